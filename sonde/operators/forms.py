"""Questionnaires in free text: evening and morning forms as columns. Sections are cut once, fields are read from their section."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.functions import scalars as S
from sonde.operators import reports

YES = "예"
NUMBER = r"\d+(?:\.\d+)?"
AMOUNT = rf"{NUMBER}(?:[-~]{NUMBER})?"
CLOCK = r"(?:(오전|오후)\s*)?(\d+(?:[-~]\d+)?)\s*시(?:\s*(\d+(?:[-~]\d+)?)\s*분)?"
LASTS = rf"(?:({AMOUNT})\s*(?:시간|시))?(?:\s*({AMOUNT})\s*분)?"

# Sections of the evening form.
SECTIONS = {
    "history": r"1\.\s*현재 다음과 같은 질환.*?\n(.*?)\n2\.",
    "psqi": r"수면의\s*질\s*지수\s*\(PSQI\)(.*?)(?:주간\s*졸림도|\z)",
    "ess": r"(The Epworth Sleepiness Scale.*)",
    "fss": r"(피로 정도에 대한 설문.*)",
    "berlin": r"Berline\s*Questionnaire(.*?)(?:불면증|하지불안|\z)",
    "rls": r"하지불안증후군 / 주기성사지운동증후군(.*?)(?:하지불안증후군에 대한 설문|\z)",
    "irls": r"하지불안증후군에 대한 설문 \(Restless Legs Syndrome Rating Scale\)(.*)",
    "rbd": r"수면중\s*이상행동(.*?)(?:수면의\s*질|주간\s*졸림도|\z)",
    "phq": r"Patient\s*Health\s*Questionnaire(.*?)(?:총점|\z)",
}
# Measures, each after its label.
MEASURES = {"Height_cm": "신장", "Weight_kg": "체중", "BMI": "BMI", "Neckcir_cm": "목둘레"}
# Habits, the question and what says yes to it.
HABITS = {
    "Habit_Caffein": (r"카페인\s*섭취.*?질문", r"카페인.*?마신다"),
    "Habit_Alcohol": (r"음주\s*에\s*대한\s*질문", r"음주.*?마신다"),
    "Habit_Workout": (r"운동\s*에\s*대한\s*질문", r"운동.*?운동한다"),
}
SMOKING = (r"흡연\s*에\s*대한\s*질문", r"흡연.*?금연했다면", r"흡연.*?피운다")
# Illnesses ticked in the history.
HISTORY = {
    "PHx_CVA": "뇌졸중", "PHx_Parkinson": r"파킨슨씨\s*병", "PHx_PNS": r"말초\s*신경질환", "PHx_Epilepsy": r"경련성\s*질환", "PHx_Dementia": "치매|노망",
    "PHx_Alcoholism": r"알코올\s*중독증", "PHx_Cancer": "암", "PHx_Renal": r"신부전\s*\(신장질환\)", "PHx_Pulmonary": r"만성\s*폐질환", "PHx_HTN": "고혈압",
    "PHx_Thyroid": "갑상선질환", "PHx_Liver": "간염", "PHx_DM": "당뇨", "PHx_Cardiovascular": "심장질환", "PHx_NasalFx": r"코뼈가\s*부러진\s*적",
    "PHx_Sinusitis": r"축농증|알러지성\s*비염", "PHx_GERD_ulcer": r"위궤양|위식도\s*역류", "PHx_Psy": "정신과적 질환|우울증|불안증|공황장애",
}
# Questions that yes or no follows.
ASKED = {
    "Shiftwork": r"교대\s*근무를\s*합니까\?\s*", "SQ_Satisfaction": r"밤에 수면시간이 충분하다고 느끼십니까\?\s*", "Nap_Satisfaction": r"낮잠을 자고 나면 상쾌합니까\?\s*",
    "N_Sleepattack": r"나도\s*모르게\s*잠에\s*빠져\s*든\s*적.*?", "N_Cataplexy": r"몸에\s*실제로\s*힘이\s*빠져.*?넘어지거나.*?", "N_Hallucination": r"환각이나\s*꿈\s*같은\s*이미지.*?", "N_Paralysis": r"가위\s*눌림.*?",
}
# Items of the scales by what they say.
ESS = {"book": "앉아서 책", "tv": "텔레비전", "sitting": "회의석상", "transport": "버스나", "rest": "오후 휴식", "talk": "누군가에게", "meal": "점심식사", "driving": "차를 운전"}
FSS = (
    "내가 피로해지면 나는 의욕이 낮아진다.", "운동을 하면 피로해진다.", "나는 쉽게 피곤해진다.", "피로로 인해 신체적 활동이 방해를 받는다.", "피로로 인해 빈번하게 문제가 발생한다.",
    "피로하면 신체적 활동을 지속할 수 없다.", "피로하면 의무와 책임을 다하지 못하게 된다.", "피로는 나에게 가장 지장을 초래하는 세 가지", "피로로 인해 나의 일, 가족, 혹은 사회생활이",
)
RLS = {
    "RLS_01_urge": r"다리에\s*불편하거나\s*좋지\s*않은\s*감각으로\s*인해\s*다리를\s*자꾸\s*움직이고\s*싶습니까\?", "RLS_02_rest": r"다리를\s*움직이고\s*싶은\s*충동이나\s*좋지\s*않은\s*감각이\s*쉬거나.*?악화되나요\?",
    "RLS_03_move": r"다리를\s*움직이고\s*싶은\s*충동이나\s*좋지\s*않은\s*감각은\s*걷거나\s*움직임에\s*따라\s*완화되나요\?",
    "RLS_04_night": r"다리를\s*움직이고\s*싶은\s*충동이나\s*좋지\s*않은\s*감각이\s*낮보다\s*저녁이나\s*밤에\s*더\s*나빠지거나.*?발생하나요\?",
    "RLS_05_frequency": r"얼마나\s*자주\s*발생하나요\?", "RLS_06_family": r"가족\s*중에\s*이런\s*증세를\s*가진\s*분이\s*계신가요\?", "RLS_07_observed": r"수면\s*중\s*발목을\s*움직인다거나\s*다리를\s*주기적으로\s*움직인다는\s*이야기",
}
IRLS = (
    r"불편이\s*어느\s*정도인가요\?", r"움직이고\(돌아다니고\)\s*싶은\s*정도는\?", r"움직이게\(돌아다니게\)\s*되면.*?나아지나요\?", r"수면장애가\s*얼마나\s*심하나요\?", r"주간\s*피로감이나\s*졸림이\s*어느\s*정도인가요\?",
    r"전체적으로\s*볼\s*때.*?심한\s*정도는\?", r"얼마나\s*자주.*?발생하나요\?", r"평균\s*하루\s*어느\s*정도의\s*증상이\s*있나요\?", r"일상생활에\s*얼마나\s*지장을\s*주나요\?", r"기분장애.*?얼마나\s*심한가요\?",
)
RBD_FIRST = {"RBD_FreqDream": r"꿈을\s*많이\s*꾸십니까", "RBD_Observed": r"고약한\s*잠버릇"}
RBDSQ = {1: "생생한", 2: "공격적인", 3: "일치한다", 4: r"알고\s*있다", 5: r"다칠\s*뻔하거나", 7: r"스스로\s*깨기도", 8: r"잘\s*기억한다", 9: r"잘\s*깬다"}
CAUSES = (r"뇌\s*졸중", r"두부\s*외상", r"파키?\s*슨|파킨\s*슨", r"하지\s*불안\s*증후군", r"기면\s*발작", r"우울\s*증", r"뇌전\s*증", r"중추\s*신경계\s*염증")
# Answers of the Berlin form with their codes, the first that is found counts; questions that share answers together.
BERLIN = {
    (1,): (("증가", 1), ("감소", 2), ("변하지", 3)), (2,): (("예", 1), ("아니오", 2), ("모르", 3)), (3,): (("매우", 4), ("말하는 것보다", 3), ("말하는 정도", 2), ("숨쉬는", 1)),
    (4, 6, 7, 8): (("매일", 1), ("3-4", 2), ("1-2.*주|주.*1-2", 3), ("1-2.*달|달.*1-2", 4), ("전혀", 5)), (5, 9, 10): (("예", 1), ("아니오", 2)),
}
# Questions of the morning form by number, and its prompt for dreams.
MORNING = (
    "어제 밤 평소 복용하시던 수면제가 있다면 복용 여부를 알려주십시오.", "어젯밤 불을 끈 후 잠이 드는데 까지 얼마나 걸렸습니까", "보통 집에서 잠이 드는데 걸리는 시간과 비교할 때 이 시간은",
    "어젯밤에 얼마나 오랫동안 잠을 잤다고 생각하십니까", "보통 집에서 잠자는 시간과 비교할 때 이 시간은", "어젯밤에 잠자는 동안 몇 번 깨었습니까", "현재 당신은 어떻다고 생각 되십니까",
    "오늘 아침 신체적으로 불편한 점이 있다면", "어젯밤 당신의 수면에 대한 평가를 내린다면 아래에 있는 다섯 가지 항목에서", "어젯밤 당신은 꿈을 기억하십니까", "오늘 아침 어떻게 잠에서 깨어났습니까",
    "어젯밤의 수면을 평소 집에서의 수면과 비교하면 어떻다고 생각하십니까",
)
DETAILS = "자세히 설명하십시오."
RATINGS = {"a": "㉠", "b": "㉡", "c": "㉢", "d": "㉣", "e": "㉤"}


def amount(c: Column, how: str = "mid") -> Column:
    """The middle or greater end of the first `a-b` or `a~b`, else the first number."""
    pair = rf"({NUMBER})\s*[-~]\s*({NUMBER})"
    a, b = S.found(c, pair, 1).cast("double"), S.found(c, pair, 2).cast("double")
    return F.coalesce((a + b) / 2 if how == "mid" else F.greatest(a, b), S.found(c, f"({NUMBER})").cast("double"))


def whole(c: Column) -> Column:
    return c.try_cast("int")


def yes_no(c: Column) -> Column:
    """예 is 1, 아니오 0; other texts by whether they hold the first."""
    t = F.trim(c)
    return F.when(t == "", None).when(F.contains(t, F.lit(YES)), 1).when(t.isNotNull(), 0)


def hours_minutes(half: Column | None, hour: Column, minute: Column, bed: str | None = None) -> Column:
    """struct(h, m) of a length of time, or, with `bed` of in or out, of a clock with or without its half of the day.

    Twelve at bedtime is midnight. Without a half, bedtimes from 6 to 11 are in the evening and getting up from 1 to 11
    in the morning. Parts of hours become minutes.
    """
    h, m = amount(hour), F.coalesce(amount(minute), F.lit(0.0))
    h = F.when(hour.isNull() & minute.isNotNull(), 0.0).otherwise(h)
    if bed:
        guess = F.when(h.between(6, 12) & ~((h >= 12) & (h < 13)), "오후").otherwise("오전") if bed == "in" else F.when(h.between(1, 11), "오전").otherwise("오후")
        part = F.coalesce(F.nullif(F.trim(half), F.lit("")), guess)
        noon = (h >= 12) & (h < 13) & F.lit(bed == "in")
        h = F.when(noon, h - 12).when((part == "오전") & (h == 12), 0.0).when((part == "오후") & (h < 12), h + 12).otherwise(h)
    total = F.rint(F.floor(h) * 60 + (h - F.floor(h)) * 60 + m)
    return F.when(h.isNotNull(), F.struct(F.floor(total / 60).cast("int").alias("h"), (total % 60).cast("int").alias("m")))


def _week(base: str, section: Column, labels: tuple[str, str], bed: str | None = None) -> list[Column]:
    """HH and MM of weekdays and free days, each after its label."""
    out = []
    for end, label in zip(("week", "free"), labels, strict=True):
        lead = rf"(?s){label}\s*[:\s]\s*"
        t = hours_minutes(*(S.found(section, lead + CLOCK, k) for k in (1, 2, 3)), bed=bed) if bed else hours_minutes(None, *(S.found(section, lead + LASTS, k) for k in (1, 2)))
        out += [t["h"].alias(f"{base}_HH_{end}"), t["m"].alias(f"{base}_MM_{end}")]
    return out


def _block(section: Column, n: int) -> Column:
    return S.found(section, rf"(?s)({n}\.\s*.*?)(?:\s*{n + 1}\.|\z)")


def evening(df: DataFrame, text: str, zero_history: bool = True) -> DataFrame:
    """`df` with the fields of an evening questionnaire; what isn't asked or answered is null.

    Illnesses are 0 where the history section is missing, as in the source; with zero_history off they are null there.
    """
    body = F.trim(F.regexp_replace(text, " ", " "))
    rows = df.withColumn("__t", F.when((body != "") & (body != "매치없음"), body))
    rows = rows.withColumns({f"__{name}": S.found("__t", f"(?s){p}") for name, p in SECTIONS.items()})
    t, out = F.col("__t"), []
    out += [F.floor(amount(S.found(t, rf"{label}\s*([\d.~-]+)")) + 0.5).cast("int").alias(k) for k, label in MEASURES.items()]
    out.append(F.trim(S.found(t, r"직업\s+([^\n]+)")).alias("Occupation"))
    out += [F.when(t.rlike(f"(?s){asked}"), t.rlike(f"(?s){yes}").cast("int")).alias(k) for k, (asked, yes) in HABITS.items()]
    asked, quit_, smokes = SMOKING
    out.append(F.when(t.rlike(f"(?s){asked}"), F.when(t.rlike(f"(?s){quit_}"), 1).when(t.rlike(f"(?s){smokes}"), 2).otherwise(0)).alias("Habit_Smoking"))
    history = F.coalesce("__history", F.when(t.isNotNull(), "")) if zero_history else F.col("__history")
    out += [history.rlike(p).cast("int").alias(k) for k, p in HISTORY.items()]
    out += [yes_no(S.found(t, f"(?s){p}({YES}|아니오)")).alias(k) for k, p in ASKED.items()]
    psqi = F.col("__psqi")
    for n, (base, bed) in enumerate((("PSQI_01_BedIn", "in"), ("PSQI_02_Latency", None), ("PSQI_03_BedOut", "out"), ("PSQI_04_SD", None)), 1):
        out += _week(base, _block(psqi, n), ("주중", "주말"), bed)
    woken = r"밤에\s*몇\s*번\s*깨십니까\?[^\n]*?"
    out.append(F.coalesce(whole(S.found(t, woken + r"(\d+)\s*번")), whole(amount(S.found(t, woken + r"([\d\-\s~]+)번"), "max"))).alias("SQ_Wakefreq"))
    out.append(whole(amount(S.found(t, r"낮잠을\s*잡니까\?[^\n]*?([\d\-\s~]+)번"), "max")).alias("Nap_Freq"))
    out += _week("Nap", S.found(t, r"([^\n]*평균\s*낮잠\s*시간[^\n]*)"), ("평일", "주말"))
    out.append(whole(S.found(t, r"(?s)Stanford\s*Sleepiness\s*Scale.*?(\d+)\.")).alias("SSS"))
    out += [whole(S.found("__ess", rf"(\d+)\s*\*\s*[^\n]*?\Q{w}\E")).alias(f"ESS_{i:02d}_{k}") for i, (k, w) in enumerate(ESS.items(), 1)]
    out += [whole(S.found("__fss", rf"\Q{w}\E[^\n]*?\s+(\d+)")).alias(f"FSS_{i:02d}") for i, w in enumerate(FSS, 1)]
    for own, answers in BERLIN.items():
        for i in own:
            said = S.found("__berlin", rf"{i}\.[^\n]*?\n\s*([^\n]*?)\s*(?:\n|\z)")
            code = None
            for word, n in answers:
                code = F.when(said.rlike(word), n) if code is None else code.when(said.rlike(word), n)
            out.append(code.alias(f"BQ_{i:02d}"))
    out += [whole(S.found("__rls", rf"(?s){p}.*?(\d)\.")).alias(k) for k, p in RLS.items()]
    out += [whole(S.found("__irls", rf"(?s){p}.*?(\d)\.")).alias(f"IRLS_{i:02d}") for i, p in enumerate(IRLS, 1)]
    answer = rf"({YES}|아니오)[^\S\n]*$"
    out += [yes_no(S.found("__rbd", rf"(?smd){p}.*?{answer}")).alias(k) for k, p in RBD_FIRST.items()]
    out += [yes_no(S.found("__rbd", rf"(?smd)^{n}\s+.*?{p}.*?\s+{answer}")).alias(f"RBDSQ_{n:02d}") for n, p in RBDSQ.items()]
    out += [yes_no(S.found("__rbd", rf"(?smd)^6\.{n}\s+.*?\s+{answer}")).alias(f"RBDSQ_06_{n:02d}") for n in range(1, 5)]
    tenth = rf"(?smd)^10\s+.*?신경계.*?\s+{answer}"
    ten = yes_no(S.found("__rbd", tenth))
    rest = F.substring_index(S.found("__rbd", tenth + "(.*)", 2), "총점", 1)
    codes = F.array_compact(F.array(*[F.when(rest.rlike(p), F.lit(str(i))) for i, p in enumerate(CAUSES, 1)]))
    out += [ten.alias("RBDSQ_10"), F.when(ten == 1, F.nullif(F.array_join(codes, ","), F.lit(""))).alias("RBDSQ_10_Y")]
    out += [whole(S.found("__phq", rf"(?s){i}\..*?(\d)\s*(?:\n|\z)")).alias(f"PHQ_{i:02d}") for i in range(1, 10)]
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def segments(text: Column) -> dict[int, Column]:
    """For each question of the morning form what stands between it and the next question present, null if it isn't there.

    Questions are found by their whole sentence, for answers are numbered too.
    """
    lead = {n: rf"(?i){n}\.\s*" + r"\s+".join(re.escape(w) for w in q.split()) + r"\s*[?.)]?" for n, q in enumerate(MORNING, 1)}
    start = {n: F.regexp_instr(text, F.lit(p)) for n, p in lead.items()}
    out = {}
    for n, p in lead.items():
        later = F.array_compact(F.array(*[F.when(s > start[n], s) for m, s in start.items() if m != n]))
        end = F.coalesce(F.array_min(later), F.length(text) + 1)
        from_here = F.substring(text, start[n], end - start[n])
        out[n] = F.when(start[n] > 0, F.regexp_replace(from_here, "^" + p, ""))
    return out


def complaint(c: Column) -> Column:
    """Free text without what surrounds it; one space stays after a last full stop that had any."""
    t = F.regexp_replace(c, r"^[\r\n]+|[\r\n]+\z", "")
    bare = F.regexp_replace(t, r"^\s+|\s+\z", "")
    return F.when(t.rlike(r"\.\s+\z"), F.concat(F.regexp_replace(F.regexp_replace(t, r"\s+\z", ""), r"^[\r\n]+", ""), F.lit(" "))).otherwise(F.nullif(bare, F.lit("")))


def dream(c: Column) -> Column:
    """Free text from its first letter on; last line feeds go, but for the one of a last '.' CR LF."""
    t = F.regexp_replace(c, r"^\s+", "")
    cut = F.regexp_replace(t, r"\n+\z", "")
    return F.nullif(F.when(t.rlike(r"\r\n\z") & cut.rlike(r"\.\r\z"), F.concat(cut, F.lit("\n"))).otherwise(cut), F.lit(""))


def morning(df: DataFrame, text: str) -> DataFrame:
    """`df` with the 20 fields of a morning questionnaire; questions that aren't there give nulls."""
    rows = df.withColumns({f"__s{n}": s for n, s in segments(F.col(text)).items()})
    s = {n: F.col(f"__s{n}") for n in range(1, len(MORNING) + 1)}
    said = lambda c: F.when(F.contains(c, F.lit("아니오")), 0).when(F.contains(c, F.lit(YES)), 1)
    h, m = ({n: reports.sleep_parts(s[n])[k] for n in (2, 4)} for k in ("h", "m"))
    minutes = {n: h[n] * 60 + m[n] for n in (2, 4)}
    told = F.when(F.contains(s[10], F.lit(DETAILS)), F.regexp_replace(s[10], rf"(?s)^.*?\Q{DETAILS}\E", ""))
    out = {
        "01_Hypnotics": said(s[1]), "02_SubSL_HH": h[2], "02_SubSL_MM": m[2], "02_SubSL_min": minutes[2], "02_SubSL_Home": reports.answer_code(s[3], reports.COMPARED),
        "03_SubSD_HH": h[4], "03_SubSD_MM": m[4], "03_SubSD_hr": F.round(minutes[4] / 60, 9), "03_SubSD_Home": reports.answer_code(s[5], reports.COMPARED), "04_WakeNo": reports.wakings(s[6]),
        "05_Alertness": reports.answer_code(s[7], reports.ALERTNESS), "05_Complaint": complaint(s[8]), **{f"06_SQ_{k}": S.found(s[9], rf"{mark}\s*(\d+)").cast("double") for k, mark in RATINGS.items()},
        "07_Dream": said(s[10]), "07_Dream_text": dream(told), "08_Wake": reports.answer_code(s[11], reports.WOKEN_BY),
    }
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(f"PSG_M_{k}") for k, c in out.items()])
