"""Routes of pages, categories and families of their forms, families carried over pages, and what type a study is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.functions import names
from sonde.functions import scalars as S

# Routes and the phrases that decide on one at once, in order.
SIGNALS, REPORT, REPORT_LONG = "map_route_polysomnography_signals", "map_route_psg_report_general", "map_route_psg_report_extensive"
PRESSURE, PRESSURE_LONG = "map_route_cpap_psg_report_general", "map_route_cpap_psg_report_extensive"
MORNING, NIGHT = "map_route_morning_questionnaire", "map_route_night_questionnaire"
PHRASES = (
    (PRESSURE_LONG, ("full night cpap polysomnography report",)),
    (REPORT_LONG, ("night polysomnography report",)),
    (MORNING, ("아침 질문 사항",)),
    (NIGHT, ("병력과 가족력", "수면 습관", "생활 습관", "Stanford Sleepiness Scale", "Epworth Sleepiness Scale", "Pittsburgh Sleep Quality Index", "피로 정도에 대한 설문", "Fatigue Severity Scale", "Berlin Questionnaire", "Insomnia Severity Index", "하지불안증후군/주기성사지운동증후군", "하지불안증후군에 대한 설문", "우울증에 관한 설문", "Beck Depression Inventory", "삶의 질 척도", "WHOQOL-BREF")),
)
# Hints (name, pattern, weight) of each route, searched without regard to case.
HINTS = {
    SIGNALS: (
        ("note", r"this page contains psg signal graphs\.", 6),
        ("channels", r"\b(?:f3-a2|c3-a2|f4-a1|c4-a1|o1-a2|o2-a1|le-a2|re-a1|so-a2|io-a2|chin1-chin2|snore-ref|emg-ref|ptaf-ref|chest-ref|abd-ref|lleg-ref|rleg-ref)\b", 4),
        ("terms", r"\b(?:epoch|flow|snore|spo2|hr|body|position|stage|events?)\b", 1),
    ),
    PRESSURE: (
        ("title", "cpap polysomnography|cpap titration|pap titration|nasal cpap titration", 3), ("units", r"\bcpap\b|\bpap\b|cmh2o|cmh_?2o", 2),
        ("footer", r"optimal cpap pressure|pressure\s*(?:\(|\d)|mask leak|mouth breathing", 2), ("steps", r"(?:^|\n)\s*pressure\s+\d+\s*cmh2o", 2),
    ),
    REPORT: (
        ("title", r"신경과\s*수면검사|수면다원검사|polysomnography(?:\s+(?:data|report))?", 3), ("metrics", r"\b(?:tst|ahi|rdi|sleep efficiency|sleep latency|rem latency|lowest\s*sao2|lowest\s*spo2)\b", 2),
        ("channels", r"\b(?:eeg|eog|emg|ecg|ekg|airflow|thorax|abd(?:omen)?|spo2|snor(?:e|ing)?|position|leg|chin)\b", 2), ("leads", r"\b(?:c3-a2|c4-a1|o1-a2|o2-a1|f3-m2|f4-m1)\b", 2),
        ("clinician", r"diagnosis|impression|interpretation|clinical\s+correlation|technologist|physician", 2), ("events", "respiratory event|apnea|hypopnea|arousal index|stage n1|stage n2|stage n3|rem/tst", 2),
    ),
    MORNING: (
        ("text", r"어젯밤|오늘\s*아침|보통\s*집에서|잠에서\s*깨어|얼마나\s*오랫동안\s*잠을", 2), ("items", r"수면제|꿈을\s*기억|잠자는\s*동안\s*몇\s*번\s*깨|어떻게\s*잠에서\s*깨어", 2),
        ("title", r"어젯밤\s*당신의\s*수면에\s*대한\s*평가|오늘\s*아침\s*신체적으로\s*불편", 3),
    ),
    NIGHT: (
        ("title", r"questionnaire|설문지|문진표|자가기입|자가\s*보고|지난\s*한\s*달간", 2), ("scales", r"\b(?:psqi|epworth|ess|fss|bq|berlin questionnaire|isi|rbdsq|phq|whoqol)\b", 2),
        ("marks", r"\[\s*selected!\s*\]|◯|○|☑|✓|체크|예\s*/\s*아니오|예\s+\[selected!\]|아니오\s+\[selected\]", 2), ("items", r"(?:^|\n)\s*\d{1,2}\.\s", 1), ("language", "환자|본인|주중|주말|잠이|졸립|피곤|깼|수면", 1),
    ),
}
TABLE_HINTS = ("metrics", "events", "clinician")
LONG_REPORT, LONG_PRESSURE = "night polysomnography report", "full night cpap polysomnography report"
# Families of official forms and their titles, in order; those of several pages; what ends a form; what tells a second page.
FAMILIES = {
    "MQ": ("아침 질문 사항",), "SSS": ("Stanford Sleepiness Scale",), "ESS": ("Epworth Sleepiness Scale",), "FSS": ("Fatigue Severity Scale", "피로 정도에 대한 설문"), "BQ": ("Berlin Questionnaire",),
    "ISI": ("Insomnia Severity Index", "불면증에 관한 설문", "불면증에 관한 질문"), "RLS": ("하지불안증후군/주기성사지운동증후군", "Restless Legs Syndromes and PLMS questions"), "IRLS": ("하지불안증후군에 대한 설문",),
    "RBD": ("RBDSQ", "REM sleep behavior", "렘수면행동장애", "꿈을 많이 꾸십니까", "고약한 잠버릇"), "PHQ": ("PHQ", "Patient Health Questionnaire"), "PSQI": ("수면의 질 지수", "Pittsburgh Sleep Quality Index"),
    "BDI": ("우울증에 관한 설문", "Beck Depression Inventory"), "QOL": ("삶의 질 척도", "WHOQOL-BREF"),
}
SEVERAL_PAGES, WITH_CUE = ("PSQI", "BDI", "QOL"), "PSQI"
BREAKS = ("생활 습관", "병력과 가족력", "수면 습관", "수면에 관한 설문지", "수면다원검사 설문지", r"POLYSOMNOGRAPHY\s*\|\s*QUESTIONNAIRE", "SLEEP QUESTIONNAIRE", "SLEEP - WAKE QUESTIONNAIRE", "Living habit")
SECOND_PAGE = (r"During the past month,\s*how would you rate your sleep quality overall\?", "rate your sleep quality overall", r"지난 한달 동안,\s*당신의 전반적인 수면의 질은 어떠하였습니까")
# Categories and their patterns.
CATEGORIES = {
    "basic": (r"\b등록번호\b", r"\b병록 번호\b", r"\bhospi\.\s*no\b", r"\bid:\b", r"\b성명\b", r"\bname\b", r"\b성별\b", r"\bsex\b", r"\b연령\b", r"\bage\b", r"\b검사일\b", r"\bdate:\b", r"\bstudy date\b", r"\bpsg#\b", r"\btest no\.\b", r"\bsleep study number\b", r"\bheight\b", r"\bweight\b", r"\bbody mass index\b", r"\bneck circumference\b", r"\b직업:\b", r"교대\s*근무", "근무시간"),
    "phx_habit": ("생활 습관", "병력과 가족력", "living habit", "medical history", "family history", "직업", r"교대\s*근무", "질환을 앓고 있거나 과거에 앓은 적", "카페인", "음주", "흡연", "운동"),
    "sleep_behavior": ("수면 습관", "수면에 관한 설문지", "수면다원검사 설문지", "polysomnogr?aphy questionnaire", "sleep questionnaire", "sleep - wake questionnaire", "밤에 몇 번 깨십니까", "낮잠", "낮에 과도하게 졸립", "가위 눌림", "환각이나 꿈 같은 이미지"),
    "mq": ("아침 질문 사항", "어젯밤 불을 끈 후", "어젯밤에 얼마나 오랫동안 잠을 잤다고 생각", "오늘 아침 어떻게 잠에서 깨어났"),
    "psg": ("polysomnography report", "night polysomnography report", "respiratory disturbance index", "sleep efficiency", r"lowest\s+spo?2", "this page contains psg signal graphs", "arousal index", "periodic limb movement", "수면다원검사", "수면 효율", "호흡장애지수"),
    "cpap": ("cpap polysomnography report", "full night cpap polysomnography report", r"\bcpap\b", r"\bpap\b", r"pressure\s+\d+\s*cmh2o", "optimal cpap pressure", "mask leak", "mouth breathing"),
    "psqi": ("pittsburgh sleep quality index", "수면의 질 지수"), "sss": ("stanford sleepiness scale",), "ess": ("epworth sleepiness scale",), "fss": ("fatigue severity scale", "피로 정도에 대한 설문"), "berlin": ("berlin questionnaire",),
    "isi": ("insomnia severity index", "불면증에 관한 설문", "불면증에 관한 질문"), "rls": ("restless legs syndromes and plms questions", "하지불안증후군/주기성사지운동증후군", "하지불안증후군에 대한 설문"),
    "rbd": ("rbdsq", "rem sleep behavior", "렘수면행동장애", "고약한 잠버릇", "꿈에서의 행동", "잠자는 동안 몸부림", "수면 중 소리를 지르", "팔을 휘두르", "신경계 질환이 있다"),
    "phq": (r"\bphq\b", "patient health questionnaire", "기분이 가라앉거나 우울하거나 희망이 없", "평소 하던 일에 대한 흥미가 없어지거나 즐거움을 느끼지 못", "차라리 죽는 것이 낫겠다고"),
    "bdi": ("beck depression inventory", "우울증에 관한 설문"), "qol": ("whoqol", "삶의 질 척도", "quality of life"),
}
ALONE, DEFAULT_CATEGORY = ("mq", "cpap", "psg"), "phx_habit"
# Type codes of studies; cues of pressure nights and nap tests.
STUDY_TYPES = {"1": "P", "2": "PE", "3": "C", "4": "SP", "5": "M"}
PRESSURE_CUES = r"full\s+night\s+cpap\s+polysomnography|nasal\s+cpap\s+titration|optimal\s+cpap\s+pressure|this\s+polysomnogram\s+was\s+a\s+full\s+night\s+cpap\s+titration"
NAP_CUES = r"\bmslt\b|multiple sleep latency"
# Pressure steps, and where a page of titration names one.
FIRST_STEP, LAST_STEP = 5, 29
STEP_ANCHORS = (r"\bfull\s+night\s+cpap\s+polysomnography\b", r"\bnasal\s+cpap\s+titration\b", r"\bcpap\s+titration\b", r"\boptimal\s+cpap\s+pressure\b", r"\bnasal\s+cpap\s+at\s+\d{1,2}\s*cm")
STEP_RANGES = (r"\bpressure\s*(\d{1,2})\s*[~\-–]\s*(\d{1,2})\s*m?\s*cm\s*/?\s*h2o\b", r"\bpressure\s*(\d{1,2})\s*[~\-–]\s*(\d{1,2})\s*m?h2o\b")
STEP_BULLET = r"(?:^|\*)\s*pressure\s*(\d{1,2})\s*cm\s*/?\s*h2o\b"
STEP_ROWS = (r"^\s*\|?\s*(\d{1,2})\s*/\s*([0-9]+(?:\.[0-9]+)?)\b", r"^\s*(\d{1,2})\s+([0-9]+(?:\.[0-9]+)?)\s*\|", r"^\s*\|?\s*(\d{1,2})\s*\|\s*([0-9]+(?:\.[0-9]+)?)\s*\|")
STEP_OPTIMAL, STEP_ADVISED = r"\boptimal\s+cpap\s+pressure\s*:?\s*(\d{1,2})\s*cm", r"\bnasal\s+cpap\s+at\s*(\d{1,2})\s*cm"


def holds(text: str | Column, *patterns: str) -> Column:
    """Whether any of the patterns is found, whatever its case; Unicode word edges. False for a null text."""
    return F.coalesce(S.col(text).rlike("(?iuU)" + "|".join(f"(?:{p})" for p in patterns)), F.lit(False))


def ordered(choices: list[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """The value of the first condition that holds."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.coalesce(*[F.when(c, lit(v)) for c, v in choices], lit(default))


def phrase_route(text: str | Column) -> Column:
    plain = F.lower(S.collapse_spaces(text))
    return ordered([(reduce(Column.__or__, [F.contains(plain, F.lit(w.lower())) for w in words]), name) for name, words in PHRASES], None)


def routed(df: DataFrame, text: str) -> DataFrame:
    """`df` with route, confidence, reason and one score a route.

    A deciding phrase gives its route with high confidence. Else weights of the hints found are summed; the highest sum,
    the first named of equals, is the route if it isn't beaten by rule: pages with the note of signal graphs, or with
    signals and no table, are signals; pressure and study reports need 3 and 2 more than the second sum. Confidence is high from a
    lead of 4 on, medium from 2.
    """
    rows = df.withColumn("__direct", phrase_route(text))
    rows = rows.withColumns({f"score_{name}": F.when(F.col("__direct").isNotNull(), 0).otherwise(sum((F.when(holds(text, p), w).otherwise(0) for _, p, w in own), F.lit(0))) for name, own in HINTS.items()})
    score = {name: F.col(f"score_{name}") for name in HINTS}
    ranked = F.sort_array(F.array(*score.values()), asc=False)
    rows = rows.withColumns({"__top": ranked[0], "__second": ranked[1]})
    best = ordered([(c == F.col("__top"), name) for name, c in score.items()], NIGHT)
    long, long_pressure = holds(text, LONG_REPORT), holds(text, LONG_PRESSURE)
    table = holds(text, *[p for n, p, _ in HINTS[REPORT] if n in TABLE_HINTS])
    graphs = (score[SIGNALS] >= F.greatest(F.lit(4), F.col("__second") + 1)) & ~table & ~long & ~long_pressure
    clear = F.greatest(F.lit(3), F.col("__second") + 2)
    route = ordered([
        (F.col("__direct").isNotNull(), F.col("__direct")), (holds(text, HINTS[SIGNALS][0][1]) | ((best == SIGNALS) & graphs), SIGNALS),
        ((score[PRESSURE] >= clear) & long_pressure, PRESSURE_LONG), (score[PRESSURE] >= clear, PRESSURE), ((score[REPORT] >= clear) & long, REPORT_LONG), (score[REPORT] >= clear, REPORT),
    ], best)
    lead = F.col("__top") - F.col("__second")
    confidence = ordered([(F.col("__direct").isNotNull() | (lead >= 4), "high"), (lead >= 2, "medium")], "low")
    reason = F.when(F.col("__direct").isNotNull(), "phrase").otherwise("hints")
    return rows.withColumns({"route": route, "confidence": confidence, "reason": reason}).drop("__direct", "__top", "__second")


def decided(route: Column, confidence: Column, said: Column, said_confidence: Column) -> tuple[Column, Column]:
    """(route, confidence) where an outside decision stands before the rules': names it doesn't give in any known form mean the usual route, unknown
    confidences keep the rules'; without a decision (null) the rules' stand."""
    low = F.lower(F.trim(said_confidence))
    return F.when(said.isNotNull(), names.route_name(said)).otherwise(route), F.when(low.isin("high", "medium", "low"), low).otherwise(confidence)


def router_text(text: str | Column) -> Column:
    """What is shown of a page to decide its route: pages of a night's report begin with its title."""
    t, title = S.col(text), "NIGHT POLYSOMNOGRAPHY REPORT"
    begins = F.startswith(F.regexp_replace(t, r"(?U)^\s+", ""), F.lit(title))
    return F.when(t.rlike(f"(?i){title}") & ~begins, F.concat(F.lit(f"{title}\n"), t)).otherwise(F.coalesce(t, F.lit("")))


def family(text: str | Column) -> Column:
    """The first official form whose title the text holds, else NON."""
    return ordered([(holds(text, *titles), name) for name, titles in FAMILIES.items()], "NON")


def families(pages: DataFrame, keys: list[str], order: list[str], route: str, text: str) -> DataFrame:
    """`pages` with official_family: a title starts a family, and forms of several pages go on.

    They go on until another title, a break, or a page that isn't a questionnaire; PSQI also until a page without its second page's
    cue. Four windows over one ordering of each entity's pages.
    """
    own = family(text)
    asked = F.col(route).isin(NIGHT, MORNING)
    start = F.when(~F.coalesce(asked, F.lit(False)), "NON").when(own != "NON", own).when(holds(text, *BREAKS), "NON")
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = pages.withColumn("__start", start).withColumn("__open", F.last("__start", ignorenulls=True).over(upto)).withColumn("__run", F.count("__start").over(upto))
    inside = Window.partitionBy(*keys, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    lost = F.max(F.col("__start").isNull() & ~holds(text, *SECOND_PAGE)).over(inside)
    goes_on = F.col("__open").isin(*SEVERAL_PAGES) & ((F.col("__open") != WITH_CUE) | ~lost)
    return rows.withColumn("official_family", F.coalesce("__start", F.when(goes_on, F.col("__open")), F.lit("NON"))).drop("__start", "__open", "__run")


def categories(text: str | Column) -> Column:
    """The categories of a page: morning form, pressure report or study report alone, else all others that match, else the default."""
    hits = {name: holds(text, *patterns) for name, patterns in CATEGORIES.items()}
    rest = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items() if name not in ALONE]))
    alone = [(hits[name], F.array(F.lit(name))) for name in ALONE]
    return ordered([*alone, (F.size(rest) > 0, rest)], F.array(F.lit(DEFAULT_CATEGORY)))


def week_mode(text: str | Column) -> Column:
    """weekfree where weekdays and free days are told apart, else single."""
    return F.when(holds(text, "주중|주말|weekday|weekend"), "weekfree").otherwise("single")


def steps_named(pages: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row a page: allowed and detected pressure steps (sorted arrays), explicit, optimal and advised ones, and report, whether it is a titration report."""
    line = F.col("line")

    def steps(*patterns: str) -> Column:
        found = F.concat(*[F.transform(F.regexp_extract_all(line, F.lit(f"(?i){p}"), F.lit(1)), lambda x: x.cast("int")) for p in patterns])
        return F.filter(found, lambda x: x.between(FIRST_STEP, LAST_STEP))

    def ranges(p: str) -> Column:
        ends = [F.transform(F.regexp_extract_all(line, F.lit(f"(?i){p}"), F.lit(k)), lambda x: x.cast("int")) for k in (1, 2)]
        inside = F.filter(F.arrays_zip(ends[0].alias("a"), ends[1].alias("b")), lambda r: r["a"].between(FIRST_STEP, LAST_STEP) & r["b"].between(FIRST_STEP, LAST_STEP))
        return F.flatten(F.transform(inside, lambda r: F.sequence(F.least(r["a"], r["b"]), F.greatest(r["a"], r["b"]))))

    row_at = F.coalesce(*[F.when(line.rlike(p), F.struct(F.regexp_extract(line, p, 1).cast("int").alias("s"), F.regexp_extract(line, p, 2).cast("double").alias("t"))) for p in STEP_ROWS])
    rows = pages.select(*keys, F.explode(F.split(F.col(text), r"\r\n|\n|\r")).alias("line")).withColumn("line", F.trim("line"))
    row_step = F.filter(F.array(F.when(row_at["t"] > 0, row_at["s"])), lambda x: x.between(FIRST_STEP, LAST_STEP))
    parts = {"ranged": F.concat(*[ranges(p) for p in STEP_RANGES]), "listed": F.concat(steps(STEP_BULLET), row_step), "optimal": steps(STEP_OPTIMAL), "advised": steps(STEP_ADVISED)}
    of = rows.groupBy(*keys).agg(F.max(holds("line", *STEP_ANCHORS)).alias("anchored"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(n) for n, c in parts.items()])
    allowed = F.array_sort(F.array_union("ranged", "listed"))
    some = F.size(F.concat("ranged", "listed", "optimal", "advised")) > 0
    detected = F.array_sort(F.array_distinct(F.concat("ranged", "listed", "optimal", "advised")))
    return of.select(*keys, allowed.alias("allowed"), detected.alias("detected"), F.col("listed").alias("explicit"), "optimal", "advised", (F.col("anchored") & some).alias("report"))


def study_type(c: str | Column) -> Column:
    """P, PE, C, SP or M of a code from 1 to 5, or of a text that has one as a word."""
    t = F.upper(F.trim(S.col(c).cast("string")))
    code = F.when(t.rlike(r"^\d+(?:\.0+)?$"), F.create_map(*[F.lit(x) for kv in STUDY_TYPES.items() for x in kv])[t.cast("double").cast("int").cast("string")])
    return F.when(t.rlike(r"^\d+(?:\.0+)?$"), code).otherwise(S.found(t, r"\b(PE|SP|P|C|M)\b"))


def inferred_types(pages: DataFrame, entity: str, order: str, category: str, text: str, given: DataFrame) -> DataFrame:
    """Rows (entity, type): the given type, else C or M of the first page that shows one, else P where the study has a number.

    `given` has (entity, PSG_Type, PSG_No).
    """
    named = steps_named(pages, [entity, order], text).select(entity, order, "report", (F.size(F.concat("optimal", "advised", "explicit")) > 0).alias("some"))
    rows = pages.join(named, [entity, order], "left")
    shows = F.when((F.col(category) == "cpap") & (F.coalesce("report", F.lit(False)) | F.coalesce("some", F.lit(False)) | holds(text, PRESSURE_CUES)), "C").when(holds(text, NAP_CUES), "M")
    first = rows.withColumn("__t", shows).where("__t is not null").groupBy(entity).agg(F.min_by("__t", order).alias("__t"))
    return given.join(first, entity, "left").select(entity, F.coalesce(study_type("PSG_Type"), "__t", F.when(S.normalise_value("PSG_No").isNotNull(), "P")).alias("type"))
