"""Fields of study reports and morning questionnaires: measures, titration tables, answers and study ids (JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.functions import scalars as S

# Labels of answers with their codes.
COMPARED = {"훨씬 길다": 1, "길다": 2, "같다": 3, "짧다": 4, "훨씬 짧다": 5}
ALERTNESS = {"매우 피곤하다": 1, "깨어 있지만 정신이 맑지 못하다": 2, "편안하다": 3, "깨어 있으며 정신이 맑다": 4}
WOKEN_BY = {"소음으로": 1, "불안감으로": 2, "검사실에서 깨워": 3, "자발적으로": 4, "기타": 5}
# What ends a titration table, and the steps it may have.
TABLE_ENDS = ("LEG MOVEMENT", "Optimal CPAP", "NIGHT", "POLYSOMNOGRAPHY REPORT", "Date", "Ⅰ.", "II.", "Ⅲ.", "Total PLMS Index")
STEPS = (5, 29)
# Fields of a report and the label right before each; texts, the others are numbers.
FOLLOWING = {
    "PSG_No": "PSG#", "Neckcir_cm": "Neck Circumference", "TST_min": "Total Sleep Time(min)", "SL_min": "Sleep Latency(min)", "REM_SL_min": "REM Latency(min)", "Sleep_Eff": "Sleep Efficiency(%)",
    "Arousal_no": "Total Arousal #", "Arousal_idx": "Arousal Index", "Arousal_resp_idx": "Respiratory Arousal", "Arousal_snoring_idx": "Snoring Arousal", "Arousal_PLM_idx": "PLM Arousal", "Arousal_spont_idx": "Spontaneous",
    "REM_pct": "REM/TST(%)", "N1_pct": "Stage N1/TST(%)", "N2_pct": "Stage N2/TST(%)", "N3_pct": "Stage N3/TST(%)", "PLM_idx": "Total PLMS Index", "LM_idx": "Total LM Index",
    "Arousal_PLM_idx_re": "PLM Arousal index", "Arousal_LM_no": "LM Arousal", "Arousal_LM_idx": "LM Arousal index",
}
BODY = {"Height_cm": "Height", "Weight_kg": "Weight", "BMI": "Body Mass Index"}
TEXTS = ("PSG_No",)
# Heads of the tables of a baseline report.
EVENTS = "Obstructive Apnea Central Apnea Mixed Apnea Hypopnea *Flow limit. Ar."
INDEXES = "Index Apnea Hypopnea Apnea+Hypopnea Flow limit. Arousal Snoring Arousal"
POSITIONS = "REM NREM REM N1 N2 N3 NREM"
DIAGNOSIS = ("Ⅱ. Diagnosis :", "Ⅱ. Diagnosis")
AFTER_DIAGNOSIS = "Ⅲ."
DECIMAL = r"(\d+(?:\.\d+)?)"


def waso_percent(text: str | Column) -> Column:
    return S.found(S.collapse_spaces(text), rf"WASO.*?{DECIMAL}\s+\(%\)").cast("double")


def lowest_saturation(text: str | Column) -> Column:
    """The number directly after the label; `Lowest SaO2 Awake` has none."""
    return S.found(S.collapse_spaces(text), rf"Lowest\s+SaO2\s*:?\s*{DECIMAL}").cast("double")


def movement_arousals(text: str | Column) -> Column:
    """The first count of PLM arousals, passing over rates (`/hr`)."""
    t = F.regexp_replace(S.collapse_spaces(text), r"(?i)PLM\s+Arousal\s+\S+\s+/hr?(?=\s|$)", "")
    numbers = F.transform(F.regexp_extract_all(t, F.lit(r"(?i)PLM\s+Arousal\s+(\S+)\s+\S"), F.lit(1)), S.lenient_number)
    return F.try_element_at(F.filter(numbers, lambda x: x.isNotNull()), F.lit(1))


def sleep_parts(answer: str | Column) -> Column:
    """struct(h, m) of `x 시간 y 분`, minutes, hours, and the middle of ranges, tried in that order; ranges go before single values."""
    def n(pattern: str, group: int = 1) -> Column:
        return S.found(answer, pattern, group).cast("double")

    def parts(h: Column, m: Column) -> Column:
        return F.when(h.isNotNull() & m.isNotNull(), F.struct(h.alias("h"), m.alias("m")))

    zero = F.lit(0.0)
    dash = rf"{DECIMAL}\s*[-~–]\s*{DECIMAL}\s*"
    both = rf"{DECIMAL}\s*시간\s*{DECIMAL}\s*분"
    hours = (n(dash + "시간") + n(dash + "시간", 2)) / 2
    return F.coalesce(
        parts(n(both), n(both, 2)), parts(zero, (n(dash + "분") + n(dash + "분", 2)) / 2), parts(zero, n(rf"{DECIMAL}\s*분")),
        parts(F.floor(hours).cast("double"), (hours - F.floor(hours)) * 60), parts(n(rf"{DECIMAL}\s*시간"), zero),
    )


def sleep_minutes(answer: str | Column) -> Column:
    t = sleep_parts(answer)
    return t["h"] * 60 + t["m"]


def wakings(answer: str | Column) -> Column:
    """A count of times, the larger end of a range."""
    pair = r"(\d+)\s*[-~–]\s*(\d+)\s*번"
    return F.coalesce(F.greatest(S.found(answer, pair, 1).cast("double"), S.found(answer, pair, 2).cast("double")), S.found(answer, r"(\d+)\s*번").cast("double"))


def answer_code(answer: str | Column, codes: dict[str, int]) -> Column:
    """The code of the longest label the answer holds, else its item number."""
    number = S.found(answer, rf"([1-{max(codes.values())}])\s*\.").cast("int")
    return F.coalesce(*[F.when(S.col(answer).contains(k), F.lit(codes[k])) for k in sorted(codes, key=len, reverse=True)], number)


def study_id(date: str | Column, number: str | Column, kind: str | Column, site: str = "001") -> Column:
    """`site_YYYYMMDD_n_KIND`, null unless all are there; n follows the number's last dash, or ends it."""
    digits = F.regexp_replace(S.col(date).cast("string"), r"\D", "")
    day = F.when(digits != "", F.lpad(digits, 8, "0"))
    n = S.found(F.trim(S.col(number)), r".*-(\d+)")
    n = F.coalesce(n, S.found(F.trim(S.col(number)), r"(\d+)$")).cast("long").cast("string")
    return F.concat(F.lit(f"{site}_"), day, F.lit("_"), n, F.lit("_"), F.nullif(F.upper(F.trim(S.col(kind))), F.lit("")))


def titration(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, step, minutes, position, stage, ahi, snoring, lowest, plm, respiratory, spontaneous) of the pressure table.

    A row has 12 words at least, the first two numbers, and a whole step within STEPS; of rows with one step the
    last counts. Snoring is what stands between the eighth word and the last four.
    """
    body = F.regexp_replace(F.col(text), r"\r\n?", "\n")
    table = S.found(body, r"(?s)Resp\.\s*Spon\.[^\n]*\n(.*)$")
    stop = F.concat(F.lit("\n"), table).alias("t")
    ends = "|".join(rf"\Q{e}\E" for e in TABLE_ENDS)
    rows = F.split(F.regexp_replace(stop, rf"(?s)\n[^\S\n]*(?!\d)[^\n]*?(?:{ends}).*$", ""), "\n")
    w = F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ")
    cut = df.select(key, F.posexplode(rows).alias("at", "line")).withColumn("w", w).where(F.size("w") >= 12)
    cut = cut.where(F.col("w")[0].rlike(rf"^{DECIMAL}$") & F.col("w")[1].rlike(rf"^{DECIMAL}$"))
    value = F.col("w")[0].cast("double")
    cut = cut.withColumn("step", F.rint(value).cast("int")).where((F.abs(value - F.col("step")) <= 0.01) & F.col("step").between(*STEPS))
    last = cut.groupBy(key, "step").agg(F.max_by("w", "at").alias("w"))

    def end(k: int) -> Column:
        return S.lenient_number(F.element_at("w", -k))

    snoring = S.normalise_value(F.lower(F.array_join(F.slice("w", F.lit(9), F.size("w") - 12), " ")))
    return last.select(
        key, "step", S.lenient_number(F.col("w")[1]).alias("minutes"), F.lower(F.col("w")[2]).alias("position"), F.col("w")[3].alias("stage"), S.lenient_number(F.col("w")[4]).alias("ahi"),
        snoring.alias("snoring"), end(4).alias("lowest"), end(3).alias("plm"), end(2).alias("respiratory"), end(1).alias("spontaneous"),
    )


def after_label(plain: Column, label: str) -> Column:
    """The token after a label that stands free, in a text of single spaces."""
    return S.found(plain, rf"(?:^|\s)\Q{label}\E\s+(\S+)")


def table_places() -> dict[str, tuple[str, int]]:
    """For each field of the tables of a baseline report (head, place): places count from 1 over the cells after the head."""
    out = {}
    for i, name in enumerate(("AI_obs", "AI_cent", "AI_mix", "HI")):  # a count and an index each, of all sleep, REM and NREM
        for row, part in enumerate(("", "_REM", "_NREM")):
            out[name + part] = (EVENTS, 10 * row + 2 * i + 2)
    for row, part in enumerate(("total", "sup", "lat")):
        out[f"AHI_{part}"] = (INDEXES, 5 * row + 3)
    for row, part in enumerate(("sup", "lat")):
        names = [f"REM_{part}_min", f"NREM_{part}_min", *(f"AHI_{part}_{stage}" for stage in ("REM", "N1", "N2", "N3", "NREM"))]
        out |= {name: (POSITIONS, 7 * row + k) for k, name in enumerate(names, 1)}
    return out


def cells(text: str | Column, head: str) -> Column:
    """Numbers and placeholders of the lines after a head, of each line at most as many as the head has words."""
    words = head.split()
    after = S.found(text, "(?s)" + r"\s+".join(rf"\Q{w}\E" for w in words) + "(.*)")
    token = F.lit(r"((?i)N/A|--?|[-+]?[0-9]+(?:\.[0-9]*)*)")
    return F.flatten(F.transform(F.split(after, r"\r\n|\n|\r"), lambda line: F.slice(F.regexp_extract_all(line, token, F.lit(1)), 1, len(words))))


def diagnosis(text: str | Column, kind: str | Column) -> Column:
    """The lines of the diagnosis section that begin with #.

    Split-night reports keep spaces at line ends and have a line feed after the first line, CR LF after others. The others
    lose them and have line feeds if the text has a CR and there are three lines or more, else CR LF.
    """
    t = S.col(text)
    section = F.coalesce(*[S.found(t, rf"(?s)(\Q{d}\E.*)") for d in DIAGNOSIS])
    lines = F.split(F.substring_index(section, AFTER_DIAGNOSIS, 1), r"\r\n|\n|\r")
    own = F.filter(lines, lambda x: F.ltrim(x).startswith("#"))
    bare = F.filter(F.transform(own, lambda x: F.regexp_replace(x, r"\s+$", "")), lambda x: x != "")
    split = F.concat(own[0], F.when(F.size(own) > 1, F.concat(F.lit("\n"), F.array_join(F.slice(own, F.lit(2), F.size(own)), "\r\n"))).otherwise(""))
    feeds = F.contains(t, F.lit("\r")) & (F.size(bare) > 2)
    plain = F.when(feeds, F.array_join(bare, "\n")).otherwise(F.array_join(bare, "\r\n"))
    return F.when(F.size(own) > 0, F.when(S.col(kind) == "SP", split).otherwise(plain))


def study_report(df: DataFrame, text: str, kind: str) -> DataFrame:
    """`df` with the fields of a study report of kind P, M, C or SP: common ones, body measures, and of P, M and SP those of the baseline tables."""
    k = F.upper(F.trim(kind))
    heads = {EVENTS: "__events", INDEXES: "__indexes", POSITIONS: "__positions"}
    rows = df.withColumn("__plain", S.collapse_spaces(text)).withColumns({name: cells(text, head) for head, name in heads.items()})
    plain = F.col("__plain")

    def value(name: str, label: str) -> Column:
        found = after_label(plain, label)
        return found if name in TEXTS else S.lenient_number(found)

    common = {name: value(name, label) for name, label in FOLLOWING.items()}
    common |= {"WASO_pct": waso_percent(text), "Lowest_SpO2": lowest_saturation(text), "Arousal_PLM_no": movement_arousals(text)}
    common["Neckcir_cm"] = F.rint(common["Neckcir_cm"])
    body = {name: value(name, label) for name, label in BODY.items()}
    body["BMI"] = F.rint(body["BMI"])
    base = {name: S.lenient_number(F.try_element_at(heads[head], F.lit(place))) for name, (head, place) in table_places().items()}
    base["RDI_no"] = S.lenient_number(after_label(plain, "Number"))
    base["RDI_idx"] = S.found(plain, rf"Number\s+{DECIMAL}\s+Index\s+{DECIMAL}", 2).cast("double")
    base["Diagnosis_etc"] = diagnosis(text, k)
    known = k.isin("P", "M", "C", "SP")
    out = common | {n: F.when(k.isin("P", "M", "SP"), c) for n, c in base.items()} | {n: F.when(known, c) for n, c in body.items()}
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[c.alias(n) for n, c in out.items()])


def titration_wide(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row a study with Pressure_05, Pr05_time_min, ..., for each step: the measures of `titration` under fixed names."""
    names = {"minutes": "time_min", "position": "position", "stage": "stage", "ahi": "AHI", "snoring": "snoring", "lowest": "lowest_SpO2", "plm": "PLM_idx", "respiratory": "arousal_resp_idx", "spontaneous": "arousal_spont_idx"}
    steps = list(range(STEPS[0], STEPS[1] + 1))
    long = titration(df, key, text)
    wide = long.groupBy(key).pivot("step", steps).agg(F.first(F.col("step")).alias("step"), *[F.first(c).alias(c) for c in names])
    cols = [F.col(f"{s}_step").alias(f"Pressure_{s:02d}") for s in steps] + [F.col(f"{s}_{c}").alias(f"Pr{s:02d}_{n}") for s in steps for c, n in names.items()]
    return wide.select(key, *cols)
