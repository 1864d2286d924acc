"""Facts checked against a dictionary, core fields read from page texts with their evidence, and the rules of a final row.

A dictionary has key, description, format and options (map of code to label, in order of the codes as `labels` array); facts
have key and value as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.functions import scalars as S
from sonde.operators.routing import FIRST_STEP, LAST_STEP, holds, ordered, study_type

# Words of keys and descriptions that mean times, or degrees.
TIMES = ("_hh", "_mm", "latency", "time", "duration", "sleep", "wake", "tst", "weso", "waso", "분", "시간", "시각")
DEGREES = ("severity", "freq", "frequency", "scale", "grade", "정도", "빈도", "심함", "심각")
# Bases of the keys that a form has once, or for weekdays and free days; clocks among them; times of the morning form.
WEEK_BASES = ("PSQI_01_BedIn", "PSQI_02_Latency", "PSQI_03_BedOut", "PSQI_04_SD")
CLOCKS, BEDTIME = ("PSQI_01_BedIn", "PSQI_03_BedOut"), "PSQI_01_BedIn"
MORNING_BASES = ("PSG_M_02_SubSL", "PSG_M_03_SubSD")
# Keys whose evidence is weighed line by line, by where they are written.
HEADER_KEYS = ("Hospital_ID", "Name", "PSG_Date", "PSG_No", "SEX", "AGE", "Height_cm", "Weight_kg", "BMI", "Neckcir_cm")
PROFILE_KEYS = ("Occupation", "Shiftwork")
HEADER_WORDS = r"\b(?:id|name|age|sex|date|study date|psg#?|height|weight|body mass index|neck circumference)\b"
HEADER_LABELS = r"(?:등록번호|병록\s*번호|성명|검사일|검사날짜|성별|연령|신장|체중|목둘레|목 둘레)"
PROFILE_WORDS = r"(?:직업|occupation|교대\s*근무|shift\s*work)"
AFTER_NAME = r"\b(?:id|height|age|sex|dept|study\s*date|date|psg#?|weight|technician|body\s*mass\s*index|neck\s*circumference)\b.*$"
AFTER_WORK = r"\b(?:결혼|marriage|근무시간|duty\s*time|교대\s*근무|shift\s*work|주증상|주소|전화번호|휴대폰|address|cell\s*phone)\b.*$"
NO_WORK = "취준|취업|휴직|무직|무|^x$|^없음$"
SELECTED_NO = r"selected!:\s*아니오|\[\s*selected!:\s*no\s*\]|\b아니오\b|\bno\b"
SELECTED_YES = r"selected!:\s*예|\[\s*selected!:\s*yes\s*\]|\b예\b|\byes\b"
DASHES = ("-", "--", "—", "–")
STAGES = ("w", "r", "1", "2", "3")
SITE = {"Lab_ID": 1, "Device_Type": 1}
PRESSURE_KEY, STEP_KEY = r"^Pressure_(\d{2})$", r"^Pr(\d{2})_(.+)$"
# When a second look at a page is worth it.
FEW_KEYS, LONG_ENOUGH, NUMBERS, PAIRS = 12, 180, 8, 4
RECALL = r"selected|circled|checked|\[x\]|questionnaire|pittsburgh|epworth|beck depression|insomnia severity|restless|whoqol|sleep architecture|patient information|등록번호|성명|name:|study date|total sleep time|sleep latency|rdi|ahi|arousal"
STRUCTURED = r"selected|circled|checked|\[x\]|name:|등록번호|study date|sex/age|height|weight|bmi|total sleep time|sleep latency|rem latency|sleep efficiency|arousal index|\|"
A_NUMBER, A_PAIR = r"(?U)\b\d+(?:\.\d+)?\b", r"(?U):\s*[^\n]{1,60}"
NO_CODE = 9999


def any_range(c: Column) -> tuple[Column, Column]:
    """(low, high) of the first `a~b`, `a-b`, `a to b` or `between a and b` inside a text."""
    n = r"(-?\d+(?:\.\d+)?)"
    t = F.translate(c, "～∼–—", "~~--")
    at, other = rf"(?i){n}\s*(?:~|-|to)\s*{n}", rf"(?i)between\s+{n}\s+and\s+{n}"
    a, b = (F.coalesce(S.found(t, at, k), S.found(t, other, k)).try_cast("double") for k in (1, 2))
    return F.least(a, b), F.greatest(a, b)


def format_range(c: Column) -> tuple[Column, Column]:
    n = r"(-?\d+(?:\.\d+)?)"
    a, b = (S.found(c, rf"{n}\s*-\s*{n}", k).try_cast("double") for k in (1, 2))
    return F.least(a, b), F.greatest(a, b)


def format_choices(c: Column) -> Column:
    """Upper-case tokens of a comma list of two or more short ones; null for dates, ranges and other formats."""
    tokens = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    free = ~F.contains(F.upper(c), F.lit("YYYYMMDD")) & ~c.rlike(r"\d+\s*-\s*\d+")
    return F.when(free & (F.size(tokens) >= 2) & ~F.exists(tokens, lambda x: F.length(x) > 16), F.transform(tokens, F.upper))


def format_numbers(c: Column) -> Column:
    """Whole numbers that stand alone in a comma list."""
    return F.transform(F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x.rlike(r"^-?\d+$")), lambda x: x.cast("long"))


def whole_number(c: Column) -> Column:
    """The first number, rounded half to even."""
    return F.rint(S.found(S.normalise_value(c), r"(-?\d+(?:\.\d+)?)").try_cast("double")).cast("long")


def plain_number(x: Column) -> Column:
    return F.when(F.abs(x - F.rint(x)) < 1e-9, F.rint(x).cast("long").cast("string")).otherwise(F.bround(x, 4).cast("string"))


def checked(facts: DataFrame, dictionary: DataFrame, mode: str | None = None, midpoints: bool = False) -> DataFrame:
    """`facts` with valid, the value in its normal form, and reason, null where it is valid.

    Order of the checks: unknown key; variant the page's mode (a column of weekfree or single) doesn't allow; empty; option code, code at the
    severe end of a range, number the format names, label that equals, holds or lies in the value (the first); date; choice;
    numeric range; any number; text. With midpoints a range is taken at its middle, or its severe end where the key means a
    degree; without, at its first number, as in the source. `dictionary` is a table of fixed size.
    """
    # what depends on the dictionary alone is found once an entry; what several checks need of a value is found once a row
    d = dictionary.select(F.col("key").alias("__k"), F.coalesce("description", F.lit("")).alias("__d"), F.coalesce("format", F.lit("")).alias("__f"), F.col("options").alias("__o"))
    low, high = format_range(F.col("__f"))
    d = d.withColumns({
        "__optional": F.size(F.coalesce(F.map_keys("__o"), F.array().cast("array<string>"))) > 0, "__dated": F.contains(F.upper("__f"), F.lit("YYYYMMDD")),
        "__choices": format_choices(F.col("__f")), "__low": low, "__high": high, "__numbers": format_numbers(F.col("__f")),
    })
    # a few keys hold most facts: the dictionary goes to them, they aren't shuffled by key
    rows = facts.join(F.broadcast(d), F.trim("key") == F.col("__k"), "left").withColumn("__v", S.normalise_value("value"))
    v, o, optional, dated, choices, low, high = map(F.col, ("__v", "__o", "__optional", "__dated", "__choices", "__low", "__high"))
    ranged = ~optional & ~dated & choices.isNull() & low.isNotNull()
    lo, hi = any_range(v)
    code = F.when(v.rlike(r"^-?\d+(?:\.0+)?$"), v.try_cast("double").cast("long"))
    has = lambda c: F.coalesce(F.map_contains_key(o, c.cast("string")), F.lit(False))
    label = S.option_label(v)
    hit = F.filter(F.map_entries(o), lambda e: (S.option_label(e["value"]) == label) | F.contains(S.option_label(e["value"]), label) | F.contains(label, S.option_label(e["value"])))
    coded = F.coalesce(
        F.when(has(code), code), F.when(has(F.rint(hi).cast("long")), F.rint(hi).cast("long")), F.when(has(F.rint(lo).cast("long")), F.rint(lo).cast("long")),
        F.when(F.array_contains("__numbers", code), code), F.when(F.size(hit) > 0, F.try_element_at(hit, F.lit(1))["key"].try_cast("long")),
    ).cast("string")
    words = F.lower(F.concat_ws(" ", "key", "__d"))
    named = lambda some: reduce(Column.__or__, [F.contains(words, F.lit(w)) for w in some])
    middle = F.when(named(TIMES) | ~named(DEGREES), (lo + hi) / 2).otherwise(hi)
    found = F.coalesce(F.when(F.lit(midpoints), middle), S.found(F.replace(v, F.lit(","), F.lit("")), r"(-?\d+(?:\.\d+)?)").try_cast("double"))
    rows = rows.withColumns({
        "__coded": F.when(optional, coded), "__date": F.when(~optional & dated, S.valid_date(v)), "__x": F.when(ranged, found),
        "__chosen": F.when(~optional & ~dated & F.array_contains(choices, F.upper(v)), F.upper(v)),
    })
    coded, date, x, chosen = map(F.col, ("__coded", "__date", "__x", "__chosen"))
    single = F.col("key").rlike(rf"^(?:{'|'.join(WEEK_BASES)})_(?:HH|MM)$")
    doubled = F.col("key").rlike(rf"^(?:{'|'.join(WEEK_BASES)})_.*_(?:week|free)$") | F.col("key").rlike(rf"^(?:{'|'.join(WEEK_BASES)})_(?:week|free)$")
    m = F.col(mode) if mode else F.lit(None).cast("string")
    reason = ordered([
        (F.col("__k").isNull(), "unknown_key"), ((m == "weekfree") & single, "psqi_single_variant_disallowed_by_ocr"), ((m == "single") & doubled, "psqi_weekfree_variant_disallowed_by_ocr"), (v.isNull(), "empty"),
        (v.rlike(r"^[\[{]"), "non_scalar"), (optional & coded.isNull(), "invalid_option"), (~optional & dated & date.isNull(), "invalid_date"), (~optional & ~dated & choices.isNotNull() & chosen.isNull(), "invalid_choice"),
        (ranged & x.isNull(), "not_numeric"), (ranged & ~x.between(low, high), "out_of_range"),
    ], None)
    plain = F.replace(v, F.lit(","), F.lit(""))
    number = F.when(plain.rlike(r"^-?\d+(?:\.\d+)?$"), plain_number(plain.try_cast("double")))
    normal = ordered([(optional, coded), (dated, date), (choices.isNotNull(), chosen), (low.isNotNull(), plain_number(x))], F.coalesce(number, v))
    return rows.withColumn("reason", reason).withColumn("valid", F.when(F.col("reason").isNull(), normal)).select(*facts.columns, "reason", "valid")


def dates(text: Column) -> Column:
    """All days of this century written year first, with points, dashes, slashes or in Korean, different ones in order."""
    ways = (r"\b(20\d{2})\s*[./-]\s*(\d{1,2})\s*[./-]\s*(\d{1,2})\b", r"\b(20\d{2})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일?")
    found = []
    for p in ways:
        y, m, d = (F.regexp_extract_all(text, F.lit(p), F.lit(k)) for k in (1, 2, 3))
        found.append(F.transform(F.arrays_zip(y.alias("y"), m.alias("m"), d.alias("d")), lambda t: S.date_parts(t["y"], t["m"], t["d"])))
    return F.array_distinct(F.array_compact(F.concat(*found)))


def clean_name(c: Column) -> Column:
    """A name without what follows it on the line; null with digits or under two letters."""
    t = F.regexp_replace(F.replace(c, F.lit("*"), F.lit(" ")), f"(?i){AFTER_NAME}", "")
    t = F.regexp_replace(F.regexp_replace(t, "^[^0-9A-Za-z가-힣]+", ""), r"[^0-9A-Za-z가-힣]+$", "")
    t = S.collapse_spaces(t)
    return F.when(~t.rlike("[0-9]") & (F.length(F.replace(t, F.lit(" "), F.lit(""))) >= 2), t)


def clean_occupation(c: Column) -> Column:
    t = F.regexp_replace(F.trim(c), f"(?iU){AFTER_WORK}", "")
    t = F.regexp_replace(S.collapse_spaces(F.regexp_replace(t, "^[ ,;:-]+|[ ,;:-]+$", "")), r"(?i)^(?:없음|none)\s+(?=[0-9A-Za-z가-힣])", "")
    return F.when((t != "") & ~t.rlike(r"^[_\-\s□]+$") & ~t.rlike(f"(?i){NO_WORK}"), t)


def core_fields(text: str | Column) -> dict[str, Column]:
    """Fields of a page's head, the first pattern that is found: only where they are written out."""
    t = S.col(text)
    first = lambda *ps: F.coalesce(*[S.found(t, f"(?i){p}") for p in ps])
    joint = r"sex\s*/\s*age\s*[:#]?\s*([MF])\s*/\s*(\d{1,3})"
    sex = F.lower(F.coalesce(S.found(t, f"(?i){joint}"), first(r"\bsex\b\s*[:#]?\s*(male|female|m|f)\b")))
    reversed_day = r"(?i)\b(\d{1,2})\s*day\s*(\d{1,2})\s*mo\s*(20\d{2})\s*year\b"
    back = S.date_parts(S.found(t, reversed_day, 3), S.found(t, reversed_day, 2), S.found(t, reversed_day, 1))
    return {
        "Hospital_ID": first(r"(?:등록번호|registration\s*no\.?|sleep study number|hospi\.?\s*no\.?)\D{0,12}([0-9]{6,12})", r"\bID\s*(?:[:#|]\s*)?([0-9]{6,12})\b"),
        "Name": clean_name(first(r"(?:성명|name)\s*[:#]\s*([^\n\r|]{2,80})", r"환자명\s*[:#]\s*([^\n\r|]{2,80})")),
        "PSG_No": F.regexp_replace(first(r"(?:test\s*no\.?|psg#?)\s*[:#]?\s*([A-Za-z]?\d{4}\s*[-/]\s*\d+)", r"\b(P\d{4}\s*[-/]\s*\d+)\b"), r"\s+", ""),
        "PSG_Date": F.coalesce(F.try_element_at(dates(t), F.lit(1)), back),
        "SEX": F.when(sex.startswith("m"), "Male").when(sex.startswith("f"), "Female"),
        "AGE": F.coalesce(S.found(t, f"(?i){joint}", 2), first(r"\bage\b\s*[:#]?\s*(\d{1,3})\b")),
        "Height_cm": first(r"\bheight\b\s*[:#]?\s*(\d{2,3}(?:\.\d+)?)\s*cm\b"), "Weight_kg": first(r"\bweight\b\s*[:#]?\s*(\d{2,3}(?:\.\d+)?)\s*kg\b"), "BMI": first(r"\b(?:bmi|body mass index)\b\s*[:#]?\s*(\d{1,2}(?:\.\d+)?)"),
        "ESS_Total": first(r"\bESS\b\s*[:#]?\s*(\d{1,2})\b"), "BDI_Total": first(r"\bBDI\b\s*[:#]?\s*(\d{1,2})\b"),
    }


def back_filled(facts: DataFrame, pages: DataFrame, dictionary: DataFrame, page: str, text: str) -> DataFrame:
    """`facts` (page, key, valid) with core fields of `pages` (page, text) added where the key is absent, if they check;
    a name in Latin letters gives way to one in Hangul. Column origin tells which: map or text."""
    found = pages.select(page, F.inline(F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in core_fields(text).items()]))).where("value is not null")
    more = checked(found, dictionary).where("reason is null").select(page, "key", "valid", F.lit(1).alias("__o"))
    hangul = F.col("valid").rlike("[가-힣]")
    rows = facts.select(page, "key", "valid", F.lit(0).alias("__o")).unionByName(more).withColumn("__first", F.when((F.col("key") == "Name") & hangul, F.col("__o") - 2).otherwise(F.col("__o")))
    return rows.groupBy(page, "key").agg(F.min(F.struct("__first", "valid", "__o")).alias("m")).select(page, "key", F.col("m.valid").alias("valid"), F.when(F.col("m.__o") == 0, "map").otherwise("text").alias("origin"))


def line_evidence(lines: DataFrame, category: str) -> DataFrame:
    """`lines` exploded to (key, value, source_rank, quality): every candidate for a person's fields on each line.

    Heights under 100 beside weights from 100 to 230 are taken for each other. Lower ranks are better sources.
    """
    t = F.trim("line")
    every = lambda p: F.regexp_extract_all(t, F.lit(f"(?iU){p}"), F.lit(1))
    joint = r"sex\s*/\s*age\s*[:#]?\s*([MF])\s*/\s*(\d{1,3})"
    heights, weights = every(r"(?:신장|height)\s*[:#]?\s*(\d{2,3}(?:\.\d+)?)\s*cm\b"), every(r"(?:체중|weight)\s*[:#]?\s*(\d{2,3}(?:\.\d+)?)\s*kg\b")
    pairs = F.filter(F.arrays_zip(heights.alias("h"), weights.alias("w")), lambda p: p["h"].isNotNull() & p["w"].isNotNull())
    swapped = lambda p: (p["h"].cast("double") < 100) & p["w"].cast("double").between(100, 230)
    both = (F.size(heights) > 0) & (F.size(weights) > 0)
    lone = F.when(holds(t, joint), F.array(F.upper(S.found(t, f"(?i){joint}")))).otherwise(F.concat(every(r"(?:성별|sex)[^\n\r]{0,40}selected!:\s*(male|female|m|f|남|여)"), every(r"(?:성별|sex)\s*[:#]?\s*(male|female|m|f|남|여)\b")))
    shift = F.when(holds(t, r"교대\s*근무|shift\s*work(?:er)?"), F.when(holds(t, SELECTED_NO), "No").when(holds(t, SELECTED_YES), "Yes"))
    found = {
        "Hospital_ID": every(r"(?:등록번호|병록\s*번호|ID)\s*[:#]?\s*([0-9]{6,12})"), "Name": F.transform(F.concat(every(r"(?:성명|환자명)\s*[:#]?\s*([^\n\r|]{2,80})"), every(r"\bName\b\s*[:#]?\s*([^\n\r|]{2,80})")), clean_name),
        "PSG_Date": F.when(holds(t, r"(?:검사일|검사날짜|study date|date)\b"), dates(t)), "PSG_No": F.transform(every(r"(?:PSG#?|Test\s*No\.?)\s*[:#]?\s*(P?\d{1,4}\s*[-/]\s*\d+)"), lambda x: F.regexp_replace(x, r"\s+", "")),
        "SEX": lone, "AGE": F.when(holds(t, joint), F.array(S.found(t, f"(?i){joint}", 2))).otherwise(every(r"(?:연령|age)\s*[:#]?\s*(\d{1,3})\b")),
        "Height_cm": F.when(both, F.transform(pairs, lambda p: F.when(swapped(p), p["w"]).otherwise(p["h"]))).otherwise(heights), "Weight_kg": F.when(both, F.transform(pairs, lambda p: F.when(swapped(p), p["h"]).otherwise(p["w"]))).otherwise(weights),
        "BMI": every(r"(?:BMI|Body\s*Mass\s*Index)\s*[:#]?\s*(\d{1,2}(?:\.\d+)?)"), "Neckcir_cm": every(r"(?:Neck\s*Circumference|목\s*둘레)\s*[:#]?\s*(\d{1,2}(?:\.\d+)?)\s*cm\b"),
        "Occupation": F.array(clean_occupation(S.found(t, r"(?i)(?:직업|occupation)\s*[:#]?\s*([^\n\r]+)"))), "Shiftwork": F.array(shift),
    }

    def named(key: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.struct(F.lit(key).alias("key"), x.alias("value")))

    one = [named(k, values) for k, values in found.items()]
    rows = lines.select("*", F.inline(F.flatten(F.array_compact(F.array(*one))))).where("value is not null")
    header, profile = F.col("key").isin(*HEADER_KEYS), F.col("key").isin(*PROFILE_KEYS)
    less = lambda c, n: F.when(c, n).otherwise(0)
    rank = 50 - less(header & holds(t, HEADER_WORDS), 20) - less(header & t.rlike(HEADER_LABELS), 10) - less(header & F.col(category).isin("basic", "psg", "cpap"), 6)
    rank = rank - less(profile & holds(t, PROFILE_WORDS), 20) - less(profile & F.col(category).isin("basic", "phx_habit", "mq"), 8)
    return rows.withColumns({"source_rank": rank, "quality": quality("key", "value")})


def quality(key: str, value: str) -> Column:
    """0 to 3: how much a value looks like one of its key."""
    k, v = F.col(key), F.trim(value)
    name = F.when(F.regexp_replace(v, r"\s+", "").rlike("^[가-힣]{2,5}$"), 3).when(v.rlike("^[A-Za-z ]{2,40}$"), 2).otherwise(1)
    number = F.when(v.rlike(r"(?i)^P\d{4}[-/]\d+$"), 3).when(v.rlike(r"(?i)^P?\d{3}[-/]\d+$"), 2).otherwise(1)
    measured = k.isin("Hospital_ID", "AGE", "Height_cm", "Weight_kg", "BMI", "Neckcir_cm")
    return F.when(v == "", 0).when(k == "Name", name).when(k == "PSG_No", number).when(measured, 2).when(k == "Occupation", F.when(v.rlike(f"(?i){NO_WORK}"), 0).otherwise(2)).otherwise(1)


def second_look(text: str | Column, keys: str | Column, least: int = FEW_KEYS) -> Column:
    """Whether a page's text promises more than the `keys` found: few keys, length, a hint, a hint of structure, and many numbers or pairs."""
    t = S.col(text)
    long = F.length(F.regexp_replace(t, r"(?U)^\s+|\s+$", "")) >= LONG_ENOUGH
    many = (F.regexp_count(t, F.lit(A_NUMBER)) >= NUMBERS) | (F.regexp_count(t, F.lit(A_PAIR)) >= PAIRS)
    return (S.col(keys) < least) & F.coalesce(long & holds(t, RECALL) & holds(t, STRUCTURED) & many, F.lit(False))


def guarded(facts: DataFrame, key: str = "key", value: str = "valid") -> DataFrame:
    """Pressure facts of one page with reason: a pressure must be its own step, a dash isn't a snoring."""
    step, measure = S.found(key, PRESSURE_KEY).cast("int"), S.found(key, STEP_KEY, 2)
    wrong = step.isNotNull() & ~F.coalesce(whole_number(F.col(value)) == step, F.lit(False))
    blank = measure.isNotNull() & step_value(F.col(key), F.col(value)).isNull() & S.normalise_value(value).isNotNull()
    return facts.withColumn("reason", F.when(wrong, "cpap_pressure_value_mismatch").when(blank, "cpap_placeholder_blank"))


def step_value(key: Column, value: Column) -> Column:
    """Positions in lower case with single spaces, stages without spaces in lower case, snoring in lower case without dashes, pressures whole."""
    v = S.normalise_value(value)
    snoring = F.when(~v.isin(*DASHES), F.lower(v))
    return F.when(key.rlike("_position$"), F.lower(S.collapse_spaces(v))).when(key.rlike("_stage$"), F.lower(F.regexp_replace(v, r"\s+", ""))).when(key.rlike("_snoring$"), snoring).when(key.rlike(PRESSURE_KEY), F.coalesce(whole_number(v).cast("string"), v)).otherwise(v)


def expanded_steps(dictionary: DataFrame, prototype: str = "05") -> DataFrame:
    """`dictionary` with the rows of the prototype step repeated for every step that has none; a table of fixed size."""
    proto = dictionary.where(F.col("key").rlike(rf"^(?:Pressure_{prototype}$|Pr{prototype}_)"))
    names = F.transform(F.sequence(F.lit(FIRST_STEP), F.lit(LAST_STEP)), lambda i: F.lpad(i.cast("string"), 2, "0"))
    more = proto.withColumn("__s", F.explode(names)).withColumn("key", F.regexp_replace("key", F.lit(f"(?<=^Pressure_|^Pr){prototype}"), F.col("__s"))).drop("__s")
    return dictionary.unionByName(more.join(dictionary.select("key"), "key", "left_anti").select(*dictionary.columns))


def study_number(number: str | Column, date: str | Column) -> Column:
    """P, year, dash and number of `yy-n`, `yyyy-n` and the like; two or three digits of the study's own year are it; other texts stay."""
    t = F.replace(F.regexp_replace(S.col(number), r"\s+", ""), F.lit("/"), F.lit("-"))
    left, right = S.found(t, r"^[Pp]?(\d{1,4})-(\d+)$"), S.found(t, r"^[Pp]?(\d{1,4})-(\d+)$", 2)
    year = F.substring(S.valid_date(date), 1, 4)
    full = F.when(F.length(left) == 4, left).when(F.endswith(year, F.when(F.length(left) == 1, F.concat(F.lit("0"), left)).otherwise(left)), year).otherwise(left)
    return F.when(left.isNotNull(), F.concat(F.lit("P"), full, F.lit("-"), right.cast("long").cast("string"))).otherwise(F.nullif(t, F.lit("")))


def minute(c: Column, keep_unread: bool = True) -> Column:
    """Minutes from 0 to 59, 60 as 0; null beyond; a text without a number stays if asked to."""
    x = S.first_number(c)
    x = F.when(F.abs(x - 60) < 1e-9, 0.0).otherwise(x)
    return F.when(x.isNull(), c if keep_unread else None).otherwise(F.when(x.between(0, 59), plain_number(x)))


def final_row(df: DataFrame) -> DataFrame:
    """The wide row's rules in their order, on the columns that are there (all texts): site defaults, study number, questionnaire and
    morning times, history codes, body mass, titration steps, restless-legs agreement, database id; last the study's type and earlier data are blanked.
    """
    have = set(df.columns)
    new = {c: F.lit(str(v)) for c, v in SITE.items()}
    get = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    if "PSG_No" in have:
        new["PSG_No"] = study_number("PSG_No", get("PSG_Date"))
    for base in WEEK_BASES:
        for end in ("", "_week", "_free"):
            h, m = f"{base}_HH{end}", f"{base}_MM{end}"
            if h in have:
                n = whole_number(F.col(h))
                new[h] = F.when(n.isNull(), F.col(h)).otherwise((S.clock_hour(n, base == BEDTIME) if base in CLOCKS else n).cast("string"))
            if m in have:
                new[m] = minute(F.col(m))
    for base in MORNING_BASES:
        if f"{base}_HH" in have:
            n = whole_number(F.col(f"{base}_HH"))
            new[f"{base}_HH"] = F.when(n.between(0, 23), n.cast("string"))
        if f"{base}_MM" in have:
            new[f"{base}_MM"] = minute(F.col(f"{base}_MM"), keep_unread=False)
    new |= {c: F.coalesce(whole_number(F.col(c)).cast("string"), F.col(c)) for c in df.columns if c.startswith("PHx_")}
    if {"Height_cm", "Weight_kg", "BMI"} <= have:
        h, w, b = (S.strict_number(c) for c in ("Height_cm", "Weight_kg", "BMI"))
        again = F.bround(w / (h / 100 * (h / 100)), 1)
        new["BMI"] = F.when((h > 0) & (w > 0) & (F.abs(again - b) > 1.0), plain_number(again)).otherwise(F.col("BMI"))
    for step in range(FIRST_STEP, LAST_STEP + 1):
        new |= _step_columns(step, have)
    if {"RLS_Category", "IRLS_Category"} <= have:
        new["RLS_Category"] = F.when(whole_number(F.col("IRLS_Category")) == NO_CODE, "0").otherwise(F.col("RLS_Category"))
        new["IRLS_Category"] = F.when(whole_number(F.col("RLS_Category")) == 0, str(NO_CODE)).otherwise(F.col("IRLS_Category"))
    rows = df.withColumns(new)
    if {"PSG_Date", "PSG_No", "PSG_Type"} <= have:
        last = S.found("PSG_No", r"(\d+)\s*$").cast("long").cast("string")
        made = F.concat(F.lit("001_"), S.valid_date("PSG_Date"), F.lit("_"), last, F.lit("_"), study_type("PSG_Type"))
        rows = rows.withColumn("Database_ID", F.coalesce(made, get("Database_ID")))
    return rows.withColumns({c: F.lit(None).cast("string") for c in ("PSG_Type", "Previous_Data") if c in have})


def one_form(df: DataFrame) -> DataFrame:
    """The earlier rule for forms that ask once or for weekdays and free days: fields vote for a form, and values are copied to it.

    A field with weekday or free values and no single one votes for two, one with a single value only for one; with all three, for two if they differ.
    Two wins with more votes; the other form's columns are then null.
    """
    have = set(df.columns)
    get = lambda c: S.normalise_value(c) if c in have else F.lit(None).cast("string")
    same = lambda c: F.coalesce(whole_number(c).cast("string"), F.lower(c))
    fields = [(f"{b}_{u}", f"{b}_{u}_week", f"{b}_{u}_free") for b in WEEK_BASES for u in ("HH", "MM")]
    votes = F.lit(0)
    for names in fields:
        one, week, free = map(get, names)
        differ = (same(week) != same(free)) | (same(one) != same(week))
        all_three = one.isNotNull() & week.isNotNull() & free.isNotNull()
        two = (week.isNotNull() | free.isNotNull()) & one.isNull()
        single = one.isNotNull() & week.isNull() & free.isNull()
        votes = votes + F.when(two | (all_three & differ), 1).when(single | all_three, -1).otherwise(0)
    rows, new = df.withColumn("__two", votes > 0), {}
    for names in fields:
        one, week, free = map(get, names)
        two = F.col("__two")
        new[names[0]] = F.when(~two, F.coalesce(one, week, free))
        new[names[1]] = F.when(two, F.coalesce(week, one))
        new[names[2]] = F.when(two, F.coalesce(free, one))
    return rows.withColumns(new).drop("__two")


def history_zeros(df: DataFrame) -> DataFrame:
    """The earlier rule for the history: where any item is answered, those that aren't are 0."""
    items = [c for c in df.columns if c.startswith("PHx_")]
    if not items:
        return df
    answered = F.coalesce(*[S.normalise_value(c) for c in items]).isNotNull()
    return df.withColumns({c: F.coalesce(whole_number(F.col(c)).cast("string"), S.normalise_value(c), F.when(answered, F.lit("0"))) for c in items})


def _step_columns(step: int, have: set[str]) -> dict[str, Column]:
    """Columns of one titration step in their normal form; a stage that ends a position moves to the stages."""
    out: dict[str, Column] = {}
    pressure, place, stage = f"Pressure_{step:02d}", f"Pr{step:02d}_position", f"Pr{step:02d}_stage"
    if pressure in have:
        out[pressure] = F.when(whole_number(F.col(pressure)) == step, F.lit(str(step)))
    for c in have:
        if c.startswith(f"Pr{step:02d}_"):
            out[c] = step_value(F.lit(c), F.col(c))
    if {place, stage} <= have:
        p, s = out[place], out[stage]
        tail = F.when(F.element_at(F.split(p, " "), -1).isin(*STAGES) & F.contains(p, F.lit(" ")), F.element_at(F.split(p, " "), -1))
        moved = tail.isNotNull() & s.isNotNull()
        stages = F.filter(F.split(s, ","), lambda x: x != "")
        out[place] = F.when(moved, F.regexp_replace(p, r" \S+$", "")).otherwise(p)
        out[stage] = F.when(moved, F.array_join(F.array_union(stages, F.array(tail)), ",")).otherwise(s)
    return out


def diagnoses(values: Column) -> Column:
    """Different # fragments of an array of texts, in order, joined by a space: whole lines that begin with #, else what follows a # inside."""
    def parts(v: Column) -> Column:
        t = S.normalise_value(v)
        lines = F.filter(F.transform(F.split(t, r"[\r\n]+"), lambda x: F.trim(x)), lambda x: x.startswith("#"))
        inner = F.filter(F.transform(F.regexp_extract_all(t, F.lit(r"(#[^#\n\r]+)"), F.lit(1)), lambda x: F.trim(x)), lambda x: x != "")
        return F.coalesce(F.when(F.size(lines) > 0, lines).otherwise(inner), F.array().cast("array<string>"))

    return F.nullif(F.array_join(F.array_distinct(F.flatten(F.transform(values, parts))), " "), F.lit(""))


