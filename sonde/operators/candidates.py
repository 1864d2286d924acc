"""Which keys of a dictionary a page may fill: by route, category, document label, trigger words, pressure steps and likeness of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.functions import scalars as S
from sonde.operators import nearest, routing
from sonde.operators.routing import holds

# Keys that always take part.
CORE = ("Hospital_ID", "Name", "Lab_ID", "Device_Type", "PSG_Date", "PSG_No", "PSG_Type", "Database_ID", "Previous_Data", "SEX", "AGE", "Height_cm", "Weight_kg", "BMI", "Neckcir_cm", "Occupation", "Shiftwork")
# Labels of documents, each the prefixes and patterns of its keys.
LABELS = {
    "psg_report": (("TST", "SL", "REM", "N1", "N2", "N3", "WASO", "AI", "HI", "AHI", "RDI", "Arousal", "Lowest", "PLM", "LM"), ("^PSG_(?!M_)", "^Sleep_Eff$", "^Diagnosis_etc$")),
    "cpap_pressure": ((), (r"^Pressure_\d{2}$", r"^Pr\d{2}_")), "psg_morning": ((), ("^PSG_M_",)), "psqi": (("PSQI",), ()), "ess": (("ESS",), ()), "fss": (("FSS",), ()), "bq": (("BQ",), ()), "isi": (("ISI",), ()),
    "rls_irls": (("RLS", "IRLS"), ()), "rbd_rbdsq": (("RBD", "RBDSQ"), ()), "mood": (("BDI", "PHQ"), ()), "qol": (("QOL",), ()), "sleep_history": (("Habit", "PHx", "Occupation", "Shiftwork", "SSS", "SQ", "Nap", "N"), ()),
}
# Labels a route may fill.
ROUTE_LABELS = {
    routing.SIGNALS: (), routing.REPORT: ("psg_report",), routing.REPORT_LONG: ("psg_report",), routing.PRESSURE: ("psg_report", "cpap_pressure"), routing.PRESSURE_LONG: ("psg_report", "cpap_pressure"),
    routing.MORNING: ("psg_morning",), routing.NIGHT: ("psqi", "ess", "fss", "bq", "isi", "rls_irls", "rbd_rbdsq", "mood", "qol", "sleep_history"),
}
ASKED = (routing.MORNING, routing.NIGHT)
# Words in a text that call for keys of these prefixes.
TRIGGERS = (
    (r"\bpsqi\b|pittsburgh sleep quality index", ("PSQI",)), (r"\bess\b|epworth sleepiness", ("ESS",)), (r"\bfss\b|fatigue severity", ("FSS",)), (r"\bbq\b|berlin questionnaire", ("BQ",)), (r"stop[- ]?bang|stop questionnaire", ("STOP", "STOPBANG")),
    (r"\bisi\b|insomnia severity", ("ISI",)), (r"\brls\b|restless legs", ("RLS", "IRLS")), (r"\birls\b|international restless", ("IRLS", "RLS")), (r"\brbd\b|rbdsq|rem sleep behavior", ("RBDSQ", "RBD")), (r"\bphq\b|patient health questionnaire", ("PHQ",)),
    (r"\bbdi\b|beck depression", ("BDI",)), ("whoqol|quality of life", ("WHOQOL", "QOL")), (r"\bmslt\b|multiple sleep latency", ("MSLT",)), (r"\bnap\b|sleep attack", ("Nap", "N")),
)
MEASURED = "polysomnography|sleep architecture|respiratory event|rdi|ahi|arousal index|total sleep time|sleep latency|rem latency|snoring|stage n1|stage n2|stage n3|sleep efficiency|lowest sao2"
MEASURES = r"^(?:TST_min|SL_min|REM_SL_min|Sleep_Eff|Arousal_(?:no|idx|resp_idx|snoring_idx|PLM_idx|spont_idx|PLM_no|PLM_idx_re|LM_no|LM_idx)|REM_pct|N1_pct|N2_pct|N3_pct|WASO_pct|AI(?:_|$)|HI(?:_|$)|AHI_|RDI_|Lowest_SpO2|REM_(?:sup|lat)_min|NREM_(?:sup|lat)_min|PLM_idx|LM_idx|Pressure_\d{2}|Pr\d{2}_)"
# Categories that share the common report keys.
SHARED = {"psg": "common_psg", "cpap": "common_psg"}
GRAMS, CLIP = (2, 5), 8000


def prefix(key: str | Column) -> Column:
    return F.substring_index(S.col(key), "_", 1)


def labelled(dictionary: DataFrame) -> DataFrame:
    """Rows (label, key, position): every document label with its keys."""
    hit = {name: (prefix("key").isin(*own) if own else F.lit(False)) | (F.col("key").rlike("|".join(patterns)) if patterns else F.lit(False)) for name, (own, patterns) in LABELS.items()}
    return dictionary.select("key", "position", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in hit.items()]))).alias("label"))


def by_route(dictionary: DataFrame, pages: DataFrame, keys: list[str], route: str, official: str) -> DataFrame:
    """Rows (keys, key): core keys and those of the route's labels; of questionnaires only of type A where official, B where not, all where unknown.

    `dictionary` has key, position and type; it is a table of fixed size, as is the bridge of routes and labels.
    """
    spark = dictionary.sparkSession
    bridge = spark.createDataFrame([(r, n) for r, names in ROUTE_LABELS.items() for n in names], "__route string, label string")
    own = labelled(dictionary).join(bridge, "label").select("__route", "key").distinct()
    core = dictionary.where(F.col("key").isin(*CORE)).select("key").join(bridge.select("__route").distinct().unionByName(spark.createDataFrame([(routing.SIGNALS,)], "__route string")))
    named = own.unionByName(core.select("__route", "key")).distinct().join(dictionary.select("key", F.upper(F.coalesce("type", F.lit("B"))).alias("__type")), "key")
    wanted = F.when(F.col(official), "A").when(~F.col(official), "B")
    rows = pages.join(named, F.col(route) == F.col("__route"))
    return rows.where(~F.col(route).isin(*ASKED) | wanted.isNull() | (F.col("__type") == wanted)).select(*keys, "key")


def by_category(dictionary: DataFrame, category: str) -> DataFrame:
    """The dictionary's rows of a category, with the common report keys where it shares them; those of the basic one where it has none."""
    of = F.col("category").isin(category, *([SHARED[category]] if category in SHARED else []))
    any_own = F.max(of).over(Window.partitionBy())
    return dictionary.withColumns({"__of": of, "__any": any_own}).where("__of or (not __any and category = 'basic')").drop("__of", "__any")


def for_steps(dictionary: DataFrame, steps: str | Column) -> Column:
    """Whether a dictionary row takes part on a page with these allowed pressure steps: keys of other steps don't."""
    step = F.coalesce(S.found("key", r"^Pressure_(\d{2})$"), S.found("key", r"^Pr(\d{2})_")).cast("int")
    return F.col("category").isin("common_psg", "cpap") & (step.isNull() | F.array_contains(S.col(steps), step))


def grams(text: str | Column) -> Column:
    """Strings of GRAMS characters within each word, a space on either side, lower case; as often as they occur."""
    lo, hi = GRAMS
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def of(word: Column) -> Column:
        w = F.concat(F.lit(" "), word, F.lit(" "))
        def cut(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(w) - n + 1))
            return F.when(F.length(w) >= n, F.transform(starts, lambda i: F.substring(w, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

        return F.flatten(F.array(*[cut(n) for n in range(lo, hi + 1)]))

    return F.flatten(F.transform(words, of))


def alike(queries: DataFrame, query: str, query_text: str, rows: DataFrame, row: str, row_text: str, k: int, places: int = 9) -> DataFrame:
    """Rows (query, row, rank, score): for each query the k rows most alike by cosine of TF-IDF over `grams`, later rows first among equals."""
    return nearest.alike(queries, query, query_text, rows, row, row_text, k, places, grams, GRAMS)


def selected(pages: DataFrame, page: str, text: str, dictionary: DataFrame, k: int) -> DataFrame:
    """Rows (page, key, score, place): core keys, keys of the words a page triggers, report measures on report-like pages, then the k most alike; each key once.

    `dictionary` has key, position and description; likeness is to key and description, of the first CLIP characters of a page. place orders
    a page's keys: core keys as listed, then by trigger, prefix of the trigger and position, then measures by position, then by rank.
    """
    none = F.array().cast("array<struct<prefix:string,t:int>>")
    called = [(p, [(prefix, 10 * i + j) for j, prefix in enumerate(own)]) for i, (p, own) in enumerate(TRIGGERS)]
    calls = F.flatten(F.array(*[F.when(holds(text, p), F.array(*[F.struct(F.lit(x).alias("prefix"), F.lit(t).alias("t")) for x, t in own])).otherwise(none) for p, own in called]))
    marked = pages.select(page, calls.alias("__c"), holds(text, MEASURED).alias("__m"))
    d = dictionary.select("key", F.col("position").cast("int").alias("position"))
    core = F.create_map(*[F.lit(x) for i, key in enumerate(CORE) for x in (key, i)])
    place = lambda s, p, q: F.struct(F.lit(s).alias("s"), p.alias("p"), q.alias("q"))
    zero = F.lit(0)
    by_core = marked.select(page, F.explode(F.array(*map(F.lit, CORE))).alias("key")).join(d, "key").select(page, "key", place(0, core[F.col("key")], zero).alias("place"))
    by_call = marked.select(page, F.inline("__c")).join(d.select("key", "position", prefix("key").alias("prefix")), "prefix").select(page, "key", place(1, F.col("t"), F.col("position")).alias("place"))
    measures = d.where(F.col("key").rlike(f"(?i){MEASURES}")).select("key", "position", F.lit(True).alias("__m"))
    by_measure = marked.where("__m").join(measures, "__m").select(page, "key", place(2, F.col("position"), zero).alias("place"))
    forced = by_core.unionByName(by_call).unionByName(by_measure).withColumn("score", F.lit(1.0))
    about = dictionary.select("position", F.concat_ws(" ", "key", "description").alias("__d"))
    near = alike(pages.select(page, F.substring(text, 1, CLIP).alias("__q")), page, "__q", about, "position", "__d", k).join(dictionary.select("key", "position"), "position")
    found = forced.unionByName(near.select(page, "key", place(3, F.col("rank").cast("int"), zero).alias("place"), "score"))
    return found.groupBy(page, "key").agg(F.min(F.struct("place", "score")).alias("m")).select(page, "key", F.col("m.score").alias("score"), F.col("m.place").alias("place"))


def within(rows: DataFrame, keys: list[str], order: list[str], block: Column, most: int) -> DataFrame:
    """The rows, in order, whose blocks of text together stay within `most` characters; nothing after the first that doesn't."""
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("block", block).withColumn("__sum", F.sum(F.length("block")).over(upto)).where(F.col("__sum") <= most).drop("__sum")


def described(compact: bool = False) -> Column:
    """The block of text that shows a dictionary row (key, description, category, format, options) to a model."""
    codes = F.array_sort(F.transform(F.map_entries("options"), lambda e: F.struct(e["key"].cast("int").alias("n"), e["value"].alias("v"))))
    options = F.array_join(F.transform(codes, lambda e: F.concat(e["n"].cast("string"), F.lit("="), e["v"])), ", ")
    d, f, o = (80, 40, 180) if compact else (220, 80, 260)
    parts = [("desc", S.ellipsize("description", d)), ("category", F.col("category")), ("format", S.ellipsize("format", f)), ("options", S.ellipsize(options, o))]
    start, between, end = ("", " | ", "") if compact else ("\n  ", "\n  ", "")
    said = F.concat_ws(between, *[F.concat(F.lit(f"{n}{'=' if compact else ': '}"), F.coalesce(c, F.lit(""))) for n, c in parts])
    return F.concat(F.lit("- "), F.col("key"), F.lit(" | " if compact else start), said, F.lit(end + "\n"))
