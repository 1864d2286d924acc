"""Runs against references and each other: accuracy by stage and bucket, causes of mismatches, page evidence, reviews, states and plans.

Facts of a run are (entity, field, value); provenance is (entity, field, image, value, certainty, at) with `at` the order of the entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.functions import scalars as S
from sonde.operators import evaluate, matching, routing
from sonde.operators.routing import ordered

# Fields and categories that the causes of mismatches name.
UNFILLED, BERLIN, WEEKS = "Database_ID", "BQ_", "PSQI_"
LATENCY = ("PSQI_02_Latency_HH", "PSQI_02_Latency_MM")
TABLE_GAPS = ("NREM_sup_min", "NREM_lat_min", "Arousal_PLM_no", "Arousal_LM_no")
MINOR_TEXTS, ALIKE = ("Diagnosis_etc", "PSG_M_05_Complaint"), 0.93
LOOSE = r"[\s#.,:;()/%\-\[\]<>`'\"]+"
MISREAD = ("Neckcir_cm", "BMI")
# Buckets of routes, and the order in which a field without a source takes one.
BUCKETS = {
    routing.SIGNALS: "psg_signal", routing.REPORT: "psg_report_general", routing.REPORT_LONG: "psg_report_extensive", routing.PRESSURE: "cpap_psg_report_general", routing.PRESSURE_LONG: "cpap_psg_report_extensive",
    routing.MORNING: "morning_questionnaire", routing.NIGHT: "night_questionnaire_type_b",
}
OFFICIAL_NIGHT = "night_questionnaire_type_a"
DOMINANT = (routing.PRESSURE_LONG, routing.PRESSURE, routing.REPORT_LONG, routing.REPORT, routing.MORNING, routing.NIGHT, routing.SIGNALS)
# Marks of what a request is for, of fatal errors, of spent quotas.
REQUESTS = (("strict json repair assistant|fix into a valid json object only", "json_fix"), ("resolve one conflict candidate set|conflict candidates json", "conflict"), (r"existing json \(do not repeat these keys\)", "map_recall"), ("candidate cdm fields", "map"))
FATAL = r"missing api key|invalid_api_key|(?s:(?=.*status=401)(?=.*openai))"
QUOTA = "insufficient_quota"
BEST_CERTAINTY, REVIEWED = 8.0, 20


def bucket(route: str | Column, official: str | Column) -> Column:
    r = S.col(route)
    return F.when((r == routing.NIGHT) & F.coalesce(S.col(official), F.lit(False)), OFFICIAL_NIGHT).otherwise(F.create_map(*[F.lit(x) for kv in BUCKETS.items() for x in kv])[r])


def loosely_equal(field: str, a: str, b: str) -> Column:
    """Whether two texts differ in case, space and marks only, or, for the free texts, hardly; only texts that can be that similar are compared."""
    loose = lambda c: F.regexp_replace(F.lower(S.collapse_spaces(c)), LOOSE, "")
    free = F.col(field).isin(*MINOR_TEXTS) & (loose(a) != loose(b))
    one, two = (F.when(free, S.collapse_spaces(c)) for c in (a, b))
    return (loose(a) == loose(b)) | F.coalesce(matching.similarity(one, two, ALIKE) >= ALIKE, F.lit(False))


def compared(run: DataFrame, truth: DataFrame, conflicts: DataFrame | None = None) -> DataFrame:
    """Rows (entity, field, value, truth, match, in_conflict): every field either side has; blank equals blank, numbers by value."""
    both = run.select("entity", "field", F.col("value").alias("value")).join(truth.select("entity", "field", F.col("value").alias("truth")), ["entity", "field"], "full_outer")
    rows = both.withColumn("match", S.canonical_value("value").eqNullSafe(S.canonical_value("truth")))
    if conflicts is None:
        return rows.withColumn("in_conflict", F.lit(False))
    return rows.join(conflicts.select("entity", "field").distinct().withColumn("__c", F.lit(True)), ["entity", "field"], "left").withColumn("in_conflict", F.coalesce("__c", F.lit(False))).drop("__c")


def accuracy(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by, total, correct, accuracy, with_conflicts, accuracy_with_conflicts) of `compared`: the second credits mismatches that were in conflict."""
    credited = F.col("match") | F.col("in_conflict")
    n = rows.groupBy(*by).agg(F.count("*").alias("total"), F.count_if("match").alias("correct"), F.count_if(credited).alias("with_conflicts"))
    return n.withColumns({"accuracy": F.try_divide("correct", "total"), "accuracy_with_conflicts": F.try_divide("with_conflicts", "total")})


def stage_results(rows: DataFrame, stages: DataFrame) -> DataFrame:
    """Rows (entity, stage, place, total, ..., passed, passed_with_conflicts) over cumulative stages.

    `rows` has `compared` with category, `stages` (stage, place, category, least, least_with_conflicts), a table of fixed size: a stage counts its
    own categories and those of all before, each field once.
    """
    first = rows.join(F.broadcast(stages.select("category", "place").distinct()), "category").groupBy("entity", "field", "match", "in_conflict").agg(F.min("place").alias("__p"))
    named = stages.select("stage", "place", "least", "least_with_conflicts").distinct()
    reach = first.join(F.broadcast(named), F.col("__p") <= F.col("place"))
    out = accuracy(reach, ["entity", "stage", "place", "least", "least_with_conflicts"])
    return out.withColumns({"passed": F.col("accuracy") >= F.col("least"), "passed_with_conflicts": F.col("accuracy_with_conflicts") >= F.col("least_with_conflicts")})


def highest_passed(results: DataFrame) -> DataFrame:
    """Rows (entity, stage): the last stage up to which all are passed, null if the first isn't."""
    w = Window.partitionBy("entity").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = results.withColumn("__ok", F.min(F.col("passed")).over(w))
    return rows.groupBy("entity").agg(F.max_by(F.when(F.col("__ok"), F.col("stage")), F.when(F.col("__ok"), F.col("place"))).alias("stage"))


def sources(provenance: DataFrame, resolution: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows (entity, field, bucket): where a field came from, its resolution's page, else the bucket most of its entries come from, the first of equals.

    `resolution` is (entity, field, image), `pages` (entity, image, route, official).
    """
    of = pages.select("entity", "image", bucket("route", "official").alias("bucket")).where("bucket is not null")
    named = resolution.join(of, ["entity", "image"]).select("entity", "field", F.col("bucket").alias("__r"))
    counts = provenance.join(of, ["entity", "image"]).groupBy("entity", "field", "bucket").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    mode = counts.groupBy("entity", "field").agg(F.min(F.struct((-F.col("n")).alias("n"), "first", "bucket")).alias("m"))
    return mode.join(named, ["entity", "field"], "full_outer").select("entity", "field", F.coalesce("__r", "m.bucket").alias("bucket"))


def bucketed(fields: DataFrame, found: DataFrame, memberships: DataFrame, pages: DataFrame) -> DataFrame:
    """`fields` (entity, field) with bucket: from `sources`, else by which routes may fill the field and which routes the entity has.

    `memberships` is (field, bucket), a table of fixed size.
    """
    routes = pages.groupBy("entity").agg(F.collect_set("route").alias("__routes"))  # at most seven
    own = memberships.groupBy("field").agg(F.collect_set("bucket").alias("__own"))
    rows = fields.join(found, ["entity", "field"], "left").join(F.broadcast(own), "field", "left").join(routes, "entity", "left")
    may = lambda *names: F.arrays_overlap(F.coalesce("__own", F.array().cast("array<string>")), F.array(*map(F.lit, names)))
    has = lambda *names: F.arrays_overlap(F.coalesce("__routes", F.array().cast("array<string>")), F.array(*map(F.lit, names)))
    night, report, long, press, press_long = BUCKETS[routing.NIGHT], BUCKETS[routing.REPORT], BUCKETS[routing.REPORT_LONG], BUCKETS[routing.PRESSURE], BUCKETS[routing.PRESSURE_LONG]
    pressure = F.when(has(routing.PRESSURE_LONG), press_long).otherwise(press)
    any_report = ordered([(has(routing.PRESSURE, routing.PRESSURE_LONG) & ~has(routing.REPORT, routing.REPORT_LONG), pressure), (has(routing.REPORT_LONG), long), (has(routing.REPORT), report), (has(routing.PRESSURE_LONG), press_long), (has(routing.PRESSURE), press)], None)
    guess = F.coalesce(ordered([
        (may(OFFICIAL_NIGHT), OFFICIAL_NIGHT), (may(night), night), (may(BUCKETS[routing.MORNING]), BUCKETS[routing.MORNING]), (may(press_long) & ~may(long), pressure), (may(long, report), any_report), (may(BUCKETS[routing.SIGNALS]), BUCKETS[routing.SIGNALS]),
    ], None), ordered([(has(r), BUCKETS[r]) for r in DOMINANT], night))
    return rows.select("entity", "field", F.coalesce("bucket", guess).alias("bucket"))


def texts_compared(a: DataFrame, b: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Rows (*keys, status, similarity, chars_a, chars_b): identical, different, or missing_in_one_side; only texts that differ are compared, identical ones have similarity 1."""
    left, right = a.select(*keys, F.col(text).alias("__a")), b.select(*keys, F.col(text).alias("__b"))
    rows = left.where(F.col("__a").isNotNull()).join(right.where(F.col("__b").isNotNull()), keys, "full_outer")
    status = F.when(F.col("__a").isNull() | F.col("__b").isNull(), "missing_in_one_side").when(F.col("__a") == F.col("__b"), "identical").otherwise("different")
    rows = rows.withColumn("status", status)
    differ = F.col("status") == "different"
    alike = F.when(F.col("status") == "identical", 1.0).otherwise(matching.similarity(F.when(differ, F.col("__a")), F.when(differ, F.col("__b"))))
    return rows.select(*keys, "status", alike.alias("similarity"), F.length("__a").alias("chars_a"), F.length("__b").alias("chars_b"))


def texts_agreement(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of `texts_compared` rows: texts on either side, compared, identical, changed (different or missing) and the mean similarity."""
    return rows.groupBy(*(by or [])).agg(
        F.count("chars_a").alias("files_a"), F.count("chars_b").alias("files_b"), F.count_if(F.col("status") != "missing_in_one_side").alias("compared"),
        F.count_if(F.col("status") == "identical").alias("identical"), F.count_if(F.col("status") != "identical").alias("changed"), F.avg("similarity").alias("mean_similarity"),
    )


def page_evidence(run: DataFrame, other: DataFrame) -> DataFrame:
    """Rows (entity, page, run_chars, other_chars, similarity, run_route, other_route, run_keys, other_keys) of pages (entity, page, text, route, n_keys) of either run."""
    side = lambda df, p: df.select("entity", "page", F.col("text").alias(f"__{p}"), F.length("text").alias(f"{p}_chars"), F.col("route").alias(f"{p}_route"), F.col("n_keys").alias(f"{p}_keys"))
    rows = side(run, "run").join(side(other, "other"), ["entity", "page"], "full_outer")
    alike = F.when((F.length("__run") > 0) & (F.length("__other") > 0), F.round(matching.similarity("__run", "__other"), 4))
    return rows.withColumn("similarity", alike).fillna(0, ["run_chars", "other_chars"]).drop("__run", "__other")


def causes(mismatches: DataFrame) -> DataFrame:
    """`mismatches` with stage and cause: the first rule that fits.

    They have field, value, truth, other (the other run's value), entries (how many the run has), resolved, in_conflict, candidate (whether an entry
    has the true value), and of their pages: low_chars and unlike (text much shorter, or similarity under 0.6 or 0.8: unlike6, unlike8), fewer_keys, rerouted.
    """
    v, t, o = (F.trim(F.coalesce(c, F.lit(""))) for c in ("value", "truth", "other"))
    field, blank, other_right = F.col("field"), v == "", o == t
    settled = F.col("resolved") | (F.col("entries") > 1) | F.col("in_conflict")
    lost = F.col("low_chars") | F.col("unlike6")
    rules = [
        (field == UNFILLED, "output", "metadata_assembly_gap"), (loosely_equal("field", "value", "truth"), "output", "formatting_or_minor_text_normalization"), ((field == "N_Sleepattack") & (v == "0") & (t == ""), "map", "placeholder_overinterpreted_as_zero"),
        (field.startswith(BERLIN), "ocr", "checkbox_alignment_error"), (field.isin(*TABLE_GAPS) & blank, "map", "table_subfield_omission"), (field.startswith(WEEKS) & blank & other_right, "map", "questionnaire_split_omission"),
        (field.isin(*LATENCY) & other_right, "map", "time_field_split_error"), (settled & F.col("candidate"), "resolve", "wrong_conflict_resolution"), (settled, "resolve", "document_conflict_chosen_differently"),
        (blank & other_right & F.col("fewer_keys"), "map", "map_omission"), (blank & other_right & lost, "ocr", "upstream_ocr_loss"), (blank & other_right & F.col("rerouted"), "route", "route_scope_loss"), (blank & other_right, "map", "map_omission"),
        (other_right & (field == "PSG_M_04_WakeNo"), "ocr", "numeric_ocr_error"), (other_right & field.isin(*MISREAD) & F.col("unlike8"), "ocr", "numeric_ocr_error"), (other_right, "map", "extraction_or_parsing_error"),
    ]
    kind = F.coalesce(*[F.when(c, F.struct(F.lit(s).alias("stage"), F.lit(n).alias("cause"))) for c, s, n in rules], F.struct(F.lit("map").alias("stage"), F.lit("extraction_gap").alias("cause")))
    return mismatches.withColumn("__k", kind).withColumns({"stage": F.col("__k.stage"), "cause": F.col("__k.cause")}).drop("__k")


def certainty(c: str | Column) -> Column:
    """A score from 0 to 8, null for anything else."""
    x = S.strict_number(S.col(c).cast("string"))
    return F.when(x.between(0, BEST_CERTAINTY), x)


def uncertain(row: DataFrame, provenance: DataFrame, most: int = REVIEWED) -> DataFrame:
    """Rows (entity, field, value, least, best, images): final values by their least certain matching entry, the `most` first of an entity, and of these those under the best certainty."""
    same = provenance.withColumn("__s", certainty("certainty")).withColumn("__v", S.canonical_value("value"))
    rows = row.where(S.normalise_value("value").isNotNull()).withColumn("__v", S.canonical_value("value")).join(same.select("entity", "field", "__v", "__s", "image", "at"), ["entity", "field", "__v"])
    images = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("at", "image"))), lambda x: x["image"]))
    found = rows.groupBy("entity", "field", "value").agg(F.min("__s").alias("least"), F.max("__s").alias("best"), images.alias("images")).where("least is not null")
    rank = F.row_number().over(Window.partitionBy("entity").orderBy("least", F.lower("field"), "field"))
    return found.withColumn("__n", rank).where((F.col("__n") <= most) & (F.col("least") < BEST_CERTAINTY)).drop("__n")


def value_order(c: str | Column) -> Column:
    """A sort key: numbers by value, then texts, then nulls."""
    v = S.normalise_value(c)
    x = S.strict_number(v)
    return F.struct(F.when(v.isNull(), 2).when(x.isNotNull(), 0).otherwise(1).alias("kind"), x.alias("number"), v.alias("text"))


def conflict_review(conflicts: DataFrame, resolution: DataFrame) -> DataFrame:
    """Rows (entity, field, value, n, images, best, mean, chosen, mode): the candidates of each conflict, most frequent first, with what was chosen."""
    images = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("at", "image"))), lambda x: x["image"]))
    seen = conflicts.withColumn("__s", certainty("certainty")).groupBy("entity", "field", "value").agg(F.count("*").alias("n"), images.alias("images"), F.max("__s").alias("best"), F.avg("__s").alias("mean"))
    rows = seen.join(resolution.select("entity", "field", F.col("value").alias("chosen"), "mode"), ["entity", "field"], "left")
    place = F.row_number().over(Window.partitionBy("entity", "field").orderBy(F.desc("n"), F.desc_nulls_last("best"), value_order("value")))
    return rows.withColumn("place", place)


def request_kind(text: str | Column, images: str | Column) -> Column:
    """What a request is for: ocr with images, else by its words."""
    low = F.lower(S.col(text))
    return ordered([(S.col(images) > 0, "ocr"), *[(F.coalesce(low.rlike(p), F.lit(False)), n) for p, n in REQUESTS]], "other")


def prompt_tokens(chars: str | Column, images: str | Column) -> Column:
    """A quarter of the characters, and 768 for each image."""
    return (F.ceil(S.col(chars) / 4) + 768 * S.col(images)).cast("long")


def fatal(errors: DataFrame, entity: str, order: list[str], message: str) -> DataFrame:
    """Rows (entity, message): the first error of each entity that no retry mends."""
    return errors.where(F.lower(message).rlike(FATAL)).groupBy(entity).agg(F.min_by(message, F.struct(*order)).alias(message))


def status(has_summary: str | Column, log: str | Column) -> Column:
    """COMPLETE with a summary, RUN_INCOMPLETE with a log only (_QUOTA if a quota was spent), else MISSING."""
    return ordered([(F.coalesce(S.col(has_summary), F.lit(False)), "COMPLETE"), (F.contains(S.col(log), F.lit(QUOTA)), "RUN_INCOMPLETE_QUOTA"), (S.col(log).isNotNull(), "RUN_INCOMPLETE")], "MISSING")


def open_entities(all_of: DataFrame, summaries: DataFrame, entity: str = "entity", with_map: bool = True) -> DataFrame:
    """Entities still to do: no summary with pages read, and mapped if asked for."""
    done = summaries.where((F.col("ocr_ok") > 0) & ((F.col("map_ok") > 0) | F.lit(not with_map)))
    return all_of.join(done.select(entity), entity, "left_anti")


def batch_summary(runs: DataFrame) -> DataFrame:
    """One row: entities, pages and seconds in sum, means over those that have them."""
    return runs.agg(F.count("*").alias("entities"), F.sum("images_total").alias("pages"), F.sum("total_elapsed_seconds").alias("seconds"), F.avg("accuracy").alias("accuracy"), F.avg("f1").alias("f1"), F.sum("total_tokens").alias("tokens"))


def group_totals(rows: DataFrame, by: str, sums: list[str]) -> DataFrame:
    """Sums by group with a row of grand totals, whose group is null."""
    return rows.rollup(by).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums])
