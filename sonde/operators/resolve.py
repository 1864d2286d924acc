"""Facts with several candidate values: merging, votes, evidence, validation, aliases and back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merged(facts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows (*keys, n_values, merged): the value where a key has one only, null and its count where values conflict.

    Distinct values are counted through their least and greatest, so no set is gathered."""
    return facts.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count_distinct(value).alias("n_values"), F.min(value).alias("__min")).select(*keys, "n_values", F.when(F.col("n_values") == 1, F.col("__min")).alias("merged"))


def vote_table(facts: DataFrame, keys: list[str], value: str, certainty: str) -> DataFrame:
    return facts.groupBy(*keys, value).agg(F.count("*").alias("votes"), F.max(certainty).alias("best"), F.avg(certainty).alias("mean"))


def majority(facts: DataFrame, keys: list[str], value: str, certainty: str) -> DataFrame:
    """Rows (*keys, chosen, mode): single value, unique majority, unique best certainty among the tied, else pending."""
    votes = vote_table(facts, keys, value, certainty)
    per = votes.groupBy(*keys).agg(F.count("*").alias("__values"), F.max("votes").alias("__top"))
    tied = votes.join(per, keys).where(F.col("votes") == F.col("__top"))
    tied = tied.groupBy(*keys).agg(F.first("__values").alias("__values"), F.count("*").alias("__tied"), F.max(F.struct("best", value)).alias("__best"), F.max("best").alias("__c"), F.collect_list("best").alias("__all"))
    at_best = F.size(F.filter("__all", lambda b: b == F.col("__c")))
    mode = F.when(F.col("__values") == 1, "single").when(F.col("__tied") == 1, "majority").when((F.col("__c") >= 0) & (at_best == 1), "certainty").otherwise("pending")
    return tied.select(*keys, mode.alias("mode"), F.when(mode != "pending", F.col("__best")[value]).alias("chosen"))


def by_evidence(facts: DataFrame, keys: list[str], value: str, rank: str, quality: str) -> DataFrame:
    """Rows (*keys, chosen, conflict): most frequent, then best source rank, then quality; an exact tie is a conflict."""
    seen = facts.groupBy(*keys, value).agg(F.count("*").alias("__n"), F.min(F.struct(F.col(rank).alias("r"), (-F.col(quality)).alias("q"))).alias("__s"))
    place = F.struct((-F.col("__n")).alias("n"), F.col("__s.r").alias("r"), F.col("__s.q").alias("q"))
    first = Window.partitionBy(*keys)
    rows = seen.withColumn("__p", place).withColumn("__b", F.min("__p").over(first)).where("__p = __b")
    return rows.groupBy(*keys).agg(F.min(value).alias("__v"), F.count("*").alias("__k")).select(*keys, F.when(F.col("__k") == 1, F.col("__v")).alias("chosen"), (F.col("__k") > 1).alias("conflict"))


def most_common(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Rows (key, mode): the most frequent value, the first seen of equals."""
    n = df.groupBy(key, value).agg(F.count("*").alias("__n"), F.min(F.struct(*order)).alias("__first"))
    return n.groupBy(key).agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__first").alias("f"), F.col(value).alias("v"))).alias("m")).select(key, F.col("m.v").alias("mode"))


def best_attempt(df: DataFrame, key: str, score: Column, order: list[str], *cols: str) -> DataFrame:
    """One row a key: the highest score, the earliest of equals."""
    return df.groupBy(key).agg(F.min(F.struct((-score).alias("s"), *order, *[F.col(c).alias(f"__{c}") for c in cols])).alias("m")).select(key, *[F.col(f"m.__{c}").alias(c) for c in cols])


def validated(facts: DataFrame, rules: dict[str, tuple[float, float]], choices: dict[str, list[str]], key: str, value: str) -> DataFrame:
    """`facts` with reason: null where valid, else the first of unknown_key, empty, not_numeric, out_of_range, invalid_choice."""
    known = F.col(key).isin(*rules, *choices)
    number = F.col(value).try_cast("double")
    lo = F.create_map(*[x for k, (a, _) in rules.items() for x in (F.lit(k), F.lit(float(a)))])[F.col(key)]
    hi = F.create_map(*[x for k, (_, b) in rules.items() for x in (F.lit(k), F.lit(float(b)))])[F.col(key)]
    allowed = None
    for k, own in choices.items():
        hit = (F.col(key) == k) & ~F.col(value).isin(*own)
        allowed = hit if allowed is None else allowed | hit
    reason = F.when(~known, "unknown_key").when(F.coalesce(F.trim(value), F.lit("")) == "", "empty")
    reason = reason.when(lo.isNotNull() & number.isNull(), "not_numeric").when(lo.isNotNull() & ((number < lo) | (number > hi)), "out_of_range")
    return facts.withColumn("reason", reason.when(allowed, "invalid_choice") if allowed is not None else reason)


def aliased(df: DataFrame, col: str, aliases: dict[str, str], out: str, default: str | None = None) -> DataFrame:
    """A lookup table of fixed size as a map; what it doesn't know passes through, or takes the default."""
    found = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])[F.lower(F.trim(col))]
    return df.withColumn(out, F.coalesce(found, F.col(col) if default is None else F.lit(default)))


def back_filled(present: Column, *others: Column) -> Column:
    return F.coalesce(present, *others)


def wide(facts: DataFrame, entity: str, key: str, value: str, columns: list[str]) -> DataFrame:
    """One row an entity with a fixed list of columns; keys outside the list are dropped."""
    return facts.where(F.col(key).isin(*columns)).groupBy(entity).pivot(key, columns).agg(F.first(value, ignorenulls=True))


def first_seen(facts: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Rows (*keys, chosen, conflict): the earlier rule of merging, the first value that isn't null; whether others differ."""
    rows = facts.where(F.col(value).isNotNull())
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, value)).alias("__m"), F.count_distinct(value).alias("__n")).select(*keys, F.col("__m")[value].alias("chosen"), (F.col("__n") > 1).alias("conflict"))


def most_seen(facts: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """Rows (*keys, chosen, conflict): the patient-level rule of merging, the most frequent value, of equals the first seen."""
    seen = facts.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"), F.min(F.struct(*order)).alias("__f"))
    place = F.struct((-F.col("__n")).alias("n"), F.col("__f").alias("f"), F.col(value).alias("v"))
    return seen.groupBy(*keys).agg(F.min(place).alias("__m"), F.count("*").alias("__k")).select(*keys, F.col("__m.v").alias("chosen"), (F.col("__k") > 1).alias("conflict"))
