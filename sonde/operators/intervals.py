"""Algebra of inclusive integer ranges, partitioned by entity: coalesce, subtract, cover, as-of and activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normalise(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """Reversed ranges are swapped, ranges not above 0 and incomplete ones go."""
    whole = df.where(F.col(lo).isNotNull() & F.col(hi).isNotNull())
    return whole.withColumns({lo: F.least(lo, hi), hi: F.greatest(lo, hi)}).where(F.col(lo) > 0)


def coalesce_ranges(df: DataFrame, keys: list[str], lo: str, hi: str, gap: int = 1) -> DataFrame:
    """Rows (*keys, lo, hi): overlapping ranges and those at most `gap` apart joined. One shuffle on the keys."""
    w = Window.partitionBy(*keys).orderBy(lo, hi)
    end = F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col(lo) <= end + gap, 0).otherwise(1)).over(w)
    return df.select(*keys, lo, hi, island.alias("__island")).groupBy(*keys, "__island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi)).drop("__island")


def subtract_ranges(df: DataFrame, minus: DataFrame, keys: list[str], lo: str, hi: str) -> DataFrame:
    """What of `df` no range of `minus` covers, as maximal ranges; by edges, not by expanding to points.

    At each edge the coverage of either side changes; running sums over the edges of a key tell which stretches
    are covered by the left side only.
    """
    def edges(rows: DataFrame, a: int, b: int) -> DataFrame:
        both = F.array(F.struct(F.col(lo).alias("at"), F.lit(a).alias("a"), F.lit(b).alias("b")), F.struct((F.col(hi) + 1).alias("at"), F.lit(-a).alias("a"), F.lit(-b).alias("b")))
        return rows.select(*keys, F.inline(both))

    points = edges(df, 1, 0).unionByName(edges(minus, 0, 1)).groupBy(*keys, "at").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    w = Window.partitionBy(*keys).orderBy("at")
    runs = points.select(*keys, "at", F.lead("at").over(w).alias("__next"), F.sum("a").over(w).alias("__a"), F.sum("b").over(w).alias("__b"))
    left = runs.where("__a > 0 and __b = 0 and __next is not null").select(*keys, F.col("at").alias(lo), (F.col("__next") - 1).alias(hi))
    return coalesce_ranges(left, keys, lo, hi)


def marked(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, lo: str, hi: str, name: str) -> DataFrame:
    """`points` with `name`: whether a range holds the point. The furthest end of the ranges that start at or before it decides."""
    marks = points.withColumn("__hi", F.lit(None).cast("long")).withColumn("__kind", F.lit(1))
    starts = ranges.select(*keys, F.col(lo).alias(at), F.col(hi).cast("long").alias("__hi"), F.lit(0).alias("__kind"))
    w = Window.partitionBy(*keys).orderBy(at, "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = marks.unionByName(starts, allowMissingColumns=True).withColumn(name, F.coalesce(F.max("__hi").over(w) >= F.col(at), F.lit(False)))
    return both.where("__kind = 1").drop("__hi", "__kind")


def uncovered(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, lo: str, hi: str) -> DataFrame:
    """The rows of `points` that no range covers."""
    return marked(points, ranges, keys, at, lo, hi, "__in").where("not `__in`").drop("__in")


def islands(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Rows (*keys, start, end): runs of consecutive numbers."""
    w = Window.partitionBy(*keys).orderBy(at)
    return df.select(*keys, at, (F.col(at) - F.row_number().over(w)).alias("__run")).groupBy(*keys, "__run").agg(F.min(at).alias("start"), F.max(at).alias("end")).drop("__run")


def active(points: DataFrame, spans: DataFrame, key: str, at: str, lo: str, hi: str, cell: int) -> DataFrame:
    """`points` with active 0/1: whether a span [lo, hi) of the key holds the point.

    Points and the spans that touch it are dealt by stretches of `cell`, so a frequent key is many tasks; in one shuffle, the furthest end of the
    spans that began at or before a point decides.
    """
    n = F.floor(F.col(lo) / cell), F.floor((F.col(hi) - 1) / cell)
    starts = spans.where((F.col(hi) > F.col(lo)) & F.col(key).isNotNull()).select(key, F.col(lo).alias("__lo"), F.col(hi).alias("__hi"), F.explode(F.sequence(*n)).alias("__cell"))
    starts = starts.select(key, F.greatest("__lo", F.col("__cell") * cell).alias(at), "__hi", "__cell", F.lit(0).alias("__kind"))
    both = points.withColumns({"__cell": F.floor(F.col(at) / cell), "__kind": F.lit(1)}).unionByName(starts, allowMissingColumns=True)
    w = Window.partitionBy(key, "__cell").orderBy(at, "__kind").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.withColumn("active", F.coalesce(F.max("__hi").over(w) > F.col(at), F.lit(False)).cast("int")).where("__kind = 1")
    return rows.select(*points.columns, "active")


def near_in_time(df: DataFrame, other: DataFrame, key: str, ident: str, at: str, days: int = 7) -> DataFrame:
    """Semi-join: rows of `df` with another row of `other` of the key within `days` floored days. Days are filed in cells."""
    width = days + 1
    far = other.select(F.col(key).alias("__key"), F.col(ident).alias("__id"), F.col(at).alias("__at"), F.explode(F.sequence(F.floor(F.col(at) / 86400 / width) - 1, F.floor(F.col(at) / 86400 / width) + 1)).alias("__cell"))
    apart = F.abs(F.floor((F.col(at) - F.col("__at")) / 86400)) <= days
    return df.withColumn("__c", F.floor(F.col(at) / 86400 / width)).join(far, (F.col(key) == F.col("__key")) & (F.col("__c") == F.col("__cell")) & (F.col(ident) != F.col("__id")) & apart, "left_semi").drop("__c")
