"""Ordered operators: relative time, carried state, segments, sliding sums, contiguous partitions and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

BEFORE = (Window.unboundedPreceding, -1)


def relative_time(clock: Column, w: WindowSpec, day: float = 86400, slack: float = 1) -> Column:
    """Time since the first row of a clock that falls back to 0 at midnight; falls of up to `slack` are jitter."""
    turn = F.when(F.lag(clock).over(w) - clock > slack, 1).otherwise(0)
    return clock, turn, day  # summed by relative_seconds, windows can't nest


def relative_seconds(df: DataFrame, keys: list[str], order: list[str], clock: str, out: str, day: int = 86400, slack: float = 1) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    _, turn, _ = relative_time(F.col(clock), w, day, slack)
    rows = df.withColumn("__turn", turn)
    t = F.col(clock) + day * F.sum("__turn").over(w)
    rows = rows.withColumn("__t", t)
    return rows.withColumn(out, F.col("__t") - F.first("__t").over(w)).drop("__turn", "__t")


def carried_state(df: DataFrame, keys: list[str], order: list[str], state: Column, out: str, back_fill: bool = True) -> DataFrame:
    """The last non-null state at or before each row; what comes before the first takes the first if asked to."""
    w = Window.partitionBy(*keys).orderBy(*order)
    last = F.last(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    first = F.first(state, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn(out, F.coalesce(last, first) if back_fill else last)


def state_with_breaks(df: DataFrame, keys: list[str], order: list[str], start: Column, stop: Column, out: str) -> DataFrame:
    """A start sets the state, a stop clears it, other rows keep it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(start.isNotNull(), F.struct(start.alias("v"))).when(stop, F.struct(F.lit(None).cast("string").alias("v")))
    return df.withColumn(out, F.last(mark, ignorenulls=True).over(w)["v"])


def step_length(df: DataFrame, key: str, order: list[str], at: str) -> DataFrame:
    """Rows (key, step): the median time between neighbours, to a thousandth."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.select(key, (F.col(at) - F.lag(at).over(w)).alias("__d")).where("__d is not null").groupBy(key).agg(F.round(F.percentile("__d", F.lit(0.5)), 3).alias("step"))


def onsets(df: DataFrame, keys: list[str], order: list[str], label: str, out: str) -> DataFrame:
    """Distinct labels of each group in order of first appearance, joined by ';'. First places are found before
    the group is gathered, so a group's list is no longer than its labels."""
    first = df.groupBy(*keys, label).agg(F.min(F.struct(*order)).alias("__first"))
    return first.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__first", label))), lambda s: s[label]), ";").alias(out))


def numbered(df: DataFrame, group: str, day: str, order: list[str], out: str) -> DataFrame:
    """1, 2, ... within a group in order, in two levels: days are counted first, rows numbered within their day."""
    sums = df.groupBy(group, day).agg(F.count("*").alias("__n"))
    base = sums.select(F.col(group).alias("__g"), F.col(day).alias("__d"), F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy(day).rowsBetween(*BEFORE)), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy(group, day).orderBy(*order))
    return df.withColumn("__in", inside).join(base, (F.col(group) == F.col("__g")) & (F.col(day) == F.col("__d"))).withColumn(out, F.col("__base") + F.col("__in")).drop("__in", "__base", "__g", "__d")


def sliding(df: DataFrame, keys: list[str], at: str, width: int, value: str) -> DataFrame:
    """Adds n_window and sum_window: rows of the same keys in (at - width, at] and the sum of their values.

    Rows go to the stretch of `width` they lie in and the next one, so a key is dealt by time and no task holds all of a frequent one.
    """
    dealt = df.withColumn("__later", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("__cell", F.floor(F.col(at) / width) + F.col("__later"))
    w = Window.partitionBy(*keys, "__cell").orderBy(at).rangeBetween(-(width - 1), 0)
    out = dealt.withColumns({"n_window": F.count("*").over(w), "sum_window": F.sum(value).over(w)})
    return out.where("__later = 0").drop("__later", "__cell")


def balanced_split(df: DataFrame, key: str, order: list[str], weight: str) -> DataFrame:
    """Rows (key, cut, difference): after how many rows the two halves' weights differ least, the earliest of equals."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = df.select(key, F.row_number().over(w).alias("cut"), F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("__left"), F.sum(weight).over(Window.partitionBy(key)).alias("__all"), F.count("*").over(Window.partitionBy(key)).alias("__n"))
    rows = rows.where("cut < __n").withColumn("difference", F.abs(2 * F.col("__left") - F.col("__all")))
    return rows.groupBy(key).agg(F.min(F.struct("difference", "cut")).alias("m")).select(key, F.col("m.cut").alias("cut"), F.col("m.difference").alias("difference"))


def weighted_parts(df: DataFrame, key: str, order: list[str], weight: str, parts: int, out: str) -> DataFrame:
    """Contiguous parts 0 to parts - 1 of about equal weight: a row's part is where the weight before it falls."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.coalesce(F.sum(weight).over(w.rowsBetween(*BEFORE)), F.lit(0))
    return df.withColumn(out, F.least(F.lit(parts - 1), F.floor(before * parts / F.greatest(F.lit(1), F.sum(weight).over(Window.partitionBy(key))))).cast("int"))


def bundles(df: DataFrame, key: str, order: list[str], size: int, out: str) -> DataFrame:
    return df.withColumn(out, F.floor((F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1) / size).cast("int"))


def anchored(df: DataFrame, text: str, anchors: list[str]) -> DataFrame:
    """Rows (*df, anchor, start, length): the text from each anchor's first place to the next anchor's, within the row."""
    spots = F.array(*[F.struct(F.instr(F.col(text), a).alias("start"), F.lit(a).alias("anchor")) for a in anchors])
    rows = df.withColumn("__s", F.array_sort(F.filter(spots, lambda s: s["start"] > 0))).withColumn("__e", F.length(text) + 1)
    rows = rows.select(*df.columns, "__s", "__e", F.posexplode("__s").alias("__i", "__a"))
    end = F.coalesce(F.get("__s", F.col("__i") + 1)["start"], F.col("__e"))
    return rows.select(*df.columns, F.col("__a.anchor").alias("anchor"), F.col("__a.start").alias("start"), (end - F.col("__a.start")).alias("length"))
