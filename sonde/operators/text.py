"""Pages and documents as numbered lines; routing by weighted patterns; first-match classes; field extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKER = r"^\s*\[SOURCE_IMAGE:"
INFORMATIVE = r"[^ \t\n\f\r0-9|*#$%&!=_.,;:-]"
#: Spaces of Unicode (Zs), which don't count at the ends of a line.
SPACES = "".join(map(chr, (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))
BREAKS = r"\r\n|\n|\r"


def lines(df: DataFrame, keys: list[str], text: str, breaks: str = BREAKS) -> DataFrame:
    """Rows (*keys, line_no, line, informative), lines numbered from 1; cut at any line break, or at `breaks` only."""
    rows = df.select(*keys, F.posexplode(F.split(F.col(text), breaks, -1)).alias("__p", "line"))
    t = F.btrim("line", F.lit(SPACES))
    return rows.select(*keys, (F.col("__p") + 1).alias("line_no"), "line", (t.rlike(INFORMATIVE) & ~t.rlike(MARKER)).alias("informative"))


def merged_pages(pages: DataFrame, entity: str, page: str, text: str) -> DataFrame:
    """One document an entity: its non-empty pages in order, each after a marker line, a blank line between."""
    rows = pages.where(F.length(F.trim(text)) > 0)
    part = F.concat(F.lit("[SOURCE_IMAGE: "), F.col(page).cast("string"), F.lit("]\n"), F.col(text))
    return rows.groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, part.alias("__t")))), lambda s: s["__t"]), "\n\n").alias("text"))


def matches(text: str | Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def route(df: DataFrame, text: str, rules: dict[str, list[tuple[str, int]]]) -> DataFrame:
    """`df` with route, score, margin and confidence: weights of the patterns found are summed by route, the highest wins,
    the first named of equals; high from 4 on, medium from 2 on."""
    total = {name: sum((F.when(F.col(text).rlike(p), w).otherwise(0) for p, w in own), F.lit(0)) for name, own in rules.items()}
    ranked = F.array_sort(F.array(*[F.struct((-s).alias("s"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, s) in enumerate(total.items())]))
    rows = df.withColumn("__r", ranked).withColumn("score", -F.col("__r")[0]["s"]).withColumn("margin", F.col("score") + F.col("__r")[1]["s"])
    rows = rows.withColumn("route", F.when(F.col("score") > 0, F.col("__r")[0]["n"]).otherwise("unknown"))
    return rows.withColumn("confidence", F.when(F.col("score") >= 4, "high").when(F.col("score") >= 2, "medium").otherwise("low")).drop("__r")


def first_match(text: str | Column, rules: list[tuple[str, str]], default: str) -> Column:
    out = None
    col = F.col(text) if isinstance(text, str) else text
    for pattern, name in rules:
        out = F.when(col.rlike(pattern), name) if out is None else out.when(col.rlike(pattern), name)
    return out.otherwise(default)


def nth_number(text: str | Column, n: int) -> Column:
    """The n-th run of digits, from 1."""
    return F.get(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), n - 1)


def all_found(text: str | Column, pattern: str, group: int = 1) -> Column:
    """Distinct matches in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
