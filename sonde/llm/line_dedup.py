"""Line deduplication by overlapping windows of three lines.

Every window of LINES consecutive lines is hashed to 128 bits; a text of fewer lines has one window, filled up with
nulls. A window found more than once in the corpus keeps its first occurrence, in the order of (doc_id, text key, line);
the lines that any later occurrence covers are removed, overlapping windows merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import stored, text_key

LINES = 3


def repeats(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Rows (__id, __key, __covered): for each distinct (doc_id, text) with a later occurrence, the lines it covers, from 0."""
    split = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), text_key(F.col("text").cast("string")).alias("__key"), split.alias("__lines"), "text")
    rows = rows.where(F.octet_length("text") > 0)

    def window(i: F.Column) -> F.Column:
        parts = [F.get("__lines", i + k) for k in range(lines)]
        short = [p.isNull() for p in parts]  # xxhash64 passes over nulls
        return F.struct(i.alias("at"), F.xxhash64(*parts, *short).alias("h"), F.xxhash64(F.lit(1), *reversed(parts), *short).alias("g"))

    found = F.inline(F.transform(F.sequence(F.lit(0), F.greatest(F.size("__lines") - lines, F.lit(0))), window))
    windows = stored(rows.select("__id", "__key", found), "lines")
    place = F.struct(F.col("__id").isNull().alias("no"), F.col("__id").alias("id"), F.col("__key").alias("key"), F.col("at").alias("at"))
    first = windows.groupBy("h", "g").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    # rows that repeat a document's id and text are the same place; they are one document here
    later = windows.join(first.drop("last"), ["h", "g"]).where(~place.eqNullSafe(F.col("first"))).select("__id", "__key", "at").distinct()
    covered = F.flatten(F.transform(F.collect_list("at"), lambda i: F.sequence(i, i + lines - 1)))  # may end after a short text
    return later.groupBy("__id", "__key").agg(F.array_distinct(covered).alias("__covered"))


def line_dedup(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """The columns of `docs` with repeated lines taken out of text, and __lines (line count) and __removed.

    One row for each row of `docs`. A text of fewer than three lines goes if an earlier one is the same; empty texts stay
    as they are; a null text stays null with 0 lines. Rows that repeat an id and text are treated alike, as one document. A null id
    stands after all others. Lines are cut at line feeds only and compared byte for byte. n_chars, if there,
    follows the text.
    """
    found = repeats(docs, lines)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_key(F.col("text").cast("string")) == F.col("__key"))
    rows = docs.join(found, same, "left").withColumn("__split", F.split(F.col("text").cast("string"), "\n", -1))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("__split"))
    rows = rows.withColumn("__covered", F.filter("__covered", lambda i: i < F.size("__split")))
    rows = rows.withColumn("__lines", n).withColumn("__removed", F.coalesce(F.size("__covered"), F.lit(0)))
    left = F.array_except(F.sequence(F.lit(0), F.size("__split") - 1), F.col("__covered"))
    text = F.when(F.col("__removed") == 0, F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("__split", i)), "\n"))
    rows = rows.withColumn("__new", text)
    cols = [F.col("__new").alias(c) if c == "text" else (F.when(F.col("__removed") == 0, F.col(c)).otherwise(F.length("__new")).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")) for c in docs.columns]
    return rows.select(*cols, "__lines", "__removed")


ORACLE_SQL = r"""
with d as (select doc_id, text, string_split(text, chr(10)) as ls from documents),
w as (select doc_id, i - 1 as pos, ls[i:i + 2] as win from (select doc_id, ls, unnest(range(1, greatest(2, len(ls) - 1))) as i from d where text <> '')),
f as (select *, row_number() over (partition by win order by doc_id, pos) as rn from w),
c as (select distinct doc_id, pos + k as pos from f, (values (0), (1), (2)) t(k) where rn > 1),
l as (select doc_id, unnest(range(0, len(ls))) as pos, unnest(ls) as line from d),
k as (select l.doc_id, count(*) as n_lines, count(c.pos) as n_removed, coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where c.pos is null), '') as kept
  from l left join c on l.doc_id = c.doc_id and l.pos = c.pos group by 1)
select doc_id, n_lines::int as n_lines, n_removed::int as n_removed, sha256(kept) as kept_sha256 from k
"""
