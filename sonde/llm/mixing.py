"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Slots 0, 1, 2, ... are golden-ratio points in [0, 1); a slot goes to the source in whose part of the
cumulative weights it falls; a source that no point falls to has the slot nearest to its part. Slots are ranked
within their source, and the slot of rank r takes block r of the source: its documents in shuffled order, laid end
to end and repeated, of which the target's words are cut into as many equal blocks as the source has slots. So each
source's blocks hold about the same number of words, and its slots together hold its target. Ranks and running sums
are built in two levels (bucket sums first, then within a bucket), so no window ever holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import stored, text_key

GOLDEN = 0.6180339887498949
WEIGHTS = (1, 2, 3)
CAP = 3
SLOTS, BLOCK_WORDS = 32768, 4096
CELLS = 1024
SLOT_RUN = 65536
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Rows (source, source_size, target, lo, hi) from rows (source, source_size), one a source.

    Sources in code point order, null last, have the weights in turn. Targets share the whole size by weight, none
    above cap times its source; what is cut is shared again. With sources ordered by cap over weight, the level
    (words per weight) is the largest of the levels left after capping each first few.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1).cast("double")
    by_ratio = Window.orderBy("__ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    upto = by_name.rowsBetween(Window.unboundedPreceding, -1)
    return (
        sizes.withColumn("__w", w)
        .withColumn("__ratio", cap * F.col("source_size") / F.col("__w"))
        .withColumn("__left", F.sum("source_size").over(whole) - F.coalesce(F.sum(cap * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("__weight", F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
        .withColumn("__level", F.max(F.col("__left") / F.col("__weight")).over(whole))
        .withColumn("target", F.least((cap * F.col("source_size")).cast("double"), F.col("__w") * F.col("__level")))
        .withColumn("__sum", F.sum("target").over(whole))
        .withColumn("__lo", F.coalesce(F.sum("target").over(upto), F.lit(0.0)))
        .select("source", "source_size", "target", F.when(F.col("__sum") > 0, F.col("__lo") / F.col("__sum")).alias("lo"), F.when(F.col("__sum") > 0, (F.col("__lo") + F.col("target")) / F.col("__sum")).alias("hi"))
    )


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """Rows (slot, source, rank): which source each slot takes from, ranks from 0 within a source. Every source with a target has one at least."""
    spark = shares.sparkSession
    points = spark.range(slots).select(F.col("id").alias("slot"), ((F.col("id") * GOLDEN) % 1.0).alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS))
    # the last source also takes what rounding leaves above its end; cells make the range join an equi-join
    parts = shares.where("target > 0").withColumn("last", F.row_number().over(Window.orderBy(F.col("hi").desc(), F.col("lo").desc())) == 1)
    parts = parts.withColumn("hi", F.when(F.col("last"), F.lit(1.0)).otherwise(F.col("hi")))
    cells = parts.select("source", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1).cast("long")))).alias("cell"))
    placed = points.join(cells, "cell").where("u >= lo and u < hi").select("slot", "source")
    met = placed.groupBy("source").agg(F.lit(1).alias("met")).select(F.col("source").alias("__s"), "met")
    alone = parts.join(met, F.col("source").eqNullSafe(F.col("__s")), "left").where("met is null").select(F.floor(F.col("lo") * slots).alias("slot"), "source")
    placed = placed.unionByName(alone).withColumn("run", F.floor(F.col("slot") / SLOT_RUN))
    sums = placed.groupBy("source", "run").agg(F.count("*").alias("n"))
    first = sums.select(F.col("source").alias("__s"), F.col("run").alias("__r"), F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__first"))
    ranked = placed.withColumn("__in", F.row_number().over(Window.partitionBy("source", "run").orderBy("slot")) - 1)
    return ranked.join(first, F.col("source").eqNullSafe(F.col("__s")) & (F.col("run") == F.col("__r"))).select("slot", "source", (F.col("__first") + F.col("__in")).alias("rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, key: tuple[Column, ...] = ()) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken[, __k0...]), one for each row of `docs`.

    Size counts words, 0 for a null or empty text; taken is how many of its words the mix takes, repeats
    counted, at most cap times the size. Which documents a source's last, partial pass takes follows the md5
    of their ids, so reruns agree; rows that repeat an id and size may swap values, which leaves the result the
    same. Null sources form one source, null ids are shuffled like the empty id. Without any word nothing is
    taken. `key` adds columns as __k0, ....
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words().alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("h"), *[k.alias(f"__k{i}") for i, k in enumerate(key)],
    )
    rows = stored(rows.withColumn("bucket", F.substring("h", 1, 3)), "mix")
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    shares = stored(targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), weights, cap), "mix-targets")
    total = int(shares.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    block = max(1, min(BLOCK_WORDS, total // SLOTS))
    slots = stored(schedule(shares, -(-total // block)), "mix-slots")
    counts = slots.groupBy("source").agg(F.count("*").alias("__slots")).select(F.col("source").alias("__c"), "__slots")

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    of = shares.join(counts, F.col("source").eqNullSafe(F.col("__c")), "left").select(F.col("source").alias("__o"), "source_size", "target", F.round("target").cast("long").alias("__words"), F.coalesce("__slots", F.lit(1)).alias("__slots"))
    starts = starts.join(of, F.col("__s").eqNullSafe(F.col("__o"))).drop("__o")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    placed = (
        rows.withColumn("n", F.row_number().over(inside))
        .withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(starts, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b"))).drop("__s", "__b")
        .withColumn("start", F.col("start") + F.col("base"))
    )
    # a document's places in the repeated stream, as far as the target's words go, cut at block ends; block r begins at round(r * step)
    step = F.greatest(F.col("__words") / F.col("__slots"), F.lit(1e-9))
    reach = F.least(F.lit(cap - 1), F.floor(F.greatest(F.col("__words") - 1, F.lit(0)) / F.greatest(F.col("source_size"), F.lit(1))))
    carried = ["doc_id", "source", "size", "source_size", "target", "bucket", "n", *[f"__k{i}" for i in range(len(key))]]
    passes = placed.where("size > 0").withColumn("__step", step).select(*carried, "start", "__words", "__step", F.explode(F.sequence(F.lit(0).cast("long"), reach.cast("long"))).alias("pass"))
    passes = passes.withColumn("from", F.col("pass") * F.col("source_size") + F.col("start")).withColumn("to", F.least(F.col("from") + F.col("size"), F.greatest("from", "__words")))
    near = lambda w: F.floor(w / F.col("__step"))
    blocks = F.when(F.col("from") < F.col("to"), F.sequence(F.greatest(near(F.col("from")) - 1, F.lit(0).cast("long")), near(F.col("to")) + 1)).otherwise(F.array(F.lit(-1).cast("long")))
    pieces = passes.select(*carried, "from", "to", "__step", F.explode(blocks).alias("block"))
    edge = lambda r: F.round(r * F.col("__step")).cast("long")
    pieces = pieces.withColumn("words", F.least("to", edge(F.col("block") + 1)) - F.greatest("from", edge(F.col("block")))).where("words > 0 or block < 0")
    hit = slots.select(F.col("source").alias("__s"), F.col("rank").alias("__r"), F.lit(1).alias("hit"))
    got = pieces.join(hit, F.col("source").eqNullSafe(F.col("__s")) & (F.col("block") == F.col("__r")), "left").groupBy(*carried).agg(F.sum(F.when(F.col("hit") == 1, F.col("words")).otherwise(0)).alias("taken"))
    nothing = placed.where("size = 0").select(*carried, F.lit(0).cast("long").alias("taken"))
    return got.union(nothing).drop("bucket", "n")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself, with the columns of `docs`: each document as often as it was taken.

    A source's blocks lie one after another in its stream, so only the document at the target's end is taken in part: up to the word where the
    last block ends, with all that stands before and between its words. Rows alike in id, source and text share what they were given.
    Documents without a word go.
    """
    names, key = docs.columns, text_key("text")
    got = mix(docs, weights, cap, (key,)).groupBy("doc_id", "source", "__k0").agg(F.sum("taken").alias("__all"), F.count("*").alias("__n"), F.max("size").alias("__size")).where("`__all` > 0")
    got = got.select(F.col("doc_id").alias("__id"), F.col("source").alias("__s"), F.col("__k0").alias("__key"), "__all", "__n", "__size")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__s")) & (key == F.col("__key"))
    alike = Window.partitionBy("__id", "__s", "__key").orderBy(F.lit(1))
    rows = docs.join(got, same).withColumn("__k", F.row_number().over(alike) - 1)
    rows = rows.withColumn("__taken", F.floor(F.col("__all") / F.col("__n")) + (F.col("__k") < F.col("__all") % F.col("__n")).cast("int"))
    rows = rows.where("`__taken` > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__taken") - 1) / F.col("__size")))))
    part = F.least(F.col("__taken") - F.col("__copy") * F.col("__size"), F.col("__size")).cast("int")
    spaced = F.regexp_extract_all("text", F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1))
    text = F.when(part >= F.col("__size"), F.col("text")).otherwise(F.array_join(F.slice(spaced, F.lit(1), part), ""))
    return rows.select(*[text.alias(c) if c == "text" else (F.length(text).cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")) for c in names])


ORACLE_SQL = r"""
with r as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, md5(coalesce(doc_id::varchar, '')) as h from documents),
s0 as (select source, sum(size)::bigint as source_size from r group by 1),
s1 as (select *, [1, 2, 3][(row_number() over (order by source nulls last) - 1) % 3 + 1]::double as w from s0),
s2 as (select *, 3 * source_size / w as ratio from s1),
s3 as (select *, ((sum(source_size) over () - coalesce(sum(3 * source_size) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
  / (sum(w) over () - coalesce(sum(w) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))) as level from s2),
s4 as (select *, least((3 * source_size)::double, w * max(level) over ()) as target from s3),
d as (select r.*, s4.source_size, s4.target, round(s4.target)::bigint as words, sum(size) over (partition by r.source order by h, doc_id, size rows between unbounded preceding and current row) - size as start
  from r join s4 on r.source is not distinct from s4.source)
select doc_id, source, size, source_size, target,
  (greatest(0, least(size, words - start)) + greatest(0, least(size, words - start - source_size)) + greatest(0, least(size, words - start - 2 * source_size)))::bigint as taken
from d
"""
