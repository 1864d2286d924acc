"""Keeping the first of what lies near each other, in order: a row stays unless a row before it that stays is near.

That is the lexicographically first maximal independent set of the graph of near rows. Ranges of rows are decided one after another, each
longer than all before it: rows near one that stayed before go, links are made of the others. A range's links are decided in rounds: rows that
no undecided row before them is near to stay, what is near to them and after them goes, and both leave the graph. Only edges move, and each
round's edges and rows that go are stored, so a round can be repeated. Rows with the same hash are one row of the graph, the first of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.operators import hamming
from sonde.session import stored

#: A hash may differ in one bit less than it has parts of so many bits.
PART = 32
#: Rows decided in the first turn; each turn after it decides so many times what was decided before.
START, GROWTH = 1 << 15, 4


def edges(rows: DataFrame, group: str, ident: str, hash_: str, longs: int, most: int) -> DataFrame:
    """Rows (group, a, b): of one group, a before b, hashes of `longs` numbers at most `most` bits apart; `rows` has each hash of a group once."""
    n = longs * 64 // PART
    if most >= n:
        raise ValueError(f"at most {n - 1} bits of a hash of {64 * longs}")
    return hamming.met(rows, group, ident, hash_, longs, most, pairs=True)


def gone(links: DataFrame, group: str) -> DataFrame:
    """Rows (group, node) that go, of links (group, a, b) with a before b. There are as many rounds as the longest run of decisions that wait for each other."""
    left, out = stored(links, "firsts-links"), []
    while not left.isEmpty():
        waits = left.select(group, F.col("b").alias("a")).distinct()
        stays = left.select(group, "a").distinct().join(waits, [group, "a"], "left_anti")
        goes = stored(left.join(stays, [group, "a"], "left_semi").select(group, F.col("b").alias("node")).distinct(), "firsts-gone")
        out.append(goes)
        left = left.join(goes, (left[group] == goes[group]) & (left["b"] == goes["node"]), "left_anti")
        left = left.join(goes, (left[group] == goes[group]) & (left["a"] == goes["node"]), "left_anti")
        left = stored(left.join(stays, [group, "a"], "left_anti"), "firsts-links")
    empty = left.select(group, F.col("a").alias("node"))
    for part in out:
        empty = empty.unionByName(part)
    return empty


def decided(heads: DataFrame, group: str, ident: str, hash_: str, longs: int, most: int) -> DataFrame:
    """Rows (group, ident, first) of those `heads` (group, ident, hash_), each hash of a group once, that go; first is the first that stays and is near.

    Decided in turns by ranges of ident, each longer than all before: what is near a row that stayed in an earlier turn goes without more, so
    links are made among the others of a turn only, and a crowd of near rows has few of them.
    """
    n = heads.count()
    turns = max(1, -(-n // START))
    placed = heads.select(group, ident, hash_, F.lit(0).alias("__turn"))
    if turns > 1:
        placed = stored(heads.select(group, ident, hash_).repartitionByRange(turns, ident).withColumn("__turn", F.spark_partition_id()), "firsts-placed")
        turns = placed.agg(F.max("__turn")).first()[0] + 1
    lo, hi, kept, out = 0, max(1, turns * START // max(n, 1)), None, []
    while lo < turns:
        new = placed.where((F.col("__turn") >= lo) & (F.col("__turn") < hi)).drop("__turn")
        if kept is not None:
            out.append(stored(hamming.met(kept, group, ident, hash_, longs, most, pairs=False, after=new).drop("many"), "firsts-near"))
            new = stored(new.join(out[-1], [group, ident], "left_anti"), "firsts-open")
        links = stored(edges(new, group, ident, hash_, longs, most), "firsts-edges")
        goes = stored(gone(links, group), "firsts-all")
        # the first of those that stay, for each row that goes
        stays = links.join(goes.withColumnRenamed("node", "a"), [group, "a"], "left_anti").groupBy(group, F.col("b").alias(ident)).agg(F.min("a").alias("first"))
        out.append(stored(goes.withColumnRenamed("node", ident).join(stays, [group, ident]), "firsts-went"))
        more = stored(new.join(out[-1], [group, ident], "left_anti"), "firsts-kept")
        kept = more if kept is None else kept.unionByName(more)
        lo, hi = hi, hi * GROWTH
    went = out[0]
    for part in out[1:]:
        went = went.unionByName(part)
    return went


def kept_in_order(rows: DataFrame, group: str, ident: str, hash_: str, longs: int, most: int, same: str | None = None) -> DataFrame:
    """Rows (group, ident, kept, reason, matched_with): in order of `ident`, a row goes if one before it that stays is at most `most` bits away; matched_with is the first such.

    reason is exact_duplicate where `same` (such as a checksum of the content) equals that of the row it goes for, else near_duplicate.
    Rows without a hash stay. Within a group idents are unique; groups and idents aren't null.
    """
    same = same or hash_
    have = rows.where(F.col(hash_).isNotNull()).select(group, ident, F.col(hash_).alias("__h"), F.col(same).alias("__same"))
    heads = stored(have.groupBy(group, "__h").agg(F.min(F.struct(F.col(ident), F.col("__same"))).alias("m")).select(group, "__h", F.col(f"m.{ident}").alias("__head"), F.col("m.__same").alias("__own")), "firsts-heads")
    goes = decided(heads, group, "__head", "__h", longs, most).withColumnRenamed("first", "__for")
    # the checksum of the row it goes for comes along
    of = goes.join(heads.select(group, F.col("__head").alias("__for"), F.col("__own").alias("__their")), [group, "__for"])
    told = heads.join(of, [group, "__head"], "left").select(group, "__h", "__head", F.coalesce("__for", "__head").alias("__for"), F.coalesce("__their", "__own").alias("__their"))
    out = rows.join(told, (rows[group] == told[group]) & (rows[hash_] == told["__h"]), "left").drop(told[group])
    stayed = F.col("__h").isNull() | (F.col(ident) == F.col("__for"))
    reason = F.when(~stayed, F.when(F.col(same) == F.col("__their"), "exact_duplicate").otherwise("near_duplicate"))
    return out.select(group, ident, stayed.alias("kept"), reason.alias("reason"), F.when(~stayed, F.col("__for")).alias("matched_with"))
