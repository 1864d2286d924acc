"""Ranked lexical search: an inverted index in shards of documents, searched by MaxScore.

A map task cuts the documents it reads into shards of at most SHARD_POSTINGS postings (one document more at most) and writes a
shard's posting lists, one row a term; nothing is shuffled. A search takes the lists of its items' terms and gives each shard
to a task. There the lists are ordered by the most that any of their documents gains. Lists whose bounds together stay below
the worst of the best k scores so far are non-essential: documents are found by the other lists, and probed in the
non-essential ones, highest bound first, only as long as what is left could still lift them to that score. Each shard gives k
rows an item, and a window over these rows keeps the best.

Items are searched in blocks of about BLOCK_TERMS (item, term) pairs, which is what a task holds of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches, stored

#: The maximal runs of digits, letters and what is beyond ASCII; all bytes of a UTF-8 character beyond ASCII are 0x80 or more.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BEST = 20
SHARD_POSTINGS, SHARD_DOCS = 1 << 21, 1 << 16
BLOCK_TERMS = 200_000
FIRST_WINDOW, WINDOW = 256, 8192
LONG = 1 << 22
NO_ID = np.iinfo(np.int64).max
INDEX = "shard long, term binary, docs array<int>, times array<int>, ids array<long>, sizes array<long>"


def terms(text: bytes | None) -> Counter[bytes]:
    text = (text or b"").translate(LOWER)
    if len(text) > LONG:  # no list of all terms of a long text
        return Counter(m.group() for m in TERM.finditer(text))
    return Counter(TERM.findall(text))


@dataclass
class Shard:
    """Posting lists of some documents, which are numbered from 0 in the order added."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    found: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    ids: list[int | None] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    postings: int = 0

    def add(self, ident: int | None, text: bytes | None) -> None:
        """Documents without a term don't count and can't be found."""
        own = terms(text)
        if not own:
            return
        known = self.vocabulary
        self.found.append((np.array([known.setdefault(t, len(known)) for t in own], np.int32), np.fromiter(own.values(), np.int32, len(own))))
        self.ids.append(ident)
        self.sizes.append(int(self.found[-1][1].sum(dtype=np.int64)))
        self.postings += len(own)

    def full(self, most: int) -> bool:
        return self.postings >= most or len(self.ids) >= SHARD_DOCS

    def rows(self, shard: int) -> pa.RecordBatch:
        """One row a term, and one without a term that holds the documents' ids and sizes."""
        of = np.concatenate([t for t, _ in self.found])
        doc = np.repeat(np.arange(len(self.found), dtype=np.int32), [len(t) for t, _ in self.found])
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=len(self.vocabulary)))
        at = pa.array(np.r_[0, ends, ends[-1]].astype(np.int32))
        none = pa.array([None] * len(self.vocabulary), pa.list_(pa.int64()))
        last = lambda x: pa.concat_arrays([none, pa.array([x], pa.list_(pa.int64()))])
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(self.vocabulary) + 1, shard)), pa.array([*self.vocabulary, None], pa.binary()), pa.ListArray.from_arrays(at, pa.array(doc[order])),
            pa.ListArray.from_arrays(at, pa.array(np.concatenate([n for _, n in self.found])[order])), last(self.ids), last(self.sizes),
        ], names=["shard", "term", "docs", "times", "ids", "sizes"])


def build(docs: DataFrame, ident: str = "doc_id", text: str = "text", postings: int = SHARD_POSTINGS) -> DataFrame:
    """The index of `docs`, stored: rows (shard, term, docs, times, ids, sizes), in shards of about `postings`.

    A shard is named by its task and number within it, and a task's rows are written once, so a retried task replaces its shards.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        shard = Shard()
        for batch in batches:
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard.add(one, data.as_py())
                if shard.full(postings):
                    yield shard.rows(base)
                    base, shard = base + 1, Shard()
        if shard.ids:
            yield shard.rows(base)

    return stored(docs.select(F.col(ident).cast("long"), F.col(text).cast("string").cast("binary")).mapInArrow(run, INDEX), "lexical-index")


def asked(items: DataFrame, item: str, text: str = "text") -> DataFrame:
    """Rows (item, term, times) of the items' terms; rows that share an item's id are one item, a null id is an item of its own."""
    kind = dict(items.dtypes)[item]
    arrow = items.select(item).limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = terms(data.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([one] * len(own), arrow), pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.int64())], names=["item", "term", "times"])

    rows = items.select(F.col(item).alias("item"), F.col(text).cast("string").cast("binary")).mapInArrow(run, f"item {kind}, term binary, times long")
    return rows.groupBy("item", "term").agg(F.sum("times").alias("times"))


@dataclass
class Postings:
    """A list of documents in order with what each gains by the term, and the most that any gains."""

    docs: np.ndarray
    gains: np.ndarray
    bound: int


def lengths(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m: 75 and a quarter of its size over the mean size, in hundredths."""
    if len(sizes) and 25 * int(sizes.max()) * n_docs > np.iinfo(np.int64).max:
        return np.array([75 + 25 * int(n) * n_docs // n_terms for n in sizes], np.int64)
    return 75 + 25 * sizes * n_docs // n_terms


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def best(lists: list[tuple[Postings, int]], ids: np.ndarray, k: int = BEST) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers and scores of the k documents that gain most by the lists, each taken so many times, and how many postings were read.

    Highest scores first, ties to smaller `ids`; documents that gain nothing don't count.
    """
    lists = sorted(((p, r) for p, r in lists if p.bound * r > 0), key=lambda x: x[0].bound * x[1])
    upto = np.cumsum([p.bound * r for p, r in lists])  # most that the first lists give together
    docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    worst, low, width, read = 1, 0, FIRST_WINDOW, 0
    while low < len(ids):
        high = min(len(ids), low + width)
        essential = int(np.searchsorted(upto, worst))  # the first list with which the bounds reach the worst score
        if essential == len(lists):
            break
        sums = np.zeros(high - low, np.int64)
        for p, r in lists[essential:]:
            a, b = np.searchsorted(p.docs, (low, high))
            sums[p.docs[a:b] - low] += p.gains[a:b] * r
            read += int(b - a)
        own = np.flatnonzero(sums)
        got, own = sums[own], own + low
        for i in range(essential - 1, -1, -1):
            able = got + upto[i] >= worst
            own, got = own[able], got[able]
            if not len(own):
                break
            p, r = lists[i]
            at = np.minimum(np.searchsorted(p.docs, own), len(p.docs) - 1)
            got = got + np.where(p.docs[at] == own, p.gains[at] * r, 0)
            read += len(own)
        able = got >= worst
        docs, scores = np.r_[docs, own[able]], np.r_[scores, got[able]]
        order = np.lexsort((ids[docs], -scores))[:k]
        docs, scores = docs[order], scores[order]
        worst = int(scores[-1]) if len(scores) == k else 1
        low, width = high, min(2 * width, WINDOW)
    return docs, scores, read


def search(index: DataFrame, items: DataFrame, item: str, text: str = "text", k: int = BEST, ident: str = "doc_id") -> DataFrame:
    """Rows (item, rank, doc_id, score): for each item the k documents of `index` with the highest scores above 0, ties to smaller ids.

    A term's weight is w = floor(1000 ln((2 N + 2) / (2 df + 1))), a document's m is 75 + 25 n N div L, and it scores
    w (10^9 tf div (1000 tf + 12 m)) for each of the item's terms, repeats included. Null and empty texts have no terms, and items
    and documents without terms give no rows. Rows of `items` with the same id are one item (null ids too). Each row of the indexed
    documents ranks for itself, so repeated rows take several ranks; null ids come last among ties. Very long texts are read whole:
    a text's distinct terms are held by one task. Empty tables give empty results. Other columns are not read.
    """
    spark = index.sparkSession
    kind = dict(items.dtypes)[item]
    every = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    n_docs, n_terms = (int(x or 0) for x in index.where("term is null").agg(F.sum(F.size("ids")), F.sum(every)).first())
    wanted = stored(asked(items, item, text), "lexical-items")
    counted = index.where("term is not null").select("term", F.size("docs").alias("n")).join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("n").alias("df"))
    wanted = stored(wanted.join(counted, "term"), "lexical-weights")
    blocks = max(1, math.ceil(wanted.count() / BLOCK_TERMS))
    schema = f"item {kind}, doc_id long, score long"
    arrow = items.select(item).limit(0).toArrow().schema.field(0).type

    def block(own: DataFrame) -> DataFrame:
        found: dict[object, list[tuple[bytes, int]]] = {}
        weights: dict[bytes, int] = {}
        for r in own.collect():  # about BLOCK_TERMS rows
            found.setdefault(r["item"], []).append((bytes(r["term"]), r["times"]))
            weights[bytes(r["term"])] = weight(n_docs, r["df"])

        def run(table: pa.Table) -> pa.Table:
            shard = table.filter(pc.is_null(table.column("term")))
            lists = table.filter(pc.is_valid(table.column("term")))
            ids = shard.column("ids").combine_chunks().flatten()
            keys = np.asarray(ids.fill_null(NO_ID))
            m = lengths(np.asarray(shard.column("sizes").combine_chunks().flatten()), n_docs, n_terms)
            own: dict[bytes, Postings] = {}
            for term, docs, times in zip(lists.column("term"), lists.column("docs"), lists.column("times"), strict=True):
                at, tf = np.asarray(docs.values), np.asarray(times.values).astype(np.int64)
                gains = weights[term.as_py()] * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
                own[term.as_py()] = Postings(at, gains, int(gains.max()))
            out = []
            for one, parts in found.items():
                docs, scores, _ = best([(own[t], r) for t, r in parts if t in own], keys, k)
                out += [(one, ids[int(d)].as_py(), int(s)) for d, s in zip(docs, scores, strict=True)]
            columns = list(zip(*out, strict=True)) or [[], [], []]
            return pa.table([pa.array(columns[0], arrow), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

        lists = index.join(own.select("term").distinct(), "term").select("shard", "term", "docs", "times", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("sizes"))
        whole = index.where("term is null").select("shard", "term", F.lit(None).cast("array<int>").alias("docs"), F.lit(None).cast("array<int>").alias("times"), "ids", "sizes")
        return lists.unionByName(whole).groupBy("shard").applyInArrow(run, schema)

    number = F.pmod(F.xxhash64("item"), F.lit(blocks))
    rows = None
    for b in range(blocks):
        part = block(wanted.where(number == b))
        part = stored(part, "lexical-block") if blocks > 1 else part
        rows = part if rows is None else rows.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    out = rows.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select(F.col("item").alias(item), "rank", F.col("doc_id").alias(ident), "score")


ORACLE_SQL = r"""
with dt as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
it as (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark),
g as (select count(*) filter (where len(w) > 0) as n_docs, sum(len(w))::bigint as n_terms from dt),
tf as (select r, t, count(*) as tf from (select r, unnest(w) as t from dt) group by 1, 2),
w as (select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tf, g group by t, n_docs),
q as (select item_id, t, count(*) as times from it group by 1, 2),
s as (select q.item_id, dt.r, dt.doc_id, sum(q.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(dt.w) * n_docs) // n_terms))))::bigint as score
  from q join w using (t) join tf using (t) join dt using (r), g group by 1, 2, 3),
k as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from s where score > 0)
select item_id, rank::int as rank, doc_id, score from k where rank <= 20
"""
