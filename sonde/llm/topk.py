"""Exact top-k inner products by dual cover trees.

Vectors are gathered into blocks of bounded bytes, each with a cover tree: a node's children are a net of its
points at half its scale, and every node knows its centre and the exact radius that covers its points. Query
blocks meet all candidate blocks; a pair of nodes is left out when no inner product between their points
can reach the worst k-th score of the query node:

    <q, c> <= <q0, c0> + rq |c0| + rc |q0| + rq rc

Pairs are visited best bound first and leaf pairs are scored with one exact integer product. A query block keeps
its scores over all candidate blocks of its share; the shares' results are merged by rank.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches

K, SCALE, STEP = 20, 64, 20
LEAF = 64
BLOCK_BYTES = 128 << 10
SHARES = 4
NONE = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Points in tree order; node i spans points lo[i]:hi[i], its children are kids[i]."""

    ids: np.ndarray
    points: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    kids: list[list[int]]


def build(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    x = points.astype(np.float64)
    order: list[np.ndarray] = []
    centre, radius, lo, hi, kids = [], [], [], [], []
    placed = 0

    def add(rows: np.ndarray, scale: float) -> int:
        nonlocal placed
        node = len(centre)
        c = x[rows[0]]
        d = np.sqrt(((x[rows] - c) ** 2).sum(1))
        centre.append(rows[0])
        radius.append(float(d.max()))
        lo.append(placed)
        hi.append(placed)
        kids.append([])
        reach = min(scale, radius[node])
        groups: list[np.ndarray] = []
        while len(rows) > leaf and reach > 0:
            reach /= 2
            groups, rest = [], rows
            while len(rest):  # a net: every point within reach of a centre, centres further apart
                near = ((x[rest] - x[rest[0]]) ** 2).sum(1) <= reach * reach
                groups.append(rest[near])
                rest = rest[~near]
            if len(groups) > 1:
                break
        if 1 < len(groups) <= len(rows) // 2:
            lone = [g for g in groups if len(g) == 1]
            for g in groups:
                if len(g) > 1:
                    kids[node].append(add(g, reach))
            if lone:  # points alone at this scale stay together under one child
                kids[node].append(flat(np.concatenate(lone)))
        else:
            order.append(rows)
            placed += len(rows)
        hi[node] = placed
        return node

    def flat(rows: np.ndarray) -> int:
        nonlocal placed
        centre.append(rows[0])
        radius.append(float(np.sqrt(((x[rows] - x[rows[0]]) ** 2).sum(1)).max()))
        lo.append(placed)
        order.append(rows)
        placed += len(rows)
        hi.append(placed)
        kids.append([])
        return len(centre) - 1

    add(np.arange(len(ids)), np.inf)
    perm = np.concatenate(order)
    at = np.array(centre)
    return Tree(ids[perm], points[perm], x[at], np.array(radius), np.sqrt((x[at] ** 2).sum(1)), np.array(lo), np.array(hi), kids)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum stays below 2**53, else in integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The best k of each query so far."""

    def __init__(self, tree: Tree, k: int) -> None:
        self.tree, self.k = tree, k
        n = len(tree.ids)
        self.score = np.full((n, k), NONE)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def search(self, other: Tree) -> None:
        q, c = self.tree, other
        stack = [(np.inf, 0, 0)]
        while stack:
            bound, i, j = stack.pop()
            worst = self.score[q.lo[i] : q.hi[i], -1].min()
            if worst != NONE and bound < worst:
                continue
            if not q.kids[i] and not c.kids[j]:
                self.score_leaves(i, j, c)
                continue
            a = np.array(q.kids[i] or [i])
            b = np.array(c.kids[j] or [j])
            upper = q.centre[a] @ c.centre[b].T + q.radius[a][:, None] * c.norm[b] + q.norm[a][:, None] * c.radius[b] + q.radius[a][:, None] * c.radius[b]
            upper = upper * (1 + 1e-12) + 1e-6  # doubles round
            most = np.argsort(upper, axis=None)
            stack += [(upper.flat[m], int(a[m // len(b)]), int(b[m % len(b)])) for m in most]

    def score_leaves(self, i: int, j: int, c: Tree) -> None:
        rows = np.arange(self.tree.lo[i], self.tree.hi[i])
        ids = c.ids[c.lo[j] : c.hi[j]]
        s = products(self.tree.points[rows], c.points[c.lo[j] : c.hi[j]])
        worst, last = self.score[rows, -1][:, None], self.id[rows, -1][:, None]
        good = ((s > worst) | ((s == worst) & (ids < last))) & (ids != self.tree.ids[rows][:, None])
        hit = good.any(axis=1)
        if not hit.any():
            return
        rows, cols = rows[hit], good[hit].any(axis=0)
        s = np.where(good[hit][:, cols], s[hit][:, cols], NONE)
        score = np.concatenate([self.score[rows], s], axis=1)
        own = np.concatenate([self.id[rows], np.where(s == NONE, np.iinfo(np.int64).max, ids[cols])], axis=1)
        best = np.lexsort((own, -np.maximum(score, NONE + 1)), axis=-1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, best, 1)
        self.id[rows] = np.take_along_axis(own, best, 1)


def blocks(vectors: DataFrame, most: int = BLOCK_BYTES) -> DataFrame:
    """Rows (dim, block, tree): cover trees over the rows (vec_id, v) of each partition, block numbers any longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, points = (np.concatenate(p) for p in held.pop(dim))
            top = int(np.abs(points).max(initial=0))
            points = points.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max))
            tree = pickle.dumps(build(ids, points))
            return pa.RecordBatch.from_arrays([pa.array([dim]), pa.array([int(ids[0])]), pa.array([tree], pa.binary())], names=["dim", "block", "tree"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                points = values[(ends[own] - dim)[:, None] + np.arange(dim)].astype(np.int64)
                rows = max(64, most // max(1, dim))
                for a in range(0, len(own), rows):
                    part = held.setdefault(int(dim), ([], []))
                    part[0].append(ids[own[a : a + rows]])
                    part[1].append(points[a : a + rows])
                    if sum(map(len, part[0])) >= rows:
                        yield out(int(dim))
        for dim in list(held):
            yield out(dim)

    return vectors.mapInArrow(run, "dim long, block long, tree binary")


def quantised(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows (vec_id, v) of whole, finite vectors with each component as floor(scale * x)."""
    x = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & x.isNotNull() & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) == float("inf")))
    return rows.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v"))


def exact_topk(rows: DataFrame, k: int = K, step: int = STEP, scale: int = SCALE) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row of `rows` whose vec_id `step` divides, its k best of the others.

    Ties go to the smaller vec_id; fewer than k others give all of them. Vectors that are null or hold null or
    non-finite components, and rows of null vec_id, take no part; vectors of different lengths do not meet. All rows
    of a query's vec_id are its own; rows that repeat a candidate each count, rows that repeat a query's id and
    vector are one query, of different vectors under one id the first by rank stays. Empty tables give empty results.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    vectors = quantised(rows, scale)
    queries = blocks(vectors.where(F.col("vec_id") % step == 0).dropDuplicates(["vec_id"]), BLOCK_BYTES // 8).select("dim", F.col("block").alias("query"), F.col("tree").alias("queries"))
    # every query block meets every candidate block of its length, dealt into shares
    shares = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))).alias("share"))
    candidates = blocks(vectors).select("dim", "tree", (F.pmod(F.xxhash64("block"), F.lit(SHARES))).cast("int").alias("share"))
    pairs = candidates.join(shares, ["dim", "share"]).select("query", "share", "queries", "tree")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.repartition(parts, "query", "share").sortWithinPartitions("query", "share")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, best = None, None

        def out(best: Best) -> pa.RecordBatch:
            n, k = best.score.shape
            full = (best.score != NONE).ravel()
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(best.tree.ids, k)[full]), pa.array(best.id.ravel()[full]), pa.array(best.score.ravel()[full])], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for query, share, queries, tree in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if (query, share) != at:
                    if best is not None:
                        yield out(best)
                    at, best = (query, share), Best(pickle.loads(queries), k)  # noqa: S301  written above
                best.search(pickle.loads(tree))  # noqa: S301
        if best is not None:
            yield out(best)

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p) where rank <= 20
"""
