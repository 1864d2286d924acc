"""Document quality from a byte-level convolutional network in numpy.

Filters of WIDTH bytes run over every position of a document. Responses are max-pooled within overlapping
chunks (CHUNK bytes, a new one every HALF bytes) that cover the whole text, and the chunks' pooled responses
are combined (mean and max) into one logistic score. A filter is one table of 256 weights per byte of its
width; two neighbouring tables are fused into one over byte pairs for scoring.

Only the text is seen by the model. Training takes at most SAMPLE labelled rows of each class, at most
TRAIN_CHUNKS chunks of each spread evenly over the text; scoring reads every byte of every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches

WIDTH, FILTERS, HALF = 6, 8, 256
CHUNK = 2 * HALF
SAMPLE = 1000
TRAIN_CHUNKS = 6
THRESHOLD = 0.7
BLOCK = 1 << 19


@dataclass
class Model:
    tables: np.ndarray  # WIDTH, 256, FILTERS
    bias: np.ndarray  # FILTERS
    mix: np.ndarray  # 2 * FILTERS
    base: float

    def chance(self, mean: np.ndarray, top: np.ndarray) -> np.ndarray:
        z = np.concatenate([mean, top], axis=1) @ self.mix + self.base
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def untrained() -> Model:
    return Model(np.zeros((WIDTH, 256, FILTERS), np.float32), np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), 0.0)


def train(samples: list[tuple[int, int, bytes]], epochs: int = 10, seed: int = 7, rate: float = 0.03) -> Model:
    """Fit on (document, label, chunk with WIDTH - 1 bytes more) by Adam on the logistic loss."""
    if len({y for _, y, _ in samples}) < 2:
        model = untrained()
        model.base = 40.0 * (1 if samples and samples[0][1] else -1) if samples else 0.0
        return model
    rng = np.random.default_rng(seed)
    order: dict[int, list[int]] = {}
    for i, (doc, _, _) in enumerate(samples):
        order.setdefault(doc, []).append(i)
    x = np.zeros((len(samples), CHUNK + WIDTH - 1), np.uint8)
    valid = np.zeros(len(samples), np.int64)
    for i, (_, _, b) in enumerate(samples):
        x[i, : len(b)] = np.frombuffer(b, np.uint8)
        valid[i] = min(CHUNK, max(1, len(b)))
    labels = {doc: samples[own[0]][1] for doc, own in order.items()}
    docs = sorted(order)
    weight = {k: 0.5 / max(1, sum(1 for y in labels.values() if y == k)) for k in (0, 1)}
    p = [rng.normal(0, 0.1, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, 2 * FILTERS), np.zeros(1)]
    p[2][:FILTERS] = np.where(np.arange(FILTERS) % 2, 0.5, -0.5)
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    place = np.arange(CHUNK)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // 64)):
            own = [docs[j] for j in part]
            rows = np.concatenate([order[d] for d in own])
            at = np.repeat(np.arange(len(own)), [len(order[d]) for d in own])
            y = np.array([labels[d] for d in own], float)
            xs = x[rows]
            pre = sum(p[0][k].astype(np.float32)[xs[:, k : k + CHUNK]] for k in range(WIDTH))
            pre[place[None, :] >= valid[rows][:, None]] = -1e9
            best = pre.argmax(axis=1)
            m = np.take_along_axis(pre, best[:, None, :], 1)[:, 0, :] + p[1]
            h = np.maximum(m, 0)
            n = np.bincount(at, minlength=len(own)).astype(float)
            mean = np.stack([np.bincount(at, h[:, f], len(own)) for f in range(FILTERS)], 1) / n[:, None]
            starts = np.r_[0, np.cumsum(n).astype(int)[:-1]]
            top = np.maximum.reduceat(h, starts, axis=0)
            feats = np.concatenate([mean, top], 1)
            chance = 1 / (1 + np.exp(-np.clip(feats @ p[2] + p[3][0], -40, 40)))
            dz = (chance - y) * np.array([weight[int(v)] for v in y]) * len(docs) / len(own)
            dfeat = dz[:, None] * p[2][None, :]
            dh = (dfeat[:, :FILTERS] / n[:, None])[at] + dfeat[:, FILTERS:][at] * (h == top[at])
            dm = dh * (m > 0)
            dt = np.zeros_like(p[0])
            cols = np.broadcast_to(np.arange(FILTERS), best.shape)
            for k in range(WIDTH):
                np.add.at(dt[k], (np.take_along_axis(xs, best + k, 1), cols), dm)
            grads = [dt + 1e-4 * p[0], dm.sum(0), feats.T @ dz + 1e-3 * p[2], np.array([dz.sum()])]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.99 * second[i] + 0.01 * g * g
                p[i] = p[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    return Model(p[0].astype(np.float32), p[1].astype(np.float32), p[2].astype(np.float32), float(p[3][0]))


class Scorer:
    """Scores whole texts; work arrays are bounded by BLOCK positions."""

    def __init__(self, model: Model) -> None:
        self.model = model
        low, high = np.arange(65536) & 255, np.arange(65536) >> 8
        self.pairs = [[np.ascontiguousarray(model.tables[k][low, f] + model.tables[k + 1][high, f]) for k in range(0, WIDTH, 2)] for f in range(FILTERS)]

    def pooled(self, data: np.ndarray, shut: np.ndarray) -> np.ndarray:
        """Largest response of each filter in each run of HALF positions; data holds WIDTH bytes more."""
        pair = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << 8)
        n = len(shut)
        out = np.empty((FILTERS, n // HALF), np.float32)
        for f, tables in enumerate(self.pairs):
            r = tables[0][pair[:n]]
            for k, t in enumerate(tables[1:], 1):
                r += t[pair[2 * k : 2 * k + n]]
            r[shut] = -1e9
            out[f] = r.reshape(-1, HALF).max(axis=1)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        sizes = [(max(1, len(t)) + WIDTH - 1 + HALF - 1) // HALF * HALF for t in texts]
        data = np.zeros(sum(sizes) + WIDTH, np.uint8)
        shut = np.ones(sum(sizes), bool)
        at = 0
        for t, n in zip(texts, sizes, strict=True):
            data[at : at + len(t)] = np.frombuffer(t, np.uint8)
            shut[at : at + max(1, len(t))] = False
            at += n
        halves = np.concatenate([self.pooled(data[i : i + BLOCK + WIDTH], shut[i : i + BLOCK]) for i in range(0, len(shut), BLOCK)], axis=1) if texts else np.zeros((FILTERS, 0))
        means, tops, at = [], [], 0
        for n in (s // HALF for s in sizes):
            own = halves[:, at : at + n]
            at += n
            chunks = np.maximum(own[:, :-1], own[:, 1:]) if n > 1 else own
            h = np.maximum(chunks + self.model.bias[:, None], 0)
            means.append(h.mean(axis=1))
            tops.append(h.max(axis=1))
        return self.model.chance(np.array(means), np.array(tops)) if texts else np.zeros(0)


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, target: str = "quality") -> Model:
    """Train on at most `sample` rows of each class whose id's checksum doesn't hold them out.

    Ids labelled both ways, null ids and null labels are left out. Which rows are taken depends on ids only.
    """
    bounded_batches(docs.sparkSession)
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").alias("__id")).agg(F.min(target).alias("__y"), F.max(target).alias("__z")).where("__y = __z")
    )
    picked = None
    for k in (0, 1):
        part = known.where(F.col("__y") == k).orderBy(F.xxhash64("__id"), "__id").limit(sample)
        picked = part if picked is None else picked.union(part)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ys, parts = [], [], []
            for i, y, t in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                b = (t or "").encode()
                last = max(0, len(b) - CHUNK)
                for start in sorted({round(last * k / max(1, TRAIN_CHUNKS - 1)) for k in range(TRAIN_CHUNKS)}):
                    ids.append(i)
                    ys.append(y)
                    parts.append(b[start : start + CHUNK + WIDTH - 1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(parts, pa.binary())], names=["id", "y", "chunk"])

    # at most 2 * sample ids are broadcast, at most TRAIN_CHUNKS chunks of each come back
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("__text"))
    rows = texts.join(F.broadcast(picked), "__id").select("__id", F.col("__y").cast("int"), "__text").mapInArrow(chunks, "id long, y int, chunk binary")
    rows = rows.distinct().orderBy("id", "chunk").limit(4 * sample * TRAIN_CHUNKS)
    return train([(r.id, r.y, bytes(r.chunk)) for r in rows.collect()])


def quality_scores(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (*keep, score, predicted) for each row of `docs`.

    Null texts count as empty, empty texts get the score of a document without a byte. Scores depend on the
    text alone, so repeated rows repeat. A model of one class scores near 0 or 1, of none 0.5.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(len(keep)).to_pylist()]
            score = scorer.scores(texts).astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{kinds}, score double, predicted int")


def quality_filter(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, columns unchanged, whose text scores at least `threshold`."""
    names = docs.columns
    own = tuple(f"__c{i}" for i in range(len(names)))
    rows = docs.toDF(*own).withColumn("text", F.col(own[names.index("text")]))
    return quality_scores(rows, model, threshold, own).where("predicted = 1").select(*own).toDF(*names)
