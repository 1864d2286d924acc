"""A log-bilinear language model, trained by noise-contrastive estimation in numpy, and the smoothed unigram model it is held against.

Tokens become symbols: the OWN words most frequent in training have one each, all others share CLASSES by their last two bytes. The
model predicts a symbol y from the two before it, by (r[x1] C1 + r[x2] C2) q[y] + b[y]; within a class, words follow their smoothed
counts. As the two contexts add up in the exponent, the normaliser of every pair of contexts is one entry of a product of two
matrices, exp(r C1 q + b) and exp(r C2 q) transposed: every token gets its normalised log-probability by three lookups.

Three passes over the texts. One counts every word of all documents. One turns texts into symbols, 2 bytes a token, stored; counts of
words with at least 1 / HOT of all tokens (so at most HOT words) are held by every task, words rarer than that meet their counts by a
join that no frequent word takes part in. Training reads the stored symbols of all training documents once, in rounds:
every task goes over its part of a round's documents, starting from the same parameters, and parameters are averaged by tokens. Only parameters, the words of HOT
and one row a class go through the driver, all of bounded size; texts, words and symbols don't.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches, stored

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Stands for a text's end; no word is empty.
END = b""
OWN, CLASSES, TAIL = 1536, 512, 2
HOT = 1_000_000
ADDED = 0.1
DIM, NOISE, BATCH, RATE = 32, 64, 512, 0.2
#: Rounds of training, each over its share of the training documents, and the fewest training tokens a task is given.
ROUNDS, TASK_TOKENS = 2, 2_000_000
MEMORY = 300_000
PIECE = 1 << 22
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept out of training: crc32 of the id as text is divisible by 10; null ids count as the empty id."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def pieces(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size: it is cut at white space about every PIECE bytes."""
    text = (text or b"").translate(LOWER)
    low = 0
    while len(text) - low > PIECE:
        cut = BLANK.search(text, low + PIECE)
        if not cut:
            break
        yield text[low : cut.start()].split()  # splits at just these characters
        low = cut.end()
    yield text[low:].split() if low else text.split()


def class_of(word: bytes) -> int:
    return OWN + zlib.crc32(word[-TAIL:]) % CLASSES


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word, c, n): how often each word, the end among them, occurs in training documents and in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            words = list(counts[0].keys() | counts[1].keys())
            c, h = (np.fromiter((k[w] for w in words), np.int64, len(words)) for k in counts)
            for k in counts:
                k.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c), pa.array(c + h)], names=["word", "c", "n"])

        for batch in batches:
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = counts[held]
                for words in pieces(text.as_py()):
                    own.update(words)
                own[END] += 1
                if len(counts[0]) + len(counts[1]) > 2 * MEMORY:
                    yield rows()
        yield rows()

    found = docs.select(held_out().alias("__held"), F.col("text").cast("string").cast("binary")).mapInArrow(run, "word binary, c long, n long")
    return found.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts that every task holds: words of HOT with symbols and training counts, tokens and distinct words of each class."""

    codes: dict[bytes, int]
    symbols: np.ndarray
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    words: int

    def class_log(self) -> np.ndarray:
        """log10 of what counts are divided by within each symbol; 0 for words with one of their own."""
        out = np.log10(self.class_tokens + ADDED * (self.class_words + 1))
        out[:OWN] = 0
        return out

    def base(self, logs: float, n: int) -> float:
        return logs - n * float(np.log10(self.tokens + ADDED * (self.words + 1)))


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From stored rows (word, c, n). Words with at least 1 / HOT of all tokens are held; the OWN with the highest training counts have symbols, ties in byte order."""
    total, tokens, words = (int(x or 0) for x in counts.agg(F.sum("n"), F.sum("c"), F.count_if(F.col("c") > 0)).first())
    frequent = (F.col("n") * HOT >= total) | (F.col("word") == F.lit(END))
    held = sorted(((bytes(r.word), r.c) for r in counts.where(frequent).collect()), key=lambda x: (-x[1], x[0]))  # at most HOT rows
    if END not in {w for w, _ in held[:OWN]}:
        held = [x for x in held if x[0] == END] + [x for x in held if x[0] != END]
    own = [w for w, c in held[:OWN] if c > 0 or w == END]
    symbols = np.array([i if i < len(own) else class_of(w) for i, (w, _) in enumerate(held)], np.uint16)
    kind = F.lit(OWN) + F.crc32(F.expr(f"substring(word, greatest(length(word) - {TAIL - 1}, 1), {TAIL})")) % CLASSES
    rows = counts.where("c > 0").groupBy(kind.cast("int").alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect()  # one a class
    c, v = np.zeros(OWN + CLASSES), np.zeros(OWN + CLASSES)
    for r in rows:
        c[r.k], v[r.k] = r.c, r.v
    for i, w in enumerate(own):  # those with symbols of their own aren't in a class
        if held[i][1]:
            c[class_of(w)] -= held[i][1]
            v[class_of(w)] -= 1
        c[i], v[i] = held[i][1], 1
    return Vocabulary({w: i for i, (w, _) in enumerate(held)}, symbols, np.array([c for _, c in held], np.int64), c, v, tokens, words)


ENCODED = "doc_id long, row long, held_out boolean, symbols binary, n_known long, logs double, inner double, rare array<binary>, times array<int>"


def encoded(docs: DataFrame, of: Vocabulary) -> DataFrame:
    """Rows of ENCODED, one a document: its symbols (2 bytes each) and, of the words that tasks hold, how many are known and the sums of
    log10 of their counts, over all and over those in classes; words that tasks don't hold are listed. `row` tells repeated ids apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = len(of.codes)
        symbols = np.r_[of.symbols, np.arange(OWN, OWN + CLASSES).astype(np.uint16)]
        logs = np.r_[np.log10(of.counts + ADDED), np.zeros(CLASSES)]
        inner = np.where(symbols >= OWN, logs, 0)
        known = np.r_[of.counts > 0, np.zeros(CLASSES, bool)]

        class Codes(dict):
            def __missing__(self, word: bytes) -> int:
                code = hot + class_of(word) - OWN
                if len(self) < hot + MEMORY:
                    self[word] = code
                return code

        code, row = Codes(of.codes), TaskContext.get().partitionId() << 33
        for batch in batches:
            out: list[tuple] = []
            for ident, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                parts, rare = [], Counter()
                for words in pieces(text.as_py()):
                    own = np.fromiter(map(code.__getitem__, words), np.int32, len(words))
                    rare.update(words[i] for i in np.flatnonzero(own >= hot))
                    parts.append(own)
                own = np.concatenate([*parts, [code[END]]]).astype(np.int32)
                out.append((ident, row, held, symbols[own].tobytes(), int(known[own].sum()), float(logs[own].sum()), float(inner[own].sum()), list(rare), list(rare.values())))
                row += 1
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()))
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "row", "held_out", "symbols", "n_known", "logs", "inner", "rare", "times"])

    return docs.select(F.col("doc_id").cast("long"), held_out(), F.col("text").cast("string").cast("binary")).mapInArrow(run, ENCODED)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Parameters, and p, the share of each symbol in training, which noise is drawn by."""

    r: np.ndarray
    q: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    b: np.ndarray
    p: np.ndarray
    slopes: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fresh(cls, p: np.ndarray, seed: int = 1) -> Model:
        """Starts at the unigram model: small vectors, and the log share of each symbol as its bias."""
        rng = np.random.default_rng(seed)
        small = lambda: rng.normal(0, 0.1, (len(p), DIM)).astype(np.float32)
        return cls(small(), small(), np.eye(DIM, dtype=np.float32), np.eye(DIM, dtype=np.float32) / 2, np.log(p).astype(np.float32), p)

    def packed(self) -> np.ndarray:
        """All parameters as rows of 2 DIM + 1 numbers."""
        wide = np.zeros((2 * DIM, 2 * DIM + 1), np.float32)
        wide[:DIM, :DIM], wide[DIM:, :DIM] = self.c1, self.c2
        return np.r_[np.c_[self.r, self.q, self.b], wide]

    def unpacked(self, rows: np.ndarray) -> Model:
        n = len(self.p)
        rows = rows.astype(np.float32)
        return Model(*(np.ascontiguousarray(a) for a in (rows[:n, :DIM], rows[:n, DIM : 2 * DIM], rows[n : n + DIM, :DIM], rows[n + DIM :, :DIM], rows[:n, 2 * DIM])), self.p)

    def learn(self, x1: np.ndarray, x2: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        """One pass in batches, each with one draw of NOISE symbols for all its positions; steps by Adagrad."""
        if not self.slopes:
            self.slopes = [np.ones_like(a) for a in (self.r, self.q, self.c1, self.c2, self.b)]
        sums, lift = np.cumsum(self.p), (np.log(NOISE) + np.log(self.p)).astype(np.float32)
        noise = np.minimum(np.searchsorted(sums, rng.random((-(-len(y) // BATCH), NOISE)) * sums[-1]), len(sums) - 1).astype(np.uint16)
        gr, gq, g1, g2, gb = self.slopes
        for low, drawn in zip(range(0, len(y), BATCH), noise, strict=True):
            a1, a2, t = (z[low : low + BATCH] for z in (x1, x2, y))
            r1, r2, qt, qn = self.r[a1], self.r[a2], self.q[t], self.q[drawn]
            h = r1 @ self.c1 + r2 @ self.c2
            true = sigmoid(np.einsum("ij,ij->i", h, qt) + (self.b - lift)[t]) - 1
            false = sigmoid(h @ qn.T + (self.b - lift)[drawn])
            dh = true[:, None] * qt + false @ qn
            out = np.r_[np.c_[true[:, None] * h, true], np.c_[false.T @ h, false.sum(axis=0)]]
            at, total = self._summed(np.r_[t, drawn], out)
            self._step(self.q, gq, at, total[:, :DIM])
            self._step(self.b, gb, at, total[:, DIM])
            at, total = self._summed(np.r_[a1, a2], np.r_[dh @ self.c1.T, dh @ self.c2.T])
            self._step(self.r, gr, at, total)
            for c, g, r in ((self.c1, g1, r1), (self.c2, g2, r2)):
                self._step(c, g, slice(None), r.T @ dh)

    @staticmethod
    def _summed(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(ids, kind="stable")
        own = ids[order]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        return own[first], np.add.reduceat(rows[order], first, axis=0)

    @staticmethod
    def _step(a: np.ndarray, slopes: np.ndarray, at: np.ndarray | slice, g: np.ndarray) -> None:
        s = slopes[at] + g * g
        slopes[at] = s
        a[at] -= RATE * g / np.sqrt(s)

    def tables(self, rows: int = 256) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What each context gives each symbol (bias in the first), and the log normaliser of every pair of contexts, made some rows at a time."""
        one, two = self.r @ self.c1 @ self.q.T + self.b, self.r @ self.c2 @ self.q.T
        norm = np.empty_like(one)
        m2 = two.max(axis=1, keepdims=True)
        by_two = np.exp(two - m2).T
        for low in range(0, len(one), rows):
            part = one[low : low + rows]
            m1 = part.max(axis=1, keepdims=True)
            norm[low : low + rows] = np.log(np.maximum(np.exp(part - m1) @ by_two, 1e-30)) + m1 + m2.T
        return one, two, norm


def contexts(symbols: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbol before each, and the one before that; before a text are ends."""
    wide = np.r_[np.uint16(end), np.uint16(end), symbols]
    return wide[1:-1], wide[:-2]


def fit(texts: DataFrame, of: Vocabulary) -> Model:
    """Trains on the symbols of all rows of `encoded` that aren't held out, one pass in ROUNDS rounds.

    In a round each task learns from its part of the rows, at least about TASK_TOKENS tokens where there are as many; what tasks give is averaged
    by symbol and tokens, so a round moves one set of parameters a task (some 0.5 MB). Without training tokens the model stays as it starts.
    """
    end = int(of.symbols[of.codes[END]]) if of.codes else 0
    p = of.class_tokens + 0.5
    model = Model.fresh(p / p.sum())
    if not of.tokens:
        return model
    for turn in range(ROUNDS):
        rows = texts.where(~F.col("held_out") & (F.pmod("row", F.lit(ROUNDS)) == turn)).select("symbols").coalesce(max(1, of.tokens // ROUNDS // TASK_TOKENS))
        model = model.unpacked(_averaged(rows, model, end, turn))
    return model


def _averaged(rows: DataFrame, start: Model, end: int, turn: int) -> np.ndarray:
    """Parameters after one round: the means over tasks, weighed by their tokens, in the rows of `packed`."""
    whole = start.packed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = start.unpacked(whole.copy()), 0
        rng = np.random.default_rng([turn, TaskContext.get().partitionId()])
        for batch in batches:
            parts = [np.frombuffer(b.as_py(), np.uint16) for b in batch.column(0)]
            if not parts:
                continue
            x1, x2 = (np.concatenate(z) for z in zip(*(contexts(s, end) for s in parts), strict=True))
            y = np.concatenate(parts)
            order = rng.permutation(len(y))
            own.learn(x1[order], x2[order], y[order], rng)
            seen += len(y)
        if seen:
            out = own.packed()
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel().astype(np.float64)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(out), dtype=np.int32)), pa.array(np.full(len(out), float(seen))), values], names=["i", "w", "v"])

    parts = rows.mapInArrow(run, "i int, w double, v array<double>")
    found = parts.groupBy("i").agg(F.sum("w"), *[F.sum(F.col("w") * F.col("v")[k]) for k in range(whole.shape[1])]).collect()  # one row a symbol
    out = whole.astype(np.float64)
    for r in found:
        out[r[0]] = np.array(r[2:]) / r[1]
    return out


#: The tables of the model last used by this worker.
_made: dict[bytes, tuple] = {}


def made(model: Model) -> tuple:
    key = model.packed().tobytes()
    if key not in _made:
        _made.clear()
        _made[key] = model.tables()
    return _made[key]


def scored(texts: DataFrame, of: Vocabulary, model: Model) -> DataFrame:
    """Rows (doc_id, row, held_out, n_tokens, n_known, logs, score) of `encoded` rows; what rare words add to the last three is left out."""
    end = int(of.symbols[of.codes[END]]) if of.codes else 0
    class_log = of.class_log()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, norm = made(model)
        for batch in batches:
            n, score = [], []
            for data, inner in zip(batch.column(3), batch.column(6).to_pylist(), strict=True):
                y = np.frombuffer(data.as_py(), np.uint16)
                x1, x2 = contexts(y, end)
                logs = one[x1, y].astype(np.float64) + two[x2, y] - norm[x1, x2]
                n.append(len(y))
                score.append(float(logs.sum() / np.log(10) - class_log[y].sum()) + inner)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), batch.column(4), batch.column(5), pa.array(score, pa.float64())], names=["doc_id", "row", "held_out", "n_tokens", "n_known", "logs", "score"])

    return texts.select("doc_id", "row", "held_out", "symbols", "n_known", "logs", "inner").mapInArrow(run, "doc_id long, row long, held_out boolean, n_tokens long, n_known long, logs double, score double")


def rare_words(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows (row, __known, __logs): of the words that tasks don't hold, how many of a document's are known, and the sum of log10 of their counts."""
    pairs = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("t"))
    met = pairs.join(counts.select("word", "c"), "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    return met.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("t")).otherwise(0)).alias("__known"), F.sum(F.col("t") * F.log10(F.col("c") + ADDED)).alias("__logs"))


def scores(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of `docs`.

    Learns from the documents that `held_out` doesn't name and scores all. Null texts are empty: one end, like empty texts. Repeated rows
    each count and are each scored; null ids count as the empty id. Very long texts are read whole, in pieces of PIECE bytes; their symbols
    (2 bytes a token) are held by one task. Other columns are not read. An empty table gives an empty result; without training documents
    the model stays at equal shares.
    """
    bounded_batches(docs.sparkSession)
    counts = stored(word_counts(docs), "lm-counts")
    of = vocabulary(counts)
    texts = stored(encoded(docs, of), "lm-symbols")
    model = fit(texts, of)
    rows = scored(texts, of, model).join(rare_words(texts, counts), "row", "left")
    logs, extra = F.col("logs") + F.coalesce("__logs", F.lit(0.0)), F.coalesce("__logs", F.lit(0.0))
    each = float(np.log10(of.tokens + ADDED * (of.words + 1)))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("__known", F.lit(0))).cast("long").alias("n_known"), F.lit(of.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * each).alias("base_score"), (F.col("score") + extra).alias("score"),
    )
