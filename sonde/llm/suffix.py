"""Exact removal of repeated byte strings by merged Burrows-Wheeler transforms.

1. Every window of LENGTH bytes has an anchor, the least hashed GRAM-byte string inside it (the leftmost of equals).
   Equal windows have equal anchors at equal distances, so repeats are looked for among the neighbourhoods of equal
   anchors only: the bytes of all windows that share one anchor. There are about 2 / (LENGTH - GRAM) anchors a byte.
2. Equal neighbourhoods are counted before anything else; what occurs twice is repeated as a whole and stands in the
   next step once, with its count.
3. Distinct neighbourhoods of one anchor are compared with each other. They are strings over an alphabet of
   SYMBOL-byte blocks (one string for each residue). Shards of them have their own suffix order and transform; the
   shards' transforms are merged by iterative interleave refinement: each pass moves every entry by its
   symbol, stably, so that pass d orders all suffixes by d symbols from the order by d - 1, and carries along where
   the common prefix ends. After LENGTH / SYMBOL passes the intervals left are the strings of LENGTH bytes, and those of
   weight two or more are repeated. Entries alone in their interval leave the refinement.
4. Repeated windows go back to their documents, their bytes are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches, stored, text_key

LENGTH, GRAM = 400, 32
SYMBOL = 50
SHARDS = 4
BATCH = 1 << 20
HOT = 100_000
BLOCK = 1 << 20
_mixed = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = [np.uint64(int(hashlib.md5(bytes([i])).hexdigest()[:16], 16) | 1) for i in range(8)]  # noqa: S324


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on."""
    h = _mixed[data]
    span, k = 1, 0
    while span < GRAM:
        h = h[:-span] * ODD[k] + h[span:]
        h ^= h >> np.uint64(31)
        span, k = 2 * span, k + 1
    h *= ODD[6]
    return h ^ (h >> np.uint64(29))


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Arrays (text, first window, last window, anchor's position, anchor's hash), one entry for each anchor in use."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    starts = np.cumsum(sizes) - sizes
    h = grams(data)
    bits = int(len(h)).bit_length()
    key = (h >> np.uint64(bits)) << np.uint64(bits) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, LENGTH - GRAM + 1
    low = key
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    at = (low & np.uint64((1 << bits) - 1)).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)[: len(at)]
    whole = np.arange(len(at)) + LENGTH <= (starts + sizes)[of]
    w = np.flatnonzero(whole)
    if not len(w):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    cut = np.flatnonzero((np.diff(at[w]) != 0) | (np.diff(w) != 1))
    first, last = w[np.r_[0, cut + 1]], w[np.r_[cut, len(w) - 1]]
    doc = of[first]
    return doc, first - starts[doc], last - starts[doc], at[first] - starts[doc], h[at[first]].view(np.int64)


def suffix_order(symbol: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Positions in the order of their whole symbol strings by prefix doubling; -1 in `after` ends a string, ties by position."""
    rank, step = symbol.astype(np.int64), after.copy()
    while True:
        following = np.where(step >= 0, rank[step] + 1, 0)
        both = rank * (len(rank) + 2) + following
        _, new = np.unique(both, return_inverse=True)
        step = np.where(step >= 0, step[step], -1)
        rank = new.astype(np.int64)
        if (step < 0).all():
            return np.argsort(rank, kind="stable")


def repeated(texts: list[bytes], weights: list[int], shards: int = SHARDS) -> list[np.ndarray]:
    """For each text, which of its windows of LENGTH bytes occur with a weight of two or more over all texts."""
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    h = grams(data)
    reach = SYMBOL - GRAM
    h = h[: len(h) - reach] * ODD[7] + h[reach:]
    of = np.repeat(np.arange(len(texts)), sizes)
    place = np.flatnonzero(np.arange(len(h)) + SYMBOL <= (starts + sizes)[of[: len(h)]])  # where a symbol begins
    _, symbol = np.unique(h[place], return_inverse=True)
    index = np.full(len(data) + SYMBOL, -1)
    index[place] = np.arange(len(place))
    after = index[place + SYMBOL]
    after = np.where((after >= 0) & (of[place] == of[np.minimum(place + SYMBOL, len(data) - 1)]), after, -1)

    # each shard's suffixes in order; the end of a string is a suffix of its own, before all others
    shard = (np.arange(len(texts)) * shards // len(texts))[of[place]]
    edge = np.flatnonzero(np.r_[True, np.diff(shard) != 0, True])
    slots, ends = [], []
    for a, b in zip(edge, edge[1:], strict=False):
        slots.append(a + suffix_order(symbol[a:b], np.where(after[a:b] >= 0, after[a:b] - a, -1)))
        ends.append(a + np.flatnonzero(after[a:b] < 0))
    # the transforms: what stands before each suffix, in each shard's order, and the suffix it leads to
    previous = np.full(len(place), -1)
    previous[after[after >= 0]] = np.flatnonzero(after >= 0)
    entry = np.concatenate([np.concatenate([e, previous[s][previous[s] >= 0]]) for e, s in zip(ends, slots, strict=True)]) if slots else np.zeros(0, np.int64)
    group = np.zeros(len(entry), np.int64)  # shard after shard: as merged as no symbol can tell
    weight = np.asarray(weights)[of[place]]
    for _ in range(LENGTH // SYMBOL):
        if not len(entry):
            break
        order = np.argsort(symbol[entry], kind="stable")
        suffix, g = entry[order], group[order]
        c = symbol[suffix]
        number = np.cumsum(np.r_[False, (c[1:] != c[:-1]) | (g[1:] != g[:-1])])  # common prefixes end where it steps
        alive = (np.bincount(number, weight[suffix]) >= 2)[number]
        suffix, number = suffix[alive], number[alive]
        lead = previous[suffix]
        entry, group = lead[lead >= 0], number[lead >= 0]
    else:
        marked = np.zeros(len(data), bool)
        marked[place[suffix]] = True
        return [marked[s : s + max(0, n - LENGTH + 1)] for s, n in zip(starts, sizes, strict=True)]
    return [np.zeros(max(0, n - LENGTH + 1), bool) for n in sizes]


def runs(mark: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of each run of True."""
    edge = np.flatnonzero(np.diff(np.r_[False, mark, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def of_anchor(members: list[tuple[int, int, bytes]], batch: int = BATCH) -> list[np.ndarray]:
    """Repeated windows of one anchor's neighbourhoods (weight, anchor's offset, bytes) that are too large together.

    Equal windows lie equally far before the anchor, so distances are dealt with a few at a time; strings
    that are equal in that part are joined first.
    """
    out = [np.zeros(len(t) - LENGTH + 1, bool) for _, _, t in members]
    width = 32
    for far in range(0, LENGTH - GRAM + 1, width):
        parts: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, offset, text) in enumerate(members):
            lo, hi = max(0, offset - far - width + 1), min(len(text) - LENGTH, offset - far)
            if lo <= hi:
                parts.setdefault(text[lo : hi + LENGTH] + bytes([hi - lo, offset - lo - far]), []).append((i, lo))
        texts = [t[:-2] for t in parts]
        weights = [sum(members[i][0] for i, _ in own) for own in parts.values()]
        if not texts:
            continue
        if sum(map(len, texts)) > batch:  # too many distinct ones still: windows one by one, by their bytes
            seen: dict[bytes, int] = {}
            for k in range(width):
                seen.clear()
                for t, w in zip(parts, weights, strict=True):
                    at = t[-1] - k
                    if 0 <= at <= t[-2]:
                        key = xxhash.xxh3_128_digest(t[at : at + LENGTH])
                        seen[key] = seen.get(key, 0) + w
                for t, own in parts.items():
                    at = t[-1] - k
                    if 0 <= at <= t[-2] and seen[xxhash.xxh3_128_digest(t[at : at + LENGTH])] >= 2:
                        for i, lo in own:
                            out[i][lo + at] = True
            continue
        for own, mark in zip(parts.values(), repeated(texts, weights), strict=True):
            for i, lo in own:
                out[i][lo : lo + len(mark)] |= mark
    return out


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("__id"), text_key(F.col("text").cast("string")).alias("__key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))


def find_anchors(rows: DataFrame) -> DataFrame:
    """Rows (__id, __key, first, last, offset, anchor, content): the windows first to last share the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(i, t.encode()) for i, t in enumerate(batch.column(2).to_pylist())]
            texts = [(i, t) for i, t in texts if len(t) >= LENGTH]
            a = 0
            while a < len(texts):
                b, held = a, 0
                while b < len(texts) and (b == a or held + len(texts[b][1]) <= BLOCK):
                    held += len(texts[b][1])
                    b += 1
                part = [t for _, t in texts[a:b]]
                doc, first, last, at, h = anchors(part)
                content = [xxhash.xxh3_64_intdigest(part[d][x : y + LENGTH]) for d, x, y in zip(doc.tolist(), first.tolist(), last.tolist(), strict=True)]
                row = pa.array(np.array([i for i, _ in texts[a:b]], np.int64)[doc])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array((at - first).astype(np.int32)), pa.array(h), pa.array(np.array(content, np.uint64).view(np.int64))],
                    names=["__id", "__key", "first", "last", "offset", "anchor", "content"],
                )
                a = b

    return rows.mapInArrow(run, "__id long, __key long, first int, last int, offset int, anchor long, content long")


def neighbourhoods(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (anchor, content, n, offset, bytes) of `wanted` (rep: where one stands), cut from the texts."""
    lists = wanted.select("rep.id", "rep.key", F.struct("anchor", "content", "n", "rep.offset", "rep.first", "rep.last").alias("w")).groupBy(F.col("id").alias("__i"), F.col("key").alias("__k")).agg(F.collect_list("w").alias("w"))
    here = rows.where(F.octet_length("__text") >= LENGTH)
    # rows that repeat an id and text give the same bytes again: one of them is enough
    joined = here.join(lists, here["__id"].eqNullSafe(F.col("__i")) & (here["__key"] == F.col("__k"))).select("__text", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                b = text.encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w[c] for w in own], k) for c, k in (("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int64()), ("offset", pa.int32()))]
                    + [pa.array([b[w["first"] : w["last"] + LENGTH] for w in own], pa.binary())],
                    names=["anchor", "content", "n", "offset", "bytes"],
                )

    return joined.mapInArrow(run, "anchor long, content long, n long, offset int, bytes binary")


RANGES = "anchor long, content long, lo int, hi int"


def compared(parts: DataFrame, batch: int = BATCH) -> DataFrame:
    """Rows (anchor, content, lo, hi): runs of repeated windows among neighbourhoods of equal anchors."""
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def solve(groups: list[dict[int, tuple[int, int, bytes]]]) -> pa.RecordBatch:
        names = [(a, c) for a, own in groups for c in own]
        members = [m for _, own in groups for m in own.values()]
        marks = of_anchor(members, batch) if len(groups) == 1 and sum(len(m[2]) for m in members) > batch else repeated([m[2] for m in members], [m[0] for m in members])
        found = [(a, c, lo, hi) for (a, c), m, mark in zip(names, members, marks, strict=True) if m[0] < 2 for lo, hi in runs(mark)]
        cols = list(zip(*found, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["anchor", "content", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, last = [], 0, None
        for b in batches:
            for anchor, content, weight, offset, text in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                if anchor != last:
                    own = sum(len(m[2]) for m in groups[-1][1].values()) if groups else 0
                    if groups and (held >= batch or own > batch):
                        if own > batch and len(groups) > 1:
                            yield solve(groups[:-1])
                            groups = groups[-1:]
                        yield solve(groups)
                        groups, held = [], 0
                    groups.append((anchor, {}))
                    last = anchor
                if content not in groups[-1][1]:
                    groups[-1][1][content] = (weight, offset, text)
                    held += len(text)
        if groups:
            own = sum(len(m[2]) for m in groups[-1][1].values())
            if own > batch and len(groups) > 1:
                yield solve(groups[:-1])
                groups = groups[-1:]
            yield solve(groups)

    return parts.repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(run, RANGES)


def counted(parts: DataFrame) -> DataFrame:
    """The same for anchors too frequent for one task: window by window, weights summed by the windows' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for anchor, content, weight, _, text in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                n = len(text) - LENGTH + 1
                h = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[i : i + LENGTH]) for i in range(n)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array([anchor] * n), pa.array([content] * n), pa.array(range(n), pa.int32()), pa.array([weight] * n), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["anchor", "content", "lo", "n", "h", "g"])

    windows = parts.dropDuplicates(["anchor", "content"]).mapInArrow(run, "anchor long, content long, lo int, n long, h long, g long")
    twice = windows.groupBy("h", "g").agg(F.sum("n").alias("all")).where("all >= 2")
    return windows.join(twice, ["h", "g"]).where("n < 2").select("anchor", "content", "lo", F.col("lo").alias("hi"))


def repeated_spans(docs: DataFrame, hot: int = HOT, batch: int = BATCH) -> DataFrame:
    """Rows (__id, __key, spans): for each (doc_id, text) with repeats, runs (lo, hi) of repeated windows."""
    bounded_batches(docs.sparkSession)
    rows = keyed(docs)
    found = stored(find_anchors(rows), "anchors")
    again = found.groupBy("anchor").agg(F.count("*").alias("__n"), F.min("content").alias("__a"), F.max("content").alias("__b")).where("`__n` > 1")
    again = stored(again, "anchors-again")  # a join of two plain scans, which can be split where an anchor is frequent
    kept = stored(found.join(again, "anchor").select(*found.columns, (F.col("__a") != F.col("__b")).alias("mixed")), "anchors-twice")
    rep = F.struct(F.col("__id").alias("id"), F.col("__key").alias("key"), "first", "last", "offset")
    sets = stored(kept.groupBy("anchor", "content", "mixed").agg(F.count("*").alias("n"), F.min(rep).alias("rep")), "anchors-sets")
    whole = sets.where("n >= 2").select("anchor", "content", F.lit(0).alias("lo"), (F.col("rep.last") - F.col("rep.first")).alias("hi"))
    parts = neighbourhoods(rows, sets.where("mixed"))
    large = sets.where("mixed").groupBy("anchor").agg(F.count("*").alias("__d")).where(F.col("__d") > hot).select("anchor")
    if large.isEmpty():
        some = compared(parts, batch)
    else:
        parts = stored(parts, "anchors-hot")
        some = compared(parts.join(large, "anchor", "left_anti"), batch).union(counted(parts.join(large, "anchor", "left_semi")))
    marks = whole.union(some)
    spans = kept.join(marks, ["anchor", "content"]).select("__id", "__key", F.struct((F.col("first") + F.col("lo")).alias("lo"), (F.col("first") + F.col("hi")).alias("hi")).alias("s"))
    return spans.groupBy("__id", "__key").agg(F.collect_list("s").alias("spans"))


def suffix_dedup(docs: DataFrame, with_text: bool = False, hot: int = HOT, batch: int = BATCH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]), one for each row of `docs`.

    A byte goes if a string of LENGTH bytes that covers it starts anywhere else too, in the same text or another.
    Null texts count as empty; texts shorter than LENGTH lose nothing. Rows that repeat an id and text count as two
    documents, so both lose what is LENGTH long. What is kept may cut UTF-8 sequences, hence binary. Empty tables
    give empty results; other columns are not read. Hashes of 64 bits stand for anchors, symbols and, within an
    anchor, neighbourhoods.
    """
    spans = repeated_spans(docs, hot, batch)
    rows = keyed(docs)
    right = spans.select(F.col("__id").alias("__i"), F.col("__key").alias("__k"), "spans")
    joined = rows.join(right, rows["__id"].eqNullSafe(F.col("__i")) & (rows["__key"] == F.col("__k")), "left").select("__id", "__text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, count, digest, left = [], [], [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                b = text.encode()
                merged: list[list[int]] = []
                for lo, hi in sorted((s["lo"], s["hi"] + LENGTH) for s in own or ()):
                    if merged and lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                keep, at = [], 0
                for lo, hi in merged:
                    keep.append(b[at:lo])
                    at = hi
                keep.append(b[at:])
                kept = b"".join(keep)
                size.append(len(b))
                gone.append(len(b) - len(kept))
                count.append(len(merged))
                digest.append(hashlib.sha256(kept).hexdigest())
                left.append(kept if with_text else None)
            cols = [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(left, pa.binary())] * with_text, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)
