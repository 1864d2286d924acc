"""SimHash near-duplicates, candidates filtered by pigeonring chains.

Fingerprints of 64 bits are cut into SEGMENTS on a ring. If two differ in at most `most` bits, some chain of
consecutive segments keeps every running sum of differences within its share of the budget: the first j
segments together differ in at most floor(j * most / SEGMENTS) bits. With most < SEGMENTS the first segment
is then equal and the next differs in at most one bit, so one of its halves is equal too. Each distinct
fingerprint is filed under (start, half, first segment, that half), pairs that share a file go through the
whole chain condition, and what is left through the Hamming check. Files send on a spanning forest of their
links, never all pairs; files too large for that are cut again by their varying bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches, components, stored, text_key

SEED, WORDS, MOST, SEGMENTS = 42, 4, 4, 5
DENSE = 2048
#: near_dedup: shingles are counted in at most COUNTED texts, at most COMMON counts are kept; pairs of one node checked by one
#: task: HOT; texts of a crowd in a block: BLOCK; pairs a text sends before all are sent: ROUNDS; pairs looked at at once: PAIRS;
#: rows of a list that a task holds: PART.
COUNTED, COMMON, HOT = 16384, 1 << 17, 256
BLOCK, ROUNDS, PAIRS, PART = 2048, (2,), 1 << 17, 1 << 20
#: Rounding allowed for where a filter compares sizes; it only lets more through.
SLACK = 1e-6
#: Bytes of text whose shingle sets a worker holds.
PIECE = 1 << 20
#: 64-bit numbers of a set's parity bits.
PARITY = 16
BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def remixed(h: np.ndarray, turn: int) -> np.ndarray:
    """Other 64-bit hashes of the same shingles for each turn; turn 0 leaves them."""
    if not turn:
        return h
    h = h + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prints_of(text: bytes, words: int = WORDS, turns: int = 1) -> np.ndarray:
    """Majority bits of XXH64 over the text's word shingles, repeats included, for each turn; 0 without a word."""
    own = text.translate(LOWER).split()
    if not own:
        return np.zeros(turns, np.uint64)
    shingles = map(b" ".join, zip(*(own[k:] for k in range(words)), strict=False)) if len(own) >= words else iter([b" ".join(own)])
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    out = np.zeros(turns, np.uint64)
    for turn in range(turns):
        by = np.bincount((remixed(h, turn).view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256, dtype=np.int64)).ravel(), minlength=2048).reshape(8, 256)
        ones = (by @ BITS).ravel() * 2 > len(h)
        out[turn] = np.packbits(ones, bitorder="little").view(np.uint64)[0]
    return out


def fingerprint(text: bytes, words: int = WORDS) -> int:
    return int(prints_of(text, words)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, keep: tuple[str, ...] = ("doc_id",), turns: int | None = None) -> DataFrame:
    """Rows (*keep, fp long): the fingerprint of each row's text as a signed 64-bit number; with turns, fp is an array of so many."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [prints_of((t or "").encode(), words, turns or 1) for t in batch.column(len(keep)).to_pylist()]
            fp = pa.array(np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64))
            if turns:
                fp = pa.ListArray.from_arrays(pa.array(np.arange(0, len(fp) + 1, turns, dtype=np.int32)), fp)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], fp], names=[*keep, "fp"])

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{kinds}, fp {'array<long>' if turns else 'long'}")


def bounds(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    cut = [64 * i // segments for i in range(segments + 1)]
    return list(zip(cut, cut[1:], strict=False))


def field(fp: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return (fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)


def filed(fp: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """For each fingerprint its 2 * segments file numbers: an equal segment and half of the next one on the ring."""
    ring, out = bounds(segments), []
    for i, (lo, hi) in enumerate(ring):
        nlo, nhi = ring[(i + 1) % segments]
        mid = (nlo + nhi) // 2
        for half, (a, b) in enumerate(((nlo, mid), (mid, nhi))):
            out.append(((np.uint64(2 * i + half) << np.uint64(32)) | (field(fp, lo, hi) << np.uint64(8)) | field(fp, a, b)).astype(np.int64))
    return np.stack(out, axis=1)


def chained(x: np.ndarray, most: int = MOST, segments: int = SEGMENTS) -> np.ndarray:
    """Whether some start on the ring keeps all its running sums of differing bits within their shares."""
    d = np.stack([np.bitwise_count(field(x, lo, hi)) for lo, hi in bounds(segments)]).astype(np.int64)
    any_start = np.zeros(x.shape, bool)
    for i in range(segments):
        run, fits = np.zeros(x.shape, np.int64), np.ones(x.shape, bool)
        for j in range(segments):
            run = run + d[(i + j) % segments]
            fits &= run * segments <= (j + 1) * most
        any_start |= fits
    return any_start


def linked(x: np.ndarray, most: int = MOST) -> np.ndarray:
    """Indices of the differences x that are links: chain condition first, then the full count."""
    some = np.flatnonzero(chained(x, most))
    return some[np.bitwise_count(x[some]) <= most]


def forest(fp: np.ndarray, most: int = MOST) -> list[tuple[int, int]]:
    """Links that join all linked members of one file; fp distinct."""
    parent: dict[int, int] = {}

    def root(a: int) -> int:
        while parent.setdefault(a, a) != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    out, stack = [], [fp]
    while stack:
        part = stack.pop()
        varying = int(np.bitwise_or.reduce(part ^ part[0])) if len(part) else 0
        where = [b for b in range(64) if varying >> b & 1]
        if len(part) > DENSE and len(where) > most + 1:
            cut = [len(where) * i // (most + 1) for i in range(most + 2)]
            for a, b in zip(cut, cut[1:], strict=False):  # one of most + 1 sets of bits is equal in any link
                value = part & np.uint64(sum(1 << w for w in where[a:b]))
                order = np.argsort(value, kind="stable")
                ends = np.flatnonzero(np.diff(value[order])) + 1
                stack += [s for s in np.split(part[order], ends) if len(s) > 1]
            continue
        for i in range(len(part) - 1):
            for j in linked(part[i] ^ part[i + 1 :], most):
                a, b = int(part[i]), int(part[i + 1 + j])
                ra, rb = root(a), root(b)
                if ra != rb:
                    parent[ra] = rb
                    out.append((a, b))
    return out


def links(distinct: DataFrame, most: int = MOST, segments: int = SEGMENTS) -> DataFrame:
    """Rows (a, b): for every file of `distinct`, links that connect all its linked members.

    `distinct` has fp long, and a and b are such; or turn int, fp long and node long, distinct by turn and fp, and a and b
    are nodes whose fingerprints of one turn are linked.
    """
    if most >= segments:
        raise ValueError("more segments than differing bits are needed")
    if "node" not in distinct.columns:
        distinct = distinct.select(F.lit(0).alias("turn"), "fp", F.col("fp").alias("node"))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn, fp, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            keys = filed(fp.view(np.uint64), segments) + (turn.astype(np.int64) * 2 * segments << 32)[:, None]
            many = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fp, many)), pa.array(np.repeat(node, many))], names=["key", "fp", "node"])

    def pairs(keys: np.ndarray, fp: np.ndarray, node: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        starts = np.r_[0, np.flatnonzero(np.diff(keys)) + 1, len(keys)]
        sizes = np.diff(starts)
        for s in np.flatnonzero(sizes > 16):
            of, names = fp[starts[s] : starts[s + 1]], node[starts[s] : starts[s + 1]]
            own = forest(of, most)
            if own:
                order = np.argsort(of)
                at = order[np.searchsorted(of, np.array(own, np.uint64), sorter=order)]
                yield names[at[:, 0]], names[at[:, 1]]
        small = np.repeat(sizes <= 16, sizes)
        for d in range(1, 16):
            i = np.flatnonzero((keys[d:] == keys[:-d]) & small[d:]) if len(keys) > d else np.zeros(0, int)
            if not len(i):
                break
            hit = i[linked(fp[i] ^ fp[i + d], most)]
            yield node[hit], node[hit + d]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fp, node = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out(*own: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a, b in pairs(*own):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            more = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            keys, fp, node = np.concatenate([keys, more[0]]), np.concatenate([fp, more[1].view(np.uint64)]), np.concatenate([node, more[2]])
            if len(keys) > 100_000 and keys[0] != keys[-1]:  # all but the last file are complete
                end = int(np.searchsorted(keys, keys[-1], "left"))
                yield from out(keys[:end], fp[:end], node[:end])
                keys, fp, node = keys[end:], fp[end:], node[end:]
        yield from out(keys, fp, node)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = distinct.select("turn", "fp", "node").mapInArrow(file, "key long, fp long, node long")
    return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(join, "a long, b long")


def simhash_components(docs: DataFrame, most: int = MOST, words: int = WORDS) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of `docs`.

    Null and empty texts have fingerprint zero and link like any other. component_id is the smallest non-null
    doc_id reachable, null if there is none. Repeated rows and equal texts share a fingerprint. Empty tables
    give empty results; other columns are not read.
    """
    rows = stored(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), words), "simhash")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = components(links(least.select("fp"), most)).withColumnRenamed("node", "fp")
    reach = least.join(nodes, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    ids = reach.groupBy("root").agg(F.min("least").alias("component_id"))
    of = reach.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, most: int = MOST, words: int = WORDS) -> DataFrame:
    """The rows of `docs`, columns unchanged, of which one of each component of linked fingerprints stays, as `simhash_components` joins them.

    The row with the smallest doc_id stays, null ids last; of rows that repeat an id, the one with the smaller text key; of rows
    that repeat both, any one. Null and empty texts have fingerprint zero. Texts are told apart by 128 bits of hash and move once, at last.
    """
    names = docs.columns
    own = [f"__c{i}" for i in range(len(names))]  # extra columns may have any name
    text = F.col(own[names.index("text")]).cast("string")
    place = ["no", "id", "key", "other"]
    ident = F.col(own[names.index("doc_id")]).cast("long")
    at = {"no": ident.isNull(), "id": F.coalesce(ident, F.lit(0)), "key": text_key(text), "other": F.xxhash64(F.lit(1), F.coalesce(text, F.lit("")))}
    rows = docs.toDF(*own).withColumns(at)
    prints = stored(fingerprints(rows.withColumn("text", text), words, tuple(place)), "simhash")
    nodes = components(links(prints.select("fp").distinct(), most)).withColumnRenamed("node", "fp")
    least = prints.groupBy("fp").agg(F.min(F.struct(*place)).alias("p"))
    stay = least.join(nodes, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("p").alias("p")).select("p.*")
    first = F.row_number().over(Window.partitionBy(*place).orderBy(F.lit(0)))
    return rows.join(stay, place, "left_semi").withColumn("__n", first).where("`__n` = 1").select(*own).toDF(*names)


def shingles(text: str | None, words: int) -> np.ndarray:
    """64-bit hashes of the different word shingles of a text; without a word, of one empty shingle."""
    own = (text or "").encode().translate(LOWER).split()
    cut = {b" ".join(own[k : k + words]) for k in range(max(len(own) - words, 0) + 1)}
    return np.fromiter(map(xxhash.xxh64_intdigest, cut), np.uint64, len(cut)).view(np.int64)


def over_sets(texts: DataFrame, words: int, make, kinds: str) -> DataFrame:
    """`make` over the shingle sets of rows (node, text): it gets nodes, sizes and all hashes one after another, and returns columns.

    A worker holds the sets of about PIECE bytes of text, or of one text.
    """
    bounded_batches(texts.sparkSession)
    names = [k.split()[0] for k in kinds.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(nodes: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
            n = np.array([len(x) for x in sets], np.int64)
            columns = make(np.array(nodes, np.int64), n, np.concatenate(sets))
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

        for batch in batches:
            nodes, sets, held = [], [], 0
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                nodes.append(node)
                sets.append(shingles(text, words))
                held += len(text or "")
                if held > PIECE:
                    yield out(nodes, sets)
                    nodes, sets, held = [], [], 0
            if nodes:
                yield out(nodes, sets)

    return texts.select("node", F.col("text").cast("string")).mapInArrow(run, kinds)


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """Rows (node long, own array<long>): the shingle set of each row (node, text)."""

    def make(node: np.ndarray, n: np.ndarray, h: np.ndarray) -> tuple:
        return node, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(h))

    return over_sets(texts, words, make, "node long, own array<long>")


def similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have a Jaccard similarity of `least` or more.

    A node that many pairs name as b is dealt over one partition key for each HOT of them.
    """
    share = pairs.groupBy("b").agg(F.ceil(F.count("*") / HOT).cast("int").alias("shares"))
    dealt = pairs.join(share, "b").withColumn("salt", F.pmod(F.hash("a"), F.col("shares")))
    right = share.join(sets.withColumnRenamed("node", "b").withColumnRenamed("own", "other"), "b").select("b", "other", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("salt"))
    both = dealt.join(sets.withColumnRenamed("node", "a"), "a").join(right, ["b", "salt"])
    shared = F.size(F.array_intersect("own", "other"))
    return both.where(shared >= least * (F.size("own") + F.size("other") - shared)).select("a", "b")


def common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that several of the rows (node, text) hold, sorted, and how many do; the COMMON most frequent at most."""
    every = over_sets(texts, words, lambda node, n, h: (h,), "h long")
    counts = stored(every.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "near-counts")
    least, room = 2, COMMON
    for n, many in sorted((tuple(r) for r in counts.groupBy("n").count().collect()), reverse=True):
        room -= many
        if room < 0:
            least = n + 1
            break
    kept = counts.where(F.col("n") >= least).toArrow()
    h, n = (kept.column(c).to_numpy() for c in ("h", "n"))
    order = np.argsort(h)
    return h[order], n[order]


def prefixes(texts: DataFrame, words: int, common: tuple[np.ndarray, np.ndarray], least: float) -> DataFrame:
    """Rows (key, size, node) of rows (node, text): each set's first shingles in one order for all, those not in `common` first.

    Sets of n and m >= n shingles with a Jaccard similarity of `least` share at least least * m of them, and at least
    2 * least / (1 + least) * n. So one of the longer set's first m - least * m + 1 is among the shorter one's
    first n - 2 * least / (1 + least) * n + 1, whatever the order is. `size` is twice the set's size, odd beyond that second bound.
    """
    known, often = common

    def make(node: np.ndarray, n: np.ndarray, h: np.ndarray) -> tuple:
        of = np.repeat(np.arange(len(n)), n)
        rank = np.zeros(len(h), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            rank = np.where(known[at] == h, often[at], 0)
        order = np.lexsort((h, rank, of))
        place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        outer = n - np.ceil(least * n - SLACK).astype(np.int64) + 1
        inner = n - np.ceil(2 * least / (1 + least) * n - SLACK).astype(np.int64) + 1
        first = np.flatnonzero(place < outer[of])
        size = 2 * n[of[first]] + (place[first] >= inner[of[first]])
        return h[order[first]], size, node[of[first]]

    return over_sets(texts, words, make, "key long, size long, node long")


def by_key(rows: DataFrame, run, kinds: str, once: bool = True) -> DataFrame:
    """`run` over lists of rows (key, size, node, ...) of one key, by size: each call gets columns of complete lists and yields columns.

    With `once`, of rows that repeat a node in a list one counts, and a list of over PART rows comes in parts; `run` gets its key too.
    """
    names = [k.split()[0] for k in kinds.split(", ")]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = None  # key of a list that comes in parts

        def out(own: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if once:
                new = np.r_[True, (own[0][1:] != own[0][:-1]) | (own[2][1:] != own[2][:-1])]
                own = [*(c[new] for c in own), cut]
            for columns in run(*own):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        held: list[list[np.ndarray]] = []
        many = 0
        for batch in batches:
            more = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(more[0]):
                continue
            held.append(more)
            many += len(more[0])
            if many > 100_000 and held[0][0][0] != more[0][-1]:  # all but the last list are complete
                own = [np.concatenate(c) for c in zip(*held, strict=True)]
                end = int(np.searchsorted(own[0], own[0][-1], "left"))
                yield from out([c[:end] for c in own])
                held, many = [[c[end:] for c in own]], len(own[0]) - end
            elif once and many > PART:
                own = [np.concatenate(c) for c in zip(*held, strict=True)]
                cut = own[0][-1]  # the last list may go on
                yield from out(own)
                held, many = [], 0
        if many:
            yield from out([np.concatenate(c) for c in zip(*held, strict=True)])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key").sortWithinPartitions("key", "size", "node").mapInArrow(join, kinds)


def listed(rows: DataFrame, least: float) -> DataFrame:
    """Rows (crowd, key, a, b) from `prefixes`: pairs (a, b) to check, b the smaller set, and of crowds also their members.

    Lists of two texts send their pair if it can reach `least`. Larger ones, crowds, send each member with one no larger
    than it, a leader, and their members (key, a the node, b the size), for `apart`: two rows a member at most. Parts of one
    list have leaders of their own; `apart` sees it whole.
    """

    def run(key: np.ndarray, size: np.ndarray, node: np.ndarray, cut: int | None) -> Iterator[tuple[np.ndarray, ...]]:
        starts = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)]
        sizes = np.diff(starts)
        sizes = np.where(key[starts[:-1]] == cut, np.maximum(3, sizes), sizes) if cut is not None else sizes
        n, inner = size >> 1, size & 1 == 0
        i = starts[:-1][sizes == 2]
        i = i[inner[i] & (n[i] >= least * n[i + 1] - SLACK)]
        a, b = node[i + 1], node[i]
        swap = (n[i] == n[i + 1]) & (a < b)
        yield np.zeros(len(i), bool), key[i], np.where(swap, b, a), np.where(swap, a, b)
        members = np.flatnonzero(np.repeat(sizes > 2, np.diff(starts)))
        yield np.ones(len(members), bool), key[members], node[members], size[members]
        todo = members
        while len(todo):  # the next leader of every crowd at once; it takes those that its size allows
            first = np.r_[True, key[todo][1:] != key[todo][:-1]]
            lead = todo[first][np.cumsum(first) - 1]
            own = n[todo] <= (n[lead] + SLACK) / least
            a, b = todo[own & ~first], lead[own & ~first]
            yield np.zeros(len(a), bool), key[a], node[a], node[b]
            todo = todo[~own]

    return by_key(rows, run, "crowd boolean, key long, a long, b long")


def parities(texts: DataFrame, words: int) -> DataFrame:
    """Rows (node, n, p0, p1, ...) of rows (node, text): the set's size, and for each of 64 * PARITY classes of hashes whether it has an odd number of them.

    Sets with d shingles not in both differ in at most d of these bits.
    """
    width = 64 * PARITY

    def make(node: np.ndarray, n: np.ndarray, h: np.ndarray) -> tuple:
        at = np.repeat(np.arange(len(n)) * width, n) + (h & (width - 1))
        bits = np.bincount(at, minlength=len(n) * width).reshape(len(n), width) & 1
        parts = np.packbits(bits.astype(bool), axis=1, bitorder="little").view(np.int64)
        return node, n, *np.ascontiguousarray(parts.T)

    return over_sets(texts, words, make, "node long, n long, " + ", ".join(f"p{k} long" for k in range(PARITY)))


def possible(pairs: DataFrame, parity: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose sizes and parities (of `parities`) allow a Jaccard similarity of `least`.

    A node that many pairs name as b is dealt over one partition key for each HOT of them.
    """
    words = [f"p{k}" for k in range(PARITY)]
    share = pairs.groupBy("b").agg(F.ceil(F.count("*") / HOT).cast("int").alias("shares"))
    dealt = pairs.join(share, "b").withColumn("salt", F.pmod(F.hash("a"), F.col("shares")))
    left = parity.select(F.col("node").alias("a"), F.col("n").alias("na"), *[F.col(w).alias(f"a{w}") for w in words])
    right = share.join(parity.withColumnRenamed("node", "b"), "b").select("b", "n", *words, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("salt"))
    unlike = sum((F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(w))) for w in words), F.lit(0))
    most = (F.col("n") + F.col("na")) * ((1 - least) / (1 + least)) + SLACK
    return dealt.join(left, "a").join(right, ["b", "salt"]).where(unlike <= most).select("a", "b")


def apart(crowds: DataFrame, parity: DataFrame, least: float, nearest: int | None = None) -> DataFrame:
    """Rows (a, b), b the smaller set: pairs within a crowd that differ in root and can reach `least` by their sizes and parities.

    `crowds` has rows (key, size, node, root). With `nearest`, each text sends only so many pairs of each BLOCK others, those of
    the least unlike parities. Crowds of one root are done; texts of a crowd's largest root meet only the others. A crowd is
    dealt in blocks of about BLOCK texts, every block of the others against every block of all, so that no task holds a whole one.
    """
    words = [f"p{k}" for k in range(PARITY)]
    by_root = crowds.groupBy("key", "root").agg(F.count("*").alias("c"))
    per = by_root.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    per = per.select("key", F.col("top.root").alias("top"), blocks(F.col("all") - F.col("top.c")).alias("others"), blocks(F.col("all")).alias("whole"))
    rows = crowds.join(per, "key").withColumn("other", F.col("root") != F.col("top")).join(parity.drop("n"), "node")
    share = lambda n: F.pmod(F.xxhash64(F.lit(1), "node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("other").select("*", F.lit(1).alias("side"), share("others").alias("l"), every("whole").alias("r"))
    right = rows.select("*", F.lit(0).alias("side"), every("others").alias("l"), share("whole").alias("r"))
    dealt = left.unionByName(right).select(F.xxhash64("key", "l", "r").alias("key"), "size", "node", "root", "side", F.col("other").cast("int").alias("other"), *words)

    def run(key: np.ndarray, size: np.ndarray, node: np.ndarray, root: np.ndarray, side: np.ndarray, other: np.ndarray, *parity: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        bits = np.stack(parity, axis=1).view(np.uint64)  # bitwise_count takes signed numbers by their absolute value
        n, inner = size >> 1, size & 1 == 0
        group = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        lefts, rights = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        count = np.bincount(group[rights], minlength=int(group[-1]) + 1)
        start = np.cumsum(count) - count  # of a group's texts in `rights`
        meets = count[group[lefts]]
        upto = np.cumsum(meets)
        at = 0
        while at < len(lefts):  # some texts of the left against all of their group's right
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, "right")))
            i = np.repeat(lefts[at:end], meets[at:end])
            first = np.cumsum(meets[at:end]) - meets[at:end]
            j = rights[np.repeat(start[group[lefts[at:end]]], meets[at:end]) + np.arange(len(i)) - np.repeat(first, meets[at:end])]
            at = end
            up = (n[j] > n[i]) | ((n[j] == n[i]) & (node[j] > node[i]))
            fits = (root[j] != root[i]) & (np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j]) - SLACK) & np.where(up, inner[i], inner[j])
            if nearest is None:  # a pair of others meets twice
                fits &= (other[j] == 0) | (node[j] > node[i])
            i, j, up = i[fits], j[fits], up[fits]
            both = n[j] + n[i]
            unlike = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(unlike <= both * ((1 - least) / (1 + least)) + SLACK)
            if nearest is not None:
                near = near[np.lexsort((unlike[near] / np.maximum(1, both[near]), i[near]))]
                new = np.r_[True, i[near][1:] != i[near][:-1]][: len(near)]
                place = np.arange(len(near)) - np.maximum.accumulate(np.where(new, np.arange(len(near)), 0))
                near = near[place < nearest]
            i, j, up = i[near], j[near], up[near]
            yield np.where(up, node[j], node[i]), np.where(up, node[i], node[j])

    return by_key(dealt, run, "a long, b long", once=False)


def near_dedup(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of `docs`, columns unchanged, of which one of each group of near copies stays.

    Near copies share `least` of their `words`-word shingles (Jaccard, each shingle once); groups are the components of
    all such pairs. Every pair that reaches `least` shares a shingle among the first of both sets (`prefixes`), in an order that
    puts shingles common in a sample of texts last; the sample decides how many pairs are checked, not which are found. Pairs
    whose parities allow it are checked by their whole sets. In crowds each text is first checked against a leader,
    then against the most alike that the checked pairs have not joined it with, a few at a time, at last against all such.

    The row with the smallest doc_id stays, null ids last; of rows that repeat an id, the one with the smaller text
    key; of rows that repeat both, any one. Null and empty texts are copies of each other. Texts are told apart by 128 bits of hash.
    """
    names = docs.columns
    own = [f"__c{i}" for i in range(len(names))]  # extra columns may have any name
    text = F.col(own[names.index("text")]).cast("string")
    other = F.xxhash64(F.lit(1), F.coalesce(text, F.lit("")))
    rows = docs.toDF(*own).withColumns({"key": text_key(text), "other": other, "id": F.col(own[names.index("doc_id")]).cast("long")})
    first = F.row_number().over(Window.partitionBy("key", "other").orderBy(F.col("id").asc_nulls_last()))
    # whole texts move once, to one row for each different text; map tasks first drop their own copies. Nodes are numbered as they are stored
    nodes = stored(rows.withColumn("__n", first).where("`__n` = 1").drop("__n").withColumn("node", F.monotonically_increasing_id()), "near-texts")
    texts = nodes.select("node", text.alias("text"))

    share = -(-nodes.count() // COUNTED)
    common = common_shingles(nodes.where(F.pmod("key", F.lit(max(1, share))) == 0).select("node", text.alias("text")), words)
    lists = stored(listed(prefixes(texts, words, common, least), least), "near-lists")
    parity = stored(parities(texts, words), "near-parities")
    pairs = lists.where("not crowd and a <> b").select("a", "b").distinct()
    pairs = stored(possible(stored(pairs, "near-pairs"), parity, least), "near-possible")
    found = stored(similar(pairs, sets_of(texts, pairs, words), least), "near-found")
    groups = components(found)
    crowds = lists.where("crowd").select("key", F.col("b").alias("size"), F.col("a").alias("node"))
    for nearest in (*ROUNDS, None):
        joined = crowds.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        rest = stored(apart(joined, parity, least, nearest).distinct(), "near-rest")
        if rest.isEmpty():  # nor is there a pair for a later round
            break
        found = stored(similar(rest, sets_of(texts, rest, words), least), "near-found")
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found))
    place = F.struct(F.col("id").isNull().alias("no"), "id", "key", "other", "node")
    stay = nodes.select("id", "key", "other", "node").join(groups, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min(place).alias("p")).select(F.col("p.node").alias("node"))
    return nodes.join(stay, "node", "left_semi").select(*own).toDF(*names)


def sets_of(texts: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Shingle sets (`shingle_sets`) of those of the rows (node, text) that the pairs (a, b) name."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return shingle_sets(texts.join(ends, "node", "left_semi"), words)
