"""Packing documents into sequences by linear grouping and few-size configurations.

Documents are tokenised once, only those longer than a sequence are cut. The plan needs nothing but the
histogram of piece lengths, at most `size` numbers whatever the corpus. Large lengths are put in descending
order into groups of equally many pieces and rounded up to each group's largest; configurations of these few
sizes are chosen by exact subset sums, each used as often as the groups allow; then actual lengths are put in
the places of their groups and the small pieces go best-fit into what the actual lengths leave free. The plan
is kept as runs of like sequences, so its size follows the number of lengths, not of documents. Pieces find
their place by rank within their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches, stored

SIZE, END = 1024, 2
GROUPS = 400
SMALL = 128
RANK_ROWS, MOST_BUCKETS = 1000, 65536


class Encoder:
    """Ids of the byte-level BPE tokenizer.

    Whole texts are encoded through the ranks file, whose merges are the same, one call a text; texts with other scripts
    (whose character classes may differ between the libraries) or special strings go to the tokenizer itself. Nothing is
    remembered between texts: most words that a memory would keep are rare, and it was slower. `memory` has no effect.
    """

    def __init__(self, path: str, ranks: str | None, pattern: str | None, memory: int = 0) -> None:
        import re

        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.other = re.compile("[^\x00-ԯ‐-‧]")
        self.quick = None
        if ranks:
            import base64

            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.quick is None or self.other.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.quick.encode_ordinary(text), "<u4").tobytes()


def pieces(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: str | None = None, with_ids: bool = True, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows (*keep, piece, start, length, ids_crc32[, ids binary]); ids as little-endian unsigned 32-bit numbers.

    `tokenizer`: path on every machine, default the public 50k one. A null or empty text is the end id alone.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer is None:
            import public_tokenizers as public

            encoder = Encoder(str(public.path("byte_bpe_50k.json")), str(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
        else:
            encoder = Encoder(tokenizer, None, None)
        tail = np.array([end], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(len(keep)).to_pylist()):
                whole = encoder.ids(text or "") + tail
                n = len(whole) // 4
                first = n % size or size
                for k, (a, b) in enumerate(zip(range(first - size, n, size), range(first, n + 1, size), strict=False)):
                    a = max(a, 0)
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(whole[4 * a : 4 * b]))
                    if with_ids:
                        ids.append(whole[4 * a : 4 * b])
            took = pa.array(row, pa.int64())
            cols = [c.take(took) for c in batch.columns[: len(keep)]] + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(ids, pa.binary())] if with_ids else []), names=[*keep, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return rows.mapInArrow(run, f"{kinds}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def configuration(sizes: list[int], left: list[int], size: int) -> list[int]:
    """Group numbers of one configuration: the largest size left and the fullest set beside it (exact subset sum)."""
    head = next(g for g, n in enumerate(left) if n)
    room = size - sizes[head]
    reach, before = 1, []
    mask = (1 << (room + 1)) - 1
    for g in range(head, len(sizes)):
        before.append(reach)
        for _ in range(min(left[g] - (g == head), room // sizes[g])):
            more = reach | (reach << sizes[g]) & mask
            if more == reach:
                break
            reach = more
    total, out = reach.bit_length() - 1, [head]
    for g in range(len(sizes) - 1, head - 1, -1):
        while not before[g - head] >> total & 1:
            out.append(g)
            total -= sizes[g]
    return out


def plan(counts: dict[int, int], size: int = SIZE, groups: int = GROUPS, small: int = SMALL) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, first rank, pieces, first sequence, offset) for a histogram of lengths, and the sequences used.

    Pieces first rank + i of that length stand in sequence first sequence + i at the offset.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)  # pieces of a length that have their place
    top = 0
    if counts.get(size):
        runs.append((size, 0, counts[size], 0, 0))
        top = counts[size]
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room: runs (sequences, first)

    large = [(n, counts[n]) for n in sorted(counts, reverse=True) if small < n < size and counts[n]]
    each = max(1, -(-sum(c for _, c in large) // groups))
    members: list[list[list[int]]] = []  # of each group: [length, pieces]
    room = 0
    for n, c in large:
        while c:
            if not room:
                members.append([])
                room = each
            k = min(c, room)
            members[-1].append([n, k])
            c, room = c - k, room - k
    sizes, left = [m[0][0] for m in members], [sum(k for _, k in m) for m in members]
    while any(left):
        config = configuration(sizes, left, size)
        times = min(left[g] // config.count(g) for g in set(config))
        for g in set(config):
            left[g] -= times * config.count(g)
        # actual lengths take the places, the same for a whole run of sequences
        while times:
            need: dict[int, int] = defaultdict(int)
            taken, width = [], times
            for g in config:
                k = need[g]
                need[g] += 1
                taken.append((g, k))
            # each place of a group takes from the group's front; a run ends where the front's length would
            for g, k in need.items():
                width = min(width, max(1, members[g][0][1] // k))
            offset = 0
            for g, _ in taken:
                n = members[g][0][0]
                k = min(width, members[g][0][1])
                runs.append((n, used[n], k, top, offset))
                used[n] += k
                members[g][0][1] -= k
                if not members[g][0][1]:
                    members[g].pop(0)
                offset += n
            free[size - offset].append((width, top))
            top += width
            times -= width

    rooms = sorted(r for r in free if r)
    for n in sorted((n for n in counts if n <= small and counts[n]), reverse=True):
        c = counts[n]
        while c:
            at = bisect_left(rooms, n)
            if at == len(rooms):
                per = size // n
                new = max(1, c // per)
                if not free[size]:
                    insort(rooms, size)
                free[size].append((new, top))
                top += new
                continue
            r = rooms[at]
            m, first = free[r].pop()
            per = min(r // n, c)
            width = min(m, c // per)
            for k in range(per):
                runs.append((n, used[n], width, first, size - r + k * n))
                used[n] += width
            c -= per * width
            if m > width:
                free[r].append((m - width, first + width))
            if not free[r]:
                rooms.pop(at)
            if r - per * n:
                if not free[r - per * n]:
                    insort(rooms, r - per * n)
                free[r - per * n].append((width, first))
    return runs, top


def pack(cut: DataFrame, size: int = SIZE, groups: int = GROUPS, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """`cut` (from pieces, stored) with sequence_id and offset: gapless places from 0 in as few sequences as the plan finds."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    runs, _ = plan(counts, size, groups)
    by: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    for n, rank, k, seq, offset in runs:
        by[n].append((rank, seq, offset))
    tables = {n: tuple(np.array(x, np.int64) for x in zip(*sorted(v), strict=True)) for n, v in by.items()}
    # ranks in two levels, so that a frequent length is many small windows; an array of `size` numbers says how many
    split = [1] * (size + 1)
    for n, c in counts.items():
        split[n] = min(MOST_BUCKETS, -(-c // RANK_ROWS))
    parts = F.get(F.lit(split), F.col("length").cast("int")).cast("long")
    rows = cut.withColumn("__bucket", F.pmod(F.xxhash64(*order[:2]), parts))
    sums = rows.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    ranked = rows.withColumn("__in", F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*order)) - 1).join(base, ["length", "__bucket"])
    ranked = ranked.withColumn("__rank", F.col("__base") + F.col("__in")).select(*cut.columns, "__rank")
    kinds = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes)
    names = cut.columns
    at = names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(at).to_numpy()
            rank = batch.column(batch.num_columns - 1).to_numpy()
            seq, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for n in np.unique(length):
                first, s, o = tables[int(n)]
                own = length == n
                k = np.searchsorted(first, rank[own], "right") - 1
                seq[own], offset[own] = s[k] + rank[own] - first[k], o[k]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    if not counts:
        return cut.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, size: int = SIZE, with_ids: bool = True, tokenizer: str | None = None) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one for each piece of each row.

    Null and empty texts are one piece of the end id. Repeated rows and null ids are packed like any other.
    Empty tables give empty results; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return pack(stored(pieces(rows, size, tokenizer=tokenizer, with_ids=with_ids), "pieces"), size)
