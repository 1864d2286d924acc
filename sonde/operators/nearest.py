"""The rows most alike to each text, by cosine of TF-IDF over grams: a block-max inverted index of the rows, searched with MaxScore bounds.

The rows are the smaller side (a dictionary). They are weighed in DataFrame functions, cut into shards of about SHARD postings and each
shard goes to the tasks that read the texts; there is one pass over the texts a shard, and nothing of a text is shuffled but its best rows.

In a shard, rows are numbered and cut into blocks of BLOCK. A gram has one entry for each block it occurs in, with the highest weight there.
For a text, the entries' highest weights bound what any row of a block can score: blocks are taken by falling bound, until none can
reach the worst of the best k. Inside a block, entries whose bounds together stay below that worst are non-essential: rows are found by
the other entries, and only those that the rest could still lift are looked up in them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, BLOCK = 1 << 20, 96
#: Bytes of texts whose words are cut together.
CHUNK = 1 << 20


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run, one run after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Index:
    """Entries (block, gram) in order of block, in a block by what postings they spare for their bound; entry e has the postings ends[e]:ends[e + 1] (number in the block, weight) and their highest weight."""

    grams: dict[str, int]
    idf: np.ndarray
    first: np.ndarray  # of each gram, where its entries begin in `entry`, and the end
    entry: np.ndarray
    block: np.ndarray
    gram: np.ndarray
    high: np.ndarray
    ends: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    row_ends: np.ndarray  # by row, grams in order
    row_gram: np.ndarray
    row_weight: np.ndarray
    home: np.ndarray  # whether a gram counts for a text's length in this shard

    @classmethod
    def of(cls, rows: pa.Table, shard: int) -> Index:
        """From rows (grams, idf, weights, home) of lists, in the order of the rows."""
        flat = {c: rows.column(c).combine_chunks() for c in ("grams", "idf", "weights", "home")}
        names, of = np.unique(np.asarray(flat["grams"].flatten(), dtype=object), return_inverse=True) if len(rows) and len(flat["grams"].flatten()) else (np.zeros(0, object), np.zeros(0, np.int64))
        lengths = np.asarray(pc.list_value_length(flat["grams"]))
        row = np.repeat(np.arange(len(rows)), lengths)
        weight = np.asarray(flat["weights"].flatten(), float)
        idf, home = np.zeros(len(names)), np.zeros(len(names), bool)
        idf[of] = np.asarray(flat["idf"].flatten(), float)
        home[of] = np.asarray(flat["home"].flatten()) == shard
        order = np.lexsort((row, of, row // BLOCK))
        g, r, w = of[order], row[order], weight[order]
        new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (r[1:] // BLOCK != r[:-1] // BLOCK)]) if len(g) else np.zeros(0, np.int64)
        sizes, high = np.diff(np.r_[new, len(g)]), np.maximum.reduceat(w, new) if len(new) else w
        spared = np.lexsort((idf[g[new]] * high / sizes, r[new] // BLOCK))
        at = runs(new[spared], sizes[spared])
        gram = g[new[spared]]
        by_gram, by_row = np.argsort(gram, kind="stable"), np.lexsort((of, row))
        return cls(
            {str(n): i for i, n in enumerate(names)}, idf, np.searchsorted(gram[by_gram], np.arange(len(names) + 1)), by_gram, r[new[spared]] // BLOCK, gram, high[spared],
            np.r_[0, np.cumsum(sizes[spared])], r[at] % BLOCK, w[at], np.r_[0, np.cumsum(lengths)], of[by_row], weight[by_row], home,
        )

    def best(self, text: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Numbers and scores of the k rows with the highest products with `text` (a weight for each gram), of those within `slack` of the last too, and how many postings were read."""
        own = np.flatnonzero(text)
        entries = np.sort(self.entry[runs(self.first[own], self.first[own + 1] - self.first[own])])
        gain = text[self.gram[entries]]
        bounds = gain * self.high[entries]
        starts = np.append(0, np.flatnonzero(np.diff(self.block[entries])) + 1)[: len(entries)]
        stops = np.append(starts[1:], len(entries))
        most = np.add.reduceat(bounds, starts) if len(starts) else bounds
        found, scores, worst, read = [], np.zeros(0), 0.0, 0
        for b in np.argsort(-most, kind="stable"):
            if most[b] < worst - slack:
                break
            e, t = entries[starts[b] : stops[b]], gain[starts[b] : stops[b]]
            upto = np.cumsum(bounds[starts[b] : stops[b]])
            cut = int(np.searchsorted(upto, worst - slack))  # entries before it are non-essential
            sums = np.zeros(BLOCK)
            read += self._add(sums, e[cut:], t[cut:], None)
            able = sums > 0
            if cut:
                able &= sums + upto[cut - 1] >= worst - slack
                if not able.any():
                    continue
                read += self._add(sums, e[:cut], t[:cut], able)
            rows = np.flatnonzero(able & (sums >= worst - slack))
            found.append(rows + self.block[e[0]] * BLOCK)
            scores = np.concatenate((scores, sums[rows]))
            if len(scores) >= k:
                worst = max(worst, float(np.partition(scores, -k)[-k]))
        rows = np.concatenate(found) if found else np.zeros(0, np.int64)
        rows = rows[scores >= worst - slack]
        exact = np.array([text[self.row_gram[a:b]] @ self.row_weight[a:b] for a, b in zip(self.row_ends[rows], self.row_ends[rows + 1], strict=True)])
        return rows, exact, read

    def _add(self, sums: np.ndarray, entries: np.ndarray, gain: np.ndarray, able: np.ndarray | None) -> int:
        lengths = self.ends[entries + 1] - self.ends[entries]
        at = runs(self.ends[entries], lengths)
        place, value = self.place[at], np.repeat(gain, lengths) * self.weight[at]
        if able is not None:
            place, value = place[able[place]], value[able[place]]
        sums += np.bincount(place, value, len(sums))
        return len(place)


class Cutter:
    """Finds known grams in many words at once, by a trie over characters: on each level, the edges (node, character) as sorted numbers."""

    def __init__(self, grams: dict[str, int], sizes: tuple[int, int]) -> None:
        grams = {g: i for g, i in grams.items() if sizes[0] <= len(g) <= sizes[1] and " " not in g[1:-1]}
        self.sizes = sizes
        letters = sorted({c for g in grams for c in g})
        self.code = np.zeros(0x110000, np.int32)  # 0: in no gram
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.wide = len(letters) + 1
        nodes = {c: i for i, c in enumerate(letters, 1)}
        at = dict(nodes)
        self.levels = [(np.arange(self.wide), np.array([-1, *[grams.get(c, -1) for c in letters]]))]
        for n in range(2, sizes[1] + 1):
            edges = sorted((at[h[:-1]] * self.wide + nodes[h[-1]], h) for h in {g[:n] for g in grams if len(g) >= n})
            at = {h: i for i, (_, h) in enumerate(edges)}
            self.levels.append((np.array([e for e, _ in edges], np.int64), np.array([grams.get(h, -1) for _, h in edges], np.int64)))

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The known grams of all words, a space on either side, one word after another, and where each word's begin, with the end. No word is empty or has a space."""
        line = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.cumsum(line == 32)[:-1] - 1  # of the gram that begins here
        code = np.append(self.code[line], np.zeros(self.sizes[1], np.int32))
        at = np.flatnonzero(code[: len(word)])
        node = code[at].astype(np.int64)
        owner, gram = [], []
        for n, (edge, own) in enumerate(self.levels, 1):
            if n > 1 and len(edge):
                key = node * self.wide + code[at + n - 1]
                i = np.minimum(np.searchsorted(edge, key), len(edge) - 1)
                known = np.flatnonzero(edge[i] == key)
                at, node = at[known], i[known]
            elif n > 1:
                break
            if n >= self.sizes[0]:
                found = own[node]
                owner.append(word[at[found >= 0]])
                gram.append(found[found >= 0])
        owner, gram = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (owner, gram))
        return gram[np.argsort(owner, kind="stable")].astype(np.int32), np.append(0, np.cumsum(np.bincount(owner, minlength=len(words))))


def counted(texts: pa.Array, cutter: Cutter, most: int = CHUNK) -> Iterator[tuple[int, np.ndarray, int]]:
    """Of each text with a word: its place, its known grams, as often as they occur, and how many grams it has, known or not. Texts are cut together, up to `most` bytes."""
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + most, "right")))
        split = pc.ascii_split_whitespace(pc.fill_null(texts.slice(begin, end - begin), ""))
        flat = split.flatten()
        real = np.asarray(pc.binary_length(flat)) > 0
        ends = np.append(0, np.cumsum(real))[np.append(0, np.cumsum(np.asarray(pc.list_value_length(split))))]
        named = flat.filter(pa.array(real)).dictionary_encode()
        number, lengths = np.asarray(named.indices), np.asarray(pc.utf8_length(named.dictionary), np.int64)
        gram, first = cutter.of(named.dictionary.to_pylist())
        every = sum(np.maximum(0, lengths + 3 - n) for n in range(cutter.sizes[0], cutter.sizes[1] + 1))
        for i in np.flatnonzero(np.diff(ends)):
            own = number[ends[i] : ends[i + 1]]
            yield begin + int(i), gram[runs(first[own], first[own + 1] - first[own])], int(every[own].sum())
        begin = end


def weighed(rows: DataFrame, row: str, text: str, grams: Callable, shards: int) -> DataFrame:
    """Rows (row, shard, grams, idf, weights, home): counts times ln((1 + N) / (1 + df)) + 1, of length one; home is the one shard where a gram counts for the length of texts."""
    n = rows.count()
    own = rows.select(F.col(row).alias("row"), F.explode(grams(F.col(text))).alias("gram")).groupBy("row", "gram").agg(F.count("*").cast("double").alias("tf"))
    own = own.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    idf = own.groupBy("gram").agg((F.log((1 + F.lit(n)) / (1 + F.count("*"))) + 1).alias("idf"), F.min("shard").alias("home"))
    listed = own.join(idf, "gram").groupBy("row", "shard").agg(F.array_sort(F.collect_list(F.struct("gram", "idf", (F.col("tf") * F.col("idf")).alias("w"), "home"))).alias("x"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, e: a + e["w"] * e["w"]))
    return listed.select("row", "shard", F.col("x.gram").alias("grams"), F.col("x.idf").alias("idf"), F.transform("x", lambda e: e["w"] / length).alias("weights"), F.col("x.home").alias("home"))


def alike(queries: DataFrame, query: str, query_text: str, rows: DataFrame, row: str, row_text: str, k: int, places: int, grams: Callable, sizes: tuple[int, int], shard: int = SHARD) -> DataFrame:
    """Rows (query, row, rank, score): for each query the k rows most alike, later rows first among equals.

    `grams` gives the strings of `sizes` characters of a row's text as a column; texts are cut the same way in the tasks. Grams that no row
    has don't count, rows that share none with a text don't appear, nor do null texts. Ids are unique. Scores are rounded to `places`
    so that ties are ties. What the driver and each task hold of the rows is one shard.
    """
    total = rows.select(F.sum(F.size(grams(F.col(row_text))))).first()[0] or 0
    shards = max(1, math.ceil(total / shard))
    kinds = dict(queries.dtypes)[query], dict(rows.dtypes)[row]
    listed = weighed(rows.select(F.col(row), F.col(row_text)), row, row_text, grams, shards)
    texts = queries.select(F.col(query).alias("query"), F.lower(query_text).alias("text"))
    types = queries.select(query).limit(0).toArrow().schema.field(0).type, rows.select(row).limit(0).toArrow().schema.field(0).type

    def answers(part: pa.Table, number: int) -> DataFrame:
        names = part.column("row").to_pylist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index.of(part, number)
            cutter, top = Cutter(index.grams, sizes), float(index.idf.max()) if len(index.idf) else 0.0
            for batch in batches:
                out, ids = [], batch.column(0).to_pylist()
                for i, own, every in counted(batch.column(1), cutter):
                    weights = np.bincount(own, minlength=len(index.idf)) * index.idf
                    length = math.sqrt(float(weights @ weights)) if shards == 1 else top * every  # that of the text, or more
                    found, scores, _ = index.best(weights, k, length * 2 * 10.0**-places)
                    out.append((ids[i], None, float(weights[index.home] @ weights[index.home])))
                    out += [(ids[i], names[r], float(s)) for r, s in zip(found, scores, strict=True)]
                columns = list(zip(*out, strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], types[0]), pa.array(columns[1], types[1]), pa.array(columns[2], pa.float64())], names=["query", "row", "dot"])

        return texts.mapInArrow(run, f"query {kinds[0]}, row {kinds[1]}, dot double")

    found = None
    for number in range(shards):
        part = answers(listed.where(F.col("shard") == number).orderBy("row").drop("shard").toArrow(), number)  # about SHARD postings
        found = part if found is None else found.unionByName(part)
    by_query = Window.partitionBy("query")
    length = F.sqrt(F.sum(F.when(F.col("row").isNull(), F.col("dot"))).over(by_query))
    scored = found.withColumn("score", F.round(F.col("dot") / length, places)).where("row is not null and dot > 0")
    rank = F.row_number().over(by_query.orderBy(F.desc("score"), F.desc("row")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias(query), F.col("row").alias(row), "rank", "score")
