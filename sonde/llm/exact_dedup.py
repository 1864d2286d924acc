"""Exact deduplication with Patricia tries as owners of texts.

Texts are normalised, keyed by byte length and content hash, and each partition inserts the full byte strings
into compressed radix tries whose terminal nodes hold the smallest identifier and the number of rows. Every
map task first runs its rows through a trie of its own, so a group of copies, however large, sends at most one
row a task into the shuffle. A trie over its memory bound spills its largest subtree to an unnamed temporary
file, which is folded in again when the trie is drained.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches

SPACES = re.compile("[\x20\x09-\x0d]+")
TRIE_BYTES = 64 << 20
NODE_BYTES = 300


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner=None) -> None:
        self.label, self.children, self.owner = label, None, owner


def merge(a: tuple, b: tuple) -> tuple:
    """Owners are (smallest id or None, rows); None stands after every id."""
    ids = [x for x in (a[0], b[0]) if x is not None]
    return (min(ids) if ids else None, a[1] + b[1])


class Patricia:
    """Compressed radix trie over byte strings, with a bound on memory."""

    def __init__(self, most: int = TRIE_BYTES) -> None:
        self.most, self.held, self.root = most, 0, Node(b"")
        self.spilled: dict[bytes, object] = {}

    def insert(self, key: bytes, owner: tuple) -> None:
        node, rest = self.root, key
        while True:
            if not rest:
                node.owner = merge(node.owner, owner) if node.owner else owner
                return
            if node.children is None:
                node.children = {}
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, owner)
                self.held += len(rest) + NODE_BYTES
                break
            label = child.label
            if rest.startswith(label):
                node, rest = child, rest[len(label):]
                continue
            lo, hi = 0, min(len(label), len(rest))
            while lo < hi:  # longest common prefix by halving
                mid = (lo + hi + 1) // 2
                if label[:mid] == rest[:mid]:
                    lo = mid
                else:
                    hi = mid - 1
            fork = Node(label[:lo])
            child.label = label[lo:]
            fork.children = {child.label[0]: child}
            node.children[rest[0]] = fork
            self.held += NODE_BYTES
            node, rest = fork, rest[lo:]
        if self.held > self.most:
            self.spill()

    def _walk(self, node: Node, prefix: bytes) -> Iterator[tuple[bytes, tuple]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            full = prefix + node.label
            if node.owner:
                yield full, node.owner
            for child in (node.children or {}).values():
                stack.append((child, full))

    def spill(self) -> None:
        """Move the subtrees below the root, each to the file of its first byte."""
        for first, child in (self.root.children or {}).items():
            f = self.spilled.get(first)
            if f is None:
                f = self.spilled[first] = tempfile.TemporaryFile()  # noqa: SIM115
            for pair in self._walk(child, b""):
                pickle.dump(pair, f)
        self.root.children, self.held = None, 0

    def drain(self) -> Iterator[tuple[bytes, tuple]]:
        """Every string once with its owner; spilled subtrees are rebuilt one at a time."""
        files, self.spilled = self.spilled, {}
        if self.root.owner:
            yield b"", self.root.owner
        kept = self.root.children or {}
        self.root, self.held = Node(b""), 0
        for first, child in kept.items():
            if first not in files:
                yield from self._walk(child, b"")
        for first, f in files.items():
            whole: dict[bytes, tuple] = {}
            f.seek(0)
            # strings of one subtree, split again by digest so that each part fits
            parts = max(1, (f.seek(0, 2) // max(1, self.most)) + 1)
            for part in range(parts):
                f.seek(0)
                whole = {}
                while True:
                    try:
                        key, owner = pickle.load(f)  # noqa: S301  our own file
                    except EOFError:
                        break
                    if parts == 1 or hashlib.sha1(key).digest()[0] * parts // 256 == part:  # noqa: S324
                        whole[key] = merge(whole[key], owner) if key in whole else owner
                if first in kept:
                    for key, owner in self._walk(kept[first], b""):
                        if parts == 1 or hashlib.sha1(key).digest()[0] * parts // 256 == part:  # noqa: S324
                            whole[key] = merge(whole[key], owner) if key in whole else owner
                yield from whole.items()
            f.close()


def owners(docs: DataFrame, trie_bytes: int = TRIE_BYTES, with_text: bool = True) -> DataFrame:
    """Rows (digest, keep_id, group_size, text): each distinct normalised text with its owner; text is null unless asked for."""
    bounded_batches(docs.sparkSession)
    schema = "n int, h long, digest string, text binary, keep_id long, group_size long"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia(trie_bytes)
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                trie.insert(SPACES.sub(" ", t or "").encode(), (i, 1))
            if trie.held > trie_bytes // 2:  # partial: the reduce side sums what is sent twice
                yield from out(trie.drain())
        yield from out(trie.drain())

    def out(pairs: Iterator[tuple[bytes, tuple]], text: bool = True) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        for key, owner in pairs:
            digest = hashlib.sha256(key).digest()
            block.append((len(key), int.from_bytes(digest[:8], "big", signed=True), digest.hex(), key if text else None, *owner))
            held += len(key)
            if held > 4 << 20 or len(block) >= 5000:
                yield made(block)
                block, held = [], 0
        if block:
            yield made(block)

    def made(block: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*block, strict=True))
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["n", "h", "digest", "text", "keep_id", "group_size"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, trie = None, Patricia(trie_bytes)
        done: list[tuple] = []
        held = 0
        for batch in batches:
            for n, h, text, keep_id, size in zip(*(batch.column(c).to_pylist() for c in ("n", "h", "text", "keep_id", "group_size")), strict=True):
                if (n, h) != at:  # sorted: a key's rows stand together, so the trie of the last key is complete
                    for key, owner in trie.drain():
                        done.append((key, owner))
                        held += len(key)
                    at = (n, h)
                    if held > 4 << 20:
                        yield from out(iter(done), with_text)
                        done, held = [], 0
                trie.insert(text, (keep_id, size))
        done.extend(trie.drain())
        yield from out(iter(done), with_text)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(local, schema)
    return small.repartition(parts, "n", "h").sortWithinPartitions("n", "h").mapInArrow(reduce, schema)


def exact_dedup(docs: DataFrame, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Rows (doc_id, keep_id, group_size, kept, text_sha256), one for each row of `docs`.

    Null texts count as empty, so all null, empty and same texts form groups; a text of spaces only is " ".
    keep_id is null only if every row of the group has a null doc_id. Rows that repeat the staying row's
    doc_id and text: one of them is kept. An empty table gives an empty result; other columns are not read.
    """
    # numbered before the join: the join on the digest alone can then be split where a digest is frequent
    alone = Window.partitionBy("doc_id", "text_sha256").orderBy(F.lit(1))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " "), 256).alias("text_sha256"),
    ).withColumn("__first", F.row_number().over(alone) == 1)
    found = owners(docs, trie_bytes, with_text=False).select(F.col("digest").alias("text_sha256"), "keep_id", "group_size")
    return (
        rows.join(found, "text_sha256")
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("__first")).alias("kept"), "text_sha256")
    )


ORACLE_SQL = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size,
  doc_id is not distinct from keep_id and row_number() over (partition by text_sha256, doc_id) = 1 as kept, text_sha256
from d join g using (text_sha256)
"""
