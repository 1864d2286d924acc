"""Secret scans: candidate strings judged by a random forest.

Candidates are long runs of key characters, and what is assigned to a name such as token or password. A forest
over length, character transitions, dictionary coverage, path shape and neighbouring words takes out false
positives. It is trained from labelled findings; without any, from `labelled_findings`, which makes them by rule from a seed.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.llm.common import bounded_batches

# Names that announce a secret, words beside harmless look-alikes, common words, known prefixes.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "auth", "credential", "private_key", "bearer")
HARMLESS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "uuid", "guid", "revision", "example", "sample", "test", "dummy", "placeholder", "id", "path", "file", "url")
COMMON = ("the", "and", "for", "with", "this", "that", "from", "your", "here", "key", "test", "example", "value", "name", "user", "file", "data", "main", "index", "config", "service", "manager", "handler", "request", "response", "change", "default", "public", "string", "number", "token", "secret", "password", "api", "access", "ing", "tion", "ment", "able", "ever", "ich", "que", "eau", "ion", "ado", "ente", "http", "www", "com", "org", "src", "lib", "usr", "local", "home", "image", "static", "class", "function", "return")
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghs_", "glpat-", "sk_live_", "sk-", "xoxb-", "xoxp-", "AIza", "eyJ", "npm_", "hf_")

RUN = re.compile(r"[A-Za-z0-9_\-+/=.]{20,}")
ASSIGNED = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|credential)s?[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"',;]{8,})")
CONTEXT = 48
TREES, DEPTH, FINDINGS = 30, 8, 4000
THRESHOLD = 0.5
_kinds = np.zeros(128, np.int64)  # transitions: other, lower, upper, digit, mark
for _c in range(128):
    _kinds[_c] = 1 if chr(_c).islower() else 2 if chr(_c).isupper() else 3 if chr(_c).isdigit() else 4 if chr(_c) in "_-+/=." else 0
VOWEL = frozenset("aeiouAEIOU")


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans (start, end) to judge, in order and apart: assigned values, then runs with digits among letters or a known prefix."""
    found = [m.span(1) for m in ASSIGNED.finditer(text)] if re.search("[:=]", text) else []
    for m in RUN.finditer(text):
        a, b = m.span()
        while b > a and text[b - 1] in ".-":
            b -= 1
        s = text[a:b]
        mixed = any(c.isdigit() for c in s) and any(c.isalpha() for c in s)
        if b - a >= 20 and (mixed or s.startswith(PREFIXES)):
            found.append((a, b))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def features(text: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    n = len(s)
    kinds = _kinds[np.frombuffer(s.encode("ascii", "replace"), np.uint8) & 127]
    share = np.bincount(kinds, minlength=5) / n
    moves = float((np.diff(kinds) != 0).mean()) if n > 1 else 0.0
    pairs = np.bincount(kinds[:-1] * 5 + kinds[1:], minlength=25) / max(1, n - 1)
    counts = np.unique(list(s), return_counts=True)[1] / n
    entropy = float(-(counts * np.log2(counts)).sum())
    low, covered = s.lower(), bytearray(n)
    for w in COMMON:
        at = low.find(w)
        while at >= 0:
            covered[at : at + len(w)] = b"\1" * len(w)
            at = low.find(w, at + 1)
    left, right = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    near = [w.strip("\"'=:,;()[]") for w in left.split()][-4:]
    return [
        n, *share, moves, pairs[1 * 5 + 3] + pairs[3 * 5 + 1], pairs[1 * 5 + 1], pairs[3 * 5 + 3], pairs[2 * 5 + 1], entropy, entropy / math.log2(max(2, n)),
        sum(covered) / n, sum(c in VOWEL for c in s) / n, len(set(s)), float(bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", s))), float(bool(re.fullmatch("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", s))),
        s.count("/"), s.count("."), s.count("-") + s.count("_"), float(bool(re.search(r"(^|[/.])[a-z]{2,5}$", s)) and "/" in s),
        float(any(x in w for w in near for x in NAMES)), float(any(w in HARMLESS for w in near)), float(any(w.strip("\"'=:,;()[]") in HARMLESS for w in right.split()[:2])),
        float(bool(re.search(r"[:=]\s*[\"']?$", left))), float(s.startswith(PREFIXES)),
    ]


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, int, int, int]]:
    """Findings (text, start, end, 1 for a secret) made by rule: kinds of secrets and of look-alikes in equal parts."""
    r = random.Random(seed)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = lower + lower.upper() + digits
    some = lambda of, k: "".join(r.choices(of, k=k))
    syllables = ("tion", "er", "an", "the", "in", "on", "re", "st", "en", "ou", "ich", "ver", "eau", "que", "ado", "al")
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    secrets = (
        lambda: some("0123456789abcdef", r.choice((32, 40, 48, 64))), lambda: some(mixed, r.randint(24, 64)), lambda: some(mixed + "+/", r.randint(38, 86)) + "=" * r.randint(0, 2),
        lambda: r.choice(PREFIXES[:10]) + some(mixed, r.randint(16, 40)), lambda: some(mixed + "!#%&*", r.randint(12, 20)), lambda: "eyJ" + some(mixed + "_-", 30) + "." + some(mixed + "_-", 60),
    )
    false = (
        lambda: "-".join(word() for _ in range(r.randint(3, 6))) + some(digits, r.randint(1, 4)), lambda: "/".join(word() for _ in range(r.randint(3, 7))) + r.choice((".py", ".txt", ".html", "")) + some(digits, 1),
        lambda: "".join(word().capitalize() for _ in range(r.randint(4, 7))) + some(digits, r.randint(0, 2)), lambda: r.choice(("your", "my", "example", "changeme", "insert")) + "_" + r.choice(("token", "api_key", "secret", "password")) + r.choice(("_here", "_value", "_123")),
        lambda: "x" * r.randint(12, 40), lambda: f"www.{word()}{word()}{r.randint(1, 99)}.example.com/{word()}", lambda: f"20{r.randint(10, 29)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T0{r.randint(0, 9)}.{r.randint(10, 59)}.{r.randint(10, 59)}Z",
        lambda: f"v{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 20)}-{word()}-{word()}.{r.randint(1, 9)}",
    )
    hashes = (lambda: some("0123456789abcdef", r.choice((32, 40, 64))), lambda: "-".join(some("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)))
    out = []
    for i in range(n):
        around = [" ".join(word() for _ in range(r.randint(2, 6))) for _ in range(2)]
        named = r.choice(NAMES[:10]) + r.choice((" = ", ": ", "=", ' = "', ': "'))
        if i % 2:
            s, lead, y = r.choice(secrets)(), named if r.random() < 0.85 else r.choice(("export ", "use ", "with ")) , 1
            if lead[-1] == " " and "=" not in lead and ":" not in lead:
                s = r.choice(PREFIXES[:10]) + some(mixed, 30)
        elif r.random() < 0.3:
            s, lead, y = r.choice(hashes)(), r.choice(("commit ", "sha256: ", "checksum = ", "md5 ", "uuid: ", "id = ", "revision ", "")), 0
        else:
            s, lead, y = r.choice(false)(), named if r.random() < 0.4 else "", 0
        text = f"{around[0]} {lead}{s}" + ('"' if '"' in lead else "") + f" {around[1]}"
        at = len(around[0]) + 1 + len(lead)
        out.append((text, at, at + len(s), y))
    return out


@dataclass
class Forest:
    """Trees as arrays: feature (-1 at a leaf), threshold, left and right child, share of secrets."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def chance(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                f = feature[at]
                inner = f >= 0
                go = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += value[at]
        return total / max(1, len(self.trees))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> Forest:
    """A forest of bootstrap trees; each split looks at a random third of the features, by Gini impurity."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        rows = rng.integers(0, len(x), len(x))
        nodes: list[list[float]] = []

        def split(own: np.ndarray, level: int, nodes: list[list[float]] = nodes) -> int:
            node = len(nodes)
            nodes.append([-1, 0.0, 0, 0, float(y[own].mean())])
            if level == depth or len(own) < 8 or y[own].min() == y[own].max():
                return node
            best = None
            for f in rng.choice(x.shape[1], max(1, x.shape[1] // 3), replace=False):
                order = np.argsort(x[own, f], kind="stable")
                v, t = x[own, f][order], y[own][order]
                ones = np.cumsum(t)[:-1]
                n = np.arange(1, len(v))
                p, q = ones / n, (t.sum() - ones) / (len(v) - n)
                impurity = np.where(v[1:] > v[:-1], n * p * (1 - p) + (len(v) - n) * q * (1 - q), np.inf)
                k = int(impurity.argmin())
                if np.isfinite(impurity[k]) and (best is None or impurity[k] < best[0]):
                    best = (impurity[k], f, (v[k] + v[k + 1]) / 2)
            if best is None:
                return node
            go = x[own, best[1]] <= best[2]
            nodes[node][0], nodes[node][1] = int(best[1]), float(best[2])
            nodes[node][2] = split(own[go], level + 1)
            nodes[node][3] = split(own[~go], level + 1)
            return node

        split(rows, 0)
        a = np.array(nodes)
        out.append((a[:, 0].astype(np.int64), a[:, 1], a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4]))
    return Forest(out)


def fit(findings: list[tuple[str, int, int, int]] | None = None) -> Forest:
    """Train on labelled findings (text, start, end, label)."""
    findings = labelled_findings() if findings is None else findings
    if not findings:
        return Forest([])
    return grow(np.array([features(t, a, b) for t, a, b, _ in findings]), np.array([y for *_, y in findings], float))


def secret_scan(docs: DataFrame, forest: Forest | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, start, length, secret_sha256, score, is_secret), one for each candidate of each row of `docs`.

    Starts and lengths are in characters. Null and empty texts have no candidates; repeated rows and null ids are
    scanned like any other. Very long texts are read whole. A forest of no finding scores 0.
    """
    bounded_batches(docs.sparkSession)
    forest = fit() if forest is None else forest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, digest, x = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for a, b in candidates(text or ""):
                    row.append(i)
                    start.append(a)
                    length.append(b - a)
                    digest.append(hashlib.sha256(text[a:b].encode()).hexdigest())
                    x.append(features(text, a, b))
            score = forest.chance(np.array(x)) if x else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(digest, pa.string()), pa.array(score), pa.array(score >= threshold)],
                names=["doc_id", "start", "length", "secret_sha256", "score", "is_secret"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, start long, length long, secret_sha256 string, score double, is_secret boolean")
