"""Matching blocks of two texts and their similarity, by longest common runs found over named substrings.

A block is the longest run that two ranges share, earliest in the first text, then in the second; what lies before and after it is matched
the same way. Where the second text has COMMON_FROM characters or more, characters that make up more than one in COMMON_SHARE of it don't
start a block, they only lengthen one on either side, or what two ranges without a block begin with is one. Similarity is twice the matched characters over all characters.

For long ranges every substring of 2^k characters has a number (equal substrings, equal numbers), made once for a pair from the numbers of
its halves; two windows of any length are equal if their first and last such substrings are, so the longest length is found by bisection
over sorted numbers. Short ranges are compared character by character in one array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMON_FROM, COMMON_SHARE = 200, 100
#: Pairs of characters up to which two ranges are compared in one array.
SMALL = 1 << 13


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Pair:
    """Two texts, and the numbers of their substrings as far as they have any in common."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = characters(a), characters(b)
        found, at = np.unique(np.r_[self.a, self.b], return_inverse=True)
        rare = np.ones(len(found), bool)
        if len(self.b) >= COMMON_FROM:
            rare = np.bincount(at[len(self.a) :], minlength=len(found)) <= len(self.b) // COMMON_SHARE + 1
        self.rare_a, self.rare_b = rare[at[: len(self.a)]], rare[at[len(self.a) :]]
        self.common = np.r_[0, np.cumsum(~self.rare_a)]
        self.levels = [at]

    def level(self, k: int) -> np.ndarray | None:
        """Numbers of the substrings of 2^k characters of both texts, one after another; None if no such substring is in both."""
        while len(self.levels) <= k and self.levels[-1] is not None:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            n = len(last) - half
            now = None
            if n > 0:
                now = np.unique(last[:n].astype(np.int64) * (int(last.max()) + 1) + last[half:], return_inverse=True)[1]
                one, two = now[: max(0, len(self.a) - 2 * half + 1)], now[len(self.a) :]
                now = now if len(one) and len(two) and np.isin(one, two).any() else None
            self.levels.append(now)
        return self.levels[k] if k < len(self.levels) else None

    def windows(self, n: int, a0: int, a1: int, b0: int, b1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Starts of windows of n rare characters in a0:a1, their numbers, and those of all windows in b0:b1."""
        k = n.bit_length() - 1
        names = self.level(k)
        if names is None:
            return None
        more, wide, off = n - (1 << k), int(names.max()) + 1, len(self.a)
        key = lambda low, high: names[low:high] * wide + names[low + more : high + more] if more else names[low:high]
        starts = np.arange(a0, a1 - n + 1)
        plain = self.common[a0 + n : a1 + 1] == self.common[a0 : a1 - n + 1]
        return starts[plain], key(a0, a1 - n + 1)[plain], key(off + b0, off + b1 - n + 1)

    def longest(self, a0: int, a1: int, b0: int, b1: int, most: int) -> tuple[int, int, int]:
        """(start in a, start in b, length) of the longest shared run of rare characters, at most `most`; length 0 if there is none."""
        most = min(most, a1 - a0, b1 - b0)
        if most <= 0:
            return a0, b0, 0
        if (a1 - a0) * (b1 - b0) <= SMALL:
            return self._small(a0, a1, b0, b1)
        low, high = 0, most
        while low < high:  # double up to a length that isn't shared, then bisect
            n = min(high, 2 * low + 1) if high == most else (low + high + 1) // 2
            got = self.windows(n, a0, a1, b0, b1)
            if got is not None and np.isin(got[1], got[2]).any():
                low = n
            else:
                high = n - 1
        if not low:
            return a0, b0, 0
        starts, one, two = self.windows(low, a0, a1, b0, b1)
        first = int(np.argmax(np.isin(one, two)))
        return int(starts[first]), b0 + int(np.argmax(two == one[first])), low

    def _small(self, a0: int, a1: int, b0: int, b1: int) -> tuple[int, int, int]:
        same = (self.a[a0:a1, None] == self.b[None, b0:b1]) & self.rare_a[a0:a1, None]
        if not same.any():
            return a0, b0, 0
        n, steps = 1, [same]  # steps[k]: where windows of 2^k are equal
        while min(steps[-1].shape) > n:
            last = steps[-1]
            longer = last[:-n, :-n] & last[n:, n:]
            if not longer.any():
                break
            steps.append(longer)
            n *= 2
        now = steps[-1]
        for k in range(len(steps) - 2, -1, -1):  # lengthen by what is left
            other = steps[k]
            rows, cols = min(now.shape[0], other.shape[0] - n), min(now.shape[1], other.shape[1] - n)
            if rows > 0 and cols > 0 and (longer := now[:rows, :cols] & other[n : n + rows, n : n + cols]).any():
                now, n = longer, n + (1 << k)
        i, j = divmod(int(np.argmax(now)), now.shape[1])
        return a0 + i, b0 + j, n

    def blocks(self) -> Iterator[tuple[int, int, int]]:
        """(start in a, start in b, length) of all matching blocks, in no order."""
        left = [(0, len(self.a), 0, len(self.b), min(len(self.a), len(self.b)))]
        while left:
            a0, a1, b0, b1, most = left.pop()
            i, j, n = self.longest(a0, a1, b0, b1, most)
            if not n:  # then what both ranges begin with
                if n := _same(self.a[a0 : min(a1, a0 + b1 - b0)], self.b[b0 : min(b1, b0 + a1 - a0)]):
                    yield a0, b0, n
                continue
            before, after = min(i - a0, j - b0), min(a1 - i - n, b1 - j - n)
            back = _same(self.a[i - before : i][::-1], self.b[j - before : j][::-1])
            on = _same(self.a[i + n : i + n + after], self.b[j + n : j + n + after])
            low_a, low_b, high_a, high_b = i - back, j - back, i + n + on, j + n + on
            yield low_a, low_b, back + n + on
            left += [(a0, low_a, b0, low_b, n), (high_a, a1, high_b, b1, n)]


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many characters are equal from the start."""
    differ = a != b
    return int(np.argmax(differ)) if differ.any() else len(a)


def matched(a: str, b: str) -> int:
    return sum(n for _, _, n in Pair(a, b).blocks()) if a and b else 0


def ratio(a: str, b: str) -> float:
    return 2.0 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0


@F.arrow_udf(T.DoubleType())
def _ratios(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if x is None or y is None else ratio(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("a", "b", "size")])))
def _blocks(a: pa.Array, b: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("size", pa.int32())]))
    rows = [None if x is None or y is None else [dict(zip(("a", "b", "size"), t, strict=True)) for t in sorted(Pair(x, y).blocks())] for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    return pa.array(rows, kind)


def at_most(a: Column, b: Column) -> Column:
    """A bound on the similarity in built-in functions: twice the characters both have, whatever their order, over all characters."""
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    both = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(count(a, c), count(b, c))))
    return F.coalesce(F.try_divide(2.0 * both, F.length(a) + F.length(b)), F.lit(1.0))


def similarity(a: str | Column, b: str | Column, least: float | None = None) -> Column:
    """Similarity of two texts, null if either is null; with `least`, null also where it can't reach that, which built-in functions find out first.

    A pair is compared within one row: memory grows with its characters, time with them and the number of blocks.
    """
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    if least is None:
        return _ratios(a, b)
    lengths = F.coalesce(F.try_divide(2.0 * F.least(F.length(a), F.length(b)), F.length(a) + F.length(b)), F.lit(1.0)) >= least
    able = F.when(lengths, at_most(a, b) >= least).otherwise(False)
    return _ratios(F.when(able, a), F.when(able, b))


def blocks(a: str | Column, b: str | Column) -> Column:
    """The matching blocks as an array of (a, b, size), in order: starts from 0 in either text."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return _blocks(a, b)
