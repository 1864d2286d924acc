import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.operators import matching
from sonde.plans import catalog

SF = "/root/testdata/sf0.001"


def brute(a, b):
    return [tuple(m) for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks()][:-1]


def joined(blocks):
    """Blocks in order, those that touch in both texts as one."""
    out = []
    for i, j, n in sorted(blocks):
        if out and (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]) == (i, j):
            out[-1] = (*out[-1][:2], out[-1][2] + n)
        else:
            out.append((i, j, n))
    return out


def edited(rng, text, alphabet, share):
    out = [c for c in text if rng.random() > share]
    for _ in range(int(len(text) * share)):
        out.insert(rng.randrange(len(out) + 1), rng.choice(alphabet))
    return "".join(out)


@pytest.mark.parametrize("small", [matching.SMALL, 0])
def test_blocks_equal_brute_force(small, monkeypatch):
    """Short and long texts of few and many different characters, whichever way ranges are compared."""
    monkeypatch.setattr(matching, "SMALL", small)
    rng = random.Random(5)
    for _ in range(250):
        alphabet = rng.choice(["ab", "abc ", "abcdefghijklmnop ", "".join(map(chr, range(0x3B1, 0x3F1))) + "\U0001f600"])
        a = "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 40, 199, 200, 260, 420])))
        b = edited(rng, a, alphabet, 0.2) if rng.random() < 0.5 else "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 3, 60, 199, 200, 350])))
        assert joined(matching.Pair(a, b).blocks() if a and b else []) == brute(a, b)
        assert matching.ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()


def test_common_characters_start_no_block():
    assert matching.ratio("x" * 300, "x" * 300) == 1.0
    assert matching.ratio("y" + "x" * 300, "x" * 300) == 0.0
    assert matching.ratio("y" + "x" * 199, "x" * 199) > 0.9
    assert matching.ratio("", "") == 1.0


def test_conversations(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").select("text").where("text is not null").limit(400).collect()
    texts = [r["text"] for r in turns]
    pairs = list(zip(texts, texts[1:] + texts[:1], strict=True)) + [(t, edited(random.Random(i), t, "abc de", 0.05)) for i, t in enumerate(texts)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r["i"]: (r["s"], r["close"], r["most"]) for r in rows.select("i", matching.similarity("a", "b").alias("s"), matching.similarity("a", "b", 0.8).alias("close"), matching.at_most(F.col("a"), F.col("b")).alias("most")).collect()}
    for i, (a, b) in enumerate(pairs):
        want = difflib.SequenceMatcher(None, a, b).ratio()
        assert got[i][0] == want
        assert got[i][2] >= want - 1e-12
        assert got[i][1] == (want if got[i][2] >= 0.8 else None)
    nulls = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string").select(matching.similarity("a", "b"), matching.blocks("a", "b")).collect()
    assert [tuple(r) for r in nulls] == [(None, None)] * 2
    found = spark.createDataFrame([("abxcd", "abcd")], "a string, b string").select(matching.blocks("a", "b").alias("m")).first()["m"]
    assert [tuple(m) for m in found] == [(0, 0, 2), (3, 2, 2)]


@pytest.mark.parametrize("name", ["q38_similarity_ratio", "q56_texts_compared"])
def test_queries(spark, name):
    """Every pair of the whole table against a brute force."""
    rows = catalog.queries()[name](spark, SF).collect()
    one, two = ({(r["conv_id"], r["turn"], r["role"]): r["text"] for r in df.collect()} for df in catalog.retyped(spark, SF))
    if name == "q38_similarity_ratio":
        turns = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect()
        want = [(b["conv_id"], b["turn"], round(difflib.SequenceMatcher(None, a["text"], b["text"]).ratio(), 6)) for a, b in zip(turns, turns[1:], strict=False) if a["conv_id"] == b["conv_id"]]
        assert sorted(map(tuple, rows)) == sorted(want)
        return
    got = {(r["conv_id"], r["turn"], r["role"]): (r["status"], r["similarity"]) for r in rows}
    assert got.keys() == one.keys() | two.keys()
    for k, (status, alike) in got.items():
        a, b = one.get(k), two.get(k)
        want = ("missing_in_one_side", None) if a is None or b is None else ("identical", 1.0) if a == b else ("different", round(difflib.SequenceMatcher(None, a, b).ratio(), 9))
        assert (status, alike) == want
    assert len({s for s, _ in got.values()}) == 3


def test_long_texts():
    """Some hundred thousand characters: numbers of substrings are made as far as both texts share them."""
    rng = np.random.default_rng(2)
    a = "".join(map(chr, rng.integers(0xAC00, 0xAC00 + 400, 180_000)))
    b = a[:60_000] + "#" + a[60_007:]
    pair = matching.Pair(a, b)
    assert sum(n for _, _, n in pair.blocks()) == len(a) - 7
    assert 15 <= len(pair.levels) <= 19
