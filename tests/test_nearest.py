import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonde.operators import candidates, nearest


def index_of(rows):
    grams = [[f"g{i:03d}" for i in np.flatnonzero(r)] for r in rows]
    lists = pa.table({"grams": grams, "idf": [[1.0] * len(g) for g in grams], "weights": [[float(x) for x in r[r > 0]] for r in rows], "home": [[0] * len(g) for g in grams]})
    return nearest.Index.of(lists, 0)


def sparse(rng, n, m, share):
    return np.where(rng.random((n, m)) < share, rng.random((n, m)), 0)


@pytest.mark.parametrize("seed", range(6))
def test_best_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    rows = sparse(rng, 500, 60, 0.15)
    rows[100:140] = rows[0]  # ties
    rows[200] = 0  # shares nothing
    index = index_of(rows)
    at = {g: i for g, i in index.grams.items()}
    for k in (1, 5, 30):
        text = sparse(rng, 1, 60, 0.4)[0]
        own = np.zeros(len(at))
        for i, x in enumerate(text):
            if f"g{i:03d}" in at:
                own[at[f"g{i:03d}"]] = x
        found, scores, _ = index.best(own, k, 1e-9)
        dots = rows @ text
        worst = np.sort(dots)[-k]
        assert set(found) == set(np.flatnonzero((dots >= worst - 1e-9) & (dots > 0)))
        assert np.allclose(scores, dots[found])


def test_blocks_and_postings_are_left_out():
    """Rows alike lie together: most blocks can't reach the best rows, and postings there aren't read."""
    rng = np.random.default_rng(1)
    rows = np.concatenate([sparse(rng, 256, 400, 0.02) + np.eye(400)[i * 20 : i * 20 + 20].sum(0) * (rng.random((256, 400)) < 0.8) for i in range(20)])
    index = index_of(rows)
    text = rows[7]
    own = np.zeros(len(index.grams))
    for g, i in index.grams.items():
        own[i] = text[int(g[1:])]
    found, _, read = index.best(own, 3, 1e-9)
    others, own = int((rows[256:, text > 0] > 0).sum()), int((rows[:256, text > 0] > 0).sum())
    assert 7 in found
    assert read < own  # nothing of the other groups, not all of its own
    assert others > 2000


def test_shards_agree(spark):
    """Whatever the shards, and whichever grams each has: the same rows, ranks and scores."""
    words = ["sleep", "latency", "apnea", "index", "night", "수면", "다원", "검사", "ÉTÉ", "rem"]
    rng = np.random.default_rng(3)
    texts = lambda n, k: [(i, " ".join(rng.choice(words, rng.integers(1, k)))) for i in range(n)]
    rows = spark.createDataFrame([*texts(60, 5), (60, None), (61, "")], "row int, about string")
    pages = spark.createDataFrame([*texts(40, 12), (40, None), (41, "zzz qqq")], "page long, text string")
    one, many = (sorted(map(tuple, nearest.alike(pages, "page", "text", rows, "row", "about", 4, 9, candidates.grams, candidates.GRAMS, shard=s).collect())) for s in (nearest.SHARD, 700))
    assert one == many
    assert {r[0] for r in one} == set(range(40))
    none = nearest.alike(pages.limit(0), "page", "text", rows, "row", "about", 4, 9, candidates.grams, candidates.GRAMS)
    assert none.count() == 0
    assert nearest.alike(pages, "page", "text", rows.limit(0), "row", "about", 4, 9, candidates.grams, candidates.GRAMS).count() == 0


def test_forced_keys_come_in_order_of_triggers(spark):
    keys = ["ESS_01", "PSQI_02", "PSQI_01", "RLS_1", "IRLS_1", "Name", "AGE"]
    dictionary = spark.createDataFrame([(k, i, f"about {k}") for i, k in enumerate(keys)], "key string, position int, description string")
    pages = spark.createDataFrame([(1, "Epworth Sleepiness and PSQI, restless legs")], "p int, t string")
    rows = candidates.selected(pages, "p", "t", dictionary, 0).orderBy("place").collect()
    assert [r["key"] for r in rows] == ["Name", "AGE", "PSQI_02", "PSQI_01", "ESS_01", "RLS_1", "IRLS_1"]
    assert dictionary.where(F.col("key") == "Name").count() == 1


def test_cutter_equals_slices():
    """Grams of words of any script, with and without known neighbours, as often as Python's slices give them; texts with runs of blanks, none or no word."""
    rng = np.random.default_rng(5)
    letters = list("abcé수면\U0001f600 ")
    texts = ["".join(rng.choice([*letters, " ", "\t", "\n", "\x0b"], rng.integers(0, 60))) for _ in range(200)] + [None, "", " \t ", "a", "  a  b "]
    slices = lambda t: [w[i : i + n] for x in re.split(r"[ \t\n\x0b\f\r]+", t or "") if x for w in [f" {x} "] for n in range(2, 6) for i in range(len(w) - n + 1)]
    everything = sorted({g for t in texts for g in slices(t)})
    for known in (everything, everything[::3], []):
        known = {g: i for i, g in enumerate(known)}
        for most in (1, 100, 1 << 20):
            found = {i: (Counter(own.tolist()), every) for i, own, every in nearest.counted(pa.array(texts, pa.string()), nearest.Cutter(known, (2, 5)), most)}
            assert found == {i: (Counter(known[g] for g in slices(t) if g in known), len(slices(t))) for i, t in enumerate(texts) if slices(t)}


def test_words_are_cut_together(monkeypatch):
    """A word is cut once a chunk of texts, however often it occurs, and no gram of a text is looked up in Python."""
    cut = []
    of = nearest.Cutter.of
    monkeypatch.setattr(nearest.Cutter, "of", lambda self, words: cut.append(len(words)) or of(self, words))
    texts = pa.array([f"sleep apnea {i}" for i in range(500)])
    assert len(list(nearest.counted(texts, nearest.Cutter({"sle": 0}, (2, 5))))) == 500
    assert cut == [502]
