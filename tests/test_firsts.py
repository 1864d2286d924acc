import random

import numpy as np
import pytest

from sonde.operators import firsts, hamming, images

SF = "/root/testdata/sf0.001"


def brute(rows, most):
    """The rule, one row after another."""
    out = {}
    for group in {r[0] for r in rows}:
        exact, kept = {}, []
        for _, name, same, h in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            if h is None:
                out[group, name] = (True, None, None)
            elif same in exact:
                out[group, name] = (False, "exact_duplicate", exact[same])
            elif near := next((n for n, x in kept if sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(h, x, strict=True)) <= most), None):
                out[group, name] = (False, "near_duplicate", near)
            else:
                out[group, name] = (True, None, None)
                exact[same] = name
                kept.append((name, h))
    return out


def flipped(rng, h, n):
    for bit in rng.sample(range(64 * len(h)), n):
        x = ((h[bit // 64] & (1 << 64) - 1) ^ (1 << bit % 64))
        h = [*h[: bit // 64], x - (1 << 64) if x >> 63 else x, *h[bit // 64 + 1 :]]
    return h


@pytest.mark.parametrize("seed", range(3))
def test_equals_the_rule(spark, seed):
    """Chains in which each hash is near the next only, hubs, exact copies of rows that stay and that go, and hashes of one value."""
    rng = random.Random(seed)
    rows = []
    for group in ("p", "q"):
        names = [f"{i:03d}.png" for i in range(120)]
        rng.shuffle(names)
        hashes = []
        for i, name in enumerate(names):
            way = rng.random()
            if not hashes or way < 0.2:
                h = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(4)]
            elif way < 0.3:
                h = [-1, -1, -1, -1]
            elif way < 0.5:
                h = rng.choice(hashes)
            else:
                h = flipped(rng, rng.choice(hashes[-4:]), rng.randrange(1, 9))
            hashes.append(h)
            rows.append((group, name, str(h) if rng.random() < 0.7 else f"{name} of its own", h))
        rows += [(group, f"x{i}.png", "bad", None) for i in range(2)]
    df = spark.createDataFrame(rows, "g string, name string, sha1 string, h array<long>").repartition(5)
    got = {(r["g"], r["name"]): (r["kept"], r["reason"], r["matched_with"]) for r in firsts.kept_in_order(df, "g", "name", "h", 4, 6, "sha1").collect()}
    assert got == brute(rows, 6)
    assert {r for _, r, _ in got.values()} == {None, "exact_duplicate", "near_duplicate"}


def test_edges_are_all_near_pairs_once(spark):
    rng = random.Random(9)
    base = [[rng.randrange(-(1 << 63), 1 << 63) for _ in range(4)] for _ in range(6)]
    hashes = [h for b in base for h in [b, *(flipped(rng, b, n) for n in (1, 3, 4, 6, 7, 9))]]
    df = spark.createDataFrame([("g", i, h) for i, h in enumerate(hashes)], "g string, i long, h array<long>")
    got = [(r["a"], r["b"]) for r in firsts.edges(df, "g", "i", "h", 4, 6).collect()]
    far = lambda x, y: sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(x, y, strict=True))
    assert sorted(got) == [(i, j) for i in range(len(hashes)) for j in range(i + 1, len(hashes)) if far(hashes[i], hashes[j]) <= 6]
    with pytest.raises(ValueError, match="at most"):
        firsts.edges(df, "g", "i", "h", 1, 2)
    assert firsts.kept_in_order(df.limit(0), "g", "i", "h", 4, 6).count() == 0


def test_resizing():
    """Weights sum to one, even pages stay even, and a page of even cells keeps their order."""
    for n in (5, 16, 100, 333):
        assert np.abs(images.weights(n, 16).sum(axis=1) - (1 << 22)).max() <= n
    assert (images.resized(np.full((90, 70), 255, np.uint8), 16, 16) == 255).all()
    assert (images.average_hash(np.full((40, 40), 7, np.uint8)) == -1).all()  # as bright as the mean
    cells = np.kron(np.arange(256).reshape(16, 16), np.ones((8, 8))).astype(np.uint8)
    small = images.resized(cells, 16, 16).astype(int)
    assert np.abs(small - np.arange(256).reshape(16, 16)).max() <= 8
    rgb = np.dstack([np.full((4, 4), c) for c in (10, 200, 30)]).astype(np.uint8)
    assert (images.gray(rgb) == (10 * 19595 + 200 * 38470 + 30 * 7471 + 32768) // 65536).all()


def test_copies_of_a_page_that_went(spark):
    """An exact copy of a page that is itself near a kept one is near that one; copies of pages that can't be read stay."""
    h = [0, 0, 0, 0]
    rows = [("p", "1", "a", h), ("p", "2", "b", [1, 0, 0, 0]), ("p", "3", "b", [1, 0, 0, 0]), ("p", "4", "a", h), ("p", "5", "z", None), ("p", "6", "z", None)]
    got = firsts.kept_in_order(spark.createDataFrame(rows, "entity string, name string, sha1 string, hash array<long>"), "entity", "name", "hash", 4, 6, "sha1").orderBy("name").collect()
    assert [(r["reason"], r["matched_with"]) for r in got] == [(None, None), ("near_duplicate", "1"), ("near_duplicate", "1"), ("exact_duplicate", "1"), (None, None), (None, None)]


def crowd(rng, n):
    """Different hashes any two of which are at most six bits apart, among them some that aren't near any."""
    base = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(4)]
    return list({tuple(flipped(rng, base, 3) if i % 10 else [rng.randrange(-(1 << 63), 1 << 63) for _ in range(4)]) for i in range(n)})


def test_a_crowd_has_few_links(spark, monkeypatch):
    """Rows near one that stayed go without links to each other: these are stored for parts of a crowd only, not for all its pairs."""
    rng = random.Random(4)
    rows = [("p", f"{i:04d}", str(h), list(h)) for i, h in enumerate(crowd(rng, 1500))]
    links, write = [], firsts.stored

    def stored(df, label):
        out = write(df, label)
        if label in ("firsts-edges", "firsts-links"):
            links.append(out.count())
        return out

    monkeypatch.setattr(firsts, "stored", stored)
    monkeypatch.setattr(firsts, "START", 40, raising=False)
    df = spark.createDataFrame(rows, "g string, name string, sha1 string, h array<long>").repartition(3)
    got = {(r["g"], r["name"]): (r["kept"], r["reason"], r["matched_with"]) for r in firsts.kept_in_order(df, "g", "name", "h", 4, 6, "sha1").collect()}
    assert got == brute(rows, 6)
    assert sum(links) < 5 * len(rows)


@pytest.mark.parametrize("seed", range(2))
def test_turns_and_slices_equal_the_rule(spark, monkeypatch, seed):
    """Many turns by ranges of names, in files cut into slices."""
    rng = random.Random(seed)
    rows = []
    for group in ("p", "q"):
        hashes = crowd(rng, 60)
        hashes += [flipped(rng, rng.choice(hashes), rng.randrange(1, 12)) for _ in range(120)]
        rng.shuffle(hashes)
        rows += [(group, f"{i:03d}", str(h) if i % 4 else f"{i} of its own", list(h)) for i, h in enumerate(hashes)]
    monkeypatch.setattr(firsts, "START", 30)
    monkeypatch.setattr(hamming, "FILE", 16)
    df = spark.createDataFrame(rows, "g string, name string, sha1 string, h array<long>").repartition(3)
    got = {(r["g"], r["name"]): (r["kept"], r["matched_with"]) for r in firsts.kept_in_order(df, "g", "name", "h", 4, 6, "sha1").collect()}
    assert got == {k: (kept, of) for k, (kept, _, of) in brute(rows, 6).items()}


def test_candidates_are_the_near_pairs():
    """Small and large files, sides that meet and that don't."""
    rng = np.random.default_rng(2)
    h = np.repeat(rng.integers(0, 1 << 63, (8, 4), dtype=np.uint64), 40, axis=0) ^ (np.uint64(1) << rng.integers(0, 64, (320, 4), dtype=np.uint64))
    key, side = np.sort(rng.integers(0, 20, 320)), rng.choice([0, 1], 320)
    key[200:], side[:60] = 99, hamming.BOTH
    side[200:260] = hamming.BOTH
    want = {(i, j) for i in range(320) for j in range(i + 1, 320) if key[i] == key[j] and side[i] + side[j] in (1, 4) and np.bitwise_count(h[i] ^ h[j]).sum() <= 6}
    got = [(int(i), int(j)) for a, b in hamming.candidates(key, side, h, 6) for i, j in zip(a, b, strict=True)]
    assert len(got) == len(want) and set(got) == want
