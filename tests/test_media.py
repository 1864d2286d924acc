import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonde.operators import images, models, pages
from sonde.sources import edf


def png(pixels, colour=0, way=0):
    """A PNG whose lines all use one filter."""
    pixels = np.asarray(pixels, np.uint8)
    height, width = pixels.shape[:2]
    rows = pixels.reshape(height, width, -1).astype(int)
    out = b""
    for y in range(height):
        line = bytearray()
        for x in range(width):
            for c in range(rows.shape[2]):
                a, b, d = (rows[y, x - 1, c] if x else 0), (rows[y - 1, x, c] if y else 0), (rows[y - 1, x - 1, c] if x and y else 0)
                p = a + b - d
                guess = (0, a, b, (a + b) // 2, min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2])[way]
                line.append((rows[y, x, c] - guess) % 256)
        out += bytes([way]) + bytes(line)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)) + part(b"IDAT", zlib.compress(out)) + part(b"IEND", b"")


@pytest.mark.parametrize("way", range(5))
def test_png(way):
    rng = np.random.default_rng(way)
    g, c = rng.integers(0, 256, (7, 9)), rng.integers(0, 256, (6, 5, 3))
    assert (images.decode(png(g, 0, way))[:, :, 0] == g).all()
    assert (images.decode(png(c, 2, way)) == c).all()
    with pytest.raises(ValueError, match="not an image"):
        images.decode(b"xx")


def test_margins():
    page = np.full((60, 80), 255, np.uint8)
    page[20:40, 30:50] = 10
    assert pages.box(page) == (22, 12, 36, 36)
    assert pages.box(np.full((9, 9), 255, np.uint8)) == (0, 0, 9, 9)
    assert pages.box(np.zeros((9, 9), np.uint8)) == (0, 0, 9, 9)
    page[0, :4] = 0  # too few to count
    assert pages.box(page) == (22, 12, 36, 36)


def brute_evened(g, tiles, limit):
    """One pixel after another."""
    height, width = g.shape
    th, tw = -(-height // tiles), -(-width // tiles)
    mirror = lambda i, n: i if i < n else 2 * n - 2 - i
    tables = {}
    for i in range(tiles):
        for j in range(tiles):
            n = [0] * 256
            for y in range(i * th, (i + 1) * th):
                for x in range(j * tw, (j + 1) * tw):
                    n[g[mirror(y, height), mirror(x, width)]] += 1
            most = max(1, int(limit * th * tw / 256))
            over = sum(max(0, c - most) for c in n)
            n = [min(c, most) + over // 256 for c in n]
            rest = over % 256
            for k in range(rest):
                n[k * max(256 // rest, 1)] += 1
            sums, s = [], 0
            for c in n:
                s += c
                sums.append(min(255, round(float(np.float32(s * np.float32(255 / (th * tw)))))))
            tables[i, j] = sums
    out = np.zeros_like(g)
    near = lambda i: min(max(i, 0), tiles - 1)
    for y in range(height):
        for x in range(width):
            fy, fx = y / th - 0.5, x / tw - 0.5
            i, j = math.floor(fy), math.floor(fx)
            a, b = fy - i, fx - j
            at = lambda p, q: tables[near(p), near(q)][g[y, x]]  # noqa: B023, E731
            top, low = at(i, j) * (1 - b) + at(i, j + 1) * b, at(i + 1, j) * (1 - b) + at(i + 1, j + 1) * b
            out[y, x] = min(255, max(0, round(top * (1 - a) + low * a)))
    return out


@pytest.mark.parametrize("shape", [(32, 24), (37, 29)])
def test_contrast_equals_brute_force(shape):
    g = np.random.default_rng(1).integers(60, 130, shape).astype(np.uint8)
    for tiles, limit in ((4, 2.0), (8, 3.5)):
        got, want = pages.evened(g, tiles, limit).astype(int), brute_evened(g, tiles, limit).astype(int)
        assert np.abs(got - want).max() <= 1
        assert (got != want).mean() < 0.01  # halves


def test_thresholds_equal_brute_force():
    g = np.random.default_rng(2).integers(0, 256, (40, 33)).astype(np.uint8)
    sigma, half = 0.3 * (9 - 1) * 0.5 - 0.3 + 0.8, 4
    bell = [math.exp(-(i * i) / (2 * sigma * sigma)) for i in range(-half, half + 1)]
    got = pages.local_threshold(g, 9, 15)
    clip = lambda i, n: min(max(i, 0), n - 1)
    for y, x in np.random.default_rng(3).integers(0, 33, (200, 2)):
        mean = round(sum(bell[i] * bell[j] * int(g[clip(y + i - half, 40), clip(x + j - half, 33)]) for i in range(9) for j in range(9)) / sum(bell) ** 2)
        assert got[y, x] == (255 if g[y, x] > mean - 15 else 0)
    two = np.where(np.arange(400).reshape(20, 20) % 3 == 0, 40, 200).astype(np.uint8)
    assert (pages.split_threshold(two) == np.where(two == 40, 0, 255)).all()
    flat = np.full((6, 6), 90, np.uint8)
    assert (pages.smoothed(flat) == 90).all()
    assert (pages.sharpened(flat) == 90).all()
    assert (pages.stretched(np.array([[10, 20], [30, 60]], np.uint8)) == [[0, 51], [102, 255]]).all()
    assert pages.stretched(flat).max() == 0


def test_pages_as_rows(spark):
    page = np.full((120, 90), 250, np.uint8)
    page[40:80:4, 30:60] = 20
    rows = [("p", "1.png", png(page)), ("p", "2.png", b"bad"), ("q", "1.pgm", pages.portable(page)), ("q", "2.png", png(np.full((30, 20), 255)))]
    df = spark.createDataFrame([(e, n, bytearray(c)) for e, n, c in rows], "entity string, name string, content binary").withColumn("score", F.lit(1))
    got = {(r["entity"], r["name"]): r for r in pages.cropped(df).collect()}
    assert {k: (r["x"], r["y"], r["width"], r["height"]) for k, r in got.items()} == {("p", "1.png"): (22, 32, 46, 53), ("p", "2.png"): (None,) * 4, ("q", "1.pgm"): (22, 32, 46, 53), ("q", "2.png"): (0, 0, 20, 30)}
    assert (images.decode(bytes(got["p", "1.png"]["content"]))[:, :, 0] == page[32:85, 22:68]).all()
    assert got["p", "2.png"]["error"] == "not an image that is read here"
    for way in ("adaptive", "otsu"):
        ready = {(r["entity"], r["name"]): r for r in pages.prepared(df, threshold=way).collect()}
        assert set(np.unique(images.decode(bytes(ready["p", "1.png"]["content"])))) == {0, 255}
        assert ready["p", "1.png"]["content"] == ready["q", "1.pgm"]["content"]
    with pytest.raises(ValueError, match="threshold"):
        pages.prepared(df, threshold="x")
    assert pages.prepared(df.limit(0)).count() == 0


def test_duplicates(spark):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, (64, 48)), rng.integers(0, 256, (64, 48))
    near = a.copy()
    near[0, 0] ^= 1
    rows = [("p", "1.png", png(a)), ("p", "2.png", png(a)), ("p", "3.png", png(near)), ("p", "4.png", png(b)), ("p", "5.png", b"bad"), ("p", "6.png", b"bad too"), ("q", "1.png", png(a))]
    df = spark.createDataFrame([(e, n, bytearray(c)) for e, n, c in rows], "entity string, name string, content binary")
    got = {(r["entity"], r["name"]): (r["kept"], r["reason"], r["matched_with"]) for r in images.without_duplicates(images.hashed(df)).collect()}
    kept = (True, None, None)
    assert got == {("p", "1.png"): kept, ("p", "2.png"): (False, "exact_duplicate", "1.png"), ("p", "3.png"): (False, "near_duplicate", "1.png"), ("p", "4.png"): kept, ("p", "5.png"): kept, ("p", "6.png"): kept, ("q", "1.png"): kept}


def write_edf(path, signals, records, seconds=1):
    fields = {"version": "0", "patient": "X", "recording": "R", "date": "01.01.24", "time": "22.00.00", "header_bytes": 256 * (len(signals) + 1), "reserved": "", "records": records, "record_seconds": seconds, "signals": len(signals)}
    head = b"".join(str(fields[n]).ljust(w).encode() for n, w in edf.FILE)
    base = {"transducer": "", "unit": "uV", "physical_min": -100, "physical_max": 100, "digital_min": -1000, "digital_max": 1000, "filter": "", "reserved": ""}
    for n, w in edf.SIGNAL:
        head += b"".join(str({**base, "label": s[0], "samples": s[1]}[n]).ljust(w).encode() for s in signals)
    body = b"".join(np.asarray(s[2][r * s[1] : (r + 1) * s[1]], "<i2").tobytes() for r in range(records) for s in signals)
    path.write_bytes(head + body)


def test_edf(spark, tmp_path):
    heart = np.arange(70) * 10 - 300
    write_edf(tmp_path / "n1.edf", [("EEG", 5, np.zeros(35)), ("EKG1", 10, np.zeros(70)), ("ECG", 10, heart)], 7)
    df = edf.samples(spark, str(tmp_path), records=3)
    assert df.rdd.getNumPartitions() == 3
    rows = df.orderBy("sample_index").collect()
    assert [r["sample_index"] for r in rows] == list(range(70))
    assert np.allclose([r["ekg_uV"] for r in rows], heart / 10)
    assert {(r["recording"], r["channel"], r["sfreq"]) for r in rows} == {("n1.edf", "ECG", 10.0)}
    assert edf.samples(spark, str(tmp_path), seconds=1.5).count() == 15
    assert edf.samples(spark, str(tmp_path), channel="eeg").count() == 35
    info = {r["channel_name"]: r for r in edf.channels(spark, str(tmp_path)).collect()}
    assert (info["ECG"]["sfreq_hz"], info["ECG"]["n_samples"], info["ECG"]["duration_sec"], info["EEG"]["n_samples"]) == (10.0, 70, 7.0, 35)
    with pytest.raises(ValueError, match="no channel"):
        edf.pick(["EEG"])


@pytest.mark.parametrize(("old", "new", "n", "block"), [(500, 200, 2000, 300), (500, 200, 2003, 2003), (128, 200, 1500, 400), (256, 200, 1029, 256), (200, 200, 700, 128)])
def test_resampling_by_blocks(spark, old, new, n, block):
    """Whatever the blocks, the waves themselves within a thousandth, and as one block; with a short last block too, two recordings side by side."""
    t = np.arange(n) / old
    wave = np.sin(2 * np.pi * 3 * t) + 0.5 * np.cos(2 * np.pi * 11.3 * t) + t
    rows = [(name, "c", float(old), i, float(x), float(y) * k) for name, k in (("r", 1), ("s", -2)) for i, (x, y) in enumerate(zip(t, wave, strict=True))]
    df = spark.createDataFrame(rows, edf.SCHEMA).repartition(6)
    many = {}
    for r in edf.resampled(df, new, block).collect():
        many.setdefault(r["recording"], {})[r["sample_index"]] = r["ekg_uV"]
    total = round(n * new / old)
    for name, k in (("r", 1), ("s", -2)):
        assert sorted(many[name]) == list(range(total))
        got = np.array([many[name][i] for i in range(total)])
        s = np.arange(total) / new
        want = k * (np.sin(2 * np.pi * 3 * s) + 0.5 * np.cos(2 * np.pi * 11.3 * s) + s)
        assert np.abs(got - want)[20:-20].max() < 1e-3
    one = edf.resampled(df.where("recording = 'r'"), new, 1 << 20).collect()
    assert max(abs(r["ekg_uV"] - many["r"][r["sample_index"]]) for r in one) < 1e-9
    assert edf.resampled(df.limit(0), new).count() == 0


def test_resampling_leaves_out_what_the_new_rate_cannot_hold(spark):
    t = np.arange(4000) / 500
    df = spark.createDataFrame([("r", "c", 500.0, i, float(x), float(np.sin(2 * np.pi * 180 * x))) for i, x in enumerate(t)], edf.SCHEMA)
    assert max(abs(r["ekg_uV"]) for r in edf.resampled(df, 200, 1000).collect() if 100 < r["sample_index"] < 1500) < 0.01


class Scripted:
    def __init__(self, *said):
        self.said, self.asked = list(said), []

    def complete(self, system, user):
        self.asked.append(user)
        out = self.said.pop(0)
        if isinstance(out, Exception):
            raise out
        return out


def test_answers_are_repaired_and_retried():
    waits = []
    model = Scripted(RuntimeError("503 busy"), "no", '{"a": 1')
    assert models.asked_for_json(model, "s", "u", repairs=1, sleep=waits.append) == (None, 2)
    assert len(waits) == 1
    assert "isn't" not in model.asked[0]
    assert "no" in model.asked[2]
    assert models.asked_for_json(Scripted("x", 'so: {"a": 1} ok'), "s", "u", sleep=waits.append) == ({"a": 1}, 2)
    with pytest.raises(RuntimeError, match="bad key"):
        models.persistent(lambda: Scripted(RuntimeError("bad key")).complete("", ""), sleep=waits.append)


def test_mapped(spark):
    def factory():
        class Echo:
            def complete(self, system, user):
                if user == "boom":
                    raise RuntimeError("no")
                return user

        return Echo()

    rows = spark.createDataFrame([(1, '{"A": {"value": "x"}, "B": 2, "C": null}'), (2, "boom"), (3, "nothing"), (4, None), (5, "{}")], "id int, p string")
    got = sorted(((r["id"], r["key"], r["value"], r["error"]) for r in models.mapped(rows, factory, "s", "p", ["id"]).collect()), key=str)
    assert got == sorted([(1, "A", "x", None), (1, "B", "2", None), (1, "C", None, None), (2, None, None, "no"), (3, None, None, "no JSON object"), (4, None, None, "no JSON object"), (5, None, None, None)], key=str)
    facts = spark.createDataFrame([(1, "A", None, 0), (1, "A", "y", 1), (1, "A", "z", 2)], "id int, key string, value string, n int")
    assert [tuple(r) for r in models.first_facts(facts, ["id"], "key", "value", ["n"]).collect()] == [(1, "A", "y")]
    cut = spark.createDataFrame([('{"a": [1]}',), ('{"a": [1',), ("{} {",)], "t string")
    assert [r[0] for r in cut.select(models.looks_cut("t")).collect()] == [False, True, True]


def test_rounds_ask_only_what_is_open(spark, tmp_path):
    asked = []

    def attempt(pending, n):
        asked.append(pending.count())
        return pending.withColumn("done", F.col("id") <= n)

    def write(df, n):
        df.write.parquet(f"{tmp_path}/{n}")
        return spark.read.parquet(f"{tmp_path}/{n}")

    done = models.in_rounds(spark.range(5), ["id"], attempt, write, 3)
    assert asked == [5, 4, 3]
    assert sorted(r["id"] for r in done.collect()) == [0, 1, 2]


def test_pace():
    now = [0.0]
    pace = models.Pace(requests=3, tokens=100, share=1.0, clock=lambda: now[0])
    first = pace.start(60)
    assert pace.wait(30) == 0
    assert pace.wait(50) == 60
    pace.done(first, 10)
    assert pace.wait(50) == 0
    now[0] = 1.0
    pace.start(1)
    pace.start(1)
    assert pace.wait(1) == 59
    now[0] = 61.0
    assert pace.wait(90) == 0
    slept = []
    model = models.paced(Scripted("ok"), models.Pace(), slept.append)
    assert model.complete("s", "u") == "ok"
    assert slept == []
