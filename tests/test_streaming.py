import random

import pytest
from pyspark.sql import functions as F

from sonde.operators import sequences
from sonde.streaming import sliding, usage

SCHEMA = "id string, kind string, at timestamp, k long"
SECOND = 10**6


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, sliding.STORE)
    yield spark
    spark.conf.set(key, before)


def brute(records, width):
    out = {}
    for i, kind, t, _ in records:
        own = {j: k for j, other, s, k in records if other == kind and t - width < s <= t}
        out[i] = (len(own), sum(k or 0 for k in own.values()))
    return out


def written(spark, folder, records):
    """One batch: its records as files of their own."""
    rows = spark.createDataFrame([(i, kind, t, k) for i, kind, t, k in records], "id string, kind string, us long, k long")
    rows.select("id", "kind", F.timestamp_micros("us").alias("at"), "k").coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, source, folder, stretch=60 * SECOND):
    stream = spark.readStream.schema(SCHEMA).parquet(str(source))
    usage.drain(sliding.sliding(stream, "at", "id", "kind", "k", 60 * SECOND, stretch=stretch), str(folder / "out"), str(folder / "state"))
    return {r["ident"]: (r["n_window"], r["sum_window"]) for r in sliding.last_given(spark, str(folder / "out"), "ident string, kind string, at_us long, n_window long, sum_window long").collect()}


@pytest.mark.parametrize("stretch", [60 * SECOND, 150 * SECOND, None])
def test_late_records_correct_what_was_given(rocks, tmp_path, stretch):
    """Batches out of order, repeated records, equal times, null values; the last rows given equal a brute force over all records."""
    rng = random.Random(2)
    start = 1_700_000_000 * SECOND
    records = [(f"r{i}", rng.choice("ab"), start + rng.randrange(0, 400) * SECOND // rng.choice([1, 1, 3]), rng.choice([None, 1, 5, 7])) for i in range(150)]
    rng.shuffle(records)
    for low in range(0, 150, 50):
        written(rocks, tmp_path / "in", records[low : low + 50] + (records[low - 5 : low] if low else []))
        got = run(rocks, tmp_path / "in", tmp_path, stretch)
        assert got == brute(records[: low + 50], 60 * SECOND)
    again = run(rocks, tmp_path / "in", tmp_path, stretch)
    assert again == got


def test_state_goes_when_the_watermark_has_passed(rocks, tmp_path):
    """What comes after the watermark is dropped, and cleared stretches don't come back."""
    start = 1_700_000_000 // 60 * 60 * SECOND
    written(rocks, tmp_path / "in", [("a", "x", start, 1), ("b", "x", start + 10 * SECOND, 2)])
    assert run(rocks, tmp_path / "in", tmp_path) == {"a": (1, 1), "b": (2, 3)}
    written(rocks, tmp_path / "in", [("c", "x", start + 3600 * SECOND, 4)])
    run(rocks, tmp_path / "in", tmp_path)
    written(rocks, tmp_path / "in", [("d", "x", start + 20 * SECOND, 9), ("e", "x", start + 3610 * SECOND, 1)])
    assert run(rocks, tmp_path / "in", tmp_path) == {"a": (1, 1), "b": (2, 3), "c": (1, 4), "e": (2, 5)}


def test_batch_twin(spark):
    rng = random.Random(4)
    records = [(f"r{i}", rng.choice("ab"), rng.randrange(0, 300) * SECOND, rng.choice([1, 5])) for i in range(200)]
    rows = spark.createDataFrame(records, "id string, kind string, us long, k long")
    got = {r["id"]: (r["n_window"], r["sum_window"]) for r in sequences.sliding(rows, ["kind"], "us", 60 * SECOND, "k").collect()}
    assert got == brute(records, 60 * SECOND)


def test_days(spark, tmp_path):
    day = 86_400 * SECOND
    written(spark, tmp_path / "in", [("a", "x", day - 1, 1), ("b", "x", day, 2), ("b", "x", day, 2), ("c", "x", day + 5, 4), ("d", "y", day, None)])
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    usage.drain(sliding.by_day(stream, "at", "id", "kind", "k"), str(tmp_path / "out"), str(tmp_path / "state"))
    rows = usage.latest(spark, str(tmp_path / "out"), "kind").collect()
    assert {(r["start"].day, r["kind"]): (r["n"], r["total"]) for r in rows} == {(1, "x"): (1, 1), (2, "x"): (2, 6), (2, "y"): (1, None)}
