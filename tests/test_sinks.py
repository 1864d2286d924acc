import csv
import io

import pytest
from pyspark.sql import functions as F

from sonde.sources import combined, quoted_csv

CELLS = ["plain", None, "", "a,b", 'say "x"', "one\rtwo", "one\ntwo", "one\r\ntwo", " spaced ", "이름", "﻿", "\t", "'"]


def files(folder):
    return {p.name: p.read_bytes() for p in sorted(folder.iterdir()) if not p.name.endswith(".crc")}


def test_bytes(spark, tmp_path):
    """Byte for byte what the standard library writes, and what it reads again."""
    rows = [(i, c, CELLS[-1 - i]) for i, c in enumerate(CELLS)]
    df = spark.createDataFrame(rows, "n int, a string, `b,c` string").coalesce(1)
    quoted_csv.write(df, str(tmp_path / "out"), ["b,c", "gone", "a"])
    out = io.StringIO(newline="")
    want = csv.writer(out, lineterminator="\r\n")
    want.writerow(["b,c", "gone", "a"])
    want.writerows([c, None, a] for _, a, c in rows)
    got = files(tmp_path / "out")
    assert got == {"part-00000.csv": out.getvalue().encode("utf-8-sig"), "_SUCCESS": b""}
    read = list(csv.reader(io.StringIO(got["part-00000.csv"].decode("utf-8-sig"), newline="")))
    assert read[1:] == [[c or "", "", a or ""] for _, a, c in rows]


def test_many_tasks_append_and_overwrite(spark, tmp_path):
    df = spark.range(100).select("id", F.concat(F.lit("x\r"), F.col("id").cast("string")).alias("t"))
    out = tmp_path / "out"
    whole = lambda: sorted(int(r[0]) for p in out.glob("part-*.csv") for r in list(csv.reader(io.StringIO(p.read_text("utf-8-sig"), newline="")))[1:])
    quoted_csv.write(df.repartition(4), str(out))
    assert whole() == list(range(100))
    quoted_csv.write(df.where("id < 5"), f"file://{out}", mode="append", encoding="utf-8", lineEnd="\n")
    assert whole() == sorted([*range(100), *range(5)])
    quoted_csv.write(df.where("id < 7").repartition(3), str(out))
    assert whole() == list(range(7))
    quoted_csv.write(df.limit(0), str(out))
    assert files(out) == {"part-00000.csv": "id,t\r\n".encode("utf-8-sig"), "_SUCCESS": b""}


def test_a_job_that_fails_leaves_what_was_there(spark, tmp_path):
    out = tmp_path / "out"
    quoted_csv.write(spark.range(3), str(out))
    before = files(out)
    broken = spark.range(0, 40, 1, 4).select(F.when(F.col("id") == 33, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        quoted_csv.write(broken, str(out))
    assert files(out) == before


COLUMNS = ["entity", "a", "b"]


def test_combined_table(spark, tmp_path):
    """Batches, replays of them, columns that lack, repeated entities; each state equals a dict."""
    path, want = str(tmp_path / "t"), {}
    state = lambda: {r["entity"]: (r["a"], r["b"]) for r in combined.table(spark, path, "entity", COLUMNS).collect()}
    assert state() == {}
    batches = {
        "1": [("p1", 1, "x", "y"), ("p2", 1, "u", None), (None, 1, "n", "n")], "2": [("p2", 1, "v", "w"), ("p3", 1, "first", ""), ("p3", 2, "last", "")],
        "3": [], "4": [(f"q{i}", 0, str(i), None) for i in range(50)],
    }
    for name, rows in batches.items():
        df = spark.createDataFrame(rows, "entity string, at int, a string, b string")
        assert combined.put(df, path, name, "entity", ["at"], COLUMNS, buckets=8)
        want |= {e: (a, b) for e, _, a, b in sorted((r for r in rows if r[0]), key=lambda r: r[1])}
        assert state() == want
        assert not combined.put(df, path, name, "entity", ["at"], COLUMNS, buckets=8)
        assert state() == want
    assert combined.put(spark.createDataFrame([("p1", 5, "z")], "entity string, at int, a string"), path, "5", "entity", ["at"], COLUMNS)
    assert state() == want | {"p1": ("z", None)}


def test_a_batch_that_fails_does_not_show(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("p1", 1, "x", "y")], "entity string, at int, a string, b string")
    combined.put(first, path, "1", "entity", ["at"], COLUMNS)
    bad = first.withColumn("a", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        combined.put(bad, path, "2", "entity", ["at"], COLUMNS)
    with monkeypatch.context() as m:  # lost between the data and the manifest
        m.setattr(combined, "MANIFEST", "number")
        m.setattr(combined, "manifests", lambda spark, path: spark.read.schema("number long, batch string, bucket int, folder string, buckets int").json(f"{path}/_manifest"))
        with pytest.raises(Exception, match=r"(?i)parse"):
            combined.put(first.withColumn("a", F.lit("lost")), path, "2", "entity", ["at"], COLUMNS)
    rows = lambda: [tuple(r) for r in combined.table(spark, path, "entity", COLUMNS).collect()]
    assert rows() == [("p1", "x", "y")]
    assert combined.put(first.withColumn("a", F.lit("again")), path, "2", "entity", ["at"], COLUMNS)
    assert rows() == [("p1", "again", "y")]
