import json

import pytest
from pyspark.sql import functions as F

from sonde.sources import artefacts

DOCS = {
    ("r1", "p1", "final_row.json"): {"AGE": 33, "Name": "홍길동", "deep": {"a": [{"b": [1, [True, {"c": None}]]}, [], {}], "x.y": 1.5}},
    ("r1", "p1", "meta.json"): {"seconds": 2.5}, ("r1", "p2", "final_row.json"): [1, "two", {"k": "v"}], ("r2", "p1", "final_row.json"): "text", ("r2", "p3", "meta.json"): {"seconds": 1, "more": {"n": 2}},
}


def brute(doc, path="$", leaf=None):
    if isinstance(doc, dict | list) and doc:
        for k, v in doc.items() if isinstance(doc, dict) else enumerate(doc):
            yield from brute(v, f"{path}[{k}]" if isinstance(doc, list) else f"{path}.{k}", leaf if isinstance(doc, list) else k)
    else:
        kind = "object" if isinstance(doc, dict) else "array" if isinstance(doc, list) else "scalar"
        yield path, leaf, kind, None if kind != "scalar" or doc is None else doc if isinstance(doc, str) else json.dumps(doc)


@pytest.fixture
def runs(tmp_path):
    for (run, entity, name), doc in DOCS.items():
        (tmp_path / run / "out" / entity).mkdir(parents=True, exist_ok=True)
        (tmp_path / run / "out" / entity / name).write_text(json.dumps(doc, ensure_ascii=False, indent=1))
    (tmp_path / "r2" / "out" / "p2").mkdir()
    (tmp_path / "r2" / "out" / "p2" / "final_row.json").write_text("{broken")
    return str(tmp_path)


def test_leaves_equal_brute_force(spark, runs):
    rows = artefacts.documents(spark, runs, "*.json").where("error is null")
    got = sorted(map(tuple, artefacts.leaves(rows, ["run", "entity", "name"]).collect()), key=str)
    assert got == sorted(((*k, *leaf) for k, doc in DOCS.items() for leaf in brute(doc)), key=str)
    assert [(r["run"], r["entity"], r["doc"]) for r in artefacts.documents(spark, runs, "final_row.json").where("error is not null").collect()] == [("r2", "p2", None)]
    assert artefacts.leaves(rows.limit(0), ["run"]).count() == 0


def test_too_deep_is_an_error(spark):
    doc = "[" * 70 + "]" * 70
    rows = spark.createDataFrame([(1, doc)], "i int, t string").select("i", F.parse_json("t").alias("doc"))
    with pytest.raises(ValueError, match="deeper"):
        artefacts.leaves(rows, ["i"])


def test_runs_loaded_and_reported(spark, runs):
    rows = artefacts.loaded(spark, runs, {"row": "final_row.json", "meta": "meta.json"})
    got = {(r["run"], r["entity"]): r["value"] for r in artefacts.report(rows, ["run", "entity"]).collect()}
    assert set(got) == {("r1", "p1"), ("r1", "p2"), ("r2", "p1"), ("r2", "p2"), ("r2", "p3")}
    assert json.loads(got["r1", "p1"]) == {"row": DOCS["r1", "p1", "final_row.json"], "meta": {"seconds": 2.5}}
    assert json.loads(got["r2", "p3"]) == {"meta": {"seconds": 1, "more": {"n": 2}}}


def test_answers_of_any_shape(spark):
    cases = [('"plain"', "plain"), ('[{"type": "text", "text": "a"}, "b", {"content": "c"}, {"x": 1}, {"text": ""}]', "a\nb\nc"), ('{"text": "t"}', "t"), ("[]", ""), ("5", "5")]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").select("i", F.parse_json("t").alias("v")).orderBy("i")
    assert [r[0] for r in rows.select(artefacts.said("v")).collect()] == [w for _, w in cases]
