import pytest
from pyspark.sql import functions as F

from sonde.operators import candidates, routing, runs


def test_accuracy_by_stage(spark):
    run = spark.createDataFrame([("p", "A", "1.0"), ("p", "B", "x"), ("p", "C", "y"), ("p", "E", None)], "entity string, field string, value string")
    truth = spark.createDataFrame([("p", "A", "1"), ("p", "B", "z"), ("p", "C", "Y"), ("p", "D", "3"), ("p", "E", None)], "entity string, field string, value string")
    rows = runs.compared(run, truth, spark.createDataFrame([("p", "B")], "entity string, field string"))
    assert {r["field"]: (r["match"], r["in_conflict"]) for r in rows.collect()} == {"A": (True, False), "B": (False, True), "C": (False, False), "D": (False, False), "E": (True, False)}
    total = runs.accuracy(rows, ["entity"]).first()
    assert (total["total"], total["correct"], total["with_conflicts"], total["accuracy"]) == (5, 2, 3, 0.4)
    category = F.when(F.col("field").isin("A", "B"), "x").when(F.col("field") == "C", "y").otherwise("z")
    stages = spark.createDataFrame([("one", 1, "x", 0.5, 1.0), ("two", 2, "y", 0.3, 0.9), ("three", 3, "z", 0.9, 0.9)], "stage string, place int, category string, least double, least_with_conflicts double")
    got = runs.stage_results(rows.withColumn("category", category), stages)
    assert {r["stage"]: (r["total"], r["correct"], r["passed"], r["passed_with_conflicts"]) for r in got.collect()} == {"one": (2, 1, True, True), "two": (3, 1, True, False), "three": (5, 2, False, False)}
    assert runs.highest_passed(got).first()["stage"] == "two"


def test_buckets(spark):
    pages = spark.createDataFrame([("p", "1", routing.NIGHT, True), ("p", "2", routing.NIGHT, False), ("p", "3", routing.REPORT, None), ("q", "1", routing.PRESSURE_LONG, None)], "entity string, image string, route string, official boolean")
    provenance = spark.createDataFrame([("p", "A", "2", 0), ("p", "A", "3", 1), ("p", "B", "3", 0)], "entity string, field string, image string, at int")
    resolution = spark.createDataFrame([("p", "B", "1")], "entity string, field string, image string")
    found = runs.sources(provenance, resolution, pages)
    assert {r["field"]: r["bucket"] for r in found.collect()} == {"A": "night_questionnaire_type_b", "B": "night_questionnaire_type_a"}
    fields = spark.createDataFrame([("p", "A"), ("p", "B"), ("p", "AHI"), ("q", "AHI"), ("q", "other"), ("p", "other"), ("q", "Pr05")], "entity string, field string")
    members = spark.createDataFrame([("AHI", "psg_report_general"), ("AHI", "psg_report_extensive"), ("AHI", "cpap_psg_report_extensive"), ("Pr05", "cpap_psg_report_extensive")], "field string, bucket string")
    got = {(r["entity"], r["field"]): r["bucket"] for r in runs.bucketed(fields, found, members, pages).collect()}
    assert got == {("p", "A"): "night_questionnaire_type_b", ("p", "B"): "night_questionnaire_type_a", ("p", "AHI"): "psg_report_general", ("q", "AHI"): "cpap_psg_report_extensive", ("q", "other"): "cpap_psg_report_extensive", ("p", "other"): "psg_report_general", ("q", "Pr05"): "cpap_psg_report_extensive"}


def test_causes(spark):
    cases = [
        ("Database_ID", "", "1", "1", {}, ("output", "metadata_assembly_gap")), ("X", "a b", "A-B", "", {}, ("output", "formatting_or_minor_text_normalization")), ("Diagnosis_etc", "# severe obstructive apnea", "# severe obstructive apnoea", "", {}, ("output", "formatting_or_minor_text_normalization")),
        ("BQ_01", "1", "2", "2", {}, ("ocr", "checkbox_alignment_error")), ("NREM_sup_min", "", "2", "", {}, ("map", "table_subfield_omission")), ("PSQI_01", "", "2", "2", {}, ("map", "questionnaire_split_omission")),
        ("X", "1", "2", "1", {"resolved": True, "candidate": True}, ("resolve", "wrong_conflict_resolution")), ("X", "1", "2", "1", {"entries": 2}, ("resolve", "document_conflict_chosen_differently")), ("X", "", "2", "2", {"fewer_keys": True}, ("map", "map_omission")),
        ("X", "", "2", "2", {"low_chars": True}, ("ocr", "upstream_ocr_loss")), ("X", "", "2", "2", {"rerouted": True}, ("route", "route_scope_loss")), ("BMI", "1", "2", "2", {"unlike8": True}, ("ocr", "numeric_ocr_error")), ("X", "1", "2", "2", {}, ("map", "extraction_or_parsing_error")), ("X", "1", "2", "3", {}, ("map", "extraction_gap")),
    ]
    base = {"entries": 1, "resolved": False, "in_conflict": False, "candidate": False, "low_chars": False, "unlike6": False, "unlike8": False, "fewer_keys": False, "rerouted": False}
    rows = [{"i": i, "field": field, "value": value, "truth": truth, "other": other} | base | flags for i, (field, value, truth, other, flags, _) in enumerate(cases)]
    got = {r["i"]: (r["stage"], r["cause"]) for r in runs.causes(spark.createDataFrame(rows)).collect()}
    assert got == {i: case[-1] for i, case in enumerate(cases)}


def test_reviews(spark):
    provenance = spark.createDataFrame([("p", "A", "1", "x", "7", 0), ("p", "A", "2", "x", "8", 1), ("p", "A", "3", "y", "1", 2), ("p", "B", "1", "z", "8", 0), ("p", "C", "1", "q", "9", 0)], "entity string, field string, image string, value string, certainty string, at int")
    row = spark.createDataFrame([("p", "A", "x"), ("p", "B", "z"), ("p", "C", "q"), ("p", "D", "n/a")], "entity string, field string, value string")
    assert [tuple(r) for r in runs.uncertain(row, provenance).collect()] == [("p", "A", "x", 7.0, 8.0, ["1", "2"])]
    resolution = spark.createDataFrame([("p", "A", "x", "majority")], "entity string, field string, value string, mode string")
    review = runs.conflict_review(provenance.where("field = 'A'"), resolution).orderBy("place").collect()
    assert [(r["value"], r["n"], r["best"], r["mean"], r["chosen"]) for r in review] == [("x", 2, 8.0, 7.5, "x"), ("y", 1, 1.0, 1.0, "x")]


def test_states(spark):
    df = spark.createDataFrame([(True, None), (None, "x insufficient_quota"), (None, "x"), (None, None)], "s boolean, l string")
    assert [r[0] for r in df.select(runs.status("s", "l")).collect()] == ["COMPLETE", "RUN_INCOMPLETE_QUOTA", "RUN_INCOMPLETE", "MISSING"]
    asked = spark.createDataFrame([("Strict JSON repair assistant", 0), ("candidate CDM fields", 0), ("x", 1), (None, 0)], "t string, n int")
    assert [r[0] for r in asked.select(runs.request_kind("t", "n")).collect()] == ["json_fix", "map", "ocr", "other"]
    errors = spark.createDataFrame([("p", 1, "timeout"), ("p", 2, "status=401 from OpenAI"), ("p", 3, "Missing API key"), ("q", 1, "status=401")], "e string, n int, m string")
    assert [tuple(r) for r in runs.fatal(errors, "e", ["n"], "m").collect()] == [("p", "status=401 from OpenAI")]
    done = spark.createDataFrame([("a", 1, 1), ("b", 1, 0)], "entity string, ocr_ok int, map_ok int")
    assert [r[0] for r in runs.open_entities(spark.createDataFrame([("a",), ("b",), ("c",)], "entity string"), done).orderBy("entity").collect()] == ["b", "c"]
    sums = {r["g"]: (r["n"], r["x"]) for r in runs.group_totals(spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "g string, x int"), "g", ["x"]).collect()}
    assert sums == {"a": (2, 3), "b": (1, 5), None: (3, 8)}


def test_page_evidence(spark):
    kinds = "entity string, page string, text string, route string, n_keys int"
    a, b = spark.createDataFrame([("p", "1", "abcd", "x", 3)], kinds), spark.createDataFrame([("p", "1", "bcde", "y", 9), ("p", "2", "q", "y", 1)], kinds)
    got = {r["page"]: (r["run_chars"], r["other_chars"], r["similarity"], r["run_route"], r["other_keys"]) for r in runs.page_evidence(a, b).collect()}
    assert got == {"1": (4, 4, 0.75, "x", 9), "2": (0, 1, None, None, 1)}


@pytest.fixture(scope="module")
def dictionary(spark):
    keys = [("Name", "A", "basic"), ("ESS_01", "A", "ess"), ("ESS_02", "B", "ess"), ("AHI_total", "B", "common_psg"), ("Pressure_05", "B", "cpap"), ("Pr06_stage", "B", "cpap"), ("PSG_M_01", "B", "mq"), ("SL_min", "B", "psg")]
    rows = [(k, t, c, i, f"about {k}", "1-4", {"1": "one", "0": "none"}) for i, (k, t, c) in enumerate(keys)]
    return spark.createDataFrame(rows, "key string, type string, category string, position int, description string, format string, options map<string,string>")


def test_candidate_keys(spark, dictionary):
    pages = spark.createDataFrame([(1, routing.NIGHT, True), (2, routing.NIGHT, None), (3, routing.REPORT, None), (4, routing.SIGNALS, None), (5, routing.PRESSURE, None)], "p int, r string, o boolean")
    got = {}
    for r in candidates.by_route(dictionary, pages, ["p"], "r", "o").collect():
        got.setdefault(r["p"], set()).add(r["key"])
    assert got == {1: {"Name", "ESS_01"}, 2: {"Name", "ESS_01", "ESS_02"}, 3: {"Name", "AHI_total", "SL_min"}, 4: {"Name"}, 5: {"Name", "AHI_total", "SL_min", "Pressure_05", "Pr06_stage"}}
    assert {r["key"] for r in candidates.by_category(dictionary, "psg").collect()} == {"AHI_total", "SL_min"}
    assert {r["key"] for r in candidates.by_category(dictionary, "qol").collect()} == {"Name"}
    assert {r["key"] for r in dictionary.withColumn("s", F.array(F.lit(5))).where(candidates.for_steps(dictionary, "s")).collect()} == {"AHI_total", "Pressure_05"}


def test_selected_and_packed(spark, dictionary):
    pages = spark.createDataFrame([(1, "Epworth Sleepiness Scale"), (2, "sleep latency 5"), (3, "about psg_m_01")], "p int, t string")
    got = {}
    for r in candidates.selected(pages, "p", "t", dictionary, 1).collect():
        got.setdefault(r["p"], {})[r["key"]] = r["place"]["s"]
    assert got[1]["ESS_01"] == got[1]["ESS_02"] == 1
    assert got[2]["AHI_total"] == got[2]["SL_min"] == 2
    assert got[3] == {"Name": 0, "PSG_M_01": 3}
    blocks = candidates.within(dictionary.withColumn("g", F.lit(1)), ["g"], ["position"], candidates.described(), 230)
    assert [r["key"] for r in blocks.orderBy("position").collect()] == ["Name", "ESS_01"]
    assert blocks.first()["block"].startswith("- Name\n  desc: about Name\n  category: basic")
    assert "options=0=none, 1=one" in dictionary.select(candidates.described(compact=True)).first()[0]
