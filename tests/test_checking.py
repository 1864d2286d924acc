import pytest

from sonde.functions import answers
from sonde.operators import checking as C
from sonde.operators import resolve


def one(spark, t, column):
    return spark.createDataFrame([(t,)], "t string").select(column("t").alias("x")).first()["x"]


@pytest.fixture(scope="module")
def dictionary(spark):
    rows = [
        ("SEX", "Sex", "0-1, 9999", {"0": "Male", "1": "Female"}), ("PSG_Date", "date", "YYYYMMDD", {}), ("AGE", "age", "0-120", {}), ("KIND", "kind", "a, bb", {}), ("Name", "name", None, None), ("PSQI_02_Latency_MM", "minutes", "0-59", {}),
        ("PSQI_02_Latency_MM_week", "minutes", "0-59", {}), ("SEV_freq", "frequency", "0-10", {}), ("Pressure_05", "p", "", {}), ("Pr05_stage", "s", "", {}), ("BMI", "bmi", "10-60", {}),
    ]
    return spark.createDataFrame(rows, "key string, description string, format string, options map<string,string>")


def test_checked(spark, dictionary):
    cases = [
        ("none", "1", None, "unknown_key"), ("SEX", " ", None, "empty"), ("SEX", "[1]", None, "non_scalar"), ("SEX", "1.0", "1", None), ("SEX", "0~1", "1", None), ("SEX", "9999", "9999", None), ("SEX", "1) fem", "1", None), ("SEX", "x", None, "invalid_option"),
        ("PSG_Date", "2024-02-29", "20240229", None), ("PSG_Date", "2023-02-29", None, "invalid_date"), ("KIND", "A", "A", None), ("KIND", "c", None, "invalid_choice"), ("AGE", "about 45.5 y", "45.5", None), ("AGE", "x", None, "not_numeric"), ("AGE", "130", None, "out_of_range"),
        ("AGE", "30~40", "30", None), ("Name", "1,200.0", "1200", None), ("Name", " Kim ", "Kim", None), ("PSQI_02_Latency_MM", "5", None, "psqi_single_variant_disallowed_by_ocr"), ("PSQI_02_Latency_MM_week", "5", "5", None),
    ]
    df = spark.createDataFrame([(i, key, value, "weekfree") for i, (key, value, _, _) in enumerate(cases)], "i int, key string, value string, mode string")
    got = {r["i"]: (r["valid"], r["reason"]) for r in C.checked(df, dictionary, "mode").collect()}
    assert got == {i: case[2:] for i, case in enumerate(cases)}


def test_midpoints(spark, dictionary):
    df = spark.createDataFrame([("SEV_freq", "3-5"), ("PSQI_02_Latency_MM", "10~20")], "key string, value string")
    assert {r["key"]: r["valid"] for r in C.checked(df, dictionary, midpoints=True).collect()} == {"SEV_freq": "5", "PSQI_02_Latency_MM": "15"}


def test_core_fields_fill_what_is_absent(spark, dictionary):
    page = "등록번호: 12345678\nName: Hong Gil ID 9\nSex/Age: M/45\nStudy Date 2012. 5. 22\nTest No. P2012-07\nHeight: 170 cm BMI 99"
    pages = spark.createDataFrame([("p", page)], "page string, t string")
    got = pages.select(*[c.alias(k) for k, c in C.core_fields("t").items()]).first().asDict()
    assert {k: v for k, v in got.items() if v is not None} == {"Hospital_ID": "12345678", "Name": "Hong Gil", "PSG_No": "P2012-07", "PSG_Date": "20120522", "SEX": "Male", "AGE": "45", "Height_cm": "170", "BMI": "99"}
    facts = spark.createDataFrame([("p", "AGE", "44"), ("p", "Name", "Hong")], "page string, key string, valid string")
    rows = {r["key"]: (r["valid"], r["origin"]) for r in C.back_filled(facts, pages, dictionary, "page", "t").collect()}
    assert rows == {"AGE": ("44", "map"), "Name": ("Hong", "map"), "SEX": ("0", "text"), "PSG_Date": ("20120522", "text")}
    hangul = spark.createDataFrame([("p", "성명: 홍길동")], "page string, t string")
    assert C.back_filled(facts.where("key = 'Name'"), hangul, dictionary, "page", "t").first()["valid"] == "홍길동"


def test_line_evidence(spark):
    lines = [("성명: 홍길동 ID: 1234567", "basic"), ("Height 63 cm Weight 144 kg", "psg"), ("직업: 교사 결혼", "phx_habit"), ("교대 근무 selected!: 예", "mq"), ("성별 남 Age 33", "qol"), ("검사일 2012-05-22, 2012년 5월 22일", "basic"), ("", "basic")]
    df = spark.createDataFrame(lines, "line string, c string")
    got = {(r["key"], r["value"], r["source_rank"], r["quality"]) for r in C.line_evidence(df, "c").collect()}
    assert got == {
        ("Name", "홍길동", 14, 3), ("Hospital_ID", "1234567", 14, 2), ("Height_cm", "144", 24, 2), ("Weight_kg", "63", 24, 2), ("Occupation", "교사", 22, 2), ("Shiftwork", "Yes", 22, 1),
        ("SEX", "남", 20, 1), ("AGE", "33", 20, 2), ("PSG_Date", "20120522", 34, 1),
    }


def test_study_numbers(spark):
    cases = [("P12-7", "20120522", "P2012-7"), ("2/ 007", "20020101", "P2002-7"), ("P2011-03", "20120522", "P2011-3"), ("13-5", "20120522", "P13-5"), ("odd", None, "odd"), (None, "20120522", None)]
    df = spark.createDataFrame([(i, n, d) for i, (n, d, _) in enumerate(cases)], "i int, n string, d string")
    assert {r["i"]: r["x"] for r in df.select("i", C.study_number("n", "d").alias("x")).collect()} == {i: want for i, (_, _, want) in enumerate(cases)}


def test_final_row(spark):
    row = {
        "PSG_No": "P12-7", "PSG_Date": "2012-05-22", "PSG_Type": "3", "Previous_Data": "x", "Height_cm": "170", "Weight_kg": "70", "BMI": "30", "PSQI_01_BedIn_HH": "11", "PSQI_01_BedIn_MM": "60", "PSQI_03_BedOut_HH_week": "24", "PSQI_02_Latency_HH": "2", "PSQI_02_Latency_MM": "75",
        "PSG_M_02_SubSL_HH": "30", "PSG_M_02_SubSL_MM": "x", "PHx_HTN": "1.0", "RLS_Category": "2", "IRLS_Category": "9999", "Pressure_05": "5.0", "Pressure_06": "7", "Pr05_position": "Supine  R", "Pr05_stage": "N1, N2", "Pr05_snoring": "--",
    }
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    got = C.final_row(df).first().asDict()
    want = {
        "PSG_No": "P2012-7", "PSG_Date": "2012-05-22", "Database_ID": "001_20120522_7_C", "PSG_Type": None, "Previous_Data": None, "Lab_ID": "1", "Device_Type": "1", "BMI": "24.2", "PSQI_01_BedIn_HH": "23", "PSQI_01_BedIn_MM": "0", "PSQI_03_BedOut_HH_week": "0",
        "PSQI_02_Latency_HH": "2", "PSQI_02_Latency_MM": None, "PSG_M_02_SubSL_HH": None, "PSG_M_02_SubSL_MM": None, "PHx_HTN": "1", "RLS_Category": "0", "IRLS_Category": "9999", "Pressure_05": "5", "Pressure_06": None, "Pr05_position": "supine", "Pr05_stage": "n1,n2,r", "Pr05_snoring": None,
        "Height_cm": "170", "Weight_kg": "70",
    }
    assert got == want


def test_steps_and_guards(spark, dictionary):
    keys = {r["key"] for r in C.expanded_steps(dictionary).collect()}
    assert {"Pressure_05", "Pressure_29", "Pr29_stage"} <= keys
    assert len(keys) == 11 + 2 * 24
    facts = spark.createDataFrame([("Pressure_05", "5"), ("Pressure_06", "7"), ("Pr06_snoring", "-"), ("Pr06_stage", "n1"), ("AGE", "3")], "key string, valid string")
    assert {r["key"]: r["reason"] for r in C.guarded(facts).collect()} == {"Pressure_05": None, "Pressure_06": "cpap_pressure_value_mismatch", "Pr06_snoring": "cpap_placeholder_blank", "Pr06_stage": None, "AGE": None}


def test_diagnoses_and_second_look(spark):
    df = spark.createDataFrame([(["# a\nx\n# b", "see #c and #a", None, "none"],), ([None],)], "v array<string>")
    assert [r[0] for r in df.select(C.diagnoses(df["v"])).collect()] == ["# a # b #c and #a", None]
    long, numbers = "Epworth checked " + "a: 1 " * 60, " ".join(map(str, range(60)))
    cases = [
        (long, 3, True), (long, 12, False), ("short checked: 1 2 3 4 5 6 7 8", 0, False), (" " * 300 + "Epworth checked 1 2 3 4 5 6 7 8", 0, False),
        ("Sleep questionnaire " + numbers, 0, False), ("Sleep questionnaire | " + numbers, 0, True),  # a hint, but of no structure; then of one
        ("Weight " + numbers, 0, False),  # structure without a hint
        ("Sleep questionnaire | " + "x12 y_3 " * 40, 0, False), ("Sleep questionnaire | 수면12 " + "word " * 40 + "a: b\nc:\n\nd\ne : f\n", 0, False),  # numbers in words, three pairs
        ("Sleep questionnaire | " + "word " * 40 + "a: b\nc:\n\nd\ne : f\ng:h", 0, True), (None, 0, False),
    ]
    rows = spark.createDataFrame([(i, t, n) for i, (t, n, _) in enumerate(cases)], "i int, t string, n int")
    assert [r[0] for r in rows.orderBy("i").select(C.second_look("t", "n")).collect()] == [want for _, _, want in cases]


def test_earlier_rules(spark):
    row = {"PSQI_01_BedIn_HH": "11", "PSQI_02_Latency_MM_week": "10", "PSQI_02_Latency_MM_free": None, "PSQI_03_BedOut_HH_week": "7", "PSQI_03_BedOut_HH_free": "9", "PHx_A": "1", "PHx_B": None}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    got = C.one_form(df).first()
    assert (got["PSQI_01_BedIn_HH"], got["PSQI_01_BedIn_HH_week"], got["PSQI_01_BedIn_HH_free"], got["PSQI_03_BedOut_HH_free"], got["PSQI_02_Latency_MM_free"]) == (None, "11", "11", "9", None)
    single = C.one_form(df.select("PSQI_01_BedIn_HH")).first()
    assert (single["PSQI_01_BedIn_HH"], single["PSQI_01_BedIn_HH_week"]) == ("11", None)
    assert tuple(C.history_zeros(df.select("PHx_A", "PHx_B")).first()) == ("1", "0")
    facts = spark.createDataFrame([("k", None, 0), ("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("m", "x", 0), ("t", "q", 1), ("t", "p", 0)], "k string, v string, n int")
    assert {r["k"]: (r["chosen"], r["conflict"]) for r in resolve.first_seen(facts, ["k"], "v", ["n"]).collect()} == {"k": ("b", True), "m": ("x", False), "t": ("p", True)}
    assert {r["k"]: (r["chosen"], r["conflict"]) for r in resolve.most_seen(facts, ["k"], "v", ["n"]).collect()} == {"k": ("a", True), "m": ("x", False), "t": ("p", True)}


def test_answers(spark):
    said = 'Sure: {"A": {"CDM_Context": "c", "value": 1, "input_context": {"who_filled": "Patient", "question": "q?", "page": "[page_type: night] x"}, "certainty": {"total_score": 7}}, "B": "x", "C": null, "D": [1, 2]} done'
    df = spark.createDataFrame([(1, said), (2, "no object"), (3, '{"E": {"value": "y", "filler": "doctor", "text": "t"}}'), (4, None)], "id int, t string")
    rows = {r["key"]: r for r in answers.wrapped_values(df, ["id"], "t").collect()}
    assert set(rows) == set("ABCDE")
    a = rows["A"]
    assert (a["value"], a["about"], a["filled_by"], a["question"], a["page_type"], a["certainty"]) == ("1", "c", "patient", "q?", "night", "7")
    assert (rows["B"]["value"], rows["C"]["value"], rows["D"]["value"]) == ("x", None, "[1,2]")
    assert (rows["E"]["value"], rows["E"]["filled_by"], rows["E"]["question"]) == ("y", "doctor", "t")
    records = ['{"response": {"candidates": [{"content": {"parts": [{"text": " a "}, {"text": "a"}, {"text": "b"}]}}]}}', '{"response": {"candidates": [{"text": "c"}]}}', '{"response": {"candidates": [{"x": {"answer": "d \\"e\\""}}]}}', '{"error": {"message": "m"}}', '{"error": "z"}']
    got = spark.createDataFrame([(r,) for r in records], "r string").select(answers.batch_text("r"), answers.batch_error("r")).collect()
    assert [tuple(r) for r in got] == [("a\nb", None), ("c", None), ('d "e"', None), (None, "m"), (None, "z")]
    used = ['{"usage_metadata": {"total_tokens": 5}}', '{"totalTokenCount": 7}', '{"response_metadata": {"usage_metadata": {"input_tokens": 2, "output_tokens": 3}}}', '{"prompt_tokens": 1, "completion_tokens": 1}', "{}"]
    assert [r[0] for r in spark.createDataFrame([(u,) for u in used], "u string").select(answers.total_tokens("u")).collect()] == [5, 7, 5, 2, None]


def test_limits(spark):
    rows = [({" Retry-After ": "2s", "X-RateLimit-Limit-Requests": "60"}, ""), ({"x-ratelimit-reset-tokens": "1m2s"}, ""), ({}, "Please try again in 1.5s."), ({}, "no")]
    got = [r[0] for r in spark.createDataFrame(rows, "h map<string,string>, b string").select(answers.limits("h", "b")).collect()]
    assert [r["retry_after_sec"] for r in got] == [2.0, 62.0, 1.5, None]
    assert got[0]["limit_requests"] == 60.0
    last = answers.last_by_key(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, n int, v string"), "k", ["n"])
    assert {r["k"]: r["v"] for r in last.collect()} == {"a": "y", "b": "z"}


def test_dictionary_goes_to_the_facts(spark):
    """A dictionary is small and a few keys hold most facts, so facts aren't dealt by key; each value is brought to its form once a row."""
    facts = spark.range(1000).selectExpr("case when id % 10 < 9 then 'n' else 'c' end as key", "id % 50 as value").selectExpr("key", "cast(value as string) as value")
    dictionary = spark.createDataFrame([("n", "", "5-40", {}), ("c", "", "", {"1": "one"})], "key string, description string, format string, options map<string,string>")
    rows = C.checked(facts, dictionary)
    assert rows.columns == ["key", "value", "reason", "valid"]
    assert {(r["reason"], r["count"]) for r in rows.groupBy("reason").count().collect()} == {(None, 640), ("out_of_range", 260), ("invalid_option", 100)}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
