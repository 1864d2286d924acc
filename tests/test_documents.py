import __spark_entry__
import compare
import pytest
from pyspark.sql import functions as F

from sonde.operators import routing, splitting, text


def one(spark, t, column):
    return spark.createDataFrame([(t,)], "t string").select(column("t").alias("x")).first()["x"]


def test_routes(spark):
    cases = [
        ("FULL  NIGHT CPAP Polysomnography Report", routing.PRESSURE_LONG, "high"), ("Night polysomnography report", routing.REPORT_LONG, "high"), ("아침 질문 사항", routing.MORNING, "high"), ("Epworth Sleepiness Scale", routing.NIGHT, "high"),
        ("This page contains psg signal graphs.", routing.SIGNALS, "high"), ("nasal CPAP titration, optimal CPAP pressure 9", routing.PRESSURE, "high"), ("수면다원검사 Sleep efficiency AHI Diagnosis", routing.REPORT, "high"), ("환자 수면 1. x", routing.NIGHT, "low"), ("", routing.SIGNALS, "low"),
    ]
    rows = routing.routed(spark.createDataFrame([(page,) for page, _, _ in cases], "t string"), "t").collect()
    assert {r["t"]: (r["route"], r["confidence"]) for r in rows} == {page: (route, confidence) for page, route, confidence in cases}


def test_families_go_on(spark):
    pages = [
        ("a", 1, routing.NIGHT, "Pittsburgh Sleep Quality Index"), ("a", 2, routing.NIGHT, "rate your sleep quality overall"), ("a", 3, routing.NIGHT, "other"), ("a", 4, routing.NIGHT, "rate your sleep quality overall"),
        ("a", 5, routing.NIGHT, "Beck depression inventory"), ("a", 6, routing.NIGHT, "more"), ("a", 7, routing.REPORT, "Beck Depression Inventory"), ("a", 8, routing.NIGHT, "more"),
        ("b", 1, routing.NIGHT, "WHOQOL-BREF"), ("b", 2, routing.NIGHT, "x"), ("b", 3, routing.NIGHT, "Living habit"), ("b", 4, routing.NIGHT, "x"), ("b", 5, routing.MORNING, "아침 질문 사항"), ("b", 6, routing.NIGHT, "x"),
    ]
    rows = routing.families(spark.createDataFrame(pages, "e string, p int, r string, t string"), ["e"], ["p"], "r", "t").orderBy("e", "p").collect()
    assert [r["official_family"] for r in rows] == ["PSQI", "PSQI", "NON", "NON", "BDI", "BDI", "NON", "NON", "QOL", "QOL", "NON", "NON", "MQ", "NON"]


def test_categories_and_modes(spark):
    assert one(spark, "오늘 아침 어떻게 잠에서 깨어났습니까 CPAP", routing.categories) == ["mq"]
    assert one(spark, "CPAP arousal index", routing.categories) == ["cpap"]
    assert one(spark, "Name: x\n음주\nPHQ", routing.categories) == ["basic", "phx_habit", "phq"]
    assert one(spark, "zzz", routing.categories) == one(spark, None, routing.categories) == ["phx_habit"]
    assert one(spark, "주중", routing.week_mode) == "weekfree"
    assert one(spark, None, routing.week_mode) == "single"
    for v, want in (("3", "C"), ("5.0", "M"), ("type sp", "SP"), ("9", None), ("x", None), (None, None)):
        assert one(spark, v, routing.study_type) == want


def test_pressure_steps_and_types(spark):
    page = "Nasal CPAP titration\nPressure 5 ~ 8 cmH2O\n* Pressure 10 cmH2O\n | 12 / 30.5\n14 | 0 | x\nOptimal CPAP pressure: 9 cm\nnasal CPAP at 11 cm\nPressure 50 - 60 cmH2O"
    df = spark.createDataFrame([(1, "a", page, "cpap"), (1, "b", "nothing", "psg"), (2, "a", "MSLT", "psg"), (3, "a", "x", "psg"), (4, "a", "x", "psg")], "e int, p string, t string, c string")
    r = {(r["e"], r["p"]): r for r in routing.steps_named(df, ["e", "p"], "t").collect()}
    got = r[1, "a"]
    assert (got["allowed"], got["detected"], got["explicit"], got["optimal"], got["advised"], got["report"]) == ([5, 6, 7, 8, 10, 12], [5, 6, 7, 8, 9, 10, 11, 12], [10, 12], [9], [11], True)
    assert r[1, "b"]["detected"] == []
    assert r[1, "b"]["report"] is False
    given = spark.createDataFrame([(1, None, None), (2, None, None), (3, None, "P2012-1"), (4, "SP", None), (5, None, None)], "e int, PSG_Type string, PSG_No string")
    assert {r["e"]: r["type"] for r in routing.inferred_types(df, "e", "p", "c", "t", given).collect()} == {1: "C", 2: "M", 3: "P", 4: "SP", 5: None}


DOC = """[SOURCE_IMAGE: 1.jpg]
등록번호: 1234567
신장: 170 cm

음주에 관한 질문
---
Epworth Sleepiness Scale

1. book 0
2. tv 1
[SOURCE_IMAGE: 2.jpg]
아침 질문 사항
1. 어젯밤
Snoring / Apnea [selected!]
EDS [not selected]
[SOURCE_IMAGE: 3.jpg]
9. 낮잠
밤에 수면시간이 충분하다고 느끼십니까
13. x
14. y
꿈을 많이 꾸십니까 예

고약한 잠버릇 아니오
15. z"""


@pytest.fixture(scope="module")
def lines(spark):
    return text.lines(spark.createDataFrame([("d", DOC)], "doc string, t string"), ["doc"], "t").cache()


def spans(df):
    return sorted((r["category"], r["lo"], r["hi"]) for r in df.collect())


def test_ranges_by_rule(lines):
    assert spans(splitting.morning_ranges(lines, ["doc"])) == [("mq", 12, 15)]
    assert spans(splitting.checklist_ranges(lines, ["doc"])) == [("not_used", 14, 15)]
    assert spans(splitting.history_ranges(lines, ["doc"])) == [("sleep_behavior", 17, 19)]
    assert spans(splitting.question_ranges(lines, ["doc"], "rbd", patterns=splitting.DREAMS)) == [("rbd", 21, 21), ("rbd", 23, 23)]
    assert spans(splitting.question_ranges(lines, ["doc"], "q", numbers=(2, 9))) == [("q", 10, 10), ("q", 17, 18)]
    assert spans(splitting.person_ranges(lines, ["doc"])) == [("basic", 2, 4)]


def test_ranges_are_repaired(spark, lines):
    r = spark.createDataFrame([("d", "ess", 7, 7), ("d", "phx_habit", 2, 14), ("d", "sleep_behavior", 16, 24), ("d", "rbd", 1, 1)], "doc string, category string, lo int, hi int")
    assert spans(splitting.expanded(r.where("category = 'ess'"), lines, ["doc"])) == [("ess", 7, 10)]
    got = spans(splitting.finalised(r, lines, ["doc"]))
    assert got == [("basic", 2, 4), ("ess", 7, 10), ("mq", 12, 15), ("not_used", 14, 15), ("phx_habit", 5, 6), ("phx_habit", 11, 11), ("rbd", 21, 21), ("rbd", 23, 23), ("sleep_behavior", 16, 20), ("sleep_behavior", 22, 22), ("sleep_behavior", 24, 24)]


def test_texts_leftovers_and_coverage(spark, lines):
    r = spark.createDataFrame([("d", "ess", 7, 10), ("d", "basic", 1, 6)], "doc string, category string, lo int, hi int")
    texts = {x["category"]: x["text"] for x in splitting.text_of(lines, r, ["doc"], ["category"]).collect()}
    assert texts == {"ess": "Epworth Sleepiness Scale\n\n1. book 0\n2. tv 1", "basic": "등록번호: 1234567\n신장: 170 cm\n\n음주에 관한 질문\n---"}
    left = splitting.leftover(lines, r, ["doc"])
    assert sorted((x["lo"], x["hi"]) for x in left.collect()) == [(12, 15), (17, 21), (23, 24)]
    best = {x["lo"]: x["category"] for x in splitting.best_categories(lines, left, ["doc"]).collect()}
    assert best == {12: "mq", 17: "sleep_behavior", 23: "rbd"}
    c = splitting.coverage(lines, r.union(spark.createDataFrame([("d", "x", 99, 99)], r.schema)), ["doc"]).first()
    assert (c["informative"], c["covered"], c["outside"], c["valid"]) == (17, 6, 1, False)
    parts = spark.createDataFrame([("d", "x", "Epworth Sleepiness Scale\nnot there at all\nab")], "doc string, category string, text string")
    merged = spark.createDataFrame([("d", DOC)], "doc string, text string")
    assert [x["line"] for x in splitting.missing_lines(parts, merged, ["doc"]).collect()] == ["not there at all"]


def test_small_text_rules(spark):
    body = "\n".join(map(str, range(40)))
    got = one(spark, body, splitting.halves)
    assert [len(t.split("\n")) for t in got] == [6 + 17, 6 + 17]
    assert got[1].split("\n")[:7] == ["0", "1", "2", "3", "4", "5", "23"]
    assert one(spark, " a\nb ", splitting.halves) == ["a\nb"]
    assert one(spark, "( [Yes] gout, [No]  a b )", splitting.ticked_items) == ["[Yes] gout", "[No] a b"]
    m = one(spark, "trigger [Yes][no]", lambda c: splitting.marks(c, "trigger", 2))
    assert (m["yes"], m["no"], m["complete"]) == (1, 1, True)
    assert one(spark, "x", lambda c: splitting.marks(c, "trigger"))["complete"] is True
    pages = spark.createDataFrame([("e", "1", "x"), ("e", "2", "y")], "e string, p string, t string").withColumn("c", F.when(F.col("p") == "1", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"))))
    assert {r["category"]: r["text"].count("SOURCE") for r in splitting.pages_by_category(pages, "e", "p", "t", "c").collect()} == {"a": 2, "b": 1}
    rows = splitting.page_offsets(spark.createDataFrame([("e", 1, 3), ("e", 2, 2)], "e string, p int, n int"), ["e"], "p", "n").orderBy("p").collect()
    assert [(r["first"], r["last"]) for r in rows] == [(1, 3), (5, 6)]


ODD_LINES = ("12 34\n3\xa04 \n\xa0　\n\x0b\n%&! 7\nwords here\npage 3\n·•\n", "a\rb\r\nc the d\r\n\n　1　\n(2)\n7 / 8\nthe end", "1\n2\n3", "", " the \n- 5 -\n5 6\n\xa0\n?\n", "x")


@pytest.mark.parametrize("name", ["q14_line_table", "q20_leftover_coverage", "q69_split_coverage", "q70_split_leftover"])
def test_queries_of_lines_on_odd_texts(spark, tmp_path, name):
    """Lines of digits, of spaces of any kind, of decoration, other line breaks; ids that repeat."""
    rows = [(i, t * k, "s") for i, (t, k) in enumerate((t, k) for k in (1, 3) for t in ODD_LINES)]
    if name in ("q69_split_coverage", "q70_split_leftover"):
        rows += [(i, t + "\nmore words\n5\n\nand more", "s") for i, t, _ in rows]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    compare.same(spark, __spark_entry__.queries()[name], __spark_entry__.oracle_sql()[name], str(tmp_path))


def test_pairs_of_letters_on_odd_texts(spark, tmp_path):
    """Runs of one letter, letters beside other characters, empty texts and single letters are counted as SQL counts them."""
    texts = ["", "e", "ee", "eee", "eeeet tt", "eaaae eeéee", "the end, the ends.. ..", "x", None, "aabbaaa", " ".join(["eee ooo"] * 40)]
    rows = [(i, t, "s") for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("q33_near_dup", "q58_ordered_keep"):
        compare.same(spark, __spark_entry__.queries()[name], __spark_entry__.oracle_sql()[name], str(tmp_path))
