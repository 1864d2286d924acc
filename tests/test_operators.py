import random

import pytest
from pyspark.sql import functions as F

from sonde.functions import names
from sonde.functions import scalars as S
from sonde.operators import evaluate, hamming, intervals, resolve, routing, signals, text
from sonde.plans import catalog
from sonde.sources import readers, writers


@pytest.mark.parametrize(
    ("column", "value", "want"),
    [
        (S.normalise_value, " N/A ", None), (S.normalise_value, " x ", "x"), (S.canonical_value, "1,200.50", "1200.5"), (S.canonical_value, "3.0", "3"), (S.canonical_value, "nan", None), (S.canonical_value, "a  b", "a b"),
        (S.lenient_number, "0..2", 0.2), (S.lenient_number, "15.", 15.0), (S.lenient_number, "--", None), (S.lenient_number, "7 /hr", 7.0), (S.first_number, "about 1,250 g", 1250.0), (S.strict_number, "12a", None),
        (S.valid_date, "on 20240229.", "20240229"), (S.valid_date, "20240230", None), (S.clock_seconds, "01:02:03.5", 3723.5), (S.clock_seconds, "x", None), (S.duration_seconds, "Arousal - Dur: 2 min", 120.0), (S.duration_seconds, "Dur: 7.5 sec", 7.5),
        (S.backoff_seconds, "1h2m3.5s", 3723.5), (S.backoff_seconds, "250ms", 0.25), (S.backoff_seconds, "12", 12.0), (S.percentage, "95.5% (1/2)", 0.955), (S.token_estimate, "", 1), (S.option_label, " 2) Some  Times ", "some times"), (S.identifier, "Sleep-Eff (%)", "sleep_eff"),
        (S.range_value, "10~12", 11.0), (S.range_value, "between 2 and 4", 3.0), (S.range_value, "5 to 3", 4.0), (S.range_value, "9", 9.0), (S.number_token, "2.0", "2"), (S.number_token, "2.34567", "2.3457"),
    ],
)
def test_scalar(spark, column, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(column("v").alias("x")).first()["x"] == want


def test_clock_hours(spark):
    got = spark.createDataFrame([(h,) for h in (24, 12, 9, 23, 30)], "h int").select(S.clock_hour("h").alias("a"), S.clock_hour("h", bed=True).alias("b")).collect()
    assert [tuple(r) for r in got] == [(0, 0), (12, 0), (9, 21), (23, 23), (None, None)]


def test_next_token_wants_a_free_label(spark):
    df = spark.createDataFrame([("x-AHI 3 AHI 12.5 /hr",)], "t string")
    assert df.select(S.next_token("t", "AHI").alias("x")).first()["x"] == "12.5"


def test_ranges(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 4, 6), ("a", 9, 9), ("a", 2, 2), ("b", 5, 8)], "k string, lo int, hi int")
    assert sorted(map(tuple, intervals.coalesce_ranges(df, ["k"], "lo", "hi").collect())) == [("a", 1, 6), ("a", 9, 9), ("b", 5, 8)]
    minus = spark.createDataFrame([("a", 3, 4), ("b", 1, 9)], "k string, lo int, hi int")
    assert sorted(map(tuple, intervals.subtract_ranges(df, minus, ["k"], "lo", "hi").select("k", "lo", "hi").collect())) == [("a", 1, 2), ("a", 5, 6), ("a", 9, 9)]
    assert intervals.normalise(spark.createDataFrame([(5, 2), (0, 3), (None, 1)], "lo int, hi int"), "lo", "hi").collect() == [(2, 5)]


def test_coalesce_of_equal_ranges(spark):
    """Equal ranges that begin an island don't reach the one before, whatever their order."""
    rng = random.Random(5)
    rows = [(k, lo, lo + rng.randrange(4)) for k in range(40) for lo in (rng.randrange(60) for _ in range(8)) for _ in range(rng.randrange(1, 4))]
    rows += [(k, lo, hi) for k, lo, hi in rows if rng.random() < 0.5]
    want = set()
    for k in range(40):
        days = sorted({d for g, lo, hi in rows if g == k for d in range(lo, hi + 1)})
        runs = [d for i, d in enumerate(days) if not i or days[i - 1] + 1 < d], [d for i, d in enumerate(days) if i + 1 == len(days) or days[i + 1] > d + 1]
        want |= {(k, a, b) for a, b in zip(*runs, strict=True)}
    got = [tuple(r) for r in intervals.coalesce_ranges(spark.createDataFrame(rows, "k int, lo int, hi int").repartition(7), ["k"], "lo", "hi").collect()]
    assert len(got) == len(want) and set(got) == want


def test_majority_modes(spark):
    facts = spark.createDataFrame(
        [("single", "a", 1.0), ("majority", "a", 0.0), ("majority", "a", 0.0), ("majority", "b", 9.0), ("certainty", "a", 1.0), ("certainty", "b", 2.0), ("pending", "a", 2.0), ("pending", "b", 2.0), ("none", "a", None), ("none", "b", None)],
        "k string, v string, c double",
    )
    got = {r["k"]: (r["mode"], r["chosen"]) for r in resolve.majority(facts, ["k"], "v", "c").collect()}
    assert got == {"single": ("single", "a"), "majority": ("majority", "a"), "certainty": ("certainty", "b"), "pending": ("pending", None), "none": ("pending", None)}


def test_annotated_samples(spark):
    """A flag for each type, all that starts at a sample in order, stages by epochs of 3 seconds, two recordings."""
    samples = spark.range(100).select(F.explode(F.array(F.lit("r"), F.lit("s"))).alias("recording"), F.col("id").alias("sample_index"))
    said = [
        ("r", 3.2, "Stage - N1", None), ("r", 3.4, "Stage - N2", None), ("r", 6.1, "Stage - REM - x", 30.0), ("r", 0.5, "Apnea - long", 0.3), ("r", 0.5, "LM", None), ("r", 0.6, "Apnea - again", 5.0),
        ("r", 0.7, "Low Sat. - 80", 2.5), ("r", 0.5, "Apnea - too", 0.0), ("r", -1.0, "Apnea - early", 9.0), ("s", 1.0, "LM - left", 0.04),
    ]
    marks = spark.createDataFrame(said, "recording string, t_sec double, description string, duration_sec double")
    rows = signals.active_columns(signals.annotated(samples, marks, 10, epoch_seconds=3), ["Apnea", "Low Sat.", "LM"]).collect()
    got = {(r["recording"], r["sample_index"]): r for r in rows}
    assert len(rows) == len(got) == 200
    r = [got["r", i] for i in range(100)]
    assert [x["stage"] for x in r] == ["N2"] * 60 + ["REM - x"] * 40
    assert [x["epoch"] for x in r] == [i // 30 + 1 for i in range(100)]
    assert [x["apnea_active"] for x in r] == [int(5 <= i < 8 or 6 <= i < 56) for i in range(100)]
    assert [x["low_sat_active"] for x in r] == [int(7 <= i < 32) for i in range(100)]
    assert {x["lm_active"] for x in r} == {0}
    assert (r[5]["onset_types"], r[5]["onset_descriptions"]) == ("Apnea;LM", "Apnea - long;Apnea - too;LM")
    assert (r[8]["onset_types"], r[8]["onset_descriptions"], r[32]["onset_types"], r[7]["active_types"]) == (None, None, "Stage", ["Apnea", "Low Sat."])
    assert [(i, got["s", i]["stage"]) for i in range(100) if got["s", i]["lm_active"]] == [(10, None)]
    assert [tuple(x) for x in signals.duration_types(marks).collect()] == [("Apnea", 3), ("LM", 1), ("Low Sat.", 1)]


def test_pages_merge_with_markers(spark):
    pages = spark.createDataFrame([("e", "b.jpg", "two"), ("e", "a.jpg", "one"), ("e", "c.jpg", " ")], "entity string, page string, text string")
    merged = text.merged_pages(pages, "entity", "page", "text").first()["text"]
    assert merged == "[SOURCE_IMAGE: a.jpg]\none\n\n[SOURCE_IMAGE: b.jpg]\ntwo"
    rows = text.lines(spark.createDataFrame([(merged + "\n12\n---\n",)], "text string"), [], "text").where("informative").collect()
    assert [r["line"] for r in rows] == ["one", "two"]


def test_near_pairs_finds_all(spark):
    values = [0, 1, 3, 255, 1 << 40, -1, -2]
    df = spark.createDataFrame(list(enumerate(values)), "id long, bits long")
    want = {(i, j) for i in range(7) for j in range(i + 1, 7) if ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 2}
    assert {(r["a"], r["b"]) for r in evaluate.near_pairs(df, "id", "bits", 2).collect()} == want


def test_csv_encodings_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("이름,value\n홍길동,1\n".encode("cp949"))
    (tmp_path / "b.csv").write_bytes('이름,other\n"김\n철수",x\n'.encode())
    df = readers.csv_any_encoding(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["이름", "value", "other", "none"])
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("홍길동", "1", None, None), ("김\n철수", None, "x", None)], key=str)
    writers.wide_csv(df, str(tmp_path / "out"), ["이름", "value", "gone"])
    back = spark.read.csv(str(tmp_path / "out"), header=True, multiLine=True, escape='"')
    assert back.columns == ["이름", "value", "gone"]
    assert {r["이름"] for r in back.collect()} == {"홍길동", "김\n철수"}
    with pytest.raises(ValueError, match="NQ_text"):
        readers.require(df, "NQ_text")
    assert writers.markdown(df.select("value").orderBy("value")).splitlines()[2:] == ["| (blank) |", "| 1 |"]


def test_dictionary_and_texts(spark, tmp_path):
    (tmp_path / "d.csv").write_text("csv key,en,ko,0,1,2\nSEX,Sex,Sex,male,female,\nAGE,Age,years,,,\n")
    got = {r["key"]: (r["description"], r["options"]) for r in readers.dictionary(spark, str(tmp_path / "d.csv"), "csv key", ["en", "ko"]).collect()}
    assert got == {"SEX": ("Sex", {"0": "male", "1": "female"}), "AGE": ("Age | years", {})}
    (tmp_path / "p1").mkdir()
    (tmp_path / "p1" / "x.txt").write_text("a\nb")
    assert [tuple(r) for r in readers.texts(spark, str(tmp_path)).collect()] == [("p1", "x.txt", "a\nb")]


def test_encodings_of_whole_files(spark, tmp_path):
    """What comes after the first megabyte decides too; files alike in encoding and columns are one scan."""
    head = "name,value\n" + "a,1\n" * 300_000
    (tmp_path / "late.csv").write_bytes((head + "홍길동,2\n").encode("cp949"))
    (tmp_path / "mark.csv").write_bytes("name,value\nb,3\n".encode("utf-8-sig"))
    (tmp_path / "other.csv").write_bytes("value,name\n4,é\n".encode())
    paths = [str(tmp_path / f"{n}.csv") for n in ("late", "mark", "other")]
    df = readers.csv_any_encoding(spark, paths)
    assert {(r["name"], r["value"]) for r in df.where("name <> 'a'").collect()} == {("홍길동", "2"), ("b", "3"), ("é", "4")}
    assert df.count() == 300_003
    kinds = {r["path"].rsplit("/", 1)[1]: (r["encoding"], r["header"]) for r in readers.csv_kinds(spark, paths).collect()}
    assert kinds == {"late.csv": ("cp949", ["name", "value"]), "mark.csv": ("utf-8", ["name", "value"]), "other.csv": ("utf-8", ["value", "name"])}


def test_field_dictionary(spark, tmp_path):
    (tmp_path / "cdm.csv").write_bytes(
        "csv key,설명,Korean_Context,English_Context,Format/Range,1,0,Type,semantic_allowed,map category,assessment cdm type\n"
        "SEX,성별,성별,Sex,,female,male,a,0,BASIC,x\nPressure_05,,,pressure,4-20,,,,,cpap_report,\nnan,,,,,,,,,,\nPr05_stage,,nan,stage,,,,b,2,Cpap,\nPressure_07,,,own,,,,C,,,\n,,,,,,,,,,\nESS_01,,,,0-3,,,A,1,Epworth_Sleepiness_Scale,\n".encode("cp949")
    )
    rows = readers.field_dictionary(spark, str(tmp_path / "cdm.csv")).orderBy("position").collect()
    by = {r["key"]: r for r in rows}
    assert [r["key"] for r in rows][:7] == ["SEX", "Pressure_05", "Pr05_stage", "Pressure_07", "ESS_01", "Pressure_06", "Pr06_stage"]
    assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
    sex = by["SEX"]
    assert (sex["description"], sex["options"], sex["type"], sex["semantic_allowed"], sex["category"], sex["assessment_type"], sex["format"]) == ("성별 | Sex", {"0": "male", "1": "female"}, "A", 0, "basic", "x", "")
    assert (by["Pr05_stage"]["description"], by["Pr05_stage"]["semantic_allowed"], by["Pr05_stage"]["category"]) == ("stage", 1, "cpap")
    assert (by["Pressure_07"]["description"], by["Pressure_07"]["type"], by["Pressure_08"]["format"]) == ("own", "B", "4-20")
    assert by["ESS_01"]["category"] == "ess"
    assert sum(k.startswith("Pressure_") for k in by) == sum(k.endswith("_stage") for k in by) == 25


def test_names(spark):
    said = [" PSG_Report ", "Questionnaire", "berlin_questionnaire", "category__psg.txt", "map_route_psg_report", "map_route_unheard", "Zzz", None, "not used"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(said)], "i int, t string").orderBy("i").select(names.category_name("t"), names.route_name("t"), names.source_name("t")).collect()
    night, general = "map_route_night_questionnaire", "map_route_psg_report_general"
    assert [tuple(r) for r in rows] == [
        ("psg", general, "psg"), ("questionnaire", night, night), ("berlin", night, "berlin"), ("category__psg.txt", night, "category__psg.txt"), ("map_route_psg_report", general, general),
        ("map_route_unheard", night, night), ("zzz", night, "Zzz"), ("", night, ""), ("not_used", night, "not used"),
    ]
    said = spark.createDataFrame([("r1", "low", "psg_report", "HIGH"), ("r1", "low", None, "sure"), ("r1", "low", "odd", None)], "r string, c string, s string, k string")
    route, confidence = routing.decided(F.col("r"), F.col("c"), F.col("s"), F.col("k"))
    assert [tuple(r) for r in said.select(route, confidence).collect()] == [(general, "high"), ("r1", "low"), (night, "low")]
    shown = spark.createDataFrame([("a\nNight Polysomnography Report",), (" NIGHT POLYSOMNOGRAPHY REPORT x",), ("b",), (None,)], "t string").select(routing.router_text("t")).collect()
    assert [r[0] for r in shown] == ["NIGHT POLYSOMNOGRAPHY REPORT\na\nNight Polysomnography Report", " NIGHT POLYSOMNOGRAPHY REPORT x", "b", ""]


def test_near_classes_have_all_pairs_of_near_pairs(spark):
    """Every pair at most one bit apart is told by classes and their links, also where very many rows share a hash."""
    rng = random.Random(3)
    hashes = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(10)]
    hashes += [x ^ -(1 << 63) if k == 63 else x ^ (1 << k) for x in hashes for k in (0, 5, 62, 63)] + [0, -1]
    rows = [(i, rng.choice(hashes) if i % 3 else hashes[0]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, bits long")
    want = {(r["a"], r["b"]) for r in evaluate.near_pairs(df, "id", "bits", 1).collect()}
    got = {r["id"]: r for r in evaluate.near_classes(df, "id", "bits").collect()}
    near = {i: {r["class_id"], *map(int, (r["near"] or "").split(",") if r["near"] else ())} for i, r in got.items()}
    assert {(a, b) for a in got for b in got if a < b and got[b]["class_id"] in near[a]} == want
    assert {i: r["links"] for i, r in got.items()} == {i: sum(i in p for p in want) for i, _ in rows}


@pytest.mark.parametrize("size", [1 << 15, 40])
def test_near_links_equal_all_pairs(spark, monkeypatch, size):
    """All 256 bits count, up to six may differ, in any of the numbers; also with files in slices and many rows of one hash."""
    monkeypatch.setattr(hamming, "FILE", size)
    rng = random.Random(6)
    turned = lambda h, n: [x ^ sum((1 << k if k < 63 else -(1 << 63)) for k in range(64) if 64 * i + k in n) for i, x in enumerate(h)]
    bases = [[rng.randrange(-(1 << 63), 1 << 63) for _ in range(4)] for _ in range(5)]
    hashes = bases + [turned(rng.choice(bases), set(rng.sample(range(256), rng.randrange(1, 9)))) for _ in range(120)]
    rows = [(i, hashes[0] if i % 3 == 0 else rng.choice(hashes)) for i in range(400)]
    far = lambda x, y: sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(x, y, strict=True))
    want = {}
    for i, h in rows:
        near = [(j, far(h, x)) for j, x in rows if far(h, x) <= 6]
        want[i] = (min(j for j, d in near if not d), len(near) - 1, min((j for j, d in near if d), default=None))
    got = {r["id"]: (r["class_id"], r["links"], r["first_near"]) for r in evaluate.near_links(spark.createDataFrame(rows, "id long, h array<long>"), "id", "h", 4, 6).collect()}
    assert got == want


def test_near_dup_reads_the_whole_hash(spark, tmp_path):
    """Texts whose hashes differ beyond the first 64 bits only are different classes, and linked."""
    spark.createDataFrame([(1, "is is is", "s"), (2, "hi hi hi", "s"), (3, "is is", "s")], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: (r["class_id"], r["links"]) for r in catalog.queries()["q33_near_dup"](spark, str(tmp_path)).collect()} == {1: (1, 2), 2: (2, 2), 3: (1, 2)}
