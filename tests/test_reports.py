import pytest
from pyspark.sql import functions as F

from sonde.operators import reports as R


@pytest.mark.parametrize(
    ("column", "value", "want"),
    [
        (R.waso_percent, "WASO 45.0 min\n 9.5 (%)", 9.5), (R.waso_percent, "WASO 45", None), (R.lowest_saturation, "Lowest SaO2 Awake 94 % Lowest SaO2 : 81 %", 81.0), (R.lowest_saturation, None, None),
        (R.movement_arousals, "PLM Arousal 4.3 /hr x PLM Arousal 15. PLM Arousal index 2", 15.0), (R.movement_arousals, "PLM Arousal 4.3 /hr", None),
        (R.sleep_minutes, "1 시간 30 분", 90.0), (R.sleep_minutes, "10-20 분", 15.0), (R.sleep_minutes, "5분", 5.0), (R.sleep_minutes, "6~7 시간", 390.0), (R.sleep_minutes, "1.5시간", 90.0), (R.sleep_minutes, "x", None),
        (R.wakings, "2-3 번", 3.0), (R.wakings, "4번", 4.0), (R.wakings, "", None),
        (lambda c: R.answer_code(c, R.COMPARED), "훨씬 길다", 1), (lambda c: R.answer_code(c, R.COMPARED), "길다", 2), (lambda c: R.answer_code(c, R.COMPARED), " 4. ", 4),
        (lambda c: R.answer_code(c, R.ALERTNESS), "깨어 있으며 정신이 맑다", 4), (lambda c: R.answer_code(c, R.ALERTNESS), "5.", None), (lambda c: R.answer_code(c, R.WOKEN_BY), "자발적으로", 4),
    ],
)
def test_fields(spark, column, value, want):
    assert spark.createDataFrame([(value,)], "v string").select(column("v").alias("x")).first()["x"] == want


def test_study_ids(spark):
    df = spark.createDataFrame([("2024-03-01", "P2024-007", "p"), ("20240301", "12", "SP"), (None, "1", "P"), ("2024-03-01", "x", "P"), ("20240301", "1", " ")], "d string, n string, k string")
    assert [r[0] for r in df.select(R.study_id("d", "n", "k")).collect()] == ["001_20240301_7_P", "001_20240301_12_SP", None, None, None]


def test_titration(spark):
    table = "head\r\nPressure Resp. Spon. x\r\n5.0 10 Supine REM 3.2 1 2 3 mild to LOUD 90 1 2 3\r\n6 20 Lateral N2 0..2 1 2 3 91 - 0 1\n7.5 1 a b 1 2 3 4 5 6 7 8\n17.0\nnote\n5 11 Supine N1 4 1 2 3 none 88 1 2 3\nOptimal CPAP 7\n8 1 a b 1 2 3 4 5 6 7 8\n"
    df = spark.createDataFrame([(1, table), (2, "none"), (3, None)], "id int, t string")
    got = sorted(map(tuple, R.titration(df, "id", "t").collect()))
    assert got == [(1, 5, 11.0, "supine", "N1", 4.0, None, 88.0, 1.0, 2.0, 3.0), (1, 6, 20.0, "lateral", "N2", 0.2, None, 91.0, None, 0.0, 1.0)]
    assert R.titration(df.where(F.lit(False)), "id", "t").count() == 0
