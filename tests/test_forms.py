import pytest
from pyspark.sql import functions as F

from sonde.operators import forms, register, reports

EVENING = """신장 170.4 체중 60~70 BMI 22
직업 교사
카페인 섭취에 대한 질문
 카페인을 마신다
흡연에 대한 질문
 흡연 금연했다면
교대 근무를 합니까? 아니오
1. 현재 다음과 같은 질환을 앓고 있습니까
 고혈압, 당뇨
2. 다음
밤에 수면시간이 충분하다고 느끼십니까? 예
밤에 몇 번 깨십니까? 2-3 번
낮잠을 잡니까? 1-2 번
평균 낮잠 시간 평일: 1.5시간 주말: 20분
가위 눌림을
 겪은 적 아니오
수면의 질 지수 (PSQI)
1. 주중 : 12시 30분 주말 : 오후 11시
2. 주중 : 10-20분 주말 : 1시간 5분
3. 주중 : 7시 주말 : 오전 9시 15분
4. 주중 : 6~7시간 주말 : 8시간
5. 끝
주간 졸림도
Stanford Sleepiness Scale
 3. 보통
The Epworth Sleepiness Scale
2 * 앉아서 책을 읽을 때
0 * 차를 운전할 때
피로 정도에 대한 설문
운동을 하면 피로해진다. 5
Berline Questionnaire
1. 체중이
 증가했다
2. 코를
 아니오
6. 피곤
 주 1-2 회
하지불안증후군 / 주기성사지운동증후군
가족 중에 이런 증세를 가진 분이 계신가요?
 2. 없다
하지불안증후군에 대한 설문 (Restless Legs Syndrome Rating Scale)
일상생활에 얼마나 지장을 주나요?
 3. 심함
수면중 이상행동
꿈을 많이 꾸십니까 예
1 생생한 꿈 예
6.2 움직임 아니오
10 신경계 질환이 있다 예
우울증, 뇌졸중
총점 3
Patient Health Questionnaire
1. 흥미 2
2. 기분 0
총점
"""


def test_evening(spark):
    df = spark.createDataFrame([(1, EVENING), (2, None), (3, "매치없음"), (4, "신장 170")], "id int, t string")
    rows = {r["id"]: r.asDict() for r in forms.evening(df, "t").collect()}
    got = {k: v for k, v in rows[1].items() if v is not None and k not in ("id", "t") and not (k.startswith("PHx") and v == 0)}
    assert got == {
        "Height_cm": 170, "Weight_kg": 65, "BMI": 22, "Occupation": "교사", "Habit_Caffein": 1, "Habit_Smoking": 1, "Shiftwork": 0, "PHx_HTN": 1, "PHx_DM": 1, "SQ_Satisfaction": 1, "SQ_Wakefreq": 3, "Nap_Freq": 2,
        "Nap_HH_week": 1, "Nap_MM_week": 30, "Nap_HH_free": 0, "Nap_MM_free": 20, "N_Paralysis": 0, "PSQI_01_BedIn_HH_week": 0, "PSQI_01_BedIn_MM_week": 30, "PSQI_01_BedIn_HH_free": 23, "PSQI_01_BedIn_MM_free": 0,
        "PSQI_02_Latency_HH_week": 0, "PSQI_02_Latency_MM_week": 15, "PSQI_02_Latency_HH_free": 1, "PSQI_02_Latency_MM_free": 5, "PSQI_03_BedOut_HH_week": 7, "PSQI_03_BedOut_MM_week": 0, "PSQI_03_BedOut_HH_free": 9, "PSQI_03_BedOut_MM_free": 15,
        "PSQI_04_SD_HH_week": 6, "PSQI_04_SD_MM_week": 30, "PSQI_04_SD_HH_free": 8, "PSQI_04_SD_MM_free": 0, "SSS": 3, "ESS_01_book": 2, "ESS_08_driving": 0, "FSS_02": 5, "BQ_01": 1, "BQ_02": 2, "BQ_06": 3, "RLS_06_family": 2, "IRLS_09": 3,
        "RBD_FreqDream": 1, "RBDSQ_01": 1, "RBDSQ_06_02": 0, "RBDSQ_10": 1, "RBDSQ_10_Y": "1,6", "PHQ_01": 2, "PHQ_02": 0,
    }
    assert {v for k, v in rows[2].items() if k not in ("id", "t")} == {None}
    assert {v for k, v in rows[3].items() if k not in ("id", "t")} == {None}
    assert rows[4]["PHx_CVA"] == 0
    assert forms.evening(df, "t", zero_history=False).where("id = 4").first()["PHx_CVA"] is None


def test_morning(spark):
    q = dict(enumerate(forms.MORNING, 1))
    form = f"1. {q[1]} 아니오\n2. {q[2]}? 10-20 분\n3. {q[3]}? 1. 훨씬 길다\n4. {q[4]}? 6 시간 30 분\n6. {q[6]}? 2-3 번\n7. {q[7]}? 3.\n8. {q[8]}\n머리가 아프다.  \n9. {q[9]} ㉠ 3 ㉢ 7\n10. {q[10]}? 예 자세히 설명하십시오. 바다.\r\n11. {q[11]}? 4. 자발적으로\n"
    df = spark.createDataFrame([(1, form), (2, None), (3, "")], "id int, t string")
    rows = {r["id"]: r.asDict() for r in forms.morning(df, "t").collect()}
    got = {k[6:]: v for k, v in rows[1].items() if v is not None and k not in ("id", "t")}
    assert got == {
        "01_Hypnotics": 0, "02_SubSL_HH": 0.0, "02_SubSL_MM": 15.0, "02_SubSL_min": 15.0, "02_SubSL_Home": 1, "03_SubSD_HH": 6.0, "03_SubSD_MM": 30.0, "03_SubSD_hr": 6.5, "04_WakeNo": 3.0, "05_Alertness": 3,
        "05_Complaint": "머리가 아프다. ", "06_SQ_a": 3.0, "06_SQ_c": 7.0, "07_Dream": 1, "07_Dream_text": "바다.\r\n", "08_Wake": 4,
    }
    assert {v for i in (2, 3) for k, v in rows[i].items() if k not in ("id", "t")} == {None}
    assert len(rows[1]) - 2 == 20


REPORT = (
    "PSG# P2024-7 Neck Circumference 38.6 cm Height 170 cm Weight 70 Body Mass Index 24.2\nTotal Sleep Time(min) 400.5 x-Arousal Index 1 Arousal Index 12.5 /hr\nⅡ. Diagnosis :\n #1 OSA \n text\n # 2\nⅢ. Next # no\n"
    "Obstructive Apnea Central Apnea Mixed Apnea Hypopnea *Flow limit. Ar.\nTotal 1 2.5 3 4 5 6 7 8 9 10 11\nREM 1 0..2 - N/A 5 6 7 8 9 10\n"
    "Index Apnea Hypopnea Apnea+Hypopnea Flow limit. Arousal Snoring Arousal\nTotal 1 2 30 4 5\nNumber 44 Index 7.1 /hr\n"
)


def test_study_report(spark):
    df = spark.createDataFrame([(1, REPORT, "p"), (2, REPORT, "C"), (3, REPORT, "x"), (4, None, "P")], "id int, t string, kind string")
    rows = {r["id"]: r.asDict() for r in reports.study_report(df, "t", "kind").collect()}
    one = rows[1]
    assert (one["PSG_No"], one["Neckcir_cm"], one["TST_min"], one["Arousal_idx"], one["Height_cm"], one["BMI"]) == ("P2024-7", 39.0, 400.5, 12.5, 170.0, 24.0)
    assert (one["AI_obs"], one["AI_cent"], one["AI_obs_REM"], one["AI_cent_REM"], one["AHI_total"], one["RDI_no"], one["RDI_idx"]) == (2.5, 4.0, 0.2, None, 30.0, 44.0, 7.1)
    assert one["Diagnosis_etc"] == " #1 OSA\r\n # 2"
    assert rows[2]["AI_obs"] is None
    assert rows[2]["Height_cm"] == 170.0
    assert rows[3]["Height_cm"] is None
    assert {v for k, v in rows[4].items() if k not in ("id", "kind")} == {None}
    assert len(reports.table_places()) == 29


def test_diagnosis_of_split_nights(spark):
    t = "Ⅱ. Diagnosis\n# a \n# b\n# c\nⅢ."
    df = spark.createDataFrame([(t, "SP"), (t.replace("\n", "\r\n"), "P"), (t, "P"), ("none", "P")], "t string, k string")
    assert [r[0] for r in df.select(reports.diagnosis("t", "k")).collect()] == ["# a \n# b\r\n# c", "# a\n# b\n# c", "# a\r\n# b\r\n# c", None]


def test_titration_wide(spark):
    t = "Resp. Spon. x\n5.0 10 Supine REM 3.2 1 2 3 loud 90 1 2 3\n"
    r = reports.titration_wide(spark.createDataFrame([(1, t)], "id int, t string"), "id", "t").first()
    assert (r["Pressure_05"], r["Pr05_time_min"], r["Pr05_snoring"], r["Pr05_arousal_spont_idx"], r["Pressure_06"]) == (5, 10.0, "loud", 3.0, None)
    assert len(r) == 1 + 25 * 10


@pytest.mark.parametrize("year", [2012])
def test_register(spark, year):
    raw = [("1", "홍♣길동", "Polysomnography", "03-02 21:00", "50", "M"), ("1", "홍길동", "MSLT", "03-08 09:00", "50", "M"), ("2", "김", "Polysomnography with CPAP", "03-01 21:00", "40", "F"), ("3", None, "Split night polysomnography", "2012-02-01 20:00", "30", "x"), ("4", "박", "EEG", "03-01 10:00", "20", "M"), ("5", "최", "polysomnography", "bad", "20", "F")]
    df = spark.createDataFrame(raw, "`등록번호` string, `환자명` string, `검사명` string, `검사일시` string, `나이` string, `성별` string")
    got = {r["Hospital_ID"]: r for r in register.studies(df, year).collect()}
    assert {k: (r["PSG_Type"], r["Database_ID"], r["PSG_No"], r["SEX"]) for k, r in got.items()} == {
        "1": ("M", "001_20120302_003_M", "P2012-003", 0), "2": ("C", "001_20120301_002_C", "P2012-002", 1), "3": ("SP", "001_20120201_001_SP", "P2012-001", None), "5": ("P", "001_20120000_004_P", "P2012-004", 1),
    }
    assert got["1"]["Name"] == "홍길동"
    assert got["3"]["Name"] == ""
    assert register.studies(df.where(F.lit(False)), year).count() == 0
