"""The register of studies: sheets under the clinic's headings become typed, dated, numbered study rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.operators import intervals, sequences

# Headings of the sheets, the mark that goes from names, codes of the sexes, words in names of studies.
HEADINGS = {"등록번호": "Hospital_ID", "환자명": "Name", "검사명": "study", "검사일시": "at", "나이": "AGE", "성별": "SEX"}
MARK = "♣"
SEXES = {"M": 0, "F": 1}
NAP_TEST, NIGHT, PRESSURE, SPLIT = "mslt", "polysomnography", "cpap", "split night"
DAYS = 7


def renamed(sheet: DataFrame, headings: dict[str, str] = HEADINGS) -> DataFrame:
    """The sheet's columns under their own names, absent ones null, others dropped."""
    have = {c.strip(): c for c in sheet.columns}
    return sheet.select(*[(F.col(f"`{have[h]}`") if h in have else F.lit(None)).cast("string").alias(n) for h, n in headings.items()])


def when_held(at: Column, year: int) -> Column:
    """A time of `MM-dd HH:mm` in the year, or a whole date and time; null for other texts."""
    short = F.try_to_timestamp(F.concat(F.lit(f"{year}-"), at), F.lit("yyyy-MM-dd HH:mm"))
    return F.coalesce(short, F.try_to_timestamp(at))


def studies(sheet: DataFrame, year: int, start: int = 1, site: str = "001") -> DataFrame:
    """Rows (Hospital_ID, Name, AGE, SEX, PSG_Type, PSG_Date, PSG_No, Database_ID) of the nights in a sheet, numbered by time.

    A night is C with pressure, SP if split, M if the patient had a nap test within DAYS floored days, else P; other
    studies go. Nights without a time stand last, with 0000 for month and day. Equal times go by patient and study.
    """
    rows = renamed(sheet).withColumn("__when", when_held(F.trim("at"), year)).withColumn("__row", F.xxhash64(*HEADINGS.values())).withColumn("__s", F.unix_timestamp("__when"))
    kind = F.lower(F.coalesce("study", F.lit("")))
    rows = rows.withColumns({"__nap": kind.contains(NAP_TEST), "__night": kind.contains(NIGHT), "__kind": F.when(kind.contains(PRESSURE), "C").when(kind.contains(SPLIT), "SP")})
    night = rows.where("__night and not __nap")
    near = intervals.near_in_time(night.where("__s is not null"), rows.where("__nap and __s is not null"), "Hospital_ID", "__row", "__s", DAYS).select("__row", F.lit("M").alias("__m")).distinct()
    typed = night.join(near, "__row", "left").withColumn("PSG_Type", F.coalesce("__kind", "__m", F.lit("P")))
    typed = typed.withColumns({"__all": F.lit(0), "__day": F.coalesce(F.to_date("__when"), F.to_date(F.lit("9999-12-31")))})
    typed = sequences.numbered(typed, "__all", "__day", [F.col("__s").asc_nulls_last(), "Hospital_ID", "study"], "__seq")
    date = F.concat(F.lit(str(year)), F.coalesce(F.date_format("__when", "MMdd"), F.lit("0000")))
    digits = (F.col("__seq") + (start - 1)).cast("string")
    number = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    sex = F.create_map(*[F.lit(x) for kv in SEXES.items() for x in kv])[F.col("SEX")]
    return typed.select(
        "Hospital_ID", F.coalesce(F.replace("Name", F.lit(MARK), F.lit("")), F.lit("")).alias("Name"), "AGE", sex.alias("SEX"), "PSG_Type", date.alias("PSG_Date"),
        F.concat(F.lit(f"P{year}-"), number).alias("PSG_No"), F.concat_ws("_", F.lit(site), date, number, "PSG_Type").alias("Database_ID"),
    )
