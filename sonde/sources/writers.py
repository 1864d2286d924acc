"""Sinks: fixed-order CSV, artefacts by entity, JSON reports, request lines, Markdown twins of small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonde.sources import quoted_csv


def wide_csv(df: DataFrame, path: str, columns: list[str], line_end: str = quoted_csv.LINE_END) -> None:
    """The columns in order, absent ones blank, with a byte order mark; cells are quoted where they must be."""
    quoted_csv.write(df, path, columns, lineEnd=line_end)


def by_entity(df: DataFrame, path: str, entity: str = "entity") -> None:
    df.write.mode("overwrite").partitionBy(entity).parquet(path)


def json_report(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def request_lines(df: DataFrame, path: str, key: list[str], body: str) -> None:
    """JSON lines keyed `a::b`."""
    df.select(F.to_json(F.struct(F.concat_ws("::", *key).alias("key"), F.col(body).alias("request"))).alias("value")).write.mode("overwrite").text(path)


def samples_csv(df: DataFrame, path: str, places: int = 3) -> None:
    """Doubles with a fixed number of places, ranged by sample."""
    cols = [F.format_string(f"%.{places}f", c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    df.select(*cols).repartitionByRange("sample_index").sortWithinPartitions("sample_index").write.mode("overwrite").csv(path, header=True)


def markdown(df: DataFrame, rows: int = 1000) -> str:
    """A Markdown table of a small result; more than `rows` is an error, not a cut."""
    found = df.take(rows + 1)
    if len(found) > rows:
        raise ValueError(f"more than {rows} rows")
    text = lambda v: "(blank)" if v is None else str(v).replace("\n", "\\n").replace("|", "\\|")
    head = [f"| {' | '.join(df.columns)} |", "|" + " --- |" * len(df.columns)]
    return "\n".join(head + [f"| {' | '.join(text(v) for v in r)} |" for r in found])
