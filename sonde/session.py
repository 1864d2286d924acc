"""A session with the settings the engine expects; any setting given wins."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    named = spark.sparkContext._jsc.sc().getCheckpointDir()
    if named.isDefined():
        return named.get()
    folder = tempfile.mkdtemp(prefix="sonde-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes `df` under the shared folder and reads it again: its lineage ends there, and no executor owns it."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def set_for(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings that hold within the block, then what held before; double underscores stand for dots."""
    named = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
