"""Shared plumbing of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITESPACE = " \t\n\x0b\x0c\r"
#: Rows per Arrow batch handed to Python: texts may be long, so fewer than Spark's default.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to `rows`, so that a batch of long texts stays small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; set to a temporary one only where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        existing = spark.sparkContext._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            return existing.get()
        folder = tempfile.mkdtemp(prefix="sonde-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` under the shared folder and read it back: lineage ends there, no executor owns it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str | Column) -> Column:
    """A 64-bit key of a text; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(F.coalesce(text, F.lit("")))


def components(edges: DataFrame, every: int = 4, limit: int = 60) -> DataFrame:
    """Connected components of `edges` (a long, b long) as rows (node, root): root is the least node reachable.

    Alternates large-star and small-star steps until the edge set stands still; only edges move, each step is
    one shuffle of at most twice as many rows as there are edges. Lineage is cut every few steps.
    Nodes without an edge do not appear.
    """
    shared_dir(edges.sparkSession)
    both = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    both = both.checkpoint()
    before = None
    for step in range(limit):
        # large star: every neighbour above a node joins the node's least neighbour
        around = both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its lesser neighbours join the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        both = small.checkpoint()
        state = both.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"the components still change after {limit} steps")
    roots = both.select("v").distinct()
    return both.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v")).distinct()
