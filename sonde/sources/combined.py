"""A table with one row an entity that batches of rows are put into: a combined table that stays right when a batch is run again or fails.

Entities are dealt to buckets by hash. A batch rewrites the buckets it touches into a folder of its own, then one small file, the manifest, says
which folder each bucket is read from. Readers take the last manifest, so a batch shows whole or not at all. A batch that is there already
isn't put in again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

BUCKETS = 64
MANIFEST = "number long, batch string, bucket int, folder string, buckets int"


def manifests(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).json(f"{path}/_manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def bucket(entity: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(entity).cast("string")), F.lit(buckets)).cast("int")


def put(rows: DataFrame, path: str, batch: str, entity: str, order: list[str], columns: list[str], buckets: int = BUCKETS) -> bool:
    """Puts a batch in: each entity's last row in `order` takes the place of the one it had. Whether it was put in, or was there before.

    The table holds entity and `columns`, as text; absent columns are blank. Null entities are left out. One writer at a time.
    """
    spark = rows.sparkSession
    known = manifests(spark, path).where(F.col("bucket").isNotNull()).collect()  # one row a bucket and batch
    if any(r["batch"] == batch for r in known):
        return False
    number = max((r["number"] for r in known), default=0)
    now = {r["bucket"]: r["folder"] for r in known if r["number"] == number}
    buckets = known[0]["buckets"] if known else buckets  # as the table began
    names = [c for c in columns if c != entity]
    text = [F.col(f"`{c}`").cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names]
    last = rows.where(F.col(entity).isNotNull()).select(F.col(entity).cast("string").alias(entity), F.struct(*[F.col(o) for o in order]).alias("__o"), F.struct(*text).alias("__v"))
    new = last.groupBy(entity).agg(F.max(F.struct("__o", "__v")).alias("m")).select(entity, *[F.col("m.__v")[c].alias(c) for c in names]).withColumn("bucket", bucket(entity, buckets))
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())
    folder = f"data/{batch}"
    every = new
    there = [f"{path}/{now[b]}/bucket={b}" for b in touched if b in now]
    if there:
        old = spark.read.schema(new.drop("bucket").schema).parquet(*there).withColumn("bucket", bucket(entity, buckets))
        every = new.unionByName(old.join(new.select(entity), entity, "left_anti"))
    every.repartition("bucket").sortWithinPartitions("bucket", entity).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{folder}")
    now |= dict.fromkeys(touched, folder)
    lines = [(number + 1, batch, b, f, buckets) for b, f in sorted(now.items())] or [(number + 1, batch, -1, folder, buckets)]
    # one file, so that it is there whole or not at all
    spark.createDataFrame(lines, MANIFEST).coalesce(1).write.mode("append").json(f"{path}/_manifest")
    return True


def table(spark: SparkSession, path: str, entity: str, columns: list[str]) -> DataFrame:
    """Rows (entity, columns) as the last batch left them."""
    names = [c for c in columns if c != entity]
    schema = ", ".join(f"`{c}` string" for c in [entity, *names])
    known = manifests(spark, path).collect()
    number = max((r["number"] for r in known), default=0)
    folders = [f"{path}/{r['folder']}/bucket={r['bucket']}" for r in known if r["number"] == number and r["bucket"] >= 0]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
