"""Usage records as a stream: late data behind a watermark, repeated records dropped, tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed(stream: DataFrame, at: str, ident: str, kind: str, value: str, width: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Rows (start, kind, n, total); batch or stream. State is bounded by the watermark."""
    rows = stream.withWatermark(at, late).dropDuplicatesWithinWatermark([ident]) if stream.isStreaming else stream.dropDuplicates([ident])
    return rows.groupBy(F.window(at, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there now and stop; a rerun goes on from the checkpoint.

    Each batch writes the windows it changed to its own folder, so windows still open at the end are there too and a
    batch that is run again replaces itself. `latest` reads them.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows (start, kind, n, total): each window as the last batch that changed it left it."""
    rows = spark.read.schema(f"start timestamp, {kind} string, n long, total long, batch long").parquet(path)
    return rows.groupBy("start", kind).agg(F.max_by(F.struct("n", "total"), "batch").alias("v")).select("start", kind, "v.n", "v.total")
