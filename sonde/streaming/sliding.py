"""Usage over a sliding window as a stream: what each record finds used in the time before it, corrected when late records come.

A record is dealt to the stretch of time it lies in, and to the next one if a window there reaches it, so the state of a (kind, stretch) holds
the records of one stretch and a window, however frequent the kind. A record that comes late changes what later records had found; their rows are given again, and the last one
given counts. When the watermark has passed a stretch no record for it can come, and a timer clears its state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sonde.streaming.usage import windowed

STATE = "ident string, at long, value long, own boolean, n long, total long"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def used(at: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the times, in order: how many lie in the `width` up to it, and the sum of their values."""
    sums = np.r_[0, np.cumsum(value)]
    low, high = np.searchsorted(at, at - width, side="right"), np.searchsorted(at, at, side="right")
    return high - low, sums[high] - sums[low]


class Sliding(StatefulProcessor):
    """State: the records of a (kind, stretch), with what was last given for those that lie in it."""

    def __init__(self, width: int, stretch: int, kind: str) -> None:
        self.width, self.stretch, self.kind = width, stretch, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState("records", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        old = pd.DataFrame(list(self.records.get()), columns=["ident", "at", "value", "own", "n", "total"])
        new = pd.concat(list(rows))[["ident", "us", "value", "own"]].rename(columns={"us": "at"}).drop_duplicates("ident")
        new = new[~new["ident"].isin(old["ident"])].assign(n=-1, total=-1)
        if new.empty:
            return
        every = (pd.concat([old, new]) if len(old) else new).sort_values(["at", "ident"], kind="stable").reset_index(drop=True)
        n, total = used(every["at"].to_numpy(np.int64), every["value"].to_numpy(np.int64), self.width)
        given = every["own"].to_numpy(bool) & ((every["n"].to_numpy() != n) | (every["total"].to_numpy() != total))
        every["n"], every["total"] = n, total
        self.records.put([tuple(r) for r in every.astype(object).itertuples(index=False)])
        if old.empty:
            self.handle.registerTimer((int(key[1]) + 1) * self.stretch // 1000)
        out = every[given]
        yield pd.DataFrame({"ident": out["ident"], self.kind: key[0], "at_us": out["at"], "n_window": out["n"], "sum_window": out["total"]})

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
        self.records.clear()
        return iter(())

    def close(self) -> None:
        pass


def sliding(stream: DataFrame, at: str, ident: str, kind: str, value: str, width: int, late: str = "10 minutes", stretch: int | None = None) -> DataFrame:
    """Rows (ident, kind, at_us, n_window, sum_window) of a stream: records of the same kind in (at - width, at], `width` in microseconds.

    `stretch`, sixty widths if not given, is how much time a state holds: longer for rare records, shorter for frequent ones, a width at least.
    Rows are given again where a late record changes them. Records behind the watermark are dropped, repeated ones count once; a null value counts 0.
    The session's state store must be RocksDB (`STORE`).
    """
    us, stretch = F.unix_micros(at), max(width, stretch or 60 * width)
    reached = F.when(F.pmod(us, F.lit(stretch)) >= stretch - width, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = stream.withWatermark(at, late).select(F.col(at), F.col(ident).cast("string").alias("ident"), kind, us.alias("us"), F.coalesce(F.col(value).cast("long"), F.lit(0)).alias("value"), F.explode(reached).alias("later"))
    rows = rows.select(at, "ident", kind, "us", "value", (F.col("later") == 0).alias("own"), (F.floor(F.col("us") / stretch) + F.col("later")).alias("stretch"))
    kind_type = dict(stream.dtypes)[kind]
    return rows.groupBy(kind, "stretch").transformWithStateInPandas(Sliding(width, stretch, kind), f"ident string, {kind} {kind_type}, at_us long, n_window long, sum_window long", "Update", "EventTime")


def by_day(stream: DataFrame, at: str, ident: str, kind: str, value: str, late: str = "10 minutes") -> DataFrame:
    """Rows (start, kind, n, total): usage by calendar day of the session's time zone."""
    return windowed(stream, at, ident, kind, value, "1 day", late)


def last_given(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows that `usage.drain` wrote, each ident as the last batch gave it."""
    rows = spark.read.schema(f"{schema}, batch long").parquet(path)
    columns = [c for c in rows.columns if c not in ("ident", "batch")]
    return rows.groupBy("ident").agg(F.max_by(F.struct(*columns), "batch").alias("v")).select("ident", "v.*")
