"""Recordings in European Data Format as a batch source: header rows, and samples read by ranges of data records.

    spark.dataSource.register(EdfSource)
    spark.read.format("edf").option("channel", "ECG").load(path)

A partition is a range of data records of one file, so a long recording is many tasks; only the bytes of those records are read.
"""

from __future__ import annotations

import glob
import math
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The format's header, fields and their widths; of the file, then of each signal.
FILE = (("version", 8), ("patient", 80), ("recording", 80), ("date", 8), ("time", 8), ("header_bytes", 8), ("reserved", 44), ("records", 8), ("record_seconds", 8), ("signals", 4))
SIGNAL = (("label", 16), ("transducer", 80), ("unit", 8), ("physical_min", 8), ("physical_max", 8), ("digital_min", 8), ("digital_max", 8), ("filter", 80), ("samples", 8), ("reserved", 32))
# Names of heart channels, the first exact one is preferred; microvolts in a unit.
HEART, PREFERRED = r"(EKG|ECG)", ("EKG", "ECG")
MICRO = {"uv": 1.0, "µv": 1.0, "mv": 1e3, "v": 1e6}
SCHEMA = "recording string, channel string, sfreq double, sample_index long, time_sec double, ekg_uV double"
#: Samples of a block that is resampled at once, periods of the lower rate that an interpolated value depends on, and values made at a time.
BLOCK, LOBES, SLICE = 1 << 16, 32, 4096
RECORDS = 256


@dataclass
class Header:
    file: dict[str, str]
    signals: list[dict[str, str]]

    @property
    def seconds(self) -> float:
        return float(self.file["record_seconds"])

    def samples(self, i: int) -> int:
        return int(self.signals[i]["samples"])

    def rate(self, i: int) -> float:
        return self.samples(i) / self.seconds


def header(data: bytes) -> Header:
    """Parse a file's first bytes, 256 for each of the file and every signal."""
    at, file = 0, {}
    for name, width in FILE:
        file[name] = data[at : at + width].decode("latin-1").strip()
        at += width
    signals: list[dict[str, str]] = [{} for _ in range(int(file["signals"]))]
    for name, width in SIGNAL:
        for s in signals:
            s[name] = data[at : at + width].decode("latin-1").strip()
            at += width
    return Header(file, signals)


def read_header(path: str) -> Header:
    with open(path, "rb") as f:
        first = f.read(256)
        return header(first + f.read(256 * int(first[252:256])))


def pick(labels: list[str], pattern: str = HEART) -> int:
    """The channel that a pattern finds, whatever its case: one named exactly as preferred, else the first."""
    found = [i for i, n in enumerate(labels) if re.search(pattern, n, re.IGNORECASE)]
    if not found:
        raise ValueError(f"no channel like {pattern}: {', '.join(labels)}")
    return next((i for name in PREFERRED for i in found if labels[i].upper() == name), found[0])


@dataclass
class Records(InputPartition):
    path: str
    channel: int
    first: int
    last: int


class EdfReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.pattern = options.get("channel", HEART)
        self.records = int(options.get("records", RECORDS))
        self.limit = float(options["seconds"]) if "seconds" in options else None
        path = options["path"]
        self.paths = sorted(glob.glob(os.path.join(path, "**", "*.edf"), recursive=True)) if os.path.isdir(path) else sorted(glob.glob(path))

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.paths:
            h = read_header(path)
            channel = pick([s["label"] for s in h.signals], self.pattern)
            n = int(h.file["records"])
            if n < 0:  # not said: what the file holds
                n = (os.path.getsize(path) - int(h.file["header_bytes"])) // (2 * sum(h.samples(i) for i in range(len(h.signals))))
            if self.limit is not None:
                n = min(n, -int(-self.limit // h.seconds))
            out += [Records(path, channel, a, min(a + self.records, n)) for a in range(0, n, self.records)]
        return out

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        h = read_header(partition.path)
        s, n = h.signals[partition.channel], h.samples(partition.channel)
        sizes = [h.samples(i) for i in range(len(h.signals))]
        row, before = sum(sizes), sum(sizes[: partition.channel])
        with open(partition.path, "rb") as f:
            f.seek(int(h.file["header_bytes"]) + 2 * row * partition.first)
            raw = np.frombuffer(f.read(2 * row * (partition.last - partition.first)), "<i2")
        raw = raw[: len(raw) // row * row].reshape(-1, row)[:, before : before + n].ravel()
        lo, hi, dlo, dhi = (float(s[k]) for k in ("physical_min", "physical_max", "digital_min", "digital_max"))
        values = ((raw - dlo) * (hi - lo) / (dhi - dlo) + lo) * MICRO.get(s["unit"].lower(), 1.0)
        at = partition.first * n + np.arange(len(values), dtype=np.int64)
        rate = h.rate(partition.channel)
        if self.limit is not None:
            keep = at < self.limit * rate
            at, values = at[keep], values[keep]
        name = os.path.basename(partition.path)
        k = len(at)
        yield pa.RecordBatch.from_arrays([pa.array([name] * k, pa.string()), pa.array([s["label"]] * k, pa.string()), pa.array(np.full(k, rate)), pa.array(at), pa.array(at / rate), pa.array(values)], names=["recording", "channel", "sfreq", "sample_index", "time_sec", "ekg_uV"])


class EdfSource(DataSource):
    """Options: channel (a pattern), records (of a partition), seconds (read no further)."""

    @classmethod
    def name(cls) -> str:
        return "edf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> EdfReader:
        return EdfReader(dict(self.options))


def samples(spark: SparkSession, path: str, **options: str | float) -> DataFrame:
    """Rows (recording, channel, sfreq, sample_index, time_sec, ekg_uV) of one channel of every recording under a path."""
    spark.dataSource.register(EdfSource)
    return spark.read.format("edf").options(**{k: str(v) for k, v in options.items()}).load(path)


def channels(spark: SparkSession, path: str) -> DataFrame:
    """Rows (recording, channel_index, channel_name, unit, sfreq_hz, n_samples, duration_sec, physical_min, physical_max, digital_min, digital_max, meas_date): every signal's header."""
    kinds = "recording string, channel_index int, channel_name string, unit string, sfreq_hz double, n_samples long, duration_sec double, physical_min double, physical_max double, digital_min double, digital_max double, meas_date string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for where, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = header(head)
                n, length = int(h.file["records"]), h.seconds
                for i, s in enumerate(h.signals):
                    rows.append((where, i, s["label"], s["unit"], h.rate(i), n * h.samples(i), n * length, *(float(s[k]) for k in ("physical_min", "physical_max", "digital_min", "digital_max")), f"{h.file['date']} {h.file['time']}"))
            yield pa.RecordBatch.from_pylist([dict(zip([k.split()[0] for k in kinds.split(", ")], r, strict=True)) for r in rows], schema=pa.schema([(k.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64()}[k.split()[1]]) for k in kinds.split(", ")]))

    signals = F.substring("content", 253, 4).cast("string").cast("int")
    heads = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.edf").load(path)
    return heads.select(F.regexp_extract("path", r"([^/]+)$", 1), F.substring(F.col("content"), F.lit(1), 256 * (signals + 1))).mapInArrow(run, kinds)


def resampled(rows: DataFrame, rate: float, block: int = BLOCK, lobes: int = LOBES) -> DataFrame:
    """`samples` at another rate: band-limited interpolation by a windowed sinc that reaches `lobes` periods of the lower rate to either side.

    A recording is cut into blocks of `block` samples; samples near an edge also go to the next block, so each block has what its interpolation
    reaches, in one shuffle, and no task holds more than a block. Beyond a recording's ends the signal is mirrored through its end point.
    Samples of a recording are numbered from 0 without gaps.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        t = table.sort_by("sample_index")
        number, old = key[2].as_py(), float(t.column("sfreq")[0].as_py())
        first, x = int(t.column("sample_index")[0].as_py()), t.column("ekg_uV").to_numpy()
        low, high, halo = number * block, (number + 1) * block, _reach(old, rate, lobes)
        scale, end = rate / old, first + len(x)
        whole = end if end < high + halo else None  # nothing comes after: the recording's length
        n = np.arange(math.ceil(low * scale), math.ceil(high * scale) if whole is None else min(math.ceil(high * scale), max(1, round(whole * scale))), dtype=np.int64)
        y = interpolated(x, n / scale - first, min(1.0, scale), halo)
        at = len(n)
        return pa.table({"recording": pa.array([key[0].as_py()] * at, pa.string()), "channel": pa.array([key[1].as_py()] * at, pa.string()), "sfreq": np.full(at, float(rate)), "sample_index": n, "time_sec": n / rate, "ekg_uV": y})

    i, reach = F.col("sample_index"), F.ceil(lobes * F.greatest(F.lit(1.0), F.col("sfreq") / rate)) + 1
    near = F.sequence(F.greatest(F.floor((i - reach) / block), F.lit(0).cast("long")), F.floor((i + reach) / block))
    dealt = rows.withColumn("block", F.explode(near))
    last = rows.groupBy("recording", "channel").agg(F.floor(F.max("sample_index") / block).alias("__last"))
    dealt = dealt.join(last, ["recording", "channel"]).where(F.col("block") <= F.col("__last")).drop("__last")
    return dealt.groupBy("recording", "channel", "block").applyInArrow(run, SCHEMA)


def _reach(old: float, rate: float, lobes: int) -> int:
    return math.ceil(lobes * max(1.0, old / rate)) + 1


def interpolated(x: np.ndarray, at: np.ndarray, cut: float, halo: int) -> np.ndarray:
    """Values of x at the (fractional) places `at`, without what lies above `cut` of its half rate."""
    pad = min(len(x) - 1, halo)
    wide = np.concatenate([2 * x[0] - x[pad:0:-1], x, 2 * x[-1] - x[-2 : -pad - 2 : -1]]) if pad else x
    wide = np.pad(wide, halo - pad, mode="edge")
    out, offsets = np.empty(len(at)), np.arange(1 - halo, halo + 1)
    bell = np.kaiser(4 * halo * 32 + 1, 8.0)  # finely enough to be read by interpolation
    for low in range(0, len(at), SLICE):
        p = at[low : low + SLICE]
        base = np.floor(p).astype(np.int64)
        t = (p - base)[:, None] - offsets
        weights = np.sinc(cut * t) * np.interp(t, np.linspace(-halo, halo, len(bell)), bell)
        out[low : low + SLICE] = (wide[base[:, None] + offsets + halo] * weights).sum(axis=1) / weights.sum(axis=1)
    return out
