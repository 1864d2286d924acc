"""A CSV sink whose files other tools read as they are: a byte order mark, lines that end in CR LF, and quotes just where a cell needs them.

    spark.dataSource.register(QuotedCsv)
    df.write.format("quoted_csv").mode("overwrite").save(path)

Cells are quoted that hold the separator, a quote, or a line break of either kind, a lone CR too. Nulls are blank. Each task writes one file under
a folder of the job; what was there before goes, and the files take their names, only when all tasks are done. A job that fails leaves
nothing and what was there before. Paths are those that tasks and driver can open alike: shared folders, or file systems pyarrow knows by URI.
"""

from __future__ import annotations

import csv
import io
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

ENCODING, LINE_END = "utf-8-sig", "\r\n"
DONE = "_SUCCESS"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), posixpath.abspath(path))


@dataclass
class Part(WriterCommitMessage):
    number: int
    path: str
    rows: int


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], columns: list[str], overwrite: bool) -> None:
        self.path, self.columns, self.overwrite = options["path"], columns, overwrite
        self.encoding, self.line_end = options.get("encoding", ENCODING), options.get("lineend", LINE_END)
        self.folder = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        system, root = opened(self.path)
        number, n = TaskContext.get().partitionId(), 0
        folder = f"{root}/{self.folder}"
        system.create_dir(folder, recursive=True)
        path = f"{folder}/{number:05d}-{TaskContext.get().taskAttemptId()}.csv"
        with system.open_output_stream(path) as raw, io.TextIOWrapper(raw, self.encoding, newline="") as out:
            rows = csv.writer(out, quoting=csv.QUOTE_MINIMAL, lineterminator=self.line_end)
            rows.writerow(self.columns)
            for batch in iterator:
                rows.writerows(zip(*(c.to_pylist() for c in batch.columns), strict=True))
                n += len(batch)
        return Part(number, path, n)

    def commit(self, messages: list[Part | None]) -> None:
        """Parts of the tasks that counted take the place of what was there; those of repeated tasks go with the job's folder."""
        system, root = opened(self.path)
        system.create_dir(root, recursive=True)
        there = [f for f in system.get_file_info(fs.FileSelector(root)) if f.base_name != self.folder]
        if self.overwrite:
            for f in there:
                system.delete_dir(f.path) if f.type == fs.FileType.Directory else system.delete_file(f.path)
        first = 0 if self.overwrite else sum(f.base_name.startswith("part-") for f in there)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number) or [m for m in messages if m is not None][:1]
        for k, m in enumerate(parts):
            system.move(m.path, f"{root}/part-{first + k:05d}.csv")
        self._clear(system, root)
        with system.open_output_stream(f"{root}/{DONE}"):
            pass

    def abort(self, messages: list[Part | None]) -> None:
        self._clear(*opened(self.path))

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        folder = f"{root}/{self.folder}"
        if system.get_file_info(folder).type == fs.FileType.Directory:
            system.delete_dir(folder)


class QuotedCsv(DataSource):
    """Options: encoding (utf-8-sig) and lineEnd (CR LF)."""

    @classmethod
    def name(cls) -> str:
        return "quoted_csv"

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer({k.lower(): v for k, v in self.options.items()}, schema.names, overwrite)


def write(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite", **options: str) -> None:
    """The columns in order as text, absent ones blank; all of them if none are named."""
    names = df.columns if columns is None else columns
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in names])
    df.sparkSession.dataSource.register(QuotedCsv)
    rows.write.format("quoted_csv").mode(mode).options(**options).save(path)
