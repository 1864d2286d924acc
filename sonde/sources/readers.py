"""Sources: CSV with unknown encodings, annotations, dictionaries, text and JSON trees, images. Schemas are explicit."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonde.functions import names
from sonde.functions import scalars as S
from sonde.operators.checking import FIRST_STEP, expanded_steps

ENCODINGS = ("utf-8", "cp949", "euc-kr", "latin-1")
JAVA_NAMES = {"cp949": "x-windows-949", "euc-kr": "EUC-KR", "latin-1": "ISO-8859-1", "utf-8": "UTF-8"}


def strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def encoding_of(content: bytes) -> str:
    """The first encoding that reads all the bytes."""
    for name in ENCODINGS[:-1]:
        try:
            content.decode(name)
            return name
        except UnicodeDecodeError:
            continue
    return ENCODINGS[-1]


def csv_kinds(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows (path, encoding, header) of CSV files; each is read whole by a task, its names come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_py()
                encoding = encoding_of(data)
                first = next(csv.reader(io.StringIO(data.decode(encoding).lstrip("\ufeff"), newline="")), [])
                out.append((path, encoding, [c.strip() for c in first]))
            columns = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(pa.string()))], names=["path", "encoding", "header"])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(run, "path string, encoding string, header array<string>")


def csv_any_encoding(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """All-string rows of CSV files with a header, each file read in the first encoding that fits all of it; missing columns null.

    Files alike in encoding and header are one scan.
    """
    by: dict[tuple, list[str]] = {}
    for row in csv_kinds(spark, paths).collect():  # one short row a file
        by.setdefault((row["encoding"], tuple(row["header"])), []).append(row["path"])
    if {e for e, _ in by} - {"utf-8", "latin-1"}:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # else the reader knows Unicode and Latin-1 only
    out = None
    for (encoding, header), own in sorted(by.items()):
        if not header:
            continue
        part = spark.read.csv(own, header=True, schema=strings([f"_{i}" for i in range(len(header))]), enforceSchema=True, multiLine=True, encoding=JAVA_NAMES[encoding], escape='"').toDF(*header)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(", ".join(paths))
    return out if columns is None else out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns not there: {', '.join(missing)}")
    return df


def annotations(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, time, description) of a CSV without header."""
    rows = spark.read.csv(path, schema="epoch STRING, time STRING, description STRING", header=False)
    return rows.select(F.trim("epoch").try_cast("int").alias("epoch"), F.trim("time").alias("time"), F.trim("description").alias("description"))


def dictionary(spark: SparkSession, path: str, key: str, descriptions: list[str]) -> DataFrame:
    """(key, description, options): descriptions distinct and joined, options from the columns whose name is a number."""
    rows = require(csv_any_encoding(spark, [path]), key)
    codes = sorted((c for c in rows.columns if c.isdigit()), key=int)
    text = F.array_join(F.array_distinct(F.array_compact(F.array(*[F.nullif(F.trim(c), F.lit("")) for c in descriptions if c in rows.columns]))), " | ")
    options = F.map_filter(F.create_map(*[x for c in codes for x in (F.lit(c), F.nullif(F.trim(c), F.lit("")))]), lambda _, v: v.isNotNull()) if codes else F.lit(None).cast("map<string,string>")
    return rows.select(F.trim(key).alias("key"), text.alias("description"), options.alias("options"))


# Columns of a field dictionary.
FIELD, FORMAT, TYPE, CATEGORY, MEANT, ASSESSED = "csv key", "Format/Range", "Type", "map category", "semantic_allowed", "assessment cdm type"
DESCRIPTIONS = ("설명", "Korean_Context", "English_Context")


def field_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(key, description, format, options, type, category, semantic_allowed, assessment_type, position) of a dictionary of fields, in the order of the file.

    Rows without a key go. Types other than A and B are B; categories take their usual names; whether a field's meaning may be judged is 1
    unless it says 0. Pressure steps that lack are made like the first, after all others. A table of fixed size.
    """
    rows = require(csv_any_encoding(spark, [path]), FIELD)
    blank = lambda c: F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    said = lambda c: F.when(F.lower(blank(c)) != "nan", blank(c))
    codes = sorted((c for c in rows.columns if c.isdigit()), key=int)
    options = F.map_filter(F.create_map(*[x for c in codes for x in (F.lit(c), blank(c))]), lambda _, v: v.isNotNull()) if codes else F.create_map().cast("map<string,string>")
    meant = S.first_number(F.coalesce(blank(MEANT), F.lit("1")))
    numbered = rows.withColumn("__n", F.monotonically_increasing_id())  # one file, so in its order
    fields = numbered.select(
        said(FIELD).alias("key"), F.array_join(F.array_distinct(F.array_compact(F.array(*[said(c) for c in DESCRIPTIONS]))), " | ").alias("description"), F.coalesce(blank(FORMAT), F.lit("")).alias("format"),
        options.alias("options"), F.when(F.upper(blank(TYPE)) == "A", "A").otherwise("B").alias("type"), names.category_name(blank(CATEGORY)).alias("category"),
        F.when(F.rint(meant) == 0, 0).otherwise(1).alias("semantic_allowed"), F.coalesce(blank(ASSESSED), F.lit("")).alias("assessment_type"), "__n",
    ).where("key is not null")
    step = F.coalesce(S.found("key", r"^Pressure_(\d{2})$"), S.found("key", r"^Pr(\d{2})_")).cast("int")
    made = expanded_steps(fields.withColumn("__made", F.lit(0))).join(fields.select("key", F.lit(1).alias("__there")), "key", "left")
    order = Window.orderBy(F.col("__there").isNull(), F.when(F.col("__there").isNull(), step).otherwise(FIRST_STEP), "__n")  # some hundred rows
    return made.withColumn("position", F.row_number().over(order)).drop("__n", "__made", "__there")


def texts(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """(entity, name, text): whole files of a tree, the folder being the entity."""
    rows = spark.read.text(root, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    return rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("entity"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("value").alias("text"))


def json_files(spark: SparkSession, root: str, schema: str, glob: str = "*.json") -> DataFrame:
    return spark.read.schema(schema).json(root, multiLine=True, pathGlobFilter=glob, recursiveFileLookup=True)


def images(spark: SparkSession, root: str) -> DataFrame:
    """(entity, name, sha1, length, content) of image files."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG],[wW][eE][bB][pP]}").load(root)
    return rows.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("entity"), F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.sha1("content").alias("sha1"), "length", "content")


def stage_limits(spark: SparkSession, path: str, name: str, categories: str, limit: str) -> DataFrame:
    """(stage, category, limit): one row a category of a comma list; limits from texts such as '95.0% (n/m)'."""
    rows = require(csv_any_encoding(spark, [path]), name, categories, limit)
    share = F.nullif(F.regexp_extract(limit, r"([0-9]+(?:\.[0-9]+)?)\s*%", 1), F.lit("")).try_cast("double")
    return rows.select(F.trim(name).alias("stage"), F.explode(F.split(categories, ",")).alias("category"), share.alias("limit")).withColumn("category", F.trim("category"))
