"""Artefacts of runs: JSON files of any shape under a folder a run and entity, read once a kind and taken apart at any depth.

Documents are VARIANT values: no schema is inferred or given, and what one run lacks is null. A folder is root/run/.../entity/name.json.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: How deep a document may be nested: one that is deeper is an error, not a cut.
DEEPEST = 64


def documents(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows (run, entity, name, doc, error) of all files of a name (a glob) under a root, in one scan; a text that is no JSON is an error."""
    files = spark.read.text(root, wholetext=True, pathGlobFilter=name, recursiveFileLookup=True).select("value", F.col("_metadata.file_path").alias("path"))
    under = F.expr("regexp_replace(path, '^[a-z]+:/*', '/')")
    base = F.lit(root.rstrip("/").split(":", 1)[-1].replace("//", "/"))
    inner = F.split(F.substring(under, F.length(base) + 2, F.length(under)), "/")
    doc = F.try_parse_json(F.regexp_replace("value", "^\\ufeff", ""))
    return files.select(
        inner[0].alias("run"), F.when(F.size(inner) > 2, F.element_at(inner, -2)).alias("entity"), F.element_at(inner, -1).alias("name"), doc.alias("doc"), F.when(doc.isNull(), "not JSON").alias("error"))


def kind(v: str | Column) -> Column:
    """object, array or scalar; null of a null."""
    s = F.schema_of_variant(v)
    return F.when(F.startswith(s, F.lit("OBJECT")), "object").when(F.startswith(s, F.lit("ARRAY")), "array").when(s.isNotNull(), "scalar")


def leaves(rows: DataFrame, keys: list[str], doc: str = "doc") -> DataFrame:
    """Rows (*keys, path, leaf, kind, value) of every scalar at any depth, and of empty objects and arrays: path as in $.a[0].b, leaf its last name, value as text.

    One level is taken apart after another, until nothing is left to take apart; a level is one lateral join without a shuffle.
    """
    spark = rows.sparkSession
    text = lambda v: F.try_variant_get(v, "$", "string")
    now = rows.select(*keys, F.lit("$").alias("path"), F.lit(None).cast("string").alias("leaf"), F.col(doc).alias("v")).withColumn("kind", kind("v"))
    out = None
    for _ in range(DEEPEST):
        empty = F.to_json("v").isin("{}", "[]")
        ends = now.where((F.col("kind") == "scalar") | empty).select(*keys, "path", "leaf", "kind", F.when(F.col("kind") == "scalar", text("v")).alias("value"))
        out = ends if out is None else out.unionByName(ends)
        inner = now.where(F.col("kind").isin("object", "array") & ~empty)
        if inner.isEmpty():
            return out
        part = spark.tvf.variant_explode(F.col("v").outer()).toDF("pos", "key", "inside")
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), "key"))
        now = inner.lateralJoin(part).select(*keys, F.concat("path", step).alias("path"), F.coalesce("key", "leaf").alias("leaf"), F.col("inside").alias("v")).withColumn("kind", kind("v"))
    raise ValueError(f"documents are nested deeper than {DEEPEST}")


def loaded(spark: SparkSession, root: str, kinds: dict[str, str], keys: list[str] | None = None) -> DataFrame:
    """Rows (run, entity, one VARIANT column a kind) of runs under a root: `kinds` are columns and the names of their files; each is read once, joined by run and entity."""
    keys = keys or ["run", "entity"]
    out = None
    for column, name in kinds.items():
        part = documents(spark, root, name).groupBy(*keys).agg(F.max_by("doc", "name").alias(column))
        out = part if out is None else out.join(part, keys, "full_outer")
    return out


def report(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (*keys, value): the other columns of a row as one nested JSON text, VARIANT columns as they are."""
    return rows.select(*keys, F.to_json(F.struct(*[c for c in rows.columns if c not in keys])).alias("value"))


def said(v: str | Column) -> Column:
    """The text of a model's answer of any shape: itself if it is a text, else its parts' texts (text, or content of a part), joined by line breaks."""
    part = lambda x: F.coalesce(F.try_variant_get(x, "$.text", "string"), F.try_variant_get(x, "$.content", "string"), F.when(kind(x) == "scalar", F.try_variant_get(x, "$", "string")))
    parts = F.try_variant_get(v, "$", "array<variant>")
    return F.when(kind(v) == "array", F.array_join(F.filter(F.transform(parts, part), lambda t: t.isNotNull() & (t != "")), "\n")).otherwise(part(F.col(v) if isinstance(v, str) else v))
