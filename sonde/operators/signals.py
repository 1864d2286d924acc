"""Annotated time series: sample alignment, onset grids, stages and activity flags per sample."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How stages are written.
STAGE = r"(?i)^stage\s*-\s*(.*)$"


def aligned(t: Column, duration: Column, rate: float) -> tuple[Column, Column]:
    """(first, last) sample of an event, rounded half to even; an event holds its first sample at least."""
    start = F.rint(t * rate).cast("long")
    end = F.rint((t + F.coalesce(duration, F.lit(0.0))) * rate).cast("long")
    return start, F.greatest(start, end - 1)


def event_type(description: Column) -> Column:
    """What stands before ' - '; stages together."""
    head = F.trim(F.substring_index(description, " - ", 1))
    return F.when(F.lower(head).startswith("stage"), "Stage").otherwise(head)


def stage_label(description: Column) -> Column:
    """What follows 'Stage - '; all of a description that isn't of that form."""
    t = F.trim(description)
    return F.trim(F.when(t.rlike(STAGE), F.regexp_extract(t, STAGE, 1)).otherwise(t))


def duration_types(annotations: DataFrame) -> DataFrame:
    """Rows (etype, n): types of events that last, without stages, the most frequent first."""
    lasting = annotations.withColumn("etype", event_type(F.col("description"))).where("duration_sec > 0 and etype <> 'Stage'")
    return lasting.groupBy("etype").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "etype")


def by_epoch(annotations: DataFrame, lasts: DataFrame, rate: float, epoch_seconds: float = 30.0, key: str = "recording") -> DataFrame:
    """Rows (key, epoch, stage, spans, onsets): all that annotations say of an epoch, one row each.

    Epochs are numbered from 1. A stage holds from its epoch to the next one's; the first also before it; of several in an epoch the last counts.
    spans are the lasting events (etype, lo, hi) that touch the epoch, onsets (first, t, description, etype) what starts in it. Starts before 0 go.
    `lasts` has (key, last), the last sample; an epoch number of the annotations themselves (epoch) is taken where there is one.
    """
    size = max(1, round(epoch_seconds * rate))
    at = lambda c: F.floor(c / size) + 1
    first, last = aligned(F.col("t_sec"), F.col("duration_sec"), rate)
    marks = annotations.withColumns({"first": first, "last": last, "etype": event_type(F.col("description"))}).where("first >= 0")
    own = F.coalesce(F.col("epoch").cast("long"), at(F.col("first"))) if "epoch" in annotations.columns else at(F.col("first"))
    stages = marks.where("etype = 'Stage'").groupBy(key, own.alias("from")).agg(F.max(F.struct("t_sec", "description")).alias("m")).select(key, "from", stage_label(F.col("m.description")).alias("stage"))
    w = Window.partitionBy(key).orderBy("from")  # one row an epoch at most
    stages = stages.join(lasts, key).withColumns({"low": F.when(F.row_number().over(w) == 1, F.lit(1)).otherwise(F.col("from")), "high": F.coalesce(F.lead("from").over(w) - 1, F.greatest("from", at(F.col("last"))))})
    stages = stages.where("low <= high").select(key, F.explode(F.sequence("low", "high")).alias("epoch"), "stage")
    spans = marks.where("etype <> 'Stage' and duration_sec > 0").withColumn("hi", F.col("last") + 1)
    spans = spans.select(key, F.struct("etype", F.col("first").alias("lo"), "hi").alias("x"), F.explode(F.sequence(at(F.col("first")), at(F.col("last")))).alias("epoch"))
    spans = spans.groupBy(key, "epoch").agg(F.collect_set("x").alias("spans"))
    starts = marks.groupBy(key, at(F.col("first")).alias("epoch")).agg(F.array_sort(F.collect_list(F.struct("first", "t_sec", "description", "etype"))).alias("onsets"))
    return stages.join(spans, [key, "epoch"], "full_outer").join(starts, [key, "epoch"], "full_outer")


def annotated(samples: DataFrame, annotations: DataFrame, rate: float, key: str = "recording", epoch_seconds: float = 30.0) -> DataFrame:
    """Samples (key, sample_index, ...) with epoch, stage, onset_types, onset_descriptions, active_types and active 0/1.

    What starts at a sample is joined by ';' (types once each), null where nothing does; active_types are the kinds of lasting events that hold it.
    Samples meet annotations by epoch, in one join: no window goes over a recording. Annotations have key, t_sec, description and duration_sec.
    """
    size = max(1, round(epoch_seconds * rate))
    i = F.col("sample_index")
    lasts = samples.groupBy(key).agg(F.max("sample_index").alias("last"))
    told = by_epoch(annotations, lasts.withColumnRenamed("last", "__last").select(key, F.col("__last").alias("last")), rate, epoch_seconds, key)
    rows = samples.withColumn("epoch", F.floor(i / size) + 1).join(told, [key, "epoch"], "left")
    here = F.filter("onsets", lambda o: o["first"] == i)
    on = F.filter("spans", lambda s: (s["lo"] <= i) & (i < s["hi"]))
    said = lambda c: F.nullif(F.array_join(c, ";"), F.lit(""))
    rows = rows.withColumns({
        "onset_types": said(F.array_distinct(F.transform(here, lambda o: o["etype"]))), "onset_descriptions": said(F.transform(here, lambda o: o["description"])),
        "active_types": F.coalesce(F.array_sort(F.array_distinct(F.transform(on, lambda s: s["etype"]))), F.array().cast("array<string>")),
    })
    return rows.withColumn("active", (F.size("active_types") > 0).cast("int")).drop("spans", "onsets")


def active_columns(rows: DataFrame, types: list[str]) -> DataFrame:
    """A column 0/1 for each of the types, named after it."""
    name = lambda t: re.sub(r"[^a-z0-9]+", "_", t.lower()).strip("_") + "_active"
    return rows.withColumns({name(t): F.array_contains("active_types", t).cast("int") for t in types})
