"""Answers of external models and their headers as columns: objects in texts, wrapped values, batch records, limits and waits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.functions import scalars as S

# Names under which answers carry a thing, the first that isn't empty counts.
ABOUT = ("CDM_Context", "cdm_context", "CDM_context")
FILLED_BY = ("filled_by", "who_filled", "source_filler", "filler")
QUESTION = ("question", "source_question", "exact_question", "prompt", "text")
PAGE_TYPE = ("relevance", "page", "page_summary", "source_page", "page_context", "summary")
TOTALS = ("total_tokens", "totalTokenCount", "total_token_count", "totalTokens")
INPUTS, OUTPUTS = ("input_tokens", "prompt_tokens"), ("output_tokens", "completion_tokens")
PLACES = ("usage_metadata", "response_metadata", "additional_kwargs")
TEXTS = ("text", "output_text", "generated_text", "answer")
LIMITS = {"limit_requests": "limit-requests", "remaining_requests": "remaining-requests", "reset_requests_sec": "reset-requests", "limit_tokens": "limit-tokens", "remaining_tokens": "remaining-tokens", "reset_tokens_sec": "reset-tokens"}
WAITS = r"(?s)(?:retry after|try again in)[^0-9.]{0,70}([0-9.]+)"
DOCTOR, PATIENT = "doctor|physician|clinician|technician|의사|의료진", "patient|self|환자|본인"


def object_text(c: str | Column) -> Column:
    """The text of a JSON object: the whole of it, or what stands from the first to the last brace; null if neither is one."""
    t = F.trim(S.col(c))
    inner = S.found(t, r"(?s)(\{.*\})")
    one = lambda x: F.when(F.startswith(x, F.lit("{")) & F.from_json(x, "map<string,string>").isNotNull() & F.json_object_keys(x).isNotNull(), x)
    return F.coalesce(one(t), one(inner))


def first_of(json: Column, names: tuple[str, ...], under: str = "$") -> Column:
    return F.coalesce(*[F.nullif(F.trim(F.get_json_object(json, f"{under}.{n}")), F.lit("")) for n in names])


def wrapped_values(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows (keys, key, value, about, filled_by, question, page_type, certainty): one for each key of an answer's object.

    A value stands alone, or in an object under `value` with what it is about beside it; lists and other objects keep their text.
    """
    pairs = F.explode(F.from_json(object_text(text), "map<string,string>"))
    rows = df.select(*keys, pairs.alias("key", "__v")).where(F.trim("key") != "")
    v = F.col("__v")
    boxed = v.startswith("{") & F.array_contains(F.json_object_keys(v), "value")
    deep = F.when(boxed, F.coalesce(F.get_json_object(v, "$.input_context"), v))
    plain = F.when(~F.startswith(F.get_json_object(v, "$.input_context"), F.lit("{")), F.get_json_object(v, "$.input_context"))
    who = F.lower(first_of(deep, FILLED_BY))
    return rows.select(
        *keys, F.trim("key").alias("key"), F.when(boxed, F.get_json_object(v, "$.value")).otherwise(v).alias("value"), F.when(boxed, first_of(v, ABOUT)).alias("about"),
        F.when(who.rlike(DOCTOR), "doctor").when(who.rlike(PATIENT), "patient").alias("filled_by"), F.coalesce(plain, first_of(deep, QUESTION)).alias("question"),
        F.coalesce(first_of(deep, ("page_type",)), page_type(first_of(deep, PAGE_TYPE))).alias("page_type"), F.get_json_object(v, "$.certainty.total_score").alias("certainty"),
    )


def page_type(c: str | Column) -> Column:
    """x of a text that begins with [page_type: x]."""
    return F.trim(S.found(F.trim(S.col(c)), r"^\[page_type:\s*([^\]]+)\]"))


def batch_text(record: str | Column) -> Column:
    """The different texts of a batch record's first candidate, one a line; else any text the response holds."""
    r = F.get_json_object(S.col(record), "$.response")
    parts = F.from_json(F.get_json_object(r, "$.candidates[0].content.parts"), "array<struct<text:string>>")
    told = F.transform(parts, lambda p: F.trim(p["text"]))
    alone = F.array(F.trim(F.get_json_object(r, "$.candidates[0].text")))
    anywhere = F.transform(F.regexp_extract_all(r, F.lit(rf'"(?:{"|".join(TEXTS)})"\s*:\s*("(?:[^"\\]|\\.)*")'), F.lit(1)), lambda x: F.trim(F.get_json_object(F.concat(F.lit('{"t":'), x, F.lit("}")), "$.t")))
    some = lambda a: F.array_distinct(F.filter(a, lambda x: x != ""))
    chosen = F.coalesce(*[F.when(F.size(some(a)) > 0, some(a)) for a in (told, alone, anywhere)])
    return F.when(F.size(F.from_json(F.get_json_object(r, "$.candidates"), "array<string>")) > 0, F.array_join(chosen, "\n"))


def batch_error(record: str | Column) -> Column:
    e = F.get_json_object(S.col(record), "$.error")
    return F.coalesce(F.nullif(F.get_json_object(e, "$.message"), F.lit("")), F.nullif(e, F.lit("")))


def last_by_key(records: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last record of each key, as a batch's answers are read."""
    w = Window.partitionBy(key).orderBy(*[F.desc(o) for o in order])
    return records.withColumn("__n", F.row_number().over(w)).where("`__n` = 1").drop("__n")


def total_tokens(response: str | Column) -> Column:
    """Tokens of a response: a total under one of its names at the top or in its metadata, else input plus output."""
    r = S.col(response)
    number = lambda under, names: F.coalesce(*[F.get_json_object(r, f"{under}.{n}").try_cast("double") for n in names])
    at = ["$", *(f"$.{p}" for p in PLACES), *(f"$.{p}.usage_metadata" for p in PLACES)]
    tries = [x for u in [*at[1:], at[0]] for x in (number(u, TOTALS), number(u, INPUTS) + number(u, OUTPUTS))]
    return F.coalesce(*tries).cast("long")


def plain_headers(headers: str | Column) -> Column:
    """A map of headers with lower-case names and trimmed values."""
    return F.transform_values(F.transform_keys(S.col(headers), lambda k, v: F.lower(F.trim(k))), lambda k, v: F.trim(v))


def limits(headers: str | Column, body: str | Column) -> Column:
    """struct of limits, what remains of them, seconds to their reset, and retry_after_sec: the header's, a reset's, or what the text says."""
    h = plain_headers(headers)
    values = {name: S.backoff_seconds(F.try_element_at(h, F.lit(f"x-ratelimit-{key}"))) for name, key in LIMITS.items()}
    positive = lambda x: F.when(x > 0, x)
    said = S.found(F.lower(S.col(body)), WAITS).try_cast("double")
    wait = F.coalesce(positive(S.backoff_seconds(F.try_element_at(h, F.lit("retry-after")))), positive(values["reset_requests_sec"]), positive(values["reset_tokens_sec"]), said)
    return F.struct(*[c.alias(n) for n, c in values.items()], wait.alias("retry_after_sec"))
