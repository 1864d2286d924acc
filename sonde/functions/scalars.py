"""Column functions: missing values, canonical forms, numbers, dates, clocks and labels (JVM-side throughout)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that count as missing, by purpose.
MISSING = ("", "null", "none", "n/a", "na")
MISSING_EVAL = (*MISSING, "nan")
MISSING_NUMBER = ("n/a", "na", "none", "-", "--")
DASHES = ("-", "--", "—", "–")
NUMBER = r"[-+]?[0-9]+(?:\.[0-9]+)?"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def found(text: str | Column, pattern: str, group: int = 1) -> Column:
    """The group's text, null without a match."""
    return F.nullif(F.regexp_extract(col(text), pattern, group), F.lit(""))


def normalise_value(c: str | Column, missing: tuple[str, ...] = MISSING) -> Column:
    t = F.trim(col(c).cast("string"))
    return F.when(F.lower(t).isin(*missing), None).otherwise(t)


def collapse_spaces(c: str | Column) -> Column:
    return F.trim(F.regexp_replace(col(c), r"\s+", " "))


def ellipsize(c: str | Column, n: int) -> Column:
    t = collapse_spaces(c)
    return F.when(F.length(t) > n, F.concat(F.rtrim(F.substring(t, 1, n - 1)), F.lit("…"))).otherwise(t)


def alphanumeric(c: str | Column) -> Column:
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]", "")


def identifier(c: str | Column) -> Column:
    """snake_case."""
    return F.trim(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", "_"), F.lit("_"))


def option_label(c: str | Column) -> Column:
    """Lower case, without a leading item number, spaces collapsed."""
    return collapse_spaces(F.regexp_replace(F.lower(col(c)), r"^\s*[0-9]+[.)]\s*", ""))


def first_number(c: str | Column) -> Column:
    return found(F.regexp_replace(col(c), ",", ""), f"({NUMBER})").try_cast("double")


def strict_number(c: str | Column) -> Column:
    t = F.regexp_replace(F.trim(col(c)), ",", "")
    return F.when(t.rlike(f"^{NUMBER}$"), t.try_cast("double"))


def lenient_number(c: str | Column) -> Column:
    """Sentinels are null, `0..2` is 0.2, `15.` is 15, only the leading token counts."""
    t = F.regexp_extract(F.trim(col(c).cast("string")), r"^(\S*)", 1)
    t = F.regexp_replace(F.regexp_replace(t, r"\.{2,}", "."), r"\.$", "")
    return F.when(F.lower(t).isin(*MISSING_NUMBER), None).otherwise(t.try_cast("double"))


def number_token(c: str | Column) -> Column:
    """Integral doubles as integers, others to four places."""
    x = col(c).cast("double")
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(F.bround(x, 4).cast("string"))


def canonical_value(c: str | Column) -> Column:
    """Missing is null; a number is its shortest decimal form; else spaces are collapsed."""
    t = normalise_value(c, MISSING_EVAL)
    d = F.when(F.regexp_replace(t, ",", "").rlike(f"^{NUMBER}$"), F.regexp_replace(t, ",", "").try_cast("decimal(38,10)"))
    plain = F.regexp_replace(F.regexp_replace(d.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(plain, collapse_spaces(t))


def range_bounds(c: str | Column) -> tuple[Column, Column]:
    """(low, high) of `a~b`, `a-b`, `a to b`, `between a and b`; swapped when reversed; null when no range."""
    t = F.regexp_replace(F.lower(F.trim(col(c))), r"^between\s+(.*?)\s+and\s+", "$1~")
    t = F.regexp_replace(t, r"\s*(?:~|–|—|\bto\b)\s*", "~")
    pattern = r"^([0-9]+(?:\.[0-9]+)?)\s*[~-]\s*([0-9]+(?:\.[0-9]+)?)$"
    a, b = found(t, pattern, 1).try_cast("double"), found(t, pattern, 2).try_cast("double")
    return F.least(a, b), F.greatest(a, b)


def range_value(c: str | Column, how: str = "mid") -> Column:
    lo, hi = range_bounds(c)
    return F.coalesce((lo + hi) / 2 if how == "mid" else hi, first_number(c))


def percentage(c: str | Column) -> Column:
    return found(c, r"([0-9]+(?:\.[0-9]+)?)\s*%").try_cast("double") / 100


def valid_date(c: str | Column) -> Column:
    """The first eight digits together, when they are a day of the calendar."""
    t = F.coalesce(found(c, r"\b([0-9]{8})\b"), F.substring(F.regexp_replace(col(c), "[^0-9]", ""), 1, 8))
    return F.when(F.try_to_timestamp(t, F.lit("yyyyMMdd")).isNotNull() & (F.length(t) == 8), t)


def date_parts(y: str | Column, m: str | Column, d: str | Column) -> Column:
    t = F.concat(F.lpad(col(y).cast("string"), 4, "0"), F.lpad(col(m).cast("string"), 2, "0"), F.lpad(col(d).cast("string"), 2, "0"))
    return F.when(F.try_to_timestamp(t, F.lit("yyyyMMdd")).isNotNull(), t)


def clock_seconds(c: str | Column) -> Column:
    """HH:MM:SS.xx as seconds, null if it isn't one."""
    p = r"^\s*([0-9]{1,2}):([0-9]{2}):([0-9]{2}(?:\.[0-9]+)?)\s*$"
    return found(c, p, 1).cast("double") * 3600 + found(c, p, 2).cast("double") * 60 + found(c, p, 3).cast("double")


def duration_seconds(c: str | Column) -> Column:
    """`Dur: x sec`, else `Dur: x min` in seconds, else null."""
    return F.coalesce(found(c, r"(?i)Dur:\s*([0-9.]+)\s*sec").try_cast("double"), found(c, r"(?i)Dur:\s*([0-9.]+)\s*min").try_cast("double") * 60)


def backoff_seconds(c: str | Column) -> Column:
    """`1h2m3.5s`, `250ms` or a bare number, as seconds."""
    t = F.lower(F.trim(col(c)))
    part = lambda unit: F.coalesce(found(t, rf"([0-9.]+){unit}").try_cast("double"), F.lit(0.0))
    ms = found(t, r"^([0-9.]+)ms$").try_cast("double") / 1000
    whole = F.when(t.rlike(r"^(?:[0-9.]+h)?(?:[0-9.]+m)?(?:[0-9.]+s)?$") & (F.length(t) > 0), part("h") * 3600 + part("m(?!s)") * 60 + part("s"))
    return F.coalesce(t.try_cast("double"), ms, whole)


def clock_hour(c: str | Column, bed: bool = False) -> Column:
    """24 is 0; going to bed, 12 is 0 and 6 to 11 are in the evening; else 0 to 23 or null."""
    h = col(c).cast("int")
    h = F.when(h == 24, 0).otherwise(h)
    h = F.when(h == 12, 0).when(h.between(6, 11), h + 12).otherwise(h) if bed else h
    return F.when(h.between(0, 23), h)


def next_token(text: str | Column, label: str) -> Column:
    """The token right after a literal label that no word character or '-' precedes."""
    import re

    return found(collapse_spaces(text), rf"(?:^|[^\w-]){re.escape(label)}\s*(\S+)")


def choice_code(c: str | Column, codes: dict[str, int]) -> Column:
    """The code of the longest keyword contained, else a leading `n.`."""
    out = None
    for word in sorted(codes, key=lambda w: (-len(w), w)):
        hit = F.contains(col(c), F.lit(word))
        out = F.when(hit, codes[word]) if out is None else out.when(hit, codes[word])
    return out.otherwise(found(c, r"^\s*([0-9]+)\.").try_cast("int"))


def similarity_equal(a: str | Column, b: str | Column) -> Column:
    """Loose equality: the same letters and digits."""
    return alphanumeric(a).eqNullSafe(alphanumeric(b))


def token_estimate(c: str | Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.length(col(c)) / 4)).cast("long")


def ratio_text(correct: str | Column, total: str | Column) -> Column:
    return F.format_string("%d/%d (%.1f%%)", col(correct), col(total), F.coalesce(F.try_divide(col(correct) * 100.0, col(total)), F.lit(0.0)))


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a zoneless time stamp, whatever the session's zone."""
    t = col(ts)
    day = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return (day * 86400 + F.hour(t) * 3600 + F.minute(t) * 60) * 1000000 + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("long")


def day_micros(ts: str | Column) -> Column:
    return F.pmod(micros(ts), F.lit(86400 * 1000000))
