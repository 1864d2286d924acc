"""Accuracy of runs, differences between runs, usage and cost, image duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonde.operators import hamming
from sonde.session import stored


def long_form(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])).alias("f")).select(key, "f.field", "f.value")


def field_metrics(run: DataFrame, truth: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows (field, matches, false_pos, false_neg, wrong): blank equals blank; one join on the entity, no row per field before it."""
    pairs = run.select(key, *[F.col(c).cast("string").alias(f"__r{i}") for i, c in enumerate(columns)]).join(truth.select(key, *[F.col(c).cast("string").alias(f"__t{i}") for i, c in enumerate(columns)]), key)
    rows = pairs.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"__r{i}").alias("r"), F.col(f"__t{i}").alias("t")) for i, c in enumerate(columns)])).alias("f")).select("f.*")
    r, t = F.col("r"), F.col("t")
    return rows.groupBy("field").agg(
        F.count_if(r.eqNullSafe(t)).alias("matches"), F.count_if(r.isNotNull() & t.isNull()).alias("false_pos"),
        F.count_if(r.isNull() & t.isNotNull()).alias("false_neg"), F.count_if(r != t).alias("wrong"), F.count_if(r.isNotNull() & r.eqNullSafe(t)).alias("true_pos"),
    )


def scores(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and f1 with denominators of at least one."""
    tp, p = F.col("true_pos"), F.col("true_pos") + F.col("false_pos") + F.col("wrong")
    r = F.col("true_pos") + F.col("false_neg") + F.col("wrong")
    return counts.withColumn("precision", tp / F.greatest(F.lit(1), p)).withColumn("recall", tp / F.greatest(F.lit(1), r)).withColumn("f1", 2 * tp / F.greatest(F.lit(1), p + r))


def confusion(df: DataFrame, truth: Column, guess: Column) -> DataFrame:
    n = df.agg(*[F.count_if((truth == a) & (guess == b)).alias(name) for a, b, name in ((1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn"))])
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    safe = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return n.select("*", safe(F.col("tp") + F.col("tn"), total).alias("accuracy"), safe(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), safe(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def run_diff(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Rows (key, status): same, different, only_a, only_b."""
    left, right = a.select(key, F.col(value).alias("__a"), F.lit(1).alias("__l")), b.select(key, F.col(value).alias("__b"), F.lit(1).alias("__r"))
    return left.join(right, key, "full_outer").select(key, F.when(F.col("__r").isNull(), "only_a").when(F.col("__l").isNull(), "only_b").when(F.col("__a").eqNullSafe(F.col("__b")), "same").otherwise("different").alias("status"))


def usage(df: DataFrame, keys: list[str], tokens: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("requests"), F.sum(tokens).alias("tokens"), F.max(tokens).alias("most"))


def priced(rows: DataFrame, prices: dict[str, float], model: str, tokens: str) -> DataFrame:
    """Adds cost per million tokens and a note where no price is known."""
    price = F.create_map(*[x for k, v in prices.items() for x in (F.lit(k), F.lit(v))])[F.col(model)]
    return rows.withColumn("cost", price * F.col(tokens) / 1e6).withColumn("note", F.when(price.isNull(), "no price"))


def near_pairs(df: DataFrame, ident: str, bits: str, most: int, width: int = 64) -> DataFrame:
    """Rows (a, b, distance): hashes (long) at most `most` bits apart. One of most + 1 bands is equal in any such pair,
    so pairs are found by band and no two others meet."""
    n = most + 1
    cut = [width * i // n for i in range(n + 1)]
    bands = F.array(*[F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(bits, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1)).alias("v")) for i, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False))])
    rows = df.select(ident, bits, F.explode(bands).alias("k"))
    a, b = rows.select(F.col(ident).alias("a"), F.col(bits).alias("x"), "k"), rows.select(F.col(ident).alias("b"), F.col(bits).alias("y"), "k")
    far = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))).cast("int")
    return a.join(b, "k").where(F.col("a") < F.col("b")).select("a", "b", far.alias("distance")).where(F.col("distance") <= most).distinct()


def near_classes(df: DataFrame, ident: str, bits: str) -> DataFrame:
    """Rows (ident, class_id, links, near): hashes (long) at most one bit apart, without a row for each pair.

    class_id is the least ident of the rows with the same hash, near the class ids one bit away, in order and joined by commas (null without
    any), links how many other rows are at most one bit away. A hash's neighbours are looked up by setting each of its bits that is
    not set, so work grows with the different hashes, whatever their groups.
    """
    classes = stored(df.groupBy(bits).agg(F.min(ident).alias("class_id"), F.count("*").alias("n")), "near-classes")
    up = F.filter(F.transform(F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)]), lambda b: F.col(bits).bitwiseOR(b)), lambda x: x != F.col(bits))
    above = classes.select("class_id", "n", F.explode(up).alias(bits)).join(classes.select(bits, F.col("class_id").alias("__c"), F.col("n").alias("__n")), bits)
    both = F.inline(F.array(F.struct(F.col("class_id").alias("class_id"), F.col("__c").alias("c"), F.col("__n").alias("m")), F.struct(F.col("__c").alias("class_id"), F.col("class_id").alias("c"), F.col("n").alias("m"))))
    linked = above.select(both).groupBy("class_id").agg(F.sum("m").alias("m"), F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("near"))
    told = classes.join(linked, "class_id", "left").select(bits, "class_id", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("links"), "near")
    return df.join(told, bits).select(ident, "class_id", "links", "near")


def near_links(df: DataFrame, ident: str, hash_: str, longs: int, most: int) -> DataFrame:
    """Rows (ident, class_id, links, first_near): hashes of `longs` numbers at most `most` bits apart, without a row for each pair.

    class_id is the least ident of the rows with the same hash, links how many other rows are near, first_near the least class_id of another
    hash that is near (null without any). Each two different hashes that are near count; `hamming.met` gives them as pairs too.
    """
    classes = stored(df.groupBy(hash_).agg(F.min(ident).alias("class_id"), F.count("*").alias("n")), "near-classes")
    near = hamming.met(classes.withColumn("__all", F.lit(0)), "__all", "class_id", hash_, longs, most, pairs=False, times="n")
    told = classes.join(near, "class_id", "left").select(hash_, "class_id", (F.col("n") - 1 + F.coalesce("many", F.lit(0))).alias("links"), F.col("first").alias("first_near"))
    return df.join(told, hash_).select(ident, "class_id", "links", "first_near")
