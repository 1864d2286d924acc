"""Importance resampling towards a target's n-gram distribution, in DataFrame functions only.

Runs of words are hashed to buckets by crc32. A bucket's gain is the log ratio of its share in the target and in the raw
rows; a document's weight is the mean gain of its features. Weights with Gumbel noise from the documents' ids are sorted,
and the highest are drawn: that samples without replacement in proportion to exp(weight / 1000).

What moves: one count a bucket and task, one partial sum a document and task, and the drawn order's rows of five numbers.
Only the table of gains is broadcast, at most `buckets` rows of two numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonde.llm.common import stored

GRAMS, BUCKETS = 1, 10_000
SEED, SHARE, LEAST_WORDS = 2024, 10, 20
#: Most buckets whose gains are broadcast (some 16 MB).
MOST_BUCKETS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words in order: runs of digits, letters and what is beyond ASCII; of upper case only A-Z is lowered."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def features(own: Column, grams: int = GRAMS) -> Column:
    """All runs of 1 to `grams` consecutive words, joined by one space, as often as they occur."""
    runs, last = [own], own
    for n in range(2, grams + 1):
        left = F.greatest(F.lit(0), F.size(own) - (n - 1))
        last = F.zip_with(F.slice(last, F.lit(1), left), F.slice(own, F.lit(n), left), lambda x, y: F.concat(x, F.lit(" "), y))
        runs.append(last)
    return F.concat(*runs)


def bucket(feature: Column, buckets: int = BUCKETS) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_counts(df: DataFrame, text: str, grams: int, buckets: int) -> DataFrame:
    found = df.select(F.explode(features(words(F.col(text)), grams)).alias("f"))
    return found.groupBy(bucket(F.col("f"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, gain) for every bucket, from rows (bucket, n) of the raw rows and of the target: floor(1000 ln) of the ratio of shares, one added to each count."""
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    of = both.unionByName(every).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    whole = Window.partitionBy()  # over the buckets only
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    every_s, every_t = F.sum("s").over(whole).cast("double"), F.sum("t").over(whole).cast("double")
    return of.withColumns({"__all_s": every_s, "__all_t": every_t}).select("bucket", F.floor(1000 * F.log((t + 1) * (F.col("__all_s") + buckets) / ((s + 1) * (F.col("__all_t") + buckets)))).alias("gain"))


def gumbel(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of sha256 of '<seed>:<id>'; null ids are the empty id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(docs: DataFrame, gain: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score), one for each row of `docs`.

    Features are summed by document within the task that reads it, so one partial sum a document moves. Rows that repeat an
    id and a text are summed together and dealt out again.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("__a"), F.hash(text).alias("__b"), words(text).alias("__w"))
    rows = rows.select("doc_id", "__a", "__b", F.size("__w").alias("__n"), F.posexplode_outer(features(F.col("__w"), grams)).alias("__at", "__f"))
    found = rows.withColumn("bucket", bucket(F.col("__f"), buckets)).join(F.broadcast(gain), "bucket", "left")
    first = F.col("__at").isNull() | (F.col("__at") == 0)  # one such row a document
    sums = found.groupBy("doc_id", "__a", "__b", "__n").agg(F.count("__f").alias("__features"), F.sum("gain").alias("__gain"), F.count_if(first).alias("__copies"))
    n, total = F.expr("`__features` div `__copies`"), F.expr("`__gain` div `__copies`")
    sums = sums.select("doc_id", F.col("__n").cast("long").alias("n_words"), n.alias("n_features"), F.coalesce(total, F.lit(0)).alias("__gain"), "__copies")
    mean = F.when(F.col("n_features") > 0, F.expr("(`__gain` - pmod(`__gain`, n_features)) div n_features")).otherwise(F.lit(0)).cast("long")
    sums = sums.withColumn("weight", mean).withColumn("score", F.col("weight") + gumbel(seed=seed))
    return sums.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select("doc_id", "n_words", "n_features", "weight", "score")


def ranked(rows: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """Adds ranks 1, 2, 3 ... in `order`: rows are dealt by ranges and sorted, a row's rank is its place and the sizes of the ranges before.

    The sorted rows are stored before sizes are counted, so both passes see the same ranges. What is broadcast is one number a range.
    """
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    spread = stored(spread.withColumns({"__part": F.shiftright(place, 33), "__at": place.bitwiseAND(F.lit((1 << 33) - 1))}), "ranked")
    sizes = spread.groupBy("__part").agg(F.count("*").alias("__size"))
    before = F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # one row a range
    sizes = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return spread.join(sizes, "__part").withColumn(rank, F.col("__before") + F.col("__at") + 1).drop("__part", "__at", "__before")


def resample(docs: DataFrame, target: DataFrame, share: int = SHARE, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED, least: int = LEAST_WORDS) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), all long, one for each row of `docs`.

    Of the N documents with at least `least` words, floor(share N / 100) with the highest scores are drawn, ties to smaller ids;
    rank is null for the others. `target` has a column text. Null and empty texts have no features and weight 0; null ids count as
    the empty id and come last among ties; rows that repeat take part as often as they occur, rows alike in all columns are
    interchangeable. Very long texts are read whole: a text's words are one array of one row. Without target or documents all gains
    come from the ones added. Empty tables give empty results. Other columns of `docs` and `target` are not read.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets: 1 to {MOST_BUCKETS}")
    gain = gains(bucket_counts(docs, "text", grams, buckets), bucket_counts(target, "text", grams, buckets), buckets)
    rows = stored(weighted(docs, stored(gain, "gains"), grams, buckets, seed), "weighted")
    able = rows.where(F.col("n_words") >= least)
    drawn = able.count() * share // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_words"), F.asc("n_features")]
    placed = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
with recursive bits(i, c, k) as (select i, i::bigint, 0 from range(256) r(i) union all
  select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
crc as (select list(c order by i) as t from bits where k = 8),
dw as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
bw as (select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as f from benchmark),
df as (select r, unnest(w) as f from dw),
own as (select f, [('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::bigint for i in range(1, strlen(f) + 1)] as b from (select distinct f from (select f from df union all select f from bw))),
hashed as (select f, xor(list_reduce(b, lambda a, x: xor(a >> 8, crc.t[xor(a & 255, x) + 1]), 4294967295), 4294967295) % 10000 as k from own, crc),
s as (select k, count(*) as s from df join hashed using (f) group by 1), t as (select k, count(*) as t from bw join hashed using (f) group by 1),
n as (select (select count(*) from df) as big_s, (select count(*) from bw) as big_t),
g as (select k, floor(1000 * ln((coalesce(t, 0)::double + 1) * (big_s::double + 10000) / ((coalesce(s, 0)::double + 1) * (big_t::double + 10000))))::bigint as gain
  from range(10000) r(k) left join s using (k) left join t using (k), n),
d as (select r, count(*) as c, sum(gain)::hugeint as total from df join hashed using (f) join g using (k) group by 1),
w as (select doc_id, len(w)::bigint as n_features, case when c is null then 0 else ((total - ((total % c) + c) % c) // c)::bigint end as weight,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double) / 4294967296::double)))::bigint as noise from dw left join d using (r)),
o as (select *, weight + noise as score, n_features >= 20 as able, row_number() over (partition by n_features >= 20 order by weight + noise desc, doc_id nulls last, n_features) as k, count(*) filter (where n_features >= 20) over () as big_n from w)
select doc_id, n_features, weight, score, case when able and k <= big_n * 10 // 100 then k end as rank from o
"""
