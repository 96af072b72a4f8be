"""Mixing sources to target weights by hash-threshold histograms; DataFrame functions only.

Every document has a fixed 60-bit hash. Words are summed by source and by the hash's leading bits; the running sum
gives, for each source, the bucket in which its budget ends. Only that bucket is split by the next bits, until the
whole hash is used. What lies below the final hash is taken: a filter, no sort of documents. Budgets nest: a larger
budget takes all that a smaller one takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, maybe_broadcast, put, spare, table

BITS, LEVELS = 15, 4


def hash60(doc_id: Column, text: Column) -> Column:
    """The first 15 hex digits of an MD5 of id and text, as a number."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size) -> with target: shares of all words by weight, none above `most` times its source.

    Weights repeat over the sources in code-point order, null last. Sources are few beside documents (one row each),
    so the two windows over them run in one task. The excess of capped sources is shared again by weight: in the order
    of size over weight the capped ones come first, and the level of the rest follows from running sums.
    """
    everything = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("at", F.row_number().over(everything)).withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("int")))
    order = W.orderBy(F.col("source_size") / F.col("weight"), "at")
    before, whole = order.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.lit(float(most)) * F.col("source_size")
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    leveled = ranked.withColumn("level", level).withColumn("capped", cap < F.col("level") * F.col("weight"))
    rest = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    filled = leveled.withColumn("rest", rest)
    return filled.select("source", "source_size", F.when(F.col("capped"), cap).otherwise(F.col("rest") * F.col("weight")).alias("target"))


def cutoffs(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, whole, cut, some, same): `whole` copies of all, one more of hashes below cut and of `some` of the `same`
    rows at it."""
    size = F.col("source_size")
    state = goals.withColumn("whole", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
    state = state.select("source", "source_size", "target", "whole", (F.col("target") - F.col("whole") * size).alias("left"), F.lit(0).cast("long").alias("prefix"))
    for step in range(1, LEVELS + 1):
        state = table(state, f"mix-level{step - 1}")
        open_ = maybe_broadcast(state.where("left > 0").select(F.col("source").alias("of"), "left", "prefix"))
        rows = slim.select("source", "size", F.shiftright("h", BITS * (LEVELS - step)).alias("bucket"))
        hist = rows.join(open_, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("bucket", BITS) == F.col("prefix")))
        hist = hist.groupBy("of", "left", "bucket").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        run = W.partitionBy("of", "left").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        ends = hist.withColumn("upto", F.sum("words").over(run)).where(F.col("upto") >= F.col("left") - 1e-6)
        ends = ends.groupBy("of").agg(F.min_by(F.struct("bucket", "words", "upto", "rows"), "bucket").alias("end"))
        state = state.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", "target", "whole",
            F.when(F.col("end").isNull(), F.lit(0.0)).otherwise(F.col("left") - F.col("end.upto") + F.col("end.words")).alias("left"),
            F.coalesce(F.col("end.bucket"), F.lit(-1)).cast("long").alias("prefix"),
            *([F.coalesce(F.col("end.words"), F.lit(0)).alias("words"), F.coalesce(F.col("end.rows"), F.lit(0)).alias("same")] if step == LEVELS else []))
    some = F.when(F.col("words") > 0, F.least(F.floor(F.col("left") * F.col("same") / F.col("words") + 0.5), F.col("same"))).otherwise(F.col("same"))
    return state.select("source", "source_size", "target", "whole", F.col("prefix").alias("cut"), some.alias("some"), "same")


def _some(rows: DataFrame, own: str) -> DataFrame:
    """Of rows equal in source and hash (those at a cut) the first `some` of struct `own` get True in column `own`_more.

    Rows are numbered within written parts and parts by running sums, so equal rows never meet in one task.
    """
    part, at, cut = f"{own}_part", f"{own}_at", F.col(own)
    held = table(rows.withColumn(part, F.spark_partition_id()), "mix-boundary")
    numbered = held.withColumn(at, F.row_number().over(W.partitionBy(part, f"{own}._source").orderBy(F.lit(0))))
    counts = held.groupBy(F.col(f"{own}._source").alias("of"), F.col(part).alias("in")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("of").orderBy("in").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    before = counts.select(F.struct("of", "in", before.alias("n")).alias(f"{own}_before"))
    joined = numbered.join(maybe_broadcast(before), cut["_source"].eqNullSafe(F.col(f"{own}_before.of")) & (F.col(part) == F.col(f"{own}_before.in")))
    return joined.withColumn(f"{own}_more", F.col(at) + F.col(f"{own}_before.n") <= cut["some"]).drop(part, at, f"{own}_before")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Add size (words), source_size, target and taken (words the mix takes, repeats counted) to each row.

    A document is taken whole, a whole number of times, at most `most` rounded down times; the document in which a
    source's budget ends is taken if that comes nearer to the target. Of rows equal in id and text, which share a hash,
    as many are taken as come nearest. A null text has size 0; null is a source of its own, weighted last; sources without words get
    target 0; an empty table gives an empty table. Columns of the four names are replaced, all others stay.
    """
    slim = table(docs.select(F.col(source).alias("source"), n_words(F.col(text)).alias("size"), hash60(F.col(doc_id), F.col(text)).alias("h")), "mix-slim")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    cuts = table(cutoffs(slim, table(targets(sizes, weights, most), "mix-targets")), "mix-cuts")
    partial = not cuts.where("some > 0 AND some < same").isEmpty()
    own = spare(docs, "_cut")
    packed = F.struct(F.col("source").alias("_source"), F.col("source_size").alias("_size"), F.col("target").alias("_target"), "whole", "cut", "some", "same")
    h, cut = hash60(F.col(doc_id), F.col(text)), F.col(own)
    joined = docs.join(maybe_broadcast(cuts.select(packed.alias(own))), F.col(source).eqNullSafe(F.col(f"{own}._source")))
    more = (h < cut["cut"]) | ((h == cut["cut"]) & (cut["some"] > 0))
    if partial:  # a source's budget ends among equal rows
        split = (h == cut["cut"]) & (cut["some"] > 0) & (cut["some"] < cut["same"])
        joined = joined.where(~split).withColumn(f"{own}_more", more).unionByName(_some(joined.where(split), own))
    else:
        joined = joined.withColumn(f"{own}_more", more)
    sized = put(joined, size=n_words(F.col(text)))
    mixed = put(sized, source_size=cut["_size"], target=cut["_target"], taken=F.col("size") * (cut["whole"] + F.col(f"{own}_more").cast("long")))
    return mixed.drop(own, f"{own}_more")


def op6_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY source, h) AS twin FROM d),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n FROM d GROUP BY source),
w AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight FROM s),
l AS (SELECT *, (sum(n) OVER () - coalesce(sum(3.0 * n) OVER p, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS level
    FROM w WINDOW p AS (ORDER BY n / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, n, CASE WHEN 3.0 * n < level * weight THEN 3.0 * n
    ELSE (SELECT min_by(level, n / weight) FROM l WHERE 3.0 * n >= level * weight) * weight END AS target FROM l),
g AS (SELECT source, h, sum(size) AS words, count(*) AS same FROM d GROUP BY source, h),
c AS (SELECT source, h, words, same, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
b AS (SELECT t.*, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM t),
e AS (SELECT b.source, min(h) AS cut, min_by(CASE WHEN words > 0 THEN least(floor((target - whole * n - upto + words) * same / words + 0.5), same) ELSE same END, h) AS some
    FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source
    WHERE target - whole * n > 0 AND upto >= target - whole * n - 1e-6 GROUP BY b.source)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, CAST(b.n AS BIGINT) AS source_size, b.target,
    CAST(d.size * (b.whole + CASE WHEN d.h < coalesce(e.cut, -1) OR d.h = e.cut AND d.twin <= e.some THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r AS d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""
