"""Comparison of gene calls of several callers.

Calls have (contig, strand, left_end, right_end, caller). Groups of equal calls come in two modes: `keyed` by contig,
strand and ends, and `adjacent`, runs of equal neighbours in the order contig, left, right, caller, where a call of the
other strand in between splits a run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ORDER = ("left_end", "right_end", "caller", "strand")


def merge_calls(*frames: DataFrame) -> DataFrame:
    """All calls with `ord`, their place within the contig."""
    merged = reduce(DataFrame.unionByName, frames)
    return merged.withColumn("ord", F.row_number().over(W.partitionBy("contig").orderBy(*ORDER)))


def identify_callers(calls: DataFrame) -> DataFrame:
    return calls.agg(F.countDistinct("caller").alias("n_callers"), F.array_join(F.sort_array(F.collect_set("caller")), "_").alias("callers"))


def stop() -> Column:
    return F.when(F.col("strand") == "+", F.col("right_end")).otherwise(F.col("left_end"))


def islands(rows: DataFrame, same: tuple[str, ...], order: tuple[str, ...], name: str = "group_no") -> DataFrame:
    """Number the runs of neighbouring rows of a contig that agree in the columns `same`."""
    run = W.partitionBy("contig").orderBy(*order)
    now = F.struct(*same)
    return rows.withColumn("_new", F.coalesce((now != F.lag(now).over(run)).cast("int"), F.lit(1))).withColumn(name, F.sum("_new").over(run).cast("long")).drop("_new")


def compare_calls(calls: DataFrame, mode: str = "keyed") -> DataFrame:
    """Each call with the number of its group within the contig."""
    if mode == "adjacent":
        return islands(calls, ("strand", "left_end", "right_end"), ORDER)
    return calls.withColumn("group_no", F.dense_rank().over(W.partitionBy("contig").orderBy("left_end", "right_end", "strand")).cast("long"))


def _groups(calls: DataFrame, mode: str) -> DataFrame:
    by = ["contig", "strand", "left_end", "right_end"]
    rows = calls if mode == "keyed" else compare_calls(calls, mode)
    return rows.groupBy(*by, *(["group_no"] if mode != "keyed" else [])).agg(F.countDistinct("caller").alias("n_callers"), F.array_join(F.sort_array(F.collect_set("caller")), "_").alias("callers"))


def with_caller_count(rows: DataFrame, calls: DataFrame) -> DataFrame:
    """rows with `total`, the number of callers: one broadcast row."""
    return rows.join(F.broadcast(calls.agg(F.countDistinct("caller").alias("total"))))


def superset_calls(calls: DataFrame, mode: str = "keyed") -> DataFrame:
    """One row a group: length, number of callers, their names, and how far they agree."""
    agreement = F.when(F.col("n_callers") == F.col("total"), "unanimous").when(F.col("n_callers") == 1, "unique").otherwise("multiple")
    groups = with_caller_count(_groups(calls, mode), calls)
    return groups.withColumn("length", F.col("right_end") - F.col("left_end") + 1).withColumn("agreement", agreement).drop("total", "group_no")


def common_core_calls(calls: DataFrame, mode: str = "keyed") -> DataFrame:
    """The groups on which all callers agree, numbered within the contig."""
    core = with_caller_count(_groups(calls, mode), calls).where("n_callers = total").drop("total", "group_no")
    return core.withColumn("call_no", F.row_number().over(W.partitionBy("contig").orderBy("left_end", "right_end", "strand")))


def score_calls(calls: DataFrame) -> DataFrame:
    """Each call with score1: the share of callers that made it, and half a share if others agree on the stop only."""
    same = W.partitionBy("contig", "strand", "left_end", "right_end")
    similar = W.partitionBy("contig", "strand", "_stop")
    rows = with_caller_count(calls.withColumn("_stop", stop()), calls)
    rows = rows.withColumn("identicals", F.count("*").over(same)).withColumn("similars", F.count("*").over(similar))
    a = F.col("identicals") / F.col("total")
    b = F.when(((a < 1) | (F.col("similars") > F.col("identicals"))) & (F.col("similars") > 1), F.lit(0.5) / F.col("total")).otherwise(F.lit(0.0))
    return rows.withColumn("score1", a + b).drop("_stop", "total")


def average_scores(calls: DataFrame) -> DataFrame:
    return score_calls(calls).groupBy("caller").agg(F.round(F.avg("score1"), 6).alias("avg_score"), F.count("*").alias("n_calls"))


def consensus_calls(calls: DataFrame, mode: str = "keyed", min_callers: int = 2) -> DataFrame:
    """Calls of the same stop merged to the longest; call_no also counts the merged calls of too few callers."""
    rows = calls.withColumn("stop", stop())
    if mode == "adjacent":
        rows = islands(rows, ("strand", "stop"), ORDER, "call_no")
    else:
        rows = rows.withColumn("call_no", F.dense_rank().over(W.partitionBy("contig").orderBy("stop", "strand")).cast("long"))
    merged = rows.groupBy("contig", "strand", "stop", "call_no").agg(
        F.min("left_end").alias("left_end"), F.max("right_end").alias("right_end"), F.countDistinct("caller").alias("n_callers"), F.array_join(F.sort_array(F.collect_set("caller")), "_").alias("callers"))
    return merged.where(F.col("n_callers") >= min_callers).drop("stop").withColumn("length", F.col("right_end") - F.col("left_end") + 1)


def consensus_scores_listing(calls: DataFrame) -> DataFrame:
    """(line): caller, contig, number, ends, strand and score of each call, tab-separated."""
    numbered = score_calls(calls).withColumn("gene_no", F.row_number().over(W.partitionBy("contig", "caller").orderBy(*ORDER)))
    return numbered.select(F.concat_ws("\t", "caller", "contig", "gene_no", "left_end", "right_end", "strand", F.format_string("%.2f", F.bround("score1", 2))).alias("line"))


def call_grid(calls: DataFrame, callers: list[str]) -> DataFrame:
    """One row a group, six columns a caller; null where the caller lacks the call."""
    numbered = calls.withColumn("gene_no", F.row_number().over(W.partitionBy("contig", "caller").orderBy(*ORDER))).withColumn("length", F.col("right_end") - F.col("left_end") + 1)
    key = {"key_contig": "contig", "key_strand": "strand", "key_left": "left_end", "key_right": "right_end"}
    grouped = numbered.select("*", *[F.col(c).alias(k) for k, c in key.items()]).groupBy(*key).pivot("caller", callers)
    return grouped.agg(*[F.first(c).alias(c) for c in ("gene_no", "strand", "left_end", "right_end", "length", "contig")])


def call_stats(calls: DataFrame) -> DataFrame:
    """(caller, n_calls, min_length, max_length, avg_length)."""
    length = F.col("right_end") - F.col("left_end") + 1
    return calls.groupBy("caller").agg(F.count("*").alias("n_calls"), F.min(length).alias("min_length"), F.max(length).alias("max_length"), F.round(F.sum(length) / F.count("*"), 4).alias("avg_length"))


def call_totals(calls: DataFrame) -> DataFrame:
    """(n_distinct, n_common, n_unique) groups."""
    groups = with_caller_count(_groups(calls, "keyed"), calls)
    return groups.agg(F.count("*").alias("n_distinct"), F.count_if(F.expr("n_callers = total")).alias("n_common"), F.count_if(F.expr("n_callers = 1")).alias("n_unique"))


def same_save_start(calls: DataFrame) -> DataFrame:
    """Pairs of calls that share the stop and differ in the start, the longer one first."""
    rows = calls.select("contig", "strand", stop().alias("stop"), (F.col("left_end") + F.col("right_end") - stop()).alias("start"), "caller")
    a, b = rows.alias("a"), rows.alias("b")
    length = lambda side: F.abs(F.col(f"{side}.stop") - F.col(f"{side}.start"))
    joined = a.join(b, F.expr("a.contig = b.contig AND a.strand = b.strand AND a.stop = b.stop")).where(length("a") > length("b"))
    return joined.select("a.contig", "a.strand", "a.stop", F.col("a.start").alias("start1"), F.col("b.start").alias("start2"), F.col("a.caller").alias("caller1"), F.col("b.caller").alias("caller2"))


def primary_calls(calls: DataFrame, choice: str) -> DataFrame:
    """(contig, strand, left_end, right_end, callers) of one caller, `superset`, `consensus` or `common_core`."""
    sets = {"superset": superset_calls, "consensus": consensus_calls, "common_core": common_core_calls}
    chosen = sets[choice](calls) if choice in sets else calls.where(F.col("caller") == choice).withColumn("callers", F.col("caller"))
    return chosen.select("contig", "strand", "left_end", "right_end", "callers")
