"""Ordered scans of keys of any size: no task holds a whole key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.session import kept, kept_small


def with_place(rows: DataFrame, keys: list[str], order: list[Column | str], name: str) -> DataFrame:
    """`rows` with, in `name`, the place from 1 of each row among those of its keys; `rows` should be a written table.

    Rows are sorted into ranges of keys and order, whose bounds Spark samples, so that a key of many rows is spread over
    many ranges. Each range numbers its own rows; a table of a row for each key and range says how many come before.
    Without keys all rows are numbered together.
    """
    ranges = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = kept(ranges.withColumn("_range", F.spark_partition_id()).withColumn("_at", at), "ranges")
    starts = placed.groupBy("_range", *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = kept_small(starts.withColumn("_before", before).drop("_n"), "range-starts")  # else the rows themselves would be shuffled again
    return placed.join(starts, ["_range", *keys]).withColumn(name, (F.col("_at") - F.col("_first") + F.col("_before") + 1).cast("long")).drop("_range", "_at", "_first", "_before")


def look_back(rows: DataFrame, keys: list[str], place: str, lag: dict[str, Column], last: dict[str, Column], block: int = 50_000) -> DataFrame:
    """`rows` with new columns: those of `lag` hold the expression's value in the row before, those of `last` its last value
    that isn't null in any row before; null where there is none.

    `place` counts the rows of the keys from 1. Windows hold `block` rows at most; a table of a row for each key and block
    carries over what the next block looks back at.
    """
    rows = rows.withColumn("_block", F.floor((F.col(place) - 1) / block))
    near = W.partitionBy(*keys, "_block").orderBy(place)
    before = near.rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # a row a block
    ends = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n"), *[F.max_by(c, F.when(c.isNotNull(), F.col(place))).alias(f"_end_{n}") for n, c in last.items()])
    ends = ends.select(*keys, "_block", F.struct(F.lit(1).alias("one"), *[F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(n) for n in last]).alias("_last")).where("_block > 0")
    above = rows.where(F.col(place) % block == 0).select(*keys, (F.col("_block") + 1).alias("_block"), F.struct(F.lit(1).alias("one"), *[c.alias(n) for n, c in lag.items()]).alias("_lag"))
    carry = kept_small(ends.join(above, [*keys, "_block"], "left"), "block-ends")
    local = rows.select("*", *[F.lag(F.struct(c.alias("v"))).over(near).alias(f"_lag_{n}") for n, c in lag.items()], *[F.last(c, ignorenulls=True).over(before).alias(f"_last_{n}") for n, c in last.items()])
    found = local.join(carry, [*keys, "_block"], "left")
    of_lag = [F.when(F.col(f"_lag_{n}").isNotNull(), F.col(f"_lag_{n}.v")).otherwise(F.col(f"_lag.{n}")).alias(n) for n in lag]
    return found.select(*[c for c in rows.columns if c != "_block"], *of_lag, *[F.coalesce(f"_last_{n}", f"_last.{n}").alias(n) for n in last])


def placed_back(rows: DataFrame, keys: list[str], bins: list[Column], order: list[Column], name: str, lag: dict[str, Column], last: dict[str, Column], derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """with_place and look_back at once, by one shuffle and one sort: rows are dealt by keys and `bins`, which ascend with `order`
    and of which none should hold many rows. `derive` adds columns that `lag` and `last` use and that aren't worth shuffling or
    writing; the result has them.

    Each bin numbers its rows and looks back within them; a table of a row for each bin carries over what the next ones need.
    """
    of = [f"_bin{i}" for i in range(len(bins))]
    dealt = derive(rows.select("*", *[c.alias(n) for n, c in zip(of, bins, strict=True)]).repartition(*keys, *of))
    near = W.partitionBy(*keys, *of).orderBy(*order)
    before = near.rowsBetween(W.unboundedPreceding, -1)
    mine = F.struct(*[c.alias(n) for n, c in lag.items()])
    local = dealt.select(*rows.columns, *of, F.row_number().over(near).alias("_at"), F.lag(mine).over(near).alias("_lag"), F.lead(F.lit(1)).over(near).isNull().alias("_end"), *[F.last(c, ignorenulls=True).over(before).alias(f"_last_{n}") for n, c in last.items()])
    local = kept(local, "placed")
    along = W.partitionBy(*keys).orderBy(*of)  # a row a bin
    above = along.rowsBetween(W.unboundedPreceding, -1)
    ends = derive(local.where("_end")).select(
        *[F.col(c).alias(f"_of_{c}") for c in (*keys, *of)], F.coalesce(F.sum("_at").over(above), F.lit(0)).alias("_before"), F.lag(mine).over(along).alias("_above"),
        *[F.last(F.coalesce(c, f"_last_{n}"), ignorenulls=True).over(above).alias(f"_above_{n}") for n, c in last.items()])
    carry = kept_small(ends, "bin-ends")
    match = [local[c].eqNullSafe(carry[f"_of_{c}"]) for c in (*keys, *of)]
    found = local.join(carry, reduce(and_, match))
    of_lag = [F.when(F.col("_at") > 1, F.col(f"_lag.{n}")).otherwise(F.col(f"_above.{n}")).alias(n) for n in lag]
    return derive(found.select(*rows.columns, (F.col("_at") + F.col("_before")).cast("long").alias(name), *of_lag, *[F.coalesce(f"_last_{n}", f"_above_{n}").alias(n) for n in last]))
