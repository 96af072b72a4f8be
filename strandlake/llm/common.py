"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.session import drop, fresh, scratch

__all__ = ["BROADCAST_BYTES", "WORD", "drop", "fresh", "maybe_broadcast", "put", "scratch", "short_batches", "spare", "table", "tokenizer_file"]

#: A word is a maximal run of anything but the space and the ASCII controls TAB to CR.
WORD = r"[^\x20\x09-\x0D]+"

#: The most bytes a broadcast side may hold; larger sides are joined by shuffle.
BROADCAST_BYTES = 64_000_000


def table(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(c: Column, kind: T.DataType) -> Column:
    """About how many bytes the value takes."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType):
            return F.coalesce(F.aggregate(c, F.lit(0), lambda n, x: n + F.coalesce(F.octet_length(x), F.lit(0)) + 16), F.lit(0)) + 16
        width = 8 * (1 + len(kind.elementType.fields)) if isinstance(kind.elementType, T.StructType) else 8
        return F.greatest(F.size(c), F.lit(0)) * width + 16
    if isinstance(kind, T.StructType):
        return sum((_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(16))
    return F.lit(8)


def maybe_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """`df` marked for broadcast if its rows are measured to take at most `most` bytes, else as it is.

    Measuring reads `df` once more: give it a written table unless that is cheap.
    """
    width = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16)).cast("long")
    size = df.select(width.alias("width")).agg(F.coalesce(F.sum("width"), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= most else df


def put(df: DataFrame, **columns: Column) -> DataFrame:
    """Add the columns; columns of these names that `df` had (in any case) give way."""
    new = {name.lower() for name in columns}
    kept = [F.col(f"`{name}`") for name in df.columns if name.lower() not in new]
    return df.select(*kept, *[c.alias(name) for name, c in columns.items()])


def short_batches(df: DataFrame, most: int = 1_000) -> DataFrame:
    """`df`, whose session hands rows to Python in batches of `most` rows from now on, or of fewer if it is set so: a batch
    of whole texts is held in memory several times."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= most:
        conf.set(key, most)
    return df


def spare(df: DataFrame, name: str) -> str:
    """`name`, or a longer one if `df` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer `name` lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
