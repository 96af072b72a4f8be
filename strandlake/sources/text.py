"""Text files as rows, and what all readers share.

A reader takes a folder (or file) and gives one typed table of all its files. Numbers are read with try_cast; a data
line that doesn't fit its format is no row of the table but of `rejects` (file, line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.session import kept


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line), without a carriage return at the end."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r$", "").alias("line"))


def blocks(spark: SparkSession, path: str, mark: str) -> DataFrame:
    """(file, head, body): the parts of the files that begin with `mark` at the start of a line; head is the rest of that
    line, body the array of the lines below. What stands before the first mark is a part without head."""
    rows = spark.read.option("lineSep", "\n" + mark).text(path).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", "\r", "").alias("v"))
    rows = rows.select("file", F.when(F.startswith("v", F.lit(mark)), F.substring("v", len(mark) + 1, 2**31 - 1)).otherwise(F.col("v")).alias("v"))
    parts = F.split("v", "\n")
    return rows.select("file", parts[0].alias("head"), F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x != "").alias("body"))


def placed_lines(spark: SparkSession, path: str, joined: bool = False) -> DataFrame:
    """(file, split, at, line): `split` is the first byte of the input split that the line stands in, `at` ascends with the
    lines of a split. Files are cut by Spark's own splits, so a file of any size is read by many tasks. If `joined`, the files of a
    folder are one text, in the order of their names: `file` is the folder, `split` begins with the file's name."""
    name, start, place = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("at")
    of = [F.regexp_replace(name, "/[^/]*$", "").alias("file"), F.struct(F.regexp_extract(name, "[^/]*$", 0).alias("name"), start.alias("start")).alias("split")] if joined else [name.alias("file"), start.alias("split")]
    return spark.read.text(path).select(*of, place, F.regexp_replace("value", "\r$", "").alias("line"))


def carry_down(rows: DataFrame, few: int = 0, **heads: Column) -> DataFrame:
    """`rows` of placed_lines with, for each of `heads`, its last value that isn't null in this line or above it in the file.

    Each split gives its last values; a table of a row for each split of a file carries them to the splits below. If no file has more than `few`
    lines with any of heads, these are looked up for each line instead, so that lines aren't shuffled.
    """
    rows = rows.select("*", *[c.alias(f"_{n}") for n, c in heads.items()])
    if few:
        marks = kept(rows.where(" OR ".join(f"_{n} IS NOT NULL" for n in heads)).select("file", F.struct("split", "at", *[f"_{n}" for n in heads]).alias("mark")), "marks")
        most, n_files = marks.groupBy("file").count().agg(F.coalesce(F.max("count"), F.lit(0)), F.count("*")).first()
        if most <= few and most * n_files <= 500_000:
            above = marks.groupBy("file").agg(F.sort_array(F.collect_list("mark")).alias("_marks"))
            below = lambda n: F.filter("_marks", lambda m: (F.struct(m["split"], m["at"]) <= F.struct("split", "at")) & m[f"_{n}"].isNotNull())
            found = rows.join(F.broadcast(above), "file", "left")
            return found.select(*[c for c in rows.columns if c not in {f"_{n}" for n in heads}], *[F.try_element_at(below(n), F.lit(-1))[f"_{n}"].alias(n) for n in heads])
    upto = W.partitionBy("file", "split").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.groupBy("file", "split").agg(*[F.max_by(f"_{n}", F.when(F.col(f"_{n}").isNotNull(), F.col("at"))).alias(f"_{n}") for n in heads])
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    carry = ends.select("file", "split", *[F.last(f"_{n}", ignorenulls=True).over(earlier).alias(f"_above_{n}") for n in heads]).where(" OR ".join(f"_above_{n} IS NOT NULL" for n in heads))
    local = rows.select(*[c for c in rows.columns if c not in {f"_{n}" for n in heads}], *[F.last(f"_{n}", ignorenulls=True).over(upto).alias(f"_here_{n}") for n in heads])
    found = local.join(carry, ["file", "split"], "left")
    return found.select(*[c for c in local.columns if not c.startswith("_here_")], *[F.coalesce(f"_here_{n}", f"_above_{n}").alias(n) for n in heads])


def sections(spark: SparkSession, path: str, mark: str, joined: bool = False, few: int = 0) -> DataFrame:
    """(file, split, at, head, line): the lines below each line that begins with `mark`, with the rest of that line; null above the
    first. Empty lines are left out. No section is ever one row."""
    begins = F.startswith("line", F.lit(mark))
    rows = carry_down(placed_lines(spark, path, joined), few, head=F.when(begins, F.substring("line", len(mark) + 1, 2**31 - 1)))
    return rows.where(~begins & (F.col("line") != "")).select("file", "split", "at", "head", "line")


def cut_once(rows: DataFrame, line: Column, *kept: str) -> DataFrame:
    """The columns kept and `parts`, an array that is made once a row; a plain column would be made again in each filter on a
    piece of it."""
    return rows.select(*kept, F.explode(F.array(line)).alias("parts"))


def pieces(*kinds: str) -> list[Column]:
    return [F.get("parts", F.lit(i)).try_cast(kind) for i, kind in enumerate(kinds)]


def fields(line: Column, pattern: str, *kinds: str) -> list[Column]:
    """The groups of the pattern as columns of the kinds; null where the pattern doesn't match or a number doesn't fit."""
    return [F.when(line.rlike(pattern), F.regexp_extract(line, pattern, i + 1)).otherwise(F.lit(None)).try_cast(kind) for i, kind in enumerate(kinds)]


def split_tabs(line: Column, *kinds: str) -> list[Column]:
    parts = F.split(line, "\t")
    return [F.get(parts, F.lit(i)).try_cast(kind) for i, kind in enumerate(kinds)]


def sound(rows: DataFrame, *needed: str) -> DataFrame:
    return rows.where(" AND ".join(f"{c} IS NOT NULL" for c in needed))


def rejected(rows: DataFrame, *needed: str) -> DataFrame:
    """(file, line) of the rows that lack one of the needed columns."""
    return rows.where(" OR ".join(f"{c} IS NULL" for c in needed)).select("file", "line")


def numbered(rows: DataFrame) -> DataFrame:
    """gene_no in place of (split, at): the place within the file's contig, in the order of the file.

    Each split numbers its own rows; a row for each contig and split says how many stand in the splits above.
    """
    here = F.row_number().over(W.partitionBy("file", "split", "contig").orderBy("at"))
    above = F.sum("n").over(W.partitionBy("file", "contig").orderBy("split").rowsBetween(W.unboundedPreceding, -1))
    carry = rows.groupBy("file", "contig", "split").agg(F.count("*").alias("n")).select("file", "contig", "split", above.alias("_above")).where("_above IS NOT NULL")
    found = rows.withColumn("_here", here).join(carry, ["file", "contig", "split"], "left")
    return found.select(*[c for c in rows.columns if c not in ("split", "at")], (F.col("_here") + F.coalesce("_above", F.lit(0))).cast("int").alias("gene_no"))
