"""Preparation of reference data: tagging sequences with families, counts and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import kept, with_place


def accession_of(header: Column) -> Column:
    """The first word of a header without `>`."""
    return F.regexp_extract(header, r"^>*(\S+)", 1)


def tag_families(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """(header, seq) with all family ids of its accession before the header, each with a bar; unmapped ones are dropped."""
    tags = members.groupBy("accession").agg(F.array_join(F.sort_array(F.collect_set("family_id")), "|").alias("tag"))
    joined = sequences.withColumn("accession", accession_of(F.col("header"))).join(tags, "accession")
    return joined.select(F.concat(F.lit(">"), "tag", F.lit("|"), F.regexp_replace("header", "^>", "")).alias("header"), "seq")


def missing_accessions(members: DataFrame, sequences: DataFrame) -> DataFrame:
    """(accession): members without a sequence."""
    return members.select("accession").distinct().join(sequences.select(accession_of(F.col("header")).alias("accession")), "accession", "left_anti")


def tag_families_from_tables(sequences: DataFrame, members: DataFrame) -> DataFrame:
    """(kind, header, seq): the `tagged` sequences, and for each member without a sequence a `missing` row, whose header is
    the accession."""
    tagged = tag_families(sequences, members).select(F.lit("tagged").alias("kind"), "header", "seq")
    return tagged.unionByName(missing_accessions(members, sequences).select(F.lit("missing").alias("kind"), F.col("accession").alias("header"), F.lit(None).cast("string").alias("seq")))


def distinct_accessions(members: DataFrame) -> DataFrame:
    """(accession, first_family): each accession once."""
    return members.groupBy("accession").agg(F.min("family_id").alias("first_family"))


def accessions_in_order(members: DataFrame, order: str) -> DataFrame:
    """(accession, first_family, place): each accession of members (family_id, accession, order) once, with the family of its
    first row by `order`, then family; places follow the first rows."""
    first = members.where("accession IS NOT NULL").groupBy("accession").agg(F.min(F.struct(F.col(order).alias("at"), "family_id")).alias("first"))
    rows = kept(first.select("accession", F.col("first.family_id").alias("first_family"), F.col("first.at").alias("_at")), "accessions")
    return with_place(rows, [], ["_at", "accession"], "place").drop("_at")


def family_counts(members: DataFrame, reported: DataFrame) -> DataFrame:
    """(family_id, n_found, n_reported, mismatch); reported (family_id, n_reported)."""
    found = members.groupBy("family_id").agg(F.count("*").alias("n_found"))
    both = found.join(reported, "family_id", "full").fillna(0, ["n_found", "n_reported"])
    return both.withColumn("mismatch", F.col("n_found") != F.col("n_reported"))


def check_tagging(raw: DataFrame, tagged: DataFrame) -> DataFrame:
    """(check, n): unique and repeated headers before and after tagging, and how many raw headers are found again."""
    stripped = tagged.select(F.concat(F.lit(">"), F.regexp_replace("header", r"^>(VOG\d+\|)+", "")).alias("header"))

    def tally(rows: DataFrame, name: str) -> DataFrame:
        n = rows.groupBy("header").agg(F.count("*").alias("n"))
        return n.agg(F.count_if(F.col("n") == 1).alias("unique"), F.count_if(F.col("n") > 1).alias("repeated")).select(F.expr(f"stack(2, '{name} unique', unique, '{name} repeated', repeated) AS (check, n)"))

    matched = raw.select("header").distinct().join(stripped.distinct(), "header", "left_semi").agg(F.lit("matched").alias("check"), F.count("*").alias("n"))
    missing = raw.select("header").distinct().join(stripped.distinct(), "header", "left_anti").agg(F.lit("missing").alias("check"), F.count("*").alias("n"))
    return tally(raw, "raw").unionByName(tally(tagged, "tagged")).unionByName(matched).unionByName(missing)


def header_pattern_profile(headers: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(pattern, n, share): how many headers match each pattern, how many several, how many none."""
    flags = {name: F.col("header").rlike(p) for name, p in patterns.items()}
    hits = sum((f.cast("int") for f in flags.values()), F.lit(0))
    counts = headers.agg(F.count("*").alias("total"), *[F.count_if(f).alias(f"n_{i}") for i, f in enumerate(flags.values())], F.count_if(hits > 1).alias("several"), F.count_if(hits == 0).alias("none"))
    names = [*[(n, f"n_{i}") for i, n in enumerate(flags)], ("several", "several"), ("none", "none")]
    rows = counts.select("total", F.expr(f"stack({len(names)}, " + ", ".join(f"'{n}', {c}" for n, c in names) + ") AS (pattern, n)"))
    return rows.select("pattern", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def headers_only(lines: DataFrame) -> DataFrame:
    """The FASTA header lines of a table of lines (value)."""
    return lines.where(F.col("value").startswith(">"))
