"""Readers of search results: BLAST tables and XML, HMMER tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import cut_once, lines, pieces, rejected, sound

BLAST = {"query": "string", "subject": "string", "identity": "double", "aln_len": "int", "mismatches": "int", "gap_opens": "int", "q_start": "long", "q_end": "long", "s_start": "long", "s_end": "long", "evalue": "double", "bitscore": "double"}
XML = ("`Iteration_query-def` string, Iteration_hits struct<Hit: array<struct<Hit_num: int, Hit_def: string, Hit_accession: string, Hit_len: int, "
       "Hit_hsps: struct<Hsp: array<struct<Hsp_num: int, `Hsp_bit-score`: double, Hsp_evalue: double, `Hsp_query-from`: long, `Hsp_query-to`: long, `Hsp_hit-from`: long, `Hsp_hit-to`: long, Hsp_identity: long, `Hsp_align-len`: long>>>>>>, _corrupt_record string")


def blast_tab(spark: SparkSession, path: str, identity: float = 0, rejects: bool = False) -> DataFrame:
    """Tabular hits whose identity, rounded down, is at least the cutoff."""
    rows = lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")
    rows = cut_once(rows, F.split("line", "\t"), "file", "line").select("file", "line", *[c.alias(n) for n, c in zip(BLAST, pieces(*BLAST.values()), strict=True)])
    return rejected(rows, *BLAST) if rejects else sound(rows, *BLAST).drop("file", "line").where(F.floor("identity") >= identity)


def blast_list(spark: SparkSession, path: str, query: str) -> DataFrame:
    """The hits of one query."""
    return blast_tab(spark, path).where(F.col("query") == query)


def blast_xml(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(query, hit_no, name, organism, accession, n_hsps, identity, hsps): hits with nested pairs; identity of the first.
    Rejects are the iterations that don't fit the schema."""
    read = spark.read.format("xml").option("rowTag", "Iteration").schema(XML).load(path)
    if rejects:
        return read.select(F.input_file_name().alias("file"), F.col("_corrupt_record").alias("line")).where("line IS NOT NULL")
    hits = read.where("_corrupt_record IS NULL").select(F.col("Iteration_query-def").alias("query"), F.explode("Iteration_hits.Hit").alias("h"))
    hsps = F.transform("h.Hit_hsps.Hsp", lambda x: F.struct(x["Hsp_num"].alias("number"), x["Hsp_bit-score"].alias("bitscore"), x["Hsp_evalue"].alias("evalue"), x["Hsp_query-from"].alias("q_start"), x["Hsp_query-to"].alias("q_end"),
                                                          x["Hsp_hit-from"].alias("s_start"), x["Hsp_hit-to"].alias("s_end"), x["Hsp_identity"].alias("identity"), x["Hsp_align-len"].alias("aln_len")))
    first = F.col("hsps")[0]
    return hits.withColumn("hsps", hsps).select("query", F.col("h.Hit_num").alias("hit_no"), F.col("h.Hit_def").alias("name"), F.regexp_extract("h.Hit_def", r"\[([^\]]*)\]", 1).alias("organism"), F.col("h.Hit_accession").alias("accession"),
                                                F.size("hsps").alias("n_hsps"), F.round(100 * first["identity"] / first["aln_len"], 4).alias("identity"), "hsps")


def _columns(spark: SparkSession, path: str, names: dict[str, str], rejects: bool) -> DataFrame:
    """White-space separated columns, the last one being the rest of the line."""
    n = len(names)
    rows = lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")
    rows = cut_once(rows, F.split(F.trim("line"), r"\s+", n), "file", "line").select("file", "line", *[c.alias(name) for name, c in zip(names, pieces(*names.values()), strict=True)])
    needed = list(names)[:-1]
    return rejected(rows, *needed) if rejects else sound(rows, *needed).drop("file", "line")


def hmm_tbl(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """HMMER --tblout: 18 columns and a description."""
    return _columns(spark, path, {
        "target": "string", "target_accession": "string", "query": "string", "query_accession": "string", "evalue": "double", "score": "double", "bias": "double", "best_evalue": "double", "best_score": "double", "best_bias": "double",
        "expected": "double", "regions": "int", "clusters": "int", "overlaps": "int", "envelopes": "int", "n_domains": "int", "reported": "int", "included": "int", "description": "string"}, rejects)


def hmm_domtbl(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """HMMER --domtblout: 22 columns and a description."""
    return _columns(spark, path, {
        "target": "string", "target_accession": "string", "target_len": "int", "query": "string", "query_accession": "string", "query_len": "int", "evalue": "double", "score": "double", "bias": "double", "number": "int", "of": "int",
        "c_evalue": "double", "i_evalue": "double", "domain_score": "double", "domain_bias": "double", "hmm_from": "int", "hmm_to": "int", "ali_from": "int", "ali_to": "int", "env_from": "int", "env_to": "int", "acc": "double", "description": "string"}, rejects)
