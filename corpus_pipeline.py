"""A corpus pipeline: quality, near duplicates, benchmark passages, source mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All but the last return the columns of documents.

An empty table passes through as an empty table. Nulls in any column are allowed: a document without text has no
quality and goes in the first stage; one without doc_id can't be a near duplicate or be found dirty, and stays. Rows
that repeat a doc_id stay together. Columns beyond those of documents are dropped at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import fresh, maybe_broadcast, table
from strandlake.llm.decontamination import decontaminate
from strandlake.llm.mixing import mix_sources
from strandlake.llm.ngram_join import near_duplicates
from strandlake.llm.quality import classify
from strandlake.llm.token_files import read_tokens, write_tokens

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs.select(*COLUMNS), labels).where("quality_keep").select(*COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id."""
    found = near_duplicates(docs)
    others = table(found.where("component_id <> doc_id").select("doc_id").distinct(), "pipeline-others")
    return docs.select(*COLUMNS).join(maybe_broadcast(others), "doc_id", "left_anti").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that overlap with no benchmark item."""
    return decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a row a copy. Documents without words have no copy."""
    mixed = mix_sources(docs.select(*COLUMNS)).where("taken > 0")
    copies = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return mixed.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the token files: doc_id, start, n_tokens, ids_crc32."""
    return read_tokens(spark, write_tokens(docs, fresh(spark, "pipeline-tokens")))


STAGES = [("quality", quality), ("near_duplicate", near_duplicate), ("benchmark", benchmark), ("mix", mix), ("tokens", tokens)]

#: SQL can't express the classifier and the tokenizer; all stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
