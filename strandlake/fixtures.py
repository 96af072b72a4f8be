"""Domain tables derived from the driver tables; each rule stands once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = ("acgt" * 7)[:26]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gene_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, strand, left_end, right_end, length, caller), distinct."""
    at = F.expr("l_partkey % 50 * 60")
    caller = F.element_at(F.array(*[F.lit(c) for c in ("glimmer", "phanotate", "prodigal", "genemark")]), F.expr("l_linenumber % 4 + 1"))
    calls = read(spark, sf_dir, "lineitem").select(
        F.expr("concat('contig_', l_partkey div 50)").alias("contig"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (at + 1).alias("left_end"), (at + (F.expr("cast(l_quantity as bigint) % 3") + 1) * 90).alias("right_end"), caller.alias("caller")).distinct()
    return calls.withColumn("length", F.col("right_end") - F.col("left_end") + 1)


GENE_CALLS = """gene_calls AS (SELECT *, right_end - left_end + 1 AS length FROM (SELECT DISTINCT
  'contig_' || (l_partkey // 50) AS contig, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  l_partkey % 50 * 60 + 1 AS left_end, l_partkey % 50 * 60 + (CAST(floor(l_quantity) AS BIGINT) % 3 + 1) * 90 AS right_end,
  CASE l_linenumber % 4 WHEN 0 THEN 'glimmer' WHEN 1 THEN 'phanotate' WHEN 2 THEN 'prodigal' ELSE 'genemark' END AS caller FROM lineitem))"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits between genes of lines of the same order; symmetric in identity and bit score."""
    return _hits(spark, sf_dir, "(a.g <> b.g OR a.gene <> b.gene)")


def _hits(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    return completed(_scored(spark, sf_dir, which))


def _scored(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Hits with the numbers of their genomes and no more than their scores. Pairs are dealt by the query's gene, as numbers, so that what groups or ranks them by query needn't shuffle them again."""
    one = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.expr("l_suppkey % 4").alias("g"), F.col("l_partkey").alias("gene"),
                                                 F.expr("cast(round(100 * l_discount) as bigint)").alias("d"), F.col("l_extendedprice").alias("p"))
    joined = one.alias("a").join(one.alias("b"), F.expr(f"a.o = b.o AND a.n <> b.n AND {which}"))
    pairs = joined.selectExpr("a.g AS q", "b.g AS s", "a.gene AS q_gene", "b.gene AS s_gene", "greatest(100 - 15 * abs(a.d - b.d), 0) AS identity", "cast(floor(a.p + b.p) as bigint) AS bitscore")
    found = pairs.repartition("q_gene").groupBy("q", "s", "q_gene", "s_gene").agg(F.max("identity").alias("identity"), F.max("bitscore").alias("bitscore"))
    return found.selectExpr("q AS q_genome", "s AS s_genome", "q_gene", "s_gene", "identity", "bitscore")


def both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hits() where nothing ranks or groups them: two lines are a pair once, so that half as many are dealt and grouped, and each is turned at the end."""
    line = "struct(l_suppkey % 4 AS g, l_partkey AS gene)"
    one = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), F.expr(line).alias("at"), F.expr("cast(round(100 * l_discount) as bigint)").alias("d"), F.col("l_extendedprice").alias("p"))
    joined = one.alias("a").join(one.alias("b"), F.expr("a.o = b.o AND a.n < b.n AND (a.at.g <> b.at.g OR a.at.gene <> b.at.gene)"))
    pairs = joined.selectExpr("least(a.at, b.at) AS x", "greatest(a.at, b.at) AS y", "greatest(100 - 15 * abs(a.d - b.d), 0) AS identity", "cast(floor(a.p + b.p) as bigint) AS bitscore")
    pairs = pairs.selectExpr("x.g AS q_genome", "y.g AS s_genome", "x.gene AS q_gene", "y.gene AS s_gene", "identity", "bitscore").repartition("q_gene")
    found = pairs.groupBy("q_genome", "s_genome", "q_gene", "s_gene").agg(F.max("identity").alias("identity"), F.max("bitscore").alias("bitscore"))
    turns = "inline(array(struct(q_genome, s_genome, q_gene, s_gene), struct(s_genome AS q_genome, q_genome AS s_genome, s_gene AS q_gene, q_gene AS s_gene)))"
    return completed(found.selectExpr(turns, "identity", "bitscore"))


def completed(scored: DataFrame) -> DataFrame:
    """Names of the genomes and the other columns of hits that have numbers and scores."""
    return with_alignment(named(scored))


def named(scored: DataFrame) -> DataFrame:
    """completed() without the columns of with_alignment."""
    return scored.selectExpr("concat('genome', q_genome) AS q_genome", "concat('genome', s_genome) AS s_genome", "q_gene", "s_gene", "identity", "bitscore")


def with_alignment(found: DataFrame) -> DataFrame:
    """The other columns of a hit, from its bit score: gene lengths are 90, one hit in seven is to the reverse strand."""
    return found.selectExpr(
        "*", "bitscore % 60 + 30 AS aln_len", "bitscore % 4 AS gap_opens", "bitscore % 20 + 1 AS q_start", "bitscore % 20 + bitscore % 60 + 30 AS q_end",
        "CASE WHEN bitscore % 7 = 0 THEN bitscore % 15 + bitscore % 60 + 30 ELSE bitscore % 15 + 1 END AS s_start",
        "CASE WHEN bitscore % 7 = 0 THEN bitscore % 15 + 1 ELSE bitscore % 15 + bitscore % 60 + 30 END AS s_end")


HITS = """line AS (SELECT l_orderkey o, l_linenumber n, l_suppkey % 4 AS g, l_partkey AS gene, CAST(round(100 * l_discount) AS BIGINT) AS d, l_extendedprice AS p FROM lineitem),
hits AS (SELECT *, bitscore % 60 + 30 AS aln_len, bitscore % 4 AS gap_opens, bitscore % 20 + 1 AS q_start, bitscore % 20 + bitscore % 60 + 30 AS q_end,
  CASE WHEN bitscore % 7 = 0 THEN bitscore % 15 + bitscore % 60 + 30 ELSE bitscore % 15 + 1 END AS s_start,
  CASE WHEN bitscore % 7 = 0 THEN bitscore % 15 + 1 ELSE bitscore % 15 + bitscore % 60 + 30 END AS s_end FROM (
  SELECT 'genome' || a.g AS q_genome, 'genome' || b.g AS s_genome, a.gene AS q_gene, b.gene AS s_gene, max(greatest(100 - 15 * abs(a.d - b.d), 0)) AS identity, max(CAST(floor(a.p + b.p) AS BIGINT)) AS bitscore
  FROM line a JOIN line b ON a.o = b.o AND a.n <> b.n AND (a.g <> b.g OR a.gene <> b.gene) GROUP BY ALL))"""

#: The hits that compete for best hit: those between genomes of enough identity.
CANDIDATES = "candidates AS (SELECT * FROM hits WHERE q_genome <> s_genome AND identity >= 60)"


def candidates(spark: SparkSession, sf_dir: str, genome: int | None = None) -> DataFrame:
    """With `genome` those to or from that one, for what asks for no other pairs."""
    return completed(scored_candidates(spark, sf_dir, genome))


def scored_candidates(spark: SparkSession, sf_dir: str, genome: int | None = None) -> DataFrame:
    """candidates() before names and alignments are made, to be ranked as narrow rows; see completed()."""
    return _scored(spark, sf_dir, "a.g <> b.g" + ("" if genome is None else f" AND (a.g = {genome} OR b.g = {genome})")).where("identity >= 60")


def own_hits(spark: SparkSession, sf_dir: str, genome: int | None = None) -> DataFrame:
    """The hits within genomes, or within one. Both names come of one number, else comparing them joins the lines by names."""
    found = _scored(spark, sf_dir, "a.g = b.g AND a.gene <> b.gene" + ("" if genome is None else f" AND a.g = {genome}"))
    return completed(found.withColumn("s_genome", F.col("q_genome")))


def genome_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(genome, gene, contig, start, end, strand): every gene that occurs; a contig has 500 places."""
    line = read(spark, sf_dir, "lineitem").selectExpr("l_suppkey % 4 AS g", "l_partkey AS gene").distinct()
    return line.selectExpr("concat('genome', g) AS genome", "gene", "concat('contig', gene div 500) AS contig", "gene * 90 + 1 AS start", "gene * 90 + 90 AS `end`", "CASE WHEN gene % 3 = 0 THEN '-' ELSE '+' END AS strand")


GENOME_GENES = """genome_genes AS (SELECT genome, gene, 'contig' || (gene // 500) AS contig, gene * 90 + 1 AS start, gene * 90 + 90 AS "end", CASE WHEN gene % 3 = 0 THEN '-' ELSE '+' END AS strand
  FROM (SELECT DISTINCT 'genome' || (l_suppkey % 4) AS genome, l_partkey AS gene FROM lineitem))"""


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, seq): documents as nucleotides."""
    docs = read(spark, sf_dir, "documents")
    return docs.select(F.concat(F.lit("doc_"), "doc_id").alias("contig"), F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), LETTERS, BASES).alias("seq"))


CONTIGS = f"contigs AS (SELECT 'doc_' || doc_id AS contig, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), '{LETTERS}', '{BASES}') AS seq FROM documents)"


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig, ord, left_end, right_end, strand, seq): each window of 90 nucleotides as a gene call with its sequence."""
    windows = contigs(spark, sf_dir).where(F.length("seq") >= 90).select("contig", "seq", F.explode(F.sequence(F.lit(0), F.expr("cast(floor(length(seq) / 90) - 1 as int)"))).alias("i"))
    return windows.selectExpr("contig", "i AS ord", "i * 90 + 1 AS left_end", "i * 90 + 90 AS right_end", "CASE WHEN i % 2 = 0 THEN '+' ELSE '-' END AS strand", "substring(seq, i * 90 + 1, 90) AS seq")


GENES = CONTIGS + """, genes AS (SELECT contig, i AS ord, i * 90 + 1 AS left_end, i * 90 + 90 AS right_end, CASE WHEN i % 2 = 0 THEN '+' ELSE '-' END AS strand, substr(seq, CAST(i * 90 + 1 AS BIGINT), 90) AS seq
  FROM (SELECT contig, seq, CAST(unnest(range(length(seq) // 90)) AS INTEGER) AS i FROM contigs))"""


def family_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(family_id, accession), distinct."""
    return read(spark, sf_dir, "part").selectExpr("concat('VOG', lpad(p_partkey div 3, 9, '0')) AS family_id", "concat('ACC', p_partkey div 2) AS accession").distinct()


def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(family_id, category, description), one row each."""
    rows = read(spark, sf_dir, "part").selectExpr(
        "concat('VOG', lpad(p_partkey div 3, 9, '0')) AS family_id", "element_at(array('Xr', 'Xs', 'Xh', 'Xp', 'Xu'), p_size % 5 + 1) AS category", "concat_ws(' ', p_type, p_brand) AS description")
    return rows.groupBy("family_id").agg(F.min("category").alias("category"), F.max("description").alias("description"))


FAMILIES = """family_members AS (SELECT DISTINCT 'VOG' || lpad(CAST(p_partkey // 3 AS VARCHAR), 9, '0') AS family_id, 'ACC' || (p_partkey // 2) AS accession FROM part),
families AS (SELECT 'VOG' || lpad(CAST(p_partkey // 3 AS VARCHAR), 9, '0') AS family_id, min(['Xr', 'Xs', 'Xh', 'Xp', 'Xu'][p_size % 5 + 1]) AS category, max(p_type || ' ' || p_brand) AS description FROM part GROUP BY 1)"""


def annotation_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(gene, accession, header, identity, aln_len, evalue, start, end): hits whose header begins with family ids."""
    line = read(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS gene", "l_partkey AS k", "100 - 5 * cast(round(100 * l_discount) as bigint) AS identity", "cast(l_quantity as bigint) AS aln_len").groupBy("gene", "k").agg(F.max("identity").alias("identity"), F.max("aln_len").alias("aln_len"))
    return line.selectExpr("gene", "concat('ACC', k div 2) AS accession",
                           "concat('VOG', lpad(k div 3, 9, '0'), '|VOG', lpad(k % 7, 9, '0'), '|VOG', lpad(k div 3, 9, '0'), '|ACC', k div 2, ' protein ', k) AS header",
                           "identity", "aln_len", "concat('1e-', aln_len) AS evalue", "k % 50 + 1 AS start", "k % 50 + aln_len AS `end`")


ANNOTATION_HITS = """annotation_hits AS (SELECT gene, 'ACC' || (k // 2) AS accession,
  'VOG' || lpad(CAST(k // 3 AS VARCHAR), 9, '0') || '|VOG' || lpad(CAST(k % 7 AS VARCHAR), 9, '0') || '|VOG' || lpad(CAST(k // 3 AS VARCHAR), 9, '0') || '|ACC' || (k // 2) || ' protein ' || k AS header,
  identity, aln_len, '1e-' || aln_len AS evalue, k % 50 + 1 AS start, k % 50 + aln_len AS "end" FROM (
  SELECT l_suppkey AS gene, l_partkey AS k, max(100 - 5 * CAST(round(100 * l_discount) AS BIGINT)) AS identity, max(CAST(floor(l_quantity) AS BIGINT)) AS aln_len FROM lineitem GROUP BY ALL))"""


def sql(*parts: str, select: str) -> str:
    """WITH the parts, then the select."""
    return "WITH " + ",\n".join(parts) + "\n" + select
