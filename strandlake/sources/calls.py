"""Readers of gene calls: (file, contig, strand, left_end, right_end, length, caller, gene_no)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import fields, lines, numbered, placed_lines, rejected, sections, sound, split_tabs

NEEDED = ("contig", "strand", "left_end", "right_end")


def _calls(rows: DataFrame, caller: str, rejects: bool = False) -> DataFrame:
    """Order the ends, check, number in the order of the file."""
    if rejects:
        return rejected(rows, *NEEDED)
    left, right = F.least("left_end", "right_end"), F.greatest("left_end", "right_end")
    ordered = sound(rows, *NEEDED).select("file", "split", "at", "contig", "strand", left.alias("left_end"), right.alias("right_end"), (right - left + 1).alias("length"), F.lit(caller).alias("caller"))
    return numbered(ordered)


def _data(spark: SparkSession, path: str) -> DataFrame:
    return placed_lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")


def _strand(c: Column) -> Column:
    return F.when(c.isin("+", "-"), c)


def gff3(spark: SparkSession, path: str, caller: str = "gff3", feature: str | None = "cds", contig_word: bool = False, rejects: bool = False) -> DataFrame:
    """GFF rows of the feature (all, if None); contig_word cuts the contig at its first space."""
    contig, kind, left, right, strand = (split_tabs(F.col("line"), *["string"] * 2, "string", "long", "long", "string", "string")[i] for i in (0, 2, 3, 4, 6))
    rows = _data(spark, path).select("file", "split", "at", "line", (F.substring_index(contig, " ", 1) if contig_word else contig).alias("contig"), kind.alias("kind"), left.alias("left_end"), right.alias("right_end"), _strand(strand).alias("strand"))
    if feature:
        rows = rows.where(F.col("kind").isNull() | (F.lower("kind") == feature))
    return _calls(rows, caller, rejects)


def rast(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    contig, left, right, strand = fields(F.col("line"), r"^([^\t]*)\t[^\t]*\tCDS\t(\d+)\t(\d+)\t\.\t([+-])\t\d\t", "string", "long", "long", "string")
    return _calls(_data(spark, path).select("file", "split", "at", "line", contig.alias("contig"), left.alias("left_end"), right.alias("right_end"), strand.alias("strand")), "rast", rejects)


def custom(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """A user's GFF of at least seven columns; lines that don't fit are rejects."""
    return gff3(spark, path, "custom", None, rejects=rejects)


def genemark_lst(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """GeneMark .lst: a definition line names the contig of the rows below; ends may carry < or >."""
    rows = sections(spark, path, "FASTA definition line: ").select("file", "split", "at", F.regexp_extract(F.coalesce("head", F.lit("")), r"^(.*?)\s+length=\d+", 1).alias("name"), "line")
    no, strand, left, right = fields(F.col("line"), r"^\s+(\d+)\s+([+-])\s+[<>]?(\d+)\s+[<>]?(\d+)\s+\d+\s+\d+", "int", "string", "long", "long")
    contig = F.when(F.col("name") == "", "unknown").otherwise(F.col("name"))
    return _calls(rows.select("file", "split", "at", "line", contig.alias("contig"), strand.alias("strand"), left.alias("left_end"), right.alias("right_end")), "genemark", rejects)


def glimmer(spark: SparkSession, path: str, version: int = 3, rejects: bool = False) -> DataFrame:
    """Glimmer: `>contig` lines; version 2 leaves the stop codon out of the ends."""
    rows = sections(spark, path, ">").select("file", "split", "at", F.col("head").alias("contig"), "line")
    pattern = r"^orf\d+\s+(\d+)\s+(\d+)\s+([+-])\d\s+[\d.]+" if version == 3 else r"^\s*\d+\s+(\d+)\s+(\d+)\s+\[([+-])\d\sL=\s*\d+\sr=.*\]"
    start, end, strand = fields(F.col("line"), pattern, "long", "long", "string")
    shift = F.when(strand == "+", 3).otherwise(-3) if version == 2 else F.lit(0)
    return _calls(rows.select("file", "split", "at", "line", "contig", strand.alias("strand"), start.alias("left_end"), (end + shift).alias("right_end")), "glimmer", rejects)


def prodigal(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """Prodigal .sco: the sequence data line names the contig."""
    rows = sections(spark, path, "# Sequence Data:").select("file", "split", "at", F.regexp_extract("head", 'seqhdr="([^"]*)"', 1).alias("contig"), "line")
    left, right, strand = fields(F.col("line"), r"^>\d+_(\d+)_(\d+)_([+-])", "long", "long", "string")
    return _calls(rows.select("file", "split", "at", "line", "contig", strand.alias("strand"), left.alias("left_end"), right.alias("right_end")), "prodigal", rejects)


def prodigal_gff(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    return gff3(spark, path, "prodigal", rejects=rejects)


def phanotate(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """left, right, strand, contig; ends may carry < or > and may be swapped."""
    a, b, strand, contig = split_tabs(F.col("line"), "string", "string", "string", "string")
    digits = lambda c: F.regexp_extract(c, r"(\d+)", 1).try_cast("long")
    rows = _data(spark, path).where(r"line RLIKE '^[0-9<>]'").select("file", "split", "at", "line", contig.alias("contig"), _strand(strand).alias("strand"), digits(a).alias("left_end"), digits(b).alias("right_end"))
    return _calls(rows, "phanotate", rejects)


def genemarks_gff(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    return gff3(spark, path, "genemarks", contig_word=True, rejects=rejects)


def genbank_headers(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """GenBank protein FASTA headers -> (contig, left_end, right_end, strand, locus_tag, protein); joins span their parts."""
    head = F.col("line")
    plus, minus = r"location=(\d+)\.\.(\d+)\]", r"location=complement\((\d+)\.\.(\d+)\)\]"
    join = r"join\((\d+)\.\.(?:\d+,\d+\.\.)*(\d+)\)"
    p, m, j = fields(head, plus, "long", "long"), fields(head, minus, "long", "long"), fields(head, join, "long", "long")
    word = lambda pattern: F.coalesce(F.nullif(F.regexp_extract(head, pattern, 1), F.lit("")), F.lit("unknown"))
    rows = lines(spark, path).where("startswith(line, '>')").select(
        "file", "line", word(r"\|(NC_\d{6}\.\d)_").alias("contig"), F.coalesce(j[0], m[0], p[0]).alias("left_end"), F.coalesce(j[1], m[1], p[1]).alias("right_end"),
        F.when(j[0].isNotNull(), "+").when(m[0].isNotNull(), "-").when(p[0].isNotNull(), "+").otherwise("?").alias("strand"),
        word(r"locus_tag=([\w-]+)\]").alias("locus_tag"), F.concat(word(r"protein=([^\]]+)\]"), F.when(j[0].isNotNull(), " JOINED").otherwise("")).alias("protein"))
    return rejected(rows, "left_end", "right_end") if rejects else sound(rows, "left_end", "right_end").drop("file", "line")


def ncbi_gene_headers(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """`>name # start # end # strand #…` -> (name, left_end, right_end, strand)."""
    part = F.split("line", r"\s*#\s*")
    strand = F.when(F.get(part, F.lit(3)) == "1", "+").when(F.get(part, F.lit(3)) == "-1", "-")
    rows = lines(spark, path).where("startswith(line, '>')").select("file", "line", F.regexp_replace(part[0], "^>", "").alias("name"), F.get(part, F.lit(1)).try_cast("long").alias("left_end"), F.get(part, F.lit(2)).try_cast("long").alias("right_end"), strand.alias("strand"))
    needed = ("left_end", "right_end", "strand")
    return rejected(rows, *needed) if rejects else sound(rows, *needed).drop("file", "line")


def cgc(spark: SparkSession, path: str, known: tuple[str, ...] = ("genemark", "glimmer", "phanotate", "prodigal", "rast", "custom", "gff3"), rejects: bool = False) -> DataFrame:
    """The normalized table; a line `# X gene calls` names the caller of the rows below, unknown callers are skipped."""
    rows = sections(spark, path, "# ").select("file", F.lower(F.regexp_extract("head", r"^(\S+) gene calls", 1)).alias("caller"), "line").where(F.col("caller").isin(*known))
    no, strand, left, right, length, contig = split_tabs(F.col("line"), "int", "string", "long", "long", "long", "string")
    parsed = rows.select("file", "line", "caller", no.alias("gene_no"), strand.alias("strand"), left.alias("left_end"), right.alias("right_end"), length.alias("length"), contig.alias("contig"))
    return rejected(parsed, *NEEDED, "gene_no") if rejects else sound(parsed, *NEEDED, "gene_no").drop("line")
