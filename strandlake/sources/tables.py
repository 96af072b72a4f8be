"""Readers of sequences, tRNA tables, families, lookups and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.sequence import clean_sequence

from .text import blocks, carry_down, lines, placed_lines, rejected, sections, sound, split_tabs


def fasta(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(file, header, seq): a row a record; lower case, without white space, digits and asterisks. Rejects are headers
    without a sequence."""
    rows = blocks(spark, path, ">")
    if rejects:
        return rows.where("size(body) = 0 AND head <> ''").select("file", F.concat(F.lit(">"), "head").alias("line"))
    return rows.where("size(body) > 0").select("file", "head", F.array_join("body", "").alias("text")).select("file", F.col("head").alias("header"), clean_sequence(F.col("text")).alias("seq"))


def fasta_texts(rows: DataFrame) -> DataFrame:
    """rows (..., text) whose texts are FASTA: the other columns with header and seq, a row a record, as fasta() has them."""
    others = [c for c in rows.columns if c != "text"]
    cut = rows.select(*others, F.explode(F.split("text", "\n>")).alias("v")).withColumn("v", F.regexp_replace("v", "^>", ""))
    body = F.filter(F.slice(F.split("v", "\n"), 2, F.size(F.split("v", "\n"))), lambda x: x != "")
    return cut.where(F.size(body) > 0).select(*others, F.split("v", "\n")[0].alias("header"), clean_sequence(F.array_join(body, "")).alias("seq"))


def trna(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(contig, trna_no, start, end, strand, label, score): begin after end is `-` and swapped, equal ends are `x`."""
    contig, no, begin, end, kind, codon, _, _, score, note = split_tabs(F.col("line"), "string", "int", "long", "long", "string", "string", "long", "long", "double", "string")
    rows = lines(spark, path).where(r"line <> '' AND NOT line RLIKE '^(Sequence|Name|-+)\\s'").select("file", "line", F.rtrim(contig).alias("contig"), no.alias("trna_no"), begin.alias("b"), end.alias("e"), kind.alias("kind"), codon.alias("codon"), score.alias("score"), note.alias("note"))
    if rejects:
        return rejected(rows, "trna_no", "b", "e")
    rows = sound(rows, "trna_no", "b", "e")
    label = F.concat(F.lit("tRNA-"), "kind", F.lit("("), "codon", F.lit(")"), F.when(F.col("note").rlike(r"\w"), F.concat(F.lit("-"), "note")).otherwise(""))
    strand = F.when(F.col("b") < F.col("e"), "+").when(F.col("b") > F.col("e"), "-").otherwise("x")
    return rows.select("contig", "trna_no", F.least("b", "e").alias("start"), F.greatest("b", "e").alias("end"), strand.alias("strand"), label.alias("label"), "score")


def family_members(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(family_id, accession): the fifth column holds the accessions, joined by commas."""
    rows = lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")
    family, *_, members = split_tabs(F.col("line"), *["string"] * 5)
    rows = rows.select("file", "line", family.alias("family_id"), members.alias("members"))
    return rejected(rows, "members") if rejects else sound(rows, "members").select("family_id", F.explode(F.split("members", ",")).alias("accession"))


def family_annotations(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(family_id, n_proteins, n_species, category, description)."""
    rows = lines(spark, path).where("line <> '' AND NOT startswith(line, '#')")
    names = ("family_id", "n_proteins", "n_species", "category", "description")
    rows = rows.select("file", "line", *[c.alias(n) for n, c in zip(names, split_tabs(F.col("line"), "string", "int", "int", "string", "string"), strict=True)])
    return rejected(rows, *names) if rejects else sound(rows, *names).drop("file", "line")


def family_tables(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(family_id, n_reported, n_found, mismatch, accessions): tables that begin with `#family: has n proteins …`. Rejects
    are rows of fewer than four columns."""
    begins = F.startswith("line", F.lit("#"))
    rows = carry_down(placed_lines(spark, path), head=F.when(begins, F.struct("split", "at", F.substring("line", 2, 2**31 - 1).alias("text"))))
    if rejects:
        return rows.where(~begins & (F.col("line") != "")).select("file", "line").where(F.size(F.split("line", "\t")) < 4)
    named = rows.where("head IS NOT NULL").groupBy("file", "head").agg(F.array_sort(F.collect_list(F.when(~begins, F.get(F.split("line", "\t"), F.lit(3))))).alias("a"))
    found = named.select(F.regexp_extract("head.text", r"^(\w+):", 1).alias("family_id"), F.regexp_extract("head.text", r"has (\d+)", 1).try_cast("long").alias("n_reported"), "a").where("family_id <> ''")
    return found.select("family_id", "n_reported", F.size("a").cast("long").alias("n_found"), (F.size("a") != F.col("n_reported")).alias("mismatch"), F.array_join("a", ",").alias("accessions"))


def accession_taxa(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(accession, version, taxid, gi): the four columns of an accession2taxid table, whose first line names them."""
    accession, version, taxid, gi = split_tabs(F.col("line"), "string", "string", "long", "string")
    rows = lines(spark, path).where("line <> '' AND NOT startswith(line, 'accession\t')").select("file", "line", accession.alias("accession"), version.alias("version"), taxid.alias("taxid"), gi.alias("gi"))
    return rejected(rows, "taxid", "gi") if rejects else sound(rows, "taxid", "gi").drop("file", "line")


def lookup(spark: SparkSession, path: str, kind: str, sep: str = "\t", rejects: bool = False) -> DataFrame:
    """(kind, key, value): the key up to the first separator, the value behind it."""
    part = F.split("line", sep, 2)
    if rejects:
        return lines(spark, path).where((F.size(part) < 2) & (F.col("line") != ""))
    return lines(spark, path).where(F.size(part) == 2).select(F.lit(kind).alias("kind"), part[0].alias("key"), F.trim(part[1]).alias("value"))


PROFILE = {"sort_pos": "long", "row_type": "string", "q_start": "long", "q_end": "long", "s_start": "long", "s_end": "long", "identity": "double", "evalue": "double", "role1": "string", "g1_header": "string", "g1_contig": "string", "g1_annotation": "string",
           "g1_start": "long", "g1_end": "long", "g1_strand": "string", "role2": "string", "g2_header": "string", "g2_contig": "string", "g2_annotation": "string", "g2_start": "long", "g2_end": "long", "g2_strand": "string", "g1_coverage": "long",
           "g2_coverage": "long", "aln_len": "long", "gap_opens": "long", "g1_span": "long", "g1_length": "long", "g2_span": "long", "g2_length": "long"}


def profile_report(spark: SparkSession, path: str, rejects: bool = False, joined: bool = False) -> DataFrame:
    """The 30 columns of pair reports with the molecule type, which a line `#GENE HITS` or `#PROTEIN HITS` sets. If `joined`, the
    files of a folder are one report, in the order of their names."""
    rows = sections(spark, path, "#", joined, few=16).select("file", F.when(F.startswith("head", F.lit("PROTEIN HITS")), "protein").when(F.startswith("head", F.lit("GENE HITS")), "gene").alias("mol_type"), "line").where(r"mol_type IS NOT NULL AND line RLIKE '^[0-9]'")
    if rejects:
        return rows.where(F.size(F.split("line", "\t")) < len(PROFILE)).select("file", "line")
    return rows.where(F.size(F.split("line", "\t")) >= len(PROFILE)).select("mol_type", *[F.nullif(c, F.lit("")).alias(n) if kind == "string" else c.alias(n) for (n, kind), c in zip(PROFILE.items(), split_tabs(F.col("line"), *PROFILE.values()), strict=True)])


def paralog_report(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(genome, mol_type, gene, paralog, identity, coverage): stanzas `query:…` and `coverage:…` below section lines. Rejects
    are the query lines of stanzas without identity or coverage."""
    listing = F.when(F.startswith("line", F.lit("PARALOGS for genome ")), F.struct("split", "at", F.regexp_extract("line", r"([^/]+?)(?:\.\w+)?$", 1).alias("genome")))
    kind = F.regexp_extract("line", r"^(Gene|Protein) Paralogs", 1)
    section = F.when(kind != "", F.struct("split", "at", F.lower(kind).alias("mol_type")))
    query = F.when(F.startswith("line", F.lit("query:")), F.struct("split", "at", "line"))
    rows = carry_down(placed_lines(spark, path), listing=listing, section=section, query=query)
    below = lambda a, b: F.struct(f"{a}.split", f"{a}.at") > F.struct(f"{b}.split", f"{b}.at")
    rows = rows.where("query IS NOT NULL AND listing.genome <> ''").where(below("query", "listing"))
    mol_type = F.when(F.col("section").isNotNull() & below("section", "listing"), F.col("section.mol_type")).otherwise("")
    line, first = F.col("query.line"), lambda c: F.min_by(c, F.when(c.isNotNull(), F.struct("split", "at")))
    cover = F.regexp_extract("line", r"^coverage:(-?[\d.]+)", 1)
    stanzas = rows.groupBy("file", "query", F.col("listing.genome").alias("genome")).agg(F.min_by(mol_type, F.struct("split", "at")).alias("mol_type"), first(F.when(cover != "", cover)).try_cast("double").alias("coverage"))
    pick = lambda p: F.regexp_extract(line, p, 1)
    found = stanzas.select("file", line.alias("line"), "genome", "mol_type", pick(r"^query:([^\t]*)").alias("gene"), pick(r"\tsubject:([^\t\n]*)").alias("paralog"), pick(r"^[^\t]*\t[^\t]*\t[^\t]*\t([\d.]+)").try_cast("double").alias("identity"), "coverage")
    return rejected(found, "identity", "coverage") if rejects else sound(found, "identity", "coverage").drop("file", "line")


def pair_log(spark: SparkSession, path: str, rejects: bool = False) -> DataFrame:
    """(file, genome1, genome2): the genome files that a pair's log names, without folder and ending. Rejects are the lines
    that name a genome file of no known form."""
    if rejects:
        return lines(spark, path).where(r"line RLIKE 'genome file #[12]' AND NOT line RLIKE 'genome file #[12]: .*[^/]+\\.\\w+$'")
    name = lambda i: F.max(F.nullif(F.regexp_extract("line", rf"genome file #{i}: .*?([^/]+?)\.\w+$", 1), F.lit(""))).alias(f"genome{i}")
    return lines(spark, path).groupBy("file").agg(name(1), name(2))
