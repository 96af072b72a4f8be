"""Sequence and header functions: string expressions only, no Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake.session import kept

# IUPAC letters and their complements; the codons of NCBI table 11 in the order t, c, a, g.
IUPAC, COMPLEMENT = "acgtrymkbdhvACGTRYMKBDHV", "tgcayrkmvhdbTGCAYRKMVHDB"
CODON_BASES = "tcag"
TABLE_11 = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
TRUNCATION = 15


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, COMPLEMENT))


def translate_sequence(seq: Column, table: str = TABLE_11) -> Column:
    """Frame 1, unknown codons X, one terminal stop dropped; an incomplete last codon is ignored."""
    digits = F.translate(F.lower(seq), CODON_BASES + "0123", "0123XXXX")
    codons = F.regexp_extract_all(digits, F.lit(r"[\s\S]{3}"), F.lit(0))
    amino = F.transform(codons, lambda c: F.when(c.rlike("^[0-3]{3}$"), F.substring(F.lit(table), F.conv(c, 4, 10).cast("int") + 1, F.lit(1))).otherwise("X"))
    return F.regexp_replace(F.array_join(amino, ""), r"\*$", "")


def clean_sequence(text: Column) -> Column:
    """Lower case without white space, digits and asterisks."""
    return F.regexp_replace(F.lower(text), r"[\s\d*]", "")


def short_header(header: Column) -> Column:
    return F.substring_index(header, " ", 1)


def header_variants(header: Column, parent: Column, mol_type: Column, ord_: Column) -> dict[str, Column]:
    """The forms of a FASTA header, without `>`."""
    full = F.regexp_replace(header, "^>+", "")
    return {
        "full": full, "blast": short_header(full), "short": short_header(full), "clean": F.regexp_replace(F.translate(full, " ", "_"), r"[();:?.]", ""),
        "trunc": F.substring(full, 1, TRUNCATION), "compound": F.concat_ws("_", full, parent), "sequential": F.concat_ws("-", mol_type, ord_.cast("string")),
    }


def cgp_header(ord_: Column, strand: Column, start: Column, end: Column) -> Column:
    return F.concat(F.lit("cds"), F.concat_ws("/", ord_.cast("string"), strand, start.cast("string"), end.cast("string")), F.lit("/"))


def parse_cgp_header(header: Column) -> dict[str, Column]:
    p = F.split(header, "/")
    return {"cds": F.get(p, F.lit(0)), "strand": F.get(p, F.lit(1)), "start": F.get(p, F.lit(2)).try_cast("long"), "end": F.get(p, F.lit(3)).try_cast("long")}


def sanitize_header(header: Column) -> Column:
    return F.regexp_replace(header, "[^>a-zA-Z0-9_]", "_")


def start_codon_class(seq: Column) -> Column:
    codon = F.lower(F.substring(seq, 1, 3))
    return F.when(codon == "", F.lit(None)).when(codon == "atg", "common").when(codon.isin("gtg", "ttg"), "alternate").when(codon.isin("att", "ctg"), "rare").otherwise("incorrect")


def start_codon_sites(seq: Column) -> dict[str, Column]:
    """How often `atg` occurs, where (from 0), and the sequence with it in capitals."""
    sites = F.filter(F.sequence(F.lit(1), F.greatest(F.length(seq) - 2, F.lit(1))), lambda i: F.substring(seq, i, F.lit(3)) == "atg")
    return {"n_sites": F.regexp_count(seq, F.lit("atg")), "sites": F.transform(sites, lambda i: i - 1), "highlighted": F.regexp_replace(seq, "atg", "ATG")}


def _stretches(calls: DataFrame, contigs: DataFrame, left: Column, right: Column, name: str, window: int) -> DataFrame:
    """calls with `name`, the contig's letters from left to right, both within the contig or cut at its end.

    Contigs (ASCII) are cut into windows that reach half a window into the next one, so that a call meets one window and
    not its whole contig; calls longer than that are put together from several windows.
    """
    more = window // 2
    starts = F.sequence(F.lit(0), F.greatest((F.length("seq") - 1) / window, F.lit(0)).cast("int"))
    data = F.col("seq").cast("binary")  # bytes are found by place, letters by walking from the start
    cut = contigs.where("seq <> ''").select("contig", F.posexplode(F.transform(starts, lambda i: F.substring(data, i * window + 1, F.lit(window + more)))).alias("_window", "_piece"))
    placed = calls.withColumn("_from", left).withColumn("_to", F.greatest(right, left - 1)).withColumn("_window", F.floor((F.col("_from") - 1) / window).cast("int"))
    inside = F.col("_to") - F.col("_window") * window <= window + more
    part = lambda a, b: F.substring(F.col("_piece"), a.cast("int"), (b - a + 1).cast("int")).cast("string")
    at = F.col("_from") - F.col("_window") * window
    short = placed.where(inside).join(cut, ["contig", "_window"]).withColumn(name, part(at, at + F.col("_to") - F.col("_from"))).drop("_piece", "_window", "_from", "_to")
    long = placed.where(~inside).withColumn("_id", F.monotonically_increasing_id()).withColumn("_window", F.explode(F.sequence("_window", F.floor((F.col("_to") - 1) / window).cast("int")))).join(cut, ["contig", "_window"])
    a, b = F.greatest(at, F.lit(1)), F.least(F.col("_to") - F.col("_window") * window, F.lit(window))
    pieces = long.groupBy("_id", *calls.columns).agg(F.array_sort(F.collect_list(F.struct("_window", part(a, b).alias("p")))).alias("ps"))
    return short.unionByName(pieces.withColumn(name, F.array_join(F.transform("ps", lambda x: x["p"]), "")).drop("_id", "ps"))


def _turned(found: DataFrame, name: str) -> DataFrame:
    return found.withColumn(name, F.when(F.col("strand") == "-", reverse_complement(F.col(name))).otherwise(F.col(name)))


def extract_genes(calls: DataFrame, contigs: DataFrame, window: int = 8_192) -> DataFrame:
    """calls (contig, strand, left_end, right_end, ...) with `gene`, the called stretch, reversed on `-`; start 0 is 1."""
    clamped = calls.withColumn("left_end", F.greatest(F.col("left_end"), F.lit(1)))
    return _turned(_stretches(clamped, contigs, F.col("left_end"), F.col("right_end"), "gene", window), "gene")


def extract_flanks(calls: DataFrame, contigs: DataFrame, flank: int, window: int = 8_192) -> DataFrame:
    """As extract_genes, widened by `flank` to both sides and clamped at the contig's start; a call without contig takes
    the first contig by name."""
    first = contigs.select(F.min("contig").alias("first_contig"))
    named = calls.join(F.broadcast(first)).withColumn("contig", F.coalesce("contig", "first_contig")).drop("first_contig")
    return _turned(_stretches(named, contigs, F.greatest(F.col("left_end") - flank, F.lit(1)), F.col("right_end") + flank, "stretch", window), "stretch")


def wrap_sequence(rows: DataFrame, width: int, key: str = "contig") -> DataFrame:
    """(key, line_no, line): the sequence in lines of `width`."""
    lines = F.when(F.length("seq") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.length("seq") - 1) / width).cast("int")), lambda i: F.substring("seq", i * width + 1, F.lit(width))))
    return rows.select(key, F.posexplode(lines).alias("line_no", "line"))


def find_by_header(rows: DataFrame, pattern: str) -> DataFrame:
    """The first row, by ord, of each contig whose header matches the pattern."""
    return rows.where(F.col("header").rlike(pattern)).groupBy("contig").agg(F.min_by("header", F.struct("ord", "header")).alias("header"), F.min("ord").alias("ord"))


#: Bits of one row of a bitmap table, and the most bits of a whole one, 32 MB.
BITMAP_BITS, MOST_BITS = 1 << 15, 1 << 28


def likely_wanted(rows: DataFrame, wanted: DataFrame, key: str, bits_an_id: int = 16) -> DataFrame:
    """The rows whose key may be wanted: all that are, and some that aren't. No row is shuffled.

    A Bloom filter of two bits for each of the ids `wanted`, a written table without repeats, is broadcast as a table of
    bitmaps: 16 bits an id, MOST_BITS at most, beyond which more rows pass that aren't wanted (1.4 % below it).
    """
    n_ids = wanted.count()
    n_bits = min(MOST_BITS, BITMAP_BITS << max(0, (n_ids * bits_an_id - 1) // BITMAP_BITS).bit_length())
    place = lambda seed: F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(n_bits))
    bits = wanted.select(F.explode(F.array(place(1), place(2))).alias("_bit"))
    maps = bits.groupBy(F.floor(F.col("_bit") / BITMAP_BITS).alias("_map")).agg(F.bitmap_construct_agg(F.col("_bit") % BITMAP_BITS).alias("_bits"))
    for seed in (1, 2):
        at = (F.col("_bit") % BITMAP_BITS).cast("int")
        byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit % 32768 as int) div 8 + 1, 1)")), 16, 10).cast("int")
        own = rows.where(F.col(key).isNotNull()).withColumn("_bit", place(seed)).withColumn("_map", F.floor(F.col("_bit") / BITMAP_BITS))
        rows = own.join(F.broadcast(maps), "_map").where(F.getbit(byte, at % 8) == 1).drop("_bit", "_bits", "_map")
    return rows


def select_by_id(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is one of `wanted`, repeated rows as often as they are there; null keys are in no result.

    Rows of unwanted ids are left out by a broadcast Bloom filter first, so that of their sequences hardly any is shuffled.
    """
    ids = kept(wanted.where(F.col(key).isNotNull()).select(key).distinct(), "wanted-ids")
    return likely_wanted(rows, ids, key).join(ids, key, "left_semi").select(*rows.columns)


def renumber(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    """Rows (contig, ord, ...) without the deleted (contig, ord); ord starts at 1 and has no gaps within a contig."""
    kept = rows.join(deleted.select("contig", "ord"), ["contig", "ord"], "left_anti")
    return kept.withColumn("ord", F.row_number().over(W.partitionBy("contig").orderBy("ord")))
