"""Queries over sequences and headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as X
from strandlake.functions import sequence as Q
from strandlake.operators import headers as N


def _calls(s, d):
    return X.genes(s, d).drop("seq")


def _headers(s, d):
    """Sequence headers as files have them, from the parts table."""
    return X.read(s, d, "part").selectExpr("concat('>gi|', p_partkey, '|', p_name, ' (', p_type, '); size: ', p_size, '.') AS header", "p_brand AS parent", "cast(p_partkey % 50 as int) AS ord", "concat('contig', p_partkey % 20) AS contig")


HEADERS = "heads AS (SELECT '>gi|' || p_partkey || '|' || p_name || ' (' || p_type || '); size: ' || p_size || '.' AS header, p_brand AS parent, CAST(p_partkey % 50 AS INTEGER) AS ord, 'contig' || (p_partkey % 20) AS contig FROM part)"


def _sites(s, d):
    sites = Q.start_codon_sites(F.col("seq"))
    return X.genes(s, d).select("contig", "ord", sites["n_sites"].alias("n_sites"), F.array_join(F.transform(sites["sites"], lambda i: i.cast("string")), ",").alias("sites"), sites["highlighted"].alias("highlighted"))


def _variants(s, d):
    rows = _headers(s, d)
    forms = Q.header_variants(F.col("header"), F.col("parent"), F.lit("gene"), F.col("ord"))
    return rows.select("header", *[c.alias(f"h_{name}") for name, c in forms.items()])


def _wanted(s, d):
    """Names, numbers and short pieces to look for in the headers, and some that none holds."""
    return X.read(s, d, "part").selectExpr("explode(array(p_name, concat('|', p_partkey, '|'), substring(p_type, 2, 3), concat(p_brand, '!'), '')) AS pattern")


QUERIES = {
    "header_variants": _variants,
    "cgp_header": lambda s, d: _calls(s, d).select("contig", "ord", Q.cgp_header(F.col("ord"), F.col("strand"), F.col("left_end"), F.col("right_end")).alias("header")),
    "parse_cgp_header": lambda s, d: QUERIES["cgp_header"](s, d).select("contig", *[c.alias(n) for n, c in Q.parse_cgp_header(F.col("header")).items()]),
    "sanitize_headers": lambda s, d: _headers(s, d).select("header", Q.sanitize_header(F.col("header")).alias("clean")),
    "clean_fasta": lambda s, d: X.read(s, d, "documents").select("doc_id", F.upper(Q.clean_sequence(F.regexp_replace("text", r"[^\x00-\x7F]", ""))).alias("seq")),
    "extract_genes": lambda s, d: Q.extract_genes(_calls(s, d), X.contigs(s, d)),
    "extract_genes_flank": lambda s, d: Q.extract_flanks(_calls(s, d), X.contigs(s, d), 30),
    "reverse_complement": lambda s, d: X.contigs(s, d).select("contig", Q.reverse_complement(F.col("seq")).alias("seq")),
    "translate_genes": lambda s, d: X.genes(s, d).select("contig", "ord", Q.translate_sequence(F.col("seq")).alias("protein")),
    "start_codon_class": lambda s, d: X.genes(s, d).groupBy(Q.start_codon_class(F.col("seq")).alias("class")).agg(F.count("*").alias("n_genes")),
    "start_codon_sites": _sites,
    "wrap_sequence": lambda s, d: Q.wrap_sequence(X.contigs(s, d), 60),
    "contig_lengths": lambda s, d: X.contigs(s, d).select("contig", F.length("seq").alias("length")),
    "find_by_header": lambda s, d: Q.find_by_header(_headers(s, d), "widget|ring"),
    "find_by_headers": lambda s, d: N.find_by_headers(_headers(s, d), _wanted(s, d)),
    "select_by_id": lambda s, d: Q.select_by_id(X.genes(s, d).select("contig", "ord", "strand"), X.contigs(s, d).where("length(seq) % 2 = 0"), "contig"),
    "renumber": lambda s, d: Q.renumber(_calls(s, d).select("contig", "ord", "left_end"), _calls(s, d).where("ord % 3 = 1").select("contig", "ord")),
}

_RC = f"reverse(translate({{}}, '{Q.IUPAC}', '{Q.COMPLEMENT}'))"
_CODONS = "MAP {" + ", ".join(f"'{a}{b}{c}': '{Q.TABLE_11[16 * i + 4 * j + k]}'" for i, a in enumerate("tcag") for j, b in enumerate("tcag") for k, c in enumerate("tcag")) + "}"
_C = "SELECT contig, ord, left_end, right_end, strand"
SQL = {
    "header_variants": X.sql(HEADERS, select="SELECT header, h AS h_full, split_part(h, ' ', 1) AS h_blast, split_part(h, ' ', 1) AS h_short, regexp_replace(replace(h, ' ', '_'), '[();:?.]', '', 'g') AS h_clean, left(h, 15) AS h_trunc, h || '_' || parent AS h_compound, 'gene-' || ord AS h_sequential FROM (SELECT *, ltrim(header, '>') AS h FROM heads)"),
    "cgp_header": X.sql(X.GENES, select="SELECT contig, ord, 'cds' || ord || '/' || strand || '/' || left_end || '/' || right_end || '/' AS header FROM genes"),
    "parse_cgp_header": X.sql(X.GENES, select="SELECT contig, 'cds' || ord AS cds, strand, CAST(left_end AS BIGINT) AS start, CAST(right_end AS BIGINT) AS \"end\" FROM genes"),
    "sanitize_headers": X.sql(HEADERS, select="SELECT header, regexp_replace(header, '[^>a-zA-Z0-9_]', '_', 'g') AS clean FROM heads"),
    "clean_fasta": r"SELECT doc_id, upper(regexp_replace(lower(regexp_replace(text, '[^\x00-\x7F]', '', 'g')), '[\s\x0B0-9*]', '', 'g')) AS seq FROM documents",
    "extract_genes": X.sql(X.GENES, select=f"{_C}, CASE WHEN strand = '-' THEN {_RC.format('seq')} ELSE seq END AS gene FROM genes"),
    "extract_genes_flank": X.sql(X.GENES, select=f"{_C}, CASE WHEN strand = '-' THEN {_RC.format('p')} ELSE p END AS stretch FROM (SELECT g.*, substr(c.seq, greatest(left_end - 30, 1)::BIGINT, (right_end + 30 - greatest(left_end - 30, 1) + 1)::BIGINT) AS p FROM genes g JOIN contigs c USING (contig))"),
    "reverse_complement": X.sql(X.CONTIGS, select=f"SELECT contig, {_RC.format('seq')} AS seq FROM contigs"),
    "translate_genes": X.sql(X.GENES, select=f"SELECT contig, ord, regexp_replace(array_to_string(list_transform(range(30), lambda i: ({_CODONS})[substr(seq, 3 * i + 1, 3)]), ''), '[*]$', '') AS protein FROM genes"),
    "start_codon_class": X.sql(X.GENES, select="SELECT CASE WHEN left(seq, 3) = 'atg' THEN 'common' WHEN left(seq, 3) IN ('gtg', 'ttg') THEN 'alternate' WHEN left(seq, 3) IN ('att', 'ctg') THEN 'rare' ELSE 'incorrect' END AS class, count(*) AS n_genes FROM genes GROUP BY 1"),
    "start_codon_sites": X.sql(X.GENES, select="SELECT contig, ord, CAST(len(s) AS INTEGER) AS n_sites, array_to_string(s, ',') AS sites, replace(seq, 'atg', 'ATG') AS highlighted FROM (SELECT *, list_filter(range(88), lambda i: substr(seq, i + 1, 3) = 'atg') AS s FROM genes)"),
    "wrap_sequence": X.sql(X.CONTIGS, select="SELECT contig, CAST(i AS INTEGER) AS line_no, substr(seq, i * 60 + 1, 60) AS line FROM (SELECT contig, seq, unnest(range(ceil(length(seq) / 60.0)::BIGINT)) AS i FROM contigs)"),
    "contig_lengths": X.sql(X.CONTIGS, select="SELECT contig, CAST(length(seq) AS INTEGER) AS length FROM contigs"),
    "find_by_header": X.sql(HEADERS, select="SELECT contig, arg_min(header, (ord, header)) AS header, min(ord) AS ord FROM heads WHERE regexp_matches(header, 'widget|ring') GROUP BY contig"),
    "find_by_headers": X.sql(HEADERS, "wanted AS (SELECT DISTINCT unnest([p_name, '|' || p_partkey || '|', substr(p_type, 2, 3), p_brand || '!']) AS pattern FROM part)",
                             select="SELECT pattern, contig, min(ord) AS ord, arg_min(header, (ord, header)) AS header FROM heads JOIN wanted ON contains(header, pattern) GROUP BY pattern, contig"),
    "select_by_id": X.sql(X.GENES, select="SELECT contig, ord, strand FROM genes WHERE contig IN (SELECT contig FROM contigs WHERE length(seq) % 2 = 0)"),
    "renumber": X.sql(X.GENES, select="SELECT contig, row_number() OVER (PARTITION BY contig ORDER BY ord) AS ord, left_end FROM genes WHERE ord % 3 <> 1"),
}
