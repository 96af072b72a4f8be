"""Queries over search hits and pair profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as X
from strandlake.operators import chains as K
from strandlake.operators import hits as H
from strandlake.operators import profile as P
from strandlake.session import kept


def _best(s, d, genome=None):
    """Ranked as narrow rows of numbers; names and alignments are made for the best alone."""
    return X.completed(H.best_hits(X.scored_candidates(s, d, genome)))


def _kept_genes(s, d):
    """For use in several places of a plan, each of which would read and group the lines again."""
    return kept(X.genome_genes(s, d), "genes")


def _annotations(s, d, genes=None):
    return (X.genome_genes(s, d) if genes is None else genes).where("gene % 4 = 0").selectExpr("genome", "gene", "concat('protein ', gene) AS annotation")


def _profile(s, d):
    genes = _kept_genes(s, d)
    return H.merge_profile(_best(s, d), genes, _annotations(s, d, genes))


def _seq(gene: str) -> str:
    """Sequences of genes, by number: their start codon is all that matters here."""
    return f"concat(element_at(array('atg', 'gtg', 'att', 'ccc'), {gene} % 4 + 1), 'acgtac')"


def _alerted(s, d, genome=None, annotated=False, codes=()):
    """Of the profiles of all pairs, or of those of one genome, given by number; alerts don't ask for annotations. Alignments and
    sequences are made of a row's other columns where they are used."""
    genes = _kept_genes(s, d)
    best = X.named(H.best_hits(X.scored_candidates(s, d, genome)))
    return P.merged_alerts(best, genes, _annotations(s, d, genes) if annotated else None, _completed, of=None if genome is None else f"genome{genome}", codes=codes)


def _completed(rows):
    return X.with_alignment(rows).withColumn("g1_seq", F.expr(_seq("cast(gene1 as int)"))).withColumn("g2_seq", F.expr(_seq("cast(gene2 as int)")))


def _sequence_best_hits(s, d):
    """From sequences to best hits: matched bases stand for the bit score."""
    genome = "concat('genome', cast(substring({}, 5) as bigint) % 4)"
    found = H.kmer_hits(X.contigs(s, d)).selectExpr(f"{genome.format('q')} AS q_genome", f"{genome.format('s')} AS s_genome", "q AS q_gene", "s AS s_gene", "identity", "matched AS bitscore", "q_start", "q_end", "s_start", "s_end", "aln_len")
    return H.hit_coverage(H.best_hits(H.filter_hits(found).where("q_genome <> s_genome")), "aln_len")


COLUMNS = ["genome1", "genome2", "ord", "row_type", "gene1", "gene2"]

QUERIES = {
    "genome_pairs": lambda s, d: H.genome_pairs(X.genome_genes(s, d).groupBy("genome").agg(F.min("gene").alias("g")).select("genome", F.expr("cast(substring(genome, 7) as int)").alias("ord"))),
    "kmer_hits": lambda s, d: H.kmer_hits(X.contigs(s, d)),
    "sequence_classes": lambda s, d: K.sequence_classes(X.contigs(s, d)),
    "chained_hits": lambda s, d: K.chained_hits(X.contigs(s, d)),
    "sequence_best_hits": _sequence_best_hits,
    "filter_hits": lambda s, d: H.filter_hits(X.hits(s, d), 80),
    "top_hits": lambda s, d: H.top_hits(X.candidates(s, d)).select("q_genome", "q_gene", "s_genome", "s_gene", "rank", "bitscore"),
    "best_hits": _best,
    "hit_coverage": lambda s, d: H.hit_coverage(X.hits(s, d)).select("q_genome", "q_gene", "s_genome", "s_gene", "q_coverage", "s_coverage"),
    "mutual_best_hits": lambda s, d: H.mutual_best_hits(_best(s, d)).select("q_genome", "q_gene", "s_genome", "s_gene", "bitscore"),
    "singular_best_hits": lambda s, d: H.singular_best_hits(_best(s, d)).select("q_genome", "q_gene", "s_genome", "s_gene", "bitscore"),
    "loners": lambda s, d: H.loners(X.genome_genes(s, d), _best(s, d)),
    "paralogs": lambda s, d: H.paralogs(X.own_hits(s, d), X.genome_genes(s, d)),
    "homology_stats": lambda s, d: H.homology_stats(X.genome_genes(s, d), _best(s, d)),
    "set_stats": lambda s, d: H.set_stats(X.genome_genes(s, d), _annotations(s, d), H.paralogs(X.own_hits(s, d), X.genome_genes(s, d))),
    "merge_profile": _profile,
    "profile_alerts": lambda s, d: _alerted(s, d).select(*COLUMNS, "alerts"),
    "query_profiles": lambda s, d: P.query_profiles(_alerted(s, d, codes=("a", "b", "i")), "1", ("mutual", "singular"), ("a", "b", "i")).select(*COLUMNS, "alerts"),
    "count_differences": lambda s, d: P.count_differences(P.query_profiles(_alerted(s, d, codes=("c", "d", "i", "j")), codes=("c", "d", "i", "j"))),
    "homolog_table": lambda s, d: P.homolog_table(_alerted(s, d, 0, True), "genome0"),
    "loner_matrix": lambda s, d: P.loner_matrix(_profile(s, d), "genome0", ["genome1", "genome2", "genome3"]),
}

BEST = """best AS (SELECT * FROM candidates QUALIFY row_number() OVER (PARTITION BY q_genome, q_gene, s_genome ORDER BY bitscore DESC, s_gene) = 1),
paired AS (SELECT a.*, b.s_gene AS back_gene FROM best a LEFT JOIN best b ON a.q_genome = b.s_genome AND a.s_genome = b.q_genome AND a.s_gene = b.q_gene),
mutual AS (SELECT * EXCLUDE back_gene FROM paired WHERE back_gene = q_gene), singular AS (SELECT * EXCLUDE back_gene FROM paired WHERE back_gene <> q_gene),
lone AS (SELECT g.genome, g.gene, o.genome AS other FROM genome_genes g, (SELECT DISTINCT genome FROM genome_genes) o WHERE g.genome <> o.genome
  AND NOT EXISTS (SELECT 1 FROM (FROM mutual UNION ALL FROM singular) u WHERE u.q_genome = g.genome AND u.q_gene = g.gene AND u.s_genome = o.genome))"""
ALL = (X.HITS, X.CANDIDATES, X.GENOME_GENES, BEST)
PARALOGS = """top5 AS (SELECT * FROM hits WHERE q_genome = s_genome AND q_gene <> s_gene AND identity >= 60 QUALIFY row_number() OVER (PARTITION BY q_genome, q_gene ORDER BY bitscore DESC, s_gene) <= 5),
paralog AS (SELECT genome, gene, s_gene AS paralog, identity, bitscore, CAST(round_even(100.0 * abs(q_end - q_start) / abs("end" - start), 0) AS BIGINT) AS coverage
  FROM top5 JOIN genome_genes ON q_genome = genome AND q_gene = gene WHERE round_even(100.0 * abs(q_end - q_start) / abs("end" - start), 0) >= 60)"""
_COVER = "CAST(round_even(100.0 * (CASE WHEN {1} >= {0} THEN {1} - {0} + 1 ELSE {1} - {0} - 1 END) / 90, 0) AS BIGINT)"
_QC, _SC = _COVER.format("q_start", "q_end"), _COVER.format("s_start", "s_end")
PROFILE = f"""note AS (SELECT genome, gene, contig, start, "end", strand, 'cds' || gene || '/' || strand || '/' || start || '/' || "end" || '/' AS header, CASE WHEN gene % 4 = 0 THEN 'protein ' || gene END AS annotation FROM genome_genes),
u AS (
  SELECT q_genome AS genome1, s_genome AS genome2, 'genome1_mutual' AS row_type, q_gene AS gene1, s_gene AS gene2, identity, bitscore, aln_len, gap_opens, q_start, q_end, s_start, s_end, {_QC} AS g1_coverage, {_SC} AS g2_coverage, abs(q_end - q_start) + 1 AS g1_span, abs(s_end - s_start) + 1 AS g2_span FROM mutual WHERE q_genome < s_genome
  UNION ALL SELECT q_genome, s_genome, 'genome1_singular', q_gene, s_gene, identity, bitscore, aln_len, gap_opens, q_start, q_end, s_start, s_end, {_QC}, {_SC}, abs(q_end - q_start) + 1, abs(s_end - s_start) + 1 FROM singular WHERE q_genome < s_genome
  UNION ALL SELECT s_genome, q_genome, 'genome2_singular', s_gene, q_gene, identity, bitscore, aln_len, gap_opens, q_start, q_end, s_start, s_end, {_SC}, {_QC}, abs(s_end - s_start) + 1, abs(q_end - q_start) + 1 FROM singular WHERE q_genome > s_genome
  UNION ALL SELECT genome, other, 'genome1_loner', gene, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lone WHERE genome < other
  UNION ALL SELECT other, genome, 'genome2_loner', NULL, gene, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM lone WHERE genome > other),
profile AS (SELECT u.*, {', '.join(f'n{i}.contig AS g{i}_contig, n{i}.start AS g{i}_start, n{i}."end" AS g{i}_end, n{i}.strand AS g{i}_strand, n{i}.header AS g{i}_header, n{i}.annotation AS g{i}_annotation, n{i}."end" - n{i}.start + 1 AS g{i}_length' for i in (1, 2))},
  row_number() OVER (PARTITION BY genome1, genome2 ORDER BY CASE WHEN row_type = 'genome2_loner' THEN 1 ELSE 0 END, coalesce(n1.contig, n2.contig), coalesce(n1.start, n2.start), row_type, gene2 NULLS FIRST) AS ord
  FROM u LEFT JOIN note n1 ON n1.genome = genome1 AND n1.gene = gene1 LEFT JOIN note n2 ON n2.genome = genome2 AND n2.gene = gene2)"""
_KIND = "CASE gene{0} % 4 WHEN 0 THEN 'common' WHEN 1 THEN 'alternate' WHEN 2 THEN 'rare' WHEN 3 THEN 'incorrect' ELSE 'unknown' END"
_P = "OVER (PARTITION BY genome1, genome2 ORDER BY ord)"
_B = "OVER (PARTITION BY genome1, genome2 ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
ALERTED = f"""seen AS (SELECT *, row_type NOT LIKE '%loner' AS hit, coalesce(g1_coverage, 0) AS c1, coalesce(g2_coverage, 0) AS c2, coalesce(g1_start, 0) - coalesce(lag(g1_end) {_P}, 0) AS d1, coalesce(g2_start, 0) - coalesce(lag(g2_end) {_P}, 0) AS d2,
  coalesce(gene1 = lag(gene1) {_P}, FALSE) AS same1, coalesce(gene2 = lag(gene2) {_P}, FALSE) AS same2, coalesce(last_value(q_end IGNORE NULLS) {_B}, 0) AS pq, coalesce(last_value(s_end IGNORE NULLS) {_B}, 0) AS ps,
  coalesce(lag(coalesce(g1_coverage, 0) < 0 OR coalesce(g2_coverage, 0) < 0) {_P}, FALSE) AS was_flipped, row_type LIKE 'genome1%' AS one FROM profile),
alerted AS (SELECT *, concat_ws('; ',
  CASE WHEN hit AND (c1 < 0 OR c2 < 0) THEN 'a){P.FLIP}' END, CASE WHEN hit AND gap_opens IN (0, 1) AND abs(c1 - c2) > 20 THEN 'b){P.MISSING}' END,
  CASE WHEN hit AND same1 THEN 'c){P.PARALOG} on genome 2' END, CASE WHEN hit AND same2 THEN 'd){P.PARALOG} on genome 1' END,
  CASE WHEN hit AND NOT was_flipped AND c1 >= 98 AND 100 - c2 >= 20 AND one AND abs(s_start - ps) <= 20 THEN 'e){P.ALTERNATE} on genome 2' END,
  CASE WHEN hit AND NOT was_flipped AND c1 >= 98 AND 100 - c2 >= 20 AND NOT one AND abs(q_start - pq) <= 20 THEN 'f){P.ALTERNATE} on genome 2' END,
  CASE WHEN hit AND NOT was_flipped AND c2 >= 98 AND 100 - c1 >= 20 AND NOT one AND abs(s_start - ps) <= 20 THEN 'g){P.ALTERNATE} on genome 1' END,
  CASE WHEN hit AND NOT was_flipped AND c2 >= 98 AND 100 - c1 >= 20 AND one AND abs(q_start - pq) <= 20 THEN 'h){P.ALTERNATE} on genome 1' END,
  CASE WHEN hit AND d1 IN (0, 3) THEN 'i){P.SPLIT}1' END, CASE WHEN hit AND d1 IN (0, 3) AND gene1 % 4 <> 0 THEN 'k){P.NOT_ATG}1' END, CASE WHEN hit AND d1 IN (0, 3) THEN 'm){P.START_CODON}1, type is: ' || {_KIND.format(1)} END,
  CASE WHEN hit AND d2 IN (0, 3) THEN 'j){P.SPLIT}2' END, CASE WHEN hit AND d2 IN (0, 3) AND gene2 % 4 <> 0 THEN 'l){P.NOT_ATG}2' END, CASE WHEN hit AND d2 IN (0, 3) THEN 'n){P.START_CODON}2, type is: ' || {_KIND.format(2)} END,
  CASE WHEN NOT hit AND same1 THEN 'o){P.SPLIT} on genome 1; q){P.START_CODON}1, type is: ' || {_KIND.format(1)} END,
  CASE WHEN NOT hit AND same2 THEN 'p){P.SPLIT} on genome 2; r){P.START_CODON}2, type is: ' || {_KIND.format(2)} END) AS alerts FROM seen)"""
_WITH_ALERTS = (*ALL, PROFILE, ALERTED)
_C = ", ".join(COLUMNS)
_HIT = "q_genome, q_gene, s_genome, s_gene"

SQL = {
    "genome_pairs": X.sql(X.GENOME_GENES, select="SELECT a.genome AS genome1, b.genome AS genome2 FROM (SELECT DISTINCT genome FROM genome_genes) a JOIN (SELECT DISTINCT genome FROM genome_genes) b ON a.genome < b.genome"),
    "kmer_hits": X.sql(X.CONTIGS, """k AS (SELECT contig, i AS at, substr(seq, i + 1, 16) AS kmer FROM (SELECT contig, seq, unnest(range(length(seq) - 15)) AS i FROM contigs WHERE length(seq) >= 16))""",
        "often AS (SELECT kmer FROM k GROUP BY kmer HAVING count(DISTINCT contig) > 1)", "kept AS (SELECT k.* FROM k SEMI JOIN often USING (kmer))",
        "d AS (SELECT a.contig AS q, b.contig AS s, a.at - b.at AS diagonal, count(*) AS n_shared, list_sort(list(a.at)) AS p FROM kept a JOIN kept b USING (kmer) WHERE a.contig <> b.contig GROUP BY ALL HAVING count(*) >= 10)",
        "best AS (SELECT q, s, diagonal, n_shared, p[1] + 1 AS q_start, p[-1] + 16 AS q_end, 16 + coalesce(list_sum(list_transform(p[2:], lambda x, i: least(x - p[i], 16))), 0) AS matched FROM d QUALIFY row_number() OVER (PARTITION BY q, s ORDER BY n_shared DESC, diagonal) = 1)",
        select="SELECT *, q_start - diagonal AS s_start, q_end - diagonal AS s_end, q_end - q_start + 1 AS aln_len, round(100.0 * matched / (q_end - q_start + 1), 4) AS identity FROM best"),
    "filter_hits": X.sql(X.HITS, select="SELECT * FROM hits WHERE floor(identity) >= 80"),
    "top_hits": X.sql(X.HITS, X.CANDIDATES, select=f"SELECT {_HIT}, row_number() OVER (PARTITION BY q_genome, q_gene, s_genome ORDER BY bitscore DESC, s_gene) AS rank, bitscore FROM candidates QUALIFY rank <= 5"),
    "best_hits": X.sql(*ALL, select="SELECT * FROM best"),
    "hit_coverage": X.sql(X.HITS, select=f"SELECT {_HIT}, {_QC} AS q_coverage, {_SC} AS s_coverage FROM hits"),
    "mutual_best_hits": X.sql(*ALL, select=f"SELECT {_HIT}, bitscore FROM mutual"),
    "singular_best_hits": X.sql(*ALL, select=f"SELECT {_HIT}, bitscore FROM singular"),
    "loners": X.sql(*ALL, select="SELECT * FROM lone"),
    "paralogs": X.sql(X.HITS, X.GENOME_GENES, PARALOGS, select="SELECT * FROM paralog"),
    "homology_stats": X.sql(*ALL, """kinds AS (SELECT q_genome, s_genome, 'mutual' AS kind FROM mutual UNION ALL SELECT q_genome, s_genome, 'singular' FROM singular UNION ALL SELECT genome, other, 'loner' FROM lone)""",
        select="""SELECT least(q_genome, s_genome) AS genome1, greatest(q_genome, s_genome) AS genome2, count_if(kind = 'mutual' AND q_genome < s_genome) AS mutual, count_if(kind = 'singular' AND q_genome < s_genome) AS singular1,
        count_if(kind = 'singular' AND q_genome > s_genome) AS singular2, count_if(kind = 'loner' AND q_genome < s_genome) AS loner1, count_if(kind = 'loner' AND q_genome > s_genome) AS loner2 FROM kinds GROUP BY ALL"""),
    "set_stats": X.sql(X.HITS, X.GENOME_GENES, PARALOGS, select="""SELECT genome, count(*) AS n_genes, count_if(gene % 4 = 0) AS n_annotations, (SELECT count(DISTINCT gene) FROM paralog p WHERE p.genome = g.genome) AS n_with_paralogs FROM genome_genes g GROUP BY genome"""),
    "merge_profile": X.sql(*ALL, PROFILE, select="SELECT * FROM profile"),
    "profile_alerts": X.sql(*_WITH_ALERTS, select=f"SELECT {_C}, alerts FROM alerted"),
    "query_profiles": X.sql(*_WITH_ALERTS, select=f"SELECT {_C}, alerts FROM alerted WHERE row_type IN ('genome1_mutual', 'genome1_singular') AND regexp_matches(alerts, '(^|; )[abi][)]')"),
    "count_differences": X.sql(*_WITH_ALERTS, select="SELECT genome1, genome2, count(*) AS n_rows FROM alerted WHERE regexp_matches(alerts, '(^|; )[cdij][)]') GROUP BY ALL"),
    "homolog_table": X.sql(*_WITH_ALERTS, select="""SELECT g.gene1 AS gene, o.genome2 AS genome, coalesce(h.g2_header, 'no record') AS header, h.g2_annotation AS annotation, h.g2_length AS length, h.alerts AS interpretation, h.row_type FROM (SELECT DISTINCT gene1 FROM profile WHERE genome1 = 'genome0' AND gene1 IS NOT NULL) g,
        (SELECT DISTINCT genome2 FROM profile WHERE genome1 = 'genome0' AND gene1 IS NOT NULL) o LEFT JOIN (SELECT * FROM alerted WHERE genome1 = 'genome0' AND gene1 IS NOT NULL AND gene2 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene1, genome2 ORDER BY ord DESC) = 1) h ON h.gene1 = g.gene1 AND h.genome2 = o.genome2"""),
    "loner_matrix": X.sql(*ALL, PROFILE, select="SELECT g1_header AS header, g1_start AS start, g1_contig AS contig, " + ", ".join(f"max(CASE WHEN genome2 = 'genome{i}' THEN 'X' END) AS genome{i}" for i in (1, 2, 3)) + " FROM profile WHERE genome1 = 'genome0' AND row_type = 'genome1_loner' GROUP BY ALL"),
}

_CLASSES = "cls AS (SELECT contig, min(contig) OVER (PARTITION BY seq) AS class, length(seq) AS size FROM (SELECT DISTINCT contig, seq FROM contigs WHERE contig IS NOT NULL AND seq IS NOT NULL))"
_NEAR = "coalesce({0} BETWEEN 1 AND 200, FALSE)"
_ALONG = "OVER (PARTITION BY u, v ORDER BY x, y)"
_STEPS = f"x - lag(x) {_ALONG} AS dx, y - lag(y) {_ALONG} AS dy"
_ON = f"({_NEAR.format('dx')} AND {_NEAR.format('dy')})"
SQL["sequence_classes"] = X.sql(X.CONTIGS, _CLASSES, select="SELECT * FROM cls")
SQL["chained_hits"] = X.sql(
    X.CONTIGS, _CLASSES, "u AS (SELECT DISTINCT contig, seq FROM contigs SEMI JOIN (SELECT contig FROM cls WHERE contig = class) USING (contig))",
    "km AS (SELECT contig, i AS pos, n, substr(seq, i + 1, 16) AS kmer FROM (SELECT contig, seq, length(seq) - 15 AS n, unnest(range(length(seq) - 15)) AS i FROM u WHERE length(seq) >= 16))",
    "mn AS (SELECT DISTINCT contig, m.pos AS pos, m.kmer AS kmer FROM (SELECT contig, pos, n, min({'h': md5(kmer), 'pos': pos, 'kmer': kmer}) OVER (PARTITION BY contig ORDER BY pos ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS m FROM km) WHERE pos = 0 OR pos <= n - 5)",
    "o AS (SELECT *, row_number() OVER (PARTITION BY contig, kmer ORDER BY pos) AS no FROM mn)", "anchor AS (SELECT a.contig AS u, b.contig AS v, a.pos AS x, b.pos AS y FROM o a JOIN o b USING (kmer, no) WHERE a.contig < b.contig)",
    f"f AS (SELECT *, {_ON} AS follows FROM (SELECT *, {_STEPS} FROM anchor))", f"l AS (SELECT u, v, x, y FROM (SELECT *, coalesce(lead(follows) {_ALONG}, FALSE) AS leads FROM f) WHERE follows OR leads)",
    f"c AS (SELECT *, {_ON} AS ok FROM (SELECT *, {_STEPS} FROM l))", f"n AS (SELECT *, sum(CASE WHEN ok THEN 0 ELSE 1 END) {_ALONG} AS chain FROM c)",
    "g AS (SELECT u, v, min(x) + 1 AS us, max(x) + 16 AS ue, min(y) + 1 AS vs, max(y) + 16 AS ve, count(*) AS n_anchors, count(*) FILTER (ok AND dx <> dy) AS gap_opens, coalesce(sum(abs(dx - dy)) FILTER (ok), 0) AS gap_letters, coalesce(sum(least(dx, dy, 16)) FILTER (ok), 0) + 16 AS matched FROM n GROUP BY u, v, chain HAVING count(*) >= 2)",
    "b AS (SELECT u AS q, v AS s, us AS q_start, ue AS q_end, vs AS s_start, ve AS s_end, n_anchors, gap_opens, gap_letters, matched FROM g UNION ALL SELECT v, u, vs, ve, us, ue, n_anchors, gap_opens, gap_letters, matched FROM g)",
    select="SELECT *, round(100.0 * matched / aln_len, 4) AS identity FROM (SELECT q, s, q_start, q_end, s_start, s_end, n_anchors, gap_opens, CAST(gap_letters AS BIGINT) AS gap_letters, CAST(matched AS BIGINT) AS matched, greatest(q_end - q_start, s_end - s_start) + 1 AS aln_len FROM b)")

_SPAN = "CAST(round_even(100.0 * (CASE WHEN {1} >= {0} THEN {1} - {0} + 1 ELSE {1} - {0} - 1 END) / aln_len, 0) AS BIGINT)"
SQL["sequence_best_hits"] = f"""SELECT *, {_SPAN.format('q_start', 'q_end')} AS q_coverage, {_SPAN.format('s_start', 's_end')} AS s_coverage FROM (
  SELECT 'genome' || (CAST(substr(q, 5) AS BIGINT) % 4) AS q_genome, 'genome' || (CAST(substr(s, 5) AS BIGINT) % 4) AS s_genome, q AS q_gene, s AS s_gene, identity, matched AS bitscore, q_start, q_end, s_start, s_end, aln_len FROM ({SQL['kmer_hits']}) WHERE identity >= 60)
  WHERE q_genome <> s_genome QUALIFY row_number() OVER (PARTITION BY q_genome, q_gene, s_genome ORDER BY bitscore DESC, s_gene) = 1"""
