"""Queries over all genome pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake import fixtures as X
from strandlake.operators import genomics as G
from strandlake.operators import hits as H

from .hits import ALL, PARALOGS, PROFILE, _kept_genes, _seq

NAME = "concat(genome, ':', contig, ':cds', gene, '/', strand, '/', start, '/', `end`, '/')"


def _named(genes):
    return genes.selectExpr("genome", "gene AS ord", f"{NAME} AS gene")


def _genes(s, d):
    return _named(X.genome_genes(s, d))


def _hit_rows(best, genes):
    """Rows of profiles that have hits; their alignments aren't used, so that they are made last."""
    return H.described(X.with_alignment(H.located_hits(best, genes, loners=False)))


def _edges(s, d, genome=None, genes=None):
    """Of all genes, or of those of one genome, given by number; `genes` if they are kept already."""
    genes = _kept_genes(s, d) if genes is None else genes
    edges = G.load_genome_hits(_hit_rows(X.named(H.best_hits(X.scored_candidates(s, d, genome))), genes))
    return edges if genome is None else edges.where(F.col("genome") == f"genome{genome}")


def _paralogs(s, d, genome=None, genes=None):
    genes = _kept_genes(s, d) if genes is None else genes
    genes = genes if genome is None else genes.where(F.col("genome") == f"genome{genome}")
    names = genes.selectExpr("genome", "gene", f"{NAME} AS id")
    found = H.paralogs(X.own_hits(s, d, genome), genes)
    return found.join(names, ["genome", "gene"]).join(names.select("genome", F.col("gene").alias("paralog"), F.col("id").alias("other")), ["genome", "paralog"]).select(F.col("id").alias("gene"), F.col("other").alias("paralog"))


def _checked(genes):
    """The genes with headers of which some occur twice in a genome, and a genome that is listed twice."""
    header = "concat('cds', CASE WHEN ord < 1000 THEN ord ELSE ord - 1000 END)"
    return _named(genes).selectExpr("*", f"{header} AS header", "CASE WHEN genome = 'genome3' THEN array(1, 2) ELSE array(1) END AS listings").withColumn("n_listed", F.size("listings")).drop("listings")


def _groups(s, d, genes=None):
    genes = _kept_genes(s, d) if genes is None else genes
    return G.homology_groups(_named(genes).where("genome = 'genome0'"), _edges(s, d, 0, genes), _paralogs(s, d, 0, genes))


def _with_genes(of):
    """A query of the kept genes, which its parts share."""
    return lambda s, d: of(s, d, _kept_genes(s, d))


QUERIES = {
    "load_genome_hits": _edges,
    "mutual_best_hit_lists": lambda s, d: G.hit_lists(_edges(s, d), "mutual"),
    "singular_best_hit_lists": lambda s, d: G.hit_lists(_edges(s, d), "singular"),
    "correspondences": lambda s, d: G.correspondences(_edges(s, d, 0), "genome0"),
    "core_genome": _with_genes(lambda s, d, genes: G.core_genome(_edges(s, d, 0, genes), _named(genes), "genome0")),
    "genomic_loners": _with_genes(lambda s, d, genes: G.genomic_loners(_named(genes), _edges(s, d, genes=genes))),
    "genomic_paralogs": lambda s, d: G.genomic_paralogs(_paralogs(s, d)),
    "paralog_set_size": lambda s, d: G.paralog_set_size(_paralogs(s, d)),
    "homology_groups": _groups,
    "group_sequences": _with_genes(lambda s, d, genes: G.group_sequences(_groups(s, d, genes), genes.selectExpr(f"{NAME} AS gene", f"{_seq('cast(gene as int)')} AS seq"))),
    "group_annotations": _with_genes(lambda s, d, genes: G.group_annotations(_groups(s, d, genes), _named(genes).where("ord % 4 = 0").selectExpr("gene", "concat('protein ', ord) AS annotation"))),
    "genome_data_checks": _with_genes(lambda s, d, genes: G.genome_data_checks(_checked(genes), _edges(s, d, genes=genes))),
}

EDGES = """named AS (SELECT genome, gene AS ord, genome || ':' || contig || ':cds' || gene || '/' || strand || '/' || start || '/' || "end" || '/' AS gene FROM genome_genes),
half AS (SELECT genome1 || ':' || g1_contig || ':' || g1_header AS id1, genome1, gene1, genome2 || ':' || g2_contig || ':' || g2_header AS id2, genome2, gene2, split_part(row_type, '_', 2) AS kind FROM profile WHERE row_type NOT LIKE '%loner'),
edges AS (SELECT id1 AS gene, genome1 AS genome, CAST(gene1 AS INTEGER) AS gene_no, id2 AS partner, genome2 AS partner_genome, kind FROM half UNION SELECT id2, genome2, CAST(gene2 AS INTEGER), id1, genome1, kind FROM half)"""
PARALOG_EDGES = "pe AS (SELECT a.gene AS gene, b.gene AS paralog FROM paralog p JOIN named a ON a.genome = p.genome AND a.ord = p.gene JOIN named b ON b.genome = p.genome AND b.ord = p.paralog)"
_E = (*ALL, PROFILE, EDGES)
_EP = (*_E, PARALOGS, PARALOG_EDGES)
# seeds in gene order: a list of the seeds so far is carried from gene to gene
SEEDS = """z AS MATERIALIZED (SELECT ord, gene, row_number() OVER (ORDER BY ord) AS i FROM named WHERE genome = 'genome0'), listers AS MATERIALIZED (SELECT z.i, list(l.i) AS before FROM pe JOIN z ON z.gene = pe.paralog JOIN z l ON l.gene = pe.gene AND l.i < z.i GROUP BY z.i),
walk(i, seeds) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL SELECT walk.i + 1, CASE WHEN list_has_any(seeds, coalesce(l.before, [])) THEN seeds ELSE list_append(seeds, walk.i + 1) END FROM walk LEFT JOIN listers l ON l.i = walk.i + 1 WHERE walk.i < (SELECT max(i) FROM z)),
seed AS (SELECT row_number() OVER (ORDER BY s) AS group_no, z.gene AS seed FROM (SELECT unnest(seeds) AS s FROM walk WHERE i = (SELECT max(i) FROM z)) JOIN z ON z.i = s),
ps AS (SELECT group_no, seed, paralog AS member FROM seed JOIN pe ON pe.gene = seed), grouped AS (SELECT group_no, seed, seed AS member FROM seed UNION SELECT group_no, seed, partner FROM seed JOIN edges ON edges.gene = seed UNION SELECT * FROM ps UNION SELECT group_no, seed, partner FROM ps JOIN edges ON edges.gene = member)"""


def _walk(select: str) -> str:
    return X.sql(*_EP, SEEDS, select=select).replace("WITH ", "WITH RECURSIVE ", 1)


_LISTS = "SELECT gene, genome, count(DISTINCT partner) AS n_partners, string_agg(DISTINCT partner, ',' ORDER BY partner) AS partners FROM edges WHERE kind = '{}' GROUP BY gene, genome"
SQL = {
    "load_genome_hits": X.sql(*_E, select="SELECT * FROM edges"),
    "mutual_best_hit_lists": X.sql(*_E, select=_LISTS.format("mutual")),
    "singular_best_hit_lists": X.sql(*_E, select=_LISTS.format("singular")),
    "correspondences": X.sql(*_E, select="SELECT gene, string_agg(partner, ',' ORDER BY rank, partner) AS partners FROM (SELECT gene, partner, min(CASE kind WHEN 'mutual' THEN 0 ELSE 1 END) AS rank FROM edges WHERE genome = 'genome0' GROUP BY ALL) GROUP BY gene"),
    "core_genome": X.sql(*_E, select="SELECT gene, count(DISTINCT partner_genome) AS n_partners FROM edges WHERE genome = 'genome0' AND kind = 'mutual' GROUP BY gene HAVING count(DISTINCT partner_genome) = (SELECT count(DISTINCT genome) - 1 FROM named)"),
    "genomic_loners": X.sql(*_E, select="SELECT gene, genome FROM named WHERE gene NOT IN (SELECT gene FROM edges)"),
    "genomic_paralogs": X.sql(*_EP, select="SELECT gene, count(DISTINCT paralog) AS n_paralogs, string_agg(DISTINCT paralog, ',' ORDER BY paralog) AS paralogs FROM pe GROUP BY gene"),
    "paralog_set_size": X.sql(*_EP, select="SELECT n_paralogs, count(*) AS n_genes FROM (SELECT gene, count(DISTINCT paralog) AS n_paralogs FROM pe GROUP BY gene) GROUP BY n_paralogs"),
    "homology_groups": _walk("SELECT * FROM grouped"),
    "group_sequences": _walk("SELECT group_no, seed, member, ['atg', 'gtg', 'att', 'ccc'][ord % 4 + 1] || 'acgtac' AS seq FROM grouped JOIN named ON named.gene = member"),
    "group_annotations": _walk("SELECT group_no, seed, member, CASE WHEN ord % 4 = 0 THEN 'protein ' || ord ELSE 'no annotation found' END AS annotation FROM grouped JOIN named ON named.gene = member"),
    "genome_data_checks": X.sql(*_E, select="""SELECT 'duplicate id' AS "check", gene AS subject, count(*) AS n FROM named GROUP BY gene HAVING count(*) > 1
        UNION ALL SELECT 'long mutual list', gene, count(DISTINCT partner) FROM edges WHERE kind = 'mutual' GROUP BY gene HAVING count(DISTINCT partner) > (SELECT count(DISTINCT genome) - 1 FROM named)
        UNION ALL SELECT 'self hit', gene, count(*) FROM edges WHERE gene = partner GROUP BY gene UNION ALL SELECT 'genomes', 'all', count(DISTINCT genome) FROM named
        UNION ALL SELECT 'duplicate header', genome || ':cds' || gene, count(*) FROM (SELECT genome, gene FROM genome_genes WHERE gene < 1000 UNION ALL SELECT genome, gene - 1000 FROM genome_genes WHERE gene >= 1000) GROUP BY ALL HAVING count(*) > 1
        UNION ALL SELECT 'duplicate genome', 'genome3', 2"""),
}
