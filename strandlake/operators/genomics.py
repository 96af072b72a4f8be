"""Genomics over all pairs: edges between genes, core genome, correspondences, homology groups.

Edges have (gene, genome, partner, partner_genome, kind): gene ids are `genome:contig:header`, kind is mutual or
singular. Paralog edges have (gene, paralog).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlake.session import drop, fresh

from .scan import kept, with_place


def load_genome_hits(profile: DataFrame) -> DataFrame:
    """The edges of all pair profiles in both directions; gene_no is the number in the cds header."""
    name = lambda i: F.concat_ws(":", f"genome{i}", f"g{i}_contig", f"g{i}_header")
    number = lambda i: F.regexp_extract(f"g{i}_header", r"^cds(\d+)/", 1).cast("int")
    side = lambda i: F.struct(name(i).alias("gene"), F.col(f"genome{i}").alias("genome"), number(i).alias("gene_no"))
    # an edge and its way back are one row while repeated ones are looked for
    once = profile.where(~F.col("row_type").endswith("loner")).select(F.least(side(1), side(2)).alias("a"), F.greatest(side(1), side(2)).alias("b"), F.substring_index("row_type", "_", -1).alias("kind")).distinct()
    turned = once.select("kind", F.explode(F.array_distinct(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))).alias("e"))
    return turned.select("e.x.gene", "e.x.genome", "e.x.gene_no", F.col("e.y.gene").alias("partner"), F.col("e.y.genome").alias("partner_genome"), "kind")


def gene_lists(profile: DataFrame, genes: DataFrame) -> DataFrame:
    """(gene, genome, mutual, singular): each gene of `genes` (gene, genome) and of the hit rows of profiles with its distinct partners of
    either kind, (partner, partner_genome), sorted. What lists, loners, core and correspondences ask for, by one grouping of the edges."""
    name = lambda i: F.concat_ws(":", f"genome{i}", f"g{i}_contig", f"g{i}_header")
    end = lambda i, j: F.struct(name(i).alias("gene"), F.col(f"genome{i}").alias("genome"), name(j).alias("partner"), F.col(f"genome{j}").alias("partner_genome"))
    both = profile.where(~F.col("row_type").endswith("loner")).select(F.substring_index("row_type", "_", -1).alias("kind"), F.explode(F.array(end(1, 2), end(2, 1))).alias("e")).select("kind", "e.*")
    listed = both.unionByName(genes.select("gene", "genome"), allowMissingColumns=True)
    found = listed.groupBy(F.xxhash64("gene").alias("_sum"), "gene", "genome").agg(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("kind", "partner", "partner_genome"))).alias("all"))  # names begin alike, so that a sort tells them apart late
    of = lambda kind: F.array_sort(F.array_distinct(F.transform(F.filter("all", lambda p: p["kind"] == kind), lambda p: F.struct(p["partner"].alias("partner"), p["partner_genome"].alias("partner_genome"))))).alias(kind)
    return found.select("gene", "genome", of("mutual"), of("singular"))


def listed(lists: DataFrame, kind: str) -> DataFrame:
    """hit_lists of gene_lists."""
    names = F.array_distinct(F.transform(kind, lambda p: p["partner"]))
    return lists.where(F.size(kind) > 0).select("gene", "genome", F.size(names).cast("long").alias("n_partners"), F.array_join(names, ",").alias("partners"))


def listed_edges(lists: DataFrame) -> DataFrame:
    """(gene, partner), distinct, of gene_lists."""
    return lists.select("gene", F.explode(F.array_union(F.transform("mutual", lambda p: p["partner"]), F.transform("singular", lambda p: p["partner"]))).alias("partner"))


def listed_loners(lists: DataFrame) -> DataFrame:
    """genomic_loners of gene_lists whose genes are those of the table."""
    return lists.where((F.size("mutual") == 0) & (F.size("singular") == 0)).select("gene", "genome")


def listed_core(lists: DataFrame, genes: DataFrame, reference: str) -> DataFrame:
    """core_genome of gene_lists."""
    others = genes.where(F.col("genome") != reference).agg(F.countDistinct("genome").alias("n_others"))
    counts = lists.where((F.col("genome") == reference) & (F.size("mutual") > 0)).select("gene", F.size(F.array_distinct(F.transform("mutual", lambda p: p["partner_genome"]))).cast("long").alias("n_partners"))
    return counts.join(F.broadcast(others), F.col("n_partners") == F.col("n_others")).drop("n_others")


def listed_correspondences(lists: DataFrame, reference: str) -> DataFrame:
    """correspondences of gene_lists."""
    names = F.array_union(F.transform("mutual", lambda p: p["partner"]), F.transform("singular", lambda p: p["partner"]))
    return lists.where((F.col("genome") == reference) & (F.size(names) > 0)).select("gene", F.array_join(names, ",").alias("partners"))


def hit_lists(edges: DataFrame, kind: str) -> DataFrame:
    """(gene, genome, n_partners, partners): the partners of one kind over all genomes, sorted, joined by commas."""
    return edges.where(F.col("kind") == kind).groupBy("gene", "genome").agg(F.sort_array(F.collect_set("partner")).alias("all")).select("gene", "genome", F.size("all").cast("long").alias("n_partners"), F.array_join("all", ",").alias("partners"))


def correspondences(edges: DataFrame, reference: str) -> DataFrame:
    """(gene, partners): a reference gene's distinct partners, the mutual ones first."""
    rank = F.when(F.col("kind") == "mutual", 0).otherwise(1)
    own = edges.where(F.col("genome") == reference).groupBy("gene", "partner").agg(F.min(rank).alias("rank"))
    ordered = F.sort_array(F.collect_list(F.struct("rank", "partner")))
    return own.groupBy("gene").agg(F.array_join(F.transform(ordered, lambda x: x["partner"]), ",").alias("partners"))


def core_genome(edges: DataFrame, genes: DataFrame, reference: str) -> DataFrame:
    """(gene, n_partners): reference genes with a mutual partner in every other genome of `genes`."""
    others = genes.where(F.col("genome") != reference).agg(F.countDistinct("genome").alias("n_others"))
    counts = edges.where((F.col("genome") == reference) & (F.col("kind") == "mutual")).groupBy("gene").agg(F.countDistinct("partner_genome").alias("n_partners"))
    return counts.join(F.broadcast(others), F.col("n_partners") == F.col("n_others")).drop("n_others")


def genomic_loners(genes: DataFrame, edges: DataFrame) -> DataFrame:
    """(gene, genome): genes (gene, genome) without any edge."""
    return genes.select("gene", "genome").join(edges.select("gene").distinct(), "gene", "left_anti")


def genomic_paralogs(paralogs: DataFrame) -> DataFrame:
    """(gene, n_paralogs, paralogs): distinct paralog ids, sorted, joined by commas."""
    return paralogs.groupBy("gene").agg(F.sort_array(F.collect_set("paralog")).alias("all")).select("gene", F.size("all").cast("long").alias("n_paralogs"), F.array_join("all", ",").alias("paralogs"))


def paralog_set_size(paralogs: DataFrame) -> DataFrame:
    """(n_paralogs, n_genes): how many genes have how many paralogs."""
    return paralogs.groupBy("gene").agg(F.countDistinct("paralog").alias("n_paralogs")).groupBy("n_paralogs").agg(F.count("*").alias("n_genes"))


def homology_seeds(genes: DataFrame, paralogs: DataFrame) -> DataFrame:
    """The genes (gene, ord) that start a group: in order, those that no earlier seed lists as a paralog.

    A gene is lost if any of its terms holds; a term names an earlier gene and holds if that is a seed (or, where `no` is
    set, if it isn't). A gene of one term is that gene's equal or opposite: it takes part in no round of its own, all terms
    that name it name what it depends on instead. So each round halves the way to go along chains, besides deciding every
    gene whose terms are all decided; a gene that has both terms of one other is lost at once. Terms and decisions are
    tables in the shared folder; a round writes three, and the seeds are read from the rounds' states.
    """
    spark = genes.sparkSession
    seeds_at = fresh(spark, "seeds")

    def keep(df: DataFrame, path: str | None = None) -> DataFrame:
        path = path or fresh(spark, "seeds-open")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    place = genes.select("gene", "ord")
    earlier = paralogs.select("gene", "paralog").distinct().join(place, "gene").join(place.select(F.col("gene").alias("paralog"), F.col("ord").alias("paralog_ord")), "paralog").where("ord < paralog_ord")
    terms = keep(earlier.select(F.col("paralog").alias("gene"), F.col("paralog_ord").alias("ord"), F.col("gene").alias("on"), F.lit(False).alias("no")))
    free = place.join(terms, "gene", "left_anti").select("gene", "ord", F.lit(False).alias("lost"), F.lit(0).cast("long").alias("open"))
    state = keep(free.withColumn("one", F.when(F.lit(False), F.struct(F.col("gene").alias("on"), F.lit(False).alias("no")))), f"{seeds_at}/round=0")
    decided, n = state.select("gene", (~F.col("lost")).alias("seed")), 0
    while not terms.isEmpty():
        n += 1
        known = terms.join(decided.select(F.col("gene").alias("on"), "seed"), "on", "left").withColumn("holds", F.col("seed") != F.col("no"))
        pairs = known.groupBy("gene", "ord", "on").agg(F.min("no").alias("least"), F.max("no").alias("no"), F.max("holds").alias("holds"))
        pairs = keep(pairs.withColumn("holds", F.when(F.col("least") != F.col("no"), True).otherwise(F.col("holds"))))
        state = pairs.groupBy("gene", "ord").agg(F.coalesce(F.max("holds"), F.lit(False)).alias("lost"), F.count_if(F.col("holds").isNull()).alias("open"), F.max(F.when(F.col("holds").isNull(), F.struct("on", "no"))).alias("one"))
        state = keep(state, f"{seeds_at}/round={n}")
        now = state.where("lost OR open = 0").select("gene", (~F.col("lost")).alias("seed"))
        left = pairs.where("holds IS NULL").join(now, "gene", "left_anti").select("gene", "ord", "on", "no")
        # seed(gene) is seed(one.on) if one.no, else its opposite
        same = state.where("NOT lost AND open = 1").select(F.col("gene").alias("on"), F.col("one.on").alias("to"), F.col("one.no").alias("equal"))
        turned = left.join(same, "on", "left").select("gene", "ord", F.coalesce("to", "on").alias("on"), F.when(F.col("to").isNull() | F.col("equal"), F.col("no")).otherwise(~F.col("no")).alias("no"))
        after = keep(turned.distinct())
        drop(terms, pairs)
        terms, decided = after, now
    return spark.read.schema(state.schema).parquet(seeds_at).where("NOT lost AND open = 0").select("gene", "ord")


def homology_groups(genes: DataFrame, edges: DataFrame, paralogs: DataFrame) -> DataFrame:
    """(group_no, seed, member): each seed of the reference genes with itself, its partners, its paralogs and their partners."""
    own = kept(paralogs.select("gene", "paralog").distinct(), "paralogs")
    seeds = homology_seeds(genes, own)
    numbered = with_place(seeds, [], ["ord"], "group_no").select(F.col("group_no").cast("int").alias("group_no"), F.col("gene").alias("seed"))
    of_seed = numbered.join(own, F.col("seed") == F.col("gene")).select("group_no", "seed", F.col("paralog").alias("member"))
    inner = kept(numbered.select("group_no", "seed", F.col("seed").alias("member")).unionByName(of_seed), "group-genes")
    return inner.unionByName(inner.join(edges.select("gene", "partner"), F.col("member") == F.col("gene")).select("group_no", "seed", F.col("partner").alias("member"))).distinct()


def group_sequences(groups: DataFrame, sequences: DataFrame) -> DataFrame:
    """Groups with each member's sequence; sequences (gene, seq)."""
    return groups.join(sequences.select(F.col("gene").alias("member"), "seq"), "member")


def group_annotations(groups: DataFrame, annotations: DataFrame) -> DataFrame:
    """Groups with each member's annotation, or `no annotation found`; annotations (gene, annotation)."""
    found = groups.join(annotations.select(F.col("gene").alias("member"), "annotation"), "member", "left")
    return found.withColumn("annotation", F.coalesce("annotation", F.lit("no annotation found")))


def genome_data_checks(genes: DataFrame, edges: DataFrame) -> DataFrame:
    """(check, subject, n): duplicate gene ids, genomes and headers, mutual lists longer than the other genomes, self hits.

    genes (gene, genome, ...); `header` is checked within a genome and `n_listed`, how often a genome was given, over
    genomes if the columns exist.
    """
    edges = kept(edges.select("gene", "partner", "kind"), "edges")
    others = genes.agg((F.countDistinct("genome") - 1).alias("n_others"))
    twice = genes.groupBy("gene").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate id").alias("check"), F.col("gene").alias("subject"), "n")
    long = edges.where("kind = 'mutual'").groupBy("gene").agg(F.countDistinct("partner").alias("n")).join(F.broadcast(others), F.col("n") > F.col("n_others")).select(F.lit("long mutual list").alias("check"), F.col("gene").alias("subject"), "n")
    itself = edges.where("gene = partner").groupBy("gene").agg(F.count("*").alias("n")).select(F.lit("self hit").alias("check"), F.col("gene").alias("subject"), "n")
    count = genes.agg(F.countDistinct("genome").alias("n")).select(F.lit("genomes").alias("check"), F.lit("all").alias("subject"), "n")
    found = twice.unionByName(long).unionByName(itself).unionByName(count)
    if "header" in genes.columns:
        again = genes.groupBy(F.concat_ws(":", "genome", "header").alias("subject")).agg(F.count("*").alias("n")).where("n > 1")
        found = found.unionByName(again.select(F.lit("duplicate header").alias("check"), "subject", "n"))
    if "n_listed" in genes.columns:
        again = genes.groupBy(F.col("genome").alias("subject")).agg(F.max("n_listed").cast("long").alias("n")).where("n > 1")
        found = found.unionByName(again.select(F.lit("duplicate genome").alias("check"), "subject", "n"))
    return found
