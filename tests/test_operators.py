"""Golden cases and properties of the reference operators."""

import random

import pytest
from pyspark.sql import functions as F

from strandlake.functions import sequence as Q
from strandlake.operators import annotate as A
from strandlake.operators import calls as C
from strandlake.operators import genomics as G
from strandlake.operators import hits as H
from strandlake.operators import prep as R
from strandlake.sources import calls as RC
from strandlake.sources import tables as RT

CALLS = "contig string, strand string, left_end long, right_end long, caller string"


@pytest.fixture(scope="module")
def calls(spark):
    rows = [("c", "+", 1, 90, "x"), ("c", "-", 1, 90, "y"), ("c", "+", 1, 90, "z"), ("c", "+", 31, 90, "y"), ("c", "-", 200, 300, "x"), ("c", "-", 200, 330, "y"), ("d", "+", 5, 50, "x")]
    return spark.createDataFrame(rows, CALLS)


def test_adjacent_groups_split_where_strands_interleave(calls):
    keyed, adjacent = C.superset_calls(calls), C.superset_calls(calls, "adjacent")
    assert keyed.where("contig = 'c' AND strand = '+' AND left_end = 1").first().callers == "x_z"
    assert adjacent.where("contig = 'c' AND left_end = 1").count() == 3


def test_superset_holds_consensus_and_core(calls):
    assert {r.agreement for r in C.superset_calls(calls).collect()} == {"unique", "multiple"}
    assert C.common_core_calls(calls).count() == 0
    merged = {(r.contig, r.strand, r.left_end, r.right_end): r.call_no for r in C.consensus_calls(calls).collect()}
    assert merged == {("c", "+", 1, 90): 2, ("c", "-", 200, 330): 3}


def test_scores_follow_identical_and_similar_calls(calls):
    score = {(r.contig, r.strand, r.left_end, r.right_end, r.caller): r.score1 for r in C.score_calls(calls).collect()}
    assert score["c", "+", 1, 90, "x"] == pytest.approx(2 / 3 + 0.5 / 3) and score["c", "-", 1, 90, "y"] == pytest.approx(1 / 3) and score["d", "+", 5, 50, "x"] == pytest.approx(1 / 3)


def test_order_of_input_does_not_matter(calls):
    mixed = calls.orderBy(F.desc("right_end")).repartition(5)
    for f in (C.superset_calls, C.score_calls, C.consensus_calls, C.merge_calls):
        assert sorted(map(str, f(calls).collect())) == sorted(map(str, f(mixed).collect()))


HITS = "q_genome string, s_genome string, q_gene int, s_gene int, identity int, bitscore int, q_start int, q_end int, s_start int, s_end int"


def hits(spark, *rows):
    return spark.createDataFrame([(*r, 80, 1, 1, 90, 1, 90) for r in rows], HITS)


def test_hit_classes_are_disjoint_and_complete(spark):
    best = hits(spark, ("a", "b", 1, 1), ("b", "a", 1, 1), ("a", "b", 2, 1), ("a", "b", 3, 9), ("b", "a", 2, 1))
    genes = spark.createDataFrame([(g, i) for g in "ab" for i in (1, 2, 3)], "genome string, gene int")
    mutual = {(r.q_genome, r.q_gene) for r in H.mutual_best_hits(best).collect()}
    strict, loose = ({(r.q_genome, r.q_gene) for r in H.singular_best_hits(best, s).collect()} for s in (True, False))
    alone = {(r.genome, r.gene) for r in H.loners(genes, best).collect()}
    assert mutual == {("a", 1), ("b", 1)} and strict == {("a", 2), ("b", 2)} and loose == strict | {("a", 3)}
    assert not mutual & strict and not alone & (mutual | strict) and alone | mutual | strict == {(g, i) for g in "ab" for i in (1, 2, 3)}


def test_coverage_rounds_half_to_even_and_is_negative_on_the_reverse_strand(spark):
    rows = spark.createDataFrame([(1, 25, 25, 1, 1000), (1, 45, 1, 10, 0)], "q_start int, q_end int, s_start int, s_end int, size int")
    got = [(r.q_coverage, r.s_coverage) for r in H.hit_coverage(rows, "size").orderBy("q_end").collect()]
    assert got == [(2, -2), (None, None)]


def test_seeds_are_greedy_in_gene_order(spark):
    genes = spark.createDataFrame([(f"g{i}", i) for i in range(6)], "gene string, ord int")
    edges = spark.createDataFrame([("g0", "g1"), ("g1", "g2"), ("g2", "g3"), ("g3", "g0"), ("g5", "g4")], "gene string, paralog string")
    assert [r.gene for r in G.homology_seeds(genes, edges).orderBy("ord").collect()] == ["g0", "g2", "g4", "g5"]


def test_sequence_functions(spark):
    row = spark.createDataFrame([("atgacnRyk", "atgaaatagg", "GTG", ">a b (c); d:e?.f", "xatgatgx")], "s string, g string, c string, h string, t string")
    v = Q.header_variants(F.col("h"), F.lit("p"), F.lit("gene"), F.lit(3))
    sites = Q.start_codon_sites(F.col("t"))
    got = row.select(Q.reverse_complement(Q.reverse_complement(F.col("s"))).alias("twice"), Q.reverse_complement(F.col("s")).alias("rc"), Q.translate_sequence(F.col("g")).alias("p"), Q.start_codon_class(F.col("c")).alias("k"), v["clean"].alias("clean"), v["trunc"].alias("trunc"),
                     v["sequential"].alias("seq"), sites["sites"].alias("sites"), sites["highlighted"].alias("high"), *[c.alias(f"p_{n}") for n, c in Q.parse_cgp_header(F.lit("cds7/-/10/99/")).items()]).first()
    assert got.twice == "atgacnRyk" and got.rc == "mrYngtcat" and got.p == "MK" and got.k == "alternate" and got.clean == "a_b_c_def" and got.trunc == "a b (c); d:e?.f" and got.seq == "gene-3"
    assert got.sites == [1, 4] and got.high == "xATGATGx" and (got.p_cds, got.p_strand, got.p_start, got.p_end) == ("cds7", "-", 10, 99)


def test_flank_is_clamped_and_start_zero_is_one(spark):
    contigs = spark.createDataFrame([("c", "acgtacgtac")], "contig string, seq string")
    calls = spark.createDataFrame([("c", "+", 0, 4), (None, "-", 2, 5)], "contig string, strand string, left_end int, right_end int")
    assert [r.gene for r in Q.extract_genes(calls, contigs).collect()] == ["acgt"]
    assert sorted(r.stretch for r in Q.extract_flanks(calls, contigs, 3).collect()) == ["acgtacg", "acgtacgt"]


def test_family_ids_keep_order_and_match_whole_keys(spark):
    hits = spark.createDataFrame([(1, "VOG10|VOG1|VOG10 x")], "gene int, header string")
    assert hits.select(A.family_ids(F.col("header")).alias("v")).first().v == ["VOG10", "VOG1"]
    families = spark.createDataFrame([("VOG1", "one"), ("VOG10", "ten")], "family_id string, description string")
    assert {(r.family_id, r.description) for r in A.family_description(hits, families).collect()} == {("VOG1", "one"), ("VOG10", "ten")}


def test_tagging_keeps_header_and_sequence_together(spark):
    sequences = spark.createDataFrame([(">A one", "s1"), (">B two", "s2"), (">C", "s3")], "header string, seq string")
    members = spark.createDataFrame([("V2", "A"), ("V1", "A"), ("V1", "B"), ("V9", "Z")], "family_id string, accession string")
    assert {(r.header, r.seq) for r in R.tag_families(sequences, members).collect()} == {(">V1|V2|A one", "s1"), (">V1|B two", "s2")}
    assert [r.accession for r in R.missing_accessions(members, sequences).collect()] == ["Z"]


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_fasta_and_gff_files(spark, tmp_path):
    path = write(tmp_path, "a.fasta", ">one x\r\nAC GT1\r\nacg*\n>two\nTTT\n>empty\n")
    assert {(r.header, r.seq) for r in RT.fasta(spark, path).collect()} == {("one x", "acgtacg"), ("two", "ttt")}
    folder = tmp_path / "g"
    folder.mkdir()
    path = write(folder, "a.gff", "#c\nk\tt\tCDS\t9\t3\t.\t-\t0\tx\nk\tt\tgene\t1\t2\t.\t+\t0\tx\nk\tt\tCDS\tx\t3\t.\t-\t0\tx\n")
    assert [(r.contig, r.left_end, r.right_end, r.length, r.strand) for r in RC.gff3(spark, path).collect()] == [("k", 3, 9, 7, "-")]
    assert [r.line.split("\t")[3] for r in RC.gff3(spark, path, rejects=True).collect()] == ["x"]


def test_glimmer_versions(spark, tmp_path):
    path = write(tmp_path, "a.txt", ">k1\norf00001 1 90 +1 5.0\norf00002 300 200 -2 5.0\n>k2\norf00001 7 96 +1 5.0\n")
    assert {(r.contig, r.strand, r.left_end, r.right_end) for r in RC.glimmer(spark, path).collect()} == {("k1", "+", 1, 90), ("k1", "-", 200, 300), ("k2", "+", 7, 96)}


def test_kmer_hits_of_more_sequences_than_a_block(spark):
    """57 copies, 4 near copies and a passage in 60 others: no k-mer is too frequent to count."""
    rng = random.Random(5)
    draw = lambda n: "".join(rng.choices("acgt", k=n))
    one, passage = draw(60), draw(30)
    seqs = [one] * 57 + [one[:30] + c + one[31:] for c in "acgt" if c != one[30]] + [one[5:]] + [draw(20) + passage + draw(7) for _ in range(60)] + ["ac" * 20, "ac" * 15, "acg", ""]
    rows = {f"c{i}": s for i, s in enumerate(seqs)}
    want = {}
    places = {c: [(s[i : i + 16], i) for i in range(len(s) - 15)] for c, s in rows.items()}
    by_kmer = {}
    for c, found in places.items():
        for w, i in found:
            by_kmer.setdefault(w, []).append((c, i))
    count = {}
    for found in by_kmer.values():
        for c, i in found:
            for d, j in found:
                if c != d:
                    count.setdefault((c, d), {}).setdefault(i - j, []).append(i)
    for pair, diagonals in count.items():
        n, d = max((len(at), -d) for d, at in diagonals.items())
        if n >= 10:
            want[pair] = (-d, n, min(diagonals[-d]) + 1, max(diagonals[-d]) + 16)
    got = H.kmer_hits(spark.createDataFrame(list(rows.items()), "contig string, seq string").repartition(3)).collect()
    assert {(r.q, r.s): (r.diagonal, r.n_shared, r.q_start, r.q_end) for r in got} == want and len(got) == len(want) > 57 * 56 + 60 * 59


def test_genes_are_cut_from_windows(spark):
    """Calls inside a window, over its edge, over several windows, at the contig's ends and beyond them."""
    rng = random.Random(2)
    contigs = {c: "".join(rng.choices("acgt", k=n)) for c, n in (("a", 1_000), ("b", 64), ("c", 0), ("d", 129))}
    rows = [(c, rng.choice("+-"), rng.randint(0, 900), 0) for c in contigs for _ in range(40)]
    rows = [(c, s, left, left + rng.choice([0, 2, 30, 95, 96, 97, 400])) for c, s, left, _ in rows] + [("a", "+", 0, 1_000), ("a", "-", 1, 1_000), ("a", "+", 64, 65)]
    calls = spark.createDataFrame(rows, "contig string, strand string, left_end long, right_end long")
    table = spark.createDataFrame(list(contigs.items()), "contig string, seq string")

    def plain(c, strand, left, right):
        part = contigs[c][max(left, 1) - 1 : right]
        return part if strand == "+" else part[::-1].translate(str.maketrans("acgt", "tgca"))

    got = sorted((r.contig, r.strand, r.left_end, r.right_end, r.gene) for r in Q.extract_genes(calls, table, window=64).where("gene <> ''").collect())
    assert got == sorted((c, s, max(a, 1), b, plain(c, s, a, b)) for c, s, a, b in rows if plain(c, s, a, b))
    flanks = sorted((r.left_end, r.right_end, r.stretch) for r in Q.extract_flanks(calls.where("contig = 'a'"), table, 7, window=64).where("stretch <> ''").collect())
    assert flanks == sorted((a, b, plain("a", s, max(a - 7, 1), b + 7)) for c, s, a, b in rows if c == "a" and plain("a", s, max(a - 7, 1), b + 7))


def test_translation_equals_the_table(spark):
    bases = "tcag"
    table = {a + b + c: Q.TABLE_11[16 * i + 4 * j + k] for i, a in enumerate(bases) for j, b in enumerate(bases) for k, c in enumerate(bases)}
    rng = random.Random(4)
    seqs = ["".join(rng.choices("acgtnACGT", k=rng.randint(0, 40))) for _ in range(200)] + ["", "at", "atgtaa", "taataa"]
    got = {r.s: r.p for r in spark.createDataFrame([(s,) for s in seqs], "s string").select("s", Q.translate_sequence(F.col("s")).alias("p")).collect()}
    for s in seqs:
        whole = "".join(table.get(s.lower()[i : i + 3], "X") for i in range(0, len(s) - 2, 3))
        assert got[s] == (whole[:-1] if whole.endswith("*") else whole)


def test_a_whole_file_of_custom_calls(spark, tmp_path):
    """A file as tools write it: two comment lines, then calls, of which one is broken."""
    name = "Sample_NC_000001_1_Some_phage__complete_genome"
    rows = [f"{name}\tMyCaller\tCDS\t{left}\t{left + 140}\t4.4\t{'-' if i % 5 == 4 else '+'}\t0\tID=1_{i}" for i, left in enumerate(range(1, 4_300, 100), 1)]
    (tmp_path / "calls.gff").write_text("\n".join(["##gff-version  3", f'# Sequence Data: seqhdr="{name}"', *rows, f"{name}\tMyCaller\tCDS\t1"]) + "\n")
    found = RC.custom(spark, str(tmp_path)).orderBy("gene_no").collect()
    assert len(found) == len(rows) and [r.gene_no for r in found] == list(range(1, len(rows) + 1)) and {r.length for r in found} == {141}
    assert sum(r.strand == "-" for r in found) == sum("\t-\t" in r for r in rows)
    assert [r.line for r in RC.custom(spark, str(tmp_path), rejects=True).collect()] == [f"{name}\tMyCaller\tCDS\t1"]


def test_seeds_equal_a_walk_in_order(spark):
    rng = random.Random(9)
    genes = [(f"g{i}", i) for i in range(60)]
    pairs = {(f"g{rng.randrange(60)}", f"g{rng.randrange(60)}") for _ in range(70)} | {(f"g{i}", f"g{i + 1}") for i in range(20, 30)}
    listed = [(a, b) for a, b in pairs if a != b]
    seeds = []
    for g, _ in genes:
        if not any(a in seeds and b == g for a, b in listed):
            seeds.append(g)
    got = G.homology_seeds(spark.createDataFrame(genes, "gene string, ord int"), spark.createDataFrame(listed, "gene string, paralog string")).orderBy("ord").collect()
    assert [r.gene for r in got] == seeds
