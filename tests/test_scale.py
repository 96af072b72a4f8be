"""Splits, ranges, blocks, chains: what cuts large keys must not be seen in the result."""

import glob
import hashlib
import os
import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandlake import fixtures as X
from strandlake import session as S
from strandlake.functions import sequence as Q
from strandlake.operators import chains as C
from strandlake.operators import genomics as G
from strandlake.operators import headers as N
from strandlake.operators import hits as H
from strandlake.plans import hits as HITS_PLAN
from strandlake.plans.files import QUERIES as FILES
from strandlake.plans.genomics import QUERIES as GENOMICS
from strandlake.operators import profile as P
from strandlake.operators.scan import kept, look_back, placed_back, with_place
from strandlake.session import fresh
from strandlake.sinks import text as W_
from strandlake.sources import calls as RC
from strandlake.sources import search as RS
from strandlake.sources import tables as RT
from strandlake.sources.text import placed_lines, sections


def rows(df):
    return sorted(map(str, df.collect()))


def in_small_splits(spark, lines, read):
    """What `read` makes of one file of the lines, whole and in splits of some hundred bytes."""
    path = fresh(spark, "splits")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    whole = read(path)
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = placed_lines(spark, path).select("split").distinct().count()
        cut = read(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return whole, cut, n


def test_sections_in_small_splits(spark):
    rng = random.Random(1)
    lines, want, head = ["above"], [(None, "above")], None
    for i in range(400):
        if rng.random() < 0.02:
            head = f"part {i}"
            lines.append(">" + head)
        else:
            lines.append("" if rng.random() < 0.1 else f"line {i} " + "x" * rng.randrange(60))
            want += [(head, lines[-1])] * (lines[-1] != "")
    whole, cut, n = in_small_splits(spark, lines, lambda p: sorted((str(r.head), r.line) for r in sections(spark, p, ">").collect()))
    assert n > 20 and whole == cut == sorted((str(h), x) for h, x in want)


def test_readers_in_small_splits(spark):
    glimmer = [x for c in range(3) for x in [f">contig{c}", *[f"orf{i} {i * 9 + 1} {i * 9 + 90} +1 7.5" for i in range(60)]]]
    cgc = [x for c in ("glimmer", "mystery", "rast") for x in [f"# {c} gene calls", *[f"{i}\t+\t{i}\t{i + 89}\t90\tc" for i in range(1, 50)]]]
    tables = [x for f in range(8) for x in [f"#VOG{f}: has {f * 4} proteins from 2 genomes", *[f"VOG{f}\tspecies\tNC_1\tACC{i}\t1..9\t1" for i in range(f * 5)]]]
    paralogs = [x for g in range(2) for x in [f"PARALOGS for genome /data/g{g}.fasta", *[y for k in ("Gene", "Protein") for y in [f"{k} Paralogs", *[z for i in range(30) for z in (f"query:a{i}\tsubject:b{i}\tgene_paralog\t9{i % 10}", f"coverage:{i}" if i % 9 else "no coverage")]]]]]
    for text, read in ((glimmer, RC.glimmer), (cgc, RC.cgc), (tables, RT.family_tables), (paralogs, RT.paralog_report)):
        for rejects in (False, True):
            whole, cut, n = in_small_splits(spark, text, lambda p, read=read, rejects=rejects: rows(read(spark, p, rejects=rejects).drop("file")))
            assert n > 3 and whole == cut
        assert read is not RT.paralog_report or len(cut) == 2 * 2 * 4
    whole, _, _ = in_small_splits(spark, paralogs, lambda p: {(r.genome, r.mol_type, r.gene, r.coverage) for r in RT.paralog_report(spark, p).collect()})
    assert whole == {(f"g{g}", k, f"a{i}", float(i)) for g in range(2) for k in ("gene", "protein") for i in range(30) if i % 9}


def test_places_by_ranges(spark):
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.8 else rng.choice("abc"), rng.randrange(50), i) for i in range(3_000)]
    table = kept(spark.createDataFrame(data, "k string, o int, i int"), "t")
    for keys in (["k"], []):
        want = table.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*keys, "o", "i")).cast("long"))
        assert rows(with_place(table, keys, ["o", "i"], "place").select(*want.columns)) == rows(want)
    assert with_place(table.limit(0), ["k"], ["o"], "place").count() == 0


def test_look_back_over_blocks(spark):
    rng = random.Random(3)
    data = [(k, i, rng.choice([None, None, None, i]), rng.choice([None, k])) for k in ("a", "b") for i in range(1, 60)]
    df = spark.createDataFrame(data, "k string, place int, v int, s string")
    order = W.partitionBy("k").orderBy("place")
    want = df.withColumn("prev", F.lag("v").over(order)).withColumn("prev_s", F.lag("s").over(order)).withColumn("seen", F.last("v", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    for block in (1, 4, 7, 1000):
        assert rows(look_back(df, ["k"], "place", {"prev": F.col("v"), "prev_s": F.col("s")}, {"seen": F.col("v")}, block)) == rows(want)


def test_seeds_of_long_chains_and_of_random_listings(spark):
    def greedy(n, listed):
        lost, out = set(), []
        for i in range(n):
            if i not in lost:
                out.append(i)
                lost |= listed.get(i, set())
        return out

    rng = random.Random(4)
    chain = {i: {i + 1} for i in range(999)}
    mixed = {i: {j for j in (i + rng.randrange(-3, 6) for _ in range(rng.choice([0, 1, 1, 2]))) if j != i and 0 <= j < 200} for i in range(200)}
    for n, listed in ((1000, chain), (200, mixed)):
        genes = spark.createDataFrame([(str(i), i) for i in range(n)], "gene string, ord int")
        found = G.homology_seeds(genes, spark.createDataFrame([(str(a), str(b)) for a, bs in listed.items() for b in bs], "gene string, paralog string"))
        assert [r.ord for r in found.orderBy("ord").collect()] == greedy(n, listed)
        assert max(int(f.split("round=")[1].split("/")[0]) for f in found.inputFiles()) <= 14


def sequence(rng, n):
    return "".join(rng.choice("acgt") for _ in range(n))


def edited(rng, seq, every):
    out = []
    for i, c in enumerate(seq):
        if i % every == every // 2:
            out.append({0: c + rng.choice("acgt"), 1: "", 2: rng.choice("acgt".replace(c, ""))}[rng.randrange(3)])
        else:
            out.append(c)
    return "".join(out)


def test_chains_find_planted_copies(spark):
    rng = random.Random(5)
    base = [sequence(rng, 600) for _ in range(30)]
    data = [(f"base{i:02}", s) for i, s in enumerate(base)]
    data += [(f"copy{i:02}", sequence(rng, rng.randrange(50)) + edited(rng, s, 45) + sequence(rng, 30)) for i, s in enumerate(base)]
    data += [("same", base[0]), ("same too", base[0]), ("short", "acgt"), ("none", None), ("empty", ""), (None, base[1]), ("base00", base[0])]
    df = spark.createDataFrame(data, "contig string, seq string")
    hits = C.chained_hits(df).collect()
    pairs = {(r.q, r.s) for r in hits}
    assert all((f"base{i:02}", f"copy{i:02}") in pairs and (f"copy{i:02}", f"base{i:02}") in pairs for i in range(30))
    longest = {p: max(r.q_end - r.q_start + 1 for r in hits if (r.q, r.s) == p) for p in pairs}
    assert sum(longest[f"base{i:02}", f"copy{i:02}"] > 500 for i in range(30)) >= 29  # one chain over insertions and deletions
    assert any(r.gap_opens > 5 for r in hits) and all(r.q_end - r.q_start + 1 <= r.aln_len and 0 < r.identity <= 100 for r in hits)
    classes = {r.contig: r["class"] for r in C.sequence_classes(df).collect()}
    assert classes["same"] == classes["same too"] == classes["base00"] == "base00" and classes["short"] == "short" and "none" not in classes
    old = {(classes[r.q], classes[r.s]) for r in H.kmer_hits(df.where("contig IS NOT NULL")).collect()}
    old = {(a, b) for a, b in old if a != b}
    assert len(old & pairs) >= 0.95 * len(old) > 0


def test_minimizers_of_pieces_are_those_of_the_whole(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([("a", sequence(rng, 900)), ("b", "ac" * 300), ("c", sequence(rng, 18))], "contig string, seq string")
    assert rows(C.minimizers(df, span=37)) == rows(C.minimizers(df, span=10_000))


def test_packed_files_are_few_and_hold_every_key(spark):
    rng = random.Random(7)
    data = [(f"k{rng.choice([0, 0, 0, rng.randrange(300)])}", i, "é" * rng.randrange(1, 40)) for i in range(3_000)]
    path = fresh(spark, "packed")
    index = W_.write_packed(spark.createDataFrame(data, "key string, i int, value string"), path, ["key"], ["i"], 10_000).collect()
    n_bytes = sum(len(v.encode()) + 1 for *_, v in data)
    assert len({r.file for r in index}) <= n_bytes // 10_000 + 1 and max(r.part for r in index) > 5 and sum(r.length for r in index) == n_bytes
    found = {}
    for r in sorted(index, key=lambda r: (r.key, r.part)):  # as another program reads them
        (name,) = glob.glob(f"{path}/text/file={r.file}/part-*")
        with open(name, "rb") as f:
            f.seek(r.start)
            found[r.key] = found.get(r.key, b"") + f.read(r.length)
    want = {}
    for k, _, v in sorted(data, key=lambda x: x[1]):
        want[k] = want.get(k, b"") + v.encode() + b"\n"
    assert found == want
    assert {(r.key, r.part): r.text for r in W_.read_packed(spark, path).collect()}.keys() == {(r.key, r.part) for r in index}


def test_packed_texts_are_cut_and_digested_as_streams(spark):
    """A key of many parts among small ones, values of several lines, empty lines; before, a key's text was one row."""
    rng = random.Random(11)
    data = [(0 if i % 2 else i, i, rng.choice(["", ">a\nacgt", "é" * rng.randrange(30)])) for i in range(4_000)]
    path = fresh(spark, "packed")
    W_.write_packed(spark.createDataFrame(data, "key int, i int, value string"), path, ["key"], ["i"], 5_000)
    want = {}
    for k, _, v in sorted(data):
        want[str(k)] = want.get(str(k), "") + v + "\n"
    found = W_.text_digests(W_.packed_lines(spark, path), "key")
    assert {r.key: (r.n_lines, r.digest) for r in found.collect()} == {k: (v.count("\n"), hashlib.sha256(v.encode()).hexdigest()) for k, v in want.items()} and found.count() == len(want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(line" not in plan and "sha2" not in plan
    texts = {}
    for r in W_.read_packed(spark, path).orderBy("key", "part").collect():
        texts[str(r.key)] = texts.get(str(r.key), "") + r.text
    assert texts == want


def test_groups_and_profiles_are_packed_not_foldered(spark):
    """A folder a group or family made their number, and the time to list them, follow the keys."""
    before = set(glob.glob(f"{S.scratch(spark).removeprefix('file:')}/*"))
    for name in ("emit_group_fasta", "emit_group_annotations", "concat_profiles"):
        assert FILES[name](spark, "/root/testdata/sf0.001").count() > 0
    new = set(glob.glob(f"{S.scratch(spark).removeprefix('file:')}/*")) - before
    assert not [f for top in new for f in glob.glob(f"{top}/group_no=*") + glob.glob(f"{top}/family_id=*")]


def test_records_in_texts_are_those_of_files(spark):
    texts = [">a b\nAC gt\n\n12*\n>none\n>c\nttt\n", "above\n>d\na\n", ">e\n", ""]
    path = fresh(spark, "records")
    spark.createDataFrame([(x,) for x in texts], "value string").write.option("maxRecordsPerFile", 1).text(path)
    got = RT.fasta_texts(spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, text string")).collect()
    assert sorted((r.header, r.seq) for r in got) == sorted((r.header, r.seq) for r in RT.fasta(spark, path).collect())


def test_lines_of_search_tables_are_split_once(spark):
    """Before, each column's check split the line again."""
    path = fresh(spark, "search")
    spark.createDataFrame([("t - 90 q - 90 1e-5 5 0.1 1 2 1e-3 1e-4 4 0.2 1 9 1 9 1 9 0.9 tail fiber",), ("q\ts\t99\t90\t0\t0\t1\t90\t1\t90\t1e-3\t50",), ("no row",)], "value string").coalesce(1).write.text(path)
    for read, n in ((RS.blast_tab, 1), (RS.hmm_domtbl, 1), (lambda s, p: RS.blast_list(s, p, "q"), 1)):
        found = read(spark, path)
        assert found.count() == n and found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert RS.blast_tab(spark, path, rejects=True).count() == RS.hmm_domtbl(spark, path, rejects=True).count() == 2


def test_hits_are_shuffled_once_for_best_ones(spark):
    plan = H.best_hits(X.candidates(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(q_gene#") == 1 and "hashpartitioning(q_genome" not in plan


def test_kmers_are_shuffled_with_numbers(spark):
    """Before, each k-mer and each pair of places went with digests of 64 letters."""
    rng = random.Random(12)
    base = sequence(rng, 80)
    seqs = spark.createDataFrame([("a", base), ("b", base[:60] + sequence(rng, 20)), ("c", base)], "contig string, seq string")
    found = H.kmer_hits(seqs)
    assert {(r.q, r.s) for r in found.collect()} == {(x, y) for x in "abc" for y in "abc" if x != y}
    assert "no#" in found._jdf.queryExecution().optimizedPlan().toString()


def test_best_hits_are_ranked_once(spark):
    """Before, the hits were ranked for both sides of the join."""
    found = H.mutual_best_hits(H.best_hits(X.candidates(spark, "/root/testdata/sf0.001")))
    assert "Window" not in found._jdf.queryExecution().executedPlan().toString() and found.count() > 0


def test_numbered_rows_are_not_shuffled_again(spark):
    """Without broadcasts by size, rows still meet the small tables of range starts and block ends where they are."""
    table = kept(spark.range(2_000).selectExpr("id % 3 AS k", "id AS o", "nullif(id % 5, 0) AS v"), "t")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        placed = with_place(table, ["k"], ["o"], "place")
        seen = look_back(placed, ["k"], "place", {"prev": F.col("o")}, {"last": F.col("v")}, 100)
        assert not any("SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString() for df in (placed, seen))
        order = W.partitionBy("k").orderBy("o")
        want = table.select("*", F.lag("o").over(order).alias("prev"), F.last("v", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("last"))
        assert rows(seen.drop("place")) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_edges_of_repeated_turned_and_own_rows(spark):
    data = [("g0", "c", "cds1/", "g1", "c", "cds2/", "genome1_mutual"), ("g0", "c", "cds1/", "g1", "c", "cds2/", "genome2_mutual"), ("g1", "c", "cds2/", "g0", "c", "cds1/", "genome1_mutual"), ("g0", "c", "cds1/", "g0", "c", "cds1/", "genome1_singular"), ("g0", "c", "x", "g1", None, None, "genome1_loner")]
    found = G.load_genome_hits(spark.createDataFrame(data, "genome1 string, g1_contig string, g1_header string, genome2 string, g2_contig string, g2_header string, row_type string"))
    assert found.columns == ["gene", "genome", "gene_no", "partner", "partner_genome", "kind"]
    assert sorted(map(tuple, found.collect())) == [("g0:c:cds1/", "g0", 1, "g0:c:cds1/", "g0", "singular"), ("g0:c:cds1/", "g0", 1, "g1:c:cds2/", "g1", "mutual"), ("g1:c:cds2/", "g1", 2, "g0:c:cds1/", "g0", "mutual")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0  # before, both ways were shuffled


def test_top_hits_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("g", i % 3, "h", i, float(i)) for i in range(50)], "q_genome string, q_gene int, s_genome string, s_gene int, bitscore double")
    plan = H.top_hits(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit", plan.index("Exchange")) > 0  # below the exchange: at most two rows a query and task are shuffled
    assert len(H.top_hits(df, 2).collect()) == 6


def test_many_patterns_find_what_one_by_one_finds(spark):
    rng = random.Random(8)
    heads = [(rng.choice("ab"), rng.randrange(9), "".join(rng.choice("xyz|é ") for _ in range(rng.randrange(30)))) for _ in range(200)] + [("a", 1, None), ("a", 2, "")]
    wanted = ["".join(rng.choice("xyz|é ") for _ in range(rng.choice([1, 2, 5, 6, 7, 9]))) for _ in range(150)] + ["", None, "nothing holds this"]
    wanted += [h[2][3:15] for h in heads[:20] if h[2]] * 2
    got = N.find_by_headers(spark.createDataFrame(heads, "contig string, ord int, header string"), spark.createDataFrame([(w,) for w in wanted], "pattern string")).collect()
    want = {(w, c, *min((o, h) for d, o, h in heads if d == c and h and w in h)) for w in set(wanted) if w for c in "ab" if any(d == c and h and w in h for d, _, h in heads)}
    assert {tuple(r[c] for c in ("pattern", "contig", "ord", "header")) for r in got} == want and len(got) == len(want) > 50


def test_search_for_many_patterns_broadcasts_none(spark, monkeypatch):
    """Plans take the substrings of a small file for a small table; at 1.2 million patterns they didn't fit the driver."""
    plans, keep = [], N.kept
    monkeypatch.setattr(N, "kept", lambda df, label: plans.append(df) or keep(df, label))
    heads = spark.range(200).selectExpr("'c' AS contig", "cast(id AS int) AS ord", "concat('>gi|', id, '|') AS header")
    plans.append(N.find_by_headers(heads, spark.range(100).selectExpr("concat('gi|', id, '|') AS pattern")))
    assert plans[-1].count() == 100
    assert not any("Broadcast" in df._jdf.queryExecution().executedPlan().toString() for df in plans)


def test_names_that_lead_to_one_another(spark):
    pairs = [(f"n{i:03}", f"n{i + 1:03}") for i in range(100)] + [("z", "y"), ("y", "z"), ("q", "q"), (None, "q"), ("n050", "a")]
    got = {r.name: r["class"] for r in N.name_classes(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert all(got[f"n{i:03}"] == "a" for i in range(101)) and got["z"] == got["y"] == "y" and got["q"] == "q" and len(got) == 105
    assert N.name_classes(spark.createDataFrame([], "a string, b string")).count() == 0


def test_tags_by_any_name(spark):
    rows = [(">old1|x", "s"), (">ACC1.7 y", "s"), (">nobody", None), (">old1|x", "s"), (None, "t"), (">ACC2,ACC1", "u")]
    seqs, members = spark.createDataFrame(rows, "header string, seq string"), spark.createDataFrame([("V2", "ACC1.2"), ("V1", "ACC1"), ("V3", "ACC2"), ("V4", None)], "family_id string, accession string")
    tagged = N.tag_by_any_name(seqs, members, spark.createDataFrame([("old1", "mid.1"), ("mid", "ACC1")], "a string, b string"))
    assert sorted((str(r.header), r.tag) for r in tagged.collect() if r.tag) == [(">ACC1.7 y", "V1|V2"), (">ACC2,ACC1", "V1|V2|V3"), (">old1|x", "V1|V2"), (">old1|x", "V1|V2")]
    assert tuple(N.tagging_share(tagged).first()) == (6, 4, 0.3333)


def test_gene_numbers_follow_the_file(spark):
    rng = random.Random(9)
    calls = [(f"c{rng.randrange(3)}", rng.randrange(1, 5000)) for _ in range(300)]
    gff = [f"{c}\ttool\tCDS\t{left}\t{left + 89}\t.\t+\t0\t." for c, left in calls]
    whole, cut, n = in_small_splits(spark, gff, lambda p: sorted((r.contig, r.gene_no, r.left_end) for r in RC.gff3(spark, p).collect()))
    want = sorted((c, i + 1, left) for k in {c for c, _ in calls} for i, (c, left) in enumerate([x for x in calls if x[0] == k]))
    assert n > 20 and whole == cut == want


def test_selected_rows_are_those_of_wanted_ids(spark):
    """Against a plain semi-join, with repeats, nulls and no wanted id; few unwanted rows pass the filter."""
    rows = spark.range(40_000).selectExpr("CASE WHEN id % 1000 = 0 THEN NULL ELSE concat('id', id % 30000) END AS contig", "repeat('acgt', cast(id % 7 AS int)) AS seq", "id AS _other")
    wanted = spark.range(0, 60_000, 11).selectExpr("CASE WHEN id = 0 THEN NULL ELSE concat('id', id) END AS contig", "id AS seq").union(spark.createDataFrame([("id5", 1), ("id5", 1)], "contig string, seq long"))
    got = Q.select_by_id(rows, wanted, "contig")
    want = rows.join(wanted.select("contig").distinct(), "contig", "left_semi")
    assert got.columns == rows.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*rows.columns).collect()))
    ids = S.kept(wanted.select("contig").where("contig IS NOT NULL").distinct(), "ids")
    passed = Q.likely_wanted(rows, ids, "contig")
    assert want.count() <= passed.count() <= want.count() + 0.03 * rows.count()
    assert "Exchange hashpartitioning" not in "".join(line for line in passed._jdf.queryExecution().executedPlan().toString().splitlines() if "contig" in line)
    assert Q.select_by_id(rows, wanted.limit(0), "contig").count() == 0 and Q.select_by_id(rows.limit(0), wanted, "contig").count() == 0


SMALL = "/root/testdata/sf0.001"


def written(spark, label):
    return set(glob.glob(f"{S.scratch(spark).removeprefix('file:')}/{label}-*"))


def test_xml_of_hits_is_written_compressed(spark):
    before = written(spark, "xml")
    n = FILES["ingest_blast_xml"](spark, SMALL).count()
    (path,) = written(spark, "xml") - before
    assert n > 1000 and sum(os.path.getsize(f) for f in glob.glob(f"{path}/part-*")) < 200 * n


def test_profile_rows_are_those_of_the_profile_and_edges_sort_nothing(spark):
    best, genes = H.best_hits(X.candidates(spark, SMALL)), X.genome_genes(spark, SMALL)
    notes = genes.where("gene % 4 = 0").selectExpr("genome", "gene", "concat('protein ', gene) AS annotation")
    assert rows(H.profile_rows(best, genes, notes)) == rows(H.merge_profile(best, genes, notes).drop("ord"))
    before = written(spark, "ranges")
    assert GENOMICS["load_genome_hits"](spark, SMALL).count() > 1000
    assert written(spark, "ranges") == before


def test_hits_of_one_genome_are_those_among_all(spark):
    all_of, some = X.candidates(spark, SMALL), X.candidates(spark, SMALL, 0)
    assert rows(some) == rows(all_of.where("q_genome = 'genome0' OR s_genome = 'genome0'")) != []
    assert rows(X.own_hits(spark, SMALL, 1)) == rows(X.hits(spark, SMALL).where("q_genome = 'genome1' AND s_genome = 'genome1'")) != []
    assert rows(G.load_genome_hits(H.profile_rows(H.best_hits(some), X.genome_genes(spark, SMALL))).where("genome = 'genome0'")) == rows(GENOMICS["load_genome_hits"](spark, SMALL).where("genome = 'genome0'"))


def test_lists_are_collected_once(spark):
    edges = spark.createDataFrame([("a", "x", "b", "mutual"), ("a", "x", "b", "mutual"), ("a", "x", "c", "mutual"), ("a", "x", None, "mutual")], "gene string, genome string, partner string, kind string")
    found = G.hit_lists(edges, "mutual")
    assert [tuple(r) for r in found.collect()] == [("a", "x", 2, "b,c")]
    assert "distinct" not in found._jdf.queryExecution().executedPlan().toString()


def test_digests_of_packed_pieces(spark):
    rng = random.Random(5)
    data = [(f"key {k}", i, "".join(rng.choice("abé\n") for _ in range(rng.randrange(60)))) for k in range(40) for i in range(300 if k < 3 else 4)]
    path = fresh(spark, "pieces")
    W_.write_packed(spark.createDataFrame(data, "key string, i int, value string"), path, ["key"], ["i"], 3_000)
    want = {}
    for key, _, text in data:
        want[key] = want.get(key, b"") + (text + "\n").encode()
    for piece in (1, 100, 1 << 16):
        found = W_.packed_digests(spark, path, piece).collect()
        assert {r.key: (r.n_lines, r.digest) for r in found} == {k: (t.count(b"\n"), hashlib.sha256(t).hexdigest()) for k, t in want.items()} and len(found) == 40


def test_alerts_ask_for_no_annotations(spark, monkeypatch):
    monkeypatch.setattr(HITS_PLAN, "_annotations", lambda s, d: 1 / 0)
    assert HITS_PLAN.QUERIES["profile_alerts"](spark, SMALL).count() > 1000


def test_edges_make_no_loners_and_read_genes_once(spark):
    """Before, the hits were classified once more for loners that edges then left out, and each side grouped the lines for its genes."""
    plan = GENOMICS["load_genome_hits"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "l_partkey" not in plan
    best, genes = H.best_hits(X.candidates(spark, SMALL)), X.genome_genes(spark, SMALL)
    assert rows(H.profile_rows(best, genes, loners=False)) == rows(H.profile_rows(best, genes).where("row_type NOT LIKE '%loner'")) != []


def test_best_hits_are_ranked_as_numbers(spark):
    """Before, hits were sorted with names and alignments."""
    found = HITS_PLAN.QUERIES["best_hits"](spark, SMALL)
    want = H.best_hits(X.candidates(spark, SMALL))
    assert found.columns == want.columns and rows(found) == rows(want) != []
    ranked = found._jdf.queryExecution().optimizedPlan().toString().split("Window ", 1)[1]
    assert "aln_len" not in ranked and "concat(genome" not in ranked


def test_rounds_of_seeds_write_three_tables(spark):
    before = written(spark, "seeds")
    genes = spark.createDataFrame([(str(i), i) for i in range(9)], "gene string, ord int")
    found = G.homology_seeds(genes, spark.createDataFrame([(str(i), str(i + 1)) for i in range(8)], "gene string, paralog string"))
    assert [r.ord for r in found.orderBy("ord").collect()] == [0, 2, 4, 6, 8]
    made = written(spark, "seeds") - before
    assert len([p for p in made if "seeds-open" in p]) == 1  # what is left is the last, empty table of terms


def test_reports_of_large_pairs_are_several_files_in_order(spark):
    """Before, one task sorted and wrote a pair's whole report."""
    rng = random.Random(13)
    data = [(p, m, i, "é" * rng.randrange(9)) for p in ("a-b", "a-c") for m in (1, 2) for i in range(-1, 800 if p == "a-b" else 3)]
    rng.shuffle(data)
    table = kept(spark.createDataFrame(data, "pair string, section int, ord long, text string").withColumn("value", F.when(F.col("ord") < 0, F.concat(F.lit("#"), F.element_at(F.array(F.lit("GENE HITS"), F.lit("PROTEIN HITS")), F.col("section")))).otherwise(F.concat_ws("\t", "ord", *[F.lit("x")] * 28, "text"))), "t")
    path = W_.write_lines(W_.ranged_files(table, "pair", *W_.PROFILE_ORDER), fresh(spark, "ranged"), "pair", per_file=150)
    for pair in ("a-b", "a-c"):
        files = sorted(glob.glob(f"{path}/pair={pair}/part-*"))
        text = [x for f in files for x in open(f, encoding="utf-8").read().splitlines()]
        assert text == [r.value for r in table.where(F.col("pair") == pair).orderBy(*W_.PROFILE_ORDER).collect()] and (pair == "a-c" or len(files) > 5)
    found = RT.profile_report(spark, f"{path}/*", joined=True).select("mol_type", "sort_pos").collect()
    assert sorted(map(tuple, found)) == sorted(("gene" if m == 1 else "protein", i) for _, m, i, _ in data if i >= 0)


def test_rows_are_placed_and_look_back_by_one_sort(spark):
    rng = random.Random(20)
    data = [(k, rng.choice([None, "a", "b"]), rng.choice([None, *range(40)]), i, rng.choice([None, 1, 2, 3])) for i, k in enumerate("xxxxxxxy" * 60)]
    table = kept(spark.createDataFrame(data, "k string, c string, o int, i int, v int"), "t")
    order, lag, last = [F.col(c) for c in ("c", "o", "i")], {"prev": F.col("v"), "prev_w": F.col("w")}, {"seen": F.col("w")}
    derive = lambda df: df.withColumn("w", F.col("v") * 10)
    want = rows(look_back(derive(with_place(table, ["k"], order, "place")), ["k"], "place", lag, last).select("k", "i", "place", "prev", "prev_w", "seen", "w"))
    for bins in ([F.col("c"), F.floor(F.col("o") / 3)], [F.col("c")], [F.lit(0)]):
        assert rows(placed_back(table, ["k"], bins, order, "place", lag, last, derive).select("k", "i", "place", "prev", "prev_w", "seen", "w")) == want
    assert placed_back(table.limit(0), ["k"], bins, order, "place", lag, last, derive).count() == 0


def test_alerts_write_profiles_once(spark):
    """Before, rows were written before and after they were sorted into ranges, and sorted once more to look back."""
    before = written(spark, "ranges"), written(spark, "profile-rows")
    assert HITS_PLAN.QUERIES["count_differences"](spark, SMALL).count() == 6 and HITS_PLAN.QUERIES["query_profiles"](spark, SMALL).count() > 100
    assert (written(spark, "ranges"), written(spark, "profile-rows")) == before
    profile = HITS_PLAN._completed(HITS_PLAN._profile(spark, SMALL).select("genome1", "genome2", "ord", "row_type", "gene1", "gene2", "bitscore", "g1_start", "g1_end", "g2_start", "g2_end", "g1_coverage", "g2_coverage"))
    want = P.query_profiles(P.profile_alerts(profile, 70), codes=("b", "c", "m")).select(*HITS_PLAN.COLUMNS, "alerts")
    assert rows(HITS_PLAN._alerted(spark, SMALL, codes=("b", "c", "m")).select(*HITS_PLAN.COLUMNS, "alerts")) == rows(want) != []


def test_profiles_of_unknown_and_repeated_genes(spark):
    """Hits of genes that no table has, genes that stand twice, genomes without hits."""
    best = spark.createDataFrame([("g0", "g1", 1, 5, 90), ("g1", "g0", 5, 1, 90), ("g0", "g1", 2, 5, 80), ("g1", "g0", 6, 2, 70), ("g0", "g1", 3, 7, 60), ("g1", "g0", 9, 1, 50), ("g0", "g3", 4, 1, 40), ("g2", "g0", 8, 1, 30)], "q_genome string, s_genome string, q_gene int, s_gene int, bitscore long")
    best = X.with_alignment(best.withColumn("identity", F.lit(90)))
    genes = spark.createDataFrame([("g0", i, "c", i * 90, i * 90 + 89, "+") for i in (1, 2, 2, 3, 4)] + [("g1", i, "c", i * 90, i * 90 + 89, "-") for i in (5, 6, 7)], "genome string, gene int, contig string, start int, end int, strand string")
    found = H.profile_rows(best, genes)
    tagged, names = H.classify_hits(best), ("genome1", "genome2", "row_type", "gene1", "gene2")
    used = tagged.where("kind = 'singular' OR kind = 'mutual' AND q_genome < s_genome")
    forward = F.col("q_genome") < F.col("s_genome")
    pick = lambda a, b: F.when(forward, F.col(a)).otherwise(F.col(b))
    want = [tuple(r) for r in used.select(pick("q_genome", "s_genome"), pick("s_genome", "q_genome"), F.concat(F.when(forward, "genome1_").otherwise("genome2_"), "kind"), pick("q_gene", "s_gene"), pick("s_gene", "q_gene")).collect()]
    for r in H.loners(genes, best).collect():
        want.append((r.genome, r.other, "genome1_loner", r.gene, None) if r.genome < r.other else (r.other, r.genome, "genome2_loner", None, r.gene))
    twice = [w for w in want if w[0] == "g0" and w[3] == 2]
    assert sorted(map(str, want + twice)) == sorted(str(tuple(r)) for r in found.select(*names).collect())
    assert {(r.gene1, r.g1_header, r.g2_header) for r in found.where("gene2 = 9").collect()} == {(1, "cds1/+/90/179/", None)}


def test_gene_lists_give_what_edges_give(spark):
    """Before, the reports shuffled the edges once for each list, and own hits were joined by the names of genomes."""
    profile = H.profile_rows(H.best_hits(X.candidates(spark, SMALL)), X.genome_genes(spark, SMALL))
    genes = profile.select(F.explode(F.array(*[F.struct(F.concat_ws(":", f"genome{i}", f"g{i}_contig", f"g{i}_header").alias("gene"), F.col(f"genome{i}").alias("genome"), F.col(f"gene{i}").alias("no")) for i in "12"])).alias("e")).select("e.*").where("no IS NOT NULL").drop("no").distinct()
    genes = kept(genes.unionByName(spark.createDataFrame([("genome9:x", "genome9")], "gene string, genome string")), "t")
    lists, edges = G.gene_lists(profile.unionByName(profile), genes), G.load_genome_hits(profile)
    for kind in ("mutual", "singular"):
        assert rows(G.listed(lists, kind)) == rows(G.hit_lists(edges, kind)) != []
    assert rows(G.listed_edges(lists)) == rows(edges.select("gene", "partner").distinct()) and rows(G.listed_loners(lists)) == rows(G.genomic_loners(genes, edges)) != []
    some = genes.where("genome <> 'genome9'")
    assert rows(G.listed_core(lists, some, "genome1")) == rows(G.core_genome(edges, some, "genome1")) and rows(G.listed_correspondences(lists, "genome0")) == rows(G.correspondences(edges, "genome0")) != []
    plan = H.paralogs(X.own_hits(spark, SMALL), X.genome_genes(spark, SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Join Inner" in line and "(concat(genome" in line for line in plan.split("\n"))
    before = written(spark, "edges")
    FILES["emit_genomics_reports"](spark, SMALL)
    assert written(spark, "edges") == before
