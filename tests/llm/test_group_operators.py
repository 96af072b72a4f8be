"""Vector dedup, n-gram join, mixing, WARC, decontamination, pipeline: brute force and edge cases."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandlake.llm import decontamination, mixing, ngram_join, vectors, warc
from strandlake.llm.common import fresh
from strandlake.llm.graphs import components

WORDS = [f"w{i}" for i in range(400)]


def brute_components(sets, percent=75):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def shingles(text, n=5):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


@pytest.mark.parametrize("above", [1, 3, 32])
def test_ngram_join_equals_brute_force(spark, above):
    """Chains of edits, a common passage in most texts, and low thresholds so that tokens are frequent and combined."""
    rng = random.Random(above)
    passage = " ".join(rng.choices(WORDS, k=40))
    texts = [None, "", " \t\n", "One two", "one TWO", "a b c d e", "É é", "x " * 3000]
    for _ in range(12):
        words = rng.choices(WORDS, k=rng.randint(8, 120))
        for _ in range(rng.randint(1, 9)):
            texts.append(" ".join(words) + (" " + passage if rng.random() < 0.6 else ""))
            words = list(words)
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
    texts += [passage + " " + " ".join(rng.choices(WORDS, k=4)) for _ in range(25)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n string").repartition(5)
    got = {r.doc_id: r for r in ngram_join.near_duplicates(docs, frequent_above=above, star_above=3).collect()}
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(sets)


def test_ngram_join_edges(spark):
    docs = spark.createDataFrame([(None, "a b"), (2, "a b"), (2, "a b"), (1, "A  B")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect())
    assert got == [(0, 1, None), (1, 1, 1), (2, 1, 1), (2, 1, 1)]
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}
    assert components(edges.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [b + rng.normal(size=16) * s for b in base for s in (0, 0.02, 0.05, 0.1, 0.3)] + [base[0] * 2, base[0]]
    x = np.array(rows, np.float32).astype(float)
    n = len(x)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0]]
    data = [(i, [float(v) for v in r], i) for i, r in enumerate(x)] + [(n + i, v, 0) for i, v in enumerate(odd)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>, rep int")
    found = vectors.near_vectors(table, shard_size=40)
    got = {r.vec_id: r for r in found.collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    sets = {i: frozenset(np.flatnonzero(near[i])) for i in range(n)}
    links = sum(len(s) - 1 for s in sets.values())
    assert sum(got[i].n_links for i in range(n)) >= 0.97 * links and all(got[i].n_links < len(sets[i]) for i in range(n))
    assert all(got[n + i].n_links == 0 and got[n + i].kept and got[n + i].component_id == n + i for i in range(len(odd)))
    assert vectors.audit(table, found, every=10) >= 0.9
    clash = table.withColumn("k1", F.lit("x")).union(table.limit(3).withColumn("k1", F.lit("y"))).union(spark.createDataFrame([(None, data[0][1], 0, "z")], "vec_id long, embedding array<float>, rep int, k1 string"))
    more = vectors.near_vectors(clash, shard_size=40).collect()
    assert len(more) == len(data) + 4 and [(r.n_links, r.component_id) for r in more if r.vec_id is None] == [(0, None)]
    assert all(r.component_id == got[r.vec_id].component_id for r in more if r.vec_id is not None)
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_large_blocks_are_searched_pairwise(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=8) + rng.normal(size=(2_500, 8)) * 0.01
    table = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.near_vectors(table, shard_size=10_000).toPandas()
    assert (got.component_id == 0).all() and (got.n_links == 2_499).mean() > 0.99


def test_targets_and_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), None if i % 10 == 0 else f"s{i % 4}", "x") for i in range(400)] + [(900, None, "s1", "x"), (901, "", "empty", "x"), (902, "w w", "s1", "y"), (902, "w w", "s1", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, whole string")
    mixed = mixing.mix_sources(docs).toPandas()
    assert len(mixed) == len(rows) and (mixed.taken <= 3 * mixed["size"]).all()
    sizes = mixed.fillna({"source": "~"}).groupby("source").agg(s=("source_size", "first"), t=("target", "first"), k=("taken", "sum"), n=("size", "sum"))
    assert (sizes.s == sizes.n).all() and (abs(sizes.k - sizes.t) <= 7).all() and abs(sizes.t.sum() - sizes.s.sum()) < 1e-6
    order = sorted(sizes.index)
    left = {s: float(sizes.n[s]) for s in order}
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        free = [s for s in order if s not in capped]
        level = (sum(left.values()) - sum(3 * left[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * left[s]}
        if not over:
            break
        capped |= over
    target = {s: 3 * left[s] if s in capped else level * weight[s] for s in order}
    assert all(abs(target[s] - sizes.t[s]) < 1e-6 for s in order)
    again = mixing.mix_sources(docs.repartition(7)).toPandas()
    assert sorted(zip(again.doc_id, again.taken)) == sorted(zip(mixed.doc_id, mixed.taken))
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mix_splits_equal_rows(spark):
    """A source of equal rows comes within a row of its target; helper names may be taken."""
    rows = [(1, "w w w", "a")] * 50 + [(i, "w " * (1 + i % 5), "b") for i in range(2, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).withColumn("_cut", F.lit("x")).withColumn("_cut_more", F.lit(1))
    mixed = mixing.mix_sources(docs).toPandas()
    assert len(mixed) == len(rows) and set(mixed["_cut"]) == {"x"} and (mixed.taken <= 3 * mixed["size"]).all()
    a = mixed[mixed.source == "a"]
    assert abs(a.taken.sum() - a.target.iloc[0]) <= 1.5 + 1e-6 and a.target.iloc[0] % 150 > 3
    long = mixing.mix_sources(spark.createDataFrame([(1, "long " * 400_000, "c")], docs.schema.simpleString()[7:-1].split(",_cut")[0].replace(":", " ")))
    assert [(r["size"], r.taken) for r in long.collect()] == [(400_000, 400_000)]


def test_warc_of_repeated_ids(spark):
    pages = spark.createDataFrame([(1, "A"), (2, "A"), (2, "BB"), (3, "BB"), (3, "BB"), (None, "A")], "page_id long, html string").withColumn("url", F.lit("http://a"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(spark, warc.write_archives(pages, fresh(spark, "w"))).collect())
    assert got == [(0, 1, "response", None), (1, 1, "response", None), (2, 1, "revisit", 1), (2, 2, "response", None), (3, 2, "revisit", 2), (3, 2, "revisit", 2)]


def test_warc_stops_at_an_unsound_header(spark):
    page = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %s\r\n\r\n%s\r\n\r\n"
    path = fresh(spark, "w")
    spark.createDataFrame([(bytearray(page % (1, b"1", b"a") + page % (2, b"x", b"b") + page % (3, b"1", b"c")),)], "value binary").select(F.col("value").cast("string")).write.option("lineSep", "\n").text(path)
    assert [r.page_id for r in warc.read_archives(spark, path).collect()] == [1]


def test_smaller_budgets_nest(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), "ab"[i % 2]) for i in range(300)], "doc_id long, text string, source string")
    taken = [{r.doc_id for r in mixing.mix_sources(docs, weights=w).where("source = 'a' AND taken > 0").collect()} for w in ((1, 9), (2, 5), (1, 1))]
    assert taken[0] < taken[1] < taken[2]


def test_warc_round_trip(spark):
    tricky = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
    htmls = ["<p>é</p>", "", None, "<p>é</p>", tricky, tricky, "x" * 300_000, "line\n\n\r\nend\r"]
    pages = spark.createDataFrame([(10 - i, None if i == 2 else f"http://a/{i}\r\nX: y", h, "z") for i, h in enumerate(htmls)], "page_id long, url string, html string, later string")
    got = {r.page_id: r for r in warc.read_archives(spark, warc.write_archives(pages, fresh(spark, "w"), file_bytes=1_000)).collect()}
    assert len(got) == len(htmls)
    groups = {}
    for i, h in enumerate(htmls):
        groups.setdefault(h or "", []).append(10 - i)
    for i, h in enumerate(htmls):
        r, body, first = got[10 - i], (h or "").encode(), min(groups[h or ""])
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if first == 10 - i else ("revisit", first))
    large = warc.read_archives(spark, warc.write_archives(pages, fresh(spark, "w"), least=1)).where("payload_bytes = 0")
    assert {r.record_type for r in large.collect()} == {"response"}
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0), fresh(spark, "w"))).count() == 0


def test_decontamination_tolerates_substitutions(spark):
    rng = random.Random(5)
    item = rng.choices(WORDS, k=40)
    changed = list(item)
    changed[7], changed[22], changed[33] = "x1", "x2", "x3"
    other = rng.choices(WORDS, k=200)
    texts = [" ".join(other[:50] + item + other[50:]), " ".join(other[:9] + changed), " ".join(w.upper() + "!" for w in item), " ".join(rng.sample(item, 40)), " ".join(other), None, "", "zz yy xx extra", "w " * 20_000 + " ".join(item[5:30])]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, at int")
    docs = docs.union(docs.limit(1))
    items = spark.createDataFrame([(1, " ".join(item), "h"), (2, "zz, yy xx", "h"), (3, None, "h"), (4, "", "h"), (5, " ".join(item), "h")], "item_id long, text string, h string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_overlaps(docs, items).collect()}
    assert got == {(d, i) for d in (0, 1, 2, 8) for i in (1, 5)} | {(7, 2)}
    assert {r.doc_id for r in decontamination.decontaminate(docs, items).collect()} == {3, 4, 5, 6}
    assert decontamination.find_overlaps(docs.limit(0), items).count() == 0 and decontamination.find_overlaps(docs, items.limit(0)).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).count() == len(texts) + 1


def test_decontamination_finds_passages_of_items(spark):
    """Verbatim passages of 13 to 22 tokens from the start, the inside and the end of an item, in other text."""
    rng = random.Random(6)
    item = [f"i{k}" for k in range(60)]
    other = lambda n: [f"o{rng.randrange(10**6)}" for _ in range(n)]
    texts, want = [], {}
    for n in range(13, 23):
        for start in (0, 19, 60 - n):
            before = rng.randint(0, 40)
            want[len(texts)] = (before, start, n)
            texts.append(" ".join(other(before) + item[start : start + n] + other(30)))
    texts.append(" ".join(other(20) + item[20:30] + other(20)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in decontamination.find_overlaps(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()}
    assert set(got) == set(want)
    for i, (at, start, n) in want.items():
        r = got[i]
        assert r.n_equal == n and r.doc_token - r.item_token == at - start and r.n_equal >= 0.8 * r.n_aligned
        assert r.doc_token <= at and at + n <= r.doc_token + r.n_aligned


@pytest.mark.parametrize("share", [0.8, 0.6])
def test_longest_stretch_equals_brute_force(spark, share):
    rng = random.Random(7)
    flags = [[rng.random() < p for _ in range(rng.randint(1, 40))] for p in (0.2, 0.7, 0.85, 1) for _ in range(25)]

    def brute(e):
        n = len(e)
        size, start = max(((j - i, -i) for i in range(n) for j in range(i, n + 1) if 10 * sum(e[i:j]) >= round(10 * share) * (j - i)))
        return (-start, size) if size else (0, 0)

    rows = spark.createDataFrame([(i, e) for i, e in enumerate(flags)], "i int, e array<boolean>").select("i", decontamination._longest(F.col("e"), share).alias("b")).collect()
    assert {r.i: tuple(r.b) for r in rows} == {i: brute(e) for i, e in enumerate(flags)}


def test_masks_hit_every_stretch():
    """The fewest replaced tokens that hide a stretch from all masks are more than a fifth of it."""
    masks = [(len(m), int(m, 2)) for m in decontamination.MASKS]
    keep = (1 << max(n for n, _ in masks)) - 1
    fewest = {0: 0}  # by the last tokens, 1 for an equal one
    for n in range(1, 161):
        longer = {}
        for last, replaced in fewest.items():
            for same in (0, 1):
                now = (last << 1 | same) & keep
                if not any(n >= size and now & mask == mask for size, mask in masks):
                    longer[now] = min(longer.get(now, n), replaced + 1 - same)
        fewest = longer
        assert n < 12 or 5 * min(fewest.values()) > n, n


def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(8)
    items = {i: [f"i{i}k{k}" for k in range(rng.choice([13, 16, 20, 30, 60]))] for i in range(120)}
    texts = {}
    for i, words in items.items():
        changed = list(words)
        at = range(i % 6, len(words), 6) if i < 40 else rng.sample(range(len(words)), len(words) // 5)
        for k in at:
            changed[k] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join([f"o{rng.randrange(10**6)}" for _ in range(30)] + changed + [f"o{rng.randrange(10**6)}" for _ in range(30)])
    docs, bench = (spark.createDataFrame([(i, t) for i, t in rows.items()], f"{key} long, text string") for key, rows in (("doc_id", texts), ("item_id", {i: " ".join(w) for i, w in items.items()})))
    got = {(r.doc_id, r.item_id) for r in decontamination.find_overlaps(docs, bench).collect()}
    share = {i: sum(w in texts[i].split() for w in words) / len(words) for i, words in items.items()}
    assert all(d == i for d, i in got) and {i for i in items if share[i] >= 0.8} <= {i for i, _ in got}


def test_decontamination_finds_substituted_short_items(spark):
    """Items of 1 to 12 tokens with a fifth of the tokens replaced, at each place or pair of places; one more hides them."""
    rng = random.Random(9)
    texts, items, want = {}, {}, set()
    for n in range(1, 13):
        for more in (0, 1):
            for out in rng.sample(places := list(itertools.combinations(range(n), n // 5 + more)), min(len(places), 25)):
                i = len(texts)
                items[i] = [f"i{i}k{k}" for k in range(n)]
                copy = [f"x{i}k{k}" if k in out else w for k, w in enumerate(items[i])]
                texts[i] = " ".join([f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(20))] + copy + [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(20))])
                want |= set() if more else {i}
    docs, bench = (spark.createDataFrame(list(rows.items()), f"{key} long, text string") for key, rows in (("doc_id", texts), ("item_id", {i: " ".join(w) for i, w in items.items()})))
    assert {(r.doc_id, r.item_id) for r in decontamination.find_overlaps(docs, bench).collect()} == {(i, i) for i in want}


def test_decontamination_of_very_long_items(spark):
    words = [f"w{k}" for k in range(20_000)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    found = decontamination.find_overlaps(docs, spark.createDataFrame([(1, " ".join(["x", *words[1:9_000], "y", *words[9_001:]]))], "item_id long, text string")).collect()
    assert [(r.doc_token, r.n_aligned, r.n_equal) for r in found] == [(0, 20_000, 19_998)]


def plain_stages(docs, labels, items, model):
    """The rows that each stage keeps, from pandas and SQL: quality text by text, copies by all pairs, the rest in DuckDB."""
    from collections import Counter

    import duckdb

    from strandlake.llm import quality
    from strandlake.llm.token_files import WordIds

    kept = []
    for r in docs.itertuples():
        one = [quality.text_features([(r.text or "").encode()]), quality.page_features(*[pd.Series([v]) for v in (r.source, r.lang, r.n_chars)])]
        kept.append(bool(r.text and r.text.strip()) and model.score(one)[0] >= model.cut)
    docs = docs[kept]
    yield docs
    comp = brute_components({r.doc_id: shingles(r.text) for r in docs.itertuples()})
    docs = docs[[comp[i] == i for i in docs.doc_id]]
    yield docs
    db = duckdb.connect()
    db.register("documents", docs)
    db.register("benchmark", items)
    docs = docs[~docs.doc_id.isin(db.execute(decontamination.SQL).fetchdf().doc_id)]
    yield docs
    db.register("documents", docs)
    mixed = db.execute(mixing.SQL).fetchdf().set_index("doc_id")
    copies = (mixed.taken // mixed["size"].clip(lower=1)).reindex(docs.doc_id).to_numpy()
    docs = docs.loc[np.repeat(docs.index, copies)]
    yield docs
    from strandlake.llm.common import tokenizer_file

    words = WordIds(tokenizer_file("word_bpe_49k.json"), 100)
    ids = {r.doc_id: [*words.model.encode(r.text, add_special_tokens=False).ids, 1] for r in docs.itertuples()}
    yield Counter((i, len(ids[i]), zlib.crc32(np.array(ids[i], "<u4").tobytes())) for i in docs.doc_id)


def test_pipeline_stages_equal_plain_versions(spark):
    from collections import Counter

    from strandlake.llm import quality

    sf_dir = "/root/testdata/sf0.001"
    docs, labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    plain = plain_stages(docs.toPandas().sort_values("doc_id"), labels.toPandas(), items.toPandas(), quality.fit(docs, labels))
    n = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.table(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns, name
        assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter(next(plain).doc_id), name
        docs = out
        n.append(docs.count())
    assert n[0] > n[1] >= n[2] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).toPandas().sort_values("start")
    assert Counter(zip(last.doc_id, last.n_tokens, last.ids_crc32)) == next(plain)
    assert last.start.tolist() == np.cumsum([0, *last.n_tokens])[:-1].tolist() and last.doc_id.is_monotonic_increasing


def test_pipeline_of_nulls_repeats_and_clashing_columns(spark, tmp_path):
    """Blank texts go in the first stage; rows without id stay; rows that repeat an id stay together; extra columns go."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    good = docs.where("doc_id IN (10, 11, 12, 13, 14, 15, 16, 17)").orderBy("doc_id")
    text = good.first().text
    odd = spark.createDataFrame([(9_001, None, None, None, None), (9_002, "", "en", "a", 0), (9_003, " \n ", None, None, -1), (None, text + " and more of it", "en", None, None), (None, text + " and more of it", "en", None, None)], docs.schema)
    rows = good.union(good.limit(2)).union(odd).select("*", *[F.lit(i).alias(c) for i, c in enumerate(("_cut", "_quality", "sid", "taken", "size", "keep", "target", "component_id", "ids"))])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.table(stage(spark, now, str(tmp_path)), name)
        assert now.columns == list(corpus_pipeline.COLUMNS)
        kept.append([r.doc_id for r in now.collect()])
    assert not {9_001, 9_002, 9_003} & set(kept[0]) and kept[0].count(None) == kept[1].count(None) == kept[2].count(None)
    assert all(kept[0].count(i) == kept[1].count(i) for i in set(kept[1]))
    assert corpus_pipeline.run(spark, str(tmp_path)).where("n_tokens IS NULL").count() == 0


def test_pipeline_of_nothing(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
