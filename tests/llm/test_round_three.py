"""Toxicity, prefix trie, spelling variants: against plain versions, planted cases, odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from strandlake.llm import prefix_trie, spelling, toxicity

WORDS = "the of and house river stone walking under green light table window garden morning paper simple letter market bridge".split()


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {c: convs.get(c - c % 5, [])[: (h := zlib.crc32(str(c).encode()) % 9)] + v[h:] for c, v in convs.items()}
    nodes, kids = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    for k in nodes:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = (len(nodes[k]) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in kids[k])
        ends = ",".join(str(c) for c in sorted(nodes[k]) if len(rebuilt[c]) == len(k))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("span, block", [(64, 4096), (2, 3)])
def test_trie_equals_plain_one(spark, monkeypatch, span, block):
    monkeypatch.setattr(prefix_trie, "SPAN", span)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng = random.Random(span)
    rows = [(None, 1, "u", "lost", 0)]
    for c in range(50):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]) if t % 3 else "u", rng.choice(["x", "yé", None, ""]) if rng.random() < 0.6 else str(rng.random()), 0))
    for t in range(70):  # a long conversation, another that leaves it late, repeated turns
        rows += [(7, t, "u", "long", 0), (1000, t, "u", "long" if t < 66 else "other", 0)]
    rows += [(12, 3, "u", "twice", 0)] * 3 + [(2**40, 1, "u", "é" * 20_000, 0)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int")
    got = prefix_trie.prefix_trie(frame).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got), key=str) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_double_array_holds_each_row_and_no_other():
    rng = np.random.default_rng(3)
    rows = sorted({tuple(rng.integers(0, 40, rng.integers(1, 9)).tolist()) for _ in range(600)})
    sizes = np.array([len(r) for r in rows])
    trie = prefix_trie.DoubleArray(np.concatenate(rows), np.cumsum(sizes) - sizes, sizes)
    prefixes = {r[:d] for r in rows for d in range(1, len(r) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes)
    for row in [*rows, *[tuple(rng.integers(0, 45, 6).tolist()) for _ in range(500)]]:
        state = np.zeros(1, np.int64)
        for d, c in enumerate(row):
            state = trie.walk(state, np.array([c]))
            assert (state[0] >= 0) == (row[: d + 1] in prefixes)


def plain_variants(docs, times=5):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form = {}
    out = []
    for w, n in counts.items():
        mates = sorted((-counts[v], v) for v in counts if near(w, v))
        if mates and -mates[0][0] >= times * n:
            form[w] = mates[0][1]
        out.append((w, n, len(mates)))
    rows = set()
    for w, n, k in out:
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, k, counts[form[w]] if w in form else None))
    return rows


def test_variants_equal_plain_ones(spark):
    rng = random.Random(5)
    base = ["committee", "aabbaabb", "Straße", "éléphant", "lettuce", "balloon", "xxxxxx"]
    texts = [(None, None), (1, ""), (2, "short \u00d7\u00f7"), (3, "balloons " * 6 + "baloon-" * 7 + "balloon" + " balloon" * 200)]
    for i in range(300):
        words = []
        for _ in range(30):
            w = rng.choice(base)
            if rng.random() < 0.3:
                p = rng.randrange(len(w) + 1)
                w = w[:p] + rng.choice(["", "a", "b", "x", "é"]) + w[p + rng.randrange(2) :]
            words.append(w.upper() if rng.random() < 0.2 else w)
        texts.append((i + 10 if i % 7 else None, rng.choice([" ", "-", ", 1"]).join(words)))
    docs = spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id long, text string, n int, word string")
    got = spelling.group_variants(spelling.count_words(spelling.noisy_words(docs))).collect()
    assert len(got) == len({r.word for r in got}) > 60
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == plain_variants(texts)
    assert any(r.form and r.root != r.form for r in got) or all(r.root == (r.form or r.word) for r in got)


def test_chains_of_forms_end_in_the_last(spark):
    chain = [("abcdefg" + "x" * i, 10 * 5**i) for i in range(9)]
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert all(r.root == chain[-1][0] for r in got.values()) and got[chain[0][0]].form == chain[1][0] and got[chain[-1][0]].form is None
    assert spelling.group_variants(spark.createDataFrame([], "word string, n long")).count() == 0


INSULTING, MILD = ["zorbag", "flimwit", "grubble", "snarkle"], "person you your".split()


def toxic_docs(n, seed):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS + MILD) for _ in range(rng.choice([5, 40, 200]))]
        bad = i % 5 == 0
        for _ in range(rng.choice([1, 3]) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTING))
        docs.append((i, " ".join(words), 0.5, 7))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_on_held_out_documents(spark):
    docs, labels = toxic_docs(900, 1)
    odd = [(1000, None), (1001, ""), (1002, "..."), (1003, "you z0rbag! g.r.u.b.b.l.e"), (1004, "f l i m w i t of the house"), (1005, "the house " * 50_000), (1006, "FLIMWITTT you")]
    frame = spark.createDataFrame(docs + [(i, t, 0.1, 1) for i, t in odd] + docs[:3], "doc_id long, text string, score double, _vector int")
    known = spark.createDataFrame(labels + [(5, None), (None, 1), labels[0]], "doc_id long, toxic int")
    model = toxicity.fit(frame, known)
    assert set(INSULTING) <= set(model.lexicon)
    rows = toxicity.score(frame, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == 910 and rows[0]._vector == 7 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([got[i].predicted == (i % 5 == 0) for i in held]) > 0.97
    assert [got[i].predicted for i in (1000, 1001, 1002, 1005)] == [0] * 4


def test_toxicity_hears_hidden_words():
    reader = toxicity.Reader({"zorbag": 3.0}, frozenset(), frozenset(["you"]))
    value = lambda text: dict(zip(toxicity.NAMES, reader.vector(text), strict=True))
    for text in ("z0rb@g", "z.o.r.b.a.g", "z o r b a g", "zzzorbaag", "is (z o r b a g) ok"):
        assert value(text)["hidden_hits"] == 1 and value(text)["top_weight"] == 3, text
    assert value("Zorbag")["hidden_hits"] == 0 and value("Zorbag")["log_hits"] > 0
    assert value("you are a zorbag")["near_person"] == 1 and value("you" + " x1 of the" * 40 + " zorbag")["near_person"] == 0
    assert value(None) == value("")


def test_toxicity_never_learns_from_held_out_labels(spark):
    docs, labels = toxic_docs(400, 2)
    frame = spark.createDataFrame(docs, "doc_id long, text string, score double, n int")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (toxicity.fit(frame, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a.lexicon == b.lexicon and a.trees.toDebugString.split("\n")[1:] == b.trees.toDebugString.split("\n")[1:]


def test_toxicity_of_one_class_and_of_nothing(spark):
    docs = spark.createDataFrame([(2, "a"), (3, None)], "doc_id long, text string")
    none = toxicity.fit(docs, spark.createDataFrame([(2, 0), (3, 0)], "doc_id long, toxic int"))
    assert none is None and [r.score for r in toxicity.score(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.score(docs.limit(0), none).count() == 0
