"""Token counts, token files, secrets, language, quality: edge cases and exact checks."""

import base64
import hashlib
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandlake.llm import langid, quality, secrets, token_counts, token_files
from strandlake.llm.common import fresh, tokenizer_file

TEXTS = [None, "", " ", "a", "Hello, World!!  it's 12 o'clock.\n\n x\ty", "a  \n b <|endoftext|> c  <|endoftext|>d", "Éeau ÇA İstanbul ΣΑΣ naïve ½ ² é x y\x1cz", "don't WON'T they'LL ... foo,,bar", "word " * 30_000, "日本語テキスト 🙂🙂 text", "tok" * 5000]


def frame(spark, texts=TEXTS, **more):
    rows = [(i, t, None if i % 4 == 3 else "en", None if i % 5 == 4 else "src", i, 7.5, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_tokens double, taken int, _cut string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"])
def test_token_counts_equal_the_library(spark, name):
    docs = frame(spark)
    got = {r.doc_id: r for r in token_counts.count_tokens(docs.union(docs), tokenizer=tokenizer_file(name)).collect()}
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(name))
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(tokenizer_file(name))
        count = lambda t: len(model.encode(t, add_special_tokens=False))
    assert {i: r.n_tokens for i, r in got.items()} == {i: count(t or "") for i, t in enumerate(TEXTS)}
    assert got[0].n_tokens == 0 and got[0].n_bytes == 0 and not got[0].over_limit and got[8].over_limit
    assert got[8].n_bytes == 150_000 and got[8].lang == "en"


def test_token_counts_of_nothing(spark):
    assert token_counts.count_tokens(frame(spark).limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=700), st.floats(0, 1))
def test_blocks_round_trip(ids, percentile):
    chunk = token_files.pack_chunk([5, None], [len(ids), 0], np.array(ids, np.int64), percentile) + b"\n"
    ((docs, counts, back),) = token_files.chunks(chunk)
    assert docs == [5, None] and counts.tolist() == [len(ids), 0] and back.tolist() == ids


def test_token_files_equal_the_library(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    docs = frame(spark).repartition(3)
    path = token_files.write_tokens(docs, fresh(spark, "t"), docs_per_file=3, ids_per_chunk=50, chunks_per_file=2)
    got = token_files.read_tokens(spark, path, with_ids=True).orderBy("start").collect()
    want = [[*model.encode(t or "", add_special_tokens=False).ids, 1] for t in TEXTS]
    assert [list(r.ids) for r in got] == want
    assert [r.start for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist() and [r.doc_id for r in got] == list(range(len(TEXTS)))
    assert [r.ids_crc32 for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in want]


def test_word_ids_equal_the_library_on_letters_that_decompose():
    words = token_files.WordIds(tokenizer_file("word_bpe_49k.json"), 10_000)
    nfc = lambda s: unicodedata.normalize("NFC", s)
    odd = [c for c in map(chr, [*range(0xD800), *range(0xE000, 0x30000)]) if c.isalpha() and (nfc(c) != c or len(c.lower()) > 1 or nfc(c.lower()) != c.lower())]
    assert len(odd) > 500
    for c in odd:
        text = " ".join(f"ab{c}{m}" for m in token_files.MARKS) + f" {c}x, A{c}: {c}{c}. TÜRKİYE CUMHURİYETİ, 2024"
        assert words.encode([text]) == [words.whole(text)], hex(ord(c))


def test_token_files_with_null_and_repeated_ids_and_nothing(spark):
    docs = spark.createDataFrame([(None, "a"), (3, "b c"), (3, "b c"), (1, None)], "doc_id long, text string")
    got = token_files.read_tokens(spark, token_files.write_tokens(docs, fresh(spark, "t"))).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (1, 2, 1), (3, 3, 3), (3, 6, 3)]
    assert token_files.read_tokens(spark, token_files.write_tokens(docs.limit(0), fresh(spark, "t"))).count() == 0


SECRETS = ['api_key = "abcdef123"', "password: abc", "PassWord='hunter22' token=secret=abcdefgh", "AKIA" + "A1B2" * 4, "AKIAshort", "f" * 24 + " " + "0" * 23, "x " + "aZ3kQ9xLm2Vt7Rb1Yp8Wc5" + ".", "123e4567-e89b-12d3-a456-426614174000", "ſecret=abcdefghij", None, "",
           "internationalization-of-everything", "é apikey=aaaaaaa"]


def test_addresses_of_any_length_end_at_white_space():
    encode, key = secrets.vocabulary(tokenizer_file("byte_bpe_50k.tiktoken")).encode_ordinary, "aZ3kQ9xLm2Vt7Rb1Yp8Wc5"
    path = "com/services/webhook/"
    for many in (1, 4_000):  # in an address the pieces alone are judged, however far it began
        text = "see https://" + "x.y?" * many + path + key
        assert secrets.spans(text, encode, 2.0) == [(len(text) - len(key), len(text), 3)]
    text = f"https://x.y\n{key}/{key}"
    assert secrets.spans(text, encode, 2.0) == [(len(text) - 2 * len(key) - 1, len(text), 3)]  # no address here


def test_secrets(spark):
    docs = frame(spark, SECRETS)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secrets] for r in secrets.find_secrets(docs.union(docs)).collect()}
    assert got[0] == [("assign", 0, 20)] and got[1] == [] and got[9] == got[10] == got[11] == []
    assert got[2] == [("assign", 0, 18), ("assign", 20, 41)] and got[3] == [("access", 0, 20)] and got[4] == []
    assert got[5] == [("hex", 0, 24)] and got[6] == [("random", 2, 24)] and got[7] == [] and got[8] == [] and got[12] == [("assign", 2, 16)]
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_random_keys_behind_names_and_of_letters():
    import random
    import string

    rng, encode = random.Random(3), secrets.vocabulary(tokenizer_file("byte_bpe_50k.tiktoken")).encode_ordinary
    for alphabet, n in ((string.ascii_lowercase + string.digits, 20), (string.ascii_lowercase + string.digits, 24), (string.ascii_uppercase + "234567", 20), (string.ascii_letters + string.digits, 20), (string.ascii_lowercase, 32)):
        for before in ("", "authorization=", "com/services/webhook/"):
            keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(200)]
            found = sum(any(a <= len(before) and b == len(before) + n for a, b, _ in secrets.spans(before + k, encode, 2.0)) for k in keys)
            assert found >= 190, (alphabet, n, before, found)
    for plain in ("internationalization-of-everything", "src/main/resources/configuration/application", "HTTP_CONNECTION_TIMEOUT_SECONDS", "getElementsByClassNameAndAttribute"):
        assert secrets.spans(plain, encode, 2.0) == [], plain


def test_planted_keys_in_prose(spark):
    """Precision and recall of added spans: keys of several kinds in real texts, and all that is found beside them."""
    import random
    import string

    rng = random.Random(11)
    kinds = [(string.ascii_letters + string.digits, 40, "ghp_"), (string.ascii_letters + string.digits + "+/", 40, ""), (string.ascii_uppercase + "234567", 32, ""), (string.ascii_letters + string.digits, 24, "sk_live_"), (string.ascii_lowercase + string.digits, 32, "")]
    texts, planted = [], []
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").collect():
        words = r.text.split(" ")
        alphabet, n, before = kinds[len(texts) % len(kinds)]
        key, at = before + "".join(rng.choices(alphabet, k=n)), rng.randrange(len(words) + 1)
        start = len(" ".join(words[:at])) + (at > 0)
        texts.append(" ".join([*words[:at], key, *words[at:]]))
        planted.append((start, start + len(key)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end) for s in r.secrets if s.kind == "random"] for r in secrets.find_secrets(docs).collect()}
    hit = [any(a < end and start < b for a, b in found[i]) for i, (start, end) in enumerate(planted)]
    other = sum(not (a < planted[i][1] and planted[i][0] < b) for i, spans in found.items() for a, b in spans)
    assert sum(hit) >= 0.97 * len(hit) and other <= 0.02 * len(hit), (sum(hit), len(hit), other)


def test_known_digests_and_identifiers_are_no_secrets():
    encode = secrets.vocabulary(tokenizer_file("byte_bpe_50k.tiktoken")).encode_ordinary
    digest = hashlib.sha256(b"x").digest()
    for plain in ("integrity: sha256-" + base64.b64encode(digest).decode(), "QmYwAPJzv5CZsnA625s3Xf2nemtYgPpHdWEz79ojWKPbdG", "id 01ARZ3NDEKTSV4RRFFQ69G5FAV", "https://example.org/AbCdEfGh/some-page_2024-11", "urn 123E4567-E89B-12D3-A456-426614174000"):
        assert secrets.spans(plain, encode, 2.0) == [], plain
    assert secrets.spans("https://example.org/hook/aZ3kQ9xLm2Vt7Rb1Yp8Wc5", encode, 2.0) == [(25, 47, 3)]


def ordinary_runs(n: int, seed: int = 5) -> list[str]:
    """Long runs that are no secrets: dated names, numbers of books and journals, sequences, prose in base64."""
    import random

    rng = random.Random(seed)
    words = "data backup final report customer export invoice summary weekly training model release draft archive metrics".split()
    runs = []
    for i in range(n):
        a, b, c = rng.sample(words, 3)
        day = f"20{rng.randrange(10, 30)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}"
        isbn = f"978-{rng.randrange(1, 10)}-{rng.randrange(10, 100)}-{rng.randrange(100_000, 1_000_000)}-{rng.choice('0123456789X')}"
        prose = base64.b64encode(f"{a} {b}, the {c} of this {rng.choice(words)}.".encode()).decode()
        kinds = [f"{a}_{day}_{b}-{c}_v{rng.randrange(1, 20)}", f"{a}-{b}_{day.replace('-', '')}T{rng.randrange(100_000, 235_959)}Z", f"ISBN-{isbn}", "".join(rng.choices("ACGT", k=60)), "".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=40)), prose, f"body={prose}"]
        runs.append(kinds[i % len(kinds)])
    return runs


def test_names_sequences_and_prose_are_no_secrets_and_keys_stay():
    import random
    import string

    encode, rng = secrets.vocabulary(tokenizer_file("byte_bpe_50k.tiktoken")).encode_ordinary, random.Random(9)
    flagged = [run for run in ordinary_runs(700) if secrets.spans(f"see {run} here", encode, 2.0)]
    assert len(flagged) <= 7, flagged[:20]
    keys = ["".join(rng.choices(string.ascii_letters + string.digits, k=rng.randrange(20, 41))) for _ in range(350)]
    keys += [base64.b64encode(rng.randbytes(rng.randrange(15, 40))).decode() for _ in range(350)]
    found = sum(bool(secrets.spans(f"see {k} here", encode, 2.0)) for k in keys)
    assert found >= 0.98 * len(keys), found
    assert found / (found + len(flagged)) >= 0.98
    login = base64.b64encode(b"operator:correcthorsebattery").decode()
    assert secrets.spans(f"Basic {login}", encode, 2.0) != []
    assert secrets.spans("eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", encode, 2.0) != []
    for key in ("QWXZPLMK-TRVBNNQS-KJHGFDSW-2024", "release-2024-11-28-aZ3kQ9xLm2Vt7Rb1Yp8Wc5"):
        assert secrets.spans(key, encode, 2.0) != [], key


def test_secrets_of_long_texts_and_over_an_own_column(spark):
    docs = frame(spark, ["x " * 400_000 + "AKIA" + "A1B2" * 4, "a" * 1_000_000]).withColumn("secrets", F.lit(1))
    got = [[(s.kind, s.start) for s in r.secrets] for r in secrets.find_secrets(docs).orderBy("doc_id").collect()]
    assert got[0] == [("access", 800_000)] and got[1][0] == ("hex", 0)


def test_base_spans_equal_a_plain_scan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    patterns = [re.compile(r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
    least = [lambda m: len(m[2]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.find_secrets(docs).collect():
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in p.finditer(texts[r.doc_id]) if least[k](m))
        assert [(s.start, secrets.KINDS.index(s.kind), s.end) for s in r.secrets if s.kind != "random"] == want


def test_language_held_out_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    field = langid.fit(docs, per_language=40)
    got = langid.identify(docs, field).where(langid.held_out(docs.doc_id)).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95 and got.lang_score.between(0, 1).all()
    edge = langid.identify(frame(spark, [None, "", "123 ...", "the of and", "the of and", "½ ² ①", "Ⅷ _ \u0301", "the of and " * 300_000]).withColumn("_lang", F.lit("own")), field).orderBy("doc_id").collect()
    assert [r.lang_pred for r in (*edge[:3], *edge[5:7])] == ["und"] * 5 and edge[3].lang_pred == edge[4].lang_pred == edge[7].lang_pred == "en" and edge[3].lang_score == edge[4].lang_score
    assert {r._lang for r in edge} == {"own"} and langid.pieces("हिन्दी. x²y")[:2] == ["हिन्दी", "."]
    assert langid.identify(docs.limit(0), field).count() == 0 and langid.fit(docs.limit(0)) is None
    assert {r.lang_pred for r in langid.identify(docs.limit(3), None).collect()} == {"und"}
    switched = langid.Labeller(field).words("the is that of to. une les que dans le la du des")
    assert {g for w, g, _ in switched[:5]} == {"en"} and {g for w, g, _ in switched[-5:]} == {"fr"}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    field = langid.Field(["aa bb. cc", "dd ee"], ["x", "y"], epochs=2)
    field.moves = rng.normal(size=(2, 2))
    labeller = langid.Labeller(field)
    chains = labeller.chains(["aa bb cc dd"])
    emit = labeller.scores[chains.word].astype(float)
    post, _ = chains.marginals(emit, field.moves)
    total = np.zeros((4, 2))
    for code in range(16):
        y = [code >> i & 1 for i in range(4)]
        p = np.exp(sum(emit[i, y[i]] for i in range(4)) + sum(field.moves[y[i], y[i + 1]] for i in range(3)))
        for i in range(4):
            total[i, y[i]] += p
    assert np.allclose(post, total / total.sum(axis=1, keepdims=True))


def test_language_equals_plain_forward_backward(spark):
    """Each text's language and score against a word-by-word recursion over its sentences."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    field = langid.fit(docs, per_language=20, most_chars=5_000)
    k, got = len(field.labels), langid.identify(docs, field).collect()
    move = np.exp(field.moves)
    for r in got:
        sums = np.zeros(k)
        for sentence in re.split(r"[.!?\n]", (r.text or "").lower()):
            words = re.findall(r"[^\W\d_]+", sentence)
            if not words:
                continue
            e = np.exp(langid._emissions(words, field.weights, field.lexicon))
            f, b = [e[0] / e[0].sum()], [np.ones(k)]
            for x in e[1:]:
                f.append(x * (f[-1] @ move))
                f[-1] /= f[-1].sum()
            for x in e[:0:-1]:
                b.append(move @ (x * b[-1]))
                b[-1] /= b[-1].sum()
            for u, v in zip(f, b[::-1], strict=True):
                sums += u * v / (u * v).sum()
        if sums.sum() == 0:
            assert (r.lang_pred, r.lang_score) == ("und", 0)
        else:
            assert r.lang_pred == field.labels[sums.argmax()] and abs(r.lang_score - sums.max() / sums.sum()) < 1e-4


def test_quality_held_out_and_edges(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    known = labels.where("doc_id % 3 <> 0")
    got = quality.classify(docs, known, most_labelled=300).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert got[got.quality == 1].quality_keep.mean() > 0.97 and got[got.quality == 0].quality_keep.mean() < 0.2
    edge = quality.classify(frame(spark, [None, "", " \n", "the of and", "the of and", "word " * 30_000]), labels.limit(0)).orderBy("doc_id").collect()
    assert [r.quality_keep for r in edge] == [False] * 3 + [True] * 3 and edge[3].quality_score == 1
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert set(quality.classify(docs.limit(20).withColumn("_quality", F.lit("own")), labels).toPandas()["_quality"]) == {"own"}
    some = quality.classify(docs.select("doc_id", "text").union(docs.select("doc_id", "text").limit(5)), labels.union(labels.select(labels.doc_id, labels.quality * 0, labels.toxic).limit(3)))
    assert some.count() == 1005 and some.where("quality_score IS NULL").count() == 0


@pytest.mark.parametrize("fan_in", [2, 32])
def test_surest_of_the_pool_equal_plain_ranking(spark, fan_in):
    """Both views' surest unlabelled documents, ranked in tasks and levels, against one sort of all; ties and repeats."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.union(docs.limit(100)).repartition(7)
    rows = docs.toPandas()
    rows = rows[rows.text.notna() & rows.doc_id.notna() & ~rows.doc_id.isin(labels.where("quality IS NOT NULL").toPandas().doc_id)]
    views = [quality.text_features([t.encode() for t in rows.text]).astype("<f4"), quality.page_features(rows.source, rows.lang, rows.n_chars)]
    rng = np.random.default_rng(3)
    models = [quality.Logistic(v.astype(float), (rng.random(len(rows)) < 0.5).astype(float)) for v in views]
    pool, surest = quality._pool(docs, labels.select("doc_id").distinct(), 0.5, 40, fan_in)
    assert pool.count() == len(rows)
    for i, (model, (xs, label)) in enumerate(zip(models, surest(models), strict=True)):
        good = quality.sigmoid(model.logit(views[i].astype(float)))
        for want, p in ((1, good), (0, 1 - good)):
            at = sorted(np.flatnonzero(p >= 0.5), key=lambda k: (-round(p[k], 9), rows.doc_id.iloc[k], views[0][k].tobytes()))[:40]
            assert np.allclose(np.sort(model.logit(xs[i][label == want])), np.sort(model.logit(views[i].astype(float)[at])), atol=1e-6)
