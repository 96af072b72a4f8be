"""Language identification by a linear-chain conditional random field.

Every word of a text is labelled with a language. Emissions are sums of learned weights of the word's features:
affixes, character n-grams and membership in each language's lexicon; transitions between neighbouring words are
learned too. Chains are sentences, so code-switched text may change its language at any word. Forward-backward gives
each word's marginals; a text's language is the one with the largest sum of marginals.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import put, short_batches, spare, table
from .shingles import mix

BUCKETS = 1 << 16
#: Words are runs of letters (and the marks on them); the signs end a sentence. `[^\W\d_]` also has numbers that are no
#: decimal digits and lacks combining marks, so texts with any of these, or of other scripts, go by Unicode properties.
PIECE = re.compile(r"[^\W\d_]+|[.!?\n]")
OTHER = re.compile("[\u00b2\u00b3\u00b9\u00bc-\u00be\u0300-\U0010ffff]")
ANY_PIECE = regex.compile(r"\p{L}[\p{L}\p{M}]*|[.!?\n]")
ENDS = frozenset(".!?\n")


def pieces(text: str) -> list[str]:
    """Lower-cased words and sentence ends of a text."""
    low = text.lower()
    return ANY_PIECE.findall(low) if OTHER.search(low) else PIECE.findall(low)


def features(words: list[str], lexicon: dict[str, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """(place, word) of all features: hashed n-grams of 2 to 4 bytes and affixes, then one for each lexicon with the word."""
    raw = np.frombuffer("".join([f"<{w}>" for w in words]).encode(), np.uint8).astype(np.uint64)
    first, last = np.flatnonzero(raw == 60), np.flatnonzero(raw == 62)
    owner = np.repeat(np.arange(len(words)), last - first + 1)
    codes, owners = [], []

    def add(at: np.ndarray, n: int, kind: int) -> None:
        code = np.full(len(at), kind << 56, np.uint64)
        for i in range(n):
            code |= raw[at + i] << np.uint64(8 * i)
        codes.append(code)
        owners.append(owner[at])

    for n in (2, 3, 4):
        at = np.arange(max(0, len(raw) - n + 1))
        add(at[owner[at] == owner[at + n - 1]], n, n)
    long = last - first
    add(first[long >= 3], 4, 5)
    add(last[long >= 3] - 3, 4, 6)
    add(last[long >= 4] - 4, 5, 7)
    known = [(BUCKETS + k, i) for i, w in enumerate(words) if w in lexicon for k in lexicon[w]]
    codes.append(np.array([k for k, _ in known], np.uint64))
    owners.append(np.array([i for _, i in known], np.int64))
    flat = [(mix(c) % np.uint64(BUCKETS)).astype(np.int64) for c in codes[:-1]]
    return np.concatenate([*flat, codes[-1].astype(np.int64)]), np.concatenate(owners)


def _emissions(words: list[str], weights: np.ndarray, lexicon) -> np.ndarray:
    flat, owner = features(words, lexicon)
    return np.stack([np.bincount(owner, weights[flat, g], len(words)) for g in range(weights.shape[1])], axis=1)


class Chains:
    """Words of texts in a row, by their numbers (below 0: a sentence ends), with the chains that they form, longest first."""

    def __init__(self, word: np.ndarray, doc: np.ndarray):
        chain = np.cumsum(word < 0) + doc
        kept = word >= 0
        self.word, self.doc, chain = word[kept], doc[kept], chain[kept]
        new = np.flatnonzero(np.diff(chain, prepend=-1) != 0)
        length = np.diff(np.append(new, len(chain)))
        order = np.argsort(-length, kind="stable")
        self.first, self.length = new[order], length[order]

    def marginals(self, emit: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posterior of each word's label; expected number of each transition. emit: word's scores, not yet exponentials.

        Words are laid out by their place in the chain, so that a step works on one run of rows; the chains that go on
        are the first ones of the step before.
        """
        n, k = emit.shape
        steps = int(self.length[0]) if len(self.length) else 0
        active = np.searchsorted(-self.length, -np.arange(steps), side="left")
        at = np.repeat(np.cumsum(active) - active, active)
        at = self.first[np.arange(n) - at] + np.repeat(np.arange(steps), active)
        local = np.exp(emit[at] - emit[at].max(axis=1, keepdims=True))
        step = np.exp(moves - moves.max())
        ends = np.cumsum(active).tolist()
        forward, backward, moved = np.empty_like(local), np.ones_like(local), np.zeros((k, k))
        a = b = 0
        for c in ends:
            now = local[b:c] if b == 0 else local[b:c] * (forward[a : a + c - b] @ step)
            np.divide(now, now.sum(axis=1, keepdims=True), out=forward[b:c])
            a, b = b, c
        starts = [0, *ends[:-1]]
        for t in range(steps - 1, 0, -1):
            a, b, c = starts[t - 1], starts[t], ends[t]
            out = local[b:c] * backward[b:c]
            back = out @ step.T
            before = forward[a : a + c - b]
            moved += (before / (before * back).sum(axis=1, keepdims=True)).T @ out
            np.divide(back, back.sum(axis=1, keepdims=True), out=backward[a : a + c - b])
        forward *= backward
        forward /= forward.sum(axis=1, keepdims=True)
        post = np.empty_like(forward)
        post[at] = forward
        return post, moved * step


class Field:
    """A trained field: labels, feature weights, transition weights, lexicon."""

    def __init__(self, texts: list[str], langs: list[str], lexicon_words: int = 200, epochs: int = 25, rate: float = 0.5, ridge: float = 1e-3):
        self.labels = sorted(set(langs))
        k = len(self.labels)
        y = np.array([self.labels.index(g) for g in langs])
        counts = [Counter() for _ in self.labels]
        for text, g in zip(texts, y, strict=True):
            counts[g].update(w for w in pieces(text) if w not in ENDS)
        lexicon: dict[str, tuple[int, ...]] = {}
        for g, c in enumerate(counts):
            for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]:
                lexicon[w] = (*lexicon.get(w, ()), g)
        self.lexicon = lexicon
        vocab = {w: i for i, w in enumerate(sorted(set().union(*counts)))}
        found = [pieces(t) for t in texts]
        chains = Chains(np.array([vocab.get(w, -1) for x in found for w in x], np.int64), np.repeat(np.arange(len(texts)), [len(x) for x in found]))
        flat, owner = features(list(vocab), lexicon)
        label = y[chains.doc]
        follows = np.ones(len(label), bool)
        follows[chains.first] = False
        seen = np.zeros((k, k))
        np.add.at(seen, (label[np.flatnonzero(follows) - 1], label[follows]), 1)
        self.weights, self.moves = np.zeros((BUCKETS + k, k)), np.zeros((k, k))
        squares, move_squares = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        n = max(1, len(label))
        for _ in range(epochs):
            scores = np.stack([np.bincount(owner, self.weights[flat, g], len(vocab)) for g in range(k)], axis=1)
            post, moved = chains.marginals(scores[chains.word], self.moves)
            post[np.arange(len(label)), label] -= 1
            per_word = np.stack([np.bincount(chains.word, post[:, g], len(vocab)) for g in range(k)], axis=1)
            slope = np.stack([np.bincount(flat, per_word[owner, g], BUCKETS + k) for g in range(k)], axis=1) / n + ridge * self.weights / n
            squares += slope**2
            self.weights -= rate * slope / np.sqrt(squares)
            move_slope = (moved - seen) / n + ridge * self.moves
            move_squares += move_slope**2
            self.moves -= 0.2 * rate * move_slope / np.sqrt(move_squares)


class Labeller:
    """Applies a field to texts; keeps the emissions of at most `most` words."""

    def __init__(self, field: Field, most: int = 400_000):
        self.field, self.most = field, most
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = dict.fromkeys(ENDS, -1)
        self.scores = np.zeros((1 << 14, len(self.field.labels)), np.float32)
        self.n = 0

    def _learn(self, words: list[str]) -> None:
        new = _emissions(words, self.field.weights, self.field.lexicon)
        while self.n + len(words) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[self.n : self.n + len(words)] = new
        self.ids.update(zip(words, range(self.n, self.n + len(words)), strict=True))
        self.n += len(words)

    def chains(self, texts: list[str | None]) -> Chains:
        if self.n > self.most:
            self._clear()
        found: list[str] = []
        sizes = []
        for text in texts:
            own = pieces(text) if text else ()
            found += own
            sizes.append(len(own))
        ids = np.fromiter(map(self.ids.get, found, repeat(-2)), np.int64, len(found))
        new = np.flatnonzero(ids == -2).tolist()
        if new:
            self._learn(list(dict.fromkeys(map(found.__getitem__, new))))
            ids[new] = [self.ids[found[i]] for i in new]
        return Chains(ids, np.repeat(np.arange(len(texts)), sizes))

    def words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, marginal) of each word of a text."""
        chains = self.chains([text])
        post, _ = chains.marginals(self.scores[chains.word].astype(float), self.field.moves)
        found = [w for w in pieces(text) if w not in ENDS]
        return [(w, self.field.labels[g], float(p[g])) for w, p, g in zip(found, post, post.argmax(axis=1), strict=True)]

    def texts(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        chains = self.chains(texts)
        post, _ = chains.marginals(self.scores[chains.word].astype(float), self.field.moves)
        sums = np.stack([np.bincount(chains.doc, post[:, g], len(texts)) for g in range(post.shape[1])], axis=1)
        total = sums.sum(axis=1)
        best = sums.argmax(axis=1)
        score = np.where(total > 0, sums.max(axis=1) / np.maximum(total, 1e-12), 0.0)
        return ["und" if t == 0 else self.field.labels[g] for g, t in zip(best, total, strict=True)], np.clip(score, 0, 1)


def fit(docs: DataFrame, per_language: int = 250, most_chars: int = 200_000, **options) -> Field | None:
    """Learn from at most `per_language` texts of each language, of at most `most_chars` characters each: those of the least
    id hashes that aren't held out."""
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") <= most_chars))
    order = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = learn.select("doc_id", "lang").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("doc_id", "lang")
    chosen = F.broadcast(table(ids, "langid-sample"))  # per_language rows a language
    rows = learn.join(chosen, ["doc_id", "lang"], "left_semi").select("doc_id", "lang", "text").toPandas().sort_values(["doc_id", "lang", "text"]).drop_duplicates("doc_id")
    return Field(rows["text"].tolist(), rows["lang"].tolist(), **options) if len(rows) else None


def held_out(doc_id):
    """Whether the text of the id has a CRC-32 divisible by 5; not so for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


_workers: dict = {}


def identify(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """Add lang_pred and lang_score (0 to 1) to each row of `docs`.

    Null texts and texts without a letter are `und` with score 0, as all are if there was nothing to learn from. Equal
    texts get equal results. Columns of the two names are replaced, others stay; an empty table gives an empty table.
    """
    shared = short_batches(docs).sparkSession.sparkContext.broadcast(field)
    key = zlib.crc32(field.weights.tobytes()) if field else 0

    @F.pandas_udf("struct<lang: string, score: double>")
    def label(texts: pd.Series) -> pd.DataFrame:
        if shared.value is None:
            return pd.DataFrame({"lang": "und", "score": np.zeros(len(texts))})
        if _workers.get("key") != key:
            _workers.update(key=key, labeller=Labeller(shared.value))
        langs: list[str] = []
        scores: list[np.ndarray] = []
        for part in _portions(texts.tolist()):
            got, score = _workers["labeller"].texts(part)
            langs += got
            scores.append(score)
        return pd.DataFrame({"lang": pd.Series(langs, dtype=object), "score": np.concatenate(scores) if scores else np.zeros(0)})

    own = spare(docs, "_lang")
    labelled = put(docs, **{own: label(F.col(text))})
    return put(labelled, lang_pred=F.col(f"{own}.lang"), lang_score=F.col(f"{own}.score")).drop(own)


def _portions(texts: list[str | None], most: int = 3_000_000) -> Iterator[list[str | None]]:
    part: list[str | None] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def op3_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
