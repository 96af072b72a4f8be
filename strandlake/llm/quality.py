"""Quality classifier by co-training of two views.

One view reads the text's content, the other the page's metadata. Each is a logistic regression on a bounded sample of
labelled documents. In each round each view scores all unlabelled documents in tasks, the surest of all of them get its
label, and the other view learns from them. At the end each view is calibrated on held-out labels, the calibrated
scores are combined, and the combination scores every document.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, maybe_broadcast, put, short_batches, spare, table
from .shingles import portions, words_of

_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!", b"?", b"|", b"#", b"$", b"%", b"&", b"*", b"@", b"'\"", b"()[]{}", b"<>/\\", b":;", b"-_=+~^`", bytes(range(128, 256)))
CLASS = np.zeros((256, len(_CLASSES)))
for _i, _bytes in enumerate(_CLASSES):
    CLASS[list(_bytes), _i] = 1
SOURCES, LANGS = 64, 16


def text_features(texts: list[bytes]) -> np.ndarray:
    """Shares of byte classes, and how long, varied, repeated, capital and symbol-ridden the words are."""
    words, doc, first, last, raw = words_of(texts)
    n = len(texts)
    size = np.array([len(t) for t in texts], float)
    owner = np.repeat(np.arange(n), [len(t) + 1 for t in texts])
    shares = np.bincount(owner * 256 + raw, minlength=256 * n).reshape(n, 256) @ CLASS / np.maximum(size, 1)[:, None]
    n_words = np.bincount(doc, minlength=n)
    per_word = lambda x: np.bincount(doc, weights=x, minlength=n) / np.maximum(n_words, 1)
    length = (last - first).astype(float)
    again = np.zeros(len(words))
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    order = np.lexsort((words, doc))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = np.bincount(doc[order][new], minlength=n) / np.maximum(n_words, 1)
    letter = (CLASS[:, 0] + CLASS[:, 1] + CLASS[:, -1]) > 0
    ends = letter[raw[last - 1]] | np.isin(raw[last - 1], np.frombuffer(b".,", np.uint8)) if len(words) else np.zeros(0, bool)
    capital = CLASS[raw[first], 1] if len(words) else np.zeros(0)
    mean = per_word(length)
    other = np.column_stack([
        np.log1p(n_words), mean, np.sqrt(np.maximum(per_word(length**2) - mean**2, 0)), distinct, distinct * np.log1p(n_words),
        per_word(again), per_word(ends.astype(float)), per_word(capital), per_word(length > 20), per_word(length == 1)])
    return np.hstack([np.log(shares + 1e-3), shares, other])


def page_features(source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> np.ndarray:
    """Hashed source and language, length as stated, and what is missing."""
    out = np.zeros((len(source), SOURCES + LANGS + 4))
    for i, (s, g) in enumerate(zip(source, lang, strict=True)):
        if isinstance(s, str):
            out[i, zlib.crc32(s.encode()) % SOURCES] = 1
        if isinstance(g, str):
            out[i, SOURCES + zlib.crc32(g.encode()) % LANGS] = 1
    chars = pd.to_numeric(n_chars, errors="coerce").to_numpy(dtype=float, na_value=np.nan)
    length = np.log1p(np.clip(np.nan_to_num(chars), 0, None))
    out[:, -4], out[:, -3], out[:, -2], out[:, -1] = length, length**2, np.isnan(chars), source.isna()
    return out


class Logistic:
    """Ridge logistic regression on standardized features, by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-9] = np.inf
        z = self._z(x)
        w = np.ones(len(y)) if weight is None else weight
        self.beta = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            gradient = z.T @ (w * (p - y)) + penalty * self.beta
            hessian = (z * (w * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
            step = np.linalg.solve(hessian, gradient)
            self.beta -= step
            if np.abs(step).max() < 1e-6:
                break

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._z(x) @ self.beta, -30, 30)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


#: Models of the views -> for each view the documents of which it is surest, in both views, and the labels it gives them.
Surest = Callable[[list[Logistic]], list[tuple[list[np.ndarray], np.ndarray]]]


class CoTrained:
    """Two views, calibrated and combined; `cut` keeps nearly all held-out good documents."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray, surest: Surest, rounds: int, keep_good: float):
        held = np.arange(len(y)) % 4 == 3
        held_y = y[held]
        if len(set(held_y)) < 2 or len(set(y[~held])) < 2:
            held[:] = True
            held_y, learn = y, np.ones(len(y), bool)
        else:
            learn = ~held
        own = [(v[learn], y[learn], np.ones(learn.sum())) for v in views]
        for left in range(rounds, -1, -1):
            self.models = [Logistic(*data) for data in own]
            told = surest(self.models) if left else []
            own = []
            for i, v in enumerate(views if told else ()):
                more, label = told[1 - i]
                own.append((np.vstack([v[learn], more[i]]), np.concatenate([y[learn], label]), np.concatenate([np.ones(learn.sum()), np.full(len(label), 0.5)])))
        self.calibrations = [Logistic(m.logit(v[held])[:, None], held_y, ridge=1e-2) for m, v in zip(self.models, views, strict=True)]
        self.blend = Logistic(self._calibrated([v[held] for v in views]), held_y, ridge=1.0)
        good = np.sort(self.score([v[held] for v in views])[held_y == 1])
        self.cut = min(0.5, float(good[int((1 - keep_good) * len(good))]))

    def _calibrated(self, views: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrations, self.models, views, strict=True)])

    def view_scores(self, views: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self._calibrated(views))

    def score(self, views: list[np.ndarray]) -> np.ndarray:
        return sigmoid(self.blend.logit(self._calibrated(views)))


COLUMNS = ("text", "source", "lang", "n_chars")


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    """The columns that are read; missing ones are null."""
    has = {c.lower() for c in docs.columns}
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "double"}
    return docs.select(*more, *[(F.col(c) if c in has else F.lit(None)).cast(kinds[c]).alias(c) for c in COLUMNS])


def _views(frame: pd.DataFrame) -> Iterator[tuple[slice, list[np.ndarray]]]:
    for at, texts in portions(frame["text"]):
        where = slice(at, at + len(texts))
        part = frame.iloc[where]
        yield where, [text_features(texts), page_features(part["source"], part["lang"], part["n_chars"])]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_labelled: int = 4_000, rounds: int = 3, sure: float = 0.95, add: int = 200, keep_good: float = 0.995) -> CoTrained | None:
    """Fit on at most `most_labelled` labelled documents, those of the least id hashes, and on all unlabelled ones: each
    round takes the `add` surest of all of them for each view and class.

    A document labelled more than once counts with its lowest label; null labels count as none. None if either class
    is missing.
    """
    known = labels.where(f"{label} IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(label).cast("double").alias("y"))
    order = F.xxhash64("doc_id")
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    some = known.join(ids, "doc_id", "left_semi").orderBy(order, "doc_id").limit(most_labelled)
    chosen = F.broadcast(table(some, "quality-sample"))  # at most most_labelled rows

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, (a, b) in _views(batch):
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[where].to_numpy(), "y": batch["y"].iloc[where].to_numpy(dtype=float), "a": list(a), "b": list(b)})

    sample = _rows(docs.join(chosen, "doc_id"), "doc_id", "y").mapInPandas(emit, "doc_id long, y double, a array<double>, b array<double>").toPandas()
    sample = sample.sort_values("doc_id", key=lambda s: [zlib.crc32(str(i).encode()) for i in s], kind="stable").drop_duplicates("doc_id")
    y = (sample["y"].to_numpy() > 0.5).astype(float)
    if len(set(y)) < 2:
        return None
    views = [np.stack(sample[v].to_list()) for v in ("a", "b")]
    pool, surest = _pool(docs, known, sure, add)
    model = CoTrained(views, y, surest, rounds, keep_good)
    drop(pool)
    return model


def _pool(docs: DataFrame, known: DataFrame, sure: float, add: int, fan_in: int = 32) -> tuple[DataFrame, Surest]:
    """A table of the text features of all unlabelled documents, four bytes each, and the search of the surest in it."""
    spark = docs.sparkSession

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, texts in portions(batch["text"]):
                rows = batch.iloc[at : at + len(texts)].drop(columns="text")
                yield rows.assign(a=[x.tobytes() for x in text_features(texts).astype("<f4")])

    open_ = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").join(maybe_broadcast(known.select("doc_id")), "doc_id", "left_anti")
    pool = table(_rows(open_, "doc_id").mapInPandas(features, "doc_id long, source string, lang string, n_chars double, a binary"), "quality-pool")
    schema = "view int, label int, p double, doc_id long, source string, lang string, n_chars double, a binary"
    first = F.row_number().over(W.partitionBy("view", "label", "slot").orderBy(F.desc("p"), "doc_id", "a"))
    n_tasks = pool.select(F.spark_partition_id().alias("slot")).agg(F.max("slot")).first()[0]

    def views_of(rows: pd.DataFrame) -> list[np.ndarray]:
        text = np.frombuffer(b"".join(rows["a"]), "<f4").astype(float).reshape(len(rows), -1)
        return [text, page_features(rows["source"], rows["lang"], rows["n_chars"])]

    def surest(models: list[Logistic]) -> list[tuple[list[np.ndarray], np.ndarray]]:
        shared = spark.sparkContext.broadcast(models)

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best: dict[tuple[int, int], pd.DataFrame] = {}  # of all batches so far
            for batch in batches:
                for i, (model, x) in enumerate(zip(shared.value, views_of(batch), strict=True) if len(batch) else ()):
                    good = sigmoid(model.logit(x))
                    for label, p in ((1, good), (0, 1 - good)):
                        at = np.flatnonzero(p >= sure)
                        at = at[np.lexsort((batch["doc_id"].to_numpy()[at], -p[at]))]
                        more = batch.iloc[at].assign(view=i, label=label, p=p[at])[["view", "label", "p", "doc_id", "source", "lang", "n_chars", "a"]]
                        both = pd.concat([best[i, label], more]) if (i, label) in best else more
                        best[i, label] = both.sort_values(["p", "doc_id", "a"], ascending=[False, True, True], kind="stable").iloc[:add]
            yield from best.values()

        # the surest of each task, then of ever more tasks together: none ever ranks more than fan_in * add rows of a key
        found, slots = pool.mapInPandas(search, schema).withColumn("slot", F.spark_partition_id()), (n_tasks or 0) + 1
        while slots:
            slots = -(-slots // fan_in) if slots > fan_in else 0
            found = found.withColumn("slot", F.floor(F.col("slot") / fan_in) if slots else F.lit(0)).withColumn("at", first).where(F.col("at") <= add)
        found = found.drop("slot").toPandas()  # 4 * add rows at most
        shared.unpersist()
        found = found.sort_values(["view", "label", "at"])
        parts = [found[found["view"] == i] for i in range(len(models))]
        return [(views_of(p) if len(p) else [np.zeros((0, len(m.mean))) for m in models], p["label"].to_numpy(dtype=float)) for p in parts]

    return pool, surest


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Add quality_score (0 to 1), text_score, page_score and quality_keep to each row of `docs`; options: see fit.

    Null, empty and blank texts score 0 and aren't kept. With labels of one class only, or none, all other rows score 1
    and are kept. Equal rows get equal scores. Columns of the four names are replaced, others stay; an empty table gives
    an empty table.
    """
    model = short_batches(docs).sparkSession.sparkContext.broadcast(fit(docs, labels, **options))

    @F.pandas_udf("struct<score: double, text_score: double, page_score: double, keep: boolean>")
    def judge(text: pd.Series, source: pd.Series, lang: pd.Series, n_chars: pd.Series) -> pd.DataFrame:
        frame = pd.DataFrame({"text": text, "source": source, "lang": lang, "n_chars": n_chars})
        out = np.ones((len(frame), 3))
        for where, views in _views(frame) if model.value is not None else ():
            out[where, 0], out[where, 1:] = model.value.score(views), model.value.view_scores(views)
        blank = np.array([not t or not t.strip() for t in text], bool)
        out[blank] = 0
        cut = model.value.cut if model.value is not None else 0.0
        return pd.DataFrame({"score": out[:, 0], "text_score": out[:, 1], "page_score": out[:, 2], "keep": (out[:, 0] >= cut) & ~blank})

    has = {c.lower() for c in docs.columns}
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "double"}
    one = judge(*[(F.col(c) if c in has else F.lit(None)).cast(kinds[c]) for c in COLUMNS])
    own = spare(docs, "_quality")
    judged = put(docs, **{own: one})
    q = F.col(own)
    return put(judged, quality_score=q["score"], text_score=q["text_score"], page_score=q["page_score"], quality_keep=q["keep"]).drop(own)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, labels).select("doc_id", "quality_score", "text_score", "page_score", "quality_keep")
