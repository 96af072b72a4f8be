"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learned in Spark from the labelled documents: words that toxic documents hold more often than others by
more than chance. Each document becomes a short vector: densities of the learned and of a given lexicon, how near
their words stand to the second person, capitals, punctuation, obfuscated spelling. The trees learn from vectors whose
lexicon lacks the document's own fold, and the calibration from trees that lack its half, so that neither learns to
trust words that the labels themselves gave.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import put, spare, table

# Common insults that hold without any label; a parameter.
INSULTS = ("idiot idiots moron morons stupid dumb fool loser losers trash garbage scum clown pathetic worthless disgusting ugly freak jerk creep pig "
           "vermin filth filthy coward liar hate hates kill die shut scumbag imbecile retard").split()
# Second-person words of some languages.
SECOND_PERSON = ("you your yours yourself u ur du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre vos "
                 "ti tuyo tus usted ustedes vosotros vuestro você vocês").split()
LETTERS = re.compile(r"[^\W\d_]+")
STRIP = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "«»“”„‘’…¿¡"
LEET = str.maketrans("013457@$!|", "oieastasil")
LONG_RUN, RUN = re.compile(r"(.)\1\1"), re.compile(r"(.)\1+")
SHOUT = re.compile(r"[!?]{2,}")
FOLDS, NEAR, WINDOW = 5, 5, 50
NAMES = ("log_words", "weight_density", "hit_density", "log_hits", "log_distinct", "top_weight", "given_density", "log_given", "person_density", "near_person", "nearest", "capitals",
         "shouted", "exclamations", "questions", "signs", "bursts", "odd_words", "hidden_hits", "stretched", "densest", "strong_hits")


CAPITAL, SIGN = (np.array([f(chr(i)) for i in range(1 << 16)]) for f in (str.isupper, lambda c: not c.isalnum() and not c.isspace()))


class Token(NamedTuple):
    """What a token between white space adds: its words, which of them are hits (place, word), which are of the second person."""

    n: int
    hits: tuple[tuple[int, str], ...] = ()
    persons: tuple[int, ...] = ()
    shouted: int = 0
    odd: int = 0
    hidden: int = 0
    stretched: int = 0


PLAIN = Token(1)


class Reader(dict):
    """Token -> Token; a lone letter -> the letter. Texts become vectors; stays within `most` entries."""

    def __init__(self, lexicon: dict[str, float], given: frozenset[str], person: frozenset[str], most: int = 300_000):
        super().__init__()
        self.lexicon, self.given, self.person, self.most = lexicon, given, person, most

    def known(self, word: str) -> bool:
        return word in self.lexicon or word in self.given

    def __missing__(self, token: str) -> Token | str:
        if len(self) >= self.most:
            self.clear()
        self[token] = found = self.read(token)
        return found

    def read(self, token: str) -> Token | str:
        core = token if token.isalpha() else token.strip(STRIP)
        if len(core) == 1 and core.isalpha():
            return core
        low = core.lower()
        if core.isalpha():
            shouted = int(len(core) > 2 and core.isupper())
            persons = (0,) if low in self.person else ()
            if self.known(low):
                return Token(1, ((0, low),), persons, shouted)
            if len(set(low)) < len(low) - 1 and LONG_RUN.search(low):
                short = next((w for w in (RUN.sub(r"\1", low), RUN.sub(r"\1\1", low)) if self.known(w)), None)
                return Token(1, ((0, short),) if short else (), persons, shouted, 0, int(short is not None), 1)
            return Token(1, (), persons, shouted) if persons or shouted else PLAIN
        words = [w.lower() for w in LETTERS.findall(token)]
        hits = tuple((i, w) for i, w in enumerate(words) if self.known(w))
        whole = "".join(LETTERS.findall(token.strip(".,;:?").lower().translate(LEET))) if words and not hits else ""
        hidden = int(self.known(whole))
        return Token(len(words), ((0, whole),) if hidden else hits, tuple(i for i, w in enumerate(words) if w in self.person), 0, int(bool(words)), hidden)

    def vector(self, text: str | None) -> list[float]:
        """The vector of a text, in the order of NAMES; a null text is an empty one."""
        text = text or ""
        at: list[int] = []  # places of lexicon words among the words
        hits: list[str] = []
        you: list[int] = []
        spelled: list[str] = []  # letters that stand alone
        n = odd = hidden = shouted = stretched = 0

        def spell() -> int:
            word = "".join(spelled).lower()
            spelled.clear()
            if len(word) < 3 or not self.known(word):
                return 0
            at.append(n)
            hits.append(word)
            return 1

        tokens = list(map(self.__getitem__, text.split()))
        ahead = 0  # words so far, less the tokens so far
        last = -1
        for i in [i for i, x in enumerate(tokens) if x is not PLAIN]:
            x, n = tokens[i], i + ahead
            if spelled and (i > last + 1 or not isinstance(x, str)):
                hidden += spell()
            last = i
            if isinstance(x, str):
                spelled.append(x)
                continue
            at.extend([n + k for k, _ in x.hits])
            hits.extend([w for _, w in x.hits])
            you.extend([n + k for k in x.persons])
            ahead += x.n - 1
            odd, hidden, shouted, stretched = odd + x.odd, hidden + x.hidden, shouted + x.shouted, stretched + x.stretched
        n = len(tokens) + ahead
        hidden += spell()
        weights = [self.lexicon.get(w, 0.0) for w in hits]
        n_given = sum(w in self.given for w in hits)
        per, far, near, densest = 100 / max(n, 1), 2.0 * WINDOW, 0.0, 0
        if at:
            places = np.sort(np.array(at))
            densest = int((np.searchsorted(places, places + WINDOW) - np.arange(len(places))).max())
            if you:
                persons = np.array(you)
                right = np.searchsorted(persons, places)
                gap = np.minimum(np.abs(places - persons[np.minimum(right, len(persons) - 1)]), np.abs(places - persons[np.maximum(right - 1, 0)]))
                far, near = min(far, float(gap.min())), float((gap <= NEAR).mean())
        codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), (1 << 16) - 1)
        size = max(len(text), 1)
        return [math.log1p(n), sum(weights) * per, len(hits) * per, math.log1p(len(hits)), math.log1p(len(set(hits))), max(weights, default=0.0), n_given * per, math.log1p(n_given),
                len(you) * per, near, math.log1p(far), CAPITAL[codes].sum() / size, shouted * per, text.count("!") * per, text.count("?") * per, SIGN[codes].sum() / size,
                len(SHOUT.findall(text)) * per, odd * per, float(hidden), stretched * per, float(densest), math.log1p(sum(w > 2 for w in weights))]


def _held(doc_id: str = "doc_id") -> Column:
    """Whether labels of the document may not be learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, label: str, most_rows: int) -> DataFrame:
    """(doc_id, text, y, fold) of at most `most_rows` documents to learn from, those of the least id hashes."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~_held()).groupBy("doc_id").agg(F.max(label).cast("double").alias("y"))
    ids = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = table(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows), "toxic-labels")  # most_rows rows at most
    fold = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(FOLDS)).cast("int")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").withColumn("fold", fold)


def learn_lexicon(rows: DataFrame, least_toxic: int = 4, most_words: int = 5_000) -> list[dict[str, float]]:
    """Word -> log odds, of rows (text, y, fold): one dictionary without each fold, then one of all.

    The odds compare the shares of toxic and other documents that hold the word and are lessened by their standard error;
    words of positive odds are kept. The `most_words` surest words over all folds go to the driver.
    """
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    seen = rows.where("text IS NOT NULL").select((F.col("y") > 0.5).alias("toxic"), "fold", F.explode(words).alias("word")).where("word <> ''")
    tally = [F.count_if((F.col("toxic") == F.lit(bool(t))) & (F.col("fold") == f)).alias(f"n{t}{f}") for t in (0, 1) for f in range(FOLDS)]
    counts = seen.groupBy("word").agg(*tally)
    toxic, other = (sum((F.col(f"n{t}{f}") for f in range(FOLDS)), F.lit(0)) for t in (1, 0))
    total = rows.agg(*[F.coalesce(F.count_if((F.col("y") > 0.5).eqNullSafe(F.lit(bool(t))) & (F.col("fold") == f)), F.lit(0)).alias(f"n{t}{f}") for t in (0, 1) for f in range(FOLDS)]).first()
    sums = {t: np.array([total[f"n{t}{f}"] for f in range(FOLDS)], float) for t in (0, 1)}

    def odds(p, n, big_p, big_n, log, root):
        return log((p + 0.5) / (big_p + 1)) - log((n + 0.5) / (big_n + 1)) - 0.75 * root(1 / (p + 0.5) + 1 / (n + 0.5))

    score = odds(toxic, other, float(sums[1].sum()), float(sums[0].sum()), F.log, F.sqrt)
    top = counts.where(toxic >= least_toxic).withColumn("score", score).where("score > 0").orderBy(F.desc("score"), "word").limit(most_words).collect()
    out: list[dict[str, float]] = []
    for without in [*range(FOLDS), None]:
        kept = np.array([f != without for f in range(FOLDS)])
        found = {}
        for r in top:
            p, n = (float(sum(r[f"n{t}{f}"] for f in range(FOLDS) if kept[f])) for t in (1, 0))
            weight = odds(p, n, sums[1][kept].sum(), sums[0][kept].sum(), math.log, math.sqrt)
            if p >= least_toxic * kept.mean() and weight > 0:
                found[r.word] = weight
        out.append(found)
    return out


class Toxicity:
    """What score() applies: the lexicon, the trees and the calibration."""

    def __init__(self, lexicon: dict[str, float], trees: GBTClassificationModel, calibration, given: frozenset[str], person: frozenset[str]):
        self.lexicon, self.trees, self.calibration, self.given, self.person = lexicon, trees, calibration, given, person


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """`rows` with the trees' margin."""
    scored = trees.transform(rows)
    return scored.withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", most_rows: int = 20_000, trees: int = 12, depth: int = 3, given: list[str] = INSULTS, person: list[str] = SECOND_PERSON) -> Toxicity | None:
    """Learn from at most `most_rows` labelled documents; None if they are all of one class.

    Rows whose crc32(doc_id) mod 3 is 1 are never learned from. A document labelled more than once counts as toxic if any
    label says so.
    """
    rows = table(_labelled(docs, labels, label, most_rows), "toxic-rows")
    if len({r.toxic for r in rows.select((F.col("y") > 0.5).alias("toxic")).distinct().collect()}) < 2:
        return None
    lexicons = learn_lexicon(rows)
    by_fold = rows.sparkSession.sparkContext.broadcast((lexicons, frozenset(given), frozenset(person)))

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, *lists = by_fold.value
        readers = [Reader(lexicon, *lists, most=50_000) for lexicon in known]
        for batch in batches:
            yield pd.DataFrame({"y": (batch["y"] > 0.5).astype(float), "half": batch["fold"] % 2, "x": [readers[f].vector(t) for t, f in zip(batch["text"], batch["fold"], strict=True)]})

    made = table(rows.select("y", "fold", "text").mapInPandas(emit, "y double, half int, x array<double>"), "toxic-vectors")
    vectors = made.coalesce(rows.sparkSession.sparkContext.defaultParallelism).select("y", "half", array_to_vector("x").alias("features"))
    learner = GBTClassifier(labelCol="y", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=3, seed=1)
    halves = [vectors.where(F.col("half") == i) for i in (0, 1)]
    whole = all(h.select("y").distinct().count() == 2 for h in halves)
    judged = [_margin(learner.fit(halves[1 - i]), halves[i]) for i in (0, 1)] if whole else []
    final = learner.fit(vectors)
    tested = table((judged[0].unionByName(judged[1]) if judged else _margin(final, vectors)).select("y", "margin"), "toxic-margins")
    calibration = IsotonicRegression(labelCol="y", featuresCol="margin", predictionCol="score").fit(tested)
    return Toxicity(lexicons[-1], final, calibration, frozenset(given), frozenset(person))


_workers: dict = {}


def _reader(known) -> Reader:
    """This worker's reader of the broadcast lists; its cache lives as long as they do."""
    if _workers.get("of") is not known.value:
        _workers.update(of=known.value, reader=Reader(*known.value))
    return _workers["reader"]


def score(docs: DataFrame, model: Toxicity | None, cut: float = 0.7) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 if score >= cut, else 0); every row is kept, whole texts are read.

    Null and empty texts are scored as texts without words. Without a model all rows score 0. Equal texts score the same.
    Columns of the two names are replaced, others stay; an empty table gives an empty table.
    """
    if model is None:
        scored = put(docs, score=F.lit(0.0))
    else:
        known = docs.sparkSession.sparkContext.broadcast((model.lexicon, model.given, model.person))

        @F.pandas_udf("array<double>")
        def vector(texts: pd.Series) -> pd.Series:
            reader = _reader(known)
            return pd.Series([reader.vector(t) for t in texts], dtype=object)

        own = [spare(docs, name) for name in ("_vector", "_raw", "_probability", "_class", "_margin", "_score")]
        trees = model.trees.copy().setFeaturesCol(own[0]).setRawPredictionCol(own[1]).setProbabilityCol(own[2]).setPredictionCol(own[3])
        calibration = model.calibration.copy().setFeaturesCol(own[4]).setPredictionCol(own[5])
        judged = trees.transform(docs.withColumn(own[0], array_to_vector(vector(F.col("text").cast("string")))))
        judged = calibration.transform(judged.withColumn(own[4], vector_to_array(own[1])[1]))
        scored = put(judged, score=F.least(F.greatest(F.col(own[5]), F.lit(0.0)), F.lit(1.0))).drop(*own)
    return put(scored, predicted=(F.col("score") >= cut).cast("int"))


def op11_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score(docs, fit(docs, labels))
    return scored.select("doc_id", _held().alias("held_out"), "score", "predicted")
