"""Embedding near-dedup over a robust-pruned flat graph.

Centroids of a bounded sample cut the vectors into shards; each vector lies in its `overlap` nearest ones. Shards (large
ones in blocks) build robust-pruned neighbour lists, and the lists of all shards are united to one flat graph. Every
vector is then a query: best-first search from a block's medoid along the graph, then range expansion through all that
lies near the threshold. What is found is verified in double precision.

Pairs aren't written: a pair is counted in the least shard that its vectors share, and each block gives its links'
components as stars, so the output grows with the vectors even where thousands are alike. Equal vectors are one class
from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, maybe_broadcast, table
from .graphs import components

BLOCK = 2_048


def normal(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    big = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where(big > 0, big, 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spread rows of the sample."""
    centroids = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centroids)
    return centroids


def robust_prune(x: np.ndarray, degree: int, candidates: int, alpha: float) -> list[np.ndarray]:
    """Neighbours of each row: nearest first, without those that a kept neighbour is closer to by the factor alpha."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    far = np.maximum(2 - 2 * (x @ x.T), 0)
    np.fill_diagonal(far, np.inf)
    c = min(candidates, n - 1)
    near = np.argpartition(far, c - 1, axis=1)[:, :c]
    rows = np.arange(n)[:, None]
    near = np.take_along_axis(near, np.argsort(far[rows, near], axis=1, kind="stable"), axis=1)
    own = far[rows, near]
    alive = np.ones_like(near, bool)
    kept = np.zeros_like(alive)
    for _ in range(min(degree, c)):
        first = alive.argmax(axis=1)
        some = alive[rows[:, 0], first]
        if not some.any():
            break
        kept[rows[some, 0], first[some]] = True
        chosen = near[rows[:, 0], first]
        alive &= ~((alpha * alpha * far[chosen[:, None], near] <= own) & some[:, None])
        alive[rows[some, 0], first[some]] = False
    np.fill_diagonal(far, 0)
    return [near[i, kept[i]] for i in range(n)]


def range_search(x: np.ndarray, neighbours: list[np.ndarray], queries: np.ndarray, hops: int, near: float) -> np.ndarray:
    """Similarities (queries x rows; -2 where never met): best-first from the medoid, then through all at `near` or more."""
    n, q = len(x), len(queries)
    degrees = np.array([len(v) for v in neighbours])
    starts = np.cumsum(degrees) - degrees
    flat = np.concatenate(neighbours) if degrees.sum() else np.zeros(0, np.int64)
    met = np.full((q, n), -2.0, np.float32)
    done = np.zeros((q, n), bool)
    mean = x.mean(axis=0)
    medoid = int((x @ mean).argmax())
    met[:, medoid] = queries @ x[medoid]

    def expand(who: np.ndarray, node: np.ndarray) -> None:
        done[who, node] = True
        size = degrees[node]
        a = np.repeat(who, size)
        b = flat[np.repeat(starts[node] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        new = met[a, b] < -1.5
        a, b = a[new], b[new]
        for i in range(0, len(a), 100_000):
            u, v = a[i : i + 100_000], b[i : i + 100_000]
            met[u, v] = np.einsum("ij,ij->i", queries[u], x[v])

    everyone = np.arange(q)
    for _ in range(min(hops, n)):
        open_ = np.where(done, -3.0, met)
        best = open_.argmax(axis=1)
        go = open_[everyone, best] > -1.5
        if not go.any():
            break
        expand(everyone[go], best[go])
    while True:
        who, node = np.nonzero((met >= near) & ~done)
        if not len(who):
            return met
        for i in range(0, len(who), 20_000):
            expand(who[i : i + 20_000], node[i : i + 20_000])


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that each row of a symmetric link matrix reaches."""
    label = ids.copy()
    big = np.iinfo(np.int64).max
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], big).min(axis=1))
        if (least == label).all():
            return label
        label = least


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95, shard_size: int = 1_000, overlap: int = 3, sample_rows: int = 20_000,
                 most_shards: int = 4_096, degree: int = 24, candidates: int = 64, alpha: float = 1.2, hops: int = 32, slack: float = 0.05) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors`.

    A link joins two vectors of cosine >= `least`; component_id is the smallest vec_id reachable by links, kept marks it.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths with each other. Equal vectors are linked, repeated rows too. Recall is that of the search (see
    audit); no false link is made. Centroids are fitted on at most `sample_rows` vectors; every vector is indexed and
    is a query. An empty table gives an empty table; other columns don't matter.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    sound = v.isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))) & F.exists("v", lambda e: e != 0)
    named = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v")).withColumn("sound", F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())
    named = named.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))
    slim = table(named.select("vec_id", "sound", "k1", "k2"), "vec-names")
    classes = table(named.where("sound").groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"), F.first("v").alias("v")).withColumn("dim", F.size("v")), "vec-classes")
    dims = {r.dim: r["count"] for r in classes.groupBy("dim").count().collect()}
    picked = classes.orderBy(F.xxhash64("k1"), "rep").limit(sample_rows).select("dim", "v").toPandas()
    centroids = {}
    for dim, n in dims.items():
        x = [a for d, a in zip(picked["dim"], picked["v"], strict=True) if d == dim]
        if x:
            centroids[dim] = fit_centroids(normal(x), max(1, min(most_shards, len(x), round(n / shard_size))))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                middle = shared.value.get(dim)
                if middle is None:
                    near = np.zeros((len(part), 1), np.int64)
                else:
                    similar = normal(part["v"]) @ middle.T
                    k = min(overlap, similar.shape[1])
                    near = np.sort(np.argpartition(-similar, k - 1, axis=1)[:, :k], axis=1)
                yield pd.DataFrame({"dim": part["dim"], "rep": part["rep"], "m": part["m"], "v": part["v"], "shards": list(near)})

    dealt = classes.select("dim", "rep", "m", "v").mapInPandas(assign, "dim int, rep long, m long, v array<double>, shards array<long>")
    dealt = table(dealt.withColumn("shard", F.explode("shards")), "vec-dealt")
    sizes = table(dealt.groupBy("dim", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "vec-sizes")
    sources = [dealt, sizes]
    dealt = dealt.join(maybe_broadcast(sizes), ["dim", "shard"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        ids = part["rep"].to_numpy()
        lists = robust_prune(normal(part["v"]), degree, candidates, alpha)
        a = np.concatenate([np.repeat(ids, [len(x) for x in lists]), ids])
        b = np.concatenate([ids[np.concatenate(lists)] if len(ids) > 1 else ids[:0], np.roll(ids, 1)])  # a ring keeps each block connected
        return pd.DataFrame({"rep": np.concatenate([a, b]), "to": np.concatenate([b, a])})

    edges = dealt.groupBy("dim", "shard", "block").applyInPandas(build, "rep long, to long").where("rep <> to")
    graph = edges.groupBy("rep").agg(F.collect_set("to").alias("near"))
    placed = table(dealt.join(graph, "rep", "left"), "vec-graph")
    drop(*sources)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = placed.withColumn("other", other).where("other >= block").select("*", F.col("block").alias("ib"), F.col("other").alias("qb"), F.lit(True).alias("indexed"), (F.col("block") == F.col("other")).alias("asks"))
    pairs = pairs.unionByName(placed.withColumn("other", other).where("other < block").select("*", F.col("other").alias("ib"), F.col("block").alias("qb"), F.lit(False).alias("indexed"), F.lit(True).alias("asks")))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        indexed, asks = part["indexed"].to_numpy(bool), part["asks"].to_numpy(bool)
        ids, m, shard = part["rep"].to_numpy(), part["m"].to_numpy(), part["shard"].iloc[0]
        vectors = normal(part["v"])
        if not indexed.any() or not asks.any():
            return pd.DataFrame({"rep": ids[:0], "n": m[:0], "root": ids[:0]})
        inside = np.flatnonzero(indexed)
        order = inside[np.argsort(ids[inside])]
        known = ids[order]
        lists = []
        for near in part["near"].iloc[order]:
            to = np.asarray(near if near is not None else [], np.int64)
            at = np.minimum(np.searchsorted(known, to), len(known) - 1)
            lists.append(at[known[at] == to])
        who = np.flatnonzero(asks)
        met = range_search(vectors[order], lists, vectors[who], hops, least - slack)
        qi, xi = np.nonzero(met >= least - 1e-4)
        a, b = who[qi], order[xi]
        exact = np.concatenate([np.einsum("ij,ij->i", vectors[a[i : i + 100_000]], vectors[b[i : i + 100_000]]) for i in range(0, len(a), 100_000)]) if len(a) else np.zeros(0)
        good = (exact >= least) & (a != b)
        linked = np.zeros((len(part), len(part)), bool)
        linked[a[good], b[good]] = True
        linked |= linked.T
        root = _roots(linked, ids)
        first = np.array([list(s) + [np.iinfo(np.int64).max] * (overlap - len(s)) for s in part["shards"]])
        ours = np.zeros(len(part), np.int64)
        for i in range(0, len(part), 256):  # a pair counts where no smaller shard holds both
            x, y = np.nonzero(linked[i : i + 256])
            x += i
            u, v = first[x], first[y]
            both = (u[:, :, None] == v[:, None, :]).any(axis=2) & (u < np.iinfo(np.int64).max)
            mine = np.where(both, u, np.iinfo(np.int64).max).min(axis=1) == shard
            np.add.at(ours, x[mine], m[y[mine]])
        return pd.DataFrame({"rep": ids, "n": ours, "root": root})

    found = table(pairs.groupBy("dim", "shard", "ib", "qb").applyInPandas(search, "rep long, n long, root long"), "vec-found")
    drop(placed)
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).where("a <> b"))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    result = classes.select("k1", "k2", "rep", "m").join(counts, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    result = result.select("k1", "k2", F.lit(True).alias("sound"), (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    rows = slim.join(result, ["k1", "k2", "sound"], "left")
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def audit(vectors: DataFrame, found: DataFrame, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95) -> float:
    """Recall of `found` (near_vectors of `vectors`) over the rows whose id is divisible by `every`, by brute force."""
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).where(F.col("v").isNotNull())
    asked = rows.where(F.col("vec_id") % every == 0).toPandas()
    usable = lambda batch: np.array([len(v) > 0 and np.isfinite(np.asarray(v, float)).all() and np.any(v) for v in batch["v"]], bool)
    asked = asked[usable(asked)]
    by_length = {n: (part["vec_id"].to_numpy(), normal(part["v"])) for n, part in asked.groupby(asked["v"].map(len))}
    shared = vectors.sparkSession.sparkContext.broadcast(by_length)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[usable(batch)]
            for length, part in batch.groupby(batch["v"].map(len)):
                if length in shared.value:
                    ids, x = shared.value[length]
                    near = normal(part["v"]) @ x.T >= least
                    near &= part["vec_id"].to_numpy()[:, None] != ids[None, :]
                    yield pd.DataFrame({"vec_id": ids, "n": near.sum(axis=0)})

    true = rows.mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    both = true.join(found, "vec_id").agg(F.sum(F.least("n", "n_links")).alias("got"), F.sum("n").alias("all")).first()
    return 1.0 if not both["all"] else both["got"] / both["all"]


def op1_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
