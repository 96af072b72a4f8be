"""Benchmark decontamination by spaced-seed hashing; DataFrame functions only.

Texts become token hashes. A mask is laid over every stretch of tokens; the hash of the positions that it keeps is a
seed. Test and training seeds are joined, so a copy is found although some tokens at ignored positions were replaced.
Through each hit the two texts are aligned whole and compared token by token; the longest stretch that agrees well enough
is an overlap if it is long enough.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import maybe_broadcast, table

#: Tokens: lower-cased runs of anything but ASCII white space, controls and punctuation.
SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: 1 keeps a position, 0 ignores it. Whichever fifth of the tokens of a stretch of 12 to 160 tokens is replaced, one of
#: these masks lies on equal tokens alone (test_masks_hit_every_stretch); longer stretches hold such a shorter one.
MASKS = ("110111", "100001111")
#: Items of fewer tokens have masks as long as themselves (whole_masks).
MASKED_FROM = 12


def token_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def whole_masks(n: int, least_equal: float = 0.8) -> tuple[str, ...]:
    """Masks of n positions: whichever tokens of n are replaced, if the share `least_equal` stays, one mask ignores them all.

    The positions are cut into two blocks more than tokens may be replaced; each mask ignores as many blocks as these.
    """
    replaced = int(n * (1 - least_equal) + 1e-9)
    block = [k * (replaced + 2) // n for k in range(n)]
    blocks = sorted(set(block))
    return tuple("".join("0" if b in out else "1" for b in block) for out in combinations(blocks, min(replaced, len(blocks) - 1)))


def _seeds(rows: DataFrame, masks: tuple[str, ...], keep: list[str]) -> DataFrame:
    """keep, at, seed: one row for each mask at each position of `h` where it fits."""
    fits = rows.where(F.size("h") >= min(map(len, masks)))
    # the tokens behind each position stand beside it, null behind the end, so that the array isn't copied to each
    ahead = F.arrays_zip(*[F.slice("h", k + 1, F.greatest(F.size("h") - k, F.lit(0))).alias(f"t{k}") for k in range(max(map(len, masks)))])
    placed = fits.select(*keep, F.posexplode(ahead).alias("at", "t"))
    token = lambda k: F.col(f"t.t{k}")
    seeds = [F.when(token(len(m) - 1).isNotNull(), F.xxhash64(F.lit(m), *[token(k) for k, kept in enumerate(m) if kept == "1"])) for m in masks]
    return placed.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed")).where("seed IS NOT NULL")


def _scan(xs: Column, combine) -> Column:
    """The running values of `combine`, which takes a null on its left for nothing, over the array `xs`.

    Built in some sqrt(n) blocks of as many values: an array that grows by one is copied, so that one block alone would
    take time with the square of n.
    """
    def running(part: Column) -> Column:
        return F.aggregate(part, F.slice(part, 1, F.lit(0)), lambda done, x: F.concat(done, F.array(combine(F.get(done, F.size(done) - 1), x))))

    def blocks(xs: Column) -> Column:
        wide = F.greatest(F.ceil(F.sqrt(F.size(xs))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / wide).cast("int")), lambda b: running(F.slice(xs, b * wide + 1, wide)))

    def joined(parts: Column) -> Column:
        upto = running(F.transform(parts, lambda p: F.element_at(p, -1)))
        return _let(upto, lambda upto: F.flatten(F.transform(parts, lambda part, i: _let(F.get(upto, i - 1), lambda above: F.transform(part, lambda x: combine(above, x))))))

    return _let(xs, lambda xs: _let(blocks(xs), joined))


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _longest(equal: Column, share: float) -> Column:
    """(start, size) of the longest stretch of the flags `equal` with at least `share` of them true; the first of several.

    With prefix sums that rise by 1 - share or fall by share, a stretch is good if its end isn't below its start. Two
    pointers walk over the least sum up to a start and the greatest from an end on. In millionths, as whole numbers.
    """
    whole, cost = F.lit(10**6).cast("long"), F.lit(round(share * 10**6)).cast("long")

    steps = F.concat(F.array(F.lit(0).cast("long")), F.transform(equal, lambda e: F.when(e, whole).otherwise(F.lit(0).cast("long")) - cost))
    sums = _scan(steps, lambda a, b: F.coalesce(a, F.lit(0).cast("long")) + b)
    ends = lambda sums: F.struct(_scan(sums, F.least).alias("low"), F.reverse(_scan(F.reverse(sums), F.greatest)).alias("high"))
    state = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("start"), F.lit(0).alias("size"))

    def step(low: Column, high: Column, at: Column) -> Column:
        over = (at["i"] >= F.size(low)) | (at["j"] >= F.size(low))
        good = ~over & (F.get(low, at["i"]) <= F.get(high, at["j"]))
        more = good & (at["j"] - at["i"] > at["size"])
        return F.struct(F.when(over | good, at["i"]).otherwise(at["i"] + 1).alias("i"), F.when(good, at["j"] + 1).otherwise(at["j"]).alias("j"),
                        F.when(more, at["i"]).otherwise(at["start"]).alias("start"), F.when(more, at["j"] - at["i"]).otherwise(at["size"]).alias("size"))

    def walk(b: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), 2 * F.size(b["low"])), state, lambda at, _: step(b["low"], b["high"], at), lambda at: F.struct(at["start"].alias("start"), at["size"].alias("size")))

    return _let(_let(sums, ends), walk)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", least_tokens: int = 13, least_equal: float = 0.8) -> DataFrame:
    """(doc_id, item_id, doc_token, item_token, n_aligned, n_equal): the best overlap of each document and item.

    Each hit aligns a document and an item as far as both go; the longest stretch of the alignment of which the share
    `least_equal` agrees is an overlap if it has `least_tokens` tokens (or the whole item, if that is shorter). Items
    shorter than MASKED_FROM tokens are sought as a whole, with masks of their own length; of items below five tokens, at
    a share of 0.8, no token can be replaced. Null and empty texts overlap with nothing; rows that repeat a doc_id are taken for one document's parts; equally good overlaps: the first in the document, then in
    the item. Empty tables give an empty table; other columns don't matter.
    """
    items = table(benchmark.select(F.col(item_id).alias("item_id"), token_hashes(F.col(item_text)).alias("h")).where(F.size("h") > 0).groupBy("h").agg(F.collect_set("item_id").alias("items")), "decon-items")
    items = items.withColumn("key", F.element_at(F.array_sort("items"), 1))
    span = max(map(len, masks))
    below = max(MASKED_FROM, span)
    short = sorted(r.n for r in items.select(F.size("h").alias("n")).where(F.col("n") < below).distinct().collect())  # fewer than `below` numbers
    rows = docs.select(F.col(doc_id).alias("doc_id"), token_hashes(F.col(text)).alias("h"))
    groups = [(masks, items.where(F.size("h") >= span)), *[(whole_masks(n, least_equal), items.where(F.size("h") == n)) for n in short]]
    wanted = reduce(DataFrame.unionByName, [_seeds(of, group, ["key"]) for group, of in groups]).select("seed", "key", F.col("at").alias("item_at")).distinct()
    used = tuple(dict.fromkeys(m for group, _ in groups for m in group))
    found = _seeds(rows, used, ["doc_id"]).join(maybe_broadcast(table(wanted, "decon-seeds")), "seed").select("doc_id", "key", (F.col("at") - F.col("item_at")).alias("shift"))
    hits = table(found.distinct(), "decon-hits")
    with_hits = rows.join(maybe_broadcast(hits.select("doc_id").distinct()), "doc_id", "left_semi")
    sides = hits.join(with_hits, "doc_id").join(maybe_broadcast(items.select("key", "items", F.col("h").alias("item_h"))), "key")
    sides = sides.withColumn("doc_from", F.greatest(F.col("shift"), F.lit(0))).withColumn("item_from", F.greatest(-F.col("shift"), F.lit(0)))
    both = F.least(F.size("h") - F.col("doc_from"), F.size("item_h") - F.col("item_from"))
    equal = F.zip_with(F.slice("h", F.col("doc_from") + 1, both), F.slice("item_h", F.col("item_from") + 1, both), lambda a, b: a == b)
    needed = F.least(F.lit(least_tokens), F.size("item_h"))
    # A repeated doc_id can make a shift that another part of the document doesn't reach.
    aligned = sides.where(both >= needed).select("doc_id", "items", "doc_from", "item_from", needed.alias("needed"), equal.alias("equal"))
    likely = table(aligned.where(F.size(F.filter("equal", lambda e: e)) >= least_equal * F.col("needed")), "decon-likely")
    placed = likely.withColumn("best", _longest(F.col("equal"), least_equal)).where(F.col("best.size") >= F.col("needed"))
    good = placed.select("items", "doc_id", (F.col("doc_from") + F.col("best.start")).alias("doc_token"), (F.col("item_from") + F.col("best.start")).alias("item_token"), F.col("best.size").alias("n_aligned"),
                         F.size(F.filter(F.slice("equal", F.col("best.start") + 1, F.col("best.size")), lambda e: e)).alias("n_equal"))
    order = F.struct("n_equal", -F.col("doc_token"), -F.col("item_token"))
    best = good.withColumn("item_id", F.explode("items")).groupBy("doc_id", "item_id").agg(F.max_by(F.struct("doc_token", "item_token", "n_aligned", "n_equal"), order).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without the documents that overlap with an item; rows with a null doc_id stay. Options: find_overlaps."""
    key = options.get("doc_id", "doc_id")
    dirty = find_overlaps(docs, benchmark, **options).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(maybe_broadcast(table(dirty, "decon-dirty")), key, "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find_overlaps(docs.select("doc_id", "text"), items.select("item_id", "text"))


_TOKENS = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: w <> '')"
# All alignments that share enough neighbouring tokens, without seeds: what the masks find must be what there is.
SQL = f"""
WITH d AS (SELECT doc_id, {_TOKENS} AS h FROM documents), b AS (SELECT item_id, {_TOKENS} AS h FROM benchmark),
dg AS (SELECT doc_id, i, h[i] || ' ' || h[i + 1] AS g FROM (SELECT doc_id, h, unnest(range(1, len(h))) AS i FROM d)),
bg AS (SELECT item_id, i, n, h[i] || ' ' || h[i + 1] AS g FROM (SELECT item_id, h, len(h) AS n, unnest(range(1, len(h))) AS i FROM b)),
shifts AS (SELECT doc_id, item_id, dg.i - bg.i AS shift FROM dg JOIN bg USING (g) GROUP BY ALL HAVING count(*) >= least(3, min(n) - 1 - 2 * (min(n) // 5))),
a AS (SELECT doc_id, item_id, greatest(shift, 0) AS df, greatest(-shift, 0) AS bf, least(len(d.h) - greatest(shift, 0), len(b.h) - greatest(-shift, 0)) AS n, least(13, len(b.h)) AS needed, d.h AS dh, b.h AS bh
    FROM shifts JOIN d USING (doc_id) JOIN b USING (item_id)),
e AS (SELECT doc_id, item_id, df, bf, n, needed, list_transform(range(1, n + 1), lambda k: CASE WHEN dh[df + k] = bh[bf + k] THEN 1 ELSE 0 END) AS eq FROM a WHERE n >= needed),
s AS (SELECT *, list_transform(range(0, n + 1), lambda k: CAST(coalesce(5 * list_sum(eq[1:k]), 0) - 4 * k AS BIGINT)) AS up FROM e),
j AS (SELECT *, unnest(range(needed, n + 1)) AS stop FROM s),
i AS (SELECT *, unnest(range(0, stop - needed + 1)) AS start FROM j),
best AS (SELECT doc_id, item_id, df + start AS doc_token, bf + start AS item_token, stop - start AS n_aligned, list_sum(eq[start + 1:stop]) AS n_equal FROM i WHERE up[stop + 1] >= up[start + 1]
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, df, bf ORDER BY stop - start DESC, start) = 1)
SELECT doc_id, item_id, CAST(doc_token AS INTEGER) AS doc_token, CAST(item_token AS INTEGER) AS item_token, CAST(n_aligned AS INTEGER) AS n_aligned, CAST(n_equal AS INTEGER) AS n_equal
FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_equal DESC, doc_token, item_token) = 1
"""
