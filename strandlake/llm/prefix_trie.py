"""Conversation prefix trie by double-array tries.

A conversation's turns are numbered, its head may be borrowed from another conversation, and every turn becomes a key of
its depth, role and text. A node is named by the keys on its way, each of two 64-bit lanes; a way of more than SPAN
turns is cut into segments, so that no row grows with a conversation. Equal segments are counted once. Segments are
sorted, so that tasks hold neighbours in the trie; each task packs runs of them into double arrays (BASE and CHECK over
dense turn ids), walks all segments through them at once and gives each node's aggregates. Nodes that several runs
share, the upper ones above all, are merged by a group over the names.

Sums over subtrees follow the chains that the smallest members own: a conversation that is the smallest member of a
node is so in all nodes below it on its way. A chain's sum is a running sum; what hangs below a node of another chain
is carried up by a second walk through the tries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import maybe_broadcast, table
from .spelling import CRC_TABLE, crc_sql

#: Turns of a segment, and rows that a window over one key may hold before it is cut into blocks.
SPAN, BLOCK = 64, 4_096
#: A conversation borrows at most so many turns, from the first of each family of so many ids.
MOST_BORROWED, FAMILY = 8, 5


def turns_in_order(turns: DataFrame, most: int = BLOCK) -> DataFrame:
    """(conv_id, p, k1, k2, size): each turn's place in its conversation, by turn (null first), role and text; two hashes of
    role and text, and the text's UTF-8 bytes.

    Conversations of more than `most` turns are cut by the number of the turn into blocks of about that size, which are
    numbered by themselves.
    """
    rows = turns.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spans = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").cast("double").alias("low"), F.max("turn").cast("double").alias("high")).where((F.col("n") > most) & F.col("low").isNotNull())
    long = table(spans.select("conv_id", "low", F.greatest(F.lit(1.0), (F.col("high") - F.col("low") + 1) / F.ceil(F.col("n") / most)).alias("width")), "trie-long")
    block = F.when(F.col("low").isNull(), 0).when(F.col("turn").isNull(), -1).otherwise(F.floor((F.col("turn").cast("double") - F.col("low")) / F.col("width"))).cast("long")
    dealt = rows.join(maybe_broadcast(long), "conv_id", "left").withColumn("block", block)
    counts = dealt.where("low IS NOT NULL").groupBy("conv_id", "block").agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1))  # a row a block
    before = table(counts.select("conv_id", "block", ahead.alias("before")), "trie-blocks")
    own = F.row_number().over(W.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    placed = dealt.withColumn("own", own).join(maybe_broadcast(before), ["conv_id", "block"], "left")
    return placed.select("conv_id", (F.col("own") + F.coalesce("before", F.lit(0))).cast("long").alias("p"), F.xxhash64("role", "text").alias("k1"), F.xxhash64("text", F.lit(1), "role").alias("k2"), F.octet_length("text").cast("long").alias("size"))


def rebuild(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, d, k1, k2, size) of the rebuilt conversations, and (conv_id, length) of all of them.

    The remainders are SQL's: those of negative ids are negative.
    """
    borrowed = F.crc32(F.col("conv_id").cast("string")) % (MOST_BORROWED + 1)
    convs = placed.groupBy("conv_id").agg(F.count("*").alias("n")).withColumn("src", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", borrowed)
    sources = convs.where("conv_id = src").select("src", F.col("n").alias("m"))
    info = convs.join(sources, "src", "left").select("conv_id", "src", "h", F.least("h", F.coalesce("m", F.lit(0))).alias("taken"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"))
    info = table(info.withColumn("length", F.col("taken") + F.col("rest")), "trie-conversations")
    short = table(info.where("taken < h").select("conv_id", "taken"), "trie-short")
    kept = placed.withColumn("h", borrowed).where("p > h").join(maybe_broadcast(short), "conv_id", "left")
    kept = kept.select("conv_id", (F.col("p") - F.col("h") + F.coalesce("taken", F.col("h"))).alias("d"), "k1", "k2", "size")
    heads = placed.where(F.col("p") <= MOST_BORROWED).where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("src"), F.col("p").alias("d"), "k1", "k2", "size")
    lent = info.where("taken > 0").select("conv_id", "src", "taken").join(heads, "src").where("d <= taken").select("conv_id", "d", "k1", "k2", "size")
    return kept.unionByName(lent), info.select("conv_id", "length")


def _carried(rows: DataFrame, key: list[str], at: str, value: str, how, upward: bool) -> DataFrame:
    """`rows` with _inner and _carry, which together are `how` over the values of the key's rows ahead: those before this one by
    `at` or, if upward, this one and those of greater `at`; null over none. `at` counts rows of a key; no window over rows
    holds more than BLOCK of them, that over the blocks a row each."""
    sign = -1 if upward else 1
    rows = rows.withColumn("_block", F.floor(F.col(at) / BLOCK))
    inner = how(value).over(W.partitionBy(*key, "_block").orderBy(sign * F.col(at)).rowsBetween(W.unboundedPreceding, 0 if upward else -1))
    blocks = rows.groupBy(*key, "_block").agg(how(value).alias("_sum"))
    outer = how("_sum").over(W.partitionBy(*key).orderBy(sign * F.col("_block")).rowsBetween(W.unboundedPreceding, -1))
    carry = table(blocks.withColumn("_carry", outer).where("_carry IS NOT NULL").drop("_sum"), "trie-carry")  # later blocks of long keys
    return rows.withColumn("_inner", inner).join(maybe_broadcast(carry), [*key, "_block"], "left").select(*[c for c in rows.columns if c != "_block"], "_inner", "_carry")


def segments(turns: DataFrame) -> DataFrame:
    """(conv_id, j, ga, gb, size, xa, xb, ba, bb): the keys of up to SPAN turns each, their xor in two lanes, and that of all
    segments before, which names the node above."""
    keyed = turns.select("conv_id", F.floor((F.col("d") - 1) / SPAN).alias("j"), F.struct("d", F.xxhash64("d", "k1").alias("ga"), F.xxhash64("k2", "d").alias("gb"), "size").alias("t"))
    cut = keyed.groupBy("conv_id", "j").agg(F.sort_array(F.collect_list("t")).alias("t"), F.bit_xor("t.ga").alias("xa"), F.bit_xor("t.gb").alias("xb"))
    kept = table(cut.select("conv_id", "j", F.col("t.ga").alias("ga"), F.col("t.gb").alias("gb"), F.col("t.size").alias("size"), "xa", "xb"), "trie-cut")
    narrow = kept.where(F.size("ga") == SPAN).select("conv_id", (F.col("j") + 1).alias("j"), "xa", "xb").unionByName(kept.where("j > 0").select("conv_id", "j", F.lit(0).cast("long").alias("xa"), F.lit(0).cast("long").alias("xb")))
    steps = narrow.groupBy("conv_id", "j").agg(F.bit_xor("xa").alias("xa"), F.bit_xor("xb").alias("xb"))
    names = steps.select("conv_id", "j")
    for lane in ("a", "b"):
        own = F.coalesce(F.col("_inner"), F.lit(0)).bitwiseXOR(F.coalesce(F.col("_carry"), F.lit(0))).bitwiseXOR(F.col(f"x{lane}"))
        one = _carried(steps.select("conv_id", "j", f"x{lane}"), ["conv_id"], "j", f"x{lane}", F.bit_xor, False).select("conv_id", "j", own.alias(f"b{lane}"))
        names = names.join(one, ["conv_id", "j"])
    zero = F.lit(0).cast("long")
    first = kept.where("j = 0").withColumn("ba", zero).withColumn("bb", zero)
    return table(first.unionByName(kept.where("j > 0").join(names, ["conv_id", "j"])), "trie-segments")


class DoubleArray:
    """A trie of rows of symbols in BASE and CHECK: the child of state s by symbol c is t = BASE[s] + c if CHECK[t] is s."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Rows are symbols[starts : starts + sizes] each; the root is state 0. Built level by level."""
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -2, np.int64)  # -2: the root, -1: free
        self._low = 1
        self.width = int(symbols.max()) + 1 if len(symbols) else 1
        at = np.zeros(len(starts), np.int64)
        self.states: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of each level: rows, their states, the states above
        level, live = 0, np.flatnonzero(sizes > 0)
        while len(live):
            above, symbol = at[live], symbols[starts[live] + level]
            order = np.lexsort((symbol, above))
            a, c = above[order], symbol[order]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
            a, c = a[new], c[new]
            cuts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1], [True]]))
            for first, last in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                self._place(int(a[first]), c[first:last])
            at[live] = self.base[above] + symbol
            self.states.append((live, at[live].copy(), above))
            level += 1
            live = live[sizes[live] > level]

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _place(self, state: int, symbols: np.ndarray) -> None:
        """Give the state the first base at which all children fall on free places."""
        step, low, look = symbols - symbols[0], self._low, 64
        while True:
            self._grow(low + look + int(step[-1]) + 1)
            free = low + np.flatnonzero(self.check[low : low + look] == -1)
            fits = free if len(step) == 1 else free[(self.check[free[:, None] + step] == -1).all(axis=1)]
            if len(fits):
                break
            low, look = low + look, 2 * look
        at = int(fits[0])
        self.base[state] = at - int(symbols[0])
        self.check[at + step] = state
        while self._low < len(self.check) and self.check[self._low] != -1:
            self._low += 1

    def walk(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The children of the states by the symbols; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to >= 0) & (to < len(self.check)) & (states >= 0)
        return np.where(inside & (self.check[np.where(inside, to, 0)] == states), to, -1)


def _run(batch: pa.RecordBatch, span: int) -> pa.RecordBatch:
    """The nodes of a run of segments (ba, bb, j, ga, gb, size, x, y, z) of `span` turns: name, name above, depth, bytes, sums of x and y and
    least z of the segments through it."""
    column = lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(batch.column("ga").offsets.to_numpy().astype(np.int64))
    ga, gb, size = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("ga", "gb", "size"))
    starts = np.cumsum(sizes) - sizes
    ba, bb, j = column("ba"), column("bb"), column("j")
    values = {"x": column("x"), "y": column("y"), "z": column("z")}

    def dense(*keys: np.ndarray) -> np.ndarray:
        order = np.lexsort(keys)
        new = np.zeros(len(order), np.int64)
        for k in keys:
            new[1:] |= k[order][1:] != k[order][:-1]
        ids = np.empty(len(order), np.int64)
        ids[order] = np.cumsum(new)
        return ids

    # one double array for all: the first symbol stands for the name of the node above
    roots, turn = dense(ba, bb, j), dense(ga, gb)
    whole = np.empty(len(turn) + len(sizes), np.int64)
    heads = starts + np.arange(len(sizes))
    inner = np.ones(len(whole), bool)
    inner[heads] = False
    whole[heads], whole[inner] = roots, turn
    trie = DoubleArray(whole, heads, sizes + 1)
    n = len(trie.check)
    out = {c: np.zeros(n, np.int64) for c in ("a", "b", "pa", "pb", "depth", "bytes", "x", "y")} | {"z": np.full(n, np.iinfo(np.int64).max)}
    lane_a, lane_b, state = ba.copy(), bb.copy(), np.zeros(len(sizes), np.int64)
    state = trie.walk(state, roots)
    for level in range(int(sizes.max()) if len(sizes) else 0):
        rows = np.flatnonzero(sizes > level)
        at = starts[rows] + level
        to = trie.walk(state[rows], turn[at])
        out["pa"][to], out["pb"][to] = lane_a[rows], lane_b[rows]
        lane_a[rows] ^= ga[at]
        lane_b[rows] ^= gb[at]
        out["a"][to], out["b"][to], out["depth"][to], out["bytes"][to] = lane_a[rows], lane_b[rows], span * j[rows] + level + 1, size[at]
        np.add.at(out["x"], to, values["x"][rows])
        np.add.at(out["y"], to, values["y"][rows])
        np.minimum.at(out["z"], to, values["z"][rows])
        state[rows] = to
    kept = np.flatnonzero(out["depth"] > 0)
    return pa.RecordBatch.from_arrays([pa.array(v[kept]) for v in out.values()], names=list(out))


NODE = "a long, b long, pa long, pb long, depth long, bytes long, x long, y long, z long"


def trie_nodes(rows: DataFrame) -> DataFrame:
    """The nodes (a, b, pa, pb, depth, bytes, x, y, z) on the ways of the segments (ba, bb, j, ga, gb, size, x, y, z): sums of x
    and y, least z. Runs of sorted segments, as they come to Python, are a double array each."""

    span = SPAN

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _run(batch, span)

    order = ["j", "ba", "bb", "ga", "gb"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.select(*order, "size", "x", "y", "z").repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = sorted_.mapInArrow(runs, NODE).groupBy("a", "b")
    return found.agg(*[F.first(c).alias(c) for c in ("pa", "pb", "depth", "bytes")], F.sum("x").alias("x"), F.sum("y").alias("y"), F.min("z").alias("z"))


def _endings(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the conversations (conv_id, a, b) that end in a node: ids in blocks as text, which one digest
    a node takes in order, so that no cell holds all of a node."""
    block = F.floor(F.col("conv_id") / BLOCK)
    texts = ends.groupBy("a", "b", block.alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done: list[tuple[int, int, str]] = []
            for a, b, text in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "text")], strict=True):
                if (a, b) != key:
                    if key:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (a, b), hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield _digests(done)
        if key:
            yield _digests([(*key, sha.hexdigest())])

    return texts.repartition("a", "b").sortWithinPartitions("a", "b", "block").mapInArrow(digest, "a long, b long, ends_sha256 string")


def _digests(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["a", "b", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a row for each node.

    conversations (conv_id, turn, role, text). Turns of equal number are ordered by role and text; repeated rows are turns
    of their own; rows without conv_id count for nothing; null roles and texts are empty, null turns come first. Other
    columns don't matter. Without conversations there is no node, not even the root.
    """
    placed = table(turns_in_order(conversations), "trie-placed")
    turns, convs = rebuild(placed)
    cut = segments(turns)
    alike = cut.groupBy("j", "ba", "bb", "xa", "xb", F.size("ga").alias("n_turns")).agg(F.first("ga").alias("ga"), F.first("gb").alias("gb"), F.first("size").alias("size"), F.count("*").alias("x"), F.min("conv_id").alias("z"))
    below = trie_nodes(alike.withColumn("y", F.lit(0).cast("long"))).select("a", "b", "pa", "pb", "depth", "bytes", F.col("x").alias("n"), F.col("z").alias("least"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least")).where("n > 0").select(zero.alias("a"), zero.alias("b"), none.alias("pa"), none.alias("pb"), zero.alias("depth"), zero.alias("bytes"), "n", "least")
    nodes = table(below.unionByName(root), "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = table(counted.withColumn("w", (F.col("n") - 1) * F.col("bytes")), "trie-counted")

    # chains: the nodes of one smallest member; only the last one of a chain may be childless
    top = F.min_by(F.struct("pa", "pb"), "depth").alias("top")
    chains = table(counted.groupBy("least").agg(F.min("depth").alias("from"), F.sum("w").alias("x"), F.count_if(F.col("n_children") == 0).alias("y"), top), "trie-chains")
    hung = chains.where("from > 0").groupBy("top").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).select("top.pa", "top.pb", "x", "y")
    hung = hung.join(nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), "least", "depth"), ["pa", "pb"]).where("depth > 0")
    ways = hung.select("least", "depth", "x", "y").join(cut.withColumnRenamed("conv_id", "least"), "least").where(F.col("j") * SPAN < F.col("depth"))
    upto = lambda c: F.slice(c, 1, F.least(F.lit(SPAN), F.col("depth") - F.col("j") * SPAN).cast("int")).alias(c)
    carried = trie_nodes(ways.select("j", "ba", "bb", upto("ga"), upto("gb"), upto("size"), "x", "y", zero.alias("z"))).select("a", "b", F.col("x").alias("more_w"), F.col("y").alias("more_leaves"))
    all_hung = chains.where("from > 0").agg(F.coalesce(F.sum("x"), zero).alias("more_w"), F.coalesce(F.sum("y"), zero).alias("more_leaves")).select(zero.alias("a"), zero.alias("b"), "more_w", "more_leaves")
    more = carried.unionByName(all_hung)

    own = _carried(counted, ["least"], "depth", "w", F.sum, True).withColumn("own", F.col("_inner") + F.coalesce("_carry", F.lit(0))).drop("_inner", "_carry")
    own = own.join(chains.select("least", F.col("y").alias("leaf")), "least")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("least").alias("parent_conv_id"))
    ends = cut.groupBy("conv_id").agg(F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b")).unionByName(convs.where("length = 0").select("conv_id", zero.alias("a"), zero.alias("b")))
    found = own.join(more, ["a", "b"], "left").join(_endings(ends), ["a", "b"], "left").join(parents, ["pa", "pb"], "left")
    return found.select(F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", (F.col("leaf") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                        (F.col("own") + F.coalesce("more_w", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL = f"""
WITH {CRC_TABLE},
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT c, count(*) AS n FROM t GROUP BY c),
i AS (SELECT n.c, n.c - n.c % 5 AS src, h, least(h, coalesce(s.n, 0)) AS taken FROM (SELECT c, {crc_sql("CAST(c AS VARCHAR)")} % 9 AS h FROM n, crc) n LEFT JOIN n s ON s.c = n.c - n.c % 5),
r AS (SELECT c, p - h + taken AS d, role, text FROM t JOIN i USING (c) WHERE p > h UNION ALL SELECT i.c, p, role, text FROM i JOIN t ON t.c = i.src WHERE p <= h),
lists AS (SELECT c, list(length(role) || ':' || role || text ORDER BY d) AS k, list(CAST(octet_length(encode(text)) AS BIGINT) ORDER BY d) AS s FROM r GROUP BY c UNION ALL SELECT c, [], [] FROM i WHERE c NOT IN (SELECT c FROM r)),
ways AS (SELECT c, len(k) AS size, d, k[1:d] AS node, k[1:d - 1] AS above, CASE WHEN d > 0 THEN s[d] ELSE 0 END AS b FROM (SELECT *, unnest(range(len(k) + 1)) AS d FROM lists)),
nodes AS (SELECT node, any_value(above) AS above, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(b) AS b, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '')) AS ends_sha256 FROM ways GROUP BY node),
kids AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
full_ AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
sums AS (SELECT u.node, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.b) AS saved FROM (SELECT node[1:d] AS node, n_convs, n_children, b FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_)) v JOIN full_ u USING (node) GROUP BY u.node)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_ f JOIN sums USING (node) LEFT JOIN full_ p ON f.depth > 0 AND p.node = f.above
"""
