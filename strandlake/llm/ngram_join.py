"""N-gram Jaccard self-join by token-combination prefixes.

The tokens of a text are its distinct word shingles. All texts order tokens alike: rare ones first, frequent ones
last. Texts of similarity t share at least k tokens among the first n - ceil(t n) + k of their own. A text whose
prefix for k = 2 holds rare tokens only is indexed under each rare token of its prefix for k = 1; any other text under
the rare tokens of its prefix for k = 2 and under each combination of two frequent ones. Two similar texts then share
an index key, and no key stands for a frequent token alone.

One pass over the texts keeps of each set its name, its size and its head: its least tokens, somewhat more than a prefix
for k = 2. Heads are counted packed, four bytes a token, which gives the frequent tokens and a bitmap of bounded size
that leaves out tokens that no second set has; keys are then made of the heads and dealt once. Only texts with so many
frequent tokens that their head lacks rare ones are read again.

Equal sets are one class from the start. Classes that agree on one of their least tokens are first linked as stars
around one of them, so that a large group of near copies is a single component before candidates are made. Under keys
that many share, each text is compared with the hub, the text of the most common keys, and texts that don't join their
hub's component are compared with all of that hub, in blocks by postings that write spanning links only. Candidate pairs
are made for the rest, between components. Every link is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import drop, maybe_broadcast, short_batches, table
from .graphs import components
from .shingles import mix, portions, shingle_sets

SKETCH, SKETCH_SHARED = 8, 3
#: A head goes this many tokens, and this part of the set, beyond the prefix for k = 1.
HEAD_MORE, HEAD_SHARE = 8, 12
#: The most bits of the bitmap of shared tokens (32 MB), and the most tokens that one part of their count holds at once.
BITMAP_BITS, PART_TOKENS = 1 << 28, 1 << 23
TAIL = np.uint64((1 << 32) - 1)
SIGN = np.uint64(1 << 63)
PAIR_A, PAIR_B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)


def _scan(docs: DataFrame, emit, schema: str, width: int, extra: tuple[str, ...] = ()) -> DataFrame:
    """emit(rows, sets) -> frame, over runs of whole texts of docs (doc_id, text, *extra)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, texts in portions(batch["text"]):
                yield emit(batch.iloc[at : at + len(texts)], shingle_sets(texts, width))

    return docs.select("doc_id", "text", *extra).mapInPandas(run, schema)


def _prefix(n, percent: int):
    """The length of the prefix for k = 1: n - ceil(n * percent / 100) + 1."""
    return n + (-n * percent // 100) + 1


def set_table(docs: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n, k1, k2, sketch, head): set size, a 128-bit name of the set (null if empty), its least tokens, its head."""

    def emit(rows, sets):
        least = [sets.of(i)[:SKETCH].view(np.int64) for i in range(len(rows))]
        sizes = np.minimum(sets.sizes, _prefix(sets.sizes, percent) + HEAD_MORE + sets.sizes // HEAD_SHARE)
        heads = [sets.tokens[a : a + n].tobytes() for a, n in zip(sets.starts, sizes, strict=True)]
        k1, k2 = pd.array(sets.keys, "Int64"), pd.array(sets.more, "Int64")
        k1[sets.sizes == 0] = k2[sets.sizes == 0] = pd.NA
        return pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64").array, "n": sets.sizes, "k1": k1, "k2": k2, "sketch": least, "head": heads})

    return _scan(docs, emit, "doc_id long, n long, k1 long, k2 long, sketch array<long>, head binary", width)


def _alike(a: str, b: str, percent: int):
    """Sizes that allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


KEY = ("g", "i", "j", "role", "sid")


def _deliver(docs: DataFrame, classes: DataFrame, roles: DataFrame, width: int) -> DataFrame:
    """roles (sid, g, i, j, role) with each set's tokens, dealt by (g, i, j) and sorted by role within."""
    wanted = roles.groupBy("sid").agg(F.collect_list(F.struct("g", "i", "j", "role")).alias("roles")).join(classes.select("sid", "k1", F.col("first").alias("doc_id")), "sid")
    wanted = maybe_broadcast(table(wanted, "join-wanted"))

    def emit(rows, sets):
        out = {"g": [], "i": [], "j": [], "role": [], "sid": [], "tokens": []}
        for k, (sid, name, own) in enumerate(zip(rows["sid"], rows["k1"], rows["roles"], strict=True)):
            if sets.sizes[k] and sets.keys[k] == name:
                blob = sets.of(k).tobytes()
                for role in own:
                    for name in KEY[:4]:
                        out[name].append(role[name])
                    out["sid"].append(sid)
                    out["tokens"].append(blob)
        return pd.DataFrame(out)

    blobs = _scan(docs.join(wanted, "doc_id"), emit, "g long, i int, j int, role int, sid long, tokens binary", width, ("sid", "k1", "roles"))
    return blobs.repartition("g", "i", "j").sortWithinPartitions(*KEY)


def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int, per_group: int = 256) -> DataFrame:
    """The pairs (a, b) of set names whose sets have 100 * shared >= percent * all.

    The sets around one b meet in groups of about `per_group` members, each with its own copy of b's set; a task
    streams through its groups in order and holds one set of a group's centre at a time.
    """
    pairs = table(pairs.select("a", "b").distinct(), "join-pairs")
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / per_group).alias("salts"))
    dealt = pairs.join(sizes, "b").select("a", F.col("b").alias("g"), F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("i"), F.lit(0).alias("j"))
    roles = dealt.select(F.col("a").alias("sid"), "g", "i", "j", F.lit(1).alias("role")).unionByName(dealt.select(F.col("g").alias("sid"), "g", "i", "j", F.lit(0).alias("role")).distinct())

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, centre = None, None
        for batch in batches:
            good = []
            for g, i, role, sid, blob in zip(batch["g"], batch["i"], batch["role"], batch["sid"], batch["tokens"], strict=True):
                tokens = np.frombuffer(blob, np.uint64)
                if role == 0:
                    at, centre = (g, i), tokens
                elif at == (g, i):
                    x, y = (tokens, centre) if len(tokens) < len(centre) else (centre, tokens)
                    place = np.searchsorted(y, x)
                    shared = int((y[np.minimum(place, len(y) - 1)] == x).sum())
                    if 100 * shared >= percent * (len(x) + len(y) - shared):
                        good.append((sid, g))
            yield pd.DataFrame(good, columns=["a", "b"], dtype="int64")

    return table(_deliver(docs, classes, roles, width).mapInPandas(compare, "a long, b long").distinct(), "join-links")


class _Block:
    """Sets with postings of their tokens, and which of them are known to be joined."""

    def __init__(self, sids: list[int], sets: list[np.ndarray]):
        self.sids, self.sizes = np.array(sids), np.array([len(x) for x in sets])
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.owner = owner[order]
        self.tokens, self.starts, self.counts = np.unique(tokens[order], return_index=True, return_counts=True)
        self.label: dict[int, int] = {}

    def root(self, sid: int) -> int:
        while (up := self.label.get(sid, sid)) != sid:
            sid = up
        return sid

    def links(self, sid: int, tokens: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """Links of the set to sets of the block that aren't joined with it yet."""
        place = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        place = place[self.tokens[place] == tokens]
        size = self.counts[place]
        posts = self.owner[np.repeat(self.starts[place] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        shared = np.bincount(posts, minlength=len(self.sizes))
        for other in self.sids[100 * shared >= percent * (self.sizes + len(tokens) - shared)].tolist():
            a, b = self.root(sid), self.root(other)
            if a != b:
                self.label[max(a, b)] = min(a, b)
                yield sid, other


def dense_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, width: int, percent: int, block: int = 1_024) -> DataFrame:
    """Links (a, b) within each group of groups (hub, sid, asks): a spanning part of the links of the sets that ask.

    Groups are cut into blocks of about `block` sets; each task compares one block of askers with one block of all, by
    postings, and writes a link only if it joins what it has not joined yet, so no pairs are written.
    """
    sizes = groups.groupBy("hub").agg(F.ceil(F.count("*") / block).cast("int").alias("n_i"), F.ceil(F.count_if("asks") / block).cast("int").alias("n_j"), F.count_if("asks").alias("n")).where("n > 0").drop("n")
    cut = groups.join(sizes, "hub").withColumn("h", F.xxhash64("sid"))
    index = cut.select("sid", F.col("hub").alias("g"), F.pmod("h", F.col("n_i")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_j") - 1)).alias("j"), F.lit(0).alias("role"))
    asks = cut.where("asks").select("sid", F.col("hub").alias("g"), F.explode(F.sequence(F.lit(0), F.col("n_i") - 1)).alias("i"), F.pmod("h", F.col("n_j")).cast("int").alias("j"), F.lit(1).alias("role"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, ready = None, ([], []), None
        for batch in batches:
            good: list[tuple[int, int]] = []
            for g, i, j, role, sid, blob in zip(batch["g"], batch["i"], batch["j"], batch["role"], batch["sid"], batch["tokens"], strict=True):
                if (g, i, j) != at:
                    at, held, ready = (g, i, j), ([], []), None
                if role == 0:
                    held[0].append(sid)
                    held[1].append(np.frombuffer(blob, np.uint64))
                elif held[0]:
                    ready = ready or _Block(*held)
                    good += ready.links(sid, np.frombuffer(blob, np.uint64), percent)
            yield pd.DataFrame(good, columns=["a", "b"], dtype="int64")

    return table(_deliver(docs, classes, index.unionByName(asks), width).mapInPandas(compare, "a long, b long").distinct(), "join-links")


def _place(tokens: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of the range of tokens in which each lies, and 32 bits that tell where in it."""
    x = (tokens >> np.uint64(20)) * np.uint64(parts)
    return (x >> np.uint64(44)).astype(np.int64), x >> np.uint64(12) & TAIL


def _heads(column) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of some heads in a row, and the length of each."""
    return np.frombuffer(b"".join(column), np.uint64), np.fromiter(map(len, column), np.int64, len(column)) // 8


class Known(NamedTuple):
    """Which tokens are frequent, and which may be in two heads: sorted frequent ones, a bitmap a part, bits of a part."""

    parts: int
    frequent: np.ndarray
    bitmap: np.ndarray
    bits: int

    def often(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token is frequent."""
        if not len(self.frequent):
            return np.zeros(len(tokens), bool)
        part, tail = _place(tokens, self.parts)
        key = part.astype(np.uint64) << np.uint64(32) | tail
        place = np.minimum(np.searchsorted(self.frequent, key), len(self.frequent) - 1)
        return self.frequent[place] == key

    def shared(self, tokens: np.ndarray) -> np.ndarray:
        """Whether each token may be in two heads."""
        part, tail = _place(tokens, self.parts)
        at = part * self.bits + (tail * np.uint64(self.bits) >> np.uint64(32)).astype(np.int64)
        return self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


def _packed(tokens: np.ndarray, parts: int) -> pd.DataFrame:
    """(part, tails): the tokens by parts, four bytes each."""
    part, tail = _place(np.sort(tokens), parts)
    new = np.flatnonzero(np.diff(part, prepend=-1))
    tails = [x.tobytes() for x in np.split(tail.astype("<u4"), new[1:])] if len(new) else []
    return pd.DataFrame({"part": part[new].astype(np.int32), "tails": tails})


def _flags(tails: np.ndarray, bits: int) -> bytes:
    """A part's bitmap."""
    flags = np.zeros(bits, np.uint8)
    flags[(tails.astype(np.uint64) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def count_heads(heads: DataFrame, n_tokens: int, above: int, most: int) -> Known:
    """Counts the tokens of heads (head, lead): frequent ones are in more than `above` heads of leads, the `most` most
    frequent of them. Tokens travel packed; a part is counted at a time and holds PART_TOKENS tokens on average at most.
    """
    parts = min(1 << 20, max(int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_tokens // PART_TOKENS)))
    bits = max(8, min(BITMAP_BITS // parts, 4 * n_tokens // parts) // 8 * 8)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 2_000):
                rows = batch.iloc[i : i + 2_000]
                for lead in (False, True):
                    yield _packed(_heads(rows["head"][rows["lead"] == lead])[0], parts).assign(lead=lead)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, {False: [], True: []}
        for batch in batches:
            for p, lead, tails in zip(batch["part"], batch["lead"], batch["tails"], strict=True):
                if p != part:
                    if part is not None:
                        yield counted(part, held)
                    part, held = p, {False: [], True: []}
                held[lead].append(tails)
        if part is not None:
            yield counted(part, held)

    def counted(part: int, held: dict[bool, list[bytes]]) -> pd.DataFrame:
        leads, others = (np.frombuffer(b"".join(held[k]), "<u4") for k in (True, False))
        values, n = np.unique(np.concatenate([leads, others]), return_counts=True)
        shared = _flags(values[n > 1], bits)
        values, n = np.unique(leads, return_counts=True)
        often = n > above
        k = int(often.sum())
        return pd.DataFrame({"part": np.int32(part), "tail": [*values[often].tolist(), 0], "df": [*n[often].tolist(), 0], "bits": [None] * k + [shared]})

    packed = heads.select("head", "lead").mapInPandas(emit, "part int, tails binary, lead boolean")
    counts = table(packed.repartition(parts, "part").sortWithinPartitions("part").mapInPandas(count, "part int, tail long, df long, bits binary"), "join-counts")
    rows = counts.where("bits IS NULL").orderBy(F.desc("df"), "part", "tail").limit(most).select("part", "tail").toPandas()
    frequent = np.sort(rows["part"].to_numpy().astype(np.uint64) << np.uint64(32) | rows["tail"].to_numpy().astype(np.uint64))
    bitmap = np.zeros(parts * bits // 8, np.uint8)
    for r in counts.where("bits IS NOT NULL").select("part", "bits").collect():  # BITMAP_BITS in all at most
        bitmap[r.part * bits // 8 : (r.part + 1) * bits // 8] = np.frombuffer(r.bits, np.uint8)
    drop(counts)
    return Known(parts, frequent, bitmap, bits)


def _sigs(own: np.ndarray, often: np.ndarray, shared: np.ndarray, n: int, percent: int) -> Iterator[tuple[np.ndarray, int | None]]:
    """Runs of a set's keys, each with the greatest key of its prefix for k = 1 in the order of tokens if that is all it
    has; none if `own`, its least tokens, don't suffice. Keys that no other set can have are left out."""
    one = _prefix(n, percent)
    two = min(n, one + 1)
    rare = np.flatnonzero(~often)
    if len(rare) >= two:
        at = rare[:one]
        last = int((own[at[-1]] ^ SIGN).view(np.int64))
        yield own[at[shared[at]]], last
    elif len(own) == n:
        yield own[rare[shared[rare]]], None
        x = own[often][: two - len(rare)]
        for i in range(len(x) - 1):
            yield mix(x[i] * PAIR_A + x[i + 1 :] * PAIR_B), None


def whole_sets(heads: DataFrame, docs: DataFrame, classes: DataFrame, known: Known, width: int, percent: int) -> tuple[DataFrame, Known]:
    """The sets whose heads have too few rare tokens for a prefix (sid, k1, doc_id), and `known` with all their tokens
    taken for shared ones: their prefixes go beyond what was counted."""
    spark, parts, bits = docs.sparkSession, known.parts, known.bits
    shared = spark.sparkContext.broadcast(known._replace(bitmap=known.bitmap[:0]))

    def lacking(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, lengths = _heads(batch["head"])
            n = batch["n"].to_numpy()
            rare = np.add.reduceat(~shared.value.often(tokens), np.cumsum(lengths) - lengths) if len(batch) else lengths
            yield batch.loc[(rare < np.minimum(n, _prefix(n, percent) + 1)) & (lengths < n), ["sid"]]

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = None, []
        for batch in batches:
            for p, tails in zip(batch["part"], batch["tails"], strict=True):
                if p != part:
                    if part is not None:
                        yield pd.DataFrame({"part": [part], "bits": [_flags(np.concatenate(held), bits)]})
                    part, held = p, []
                held.append(np.frombuffer(tails, "<u4"))
        if part is not None:
            yield pd.DataFrame({"part": [part], "bits": [_flags(np.concatenate(held), bits)]})

    if not len(known.frequent):
        return classes.select("sid", "k1", F.col("first").alias("doc_id")).limit(0), known
    short = table(heads.select("sid", "n", "head").mapInPandas(lacking, "sid long").distinct().join(classes.select("sid", "k1", F.col("first").alias("doc_id")), "sid"), "join-short")
    shared.destroy()
    packed = _scan(docs.join(maybe_broadcast(short), "doc_id"), lambda rows, sets: _packed(sets.tokens, parts), "part int, tails binary", width)
    bitmap = known.bitmap  # ours alone: marked in place
    for r in packed.repartition(parts, "part").sortWithinPartitions("part").mapInPandas(mark, "part int, bits binary").collect():  # BITMAP_BITS in all at most
        bitmap[r.part * bits // 8 : (r.part + 1) * bits // 8] |= np.frombuffer(r.bits, np.uint8)
    return short, known


KEYS = "sig long, sid long, n long, last long"


def _keys(sids, sizes, tokens: np.ndarray, lengths: np.ndarray, known: Known, percent: int, most: int = 500_000) -> Iterator[pd.DataFrame]:
    """Frames of KEYS, of about `most` rows each."""
    often, shared = known.often(tokens), known.shared(tokens)
    starts = np.cumsum(lengths) - lengths
    sigs, owners, lasts, held = [], [], [], 0

    def flush() -> pd.DataFrame:
        size = [len(s) for s in sigs]
        at = np.repeat(np.array(owners, np.int64), size)
        last = pd.array(np.repeat(np.array([x or 0 for x in lasts], np.int64), size), "Int64")
        last[np.repeat(np.array([x is None for x in lasts], bool), size)] = pd.NA
        sig = np.concatenate(sigs).view(np.int64) if sigs else np.zeros(0, np.int64)
        return pd.DataFrame({"sig": sig, "sid": np.asarray(sids)[at], "n": np.asarray(sizes)[at], "last": last})

    for i in np.flatnonzero(lengths):
        span = slice(starts[i], starts[i] + lengths[i])
        for keys, last in _sigs(tokens[span], often[span], shared[span], int(sizes[i]), percent):
            sigs.append(keys)
            owners.append(i)
            lasts.append(last)
            held += len(keys)
            if held >= most:
                yield flush()
                sigs, owners, lasts, held = [], [], [], 0
    yield flush()


def index(heads: DataFrame, docs: DataFrame, short: DataFrame, known, width: int, percent: int) -> DataFrame:
    """KEYS under which each set of heads (sid, n, head) is indexed, those of `short` by their texts; `known` is broadcast."""

    def of_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 2_000):
                rows = batch.iloc[i : i + 2_000]
                yield from _keys(rows["sid"].to_numpy(), rows["n"].to_numpy(), *_heads(rows["head"]), known.value, percent)

    def of_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, texts in portions(batch["text"]):
                sets, rows = shingle_sets(texts, width), batch.iloc[at : at + len(texts)]
                sizes = np.where(sets.keys == rows["k1"].to_numpy(), sets.sizes, 0)
                yield from _keys(rows["sid"].to_numpy(), sizes, sets.tokens[np.repeat(sizes > 0, sets.sizes)], sizes, known.value, percent)

    by_text = docs.join(maybe_broadcast(short), "doc_id").select("text", "sid", "k1").mapInPandas(of_texts, KEYS)
    return table(heads.select("sid", "n", "head").mapInPandas(of_heads, KEYS).unionByName(by_text), "join-keys")


def _enough(percent: int):
    """Whether prefixes for k = 1 that share `shared` tokens allow the similarity.

    All that a shares with b up to the end of the prefix that ends first lies in both prefixes; behind it the text of
    that prefix has ceil(n * percent / 100) - 1 tokens.
    """
    needed = F.ceil((F.col("n") + F.col("bn")) * percent / (100 + percent))
    first = F.when(F.col("last") <= F.col("blast"), F.col("n")).otherwise(F.col("bn"))
    return F.col("last").isNull() | F.col("blast").isNull() | (F.col("shared") + F.ceil(first * percent / 100) - 1 >= needed)


def _labelled(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with cid, the component of sid (itself, if `found` doesn't have it)."""
    labels = maybe_broadcast(found.select(F.col("node").alias("sid"), F.col("component").alias("known")))
    return rows.join(labels, "sid", "left").withColumn("cid", F.coalesce("known", "sid")).drop("known")


def similar_sets(docs: DataFrame, width: int = 5, percent: int = 75, frequent_above: int = 32, most_frequent: int = 1_000_000, star_above: int = 16) -> tuple[DataFrame, DataFrame]:
    """(sets, found): (doc_id, n, sid) of `docs` (doc_id, text), sid naming equal sets (null if empty), and the component of
    each sid that is linked to another."""
    spark = short_batches(docs).sparkSession
    sets = table(set_table(docs, width, percent), "join-sets")
    known = sets.where("k1 IS NOT NULL AND doc_id IS NOT NULL")
    classes = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    # a class goes by its least doc_id, or by a hash where an id has several texts
    odd = F.count("*").over(W.partitionBy("first")) > 1
    classes = table(classes.withColumn("sid", F.when(odd, F.xxhash64("k1", "k2")).otherwise(F.col("first"))), "join-classes")
    # stars over the least tokens
    least = classes.select("sid", "n", F.explode("sketch").alias("sig"))
    centres = least.groupBy("sig").agg(F.min_by(F.struct("sid", "n"), "sid").alias("c"), F.count("*").alias("m")).where("m > 1").select("sig", F.col("c.sid").alias("b"), F.col("c.n").alias("bn"))
    stars = least.join(maybe_broadcast(table(centres, "join-centres")), "sig").where((F.col("sid") != F.col("b")) & _alike("n", "bn", percent))
    stars = stars.groupBy(F.col("sid").alias("a"), "b").agg(F.count("*").alias("shared"), F.max("n").alias("n")).where(F.col("shared") >= F.least(F.lit(SKETCH_SHARED), "n"))
    links = verify(docs, classes, stars, width, percent)
    found = components(links)
    # token counts and the index over one head of each class; frequencies over one of each component
    copies = known.select("doc_id", "k1", "k2").join(classes.select("k1", "k2", "first"), ["k1", "k2"]).where("doc_id <> first").select("doc_id", "k1").distinct()
    odd = maybe_broadcast(table(classes.where("sid <> first").select(F.col("first").alias("doc_id"), "k1", F.col("sid").alias("odd")), "join-odd"))
    heads = known.select("doc_id", "k1", "n", "head").join(maybe_broadcast(table(copies, "join-copies")), ["doc_id", "k1"], "left_anti")
    heads = heads.join(odd, ["doc_id", "k1"], "left").select(F.coalesce("odd", "doc_id").alias("sid"), "n", "head")
    behind = maybe_broadcast(table(found.where("node <> component").select(F.col("node").alias("sid"), F.lit(False).alias("lead")), "join-behind"))
    n_tokens = int(classes.agg(F.coalesce(F.sum(F.floor(F.col("n") * (100 - percent) / 100 + F.col("n") / HEAD_SHARE) + HEAD_MORE + 1), F.lit(0))).first()[0])
    count = count_heads(heads.join(behind, "sid", "left").withColumn("lead", F.coalesce("lead", F.lit(True))), n_tokens, frequent_above, most_frequent)
    short, count = whole_sets(heads, docs, classes, count, width, percent)
    told = spark.sparkContext.broadcast(count)
    keys = index(heads, docs, short, told, width, percent)
    told.destroy()  # workers would keep it
    del count
    shared = _labelled(keys.select("sig", "sid"), found).groupBy("sig").agg(F.min("cid").alias("low"), F.max("cid").alias("high"), F.count("*").alias("m")).where("low < high").select("sig", "m")
    rows = table(keys.join(maybe_broadcast(table(shared, "join-shared")), "sig").select("sig", "sid", "n", "last", "m"), "join-rows")
    named = sets.select("doc_id", "n", "k1", "k2").join(classes.select("k1", "k2", "sid"), ["k1", "k2"], "left").select("doc_id", "n", "sid")
    named = table(named, "join-named")
    drop(keys, sets)
    # hot keys: each set goes to the hub with which it shares most of them; hubs are the sets of the most common keys
    hot = table(rows.where(F.col("m") > star_above).select("sig", "sid", "n", "m"), "join-hot")
    score = hot.groupBy("sid").agg((F.sum("m") / F.max("n")).alias("score"))
    tops = hot.join(score, "sid").groupBy("sig").agg(F.max_by("sid", F.struct("score", "sid")).alias("hub"))
    hubs = hot.join(tops, "sig").groupBy("sid", "hub").agg(F.count("*").alias("shared")).groupBy("sid").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    hubs = table(hubs, "join-hubs")
    links = table(links.unionByName(verify(docs, classes, hubs.where("sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b")), width, percent)), "join-links")
    found = components(links)
    known_hubs = _labelled(hubs.select(F.col("hub").alias("sid")).distinct(), found).select(F.col("sid").alias("hub"), F.col("cid").alias("hub_cid"))
    groups = table(_labelled(hubs, found).join(known_hubs, "hub").select("hub", "sid", (F.col("cid") != F.col("hub_cid")).alias("asks")), "join-groups")
    links = table(links.unionByName(dense_links(docs, classes, groups, width, percent)), "join-links")
    found = components(links)
    rows = rows.join(maybe_broadcast(hubs), "sid", "left")
    now = table(_labelled(rows, found).drop("m"), "join-open")
    other = now.select("sig", F.col("sid").alias("b"), F.col("n").alias("bn"), F.col("last").alias("blast"), F.col("cid").alias("bc"), F.col("hub").alias("bhub"))
    apart = F.col("hub").isNull() | F.col("bhub").isNull() | (F.col("hub") != F.col("bhub"))  # sets of one hub have been compared
    met = now.join(other, "sig").where((F.col("sid") < F.col("b")) & (F.col("cid") != F.col("bc")) & apart & _alike("n", "bn", percent))
    pairs = met.groupBy(F.col("sid").alias("a"), "b", "n", "bn", "last", "blast").agg(F.count("*").alias("shared")).where(_enough(percent)).select("a", "b")
    links = table(links.unionByName(verify(docs, classes, pairs, width, percent)), "join-links")
    return named, components(links)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75, **options) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`.

    Words are runs of non-space after lower-casing A-Z; a text of fewer than `width` words is one shingle; null, empty
    and blank texts have no shingle and are components of their own, as are rows of a null doc_id (component null).
    Repeated rows and equal sets are linked. component_id is the smallest doc_id reachable by links of
    100 * shared >= percent * all. An empty table gives an empty table; other columns don't matter.
    Equal sets are told by 128-bit names, tokens within two sets by 64 bits.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets, found = similar_sets(rows, width, percent, **options)
    labelled = table(_labelled(sets, found), "join-labelled")
    firsts = labelled.where("sid IS NOT NULL").groupBy("cid").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    joined = labelled.join(maybe_broadcast(firsts), "cid", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id")).alias("component_id"))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
