"""Token counts by a map-side two-tier lookup.

Tier one is a table of the lengths, in tokens, of the most frequent text pieces, broadcast to all workers. Tier two
is a cache in each Python worker, filled by encoding what tier one misses. No piece of text is ever shuffled: each
task gives one packed, bounded summary of its frequent pieces, and summaries are merged level by level to make tier one.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import put, short_batches, table, tokenizer_file

#: A byte-level pre-token never crosses a space that a printable, non-white character follows.
CUT = re.compile(" (?=[!-~¡-ᙿ])")


def load(path: str):
    """The tokenizer file's encode function, text -> number of tokens, and the special strings it knows; None for these if
    its texts can't be counted piece by piece, as only those of plain byte-level files can."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda text: len(model.encode(text))), None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    form = json.loads(model.to_str())
    by_piece = (form["pre_tokenizer"] or {}).get("type") == "ByteLevel" and form["pre_tokenizer"]["use_regex"] and not form["normalizer"]
    specials = [t.content for t in model.get_added_tokens_decoder().values()]
    return (lambda text: len(model.encode(text, add_special_tokens=False))), specials if by_piece else None


class Lengths(dict):
    """Piece (as it follows a space) -> number of tokens; encodes what it lacks and stays within `most` entries."""

    def __init__(self, encode, frequent: dict[str, int], most: int):
        super().__init__(frequent)
        self.encode, self.frequent, self.most = encode, frequent, most

    def __missing__(self, piece: str) -> int:
        n = self.encode(" " + piece)
        if len(self) >= self.most:
            self.clear()
            self.update(self.frequent)
        self[piece] = n
        return n


_workers: dict = {}


def _lengths(path: str, frequent: dict[str, int], key: str, most: int):
    if _workers.get("key") != (path, key):
        encode, specials = load(path)
        _workers.update(key=(path, key), of=(Lengths(encode, frequent, most), encode, specials))
    return _workers["of"]


def _one(text: str, lengths: Lengths, encode, specials) -> int:
    if specials is None or any(s in text for s in specials):  # pieces of such a text may depend on each other
        return encode(text)
    first, *rest = CUT.split(text)
    return (encode(first) if first else 0) + sum(map(lengths.__getitem__, rest))


def frequent_pieces(docs: DataFrame, text: str = "text", most: int = 32_768, per_task: int = 8_192, fan_in: int = 32) -> list[str]:
    """The most frequent pieces over all texts, from a bounded heavy-hitter summary of each task.

    A task gives one row, its packed summary; `fan_in` summaries at a time are merged to one of at most `most` pieces,
    level by level, so that no task and not the driver holds more than that.
    """

    def row(slot: int, seen: Counter, keep: int) -> pd.DataFrame:
        top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:keep]
        return pd.DataFrame({"slot": [slot], "pieces": [[p for p, _ in top]], "n": [[n for _, n in top]]})

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for one in batch["t"]:
                if one:
                    seen.update(CUT.split(one)[1:])
                if len(seen) > 32 * per_task:
                    seen = Counter(dict(seen.most_common(4 * per_task)))
        yield row(TaskContext.get().partitionId(), seen, per_task)

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        seen: Counter = Counter()
        for pieces, n in zip(part["pieces"], part["n"], strict=True):
            seen.update(dict(zip(pieces, n, strict=True)))
        return row(int(part["slot"].iloc[0]), seen, most)

    schema = "slot long, pieces array<string>, n array<long>"
    found = table(docs.select(F.col(text).alias("t")).mapInPandas(summary, schema), "token-pieces")
    while found.count() > 1:
        found = table(found.withColumn("slot", F.floor(F.col("slot") / fan_in)).groupBy("slot").applyInPandas(merge, schema), "token-pieces")
    rows = found.collect()
    return list(rows[0].pieces) if rows else []


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str | None = None, limit: int = 512,
                 most_frequent: int = 32_768, cache_entries: int = 400_000) -> DataFrame:
    """Add n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) to each row of `docs`.

    Counts equal those of the tokenizer's library on the whole text: no begin, end or added special tokens, no
    truncation. A null text counts as empty: 0 bytes, 0 tokens, not over. Columns of the three names are replaced;
    every other column, repeated rows and ties stay as they are; an empty table gives an empty table. Texts of files that
    aren't plain byte-level ones are encoded whole.
    """
    path = tokenizer or tokenizer_file("byte_bpe_50k.json")
    spark = short_batches(docs).sparkSession
    encode, specials = load(path)
    pieces = frequent_pieces(docs, text, most_frequent) if specials is not None else []
    tier_one = {p: encode(" " + p) for p in pieces}
    shared = spark.sparkContext.broadcast(tier_one)

    @F.pandas_udf("long")
    def n_tokens(texts: pd.Series) -> pd.Series:
        lengths, whole, special = _lengths(path, shared.value, str(shared.id if hasattr(shared, "id") else id(shared)), cache_entries)
        return pd.Series([_one(t, lengths, whole, special) if t else 0 for t in texts], dtype="int64")

    kept = F.coalesce(F.col(text), F.lit(""))
    counted = put(docs, n_bytes=F.octet_length(kept).cast("long"), n_tokens=n_tokens(kept))
    return put(counted, over_limit=F.col("n_tokens") > limit)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", "over_limit")
