"""Token ids in binary files: patched frame-of-reference blocks.

A file is a row of chunks. A chunk holds whole documents in ascending id order:

    magic "PFOR" | u32 bytes of the chunk | u32 documents | u32 ids | u32 blocks
    i64 doc_id x documents | u8 doc_id is set x documents | u32 ids x documents
    u32 start of each block, from the first block
    blocks | line feed

A block holds 256 ids (the last one fewer): u32 least id | u8 width | u16 exceptions | ids minus the least, the low
`width` bits of each, packed | u8 place x exceptions | u32 high bits x exceptions. The width is the chosen percentile of
the block's bit lengths, so that a few large ids don't widen all others. All numbers are little-endian. Spark's text
writer writes the chunks; its line separator is the chunk's final byte.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, short_batches, table, tokenizer_file

MAGIC, BLOCK = b"PFOR", 256
HEAD, BLOCK_HEAD = struct.Struct("<4sIIII"), struct.Struct("<IBH")
HEAD_TYPE = np.dtype([("least", "<u4"), ("width", "u1"), ("odd", "<u2")])


def pack_blocks(ids: np.ndarray, percentile: float = 0.9) -> list[bytes]:
    """The ids (below 2**32) as blocks."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    grid = np.full(n * BLOCK, ids[-1], dtype=np.int64)
    grid[: len(ids)] = ids
    grid = grid.reshape(n, BLOCK)
    least = grid.min(axis=1)
    over = grid - least[:, None]
    lengths = np.frexp(over.astype(np.float64))[1].astype(np.uint8)
    place = min(BLOCK - 1, int(percentile * BLOCK))
    widths = np.partition(lengths, place, axis=1)[:, place]
    outliers = lengths > widths[:, None]
    packed: list[bytes] = [b""] * n
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            whole = over[rows].astype("<u2" if width <= 16 else "<u4").view(np.uint8).reshape(len(rows), BLOCK, -1)
            bits = np.unpackbits(whole, axis=2, count=int(width), bitorder="little").reshape(len(rows), -1)
            for row, line in zip(rows, np.packbits(bits, axis=1, bitorder="little"), strict=True):
                packed[row] = line.tobytes()
    row, at = np.nonzero(outliers)
    high = (over[row, at] >> widths[row]).astype("<u4")
    cuts = np.searchsorted(row, np.arange(n + 1)).tolist()
    at = at.astype(np.uint8)
    return [BLOCK_HEAD.pack(m, w, b - a) + line + at[a:b].tobytes() + high[a:b].tobytes()
            for m, w, line, a, b in zip(least.tolist(), widths.tolist(), packed, cuts[:-1], cuts[1:], strict=True)]


def unpack_blocks(data: memoryview, starts: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of a chunk's blocks; each block is found by its start alone."""
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)
    runs = lambda at, size: np.lib.stride_tricks.sliding_window_view(raw, size)[at]
    heads = runs(starts, BLOCK_HEAD.size).view(HEAD_TYPE)[:, 0]
    widths, odd = heads["width"].astype(np.int64), heads["odd"].astype(np.int64)
    out = np.zeros((n, BLOCK), dtype=np.int64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            bits = np.zeros((len(rows), BLOCK, 16 if width <= 16 else 32), dtype=np.uint8)
            bits[:, :, :width] = np.unpackbits(runs(starts[rows] + BLOCK_HEAD.size, BLOCK * width // 8), axis=1, bitorder="little").reshape(len(rows), BLOCK, width)
            out[rows] = np.packbits(bits, axis=2, bitorder="little").view("<u2" if width <= 16 else "<u4")[:, :, 0]
    if odd.any():
        at, block = starts + BLOCK_HEAD.size + BLOCK * widths // 8, np.repeat(np.arange(n), odd)
        k = np.arange(len(block)) - np.repeat(np.cumsum(odd) - odd, odd)
        high = runs(at[block] + odd[block] + 4 * k, 4).view("<u4")[:, 0].astype(np.int64)
        out[block, raw[at[block] + k]] |= high << widths[block]
    out += heads["least"].astype(np.int64)[:, None]
    return out.reshape(-1)[:n_ids]


def pack_chunk(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, percentile: float = 0.9) -> bytes:
    """A chunk without its final line feed."""
    blocks = pack_blocks(ids, percentile)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].astype("<u4") if blocks else np.zeros(0, "<u4")
    body = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array(counts, "<u4").tobytes(), starts.tobytes(), *blocks])
    return HEAD.pack(MAGIC, HEAD.size + len(body) + 1, len(doc_ids), len(ids), len(blocks)) + body


def chunks(data: bytes) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc ids, ids per document, ids) of each chunk of a file."""
    view, at = memoryview(data), 0
    while at < len(data):
        magic, size, n_docs, n_ids, n_blocks = HEAD.unpack_from(view, at)
        if magic != MAGIC or data[at + size - 1] != 10:
            raise ValueError(f"no chunk at byte {at}")
        pos = at + HEAD.size
        docs = np.frombuffer(view, "<i8", n_docs, pos)
        known = np.frombuffer(view, np.uint8, n_docs, pos + 8 * n_docs)
        counts = np.frombuffer(view, "<u4", n_docs, pos + 9 * n_docs)
        starts = np.frombuffer(view, "<u4", n_blocks, pos + 13 * n_docs).astype(np.int64)
        ids = unpack_blocks(view[pos + 13 * n_docs + 4 * n_blocks : at + size], starts, n_ids)
        yield [int(d) if k else None for d, k in zip(docs, known, strict=True)], counts, ids
        at += size


#: Characters that Python's split() takes for white space and the tokenizer does not, and how special strings begin.
WHOLE = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")
#: A single mark between a letter and white space is a pre-token of its own.
ENDING = re.compile(r"[.,;:!?](?<=[a-zß-öø-ÿ][.,;:!?])(?=\s|\Z)")


#: ASCII signs: behind a letter they are pre-tokens of their own.
MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{}~"


def latin(text: str) -> bool:
    """Whether the text is of Latin-1, where Python's lower case is the tokenizer's."""
    return text.isascii() or text.encode("latin-1", "replace").decode("latin-1") == text


def ends_in_letter(core: str) -> bool:
    """Whether the tokenizer sees a letter at the end: some letters become a letter and a combining mark when they are
    normalized or lower-cased, and such a mark forms one pre-token with the signs behind it."""
    return core[-1].isalpha() and (core.isascii() or unicodedata.normalize("NFC", core).lower()[-1].isalpha())


class WordIds(dict):
    """Word (between white space) -> its ids as bytes.

    The tokenizer's normalizer and pre-tokenizer never look beyond white space, so a text's ids are those of its words
    in a row. Words of lower-case letters only are encoded many at a time: each ends at the one id that ends a word.
    The cache has a young and an old half; what is found in the old one is young again.
    """

    def __init__(self, path: str, most: int):
        super().__init__()
        self.old: dict[str, bytes] = {}
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.most, self.model = most, Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        vocab = self.model.get_vocab()
        self.kind = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        form = json.loads(self.model.to_str())
        self.by_word = form["model"].get("end_of_word_suffix") == "</w>" and "Lowercase" in str(form["normalizer"])
        del form
        # for words of lower-case Latin-1 letters only, which its normalizer and its pattern leave as they are
        self.plain = Tokenizer(self.model.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            core = word.rstrip(MARKS)
            low = word.lower()
            if core and core != word and ends_in_letter(core):
                found = self[core] + self[word[len(core):]]
            elif low != word and latin(word):
                found = self[low]
            else:
                found = self.whole(word)
        self[word] = found
        return found

    def learn(self, words: set[str]) -> None:
        """Encode at once what is plain in `words` and not in the old half."""
        plain = [w for w in words if w.isalpha() and w.islower() and w not in self.old and latin(w)]
        for i in range(0, len(plain), 2_000):
            part = plain[i : i + 2_000]
            ids = np.array(self.plain.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part):
                raw, size = ids.tobytes(), self.kind.itemsize
                cuts = (cuts * size).tolist()
                for word, a, b in zip(part, [0, *cuts[:-1]], cuts, strict=True):
                    self[word] = raw[a:b]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self.whole(t) for t in texts]
        if len(self) > self.most // 2:  # what isn't asked for again while the cache fills once more is forgotten
            self.old = dict(self)
            self.clear()
        split = [None if any(s in t for s in WHOLE) else (ENDING.sub(r" \g<0>", t.lower()) if latin(t) else t).split() for t in texts]
        words = list(chain.from_iterable(s for s in split if s))
        ids = list(map(self.get, words))
        gaps = [i for i, found in enumerate(ids) if found is None]
        self.learn(set(map(words.__getitem__, gaps)))
        for i in gaps:
            ids[i] = self[words[i]]
        ends = accumulate(len(s or ()) for s in split)
        return [self.whole(t) if s is None else b"".join(ids[end - len(s) : end]) for t, s, end in zip(texts, split, ends, strict=True)]


_workers: dict = {}


def _words(path: str, most: int) -> WordIds:
    if path not in _workers:
        _workers[path] = WordIds(path, most)
    return _workers[path]


def write_tokens(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, end_id: int = 1,
                 percentile: float = 0.9, docs_per_file: int = 8_192, ids_per_chunk: int = 1 << 18, chunks_per_file: int = 64, cache_words: int = 300_000) -> str:
    """Encode whole texts, append `end_id` to each document and write the ids in ascending doc_id order; returns `path`.

    Files hold ranges of doc_id: bounds are quantiles of the id column alone, the ids are then shuffled once. A range of
    more than `chunks_per_file` chunks is cut into several files, so that files have a bounded size. Null and
    empty texts are the end id alone. Null ids come first; equal ids are ordered by their texts' hash. Other columns
    aren't written. An empty table writes no chunk.
    """
    file = tokenizer or tokenizer_file("word_bpe_49k.json")
    ids = short_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"))
    n_files = max(1, -(-ids.count() // docs_per_file))
    bounds = ids.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / n_files for i in range(1, n_files)], 0.1 / n_files) if n_files > 1 else []
    edges = np.array(sorted(set(bounds)), dtype=np.float64)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _words(file, cache_words)
        end = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            for i in range(0, len(batch), 256):
                part = batch.iloc[i : i + 256]
                values = [v + end for v in words.encode(part["text"].tolist())]
                at = np.searchsorted(edges, part["doc_id"].to_numpy(dtype=np.float64, na_value=-np.inf), side="right")
                yield pd.DataFrame({"part": at.astype(np.int32), "doc_id": part["doc_id"].astype("Int64"), "tie": part["tie"], "size": words.kind.itemsize, "ids": values})

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        total = 0
        for batch in batches:
            kinds = batch.column("size").to_pylist()
            for doc, size, raw in zip(batch.column("doc_id").to_pylist(), kinds, batch.column("ids"), strict=True):
                held.append((doc, np.frombuffer(raw.as_py(), f"<u{size}")))
                total += len(held[-1][1])
                if total >= ids_per_chunk:
                    yield _chunk(held, percentile)
                    held, total = [], 0
        if held:
            yield _chunk(held, percentile)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    encoded = rows.mapInPandas(encode, "part int, doc_id long, tie long, size int, ids binary")
    dealt = encoded.repartitionById(n_files, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
    dealt.mapInArrow(chunk, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", chunks_per_file).text(path)
    return path


def _chunk(held: list[tuple[int | None, np.ndarray]], percentile: float) -> pa.RecordBatch:
    data = pack_chunk([d for d, _ in held], [len(x) for _, x in held], np.concatenate([x for _, x in held]), percentile)
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of the files in `path`: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    `start` counts the ids of all documents before; it is an offset in the file plus the sum of the files before.
    """
    schema = "file string, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"], strict=True):
                at = 0
                for docs, counts, ids in chunks(bytes(data)):
                    ends = np.cumsum(counts, dtype=np.int64)
                    starts = ends - counts
                    flat = ids.astype("<u4")
                    rows = pd.DataFrame({"file": file, "doc_id": pd.array(docs, "Int64"), "at": at + starts, "n_tokens": counts.astype(np.int64),
                                         "ids_crc32": [zlib.crc32(flat[a:b]) for a, b in zip(starts, ends, strict=True)]})
                    if with_ids:
                        rows["ids"] = [flat[a:b].astype(np.int32) for a, b in zip(starts, ends, strict=True)]
                    yield rows
                    at += int(ends[-1]) if len(ends) else 0

    found = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(scan, schema)
    if not with_ids:
        found = table(found, "token-rows")
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first"))
    before = F.coalesce(F.sum("total").over(W.orderBy("first", "file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row a file
    files = files.select("file", before.alias("before"))
    return found.join(F.broadcast(files), "file").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_tokens(spark, write_tokens(docs, fresh(spark, "tokens")))
