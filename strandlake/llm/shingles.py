"""Sets of hashed word shingles of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 5
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
STEP = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0..n of the base and of its inverse mod 2**64."""
    if len(_powers.get("up", ())) <= n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    """All words of some texts in a row: hash, text and the word's first and last + 1 byte in `raw`."""

    hashes: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    raw: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    """The words, lower-cased A-Z, between ASCII white space."""
    raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    bounds = np.cumsum([len(t) + 1 for t in texts])
    space = SPACES[raw]
    before = np.concatenate([[True], space[:-1]])
    first = np.flatnonzero(before & ~space)
    last = np.flatnonzero(space & ~before)
    up, down = _power(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[LOWER[raw]] * up[: len(raw)], dtype=np.uint64)])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    return Words(hashes, np.searchsorted(bounds, first, side="right"), first, last, raw)


class Sets(NamedTuple):
    """Of each text: where its tokens begin and how many they are; tokens ascend within a text; keys and more name equal
    sets by 64 bits each."""

    starts: np.ndarray
    sizes: np.ndarray
    tokens: np.ndarray
    keys: np.ndarray
    more: np.ndarray

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.starts[i] : self.starts[i] + self.sizes[i]]


def shingle_sets(texts: list[bytes], width: int = 5) -> Sets:
    """Distinct shingles of `width` words of each text; a shorter text is one shingle; one without words has none."""
    words, doc, *_ = words_of(texts)
    n_words = np.bincount(doc, minlength=len(texts))
    n = len(words) - width + 1
    hashes, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n > 0:
        inside = doc[:n] == doc[width - 1 :]
        value = np.zeros(n, np.uint64)
        for k in range(width):
            value += words[k : k + n] * STEP[k]
        hashes, owner = mix(value[inside]), doc[:n][inside]
    few = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(few):
        at = np.cumsum(n_words) - n_words
        whole = [sum((int(words[at[d] + k]) * int(STEP[k]) for k in range(n_words[d])), int(n_words[d])) & (1 << 64) - 1 for d in few]
        hashes, owner = np.concatenate([hashes, mix(np.array(whole, np.uint64))]), np.concatenate([owner, few])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    sizes = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes

    def name(salt: int) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(salt)), dtype=np.uint64)])
        return mix(sums[starts + sizes] - sums[starts] + sizes.astype(np.uint64)).view(np.int64)

    return Sets(starts, sizes, hashes, name(0xD6E8FEB86659FD93), name(0xA0761D6478BD642F))


def portions(texts, most_bytes: int = 500_000) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about `most_bytes`, as (place of the first, UTF-8 texts); null counts as empty."""
    run: list[bytes] = []
    at = size = 0
    for i, text in enumerate(texts):
        run.append(text.encode("utf-8", "surrogatepass") if text else b"")
        size += len(run[-1])
        if size >= most_bytes:
            yield at, run
            run, size, at = [], 0, i + 1
    if run:
        yield at, run
