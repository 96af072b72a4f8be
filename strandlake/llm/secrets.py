"""Secret scans: fixed base patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spends few tokens on language and many on random strings. A run of key characters whose
characters-per-token ratio under a public vocabulary is low is a secret, unless it is a known kind of digest or
identifier, a name made of words, dates and numbers, a biological sequence, or prose in base64. The ratio is taken of the whole run and of its pieces between = and /, so that a name or path beside a key
doesn't hide it; inside an address only the pieces count.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import put, short_batches, tokenizer_file

# The base patterns, the shortest lengths, and the kinds in their order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run can't hold a match, so this finds the same runs as one of any length
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "api")

#: Runs that may be random keys: letters of both cases, digits and the base64 signs.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
PIECE = re.compile(r"[^=/]{20,}")
#: Digests and identifiers that are no secrets: MD5, SHA-1, SHA-2 in hex; SHA-2 of subresource integrity in base64; content
#: ids; UUIDs; ULIDs; numbers. Letters are left to the ratio.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|sha(?:256-[A-Za-z0-9+/]{43}=|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86}==)"
    r"|Qm[1-9A-HJ-NP-Za-km-z]{44}|baf[ky][a-z2-7]{55}|[0-7][0-9A-HJKMNP-TV-Z]{25}"
    r"|(?:ISBN|ISSN|EAN|DOI|ORCID)(?:-?1[03])?[-_=:]*[0-9][0-9_-]*[Xx]?"
    r"|[ACGTUN]+|[acgtun]+|[ACDEFGHIKLMNPQRSTVWY]+"
    r"|[0-9+/_=-]+)")
#: The parts of a name that say nothing of it: numbers, dates, times and versions.
COUNTED = re.compile(r"(?:[vr]?[0-9]+|(?:19|20)[0-9]{6}T[0-9]{4,6}Z?|[0-9]{1,2}(?:st|nd|rd|th))", re.I)
PARTS = re.compile(r"[^/_=+-]+")
#: What may stand before a run of base64, and the prose that a run may hold; `user:key` is none.
LEAD = re.compile(r"[A-Za-z][A-Za-z0-9_-]*=(?=[^=])")
PROSE = re.compile(r"[^\W\d_]+(?:[,.;:!?'\")–—-]*\s+['\"(–—-]*[^\W_]+(?:['’-][^\W_]+)*)+[\s.!?'\")]*")
#: What stands before a run inside an address: only the run's pieces can be keys there, not its path as a whole.
ADDRESS = re.compile(r"://\S*")

_vocabularies: dict = {}


def vocabulary(path: str):
    """The tiktoken encoding of a rank file, made once in each worker."""
    if path not in _vocabularies:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _vocabularies[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _vocabularies[path]


def _is_name(run: str, encode, most_chars_per_token: float) -> bool:
    """Whether the run is dates, numbers and versions joined with words that pass the ratio by themselves."""
    parts = PARTS.findall(run)
    words = [p for p in parts if not COUNTED.fullmatch(p)]
    return 0 < len(words) < len(parts) and all(w.isalpha() and len(w) > most_chars_per_token * len(encode(w)) for w in words)


def _is_prose(run: str, encode, most_chars_per_token: float) -> bool:
    """Whether the run, or what follows its `name=`, is base64 of words that pass the ratio."""
    lead = LEAD.match(run)
    code = (run[lead.end() :] if lead else run).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        said = base64.b64decode(code + "=" * (-len(code) % 4), validate=True).decode()
    except ValueError:
        return False
    return PROSE.fullmatch(said) is not None and len(said) > most_chars_per_token * len(encode(said))


def _harmless(run: str, encode, most_chars_per_token: float) -> bool:
    """Whether the ratio clears the run, or it is a name or prose."""
    return len(run) > most_chars_per_token * len(encode(run)) or _is_name(run, encode, most_chars_per_token) or _is_prose(run, encode, most_chars_per_token)


def spans(text: str, encode, most_chars_per_token: float) -> list[tuple[int, int, int]]:
    """(start, end, kind number), sorted; code points, end exclusive."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(*m.span(), 2) for m in HEX.finditer(text)]
    base = list(found)
    addresses: list[tuple[int, int]] | None = None

    def in_address(at: int) -> bool:
        """Whether an address, of any length, or a colon stands right before this place."""
        nonlocal addresses
        if addresses is None:
            addresses = [m.span() for m in ADDRESS.finditer(text)]
        i = bisect_right(addresses, (at - 3, len(text))) - 1
        return text[at - 1 : at] == ":" or (i >= 0 and at <= addresses[i][1])

    for m in RUN.finditer(text):
        run, (start, end) = m[0], m.span()
        if KNOWN.fullmatch(run) or any(a < end and start < b for a, b, _ in base):
            continue
        address = (run.startswith("//") or "/" in run) and in_address(start)
        if not address and not _harmless(run, encode, most_chars_per_token):
            found.append((start, end, 3))
            continue
        for p in PIECE.finditer(run):
            if p[0] != run and not KNOWN.fullmatch(p[0]) and not _harmless(p[0], encode, most_chars_per_token):
                found.append((start + p.start(), start + p.end(), 3))
    return sorted(found, key=lambda x: (x[0], x[2]))


def find_secrets(docs: DataFrame, text: str = "text", ranks: str | None = None, most_chars_per_token: float = 2.0) -> DataFrame:
    """Add secrets: array of (kind, start, end) by start, then kind as in KINDS; whole texts, code points.

    The base patterns always stay; the efficiency test adds `random` spans where no base span lies. Null and empty
    texts have none. Repeated rows get the same spans; a column `secrets` is replaced, all others stay; an empty table
    gives an empty table.
    """
    path = ranks or tokenizer_file("byte_bpe_50k.tiktoken")

    @F.pandas_udf("array<string>")
    def scan(texts: pd.Series) -> pd.Series:
        encode = vocabulary(path).encode_ordinary
        return pd.Series([[f"{KINDS[k]}:{a}:{b}" for a, b, k in spans(t, encode, most_chars_per_token)] if t else [] for t in texts], dtype=object)

    def parts(one):
        p = F.split(one, ":")
        return F.struct(p[0].alias("kind"), p[1].cast("int").alias("start"), p[2].cast("int").alias("end"))

    return put(short_batches(docs), secrets=F.transform(scan(F.coalesce(F.col(text), F.lit(""))), parts))


def _joined(secrets):
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    secrets = F.col("secrets")

    def count(kind: str):
        return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")

    n = {f"n_{kind}": count(kind) for kind in KINDS[:3]}
    base = F.filter(secrets, lambda s: s["kind"] != KINDS[3])
    return found.select("doc_id", *[c.alias(k) for k, c in n.items()], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(secrets).alias("spans"))
