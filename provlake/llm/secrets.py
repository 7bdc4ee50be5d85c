"""Secret scans: fixed patterns, and a token-efficiency test for strings that no pattern names.

Text that people write packs several characters into each token of a BPE vocabulary; random strings
do not.  Long unbroken strings with letters, with or without digits, that have few characters per token are reported,
unless they have the form of a known digest or consist of vocabulary words and numbers.  One map over whole texts, no shuffle.
Null text: empty.  Repeated rows: each row alone.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate, pairwise

from pyspark.sql import DataFrame

from provlake.llm.common import per_text

KINDS = ("assign", "access", "hex", "random")
# The base patterns.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so the length may stand in the pattern
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Hex lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGESTS = {32, 40, 56, 64, 96, 128}
_HEXES = re.compile(r"[0-9a-fA-F]+")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: Words in one case style, numbers, and what separates them: no two alternatives begin with the same character.
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+|[^A-Za-z0-9]+")
LEAST_WORD = 3
MAX_RATIO = 2.1
LETTERS_RATIO = 2.05
LEAST_LETTERS = 8
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("provlake", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def identifier(s: str, path: str) -> bool:
    """Words and numbers only: each run of letters in one case style has three letters or more and is a word of the vocabulary."""
    one = lambda w: len(_encoding(path).encode_ordinary(f" {w}")) == 1
    return all(len(p) >= LEAST_WORD and (one(p) or one(p.lower())) for p in _PARTS.findall(s) if p[0].isalpha())


def random_looking(s: str, path: str, max_ratio: float = MAX_RATIO, letters_ratio: float = LETTERS_RATIO) -> bool:
    """Few characters per token; strings of letters alone have a lower limit, as long words of other languages come near, and
    need some different letters.  Numbers, digests, identifiers and stretches of the alphabet are none."""
    if not re.search("[A-Za-z]", s) or (_HEXES.fullmatch(s) and len(s) in DIGESTS) or _UUID.fullmatch(s):
        return False
    if 2 * sum(ord(y) - ord(x) == 1 for x, y in pairwise(s)) > len(s):
        return False
    if not re.search("[0-9]", s):
        max_ratio = min(max_ratio, letters_ratio)
        if len(set(s)) < LEAST_LETTERS:
            return False
    return len(s) / len(_encoding(path).encode_ordinary(s)) < max_ratio and not identifier(s, path)


def ends_before(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """The starts of spans in order, and the last end of those up to each: a span (a, b) meets none if ends before b are at most a."""
    spans = sorted(spans)
    return [s[0] for s in spans], list(accumulate((s[2] for s in spans), max))


def scan(text: str, path: str, max_ratio: float = MAX_RATIO) -> tuple:
    low = text.lower()
    base = []
    if ("=" in text or ":" in text) and any(k in low for k in ("passw", "secret", "token", "api")):
        base += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found = [(m.start(), 3, m.end()) for m in _LONG.finditer(text)]
    if found:
        starts, ends = ends_before(base)
        free = lambda a, b: not (i := bisect_left(starts, b)) or ends[i - 1] <= a
        found = [x for x in found if free(x[0], x[2]) and random_looking(text[x[0] : x[2]], path, max_ratio)]
    show = lambda xs: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(xs))
    n = [sum(x[1] == k for x in base) for k in range(3)]
    return *n, hashlib.sha256(show(base).encode()).hexdigest(), show(base + found), len(found), [text[a:b] for a, _, b in sorted(base + found)]


def scan_secrets(docs: DataFrame, vocabulary: str | None = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: counts by kind, all spans, and the strings found."""
    path = vocabulary or vocabulary_path("byte_bpe_50k.tiktoken")
    return per_text(docs, lambda t: scan(t, path, max_ratio), "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long, found array<string>")
