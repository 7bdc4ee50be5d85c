"""Quality rules by repetition coverage: the share of characters inside duplicated n-grams and lines.

Three coverages decide, each against its limit: word n-grams that occur twice or more anywhere in the text (rolling
hashes of several lengths), lines that occur twice or more, and character n-grams that repeat at once, three times or
more in a row (as noise like `***` or `ababab` does, which word n-grams do not see).
Each text is handled whole and alone, so the job is one map over the documents and nothing is shuffled.
Null or empty text: all counts zero, base_failed true, kept false.  Repeated rows and ties: each row alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from provlake.llm.common import per_text

#: n-gram length in words -> largest share of word characters inside n-grams that occur twice or more.
MAX_COVERAGE = {5: 0.36, 6: 0.34, 7: 0.32, 8: 0.30, 9: 0.28, 10: 0.26}
MAX_LINE_COVERAGE = 0.30
#: Lengths in bytes of the n-grams that repeat at once, how many in a row count, and the largest share inside such runs.
RUN_UNITS = range(1, 9)
RUN_COPIES = 3
MAX_RUN_COVERAGE = 0.10
MIN_WORDS = 20
WINDOW = 8
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * _MUL
    x ^= x >> np.uint64(31)
    return x * _BASE


def _inside(h: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words stand in a window whose hash is found twice or more."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    eq = s[1:] == s[:-1]
    dup = np.zeros(len(h), bool)
    dup[order[1:][eq]] = True
    dup[order[:-1][eq]] = True
    edge = np.zeros(words + 1, np.int32)
    at = np.flatnonzero(dup)
    edge[at] += 1
    np.subtract.at(edge, at + n, 1)
    return np.cumsum(edge[:-1]) > 0


def in_runs(raw: np.ndarray, units=RUN_UNITS, copies: int = RUN_COPIES) -> np.ndarray:
    """Which bytes stand in `copies` or more successive copies of one n-gram of a length in `units`."""
    inside = np.zeros(len(raw), bool)
    for unit in units:
        if len(raw) < unit * copies:
            break
        same = np.concatenate((np.zeros(unit, np.int8), (raw[unit:] == raw[:-unit]).view(np.int8), [0]))
        step = np.diff(same, prepend=np.int8(0))
        a, b = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        for i, j in zip(a[b - a >= unit * (copies - 1)].tolist(), b[b - a >= unit * (copies - 1)].tolist(), strict=True):
            inside[i - unit : j] = True
    return inside


def repetition(text: str, max_coverage: dict[int, float] = MAX_COVERAGE, max_lines: float = MAX_LINE_COVERAGE, max_runs: float = MAX_RUN_COVERAGE) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, the largest coverage, line and run coverage."""
    data = text.encode("utf-8", "replace")
    raw = np.frombuffer(data, np.uint8)
    words = data.split()  # of bytes: exactly the ASCII blanks
    n = len(words)
    symbols = int(_SYMBOL[raw].sum())
    first = (raw & 0xC0) != 0x80
    inside = ~_SPACE[raw]
    chars = int((first & inside).sum())

    seen: set[bytes] = set()
    twice: set[bytes] = set()
    n_dup = 0
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    for x in lines:
        if x in seen:
            n_dup += 1
            twice.add(x)
        seen.add(x)
    in_lines = sum(len(b"".join(x.split()).decode("utf-8", "replace")) for x in lines if x in twice) if twice else 0

    repeat, worst, over = 0, 0.0, False
    if n >= min([WINDOW, *max_coverage]):
        box = np.empty(n, object)
        box[:] = words
        v = _spread(pd.factorize(box)[0])
        edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        count = np.concatenate(([0], np.cumsum(first)))
        size = count[np.flatnonzero(edges == -1)] - count[np.flatnonzero(edges == 1)]
        h = v
        for k in range(2, min(n, max([WINDOW, *max_coverage])) + 1):
            h = h[:-1] * _BASE + v[k - 1 :]  # rolls on from the hashes of length k - 1
            if k != WINDOW and k not in max_coverage:
                continue
            mask = _inside(h, k, n)
            repeat = int(mask.sum()) if k == WINDOW else repeat
            if k in max_coverage:
                share = float(size[mask].sum()) / max(chars, 1)
                worst, over = max(worst, share), over or share > max_coverage[k]
    line_share = in_lines / max(chars, 1)
    run_share = float((in_runs(raw) & inside & first).sum()) / max(chars, 1)
    failed = n < MIN_WORDS or 100 * repeat > 30 * n
    return n, chars, symbols, n_dup, repeat, failed, not (failed or over or line_share > max_lines or run_share > max_runs), worst, line_share, run_share


def repetition_quality(docs: DataFrame, max_coverage: dict[int, float] | None = None, max_lines: float = MAX_LINE_COVERAGE, max_runs: float = MAX_RUN_COVERAGE) -> DataFrame:
    """One row per document with its base counts, its coverages and the verdict."""
    limits = max_coverage or MAX_COVERAGE
    schema = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ngram_coverage double, line_coverage double, run_coverage double"
    return per_text(docs, lambda t: repetition(t, limits, max_lines, max_runs), schema)
