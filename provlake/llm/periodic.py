"""Periodic runs of words, by the maximal pairs of each text's LCP-interval tree.

A run is a stretch of words with smallest period q, at least LEAST words and TIMES periods long, that no neighbouring word
extends.  It is the same as a maximal pair of the text: two places q apart whose words agree up to the run's end, with
different words (or none) on their left, and different words (or the end) on their right.  So nothing is extended:

1. Texts are taken together in chunks of about CHUNK bytes.  Their words become numbers.  A rolling hash tells the texts with an
   equal window of `depth` words, the least that a pair can share; no others can hold a run.
2. The suffixes of those texts are sorted by prefix doubling; the ranks of each length 2^j are kept, and the longest common prefixes
   of neighbours are read off them.  The text's number is part of the first rank, so nothing is shared between texts.
3. The intervals of the LCP array at least `depth` deep are closed bottom-up.  An interval holds its places in the order of
   the text, each with its left word's class.  As a child joins its parent, each place of the smaller list meets its
   neighbours of the other list: with different left classes and a distance that the depth allows they are a pair.

Only neighbours can be a run's pair: any third place between them would give the stretch a smaller period, as the shared part has
at least two periods (TIMES is at least 3).  So class lists are not multiplied out, lists are joined small to large, and a text of n
words takes O(n log n) steps, however often its passages repeat.  Pairs at multiples of q have the same start and end as
the run; the smallest distance stays.

Memory: one chunk, or one text if that is longer: four bytes for each word and doubling of its longest repeat.

Null or empty text: no words, no runs, collapsed is the empty text.  Every row has its own result, also repeated rows and null ids.  Other
columns are left out, so their names don't matter.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import small_batches

LEAST = 6
TIMES = 4
#: Bytes of text whose suffixes are sorted together.
CHUNK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def least_depth(least: int, times: int) -> int:
    """The fewest words that the two places of a run's pair share."""
    return min(max(least - q, (times - 1) * q) for q in range(1, max(2, least)))


def _repeating(words: np.ndarray, doc: np.ndarray, depth: int, n_docs: int) -> np.ndarray:
    """For each text, whether two of its windows of `depth` words have the same hash."""
    n = len(words) - depth + 1
    if n < 2:
        return np.zeros(n_docs, bool)
    h = doc[:n].astype(np.uint64)
    for j in range(depth):
        h = (h ^ words[j : j + n].astype(np.uint64)) * _ODD
        h ^= h >> np.uint64(29)
    inside = np.flatnonzero(doc[:n] == doc[depth - 1 :])
    h = h[inside]
    order = np.argsort(h)
    twice = h[order[1:]] == h[order[:-1]]
    out = np.zeros(n_docs, bool)
    out[doc[inside[order[1:][twice]]]] = True
    return out


def _starts(differs: np.ndarray) -> np.ndarray:
    """For each place of a sorted list, where its group begins; differs tells the places (from the second) that begin one."""
    at = np.arange(len(differs) + 1)
    at[1:][~differs] = 0
    return np.maximum.accumulate(at)


def _doublings(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """The ranks of all suffixes by their first 1, 2, 4, ... words inside their text, until all differ."""
    n = len(words)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    still = np.arange(n)
    base = np.zeros(n, np.int64)
    levels, length = [], 0
    while True:
        order = np.argsort(key, kind="stable")
        key, places = key[order], still[order]
        run = _starts(key[1:] != key[:-1])
        old = base[places]
        ranks = old + run - _starts(old[1:] != old[:-1])
        base = base.copy()
        base[places] = ranks
        levels.append(base.astype(np.int32))
        same = np.flatnonzero(run[1:] == run[:-1])
        if not len(same):
            return levels
        more = np.zeros(len(places), bool)
        more[same] = more[same + 1] = True
        still = places[more]
        length = 2 * length or 1
        after = still + length
        inside = after < end[still]
        after[~inside] = 0
        key = base[still] * (n + 1) + np.where(inside, base[after] + 1, 0)


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many words the suffixes at a and b share."""
    n, out = len(end), np.zeros(len(a), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        ok = (x < end[a]) & (y < end[b])
        ok[ok] = levels[j][x[ok]] == levels[j][y[ok]]
        out[ok] += 1 << j
    return np.minimum(out, n)


def _interval_pairs(places: list[int], shared: list[int], left: np.ndarray, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(start, period, length) of the maximal pairs of a run's distance below one interval; places in suffix order."""

    def joined(a: list[int], b: list[int], depth: int) -> list[int]:
        few, many = (a, b) if len(a) < len(b) else (b, a)
        reach = depth // (times - 1)
        for p in few:
            i = bisect(many, p)
            for x, y in ((many[i - 1], p) if i else (0, 0), (p, many[i]) if i < len(many) else (0, 0)):
                if 0 < y - x <= reach and y - x + depth >= least and left[x] != left[y]:
                    found.append((x, y - x, y - x + depth))
        if len(few) * 8 < len(many):
            for p in few:
                insort(many, p)
        else:
            many += few
            many.sort()
        return many

    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, list[int]]] = []
    held = [places[0]]
    for p, depth in zip(places[1:], shared, strict=True):
        while open_ and open_[-1][0] > depth:
            value, own = open_.pop()
            held = joined(own, held, value)
        if open_ and open_[-1][0] == depth:
            held = joined(open_.pop()[1], held, depth)
        open_.append((depth, held))
        held = [p]
    while open_:
        value, own = open_.pop()
        held = joined(own, held, value)
    return iter(found)


def _runs(words: np.ndarray, doc: np.ndarray, end: np.ndarray, least: int, times: int) -> dict[tuple[int, int], int]:
    """(start, length) -> period of all runs of the texts that lie one after another in words."""
    depth = least_depth(least, times)
    levels = _doublings(words, doc, end)
    suffixes = np.empty(len(words), np.int64)
    suffixes[levels[-1]] = np.arange(len(words))
    shared = _common(levels, suffixes[:-1], suffixes[1:], end)
    deep = np.concatenate(([False], shared >= depth, [False]))
    first, last = np.flatnonzero(~deep[:-1] & deep[1:]), np.flatnonzero(deep[:-1] & ~deep[1:])
    left = np.where(np.concatenate(([True], doc[1:] != doc[:-1])), -1, np.concatenate(([-1], words[:-1])))
    out: dict[tuple[int, int], int] = {}
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        places, own = suffixes[a : b + 1], shared[a:b]
        if np.diff(np.sort(places)).min() * (times - 1) > own.max():
            continue  # no two places are near enough for what any two of them share
        for start, period, length in _interval_pairs(places.tolist(), own.tolist(), left, least, times):
            if period < out.get((start, length), period + 1):
                out[start, length] = period
    return out


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """For each text, given as its words: its runs (start, length, period) by start, then period."""
    if times < 3 or least < 1:
        raise ValueError("runs need at least three periods and one word")
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(texts)), sizes)
    some = _repeating(words, doc, least_depth(least, times), len(texts))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not some.any():
        return out
    kept = some[doc]
    words, doc, sizes = words[kept], doc[kept], np.where(some, sizes, 0)
    stop = np.cumsum(sizes)
    for (start, length), period in sorted(_runs(words, doc, stop[doc], least, times).items()):
        d = int(doc[start])
        out[d].append((start - int(stop[d] - sizes[d]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run contains after its first period."""
    if not runs:
        return b" ".join(words)
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\x01" * (length - period)
    return b" ".join([w for w, g in zip(words, gone, strict=True) if not g])


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period, by start, then period) and collapsed, the text without repeated periods."""
    one = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def answer(ids: list[pa.Array], texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]  # bytes split at exactly the six blanks
        runs = runs_of_texts(words, least, times)
        made = [
            pa.array([len(w) for w in words], pa.int64()),
            pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], pa.list_(one)),
            pa.array([collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), *made], names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            begin, held, texts = 0, 0, []
            for i, t in enumerate(b.column(1)):
                texts.append(t.as_py() or b"")
                held += len(texts[-1])
                if held >= CHUNK or i + 1 == b.num_rows:
                    yield answer([b.column(0).slice(begin, i + 1 - begin)], texts)
                    begin, held, texts = i + 1, 0, []

    src = small_batches(docs).select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; ties: the first in the list.  Null if there is none."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def run_lines(runs: Column) -> Column:
    """`start,length,period` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
