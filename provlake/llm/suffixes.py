"""Suffix-array dedup: bytes inside a 400-byte string that also starts elsewhere are removed.

1. Samples.  Of the 101 strings of 300 bytes inside any 400-byte string, those with the least rolling hash are
   sampled.  Equal 400-byte strings sample the same places, so only samples whose hash is found twice or
   more matter.  The count is partially aggregated; nothing but hashes is shuffled for it.
2. Contexts.  A surviving sample becomes a short text: up to 100 bytes before it, the 300-byte string as ONE
   symbol, up to 100 bytes after it.  Equal contexts fall together first and carry their number.
3. Columns.  The contexts that differ around the same 300 bytes go through a column-wise construction over
   many texts: each round inserts one symbol of every text, last symbols first, into the Burrows-Wheeler
   transform and the common prefixes of the whole collection.  Both lie in external files of the task,
   read and rewritten in sequence once a round.  Two texts share a 400-byte string exactly where
   neighbouring suffixes have 101 symbols in common across the 300-byte symbol.
4. The covered ranges of each document are merged and cut out.

A 300-byte string with more than HOT distinct contexts is not gathered in a task: its windows are halved by their
place, each half is keyed by the bytes that its windows have in common, and equal remainders fall together,
until no key has more.  Matches never cross documents.
Null text: empty.  Texts under 400 bytes: kept whole.  Repeated rows count as different documents.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provlake.llm.common import join_key, keyed, small_batches, sorted_groups, written

LENGTH = 400
CORE = 300
#: Contexts of one key that a construction takes at most.
HOT = 2000
#: Contexts that go through one construction together.
BUCKET = 1000
#: Rounds after which suffixes that have become mere tails of newer ones leave the files.
RETIRE = 16
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_B = 0x9E3779B97F4A7C15
_STEP = {"up": _B, "down": pow(_B, -1, 1 << 64)}
_powers = {k: np.ones(1, np.uint64) for k in _STEP}


def _power(kind: str, n: int) -> np.ndarray:
    p = _powers[kind]
    while len(p) < n:
        p = np.concatenate((p, p * np.uint64(pow(_STEP[kind], len(p), 1 << 64))))
    _powers[kind] = p
    return p[:n]


def core_hashes(data: bytes, core: int) -> np.ndarray:
    """A 64-bit rolling hash of every string of `core` bytes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[np.frombuffer(data, np.uint8)] * _power("up", n), out=sums[1:])
    h = (sums[core:] - sums[:-core]) * _power("down", n - core + 1)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _slide(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    span = 1
    while span * 2 <= w:
        x = f(x[:-span], x[span:])
        span *= 2
    return f(x[: len(x) - (w - span)], x[w - span :]) if span < w else x


def sample(data: bytes, length: int = LENGTH, core: int = CORE) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the strings that are least in some window of `length` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = core_hashes(data, core)
    w = length - core + 1
    least = _slide(h, w, np.minimum)
    edge = np.zeros(w - 1, np.uint64)
    best = _slide(np.concatenate((edge, least, edge)), w, np.maximum)  # the greatest of the least of all windows around a place
    at = np.flatnonzero(best == h)
    return at, h[at].view(np.int64)


def _hashes(length: int, core: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for rid, t in zip(b["rid"], b["text"], strict=True):
                u, n = np.unique(sample((t or "").encode("utf-8", "replace"), length, core)[1], return_counts=True)
                rows.append((np.full(len(u), rid), u, np.minimum(n, 2)))
            if rows:
                yield pd.DataFrame({"rid": np.concatenate([r[0] for r in rows]), "fp": np.concatenate([r[1] for r in rows]), "n": np.concatenate([r[2] for r in rows]).astype(np.int32)})

    return run


def _contexts(length: int, core: int):
    """Texts with the hashes of their surviving samples -> contexts."""
    side = length - core

    def one(data: bytes, fps: np.ndarray) -> list[tuple]:
        at, h = sample(data, length, core)
        rows = []
        for p in at[np.isin(h, fps)].tolist():
            whole = data[max(0, p - side) : p + length]
            left = min(p, side)
            mid = hashlib.blake2b(whole[left : left + core], digest_size=16).digest()
            right = whole[left + core :]
            ctx = hashlib.blake2b(b"%d " % left + whole, digest_size=16).digest()
            rows.append({"pos": p, "mid": mid, "ctx": ctx, "before": whole[:left], "after": right, "n_before": left, "n_after": len(right)})
        return rows

    @F.pandas_udf("array<struct<pos:int,mid:binary,ctx:binary,before:binary,after:binary,n_before:int,n_after:int>>")
    def run(texts: pd.Series, marks: pd.Series) -> pd.Series:
        return pd.Series([one((t or "").encode("utf-8", "replace"), np.asarray(m, np.int64)) for t, m in zip(texts, marks, strict=True)])

    return run


class Columns:
    """The transform and the common prefixes of a growing collection, in two external files."""

    def __init__(self, folder: str, n: int):
        self.folder, self.size, self.base = folder, 0, n
        self.at = np.arange(n)  # place of each text's newest suffix
        self._put(np.zeros(n, np.uint8), np.zeros(n, np.int16))

    def _put(self, bwt: np.ndarray, lcp: np.ndarray) -> None:
        for name, x in (("bwt", bwt), ("lcp", lcp)):
            with open(f"{self.folder}/{name}", "r+b" if self.size else "wb") as f:
                f.write(x.tobytes())
        self.size = len(bwt)

    def _get(self) -> tuple[np.ndarray, np.ndarray]:
        return np.fromfile(f"{self.folder}/bwt", np.uint8, self.size), np.fromfile(f"{self.folder}/lcp", np.int16, self.size)

    def retire(self, who: np.ndarray) -> None:
        """Leave out all but the newest suffix of each text of `who`, with their order and common prefixes.

        Windows span whole columns: an older suffix is of use only as the tail of a newer one.
        """
        _, lcp = self._get()
        by = who[np.argsort(self.at[who])]
        g = self.at[by]
        between = _least(lcp, g[:-1], g[1:]) - 1
        self.at[by] = np.arange(len(by))
        self.base = len(by)
        self._put(np.zeros(len(by), np.uint8), np.concatenate(([0], between)).astype(np.int16))

    def insert(self, who: np.ndarray, symbol: np.ndarray, tie: np.ndarray | None = None) -> np.ndarray:
        """One round: the next symbol of every text in `who` goes before its newest suffix.

        symbol: 1 and up; 0 ends a text and equals nothing.  tie: sets symbols of one number apart (they were
        not in the collection before).  Returns each new suffix's common prefix with its nearer neighbour.
        """
        bwt, lcp = self._get()
        m, n = len(bwt), len(who)
        g = self.at[who]
        bwt[g] = symbol
        order = np.argsort(bwt, kind="stable")  # places by symbol: the succession of the suffixes that they lead to
        ended = int(np.count_nonzero(bwt == 0))  # these lead nowhere; n suffixes of length zero stand before all others
        fresh_here = np.zeros(m, bool)
        fresh_here[g] = True
        owner = np.empty(m, np.int32)
        owner[g] = np.arange(n)
        r = np.flatnonzero(fresh_here[order])
        mine = owner[order[r]]
        if tie is not None:  # the symbol is new: its places are all of this round
            mine = mine[np.argsort(tie[mine], kind="stable")]
        g, who, symbol = g[mine], who[mine], symbol[mine]
        # neighbours before and after among the places of the same symbol
        if tie is None:
            prev, nxt = order[np.maximum(r - 1, 0)], order[np.minimum(r + 1, m - 1)]
            prev = np.where((r > 0) & (bwt[prev] == symbol) & (symbol > 0), prev, -1)
            nxt = np.where((r + 1 < m) & (bwt[nxt] == symbol) & (symbol > 0), nxt, -1)
        else:
            equal = np.concatenate(([False], tie[mine][1:] == tie[mine][:-1], [False]))
            prev = np.where(equal[:-1], np.concatenate(([-1], g[:-1])), -1)
            nxt = np.where(equal[1:], np.concatenate((g[1:], [-1])), -1)
        up, down = _least(lcp, prev, g), _least(lcp, g, nxt)
        fresh = r - ended + self.base
        live = symbol > 0
        total = self.base + m - ended
        out_b, out_l = np.zeros(total, np.uint8), np.zeros(total, np.int16)
        keep = np.ones(total, bool)
        keep[fresh[live]] = False
        out_b[keep], out_l[keep] = bwt[: total - int(live.sum())], lcp[: total - int(live.sum())]
        out_l[fresh[live]] = up[live]
        has = live & (nxt >= 0)
        out_l[fresh[has] + 1] = down[has]
        alone = live & (nxt < 0) & (fresh + 1 < total)
        out_l[fresh[alone] + 1] = 0
        self.at[who[live]] = fresh[live]
        self._put(out_b, out_l)
        best = np.zeros(n, np.int64)
        best[live] = np.maximum(up, down)[live]
        back = np.zeros(len(self.at), np.int64)
        back[who] = best
        return back


def _least(lcp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 + the least of lcp over (a, b] where both are places, else 0."""
    out = np.zeros(len(a), np.int64)
    ok = np.flatnonzero((a >= 0) & (b >= 0))
    if len(ok):
        by = ok[np.argsort(a[ok], kind="stable")]
        cuts = np.empty(2 * len(by), np.int64)
        cuts[::2], cuts[1::2] = a[by] + 1, b[by] + 1
        out[by] = np.minimum.reduceat(np.concatenate((lcp, lcp[:1])), cuts)[::2] + 1
    return out


def shared_windows(mids: list, lefts: list[bytes], rights: list[bytes], side: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest number of bytes before mid of a window (mid and `side` bytes around it)
    that another text has too; -1, -1 without one."""
    n = len(mids)
    used = np.unique(np.frombuffer(b"".join(lefts) + b"".join(rights) or b"\0", np.uint8))
    code = np.zeros(256, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    if len(used) > 254:
        raise ValueError("more than 254 byte values")
    left, right = np.zeros((n, side), np.uint8), np.zeros((n, side), np.uint8)
    for i, (a, b) in enumerate(zip(lefts, rights, strict=True)):
        left[i, side - len(a) :] = code[np.frombuffer(a, np.uint8)]
        right[i, : len(b)] = code[np.frombuffer(b, np.uint8)]
    low, high = np.full(n, -1), np.full(n, -1)
    everyone = np.arange(n)
    size = np.array([len(b) for b in rights])
    gap = np.array([len(a) for a in lefts])
    with tempfile.TemporaryDirectory(prefix="columns-") as folder:
        col = Columns(folder, n)
        for c in range(side - 1, -1, -1):
            who = everyone[size > c]
            if len(who):
                col.insert(who, right[who, c])
            if c % RETIRE == 0:
                col.retire(everyone)
        name = np.unique(np.asarray(mids, object), return_inverse=True)[1]
        for before in range(side + 1):
            who = everyone if before == 0 else everyone[gap >= before]
            if before == 0:
                best = col.insert(who, np.full(n, len(used) + 1, np.uint8), name)
            else:
                if not len(who):
                    break
                best = col.insert(who, left[who, side - before])
            if before % RETIRE == 0:
                col.retire(who)
            hit = best > side
            low[hit & (low < 0)] = before
            high[hit] = before
    return low, high


def _construct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, rel, before, after, l, h) sorted by key -> (rel, low, high)."""

    def flush(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts, ignore_index=True)
        for width, b in rows.groupby(rows["h"] - rows["l"]):
            low, high = shared_windows(list(b["key"]), list(b["before"]), list(b["after"]), int(width))
            hit, start = low >= 0, b["l"].to_numpy()
            yield pd.DataFrame({"rel": b["rel"][hit], "low": (low + start)[hit].astype(np.int32), "high": (high + start)[hit].astype(np.int32)})

    held: list[pd.DataFrame] = []
    for chunk in sorted_groups(batches, ["key"]):
        key = chunk["key"].to_numpy()
        edges = np.concatenate((np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        start = 0
        for e in edges:
            if e - start + sum(map(len, held)) >= BUCKET or e == len(key):
                held.append(chunk.iloc[start:e])
                start = e
                if sum(map(len, held)) >= BUCKET:
                    yield from flush(held)
                    held = []
    if held:
        yield from flush(held)


def _halves(rows: DataFrame, side: int) -> DataFrame:
    """Each row's windows [l, h] in two halves; key: the bytes that all windows of a half hold, rel: all that any of them holds."""
    mid = ((F.col("l") + F.col("h")) / 2).cast("int")
    two = F.explode(F.array(F.struct(F.col("l").alias("x"), mid.alias("y")), F.struct((mid + 1).alias("x"), F.col("h").alias("y")))).alias("r")
    r = rows.select("ctx", "mid", "whole_before", "whole_after", two).select("*", F.col("r.x").alias("l"), F.col("r.y").alias("h")).drop("r").where(F.col("l") <= F.col("h"))
    nb, na = F.length("whole_before"), F.length("whole_after")
    r = r.where((nb >= F.col("l")) & (na >= side - F.col("h")))
    left, right = F.least(F.col("h"), nb), F.least(side - F.col("l"), na)
    place = F.encode(F.concat_ws(":", F.lit(""), "l", "h", F.lit("")), "UTF-8")
    key = F.md5(F.concat("mid", place, F.substring("whole_before", nb - F.col("l") + 1, F.col("l")), F.substring("whole_after", F.lit(1), side - F.col("h"))))
    extra = [F.substring("whole_before", nb - left + 1, left - F.col("l")), F.substring("whole_after", side - F.col("h") + 1, right - side + F.col("h"))]
    r = r.withColumn("key", F.unhex(key)).withColumn("before", extra[0]).withColumn("after", extra[1])
    sizes = F.encode(F.concat_ws(":", F.lit(""), F.length("before"), F.lit("")), "UTF-8")
    return r.withColumn("rel", F.unhex(F.md5(F.concat("key", sizes, "before", "after"))))


def covered(several: DataFrame, side: int) -> DataFrame:
    """(ctx, low, high) of contexts (mid, ctx, n, before, after) that share a window with another or are found twice.

    Contexts with the same key go through one construction.  A key with more than HOT of them is halved: windows with few bytes
    before mid and windows with many are keyed by the bytes that all of each half hold; equal remainders fall together.  A half
    of one window has one remainder, so at most log2(side) rounds follow, and a context gives two rows in each.
    """
    rows = several.select("ctx", "mid", F.col("before").alias("whole_before"), F.col("after").alias("whole_after"), F.col("mid").alias("key"), F.col("ctx").alias("rel"), "before", "after", F.lit(0).alias("l"), F.lit(side).alias("h"), "n")
    out = None
    while True:
        first = out is None
        distinct = rows if first else rows.groupBy("rel").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("key", "before", "after", "l", "h")])
        counts = written(distinct.groupBy("key").agg(F.count("*").alias("k")).where("k > 1"))
        usual = distinct.join(counts.where(F.col("k") <= HOT), "key", "left_semi").select("key", "rel", "before", "after", "l", "h")
        ranges = usual.repartition("key").sortWithinPartitions("key").mapInPandas(_construct, "rel binary, low int, high int")
        # what is found twice is covered as far as it reaches
        reach = [F.greatest(F.col("l"), F.col("h") - F.length("after")), F.least(F.col("h"), F.col("l") + F.length("before"))]
        again = distinct.where("n > 1").select("rel", reach[0].cast("int").alias("low"), reach[1].cast("int").alias("high")).where("low <= high")
        got = written(ranges.unionAll(again).groupBy("rel").agg(F.min("low").alias("low"), F.max("high").alias("high")))
        here = got.withColumnRenamed("rel", "ctx") if first else written(rows.select("ctx", "rel").join(got, "rel").select("ctx", "low", "high"))
        out = here if first else out.unionAll(here)
        hot = written(counts.where(F.col("k") > HOT).select("key"))
        if hot.isEmpty():
            return out
        rows = written(_halves(rows.join(hot, "key", "left_semi"), side))


def _merge(spans: list, n: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((int(x[0]), int(x[1])) for x in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, n)) for a, b in out]


def _cut(text: str, spans: list | None) -> tuple:
    data = text.encode("utf-8", "replace")
    runs = _merge([] if spans is None else [(s["a"], s["b"]) for s in spans], len(data))
    kept, last = [], 0
    for x, y in runs:
        kept.append(data[last:x])
        last = y
    rest = b"".join([*kept, data[last:]])
    return len(data), sum(y - x for x, y in runs), len(runs), hashlib.sha256(rest).hexdigest(), [f"{x}:{y}" for x, y in runs], rest


def repeated_ranges(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """(doc_id, _th, ends): for each document that has any, the covered ranges (a, b), at most one for each start."""
    side = length - core
    src = keyed(small_batches(docs))
    with_id = src.select(F.xxhash64("doc_id", "_th").alias("rid"), "text")
    marks = with_id.mapInPandas(_hashes(length, core), "rid long, fp long, n int")
    twice = written(marks.groupBy("fp").agg(F.sum("n").alias("n")).where("n > 1").select("fp"))
    # a rid that two documents share only adds hashes to try
    tried = marks.select("rid", "fp").join(twice, "fp", "left_semi").groupBy("rid").agg(F.collect_set("fp").alias("fps"))
    found = src.withColumn("rid", F.xxhash64("doc_id", "_th")).join(tried, "rid").select("doc_id", "_th", "text", "fps")
    ctx = written(found.select("doc_id", "_th", F.explode(_contexts(length, core)("text", "fps")).alias("c")).select("doc_id", "_th", "c.*"))

    by_mid = ctx.groupBy("mid").agg(F.count("*").alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi")).where("n > 1")
    by_mid = written(by_mid.select("mid", (F.col("lo") != F.col("hi")).alias("mixed")))
    mixed = by_mid.where("mixed").select("mid")
    several = written(ctx.join(mixed, "mid").groupBy("ctx").agg(F.first("mid").alias("mid"), F.count("*").alias("n"), F.first("before").alias("before"), F.first("after").alias("after")))
    differing = written(covered(several, side).groupBy("ctx").agg(F.min("low").alias("low"), F.max("high").alias("high")))

    at = ctx.select("doc_id", "_th", "pos", "mid", "ctx", "n_before", "n_after")
    a = at.join(differing, "ctx").select("doc_id", "_th", "pos", "low", "high")
    same = by_mid.where("not mixed").select("mid")
    b = at.join(same, "mid").select("doc_id", "_th", "pos", F.greatest(F.lit(0), side - F.col("n_after")).alias("low"), F.least(F.lit(side), F.col("n_before")).alias("high")).where("low <= high")
    spans = a.unionAll(b).select("doc_id", "_th", (F.col("pos") - F.col("high")).alias("a"), (F.col("pos") - F.col("low") + length).alias("b"))
    starts = spans.groupBy("doc_id", "_th", "a").agg(F.max("b").alias("b"))
    return starts.groupBy("doc_id", "_th").agg(F.collect_list(F.struct("a", "b")).alias("ends"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, core: int = CORE) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans, kept_sha256, the removed ranges and the bytes kept."""
    both = join_key(keyed(docs), written(repeated_ranges(docs, length, core)))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"]

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<string>, kept binary")
    def run(texts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = [_cut(t or "", e) for t, e in zip(texts, ends, strict=True)]
        return pd.DataFrame({n: [r[i] for r in rows] for i, n in enumerate(names)})

    return both.select("doc_id", run("text", "ends").alias("_r")).select("doc_id", "_r.*")
