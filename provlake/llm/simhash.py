"""SimHash near-duplicates through a Gray-ordered hierarchical index.

1. Fingerprints are computed per document in one map; equal ones fall together (partial aggregation).
2. Two fingerprints with at most 2 differing bits agree on at least 3 of 5 blocks of bits, so each
   distinct fingerprint goes to the C(5, 3) = 10 buckets of its triples of blocks.  A bucket with more than
   HOT fingerprints is dealt out again by thirds of its two open blocks (one third must agree too).
3. In each bucket fingerprints are sorted by Gray rank and the bits that neighbours share are factored
   into nodes of a tree; pairs of nodes are followed down only while their shared bits differ in at most 2.
   A bucket gives each of its fingerprints its local root, not all pairs.
4. Components: alternate large-star and small-star steps over written tables until nothing changes.

Null or empty text: fingerprint zero, linked like any other.  Repeated rows and ties share a
fingerprint and so a component.  component_id is the smallest doc_id of the component (null ids are ignored
unless there is no other).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provlake.llm.common import KEY, free_name, keyed, small_batches, written

BITS = 2
SEED = 42
HOT = 3000
#: 64 bits in five blocks, as (shift, width).
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
TRIPLES = list(combinations(range(5), 3))
_FAN = 8


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits, each set if it is set in over half of the hashes of the word shingles; signed."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    h = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [h(line, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [h(line[a:b], SEED) for a, b in zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
    v = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(v), 1 << 16):
        ones += np.unpackbits(v[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(v), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, _th (a hash of the text), fp (signed 64 bits)."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return keyed(small_batches(docs)).select(*KEY, run("text").alias("fp"))


def gray_rank(v: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray order."""
    r = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def index_links(fps: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in fps) of distinct fingerprints at most `bits` apart, from the hierarchical index."""
    n = len(fps)
    order = np.argsort(gray_rank(fps), kind="stable")
    leaf = fps[order]
    levels = [(leaf, ~np.zeros(n, np.uint64))]  # shared pattern, mask of shared bits
    while len(levels[-1][0]) > _FAN:
        p, m = levels[-1]
        cut = np.arange(0, len(p), _FAN)
        every = np.bitwise_and.reduceat(p & m, cut)
        some = np.bitwise_or.reduceat((p & m) | ~m, cut)
        mask = np.bitwise_and.reduceat(m, cut) & ~(every ^ some)
        levels.append((every & mask, mask))
    top = len(levels[-1][0])
    a, b = np.triu_indices(top)
    out_a, out_b = [], []
    stack = [(len(levels) - 1, a, b)]
    while stack:
        level, a, b = stack.pop()
        p, m = levels[level]
        keep = np.bitwise_count((p[a] ^ p[b]) & m[a] & m[b]) <= bits
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level == 0:
            real = a != b
            out_a.append(order[a[real]])
            out_b.append(order[b[real]])
            continue
        for i in range(0, len(a), 1 << 14):  # bounded memory: a slice of node pairs at a time
            x = (a[i : i + (1 << 14), None, None] * _FAN + np.arange(_FAN)[None, :, None]).astype(np.int64)
            y = (b[i : i + (1 << 14), None, None] * _FAN + np.arange(_FAN)[None, None, :]).astype(np.int64)
            x, y = np.broadcast_arrays(x, y)
            x, y = x.ravel(), y.ravel()
            ok = (x <= y) & (y < len(levels[level - 1][0]))
            stack.append((level - 1, x[ok], y[ok]))
    if not out_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each place reaches by the pairs."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        was = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(was, root):
            break
    return root


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (bucket, fp) sorted by bucket -> (src, dst): each fingerprint and its smaller local root."""
    from provlake.llm.common import sorted_groups

    for chunk in sorted_groups(batches, ["bucket"]):
        key = chunk["bucket"].to_numpy()
        fp = chunk["fp"].to_numpy()
        edge = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        src, dst = [], []
        for i, j in zip(edge[:-1], edge[1:], strict=True):
            if j - i < 2:
                continue
            own = np.sort(fp[i:j])
            root = local_roots(len(own), *index_links(own.view(np.uint64)))
            far = np.flatnonzero(root != np.arange(len(own)))
            src.append(own[far])
            dst.append(own[root[far]])
        if src:
            yield pd.DataFrame({"src": np.concatenate(src), "dst": np.concatenate(dst)})


def _bits(shift: int, width: int):
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)


def buckets(fps: DataFrame) -> DataFrame:
    """(bucket, fp) for all buckets with two fingerprints or more; hot ones dealt out again."""
    keys = [F.struct(F.lit(k).alias("c"), F.xxhash64(F.lit(k), *[_bits(*BLOCKS[i]) for i in t]).alias("bucket")) for k, t in enumerate(TRIPLES)]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.c", "k.bucket")
    sizes = written(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    rows = rows.join(sizes, "bucket")
    cold = rows.where(F.col("n") <= HOT).select("bucket", "fp")
    thirds = []
    for k, t in enumerate(TRIPLES):
        (s1, w1), (s2, w2) = (BLOCKS[i] for i in range(5) if i not in t)
        open_bits = F.shiftleft(_bits(s1, w1), 13).bitwiseOR(_bits(s2, w2))
        cuts = [(0, 9), (9, 9), (18, 8)]
        thirds.append(F.when(F.col("c") == k, F.array(*[F.xxhash64("bucket", F.lit(i), F.shiftrightunsigned(open_bits, a).bitwiseAND((1 << b) - 1)) for i, (a, b) in enumerate(cuts)])))
    hot = rows.where(F.col("n") > HOT).select(F.explode(F.coalesce(*thirds)).alias("bucket"), "fp")
    return cold.unionAll(hot)


def components(edges: DataFrame, rounds: int = 30) -> DataFrame:
    """(node, root) for all nodes of edges (src, dst); root is the smallest node reached.

    Large-star and small-star steps; each takes minima by partial aggregation and joins them back, so a
    node with many links is never gathered.  Tables are written each round.
    """
    e = written(edges.select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).where("a <> b").distinct())
    sign = lambda t: t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    was = sign(e)
    for _ in range(rounds):
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = written(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        small = large.join(written(large.groupBy("a").agg(F.min("b").alias("m"))), "a")
        e = written(small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        now = sign(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _by_root(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, _th, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    marks = written(fingerprints(docs, width))
    # several documents may share a fingerprint: link rows by fingerprint, name components by document
    fps = marks.groupBy("fp").agg(F.min("doc_id").alias("first"))
    pairs = buckets(fps.select("fp")).repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_bucket_links, "src long, dst long")
    roots = written(components(pairs))
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marks, written(named.join(least, "root").select("fp", "root", "component_id"))


def simhash_components(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    marks, by_fp = _by_root(docs, width)
    return marks.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame, width: int = 3) -> DataFrame:
    """One row of docs for each component, the one with the least doc_id (no id: last; then by text hash); all columns as they were.

    Only ids are gathered.  The rows themselves move in one keyed shuffle, whatever the number of ids: the join is told to
    hash the ids, so that the plan is the same at every size and skewed ids are split.  Repeated rows with
    one id and one text are told apart by a window over these rows alone.
    """
    marks, by_fp = _by_root(docs, width)
    rows = marks.groupBy("fp", *KEY).agg(F.count("*").alias("n")).join(by_fp.select("fp", "root"), "fp")
    rows = written(rows.select("root", F.struct(F.col("doc_id").isNull().alias("z"), *KEY).alias("r"), "n"))
    first = rows.groupBy("root").agg(F.min("r").alias("f"))
    gone = (F.col("r") != F.col("f")).alias("_gone")
    told = written(rows.join(first, "root").select(F.col("r.doc_id").alias("_id"), F.col("r._th").alias("_ih"), gone, "n").where("_gone or n > 1").select("_id", "_ih", "_gone"))
    own = {c: free_name(c, docs.columns) for c in ("_id", "_ih", "_gone", "_rank")}
    told = told.withColumnsRenamed({c: own[c] for c in told.columns}).hint("shuffle_hash")
    both = docs.join(told, docs["doc_id"].eqNullSafe(F.col(own["_id"])) & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col(own["_ih"])), "left")
    single = both.where(F.col(own["_gone"]).isNull()).select(docs.columns)
    rank = F.row_number().over(Window.partitionBy(own["_id"], own["_ih"]).orderBy(F.xxhash64(*docs.columns)))
    repeated = both.where(~F.col(own["_gone"])).withColumn(own["_rank"], rank).where(F.col(own["_rank"]) == 1).select(docs.columns)
    return single.unionAll(repeated)
