"""Periodic runs, source mixing and the Merkle manifest against plain brute-force versions, with the odd cases."""

import hashlib
import random
import time
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from provlake.llm import manifest, mixing, periodic, queries
from provlake.llm.common import ranked

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, n_words string, g int, item string, size string, number int"
rnd = random.Random(11)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def prose(n, k=9):
    return " ".join(rnd.choice("abcdefghijklmnop"[:k]) for _ in range(n))


TEXTS = [
    None, "", " \n\t ", "one", prose(60, 2), prose(300, 2), prose(500, 16), "ab " * 700, "a b\tc\n" * 40, "A a " * 3, "x " * 5, "x " * 6, "é\x85ü　 " * 20,
    prose(30) + " " + "p q r s " * 5 + prose(30), prose(10) + " z z z z z z " + "y y y y y y y " + prose(3), "x" * 50_000, (prose(50) + "\n") * 9,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None][i % 2], ["s1", "s2", "é", None, "S"][i % 5], len(t or ""), 1, "clash", 2, "clash", "clash", 3) for i, t in enumerate(TEXTS * 12)]
    rows += [(3, TEXTS[4], None, "s1", None, None, None, None, None, None, None)] * 2 + [(None, TEXTS[5], None, None, 7, None, None, None, None, None, None), (900, "alone", "en", "only", 5, 0, "", 0, "", "", 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def same(got, want):
    assert Counter(map(repr, got)) == Counter(map(repr, want))


def plain_runs(w, least=6, times=4):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if (n := j - i + q) >= max(least, times * q) and j > i:
                out.setdefault((i, n), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def test_runs_of_random_words():
    for k in range(600):
        size, kinds = rnd.randrange(0, 70), rnd.choice((1, 2, 3, 6))
        texts = [[b"abcdefgh"[x : x + 1] for x in (rnd.randrange(kinds) for _ in range(size))] for _ in range(rnd.randrange(1, 4))]
        for t in texts:  # a planted run
            a, q, n = rnd.randrange(size + 1), rnd.randrange(1, 6), rnd.randrange(40)
            t[a:a] = (t[a : a + q] or [b"z"]) * (n // q)
        for least, times in ((6, 4), (3, 3), (12, 5)):
            assert periodic.runs_of_texts(texts, least, times) == [plain_runs(t, least, times) for t in texts], (k, texts)


def planted(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def plain_answer(doc_id, text):
    w = planted(doc_id, text)
    runs, best = plain_runs(w), (None,) * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = s, n, q, 1000 * n // q
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    return (doc_id, len(w), len(runs), *best, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("chunk", [1 << 20, 200])
def test_op11(docs, monkeypatch, chunk, spark, tmp_path):
    monkeypatch.setattr(periodic, "CHUNK", chunk)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = [plain_answer(r.doc_id, r.text) for r in docs.collect()]
    assert sum(w[2] > 0 for w in want) > 20
    same([tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()], want)


def test_periodic_runs_of_long_texts_take_linear_steps():
    for t in (b"ab " * 400_000, b"".join(b"same five words stand here %d " % i for i in range(60_000))):
        began = time.perf_counter()
        periodic.runs_of_texts([t.split()])
        assert time.perf_counter() - began < 30


def test_periodic_runs_empty(empty):
    assert periodic.periodic_runs(empty).collect() == []


def test_ranked(spark):
    rows = [(["a", None, "b"][rnd.randrange(3)], rnd.randrange(50), rnd.randrange(9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, o int, _part int").repartition(7)
    want, seen = [], Counter()
    for g, o, x in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        want.append((g, o, x, seen[g]))
        seen[g] += 1
    same([tuple(r) for r in ranked(df, ["g"], ["o", "_part"], "n").collect()], want)


def highest(sizes, seats):
    """Blocks by one highest quotient after the other; ties to the first."""
    won = [0] * len(sizes)
    for _ in range(seats):
        won[max(range(len(sizes)), key=lambda i: (round(sizes[i] / (2 * won[i] + 1), 6), -i))] += 1
    return won


def plain_targets(words, weights, share, most):
    target, full = [0.0] * len(words), set()
    while True:
        rest = [i for i in range(len(words)) if i not in full]
        if not rest:
            return target
        left = share * sum(words) - sum(most * words[i] for i in full)
        over = [i for i in rest if left * weights[i] / sum(weights[j] for j in rest) >= most * words[i]]
        for i in rest:
            target[i] = left * weights[i] / sum(weights[j] for j in rest)
        if not over:
            return target
        for i in over:
            full.add(i)
            target[i] = float(most * words[i])


def plain_mix(rows, block, seed):
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    docs = []
    for doc_id, text, source in rows:
        mark = md5(f"{seed}:{'-' if doc_id is None else doc_id}:{'-' if text is None else md5(text)}")
        docs.append((doc_id, source, len((text or "").encode().split()), mark))
    names = sorted({d[1] for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    words = [sum(d[2] for d in docs if d[1] == s) for s in names]
    targets = plain_targets(words, [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2)
    blocks = highest(targets, int(1.5 * sum(words) / block + 0.5)) if sum(words) else [0] * len(names)
    out = []
    for k, s in enumerate(names):
        own = sorted((d for d in docs if d[1] == s), key=lambda d: d[3])
        n = next(n for n in range(len(own) + 1) if n * n >= len(own))
        shards = {}
        for d in own:
            shards.setdefault(int(d[3][:8], 16) % n, []).append(d)
        order = sorted(shards)
        quotas = highest([sum(d[2] for d in shards[x]) for x in order], blocks[k]) if words[k] else [0] * len(order)
        for x, quota in zip(order, quotas, strict=True):
            line = [i for i, d in enumerate(shards[x]) for _ in range(d[2])]
            begin = block * (int(md5(f"{seed}:{k}:{x}")[:8], 16) % -(-max(len(line), 1) // block))
            taken = Counter(line[(begin + i) % len(line)] for i in range(min(quota * block, 2 * len(line))))
            out += [(d[0], d[2], words[k], targets[k], taken[i]) for i, d in enumerate(shards[x])]
    return out


@pytest.mark.parametrize("block", [16, 1, 300])
def test_mix(docs, block):
    got = mixing.mix(docs, block=block)
    rows = [tuple(r) for r in got.select("doc_id", "size", "source_size", F.round("target", 6), "taken").collect()]
    same(rows, [(*w[:3], round(w[3], 6), w[4]) for w in plain_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], block, mixing.SEED)])
    assert all(t <= 2 * n for _, n, _, _, t in rows)
    assert got.where("exists(pieces, p -> p.start < 0 or p.words < 1 or p.start + p.words > size)").count() == 0


def test_mix_comes_near_its_targets_and_reruns_agree(spark):
    base = "/root/testdata/sf0.01"
    one = queries.op12_source_mix(spark, base)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    two = mixing.mix(docs.repartition(11)).drop("rounds", "pieces")
    same([tuple(r) for r in one.collect()], [tuple(r) for r in two.collect()])
    sums = one.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 0.01 * r.target + mixing.BLOCK for r in sums)


def test_mix_without_words(spark, docs, empty):
    assert mixing.mix(empty).collect() == []
    none = docs.where("trim(coalesce(text, '')) = ''")
    assert {(r.size, r.target, r.taken) for r in mixing.mix(none.withColumn("text", F.lit(""))).collect()} == {(0, 0.0, 0)}
    assert {(r.size, r.target, r.taken) for r in mixing.mix(docs.where("doc_id = 900")).collect()} == {(1, 1.5, 0)}  # less than half a block


def tree(nodes):
    """Levels of a tree of digests, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 16
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 16])))
        i //= 16
    return out


def plain_manifest(rows):
    h = lambda vs: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vs))
    low = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r[0] is not None, r[0] or 0, h(r), h([*r[:4], low(r[4])])) for r in rows if r[1] == s) for s in names]
    trees = [tree([x[2] for x in g]) for g in groups]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, (g, t) in enumerate(zip(groups, trees, strict=True)):
        for i, (known, doc_id, leaf, tampered) in enumerate(g):
            path = path_of(t, i) + path_of(top, k)
            at = tampered if known and zlib.crc32(str(doc_id).encode()) % 5 == 0 else leaf
            for pre, post in path:
                at = sha(pre + at + post)
            out.append((doc_id if known else None, leaf, t[-1][0], top[-1][0], sha("".join(a + b for a, b in path)), at, at == top[-1][0]))
    return out


def test_op13(docs, spark, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op13_merkle_manifest(spark, str(tmp_path)).collect()]
    same(got, plain_manifest([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]))


@pytest.mark.parametrize(("n", "fan"), [(1, 16), (2, 16), (16, 16), (17, 16), (257, 16), (40, 2), (300, 3)])
def test_manifest_sizes(spark, n, fan):
    """Several tiers, and groups of exactly a run, a block and one more."""
    rows = spark.range(n).selectExpr("id as doc_id", "if(id % 7 = 0, 'a', 'b') as source", "'x' as text")
    got = manifest.verified(manifest.proofs(rows, ["doc_id", "text"], fan=fan)).collect()
    assert len(got) == n and all(r.verified for r in got) and len({r.root for r in got}) == 1
    size = Counter("a" if r.doc_id % 7 == 0 else "b" for r in got)
    levels = lambda k: next(i for i in range(20) if fan**i >= k)
    assert all(len(r.path) == levels(size["a" if r.doc_id % 7 == 0 else "b"]) + levels(len(size)) for r in got)


def test_manifest_empty(empty):
    assert manifest.proofs(empty).collect() == []
