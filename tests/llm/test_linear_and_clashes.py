"""Long texts in linear time, clashing names, and identifiers that only other identifiers' contexts show."""

import json
import random
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from provlake.llm import boilerplate, bpe, chains, personal, secrets

rnd = random.Random(4)


def test_secret_scan_of_a_megabyte_is_linear():
    path = secrets.vocabulary_path("byte_bpe_50k.tiktoken")
    unit = "deadbeefdeadbeefdeadbeef00 {} plain words here "
    took = []
    for n in (4_000, 16_000):
        text = "".join(unit.format("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24))) for _ in range(n))
        began = time.perf_counter()
        out = secrets.scan(text, path)
        took.append(time.perf_counter() - began)
        assert out[2] == n
    assert took[1] < 10 * took[0] and took[1] < 60


def test_overlaps_are_those_of_all_pairs():
    for _ in range(300):
        spans = [(a, 0, a + rnd.randrange(1, 9)) for a in (rnd.randrange(60) for _ in range(rnd.randrange(8)))]
        starts, ends = secrets.ends_before(spans)
        from bisect import bisect_left

        for a in range(60):
            b = a + rnd.randrange(1, 6)
            i = bisect_left(starts, b)
            assert (not i or ends[i - 1] <= a) == (not any(x < b and a < y for x, _, y in spans))


def test_personal_data_of_long_texts(spark):
    """Places are right beyond a block of matches, and a megabyte with tens of thousands of them is done in seconds."""
    for n in (64, 200):
        text = "".join(f"é{i} a{i}@b.cd, " for i in range(n))
        got = personal.personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
        want, at = [], 0
        for i in range(n):
            at = text.index(f"a{i}@", at)
            want.append(f"email:{at}:{at + len(f'a{i}@b.cd')}")
        assert got.spans == ",".join(want)
    text = "".join(f"mail bob{i}@example.com or 10.0.{i % 256}.7 now " for i in range(25_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.perf_counter()
    assert personal._spans(df, "text").select(F.size("_base")).first()[0] == 50_000 and personal.instances(df).count() == 50_000
    assert time.perf_counter() - began < 60


def test_unseen_identifiers_by_context(spark):
    """Codes that no base pattern knows are found where addresses stand elsewhere; codes of a second context, which only such codes share, follow."""
    mails = [f"please write to <u{i}q@mail{i}.org> today" for i in range(90)]
    codes = [f"m{i:04d}77" for i in range(33)]
    first = [f"please write to {c} today" for c in codes[:30]]
    second = [f"badge of {c} was seen" for c in codes[:30]] + [f"badge of {c} was seen" for c in codes[30:]]
    clean = [f"it took about {i + 1000} steps and chapter {i} of 2024" for i in range(30)]
    rows = [(i, t) for i, t in enumerate(mails * 3 + first + second + clean)]
    got = {r.doc_id: r.spans for r in personal.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {t for i, t in rows if "found" in got[i]}
    hidden = {t for t in first + second}
    assert len(found & hidden) >= 0.9 * len(hidden) and not found & set(clean)
    assert len(found & set(second[30:])) == 3


def test_boilerplate_counts_do_not_replace_columns(spark):
    rows = [(i, f"same line\nown line {i}", "s", -7, "keep") for i in range(20)]
    pages = spark.createDataFrame(rows, "doc_id long, text string, source string, _n_lines int, __N_dropped string")
    out = boilerplate.drop_boilerplate(pages)
    assert boilerplate.count_names(pages) == ("__n_lines", "_n_dropped")
    assert {(r["_n_lines"], r["__N_dropped"], r["__n_lines"], r["_n_dropped"]) for r in out.collect()} == {(-7, "keep", 2, 1)}
    assert out.select(F.sum("__n_lines")).first()[0] == 40


def test_words_met_lately_stay_known(monkeypatch):
    """A word that comes up again is not worked out again, however many others came before it; a long one takes time in proportion."""
    monkeypatch.setattr(bpe, "CACHED_WORDS", 20)
    with open(secrets.vocabulary_path("word_bpe_49k.json"), encoding="utf-8") as f:
        a = bpe.MergeAutomaton(json.load(f))
    before = [a.encode("".join(rnd.choice("etaoinshrdlu") for _ in range(9))) for _ in range(60)]
    assert len(before) == 60
    walked, walk = [], a.walk
    monkeypatch.setattr(a, "walk", lambda s: walked.append(s) or walk(s))
    got = {a.encode("onheretionshon theandsh") for _ in range(5)}
    assert len(got) == 1 and sorted(walked) == ["onheretionshon", "theandsh"]
    began = time.perf_counter()
    word = "".join(rnd.choice("etaoinshrdlu") for _ in range(300_000))
    assert "".join(a.encode(word)[1].split(" ")) == f"{word}</w>"
    assert time.perf_counter() - began < 30


def test_pairs_of_one_chain_are_not_chained(monkeypatch):
    """Matches that rise close together are one chain without a search; distances and sums tell whether it is exact.  Others are searched."""
    words = "".join(f"w{i} " for i in range(90)).split()
    edited = [*words[:40], "x", *words[41:]]
    seeds = {n: chains.seeds(chains.word_hashes(" ".join(t)), np.array([90])) for n, t in (("a", words), ("b", words), ("c", edited))}
    rows = []
    for doc, n in ((2, "b"), (3, "c")):
        here = {s: (p, h) for p, s, h in zip(*(seeds["a"][i].tolist() for i in (1, 2, 3)), strict=True)}
        there = {s: (p, h) for p, s, h in zip(*(seeds[n][i].tolist() for i in (1, 2, 3)), strict=True)}
        rows += [(1, *here[s], doc, *there[s], False) for s in here if s in there]
    d = pd.DataFrame(rows, columns=["doc_a", "pos_a", "before_a", "doc_b", "pos_b", "before_b", "of_run"])
    for c in ("before_a", "before_b"):
        d[c] = d[c].astype(np.int32)
    searched, chain = [], chains.chain
    monkeypatch.setattr(chains, "chain", lambda *x: searched.append(1) or chain(*x))
    got = pd.concat(chains._candidates(chains.K, chains.WINDOW, 50)(iter([d.iloc[:5], d.iloc[5:]]))).set_index("doc_b")
    assert not searched and got.exact.to_dict() == {2: True, 3: False}
    assert got["tail"][2] == chains.K + chains.WINDOW and got["tail"][3] == 0 and list(got["at"][2]) == [] and list(got["at"][3]) == list(got["bt"][3])
    crossed = d.assign(pos_b=d.pos_b.to_numpy()[::-1])
    list(chains._candidates(chains.K, chains.WINDOW, 50)(iter([crossed])))
    assert searched


def test_alignments_side_by_side_are_those_one_by_one():
    r = random.Random(12)
    some = []
    for _ in range(200):
        x = np.array([r.randrange(6) for _ in range(r.randrange(0, 30))], np.int64)
        y = np.array([r.randrange(6) if r.random() < 0.2 else w for w in x.tolist() if r.random() < 0.9], np.int64)
        some.append((x, y, []))
    for got, one in zip(chains.align(some), (chains.align([c])[0] for c in some), strict=True):
        assert got.tolist() == one.tolist()
    for (x, y, _), got in zip(some, chains.align(some), strict=True):
        assert (x[got[:, 0]] == y[got[:, 1]]).all() and (np.diff(got, axis=0) > 0).all()
