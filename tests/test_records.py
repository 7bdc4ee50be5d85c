"""Operators of records, files and lineage on small inputs, against plain Python."""

from urllib.parse import urldefrag, urljoin

import numpy as np
import pytest
from pyspark.sql import functions as F

from provlake.functions import urls
from provlake.operators import bundles, images, lineage
from provlake.operators.contracts import Contract, Rule, issue_rows
from provlake.sources import readers


def plain_score(a):
    h, w = a.shape
    size = lambda r, c: np.hypot(a[r, c + 1] - a[r, c - 1] if 0 < c < w - 1 else 0.0, a[r + 1, c] - a[r - 1, c] if 0 < r < h - 1 else 0.0)
    m = [size(r, c) for r in range(h) for c in range(w)]
    limit = max(30.0, float(np.percentile(m, 75)))
    return min(1.0, sum(x > limit for x in m) / len(m) * 2.5 + a.std() / 255 * 0.3)


def test_text_score():
    r = np.random.default_rng(3)
    for shape in ((1, 1), (2, 5), (30, 40), (3, 3)):
        for top in (20, 60, 256):
            a = r.integers(0, top, shape).astype(np.float32)
            assert abs(images.text_score(a) - plain_score(a.astype(np.float64))) < 1e-6


def test_shrink():
    flat = np.full((1000, 1300), 77.0)
    assert images.shrink(flat).shape == (492, 640) and set(images.shrink(flat).ravel()) == {77.0}
    ramp = np.tile(np.arange(1280.0) / 8, (10, 1))
    got = images.shrink(ramp)
    assert got.shape == (5, 640) and np.abs(got[2, 1:-1] - (np.arange(640) * 2 + 0.5)[1:-1] / 8).max() <= 1
    assert images.shrink(flat[:100, :100]).shape == (100, 100)


def test_relative_addresses(spark):
    bases = ["https://a.example/x/y/page?q=1#f", "http://b.example", "https://c.example/only"]
    links = ["z.png", "/r.png", "//cdn.example/k.png", "../up.png", "./here.png", "a/./b/../c.png#t", "?v=2", "https://other.example/i.png", "../../../far.png"]
    rows = [(b, u) for b in bases for u in links]
    d = spark.createDataFrame(rows, "base string, url string")
    got = [r.x for r in d.select(urls.image_url("url", "base").alias("x")).collect()]
    assert got == [urldefrag(urljoin(b, u))[0] for b, u in rows]


def test_long_chains_diamonds_and_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}", "r") for i in range(24)]
    diamond = [("n0", "m", "r"), ("m", "n2", "r")]
    e = spark.createDataFrame(chain + diamond, "parent string, child string, relation string")
    got = lineage.ancestors(spark, e, spark.createDataFrame([("n24",)], "root string")).collect()
    assert {r.ancestor for r in got} == {f"n{i}" for i in range(24)} | {"m"} and max(r.depth for r in got) == 24
    assert len(got) == 26  # 24 of the chain, m, and n0 once more, as the child of m
    new = spark.createDataFrame([("n24", "n0"), ("n24", "x"), ("m", "m"), ("x", "n24")], "parent string, child string")
    assert {(r.parent, r.child): r.rejected for r in lineage.would_cycle(spark, e, new).collect()} == {("n24", "n0"): True, ("n24", "x"): False, ("m", "m"): True, ("x", "n24"): False}
    ring = spark.createDataFrame([("a", "b", "r"), ("b", "a", "r")], "parent string, child string, relation string")
    with pytest.raises(ValueError, match="cycle"):
        lineage.ancestors(spark, ring, spark.createDataFrame([("a",)], "root string"))


def test_nested_rules(spark):
    d = spark.sql("SELECT 1 AS id, 'x1' AS n, named_struct('v', -1) AS s, array(named_struct('w', 3), named_struct('w', 9)) AS xs UNION ALL SELECT 2, '7', NULL, array()")
    c = Contract("c", [Rule("id"), Rule("n", type="integer"), Rule("s", nullable=True, fields=(Rule("v", nullable=True, minimum=0),)), Rule("xs", items=Rule("", fields=(Rule("w", maximum=5),)))])
    assert {tuple(r) for r in issue_rows(d, c, ["id"]).collect()} == {(1, "$.n", "TYPE"), (1, "$.s.v", "MINIMUM"), (1, "$.xs[1].w", "MAXIMUM")}


def test_submit_is_whole_or_nothing(spark, tmp_path, monkeypatch):
    for n in ("a", "b"):
        (tmp_path / n).write_text(n * 9)
    files = readers.file_hashes(spark, f"{tmp_path}/*").select("path", F.concat("name", F.lit(".csv")).alias("name"))
    report = spark.createDataFrame([("k-1", "ACCEPTED")], "batch_id string, status string")
    root = str(tmp_path / "accepted")
    monkeypatch.setattr(bundles, "copy_mismatches", lambda *a: spark.createDataFrame([("a.csv",)], "name string"))
    with pytest.raises(ValueError, match="COPY_CHECKSUM_MISMATCH"):
        bundles.submit(spark, files, root, "k-1", report)
    assert not list((tmp_path / "accepted").iterdir())
    monkeypatch.undo()
    bundles.submit(spark, files, root, "k-1", report)
    assert {p.name for p in (tmp_path / "accepted/k-1").iterdir() if p.name[0] != "."} == {"a.csv", "b.csv", "manifest.json", "validation_report.json"}
    assert bundles.submit(spark, files, root, "k-1", report) == f"{root}/k-1"  # the same files again
    with pytest.raises(FileExistsError, match="DIFFERENT_CONTENT"):
        bundles.submit(spark, files.where("name = 'a.csv'"), root, "k-1", report)
    (tmp_path / "a").write_text("other")
    with pytest.raises(FileExistsError, match="DIFFERENT_CONTENT"):
        bundles.submit(spark, files, root, "k-1", report)
    (tmp_path / "a").write_text("a" * 9)
    (tmp_path / "accepted/k-1/.manifest.json.crc").unlink()
    (tmp_path / "accepted/k-1/manifest.json").write_text('{"status": "DRAFT"}')
    with pytest.raises(ValueError, match="ACCEPTED_MANIFEST_INVALID"):
        bundles.submit(spark, files, root, "k-1", report)


def test_copies_that_differ(spark):
    before = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "name string, sha256 string")
    after = spark.createDataFrame([("a", "1"), ("b", "9")], "name string, sha256 string")
    assert {r.name for r in bundles.copy_mismatches(before, after, ["name"]).collect()} == {"b", "c"}
