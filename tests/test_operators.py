import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from provlake.operators import bundles, contracts, dedupe, emission, images, intake, lineage, metadata, publish, summaries
from provlake.sources import html, readers
from provlake.streaming.sensor import register_accepted


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_wins_keeps_unkeyed(spark):
    d = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "p int, k string")
    assert rows(dedupe.first_wins(d, "k", "p", keep_null_keys=True).select("p")) == [(1,), (3,), (4,)]


@pytest.mark.parametrize(
    ("rounds", "cap", "limit", "want"),
    [
        ([["a", "b", "c"]], 2, 3, (1, "MAX_PRODUCTS_REACHED", 2, 0)),
        ([["a"], ["a"], ["a"], ["a"], ["b"]], 9, 3, (4, "NO_NEW_PRODUCTS", 1, 3)),
        ([["a", "a"], ["b"]], 9, 3, (2, "SCROLL_LIMIT_REACHED", 2, 0)),
    ],
)
def test_scroll_stop(spark, rounds, cap, limit, want):
    data = [("x", i + 1, v) for i, r in enumerate(rounds) for v in r]
    got = dedupe.scroll_stop(spark.createDataFrame(data, "b string, r int, i string"), "b", "r", "i", cap, limit).first()
    assert tuple(got)[1:] == want


def test_upsert_keeps_first_position(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], "k string, o int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("c", 2, "z")], "k string, o int, v string")
    assert rows(dedupe.upsert(old, new, "k", "o").select("k", "v", "position")) == [("a", "y", 1), ("b", "x", 2), ("c", "z", 2)]


def test_contract_issues_and_split(spark):
    c = contracts.Contract("t", [contracts.Rule("a", minimum=1), contracts.Rule("b", nullable=True, enum=("x",))])
    d = spark.createDataFrame([(1, "x", None), (0, "y", None), (None, None, 1)], "a int, b string, z int")
    got = {tuple(r) for r in contracts.issue_rows(d, c, ["a"]).collect()}
    assert {(0, "$.a", "MINIMUM"), (0, "$.b", "ENUM"), (None, "$.a", "REQUIRED"), (1, "$.z", "ADDITIONAL")} <= got
    good, bad = contracts.split(d.drop("z"), c)
    assert good.count() + bad.count() == 3 and good.count() == 1
    with pytest.raises(KeyError):
        contracts.contract("nothing")


def test_adapt_products_is_stable(spark):
    d = spark.createDataFrame([("7", " tofu ", "u", "x", "0.5", "q"), ("8", "", "u", "", "bad", "")], "original_product_id string, product_name_raw string, product_url string, weight_raw string, ocr_confidence string, odd string")
    a = intake.adapt_products(d, "r", "t", "20260801-ann-1")
    got = {r.original_product_id: r for r in a.collect()}
    assert got["7"].record_id == "20260801-ann-1:SHOP:7" and got["7"].extra == {"odd": "q"} and got["7"].ocr_confidence == 0.5
    assert got["8"].bad_confidence and got["8"].weight_raw is None and len(got["8"].content_hash) == 64
    again = {r.content_hash for r in intake.adapt_products(d.orderBy(F.desc("original_product_id")), "r", "t", "20260801-ann-1").collect()}
    assert again == {r.content_hash for r in got.values()}


def test_state_machine(spark):
    d = spark.createDataFrame([("a", 1, "PENDING"), ("a", 2, "RUNNING"), ("a", 3, "SUCCEEDED"), ("a", 4, "RUNNING")], "r string, o int, s string")
    assert [r.valid for r in metadata.checked_transitions(d, "r", "o", "s").orderBy("o").collect()] == [True, True, True, False]
    with pytest.raises(ValueError, match="1 to 1000"):
        metadata.recent(d, "o", "r", 0)


def test_lineage_diamond_and_cycle(spark):
    e = spark.createDataFrame([("a", "b", "x"), ("a", "c", "x"), ("b", "d", "x"), ("c", "d", "x"), ("a", "d", "x")], "parent string, child string, relation string")
    up = lineage.ancestors(spark, e, spark.createDataFrame([("d",)], "root string"))
    assert {(r.ancestor, r.depth) for r in up.collect()} == {("b", 1), ("c", 1), ("a", 1), ("a", 2)}
    p = spark.createDataFrame([("d", "a"), ("d", "d"), ("d", "e")], "parent string, child string")
    assert rows(lineage.would_cycle(spark, e, p)) == [("d", "a", True), ("d", "d", True), ("d", "e", False)]


def test_percent_is_half_even(spark):
    d = spark.createDataFrame([(1, 200), (3, 200), (5, 4), (1, 0)], "d int, t int")
    assert [r[0] for r in d.select(summaries.progress_percent("d", "t")).collect()] == [0, 2, 100, None]


def test_publish_only_approved(spark):
    d = spark.createDataFrame([(1, "AUTO_APPROVED"), (2, "REVIEW_REQUIRED")], "id int, review_status string")
    p = publish.publish(d, ["id"], "v1")
    assert rows(p) == [("v1", 1)] and publish.publish_manifest(p).first().row_count == 1


def test_image_candidates(spark):
    schema = "page_id int, position int, src string, alt string, class_name string, dom_path string, width int, height int"
    data = [(1, 0, "https://i.example/logo.png", None, None, None, 500, 500), (1, 1, "https://i.example/a.jpg", None, "goods_intro", None, None, None), (1, 2, "https://i.example/b.jpg", None, None, None, 300, 300), (1, 3, "https://i.example/a.jpg#2", None, "goods_intro", None, None, None)]
    data += [(2, i, f"https://i.example/{i}.jpg", None, None, None, 300, 300) for i in range(7)] + [(3, 0, "/relative.jpg", None, None, None, 1, 1)]
    got = rows(images.candidates(spark.createDataFrame(data, schema)).select("page_id", "position", "sequence"))
    assert got == [(1, 1, 1), *[(2, i, i + 1) for i in range(5)]]


def test_text_score():
    assert images.text_score(np.full((64, 64), 90)) == 0.0
    stripes = np.tile(np.repeat([0, 255], 2), 16)[None, :].repeat(64, 0)
    assert images.text_score(stripes) > images.HAS_TEXT_ABOVE


def test_image_source_scores(spark, tmp_path):
    def bmp(path, px):
        h, w = px.shape
        body = b"".join(bytes(v for p in row for v in (p, p, p)) + b"\0" * (-3 * w % 4) for row in px[::-1].tolist())
        path.write_bytes(b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body)

    bmp(tmp_path / "flat.bmp", np.full((40, 40), 120, np.uint8))
    bmp(tmp_path / "grid.bmp", (np.indices((40, 40)).sum(0) // 2 % 2 * 255).astype(np.uint8))
    df = spark.read.format("image").load(str(tmp_path)).select(F.element_at(F.split("image.origin", "/"), -1).alias("n"), images.decoded_score().alias("s"))
    got = {r.n: r.s for r in df.collect()}
    assert got["flat.bmp"] < images.NO_TEXT_BELOW < images.HAS_TEXT_ABOVE < got["grid.bmp"]
    labels = {r[0]: r[1].presence for r in df.select("n", images.by_score("s")).collect()}
    assert labels == {"flat.bmp": "NO_TEXT", "grid.bmp": "HAS_TEXT"}


def test_html(spark):
    page = "<h1>Tofu</h1><ul><li><a href='/goods/1'><img alt=' soft '></a><a href='/x'>no</a><a href='/goods/2?q'>two <b>words</b></a></ul><dl><dt>Storage</dt><dd>cold</dd></dl><script>var a='<a href=/goods/9>'</script>"
    d = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    got = rows(d.lateralJoin(html.Links(F.col("html").outer(), F.lit("/goods/"))))
    assert [(g[0], *g[2:]) for g in got] == [(1, 0, "/goods/1", "soft"), (1, 1, "/goods/2?q", "two words")]
    r = d.select(html.page_udf(["Nothing", "Storage"])("html").alias("p")).first().p
    assert (r.title, r.value) == ("Tofu", "cold") and "cold" in r.text


def test_readers_and_commit(spark, tmp_path):
    f = tmp_path / "20260801-ann-1" / "products.csv"
    f.parent.mkdir()
    f.write_text('﻿original_product_id,name\n1,"a, ""b""\nc"\n2,\n', encoding="utf-8")
    got = rows(readers.read_flat(spark, str(f)).na.fill("-"))
    assert got == [("1", 'a, "b"\nc'), ("2", "-")]
    assert [r.batch_id for r in readers.list_batches(spark, f"file:{tmp_path}").collect()] == ["20260801-ann-1"]
    (tmp_path / "x.json").write_text("[1]")
    assert readers.read_json_strict(spark, str(tmp_path / "x.json")).first().error == "INVALID_JSON"
    out = f"{tmp_path}/gold/v1"
    readers.create_layout(spark, str(tmp_path))
    readers.commit_folder(spark.range(3), out)
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(FileExistsError):
        readers.commit_folder(spark.range(3), out)
    (tmp_path / "urls.txt").write_text("# c\n/goods/1\n/goods/1?x\n\nbad\nbad\n")
    assert readers.read_urls(spark, str(tmp_path / "urls.txt")).count() == 3


def test_stream_registers_once(spark, tmp_path):
    seen = []
    root, ck = tmp_path / "accepted", str(tmp_path / "ck")
    (root / "b1").mkdir(parents=True)
    (root / "b1" / "manifest.json").write_text(json.dumps({"a": 1}))
    register = lambda df, i: seen.extend(r.run_key for r in df.collect())
    register_accepted(spark, str(root), ck, register)
    (root / "b2").mkdir()
    (root / "b2" / "manifest.json").write_text("{}")
    register_accepted(spark, str(root), ck, register)
    register_accepted(spark, str(root), ck, register)
    assert seen == ["accepted:b1", "accepted:b2"]


def test_blocks_and_confidence(spark):
    d = spark.createDataFrame([(["a", " ", "b"], [0.5, None], [[[0.0, 1.0]]]), ([], [], [])], "t array<string>, s array<double>, p array<array<array<double>>>")
    got = d.select(emission.blocks("t", "s", "p").alias("b")).select("b", emission.joined_text("b"), emission.mean_confidence("b")).collect()
    assert [tuple(b) for b in got[0].b] == [("a", 0.5, [[0.0, 1.0]]), (" ", None, None), ("b", None, None)]
    assert tuple(got[0])[1:] == ("a\nb", 0.5) and tuple(got[1])[1:] == (None, None)


def test_manifest_rows(spark):
    schema = "pid string, name string, downloaded_images array<struct<local_path:string,source_url:string>>"
    d = spark.createDataFrame([("1", None, [("p1", "u1"), ("p2", None)]), ("2", "x", [])], schema)
    assert rows(emission.manifest_rows(d)) == [("1", "", "p1", "u1"), ("1", "", "p2", ""), ("2", "x", "", "")]


def test_emission_and_merge(spark):
    text = "유통기한 3일\n보관방법 냉장"
    data = [
        ("b", 0, "S", "1", "a.jpg", "h1", text, None, None, None),
        ("b", 1, "S", "1", "a.jpg", "h1", text, text, None, None),
        ("b", 2, "S", "1", "b.jpg", "h1", text, text, None, None),
        ("b", 3, "S", "1", "c.jpg", "h2", "none", None, "5일", None),
        ("b", 4, "S", "1", None, None, None, None, "5일", None),
        ("b", 5, "S", "2", "d.jpg", "h3", "none", None, None, None),
        ("b", 6, "S", "3", "e.jpg", "h4", text, text, None, None),
    ]
    schema = "batch_id string, position int, site string, pid string, image_path string, digest string, gate_text string, ocr_text string, expiration_dom string, storage_dom string"
    out = emission.emit(spark.createDataFrame(data, schema), spark.createDataFrame([("S:3:h4",)], "key string"))
    assert [r.outcome for r in out.orderBy("position").collect()] == ["FAILED", "IMAGE", "SKIPPED", "DOM_ONLY", "SKIPPED", "RAW_ONLY", "SKIPPED"]
    got = {r.position: r for r in emission.merged_products(out).collect()}
    assert set(got) == {1, 3} and (got[1].expiration_raw, got[1].expiration_source, got[1].storage_type) == ("3일", "OCR", "REFRIGERATED")
    assert (got[3].expiration_raw, got[3].expiration_source, got[3].validation_status) == ("5일", "DOM", "MATCHED")


def test_bundles(spark, tmp_path):
    f = tmp_path / "accepted" / "20260801-ann-001"
    f.mkdir(parents=True)
    (f / "manifest.json").write_text("{}")
    (f / "products.csv").write_text("a\n1\n")
    (f / "other.txt").write_text("x")
    files = bundles.bundle_files(spark, f"{tmp_path}/accepted/*/*")
    a = bundles.artifact_records(files).cache()
    assert {(r.logical_name, r.format) for r in a.collect()} == {("manifest", "JSON"), ("products", "CSV")}
    assert a.select("run_id").distinct().count() == 1 and bundles.bundled_in(a).count() == 1
    assert rows(bundles.artifact_records(files)) == rows(a)


def test_fuzzy_names_are_those_of_all_pairs(spark):
    r = random.Random(9)
    names = ["".join(r.choice("abc") for _ in range(r.choice((0, 1, 2, 3, 4, 5, 8, 12)))) for _ in range(60)]

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x):
            last, row[0] = row[:], i + 1
            for j, e in enumerate(y):
                row[j + 1] = min(last[j] + (c != e), last[j + 1] + 1, row[j] + 1)
        return row[-1]

    ref = [(f"c{i}", n if i % 20 else None, f"g{i % 2}", i) for i, n in enumerate(names)]
    own = [(i, f"x{i}", r.choice(names)[1:] + r.choice("abc") if i % 25 else None, f"g{i % 2}") for i in range(120)]
    out = publish.reconcile(
        spark.createDataFrame(own, "product_id long, code string, name string, grp string"),
        spark.createDataFrame(ref, "code string, name string, grp string, reference_id long"), "code", "name", "grp")
    want = {}
    for p, _, n, g in own:
        near = [(distance(n, m), i) for _, m, h, i in ref if n is not None and m is not None and g == h]
        want[p] = min([x for x in near if x[0] <= 3], default=(None, None))
    assert {x.product_id: (x.distance, x.reference_id) for x in out.collect()} == want
