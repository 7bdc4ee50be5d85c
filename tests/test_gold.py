"""Gold bundles: crashes at every step, repeats, conflicts, writers at once, damaged files."""

import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from provlake.operators import gold
from provlake.sources.commit import create_file, read_file

COLUMNS = ("id", "name", "review_status")


@pytest.fixture(scope="module")
def rows(spark):
    data = [(f"p{i}", f"name, \"{i}\"\nline", "APPROVED" if i % 3 else "REVIEW_REQUIRED", i) for i in range(60)]
    data += [("p1", "again", "APPROVED", 1), (None, "no key", "APPROVED", 2), ("bad", "x", "APPROVED", None), ("null status", "x", None, 3)]
    return spark.createDataFrame(data, "id string, name string, review_status string, size int").repartition(3)


@pytest.fixture(scope="module")
def inputs(spark):
    return spark.createDataFrame([("a1", "00"), ("a1", "00"), ("a2", "11")], "artifact_id string, checksum string")


def publish(rows, inputs, root, version="v1", **more):
    return gold.publish_bundle(rows, str(root), version, "id", COLUMNS, {"SIZE": F.col("size") >= 0}, inputs, "2026-01-01", **more)


def stop(at):
    def step(name):
        if name == at:
            raise RuntimeError(at)

    return step


def test_bundle_and_its_manifest(spark, rows, inputs, tmp_path):
    b = publish(rows, inputs, tmp_path, files_of=7)
    assert b.status == "PUBLISHED"
    m = json.loads((Path(b.path) / "manifest.json").read_text())
    assert m["row_count"] == 39 and m["inputs"] == [{"artifact_id": "a1", "checksum": "00"}, {"artifact_id": "a2", "checksum": "11"}]
    assert m["quality"]["outcomes"] == {"DUPLICATE_KEY": 3, "NOT_APPROVED": 21, "PUBLISHED": 39, "SIZE": 1}
    assert [o["files"] >= 6 for o in m["outputs"]] == [True, True]
    got = gold.read_bundle(spark, str(tmp_path), "v1")
    assert got.columns == ["dataset_version", *COLUMNS] and got.count() == 39
    csv = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{b.path}/{m['outputs'][1]['path']}")
    assert sorted(map(tuple, csv.collect())) == sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("at", ["check", "data", "csv", "quality", "manifest"])
def test_a_crash_leaves_no_bundle(spark, rows, inputs, tmp_path, at):
    with pytest.raises(RuntimeError, match=at):
        publish(rows, inputs, tmp_path, step=stop(at))
    assert gold.versions(spark, str(tmp_path)) == []
    with pytest.raises(gold.BundleError, match="MANIFEST_MISSING"):
        gold.read_bundle(spark, str(tmp_path), "v1")
    assert publish(rows, inputs, tmp_path).status == "PUBLISHED"
    assert gold.sweep(spark, str(tmp_path), "v1") == (0 if at in ("check", "data") else 1)
    assert gold.read_bundle(spark, str(tmp_path), "v1").count() == 39


def test_repeats_and_conflicts(spark, rows, inputs, tmp_path):
    first = publish(rows, inputs, tmp_path)
    again = publish(rows.repartition(7), inputs, tmp_path)
    assert again.status == "DUPLICATE" and again.manifest == first.manifest
    with pytest.raises(gold.VersionConflict):
        publish(rows.where("id <> 'p4'"), inputs, tmp_path)
    assert publish(rows.where("id <> 'p4'"), inputs, tmp_path, version="v2").status == "PUBLISHED"
    assert gold.versions(spark, str(tmp_path)) == ["v1", "v2"]


def test_writers_at_once_publish_one_bundle(spark, rows, inputs, tmp_path):
    with ThreadPoolExecutor(4) as pool:
        got = sorted(b.status for b in pool.map(lambda _: publish(rows, inputs, tmp_path), range(4)))
    assert got == ["DUPLICATE"] * 3 + ["PUBLISHED"]
    assert gold.sweep(spark, str(tmp_path), "v1") == 0 and gold.read_bundle(spark, str(tmp_path), "v1").count() == 39


def test_damage_is_found(spark, rows, inputs, tmp_path):
    b = publish(rows, inputs, tmp_path)
    part = next((Path(b.path) / b.manifest["outputs"][1]["path"]).glob("part-*.csv"))
    part.write_text(part.read_text().replace("name", "mane"))
    (part.parent / f".{part.name}.crc").unlink()
    with pytest.raises(gold.BundleError, match="CHECKSUM_MISMATCH"):
        gold.read_bundle(spark, str(tmp_path), "v1")
    (Path(b.path) / "manifest.json").write_text("{")
    with pytest.raises(gold.BundleError, match="MANIFEST_INVALID"):
        gold.read_bundle(spark, str(tmp_path), "v1")


def test_no_rows(spark, rows, inputs, tmp_path):
    assert publish(rows.where("false"), inputs, tmp_path).manifest["row_count"] == 0
    assert publish(rows.where("false"), inputs, tmp_path).status == "DUPLICATE"
    assert gold.read_bundle(spark, str(tmp_path), "v1").count() == 0


def test_create_file_never_replaces(spark, tmp_path):
    path = str(tmp_path / "a" / "f.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_file(spark, path, str(i).encode()), range(16)))
    assert won.count(True) == 1 and read_file(spark, path) == str(won.index(True)).encode()
    assert [p.name for p in (tmp_path / "a").iterdir() if p.suffix != ".crc"] == ["f.json"]
    assert read_file(spark, str(tmp_path / "none")) is None
