"""Keyed state over several triggers against the same rules over whole tables."""

import random

import pandas as pd
import pyarrow as pa
import pytest

from provlake.operators import dedupe
from provlake.streaming import discovery

rnd = random.Random(8)


@pytest.fixture(scope="module")
def state_store(spark):
    was = {k: spark.conf.get(k, None) for k in discovery.STATE_STORE}
    for k, v in discovery.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def replay(spark, folder, chunks, schema, transform):
    """Each chunk is a file and a trigger of its own."""
    for i, rows in enumerate(chunks):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/{i:03d}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in/*")
    q = transform(stream).writeStream.trigger(availableNow=True).option("checkpointLocation", f"{folder}/ck").outputMode("append").format("parquet").start(f"{folder}/out")
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/out"), len(chunks)


def test_scroll_equals_the_batch_rule(spark, state_store, tmp_path):
    rows = []
    for b in range(12):
        for r in range(10):
            rows += [(f"b{b}", r, f"i{rnd.randrange(4 + 6 * (b % 4))}", f"2026-01-01 {r:02d}:{b:02d}:00") for _ in range(rnd.randrange(1, 4))]
    schema = "batch string, round int, item string, at string"
    table = spark.createDataFrame(rows, schema)
    rows.sort(key=lambda r: r[3])
    chunks = [rows[i : i + 45] for i in range(0, len(rows), 45)] + [[("end", 0, "x", "2030-01-01 00:00:00")], [("end", 1, "x", "2031-01-01 00:00:00")]]
    got, _ = replay(spark, str(tmp_path), chunks, schema, lambda s: discovery.scroll_stream(s.withColumn("at", s["at"].cast("timestamp")), 9, 3))
    want = dedupe.scroll_stop(table, "batch", "round", "item", 9, 3)
    found = sorted(tuple(r) for r in got.where("batch <> 'end'").select(want.columns).collect())
    assert found == sorted(tuple(r) for r in want.collect())
    assert {r[2] for r in found} == {"MAX_PRODUCTS_REACHED", "NO_NEW_PRODUCTS", "SCROLL_LIMIT_REACHED"}


def test_seen_once_equals_first_wins(spark, state_store, tmp_path):
    rows = [(f"b{rnd.randrange(3)}", f"p{rnd.randrange(12)}", i) for i in range(200)]
    schema = "batch string, pid string, position long"
    got, _ = replay(spark, str(tmp_path), [rows[i : i + 60] for i in range(0, 200, 60)], schema, lambda s: discovery.seen_once(s, "batch", "pid"))
    want = dedupe.first_wins(spark.createDataFrame(rows, schema), ["batch", "pid"], "position")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_state_is_not_asked_for_each_item():
    """Each round and item of a trigger was looked up and written by a call of its own."""

    class Counted:
        calls = 0

        def __init__(self):
            self.rows, self.value = [], None

        def __getattr__(self, name):
            def call(*args):
                Counted.calls += 1
                if name == "get":
                    return self.value if self.value is not None else iter(list(self.rows)) if self.listed else None
                if name in ("put", "appendList"):
                    self.rows = [*(self.rows if name == "appendList" else []), *args[0]]
                elif name == "update":
                    self.value = args[0]
                elif name == "clear":
                    self.rows, self.value = [], None
                return ()

            return call

    class Handle(Counted):
        def _state(self, listed):
            s = Counted()
            s.listed = listed
            return s

        def getListState(self, *_):
            return self._state(True)

        def getMapState(self, *_):
            return self._state(True)

        def getValueState(self, *_):
            return self._state(False)

    p = discovery._Scroll(60, 3, 1000)
    p.init(Handle())
    rows = pd.DataFrame({"round": [0] * 5000, "item": [f"i{i}" for i in range(5000)], "at": pd.Timestamp("2026-01-01")})
    assert list(p.handleInputRows(("b",), iter([rows, rows]), None)) == [] and Counted.calls < 20
    assert len(p.pending.rows) == 60  # as many new items as stop the batch
    out = list(p.handleInputRows(("b",), iter([rows.assign(round=1)]), None))
    assert [tuple(x.iloc[0]) for x in out] == [("b", 0, "MAX_PRODUCTS_REACHED", 60, 0)] and Counted.calls < 40


def test_seen_once_keeps_state_in_spark(spark):
    """A worker was asked for each key: its state is Spark's own deduplication now, on rows reduced to the first of each key."""
    stream = spark.readStream.format("rate").load().selectExpr("value % 7 AS k", "value AS position")
    plan = discovery.seen_once(stream, "k")._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "TransformWithState" not in plan


def test_firsts_of_a_partition(monkeypatch):
    monkeypatch.setattr(discovery, "GATHERED", 10)
    rows = [{"a": rnd.randrange(3), "b": rnd.choice(["x", None]), "position": i} for i in rnd.sample(range(500), 500)]
    parts = [pa.RecordBatch.from_pylist(rows[i : i + 7]) for i in range(0, 500, 7)]
    got = [tuple(r.values()) for b in discovery._firsts(["a", "b"], "position")(iter(parts)) for r in b.to_pylist()]
    least = {}
    for r in rows:
        least[r["a"], r["b"]] = min(r["position"], least.get((r["a"], r["b"]), 999))
    assert sorted(got, key=str) == sorted(((*k, v) for k, v in least.items()), key=str)
    assert list(discovery._firsts(["a"], "position")(iter([]))) == []
