"""The table log and the metadata store with writers at once; lineage by path doubling."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from provlake.operators import lineage
from provlake.operators.store import MetadataStore
from provlake.sources import table_log
from provlake.sources.table_log import Change, TableLog

RUN = "run_id string, pipeline string, batch_id string, trigger string, code_version string, member string"


def outcomes(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols, "outcome").collect())


def test_log_versions_and_vacuum(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TableLog, "FOLDERS", 2)
    log = TableLog(spark, str(tmp_path), {"t": "a long", "u": "b string"})
    assert log.snapshot().version == 0 and log.snapshot().table("t").count() == 0
    for i in range(5):
        now, seen = log.commit(lambda s, i=i: Change(add={"t": spark.range(i, i + 2).withColumnRenamed("id", "a")}, outcome=s.version))
        assert seen == i and now.version == i + 1
    assert [len(log.snapshot(v).folders["t"]) for v in range(1, 6)] == [1, 2, 3, 1, 2]
    assert sorted(r.a for r in log.snapshot().table("t").collect()) == [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert log.snapshot(2).table("t").count() == 4
    same, _ = log.commit(lambda s: Change(add={"t": spark.range(0).withColumnRenamed("id", "a")}))
    assert same.version == 5
    log.commit(lambda s: Change(replace={"t": s.table("t").where("a > 3")}, add={"u": spark.createDataFrame([("x",)], "b string")}))
    assert log.vacuum(keep=1) > 0 and log.snapshot().table("t").count() == 3 and log.snapshot().table("u").count() == 1
    with pytest.raises(KeyError):
        log.snapshot(2)


def test_a_crash_before_the_log_file_leaves_the_version(spark, tmp_path, monkeypatch):
    log = TableLog(spark, str(tmp_path), {"t": "a long"})
    add = lambda s: Change(add={"t": spark.range(3).withColumnRenamed("id", "a")})
    log.commit(add)
    with monkeypatch.context() as m:
        m.setattr(table_log, "create_file", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.commit(add)
    assert log.snapshot().version == 1 and log.snapshot().table("t").count() == 3
    assert log.commit(add)[0].version == 2 and log.vacuum() == 1 and log.snapshot().table("t").count() == 6


def test_writers_at_once_lose_and_double_nothing(spark, tmp_path):
    """Four writers create overlapping runs and each moves all of them to RUNNING and on to its own last state."""
    ids = [f"r{i}" for i in range(24)]

    def work(w):
        store = MetadataStore(spark, str(tmp_path))
        mine = [x for i, x in enumerate(ids) if i % 4 == w or i % 3 == 0]
        made = store.create_runs(spark.createDataFrame([(x, "p", "b", f"writer {w if i % 2 else 0}", "v", "ann") for i, x in enumerate(mine)], RUN))
        last = ["SUCCEEDED", "FAILED", "PARTIAL", "CANCELLED"][w]
        moved = store.transition_runs(spark.createDataFrame([(x, s, f"{at}{w}") for x in mine for at, s in (("1", "RUNNING"), ("2", last))], "run_id string, status string, at string"))
        return outcomes(made, "run_id"), outcomes(moved, "run_id", "status")

    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(work, range(4)))
    store = MetadataStore(spark, str(tmp_path))
    runs = {r.run_id: r for r in store.runs().collect()}
    assert sorted(runs) == sorted(ids) and store.log.snapshot().table("runs").count() == len(ids)
    inserted = [r for made, _ in got for r, o in made if o == "INSERTED"]
    assert sorted(inserted) == sorted(ids)
    ended = [(r, s) for _, moved in got for r, s, o in moved if o == "APPLIED" and s != "RUNNING"]
    assert sorted(ended) == sorted((r, x.status) for r, x in runs.items())  # one way through the state machine each


def test_requests_of_one_call(spark, tmp_path):
    store = MetadataStore(spark, str(tmp_path))
    rows = [("a", "p", None, "t", "v", "m"), ("a", "p", None, "t", "v", "m"), ("a", "q", None, "t", "v", "m"), ("b", "p", "1", "t", "v", "m")]
    assert outcomes(store.create_runs(spark.createDataFrame(rows, RUN)), "run_id", "pipeline") == [("a", "p", "INSERTED"), ("a", "q", "CONFLICT"), ("b", "p", "INSERTED")]
    assert outcomes(store.create_runs(spark.createDataFrame(rows, RUN)), "run_id", "pipeline") == [("a", "p", "RETURNED"), ("a", "q", "CONFLICT"), ("b", "p", "RETURNED")]
    events = [("a", "RUNNING", "1"), ("a", "SUCCEEDED", "2"), ("a", "RUNNING", "3"), ("a", "SUCCEEDED", "4"), ("none", "RUNNING", "1"), ("b", "FAILED", "1")]
    moved = store.transition_runs(spark.createDataFrame(events, "run_id string, status string, at string"))
    assert outcomes(moved, "run_id", "at") == [("a", "1", "APPLIED"), ("a", "2", "APPLIED"), ("a", "3", "INVALID"), ("a", "4", "APPLIED"), ("b", "1", "INVALID"), ("none", "1", "NOT_FOUND")]
    assert {r.run_id: (r.status, r.started_at, r.finished_at) for r in store.runs().collect()} == {"a": ("SUCCEEDED", "1", "2"), "b": ("PENDING", None, None)}


def test_steps_artifacts_lineage_and_quality(spark, tmp_path):
    store = MetadataStore(spark, str(tmp_path))
    store.create_runs(spark.createDataFrame([("a", "p", "b", "t", "v", "m")], RUN))
    step = "run_id string, name string, attempt int, step_id string"
    assert outcomes(store.create_steps(spark.createDataFrame([("a", "s", 1, "id1"), ("a", "s", 1, "id2"), ("a", "s", 2, "id3")], step)), "step_id") == [("id1", "INSERTED"), ("id3", "INSERTED")]
    assert outcomes(store.create_steps(spark.createDataFrame([("a", "s", 1, "new")], step)), "step_id") == [("id1", "RETURNED")]
    events = [("a", "s", 1, "RUNNING", "1", 10, None), ("a", "s", 1, "SUCCEEDED", "2", None, 7), ("a", "s", 2, "SUCCEEDED", "2", 1, 1)]
    kind = "run_id string, name string, attempt int, status string, at string, input_count long, output_count long"
    moved = store.transition_steps(spark.createDataFrame(events, kind))
    assert outcomes(moved, "attempt", "at") == [(1, "1", "APPLIED"), (1, "2", "APPLIED"), (2, "2", "INVALID")]
    with pytest.raises(ValueError, match="negative"):
        store.transition_steps(spark.createDataFrame([("a", "s", 1, "FAILED", "3", -1, 0)], kind))
    art = "artifact_id string, run_id string, step string, attempt int, logical_name string, checksum string, uri string, size long"
    new = [("x1", "a", "s", 1, "n", "c1", "u", 1), ("x2", "a", "s", 1, "n", "c1", "u", 1), ("x3", "a", None, 1, "n", "c3", "u", 1)]
    assert outcomes(store.register_artifacts(spark.createDataFrame(new, art)), "artifact_id") == [("x1", "INSERTED"), ("x2", "CONFLICT"), ("x3", "INSERTED")]
    again = [("x1", "a", "s", 1, "n", "c1", "u", 1), ("x1", "a", "s", 1, "n", "other", "u", 1), ("x4", "a", None, 1, "n", "c3", "u", 1)]
    assert outcomes(store.register_artifacts(spark.createDataFrame(again, art)), "artifact_id", "checksum") == [("x1", "c1", "RETURNED"), ("x1", "other", "CONFLICT"), ("x4", "c3", "CONFLICT")]
    edge = "parent string, child string, relation string"
    first = store.add_lineage(spark.createDataFrame([("x1", "x3", "R"), ("x3", "x9", "R"), ("x5", "x5", "R")], edge))
    assert outcomes(first, "parent") == [("x1", "INSERTED"), ("x3", "INSERTED"), ("x5", "REJECTED")]
    assert outcomes(store.add_lineage(spark.createDataFrame([("x9", "x1", "R"), ("x1", "x3", "R"), ("x1", "y", "R")], edge)), "parent", "child") == [("x1", "x3", "REJECTED"), ("x1", "y", "INSERTED"), ("x9", "x1", "REJECTED")]
    q = "run_id string, artifact_id string, rule string, result_id string, passed boolean, value double"
    store.record_quality(spark.createDataFrame([("a", "x1", "r", "q1", True, 1.0)], q))
    store.record_quality(spark.createDataFrame([("a", "x1", "r", "q2", False, 2.0)], q))
    run = store.get_runs().first()
    assert [(s.name, s.attempt, s.status, s.input_count, s.output_count) for s in run.steps] == [("s", 1, "SUCCEEDED", 10, 7), ("s", 2, "PENDING", None, None)]
    assert [r.artifact_id for r in run.artifacts] == ["x1", "x3"] and [(r.passed, r.value) for r in run.results] == [(False, 2.0)]
    assert store.quality().first().result_id == "q1"


def edges_of(spark, pairs):
    return spark.createDataFrame([(str(p), str(c), "R") for p, c in pairs], "parent string, child string, relation string")


def test_a_chain_of_thousands_takes_a_dozen_rounds(spark, monkeypatch):
    n, rounds = 5000, []
    monkeypatch.setattr(lineage, "_doubled", lambda j, f=lineage._doubled: rounds.append(1) or f(j))
    got = lineage.ancestors(spark, edges_of(spark, ((i, i + 1) for i in range(n))), spark.createDataFrame([(str(n),)], "root string"))
    assert got.count() == n and got.agg(F.max("depth"), F.sum("depth")).first()[:] == (n, n * (n + 1) // 2)
    assert len(rounds) <= 15


def test_lineage_equals_walks(spark):
    rnd = random.Random(2)
    for cyclic in (False, True):
        pairs = {(a, b) if a < b or cyclic else (b, a) for a, b in ((rnd.randrange(18), rnd.randrange(18)) for _ in range(32)) if a != b}
        up = {c: sorted(p for p, d in pairs if d == c) for c in range(18)}
        roots = spark.createDataFrame([(str(i),) for i in range(18)], "root string")
        e = edges_of(spark, pairs)
        want, level = set(), {(r, r) for r in range(18)}
        for depth in range(1, 19):
            level = {(r, p, c) for r, c in level for p in up[c]}
            want |= {(str(r), str(p), str(c), "R", depth) for r, p, c in level}
            level = {(r, p) for r, p, _ in level}
        if cyclic:
            with pytest.raises(ValueError, match="cycle"):
                lineage.ancestors(spark, e, roots)
        else:
            assert {tuple(r) for r in lineage.ancestors(spark, e, roots).collect()} == want
        sets = {(str(r), str(r)) for r in range(18)} | {w[:2] for w in want}
        assert {tuple(r) for r in lineage.reached(spark, e, roots).collect()} == sets
