"""The metadata store for several writers: runs, steps, artifacts, lineage and quality results in one table log.

Every call takes a table of requests and returns it with an `outcome`.  It is checked against the version that it becomes part of, so
two writers never both insert a key, and a state machine never takes two ways.  Requests of one call that contradict each other:
of rows with the same key the least is inserted, the others conflict with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.operators import lineage, metadata
from provlake.sources.shared import written
from provlake.sources.table_log import Change, Snapshot, TableLog

RUN = ("pipeline", "batch_id", "trigger", "code_version", "member")
STEP = ("run_id", "name", "attempt")
ARTIFACT = ("run_id", "step", "attempt", "logical_name", "checksum")
SCHEMAS = {
    "runs": "run_id string, " + ", ".join(f"{c} string" for c in RUN),
    "run_events": "run_id string, status string, at string, version long",
    "steps": "run_id string, name string, attempt int, step_id string",
    "step_events": "run_id string, name string, attempt int, status string, at string, version long, input_count long, output_count long",
    "artifacts": "artifact_id string, run_id string, step string, attempt int, logical_name string, checksum string, uri string, size long",
    "edges": "parent string, child string, relation string",
    "quality": "run_id string, artifact_id string, rule string, result_id string, passed boolean, value double, version long",
}


def _inserts(existing: DataFrame, new: DataFrame, keys: Sequence[str], compared: Sequence[str]) -> DataFrame:
    """new, each row once, with outcome INSERTED, RETURNED or CONFLICT."""
    rows = new.distinct()
    first = rows.groupBy(*keys).agg(F.min(F.struct(*compared)).alias("_first")) if compared else rows.select(*keys).distinct()
    tagged = metadata.insert_or_return(existing, rows, keys, compared)
    if not compared:
        return tagged
    tagged = tagged.join(first, list(keys))
    mine = F.col("_first").eqNullSafe(F.struct(*[F.col(c) for c in compared]))
    return tagged.withColumn("outcome", F.when((F.col("outcome") == "INSERTED") & ~mine, "CONFLICT").otherwise(F.col("outcome"))).drop("_first")


def _folded(current: DataFrame, events: DataFrame, keys: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """events, in order of `at`, with outcome APPLIED, INVALID (the state machine forbids it from the state then reached) or NOT_FOUND.

    current: keys and status of what exists.  The events of one entity in one call are folded as one array.
    """
    one = F.struct("at", "status", *extra)
    per = events.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_events"))
    per = per.join(current.withColumn("_there", F.lit(True)), list(keys), "left")
    entry = lambda e, o: F.struct(e["at"].alias("at"), e["status"].alias("status"), *[e[c].alias(c) for c in extra], o.alias("outcome"))
    kind = ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in events.select("at", "status", *extra).schema)
    start = F.struct(F.col("status").alias("state"), F.array().cast(f"array<struct<{kind},outcome:string>>").alias("out"))

    def step(acc: Column, e: Column) -> Column:
        ok = F.coalesce(metadata.allowed(acc["state"], e["status"]), F.lit(False))
        outcome = F.when(F.col("_there").isNull(), "NOT_FOUND").when(ok, "APPLIED").otherwise("INVALID")
        return F.struct(F.when(ok, e["status"]).otherwise(acc["state"]).alias("state"), F.concat(acc["out"], F.array(entry(e, outcome))).alias("out"))

    out = per.select(*keys, F.explode(F.aggregate("_events", start, step)["out"]).alias("_e"))
    return out.select(*keys, "_e.*")


class MetadataStore:
    def __init__(self, spark: SparkSession, path: str):
        self.log = TableLog(spark, path, SCHEMAS)

    def _call(self, change) -> DataFrame:
        return self.log.commit(change)[1]

    def _insert(self, name: str, new: DataFrame, keys: Sequence[str], compared: Sequence[str], more=lambda rows: {}) -> DataFrame:
        def change(now: Snapshot) -> Change:
            tagged = written(_inserts(now.table(name), new, keys, compared), "outcome")
            fresh = tagged.where("outcome = 'INSERTED'").drop("outcome")
            return Change(add={name: fresh, **more(now, fresh)}, outcome=tagged)

        return self._call(change)

    def create_runs(self, new: DataFrame) -> DataFrame:
        """new: run_id and the five fields of RUN.  A run begins PENDING."""
        pending = lambda now, fresh: {"run_events": fresh.select("run_id", F.lit("PENDING").alias("status"), F.lit(None).cast("string").alias("at"),
            F.lit(now.version + 1).cast("long").alias("version"))}
        return self._insert("runs", new.select("run_id", *RUN), ["run_id"], RUN, pending)

    def create_steps(self, new: DataFrame) -> DataFrame:
        """new: run_id, name, attempt, step_id.  A step that is there stays as it is: RETURNED, whatever its id."""
        def change(now: Snapshot) -> Change:
            rows = new.groupBy(*STEP).agg(F.min("step_id").alias("step_id"))
            there = now.table("steps").select(*STEP, F.col("step_id").alias("_id"))
            tagged = rows.join(there, list(STEP), "left").withColumn("outcome", F.when(F.col("_id").isNull(), "INSERTED").otherwise("RETURNED"))
            tagged = written(tagged.withColumn("step_id", F.coalesce("_id", "step_id")).drop("_id"), "outcome")
            fresh = tagged.where("outcome = 'INSERTED'")
            nothing = [F.lit(None).cast("long").alias(c) for c in ("input_count", "output_count")]
            pending = fresh.select(*STEP, F.lit("PENDING").alias("status"), F.lit(None).cast("string").alias("at"),
                F.lit(now.version + 1).cast("long").alias("version"), *nothing)
            return Change(add={"steps": fresh.drop("outcome"), "step_events": pending}, outcome=tagged)

        return self._call(change)

    def _states(self, now: Snapshot, name: str, keys: Sequence[str]) -> DataFrame:
        """The last state of each entity: events are ordered by version and, inside a call, by time."""
        return now.table(name).groupBy(*keys).agg(F.max_by("status", F.struct("version", "at")).alias("status"))

    def _transition(self, name: str, events: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
        def change(now: Snapshot) -> Change:
            tagged = written(_folded(self._states(now, name, keys), events.select(*keys, "at", "status", *extra), keys, extra), "outcome")
            applied = tagged.where("outcome = 'APPLIED'").withColumn("version", F.lit(now.version + 1).cast("long"))
            return Change(add={name: applied.drop("outcome")}, outcome=tagged)

        return self._call(change)

    def transition_runs(self, events: DataFrame) -> DataFrame:
        """events: run_id, status, at (ISO text)."""
        return self._transition("run_events", events, ["run_id"])

    def transition_steps(self, events: DataFrame) -> DataFrame:
        """events: run_id, name, attempt, status, at, input_count, output_count (null: as before).  Negative counts raise."""
        if not events.where("input_count < 0 or output_count < 0").isEmpty():
            raise ValueError("counts must not be negative")
        return self._transition("step_events", events, STEP, ("input_count", "output_count"))

    def register_artifacts(self, new: DataFrame) -> DataFrame:
        """new: artifact_id, the five of ARTIFACT, uri, size.  CONFLICT: the id under another key, or the key under another id."""
        def change(now: Snapshot) -> Change:
            there = now.table("artifacts")
            tagged = _inserts(there, new.select(*there.columns), ["artifact_id"], ARTIFACT)
            same_key = there.select(*ARTIFACT, F.col("artifact_id").alias("_other"))
            taken = [tagged[c].eqNullSafe(same_key[c]) for c in ARTIFACT]
            other = tagged.join(same_key, taken, "left").select(tagged["*"], "_other")
            least = other.groupBy(*ARTIFACT).agg(F.min(F.when(F.col("outcome") == "INSERTED", F.col("artifact_id"))).alias("_least"))
            other = other.join(least.withColumnsRenamed({c: f"_k_{c}" for c in ARTIFACT}), [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in ARTIFACT], "left")
            beaten = (F.col("outcome") == "INSERTED") & (F.col("_other").isNotNull() | (F.col("_least") != F.col("artifact_id")))
            tagged = written(other.withColumn("outcome", F.when(beaten, "CONFLICT").otherwise(F.col("outcome"))).select(*there.columns, "outcome"), "outcome")
            fresh = tagged.where("outcome = 'INSERTED'").drop("outcome").dropDuplicates(["artifact_id"])
            return Change(add={"artifacts": fresh}, outcome=tagged)

        return self._call(change)

    def add_lineage(self, new: DataFrame) -> DataFrame:
        """new: parent, child, relation.  REJECTED: the edge lies on a cycle of what is there and what is asked for; an edge that is there is RETURNED."""
        def change(now: Snapshot) -> Change:
            there = now.table("edges")
            rows = written(new.select(*there.columns).distinct(), "edges")
            marked = lineage.on_cycles(there.unionByName(rows), rows.select("parent", "child").distinct())
            tagged = metadata.insert_or_return(there, rows, there.columns, []).join(marked, ["parent", "child"])
            tagged = written(tagged.withColumn("outcome", F.when(F.col("rejected"), "REJECTED").otherwise(F.col("outcome"))).drop("rejected"), "outcome")
            return Change(add={"edges": tagged.where("outcome = 'INSERTED'").drop("outcome")}, outcome=tagged)

        return self._call(change)

    def record_quality(self, new: DataFrame) -> DataFrame:
        """new: run_id, artifact_id, rule, result_id, passed, value.  The last call wins, under the first one's id; of one call the least row."""
        keys = ["run_id", "artifact_id", "rule"]

        def change(now: Snapshot) -> Change:
            rows = new.groupBy(*keys).agg(F.min(F.struct("result_id", "passed", "value")).alias("r")).select(*keys, "r.*",
                F.lit(now.version + 1).cast("long").alias("version"))
            rows = written(rows, "quality")
            return Change(add={"quality": rows}, outcome=rows.drop("version").withColumn("outcome", F.lit("RECORDED")))

        return self._call(change)

    def runs(self, now: Snapshot | None = None) -> DataFrame:
        """Every run with its status, started_at (first RUNNING) and finished_at (first terminal state)."""
        now = now or self.log.snapshot()
        events = now.table("run_events").withColumn("_order", F.struct("version", "at"))
        return now.table("runs").join(metadata.current_state(events, "run_id", "_order", "status", "at"), "run_id")

    def steps(self, now: Snapshot | None = None) -> DataFrame:
        """Every step with its status and the last counts that were given."""
        now = now or self.log.snapshot()
        order = F.struct("version", "at")
        last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
        state = now.table("step_events").groupBy(*STEP).agg(F.max_by("status", order).alias("status"), last("input_count"), last("output_count"))
        return now.table("steps").join(state, list(STEP))

    def quality(self, now: Snapshot | None = None) -> DataFrame:
        now = now or self.log.snapshot()
        last = F.max_by(F.struct("passed", "value"), "version").alias("r")
        return now.table("quality").groupBy("run_id", "artifact_id", "rule").agg(F.min_by("result_id", "version").alias("result_id"),
            last).select("run_id", "artifact_id", "rule", "result_id", "r.*")

    def get_runs(self, now: Snapshot | None = None) -> DataFrame:
        """Runs with their steps, artifacts and quality results as sorted arrays."""
        now = now or self.log.snapshot()
        return metadata.snapshot(
            self.runs(now), "run_id", steps=(self.steps(now), ["name", "attempt", "status", "input_count", "output_count"]),
            artifacts=(now.table("artifacts"), ["logical_name", "checksum", "artifact_id"]),
                results=(self.quality(now), ["artifact_id", "rule", "passed", "value"]),
        )
