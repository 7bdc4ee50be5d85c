"""Discovery as a stream: stop rules and seen sets as keyed state, instead of windows over a whole batch.

State lies in the state store of Spark (RocksDB) under each batch's key: the items seen, those that the round that is not complete yet adds to
them, and how far the batch is; max_items of either suffice.  State is read and written once for a batch and trigger, not once for an item.
A round is complete when a later one has begun, or when the watermark has passed `wait` after the last row: a timer
then ends the batch.  Rows of a batch that has stopped are passed over.  Whatever the triggers, the result equals
`dedupe.scroll_stop` over the whole table, if no row comes after a later round of its batch has begun.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_OUT = "batch string, stop_round int, stop_reason string, discovered long, duplicates long"


class _Scroll(StatefulProcessor):
    def __init__(self, max_items: int, unchanged_limit: int, wait_ms: int):
        self.max_items, self.unchanged_limit, self.wait_ms = max_items, unchanged_limit, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "item string")
        self.pending = handle.getListState("pending", "item string")
        self.progress = handle.getValueState("progress", "last int, streak int, found long, duplicates long, stopped boolean, pending int, again long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.progress.get() or (-1, 0, 0, 0, False, None, 0)
        if state[4]:
            return
        counts, latest = None, 0
        for part in rows:
            n = part.groupby(["round", "item"]).size()
            counts = n if counts is None else pd.concat([counts, n]).groupby(level=[0, 1]).sum()
            latest = max(latest, int(part["at"].max().timestamp() * 1000))
        if counts is None:
            return
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(latest + self.wait_ms)
        yield from self._advanced(key, state, {int(r): c.droplevel(0) for r, c in counts.groupby(level=0)}, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = self.progress.get()
        if state is not None and not state[4]:
            yield from self._advanced(key, state, {}, True)

    def _advanced(self, key, state, rounds: dict[int, pd.Series], ends: bool) -> Iterator[pd.DataFrame]:
        """The batch after its complete rounds, of which rounds tells how often each item came; its row if it stops at one of them, or ends."""
        last, streak, found, duplicates, _, pending, again = state
        seen = {i for (i,) in self.seen.get()}
        held = [i for (i,) in self.pending.get()]
        added: list[str] = []
        order = sorted({*rounds, *([] if pending is None else [pending])})
        for r in order:
            counts = rounds.get(r)
            known = None if counts is None else counts.index.isin(seen)
            more = 0 if counts is None else int(counts[known].sum())  # appearances of items of earlier rounds
            fresh = {} if counts is None else dict.fromkeys(map(str, counts.index[~known]))
            if r == pending:
                more, fresh = more + again, dict.fromkeys([i for i in held if i not in seen]) | fresh
            if r == order[-1] and not ends:
                # of so many new items the round stops the batch; those beyond them are neither seen nor counted
                state, held = (last, streak, found, duplicates, False, r, more), list(fresh)[: self.max_items - found]
                break
            duplicates += more
            last, streak, found = r, 0 if fresh else streak + 1, found + len(fresh)
            reason = "MAX_PRODUCTS_REACHED" if found >= self.max_items else "NO_NEW_PRODUCTS" if streak >= self.unchanged_limit else None
            if reason:
                yield self._ended(key, (last, streak, found, duplicates), reason)
                return
            seen.update(fresh)
            added += fresh
        if ends:
            yield self._ended(key, (last, streak, found, duplicates), "SCROLL_LIMIT_REACHED")
            return
        self.progress.update(state)
        if added:
            self.seen.appendList([(i,) for i in added])
        self.pending.clear()
        if held:
            self.pending.put([(i,) for i in held])

    def _ended(self, key, state, reason) -> pd.DataFrame:
        last, streak, found, duplicates = state
        self.progress.update((last, streak, found, duplicates, True, None, 0))
        self.seen.clear()
        self.pending.clear()
        return pd.DataFrame([{"batch": key[0], "stop_round": last, "stop_reason": reason, "discovered": min(found, self.max_items), "duplicates": duplicates}])

    def close(self) -> None:
        pass


def scroll_stream(rows: DataFrame, max_items: int, unchanged_limit: int, wait: str = "1 hour", late: str = "0 seconds") -> DataFrame:
    """One row for each batch, when it stops.  rows: a stream of batch, round, item and at (timestamp); see `dedupe.scroll_stop` for the columns.

    wait: how long after its last row a batch without a stop is ended.  late: how late rows of other batches may come.
    """
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)
    typed = rows.select(F.col("batch").cast("string").alias("batch"), F.col("round").cast("int").alias("round"),
        F.col("item").cast("string").alias("item"), "at").withWatermark("at", late)
    return typed.groupBy("batch").transformWithStateInPandas(_Scroll(max_items, unchanged_limit, wait_ms), outputStructType=_OUT, outputMode="Append",
        timeMode="EventTime")


#: Rows that are gathered before they are reduced to the first ones of their keys.
GATHERED = 100_000


def _firsts(keys: list[str], order: str):
    """The first row of each key in a partition by order; in memory are those and GATHERED rows, or as many as those."""

    def reduced(parts: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(parts).sort_by(order)
        at = t.append_column("", pa.array(range(t.num_rows), pa.int64())).group_by(keys, use_threads=False).aggregate([("", "min")])
        return t.take(at["_min"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        kept = new = 0
        for b in batches:
            held.append(pa.Table.from_batches([b]))
            new += b.num_rows
            if new > max(GATHERED, kept):
                held, new = [reduced(held)], 0
                kept = held[0].num_rows
        if held:
            yield from reduced(held).to_batches(10_000)

    return run


def seen_once(rows: DataFrame, *keys: str) -> DataFrame:
    """The first row of each key over all triggers, by `position` inside one; the key is all that is kept of it.

    A trigger's rows are reduced to the first one of each key, which Spark's own deduplication then lets pass if the key is not in its state.
    """
    first = rows.repartition(*keys).mapInArrow(_firsts(list(keys), "position"), rows.schema)
    return first.dropDuplicates(list(keys))
