"""Streams of changes whose state moves on acknowledgements only.

Rows and acknowledgements are two kinds of rows of one stream: (key, kind, seq, row_hash, status, ts), kind ``row`` or
``ack``. A key's state is the hash that was acknowledged last and the change that waits for its acknowledgement. A row that
differs from the acknowledged hash is published and waits; ``ok`` makes its hash the acknowledged one; a failed one, or one
that comes after the key's next row, changes nothing, so the next row is published again. Rows of a key are taken in the
order of (ts, kind), acknowledgements after rows. State may start from a snapshot, and ends by a timer.

The state lives in the RocksDB state store, which ``transformWithState`` needs. Keys share groups of state, one value each,
as a call of the processor and its messages to the store cost far more than a key's few rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.streams import bucket_of

STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A bucket's keys, when each ends (in milliseconds, null: never), and its own state.
STATE = "key array<string>, until array<bigint>, acked array<bigint>, last_seq array<bigint>, pending array<bigint>, pending_seq array<bigint>"


class Acknowledged(StatefulProcessor):
    """``gaps``: a key whose ``seq`` skips a number was away and is forgotten, as in a population's ticks."""

    def __init__(self, gaps: bool, forget_after_s: int):
        self.gaps, self.forget_ms = gaps, forget_after_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", STATE)

    def held(self) -> dict:
        """{key: (until, acked, last, pending, waits)} of the bucket."""
        return {k: tuple(own) for k, *own in zip(*self.state.get())} if self.state.exists() else {}

    def hold(self, keys: dict) -> None:
        if keys:
            self.state.update(tuple(map(list, zip(*[(k, *own) for k, own in keys.items()]))))
        else:
            self.state.clear()

    def first_end(self, keys: dict) -> int | None:
        """When the bucket's timer goes off."""
        return min((until for until, *_ in keys.values() if until is not None), default=None)

    def living(self, keys: dict, mark: int) -> dict:
        return {k: own for k, own in keys.items() if own[0] is None or own[0] >= mark}

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        keys = self.held()
        for row in initialState.itertuples(index=False):
            keys.setdefault(row.key, (None, int(row.row_hash), int(row.seq), None, None))
        self.hold(keys)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        keys, mark, out, seen = self.held(), timerValues.getCurrentWatermarkInMs(), [], {}
        before = self.first_end(keys)
        frame = pd.concat(list(rows)).sort_values(["ts", "ack", "seq"], kind="stable")
        for k, ack, seq, found, ok, ms in zip(*(frame[c].tolist() for c in ("key", "ack", "seq", "row_hash", "ok", "ms"))):
            seen[k] = max(seen.get(k, 0), ms)
            until, *own = keys.get(k, (None, None, None, None, None))
            keys[k] = until, *self.take(k, *own, ack, int(seq), int(found), ok, out)
        for k, ms in seen.items():
            keys[k] = max(ms + self.forget_ms, mark + 1), *keys[k][1:]
        keys = self.living(keys, mark)
        self.hold(keys)
        after = self.first_end(keys)
        if after != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        if out:
            yield pd.DataFrame(out, columns=["key", "seq", "op"])

    def take(self, key, acked, last, pending, waits, ack, seq, found, ok, out) -> tuple:
        """A key's state after a row or an acknowledgement; a change goes to ``out``."""
        if ack:
            return (pending if ok else acked, last, None, None) if pending is not None and seq == waits else (acked, last, pending, waits)
        if last is not None and seq <= last:
            return acked, last, pending, waits
        if self.gaps and last is not None and seq != last + 1:
            acked = None
        if found == acked:
            return acked, seq, None, None
        out.append((key, seq, "CREATED" if acked is None else "UPDATED"))
        return acked, seq, found, seq

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        keys = self.living(self.held(), timerValues.getCurrentWatermarkInMs())
        self.hold(keys)
        if self.first_end(keys) is not None:
            self.handle.registerTimer(self.first_end(keys))
        return iter(())

    def close(self) -> None:
        pass


def acknowledged_changes(rows: DataFrame, snapshot: DataFrame | None = None, gaps: bool = True, forget_after_s: int = 86_400, delay: str = "1 minute") -> DataFrame:
    """(key, seq, op) of a stream as above: CREATED for a key without an acknowledged hash, else UPDATED. ``snapshot``
    (key, seq, row_hash) is what was acknowledged before the stream began.

    ``gaps=True`` are ticks of a population, ``gaps=False`` settings, which stay as they were last sent.
    """
    # Without nulls a batch's hashes stay whole numbers in pandas; keys go as strings, so one that is null doesn't change others.
    said = lambda name, word: F.coalesce(F.col(name) == word, F.lit(False))
    key, seq = F.col("key").cast("string").alias("key"), F.col("seq").cast("bigint").alias("seq")
    timed = rows.withWatermark("ts", delay).select(key, said("kind", "ack").alias("ack"), seq, F.coalesce("row_hash", F.lit(0)).alias("row_hash"), said("status", "ok").alias("ok"), F.coalesce(F.unix_millis("ts"), F.lit(0)).alias("ms"), "ts")
    by_bucket = lambda df: df.select(bucket_of("key").alias("bucket"), "*").groupBy("bucket")
    first = None if snapshot is None else by_bucket(snapshot.select(key, seq, "row_hash"))
    found = by_bucket(timed).transformWithStateInPandas(Acknowledged(gaps, forget_after_s), "key string, seq bigint, op string", "Append", "EventTime", first)
    return found.withColumn("key", F.col("key").cast("bigint"))
