"""Structured Streaming forms: dedup, ticks, store book, escalation, capture on a schedule."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.ids import uuid7_time
from tidemark.operators.capture import diff_targeted
from tidemark.operators.stats import reply_type
from tidemark.scratch import cut, written_over
from tidemark.sources.snapshot_log import SnapshotLog


def with_event_time(df: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Events with ``event_time``, the instant inside their version 7 id."""
    return df.withColumn("event_time", uuid7_time(F.col(event_id)))


def dedup_stream(events: DataFrame, delay: str, event_id: str = "event_id", time: str = "event_time") -> DataFrame:
    """Each event once, if its repeats come within ``delay``; the state of older ids goes."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([event_id])


#: Groups whose state is one row each: keys share them, as a call of a pandas function costs far more than a key's few rows.
BUCKETS = 4096


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS))


def by_bucket(rows: DataFrame, key: str, order: Sequence[str], state: str, take: Callable, end: Callable, until: Callable, output: str, delay: str) -> DataFrame:
    """Keyed state over a stream (key, ts, ...), held by buckets of keys. ``take`` (key, state or None, row by name, out)
    gives the key's next state and adds to ``out``; rows of a micro-batch come by ``order``, their instant as ``us``. A key
    without rows whose ``until`` (state), in milliseconds, is behind the watermark goes through ``end`` (key, state, out).
    ``state`` and ``output`` are schemas; those of the output begin with the key as a string."""
    names = ["key", *[f.split()[0] for f in output.split(", ")[1:]]]
    fields = ", ".join(f"{name} array<{kind}>" for name, kind in (f.split() for f in f"key string, until bigint, {state}".split(", ")))

    def step(bucket, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        mark, out, fresh = held.getCurrentWatermarkMs(), [], set()
        keys = {k: (ends, tuple(own)) for k, ends, *own in zip(*held.get)} if held.exists else {}
        if not held.hasTimedOut:
            for row in pd.concat(list(frames)).sort_values(list(order), kind="stable").itertuples(index=False):
                keys[row.key] = None, take(row.key, keys[row.key][1] if row.key in keys else None, row, out)
                fresh.add(row.key)
        for k in fresh:
            keys[k] = max(until(keys[k][1]), mark + 1), keys[k][1]
        for k in [k for k, (ends, _) in keys.items() if k not in fresh and ends < mark]:
            end(k, keys.pop(k)[1], out)
        if keys:
            held.update(tuple(map(list, zip(*[(k, ends, *own) for k, (ends, own) in keys.items()]))))
            held.setTimeoutTimestamp(min(ends for ends, _ in keys.values()))
        elif held.exists:
            held.remove()
        if out:
            yield pd.DataFrame(out, columns=names)

    timed = rows.withWatermark("ts", delay).withColumn("key", F.col(key).cast("string"))
    timed = timed.select(bucket_of("key").alias("bucket"), "key", F.unix_micros("ts").alias("us"), *[c for c in rows.columns if c != key])
    found = timed.groupBy("bucket").applyInPandasWithState(step, output, fields, "append", GroupStateTimeout.EventTimeTimeout)
    return found.withColumn("key", F.col("key").cast(rows.schema[key].dataType))


def ticks(rows: DataFrame, delay: str = "1 minute", forget_after_s: int = 86_400) -> DataFrame:
    """(pk, tick, op) of a stream of population rows (pk, tick, row_hash, ts): CREATED for a key that the tick before
    didn't have, UPDATED for another hash. Of a tick's rows in a micro-batch the latest counts. Keys that leave send
    nothing; their state goes once event time is ``forget_after_s`` past their last row."""

    def take(key, state, row, out):
        tick, last, seen = state or (None, None, 0)
        seen = int(max(seen, row.us // 1000))
        if tick is not None and row.tick <= tick:
            return tick, last, seen
        if tick is None or row.tick != tick + 1:
            out.append((key, row.tick, "CREATED"))
        elif row.row_hash != last:
            out.append((key, row.tick, "UPDATED"))
        return int(row.tick), int(row.row_hash), seen

    end = lambda key, state, out: None
    latest = rows.select("pk", "tick", "row_hash", "ts", (-F.unix_micros("ts")).alias("latest"))
    found = by_bucket(latest, "pk", ["tick", "latest"], "tick bigint, row_hash bigint, seen bigint", take, end, lambda state: state[2] + forget_after_s * 1000, "key string, tick bigint, op string", delay)
    return found.select(F.col("key").cast("bigint").alias("pk"), "tick", "op")


def store_changes(events: DataFrame, silence_s: int = 1500, delay: str = "1 minute") -> DataFrame:
    """(char_id, ts, change) of a stream (char_id, ts, open): OPENED, CLOSED on a null state, EXPIRED when a trader has
    been silent for ``silence_s`` of event time."""

    silence = silence_s * 1_000_000

    def take(key, state, row, out):
        seen, is_open = state or (None, False)
        now, is_now = row.us, row.open
        if seen is not None and now < seen:
            return state
        if is_open and now - seen >= silence:
            out.append((key, seen + silence, "EXPIRED"))
            is_open = False
        if is_now != is_open:
            out.append((key, now, "OPENED" if is_now else "CLOSED"))
        return now, bool(is_now)

    def end(key, state, out):
        seen, is_open = state
        if is_open:
            out.append((key, seen + silence, "EXPIRED"))

    found = by_bucket(events.select("char_id", "ts", "open"), "char_id", ["us"], "seen bigint, open boolean", take, end, lambda state: state[0] // 1000 + silence_s * 1000, "key string, us bigint, change string", delay)
    return found.select(F.col("key").alias("char_id"), F.timestamp_micros("us").alias("ts"), "change")


def escalations(observations: DataFrame, grace_s: int = 900, delay: str = "1 minute", forget_after_s: int = 604_800) -> DataFrame:
    """The streaming form of ``operators.stats.escalate`` for (key, ts, ok, seq): observations of a key are taken in the
    order of (ts, seq), those of a micro-batch together. One that is older than the last of its key, or than the
    watermark, comes too late and is dropped. The state of a key that has been silent for ``forget_after_s`` of event
    time goes, so its next failure is a FIRST."""

    def take(key, state, row, out):
        first, told, seen = state or (None, False, None)
        now = row.us
        if seen is not None and now < seen:
            return state
        if row.ok or (seen is not None and now - seen >= forget_after_s * 1_000_000):
            first, told = None, False
        if row.ok:
            return first, told, now
        if first is None:
            first, level = now, "FIRST"
        elif told:
            level = "SILENT"
        elif now - first >= grace_s * 1_000_000:
            told, level = True, "ESCALATED"
        else:
            level = "REPEAT"
        out.append((key, now, level))
        return first, told, now

    end = lambda key, state, out: None
    found = by_bucket(observations.select("key", "ts", "ok", "seq"), "key", ["us", "seq"], "first bigint, told boolean, seen bigint", take, end, lambda state: state[2] // 1000 + forget_after_s * 1000, "key string, us bigint, level string", delay)
    return found.select("key", F.timestamp_micros("us").alias("ts"), "level")


def command_timeouts(commands: DataFrame, replies: DataFrame, wait: str = "5 minutes", delay: str = "1 minute") -> DataFrame:
    """Commands of a stream with their reply, null if none came within ``wait``. A reply has the command's correlation id
    and the type that answers the command's ``msg_type``."""
    left = commands.withWatermark("ts", delay).alias("c")
    right = replies.withWatermark("reply_ts", delay).alias("r")
    on = (F.col("c.correlation_id") == F.col("r.correlation_id")) & (reply_type(F.col("c.msg_type")) == F.col("r.msg_type")) & (F.col("r.reply_ts") >= F.col("c.ts")) & (F.col("r.reply_ts") <= F.col("c.ts") + F.expr(f"INTERVAL {wait}"))
    return left.join(right, on, "left_outer").select("c.*", "r.reply_ts", "r.status")


def stream_capture(source: DataFrame, cycle: Callable[[DataFrame, int], None], checkpoint: str, seconds: int | None = 60):
    """Run a capture cycle on every micro-batch; without ``seconds`` once over what there is. Batches that wait
    meanwhile coalesce into the next."""
    writer = source.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def capture_into(source: DataFrame, hashes: Callable[[DataFrame], DataFrame], entity: str, log: SnapshotLog, events: str, checkpoint: str, seconds: int | None = 60, compact_every: int = 20):
    """Run capture cycles that survive a restart. The snapshot is in ``log``: batch n reads version n and writes version
    n + 1; its changes (pk, op, row_hash) go below ``events`` first, in a folder of the batch. A batch that runs again reads
    the same version and replaces what it wrote, so after any failure a new query on the same checkpoint goes on.

    ``hashes`` gives (pk, row_hash) of the keys of a batch; keys that a batch doesn't have are left alone.
    """

    def cycle(batch: DataFrame, number: int) -> None:
        current = cut(hashes(batch), "current")
        before = log.load(number).where(F.col("entity") == entity).select("pk", "row_hash")
        changes = written_over(diff_targeted(current, before, current), f"{events}/batch={number}")
        log.write_delta(changes.withColumn("entity", F.lit(entity)), number + 1)
        if (number + 1) % compact_every == 0:
            log.compact(number + 1)

    return stream_capture(source, cycle, checkpoint, seconds)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, **settings: str) -> DataFrame:
    """Run a stream over what there is into Parquet and read it back; ``settings`` hold for this query only."""
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)

