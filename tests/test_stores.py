"""The snapshot log, cycles that are killed and go on, acknowledged streams, look-ups and ranks at the edges."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import capture, events, lookups
from tidemark.scratch import shared_path
from tidemark.sources import windows
from tidemark.sources.snapshot_log import SnapshotDrift, SnapshotLog
from tidemark.streaming import acknowledged, streams


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def named(spark, rows, schema="entity string, pk bigint, row_hash bigint"):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted(map(tuple, df.select("entity", "pk", "row_hash").collect()))


CHANGES = "entity string, pk bigint, op string, row_hash bigint"


def test_log_versions_against_a_dictionary(spark):
    rs, log, held, versions = random.Random(1), SnapshotLog(spark, shared_path(spark, "log"), buckets=4), {}, {}
    assert log.load().count() == 0 and log.newest() == 0 and log.manifests() == []
    held = {(e, k): k for e in "ab" for k in range(40)}
    log.write_base(named(spark, [(e, k, h) for (e, k), h in held.items()]), 1)
    versions[1] = dict(held)
    for v in range(2, 7):
        changes = []
        for e, k in rs.sample([(e, k) for e in "ab" for k in range(60)], 25):
            if (e, k) in held and rs.random() < 0.4:
                del held[e, k]
                changes.append((e, k, "DELETED", None))
            else:
                held[e, k] = rs.randrange(10**6)
                changes.append((e, k, "UPDATED", held[e, k]))
        log.write_delta(named(spark, changes, CHANGES), v)
        versions[v] = dict(held)
        if v == 4:
            log.compact()
    for v, want in versions.items():
        assert rows_of(log.load(v, check=True)) == sorted((e, k, h) for (e, k), h in want.items())
    # A version written again replaces itself; old versions go with what only they need.
    log.write_delta(named(spark, [("a", 1, "UPDATED", 7)], CHANGES), 6)
    assert ("a", 1, 7) in rows_of(log.load()) and log.newest() == 6
    log.retain(2)
    assert {(m["kind"], m["version"]) for m in log.manifests()} == {("base", 4), ("delta", 5), ("delta", 6)}
    assert rows_of(log.load(5)) == sorted((e, k, h) for (e, k), h in versions[5].items())
    # Another session's object reads the same files, and deltas may come before any base.
    assert rows_of(SnapshotLog(spark, log.path).load()) == rows_of(log.load())
    early = SnapshotLog(spark, shared_path(spark, "log"), buckets=2)
    early.write_delta(named(spark, [("a", 1, "CREATED", 7), ("a", 2, "DELETED", None)], CHANGES), 1)
    early.write_delta(named(spark, [("a", 1, "DELETED", None), ("a", 3, "CREATED", 1)], CHANGES), 2)
    assert rows_of(early.load()) == [("a", 3, 1)]


def test_a_base_is_read_without_an_exchange(spark):
    log = SnapshotLog(spark, shared_path(spark, "log"), buckets=4)
    log.write_base(spark.range(2000).select(F.lit("e").alias("entity"), F.col("id").alias("pk"), F.col("id").alias("row_hash")), 1)
    log.write_delta(spark.range(100).select(F.lit("e").alias("entity"), F.col("id").alias("pk"), F.lit("UPDATED").alias("op"), F.lit(0).cast("bigint").alias("row_hash")), 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = plan_of(log.load())
        log.write_delta(spark.range(50).select(F.lit("e").alias("entity"), F.col("id").alias("pk"), F.lit("UPDATED").alias("op"), F.lit(0).cast("bigint").alias("row_hash")), 3)
        two = plan_of(log.load())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One delta lies as its base does; of several only the deltas may move. The base is the join's left side.
    base = [line for line in two.splitlines() if line.startswith("   :  :")]
    assert "Exchange" not in one and any("Bucketed: true" in line for line in base) and not any("Exchange" in line for line in base)
    assert log.load().where("row_hash = 0").count() == 100 and log.load().count() == 2000


def test_drift_fails_a_write(spark, tmp_path):
    log = SnapshotLog(spark, "file://" + str(tmp_path / "log"), buckets=2)
    mark = str(tmp_path / "times")

    def other_each_time(batches):
        for batch in batches:
            with open(mark, "a") as f:
                f.write("x")
            with open(mark) as f:
                times = len(f.read())
            batch["row_hash"] = batch["row_hash"] + times
            yield batch

    rows = named(spark, [("e", k, k) for k in range(10)]).coalesce(1).mapInPandas(other_each_time, "entity string, pk bigint, row_hash bigint")
    with pytest.raises(SnapshotDrift, match="the frame had"):
        log.write_base(rows, 1, twice=True)
    assert log.manifests() == [] and log.load().count() == 0
    log.write_base(rows, 1)
    assert log.load(check=True).count() == 10
    # Files that change later are told by their manifest.
    part = next((tmp_path / "log" / "base" / "version=1").glob("*.parquet"))
    part.unlink()
    with pytest.raises(SnapshotDrift, match="were counted"):
        log.load(check=True)


@pytest.mark.parametrize("stop", ["before the delta", "after the delta"])
def test_a_killed_capture_goes_on(spark, stop, monkeypatch):
    """The second batch fails between its events and its delta, or after it; a new query on the same checkpoint goes on."""
    path, schema = shared_path(spark, "killed"), "pk bigint, row_hash bigint"
    batches = [[(1, 1), (2, 1)], [(1, 2), (3, 1)], [(2, 1), (3, 5)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(1.1)
    log, fail = SnapshotLog(spark, f"{path}/log", buckets=2), {"once": True}
    write = SnapshotLog.write_delta

    def killed(self, changes, version, **options):
        if version == 2 and fail["once"]:
            fail["once"] = False
            if stop == "after the delta":
                write(self, changes, version, **options)
            raise RuntimeError("killed")
        write(self, changes, version, **options)

    monkeypatch.setattr(SnapshotLog, "write_delta", killed)
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    start = lambda: streams.capture_into(source(), lambda b: b.select("pk", "row_hash"), "e", log, f"{path}/events", f"{path}/checkpoint", None)
    with pytest.raises(Exception, match="killed"):
        start().awaitTermination()
    start().awaitTermination()
    assert rows_of(log.load()) == [("e", 1, 2), ("e", 2, 1), ("e", 3, 5)] and not fail["once"]
    told = spark.read.parquet(f"{path}/events").select("batch", "pk", "op", "row_hash").collect()
    assert sorted(map(tuple, told)) == [(0, 1, "CREATED", 1), (0, 2, "CREATED", 1), (1, 1, "UPDATED", 2), (1, 3, "CREATED", 1), (2, 3, "UPDATED", 5)]


def acknowledged_one_by_one(rows, held, gaps):
    """Changes of a key's rows (kind, seq, hash, status) in their order."""
    acked, last, waits, out = held, None if held is None else 0, None, []
    for kind, seq, found, status in rows:
        if kind == "ack":
            if waits and waits[0] == seq:
                acked, waits = (waits[1] if status == "ok" else acked), None
        elif last is None or seq > last:
            if gaps and last is not None and seq != last + 1:
                acked = None
            waits, last = None, seq
            if found != acked:
                out.append((seq, "CREATED" if acked is None else "UPDATED"))
                waits = (seq, found)
    return out


@pytest.mark.parametrize("gaps", [True, False])
def test_acknowledged_changes_one_by_one(spark, gaps):
    rs, path = random.Random(3), shared_path(spark, "acks")
    held = {k: rs.randrange(3) + 2**60 for k in range(0, 12, 2)}
    told, now = {k: [] for k in range(12)}, 0
    for part in range(3):
        rows = []
        for _ in range(60):
            key, now = rs.randrange(12), now + 1
            seq = max([s for kind, s, *_ in told[key] if kind == "row"], default=0)
            row = ("ack", seq - rs.randrange(2), None, rs.choice(["ok", "ok", "failed"])) if rs.random() < 0.4 else ("row", seq + rs.choice([1, 1, 1, 2, 0]), rs.randrange(3) + 2**60, None)
            told[key].append(row)
            rows.append((key, *row, now))
        frame = spark.createDataFrame(rows, "key bigint, kind string, seq bigint, row_hash bigint, status string, t bigint").withColumn("ts", F.timestamp_seconds("t")).drop("t")
        frame.coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(1.1)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    snapshot = spark.createDataFrame([(k, 0, h) for k, h in held.items()], "key bigint, seq bigint, row_hash bigint")
    found = acknowledged.acknowledged_changes(stream, snapshot, gaps=gaps)
    got = streams.run_to_table(found, f"{path}/out", f"{path}/checkpoint", **dict([acknowledged.STORE]))
    want = sorted((k, *x) for k, rows in told.items() for x in acknowledged_one_by_one(rows, held.get(k), gaps))
    assert sorted(map(tuple, got.collect())) == want and spark.conf.get(acknowledged.STORE[0]) != acknowledged.STORE[1]


def test_state_of_silent_keys_ends(spark):
    path = shared_path(spark, "acks")
    for rows in ([(1, "row", 1, 5, None, 100), (1, "ack", 1, None, "ok", 101)], [(2, "row", 1, 5, None, 10_000)], [(2, "row", 2, 5, None, 20_000)], [(1, "row", 2, 5, None, 20_001), (2, "row", 3, 5, None, 20_001)]):
        frame = spark.createDataFrame(rows, "key bigint, kind string, seq bigint, row_hash bigint, status string, t bigint").withColumn("ts", F.timestamp_seconds("t")).drop("t")
        frame.coalesce(1).write.mode("append").parquet(f"{path}/in")
        time.sleep(1.1)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    got = streams.run_to_table(acknowledged.acknowledged_changes(stream, forget_after_s=3600), f"{path}/out", f"{path}/checkpoint", **dict([acknowledged.STORE]))
    assert sorted(map(tuple, got.where("key = 1").collect())) == [(1, 1, "CREATED"), (1, 2, "CREATED")]


def test_replies_of_another_type_are_no_answers(spark):
    path = shared_path(spark, "replies")
    spark.createDataFrame([("a", "SendCommand", 100), ("b", "SendCommand", 100), ("z", "SendCommand", 9000)], "correlation_id string, msg_type string, t bigint").withColumn("ts", F.timestamp_seconds("t")).write.parquet(f"{path}/c")
    spark.createDataFrame([("a", "SendResult", 105), ("b", "OtherResult", 105), ("z", "SendResult", 9001)], "correlation_id string, msg_type string, t bigint").select("correlation_id", "msg_type", F.timestamp_seconds("t").alias("reply_ts"), F.lit("ok").alias("status")).write.parquet(f"{path}/r")
    read = lambda x: spark.readStream.schema(spark.read.parquet(f"{path}/{x}").schema).parquet(f"{path}/{x}")
    got = streams.run_to_table(streams.command_timeouts(read("c"), read("r")), f"{path}/out", f"{path}/checkpoint")
    assert {r.correlation_id: r.status for r in got.collect()} == {"a": "ok", "b": None, "z": "ok"}


def test_windows_of_any_shape(spark, monkeypatch):
    keys = spark.createDataFrame([(k,) for k in (None, -5, 0, 3, 9, 10, 12, 14, 15, 17, 20, 20, 31, 99)], "pk bigint")
    plan = spark.createDataFrame([(0, 0, 9), (1, 10, 14), (2, 20, 20), (3, 30, 40), (4, 50, 60)], "window_no bigint, lo bigint, hi bigint")
    for short in (10_000, 2):
        monkeypatch.setattr(lookups, "SHORT_TABLE", short)
        assert {r.window_no: r.n for r in windows.window_row_counts(keys, plan).collect()} == {0: 3, 1: 3, 2: 2, 3: 1, 4: 0}
    assert windows.window_row_counts(keys.limit(0), plan).agg(F.sum("n")).first()[0] == 0 and windows.window_row_counts(keys, plan.limit(0)).count() == 0


def test_ten_thousand_steps_are_searched_in_few_looks(spark):
    steps = spark.range(10_000).select((F.col("id") * 10).alias("from"), (F.col("id") * 10 + 6).alias("to"), F.col("id").alias("value"))
    rows = spark.range(300_000).select(F.col("id"), (F.col("id") % 100_010 - 5).alias("level"))
    found = lookups.bracket_lookup(rows, steps, "level")
    assert "Join" not in plan_of(found)
    start = time.time()
    n = found.where("value = level DIV 10 AND level >= 0 AND level % 10 <= 6 OR value IS NULL AND (level < 0 OR level % 10 > 6 OR level >= 100000)").count()
    # Three thousand million comparisons if every step of every row were read.
    assert n == 300_000 and time.time() - start < 30
    times = spark.sql("SELECT timestamp'2024-01-01 00:00:00.000001' AS `from`, timestamp'2024-01-02' AS `to`, 'x' AS value")
    asked = spark.sql("SELECT timestamp'2024-01-01' AS t UNION ALL SELECT timestamp'2024-01-01 00:00:00.000001' UNION ALL SELECT null")
    assert sorted((r.value or "") for r in lookups.bracket_lookup(asked, times, "t").collect()) == ["", "", "x"]


def test_ranks_of_one_board_over_many_tasks(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id").alias("char_id"), F.when(F.col("id") % 50 > 0, "pvp").alias("rating_type"), F.lit(None).cast("int").alias("season"), F.when(F.col("id") % 3 > 0, F.col("id") % 40).otherwise(7).alias("points"))
    rows = rows.unionByName(rows.where("char_id < 5")).repartition(4)
    want = sorted(map(str, events.rating_rank(rows).select("char_id", "rating_type", "points", "position", "rank").collect()))
    monkeypatch.setattr(events, "BOARD_ROWS", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spread = []
    cut = events.cut
    monkeypatch.setattr(events, "cut", lambda df, n: (spread.append(cut(df, n)), spread[-1])[1])
    got = events.rating_rank(rows).select("char_id", "rating_type", "points", F.col("position").cast("int"), F.col("rank").cast("int"))
    assert sorted(map(str, got.collect())) == want
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shares = [r["count"] for r in spread[0].groupBy("__part").count().collect()]
    assert len(shares) > 1 and max(shares) < 2500
    assert events.rating_rank(rows.limit(0)).count() == 0


def test_rows_that_fail_and_populations_that_cannot_be_read(spark):
    rows = spark.createDataFrame([(1, (5,), 0, 1), (2, (6,), 0, 1), (3, None, 0, 1)], "pk bigint, payload struct<hp: int>, state_stamp bigint, n int")
    none = spark.createDataFrame([], "pk bigint, row_hash bigint")
    first = capture.runtime_tick(lambda: rows, none, "n")
    assert first.error is None and first.rejects.count() == 0 and sorted(r.pk for r in first.changes.collect()) == [1, 2]
    second = capture.runtime_tick(lambda: rows, first.current, "n", F.when(F.col("payload.hp") > 5, "too many"))
    assert [tuple(r) for r in second.rejects.collect()] == [(2, "too many")] and second.changes.count() == 0
    # Forgotten, so it comes back as a new one.
    third = capture.runtime_tick(lambda: rows, second.current, "n")
    assert [(r.pk, r.op) for r in third.changes.collect()] == [(2, "CREATED")]
    lost = capture.runtime_tick(lambda: spark.read.parquet("/nowhere"), third.current, "n")
    assert "nowhere" in lost.error and lost.changes.count() == 0 and lost.current.count() == 2
    with pytest.raises(ZeroDivisionError):
        capture.runtime_tick(lambda: 1 // 0, third.current, "n")
