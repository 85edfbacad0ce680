"""Streaming operators run over all rows of ``events`` as a file stream, with the batch results as their SQL."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ids
from tidemark.operators import counters
from tidemark.plans.book import query, table
from tidemark.plans.event_queries import ESCALATED
from tidemark.scratch import cut, shared_path
from tidemark.sources import records
from tidemark.sources.snapshot_log import SnapshotLog
from tidemark.streaming import acknowledged, streams


#: Micro-batches of a staged table, and rows of a micro-batch for each of its files.
BATCHES, FILE_ROWS = 4, 100_000


def staged(df, name, time="ts"):
    """A stream over a table written to the shared folder in the order of ``time``: each quarter of the span is written
    after the one before and read at once, in as many files as its rows ask for, so state lives through several
    micro-batches and no quarter goes through one task."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    rows = cut(df, name + "-rows")
    span = rows.agg(F.unix_micros(F.min(time)).alias("lo"), (F.unix_micros(F.max(time)) - F.unix_micros(F.min(time)) + 1).alias("span"), F.count(F.lit(1)).alias("n")).first()
    part = F.floor((F.unix_micros(F.col(time)) - F.lit(span.lo)) * BATCHES / F.lit(span.span))
    files = span.n // (BATCHES * FILE_ROWS) + 1
    for k in range(BATCHES):
        rows.where(part == k).repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def run(stream, name, **settings):
    spark = stream.sparkSession
    return streams.run_to_table(stream, shared_path(spark, name), shared_path(spark, f"{name}-checkpoint"), **settings)


@query("SELECT event_id, user_id FROM events")
def stream_dedup(spark, sf_dir):
    """Every tenth event comes a second time, an hour later; event time is that inside the id."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    again = e.where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    made = e.unionByName(again).join(e.select("event_id", ids.uuid7_at(F.unix_millis("ts"), F.col("event_id")).alias("uuid")), "event_id")
    timed = streams.with_event_time(staged(made, "stream-in"), "uuid")
    return run(streams.dedup_stream(timed, "1 day", "uuid"), "stream-dedup").select("event_id", "user_id")


@query("""WITH d AS (SELECT user_id AS pk, dayofmonth(ts) AS tick, max_by(event_type, event_id) AS h FROM events GROUP BY 1, 2), l AS (SELECT *, lag(tick) OVER w AS t, lag(h) OVER w AS g FROM d WINDOW w AS (PARTITION BY pk ORDER BY tick))
SELECT pk, tick, CASE WHEN t IS NULL OR t <> tick - 1 THEN 'CREATED' ELSE 'UPDATED' END AS op FROM l WHERE t IS NULL OR t <> tick - 1 OR h <> g""")
def stream_ticks(spark, sf_dir):
    """Days are ticks of a population of users whose state is the day's last event type."""
    days = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("pk"), F.dayofmonth("ts").cast("bigint").alias("tick")).agg(F.xxhash64(F.max_by("event_type", "event_id")).alias("row_hash"), F.max(F.col("ts").cast("timestamp")).alias("ts"))
    return run(streams.ticks(staged(days, "stream-in")), "stream-ticks")


@query("""WITH e AS (SELECT user_id, ts, event_type <> 'error' AS open FROM events), l AS (SELECT *, lag(ts) OVER w AS t, lag(open) OVER w AS o, lead(ts) OVER w AS n FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, coalesce(o, false) AND ts - t < INTERVAL 12 HOUR AS still, coalesce(o, false) AND ts - t >= INTERVAL 12 HOUR AS over FROM l)
SELECT user_id AS char_id, ts, CASE WHEN open THEN 'OPENED' ELSE 'CLOSED' END AS change FROM s WHERE open <> still UNION ALL SELECT user_id, t + INTERVAL 12 HOUR, 'EXPIRED' FROM s WHERE over
UNION ALL SELECT user_id, ts + INTERVAL 12 HOUR, 'EXPIRED' FROM l WHERE n IS NULL AND open AND ts + INTERVAL 12 HOUR < (SELECT max(ts) FROM events) - INTERVAL 1 MINUTE""")
def stream_stores(spark, sf_dir):
    """Stores open with an event, close with an error and expire after twelve silent hours, by the next event or by the
    watermark, which ends a minute before the last event."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("char_id"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("open"))
    found = run(streams.store_changes(staged(e, "stream-in"), 12 * 3600), "stream-stores")
    return found.select("char_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "change")


@query(f"WITH {ESCALATED} SELECT CAST(user_id AS VARCHAR) AS key, ts, CASE WHEN n = 1 THEN 'FIRST' WHEN late = 0 THEN 'REPEAT' WHEN past AND late = 1 THEN 'ESCALATED' ELSE 'SILENT' END AS level FROM g")
def stream_escalations(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "purchase").alias("ok"), F.col("event_id").alias("seq"))
    found = run(streams.escalations(staged(e, "stream-in"), 15 * 3600, forget_after_s=30 * 86_400), "stream-escalations")
    return found.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT c.event_id, r.ts AS reply_ts FROM events c LEFT JOIN events r ON r.event_id = c.event_id + 1 AND r.event_type = 'view' AND r.event_id % 7 <> 0 AND r.ts BETWEEN c.ts AND c.ts + INTERVAL 5 MINUTE WHERE c.event_type = 'click' AND (r.ts IS NOT NULL OR c.ts < (SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'view')) FROM events) - INTERVAL 1 DAY)")
def stream_timeouts(spark, sf_dir):
    """Clicks as commands of a stream, a view right after one as its reply, but for some of another type; without one in
    five minutes they time out.
    Of the last day, which later watermarks would settle, only what has its reply is compared."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    commands = staged(e.where("event_type = 'click'").select("event_id", F.col("event_id").alias("correlation_id"), F.lit("ClickCommand").alias("msg_type"), "ts"), "stream-commands")
    replies = staged(e.where("event_type = 'view'").select((F.col("event_id") - 1).alias("correlation_id"), F.col("ts").alias("reply_ts"), F.when(F.col("event_id") % 7 == 0, "OtherResult").otherwise("ClickResult").alias("msg_type"), F.lit("ok").alias("status")), "stream-replies", "reply_ts")
    found = run(streams.command_timeouts(commands, replies), "stream-timeouts")
    ends = e.agg(F.least(F.max(F.when(F.col("event_type") == "click", F.col("ts"))), F.max(F.when(F.col("event_type") == "view", F.col("ts")))).alias("last"))
    settled = found.join(F.broadcast(ends)).where(F.col("reply_ts").isNotNull() | (F.col("ts") < F.col("last") - F.expr("INTERVAL 1 DAY")))  # one row
    return settled.select("event_id", F.col("reply_ts").cast("timestamp_ntz").alias("reply_ts"))


@query("SELECT user_id AS pk, max(event_id) AS last_event FROM events GROUP BY 1")
def stream_capture(spark, sf_dir):
    """Micro-batches of new rows, each a capture cycle whose snapshot is a version of a log: at the end it holds every key
    once."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("pk"), "event_id", F.col("ts").cast("timestamp").alias("ts"))
    log = SnapshotLog(spark, shared_path(spark, "capture-log"), buckets=8)
    latest = lambda batch: batch.groupBy("pk").agg(F.max("event_id").alias("row_hash"))
    streams.capture_into(staged(e, "stream-in"), latest, "user", log, shared_path(spark, "capture-events"), shared_path(spark, "capture-checkpoint"), None, compact_every=2).awaitTermination()
    return log.load().select("pk", F.col("row_hash").alias("last_event"))


DAYS = """d AS (SELECT user_id AS pk, dayofmonth(ts) AS tick, max_by(event_type, event_id) AS h, max(ts) AS ts FROM events GROUP BY 1, 2),
n AS (SELECT *, (pk + tick) % 4 <> 0 AND coalesce(ts + CASE WHEN (pk + tick) % 7 = 0 THEN INTERVAL 3 DAY ELSE INTERVAL 1 SECOND END < lead(ts) OVER w, true) AS ok, tick - row_number() OVER w AS run FROM d WINDOW w AS (PARTITION BY pk ORDER BY tick))"""


def days_with_acks(spark, sf_dir):
    """A user's days as (key, kind, seq, row_hash, status, ts), and their acknowledgements: one in four fails, one in seven
    comes three days later."""
    days = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key"), F.dayofmonth("ts").cast("bigint").alias("seq")).agg(F.xxhash64(F.max_by("event_type", "event_id")).alias("row_hash"), F.max(F.col("ts").cast("timestamp")).alias("ts"))
    n = F.col("key") + F.col("seq")
    acks = days.select("key", F.lit("ack").alias("kind"), "seq", F.lit(None).cast("bigint").alias("row_hash"), F.when(n % 4 == 0, "failed").otherwise("ok").alias("status"), F.when(n % 7 == 0, F.col("ts") + F.expr("INTERVAL 3 DAY")).otherwise(F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("ts"))
    return days.select("key", F.lit("row").alias("kind"), "seq", "row_hash", F.lit(None).cast("string").alias("status"), "ts").unionByName(acks)


@query(f"""WITH {DAYS}, l AS (SELECT *, last_value(CASE WHEN ok THEN h END IGNORE NULLS) OVER (PARTITION BY pk, run ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS acked FROM n)
SELECT pk, tick, CASE WHEN acked IS NULL THEN 'CREATED' ELSE 'UPDATED' END AS op FROM l WHERE acked IS NULL OR acked <> h""")
def stream_acknowledged(spark, sf_dir):
    """Days are ticks of a population; only what was acknowledged before the next tick counts as sent."""
    found = acknowledged.acknowledged_changes(staged(days_with_acks(spark, sf_dir), "stream-in"), forget_after_s=40 * 86_400)
    return run(found, "stream-acknowledged", **dict([acknowledged.STORE])).select(F.col("key").alias("pk"), F.col("seq").alias("tick"), "op")


@query(f"""WITH {DAYS}, l AS (SELECT *, coalesce(last_value(CASE WHEN ok THEN h END IGNORE NULLS) OVER (PARTITION BY pk ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), CASE WHEN pk % 2 = 0 THEN 'view' END) AS acked FROM n)
SELECT pk, tick, CASE WHEN acked IS NULL THEN 'CREATED' ELSE 'UPDATED' END AS op FROM l WHERE acked IS NULL OR acked <> h""")
def stream_settings(spark, sf_dir):
    """Days as settings of a user, sent if they differ from what was last sent for sure; half of the users start from a
    snapshot in which their setting was a view."""
    rows = days_with_acks(spark, sf_dir)
    sent = rows.where("key % 2 = 0").select("key").distinct().select("key", F.lit(0).cast("bigint").alias("seq"), F.xxhash64(F.lit("view")).alias("row_hash"))
    found = acknowledged.acknowledged_changes(staged(rows, "stream-in"), cut(sent, "sent"), gaps=False, forget_after_s=40 * 86_400)
    return run(found, "stream-settings", **dict([acknowledged.STORE])).select(F.col("key").alias("pk"), F.col("seq").alias("tick"), "op")


@query("""SELECT count(*) AS consumed, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'purchase') AS handled, count(*) FILTER (event_type = 'click') AS unsupported,
count(*) FILTER (event_type = 'signup') AS validation_failed, count(*) FILTER (event_type = 'error') AS internal_error, count(*) FILTER (value > 20) AS replies_published, count(*) FILTER (value <= 20) AS replies_failed FROM events""")
def stream_counters(spark, sf_dir):
    """Commands of a stream are written, and counted by outcome and reply on the way; the counts of the batches add up."""
    names = dict(zip(("view", "purchase", "click", "signup", "error"), ("skipped", "handled", "unsupported", "validation_failed", "internal_error")))
    book = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), book[F.col("event_type")].alias("outcome"), F.when(F.col("value") > 20, "published").otherwise("failed").alias("reply"))
    flags, sent, counts = counters.command_flags(), shared_path(spark, "stream-sent"), shared_path(spark, "stream-counts")
    sink = lambda rows, number: rows.write.mode("overwrite").parquet(f"{sent}/batch={number}")
    counters.counted_into(staged(e, "stream-in"), flags, sink, counts, shared_path(spark, "stream-checkpoint"), None).awaitTermination()
    return counters.batch_counts(spark, counts, list(flags)).agg(*[F.sum(c).alias(c) for c in flags])


@query("SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS kind, event_id % 10 = 0 AS dead FROM events")
def stream_records(spark, sf_dir):
    """Events as records of a stream, a tenth of them garbage. The consumer fails once in its second batch, after writing,
    and its successor begins that batch again: every record ends up once, decoded or dead."""
    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), ids.key_bytes(F.col("event_id")).alias("key"), F.encode(F.when(F.col("event_id") % 10 == 0, "{garbage").otherwise(F.to_json(F.struct(F.col("event_type").alias("kind")))), "utf-8").alias("value"))
    path, fail = shared_path(spark, "consumed"), {"once"}

    def handle(rows, number):
        good, dead = records.decode_envelope(rows, "kind string")
        number_of = ids.key_number(F.col("key")).alias("event_id")
        both = good.select(number_of, "payload.kind", F.lit(False).alias("dead")).unionByName(dead.select(number_of, F.lit(None).cast("string").alias("kind"), F.lit(True).alias("dead")))
        records.write_batch(both, number, f"{path}/out")
        if number == 1 and fail:
            fail.clear()
            raise RuntimeError("the consumer stops")

    stream = staged(e, "stream-in")
    try:
        records.consume(stream, handle, f"{path}/checkpoint").awaitTermination()
    except StreamingQueryException as stopped:
        if "the consumer stops" not in str(stopped):
            raise
        records.consume(stream, handle, f"{path}/checkpoint").awaitTermination()
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("dead", T.BooleanType())])
    return records.read_batches(spark, f"{path}/out", schema).drop("batch")
