"""Metrics of cycles, publishing and commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def entity_stats(cycles: DataFrame) -> DataFrame:
    """The latest cycle of each entity with ``consecutive_errors``: the length of its current DEGRADED run."""
    ends = cycles.groupBy(F.col("entity").alias("__entity")).agg(F.max("cycle").alias("__last"), F.max(F.when(F.col("state") != "DEGRADED", F.col("cycle"))).alias("__healthy"))
    own = F.col("entity").eqNullSafe(F.col("__entity"))
    failing = cycles.join(ends, own).where(F.col("__healthy").isNull() | (F.col("cycle") > F.col("__healthy")))
    runs = failing.groupBy(F.col("entity").alias("__e")).agg(F.count(F.lit(1)).alias("__run"))
    ends = ends.join(runs, F.col("__entity").eqNullSafe(F.col("__e")), "left").select("__entity", "__last", F.coalesce("__run", F.lit(0)).alias("consecutive_errors"))
    return cycles.join(ends, own & (F.col("cycle") == F.col("__last"))).select(*cycles.columns, "consecutive_errors")


def module_state(enabled: Column, replies_topic: Column, errors: Column) -> Column:
    """DISABLED, DEGRADED (also without a topic for replies) or ACTIVE."""
    return F.when(~enabled, "DISABLED").when(replies_topic.isNull() | (errors > 0), "DEGRADED").otherwise("ACTIVE")


#: Outcomes that are counted for published events.
PUBLISH_OUTCOMES = ("published", "dropped", "failed")


def publish_counters(attempts: DataFrame, families: DataFrame) -> DataFrame:
    """(family, published, dropped, failed, enabled) of attempts (family, outcome); families without attempts too."""
    counts = attempts.groupBy("family").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in PUBLISH_OUTCOMES])
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in PUBLISH_OUTCOMES]
    return families.join(counts, "family", "left").select("family", *filled, "enabled")


def disabled_families(families: DataFrame, enabled: DataFrame) -> DataFrame:
    return families.select("family").join(enabled.select("family"), "family", "left_anti")


#: Outcomes that are counted for commands.
COMMAND_OUTCOMES = ("skipped", "handled", "unsupported", "validation_failed", "internal_error")


def command_counters(commands: DataFrame) -> DataFrame:
    """One row of counts over commands (outcome, reply: published, failed or null)."""
    return commands.agg(
        F.count(F.lit(1)).alias("consumed"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in COMMAND_OUTCOMES],
        *[F.count_if(F.col("reply") == r).alias(f"replies_{r}") for r in ("published", "failed")],
    )


def reply_type(command: Column) -> Column:
    """Name of a command's reply: ``Command`` at its end becomes ``Result``, else ``Result`` is added."""
    return F.concat(F.regexp_replace(command, "Command$", ""), F.lit("Result"))


def command_replies(commands: DataFrame, replies: DataFrame) -> DataFrame:
    """Commands with the time and status of their reply by correlation id; null while there is none."""
    own = replies.select(F.col("correlation_id").alias("__id"), F.col("msg_type").alias("__type"), F.col("ts").alias("reply_ts"), F.col("status").alias("reply_status"))
    return commands.join(own, (F.col("correlation_id") == F.col("__id")) & (reply_type(F.col("msg_type")) == F.col("__type")), "left").drop("__id", "__type")


def escalate(observations: DataFrame, grace_s: int = 900, key: str = "key", seq: str | None = None) -> DataFrame:
    """(key, ts, ok, level) of observations: in each run of failures FIRST, then REPEAT, one ESCALATED when the
    grace has passed since the first, then SILENT; a success resets and has no level. ``seq`` orders observations of
    one instant; without it failures come before a success there."""
    order = ["ts", seq] if seq else ["ts", "ok"]
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = observations.withColumn("__run", F.sum(F.when(F.col("ok"), 1).otherwise(0)).over(w))
    failing = Window.partitionBy(key, "__run", "ok").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    past = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.min("ts").over(failing).cast("timestamp")) >= grace_s * 1_000_000
    run = run.withColumn("__n", F.row_number().over(Window.partitionBy(key, "__run", "ok").orderBy(*order))).withColumn("__past", past)
    run = run.withColumn("__late", F.sum(F.col("__past").cast("int")).over(failing))
    level = F.when(F.col("ok"), F.lit(None)).when(F.col("__n") == 1, "FIRST").when(F.col("__late") == 0, "REPEAT").when(F.col("__past") & (F.col("__late") == 1), "ESCALATED").otherwise("SILENT")
    return run.select(key, "ts", "ok", level.alias("level"))
