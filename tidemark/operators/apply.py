"""The consumer's side: applying change events, sweeping ghosts, reconciling catalogues, replacing state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: str | Column) -> DataFrame:
    """The last row of each key by ``order``: an aggregate, so tasks reduce their rows before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def apply_changes(target: DataFrame, events: DataFrame, synced_at: Column | None = None) -> DataFrame:
    """The target (pk, payload..., optionally db_synced_at) after events (pk, op, payload..., ts_ms, seq).

    CREATED and UPDATED put, DELETED removes, other operations do nothing; the last event of a key counts.
    Every put refreshes ``db_synced_at`` if there is such a column.
    """
    last = latest(events.where("op IN ('CREATED', 'UPDATED', 'DELETED')"), ["pk"], "ts_ms", "seq")
    kept = target.join(last.select("pk"), "pk", "left_anti")
    put = last.where("op <> 'DELETED'")
    if "db_synced_at" in target.columns:
        put = put.withColumn("db_synced_at", synced_at if synced_at is not None else F.timestamp_millis("ts_ms"))
    return kept.unionByName(put.select(*target.columns))


def sweep_ghosts(target: DataFrame, completions: DataFrame, now: Column, grace_s: int, entity: str = "entity") -> DataFrame:
    """The target without rows last synced before the cycle of a completed whole-entity resync, once ``grace_s``
    have passed. ``completions``: (entity, cycle_started_at, completed_at, whole)."""
    due = completions.where(F.col("whole") & (F.unix_seconds(now) - F.unix_seconds("completed_at") >= grace_s))
    cut = due.groupBy(F.col("entity").alias("__entity")).agg(F.max("cycle_started_at").alias("__cut"))
    marked = target.join(cut, F.col(entity) == F.col("__entity"), "left")
    ghost = F.col("__cut").isNotNull() & (F.col("db_synced_at").isNull() | (F.col("db_synced_at") < F.col("__cut")))
    return marked.where(~ghost).drop("__entity", "__cut")


def sweep_scoped(target: DataFrame, fk: str, parents: DataFrame, cutoff: Column) -> DataFrame:
    """The target without rows of the given parents (pk) that were last synced before ``cutoff``."""
    inside = parents.select(F.col("pk").alias("__pk"), F.lit(True).alias("__in")).distinct()
    marked = target.join(inside, F.col(fk) == F.col("__pk"), "left")
    ghost = F.coalesce("__in", F.lit(False)) & (F.col("db_synced_at").isNull() | (F.col("db_synced_at") < cutoff))
    return marked.where(~ghost).drop("__pk", "__in")


def resync_operation_status(entities: DataFrame, now: Column, ttl_s: int = 3600) -> DataFrame:
    """(operation_id, status, ...) of rows (operation_id, entity, synced_at, swept_at, failed, requested_at).

    An entity is SWEPT, SYNCED, FAILED or PENDING; PENDING fails after the time to live. An operation is COMPLETED
    if all are swept, FAILED if all failed, PARTIALLY_FAILED if some did and none is open, else RUNNING.
    """
    late = F.unix_seconds(now) - F.unix_seconds("requested_at") > ttl_s
    state = F.when(F.col("failed"), "FAILED").when(F.col("swept_at").isNotNull(), "SWEPT").when(F.col("synced_at").isNotNull(), "SYNCED").when(late, "FAILED").otherwise("PENDING")
    counts = entities.withColumn("state", state).groupBy("operation_id").agg(F.count(F.lit(1)).alias("entities"), *[F.count_if(F.col("state") == s).alias(s.lower()) for s in ("PENDING", "SYNCED", "SWEPT", "FAILED")])
    status = F.when(F.col("swept") == F.col("entities"), "COMPLETED").when(F.col("failed") == F.col("entities"), "FAILED").when((F.col("failed") > 0) & (F.col("pending") + F.col("synced") == 0), "PARTIALLY_FAILED").otherwise("RUNNING")
    return counts.withColumn("status", status)


def catalogue_burst(df: DataFrame | None, entity: str, pk: Column, sync_id: str, ts_ms: Column, payload: Column) -> DataFrame | None:
    """UPSERT rows and a SNAPSHOT_COMPLETE marker with their count. No table (None) sends nothing at all, which is
    not an empty table: that sends a marker of 0."""
    if df is None:
        return None
    head = [F.lit(entity).alias("entity_name")]
    rows = df.select(*head, F.lit("UPSERT").alias("op"), F.lit(sync_id).alias("sync_id"), pk.cast("bigint").alias("pk"), payload.alias("payload"), F.lit(None).cast("bigint").alias("count"), ts_ms.alias("ts_ms"))
    kind = rows.schema["payload"].dataType
    marker = rows.agg(F.count(F.lit(1)).alias("count"), F.max("ts_ms").alias("ts_ms")).select(*head, F.lit("SNAPSHOT_COMPLETE").alias("op"), F.lit(sync_id).alias("sync_id"), F.lit(None).cast("bigint").alias("pk"), F.lit(None).cast(kind).alias("payload"), "count", F.coalesce("ts_ms", F.lit(0).cast("bigint")).alias("ts_ms"))
    return rows.unionByName(marker)


def catalogue_pk(entity: str, id_: Column | None = None) -> Column:
    """Key of a catalogue row: its id or level, a class's ordinal (-1 if null), 0 for the one row of a singleton."""
    if entity == "gear_score":
        return F.lit(0).cast("bigint")
    if entity == "class":
        return F.coalesce(id_, F.lit(-1)).cast("bigint")
    return id_.cast("bigint")


def reconcile_catalogue(target: DataFrame, burst: DataFrame) -> DataFrame:
    """The target (entity_name, pk, payload) after a burst: its rows are put, and rows of the entity that it didn't
    have are removed, but only if a marker counts the distinct rows of its sync id right and isn't 0."""
    ups = burst.where("op = 'UPSERT'")
    seen = ups.groupBy("entity_name", "sync_id").agg(F.count_distinct("pk").alias("n"))
    told = burst.where("op = 'SNAPSHOT_COMPLETE' AND count > 0").select("entity_name", "sync_id", "count", "ts_ms")
    # One row an entity: its newest sync whose marker counts right.
    sound = latest(told.join(seen, ["entity_name", "sync_id"]).where("n = count").select("entity_name", "sync_id", "ts_ms"), ["entity_name"], "ts_ms")
    sound = sound.select("entity_name", F.col("sync_id").alias("__sync"))
    put = ups.join(sound, "entity_name", "left").groupBy("entity_name", "pk").agg(
        F.max_by("payload", "ts_ms").alias("__put"),
        # Without a sound sync every put stays; with one, a put that it didn't have came from an older sync.
        F.max(F.col("__sync").isNull() | (F.col("sync_id") == F.col("__sync"))).alias("__known"),
    )
    old = target.select("entity_name", "pk", F.col("payload").alias("__old")).join(sound.withColumnRenamed("__sync", "__done"), "entity_name", "left")
    both = old.join(put, ["entity_name", "pk"], "full_outer")
    stays = F.when(F.col("__known").isNotNull(), F.col("__known")).otherwise(F.col("__done").isNull())
    return both.where(stays).select("entity_name", "pk", F.when(F.col("__known").isNotNull(), F.col("__put")).otherwise(F.col("__old")).alias("payload"))


def replace_snapshot_state(snapshots: DataFrame, key: str, order: str, entries: str) -> DataFrame:
    """Entries of the latest full snapshot of each key; entries that it lacks are gone."""
    return latest(snapshots.select(key, order, entries), [key], order).select(key, order, F.explode(entries).alias("entry"))


def replace_children(target: DataFrame, events: DataFrame, pk: str, order: str) -> DataFrame:
    """Rows whose nested children come whole with the newest event of their key."""
    newest = latest(events, [pk], order).select(*target.columns)
    return target.join(newest.select(pk), pk, "left_anti").unionByName(newest)


def apply_runtime(events: DataFrame, volatile: list[str], pk: str = "pk", order: str = "ts_ms") -> DataFrame:
    """Latest runtime state per key; a tombstone, whose volatile fields are all null, clears the state and stays as
    an offline row."""
    from tidemark.functions.values import carries_state

    return latest(events, [pk], order).withColumn("has_state", carries_state(*[F.col(c) for c in volatile]))


def apply_effects(state: DataFrame, effects: str = "effects", elapsed: str = "elapsed_s") -> DataFrame:
    """Effects of a character: null or empty clears on a live row. On a tombstone FROZEN effects stay, TICKING ones
    lose the time that passed and end at 0, DROPPED ones go."""
    live = F.coalesce(effects, F.array().cast(state.schema[effects].dataType))
    ticked = F.transform(live, lambda e: F.when(e["offline"] == "TICKING", e.withField("remaining_s", e["remaining_s"] - F.col(elapsed))).otherwise(e))
    offline = F.filter(ticked, lambda e: (e["offline"] == "FROZEN") | ((e["offline"] == "TICKING") & (e["remaining_s"] > 0)))
    return state.withColumn(effects, F.when(F.col("has_state"), live).otherwise(offline))


def apply_usages(events: DataFrame, key: str, order: str, usages: str = "usages") -> DataFrame:
    """Usages of the latest complete set of each key, a row each."""
    return latest(events.select(key, order, usages), [key], order).select(key, F.inline(usages))


def online_state(sources: DataFrame, key: str = "char_id") -> DataFrame:
    """Of statements (key, online, ts, source) the last one; ties go to the source that sorts last."""
    return latest(sources, [key], "ts", "source")


def server_status(events: DataFrame, known: DataFrame | None = None, key: str = "server_id", time: str = "event_time") -> DataFrame:
    """``online`` or ``stopping`` by the latest event. ``known``: (key, time) up to which each server has been told; a
    late replay, at or before that, changes nothing."""
    if known is not None:
        told = known.groupBy(F.col(key).alias("__key")).agg(F.max(time).alias("__told"))
        events = events.join(told, F.col(key) == F.col("__key"), "left").where(F.col("__told").isNull() | (F.col(time) > F.col("__told"))).drop("__key", "__told")
    last = latest(events, [key], time)
    return last.withColumn("status", F.when(F.col("msg_type") == "ServerStartedEvent", "online").when(F.col("msg_type") == "ServerStoppingEvent", "stopping"))


def drop_older(events: DataFrame, key: str, time: str) -> DataFrame:
    """Events without those that arrive after a newer one of their key (by ``seq``)."""
    before = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return events.withColumn("__max", F.max(time).over(before)).where(F.col("__max").isNull() | (F.col(time) > F.col("__max"))).drop("__max")
