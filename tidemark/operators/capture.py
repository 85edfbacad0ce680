"""Snapshot-diff change capture: hash, fold, diff, fetch, envelope, acknowledged advance.

All keys are BIGINT. A snapshot is a table (pk, row_hash); absence is a join's missing side, never a reserved value.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import hashing
from tidemark.operators.lookups import bracket_lookup
from tidemark.scratch import cut
from tidemark.sources.windows import targeted_keys


@dataclass(frozen=True)
class ChildSpec:
    """A child table: its rows belong to the primary row whose key their ``fk`` holds; a filter may leave some out."""

    name: str
    df: DataFrame
    fk: str
    hashed: Sequence[str]
    row_filter: Column | None = None

    def rows(self) -> DataFrame:
        return self.df if self.row_filter is None else self.df.where(self.row_filter)


@dataclass(frozen=True)
class ParentSpec:
    entity: str
    fk: str


@dataclass(frozen=True)
class EntitySpec:
    """An entity: primary table, key, hashed columns, payload columns, children, parents."""

    name: str
    df: DataFrame
    pk: str
    hashed: Sequence[str]
    payload: Sequence[str] = ()
    children: Sequence[ChildSpec] = ()
    parents: Sequence[ParentSpec] = ()
    extra: Mapping[str, Column] = field(default_factory=dict)

    def __post_init__(self):
        missing = [c for c in (self.pk, *self.hashed, *self.payload) if c not in self.df.columns]
        missing += [f"{x.name}.{c}" for x in self.children for c in (x.fk, *x.hashed) if c not in x.df.columns]
        if missing:
            raise ValueError(f"{self.name} has no column {', '.join(missing)}")
        names = [c.name for c in self.children]
        if len(set(names)) < len(names):
            raise ValueError(f"{self.name} has two children of one name")


def entity_hashes(spec: EntitySpec, exact: bool = True, algo: str = "crc32") -> DataFrame:
    """(pk, row_hash) of every primary row, its children folded in; orphans fall away.

    Children are summed by key before the join, in each task first, so the join sees a row per key on both sides.
    ``exact=False`` is the 32-bit fold, which is blind to some changes of several child rows at once.
    """
    out = spec.df.select(F.col(spec.pk).cast("bigint").alias("pk"), (hashing.exact_row_hash(spec.hashed) if exact else hashing.row_hash(spec.hashed, algo)).alias("__h"))
    names = []
    for k, child in enumerate(spec.children):
        rows, name = child.rows(), f"__c{k}"
        if exact:
            sums = hashing.exact_child_hash(rows, child.fk, child.hashed, name)
        else:
            sums = rows.groupBy(child.fk).agg(F.bit_xor(hashing.row_hash(child.hashed, algo)).alias(name))
        out = out.join(sums.select(F.col(child.fk).cast("bigint").alias("pk"), name), "pk", "left")
        names.append(F.col(name))
    fold = hashing.exact_fold_hash if exact else hashing.fold_hash
    return out.select("pk", (fold(F.col("__h"), names) if names else F.col("__h")).alias("row_hash"))


def diff(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """(pk, op, row_hash) of changes: CREATED, UPDATED, DELETED; unchanged rows fall away.

    A snapshot may have a boolean ``forced``: such a row counts as changed, and if it isn't stored at all
    (null row_hash), a live row is UPDATED and a missing one DELETED.
    """
    old = snapshot.select(F.col("pk").alias("__pk"), F.col("row_hash").alias("__old"), (F.col("forced") if "forced" in snapshot.columns else F.lit(False)).alias("__forced"))
    both = current.join(old, F.col("pk") == F.col("__pk"), "full_outer")
    live, stored = F.col("pk").isNotNull(), F.col("__pk").isNotNull()
    op = F.when(~stored, "CREATED").when(~live, "DELETED").when(F.col("__forced") | ~F.col("row_hash").eqNullSafe(F.col("__old")), "UPDATED")
    return both.withColumn("op", op).where("op IS NOT NULL").select(F.coalesce("pk", "__pk").alias("pk"), "op", "row_hash")


def diff_window(current: DataFrame, snapshot: DataFrame, lo: int, hi: int) -> DataFrame:
    """Changes of keys in [lo, hi]; other keys aren't judged."""
    inside = F.col("pk").between(lo, hi)
    return diff(current.where(inside), snapshot.where(inside))


def diff_windows(current: DataFrame, snapshot: DataFrame, windows: DataFrame, failed: DataFrame) -> DataFrame:
    """Changes outside windows (window_no, lo, hi) that couldn't be read: their keys are left alone, not taken as deleted."""
    bad = windows.join(failed, "window_no", "left_semi").select(F.col("lo").alias("from"), F.col("hi").alias("to"), F.lit(True).alias("value"))
    outside = lambda df: bracket_lookup(df, bad, "pk").where("value IS NULL").drop("value")
    return diff(outside(current), outside(snapshot))


def targeted(spec: EntitySpec, keys: DataFrame) -> EntitySpec:
    """The entity with the primary and child rows of the given keys (pk) only, so nothing else is hashed or moved."""
    children = [replace(c, df=targeted_keys(c.rows(), keys, c.fk), row_filter=None) for c in spec.children]
    return replace(spec, df=targeted_keys(spec.df, keys, spec.pk), children=children)


def diff_targeted(current: DataFrame, snapshot: DataFrame, keys: DataFrame) -> DataFrame:
    """Changes of the given keys (pk); a stored key that is gone is DELETED. ``current`` are hashes of all keys, or of
    these only (see :func:`diff_targeted_entity`)."""
    only = keys.select("pk").distinct()
    return diff(current.join(only, "pk", "left_semi"), snapshot.join(only, "pk", "left_semi"))


def diff_targeted_entity(spec: EntitySpec, snapshot: DataFrame, keys: DataFrame) -> DataFrame:
    """:func:`diff_targeted` of an entity whose rows are picked by key before they are hashed."""
    only = keys.select("pk").distinct()
    return diff(entity_hashes(targeted(spec, only)), snapshot.join(only, "pk", "left_semi"))


def diff_entities(specs: Sequence[EntitySpec], snapshot: DataFrame, hashes: Callable[[EntitySpec], DataFrame] = entity_hashes) -> tuple[DataFrame | None, dict[str, str]]:
    """(changes of all entities with ``entity``, errors by entity). Each entity is a job of its own whose changes are
    written, so one that fails, in planning or in a task, doesn't stop the others."""
    found, errors = None, {}
    for spec in specs:
        try:
            own = diff(hashes(spec), snapshot.where(F.col("entity") == spec.name)).select(F.lit(spec.name).alias("entity"), "pk", "op", "row_hash")
            own = cut(own, "entity-changes")
            found = own if found is None else found.unionByName(own)
        except Exception as e:
            errors[spec.name] = str(e).splitlines()[0]
    return found, errors


def fetch_changed(df: DataFrame, changes: DataFrame, pk: str) -> DataFrame:
    """Full rows of created and updated keys only."""
    keys = changes.where("op <> 'DELETED'").select(F.col("pk").alias("__pk"))
    return df.join(keys, F.col(pk).cast("bigint") == F.col("__pk"), "left_semi")


def fetch_children(child: ChildSpec, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pk, rows): the children of changed keys as sorted arrays of structs. A key's children are part of its event."""
    rows = fetch_changed(child.rows(), changes, child.fk)
    return rows.groupBy(F.col(child.fk).cast("bigint").alias("pk")).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(child.name))


def assemble(spec: EntitySpec, changes: DataFrame) -> DataFrame:
    """(pk, payload): primary columns and one array, possibly empty, per child. A key whose primary row is gone by
    now has no row."""
    own = fetch_changed(spec.df, changes, spec.pk).withColumn("__pk", F.col(spec.pk).cast("bigint"))
    own = own.select(F.col("__pk").alias("pk"), *[F.col(c) for c in (spec.payload or spec.hashed)], *[c.alias(n) for n, c in spec.extra.items()])
    fields = [c for c in own.columns if c != "pk"]
    for child in spec.children:
        rows = fetch_children(child, changes, child.hashed)
        own = own.join(rows, "pk", "left").withColumn(child.name, F.coalesce(child.name, F.array().cast(rows.schema[child.name].dataType)))
        fields.append(child.name)
    return own.select("pk", F.struct(*fields).alias("payload"))


def change_events(spec: EntitySpec, changes: DataFrame, ts_ms: Column) -> DataFrame:
    """(entity_name, pk, op, payload, ts_ms): a null payload for DELETED."""
    full = assemble(spec, changes)
    live = changes.where("op <> 'DELETED'").select("pk", "op").join(full, "pk")
    gone = changes.where("op = 'DELETED'").select("pk", "op", F.lit(None).cast(full.schema["payload"].dataType).alias("payload"))
    return live.unionByName(gone).select(F.lit(spec.name).alias("entity_name"), "pk", "op", "payload", ts_ms.alias("ts_ms"))


def advance(snapshot: DataFrame, changes: DataFrame, acks: DataFrame) -> DataFrame:
    """The next snapshot: only acknowledged keys (pk, status ``ok``) move, so what failed or is pending comes again."""
    old = snapshot.select("pk", "row_hash")
    acked = changes.join(acks.where("status = 'ok'").select("pk").distinct(), "pk", "left_semi")
    kept = old.join(acked.select("pk"), "pk", "left_anti")
    return kept.unionByName(acked.where("op <> 'DELETED'").select("pk", "row_hash"))


def change_counts(changes: DataFrame, acks: DataFrame | None = None) -> DataFrame:
    """One row of created, updated and deleted; acknowledged changes only, if ``acks`` are given."""
    if acks is not None:
        changes = changes.join(acks.where("status = 'ok'").select("pk").distinct(), "pk", "left_semi")
    return changes.agg(*[F.count_if(F.col("op") == x).alias(x.lower()) for x in ("CREATED", "UPDATED", "DELETED")])


def cycle_result(entity: str, snapshot: DataFrame, changes: DataFrame, acks: DataFrame, windows_failed: bool = False, aborted: bool = False) -> DataFrame:
    """One row of a cycle: DEGRADED if a window failed or the cycle was aborted, which then reports no changes;
    failed publishes leave it HEALTHY."""
    counts = change_counts(changes, acks)
    if aborted:
        counts = counts.select(*[F.lit(0).cast("bigint").alias(c) for c in counts.columns])
    told = acks.agg(F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "pending").alias("pending"))
    size = snapshot.agg(F.count(F.lit(1)).alias("row_count"))
    state = "DEGRADED" if windows_failed or aborted else "HEALTHY"
    return counts.join(told).join(size).select(F.lit(entity).alias("entity"), F.lit(state).alias("state"), "*")


# Fast-changing populations, without deletes.


def skip_bad_rows(rows: DataFrame, order: str) -> DataFrame:
    """Of rows (pk, payload, state_stamp) those with a key and a payload; of a key's rows the last by ``order``."""
    sound = rows.where("pk IS NOT NULL AND payload IS NOT NULL")
    rest = [c for c in rows.columns if c != "pk"]
    return sound.groupBy("pk").agg(F.max_by(F.struct(*rest), order).alias("__r")).select("pk", "__r.*")


def population_hashes(rows: DataFrame) -> DataFrame:
    """(pk, row_hash) of runtime rows; the stamp enters the hash, never the payload."""
    return rows.select("pk", hashing.stamp_hash(F.xxhash64("payload"), F.col("state_stamp")).alias("row_hash"))


def runtime_diff(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(pk, op, row_hash): CREATED or UPDATED only. A key that left is forgotten, so its return is CREATED."""
    old = previous.select("pk", F.col("row_hash").alias("__old"))
    both = current.join(old, "pk", "left")
    op = F.when(F.col("__old").isNull(), "CREATED").when(F.col("__old") != F.col("row_hash"), "UPDATED")
    return both.withColumn("op", op).where("op IS NOT NULL").select("pk", "op", "row_hash")


class Tick(NamedTuple):
    current: DataFrame
    changes: DataFrame
    #: (pk, error) of rows that couldn't be hashed; they count as having left.
    rejects: DataFrame
    #: Why the population couldn't be read; the tick is degraded then.
    error: str | None


def runtime_tick(read: Callable[[], DataFrame], previous: DataFrame, order: str, row_error: Column | None = None) -> Tick:
    """A tick of a population (pk, payload, state_stamp and ``order``) that ``read`` gives. If it can't be read, in planning
    or in a task, the previous state is kept and nothing has changed.

    ``row_error`` tells of a row what is wrong with it, null for a sound one: such a row goes to the rejects and is
    forgotten, the others are judged.
    """
    try:
        rows = cut(skip_bad_rows(read(), order).withColumn("__error", F.lit(None).cast("string") if row_error is None else row_error.cast("string")), "population-rows")
    except (PySparkException, Py4JError, OSError) as e:
        none = previous.select("pk", F.lit("").alias("error")).limit(0)
        return Tick(previous, runtime_diff(previous, previous), none, str(e).splitlines()[0])
    current = cut(population_hashes(rows.where("__error IS NULL")), "population")
    return Tick(current, cut(runtime_diff(current, previous), "population-changes"), rows.where("__error IS NOT NULL").select("pk", F.col("__error").alias("error")), None)


def runtime_advance(previous: DataFrame, current: DataFrame, changes: DataFrame, acks: DataFrame) -> DataFrame:
    """Hashes of the current population: new ones where unchanged or acknowledged, else the previous one, and none
    for a new key that wasn't acknowledged."""
    pending = changes.select("pk").join(acks.where("status = 'ok'").select("pk").distinct(), "pk", "left_anti").withColumn("__held", F.lit(True))
    old = previous.select("pk", F.col("row_hash").alias("__old"))
    both = current.join(pending, "pk", "left").join(old, "pk", "left")
    return both.select("pk", F.when(F.col("__held"), F.col("__old")).otherwise(F.col("row_hash")).alias("row_hash")).where("row_hash IS NOT NULL")


def runtime_result(current: DataFrame, changes: DataFrame, acks: DataFrame, degraded: bool = False) -> DataFrame:
    """One row of a tick: changes as attempted, the population's size, DEGRADED if any acknowledgement is missing or
    the population couldn't be read."""
    counts = changes.agg(F.count_if(F.col("op") == "CREATED").alias("created"), F.count_if(F.col("op") == "UPDATED").alias("updated"))
    bad = acks.agg(F.count_if(F.col("status") != "ok").alias("bad"))
    size = current.agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(bad).join(size).select(F.when((F.col("bad") > 0) | F.lit(degraded), "DEGRADED").otherwise("HEALTHY").alias("state"), "created", "updated", "row_count")


def settings_changes(settings: DataFrame, key: str, order: str, ignored: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Settings rows that differ from the last row sent of their key, ignoring some columns; a failed send
    (``sent`` false) leaves the one before it as the last sent."""
    from pyspark.sql import Window

    fields = [c for c in settings.columns if c not in (*ignored, key, order, "sent")]
    hashed = settings.withColumn("__h", hashing.exact_row_hash(fields))
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sent = F.col("sent") if "sent" in settings.columns else F.lit(True)
    last = F.last(F.when(sent, F.col("__h")), ignorenulls=True).over(before)
    return hashed.withColumn("__last", last).where(~F.col("__h").eqNullSafe(F.col("__last"))).drop("__h", "__last")
