"""Forced resyncs: requests, cascades, forced snapshots, completions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.capture import EntitySpec

MAX_PKS = 1000


def validate_resync(requests: DataFrame, entities: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason) of rows (request_id, entity, pks array or null for the whole entity).

    A request with an unknown entity is rejected whole. A null entity means all of them.
    """
    pks = F.col("pks")
    known = F.col("entity").isNull() | F.col("entity").isin(list(entities))
    reason = (
        F.when(~known, "unknown entity")
        .when(F.size(pks) == 0, "no keys")
        .when(F.size(pks) > MAX_PKS, "too many keys")
        .when(F.exists(pks, lambda p: p.isNull()), "null key")
        .when(F.exists(pks, lambda p: p <= 0), "key not positive")
    )
    judged = requests.withColumn("reason", reason)
    bad = judged.where("reason IS NOT NULL").groupBy("request_id").agg(F.min("reason").alias("reason"))
    rejected = requests.join(bad, "request_id")
    accepted = requests.join(bad, "request_id", "left_anti")
    every = accepted.withColumn("entity", F.explode(F.when(F.col("entity").isNull(), F.array(*map(F.lit, entities))).otherwise(F.array("entity"))))
    return every, rejected


def merge_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(whole entities, (entity, pk) of the rest): requests of an entity unite; one for the whole absorbs the others."""
    whole = requests.where("pks IS NULL").select("entity").distinct()
    keys = requests.where("pks IS NOT NULL").select("entity", F.explode("pks").alias("pk")).distinct()
    return whole, keys.join(whole, "entity", "left_anti")


def cascade(specs: Sequence[EntitySpec], parent: str, parent_keys: DataFrame) -> DataFrame:
    """(entity, pk) of the rows of other entities that refer to the given keys (pk) of ``parent``; one level."""
    found = None
    for spec in specs:
        for ref in (p for p in spec.parents if p.entity == parent):
            keys = parent_keys.select(F.col("pk").alias("__pk")).distinct()
            own = spec.df.join(keys, F.col(ref.fk).cast("bigint") == F.col("__pk"), "left_semi").select(F.lit(spec.name).alias("entity"), F.col(spec.pk).cast("bigint").alias("pk"))
            found = own if found is None else found.unionByName(own)
    if found is None:
        return parent_keys.sparkSession.createDataFrame([], "entity string, pk bigint")
    return found.distinct()


def force_resync(snapshot: DataFrame, entity_whole: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """The snapshot (pk, row_hash) with ``forced``: all stored rows, or the given keys (pk), stored or not."""
    if entity_whole:
        return snapshot.select("pk", "row_hash", F.lit(True).alias("forced"))
    wanted = keys.select("pk").distinct().withColumn("forced", F.lit(True))
    return snapshot.select("pk", "row_hash").join(wanted, "pk", "full_outer").select("pk", "row_hash", F.coalesce("forced", F.lit(False)).alias("forced"))


def quiet_republish(snapshot: DataFrame, keys: DataFrame) -> DataFrame:
    """Force keys without a completion to follow; keys that aren't positive are ignored."""
    return force_resync(snapshot, keys=keys.where("pk > 0"))


def resync_complete(in_flight: DataFrame, results: DataFrame) -> DataFrame:
    """(request_id, entity, started_at, done_cycle) of requests (request_id, entity, cycle, started_at): the first
    cycle from the request's on that is HEALTHY with nothing failed or pending; null while there is none.

    Cycles of requests and clean cycles of an entity are merged once, newest first, each asking for the last clean one
    passed; requests join the answer of their cycle, so history isn't multiplied by requests."""
    asked = in_flight.select("entity", "cycle").distinct().withColumn("good", F.lit(None).cast("bigint"))
    good = results.where("state = 'HEALTHY' AND failed = 0 AND pending = 0").select("entity", "cycle", F.col("cycle").cast("bigint").alias("good")).distinct()
    newest = Window.partitionBy("entity").orderBy(F.desc("cycle"), F.desc_nulls_last("good")).rowsBetween(Window.unboundedPreceding, 0)
    answers = asked.unionByName(good).withColumn("__done", F.last("good", ignorenulls=True).over(newest)).where("good IS NULL").select(F.col("entity").alias("__e"), F.col("cycle").alias("__c"), "__done")
    both = in_flight.join(answers, (F.col("entity") == F.col("__e")) & (F.col("cycle") == F.col("__c")), "left")
    return both.groupBy("request_id", "entity").agg(F.min("started_at").alias("started_at"), F.min("__done").alias("done_cycle"))
