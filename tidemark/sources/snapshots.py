"""Versioned hash snapshots: Parquet below ``version=N`` and, written last, a manifest that makes it count."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "entity string, pk bigint, row_hash bigint"
FORMAT = 1


def _check(df: DataFrame) -> DataFrame:
    """(entity, n, checksum): a count and an order-free checksum."""
    return df.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("pk", "row_hash")).alias("checksum"))


def empty_snapshot(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def save_snapshot(snapshot: DataFrame, path: str, version: int) -> None:
    """Write a version. A crash midway leaves no manifest, so the version before stays the newest."""
    spark = snapshot.sparkSession
    data = f"{path}/data/version={version}"
    snapshot.select("entity", "pk", "row_hash").repartition("entity", "pk").sortWithinPartitions("entity", "pk").write.mode("overwrite").parquet(data)
    sums = _check(spark.read.schema(SCHEMA).parquet(data))
    manifest = sums.select(F.lit(FORMAT).alias("format"), F.lit(version).alias("version"), "entity", "n", "checksum")
    none = spark.createDataFrame([(FORMAT, version, None, 0, 0)], manifest.schema)
    manifest.unionByName(none).coalesce(1).write.mode("overwrite").json(f"{path}/manifest/version={version}")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions that have a manifest, newest first."""
    try:
        found = spark.read.schema("format int, version int, entity string, n bigint, checksum bigint").json(f"{path}/manifest")
        return sorted((r.version for r in found.select("version").distinct().collect()), reverse=True)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return []
        raise


def load_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version. An entity whose rows don't match its manifest starts empty; the others load."""
    known = versions(spark, path)
    version = version if version is not None else (known[0] if known else None)
    if version is None or version not in known:
        return empty_snapshot(spark)
    rows = spark.read.schema(SCHEMA).parquet(f"{path}/data/version={version}")
    told = spark.read.schema("format int, entity string, n bigint, checksum bigint").json(f"{path}/manifest/version={version}").where(f"format = {FORMAT} AND entity IS NOT NULL")
    sound = _check(rows).join(told, ["entity", "n", "checksum"]).select("entity")
    # A row an entity: without the broadcast, rows are dealt by entity, all keys of one into one task.
    return rows.join(F.broadcast(sound), "entity", "left_semi")


def manifest_text(spark: SparkSession, path: str, version: int) -> list[dict]:
    return [json.loads(r.value) for r in spark.read.text(f"{path}/manifest/version={version}").collect()]
