"""A snapshot store whose versions are a base and the deltas since: a cycle writes what has changed, not all keys.

Bases and deltas are Parquet files dealt into the same buckets by entity and key, so a version is read without an exchange
of the base: the deltas, the latest of a key, are shuffled to the base's buckets or sent to them. A version counts from
the moment its manifest is there, which is written last; writing a version again replaces it.

While rows are written they are counted (an observation), and the counts are held against what the files have afterwards: a
difference fails the write. A frame that gives other rows each time it is computed can be told by counting it once more
before the write (``twice``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import remove
from tidemark.sources.snapshots import empty_snapshot

ROWS = "entity string, pk bigint, row_hash bigint, gone boolean"
MANIFEST = "format int, kind string, version bigint, buckets int, n bigint, checksum bigint"
FORMAT = 1


class SnapshotDrift(Exception):
    """What was written isn't what was counted."""


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("entity", "pk", "row_hash", "gone")), F.lit(0).cast("bigint")).alias("checksum")]


class SnapshotLog:
    """The versions below ``path``, which all executors share. Version 0 is the empty snapshot, unless it is written."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def write_base(self, snapshot: DataFrame, version: int, twice: bool = False) -> None:
        """All of a snapshot (entity, pk, row_hash)."""
        self._write(snapshot.select("entity", "pk", "row_hash", F.lit(False).alias("gone")), "base", version, twice)

    def write_delta(self, changes: DataFrame, version: int, twice: bool = False) -> None:
        """Acknowledged changes (entity, pk, op, row_hash), a row a key, as the version after all before it."""
        self._write(changes.select("entity", "pk", "row_hash", (F.col("op") == "DELETED").alias("gone")), "delta", version, twice)

    def manifests(self) -> list[dict]:
        """What counts, oldest first. One row a version comes to the driver."""
        try:
            told = self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").json(f"{self.path}/manifest")
            return sorted((r.asDict() for r in told.where(f"format = {FORMAT}").collect()), key=lambda r: (r["version"], r["kind"] == "base"))
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def newest(self) -> int:
        return max((m["version"] for m in self.manifests()), default=0)

    def parts(self, version: int | None = None) -> tuple[dict | None, list[dict]]:
        """The newest base up to a version, and the deltas after it."""
        known = [m for m in self.manifests() if version is None or m["version"] <= version]
        base = max((m for m in known if m["kind"] == "base"), key=lambda m: m["version"], default=None)
        return base, [m for m in known if m["kind"] == "delta" and (base is None or m["version"] > base["version"])]

    def load(self, version: int | None = None, check: bool = False) -> DataFrame:
        """(entity, pk, row_hash) of a version, else of the newest. With ``check`` files are held against their manifests."""
        base, deltas = self.parts(version)
        if check:
            for m in [*([base] if base else []), *deltas]:
                self._verify(m, m)
        rows = self._open(base).drop("gone") if base else empty_snapshot(self.spark)
        if not deltas:
            return rows
        changed = None
        for m in deltas:
            one = self._open(m).withColumn("v", F.lit(m["version"]).cast("bigint"))
            changed = one if changed is None else changed.unionByName(one)
        if len(deltas) > 1:
            changed = changed.groupBy("entity", "pk").agg(F.max_by(F.struct("row_hash", "gone"), "v").alias("x")).select("entity", "pk", "x.*")
        live = changed.where("NOT gone").select("entity", "pk", "row_hash")
        return rows.join(changed.select("entity", "pk"), ["entity", "pk"], "left_anti").unionByName(live) if base else live

    def compact(self, version: int | None = None) -> None:
        """Make a version, else the newest, a base of its own."""
        version = self.newest() if version is None else version
        base, deltas = self.parts(version)
        if deltas:
            self.write_base(self.load(version), version)

    def retain(self, versions: int) -> None:
        """Remove what the newest ``versions`` versions don't need. Their manifests go first."""
        known = self.manifests()
        kept = sorted({m["version"] for m in known})[-versions:]
        if not kept:
            return
        base, _ = self.parts(kept[0])
        for m in known:
            if base and (m["version"] < base["version"] or (m["version"] == base["version"] and m["kind"] == "delta")):
                remove(self.spark, self._manifest(m["kind"], m["version"]))
                remove(self.spark, self._folder(m["kind"], m["version"]))

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.path}/{kind}/version={version}"

    def _manifest(self, kind: str, version: int) -> str:
        return f"{self.path}/manifest/{kind}-{version}"

    def _write(self, rows: DataFrame, kind: str, version: int, twice: bool) -> None:
        before = rows.agg(*_sums()).first().asDict() if twice else None
        told, name = Observation(), f"snapshot_{uuid.uuid4().hex}"
        remove(self.spark, self._manifest(kind, version))
        dealt = rows.repartition(self.buckets, "entity", "pk").observe(told, *_sums())
        try:
            # Tables of the catalogue are the way to bucketed files; the files stay when the table goes.
            dealt.write.mode("overwrite").format("parquet").bucketBy(self.buckets, "entity", "pk").sortBy("entity", "pk").option("path", self._folder(kind, version)).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        made = {"format": FORMAT, "kind": kind, "version": version, "buckets": self.buckets} | told.get
        if before is not None and before != told.get:
            raise SnapshotDrift(f"{kind} {version}: the frame had {before}, then {told.get}")
        self._verify(made, told.get)
        self.spark.createDataFrame([tuple(made[c.split()[0]] for c in MANIFEST.split(", "))], MANIFEST).coalesce(1).write.mode("overwrite").json(self._manifest(kind, version))

    def _verify(self, m: dict, told: dict) -> None:
        held = self._open(m).agg(*_sums()).first()
        if (held.n, held.checksum) != (told["n"], told["checksum"]):
            raise SnapshotDrift(f"{m['kind']} {m['version']}: {told['n']} rows were counted, the files hold {held.n}, or others")

    def _open(self, m: dict) -> DataFrame:
        name = f"snapshot_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE `{name}` ({ROWS}) USING parquet CLUSTERED BY (entity, pk) SORTED BY (entity, pk) INTO {m['buckets']} BUCKETS LOCATION '{self._folder(m['kind'], m['version'])}'")
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE `{name}`")
