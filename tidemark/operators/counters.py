"""Counters made while rows pass on their way, so rows and counts come from one read, in a batch and in a stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.operators.stats import COMMAND_OUTCOMES, PUBLISH_OUTCOMES
from tidemark.scratch import written_over


def tallies(flags: Mapping[str, Column]) -> list[Column]:
    """A count per flag of the rows for which it holds."""
    return [F.count_if(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in flags.items()]


def counted(df: DataFrame, flags: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """(rows, counts): the same rows, and how many each flag holds for. The counts are there once an action has taken all
    rows, and are those of the first such action; one that stops early, as ``limit`` does, counts what it has seen."""
    seen = Observation()
    return df.observe(seen, *tallies(flags)), seen


def split(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """(kept, counts) of rows that none of ``reasons`` holds for; a row that goes counts for the first of its reasons,
    others count as ``kept``. No filter moves below the counting, so rows that go are counted as well."""
    held = {name: F.coalesce(flag, F.lit(False)) for name, flag in reasons.items()}
    flags, before = {}, F.lit(False)
    for name, flag in held.items():
        flags[name], before = flag & ~before, before | flag
    out = reduce(or_, held.values(), F.lit(False))
    rows, seen = counted(df, {**flags, "kept": ~out})
    return rows.where(~out), seen


def command_flags() -> dict[str, Column]:
    """Flags of ``operators.stats.command_counters`` over commands (outcome, reply)."""
    flags = {"consumed": F.lit(True), **{o: F.col("outcome") == o for o in COMMAND_OUTCOMES}}
    return {**flags, **{f"replies_{r}": F.col("reply") == r for r in ("published", "failed")}}


def publish_flags(families: Sequence[str]) -> dict[str, Column]:
    """A flag per family and outcome of attempts (family, outcome); the families are the caller's configuration."""
    return {f"{f}/{o}": (F.col("family") == f) & (F.col("outcome") == o) for f in families for o in PUBLISH_OUTCOMES}


def count_row(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """One row with a column per count."""
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"`{c}` bigint" for c in counts))


def publish_table(spark: SparkSession, counts: Mapping[str, int], enabled: Mapping[str, bool]) -> DataFrame:
    """(family, published, dropped, failed, enabled), a row per configured family, of counts by :func:`publish_flags`."""
    rows = [(f, *(counts.get(f"{f}/{o}", 0) for o in PUBLISH_OUTCOMES), on) for f, on in enabled.items()]
    return spark.createDataFrame(rows, "family string, published bigint, dropped bigint, failed bigint, enabled boolean")


def counted_into(stream: DataFrame, flags: Mapping[str, Column], sink: Callable[[DataFrame, int], None], counts: str, checkpoint: str, seconds: int | None = 60):
    """Run ``sink`` on every micro-batch and write the batch's counts below ``counts``, in a folder of the batch. Both come
    from one read of the batch. A batch that runs again replaces its counts, so their sums survive a restart; an empty
    batch has zeros. ``sink`` must take all rows of what it is given in its first action."""

    def batch_of(batch: DataFrame, number: int) -> None:
        rows, seen = counted(batch, flags)
        sink(rows, number)
        written_over(count_row(batch.sparkSession, seen.get).coalesce(1), f"{counts}/batch={number}")

    writer = stream.writeStream.foreachBatch(batch_of).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def batch_counts(spark: SparkSession, counts: str, names: Sequence[str]) -> DataFrame:
    """(batch, counts...) that :func:`counted_into` has written."""
    return spark.read.schema(", ".join([*[f"`{c}` bigint" for c in names], "batch bigint"])).parquet(counts)


class StreamTotals(StreamingQueryListener):
    """Running totals of what streams count by ``observe(name, ...)``, from the progress of their micro-batches: for streams
    that write to a sink of Spark's own. A batch reported again replaces its earlier report.

    Totals are of this driver's time, and progress comes shortly after its batch; counts that must outlive the driver are
    those of :func:`counted_into`.
    """

    def __init__(self) -> None:
        self._state: dict[tuple[str, str], tuple[int, dict[str, int], dict[str, int]]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.ended.discard(str(event.id))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            now = {k: int(v or 0) for k, v in row.asDict().items()}
            batch, last, done = self._state.get((str(p.id), name), (-1, {}, {}))
            if p.batchId > batch:
                done = {k: done.get(k, 0) + last.get(k, 0) for k in {**done, **last}}
            elif p.batchId < batch:
                continue
            self._state[str(p.id), name] = (p.batchId, now, done)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))

    def of(self, query_id: str, name: str) -> dict[str, int]:
        _, last, done = self._state.get((str(query_id), name), (-1, {}, {}))
        return {k: done.get(k, 0) + last.get(k, 0) for k in {**done, **last}}
