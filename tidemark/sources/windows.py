"""Key ranges: the envelope of a table and its snapshot, and closed windows over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookups import bracket_lookup

MAX_WINDOWS = 1_000_000


def pk_envelope(current: DataFrame, snapshot: DataFrame, pk: str, snapshot_pk: str = "pk") -> DataFrame:
    """One row (lo, hi) over both, so a deleted extreme lies inside; an empty side doesn't count."""
    bounds = lambda df, c: df.agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    both = bounds(current, pk).unionByName(bounds(snapshot, snapshot_pk))
    return both.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def window_bounds(lo: int | None, hi: int | None, rows: int) -> list[tuple[int, int]]:
    """Consecutive closed ranges of ``rows`` keys; none if there are no keys, an error beyond MAX_WINDOWS."""
    if rows < 1:
        raise ValueError("rows must be positive")
    if lo is None or hi is None or hi < lo:
        return []
    n = (hi - lo) // rows + 1
    if n > MAX_WINDOWS:
        raise ValueError(f"{n} windows; {MAX_WINDOWS} at most")
    return [(a, min(a + rows - 1, hi)) for a in range(lo, hi + 1, rows)]


def plan_windows(envelope: DataFrame, rows: int) -> DataFrame:
    """(window_no, lo, hi) of an envelope, computed in DECIMAL so keys near the limits of BIGINT don't overflow."""
    wide = envelope.where("hi >= lo").select(F.col("lo").cast("decimal(38,0)").alias("a"), F.col("hi").cast("decimal(38,0)").alias("b"))
    n = F.floor((F.col("b") - F.col("a")) / F.lit(rows)).cast("bigint") + 1
    sound = F.when(n <= MAX_WINDOWS, n).otherwise(F.raise_error(F.lit("too many windows")).cast("bigint"))
    each = wide.select("a", "b", F.explode(F.sequence(F.lit(0).cast("bigint"), sound - 1)).alias("window_no"))
    start = F.col("a") + F.col("window_no").cast("decimal(19,0)") * F.lit(rows).cast("decimal(10,0)")
    return each.select("window_no", start.cast("bigint").alias("lo"), F.least(start + F.lit(rows - 1), F.col("b")).cast("bigint").alias("hi"))


def jdbc_predicates(lo: int, hi: int, pk: str, rows: int) -> list[str]:
    return [f"{pk} BETWEEN {a} AND {b}" for a, b in window_bounds(lo, hi, rows)]


def jdbc_table(spark: SparkSession, url: str, table: str, pk: str, lo: int, hi: int, rows_per_window: int = 500_000, fetch_size: int = 10_000, **properties: str) -> DataFrame:
    """A table over JDBC, a partition per key window. Partitions are read in transactions of their own."""
    return spark.read.jdbc(url, table, predicates=jdbc_predicates(lo, hi, pk, rows_per_window), properties={"fetchsize": str(fetch_size), **properties})


def window_row_counts(keys: DataFrame, windows: DataFrame, pk: str = "pk") -> DataFrame:
    """(window_no, n) of keys by window. Windows don't overlap and may have any length, gaps between them, or one key each;
    keys outside all windows don't count, empty windows have 0."""
    steps = windows.select(F.col("lo").alias("from"), F.col("hi").alias("to"), F.col("window_no").alias("value"))
    placed = bracket_lookup(keys.select(F.col(pk).alias("__pk")), steps, "__pk")
    counts = placed.where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return windows.join(counts, F.col("window_no") == F.col("value"), "left").select("window_no", F.coalesce("n", F.lit(0)).alias("n"))


def targeted_keys(df: DataFrame, keys: DataFrame, pk: str) -> DataFrame:
    """Rows of given keys."""
    return df.join(keys.select(F.col(keys.columns[0]).alias("__pk")), F.col(pk) == F.col("__pk"), "left_semi")
