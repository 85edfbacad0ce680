"""Op 3: line deduplication against levelled sorted runs of line hashes.

The lines already seen are kept as runs: tables of (128-bit hash, documents), dealt into the same fixed hash buckets
and sorted by hash within each, so runs are merged bucket by bucket and nothing moves between tasks. A new batch
of documents counts its own lines, leaves out (merge anti join) those that the runs already hold as frequent, and
adds the rest as a run of level 0. When a level has ``fanout`` runs they are merged into one run of the next level.
Each run is written in two parts: hashes that reach the threshold, which later batches and merges are rid of, and the
others. How documents fall into batches changes the work, never the result: counts of all runs add up.

Lines of a frequent key lose all their occurrences. They are found by joining (text, position, hash) with the
frequent hashes; texts move once, with the list of positions to drop.

Cases: a null or empty text is one empty line; each row counts as a document, repeated rows too; null and shared ids
harm nothing, as positions belong to texts; an empty table gives an empty result; further columns are ignored. A very long
text is split into lines by one task and joined again by one; tied lines are one key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, digest128, scratch, text_or_empty

#: Frequent lines up to which they are sent to all tasks (24 bytes each); beyond, both sides are shuffled.
BROADCAST_ROWS = 100_000
#: Files that a batch holds at least to be made of whole files.
BATCH_FILES = 4
#: Spark's own limit of buckets.
MAX_BUCKETS = 100_000
SORTED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" \t\n\x0b\f\r")))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_counts(docs: DataFrame, text_col: str = "text", min_chars: int = 1) -> DataFrame:
    """(a, b, n): the number of documents that each line key's hash occurs in."""
    keys = F.filter(F.transform(lines_of(text_or_empty(text_col)), line_key), lambda k: F.char_length(k) >= min_chars)
    hashes = docs.select(F.inline(F.array_distinct(F.transform(keys, digest128))))
    return hashes.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


class LineRuns:
    """The levelled runs of one collection: bucketed tables whose files lie in the shared folder. :meth:`close` takes
    their names out of the catalogue."""

    def __init__(self, spark: SparkSession, threshold: int, fanout: int = 2, path: str | None = None):
        self.spark, self.threshold, self.fanout = spark, threshold, fanout
        self.path, self.name = path or scratch(spark, "line-runs"), f"line_runs_{uuid.uuid4().hex}"
        # A shuffle by hash deals as the buckets do, so a task of it writes its buckets whole.
        self.buckets = min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.levels: list[list[str]] = [[]]
        self.runs: list[str] = []
        # Runs are sorted as they were written; Spark is told to rely on it until close().
        self._sorted = spark.conf.get(SORTED_SCANS, "false")
        spark.conf.set(SORTED_SCANS, "true")

    def _write(self, counts: DataFrame) -> str:
        name = f"{self.name}_{len(self.runs):06d}"
        rows = counts.select("a", "b", "n", (F.col("n") >= self.threshold).alias("frequent"))
        writer = rows.write.format("parquet").partitionBy("frequent").bucketBy(self.buckets, "a", "b").sortBy("a", "b")
        writer.option("path", f"{self.path}/{name}").saveAsTable(name)
        self.runs.append(name)
        return name

    def _read(self, names: list[str], frequent: bool) -> DataFrame:
        # All columns stay: Spark sees the same buckets on both sides of a union only where nothing is projected below it.
        return reduce(DataFrame.unionByName, [self.spark.table(n).where(F.col("frequent") == frequent) for n in names])

    def new_counts(self, counts: DataFrame) -> DataFrame:
        """Counts of hashes that no run holds as frequent: a merge anti join."""
        return counts.join(self._read(self.runs, True).hint("merge"), ["a", "b"], "left_anti") if self.runs else counts

    def merged(self, names: list[str]) -> DataFrame:
        """The sum of runs, frequent hashes left out."""
        return self.new_counts(self._read(names, False).groupBy("a", "b").agg(F.sum("n").alias("n")))

    def add(self, counts: DataFrame) -> None:
        """Add a batch's :func:`line_counts`, without what is known as frequent, and merge full levels."""
        self.levels[0].append(self._write(self.new_counts(counts)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self.merged(self.levels[level])))
            self.levels[level] = []
            level += 1

    def frequent(self) -> DataFrame:
        """(a, b) of keys found in ``threshold`` documents or more, each once."""
        if not self.runs:
            return self.spark.createDataFrame([], "a bigint, b bigint")
        last = self.merged([n for level in self.levels for n in level]).where(F.col("n") >= self.threshold)
        return self._read(self.runs, True).select("a", "b").unionByName(last.select("a", "b")).distinct()

    def close(self) -> None:
        for name in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        self.spark.conf.set(SORTED_SCANS, self._sorted)


def batches_of(docs: DataFrame, n: int, id_col: str = "doc_id") -> list[DataFrame]:
    """``docs`` dealt into ``n`` batches: by file name where the rows come from many files, so that each batch reads its
    own files only; otherwise by a hash of the id, where each batch reads all and keeps its share."""
    by = F.col(id_col)
    if len(docs.inputFiles()) >= BATCH_FILES * n:
        try:
            named = docs.select(F.col("_metadata.file_name"))
            by = F.col("_metadata.file_name") if named.columns else by
        except AnalysisException:
            pass  # rows of a join or union have no file of their own
    return [docs.where(F.pmod(F.xxhash64(by), F.lit(n)) == k) for k in range(n)]


def drop_frequent(
    docs: DataFrame, batches: Iterable[DataFrame], id_col: str = "doc_id", text_col: str = "text", threshold: int = 10, min_chars: int = 1, fanout: int = 2
) -> DataFrame:
    """id, n_lines, n_dropped and the kept ``text`` of every document. ``batches`` are the documents' parts."""
    runs = LineRuns(docs.sparkSession, threshold, fanout)
    try:
        for batch in batches:
            runs.add(line_counts(batch, text_col, min_chars))
        frequent = cut(runs.frequent(), "frequent-lines")
    finally:
        runs.close()
    if frequent.count() <= BROADCAST_ROWS:
        frequent = F.broadcast(frequent)
    own = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    own = own.select("*", digest128(F.col("text")).alias("of"))
    # Equal texts drop the same lines, so positions belong to a text's hash: ids need not be distinct.
    keys = F.transform(lines_of(F.col("text")), lambda x, i: F.struct(i.alias("at"), digest128(line_key(x)).alias("key")))
    places = own.select(F.col("of.a").alias("ta"), F.col("of.b").alias("tb"), F.inline(keys)).select("ta", "tb", "at", "key.a", "key.b")
    drops = places.join(frequent, ["a", "b"]).groupBy("ta", "tb").agg(F.collect_set("at").alias("drop"))
    joined = own.join(drops, (F.col("of.a") == F.col("ta")) & (F.col("of.b") == F.col("tb")), "left")
    lines = F.col("lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("drop", F.array().cast("array<int>")))
    joined = joined.select("id", lines_of(F.col("text")).alias("lines"), "drop").select("id", "lines", kept.alias("kept"))
    return joined.select(
        F.col("id").alias(id_col),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("bigint").alias("n_dropped"),
        F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n").alias("text"),
    )
