"""Op 6: exact deduplication by 128-bit content hash, with the bytes compared inside groups.

Rows are grouped by (hash, text): the hash deals the work out and the grouping compares the bytes of texts
that share it, so texts that merely collide stay apart. Each task pre-aggregates, so a group of any size
reaches the shuffle as one row a task. Where no hash has two texts, which is checked, documents find their
group by hash alone and the texts don't move again; otherwise those few hashes are joined by text as well.

Cases: a null text equals an empty one; a null id never wins unless its whole group has none; repeated rows
of the id that stays all count as kept; an empty table gives an empty result; more columns, of any name, are carried
by :func:`deduplicate` and ignored by :func:`groups_of`. Very long texts are hashed whole and move as any other: once a
task and distinct text. Ids may be of any type that has an order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, named, number_of, numbered, text_or_empty


def content_hash(c: Column) -> Column:
    return F.unhex(F.md5(c))


def groups_of(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    normalise: Callable[[Column], Column] = ascii_lower,
    hash128: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256 of the normalised text. ``keep``: ``min`` or ``max`` id."""
    best = {"min": F.min, "max": F.max}[keep]
    rows = docs.select(F.col(id_col).alias("id"), normalise(text_or_empty(text_col)).alias("norm"))
    rows = rows.withColumn("hash", hash128(F.col("norm")))
    groups = rows.groupBy("hash", "norm").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # One row a distinct text, without the text.
    groups = cut(groups.select("hash", F.sha2(F.encode("norm", "utf-8"), 256).alias("text_sha256"), "keep_id", "group_size"), "exact-groups")
    clash = groups.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash")
    if clash.isEmpty():
        found = rows.drop("norm").join(groups, "hash")
    else:
        apart = groups.join(clash, "hash", "left_anti")
        found = rows.drop("norm").join(apart, "hash").unionByName(_by_text(rows.join(clash, "hash", "left_semi"), best).drop("norm"))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def _by_text(rows: DataFrame, best) -> DataFrame:
    """The same columns for rows whose hash several texts share, joined by the text itself."""
    groups = rows.groupBy("hash", "norm").agg(best("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.withColumn("text_sha256", F.sha2(F.encode("norm", "utf-8"), 256))
    return rows.join(groups, ["hash", "norm"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The documents that stay, all their columns, one row a group of equal texts.

    Only ids move besides the texts of the grouping: a row stays unless its id and text are among those dropped.
    Rows that share id and text are one document and stay once, so of texts without any id one row stays.
    """
    verdict = groups_of(docs, id_col, text_col, keep)
    dropped = verdict.where(~F.col("kept")).select(F.col(id_col).alias("id"), F.col("text_sha256").alias("of")).distinct()
    repeated = verdict.where("kept").groupBy(F.col(id_col).alias("id"), "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows, own = numbered(docs), number_of(docs, id_col)
    rows = rows.withColumn("sha", F.sha2(F.encode(ascii_lower(F.coalesce(number_of(docs, text_col).cast("string"), F.lit(""))), "utf-8"), 256))
    left = rows.join(dropped, own.eqNullSafe(F.col("id")) & (F.col("sha") == F.col("of")), "left_anti")
    if not repeated.isEmpty():
        left = left.dropDuplicates([f"c{docs.columns.index(id_col)}", "sha"])
    return named(left, docs)
