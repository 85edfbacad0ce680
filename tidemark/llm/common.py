"""Helpers shared by the training-data operators: tables by name, columns free of clashes, ASCII text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.scratch import cut
from tidemark.scratch import shared_path as scratch

__all__ = ["LOWER", "UPPER", "WS", "ascii_lower", "cut", "digest128", "named", "number_of", "numbered", "scratch", "table", "text_or_empty"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, as a Java and Python character class body.
WS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def digest128(c: Column) -> Column:
    """128 bits of two seeded 64-bit hashes as a struct; equal values have equal digests."""
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(7), c).alias("b"))


def numbered(docs: DataFrame) -> DataFrame:
    """The same rows with the columns ``c0``, ``c1`` and so on, so that no name of theirs clashes with a helper's."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def number_of(docs: DataFrame, name: str) -> Column:
    """The column of :func:`numbered` that ``name`` became."""
    return F.col(f"c{docs.columns.index(name)}")


def named(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of :func:`numbered` under the names, and with the types, that ``docs`` has."""
    return rows.select(*[F.col(f"c{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(docs.schema.fields)])
