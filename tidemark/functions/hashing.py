"""Row, child and entity hashes, and order-free hashes of lists."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_hash(cols: Sequence[str | Column], algo: str = "crc32") -> Column:
    """32-bit hash of the columns joined by commas, as BIGINT. Nulls are skipped, so it is blind to where a null
    stands and to commas in values; it is for compatibility. ``algo``: ``crc32`` or ``md5`` (its first 32 bits)."""
    joined = F.concat_ws(",", *[_col(c).cast("string") for c in cols])
    if algo == "crc32":
        return F.crc32(F.encode(joined, "utf-8"))
    if algo == "md5":
        return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("bigint")
    raise ValueError(f"unknown algorithm {algo}")


def exact_row_hash(cols: Sequence[str | Column]) -> Column:
    """64-bit hash that tells null from every value and columns apart."""
    return F.xxhash64(*[x for c in cols for x in (_col(c).isNull(), _col(c))])


def child_hash(children: DataFrame, fk: str, cols: Sequence[str | Column], name: str = "child_hash") -> DataFrame:
    """(fk, hash): XOR of the compatible row hashes; pairs of equal rows cancel."""
    return children.groupBy(fk).agg(F.bit_xor(row_hash(cols)).alias(name))


def exact_child_hash(children: DataFrame, fk: str, cols: Sequence[str | Column], name: str = "child_hash") -> DataFrame:
    """(fk, hash): sum of exact row hashes as DECIMAL. Order doesn't matter and multiplicity does; equal edits of
    several rows don't cancel. Tasks add up their own rows first."""
    return children.groupBy(fk).agg(F.sum(exact_row_hash(cols).cast("decimal(20,0)")).alias(name))


def fold_hash(primary: Column, children: Sequence[Column]) -> Column:
    """XOR of the primary row's hash and its children's; a missing child counts as 0."""
    out = primary
    for c in children:
        out = out.bitwiseXOR(F.coalesce(c, F.lit(0)))
    return out


def exact_fold_hash(primary: Column, children: Sequence[Column]) -> Column:
    return F.xxhash64(primary, *[x for c in children for x in (c.isNull(), c)])


def perturb(h: Column) -> Column:
    """A value that always differs from ``h``: its lowest bit flipped."""
    return h.bitwiseXOR(F.lit(1))


def stamp_hash(h: Column, stamp: Column) -> Column:
    """Mix a state stamp into a hash unless it is 0."""
    return F.when(stamp != 0, F.xxhash64(h, stamp)).otherwise(h)


_FNV_START, _FNV_PRIME = 0xCBF29CE484222325, 0x100000001B3  # fixed values of FNV-1a, 64 bits


def _fnv_bytes(state: np.ndarray, data: np.ndarray) -> np.ndarray:
    for k in range(data.shape[1]):
        state = (state ^ data[:, k].astype(np.uint64)) * np.uint64(_FNV_PRIME)
    return state


#: Texts that are left at a byte position below which they are finished one by one.
_FEW_TEXTS = 16


def _fnv_texts(state: np.ndarray, values: pd.Series) -> np.ndarray:
    """States after the UTF-16 bytes of texts. The texts of a batch lie in one buffer, longest first, and all that reach a
    byte position are hashed there together; the few that are much longer than the others are finished alone."""
    raw = [b"" if v is None else v.encode("utf-16-le", "surrogatepass") for v in values]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    order = np.argsort(-length, kind="stable")
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    start = (np.cumsum(length) - length)[order]
    falling = -length[order]
    out, left, at = state[order], np.searchsorted(falling, 0), 0
    while left >= _FEW_TEXTS:
        out[:left] = (out[:left] ^ buffer[start[:left] + at]) * np.uint64(_FNV_PRIME)
        at += 1
        left = np.searchsorted(falling[:left], -at)
    for k in range(left):
        h = int(out[k])
        for b in raw[order[k]][at:]:
            h = ((h ^ b) * _FNV_PRIME) & 0xFFFFFFFFFFFFFFFF
        out[k] = h
    back = np.empty_like(out)
    back[order] = out
    return back


def _fnv_column(state: np.ndarray, values: pd.Series, kind: T.DataType) -> np.ndarray:
    if isinstance(kind, T.StringType):
        return _fnv_texts(state, values)
    known = values.notna().to_numpy()
    if isinstance(kind, T.BooleanType):
        data = values.fillna(False).astype(np.uint8).to_numpy().reshape(-1, 1)
    elif isinstance(kind, T.DoubleType):
        data = values.fillna(0.0).to_numpy(np.float64).view(np.uint8).reshape(-1, 8)
    else:
        signed = values.fillna(0).astype(np.int64).to_numpy()
        if isinstance(kind, T.IntegerType):  # an int is extended with zeros, not with its sign
            signed = signed & 0xFFFFFFFF
        data = np.ascontiguousarray(signed).view(np.uint8).reshape(-1, 8)
    return np.where(known, _fnv_bytes(state, data), state)


def fnv1a64(df: DataFrame, cols: Sequence[str], name: str = "fnv") -> DataFrame:
    """``df`` with the 64-bit FNV-1a of ``cols`` in order: 8 little-endian bytes a number, 2 bytes a UTF-16 unit of a
    string, one byte a boolean, nothing for null. A pandas function, as SQL multiplication overflows."""
    kinds = [df.schema[c].dataType for c in cols]

    @F.pandas_udf("bigint")
    def run(frame: pd.DataFrame) -> pd.Series:
        state = np.full(len(frame), _FNV_START, np.uint64)
        for c, kind in zip(frame.columns, kinds):
            state = _fnv_column(state, frame[c], kind)
        return pd.Series(state.view(np.int64))

    return df.withColumn(name, run(F.struct(*cols)))


#: Order in which a line's attributes are hashed.
ATTRIBUTES = ("FIRE", "WATER", "WIND", "EARTH", "HOLY", "UNHOLY")


def canonical_offer(line: Column) -> Column:
    """A line of an offer list as a struct that sorts canonically: price, trader, enchant (nulls first), count,
    currency, item, then the rest; the attribute map becomes an array in a fixed order."""
    enchant = line["enchant_level"]
    return F.struct(
        line["unit_price"].alias("unit_price"),
        line["trader_id"].alias("trader_id"),
        enchant.isNotNull().alias("enchanted"),
        enchant.alias("enchant_level"),
        line["count"].alias("count"),
        line["currency_id"].alias("currency_id"),
        line["item_id"].alias("item_id"),
        line["packaged"].alias("packaged"),
        F.array(*[F.try_element_at(line["attributes"], F.lit(a)) for a in ATTRIBUTES]).alias("attributes"),
    )


def offers_hash(offers: Column) -> Column:
    """Hash of an array of offer lines that doesn't depend on their order; size and every field count."""
    lines = F.array_sort(F.transform(offers, canonical_offer))
    flat = F.transform(lines, lambda x: F.concat_ws(",", *[F.coalesce(x[f].cast("string"), F.lit("~")) for f in ("unit_price", "trader_id", "enchant_level", "count", "currency_id", "item_id", "packaged")], F.array_join(F.transform(x["attributes"], lambda a: F.coalesce(a.cast("string"), F.lit("~"))), "/")))
    return F.xxhash64(F.size(offers), F.array_join(flat, ";"))
