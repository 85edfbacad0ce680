"""Op 12: shards by a hierarchical weighted hash tree.

Shards are the leaves of a tree of regions and racks; a node weighs as much as its shards. A key descends from the root:
at each level every child draws ``-ln(u) / weight``, with u in (0, 1) from a hash of the key and the child's name, and the
least draw wins, so a child is chosen as often as its weight says. A child's draw depends on its own name and weight
only. If weights change, a key therefore leaves its child only for one that gained or because its own one lost, and what
moves stays inside the subtrees whose weights changed. A shard added as a region of its own takes keys only into itself;
one added to a rack that exists draws keys into its region, and within it they are dealt anew by weight.

Slots number the rows of a shard without gaps, in the order of a hash, so reruns and other partitionings agree. No
shard is sorted as a whole: a shard's hashes fall into bins, bins have sums, and rows are ordered within a bin only. Rows
that are alike in everything that is returned are counted first and numbered together.

Cases: a null text has no bytes; a null key draws as an empty string, so such rows share a shard, as the law asks, but
not a bin; repeated rows get slots of their own; ties of the hash go by key, size and checksum; an empty table gives an
empty result; further columns, of any name, are ignored by :func:`place` and carried by :func:`sharded`; keys may be of
any type that has a text form. Very long texts are measured where they are read and don't move, but for :func:`sharded`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, number_of, numbered

#: Rows that a bin holds on average, bins of a shard at most, and alike rows that one task numbers.
BIN_ROWS, MAX_BIN_BITS, RUN_ROWS = 50_000, 16, 100_000
#: Bins up to which their starts are sent to all tasks.
BROADCAST_BINS = 50_000
HASH_BITS = 52


class Shard(NamedTuple):
    """Shards are numbered from 0 in the order of their list."""

    region: str
    rack: str
    weight: float = 1.0


def uniform(regions: int, racks: int, shards: int) -> list[Shard]:
    """A tree of equal shards: ``shards`` a rack, ``racks`` a region."""
    return [Shard(f"r{g}", f"k{r}") for g in range(regions) for r in range(racks) for _ in range(shards)]


def grown(tree: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own."""
    taken = {s.region for s in tree}
    region = next(name for k in range(len(tree) + 1) if (name := f"r{k}") not in taken)
    return [*tree, Shard(region, "k0", weight)]


def nodes_of(tree: Sequence[Shard]) -> dict[str, list[tuple[str, float, int | None]]]:
    """Children of every node that isn't a shard, by name, the root's under "": (name, weight, number of a shard).
    Nodes without weight are left out."""
    if any(s.weight < 0 for s in tree) or not any(s.weight for s in tree):
        raise ValueError("a tree needs weights of 0 or more, and one above 0")
    weights: dict[tuple[str, str], float] = defaultdict(float)
    found = defaultdict(list)
    for number, s in enumerate(tree):
        if s.weight:
            weights["", s.region] += s.weight
            weights[s.region, f"{s.region}/{s.rack}"] += s.weight
            found[f"{s.region}/{s.rack}"].append((f"{s.region}/{s.rack}/s{number}", s.weight, number))
    for (parent, name), weight in weights.items():
        found[parent].append((name, weight, None))
    return dict(found)


def hash_of(*parts: Column) -> Column:
    """52 bits of a hash, as a bigint."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")


def shard_of(key: Column, tree: Sequence[Shard], seed: str = "shard") -> Column:
    """The shard of a key, as a number from 0."""
    nodes = nodes_of(tree)
    text = F.coalesce(key.cast("string"), F.lit(""))
    # The whole tree is one constant: regions hold racks, racks hold shards.
    leaves = lambda rack: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(k).alias("below")) for n, w, k in nodes[rack]])
    racks = lambda region: F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), leaves(n).alias("below")) for n, w, _ in nodes[region]])
    below = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), racks(n).alias("below")) for n, w, _ in nodes[""]])
    for _ in range(3):
        draws = F.transform(below, lambda c: F.struct((-F.log((hash_of(F.lit(seed), c["name"], text) + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))) / c["weight"]).alias("draw"), c["name"], c["below"].alias("below")))
        below = F.array_min(draws)["below"]
    return below


def _bin_bits(rows: int, shards: int) -> int:
    return min(MAX_BIN_BITS, max(0, (rows // (BIN_ROWS * shards)).bit_length()))


def place(docs: DataFrame, tree: Sequence[Shard], larger: Sequence[Shard] | None = None, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, seed: str = "shard") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every document: its shard in ``tree`` and its place there,
    and its shard in the ``larger`` tree, else null. ``key`` is what decides, the id if it isn't given."""
    key = F.col(id_col) if key is None else key
    raw = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    later = shard_of(key, larger, seed) if larger else F.lit(None).cast("int")
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(raw) + F.lit(1)).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"), shard_of(key, tree, seed).alias("shard"), later.alias("grown_shard"))
    alike = cut(rows.groupBy("id", "size", "text_crc32", "shard", "grown_shard").agg(F.count(F.lit(1)).alias("n")), "shard-rows")
    return _slotted(alike, seed, len(tree)).select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _slotted(alike: DataFrame, seed: str, shards: int) -> DataFrame:
    """Rows of ``alike``, each as often as its ``n`` says, with their slots."""
    total = alike.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).first()
    bits = _bin_bits(total.rows, shards)
    order = hash_of(F.lit(seed + "-slot"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("size"), F.col("text_crc32"))
    binned = alike.withColumn("h", order).withColumn("bin", F.shiftright("h", HASH_BITS - bits))
    sums = binned.groupBy("shard", "bin").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "bin", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "bin").orderBy("h", "id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    rows = binned.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    rows = rows.join(F.broadcast(sums) if shards << bits <= BROADCAST_BINS else sums, ["shard", "bin"])
    rows = rows.withColumn("first", F.col("start") + F.col("inside")).withColumn("last", F.col("first") + F.col("n") - 1)
    if total.most and total.most > RUN_ROWS:
        # Long runs of alike rows are cut, and the pieces dealt out before they are expanded.
        pieces = rows.withColumn("first", F.explode(F.sequence("first", "last", F.lit(RUN_ROWS))))
        rows = pieces.withColumn("last", F.least("last", F.col("first") + RUN_ROWS - 1)).repartition("shard", "first")
    return rows.withColumn("slot", F.explode(F.sequence("first", "last")))


def sharded(docs: DataFrame, tree: Sequence[Shard], id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, seed: str = "shard", files: int = 1) -> DataFrame:
    """``docs`` with a column ``shard`` (in place of one of that name), dealt out to ``files`` partitions a shard, to be
    written with ``partitionBy("shard")``. Texts move once."""
    if key is not None:
        docs = docs.withColumn("__key", key)
    rows, own = numbered(docs), number_of(docs, "__key" if key is not None else id_col)
    spread = F.pmod(F.xxhash64(own.cast("string"), number_of(docs, text_col).cast("string")), F.lit(files))
    rows = rows.withColumn("shard", shard_of(own, tree, seed)).withColumn("file", spread).repartition(len(tree) * files, "shard", "file")
    kept = [(k, f) for k, f in enumerate(docs.schema.fields) if f.name not in ("shard", "__key")]
    return rows.select(*[F.col(f"c{k}").cast(f.dataType).alias(f.name) for k, f in kept], "shard")
