"""Op 9: near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

1. Each document becomes the set of its distinct word shingles (64-bit hashes). Documents of equal sets are one
   class, so thousands of copies are one row from here on.
2. A class has 128 minima. They are hashed in bands: classes that share a band's bucket are candidates. The low
   4 bits of each minimum are packed into a signature; matching bits, corrected for chance matches, estimate
   the similarity, and candidates that are far below the threshold go no further.
3. A bucket doesn't list its pairs. First every member is confirmed against the bucket's most central member
   (the one in the fullest buckets) and the links are joined into components. Then, only in buckets that still
   hold several components, members of different components are confirmed. Two exact bounds come before that:
   members are left out whose shingles that no other candidate has make the threshold unreachable, and pairs
   whose parity sketches differ in more bits than the threshold lets the sets differ in shingles.
4. Components come from minimum labels with pointer jumping; documents get their class's component.

A link of similarity at the threshold shares no bucket with a chance below one in a million; all links between
candidates are confirmed on the whole sets.

Cases: null and empty texts have no set and link with nothing; a text of fewer words than a shingle is one
shingle; rows that share id and text are one document; rows without an id are never a representative of others that
have one; an empty table gives an empty result; further columns, of any name, are ignored by :func:`components` and
carried by :func:`keep_one`, which tells rows by id and text, so null and shared ids harm no other row. Ids are whole
numbers. A very long text has as many shingles as words, held by one task at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, digest128, named, number_of, numbered, text_or_empty

MINIMA, LOW_BITS = 128, 4
PARITY_BITS = 1024
#: Standard deviations below the threshold at which an estimate ends a candidate pair.
MARGIN = 5.5
#: Ids up to which a list is sent to all tasks; a longer one is joined by shuffling.
BROADCAST_IDS = 50_000

_RANDOM = np.random.default_rng(9)
_XOR = _RANDOM.integers(0, 1 << 32, MINIMA, np.uint32)
_TIMES = _RANDOM.integers(0, 1 << 31, MINIMA, np.uint32) * np.uint32(2) + np.uint32(1)
_ODD = _RANDOM.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def bands_for(threshold: float) -> tuple[int, int]:
    """(bands, rows): the most selective bands that miss a pair at the threshold less than once in a million."""
    for rows in range(16, 1, -1):
        bands = MINIMA // rows
        if (1 - threshold**rows) ** bands < 1e-6:
            return bands, rows
    return MINIMA, 1


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    of = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    codes = np.fromiter(map(of.__getitem__, words), np.uint64, n)
    if n < size:
        return mix((codes * _ODD[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = codes[: n - size + 1] * _ODD[0]
    for k in range(1, size):
        total = total + codes[k : n - size + 1 + k] * _ODD[k]
    return np.unique(mix(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    """MINIMA 32-bit minima over a set's hashes."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(short), 2048):
        np.minimum(least, ((short[k : k + 2048, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    return least


def band_hashes(least: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = least[: bands * rows].reshape(bands, rows).astype(np.uint64)
    return mix((grid * _ODD[:rows]).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))


def signature(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima, each minimum mixed first, packed into 64-bit words."""
    per = 64 // LOW_BITS
    low = (mix(least.astype(np.uint64)) & np.uint64((1 << LOW_BITS) - 1)).reshape(-1, per)
    return (low << (np.arange(per, dtype=np.uint64) * np.uint64(LOW_BITS))).sum(axis=1, dtype=np.uint64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Of PARITY_BITS bits each is set if an odd number of the hashes falls on it. The bits in which two sketches
    differ are at most as many as the hashes that only one of the sets has."""
    odd = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def describe(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, digests: bool = False) -> DataFrame:
    """id, n_shingles and, unless the set is empty, class ``c`` (128-bit digest of the set), band hashes, signature
    and parity sketch; with ``digests`` also that of the text, ``t``."""
    bands, rows = bands_for(threshold)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), *([digest128(text_or_empty(text_col)).alias("t")] if digests else []))

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            count = np.zeros(len(texts), np.int64)
            digest, band, sig, odd = (np.zeros((len(texts), n), np.int64) for n in (2, bands, MINIMA * LOW_BITS // 64, PARITY_BITS // 64))
            for k, text in enumerate(texts):
                s = shingles(text, size)
                count[k] = len(s)
                if len(s):
                    digest[k] = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                    least = minima(s)
                    band[k] = band_hashes(least, bands, rows).view(np.int64)
                    sig[k] = signature(least).view(np.int64)
                    odd[k] = parity(s)
            none = count == 0
            c = pa.StructArray.from_arrays([pa.array(digest[:, 0]), pa.array(digest[:, 1])], ["a", "b"], mask=pa.array(none))
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())) for x in (band, sig, odd)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count), c, *lists, *batch.columns[2:]], names=["id", "n", "c", "bands", "sig", "odd", *batch.schema.names[2:]])

    schema = "id bigint, n bigint, c struct<a: bigint, b: bigint>, bands array<bigint>, sig array<bigint>, odd array<bigint>"
    return source.mapInArrow(run, schema + (", t struct<a: bigint, b: bigint>" if digests else ""))


def sets_of(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(c, shingles) of classes (c, rep), from the texts of their representatives; one row a class."""
    ids = classes.select(F.col("rep").alias("__rep")).distinct()
    small = classes.count() <= BROADCAST_IDS
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.join(F.broadcast(ids) if small else ids, F.col("id").eqNullSafe(F.col("__rep")), "left_semi")

    def run(batches):
        for batch in batches:
            found = [shingles(t, size) for t in batch.column(1).to_pylist()]
            found = [s for s in found if len(s)]
            digest = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64) for s in found], np.int64).reshape(-1, 2)
            at = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            c = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(digest[:, k])) for k in (0, 1)], ["a", "b"])
            yield pa.RecordBatch.from_arrays([c, pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], names=["c", "shingles"])

    found = source.mapInArrow(run, "c struct<a: bigint, b: bigint>, shingles array<bigint>")
    return found.join(classes.select("c"), "c", "left_semi").groupBy("c").agg(F.first("shingles").alias("shingles"))


def estimate(x: Column, y: Column) -> Column:
    """Similarity by bit counts of two signatures: the share of equal low bits, less those equal by chance."""
    differ = F.lit(0)
    for k in range(MINIMA * LOW_BITS // 64):
        v = x[k].bitwiseXOR(y[k])
        any_bit = v
        for s in range(1, LOW_BITS):
            any_bit = any_bit.bitwiseOR(F.shiftrightunsigned(v, s))
        differ = differ + F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1 / (1 << LOW_BITS)
    return (1 - differ / MINIMA - chance) / (1 - chance)


def sketch_distance(x: Column, y: Column) -> Column:
    """Bits in which two parity sketches differ: a lower bound of how many shingles only one of the sets has."""
    differ = F.lit(0)
    for k in range(PARITY_BITS // 64):
        differ = differ + F.bit_count(x[k].bitwiseXOR(y[k]))
    return differ


def least_estimate(threshold: float) -> float:
    chance = 1 / (1 << LOW_BITS)
    p = threshold + (1 - threshold) * chance
    return threshold - MARGIN * math.sqrt(p * (1 - p) / MINIMA) / (1 - chance)


def could_link(nx: Column, ny: Column, percent: int) -> Column:
    return 100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of classes whose full sets reach ``percent``."""
    both = pairs.join(sets.withColumnsRenamed({"c": "x", "shingles": "sx"}), "x").join(sets.withColumnsRenamed({"c": "y", "shingles": "sy"}), "y")
    both = both.select("x", "y", F.size("sx").alias("nx"), F.size("sy").alias("ny"), F.size(F.array_intersect("sx", "sy")).cast("bigint").alias("both"))
    return both.where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))).select("x", "y")


def connected(edges: DataFrame) -> DataFrame:
    """(c, label): the smallest node reachable over the edges (x, y), for every node of an edge.

    Each round takes the smallest label among neighbours, then the label of that label; rounds grow with the
    logarithm of a component's width in practice. Labels are written each round, so lineage stays short.
    """
    ways = cut(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = cut(ways.groupBy(F.col("x").alias("c")).agg(F.min("y").alias("m")).select("c", F.least("c", "m").alias("label")), "labels")
    while True:
        near = ways.join(labels.select(F.col("c").alias("y"), "label"), "y").groupBy(F.col("x").alias("c")).agg(F.min("label").alias("m"))
        step = labels.join(near, "c").select("c", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("c").alias("label"), F.col("label").alias("further"))
        step = cut(step.join(jump, "label", "left").select("c", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        labels = step.select("c", "label")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links) and kept (it is that id)."""
    described = cut(describe(docs, id_col, text_col, size, percent / 100), "minhash")
    rows = described.select("id", "n", "c")
    own = _labelled(docs, described, id_col, text_col, size, percent)
    names = own.groupBy("label").agg(F.min("rep").alias("component"))
    own = own.join(names, "label").select("c", "component")
    found = rows.join(own, "c", "left")
    component = F.coalesce("component", "id")
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _labelled(docs: DataFrame, described: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(c, rep, label) of every class: its smallest id, and the smallest class reachable over links."""
    threshold = percent / 100
    classes = described.where(F.col("c").isNotNull()).groupBy("c").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("odd").alias("odd"))
    classes = cut(classes, "classes")
    members = classes.select("c", "n", "sig", F.posexplode("bands").alias("band", "h"))
    sizes = members.groupBy("band", "h").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = cut(members.join(sizes, ["band", "h"]), "buckets")

    central = members.groupBy("c").agg(F.sum(F.log2("members")).alias("weight"))
    pivots = members.join(central, "c").groupBy("band", "h").agg(F.max(F.struct("weight", "c", "n", "sig")).alias("p"))
    near = (estimate(F.col("sig"), F.col("p.sig")) >= least_estimate(threshold)) & could_link(F.col("n"), F.col("p.n"), percent)
    stars = members.join(pivots, ["band", "h"]).where((F.col("c") != F.col("p.c")) & near)
    stars = cut(stars.select(F.least("c", "p.c").alias("x"), F.greatest("c", "p.c").alias("y")).distinct(), "stars")

    candidates = cut(members.select("c").distinct().join(classes.select("c", "rep", "n", "odd"), "c"), "candidates")
    sets = cut(sets_of(docs, candidates, id_col, text_col, size), "sets")
    edges = cut(confirmed(stars, sets, percent), "links")
    labels = connected(edges)

    more = _between(members, labels, candidates, sets, stars, threshold, percent)
    if more is not None:
        more = cut(confirmed(more, sets, percent), "links")
        if not more.isEmpty():
            labels = connected(edges.unionByName(more))
    return classes.select("c", "rep").join(labels, "c", "left").select("c", "rep", F.coalesce("label", "c").alias("label"))


def _between(members: DataFrame, labels: DataFrame, candidates: DataFrame, sets: DataFrame, tested: DataFrame, threshold: float, percent: int) -> DataFrame | None:
    """Candidate pairs (x, y) of different components that aren't tested yet, or None."""
    labelled = members.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    # The label of most members of a bucket is its main one; a bucket of one label is done.
    counted = labelled.groupBy("band", "h", "label").agg(F.count(F.lit(1)).alias("n_label"))
    open_ = counted.groupBy("band", "h").agg(F.max(F.struct("n_label", "label")).alias("main"), F.count(F.lit(1)).alias("n_labels")).where("n_labels > 1")
    held = cut(labelled.join(open_.select("band", "h", F.col("main.label").alias("main")), ["band", "h"]), "open-buckets")
    # Shingles that only one candidate of the open buckets has can be in no intersection.
    inside = held.select("c").distinct()
    rare = sets.join(inside, "c", "left_semi").select("c", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).where("n = 1")
    own = rare.groupBy("c").agg(F.count(F.lit(1)).alias("own"))
    room = candidates.join(inside, "c", "left_semi").join(own, "c", "left").select("c", "odd", (F.col("n") - F.coalesce("own", F.lit(0))).alias("room"), F.col("n").alias("n_room"))
    room = room.where(100 * F.col("room") >= percent * F.col("n_room")).drop("n_room")
    held = cut(held.join(room, "c"), "open-members")
    if held.isEmpty():
        return None
    x = held.where(F.col("label") != F.col("main")).select("band", "h", *[F.col(k).alias(f"x_{k}") for k in ("c", "n", "sig", "label", "main", "room", "odd")])
    y = held.select("band", "h", *[F.col(k).alias(f"y_{k}") for k in ("c", "n", "sig", "label", "room", "odd")])
    most = F.least("x_room", "y_room")
    fits = (
        (F.col("x_label") != F.col("y_label"))
        & ((F.col("y_label") == F.col("x_main")) | (F.col("x_c") < F.col("y_c")))
        & could_link(F.col("x_n"), F.col("y_n"), percent)
        & (100 * most >= percent * (F.col("x_n") + F.col("y_n") - most))
        & (sketch_distance(F.col("x_odd"), F.col("y_odd")) * (100 + percent) <= (100 - percent) * (F.col("x_n") + F.col("y_n")))
        & (estimate(F.col("x_sig"), F.col("y_sig")) >= least_estimate(threshold))
    )
    same = (x["band"] == y["band"]) & (x["h"] == y["h"])
    pairs = x.join(y, same & fits).select(F.least("x_c", "y_c").alias("x"), F.greatest("x_c", "y_c").alias("y")).distinct()
    return pairs.join(tested, ["x", "y"], "left_anti")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The documents of which one a component stays, with all their columns: the one of the smallest id, without any
    id or among texts of one id that of the smallest digest. Rows that share id and text stay once."""
    described = cut(describe(docs, id_col, text_col, size, percent / 100, digests=True), "minhash")
    own = _labelled(docs, described, id_col, text_col, size, percent).select("c", "label")
    rows = described.where(F.col("c").isNotNull()).select("c", F.struct(F.col("id").isNull().alias("no_id"), "id", "t").alias("row"))
    own = rows.groupBy("c").agg(F.min("row").alias("first")).join(own, "c")
    first = own.groupBy("label").agg(F.min("first").alias("kept"))
    dropped = rows.join(own.join(first, "label").select("c", "kept"), "c").where(F.col("row") != F.col("kept"))
    dropped = cut(dropped.select(F.col("row.id").alias("__id"), F.col("row.t").alias("__t")).distinct(), "near-dropped")
    repeated = cut(rows.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("row.id").alias("__id"), F.col("row.t").alias("__t")), "near-repeated")

    text = F.coalesce(number_of(docs, text_col).cast("string"), F.lit(""))
    left = numbered(docs).withColumns({"own": number_of(docs, id_col).cast("bigint"), "of": digest128(text)})

    def match(keys, kind):
        small = keys.count() <= BROADCAST_IDS
        return left.join(F.broadcast(keys) if small else keys, F.col("own").eqNullSafe(F.col("__id")) & (F.col("of") == F.col("__t")), kind)

    left = match(dropped, "left_anti")
    if not repeated.isEmpty():
        left = match(repeated, "left_anti").unionByName(match(repeated, "left_semi").dropDuplicates(["own", "of"]))
    return named(left, docs)
