"""Op 7: mixing sources to target weights by Efraimidis-Spirakis sampling. DataFrame functions only.

A source's target is its share of the budget by weight, at most ``max_epochs`` times its size; what is cut off
goes to the other sources by weight until none is above. A target of one or more whole sizes takes the source's
documents that many times; what remains is a sample without replacement: each document has the key
``u ** (1 / w)`` of a uniform number from its id's hash and its quality weight, the keys are sorted within the
source, and a prefix sum of sizes fills the remaining budget.

The sort doesn't gather a source: keys fall into equal-width bins, bins have sums, and only within a bin are
rows ordered; a bin's prefix starts at the sum of the bins before it. Source and bin deal the rows out, so one
source with most of the rows is spread over all its bins. The tables of sources and of bins are the only ones
that are ordered as a whole; the former has one row a source.

The sample takes documents whole: one is taken if at least half of it fits, so a source misses its target by at
most half a document. Reruns and other partitionings give the same mix.

Cases: null text has size 0 and is taken 0 times its size; a null source is a source and sorts last; documents without
ids draw by their texts, so they are spread like others; repeated rows are tied and taken in turn; an empty table gives an
empty mix; further columns, of any name, are ignored by :func:`mix` and carried by :func:`mixed`. Very long texts are
measured where they are read; only :func:`mixed` moves them, once. Ids may be of any type that has a text form and an order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WS, cut, digest128, named, number_of, numbered, text_or_empty

#: Bins of the keys within a source; quality weights are at least this, which bounds the fullest bin's share.
BINS, LEAST_WEIGHT = 2048, 0.5
#: Sources up to which the table of cutoffs is sent to all tasks.
BROADCAST_SOURCES = 10_000


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{WS}]+")).cast("bigint")


def quality_weight(text: Column, size: Column) -> Column:
    """In [LEAST_WEIGHT, 1]: full for words of 3 to 9 bytes on average, the least far from that."""
    length = F.octet_length(text) / F.greatest(size, F.lit(1))
    far = F.greatest(F.lit(4.0) - length, length - F.lit(10.0), F.lit(0.0))
    return F.greatest(F.lit(LEAST_WEIGHT), 1 - far / 20)


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight: Column | None = None, seed: str = "mix", digests: bool = False) -> DataFrame:
    """(id, source, size, key) of every document; ``weight`` is a quality weight in [LEAST_WEIGHT, 1]. With ``digests``
    also that of the text, ``t``."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), text.alias("text"), *([weight.alias("w")] if weight is not None else []))
    rows = rows.withColumn("size", n_words(F.col("text")))
    w = F.col("w") if weight is not None else quality_weight(F.col("text"), F.col("size"))
    return rows.select("id", "source", "size", sample_key(F.col("id"), w, seed, F.col("text")).alias("key"), *([digest128(F.col("text")).alias("t")] if digests else []))


def sample_key(id_: Column, w: Column, seed: str, text: Column) -> Column:
    """u ** (1 / w), larger first; u in (0, 1) from 52 bits of a hash of seed and id, or of the text where there is no id."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(id_.cast("string"), F.md5(F.encode(text, "utf-8")))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return F.pow(u, F.lit(1.0) / w)


def targets(per_source: DataFrame, weights: Sequence[int] = (3, 1, 2), budget_percent: int = 150, max_epochs: int = 2) -> DataFrame:
    """(source, size, target) from (source, size). Weights repeat over the sources in code-point order, null last.

    In the order of cap / weight the capped sources come first. With the sizes and weights of those before
    a source, it is capped if its share of what they leave is above its cap. All in whole numbers, so
    the order of additions doesn't matter; one division makes the target.
    """
    big = "decimal(38,0)"
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weighed = per_source.withColumn("at", F.row_number().over(order))
    weighed = weighed.withColumn("w", F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.col("at") - 1, F.lit(len(weights))) + 1).cast("bigint"))
    everything = Window.partitionBy()
    ratio = Window.orderBy(F.col("size") / F.col("w"), "at").rowsBetween(Window.unboundedPreceding, -1)
    weighed = weighed.select(
        "*",
        F.sum("size").over(everything).cast(big).alias("all_size"),
        F.sum("w").over(everything).alias("all_w"),
        F.coalesce(F.sum("size").over(ratio), F.lit(0)).cast(big).alias("prior_size"),
        F.coalesce(F.sum("w").over(ratio), F.lit(0)).alias("prior_w"),
    )
    left = lambda s, c: s * budget_percent - c * (100 * max_epochs)  # noqa: E731  the budget that capped sources leave, times 100
    above = left(F.col("all_size"), F.col("prior_size")) * F.col("w") > F.col("size") * (100 * max_epochs) * (F.col("all_w") - F.col("prior_w"))
    weighed = weighed.withColumn("capped", above)
    weighed = weighed.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("size"))).over(everything), F.lit(0)).cast(big).alias("capped_size"),
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("w"))).over(everything), F.lit(0)).alias("capped_w"),
    )
    share = (left(F.col("all_size"), F.col("capped_size")) * F.col("w")).cast("double") / ((F.col("all_w") - F.col("capped_w")) * 100).cast("double")
    return weighed.select("source", "size", F.when(F.col("capped"), (F.col("size") * max_epochs).cast("double")).otherwise(share).alias("target"))


def plan(sized: DataFrame, **options) -> DataFrame:
    """(id, source, size, source_size, target, copies) of ``sizes``' rows, and their ``t``: how often the mix takes each
    document."""
    digest = [c for c in sized.columns if c == "t"]
    per_source = sized.groupBy("source").agg(F.sum("size").alias("size"))
    aims = targets(per_source, **options).withColumnsRenamed({"source": "t_source", "size": "source_size"})
    aims = aims.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
    aims = cut(aims.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")
    binned = sized.withColumn("bin", F.least(F.floor((1 - F.col("key")) * BINS), F.lit(BINS - 1)))
    sums = binned.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    before = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("b_source"), F.col("bin").alias("b_bin"), F.coalesce(F.sum("bin_size").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("source", "bin").orderBy(F.desc("key"), "id", *digest).rowsBetween(Window.unboundedPreceding, -1)
    rows = binned.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bin") == F.col("b_bin")))
    small = aims.count() <= BROADCAST_SOURCES
    rows = rows.join(F.broadcast(aims) if small else aims, F.col("source").eqNullSafe(F.col("t_source")))
    middle = F.col("start") + F.col("inside") + F.col("size") / 2
    return rows.select("id", "source", "size", "source_size", "target", (F.col("epochs") + F.when(middle <= F.col("rest"), 1).otherwise(0)).alias("copies"), *digest)


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight: Column | None = None, seed: str = "mix", **options) -> DataFrame:
    """id, size, source_size, target and taken (words that the mix takes, repeats counted) of every document."""
    sized = cut(sizes(docs, id_col, source_col, text_col, weight, seed), "mix-sizes")
    return plan(sized, **options).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weight: Column | None = None, seed: str = "mix", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns. Rows are told by id, source and
    text; rows that share all three are one document, taken as often as they are together.

    Texts move once, joined with the copies of their rows.
    """
    sized = cut(sizes(docs, id_col, source_col, text_col, weight, seed, digests=True), "mix-sizes")
    copies = plan(sized, **options).where("copies > 0 AND size > 0")
    copies = copies.groupBy(F.col("id").alias("m_id"), F.col("source").alias("m_source"), F.col("t").alias("m_t")).agg(F.sum("copies").alias("copies"))
    own, source = number_of(docs, id_col), number_of(docs, source_col).cast("string")
    match = own.eqNullSafe(F.col("m_id")) & source.eqNullSafe(F.col("m_source")) & (F.col("of") == F.col("m_t"))
    each = numbered(docs).withColumn("of", digest128(F.coalesce(number_of(docs, text_col).cast("string"), F.lit(""))))
    repeated = cut(sized.groupBy("id", "source", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("m_id"), F.col("source").alias("m_source"), F.col("t").alias("m_t")), "mix-repeated")
    if not repeated.isEmpty():
        one = [f"c{docs.columns.index(c)}" for c in (id_col, source_col)]
        each = each.join(repeated, match, "left_anti").unionByName(each.join(repeated, match, "left_semi").dropDuplicates([*one, "of"]))
    taken = each.join(copies, match)
    return named(taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))), docs)
