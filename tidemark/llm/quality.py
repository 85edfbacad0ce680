"""Op 4: quality rules whose thresholds adapt to each language and source.

Every document gets counts over its whole text. Rates of those counts go into mergeable quantile sketches, one
per (language, source): integer histograms whose bins keep the leading bits of a value, so the bins of two
sketches add up and any quantile is known to within a bin's width (1/64 of the value). A group of few documents
takes its language's merged sketch, a language of few documents that of all.

No cutoff is a fixed rate; each is made of the group's own quantiles (see ``RATES``):

* ``tail``: a high quantile q of the group. A group of which a good part is junk would make its own junk the norm, so
  the limit is at most ``GUARD`` times the median of that quantile over the language's groups, or ``GUARD`` times the
  group's own median where that is more, as in a source where high values are the rule.
* ``fence``: ``SPREAD`` interquartile distances beyond the median, above or below.

A count in a short text is a small sample, so a document fails a tail limit only if its count is ``SIGMAS`` standard
deviations of a Poisson count above what the limit gives for its length. Limits are joined to the documents by
(language, source); each document is then kept or not.

Cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of
their own; an empty table gives empty results; repeated rows are judged alike; further columns, of any name, are
carried by :func:`keep` and ignored by :func:`judge`. A value at a limit passes. A very long text is counted by one task,
with its words in memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut, named, number_of, numbered

SYMBOLS = b"#*$%&|<>"
#: Rates in parts of 10,000: (rate, count, of, kind, quantile in percent). A quantile of q leaves at most 100 - q
#: percent of a group to the rule. Junk full of symbols may be a twentieth of a source, so that quantile is lower.
RATES = (
    ("symbol_rate", "n_symbols", "word_chars", "tail", 90),
    ("repeat_rate", "n_repeat_words", "n_words", "tail", 99),
    ("dup_line_rate", "n_dup_lines", "n_words", "tail", 99),
    ("long_word_rate", "word_chars", "n_words", "fence above", 75),
    ("short_word_rate", "word_chars", "n_words", "fence below", 25),
)
#: Interquartile distances beyond the median, times of the other groups' or the own median, standard deviations, and
#: the documents that a sketch must hold to be used by itself.
SPREAD, GUARD, SIGMAS, MIN_DOCS = 6, 3, 3, 200
#: Leading bits of a value that a sketch keeps.
BITS = 7


def measure_text(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space only
    spaces = len(raw) - sum(map(len, words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(words), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    new = number.setdefault
    code = np.fromiter((new(w, len(number)) for w in words), np.int64, n)
    size = len(number)
    if size == n:
        return 0
    if size < 1 << 20:
        window = (code[:-2] * size + code[1:-1]) * size + code[2:]
    else:  # two steps, as three codes don't fit 64 bits
        pair = np.unique(code[:-2] * size + code[1:-1], return_inverse=True)[1]
        window = pair * size + code[2:]
    order = np.argsort(window, kind="stable")
    ordered = window[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, np.bool_)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(n, np.bool_)
    for k in range(3):
        inside[k : n - 2 + k] |= again
    return int(inside.sum())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents' columns under the names ``c0``, ``c1`` and so on, and their five counts. Each text goes to Python once."""
    at = docs.columns.index(text_col)
    source = numbered(docs)
    source = source.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))

    def run(batches):
        for batch in batches:
            found = [measure_text(t) for t in batch.column(at).to_pylist()]
            counts = [pa.array([x[k] for x in found], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[*batch.schema.names, *COUNTS])

    schema = T.StructType([*source.schema.fields, *[T.StructField(c, T.LongType()) for c in COUNTS]])
    return source.mapInArrow(run, schema)


def counted(docs: DataFrame, id_col: str, text_col: str, lang: str, source: str) -> DataFrame:
    """(id, lang, source, counts...) of every document, written."""
    picked = docs.select(F.col(id_col), F.col(lang), F.col(source), F.col(text_col))
    rows = measure(picked.toDF("id", "lang", "source", "text"))
    return cut(rows.select(F.col("c0").alias("id"), F.col("c1").alias("lang"), F.col("c2").alias("source"), *COUNTS), "quality-counts")


def bin_of(value: Column) -> Column:
    """The sketch's bin of an integer >= 0, named by its largest value: values under 2 ** BITS are exact, larger
    ones keep their BITS leading bits."""
    width = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))).cast("bigint")
    return (F.floor(value / width) + 1) * width - 1


def rate(count: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.floor(F.col(count) * 10_000 / F.col(of))).otherwise(0).cast("bigint")


def sketches(measured: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows (by..., rate, bin, n): sketches merge by adding ``n``. Documents without words are left out."""
    rates = F.array(*[F.struct(F.lit(name).alias("rate"), bin_of(rate(count, of)).alias("bin")) for name, count, of, _, _ in RATES])
    rows = measured.where("n_words > 0").select(*by, F.inline(rates))
    return rows.groupBy(*by, "rate", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return sketch.groupBy(*by, "rate", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: tuple[str, ...], percents: tuple[int, ...] = (25, 50, 75, 90, 99)) -> DataFrame:
    """(by..., rate, docs, q25, q50, ...): the bin that holds the document of that rank. The bins of a sketch are
    a bounded list (2 ** BITS and half as many per doubling), so they are gathered into an array."""
    bins = F.array_sort(F.collect_list(F.struct("bin", "n")))
    lists = sketch.groupBy(*by, "rate").agg(bins.alias("bins"), F.sum("n").alias("docs"))

    def at(percent: int) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("bigint").alias("bin"))
        step = lambda s, b: F.struct((s["seen"] + b["n"]).alias("seen"), F.when(s["bin"].isNull() & ((s["seen"] + b["n"]) * 100 >= F.col("docs") * percent), b["bin"]).otherwise(s["bin"]).alias("bin"))
        return F.aggregate("bins", start, step, lambda s: s["bin"])

    return lists.select(*by, "rate", "docs", *[at(p).alias(f"q{p}") for p in percents])


def thresholds(measured: DataFrame, spread: int = SPREAD, guard: int = GUARD, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per (lang, source) of measured documents, with a limit for each rate under the rate's name."""
    own = cut(sketches(measured, ("lang", "source")), "quality-sketches")
    names = ("q25", "q50", "q75", "q90", "q99")
    q_own = cut(quantiles(own, ("lang", "source")), "quality-quantiles")
    q_lang = quantiles(merge_sketches(own, ("lang",)), ("lang",)).select(F.col("lang").alias("l_lang"), F.col("rate").alias("l_rate"), *[F.col(c).alias(f"l_{c}") for c in ("docs", *names)])
    q_all = quantiles(merge_sketches(own, ()), ()).select(F.col("rate").alias("a_rate"), *[F.col(c).alias(f"a_{c}") for c in names])
    joined = q_own.join(q_lang, (F.col("rate") == F.col("l_rate")) & F.col("lang").eqNullSafe(F.col("l_lang"))).join(q_all, F.col("rate") == F.col("a_rate"))
    picked = [F.when(F.col("docs") >= min_docs, F.col(c)).when(F.col("l_docs") >= min_docs, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in names]
    joined = joined.select("lang", "source", "rate", *picked)
    # The median over a language's groups: a group that is mostly junk is one among many there.
    peers = joined.groupBy(F.col("lang").alias("p_lang"), F.col("rate").alias("p_rate")).agg(*[F.percentile(c, 0.5).alias(f"p_{c}") for c in ("q90", "q99")])
    joined = joined.join(peers, (F.col("rate") == F.col("p_rate")) & F.col("lang").eqNullSafe(F.col("p_lang")))
    limits = []
    for name, _, _, kind, percent in RATES:
        if kind == "tail":
            limit = F.least(F.col(f"q{percent}"), F.greatest(F.floor(F.col(f"p_q{percent}") * guard), F.col("q50") * guard))
        elif kind == "fence above":
            limit = F.col("q50") + (F.col("q75") - F.col("q50")) * spread
        else:
            limit = F.col("q50") - (F.col("q50") - F.col("q25")) * spread
        limits.append(F.max(F.when(F.col("rate") == name, limit)).cast("bigint").alias(name))
    return joined.groupBy("lang", "source").agg(*limits)


def within(sigmas: int = SIGMAS) -> Column:
    """Whether a measured document joined with its limits keeps them all."""
    ok = F.lit(True)
    for name, count, of, kind, _ in RATES:
        if kind == "tail":
            # In parts of 10,000; a Poisson count's variance is its mean, one at least.
            mean = F.col(name).cast("double") * F.col(of)
            over = F.col(count) * F.lit(10_000.0) - mean
            ok &= (over <= 0) | (over * over <= F.lit(float(sigmas * sigmas)) * 10_000 * F.greatest(mean, F.lit(10_000.0)))
        elif kind == "fence above":
            ok &= rate(count, of) <= F.col(name)
        else:
            ok &= rate(count, of) >= F.col(name)
    return ok


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source", **bounds: int) -> DataFrame:
    """id, the five counts, base_failed and kept of every document."""
    measured = counted(docs, id_col, text_col, lang, source)
    limits = thresholds(measured, **bounds).withColumnsRenamed({"lang": "l_lang", "source": "l_source"})
    own = measured.join(limits, F.col("lang").eqNullSafe(F.col("l_lang")) & F.col("source").eqNullSafe(F.col("l_source")), "left")
    return own.select(F.col("id").alias(id_col), *COUNTS, base_failed().alias("base_failed"), (~base_failed() & F.coalesce(within(), F.lit(False))).alias("kept"))


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source", **bounds: int) -> DataFrame:
    """The documents that pass, with all their columns. The texts don't move: each task measures its own again
    and looks up the limits, one row per (language, source)."""
    limits = cut(thresholds(counted(docs, id_col, text_col, lang, source), **bounds).withColumnsRenamed({"lang": "l_lang", "source": "l_source"}), "quality-limits")
    same = number_of(docs, lang).eqNullSafe(F.col("l_lang")) & number_of(docs, source).eqNullSafe(F.col("l_source"))
    return named(measure(docs, text_col).join(limits, same).where(~base_failed() & within()), docs)
