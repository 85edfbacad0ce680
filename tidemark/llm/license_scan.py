"""Op 5: license scans by an exact set-similarity join of text blocks with license templates. DataFrame functions only.

Base labels come from phrases, found wherever their words stand one after another. The method adds labels of
templates (:mod:`tidemark.llm.license_texts`): a text block has a template if it holds at least ``threshold`` of the
template's distinct tokens; a full text of more than LONG_WORDS words asks for LONG_THRESHOLD.

Blocks are runs of words of the whole text, line breaks or not. A template of ORDERED distinct tokens or more is sought in
windows of twice ``half`` words, each starting ``half`` words after the last; ``half`` is the least power of two that holds
all its words, so every run of ``half`` words lies whole in one, and templates may have any length. A shorter template says
little as a set of words: its blocks are the runs of ``1 / threshold`` times its words that start at one of them, and what
they hold of it must stand in its order.

The join: all template tokens are ordered by how often they occur in the whole corpus, rare ones first. For a template
of m tokens, a = :func:`least_of` must be shared.

* Prefix filter: as m - a tokens may be missing, l of the template's first m - a + l tokens are shared, for any l; a long
  template asks for more of them (:func:`asked_of`). These tokens are an inverted index, token -> template and position. The
  distinct tokens of the texts are joined with it first; the words of texts that hold l of a template's are exploded and
  joined with it, and blocks that hold l become candidates.
* Positional filter: a token that is missing among them leaves m less those that are missing within reach, which is the
  same count.
* Length filter: the block has a words or more.

Candidates are counted exactly. Templates are a fixed, short list (:data:`MAX_TEMPLATE_TOKENS` bounds the index), so index
and templates are broadcast. Only the hits of a text move, under a digest of it; of candidates up to BROADCAST_TEXTS texts the
places are sent to all tasks and texts don't move, beyond that those texts are joined with them.

All texts are split into words once, for what the result and the join need of a text: a short row each, which is written
(:func:`read_texts`). Only texts that are asked for more are split again. Splitting is most of the work, so a generator must not
be given a column of words: Spark infers filters from it and pushes them below the split, which then runs for each mention of it.

Cases: a null or empty text has no words, no places and no labels; repeated rows and ids are scanned alike; null ids
are ids; texts whose shares tie all have the label; an empty table gives an empty result; only the named columns are
read. A very long text is one array of words in one task; the places of a phrase are counted in one pass, however many.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut, digest128, text_or_empty
from tidemark.llm.license_texts import TEMPLATES

THRESHOLD = 0.85
#: Templates of more words are full texts, whose words other texts of their family share: they ask for more.
LONG_WORDS, LONG_THRESHOLD = 256, 0.95
#: Distinct tokens from which a template is a set; below, their order counts. Words of the shortest half window.
ORDERED, LEAST_HALF = 10, 16
#: Tokens of all templates together at most.
MAX_TEMPLATE_TOKENS = 100_000
#: Texts with hits up to which they are sent to all tasks.
BROADCAST_TEXTS = 100_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = re.compile(WORD)


def lowered(text: Column) -> Column:
    """:func:`ascii_lower`, faster on texts that are ASCII throughout."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))


def pieces_of(lower: Column) -> Column:
    """Words of a lower-case text, with an empty string at either end where there is a separator."""
    return F.split(lower, NOT_WORD)


def ends_of(split: Column) -> tuple[Column, Column]:
    """How many empty strings :func:`pieces_of` has before and after the words, 0 or 1."""
    head = F.when(F.get(split, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(split) > 1) & (F.get(split, F.size(split) - 1) == ""), 1).otherwise(0)
    return head, tail


def words_of(split: Column) -> Column:
    """:func:`pieces_of` without the empty strings at either end."""
    head, tail = ends_of(split)
    return F.slice(split, head + 1, F.size(split) - head - tail)


def template_words(text: str) -> list[str]:
    return _WORD.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


class Shape(NamedTuple):
    """How a template is sought: in windows of twice ``half`` words, or in runs of ``run`` words in its own order."""

    half: int | None
    run: int | None


def shape_of(text: str, threshold: float = THRESHOLD) -> Shape:
    words = template_words(text)
    if len(set(words)) < ORDERED:
        return Shape(None, math.floor(len(words) / threshold))
    return Shape(max(LEAST_HALF, 1 << (len(words) - 1).bit_length()), None)


def least_of(text: str, threshold: float = THRESHOLD) -> int:
    """How many of its distinct tokens a block must have of a template."""
    words = template_words(text)
    return math.ceil((max(threshold, LONG_THRESHOLD) if len(words) > LONG_WORDS else threshold) * len(set(words)))


def token_counts(read: DataFrame) -> DataFrame:
    """(token, n): how often each token occurs in all texts of :func:`read_texts`."""
    return read.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def template_tokens(templates: Sequence[tuple[str, str]]) -> list[str]:
    tokens = sorted({t for _, text in templates for t in template_words(text)})
    if len(tokens) > MAX_TEMPLATE_TOKENS:
        raise ValueError(f"{len(tokens)} template tokens; {MAX_TEMPLATE_TOKENS} at most")
    return tokens


def frequency_order(read: DataFrame, templates: Sequence[tuple[str, str]]) -> list[str]:
    """All tokens of the templates, rare ones first; as many rows come to the driver as templates and phrases have tokens."""
    tokens = template_tokens(templates)
    seen = {r.token: r.n for r in token_counts(read).collect()} if tokens else {}
    return sorted(tokens, key=lambda t: (seen.get(t, 0), t))


def phrase_places(pieces: Column, phrase: str) -> Column:
    """(n, first, last): how many places a phrase has, and the first and last word number, from 0, where it starts, in one
    pass. :func:`pieces_of` a text in; the phrase is words joined by one space."""
    joined = F.concat(F.lit(" "), F.trim(F.array_join(pieces, " ")), F.lit(" "))
    # A place is a space before the phrase; the parts between places hold the words before each, the first after a space.
    parts = F.split(joined, f" (?={re.escape(phrase)} )", -1)
    counts = F.transform(parts, lambda p: F.size(F.split(p, " ")))
    none = F.lit(None).cast("int")
    zero = F.struct(F.lit(-1).alias("words"), F.lit(0).alias("n"), none.alias("first"), none.alias("last"))
    step = lambda acc, c: F.struct((acc["words"] + c).alias("words"), (acc["n"] + 1).alias("n"), F.coalesce(acc["first"], acc["words"] + c).alias("first"), (acc["words"] + c).alias("last"))
    return F.aggregate(F.slice(counts, 1, F.size(counts) - 1), zero, step)


def asked_of(least: int) -> int:
    """How many of a template's rarest tokens a candidate must have."""
    return 1 + least // 20


def prefix_index(order: Sequence[str], templates: Sequence[tuple[str, str]], threshold: float) -> tuple[list[tuple], list[tuple]]:
    """(token, at, no, asked, least, half, run): the prefix tokens of each template, their place in it from 1 and how its
    blocks lie; and (no, label, tokens, m, least, len, ordered) of each template: its
    tokens in its own order, the words of a block, and whether their order counts."""
    rank, index, rows = {t: k for k, t in enumerate(order)}, [], []
    for no, (label, text) in enumerate(templates):
        shape, seq = shape_of(text, threshold), list(dict.fromkeys(template_words(text)))
        m, least = len(seq), least_of(text, threshold)
        asked = asked_of(least)
        index += [(t, at, no, asked, least, shape.half, shape.run) for at, t in enumerate(sorted(seq, key=rank.__getitem__)[: m - least + asked], 1)]
        rows.append((no, label, seq, m, least, shape.run or 2 * shape.half, shape.run is not None))
    return index, rows


def read_texts(docs: DataFrame, phrases: Mapping[str, str], templates: Sequence[tuple[str, str]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, n_words, found, tokens) of every text: its digest, the phrases it has with their places, and those of its words,
    each as often as it occurs, that templates or phrases have."""
    text, known = text_or_empty(text_col), sorted({*template_tokens(templates), *(w for p in phrases for w in p.split(" ") if _WORD.fullmatch(w))})
    rows = docs.select(F.col(id_col).alias("id"), digest128(text).alias("t"), pieces_of(lowered(text)).alias("pieces"))
    # As text: the words need no quoting, and a call to the JVM for each takes seconds.
    listed = ", ".join(f"'{w}'" for w in known) or "NULL"
    rows = rows.select("*", F.expr(f"filter(pieces, w -> w IN ({listed}))").alias("tokens"))
    head, tail = ends_of(F.col("pieces"))

    def places(phrase):
        # Only texts that hold every word of a phrase are searched for its places.
        maybe = F.lit(True)
        for word in filter(None, phrase.split(" ")):
            maybe &= F.array_contains("tokens", word)
        return F.when(maybe, phrase_places(F.col("pieces"), phrase))

    found = F.array(*[F.struct(F.lit(label).alias("label"), places(p).alias("at")) for p, label in phrases.items()]).cast("array<struct<label: string, at: struct<words: int, n: int, first: int, last: int>>>")
    return rows.select("id", "t", (F.size("pieces") - head - tail).cast("bigint").alias("n_words"), F.filter(found, lambda x: x["at"]["n"] > 0).alias("found"), "tokens")


INDEX = "token string, at int, no int, asked int, least int, half int, run int"


def asked_texts(read: DataFrame, index: Sequence[tuple]) -> DataFrame:
    """(t, nos): the digests of texts of :func:`read_texts` that hold enough of the prefixes of the templates ``nos``."""
    told = F.broadcast(read.sparkSession.createDataFrame(index, INDEX))
    held = read.select("t", "n_words", F.explode(F.array_distinct("tokens")).alias("token")).join(told, "token").where("n_words >= least")
    held = held.groupBy("t", "no").agg(F.size(F.collect_set("at")).alias("shared"), F.max("asked").alias("asked"))
    return held.where("shared >= asked").groupBy("t").agg(F.collect_list("no").alias("nos"))


def candidates(texts: DataFrame, index: Sequence[tuple]) -> DataFrame:
    """(t, no, start) of the blocks that hold enough of a template's prefix, of (t, nos, pieces). Every start of a run is one;
    only those at a token of the template count later."""
    told = F.broadcast(texts.sparkSession.createDataFrame(index, INDEX))
    head, tail = ends_of(F.col("pieces"))
    places = F.transform("pieces", lambda w, k: F.struct((k - head).alias("pos"), w.alias("token")))
    # Counted below the generator, as it would otherwise hand all words on with each of them.
    near = texts.select("t", "nos", "pieces", (F.size("pieces") - head - tail).alias("n")).select("t", "nos", "n", F.inline(places))
    near = near.join(told, "token").where(F.array_contains("nos", F.col("no")))
    last = F.floor(F.col("pos") / F.col("half")).cast("int")
    windows = F.transform(F.sequence(F.greatest(last - 1, F.lit(0)), last), lambda k: k * F.col("half"))
    near = near.withColumn("start", F.explode(F.when(F.col("run").isNull(), windows).otherwise(F.sequence(F.greatest(F.col("pos") - F.col("run") + 1, F.lit(0)), F.col("pos")))))
    near = near.where(F.col("n") - F.col("start") >= F.col("least"))
    found = near.groupBy("t", "no", "start").agg(F.size(F.collect_set("at")).alias("shared"), F.max("asked").alias("asked"))
    return found.where("shared >= asked").select("t", "no", "start")


def template_hits(docs: DataFrame, read: DataFrame, index: Sequence[tuple], rows: Sequence[tuple], text_col: str = "text") -> DataFrame:
    """(t, labels, share) of every text, by its digest, that has a template: the labels and the best share. ``read``:
    :func:`read_texts`; ``index`` and ``rows``: :func:`prefix_index`."""
    text = text_or_empty(text_col)

    def texts_of(wanted: DataFrame) -> DataFrame:
        """(t, the other column of ``wanted``, pieces)."""
        told = F.broadcast(wanted) if wanted.count() <= BROADCAST_TEXTS else wanted
        return docs.select(digest128(text).alias("t"), text.alias("text")).join(told, "t").select(*wanted.columns, pieces_of(lowered(F.col("text"))).alias("pieces"))

    asked = cut(asked_texts(read, index), "license-asked")
    near = cut(candidates(texts_of(asked), index).groupBy("t").agg(F.collect_list(F.struct("no", "start")).alias("at")), "license-candidates")
    forms = F.broadcast(docs.sparkSession.createDataFrame(rows, "no int, label string, seq array<string>, m int, least int, len int, ordered boolean"))
    each = texts_of(near).select("t", "at", words_of(F.col("pieces")).alias("words")).select("t", "words", F.inline("at")).join(forms, "no")
    raw = F.slice("words", F.col("start") + 1, F.col("len"))
    places = F.filter(F.transform("seq", lambda t: F.array_position(raw, t)), lambda k: k > 0)
    run = F.array_contains("seq", F.get("words", F.col("start"))) & (places == F.array_sort(places))
    both = F.when(~F.col("ordered"), F.size(F.array_intersect("seq", raw))).when(run, F.size(places))
    sure = each.select("t", "label", "m", "least", both.alias("both")).where("both >= least")
    return sure.groupBy("t").agg(F.collect_set("label").alias("labels"), F.max(F.col("both") / F.col("m")).alias("share"))


def scan(
    docs: DataFrame,
    phrases: Mapping[str, str],
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels and score of every document.

    ``phrases``: lower-case words joined by spaces, to label. ``score``: 1 with a base label, else the best share.
    """
    read = cut(read_texts(docs, phrases, templates, id_col, text_col), "license-texts")
    index, forms = prefix_index(frequency_order(read, templates), templates, threshold)
    hits = cut(template_hits(docs, read, index, forms, text_col), "license-hits")
    if hits.count() <= BROADCAST_TEXTS:
        hits = F.broadcast(hits)
    rows = read.join(hits, "t", "left")
    own = F.transform("found", lambda x: x["label"])
    every = F.array_sort(F.array_union(own, F.coalesce("labels", F.array().cast("array<string>"))))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.aggregate("found", F.lit(0).cast("bigint"), lambda n, x: n + x["at"]["n"]).alias("n_base"),
        F.array_min(F.transform("found", lambda x: x["at"]["first"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("found", lambda x: x["at"]["last"])).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("found") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
