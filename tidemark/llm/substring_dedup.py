"""Op 10: substring deduplication by content-defined chunks.

A gear hash rolls over the UTF-8 bytes of each text; where chosen bits of it are zero a chunk ends. As the hash
sees only the last few bytes, an insertion moves boundaries near itself and no others, so a passage is cut alike
wherever it stands. Chunks are compared by a 128-bit digest: those found in two places or more, of one document or of
several, are repeats. Neighbouring repeats of a document form a span; reported are spans of ``min_words`` words, and
those of ``min_chars`` characters whose words are longer than LONG_WORD on average, as in texts without spaces. A span
shorter than its passage by a chunk at either end is normal, so both bounds are well below the passages sought.

Each task pre-aggregates digests to (smallest id, places), so a chunk that many documents share reaches the
shuffle once a task; the join back is an ordinary equi-join, whose hot keys Spark splits.

Cases: null and empty texts have no chunks; rows that share id and text are one document, those that share only one
of them are several; documents without an id come before all others, in the order of their texts' digests, and of
documents that share an id none is the earlier; an empty table gives an empty result; further columns are ignored. Ids are
whole numbers. A very long text is chunked by one task, whose rows are handed on 50,000 chunks at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the gear hash that must be zero at a cut: once in 16 bytes, decided by the last 16 bytes.
CUT_BITS = 0b1111 << 12
MIN_BYTES, MAX_BYTES = 24, 256
#: Words of a reported span at least; or characters, if its words have more than LONG_WORD of them on average.
MIN_WORDS, MIN_CHARS, LONG_WORD = 16, 64, 12
#: Documents without an id are numbered below this, by their texts' digests.
_NO_ID = -(1 << 62)


def _gear() -> np.ndarray:
    """256 fixed 32-bit numbers, from a hash of each byte."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=10) for b in range(256)], np.uint32)


GEAR = _gear()


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """For each byte the sum over the last 32 bytes of GEAR[byte] << age, doubled up: 1, 2, 4, 8, 16, 32 bytes."""
    h = GEAR[raw]
    for span in (1, 2, 4, 8, 16):
        older = h[:-span] << np.uint32(span)
        h = h.copy()
        h[span:] += older
    return h


def cuts(raw: np.ndarray, min_bytes: int = MIN_BYTES, max_bytes: int = MAX_BYTES, bits: int = CUT_BITS) -> list[int]:
    """Ends of the chunks of a UTF-8 text; each is at the start of a character or the end of the text."""
    n = len(raw)
    if not n:
        return []
    starts = np.flatnonzero((raw & 0xC0) != 0x80)
    wanted = np.flatnonzero((gear_hashes(raw) & np.uint32(bits)) == 0) + 1
    wanted = np.append(starts, n)[np.searchsorted(starts, wanted)].tolist()
    found, last = [], 0
    for end in [*wanted, n]:
        while end - last > max_bytes:
            at = last + max_bytes
            while raw[at] & 0xC0 == 0x80:
                at -= 1
            found.append(at)
            last = at
        if end - last >= min_bytes or (end == n and end > last):
            found.append(end)
            last = end
    return found


def chunk_text(text: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Digests of a text's chunks, their ends in code points and the words that start in each."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    ends = cuts(raw)
    digest = xxhash.xxh3_128_digest
    digests = [digest(data[a:b]) for a, b in zip([0, *ends], ends)]
    at = np.array(ends, np.int64) - 1
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    begins = ~space
    begins[1:] &= space[:-1]
    return digests, np.cumsum((raw & 0xC0) != 0x80)[at], np.diff(np.cumsum(begins)[at], prepend=0)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, t, text) of every document with a text: a number for its id and the digest of its text."""
    t = F.xxhash64(F.col(text_col).cast("string"))
    none = F.lit(-(1 << 63)) + F.shiftrightunsigned(t, 2)
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), none).alias("id"), t.alias("t"), F.col(text_col).cast("string").alias("text")).where("text <> ''")


def chunks(texts: DataFrame) -> DataFrame:
    """A row per chunk of :func:`texts_of`: id, t, start, end (code points), words, digest halves a and b."""

    def run(batches):
        for batch in batches:
            held, size = [], 0
            for doc, t, text in zip(*[batch.column(k).to_pylist() for k in range(3)]):
                held.append((doc, t, *chunk_text(text)))
                size += len(held[-1][2])
                if size > 50_000:
                    yield _rows(held)
                    held, size = [], 0
            if held:
                yield _rows(held)

    return texts.mapInArrow(run, "id bigint, t bigint, start int, end int, words int, a bigint, b bigint")


def _rows(held: list) -> pa.RecordBatch:
    halves = np.frombuffer(b"".join(b"".join(x[2]) for x in held), "<i8").reshape(-1, 2)
    many = [len(x[2]) for x in held]
    columns = [
        *[np.repeat(np.array([x[k] for x in held], np.int64), many) for k in (0, 1)],
        np.concatenate([np.concatenate([[0], x[3][:-1]]) for x in held]).astype(np.int32),
        *[np.concatenate([x[k] for x in held]).astype(np.int32) for k in (3, 4)],
        np.ascontiguousarray(halves[:, 0]),
        np.ascontiguousarray(halves[:, 1]),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "t", "start", "end", "words", "a", "b"])


def _spans(docs: DataFrame, id_col: str, text_col: str, min_words: int, min_chars: int) -> DataFrame:
    texts = texts_of(docs, id_col, text_col)
    if not texts.groupBy("id", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        texts = texts.dropDuplicates(["id", "t"])
    # Both uses of the chunks make them anew: a table of them is estimated, not measured, to be larger than the texts' files.
    rows = chunks(texts)
    places = rows.groupBy("a", "b").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    found = rows.join(places.where("n > 1").drop("n"), ["a", "b"]).repartition("id", "t")
    again = F.row_number().over(Window.partitionBy("id", "t", "a", "b").orderBy("start")) > 1
    found = found.select("id", "t", "start", "end", "words", "first", ((F.col("first") < F.col("id")) | again).alias("again"))
    w = Window.partitionBy("id", "t").orderBy("start")
    found = found.withColumn("begins", F.coalesce((F.lag("end").over(w) != F.col("start")).cast("int"), F.lit(1))).withColumn("run", F.sum("begins").over(w))
    spans = found.groupBy("id", "t", "run").agg(
        F.min("start").cast("bigint").alias("start"),
        F.max("end").cast("bigint").alias("end"),
        F.sum("words").alias("n_words"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.array_sort(F.collect_set(F.when(F.col("first") >= _NO_ID, F.col("first")))).alias("first_ids"),
        F.max("again").alias("dropped"),
    )
    chars = F.col("end") - F.col("start")
    return spans.where((F.col("n_words") >= min_words) | ((chars >= min_chars) & (chars > LONG_WORD * F.col("n_words"))))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Repeated spans of all documents: id, start, end (code points), n_words, n_chunks, first_ids (smallest ids of
    documents that hold the chunks) and dropped (whether any of it was in an earlier document, or earlier in this one)."""
    spans = _spans(docs, id_col, text_col, min_words, min_chars)
    return spans.select(F.when(F.col("id") >= _NO_ID, F.col("id")).alias(id_col), "start", "end", "n_words", "n_chunks", "first_ids", "dropped")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, text) of every document without its dropped spans; texts that are null or empty stay so."""
    spans = _spans(docs, id_col, text_col, min_words, min_chars).where("dropped")
    cuts_ = spans.groupBy(F.col("id").alias("s_id"), F.col("t").alias("s_t")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    own = texts_of(docs, id_col, text_col).join(cuts_, (F.col("id") == F.col("s_id")) & (F.col("t") == F.col("s_t")), "left")
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("kept"))
    step = lambda s, c: F.struct(c["end"].alias("at"), F.concat(s["kept"], F.substring(F.col("text"), s["at"].cast("int") + 1, (c["start"] - s["at"]).cast("int"))).alias("kept"))
    left = F.aggregate("cuts", none, step, lambda s: F.concat(s["kept"], F.substring(F.col("text"), s["at"].cast("int") + 1, F.char_length("text"))))
    own = own.select(F.when(F.col("id") >= _NO_ID, F.col("id")).alias(id_col), F.when(F.col("cuts").isNull(), F.col("text")).otherwise(left).alias("text"))
    bare = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).cast("string").alias("text"))
    return own.unionByName(bare.where("text IS NULL OR text = ''"))
