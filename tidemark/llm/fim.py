"""Op 11: fill-in-the-middle by rotating blocks in place.

A text is a bytearray from its first byte to its last. Its cuts are found by one scan over its units; sentinels are
inserted at the cuts, which gives ``P prefix M middle S suffix``; two neighbouring segments are then exchanged by three
reversals, which move bytes within the array and need only a block of :data:`BLOCK` bytes beside it. The inverse looks
the sentinels up, rotates back and takes them out, so a text is restored from its output and its form alone.

What is drawn for a document follows from the seed and its id. A text that holds a sentinel stays plain, as do empty
texts and the share that isn't to be changed. Sentinels must be distinct and free of overlaps with each other, so that
each is found once and only where it was put.

Cases: a null text is an empty one; a null id draws as an empty string, so such rows share their draw; repeated rows and
ids draw alike; an empty table gives an empty result; further columns, of any name, are ignored by :func:`rearrange` and
carried by :func:`rearranged`; ids may be of any type that has a text form. A very long text is one bytearray in one task,
with a copy of it on either side of the Python worker; texts are handed over by at most :data:`SLICE_BYTES` or one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import named, number_of, numbered

#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes that a reversal swaps at a time, and bytes of text in a slice of rows.
BLOCK, SLICE_BYTES = 1 << 16, 4 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


def sentinel_bytes(sentinels: Sequence[str]) -> tuple[bytes, bytes, bytes]:
    """The three sentinels, once it is sure that none can be read where it wasn't put."""
    found = tuple(s.encode() for s in sentinels)
    if len(found) != 3 or len(set(found)) != 3 or not all(found):
        raise ValueError("three distinct sentinels are needed")
    for a in found:
        for b in found:
            if a is not b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)) + (a is not b))):
                raise ValueError(f"sentinels overlap: {a.decode()} and {b.decode()}")
    return found


def reverse(buf: bytearray, a: int, b: int) -> None:
    """Reverse ``buf[a:b]`` in place, a block from either end at a time."""
    while b - a > 1:
        k = min(BLOCK, (b - a) // 2)
        head, tail = buf[a : a + k], buf[b - k : b]
        head.reverse()
        tail.reverse()
        buf[a : a + k], buf[b - k : b] = tail, head
        a, b = a + k, b - k


def exchange(buf: bytearray, a: int, b: int, c: int) -> None:
    """Exchange the neighbours ``buf[a:b]`` and ``buf[b:c]`` by three reversals."""
    reverse(buf, a, b)
    reverse(buf, b, c)
    reverse(buf, a, c)


def unit_ends(raw: bytes, units: str) -> np.ndarray:
    """Byte offsets where units end: lines with their line feed, or code points."""
    codes = np.frombuffer(raw, np.uint8)
    if units == "lines":
        ends = np.flatnonzero(codes == 10) + 1
        return ends if not raw or raw.endswith(b"\n") else np.append(ends, len(raw))
    if units == "chars":
        return np.append(np.flatnonzero((codes & 0xC0) != 0x80)[1:], [len(raw)] if raw else []).astype(np.int64)
    raise ValueError(f"units are lines or chars, not {units}")


def code_points(raw: bytes | bytearray) -> int:
    return int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))


def rotate(raw: bytes, draws: tuple[int, int, int, int], units: str, rate: int, spm: int, marks: tuple[bytes, bytes, bytes]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    ends = unit_ends(raw, units)
    n = len(ends)
    h1, h2, h3, h4 = draws
    if not raw or h3 % 100 >= rate or any(s in raw for s in marks):
        return n, PLAIN, None, None, raw
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, q = (int(ends[k - 1]) if k else 0 for k in (first, second))
    counts = code_points(raw[:p]), code_points(raw[p:q])
    prefix, suffix, middle = marks
    buf = bytearray(raw)
    buf[q:q] = suffix
    buf[p:p] = middle
    buf[0:0] = prefix
    m = len(prefix) + p
    s = m + len(middle) + q - p
    form = SPM if h4 % 100 < spm else PSM
    exchange(buf, 0 if form == SPM else m, s, len(buf))
    return n, form, *counts, bytes(buf)


def rotate_back(output: bytes, form: str | None, marks: tuple[bytes, bytes, bytes]) -> bytes | None:
    """The text of an output; nothing for one that doesn't have the sentinels of its form once each, in their order."""
    if form == PLAIN:
        return output
    prefix, suffix, middle = marks
    order = {PSM: (prefix, suffix, middle), SPM: (suffix, prefix, middle)}.get(form)
    if order is None or any(output.count(x) != 1 for x in marks):
        return None
    at = [output.find(x) for x in order]
    if at[0] or at != sorted(at):
        return None
    buf = bytearray(output)
    exchange(buf, *((0, at[1]) if form == SPM else (at[1], at[2])), len(buf))
    for mark in (suffix, middle, prefix):
        k = buf.find(mark)
        del buf[k : k + len(mark)]
    return bytes(buf)


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Slices of batches that hold SLICE_BYTES of their text column, or one text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at, held = 0, 0
        for k, n in enumerate([*lengths, None]):
            if n is None or (held and held + n > SLICE_BYTES):
                yield batch.slice(at, k - at)
                at, held = k, 0
            held += n or 0


def _rotated(rows: DataFrame, carried: list[str], text: Column, drawn: Column, units: str, rate: int, spm: int, sentinels: Sequence[str]) -> DataFrame:
    """The ``carried`` columns of ``rows`` with n, form, prefix_chars, middle_chars and the output's bytes."""
    marks = sentinel_bytes(sentinels)
    source = rows.select(*carried, text.cast("string").cast("binary").alias("__text"), drawn.alias("__drawn"))

    def run(batches):
        for part in _slices(batches, len(carried)):
            found = []
            for raw, digest in zip(part.column(len(carried)), part.column(len(carried) + 1)):
                h = digest.as_py()
                found.append(rotate(raw.as_py() or b"", tuple(int(h[k : k + 8], 16) for k in (0, 8, 16, 24)), units, rate, spm, marks))
            n, form, before, inside, output = zip(*found)
            made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(output, pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(carried)], *made], names=[*carried, "__n", "__form", "__prefix", "__middle", "__output"])

    kinds = ", ".join([*(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in carried), "__n bigint, __form string, __prefix bigint, __middle bigint, __output binary"])
    return source.mapInArrow(run, kinds)


def draws_of(id_: Column, seed: str) -> Column:
    return F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(id_.cast("string"), F.lit(""))), 256)


def rearrange(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "7", units: str = "lines", rate: int = 100, spm: int = 50, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every document.

    ``rate`` percent of the documents are changed, ``spm`` percent of these in the form that starts with the suffix.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _rotated(rows, ["id"], F.col("text"), draws_of(F.col("id"), seed), units, rate, spm, sentinels)
    return found.select(F.col("id").alias(id_col), F.col("__n").alias("n"), F.col("__form").alias("form"), F.col("__prefix").alias("prefix_chars"), F.col("__middle").alias("middle_chars"), F.col("__output").cast("string").alias("output"))


def rearranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "7", units: str = "lines", rate: int = 100, spm: int = 50, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``docs`` with their outputs as texts and all their other columns."""
    rows, text = numbered(docs), docs.columns.index(text_col)
    found = _rotated(rows, [c for k, c in enumerate(rows.columns) if k != text], F.col(f"c{text}"), draws_of(number_of(docs, id_col), seed), units, rate, spm, sentinels)
    return named(found.withColumnRenamed("__output", f"c{text}"), docs)


def restore(rows: DataFrame, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``rows`` with ``restored``, the text rebuilt from their ``output`` and ``form``; null where those don't fit each other."""
    marks = sentinel_bytes(sentinels)
    carried = [c for c in rows.columns if c not in ("output", "restored")]
    source = rows.select(*carried, F.col("output").cast("binary"))
    at = carried.index("form")

    def run(batches):
        for part in _slices(batches, len(carried)):
            texts = [None if raw.as_py() is None else rotate_back(raw.as_py(), form.as_py(), marks) for raw, form in zip(part.column(len(carried)), part.column(at))]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*carried, "output", "restored"])

    kinds = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in source.columns)
    found = source.mapInArrow(run, f"{kinds}, restored binary")
    return found.select(*carried, F.col("output").cast("string"), F.col("restored").cast("string"))
