"""Op 1: BPE encoding and decoding by a minimal acyclic transducer lexicon.

Frequent words of the corpus are compiled, with their token ids as outputs, into a shared-suffix automaton
(:mod:`tidemark.llm.lexicon`) which every task memory-maps. Tasks compile a part of the words each; the driver gets
their arrays and puts them one after another. Each batch of texts is cut into words, its distinct
words walk the automaton together, and words that are not in it are merged exactly by the tokenizer's ranks: Latin
ones all together, a merge of each at a time, the others one by one.

A word is a run between white space: the tokenizer's own split never joins across white space, so the ids of a
text are those of its words one after another, whatever the text's length.

Cases: a null or empty text has no ids; repeated rows and ids give repeated rows; an empty table gives an empty
result; columns besides ``id_col`` and ``text_col`` are ignored here, and clash with nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lexicon
from tidemark.llm.common import cut

#: Words of the lexicon at most, and their UTF-8 bytes at most: bounds of what the tasks compile and the driver joins.
LEXICON_WORDS = 1 << 18
LEXICON_WORD_BYTES = 48
#: Parts that the words of the lexicon are compiled in.
LEXICON_PARTS = 32
#: Words seen fewer times are left to merging.
MIN_COUNT = 4
#: Characters that a batch of whole texts gathers before its words are looked up; a longer text is a batch itself.
BATCH_CHARS = 1 << 22
#: Widths of the tables in which pieces of words are merged together, and a table's rows; words of more characters
#: than half of the last are merged alone.
WIDTHS = (8, 16, 32, 128)
TABLE_ROWS = 1 << 13
#: Merged words, and pieces of words, that a Python worker remembers; then it forgets all of them.
CACHE_WORDS = 50_000

_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACE = re.compile("[\x09-\x0d\x20\x85\xa0  -     　]+")


#: Words of these characters, printable ASCII and Latin letters, are their own NFC form and lower-case one by one
#: (but for the dotted capital I); their pieces are cut here, as the tokenizer's own steps would.
_LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
#: The pieces are cut in UTF-8, in which all bytes from 80 on are letters' here; the space between words is one too.
_LATIN_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\xff]+|[0-9]|[^a-z\x80-\xff0-9 ]+| ")


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the other
    bytes for those from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def split_words(text: str) -> list[str]:
    """Runs between Unicode white space. ``str.split`` also splits at four control characters that aren't."""
    if _SEPARATORS.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


def words_of(texts: pa.LargeStringArray) -> pa.Array:
    """:func:`split_words` of each text as a list; there may be empty words among them."""
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():
        return pa.array([split_words(t) for t in texts.to_pylist()], pa.list_(pa.large_string()))
    return pc.utf8_split_whitespace(texts)


def bytes_of(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts, and where in them each text begins and the last one ends."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8), at


def runs(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one run after another, by their first numbers and lengths."""
    ends = np.cumsum(lengths)
    return np.repeat(first - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def woven(n: int, parts: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of ``n`` things in their order, and how many each has, from parts: (numbers of things, how many ids each of
    them has, these ids)."""
    parts, lengths = list(parts), np.zeros(n, np.int64)
    for which, count, _ in parts:
        lengths[which] = count
    at = np.cumsum(lengths) - lengths
    ids = np.empty(int(lengths.sum()), "<u4")
    for which, count, of in parts:
        ids[runs(at[which], count)] = of
    return ids, lengths


class Merger:
    """Exact encoding of single words: the tokenizer's normaliser and splitter, then merges by rank."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        with open(tokenizer_json, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("post_processor") or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("a BPE file without post-processor, byte fallback and unknown token is needed")
        own = Tokenizer.from_file(tokenizer_json)
        self.normalizer, self.splitter = own.normalizer, own.pre_tokenizer
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(a, b): k for k, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain")
        self.around = re.compile("|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.n_ids = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens: list[bytes] = [b""] * self.n_ids
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        self.decoder = own.decoder
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        # The quick way holds for one kind of tokenizer; all others take the tokenizer's own steps.
        kinds = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        pattern = splits[0].get("pattern", {}).get("Regex") if splits else None
        self.latin = kinds == ["NFC", "Replace", "Lowercase"] and pattern == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.pieces: dict[str, list[int]] = {}
        self.merged: dict[str, list[int]] = {}
        if self.latin:
            self._tabulate()

    def _tabulate(self) -> None:
        """Ids of single bytes, within and at the end of a piece, and merges by the ids of their pairs."""
        letters = [self.letters[chr(b)] for b in range(256)]
        try:
            self.inner = np.array([self.ids[c] for c in letters], np.int64)
            self.final = np.array([self.ids[c + self.end] for c in letters], np.int64)
            pairs = sorted((self._pair(self.ids[a], self.ids[b]), k, self.ids[a + b]) for (a, b), k in self.merges.items())
        except KeyError:
            self.latin = False
            return
        self.pair_key, self.pair_rank = (np.array([p[x] for p in pairs], np.int64) for x in (0, 1))
        self.unranked = 1 + max([p[1] for p in pairs], default=0)
        self.into = np.zeros(self.unranked, np.int64)
        self.into[self.pair_rank] = [p[2] for p in pairs]

    def _pair(self, a, b):
        """A number for two ids; -1 stands for none."""
        return (a + 1) * (self.n_ids + 1) + b + 1

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, ``unranked`` where they don't merge."""
        if not len(self.pair_key):
            return np.full(a.shape, self.unranked)
        pair = self._pair(a, b)
        at = np.minimum(np.searchsorted(self.pair_key, pair), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == pair, self.pair_rank[at], self.unranked)

    def _merge_table(self, symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merge` of pieces of at most ``width`` symbols, a row each, all making a merge at a time: the ids that
        each has, and all ids. The last column stays empty and stands beyond both ends of a row."""
        column = np.arange(width + 1)
        symbol = symbols[np.minimum(first[:, None] + column, len(symbols) - 1)]
        symbol[column >= sizes[:, None]] = -1
        rank = np.full(symbol.shape, self.unranked)
        rank[:, :-1] = self._ranks(symbol[:, :-1], symbol[:, 1:])
        after, before = np.tile(column + 1, (len(first), 1)), np.tile(column - 1, (len(first), 1))
        row = np.arange(len(first))
        while True:
            i = rank[row].argmin(1)
            least = rank[row, i]
            more = least < self.unranked
            if not more.any():
                break
            row, i, least = row[more], i[more], least[more]
            j = after[row, i]
            k, h = after[row, j], before[row, i]
            made = self.into[least]
            symbol[row, i], symbol[row, j], rank[row, j] = made, -1, self.unranked
            after[row, i], before[row, k] = k, i
            rank[row, i] = self._ranks(made, symbol[row, k])
            rank[row, h] = self._ranks(symbol[row, h], made)
        left = symbol >= 0
        return left.sum(1), symbol[left]

    def _latin_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of some words has, and all ids; the words are Latin without special tokens."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        text = " ".join(words).lower().encode()
        sizes = np.fromiter(map(len, _LATIN_PIECES.findall(text)), np.int64)
        raw = np.frombuffer(text, np.uint8)
        first = np.cumsum(sizes) - sizes
        symbols, last = self.inner[raw], first + sizes - 1
        symbols[last] = self.final[raw[last]]
        between = raw[first] == 0x20
        word = np.cumsum(between)[~between]
        first, sizes = first[~between], sizes[~between]
        single = np.flatnonzero(sizes == 1)
        parts, above = [(single, np.ones(len(single), np.int64), symbols[first[single]])], 1
        for width in WIDTHS:
            some = np.flatnonzero((sizes > above) & (sizes <= width))
            for k in range(0, len(some), TABLE_ROWS):
                of = some[k : k + TABLE_ROWS]
                parts.append((of, *self._merge_table(symbols, first[of], sizes[of], width)))
            above = width
        ids, count = woven(len(first), parts)
        return np.bincount(word, count, len(words)).astype(np.int64), ids

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`word` of many words: all ids, and how many each word has."""
        short = WIDTHS[-1] // 2
        quick = np.fromiter((self.latin and len(w) <= short and _LATIN.fullmatch(w) is not None and not self.around.search(w) for w in words), bool, len(words))
        alone = np.flatnonzero(~quick)
        slow = [self._remembered(words[k]) for k in alone.tolist()]
        quick = np.flatnonzero(quick)
        return woven(
            len(words),
            [
                (quick, *self._latin_words([words[k] for k in quick.tolist()])),
                (alone, np.array([len(x) for x in slow], np.int64), np.array([i for x in slow for i in x], "<u4")),
            ],
        )

    def _remembered(self, word: str) -> list[int]:
        if (ids := self.merged.get(word)) is None:
            ids = self.word(word)
            if len(word) <= 256:
                if len(self.merged) >= CACHE_WORDS:
                    self.merged.clear()
                self.merged[word] = ids
        return ids

    def piece(self, piece: str) -> list[int]:
        """:meth:`merge`, remembered."""
        if (ids := self.pieces.get(piece)) is None:
            ids = self.merge(piece)
            if len(piece) <= 64:
                if len(self.pieces) >= CACHE_WORDS:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece of the splitter: the lowest-ranked pair first, the leftmost of equals."""
        parts: list = list(piece)
        if not parts:
            return []
        parts[-1] += self.end
        n = len(parts)
        if n <= 32:
            return self._merge_short(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank = self.merges.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := rank((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [self.ids[p] for p in parts if p is not None and p in self.ids]

    def _merge_short(self, parts: list[str]) -> list[int]:
        """The same for few parts, by looking through all ranks each time."""
        get, none = self.merges.get, len(self.merges)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == none:
                break
            i = ranks.index(least)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
        return [self.ids[p] for p in parts if p in self.ids]

    def plain(self, text: str) -> list[int]:
        if not text:
            return []
        if self.latin and _LATIN.fullmatch(text):
            pieces = _LATIN_PIECES.findall(text.lower().encode())
            return [i for piece in pieces for i in self.piece("".join([self.letters[c] for c in piece.decode("latin-1")]))]
        text = self.normalizer.normalize_str(text) if self.normalizer else text
        pieces = self.splitter.pre_tokenize_str(text) if self.splitter else [(text, None)]
        return [i for piece, _ in pieces for i in self.piece(piece)]

    def word(self, text: str) -> list[int]:
        """Ids of a word; special tokens in it stand for themselves."""
        ids, at = [], 0
        for m in self.around.finditer(text):
            ids += self.plain(text[at : m.start()])
            ids.append(self.special[m[0]])
            at = m.end()
        return ids + self.plain(text[at:])


class Codec:
    """Encodes and decodes batches of texts in a task."""

    def __init__(self, tokenizer_json: str, lexicon_file: str):
        self.merger = _merger(tokenizer_json)
        self.arrays = lexicon.load(lexicon_file)
        self.tokens = pa.array([t.decode() for t in self.merger.tokens], pa.large_string())

    def of_words(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words, and how many each has: outputs of the transducer, else exact merges."""
        raw, at = bytes_of(words)
        rank = lexicon.ranks_within(self.arrays, raw, at[:-1], np.diff(at))
        known, rest = np.flatnonzero(rank >= 0), np.flatnonzero(rank < 0)
        first = self.arrays["ids_at"][rank[known]]
        count = self.arrays["ids_at"][rank[known] + 1] - first
        merged, n_merged = self.merger.words(words.take(pa.array(rest)).to_pylist())
        return woven(len(words), [(known, count, self.arrays["ids"][runs(first, count)]), (rest, n_merged, merged)])

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts as unsigned 32-bit integers, and where in them each text's begin and the last one's end."""
        lists = words_of(texts)
        coded = lists.flatten().dictionary_encode()
        ids, count = self.of_words(coded.dictionary)
        word = coded.indices.to_numpy()
        first, lengths = (np.cumsum(count) - count)[word], count[word]
        at = np.concatenate([[0], np.cumsum(lengths)])
        of_text = lists.offsets.to_numpy()
        return ids[runs(first, lengths)], at[of_text - of_text[0]]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> pa.LargeStringArray:
        """The text of each run of ids; special tokens stay. Without a decoder the tokens are joined by a space."""
        tokens = self.tokens.take(pa.array(ids))
        if self.merger.decoder is None:
            return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), tokens), pa.scalar(" ", pa.large_string()))
        tokens = tokens.to_pylist()
        return pa.array([self.merger.decoder.decode(tokens[a:b]) for a, b in zip(at.tolist(), at[1:].tolist())], pa.large_string())


def digests(raw: np.ndarray, at: np.ndarray) -> pa.Array:
    """Hexadecimal SHA-256 of runs of an array."""
    view, at = memoryview(raw), at.tolist()
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())


def word_counts(docs: DataFrame, text_col: str = "text", min_count: int = MIN_COUNT) -> DataFrame:
    """Counts of the words of all documents: (word, n) from ``min_count`` on, words over the byte bound left out."""

    def run(batches):
        for _, texts in _groups(batches):
            found = words_of(texts).flatten().value_counts()
            size = pc.binary_length(found.field(0))
            found = found.filter(pc.and_(pc.greater(size, 0), pc.less_equal(size, LEXICON_WORD_BYTES)))
            yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], names=["word", "n"])

    # Counts of a slice of a batch leave Python, so what is shuffled are distinct words of tasks.
    words = docs.select(F.col(text_col).cast("string").alias("__text")).mapInArrow(run, "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def frequent_words(docs: DataFrame, text_col: str = "text", size: int = LEXICON_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word) of which the count reaches the lowest cut that at most ``size`` words reach."""
    counts = cut(word_counts(docs, text_col, min_count), "word-counts")
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    # How many words a count has falls as the count grows; the running sum from the top stops at ``size`` words.
    room, least = size, None
    for r in by_count.orderBy(F.desc("n")).limit(size).toLocalIterator():
        if r.words > room:
            break
        room, least = room - r.words, r.n
    return counts.where(F.col("n") >= least if least is not None else F.lit(False)).select("word")


def compile_lexicon(words: Iterable[str], tokenizer_json: str) -> dict[str, np.ndarray]:
    """The transducer of ``words`` with the ids of each as its output."""
    merger = _merger(tokenizer_json)
    sound = sorted(w.encode() for w in set(words) if split_words(w) == [w])
    arrays = lexicon.compile_words(sound)
    arrays["ids"], count = merger.words([w.decode() for w in sound])
    arrays["ids_at"] = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    return arrays


def lexicon_parts(words: DataFrame, tokenizer_name: str) -> DataFrame:
    """(part, arrays) of the parts that have any of ``words``, compiled in tasks."""

    def dealt(batches):
        for batch in batches:
            raw, at = bytes_of(batch.column(0).cast(pa.large_string()))
            part = lexicon.parts_of(raw, at[:-1], np.diff(at), LEXICON_PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column(0)], names=["part", "word"])

    def compiled(rows: pa.Table) -> pa.Table:
        arrays = lexicon.dumped(compile_lexicon(rows["word"].to_pylist(), SparkFiles.get(tokenizer_name)))
        return pa.table({"part": rows["part"][:1], "arrays": pa.array([arrays], pa.binary())})

    # A part is a task's, so it takes as many tasks as there are parts, however few bytes they are.
    of_part = words.mapInArrow(dealt, "part bigint, word string").repartition(LEXICON_PARTS, "part").groupBy("part")
    return of_part.applyInArrow(compiled, "part bigint, arrays binary")


_MERGERS: dict[str, Merger] = {}
_CODECS: dict[tuple[str, str], Codec] = {}


def _merger(tokenizer_json: str) -> Merger:
    if tokenizer_json not in _MERGERS:
        _MERGERS.clear()
        _MERGERS[tokenizer_json] = Merger(tokenizer_json)
    return _MERGERS[tokenizer_json]


def _codec(tokenizer_name: str, lexicon_name: str) -> Codec:
    key = (tokenizer_name, lexicon_name)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(SparkFiles.get(tokenizer_name), SparkFiles.get(lexicon_name))
    return _CODECS[key]


def _share(spark: SparkSession, path: str, stem: str) -> str:
    """Hand a file of the driver to all executors, also later ones, under a name of its content; that name."""
    with open(path, "rb") as f:
        content = f.read()
    name = f"{stem}-{hashlib.sha256(content).hexdigest()[:16]}"
    if not any(x.endswith("/" + name) for x in spark.sparkContext.listFiles):
        folder = os.path.realpath(tempfile.mkdtemp(prefix="tidemark-"))
        with open(os.path.join(folder, name), "wb") as f:
            f.write(content)
        spark.sparkContext.addFile(os.path.join(folder, name))
    return name


def build(spark: SparkSession, docs: DataFrame, tokenizer_json: str, text_col: str = "text", size: int = LEXICON_WORDS) -> tuple[str, str]:
    """Compile the corpus's lexicon and share it with the tokenizer file: the names that encoding takes."""
    tokenizer = _share(spark, tokenizer_json, "tokenizer")
    found = lexicon_parts(frequent_words(docs, text_col, size), tokenizer)
    arrays = lexicon.joined({r.part: lexicon.loaded(r.arrays) for r in found.collect()}, LEXICON_PARTS)
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tidemark-")), "lexicon")
    lexicon.save(arrays, path)
    return tokenizer, _share(spark, path, "lexicon")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.LargeStringArray]]:
    """Slices of batches, of BATCH_CHARS characters or one text each: their first column and their texts, which are the
    last one, null ones empty."""
    for batch in batches:
        lengths = pc.fill_null(pc.utf8_length(batch.columns[-1]), 0).to_pylist()
        at, chars = 0, 0
        for k, n in enumerate([*lengths, None]):
            if n is None or (chars and chars + n > BATCH_CHARS):
                rows = batch.slice(at, k - at)
                yield rows.column(0), pc.fill_null(rows.columns[-1], "").cast(pa.large_string())
                at, chars = k, 0
            chars += n or 0


def encode(docs: DataFrame, names: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, n_tokens bigint) of every document, by :func:`build`'s names."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))

    def run(batches):
        codec = _codec(*names)
        for keys, texts in _groups(batches):
            ids, at = codec.encode(texts)
            yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(at.astype(np.int32), ids.view("<i4")), pa.array(np.diff(at))], names=[id_col, "ids", "n_tokens"])

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, n_tokens bigint")


def decode(coded: DataFrame, names: tuple[str, str], id_col: str = "doc_id") -> DataFrame:
    """(id, text) of rows with ``ids``; null ids give an empty text."""

    def run(batches):
        codec = _codec(*names)
        for batch in batches:
            lists = batch.column(1)
            at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), dtype=np.int64)])
            texts = codec.decode(lists.flatten().to_numpy(), at)
            yield pa.RecordBatch.from_arrays([batch.column(0), texts.cast(pa.string())], names=[id_col, "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def round_trip(docs: DataFrame, names: tuple[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass and keep digests: (id, n_tokens, ids_sha256, decoded_sha256)."""
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))

    def run(batches):
        codec = _codec(*names)
        for keys, texts in _groups(batches):
            ids, at = codec.encode(texts)
            back = bytes_of(codec.decode(ids, at))
            yield pa.RecordBatch.from_arrays([keys, pa.array(np.diff(at)), digests(ids, at), digests(*back)], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
