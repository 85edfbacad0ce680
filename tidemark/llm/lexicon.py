"""Minimal acyclic transducer: sorted byte words to their rank, in flat arrays that are memory-mapped.

Words go in sorted; a state whose suffixes are complete is replaced by an equal one that exists already, so
all common suffixes are shared. Each arc carries the number of words that sort before it within its state;
the sum along a path is the rank of the word, which selects its row in any table of outputs.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import numpy as np


def compile_words(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the minimal automaton of ``words`` (distinct, sorted, not empty).

    ``arc_key``: state * 256 + byte, ascending; ``arc_to``: target state; ``arc_out``: rank added by the arc;
    ``final``: whether a word ends in the state; ``root``: its number; ``base``: the rank of its first word.
    """
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    totals: list[int] = []
    keys: list[int] = []
    to: list[int] = []
    out: list[int] = []

    def settle(final: bool, labels: list[int], children: list[int]) -> int:
        shape = (final, tuple(labels), tuple(children))
        state = register.get(shape)
        if state is None:
            state = register[shape] = len(finals)
            before = int(final)
            for label, child in zip(labels, children):
                keys.append(state << 8 | label)
                to.append(child)
                out.append(before)
                before += totals[child]
            finals.append(final)
            totals.append(before)
        return state

    # The open path: per depth [is a word's end, labels, settled children]; the last label's child is the next depth.
    path: list[list] = [[False, [], []]]
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, labels, children = path.pop()
            path[-1][2].append(settle(final, labels, children))

    for word in words:
        if word <= last:
            raise ValueError("words must be distinct, sorted and not empty")
        common = 0
        for x, y in zip(word, last):
            if x != y:
                break
            common += 1
        close(common)
        for byte in word[common:]:
            path[-1][1].append(byte)
            path.append([False, [], []])
        path[-1][0] = True
        last = word
    close(0)
    root = settle(*path[0])
    return {
        "arc_key": np.array(keys, np.int64),
        "arc_to": np.array(to, np.int32),
        "arc_out": np.array(out, np.int32),
        "final": np.array(finals, np.bool_),
        "root": np.array([root], np.int32),
        "base": np.zeros(1, np.int64),
    }


def parts_of(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray, parts: int) -> np.ndarray:
    """The part that each word of a buffer belongs to, by its length, first and last byte; no word is empty."""
    return (lengths + 31 * buffer[starts].astype(np.int64) + 7 * buffer[starts + lengths - 1].astype(np.int64)) % parts


def joined(found: dict[int, dict[str, np.ndarray]], parts: int) -> dict[str, np.ndarray]:
    """One automaton with a root for each part, of automata of the words of parts; ranks go on from part to part. Parts
    without words may be missing. ``ids`` and ``ids_at``, if given, are outputs by rank."""
    root, base, states, words = np.full(parts, -1, np.int32), np.zeros(parts, np.int64), 0, 0
    ids_at, n_ids = [np.zeros(1, np.int64)], 0
    pieces: dict[str, list[np.ndarray]] = {k: [np.zeros(0, kind)] for k, kind in (("arc_key", np.int64), ("arc_to", np.int32), ("arc_out", np.int32), ("final", np.bool_), ("ids", "<u4"))}
    for part, a in sorted(found.items()):
        root[part], base[part] = a["root"][0] + states, words
        for name, more in (("arc_key", states << 8), ("arc_to", states), ("arc_out", 0)):
            pieces[name].append(a[name] + a[name].dtype.type(more))
        pieces["final"].append(a["final"])
        pieces["ids"].append(a["ids"])
        ids_at.append(a["ids_at"][1:] + n_ids)
        states, words, n_ids = states + len(a["final"]), words + len(a["ids_at"]) - 1, n_ids + len(a["ids"])
    return {name: np.concatenate(x) for name, x in pieces.items()} | {"root": root, "base": base, "ids_at": np.concatenate(ids_at)}


def dumped(arrays: dict[str, np.ndarray]) -> bytes:
    """A line of JSON with each array's place, then the arrays, 64-byte aligned after that line."""
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 1) % 64) + b"\n"
    return b"".join([head, *(x for a in arrays.values() for x in (a.tobytes(), b"\0" * (-a.nbytes % 64)))])


def parsed(raw: np.ndarray, head: bytes) -> dict[str, np.ndarray]:
    """Views of the arrays in the bytes of :func:`dumped`, by the line they begin with."""
    found = {}
    for name, (kind, n, at) in json.loads(head).items():
        start = len(head) + at
        found[name] = raw[start : start + n * np.dtype(kind).itemsize].view(kind)
    return found


def loaded(content: bytes) -> dict[str, np.ndarray]:
    """The arrays of :func:`dumped`."""
    return parsed(np.frombuffer(content, np.uint8), content[: content.index(b"\n") + 1])


def save(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file of :func:`dumped`."""
    with open(path, "wb") as f:
        f.write(dumped(arrays))


def load(path: str) -> dict[str, np.ndarray]:
    """Memory-mapped arrays of a file by :func:`save`; processes of one machine share its pages."""
    with open(path, "rb") as f:
        head = f.readline()
    return parsed(np.memmap(path, np.uint8, "r").view(np.ndarray), head)


def ranks(arrays: dict[str, np.ndarray], words: Sequence[bytes]) -> np.ndarray:
    """Each word's rank, or -1 where it isn't a word of the automaton."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return ranks_within(arrays, np.frombuffer(b"".join(words), np.uint8), np.cumsum(lengths) - lengths, lengths)


def ranks_within(arrays: dict[str, np.ndarray], buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """:func:`ranks` of words that lie in a buffer of bytes. All words take a step at a time."""
    n = len(starts)
    result = np.full(n, -1, np.int64)
    keys, to, out, final = arrays["arc_key"], arrays["arc_to"], arrays["arc_out"], arrays["final"]
    if not n or not len(keys):
        return result
    live = np.flatnonzero(lengths)
    part = parts_of(buffer, starts[live], lengths[live], len(arrays["root"]))
    state, rank = arrays["root"][part].astype(np.int64), arrays["base"][part]
    depth = 0
    while len(live):
        key = state << 8 | buffer[starts[live] + depth]
        arc = np.searchsorted(keys, key)
        arc[arc == len(keys)] = 0
        known = keys[arc] == key
        live, arc = live[known], arc[known]
        state, rank = to[arc].astype(np.int64), rank[known] + out[arc]
        depth += 1
        over = lengths[live] == depth
        if over.any():
            ends = over & final[state]
            result[live[ends]] = rank[ends]
            live, state, rank = live[~over], state[~over], rank[~over]
    return result
