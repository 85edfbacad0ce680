"""Fill-in-the-middle, sharding and the Merkle manifest against plain Python, with nulls, ties, empty and very long texts."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import fim, merkle, queries, sharding
from tidemark.llm.common import scratch

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, shard string, at string, output string, siblings string"


@pytest.fixture(scope="module")
def texts():
    rs = random.Random(11)
    line = lambda: "".join(rs.choice("abc é漢😀 ") for _ in range(rs.randint(0, 30)))
    out = [None, "", "\n", "\n\n\n", "no end", "one\n", "<P>", "a <S> b\nc", "x\n<M>\ny", "<\nP>\n<S\n>", "\r\n x\n", "x" * 200_000]
    out += ["\n".join(line() for _ in range(rs.randint(1, 12))) for _ in range(60)]
    return [*out, out[20], out[20], out[20]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(None if k % 9 == 5 else k, t, None if k % 4 == 0 else f"l{k % 3}", f"s{k % 4}" if k % 5 else None, len(t or "") if k % 6 else None, "a", "b", "c", "d", "e") for k, t in enumerate(texts)]
    rows += [rows[14]] * 4 + [(None, "same", "l1", None, 4, "a", "b", "c", "d", "e")] * 30
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill-in-the-middle


def plain_fim(id_, text, units, rate, spm):
    text = text or ""
    parts = re.findall(r"[^\n]*\n|[^\n]+", text) if units == "lines" else list(text)
    n, h = len(parts), sha(f"7:{'' if id_ is None else id_}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(s in text for s in fim.SENTINELS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("units", "rate", "spm"), [("lines", 100, 50), ("chars", 60, 100), ("lines", 50, 0)])
def test_texts_are_rearranged_and_restored(docs, units, rate, spm):
    got = fim.restore(fim.rearrange(docs, units=units, rate=rate, spm=spm)).collect()
    want = collections.Counter((r.doc_id, *plain_fim(r.doc_id, r.text, units, rate, spm), r.text or "") for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got) == want
    assert {r.form for r in got} == ({"plain", "psm", "spm"} if spm == 50 else {"plain", "spm" if spm else "psm"})


def test_rearranged_documents_keep_their_columns(docs, none):
    got = fim.rearranged(docs)
    assert got.schema.names == docs.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    want = collections.Counter((r.doc_id, plain_fim(r.doc_id, r.text, "lines", 100, 50)[-1], *r[2:]) for r in docs.collect())
    assert collections.Counter(map(tuple, got.collect())) == want
    assert fim.rearranged(none).count() == 0 and fim.restore(fim.rearrange(none)).count() == 0


def test_rotations_of_very_long_texts():
    rs = random.Random(5)
    marks = fim.sentinel_bytes(fim.SENTINELS)
    for text in ("line\n" * 2_000_000, "é" * 5_000_000, "\n" * 3_000_000 + "end"):
        draws = tuple(rs.randrange(1 << 32) for _ in range(4))
        n, form, before, inside, output = fim.rotate(text.encode(), draws, "lines", 100, 50, marks)
        a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
        parts = text.splitlines(keepends=True)
        assert (n, before, inside) == (len(parts), len("".join(parts[:a])), len("".join(parts[a:b])))
        assert len(output) == len(text.encode()) + 9 and fim.rotate_back(output, form, marks) == text.encode()
    buf = bytearray(range(256)) * 3000
    whole = bytes(buf)
    fim.exchange(buf, 7, 300_001, len(buf) - 5)
    assert bytes(buf) == whole[:7] + whole[300_001:-5] + whole[7:300_001] + whole[-5:]


def test_outputs_that_do_not_fit_their_form_give_no_text():
    marks = fim.sentinel_bytes(fim.SENTINELS)
    assert fim.rotate_back(b"<P>a<S>c<M>b", "psm", marks) == b"abc" and fim.rotate_back(b"<S>c<P>a<M>b", "spm", marks) == b"abc"
    for output, form in ((b"a<P><S><M>", "psm"), (b"<P>a<S>c", "psm"), (b"<P>a<P><S>c<M>", "psm"), (b"<P>a<S>c<M>b", "spm"), (b"x", "other"), (b"x", None)):
        assert fim.rotate_back(output, form, marks) is None
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aba", "c", "d"), ("a", "xax", "d")):
        with pytest.raises(ValueError):
            fim.sentinel_bytes(bad)


# -- sharding


def plain_shard(key, tree, seed="shard"):
    nodes, node, number = sharding.nodes_of(tree), "", None
    for _ in range(3):
        unit = lambda name: (int(hashlib.md5(f"{seed}:{name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        node, _, number = min(nodes[node], key=lambda c: (-math.log(unit(c[0])) / c[1], c[0]))
    return number


UNEVEN = [sharding.Shard("a", "x", 1.0), sharding.Shard("a", "x", 3.0), sharding.Shard("a", "y", 2.0), sharding.Shard("b", "x", 0.5), sharding.Shard("b", "z", 0.0)]


@pytest.mark.parametrize("tree", [sharding.uniform(2, 2, 2), UNEVEN])
def test_placements_by_brute_force(docs, tree):
    larger = sharding.grown(tree)
    got = sharding.place(docs, tree, larger).collect()
    want = collections.Counter()
    for r in docs.collect():
        raw, key = (r.text or "").encode(), "" if r.doc_id is None else r.doc_id
        want[r.doc_id, len(raw) + 1, zlib.crc32(raw), "key", plain_shard(key, tree), plain_shard(key, larger)] += 1
    assert collections.Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, sharding.place(docs.repartition(7), tree, larger).collect()))


def test_slots_do_not_depend_on_bins_and_long_runs_are_cut(docs, monkeypatch):
    one = collections.Counter(map(tuple, sharding.place(docs, UNEVEN).collect()))
    monkeypatch.setattr(sharding, "BIN_ROWS", 1)
    monkeypatch.setattr(sharding, "RUN_ROWS", 4)
    assert collections.Counter(map(tuple, sharding.place(docs, UNEVEN).collect())) == one


def test_movement_stays_inside_changed_subtrees_and_shares_follow_weights(spark):
    keys = spark.range(40_000).select("id")
    shards = lambda tree: {r.id: r.s for r in keys.select("id", sharding.shard_of(F.col("id"), tree).alias("s")).collect()}
    tree = [sharding.Shard(f"r{k // 6}", f"k{k // 3 % 2}", 1.0 + k % 3) for k in range(18)]
    old = shards(tree)
    count = collections.Counter(old.values())
    total = sum(s.weight for s in tree)
    assert all(abs(count[k] / 40_000 - s.weight / total) < 0.01 for k, s in enumerate(tree))
    # One shard of region r1, rack k0 gains: keys go to r1 only; inside r1 to k0 only; inside k0 to the shard only.
    heavier = [s._replace(weight=s.weight + 5) if k == 7 else s for k, s in enumerate(tree)]
    moves = collections.Counter((old[k], s) for k, s in shards(heavier).items() if old[k] != s)
    assert moves and all(tree[b].region == "r1" for _, b in moves)
    assert all(tree[b].rack == "k0" for a, b in moves if tree[a].region == "r1") and all(b == 7 for a, b in moves if tree[a][:2] == ("r1", "k0"))
    # A region of its own takes keys only into itself.
    more = shards(sharding.grown(tree, 4.0))
    assert {more[k] for k in old if old[k] != more[k]} == {18} and abs(sum(s == 18 for s in more.values()) / 40_000 - 4 / (total + 4)) < 0.01
    # A shard without weight holds nothing.
    assert 3 not in shards([s._replace(weight=0.0) if k == 3 else s for k, s in enumerate(tree)]).values()
    for bad in ([], [sharding.Shard("a", "b", 0.0)], [sharding.Shard("a", "b", -1.0), sharding.Shard("a", "b", 2.0)]):
        with pytest.raises(ValueError):
            sharding.nodes_of(bad)


def test_shards_as_files_and_other_keys(spark, docs, none, tmp_path):
    got = sharding.sharded(docs, UNEVEN, files=3)
    assert got.schema.names == [*(c for c in docs.columns if c != "shard"), "shard"]
    got.write.partitionBy("shard").parquet(f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert collections.Counter((r.doc_id, r.text, r.lang, r.shard) for r in back) == collections.Counter((r.doc_id, r.text, r.lang, plain_shard("" if r.doc_id is None else r.doc_id, UNEVEN)) for r in docs.collect())
    # Equal texts stay together where the text decides.
    together = sharding.sharded(docs, UNEVEN, key=F.md5(F.coalesce("text", F.lit("")))).groupBy(F.coalesce("text", F.lit(""))).agg(F.countDistinct("shard").alias("n")).where("n > 1")
    assert together.count() == 0 and "__key" not in sharding.sharded(docs, UNEVEN, key=F.col("text")).columns
    assert sharding.place(none, UNEVEN).count() == 0 and sharding.sharded(none, UNEVEN).count() == 0


# -- Merkle manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def plain_leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def plain_levels(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + arity])) for k in range(0, len(levels[-1]), arity)])
    return levels


def plain_proof(levels, at, arity):
    found = []
    for nodes in levels[:-1]:
        first = at - at % arity
        found.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + arity])))
        at //= arity
    return found


@pytest.mark.parametrize(("arity", "every"), [(2, 6), (2, 1), (3, 2), (5, 3)])
def test_proofs_by_brute_force(spark, docs, arity, every):
    manifest = merkle.build(docs, scratch(spark, "manifest"), [F.col(c) for c in FIELDS], arity=arity, every=every)
    trees = collections.defaultdict(list)
    for r in docs.collect():
        trees[r.lang].append((r.doc_id is not None, r.doc_id or 0, plain_leaf(r)))
    levels = {t: plain_levels([leaf for *_, leaf in sorted(rows)], arity) for t, rows in trees.items()}
    names = sorted(levels, key=lambda t: (t is not None, (t or "").encode()))
    top = plain_levels([levels[t][-1][0] for t in names], arity)
    want = collections.Counter()
    for t, rows in trees.items():
        for at, (known, id_, leaf) in enumerate(sorted(rows)):
            path = plain_proof(levels[t], at, arity) + plain_proof(top, names.index(t), arity)
            want[t, at, id_ if known else None, leaf, levels[t][-1][0], top[-1][0], tuple(path)] += 1
    got = manifest.proofs()
    assert collections.Counter((*r[:6], tuple(map(tuple, r.siblings))) for r in got.collect()) == want
    assert {r.tree: r.subroot for r in manifest.subroots().collect()} == {t: lv[-1][0] for t, lv in levels.items()}
    assert got.where(merkle.folded(F.col("leaf"), F.col("siblings")) != F.col("root")).count() == 0
    assert got.where(merkle.folded(F.sha2(F.col("leaf"), 256), F.col("siblings")) == F.col("root")).count() == 0
    some = spark.createDataFrame([(3,), (40,), (None,), (10**9,)], "x bigint")
    part = collections.Counter((*r[:6], tuple(map(tuple, r.siblings))) for r in manifest.proofs(some).collect())
    assert part == collections.Counter({k: n for k, n in want.items() if k[2] in (3, 40, None)})
    # Every level that is not stored is missing from the manifest, and it can be opened anew.
    assert len(manifest.trees.levels) == 1 + max(1, -(-max(len(lv) - 1 for lv in levels.values()) // every))


def test_manifest_of_nothing_of_one_row_and_opened_again(spark, docs, none):
    fields = [F.col(c) for c in FIELDS]
    empty = merkle.build(none, scratch(spark, "manifest"), fields)
    assert empty.root is None and empty.proofs().count() == 0
    row = docs.where("doc_id = 7")
    one = merkle.build(row, scratch(spark, "manifest"), fields)
    assert one.root == plain_leaf(row.first()) and [r.siblings for r in one.proofs().collect()] == [[]]
    path = scratch(spark, "manifest")
    built = merkle.build(docs, path, fields)
    again = merkle.opened(spark, path)
    assert again.root == built.root and collections.Counter(map(str, again.proofs().collect())) == collections.Counter(map(str, built.proofs().collect()))


def test_tampered_rows_are_found_out(spark, docs, tmp_path):
    docs.select("doc_id", "text", "lang", "source", "n_chars", "at").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_merkle(spark, str(tmp_path)).collect()
    rows = docs.collect()
    changed = lambda r: r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0 and r.n_chars is not None
    assert collections.Counter((r.doc_id, r.leaf, r.verified) for r in got) == collections.Counter((r.doc_id, plain_leaf(r), not changed(r)) for r in rows)
    assert any(map(changed, rows)) and len({r.root for r in got}) == 1 and all((r.folded_root == r.root) == r.verified for r in got)
