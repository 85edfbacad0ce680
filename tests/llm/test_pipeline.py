"""The pipeline and the registered queries on the smallest tables, against plain Python."""

import collections
import random

import __spark_entry__
import corpus_pipeline
from tests.llm.test_operators import LOW, near_brute
from tidemark.llm import quality, queries
from tidemark.llm.common import table


def test_pipeline_equals_its_stages_by_brute_force(spark, sf):
    from tokenizers import Tokenizer

    docs = table(spark, sf, "documents")
    passed = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in passed}
    first = {}
    for k in sorted(texts):
        first.setdefault((texts[k] or "").translate(LOW), k)
    ids = sorted(first.values())
    best = near_brute([texts[k] for k in ids], 5, 80)[1]
    left = {k for n, k in enumerate(ids) if best[n] == n}
    found = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, sf).collect():
        found[r.doc_id].append(r.ids)
    own = Tokenizer.from_file(queries.tokenizer_file())
    assert set(found) <= left and all(1 <= len(x) <= 2 for x in found.values())
    for k, x in found.items():
        assert x[0] == own.encode(texts[k], add_special_tokens=False).ids
    words = sum(len(texts[k].split()) for k in left)
    taken = sum(len(texts[k].split()) * len(x) for k, x in found.items())
    assert abs(taken - 1.5 * words) < 0.05 * words
    assert found.keys() == {r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").distinct().collect()}


def test_pipeline_of_hostile_rows(spark, sf):
    """Repeated ids and rows, nulls in any column and clashing names, against plain Python."""
    rs = random.Random(21)
    say = lambda: " ".join("".join(rs.choice("abcdefghij") for _ in range(rs.randint(4, 6))) for _ in range(120))
    a, b, c, d, e, f, g = (say() for _ in range(7))
    rows = [(2, a), (2, b), (1, a), (1, a.upper()), (3, c), (4, c + " more"), (None, d), (None, d), (None, e), (None, e + " more"), (5, None), (6, ""), (7, "few words"), (8, f), (8, f), (9, g)]
    texts = [(k, t, [None, "en"][n % 2], [None, "s", "t"][n % 3], len(t or ""), f"i{n}", f"s{n}", "z") for n, (k, t) in enumerate(rows)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string, n_chars bigint, __id string, __sha string, copies string").repartition(3)
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, sf)
        assert kept.columns == docs.columns, name
        found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
        if name == "quality rules":
            assert found == collections.Counter((k, t) for k, t in rows if t and len(t) > 20)
        if name == "exact dedup":
            assert found == {(1, a): 1, (2, b): 1, (3, c): 1, (4, c + " more"): 1, (None, d): 1, (None, e): 1, (None, e + " more"): 1, (8, f): 1, (9, g): 1} or found == {(1, a.upper()): 1, (2, b): 1, (3, c): 1, (4, c + " more"): 1, (None, d): 1, (None, e): 1, (None, e + " more"): 1, (8, f): 1, (9, g): 1}
    ends = collections.Counter((r.doc_id, r.text.lower()) for r in kept.collect())
    assert set(ends.values()) == {1} and set(ends) - {(None, e), (None, e + " more")} == {(1, a), (2, b), (3, c), (None, d), (8, f), (9, g)} and len(ends) == 7
    result = corpus_pipeline.run_on(spark, docs, sf)
    counted = collections.Counter((r.doc_id, tuple(r.ids)) for r in result.collect())
    assert result.columns == ["doc_id", "ids", "n_tokens"] and set(counted.values()) <= {1, 2}
    assert {k for k, _ in counted} <= {1, 2, 3, 8, 9, None} and abs(sum(counted.values()) - 1.5 * 7) <= 3
    assert corpus_pipeline.run_on(spark, docs.limit(0), sf).count() == 0


def test_stages_keep_the_columns(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert all(any(x.startswith(f"op{n}_") for x in names) for n in range(1, 11)) and "pipeline" in names
