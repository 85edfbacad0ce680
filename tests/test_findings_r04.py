"""Findings of round 4: each failed before its change."""

import re

from tidemark.llm import license_scan, queries

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_license_scan_splits_each_text_once(spark, monkeypatch):
    """F1 op5: a filter that Spark inferred on the words split each text again for each mention of them."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    cut, plans = license_scan.cut, {}
    monkeypatch.setattr(license_scan, "cut", lambda df, name: (plans.update({name: plan(df)}), cut(df, name))[1])
    texts = ["(c) X. All rights\nreserved.", "no words of it", "rights all reserved"] + [f"word{k}" for k in range(20)]
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3), {})
    plans["result"] = plan(found)
    assert {r.doc_id for r in found.collect() if r.labels == "proprietary"} == {0}
    assert {name: p.count("split(") for name, p in plans.items() if p.count("split(") > 1} == {} and "split(" not in plans["result"]
    assert not [name for name, p in plans.items() if "regexp_" in p]


def test_license_texts_with_few_rare_words_are_not_asked(spark):
    """F1 op5: only texts that hold enough of a template's rarest words are split again, at any order of the words."""
    texts = ["all rights reserved", "reserved", "rights all the reserved", "all rights", None, "x " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    templates = [("p", "all rights reserved"), ("t", " ".join(f"t{k}" for k in range(40)))]
    read = license_scan.read_texts(docs, {}, templates).cache()
    assert {r.id: sorted(r.tokens) for r in read.collect()} == {0: ["all", "reserved", "rights"], 1: ["reserved"], 2: ["all", "reserved", "rights"], 3: ["all", "rights"], 4: [], 5: []}
    index, _ = license_scan.prefix_index(["reserved", "rights", "all", *(f"t{k}" for k in range(40))], templates, 0.85)
    asked = license_scan.asked_texts(read, index).join(read, "t").select("id", "nos").collect()
    assert sorted((r.id, r.nos) for r in asked) == [(0, [0]), (2, [0])]


def test_license_phrases_at_ends_and_among_other_letters(spark):
    """F1 op5: places are counted from the split that the words come from, empty strings at its ends or not."""
    phrases = {**queries.PHRASES, "é ok": "own", "mit": "short", "a b c": "wide"}
    base = ["cc by nc", "CC-BY-NC cc by nc", "x Cc by nc", "x y cc by nc by nc cc by nc z", "ccx by nc cc by", "é OK", "É ok", "mit MIT. mİt", "K mit Σ", "A B c", "under the mit license"]
    texts = [a + t + b for t in base for a in ("", " ", "(\n") for b in ("", "!", " é")] + ["", None, "  ", "\x00", "é"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for r in license_scan.scan(rows, phrases, ()).collect():
        words, at, labels = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r.doc_id] or "").translate(LOW)), [], set()
        for phrase, label in phrases.items():
            p = phrase.split(" ")
            hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            at, labels = at + hits, labels | ({label} if hits else set())
        assert tuple(r)[1:] == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels)), float(bool(labels))), texts[r.doc_id]
