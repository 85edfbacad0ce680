"""The training-data operators against brute force on small tables with nulls, ties, empty and long texts."""

import base64
import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, exact_dedup, lexicon, license_scan, license_texts, line_dedup, mixing, near_dedup, quality, queries, substring_dedup, url_filter, warc
from tidemark.llm.common import scratch

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, copies string, id string"


def rows_of(texts):
    return [(k, t, "en" if k % 3 else None, f"s{k % 4}" if k % 5 else None, len(t or ""), "x", "y", "z") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def texts():
    rs = random.Random(7)
    words = ["".join(rs.choice("abcdeé") for _ in range(rs.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rs.choice(words) for _ in range(n))
    base, line = say(120), "A Common  line"
    near = base.split()
    near[60] = "changed"
    out = [None, "", "   \t\n", base, base.upper(), base, " ".join(near), "one two", "ONE two", say(9000), "x" * 20_000]
    out += [f"{say(30)}\n  {line if k % 2 else line.lower()}\t\n{say(30)}" for k in range(12)]
    out += ["Under the MIT License. under the mit license", "licensed under CC-BY-NC 4.0!", "Apache License, Version 2.0", "this work is licensed under the gnu general public license version 3"]
    out += [say(60) for _ in range(40)] + ["#$%& " * 80, "<|endoftext|> a\x1cb\u00a0c ΣΑΣ İ 漢字 😀"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r[0]: r for r in df.collect()}


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = sorted({b"tap", b"taps", b"top", b"tops", b"stop", b"stops", "é".encode()})
    lexicon.save(lexicon.compile_words(words), str(tmp_path / "x"))
    arrays = lexicon.load(str(tmp_path / "x"))
    assert lexicon.ranks(arrays, words).tolist() == list(range(len(words)))
    assert lexicon.ranks(arrays, [b"", b"t", b"tapss", b"zz", b"top"]).tolist() == [-1, -1, -1, -1, words.index(b"top")]
    assert len(arrays["final"]) < 1 + sum(map(len, words)) - 6  # suffixes are shared
    assert lexicon.ranks(lexicon.compile_words([]), [b"a"]).tolist() == [-1]


def test_bpe_equals_the_library(spark, docs, texts, none):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_file())
    names = bpe.build(spark, docs, queries.tokenizer_file())
    found, coded = by_id(bpe.round_trip(docs, names)), bpe.encode(docs, names)
    ids, back = by_id(coded), by_id(bpe.decode(coded, names))
    assert len(found) == len(texts)
    for k, t in enumerate(texts):
        want = own.encode(t or "", add_special_tokens=False).ids
        text = own.decode(want, skip_special_tokens=False)
        assert ids[k].ids == want and ids[k].n_tokens == len(want) and back[k].text == text
        assert found[k].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert found[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(none, bpe.build(spark, none, queries.tokenizer_file())).count() == 0


def test_url_rules_and_templates(spark):
    urls = ["http://A.example.org/es/1?q", "https://example.org/en/12#x", "http://example.org/en/2", "http://example.orgx/es/1", "x://org?/es/", "http://org/", "nothing", None, "", "http://b.com/de/x/://y", "http://b.com/DE/x", "http://h.net/bad/1"]
    pages = spark.createDataFrame([(k, u, "h", "c") for k, u in enumerate(urls)], "page_id bigint, url string, host string, path string")
    found = by_id(url_filter.judge(pages, None, queries.RULES))
    want = [("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "/en/2", "org/", "allow"), ("example.orgx", "/es/1", None, "allow"), ("org", "", None, "allow"), ("org", "/", "org/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b.com", "/de/x/://y", "com/de/", "block"), ("b.com", "/DE/x", None, "allow"), ("h.net", "/bad/1", None, "allow")]
    for k, w in enumerate(want):
        assert (found[k].host, found[k].path, found[k].rule, found[k].verdict) == w
    assert url_filter.judge(pages.limit(0), None, queries.RULES).count() == 0


def test_url_sections_are_told_apart(spark):
    """Hosts of a hundred URLs: sections of one badness merge, the bad one is rejected, ids are wildcards."""
    urls, bad = [], []
    for h, sections in (("a.net", ("news", "spam", "blog", "shop")), ("b.net", ("docs", "about"))):
        for k in range(120):
            section = sections[k % len(sections)]
            urls.append(f"http://{h}/x/{section}/{k}?q={k}")
            bad.append(None if k % 3 == 0 else int(section == "spam" or k % 40 == 1))
    # Every URL of one host is bad; a few are far deeper than any other path, one of them alone.
    urls += [f"http://c.net/{'d/' * 9}{'good' if k % 2 else 'evil'}/{k}" for k in range(80)] + ["http://c.net/" + "e/" * 3000]
    bad += [int(k % 2 == 0) for k in range(80)] + [None]
    # A large host whose one small section is bad.
    urls += [f"http://big.net/s{k % 31}/{k}" for k in range(4000)] + [f"http://big.net/tiny/{k}" for k in range(60)] + ["http://big.net/s1/1", "http://big.net/s1/1"]
    bad += [int(k % 50 == 0) for k in range(4000)] + [1] * 60 + [None, None]
    pages = spark.createDataFrame([(k, u, "x", "y") for k, u in enumerate(urls)], "page_id bigint, url string, template string, n string").repartition(5)
    labels = spark.createDataFrame([(k, b) for k, b in enumerate(bad)] + [(None, 1), (3, None)], "id bigint, bad int")
    found = by_id(url_filter.judge(pages, labels, ()))
    assert len(found) == len(urls)
    for k, u in enumerate(urls):
        wanted = "block" if "/spam/" in u or "/evil/" in u or "/tiny/" in u else "allow"
        assert found[k].verdict == wanted, (u, found[k])
    template = lambda part: {found[k].template for k, u in enumerate(urls) if part in u}
    assert template("a.net/x/spam") == {"/x/spam/*"} and template("a.net/x/news") == template("a.net/x/blog") == {"/x/{blog,+2}/*"}
    assert template("/evil/") == {"/d" * 9 + "/evil/*"} and template("e/e/e") == {"/*" * 3000} and template("/tiny/") == {"/tiny/*"}
    assert len(template("big.net/s")) == 1 and all(r.verdict == "allow" for r in url_filter.judge(pages, labels.limit(0), ()).collect())
    # Without keys and with repeated rows.
    none = url_filter.judge(pages.withColumn("page_id", F.lit(None).cast("bigint")).unionByName(pages.limit(0)), labels, ()).collect()
    assert len(none) == len(urls) and {r.verdict for r in none} == {"allow"}


@pytest.mark.parametrize("parts", [1, 7])
def test_lines_found_in_many_documents_go(spark, docs, texts, none, parts):
    found = by_id(line_dedup.drop_frequent(docs, line_dedup.batches_of(docs, parts), threshold=10, fanout=2))
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(LOW)
    seen = collections.Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} - {""})
    for k, t in enumerate(texts):
        lines = (t or "").split("\n")
        kept = [x for x in lines if seen[key(x)] < 10]
        assert (found[k].n_lines, found[k].n_dropped, found[k].text) == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert sum(r.n_dropped for r in found.values()) == 12
    assert line_dedup.drop_frequent(none, [none]).count() == 0


def test_line_runs_merge_without_moving(spark):
    counts = lambda *pairs: spark.createDataFrame([(a, -a, n) for a, n in pairs], "a bigint, b bigint, n bigint")
    runs = line_dedup.LineRuns(spark, threshold=10)
    for batch in (((1, 4), (2, 12), (3, 1)), ((1, 6), (2, 5), (4, 1)), ((1, 9), (3, 8)), ((3, 1), (5, 9)), ((4, 9),)):
        runs.add(counts(*batch))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    held = sorted((r.a, r.n) for level in runs.levels for name in level for r in spark.table(name).where("NOT frequent").collect())
    assert held == [(4, 1), (4, 9), (5, 9)]
    assert sorted(r.a for r in runs.frequent().collect()) == [1, 2, 3, 4]
    plan = runs.merged([runs.levels[0][0], runs.levels[2][0]])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    names = list(runs.runs)
    runs.close()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_line_batches_hold_every_row_once(spark, docs, tmp_path):
    docs.repartition(12).write.parquet(str(tmp_path / "many"))
    docs.coalesce(1).write.parquet(str(tmp_path / "one"))
    many, one = spark.read.parquet(str(tmp_path / "many")), spark.read.parquet(str(tmp_path / "one"))
    for table in (many, one, many.where("doc_id > 5"), many.unionByName(one), one.withColumn("doc_id", F.lit(None).cast("bigint"))):
        parts = line_dedup.batches_of(table, 3)
        assert len(parts) == 3 and sum(p.count() for p in parts) == table.count()
    twice = docs.where("doc_id in (11, 12)").withColumn("doc_id", F.lit(None).cast("bigint"))
    for _ in range(3):
        twice = twice.unionByName(twice)
    # Eight rows each of two texts, without ids: their lines are found in eight documents, the common one in sixteen.
    assert {(r.doc_id, r.n_dropped) for r in line_dedup.drop_frequent(twice, line_dedup.batches_of(twice, 2)).collect()} == {(None, 1)}


def test_quality_counts_and_verdicts(spark, docs, texts, none):
    found = by_id(quality.judge(docs))
    for k, t in enumerate(texts):
        words, t = WORD.findall(t or ""), t or ""
        windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        again = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))
        assert tuple(found[k])[1:6] == want
        failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
        assert found[k].base_failed == failed and not (failed and found[k].kept)
    assert not found[len(texts) - 2].kept
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in found.items() if r.kept}
    assert quality.judge(none).count() == 0 and quality.keep(none).count() == 0


def test_sketches_merge(spark):
    values = [(k % 2, k) for k in range(4000)]
    both = spark.createDataFrame([(g, 10_000, v, 0, 0, 0) for g, v in values], "g int, n_words bigint, n_repeat_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint")
    by_group = quality.sketches(both, ("g",))
    merged, whole = quality.merge_sketches(by_group, ()), quality.sketches(both, ())
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    q = quality.quantiles(merged, ()).where("rate = 'repeat_rate'").first()
    assert q.docs == 4000 and all(-1 <= q[f"q{p}"] - 40 * p <= 40 * p / 60 + 1 for p in (25, 50, 75, 90, 99))


def test_thresholds_adapt_to_groups(spark):
    """One text is junk in a source of prose and the rule in a source of code; a source with a third of junk loses it."""
    rs = random.Random(6)
    words = ["".join(rs.choice("abcdefgh") for _ in range(rs.randint(3, 7))) for _ in range(3000)]
    say = lambda n: [rs.choice(words) for _ in range(n)]
    code = lambda: " ".join(w + "#$" for w in say(100))
    long = lambda: " ".join(w * 3 for w in say(100))
    rows = []
    for source, kinds in (("code", [code] * 10), ("prose", [None] * 10), ("more", [None] * 10), ("mixed", [None, None, code] * 10), ("names", [None] * 99 + [long])):
        rows += [(source, None if k is None else "junk", " ".join(say(100)) if k is None else k()) for k in kinds * (300 // len(kinds))]
    docs = spark.createDataFrame([(i, t, "en", s, kind) for i, (s, kind, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string, kind string").repartition(4)
    kept = by_id(quality.judge(docs))
    share = lambda source, kind: np.mean([kept[i].kept for i, (s, k, _) in enumerate(rows) if (s, k) == (source, kind)])
    assert share("code", "junk") > 0.95 and share("mixed", "junk") == 0 and share("names", "junk") == 0
    assert min(share(s, None) for s in ("prose", "more", "mixed", "names")) > 0.95
    limits = {r.source: r for r in quality.thresholds(quality.counted(docs, "doc_id", "text", "lang", "source")).collect()}
    assert len({limits[s].symbol_rate for s in ("code", "prose")}) == 2 and limits["mixed"].symbol_rate < limits["code"].symbol_rate
    odd = docs.withColumnsRenamed({"kind": "n_words", "doc_id": "c0"}).withColumn("l_lang", F.lit("x"))
    assert quality.keep(odd, id_col="c0").columns == odd.columns and quality.keep(odd, id_col="c0").count() == sum(r.kept for r in kept.values())


def test_license_phrases_and_templates(spark, docs, texts, none):
    found = by_id(license_scan.scan(docs, queries.PHRASES))
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for k, t in enumerate(texts):
        words, at, labels = word.findall((t or "").translate(LOW)), [], set()
        for phrase, label in queries.PHRASES.items():
            p = phrase.split()
            hits = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
            at, labels = at + hits, labels | ({label} if hits else set())
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert any(r.labels == "gpl-3" for r in found.values())
    assert license_scan.scan(none, queries.PHRASES).count() == 0
    # The filters lose no block: every share of a template's tokens in every block, by counting.
    rs = random.Random(3)
    every = [(label, license_scan.template_words(t), license_scan.least_of(t), license_scan.shape_of(t)) for label, t in license_scan.TEMPLATES]
    universe = sorted({w for _, t, *_ in every for w in t})
    blocks = []
    for _, t, *_ in every:
        for _ in range(25 if len(t) <= 256 else 4):
            some = rs.sample(range(len(t)), rs.randint(len(t) * (7 if len(t) <= 256 else 9) // 10, len(t)))
            blocks.append(" ".join([*rs.choices(universe, k=rs.randint(0, 90)), *(t[i] for i in sorted(some)), *rs.choices(universe, k=rs.randint(0, 9))]))
    table = spark.createDataFrame(list(enumerate(blocks)), "doc_id bigint, text string").repartition(4)

    def best(words, t, shape):
        if shape.half:
            return max(len(set(words[i : i + 2 * shape.half]) & set(t)) for i in range(0, len(words), shape.half))
        found, seq = [0], list(dict.fromkeys(t))
        for i, w in enumerate(words):
            if w in seq:
                run = words[i : i + shape.run]
                places = [run.index(x) for x in seq if x in run]
                found.append(len(places) if places == sorted(places) else 0)
        return max(found)

    shares = set()
    for k, r in by_id(license_scan.scan(table, {})).items():
        words, hits = blocks[k].split(), {}
        for label, t, least, shape in every:
            n = best(words, t, shape)
            if n >= least:
                hits[label] = max(hits.get(label, 0), n / len(set(t)))
        assert r.labels == ",".join(sorted(hits)) and r.score == pytest.approx(max(hits.values(), default=0))
        shares.add(r.score)
    assert len([s for s in shares if 0 < s < 1]) > 10
    again = table.unionByName(table).withColumn("doc_id", F.lit(None).cast("bigint"))
    assert len({tuple(r) for r in license_scan.scan(again, {}).collect()}) <= len(blocks) and license_scan.scan(again, {}).count() == 2 * len(blocks)


def test_license_statements_over_several_lines(spark):
    wrapped = {
        "mit": "# Copyright X\n#\n# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the Software), to deal",
        "bsd": "Redistribution and use in source and binary forms, with or without\r\nmodification, are permitted provided that the following conditions\r\nare met:",
        "gpl": " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License",
        "proprietary": "\n".join("All Rights Reserved".split()),
    }
    far = lambda t: "\n".join(f"word{k} other\nline" for k in range(50)) + "\n" + t + "\n" + "\n".join("some more words" for _ in range(70))
    rows = [(f"{label}{k}", x, 1) for label, t in wrapped.items() for k, x in enumerate((t, far(t)))]
    rows += [("none0", "all\n" + "word\n" * 200 + "rights reserved"), ("none1", "any code\nassociated\n\n")]
    rows = [(*r, "x")[:3] for r in rows]
    for k, r in by_id(license_scan.scan(spark.createDataFrame([(a, b, "c") for a, b, _ in rows], "doc_id string, text string, token string"), {})).items():
        assert r.labels == ("" if k[:-1] == "none" else k[:-1]) and r.score == (0 if k[:-1] == "none" else 1)


def test_license_words_out_of_order_full_texts_and_a_million_places(spark):
    full = dict(license_texts.FULL_TEXTS)
    edited = re.sub(r"\bProgram\b", "Work", full["gpl-3"]).replace("General Public License", "GPL", 40)
    rows = {
        "staff": ("all of the staff " + " ".join(f"w{k}" for k in range(20)) + " were reserved for human rights", ""),
        "rights": ("All human rights are reserved. (c) All rights were reserved", ""),
        "own": ("(c) X. All rights reserved.", "proprietary"),
        "mixed": ("the license mit under released", ""),
        "apache": ("Licensed under Apache License, Version 2.0", "apache-2"),
        "gpl": ("some words " * 700 + edited + " more words" * 300, "gpl-3"),
        "lgpl": ("x " * 5000 + full["lgpl-2.1"].upper(), "lgpl-2.1"),
        "half": (full["gpl-3"][: len(full["gpl-3"]) // 2], ""),
        "places": ("cc by nc " * 1_000_000, "cc-by-nc"),
        "long": ("word\n" * 2_000_000 + "all rights\nreserved", "proprietary"),
    }
    found = by_id(license_scan.scan(spark.createDataFrame([(k, t) for k, (t, _) in rows.items()], "doc_id string, text string").repartition(4), queries.PHRASES))
    for k, (_, labels) in rows.items():
        missing = set(labels.split(",")) - set(found[k].labels.split(","))
        assert not missing if k in ("gpl", "lgpl") else found[k].labels == labels, (k, found[k])
    assert "lgpl" not in found["gpl"].labels and "gpl-2" not in found["lgpl"].labels.split(",") and "gpl-3" not in found["lgpl"].labels.split(",")
    assert tuple(found["places"])[1:5] == (3_000_000, 1_000_000, 0, 2_999_997)


@pytest.mark.parametrize("keep", ["min", "max"])
@pytest.mark.parametrize("colliding", [False, True])
def test_exact_groups_survive_collisions(docs, texts, none, keep, colliding):
    hash128 = (lambda c: F.unhex(F.substring(F.md5(c), 1, 2))) if colliding else exact_dedup.content_hash
    found = by_id(exact_dedup.groups_of(docs, keep=keep, hash128=hash128))
    groups = collections.defaultdict(list)
    for k, t in enumerate(texts):
        groups[(t or "").translate(LOW)].append(k)
    for norm, ids in groups.items():
        for k in ids:
            best = (min if keep == "min" else max)(ids)
            assert tuple(found[k]) == (k, best, len(ids), k == best, hashlib.sha256(norm.encode()).hexdigest())
    assert exact_dedup.groups_of(none).count() == 0


def test_exact_dedup_keeps_one_row_of_a_group(docs, texts, none):
    kept = exact_dedup.deduplicate(docs.unionByName(docs.where("doc_id = 3")), keep="min")
    firsts = {}
    for k, t in enumerate(texts):
        firsts.setdefault((t or "").translate(LOW), k)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(firsts.values())
    assert exact_dedup.deduplicate(none).count() == 0


def test_mix_targets_and_samples(spark, docs, texts, none):
    aims = {r.source: r.target for r in mixing.targets(spark.createDataFrame([("a", 100), ("b", 10), ("c", 5), (None, 1000), ("d", 0)], "source string, size bigint")).collect()}
    assert aims == {"a": 200.0, "b": 20.0, "c": 10.0, "d": 0.0, None: 1442.5}
    found = by_id(mixing.mix(docs))
    sources = collections.defaultdict(list)
    for k, t in enumerate(texts):
        r = found[k]
        assert r["size"] == len(WORD.findall(t or "")) and r.taken in (0, r["size"], 2 * r["size"])
        sources[f"s{k % 4}" if k % 5 else None].append(r)
    for rows in sources.values():
        assert rows[0].source_size == sum(r["size"] for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r["size"] for r in rows)
    again = by_id(mixing.mix(docs.repartition(5)))
    assert again == found and mixing.mix(none).count() == 0
    copies = collections.Counter(r.doc_id for r in mixing.mixed(docs).collect())
    assert copies == {k: r.taken // r["size"] for k, r in found.items() if r.taken}


def test_mix_samples_by_weight_within_one_large_source(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("a b c").alias("text"), F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.5).alias("weight"))
    found = mixing.mix(docs, weight=F.col("weight"), budget_percent=50)
    heavy, light = (found.where(f"doc_id % 2 = {k} and taken > 0").count() for k in (0, 1))
    assert heavy + light == 2000 and heavy > 1.2 * light


@pytest.mark.parametrize("few", [200_000, 0])
def test_warc_round_trip_at_any_split(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST_REPEATS", few)
    rs = random.Random(2)
    html = [None, "", "same", "same", "x" * 50_000, "né\x1f", "WARC/1.1\r\n\r\n", "same"] + ["".join(rs.choice("abc \n") for _ in range(rs.randrange(4000))) for _ in range(60)]
    pages = spark.createDataFrame([(k, f"http://h/{k}" if k % 7 else None, h, "z") for k, h in enumerate(html)] + [(None, "u", "no id", "z")], "page_id bigint, url string, html string, payload string").repartition(3)
    path = scratch(spark, "warc-test")
    warc.write(warc.revisits(pages), path)
    last = {}
    for k, h in enumerate(html):
        last[h or ""] = k
    for split in (61, 999, 1 << 20):
        found = {r.record_id: r for r in warc.read(spark, path, split).collect()}
        assert len(found) == len(html) + 1
        for k, h in enumerate(html):
            r, raw = found[f"urn:page:{k}"], (h or "").encode()
            assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert (r.record_type, r.refers_to, r.payload) == (("response", None, raw) if last[h or ""] == k else ("revisit", f"urn:page:{last[h or '']}", None))
    # A header block longer than a read, payloads longer than several, and repeated rows.
    long = "".join(rs.choice("abcdefghijklmnopqrstuvwxyz0123456789%&=") for _ in range(1_400_000))
    rows = [(1, "http://h/" + long[:200_000], "a"), (2, "http://h/2", long), (3, "http://h/3", "b"), (3, "http://h/3", "b"), (4, None, long[::-1] * 2)]
    path = scratch(spark, "warc-test")
    warc.write(warc.revisits(spark.createDataFrame(rows, "page_id bigint, url string, html string")), path)
    for split in (70_001, 1 << 20):
        found = warc.read(spark, path, split).collect()
        assert sorted((r.record_id, r.uri, (r.payload or b"").decode()) for r in found) == sorted((f"urn:page:{k}", u or "", h) for k, u, h in rows)
    empty = scratch(spark, "warc-test")
    warc.write(warc.revisits(pages.limit(0)), empty)
    assert warc.read(spark, empty).count() == 0


def test_documents_without_ids_are_mixed_like_others(spark):
    docs = spark.range(2000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("a b c d"), F.col("id").cast("string")).alias("text"))
    keys = mixing.sizes(docs).select(F.floor((1 - F.col("key")) * mixing.BINS).alias("bin")).groupBy("bin").count()
    assert keys.count() > 1000 and keys.agg(F.max("count")).first()[0] < 12
    taken = mixing.mix(docs, budget_percent=50).where("taken > 0")
    assert taken.count() == 1000 and mixing.mixed(docs, budget_percent=50).distinct().count() == 1000


def test_warc_archives_of_tasks_that_run_twice(spark, tmp_path):
    """What attempts that did not count left is not read, nor are archives without an end; others' folders are read whole."""
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.lit("http://h/").alias("url"), F.concat(F.lit("page "), (F.col("id") % 30).cast("string")).alias("html")).repartition(4)
    path = "file://" + str(tmp_path / "archives")
    warc.write(warc.revisits(pages), path)
    files = sorted((tmp_path / "archives").glob("*.warc.gz"))
    (tmp_path / "archives" / files[0].name.replace(".warc.gz", "-again.warc.gz")).write_bytes(files[0].read_bytes())
    found = warc.read(spark, path).collect()
    assert len(found) == 40 and sum(r.record_type == "revisit" for r in found) == 10
    (tmp_path / "archives" / warc.MANIFEST).unlink()
    assert warc.read(spark, path).count() > 40
    (tmp_path / "archives" / warc.UNFINISHED).touch()
    with pytest.raises(ValueError, match="to their end"):
        warc.read(spark, path)
    # A task whose first attempt fails midway writes under another name the second time.
    import pyspark

    def once(batches, mark=str(tmp_path / "failed")):
        import os

        for k, batch in enumerate(batches):
            yield batch
            if pyspark.TaskContext.get().partitionId() == 0 and not os.path.exists(mark):
                open(mark, "w").close()
                raise RuntimeError("lost")

    rows = warc.revisits(pages)
    path = "file://" + str(tmp_path / "twice")
    try:
        warc.write(rows.mapInArrow(once, rows.schema), path)
    except Exception:
        # A local master does not try a task again; the whole write is.
        warc.write(rows.mapInArrow(once, rows.schema), path)
    found = warc.read(spark, path).collect()
    assert len(found) == 40 and len({r.record_id for r in found}) == 40


def near_brute(texts, size, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    best = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j in range(i):
                if a and sets[j] and best[i] != best[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    best[i] = best[j] = min(best[i], best[j])
    return sets, best


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_components(spark, docs, texts, none, size, percent):
    # A chain and a cloud: variants of a text that isn't there, linked through some of their number only.
    rs = random.Random(11)
    base = [f"w{k}" for k in range(150)]
    cloud = []
    for k in range(40):
        w = list(base)
        for at in rs.sample(range(150), rs.randint(1, 7)):
            w[at] = f"v{k}x{at}"
        cloud.append(" ".join(w))
    every = [*texts, *cloud]
    table = spark.createDataFrame(rows_of(every), SCHEMA).repartition(3)
    found = by_id(near_dedup.components(table, size=size, percent=percent))
    sets, best = near_brute(every, size, percent)
    for k in range(len(every)):
        assert (found[k].n_shingles, found[k].component_id, found[k].kept) == (len(sets[k]), best[k], best[k] == k)
    assert near_dedup.components(none).count() == 0
    kept = near_dedup.keep_one(table, size=size, percent=percent)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [k for k, b in enumerate(best) if b == k]


def test_near_copies_and_mix_tell_rows_by_id_and_text(spark):
    rs = random.Random(13)
    say = lambda: " ".join(f"w{rs.randrange(5000)}" for _ in range(100))
    a, b, c, d, e, f = (say() for _ in range(6))
    near = lambda t: t + " more"
    schema = "doc_id bigint, source string, text string"
    rows = [(1, a), (None, near(a)), (None, b), (None, c), (None, near(c)), (None, c), (7, near(a)), (7, d), (8, e), (8, near(e)), (None, ""), (None, None), (9, f), (9, f)]
    kept = near_dedup.keep_one(spark.createDataFrame([(i, "s", t) for i, t in rows], schema).repartition(3)).collect()
    found = collections.Counter((r.doc_id, r.text) for r in kept)
    assert set(found.values()) == {1} and {(1, a), (None, b), (7, d), (None, ""), (None, None), (9, f)} <= set(found)
    assert len({(None, c), (None, near(c))} & set(found)) == 1 and len({(8, e), (8, near(e))} & set(found)) == 1 and len(found) == 8
    rows = [(None, a), (None, b), (None, c), (5, d), (5, e), (6, f), (6, f)]
    for budget in (100, 200):
        mix = mixing.mixed(spark.createDataFrame([(i, "s", t) for i, t in rows], schema), budget_percent=budget).collect()
        assert collections.Counter((r.doc_id, r.text) for r in mix) == {k: n * budget // 100 for k, n in collections.Counter(rows).items()}


def test_columns_of_any_name_are_carried(spark):
    rs = random.Random(17)
    say = lambda: " ".join(f"w{rs.randrange(5000)}" for _ in range(100))
    texts = [say() for _ in range(6)]
    names = ("__id", "__sha", "__copies", "id", "of", "own", "sha", "copies", "t", "c0", "m_id", "copy", "n_words", "row")
    rows = [(k % 8, "s", t, *[f"{n}{k}" for n in names]) for k, t in enumerate([*texts, texts[0], texts[1].upper(), texts[2] + " more", texts[3]])]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, " + ", ".join(f"{n} string" for n in names)).withColumn("lang", F.lit("en"))
    whole = {tuple(r) for r in docs.collect()}
    for stage in (lambda d: exact_dedup.deduplicate(d, keep="min"), near_dedup.keep_one, lambda d: mixing.mixed(d, budget_percent=100), quality.keep):
        found = stage(docs)
        assert found.columns == docs.columns and {tuple(r) for r in found.collect()} <= whole and stage(docs.limit(0)).count() == 0
    assert exact_dedup.deduplicate(docs, keep="min").count() == 7 and near_dedup.keep_one(docs).count() == 6 and mixing.mixed(docs, budget_percent=100).count() == 10


def test_labels_reach_along_a_chain(spark):
    pair = lambda x: (x, x)
    edges = spark.createDataFrame([(pair(k), pair(k + 1)) for k in range(60) if k != 30], "x struct<a: bigint, b: bigint>, y struct<a: bigint, b: bigint>")
    assert {r.c.a: r.label.a for r in near_dedup.connected(edges).collect()} == {k: 0 if k <= 30 else 31 for k in range(61)}


def test_estimate_is_close():
    rs = np.random.default_rng(1)
    common, a, b = (rs.integers(0, 1 << 63, n, np.uint64) for n in (800, 100, 100))
    x, y = (near_dedup.minima(np.unique(np.concatenate([common, s]))) for s in (a, b))
    same = np.mean([(near_dedup.signature(x) >> np.uint64(s) & np.uint64(15)) == (near_dedup.signature(y) >> np.uint64(s) & np.uint64(15)) for s in range(0, 64, 4)])
    assert abs((same - 1 / 16) / (15 / 16) - 0.8) < 0.15


def test_repeated_passages_are_found_and_cut(spark, none):
    rs = random.Random(4)
    word = lambda: "".join(rs.choice("abcdefghijklmno") for _ in range(rs.randint(2, 9)))
    say = lambda n: " ".join(word() for _ in range(n))
    passages = [say(60) for _ in range(40)]
    rows = [(10 * k + j, f"{say(30 + 7 * j)} {p} {say(25)}") for k, p in enumerate(passages) for j in (1, 2)] + [(1000 + k, say(120)) for k in range(40)]
    rows += [(2000, None), (2001, ""), (2002, "z" * 100_000), (None, say(50))]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("a", F.lit(1))
    found = substring_dedup.repeated_spans(table).collect()
    text = dict(rows)
    # A text of one letter repeats itself.
    assert {r.doc_id for r in found} == {10 * k + j for k in range(40) for j in (1, 2)} | {2002}
    found = [r for r in found if r.doc_id != 2002]
    for r in found:
        k = r.doc_id // 10
        assert text[r.doc_id][r.start : r.end] in f" {passages[k]} " and r.first_ids == [10 * k + 1] and r.dropped == (r.doc_id % 10 == 2)
    left = {r.doc_id: r.text for r in substring_dedup.without_repeats(table).collect()}
    for r in found:
        if r.dropped:
            assert left[r.doc_id] == text[r.doc_id][: r.start] + text[r.doc_id][r.end :]
    assert left[1000] == text[1000] and substring_dedup.repeated_spans(none).count() == 0


def test_repeats_within_a_document_without_ids_and_without_spaces(spark):
    rs = random.Random(8)
    say = lambda n: " ".join("".join(rs.choice("abcdefgh") for _ in range(rs.randint(2, 8))) for _ in range(n))
    han = lambda n: "".join(chr(rs.randrange(0x4E00, 0x9000)) for _ in range(n))
    p, q, r, s = say(60), han(200), say(60), say(60)
    rows = [(1, f"{say(40)} {p} {say(50)} {p} {say(10)}"), (2, han(80) + q + han(70)), (3, han(90) + q), (None, say(30) + " " + r), (None, f"{say(20)} {r}"), (9, say(80)), (9, say(80)), (5, f"{say(9)} {s}"), (5, f"{say(7)} {s}")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = substring_dedup.repeated_spans(table).collect()
    texts = collections.defaultdict(list)
    for k, t in rows:
        texts[k].append(t)
    assert {x.doc_id for x in found} == {1, 2, 3, None, 5}
    for x in found:
        assert any(t[x.start : x.end].strip() in w for t in texts[x.doc_id] for w in (p, q, r, s))
    mine = lambda k: sorted((x.dropped, x.first_ids) for x in found if x.doc_id == k)
    assert mine(1) == [(False, [1]), (True, [1])] and mine(2) == [(False, [2])] and mine(3) == [(True, [2])] and mine(None) == [(False, []), (True, [])] and mine(5) == [(False, [5])] * 2
    # Rows that share id and text are one document.
    again = substring_dedup.repeated_spans(table.unionByName(table)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    left = substring_dedup.without_repeats(table.unionByName(spark.createDataFrame([(7, None), (8, "")], "doc_id bigint, text string")))
    assert left.count() == len(rows) + 2 and sum(len(x.text or "") for x in left.collect()) < sum(len(t) for _, t in rows) - 300


def test_gear_hash_is_the_rolling_sum():
    raw = np.frombuffer(random.Random(1).randbytes(500), np.uint8)
    h, want = 0, []
    for b in raw.tolist():
        h = ((h << 1) + int(substring_dedup.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert substring_dedup.gear_hashes(raw).tolist() == want


def test_chunks_cover_the_text_and_resist_shifts():
    rs = random.Random(5)
    text = "".join(rs.choice("abc défé漢 ") for _ in range(5000))
    raw = np.frombuffer(text.encode(), np.uint8)
    ends = substring_dedup.cuts(raw)
    assert ends[-1] == len(raw) and all(0 < b - a <= substring_dedup.MAX_BYTES + 3 for a, b in zip([0, *ends], ends))
    a, b = (set(substring_dedup.chunk_text(t)[0]) for t in (text, "inserted " + text[:2000] + "xyz" + text[2000:]))
    assert len(a - b) <= 12
