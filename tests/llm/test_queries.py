"""Registered queries that SQL can't express, on given tables, against plain Python."""

import collections
import fractions
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, substring_dedup, url_filter
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


def brute_templates(rows):
    """Templates of (host, segments, bad) by walking down from each host; siblings are merged on their own counts."""
    found = [None] * len(rows)

    def apart(a, b):
        (m, x), (n, y) = a, b
        p = (x + y) / (m + n)
        return abs(x / m - y / n) > url_filter.Z * math.sqrt(p * (1 - p) * (1 / m + 1 / n))

    def walk(members, level, prefix):
        below = []
        for k in members:
            if len(rows[k][1]) > level:
                below.append(k)
            else:
                found[k] = prefix
        told = [rows[k][2] for k in below if rows[k][2] is not None]
        if len(set(told)) < 2 or len(below) < 2 * url_filter.MIN_URLS:
            for k in below:
                found[k] = prefix + "/*" * (len(rows[k][1]) - level)
            return
        by_part = collections.defaultdict(list)
        for k in below:
            by_part[rows[k][1][level]].append(k)
        counts = {}
        for part, ks in by_part.items():
            own = [rows[k][2] for k in ks if rows[k][2] is not None]
            if own and len(ks) >= url_filter.MIN_URLS and len(ks) >= math.sqrt(len(below)) / 2:
                counts[part] = (len(own), sum(own))
        clusters = []
        for part in sorted(counts, key=lambda p: (fractions.Fraction(counts[p][1], counts[p][0]), p)):
            if clusters and not apart(clusters[-1][1], counts[part]):
                parts, (n, x) = clusters[-1]
                clusters[-1] = ([*parts, part], (n + counts[part][0], x + counts[part][1]))
            else:
                clusters.append(([part], counts[part]))
        rest = set(by_part) - set(counts)
        for parts, _ in clusters:
            name = parts[0] if len(parts) == 1 else f"{{{min(parts)},+{len(parts) - 1}}}"
            walk([k for p in parts for k in by_part[p]], level + 1, f"{prefix}/{name}")
        if rest:
            walk([k for p in rest for k in by_part[p]], level + 1, prefix + "/*")

    by_host = collections.defaultdict(list)
    for k, (host, _, _) in enumerate(rows):
        by_host[host].append(k)
    for members in by_host.values():
        walk(members, 0, "")
    return found


@pytest.mark.parametrize("planted", [False, True])
def test_url_filters_by_brute_force(spark, tmp_path, planted):
    """On the given pages, and on the same with labels that follow the language and the number of the page."""
    labels = {r.doc_id: int(r.quality == 0 or r.toxic == 1) for r in table(spark, SF, "labels").collect()}
    pages = table(spark, SF, "pages")
    if planted:
        # Four times as many pages of a quarter of the hosts, so that hosts have sections of some size.
        pages = pages.withColumn("url", F.regexp_replace("url", "://[^/]*", "://big.example.net").alias("url")).unionByName(pages)
        labels = {k: int((k % 10 < 8) if k % 3 == 0 else k % 10 == 0) for k in range(20_000) if k % 2}
        pages = pages.withColumn("url", F.regexp_replace("url", r"/en/(\d*[0369])\b", "/en/x/$1"))
    number = F.regexp_extract(url_filter.path_of(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1).try_cast("bigint")
    told = spark.createDataFrame(list(labels.items()), "id bigint, bad int")
    got = url_filter.judge(pages, told, queries.RULES, label_key=number).collect() if planted else queries.op2_url_filters(spark, SF).collect()
    got = collections.Counter(map(tuple, got))
    pages = pages.collect()
    rows, heads = [], []
    for r in pages:
        rest = r.url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        number = re.search(r"/(\d{1,18})(?:\.html)?/?$", path)
        heads.append((host.lower(), path))
        rows.append((host.lower(), [p for p in path.split("/") if p], labels.get(int(number[1])) if number else None))
    found = brute_templates(rows)
    known = [b for _, _, b in rows if b is not None]
    share, k = sum(known) / len(known), url_filter.SMOOTHING
    smooth = lambda bs, prior: (sum(bs) + k * prior) / (len(bs) + k)
    by_host, by_template = collections.defaultdict(list), collections.defaultdict(list)
    for (host, _, bad), t in zip(rows, found):
        if bad is not None:
            by_host[host].append(bad)
            by_template[host, t].append(bad)
    want, decided = collections.Counter(), collections.Counter()
    for r, (host, path), t in zip(pages, heads, found):
        fit = [(len(x), x, v) for v, x in queries.RULES if ("." + host).endswith("." + x.split("/", 1)[0]) and path.startswith("/" + x.split("/", 1)[1])]
        badness = smooth(by_template[host, t], smooth(by_host[host], share))
        rule, verdict = max(fit)[1:] if fit else (None, "block" if badness >= url_filter.REJECT else "allow")
        want[r.page_id, host, path, rule, verdict, t, round(badness, 9)] += 1
        decided[verdict] += rule is None
    assert collections.Counter({(*g[:6], round(g[6], 9)): n for g, n in got.items()}) == want
    if planted:
        assert decided["block"] > 10 and decided["allow"] > 20 and len({t for _, t in by_template}) > 3


def test_bpe_of_the_whole_table_equals_the_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(queries.tokenizer_file())
    got = {r.doc_id: r for r in queries.op1_bpe(spark, SF).collect()}
    for r in table(spark, SF, "documents").collect():
        ids = own.encode(r.text or "", add_special_tokens=False).ids
        text = own.decode(ids, skip_special_tokens=False)
        assert tuple(got[r.doc_id])[1:4] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def plain_chunks(text):
    """Chunks of a text by the plain rolling sum, byte by byte: (bytes, end in code points)."""
    raw, found, last, h = text.encode(), [], 0, 0
    begins = lambda i: i >= len(raw) or raw[i] & 0xC0 != 0x80
    wanted = set()
    for i, b in enumerate(raw):
        h = ((h << 1) + int(substring_dedup.GEAR[b])) & 0xFFFFFFFF
        if h & substring_dedup.CUT_BITS == 0:
            end = i + 1
            while not begins(end):
                end += 1
            wanted.add(end)
    while last < len(raw):
        end = next((e for e in range(last + substring_dedup.MIN_BYTES, min(last + substring_dedup.MAX_BYTES, len(raw)) + 1) if e in wanted), None)
        if end is None:
            end = min(last + substring_dedup.MAX_BYTES, len(raw))
            while not begins(end):
                end -= 1
        found.append((raw[last:end], len(raw[:end].decode())))
        last = end
    return found


def test_repeated_spans_by_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    cut = {k: plain_chunks(t) for k, t in texts.items()}
    holders = collections.defaultdict(list)
    for k in sorted(cut):
        for n, (c, _) in enumerate(cut[k]):
            holders[c].append((k, n))
    want = set()
    for k, own in cut.items():
        run = []
        for n in range(len(own) + 1):
            if n < len(own) and len(holders[own[n][0]]) > 1:
                run.append(n)
                continue
            if run:
                start, end = own[run[0] - 1][1] if run[0] else 0, own[run[-1]][1]
                words = sum(1 for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[k]) if start <= m.start() < end)
                if words >= substring_dedup.MIN_WORDS or (end - start >= substring_dedup.MIN_CHARS and end - start > substring_dedup.LONG_WORD * words):
                    firsts = {holders[own[i][0]][0][0] for i in run}
                    again = any(f < k for f in firsts) or any(holders[own[i][0]][0] < (k, i) for i in run)
                    want.add((k, start, end, words, len(run), tuple(sorted(firsts)), again))
            run = []
    got = {(r.doc_id, r.start, r.end, r.n_words, r.n_chunks, tuple(r.first_ids), r.dropped) for r in queries.op10_substring_dedup(spark, SF).collect()}
    assert got == want
