"""DuckDB SQL for the rows of the operators' queries, written plainly: no sketch bins, bands or prefix filters where
the result doesn't depend on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tidemark.llm.common import LOWER, UPPER

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def low(c: str) -> str:
    return f"translate({c}, '{UPPER}', '{LOWER}')"


TEXT = "coalesce(text, '')"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr({h}, CAST((i // 4) * 5 + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1, 1)), '')"


def line_dedup(threshold: int) -> str:
    return f"""WITH l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split({TEXT}, chr(10)) AS ls FROM documents)),
k AS (SELECT *, {low(f"trim(line, {BLANK})")} AS key FROM l),
f AS (SELECT key FROM (SELECT DISTINCT doc_id, key FROM k WHERE key <> '') GROUP BY key HAVING count(*) >= {threshold})
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id"""


def exact_dedup() -> str:
    return f"""SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(n) AS text_sha256
FROM (SELECT doc_id, {low(TEXT)} AS n FROM documents) WINDOW g AS (PARTITION BY n)"""


def warc() -> str:
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last, sha1(h) AS s FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {BASE32.format(h="s")} AS payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to FROM d"""


def mixing(weights: Sequence[int], budget_percent: int, max_epochs: int, least_weight: float) -> str:
    full, n = 100 * max_epochs, len(weights)
    return f"""WITH d AS (SELECT doc_id, source, {TEXT} AS t, CAST(len({WORDS.format(TEXT)}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY 1),
o AS (SELECT *, ([{", ".join(map(str, weights))}])[CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % {n} + 1 AS INTEGER)] AS w, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS pos FROM s),
c AS (SELECT *, sum(size) OVER () AS S, sum(w) OVER () AS V, coalesce(sum(size) OVER r, 0) AS ps, coalesce(sum(w) OVER r, 0) AS pw FROM o WINDOW r AS (ORDER BY size / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, (S * {budget_percent} - ps * {full}) * w > size * {full} * (V - pw) AS capped FROM c),
m AS (SELECT *, coalesce(sum(size) FILTER (capped) OVER (), 0) AS cs, coalesce(sum(w) FILTER (capped) OVER (), 0) AS cw FROM k),
t AS (SELECT source, size AS source_size, CASE WHEN capped THEN CAST(size * {max_epochs} AS DOUBLE) ELSE CAST((S * {budget_percent} - cs * {full}) * w AS DOUBLE) / CAST((V - cw) * 100 AS DOUBLE) END AS target FROM m),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
q AS (SELECT *, greatest({least_weight}, 1 - greatest(4.0 - b, b - 10.0, 0.0) / 20) AS w FROM (SELECT *, strlen(t) / greatest(size, 1) AS b FROM d)),
u AS (SELECT doc_id, source, size, pow((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(t))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0, 1.0 / w) AS key FROM q),
x AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM u)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN before + size / 2 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM x JOIN e ON x.source IS NOT DISTINCT FROM e.source"""


def near_dedup(size: int, percent: int) -> str:
    shingle = " || ' ' || ".join(f"ws[i + {k}]" if k else "ws[i]" for k in range(size))
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(low(TEXT))} AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(ws) < {size} THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - {size - 2}), lambda i: {shingle}) END) AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS sh FROM s),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept FROM r JOIN s USING (doc_id) GROUP BY doc_id, sh"""


def license_scan(phrases: Mapping[str, str], templates: Sequence[tuple[str, list[str], int, int | None, int | None]]) -> str:
    """``templates``: (label, words, tokens to share, half window or run)."""
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    text_list = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    at = [f"list_transform(list_filter(range(0, len(ws) - {len(p.split()) - 1}), lambda i: ws[i + 1 : i + {len(p.split())}] = {text_list(p.split())}), lambda i: {{'at': i, 'label': '{label}'}})" for p, label in phrases.items()]
    hits = []
    for label, text, least, half, run in templates:
        tokens, seq = sorted(set(text)), list(dict.fromkeys(text))
        if run is None:
            hits.append(f"SELECT doc_id, '{label}' AS label, len(list_intersect(b, {text_list(tokens)})) / {len(tokens)} AS share FROM b WHERE half = {half} AND len(b) >= {least} AND len(list_intersect(b, {text_list(tokens)})) >= {least}")
            continue
        runs = f"SELECT doc_id, ws, unnest(list_filter(range(len(ws)), lambda i: list_contains({text_list(seq)}, ws[i + 1]))) AS i FROM w WHERE len(list_intersect(ws, {text_list(seq)})) >= {least}"
        places = f"SELECT doc_id, list_filter(list_transform({text_list(seq)}, lambda t: coalesce(list_position(ws[i + 1 : i + {run}], t), 0)), lambda p: p > 0) AS ps FROM ({runs})"
        hits.append(f"SELECT doc_id, '{label}' AS label, len(ps) / {len(seq)} AS share FROM ({places}) WHERE len(ps) >= {least} AND ps = list_sort(ps)")
    halves = ", ".join(map(str, sorted({half for *_, half, _ in templates if half})))
    return f"""WITH w AS (SELECT doc_id, {words.format(low(TEXT))} AS ws FROM documents),
p AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, flatten([{", ".join(at)}]) AS found FROM w),
b AS (SELECT doc_id, half, list_distinct(ws[k + 1 : k + 2 * half]) AS b FROM (SELECT doc_id, ws, half, unnest(range(0, len(ws), half)) AS k FROM w, (SELECT unnest([{halves}]) AS half))),
h AS ({" UNION ALL ".join(hits)}),
a AS (SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM h GROUP BY 1)
SELECT p.doc_id, n_words, CAST(len(found) AS BIGINT) AS n_base, list_min(list_transform(found, lambda x: x.at)) AS first_word, list_max(list_transform(found, lambda x: x.at)) AS last_word,
coalesce(array_to_string(list_sort(list_distinct(list_transform(found, lambda x: x.label))), ','), '') AS base_labels,
coalesce(array_to_string(list_sort(list_distinct(list_concat(list_transform(found, lambda x: x.label), coalesce(a.labels, [])))), ','), '') AS labels,
CASE WHEN len(found) > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score FROM p LEFT JOIN a USING (doc_id)"""


def quality(rates: Sequence[tuple[str, str, str, str, int]], bits: int, spread: int, guard: int, sigmas: int, min_docs: int) -> str:
    value = lambda count, of: f"CASE WHEN {of} > 0 THEN {count} * 10000 // {of} ELSE 0 END"
    each = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS rate, {value(count, of)} AS v FROM m WHERE n_words > 0" for name, count, of, _, _ in rates)
    limits, wanted = [], []
    for name, count, of, kind, p in rates:
        if kind == "tail":
            limits.append(f"max(CAST(least(q{p}, greatest(floor(p{p} * {guard}), q50 * {guard})) AS BIGINT)) FILTER (rate = '{name}') AS {name}")
            over, mean = f"({count} * 10000.0::DOUBLE - {name}::DOUBLE * {of})", f"({name}::DOUBLE * {of})"
            wanted.append(f"({over} <= 0 OR {over} * {over} <= {sigmas * sigmas}::DOUBLE * 10000 * greatest({mean}, 10000.0::DOUBLE))")
        else:
            up = kind == "fence above"
            limits.append(f"max({f'q50 + (q75 - q50) * {spread}' if up else f'q50 - (q50 - q25) * {spread}'}) FILTER (rate = '{name}') AS {name}")
            wanted.append(f"{value(count, of)} {'<=' if up else '>='} {name}")
    qs = ", ".join(f"min(bin) FILTER (cum * 100 >= docs * {p}) AS q{p}" for p in (25, 50, 75, 90, 99))
    level = lambda by: f"SELECT {by + ', ' if by else ''}rate, docs, {qs} FROM (SELECT *, sum(c) OVER (PARTITION BY {by + ', ' if by else ''}rate ORDER BY bin) AS cum, sum(c) OVER (PARTITION BY {by + ', ' if by else ''}rate) AS docs FROM (SELECT {by + ', ' if by else ''}rate, bin, count(*) AS c FROM v GROUP BY ALL)) GROUP BY ALL"
    pick = ", ".join(f"CASE WHEN o.docs >= {min_docs} THEN o.{c} WHEN l.docs >= {min_docs} THEN l.{c} ELSE a.{c} END AS {c}" for c in ("q25", "q50", "q75", "q90", "q99"))
    return rf"""WITH d AS (SELECT doc_id, lang, source, {TEXT} AS t, {WORDS.format(TEXT)} AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i : i + 2] AS tri FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g) WHERE c > 1) GROUP BY 1),
z AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
m AS (SELECT d.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(z.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM d LEFT JOIN r USING (doc_id) LEFT JOIN z USING (doc_id)),
v AS (SELECT lang, source, rate, (((v >> w) + 1) << w) - 1 AS bin FROM (SELECT *, greatest(length(bin(v)) - {bits}, 0) AS w FROM ({each}))),
o AS ({level("lang, source")}), l AS ({level("lang")}), a AS ({level("")}),
t AS (SELECT o.lang, o.source, o.rate, {pick} FROM o JOIN l ON l.rate = o.rate AND l.lang IS NOT DISTINCT FROM o.lang JOIN a ON a.rate = o.rate),
p AS (SELECT *, median(q90) OVER (PARTITION BY lang, rate) AS p90, median(q99) OVER (PARTITION BY lang, rate) AS p99 FROM t),
k AS (SELECT lang, source, {", ".join(limits)} FROM p GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce({" AND ".join(wanted)}, false) AS kept FROM m LEFT JOIN k ON k.lang IS NOT DISTINCT FROM m.lang AND k.source IS NOT DISTINCT FROM m.source"""


#: The 256 checksums of one byte, by the rule of CRC-32.
CRC_TABLE = "SELECT list(c ORDER BY k) AS cs FROM (SELECT k, list_reduce(range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k) AS c FROM (SELECT unnest(range(256)) AS k))"


def crc32(text: str, cs: str = "cs") -> str:
    """CRC-32 of a text's bytes; ``cs`` is the list of CRC_TABLE."""
    each = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda b: CAST('0x' || b AS BIGINT))"
    return f"xor(list_reduce({each}, lambda c, b: xor(c // 256, {cs}[CAST(xor(c, b) % 256 + 1 AS INTEGER)]), 4294967295), 4294967295)"


def fill_in_middle(seed: str, sentinels: Sequence[str], rate: int, spm: int) -> str:
    p, s, m = sentinels
    draw = lambda k: f"CAST('0x' || substr(h, {8 * k - 7}, 8) AS BIGINT)"
    plain = " OR ".join(["t = ''", f"{draw(3)} % 100 >= {rate}", *(f"contains(t, '{x}')" for x in sentinels)])
    part = lambda a, b: f"array_to_string(ls[{a} + 1 : {b}], '')"
    return rf"""WITH d AS (SELECT doc_id, {TEXT} AS t, regexp_extract_all({TEXT}, '[^\n]*\n|[^\n]+') AS ls, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT *, CAST(len(ls) AS BIGINT) AS n, least({draw(1)} % (len(ls) + 1), {draw(2)} % (len(ls) + 1)) AS x, greatest({draw(1)} % (len(ls) + 1), {draw(2)} % (len(ls) + 1)) AS y FROM d),
e AS (SELECT *, {part("0", "x")} AS p, {part("x", "y")} AS m, {part("y", "len(ls)")} AS s, CASE WHEN {plain} THEN 'plain' WHEN {draw(4)} % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{p}' || p || '{s}' || s || '{m}' || m ELSE '{s}' || s || '{p}' || p || '{m}' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM e"""


def sharding(nodes: Mapping[str, list[tuple]], larger: Mapping[str, list[tuple]], seed: str) -> str:
    """``nodes``: children of each node by name, (name, weight, number)."""
    rows = lambda tree: ", ".join(f"('{parent}', '{name}', {weight}, {'NULL' if number is None else number})" for parent, children in tree.items() for name, weight, number in children)
    unit = lambda *parts: "CAST('0x' || substr(md5(concat_ws(':', " + ", ".join(parts) + ")), 1, 13) AS BIGINT)"
    key = "coalesce(CAST(doc_id AS VARCHAR), '')"

    def descent(tree):
        at = f"(SELECT DISTINCT {key} AS key, '' AS node FROM documents)"
        for _ in range(3):
            at = f"(SELECT key, arg_min(name, -ln(({unit(repr(seed), 'name', 'key')} + 0.5) / 4503599627370496.0) / weight) AS node FROM {at} JOIN {tree} ON parent = node GROUP BY key)"
        return f"SELECT key, CAST(number AS INTEGER) AS shard FROM {at} JOIN {tree} ON name = node"

    return f"""WITH t AS ({CRC_TABLE}), a(parent, name, weight, number) AS (VALUES {rows(nodes)}), b(parent, name, weight, number) AS (VALUES {rows(larger)}),
d AS (SELECT doc_id, {key} AS key, CAST(strlen({TEXT}) + 1 AS BIGINT) AS size, CAST({crc32(TEXT)} AS BIGINT) AS text_crc32 FROM documents, t),
x AS ({descent("a")}), y AS ({descent("b")})
SELECT doc_id, size, text_crc32, 'key' AS law, x.shard, row_number() OVER (PARTITION BY x.shard ORDER BY {unit(repr(seed + "-slot"), "d.key", "size", "text_crc32")}, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, y.shard AS grown_shard FROM d JOIN x USING (key) JOIN y USING (key)"""


def merkle(fields: Sequence[str], tampered: str) -> str:
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"
    leaf = lambda change: "sha256(" + " || ".join(field(f"({c} + 1)" if change and c == tampered else c) for c in fields) + ")"
    grow = lambda name, by: f"""SELECT {by}, 0 AS level, i, n, leaf AS h FROM {name} UNION ALL
SELECT {by}, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {{}} WHERE n > 1 GROUP BY {by}, level, i // 2, n"""  # noqa: E731
    step = lambda by: f"""SELECT f.doc_id, f.lang, f.level + 1, f.i // 2, (f.n + 1) // 2, f.stage, sha256(CASE WHEN f.i % 2 = 1 THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END), f.proof || coalesce(s.h, '') FROM {{}} f LEFT JOIN {{}} s ON {by}s.level = f.level AND s.i = xor(f.i, 1) WHERE f.n > 1"""
    return f"""WITH RECURSIVE t AS ({CRC_TABLE}),
d AS (SELECT doc_id, lang, {leaf(False)} AS leaf, CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {leaf(True)} ELSE {leaf(False)} END AS presented FROM documents, t),
l AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
nodes(lang, level, i, n, h) AS ({grow("l", "lang").format("nodes")}),
subs AS (SELECT lang, h AS leaf, row_number() OVER (ORDER BY lang IS NOT NULL, encode(lang)) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(k, level, i, n, h) AS ({grow("(SELECT *, 0 AS k FROM subs)", "k").format("tops")}),
f(doc_id, lang, level, i, n, stage, h, proof) AS (SELECT doc_id, lang, 0, i, n, 0, presented, '' FROM l UNION ALL {step("s.lang IS NOT DISTINCT FROM f.lang AND ").format("f", "nodes")}),
g(doc_id, lang, level, i, n, stage, h, proof) AS (SELECT f.doc_id, f.lang, 0, s.i, s.n, 1, f.h, proof FROM f JOIN subs s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1 UNION ALL {step("").format("g", "tops")})
SELECT g.doc_id, d.leaf, subs.leaf AS subroot, r.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = r.h AS verified
FROM g JOIN d ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.lang IS NOT DISTINCT FROM g.lang JOIN subs ON subs.lang IS NOT DISTINCT FROM g.lang, (SELECT h FROM tops WHERE n = 1) r WHERE g.n = 1"""
