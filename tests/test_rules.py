"""Scalar rules, identifiers, hashes, records, ledgers, catalogues and streams on literal rows."""

import datetime as dt
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.functions import hashing, ids, values
from tidemark.operators import capture, catalogue, events, ledger, lookups, stats, trees
from tidemark.scratch import cleared, cut, shared_path, written
from tidemark.sources import families, records, windows
from tidemark.streaming import streams


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_filters_keep_three_valued_logic(spark):
    rows = spark.createDataFrame([("a_b1",), ("axb1",), (None,)], "s string")
    assert [r.x for r in rows.select(values.not_starts_with(F.col("s"), "a_b").alias("x")).collect()] == [False, True, None]
    assert rows.where(values.row_filter(F.col("s"), "NOT_EQ", "a_b1")).count() == 1
    with pytest.raises(ValueError):
        values.not_starts_with(F.col("s"), "")


def test_ids(spark):
    made = one(spark, ids.uuid7_at(F.lit(1_700_000_000_123).cast("bigint"), F.lit("seed")))
    assert made == one(spark, ids.uuid7_at(F.lit(1_700_000_000_123).cast("bigint"), F.lit("seed"))) and made[14] == "7" and made[19] in "89ab"
    assert one(spark, ids.uuid7_millis(F.lit(made))) == 1_700_000_000_123 and one(spark, ids.uuid7_time(F.lit(None).cast("string"))) is None
    with pytest.raises(Exception, match="version 7"):
        one(spark, ids.uuid7_time(F.lit("00000000-0000-4000-8000-000000000000")))
    assert one(spark, ids.uuid_text(ids.uuid_bytes(F.lit(made)))) == made and one(spark, ids.uuid_or_null(F.lit("  "))) is None
    for k in (0, 1, -1, (1 << 63) - 1, -(1 << 63)):
        assert bytes(one(spark, ids.key_bytes(F.lit(k).cast("bigint")))) == k.to_bytes(8, "big", signed=True)
        assert one(spark, ids.key_number(ids.key_bytes(F.lit(k).cast("bigint")))) == k
    key = lambda kind: one(spark, ids.partition_key(F.lit(kind), {"char_id": F.lit(5).cast("bigint"), "mail_id": F.lit(6).cast("bigint"), "account_name": F.lit("BoB")}))
    assert key("ServerStartedEvent") is None and bytes(key("AccountAuthAttemptEvent")) == b"bob" and key("MailReadEvent")[7] == 6 and key("ChatMessageEvent")[7] == 5


def test_fnv_against_its_definition(spark):
    def fnv(data):
        h = 0xCBF29CE484222325
        for b in data:
            h = ((h ^ b) * 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
        return h - (1 << 64) if h >> 63 else h

    rows = spark.createDataFrame([(1, -1, "aé", True), (None, 7, None, False)], "a bigint, b int, s string, t boolean")
    found = [r.fnv for r in hashing.fnv1a64(rows, ["a", "b", "s", "t"]).collect()]
    le = lambda k: k.to_bytes(8, "little", signed=True)
    assert found[0] == fnv(le(1) + (0xFFFFFFFF).to_bytes(8, "little") + "aé".encode("utf-16-le") + b"\x01")
    assert found[1] == fnv(le(7) + b"\x00")
    # Batches of texts of many lengths, a few much longer than the rest, after another column's state.
    rs = random.Random(5)
    texts = [None if k % 11 == 0 else "".join(rs.choices("aé😀\x00 z", k=rs.choice([0, 1, 7, 30]))) for k in range(300)] + ["x" * 5000, "y😀" * 3000]
    rows = spark.createDataFrame([(k, s, s) for k, s in enumerate(texts)], "k bigint, s string, t string").repartition(3)
    found = {r.k: r.fnv for r in hashing.fnv1a64(rows, ["k", "s", "t"]).collect()}
    assert found == {k: fnv(le(k) + (s or "").encode("utf-16-le") * 2) for k, s in enumerate(texts)}


def test_offer_lists_hash_without_order(spark):
    kind = "array<struct<item_id: bigint, trader_id: bigint, enchant_level: int, attributes: map<string,int>, count: bigint, unit_price: bigint, currency_id: bigint, packaged: boolean>>"
    a, b = (1, 9, None, {"FIRE": 1, "WATER": 2}, 3, 100, 57, False), (2, 9, 0, None, 3, 100, 57, False)
    c = (1, 9, 0, {"WATER": 2, "FIRE": 1}, 3, 100, 57, False)
    lists = [[a, b], [b, a], [c, b], [a], [a, a]]
    h = [r.h for r in spark.createDataFrame([(x,) for x in lists], f"o {kind}").select(hashing.offers_hash(F.col("o")).alias("h")).collect()]
    assert h[0] == h[1] and len(set(h)) == 4


def test_value_rules(spark):
    m = F.create_map(F.lit("feeAdena"), F.lit("5"), F.lit("feePercent"), F.lit("51"), F.lit("bad"), F.lit("x"))
    assert one(spark, values.seller_fee(m)) is None and one(spark, values.metadata(m, "bad", "int")) is None
    assert one(spark, values.usage_remaining(F.lit(3), F.lit(9))) == 0 and one(spark, values.usage_remaining(F.lit(None).cast("int"), F.lit(9))) is None
    assert one(spark, values.capped(F.lit(9), F.lit(None).cast("int"))) == 9 and one(spark, values.capped(F.lit(9), F.lit(4))) == 4
    assert one(spark, values.carries_state(F.lit(None), F.lit(0))) and not one(spark, values.carries_state(F.lit(None), F.lit(None)))
    assert one(spark, values.localized_map(F.create_map(F.lit("en"), F.lit(" ")))) is None
    assert one(spark, values.prefer_canonical_class(F.lit(None).cast("string"), F.lit(5))) == "5"
    assert one(spark, values.millis_or_null(F.lit(0).cast("bigint"))) is None


def test_records_round_trip_and_dead_letters(spark):
    rows = spark.createDataFrame([(1, "a", False), (2, None, False), (3, "c", True)], "pk bigint, v string, gone boolean")
    out = records.encode_envelope(rows, F.col("pk"), F.struct("pk", "v"), F.lit("t"), F.lit("Kind"), F.col("gone"))
    assert [bytes(r.value) if r.value is not None else None for r in out.orderBy("key").collect()] == [b'{"pk":1,"v":"a"}', b'{"pk":2}', None]
    broken = out.unionByName(out.limit(1).withColumn("value", F.encode(F.lit("{"), "utf-8")))
    good, dead = records.decode_envelope(records.route_by_type(broken, ["Kind"]), "pk bigint, v string")
    assert sorted((r.payload.pk if r.payload else 0) for r in good.collect()) == [0, 1, 2] and dead.count() == 1
    assert records.route_by_type(out, ["Other"]).count() == 0 and records.resolve_topics(rows.withColumn("entity_name", F.lit("x")), {})[1].first().dropped == 3


def test_escalation_and_stats(spark):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [("k", t(0), False), ("k", t(5), False), ("k", t(15), False), ("k", t(20), False), ("k", t(21), True), ("k", t(22), False)]
    found = stats.escalate(spark.createDataFrame(rows, "key string, ts timestamp, ok boolean")).orderBy("ts").collect()
    assert [r.level for r in found] == ["FIRST", "REPEAT", "ESCALATED", "SILENT", None, "FIRST"]
    assert one(spark, stats.reply_type(F.lit("SendCommand"))) == "SendResult" and one(spark, stats.reply_type(F.lit("Ping"))) == "PingResult"
    cycles = spark.createDataFrame([("a", 1, "HEALTHY"), ("a", 2, "DEGRADED"), ("a", 3, "DEGRADED"), ("b", 1, "DEGRADED"), ("c", 1, "DEGRADED"), ("c", 2, "HEALTHY")], "entity string, cycle int, state string")
    assert {r.entity: r.consecutive_errors for r in stats.entity_stats(cycles).collect()} == {"a": 2, "b": 1, "c": 0}


def test_lineage_follows_merges_and_survives_cycles(spark):
    moves = [(1, 2), (2, 3), (4, 3), (9, 9), (5, None), (6, 7), (7, 6), (7, 8)]
    # Forty moves in a row; merges one after another, the first also by a longer way; a merge on a circle.
    moves += [(100 + k, 101 + k) for k in range(40)]
    moves += [(200, 202), (201, 202), (202, 204), (203, 204), (200, 210), (210, 204)]
    moves += [(300, 301), (301, 302), (302, 301)]
    found, lost = events.item_lineage(spark.createDataFrame(moves, "item_id bigint, new_item_id bigint"))
    got = {(r.item_id, r.origin_id, r.steps) for r in found.collect()}
    want = {(2, 1, 1), (3, 1, 2), (3, 4, 1)} | {(101 + k, 100, k + 1) for k in range(40)}
    want |= {(202, 200, 1), (202, 201, 1), (210, 200, 1), (204, 200, 2), (204, 201, 2), (204, 203, 1), (301, 300, 1), (302, 300, 2)}
    assert got == want and {r.item_id for r in lost.collect()} == {6, 7, 8}


def test_lineage_through_many_merges_takes_few_rounds(spark, monkeypatch):
    """Merges one after another, and random moves with circles, against a search from each origin."""
    rounds = []
    monkeypatch.setattr(trees, "cut", lambda df, name: rounds.append(name) or cut(df, name))
    moves = [(k, k + 1) for k in range(300)] + [(1000 + k, k + 1) for k in range(300)]
    found, _ = events.item_lineage(spark.createDataFrame(moves, "item_id bigint, new_item_id bigint"))
    assert rounds.count("ways-better") <= 10
    got = {(r.item_id, r.origin_id): r.steps for r in found.collect()}
    want = {(k, 0): k for k in range(1, 301)} | {(k, 1000 + o): k - o for k in range(1, 301) for o in range(k)}
    assert got == want
    rs = random.Random(8)
    edges = {(a, b) for a, b in ((rs.randrange(60), rs.randrange(60)) for _ in range(90)) if a != b}
    found, lost = trees.shortest_origins(spark.createDataFrame([(b, a) for a, b in edges], "to bigint, origin bigint"))
    tops, want = {a for a, _ in edges} - {b for _, b in edges}, {}
    for top in tops:
        seen, front = {top: 0}, [top]
        while front:
            front = [b for a in front for x, b in edges if x == a and seen.setdefault(b, seen[a] + 1) == seen[a] + 1 and (b, top) not in want and not want.update({(b, top): seen[b]})]
    assert {(r.item_id, r.origin_id): r.steps for r in found.collect()} == want
    assert {r.item_id for r in lost.collect()} == {b for _, b in edges} - {b for b, _ in want}


def test_trees_of_any_depth_and_cycles(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 5), (5, 4), (6, 5), (7, 99)] + [(1000, None)] + [(1001 + k, 1000 + k) for k in range(70)]
    found, lost = catalogue.tree_depth(spark.createDataFrame(rows, "k bigint, p bigint"), "k", "p")
    assert {(r.k, r.root, r.depth) for r in found.collect()} == {(1, 1, 0), (2, 1, 1), (3, 1, 2)} | {(1000 + k, 1000, k) for k in range(71)}
    assert {r.k for r in lost.collect()} == {4, 5, 6, 7}


def test_conditions_of_any_depth(spark):
    tree = json.dumps({"v": 1})
    for k in range(12):
        tree = '{"logic": "AND", "negated": %s, "children": [{"v": %d}, %s]}' % (str(k % 2 == 0).lower(), 100 + k, tree)
    rows = spark.createDataFrame([(1, tree), (2, None), (3, '{"v": 9, "negated": true}'), (4, '{"children": []}')], "k int, c string")
    found = {(r.k, r.path): (r.negated, json.loads(r.leaf).get("v")) for r in catalogue.condition_leaves(rows, "k", "c").collect()}
    assert len(found) == 13 + 2 and found[3, ""] == (True, 9) and found[4, ""] == (False, None)
    assert found[1, "/1" * 12] == (False, 1) and found[1, "/0"] == (False, 111) and found[1, "/1/0"] == (True, 110)
    # Texts that aren't JSON and nodes that aren't right go to a table of their own; what is beside them stands.
    rows = spark.createDataFrame(
        [(1, "{bad"), (2, '{"children": {"v": 1}}'), (3, '{"children": [{"v": 1}, {"negated": "perhaps", "v": 2}, null, {"children": [{"children": 7}, {"b": 2, "a": 1}]}]}'), (4, "null"), (5, '{"children": null, "negated": null}'), (6, "5")], "k int, c string"
    )
    leaves, rejected = catalogue.condition_trees(rows, "k", "c")
    assert sorted((r.k, r.path, r.leaf) for r in leaves.collect()) == [(3, "/0", '{"v":1}'), (3, "/3/1", '{"a":1,"b":2}'), (5, "", '{"children":null,"negated":null}'), (6, "", "5")]
    assert sorted((r.k, r.path) for r in rejected.collect()) == [(1, ""), (2, ""), (3, "/1"), (3, "/3/0")]
    none = catalogue.condition_trees(rows.limit(0), "k", "c")
    assert [df.count() for df in none] == [0, 0] and none[0].columns == ["k", "path", "negated", "leaf"]


def test_brackets_by_list_and_by_merge(spark, monkeypatch):
    steps = spark.createDataFrame([(k * 10, None if k == 99 else k * 10 + 7, k) for k in range(100) if k != 50], "from int, to int, value int")
    rows = spark.createDataFrame([(n, k) for n, k in enumerate((None, -1, 0, 7, 8, 10, 505, 497, 499, 987, 990, 5000, 0))], "id int, level int")
    want = {0: None, 1: None, 2: 0, 3: 0, 4: None, 5: 1, 6: None, 7: 49, 8: None, 9: 98, 10: 99, 11: 99, 12: 0}
    for short in (10_000, 5):
        monkeypatch.setattr(lookups, "SHORT_TABLE", short)
        assert {r.id: r.value for r in lookups.bracket_lookup(rows, steps, "level").collect()} == want
    levels = spark.createDataFrame([(k, k * k) for k in range(1, 30)], "level int, required int")
    for short in (10_000, 5):
        monkeypatch.setattr(lookups, "SHORT_TABLE", short)
        got = {r.x: r.level for r in catalogue.level_of(spark.createDataFrame([(k,) for k in (0, 1, 24, 25, 900)], "x int"), levels, "x").collect()}
        assert got == {0: None, 1: 1, 24: 4, 25: 5, 900: 29}


def test_ledger_claims_and_transitions(spark):
    at = dt.datetime(2024, 1, 1)
    row = lambda i, s, r=None: (i, "buy", 1, 2, s, 0, 7, "{}", r, at, None, None)
    book = spark.createDataFrame([row("a", "STARTED"), row("b", "OK", "res"), row("c", "FAILED"), row("d", "CHARGED"), row("e", "WEIRD")], ledger.RECEIPTS)
    asked = spark.createDataFrame([(x, "sell", at + dt.timedelta(hours=1), 8, 9, 10, "{claim}") for x in "abcdef"] + [("f", "sell", at + dt.timedelta(1), 8, 9, 10, "{late}")], "correlation_id string, command string, ts timestamp, buyer_char_id int, seller_char_id int, mail_id int, claim_json string")
    claims = ledger.claim_outcome(asked, book)
    found = sorted((r.correlation_id, r.ts, r.outcome, r.result_json) for r in claims.collect())
    assert [x[2] for x in found] == ["IN_FLIGHT", "REPLAY_OK", "CLAIMED", "IN_FLIGHT", "IN_FLIGHT", "CLAIMED", "IN_FLIGHT"] and found[1][3] == "res"
    after = {r.correlation_id: r for r in ledger.apply_claims(book, claims).collect()}
    assert len(after) == 6 and after["b"].result_json == "res" and after["b"].command == "buy" and after["d"].charged_adena == 0
    # A reopened receipt keeps its command and parties and takes mail, claim and time; a new one takes all of the claim.
    assert tuple(after["c"]) == ("c", "buy", 1, 2, "STARTED", None, 10, "{claim}", None, at + dt.timedelta(hours=1), None, None)
    assert tuple(after["f"]) == ("f", "sell", 8, 9, "STARTED", None, 10, "{claim}", None, at + dt.timedelta(hours=1), None, None)
    bare = ledger.apply_claims(book, claims.drop("buyer_char_id", "seller_char_id", "mail_id", "claim_json"))
    assert [(r.correlation_id, r.mail_id, r.claim_json) for r in bare.where("correlation_id IN ('c', 'f')").orderBy("correlation_id").collect()] == [("c", None, None), ("f", None, None)]
    told = {r.correlation_id: (r.outcome, r.result_json) for r in ledger.lookup(spark.createDataFrame([(x,) for x in "abcdex"], "correlation_id string"), book).collect()}
    assert told == {"a": ("IN_FLIGHT", None), "b": ("REPLAY_OK", "res"), "c": (None, None), "d": ("IN_FLIGHT", None), "e": ("IN_FLIGHT", None), "x": (None, None)}
    moves = [("a", "charge_if_started", 1, 50, None), ("a", "ok_if_charged", 2, None, "yes"), ("a", "steps_done", 3, None, None), ("a", "steps_done", 4, None, None), ("a", "unheard_of", 5, None, None), ("b", "fail", 1, None, None), ("d", "refund", 1, None, None), ("d", "fail", 2, None, None), ("x", "ok", 1, None, None)]
    moves = spark.createDataFrame([(i, a, at + dt.timedelta(days=n), m, r) for i, a, n, m, r in moves], "correlation_id string, action string, ts timestamp, amount bigint, result_json string")
    settled, told = ledger.settle(book, moves)
    got = {r.correlation_id: r for r in settled.collect()}
    assert (got["a"].status, got["a"].charged_adena, got["a"].result_json) == ("OK", 50, "yes") and got["a"].steps_done_at == at + dt.timedelta(days=3) and got["b"].status == "OK"
    assert (got["d"].status, got["d"].charged_adena, got["d"].mail_id, got["d"].claim_json) == ("FAILED", 0, None, None) and len(got) == 5 and got["e"] == book.where("correlation_id = 'e'").first()
    assert sorted((r.correlation_id, r.action, r.ts.day, r.applied) for r in told.collect()) == [("a", "charge_if_started", 2, True), ("a", "ok_if_charged", 3, True), ("a", "steps_done", 4, True), ("a", "steps_done", 5, False), ("a", "unheard_of", 6, False), ("b", "fail", 2, False), ("d", "fail", 3, True), ("d", "refund", 2, True), ("x", "ok", 2, False)]


def test_settlements_carry_claims(spark):
    at = dt.datetime(2024, 1, 1)
    book = spark.createDataFrame([(k, "buy", 1, 2, "CHARGED", 5, 7, "old", None, at, None, None) for k in "abc"], ledger.RECEIPTS)
    moves = [("a", "refund", 1, None, None, "back", None), ("b", "amend_open", 1, None, None, "new", "old"), ("b", "amend_open", 2, None, None, "newer", "old"), ("b", "ok_if_open", 3, 6, "res", None, None), ("b", "amend_completed", 4, None, None, "last", "new"), ("c", "ok", 1, 9, "r", None, None), ("c", "charge_if_started", 2, 1, None, "no", None)]
    moves = spark.createDataFrame([(i, a, at + dt.timedelta(days=n), m, r, c, x) for i, a, n, m, r, c, x in moves], "correlation_id string, action string, ts timestamp, amount bigint, result_json string, claim_json string, expected_claim_json string")
    after, told = ledger.settle(book, moves)
    got = {r.correlation_id: (r.status, r.charged_adena, r.claim_json, r.result_json, r.mail_id) for r in after.collect()}
    assert got == {"a": ("STARTED", 0, "back", None, 7), "b": ("OK", 6, "last", "res", 7), "c": ("OK", 9, "old", "r", 7)}
    assert sorted((r.correlation_id, r.ts.day) for r in told.where("NOT applied").collect()) == [("b", 3), ("c", 3)]


def sessions_of(spark, rows):
    """(id, key, character, spot or None, open)"""
    fields = [x.split()[0] for x in ledger.SESSIONS.split(", ")]
    at = dt.datetime(2026, 10, 15, 12)
    full = [{"id": i, "idempotency_key": k, "character_id": c, "active_character_id": c if o else None, "spot_pool": "harbor", "spot_id": s, "active_spot_key": f"harbor:{s}" if o and s is not None else None, "started_at": at, "active_ms": 0, "type_state": "a", "ended_at": None if o else at, "end_reason": None if o else "APP_STOPPED"} for i, k, c, s, o in rows]
    return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in full], ledger.SESSIONS)


def one_by_one(sessions, requests):
    """Verdicts of requests (key, character, spot) inserted in their order."""
    keys, chars = {k for _, k, *_ in sessions}, {c for _, _, c, _, o in sessions if o}
    spots = {f"harbor:{s}" for *_, s, o in sessions if o and s is not None}
    out = []
    for key, char, spot in requests:
        verdict = "DUPLICATE" if key in keys else "CHARACTER_ACTIVE" if char in chars else "SPOT_TAKEN" if spot is not None and spot in spots else "ADMITTED"
        if verdict == "ADMITTED":
            keys.add(key), chars.add(char), spots.add(spot)
        out.append(verdict)
    return out


def test_admissions_as_if_one_by_one(spark):
    held = [(1, "k1", 7, 1, True), (2, "k2", 8, 2, False)]
    asked = [("k1", 5, None), ("n1", 5, "harbor:4"), ("n2", 7, "harbor:5"), ("n3", 9, "harbor:1"), ("n3", 9, "harbor:6"), ("n4", 8, "harbor:2"), ("n4", 3, "harbor:7"), ("n5", 5, "harbor:8"), ("n6", 4, "harbor:6"), ("n6", 4, None)]
    rs = random.Random(1)
    many = [(f"m{rs.randrange(60)}", rs.randrange(20, 60), rs.choice([None, f"harbor:{rs.randrange(10, 40)}"])) for _ in range(300)]
    for requests in (asked, many, [("x", 1, None)] * 3, []):
        rows = spark.createDataFrame([(k, c, s, n) for n, (k, c, s) in enumerate(requests)], "idempotency_key string, character_id int, spot_key string, ts bigint").repartition(3)
        found = {r.ts: r.verdict for r in ledger.session_admission(rows, sessions_of(spark, held)).collect()}
        assert [found[n] for n in range(len(requests))] == one_by_one(held, requests)


def test_placements_as_if_one_by_one(spark):
    held = [(1, "a", 7, 1, True), (2, "b", 8, 4, False), (3, "c", 9, 4, True), (4, "d", 10, 5, True), (5, "e", 11, 6, True)]
    wish = [(1, 4), (2, 9), (3, 9), (1, 4), (5, 1), (4, 4), (4, 5), (99, 8)]
    start = dt.datetime(2026, 10, 15, 13)
    rows = spark.createDataFrame([(i, "harbor", s, n, start if n == 3 else None, "b" if n == 3 else None) for n, (i, s) in enumerate(wish)], "id bigint, spot_pool string, spot_id int, ts int, started_at timestamp, type_state string").repartition(3)
    after, judged = ledger.place_sessions(sessions_of(spark, held), rows)
    where, want = {i: f"harbor:{s}" for i, _, _, s, o in held if o}, []
    for i, s in wish:
        spot = f"harbor:{s}"
        verdict = "NOT_OPEN" if i not in where else "SPOT_TAKEN" if spot in where.values() and where[i] != spot else "PLACED"
        if verdict == "PLACED":
            where[i] = spot
        want.append(verdict)
    assert {r.ts: r.verdict for r in judged.collect()} == dict(enumerate(want)) and set(want) == {"NOT_OPEN", "SPOT_TAKEN", "PLACED"}
    got = {r.id: r for r in after.collect()}
    assert {i: r.active_spot_key for i, r in got.items() if r.ended_at is None} == where and got[2].active_spot_key is None
    assert (got[1].spot_id, got[1].started_at, got[1].type_state) == (4, start, "b") and (got[3].spot_id, got[3].type_state) == (9, "a")


def placed_one_by_one(where, wish):
    """Verdicts of (id, spot) in their order; ``where`` has the spots of open sessions and is kept up to date."""
    holders, want = {}, []
    for i, s in where.items():
        holders.setdefault(s, set()).add(i)
    for i, s in wish:
        if i not in where:
            want.append("NOT_OPEN")
        elif holders.get(s, set()) - {i}:
            want.append("SPOT_TAKEN")
        else:
            holders[where[i]].discard(i)
            holders.setdefault(s, set()).add(i)
            where[i] = s
            want.append("PLACED")
    return want


def test_random_placements_one_by_one(spark):
    for seed in (0, 3):
        rs = random.Random(seed)
        held = [(i, f"k{i}", i, rs.randrange(12) if seed == 3 else i, rs.random() < 0.9) for i in range(20)]
        where = {i: f"harbor:{s}" for i, _, _, s, o in held if o}
        wish = [(rs.randrange(22), rs.randrange(26)) for _ in range(60)]
        rows = spark.createDataFrame([(i, "harbor", s, n) for n, (i, s) in enumerate(wish)], "id bigint, spot_pool string, spot_id int, ts int").repartition(3)
        after, judged = ledger.place_sessions(sessions_of(spark, held), rows)
        want = placed_one_by_one(where, [(i, f"harbor:{s}") for i, s in wish])
        assert {r.ts: r.verdict for r in judged.collect()} == dict(enumerate(want))
        assert {r.id: r.active_spot_key for r in after.collect() if r.ended_at is None} == where


def rounds_of(monkeypatch, module, name):
    """The tables of a name that a module writes from now on."""
    seen, cut = [], module.cut
    monkeypatch.setattr(module, "cut", lambda df, n: (seen.append(n) if n == name else None, cut(df, n))[1])
    return seen


def test_many_contenders_and_long_chains_of_placements_take_few_rounds(spark, monkeypatch):
    """5,000 sessions want a spot that is free and 5,000 one that is held; 1,000 sessions each want the next one's spot, the
    last of which moves to a free one, or not."""
    n = 5000
    held = [(i, f"k{i}", i, 10 + i, True) for i in range(2 * n + 2000)]
    wish = [(i, 1) for i in range(n)] + [(i, 10 + 2 * n) for i in range(n, 2 * n)]
    chain = [(2 * n + 999 - k, 10 + 2 * n + 1000 - k) for k in range(1000)]
    wish += [(2 * n + 1000, 2), *chain, (2 * n + 1999, 10 + 2 * n + 1999), *[(2 * n + 1998 - k, 10 + 2 * n + 1999 - k) for k in range(990)]]
    rows = spark.createDataFrame([(i, "harbor", s, k) for k, (i, s) in enumerate(wish)], "id bigint, spot_pool string, spot_id int, ts int")
    rounds = rounds_of(monkeypatch, ledger, "placements-ready")
    jumps = rounds_of(monkeypatch, trees, "tree")
    judged = ledger.place_sessions(sessions_of(spark, held), rows)[1]
    want = placed_one_by_one({i: f"harbor:{s}" for i, _, _, s, _ in held}, [(i, f"harbor:{s}") for i, s in wish])
    assert {r.ts: r.verdict for r in judged.collect()} == dict(enumerate(want)) and min(want.count("PLACED"), want.count("SPOT_TAKEN")) > 900
    assert len(rounds) <= 4 and len(rounds) + len(jumps) < 20


def test_long_chains_of_admissions_take_few_rounds(spark, monkeypatch):
    """Each request shares its character with the one before and its spot with the one after, or the other way round."""
    asked = [(f"c{k}", 100 + (k + 1) // 2, f"harbor:{100 + k // 2}") for k in range(1000)] + [("hot", 5000 + k, None) for k in range(3000)]
    rows = spark.createDataFrame([(k, c, s, n) for n, (k, c, s) in enumerate(asked)], "idempotency_key string, character_id int, spot_key string, ts bigint")
    rounds = rounds_of(monkeypatch, ledger, "admission-first")
    jumps = rounds_of(monkeypatch, trees, "tree")
    found = {r.ts: r.verdict for r in ledger.session_admission(rows, sessions_of(spark, [])).collect()}
    assert [found[k] for k in range(len(asked))] == one_by_one([], asked)
    assert len(rounds) <= 2 and len(rounds) + len(jumps) < 20


def test_registered_admissions_one_by_one(spark, sf):
    from tidemark.plans import rule_queries

    asked = sorted(map(tuple, rule_queries.admissions_asked(spark, sf).collect()))
    sessions = [(r.id, r.idempotency_key, r.character_id, r.active_spot_key, r.ended_at is None) for r in rule_queries.sessions_of(spark, sf).collect()]
    keys, chars, spots = {s[1] for s in sessions}, {s[2] for s in sessions if s[4]}, {s[3] for s in sessions if s[4]}
    want = {}
    for k, key, char, spot, _ in asked:
        want[k] = "DUPLICATE" if key in keys else "CHARACTER_ACTIVE" if char in chars else "SPOT_TAKEN" if spot is not None and spot in spots else "ADMITTED"
        if want[k] == "ADMITTED":
            keys.add(key), chars.add(char), spots.add(spot)
    assert {r.k: r.verdict for r in rule_queries.session_admissions(spark, sf).collect()} == want and len(set(want.values())) >= 3


def test_ordered_reads(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [("c", "buy", "STARTED", t(2)), ("a", "buy", "CHARGED", t(3)), ("b", "sell", "STARTED", t(2)), ("d", "buy", "OK", t(1)), ("e", "buy", "STARTED", t(1))]
    book = spark.createDataFrame(rows, "correlation_id string, command string, status string, created_at timestamp").repartition(4)
    assert [r.correlation_id for r in ledger.receipts_open(book).collect()] == ["e", "b", "c", "a"] and [r.correlation_id for r in ledger.receipts_open(book, "buy").collect()] == ["e", "c", "a"]
    sessions = sessions_of(spark, [(3, "a", 1, 1, True), (1, "b", 2, 2, True), (2, "c", 3, 3, False)])
    assert [r.id for r in ledger.sessions_open(sessions).collect()] == [1, 3]
    closed = ledger.close_sessions(sessions, spark.createDataFrame([(1, t(5), "LATE", 9), (1, t(4), "APP_STOPPED", 8), (2, t(4), "X", 7)], "id bigint, ended_at timestamp, end_reason string, active_ms bigint"))
    assert {r.id: (r.end_reason, r.active_ms, r.active_spot_key) for r in closed.collect()} == {1: ("APP_STOPPED", 8, None), 2: ("APP_STOPPED", 0, None), 3: (None, 0, "harbor:1")}


def test_tables_over_jdbc(spark):
    """Derby, which comes with Spark, stands for the game database: windows, late fetch and the ledger over JDBC."""
    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.createDataFrame([(k, f"clan{k}", k % 9) for k in (1, 2, 3, 250, 499, 500, 501, 999, 1000)], "clan_id bigint, clan_name string, clan_level int")
    rows.write.jdbc(url, "clan_data", properties=driver)
    table = windows.jdbc_table(spark, url, "clan_data", '"clan_id"', 1, 1000, rows_per_window=250, **driver)
    assert table.rdd.getNumPartitions() == 4 and sorted(map(tuple, table.toDF(*[c.lower() for c in table.columns]).collect())) == sorted(map(tuple, rows.collect()))
    own = table.toDF("clan_id", "clan_name", "clan_level")
    spec = capture.EntitySpec("clan", own, "clan_id", ("clan_name", "clan_level"), ("clan_name",))
    old = capture.entity_hashes(spec).where("pk <> 500").unionByName(spark.createDataFrame([(1001, 5)], "pk bigint, row_hash bigint"))
    changes = cut(capture.diff(capture.entity_hashes(spec), old), "changes")
    assert {(r.pk, r.op, r.payload and r.payload.clan_name) for r in capture.change_events(spec, changes, F.lit(1)).collect()} == {(500, "CREATED", "clan500"), (1001, "DELETED", None)}
    at = dt.datetime(2024, 1, 1)
    book = spark.createDataFrame([("a", "buy", "STARTED", at), ("b", "buy", "OK", at)], "correlation_id string, command string, status string, created_at timestamp")
    book.write.option("createTableColumnTypes", "correlation_id VARCHAR(64), command VARCHAR(64), status VARCHAR(16)").jdbc(url, "receipts", properties=driver)
    read = spark.read.jdbc(url, "receipts", properties=driver)
    assert [r[0] for r in ledger.receipts_open(read.toDF(*[c.lower() for c in read.columns])).collect()] == ["a"]


def test_records_through_files_in_micro_batches(spark):
    path = shared_path(spark, "topic")
    rows = spark.createDataFrame([(k, f"v{k}", k % 5 == 0) for k in range(12)], "pk bigint, v string, gone boolean")
    out = records.encode_envelope(rows, F.col("pk"), F.struct("pk", "v"), F.lit("t"), F.when(F.col("pk") % 2 == 0, "Even").otherwise("Odd"), F.col("gone"))
    for k in range(3):
        records.write_events(out.where(F.pmod(F.hash("key"), F.lit(3)) == k), path=path)
    stream = records.read_events_files(spark, path)
    assert stream.isStreaming
    decoded, dead = records.decode_envelope(records.route_by_type(stream, ["Even"]), "pk bigint, v string")
    found = ran(decoded.select("msg_type", ids.key_number(F.col("key")).alias("pk"), "payload.v"), "topic-out")
    assert sorted((r.pk, r.v) for r in found.collect()) == [(k, None if k % 5 == 0 else f"v{k}") for k in range(0, 12, 2)]
    with pytest.raises(Exception, match="(?i)kafka"):
        records.read_events_kafka(spark, "localhost:1", ["t"])


def test_family_tables(spark):
    made = [r.u for r in spark.createDataFrame([(1_700_000_000_000 + k, k) for k in range(3)], "m bigint, s int").select(ids.uuid7_at(F.col("m"), F.col("s")).alias("u")).collect()]
    kill = {"eventId": made[0], "bossNpcId": 25, "participants": [{"charId": 1, "partyId": None, "damageDealt": 9}], "drops": [{"itemId": 57, "count": 3}], "unknown": 1}
    spawn = {"eventId": made[1], "bosses": [{"npcId": 25, "status": "dead", "nextRespawnAt": "2024-01-01T00:00:00Z", "schedule": {"slots": [{"daysOfWeek": ["MONDAY"], "time": "20:00:00+02:00", "jitterMinutes": 5}]}}]}
    rows = [(k.to_bytes(8, "big"), json.dumps(v).encode() if isinstance(v, dict) else v, "raid", [("nx-type", t.encode())]) for k, v, t in ((25, kill, "RaidKillEvent"), (0, spawn, "BossRespawnSnapshotEvent"), (1, b"{", "RaidKillEvent"), (2, {}, "NewEvent"))]
    tables, dead = families.family_tables(spark.createDataFrame(rows, records.RECORD), "raid")
    r, b = tables["RaidKillEvent"].first(), tables["BossRespawnSnapshotEvent"].first()
    assert (r.key_number, r.event_id, r.payload.drops[0].itemId, r.payload.participants[0].damageDealt) == (25, made[0], 57, 9) and int(r.event_time.timestamp()) == 1_700_000_000
    assert b.payload.bosses[0].schedule.slots[0].time == "20:00:00+02:00" and b.payload.bosses[0].nextRespawnAt == dt.datetime(2024, 1, 1) and dead.count() == 1
    assert sum(len(x) for x in families.FAMILIES.values()) == 26 and len(families.FAMILIES) == 14


def stream_of(df, name):
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def ran(stream, name):
    return streams.run_to_table(stream, shared_path(stream.sparkSession, name), shared_path(stream.sparkSession, name + "-cp"))


def test_stream_of_ticks_and_stores(spark):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [(1, 1, 5, t(1)), (1, 2, 5, t(2)), (1, 3, 6, t(3)), (1, 5, 6, t(5)), (2, 2, 1, t(2))]
    found = ran(streams.ticks(stream_of(spark.createDataFrame(rows, "pk bigint, tick bigint, row_hash bigint, ts timestamp"), "in")), "ticks")
    assert sorted((r.pk, r.tick, r.op) for r in found.collect()) == [(1, 1, "CREATED"), (1, 3, "UPDATED"), (1, 5, "CREATED"), (2, 2, "CREATED")]
    rows = [(1, t(0), True), (1, t(10), True), (1, t(20), False), (2, t(0), True), (2, t(40), True), (3, t(5), False)]
    found = ran(streams.store_changes(stream_of(spark.createDataFrame(rows, "char_id bigint, ts timestamp, open boolean"), "in")), "stores")
    got = sorted((r.char_id, r.ts, r.change) for r in found.collect())
    assert got[:5] == [(1, t(0), "OPENED"), (1, t(20), "CLOSED"), (2, t(0), "OPENED"), (2, t(25), "EXPIRED"), (2, t(40), "OPENED")]


def test_streams_forget_silent_keys_and_drop_late_rows(spark):
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    path = shared_path(spark, "in")
    batches = [[("k", t(0), False, 1), ("k", t(5), False, 2)], [("k", t(16), False, 3), ("k", t(16), True, 4), ("j", t(16), False, 1)], [("k", t(10), False, 5), ("k", t(17), False, 6)], [("x", t(500), True, 1)], [("k", t(501), False, 7)]]
    for rows in batches:
        spark.createDataFrame(rows, "key string, ts timestamp, ok boolean, seq int").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("key string, ts timestamp, ok boolean, seq int").option("maxFilesPerTrigger", 1).parquet(path)
    found = ran(streams.escalations(stream, forget_after_s=3600), "levels")
    assert sorted((r.key, r.ts, r.level) for r in found.collect()) == [("j", t(16), "FIRST"), ("k", t(0), "FIRST"), ("k", t(5), "REPEAT"), ("k", t(16), "ESCALATED"), ("k", t(17), "FIRST"), ("k", t(501), "FIRST")]


def test_working_tables_are_cleared(spark):
    import os

    kept = shared_path(spark, "kept")
    with cleared(spark):
        inside = cut(spark.range(5), "inside")
        held = inside.inputFiles()[0].removeprefix("file://")
        out = written(inside.where("id > 1"), kept)
        assert os.path.exists(held)
    assert not os.path.exists(held) and out.count() == 3
    with pytest.raises(ValueError), cleared(spark):
        held = cut(spark.range(5), "inside").inputFiles()[0].removeprefix("file://")
        raise ValueError
    assert os.path.exists(held)


def test_presence_rules(spark):
    rows = [(True, "APP", "FISHING", True, None), (True, "CLIENT", None, False, None), (False, "CLIENT", None, False, "exit"), (True, None, None, False, None), (True, "APP", None, False, None), (True, "CLIENT", "FISHING", False, None), (True, "CLIENT", None, False, "exit"), (False, "CLIENT", None, False, None), (False, "APP", "FISHING", True, "exit"), (True, "CLIENT", None, True, None)]
    table = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, online boolean, source string, activity string, resumed boolean, logout_reason string")
    assert sorted((r.k, r.reason) for r in events.bad_presence(table).collect()) == [(3, "no source"), (4, "app session without activity"), (5, "client session with activity"), (6, "start with a reason to leave"), (7, "end without a reason"), (8, "resumed without an app start"), (9, "resumed without an app start")]


def test_queries_and_sql_are_paired():
    import __spark_entry__

    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 100
