"""Windows hashed in a database, and counters made in passing."""

import random
import sqlite3
import time
import zlib
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.operators import capture, catalogue, counters, stats
from tidemark.scratch import shared_path
from tidemark.sources import database, entities, records


class BitXor:
    def __init__(self):
        self.value = 0

    def step(self, x):
        self.value ^= x

    def finalize(self):
        return self.value


def connect(path):
    """A database with the functions that the others have built in."""

    def joined(sep, *values):
        return sep.join(str(v) for v in values if v is not None)

    def crc32(text):
        if "broken" in text:
            raise ValueError("a value that can't be hashed")
        return zlib.crc32(text.encode())

    connection = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    connection.create_function("CONCAT_WS", -1, joined)
    connection.create_function("CRC32", 1, crc32)
    connection.create_aggregate("BIT_XOR", 1, BitXor)
    return connection


@pytest.fixture
def clans(tmp_path):
    rs, path = random.Random(3), str(tmp_path / "clans.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE clan (id INTEGER PRIMARY KEY, name TEXT, level INTEGER)")
        c.execute("CREATE TABLE member (clan_id INTEGER, who TEXT, rank INTEGER)")
        c.executemany("INSERT INTO clan VALUES (?, ?, ?)", [(k, rs.choice(["a,b", "x", None]), k % 7) for k in range(100, 400) if k % 5])
        c.executemany("INSERT INTO member VALUES (?, ?, ?)", [(rs.randrange(90, 410), f"m{k}", rs.randrange(4)) for k in range(900)])
    children = (database.DbChild("member", "clan_id", ("who", "rank"), "rank > 0"),)
    return path, database.DbEntity("tests.test_sources:connect", path, "clan", "id", ("name", "level"), children)


def held(spark, path):
    """The same hashes by Spark over the same rows."""
    with sqlite3.connect(path) as c:
        clan = spark.createDataFrame(c.execute("SELECT * FROM clan").fetchall(), "id bigint, name string, level int")
        member = spark.createDataFrame(c.execute("SELECT * FROM member").fetchall(), "clan_id bigint, who string, rank int")
    spec = capture.EntitySpec("clan", clan, "id", ("name", "level"), children=(capture.ChildSpec("member", member, "clan_id", ("who", "rank"), F.col("rank") > 0),))
    return capture.entity_hashes(spec, exact=False)


def ops(df):
    return sorted((r.pk, r.op) for r in df.collect())


def test_hashes_are_made_in_the_database(spark, clans):
    path, entity = clans
    assert database.database_envelope(entity) == (101, 399)
    for rows, parts in ((7, 4), (50, 200), (1000, 1)):
        found = database.database_hashes(spark, entity, 101, 399, rows=rows, partitions=parts, fetch=3)
        assert found.rdd.getNumPartitions() <= parts and found.where("error IS NOT NULL").count() == 0
        assert sorted(map(tuple, found.select("pk", "row_hash").collect())) == sorted(map(tuple, held(spark, path).collect()))
        assert found.where("pk NOT BETWEEN lo AND hi OR window_no <> floor((pk - 101) / %d)" % rows).count() == 0
    assert database.database_hashes(spark, entity, 5, 4).count() == 0
    with pytest.raises(Exception, match="windows"):
        database.database_hashes(spark, entity, 0, 10**9, rows=1).count()
    with pytest.raises(ValueError, match="no hashed columns: clan"):
        database.DbEntity("m:f", "d", "clan", "id", ())


def test_a_window_that_fails_is_left_alone(spark, clans):
    """Of windows of fifty keys the one that can't be hashed, by a row of its own or of a child, is named; its keys are
    neither changed nor deleted, others are judged."""
    path, entity = clans
    before = held(spark, path).collect()
    snapshot = spark.createDataFrame([*map(tuple, before), (100, 1), (230, 1), (390, 1)], "pk bigint, row_hash bigint")
    with sqlite3.connect(path) as c:
        c.execute("UPDATE clan SET name = 'broken' WHERE id = 203")
        c.execute("UPDATE clan SET name = 'new' WHERE id IN (104, 204, 304)")
        c.execute("INSERT INTO member VALUES (351, 'broken', 2), (106, 'one more', 1)")
        c.execute("DELETE FROM clan WHERE id IN (107, 207, 357)")
        c.execute("INSERT INTO clan VALUES (110, 'y', 1), (210, 'y', 1)")
    found = database.database_hashes(spark, entity, 100, 399, rows=50, partitions=2, tries=2)
    changes, failed = database.database_changes(found, snapshot)
    assert [(r.window_no, r.lo, r.hi) for r in failed.orderBy("lo").collect()] == [(2, 200, 249), (5, 350, 399)]
    assert failed.where("error LIKE 'OperationalError%'").count() == 2
    assert ops(changes) == [(100, "DELETED"), (104, "UPDATED"), (106, "UPDATED"), (107, "DELETED"), (110, "CREATED"), (304, "UPDATED")]
    # No connection at all: every window fails and nothing is judged.
    nowhere = database.DbEntity("tests.test_sources:connect", path + ".gone", "clan", "id", ("name",))
    changes, failed = database.database_changes(database.database_hashes(spark, nowhere, 100, 399, rows=100), snapshot)
    assert failed.count() == 3 and changes.count() == 0


def test_targeted_keys_are_asked_for_in_lists(spark, clans):
    path, entity = clans
    snapshot = held(spark, path)
    snapshot = spark.createDataFrame([*map(tuple, snapshot.collect()), (395, 1)], "pk bigint, row_hash bigint")
    with sqlite3.connect(path) as c:
        c.execute("UPDATE clan SET level = 99 WHERE id IN (101, 102)")
        c.execute("DELETE FROM clan WHERE id = 103")
        c.execute("UPDATE clan SET name = 'broken' WHERE id = 399")
    keys = spark.createDataFrame([(101,), (101,), (103,), (104,), (395,), (700,), (None,)], "pk bigint")
    only = keys.where("pk IS NOT NULL").distinct()
    judged = lambda s: s.join(only, "pk", "left_semi")
    changes, failed = database.database_changes(database.targeted_hashes(keys, entity, rows=2), snapshot, judged)
    assert ops(changes) == [(101, "UPDATED"), (103, "DELETED"), (395, "DELETED")] and failed.count() == 0
    # A list with a key that can't be hashed: its keys come back with the error, and are not judged.
    keys = keys.unionByName(spark.createDataFrame([(399,)], "pk bigint")).coalesce(1)
    only = keys.where("pk IS NOT NULL").distinct()
    changes, failed = database.database_changes(database.targeted_hashes(keys, entity, rows=100), snapshot, judged)
    bad = {r.lo for r in failed.collect()}
    assert 399 in bad and not bad & {k for k, _ in ops(changes)} and bad | {k for k, _ in ops(changes)} >= {101, 103, 395, 399}


COMMANDS = "outcome string, reply string"


def commands(spark):
    rows = [("handled", "published")] * 5 + [("skipped", None)] * 3 + [("unsupported", "failed"), (None, None), ("other", "published")]
    return spark.createDataFrame(rows, COMMANDS).repartition(3)


def test_counts_in_passing_are_those_of_a_second_read(spark):
    df = commands(spark)
    rows, seen = counters.counted(df, counters.command_flags())
    assert rows.count() == 11
    assert seen.get == stats.command_counters(df).first().asDict()
    none, seen = counters.counted(df.where("false"), counters.command_flags())
    assert none.collect() == [] and set(seen.get.values()) == {0}
    # The first reason counts, a null condition doesn't, and rows that go are counted although only others are read.
    kept, seen = counters.split(df, {"no_reply": F.col("reply").isNull(), "bad": F.col("outcome") != "handled"})
    assert kept.select("reply").where("reply = 'published'").count() == 5
    assert seen.get == {"no_reply": 4, "bad": 2, "kept": 5}
    routed, seen = records.resolve_topics_observed(df.withColumn("entity_name", F.col("outcome")), {"handled": "t"})
    assert [r.topic for r in routed.collect()] == ["t"] * 5 and seen.get == {"without_topic": 6, "kept": 5}


def test_stream_totals_by_listener(spark):
    path = shared_path(spark, "listened")
    for k in range(3):
        commands(spark).coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(COMMANDS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in").observe("commands", *counters.tallies(counters.command_flags()))
    listener = counters.StreamTotals()
    spark.streams.addListener(listener)
    try:
        query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/check").trigger(availableNow=True).start()
        query.awaitTermination()
        end = time.time() + 60
        while str(query.id) not in listener.ended and time.time() < end:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    want = stats.command_counters(spark.read.parquet(f"{path}/out")).first().asDict()
    assert want["consumed"] == 33 and listener.of(query.id, "commands") == want and listener.of(query.id, "others") == {}


def test_counts_of_a_batch_that_runs_again(spark):
    """The second batch fails in its sink, after rows were taken; a new query on the same checkpoint goes on, and counts
    are those of the rows."""
    path, fail = shared_path(spark, "counted"), {"once": True}
    for k in range(3):
        commands(spark).coalesce(1).write.mode("append").parquet(f"{path}/in")
    flags = counters.command_flags()

    def sink(rows, number):
        rows.write.mode("overwrite").parquet(f"{path}/out/batch={number}")
        if number == 1 and fail.pop("once", False):
            raise RuntimeError("killed")

    def stream():
        return spark.readStream.schema(COMMANDS).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")

    start = partial(counters.counted_into, flags=flags, sink=sink, counts=f"{path}/counts", checkpoint=f"{path}/check", seconds=None)
    with pytest.raises(Exception, match="killed"):
        start(stream()).awaitTermination()
    start(stream()).awaitTermination()
    counts = counters.batch_counts(spark, f"{path}/counts", list(flags))
    assert counts.count() == 3
    total = counts.agg(*[F.sum(c).alias(c) for c in flags]).first().asDict()
    assert total == stats.command_counters(spark.read.parquet(f"{path}/out")).first().asDict() and total["consumed"] == 33


def entity_rows(spark, *texts):
    return spark.createDataFrame([(k.to_bytes(8, "big", signed=True), None if t is None else bytearray(t.encode())) for k, t in texts], "key binary, value binary")


def test_entity_tables(spark):
    good = '{"id": 1, "name": "a", "display": {"race": "elf", "face": 2}, "scheduledDeletionAt": "2024-01-02T03:04:05Z", "classes": [{"classId": "x", "exp": 5000000000}], "new": {"a": 1}}'
    rows, deleted, dead = entities.entity_table(entity_rows(spark, (1, good), (2, None), (3, '{"id": 3}'), (4, "{bad"), (5, '{"name": "no id"}'), (-6, '{"id": -6, "name": "b", "locks": []}')), "character")
    found = {r.id: r for r in rows.collect()}
    assert set(found) == {1, -6} and found[1].key_number == 1 and found[-6].key_number == -6
    assert found[1].display.race == "elf" and found[1].display.hairStyle is None and found[1].classes[0].exp == 5_000_000_000 and found[1].locks is None
    assert rows.where("unix_timestamp(scheduledDeletionAt) = 1704164645").count() == 1
    assert [r.key_number for r in deleted.collect()] == [2] and dead.count() == 3
    # An icon is base64; entities without an id have an identity of their own.
    clan = entities.entity_table(entity_rows(spark, (1, '{"id": 1, "name": "c", "icon": "AQID"}')), "clan")[0].first()
    assert bytes(clan.icon) == b"\x01\x02\x03"
    rows, _, dead = entities.entity_table(entity_rows(spark, (7, '{"ratingType": "pvp", "season": "1", "charId": 7, "points": 3}'), (7, '{"ratingType": "pvp", "charId": 7}')), "rating")
    assert rows.count() == 1 and dead.count() == 1
    for name in entities.ENTITIES:
        empty = entities.entity_table(entity_rows(spark).limit(0), name)
        assert empty[0].count() == 0 and set(entities.IDENTITY.get(name, ("id",))) <= set(empty[0].columns)


def test_catalogue_columns_of_entities(spark):
    npc = '{"id": 1, "type": "raid", "drops": [{"category": "a", "groupChancePercent": 50, "items": [{"itemTemplateId": 7, "min": 1, "max": 2, "chancePercent": 10}]}, {"items": [{"itemTemplateId": 8, "chancePercent": 1}]}], "minions": [{"minionNpcTemplateId": 2, "count": 3}, {"minionNpcTemplateId": 4, "count": 1, "groupIndex": 1}], "spawns": [{"x": 1, "y": 2, "z": 3, "respawnSec": 60, "respawnRandomSec": 90}, {"respawnSec": 10, "territory": [{"x": 1, "y": 2, "zmin": 0, "zmax": 9}]}]}'
    npcs = entities.entity_table(entity_rows(spark, (1, npc), (2, '{"id": 2, "type": "x"}')), "npc_template")[0]
    assert sorted((r.npc_id, r.item_id, r.item_chance, r.chance) for r in catalogue.npc_drops(entities.npc_drop_groups(npcs)).collect()) == [(1, 7, 10.0, 5.0), (1, 8, 1.0, None)]
    sets = {(r.group_no, r.fixed, r.sets) for r in catalogue.minion_sets(entities.npc_minions(npcs)).collect()}
    assert sets == {(None, True, None), (1, False, 1)}
    assert {(r.respawn_min_s, r.respawn_max_s, r.one_place) for r in catalogue.spawn_ranges(entities.npc_spawns(npcs)).collect()} == {(0, 150, True), (10, 10, True)}
    recipes = entities.entity_table(entity_rows(spark, (1, '{"id": 1, "productItemTemplateId": 5, "productCount": 2, "ingredients": [{"itemTemplateId": 6, "count": 9}]}'), (2, '{"id": 2, "rareItemTemplateId": 3}')), "recipe")[0]
    assert sorted((r.recipe_id, r.part, r.item_id, r["count"]) for r in catalogue.recipe_bom(entities.recipe_parts(recipes)).collect()) == [(1, "ingredient", 6, 9), (1, "product", 5, 2), (2, "rare_product", 3, None)]
    crystals = entities.entity_table(entity_rows(spark, (1, '{"id": 1, "level": 1, "nextItemTemplateId": 2}'), (2, '{"id": 2, "level": 2}')), "soul_crystal")[0]
    assert [(r.outcome, r.result_id, r.result_level) for r in catalogue.crystal_levels(entities.crystal_steps(crystals)).collect()] == [("next", 2, 2)]
    items = entities.entity_table(entity_rows(spark, (1, '{"id": 1, "type": "weapon", "grade": "s", "stats": {"magicWeapon": true, "stats": {"pAtk": 2.5}}, "upgrade": {"enchantable": true}, "skills": [{"id": 3, "level": 1}]}')), "item_template")[0]
    flat = catalogue.item_catalogue(entities.item_templates(items), ["grade", "magic_weapon"])
    one = flat["items"].first()
    assert (one.grade, one.magic_weapon, one.upgrade_enchantable, one.restrictions_tradable) == ("s", True, True, None)
    assert [(r.stat, r.value) for r in flat["stats"].collect()] == [("pAtk", 2.5)] and flat["skills"].first().id == 3
    levels = entities.entity_table(entity_rows(spark, (1, '{"level": 1, "requiredExp": 0}'), (2, '{"level": 2, "requiredExp": 68}')), "experience_level")[0]
    totals = spark.createDataFrame([(0, "a"), (68, "b"), (-1, "c")], "experience bigint, value string")
    assert {(r.value, r.level) for r in catalogue.level_of(totals, entities.requirements(levels)).collect()} == {("a", 1), ("b", 2), ("c", None)}


def test_a_consumer_begins_a_failed_batch_again(spark):
    """A batch fails three times, each after writing: twice in a query, whose tries are then over, and once in the next."""
    path, seen, fail = shared_path(spark, "consumed"), [], [1, 1, 1]
    for k in range(3):
        rows = [(n.to_bytes(8, "big"), bytearray(b"v%d" % n), "t", []) for n in range(10 * k, 10 * k + 10)]
        spark.createDataFrame(rows, records.RECORD).coalesce(1).write.mode("append").parquet(f"{path}/in")
    source = lambda: records.read_events_files(spark, f"{path}/in")

    def handle(rows, number):
        records.write_batch(rows, number, f"{path}/out")
        seen.append((number, rows.count()))
        if number == 0 and fail:
            raise RuntimeError(f"stopped {fail.pop()}")

    with pytest.raises(Exception, match="stopped"):
        records.consume(source(), handle, f"{path}/check", tries=2).awaitTermination()
    records.consume(source(), handle, f"{path}/check", tries=2).awaitTermination()
    out = records.read_batches(spark, f"{path}/out")
    assert seen[:4] == [(0, 30)] * 4 and out.count() == 30 and out.select("key").distinct().count() == 30
    records.consume(source(), handle, f"{path}/check").awaitTermination()
    assert records.read_batches(spark, f"{path}/out").count() == 30
