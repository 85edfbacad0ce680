"""What the findings of round 3 asked for."""

import datetime as dt
import hashlib
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark import SparkFiles
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.functions import ids
from tidemark.llm import bpe, lexicon
from tidemark.llm.queries import tokenizer_file
from tidemark.registry import ORACLE_SQL, QUERIES
from tidemark.scratch import shared_path
from tidemark.sources import entities, snapshots
from tidemark.streaming import acknowledged, streams


def test_resync_forced_where_the_missing_key_exists(spark, tmp_path):
    """in larger tables an order has the key that is forced as one that is gone."""
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"
    keys = [19, 77, 5_000_000, 5_000_009]
    spark.createDataFrame([(k, 1, "O", 5.0, "1-URGENT") for k in keys], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 1, 1, 1, 2.0, 3.0) for k in keys], line).write.parquet(f"{tmp_path}/lineitem.parquet")
    db = duckdb.connect()
    for name in ("orders", "lineitem"):
        db.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = {tuple(r) for r in QUERIES["resync_forced"](spark, str(tmp_path)).collect()}
    assert got == set(db.sql(ORACLE_SQL["resync_forced"]).fetchall())
    assert (5_000_000, "DELETED") in got


def test_records_are_parsed_once(spark):
    """filters on a payload and its fields don't parse the record again."""
    rows = spark.range(9).select(ids.key_bytes(F.col("id")).alias("key"), F.encode(F.concat(F.lit('{"id": '), F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).otherwise("null"), F.lit(', "type": "npc"'), F.when(F.col("id") % 3 > 0, "}").otherwise("")), "utf-8").alias("value"))
    good, _, dead = entities.entity_table(rows, "npc_template")
    plan = good.select("id", "type")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert sorted(r.id for r in good.collect()) == [1, 2, 5, 7]
    assert sorted(r.k for r in dead.select(ids.key_number(F.col("key")).alias("k")).collect()) == [0, 3, 4, 6, 8]


@pytest.mark.parametrize("name", ["raid_drops", "raid_contribution", "sale_totals"])
def test_tasks_that_list_lines_have_a_number_of_rows(spark, sf, name, monkeypatch):
    """more lines make more tasks, not larger ones."""
    monkeypatch.setattr("tidemark.plans.book.TASK_ROWS", 100)
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count() // 100 + 1
    assert f", {n})" in QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


def test_keys_of_a_bucket_keep_their_own_state(spark, monkeypatch):
    """keys share a group; one that is silent ends while others go on."""
    monkeypatch.setattr(streams, "BUCKETS", 1)
    t = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    path, schema = shared_path(spark, "in"), "char_id bigint, ts timestamp, open boolean"
    for rows in ([(1, t(0), True), (2**60 + 1, t(1), True)], [(1, t(40), True)], [(1, t(50), False), (3, t(50), True)], [(3, t(51), True)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = streams.store_changes(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path))
    found = streams.run_to_table(stream, shared_path(spark, "out"), shared_path(spark, "cp"))
    want = [(1, t(0), "OPENED"), (1, t(25), "EXPIRED"), (1, t(40), "OPENED"), (1, t(50), "CLOSED"), (3, t(50), "OPENED"), (2**60 + 1, t(1), "OPENED"), (2**60 + 1, t(26), "EXPIRED")]
    assert sorted((r.char_id, r.ts, r.change) for r in found.collect()) == want


def test_rows_of_a_snapshot_are_not_dealt_by_entity(spark):
    """which entities are sound is sent to the rows, whatever their size; no task gets all rows of an entity."""
    path, small = shared_path(spark, "snapshots"), "spark.sql.autoBroadcastJoinThreshold"
    snapshots.save_snapshot(spark.range(100).select(F.lit("a").alias("entity"), F.col("id").alias("pk"), F.xxhash64("id").alias("row_hash")), path, 1)
    before = spark.conf.get(small)
    spark.conf.set(small, "-1")
    try:
        loaded = snapshots.load_snapshot(spark, path)
        plan = loaded._jdf.queryExecution().executedPlan()
        assert loaded.count() == 100 and plan.toString().count("BroadcastHashJoin [entity") == 1
    finally:
        spark.conf.set(small, before)


def test_settings_of_a_bucket_keep_their_own_state(spark, monkeypatch):
    """F8, F11: keys share a value of state, so calls and messages to the store don't grow with keys; one that is silent is
    forgotten while others go on, and one of the snapshot stays."""
    monkeypatch.setattr(streams, "BUCKETS", 1)
    path, schema = shared_path(spark, "acks"), "key bigint, kind string, seq bigint, row_hash bigint, status string, ts timestamp"
    t, big = (lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)), 2**60 + 1
    parts = [
        [(1, "row", 1, big, None, t(100)), (1, "ack", 1, None, "ok", t(101)), (big, "row", 1, 5, None, t(100)), (big, "ack", 1, None, "failed", t(101)), (None, "row", 1, 5, None, t(100))],
        [(1, "row", 2, big, None, t(3000)), (big, "row", 2, 5, None, t(3000)), (big, "ack", 2, None, "ok", t(3001))],
        [(big, "row", 3, 5, None, t(6000)), (1, "row", 3, big, None, t(6000))],
        [(big, "row", 4, 5, None, t(9000))],
        [(big, "row", 5, 5, None, t(12_000))],
        [(big, "row", 6, 5, None, t(13_000))],
        [(1, "row", 4, big, None, t(13_001)), (2, "row", 1, 7, None, t(13_001)), (3, "row", 1, 8, None, t(13_001)), (big, "row", 7, 6, None, t(13_001))],
    ]
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    snapshot = spark.createDataFrame([(2, 0, 7), (3, 0, 7)], "key bigint, seq bigint, row_hash bigint")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    found = acknowledged.acknowledged_changes(stream, snapshot, gaps=False, forget_after_s=3600)
    got = {tuple(r) for r in streams.run_to_table(found, shared_path(spark, "out"), f"{path}-checkpoint", **dict([acknowledged.STORE])).collect()}
    assert got == {(1, 1, "CREATED"), (1, 4, "CREATED"), (big, 1, "CREATED"), (big, 2, "CREATED"), (big, 7, "UPDATED"), (None, 1, "CREATED"), (3, 1, "UPDATED")}
    assert [s.name for s in found.schema] == ["key", "seq", "op"]
    state = spark.read.format("statestore").option("stateVarName", "state").load(f"{path}-checkpoint")
    assert [sorted(r.value.key) for r in state.collect()] == [sorted(["1", "2", "3", str(big)])]


def test_ticks_of_a_bucket_keep_their_own_state(spark, monkeypatch):
    """F3's step in ticks: keys share a group; one that is silent is forgotten while others go on."""
    monkeypatch.setattr(streams, "BUCKETS", 1)
    t, big = (lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)), 2**60 + 1
    path, schema = shared_path(spark, "in"), "pk bigint, tick bigint, row_hash bigint, ts timestamp"
    for rows in ([(1, 1, 5, t(100)), (big, 1, 6, t(101)), (big, 1, big, t(102))], [(big, 2, big, t(9000))], [(big, 3, 5, t(9001))], [(1, 2, 5, t(9002)), (big, 5, 5, t(9002))]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    found = streams.ticks(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), forget_after_s=3600)
    got = sorted(map(tuple, streams.run_to_table(found, shared_path(spark, "out"), f"{path}-checkpoint").collect()))
    assert got == [(1, 1, "CREATED"), (1, 2, "CREATED"), (big, 1, "CREATED"), (big, 3, "UPDATED"), (big, 5, "CREATED")]
    assert spark.read.format("statestore").load(f"{path}-checkpoint").count() == 1


def test_latin_words_are_merged_together(monkeypatch):
    """op1_bpe, CPU: words outside the lexicon are merged a table at a time, none alone, with the library's ids."""
    own = Tokenizer.from_file(tokenizer_file())
    monkeypatch.setattr(bpe.Merger, "merge", lambda self, piece: pytest.fail(f"{piece} is merged alone"))
    draw = random.Random(3)
    parts = ["'s", "'re", "'d", "'", "a", "th", "tion", "ing", "\u00e9", "\u0178", "\u017f", "Z", "9", "!", "$$", "-", "<|"]
    words = {"".join(draw.choices(parts, k=draw.choice((1, 2, 5, 9, 17)))) for _ in range(4000)}
    arrays = bpe.compile_lexicon(words, tokenizer_file())
    for k, w in enumerate(sorted(words, key=str.encode)):
        a, b = arrays["ids_at"][k : k + 2]
        assert arrays["ids"][a:b].tolist() == own.encode(w, add_special_tokens=False).ids


def test_bpe_of_long_and_foreign_words(spark):
    """op1_bpe: beside the tables stand words that are long, not Latin, or hold special tokens and control characters."""
    own = Tokenizer.from_file(tokenizer_file())
    texts = ["ab" * 40 + " 12'sx", "x<|endoftext|>y", "a\x1cb c", "\u6f22\u5b57 \u0130x e\u0301", None, "", " \n ", "one\u3000two\x85three", "z" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2)
    counts = {r.word: r.n for r in bpe.word_counts(docs.unionByName(docs), min_count=1).collect()}
    assert counts["two"] == 2 and counts["a\x1cb"] == 2 and "" not in counts and "z" * 300 not in counts
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(docs, bpe.build(spark, docs, tokenizer_file())).collect()}
    for k, t in enumerate(texts):
        want = own.encode(t or "", add_special_tokens=False).ids
        back = own.decode(want, skip_special_tokens=False)
        assert got[k] == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_lexicon_is_compiled_in_tasks(spark, monkeypatch):
    """pipeline, the driver's memory: no word of the lexicon is listed, compiled or merged in the driver."""
    own = Tokenizer.from_file(tokenizer_file())
    draw = random.Random(4)
    words = ["".join(draw.choices("abcdefg\u00e9", k=draw.randint(1, 9))) for _ in range(3000)]
    docs = spark.createDataFrame([(k, " ".join(words[k % 7 :: 7])) for k in range(28)], "doc_id bigint, text string").repartition(3)
    with monkeypatch.context() as m:
        for of, name in ((lexicon, "compile_words"), (bpe.Merger, "__init__")):
            m.setattr(of, name, lambda *a: pytest.fail("the driver compiles"))
        names = bpe.build(spark, docs, tokenizer_file())
        got = {r.doc_id: r.ids for r in bpe.encode(docs, names).collect()}
    assert all(got[k] == own.encode(" ".join(words[k % 7 :: 7]), add_special_tokens=False).ids for k in range(28))
    arrays = lexicon.load(SparkFiles.get(names[1]))
    ranks = lexicon.ranks(arrays, [w.encode() for w in sorted(set(words))])
    assert sorted(ranks.tolist()) == list(range(len(set(words)))) and (arrays["root"] >= 0).sum() > 1
    for w, k in zip(sorted(set(words)), ranks):
        assert arrays["ids"][arrays["ids_at"][k] : arrays["ids_at"][k + 1]].tolist() == own.encode(w, add_special_tokens=False).ids
    assert lexicon.ranks(arrays, [b"", b"hh", b"abcdefgabcdefg"]).tolist() == [-1, -1, -1]
