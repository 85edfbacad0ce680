"""Change capture: diff cases, partial acknowledgements, resyncs, snapshots, runtime ticks, apply laws."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import apply, capture, resync
from tidemark.operators.capture import ChildSpec, EntitySpec, ParentSpec
from tidemark.scratch import shared_path
from tidemark.sources import snapshots, windows

SNAP = "pk bigint, row_hash bigint"


def ops(df):
    return {r.pk: r.op for r in df.collect()}


@pytest.fixture(scope="module")
def clans(spark):
    def build(rows, skills):
        clan = spark.createDataFrame(rows, "clan_id bigint, clan_name string, clan_level int")
        skill = spark.createDataFrame(skills, "clan_id bigint, skill_id int, skill_level int")
        return EntitySpec("clan", clan, "clan_id", ("clan_name", "clan_level"), (), (ChildSpec("skills", skill, "clan_id", ("skill_id", "skill_level")),), (ParentSpec("alliance", "clan_level"),))

    return build


ROWS = [(1, "Hellbound", 5), (2, "Phoenix", 3), (3, "Dragons", 7)]
SKILLS = [(1, 101, 1), (1, 102, 2), (2, 201, 5), (2, 202, 3)]


def test_cycles_of_an_entity_with_children(spark, clans):
    held = spark.createDataFrame([], SNAP)

    def cycle(rows, skills):
        nonlocal held
        spec = clans(rows, skills)
        changes = capture.diff(capture.entity_hashes(spec), held)
        events = {r.pk: r for r in capture.change_events(spec, changes, F.lit(1).cast("bigint")).collect()}
        held = spark.createDataFrame(capture.advance(held, changes, changes.select("pk", F.lit("ok").alias("status"))).collect(), SNAP)
        return {k: r.op for k, r in events.items()}, events

    first, events = cycle(ROWS, SKILLS)
    assert first == {1: "CREATED", 2: "CREATED", 3: "CREATED"}
    assert [len(events[k].payload.skills) for k in (1, 2, 3)] == [2, 2, 0]
    assert cycle(ROWS, SKILLS)[0] == {}
    renamed = [ROWS[0], (2, "Phoenix II", 3), ROWS[2]]
    assert cycle(renamed, SKILLS)[0] == {2: "UPDATED"}
    assert cycle(renamed, [*SKILLS, (3, 301, 1)])[0] == {3: "UPDATED"}
    assert cycle(renamed, [*SKILLS, (3, 301, 2)])[0] == {3: "UPDATED"}
    assert cycle(renamed, SKILLS)[0] == {3: "UPDATED"}
    gone, events = cycle(renamed[:2], SKILLS)  # the largest key goes
    assert gone == {3: "DELETED"} and events[3].payload is None


def test_exact_fold_sees_what_the_compatible_one_misses(spark, clans):
    # The same edit in two child rows, a doubled child row, and a null that moves.
    a, b = clans(ROWS, [(1, 1, 10), (1, 2, 40)]), clans(ROWS, [(1, 1, 11), (1, 2, 41)])
    h = lambda spec, **o: {r.pk: r.row_hash for r in capture.entity_hashes(spec, **o).collect()}
    assert h(a)[1] != h(b)[1] and h(a)[2] == h(b)[2]
    twice = clans(ROWS, [(1, 1, 10), (1, 1, 10)])
    assert h(twice)[1] != h(clans(ROWS, []))[1] and h(twice, exact=False)[1] == h(clans(ROWS, []), exact=False)[1]
    null = lambda rows: EntitySpec("x", spark.createDataFrame(rows, "k bigint, a string, b string"), "k", ("a", "b"))
    assert h(null([(1, None, "v")])) != h(null([(1, "v", None)])) and h(null([(1, None, "v")]), exact=False) == h(null([(1, "v", None)]), exact=False)
    assert h(null([(1, "a,b", "c")])) != h(null([(1, "a", "b,c")]))
    with pytest.raises(ValueError):
        EntitySpec("x", a.df, "clan_id", ("missing",))


def test_diff_cases(spark):
    now = spark.createDataFrame([(1, 10), (2, 20), (3, -2147483648), (5, 50)], SNAP)
    old = spark.createDataFrame([(1, 10), (2, 21), (3, -2147483648), (4, 40)], SNAP)
    assert ops(capture.diff(now, old)) == {2: "UPDATED", 4: "DELETED", 5: "CREATED"}
    assert ops(capture.diff_window(now, old, 2, 3)) == {2: "UPDATED"}
    assert ops(capture.diff_targeted(now, old, spark.createDataFrame([(4,), (5,), (9,)], "pk bigint"))) == {4: "DELETED", 5: "CREATED"}
    plan = windows.plan_windows(spark.createDataFrame([(1, 6)], "lo bigint, hi bigint"), 2)
    assert ops(capture.diff_windows(now.where("pk <> 3"), old, plan, spark.createDataFrame([(1,)], "window_no bigint"))) == {2: "UPDATED", 5: "CREATED"}
    forced = resync.force_resync(old, keys=spark.createDataFrame([(1,), (5,), (8,)], "pk bigint"))
    assert ops(capture.diff(now, forced)) == {1: "UPDATED", 2: "UPDATED", 4: "DELETED", 5: "UPDATED", 8: "DELETED"}
    assert ops(capture.diff(now, resync.force_resync(old, entity_whole=True))) == {1: "UPDATED", 2: "UPDATED", 3: "UPDATED", 4: "DELETED", 5: "CREATED"}
    assert ops(capture.diff(now, resync.quiet_republish(old, spark.createDataFrame([(1,), (-7,)], "pk bigint")))) == {1: "UPDATED", 2: "UPDATED", 4: "DELETED", 5: "CREATED"}


def test_only_acknowledged_keys_move(spark):
    now, old = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], SNAP), spark.createDataFrame([(2, 21), (4, 40), (6, 60)], SNAP)
    changes = capture.diff(now, old)
    acks = spark.createDataFrame([(1, "ok"), (2, "failed"), (3, "pending"), (4, "ok")], "pk bigint, status string")
    after = capture.advance(old, changes, acks)
    assert {r.pk: r.row_hash for r in after.collect()} == {1: 10, 2: 21, 6: 60}
    assert ops(capture.diff(now, after)) == {2: "UPDATED", 3: "CREATED", 6: "DELETED"}
    r = capture.cycle_result("x", after, changes, acks).first()
    assert (r.state, r.created, r.updated, r.deleted, r.failed, r.pending, r.row_count) == ("HEALTHY", 1, 0, 1, 1, 1, 3)
    r = capture.cycle_result("x", after, changes, acks, aborted=True).first()
    assert (r.state, r.created, r.deleted) == ("DEGRADED", 0, 0)


def test_failing_entity_does_not_stop_the_others(spark, clans):
    good, bad = clans(ROWS, SKILLS), clans(ROWS, SKILLS)

    def hashes(spec):
        if spec is bad:
            raise RuntimeError("no table")
        return capture.entity_hashes(spec)

    found, errors = capture.diff_entities([bad, good], snapshots.empty_snapshot(spark), hashes)
    assert found.count() == 3 and list(errors.values()) == ["no table"]


def test_windows():
    assert windows.window_bounds(5, 4, 10) == [] and windows.window_bounds(None, None, 10) == []
    assert windows.window_bounds(1, 10, 10) == [(1, 10)] and windows.window_bounds(1, 11, 10) == [(1, 10), (11, 11)]
    assert len(windows.window_bounds(1, 12_200_000, 1_220_000)) == 10
    top = (1 << 63) - 1
    assert windows.window_bounds(top - 5, top, 4) == [(top - 5, top - 2), (top - 1, top)]
    with pytest.raises(ValueError):
        windows.window_bounds(0, 10_000_000, 1)
    assert windows.jdbc_predicates(1, 5, "id", 3) == ["id BETWEEN 1 AND 3", "id BETWEEN 4 AND 5"]


def test_planned_windows_reach_the_largest_key(spark):
    top = (1 << 63) - 1
    found = windows.plan_windows(spark.createDataFrame([(top - 5, top)], "lo bigint, hi bigint"), 4).orderBy("window_no").collect()
    assert [(r.lo, r.hi) for r in found] == [(top - 5, top - 2), (top - 1, top)]
    both = windows.pk_envelope(spark.createDataFrame([(5,)], "pk bigint"), spark.createDataFrame([], SNAP), "pk").first()
    assert (both.lo, both.hi) == (5, 5)


def test_snapshot_versions_and_damage(spark):
    path = shared_path(spark, "snapshot-test")
    assert snapshots.load_snapshot(spark, path).count() == 0
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], snapshots.SCHEMA)
    snapshots.save_snapshot(rows, path, 1)
    assert sorted(snapshots.load_snapshot(spark, path).collect()) == sorted(rows.collect())
    # A newer version without a manifest doesn't count; rows that don't match theirs empty their entity only.
    rows.where("pk = 1").write.parquet(f"{path}/data/version=2")
    assert snapshots.versions(spark, path) == [1] and snapshots.load_snapshot(spark, path).count() == 3
    spark.createDataFrame([("a", 3, 30)], snapshots.SCHEMA).write.mode("append").parquet(f"{path}/data/version=1")
    assert [tuple(r) for r in snapshots.load_snapshot(spark, path).select("entity", "pk", "row_hash").collect()] == [("b", 1, 5)]


def test_runtime_ticks(spark):
    rows = lambda xs: capture.population_hashes(spark.createDataFrame(xs, "pk bigint, payload struct<hp: int>, state_stamp bigint"))
    old, new = rows([(1, (5,), 0), (2, (5,), 0), (3, (5,), 1)]), rows([(2, (6,), 0), (3, (5,), 2), (4, (1,), 0)])
    changes = capture.runtime_diff(new, old)
    assert ops(changes) == {2: "UPDATED", 3: "UPDATED", 4: "CREATED"}
    acks = spark.createDataFrame([(2, "ok"), (3, "failed"), (4, "failed")], "pk bigint, status string")
    after = capture.runtime_advance(old, new, changes, acks)
    assert ops(capture.runtime_diff(new, after)) == {3: "UPDATED", 4: "CREATED"}
    assert tuple(capture.runtime_result(new, changes, acks).first()) == ("DEGRADED", 1, 2, 3)
    bad = spark.createDataFrame([(1, (1,), 0, 1), (1, (2,), 0, 2), (None, (3,), 0, 3), (2, None, 0, 4)], "pk bigint, payload struct<hp: int>, state_stamp bigint, seq int")
    assert [(r.pk, r.payload.hp) for r in capture.skip_bad_rows(bad, "seq").collect()] == [(1, 2)]


def test_settings_are_sent_once(spark):
    rows = [(1, 1, "a", 1, True), (1, 2, "a", 2, True), (1, 3, "b", 3, False), (1, 4, "b", 4, True), (1, 5, "b", 5, True)]
    s = spark.createDataFrame(rows, "k int, n int, v string, updated_at int, sent boolean")
    assert sorted(r.n for r in capture.settings_changes(s, "k", "n").collect()) == [1, 3, 4]


def test_resync_requests(spark, clans):
    asked = spark.createDataFrame([("r1", "clan", [1, 2]), ("r2", "nope", [1]), ("r3", "clan", []), ("r4", "clan", [0]), ("r5", None, None), ("r6", "clan", [2, 3])], "request_id string, entity string, pks array<bigint>")
    good, bad = resync.validate_resync(asked, ["clan", "item"])
    assert {r.request_id: r.reason for r in bad.collect()} == {"r2": "unknown entity", "r3": "no keys", "r4": "key not positive"}
    assert sorted((r.request_id, r.entity) for r in good.collect()) == [("r1", "clan"), ("r5", "clan"), ("r5", "item"), ("r6", "clan")]
    whole, keys = resync.merge_requests(good.where("request_id <> 'r5'"))
    assert whole.count() == 0 and sorted(r.pk for r in keys.collect()) == [1, 2, 3]
    assert [x.count() for x in resync.merge_requests(good)] == [2, 0]
    found = resync.cascade([clans(ROWS, SKILLS)], "alliance", spark.createDataFrame([(5,), (7,)], "pk bigint"))
    assert sorted(r.pk for r in found.collect()) == [1, 3] and resync.cascade([], "alliance", found).count() == 0


def test_completion_waits_for_a_clean_cycle(spark):
    asked = spark.createDataFrame([("r", "e", 2, 100), ("s", "e", 9, 900)], "request_id string, entity string, cycle int, started_at bigint")
    cycles = spark.createDataFrame([(1, "e", "HEALTHY", 0, 0), (2, "e", "DEGRADED", 0, 0), (3, "e", "HEALTHY", 1, 0), (4, "e", "HEALTHY", 0, 1), (5, "e", "HEALTHY", 0, 0), (6, "e", "HEALTHY", 0, 0)], "cycle int, entity string, state string, failed int, pending int")
    assert sorted((r.request_id, r.started_at, r.done_cycle) for r in resync.resync_complete(asked, cycles).collect()) == [("r", 100, 5), ("s", 900, None)]


def test_apply_laws(spark):
    old = [(k, k * 10) for k in range(20)]
    new = [(k, k * 10 + (k % 3 == 0)) for k in range(5, 30)]
    frame = lambda rows: spark.createDataFrame(rows, "pk bigint, v bigint")
    spec = lambda rows: EntitySpec("x", frame(rows), "pk", ("v",))
    changes = capture.diff(capture.entity_hashes(spec(new)), capture.entity_hashes(spec(old)))
    events = capture.change_events(spec(new), changes, F.lit(1).cast("bigint")).select("pk", "op", "payload.v", "ts_ms", F.lit(0).alias("seq"))
    once = apply.apply_changes(frame(old), events)
    assert sorted(map(tuple, once.collect())) == new
    assert sorted(map(tuple, apply.apply_changes(once, events).collect())) == new
    odd = spark.createDataFrame([(7, "NOISE", 1, 5, 0), (8, "UPDATED", 1, 5, 0), (8, "DELETED", None, 5, 1)], events.schema)
    assert sorted(map(tuple, apply.apply_changes(frame([(7, 0), (8, 0)]), odd).collect())) == [(7, 0)]


def test_catalogue_reconcile_is_careful(spark):
    target = spark.createDataFrame([("i", k, f"v{k}") for k in range(4)], "entity_name string, pk bigint, payload string")
    burst = lambda ks: apply.catalogue_burst(spark.createDataFrame([(k,) for k in ks], "id bigint"), "i", F.col("id"), "s", F.lit(1).cast("bigint"), F.lit("new"))
    left = lambda b: sorted(r.pk for r in apply.reconcile_catalogue(target, b).collect())
    assert apply.catalogue_burst(None, "i", F.col("id"), "s", F.lit(1), F.lit("x")) is None
    assert left(burst([1, 7])) == [1, 7]
    assert left(burst([])) == [0, 1, 2, 3]  # a count of 0 removes nothing
    assert left(burst([1, 7]).where("op = 'UPSERT'")) == [0, 1, 2, 3, 7]  # no marker
    assert left(burst([1, 7]).where("pk IS NULL OR pk = 1")) == [0, 1, 2, 3]  # a row was lost


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_narrow(spark, sf):
    """Targeted capture picks rows before it hashes them, a board is cut down before the shuffle, failed windows and
    completions are no theta joins."""
    from tidemark.operators import events, resync
    from tidemark.plans import capture_queries as q
    from tidemark.plans import event_queries
    from tidemark.sources import windows

    old = q.stored_snapshot(spark, sf)
    targeted = plan_of(capture.diff_targeted_entity(q.current_spec(spark, sf), old, q.targets(spark, sf)))
    lines = targeted[targeted.index("l_orderkey") :]
    assert "LeftSemi" in lines and lines.index("partial_sum") < lines.index("LeftSemi") and "NestedLoop" not in targeted
    assert "WindowGroupLimit" in plan_of(events.leaderboard(event_queries.ratings_of(spark, sf), 10))
    asked = spark.createDataFrame([(f"r{k}", "e", k, k) for k in range(1, 9)], "request_id string, entity string, cycle bigint, started_at bigint")
    cycles = spark.createDataFrame([("e", k, "DEGRADED" if k in (1, 2, 5) else "HEALTHY", int(k == 3), 0) for k in range(1, 8)], "entity string, cycle bigint, state string, failed int, pending int")
    done = resync.resync_complete(asked, cycles)
    assert "NestedLoop" not in plan_of(done) and {r.request_id: r.done_cycle for r in done.collect()} == {"r1": 4, "r2": 4, "r3": 4, "r4": 4, "r5": 6, "r6": 6, "r7": 7, "r8": None}
    hashes = capture.entity_hashes(q.current_spec(spark, sf))
    plan = windows.plan_windows(hashes.agg({"pk": "min"}).select(F.lit(0).cast("bigint").alias("lo"), F.lit(1999).cast("bigint").alias("hi")), 100)
    assert "BETWEEN" not in plan_of(capture.diff_windows(hashes, old, plan, plan.where("window_no = 3").select("window_no"))).upper()
