"""The two ledgers: command receipts and offline sessions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.trees import rooted
from tidemark.scratch import cut, shared_path

RECEIPTS = (
    "correlation_id string, command string, buyer_char_id int, seller_char_id int, status string, charged_adena bigint, mail_id int, "
    "claim_json string, result_json string, created_at timestamp, completed_at timestamp, steps_done_at timestamp"
)
SESSIONS = (
    "id bigint, idempotency_key string, character_id int, active_character_id int, master_account_id string, activity string, account_name string, "
    "hwid string, initiator_ip string, spot_pool string, spot_id int, active_spot_key string, origin_x int, origin_y int, origin_z int, "
    "origin_heading int, started_at timestamp, planned_ms bigint, active_ms bigint, type_state string, ended_at timestamp, end_reason string"
)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECEIPTS).parquet(path)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SESSIONS).parquet(path)


def receipts_open(ledger: DataFrame, command: str | None = None) -> DataFrame:
    """STARTED and CHARGED receipts, oldest first."""
    found = ledger.where("status IN ('STARTED', 'CHARGED')")
    found = found if command is None else found.where(F.col("command") == command)
    return found.orderBy("created_at", "correlation_id")


def open_commands(ledger: DataFrame) -> DataFrame:
    return ledger.where("status IN ('STARTED', 'CHARGED')").select("command").distinct()


def receipts_stale(ledger: DataFrame, command: str, before: Column) -> DataFrame:
    return ledger.where((F.col("command") == command) & (F.col("status") == "STARTED") & (F.col("created_at") < before))


def receipts_open_steps(ledger: DataFrame, command: str) -> DataFrame:
    return ledger.where((F.col("command") == command) & (F.col("status") == "OK") & F.col("steps_done_at").isNull())


def receipts_prune(ledger: DataFrame, cutoff: Column, tracked: list[str]) -> DataFrame:
    """What stays: all but OK and FAILED receipts older than the cutoff; OK ones of tracked commands with open steps stay."""
    old = F.col("status").isin("OK", "FAILED") & (F.coalesce("completed_at", "created_at") < cutoff)
    held = (F.col("status") == "OK") & F.col("steps_done_at").isNull() & F.col("command").isin(tracked)
    return ledger.where(~(old & ~held))


def claim_outcome(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests (correlation_id, command, ts) with ``outcome`` and, for a replay, the stored result.

    CLAIMED if the ledger has none or a failed one and this is the first request of its id in the batch;
    REPLAY_OK with the result if it is OK; otherwise IN_FLIGHT.
    """
    first = F.row_number().over(Window.partitionBy("correlation_id").orderBy("ts")) == 1
    known = ledger.select("correlation_id", F.col("status").alias("__status"), F.col("result_json").alias("__result"))
    both = requests.withColumn("__first", first).join(known, "correlation_id", "left")
    free = F.col("__status").isNull() | (F.col("__status") == "FAILED")
    outcome = F.when(F.col("__status") == "OK", "REPLAY_OK").when(free & F.col("__first"), "CLAIMED").otherwise("IN_FLIGHT")
    return both.withColumn("outcome", outcome).withColumn("result_json", F.when(F.col("outcome") == "REPLAY_OK", F.col("__result"))).drop("__first", "__status", "__result")


def lookup(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Requests (correlation_id) with the ``outcome`` that their receipt tells, nothing being claimed: null where there
    is none or a failed one, REPLAY_OK with the result, else IN_FLIGHT."""
    known = ledger.select(F.col("correlation_id").alias("__id"), F.col("status").alias("__status"), F.col("result_json").alias("__result"))
    both = requests.join(known, F.col("correlation_id") == F.col("__id"), "left")
    free = F.col("__id").isNull() | F.coalesce(F.col("__status") == "FAILED", F.lit(False))
    outcome = F.when(~free, F.when(F.col("__status") == "OK", "REPLAY_OK").otherwise("IN_FLIGHT"))
    return both.withColumn("outcome", outcome).withColumn("result_json", F.when(F.col("outcome") == "REPLAY_OK", F.col("__result"))).drop("__id", "__status", "__result")


#: What a claim may tell of its parties and its cause.
CLAIM = ("buyer_char_id", "seller_char_id", "mail_id", "claim_json")


def apply_claims(ledger: DataFrame, claims: DataFrame) -> DataFrame:
    """The ledger after claims (correlation_id, command, ts, outcome and any columns of CLAIM).

    A new receipt takes all of the claim. A failed one that is reopened keeps its command and parties, takes mail and
    claim, and loses charge, result and completion; the charge of either is null until there is one.
    """
    fields = {c: F.col(c) if c in claims.columns else F.lit(None).cast(ledger.schema[c].dataType) for c in CLAIM}
    won = claims.where("outcome = 'CLAIMED'").select(F.col("correlation_id").alias("__id"), F.col("command").alias("__command"), F.col("ts").cast("timestamp").alias("__ts"), *[c.alias(f"__{n}") for n, c in fields.items()])
    both = ledger.join(won, F.col("correlation_id") == F.col("__id"), "full_outer")
    claimed, stored = F.col("__id").isNotNull(), F.col("correlation_id").isNotNull()
    told = lambda c: F.when(claimed, F.col(f"__{c}")).otherwise(F.col(c))
    kept = lambda c: F.when(~claimed, F.col(c))
    new = {
        "correlation_id": F.coalesce("correlation_id", "__id"),
        "command": F.when(stored, F.col("command")).otherwise(F.col("__command")),
        "buyer_char_id": F.when(stored, F.col("buyer_char_id")).otherwise(F.col("__buyer_char_id")),
        "seller_char_id": F.when(stored, F.col("seller_char_id")).otherwise(F.col("__seller_char_id")),
        "status": F.when(claimed, "STARTED").otherwise(F.col("status")),
        "mail_id": told("mail_id"),
        "claim_json": told("claim_json"),
        "created_at": F.when(claimed, F.col("__ts")).otherwise(F.col("created_at")),
    } | {c: kept(c) for c in ("charged_adena", "result_json", "completed_at")}
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in ledger.columns])


OPEN = ("STARTED", "CHARGED")
#: action: (statuses it starts from, or None for any; status it leads to, or None to keep it)
TRANSITIONS = {
    "charge": (None, "CHARGED"),
    "charge_if_started": (("STARTED",), "CHARGED"),
    "ok": (None, "OK"),
    "ok_if_started": (("STARTED",), "OK"),
    "ok_if_charged": (("CHARGED",), "OK"),
    "ok_if_open": (OPEN, "OK"),
    "refund": (("CHARGED",), "STARTED"),
    "fail": (OPEN, "FAILED"),
    "fail_if_started": (("STARTED",), "FAILED"),
    "amend_open": (OPEN, None),
    "amend_completed": (("OK",), None),
    "steps_done": (("OK",), None),
}
_STATE = {"status": "string", "charged_adena": "bigint", "mail_id": "int", "claim_json": "string", "result_json": "string", "completed_at": "timestamp", "steps_done_at": "timestamp"}
_MOVE = {"action": "string", "ts": "timestamp", "amount": "bigint", "told_result": "string", "told_claim": "string", "expected": "string"}


def moved(state: dict, move: dict) -> dict | None:
    """A receipt's state after a move, None if the move's guard fails."""
    start, end = TRANSITIONS.get(move["action"], ((), None))
    if state["status"] is None or (start is not None and state["status"] not in start):
        return None
    action, claim = move["action"], move["told_claim"]
    new = state | {"status": end or state["status"]}
    if action.startswith("amend"):
        return new | {"claim_json": claim} if state["claim_json"] == move["expected"] else None
    if action == "steps_done":
        return new | {"steps_done_at": move["ts"]} if state["steps_done_at"] is None else None
    if action == "refund":
        new["charged_adena"] = 0
    elif move["amount"] is not None and action in ("charge", "charge_if_started", "ok", "ok_if_open"):
        new["charged_adena"] = move["amount"]
    if end == "OK":
        new |= {"result_json": move["told_result"], "completed_at": move["ts"]}
    if end == "FAILED":
        return new | {"mail_id": None, "claim_json": None, "completed_at": move["ts"]}
    return new if claim is None else new | {"claim_json": claim}


def settle(ledger: DataFrame, transitions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ledger after the transitions, transitions with ``applied``) of rows (correlation_id, action, ts, amount,
    result_json, and optionally claim_json and expected_claim_json).

    Those of a receipt are taken in the order of time. One whose guard fails, whose receipt isn't there or whose
    action is unknown does nothing and is reported. A charge or a success may bring a new claim, a refund takes the
    charge back and keeps the claim that it brings, an amendment replaces an expected claim, a failure clears mail and
    claim, and steps are done once.
    """
    told = {"amount": "amount", "told_result": "result_json", "told_claim": "claim_json", "expected": "expected_claim_json"}
    moves = transitions.select("correlation_id", "action", F.col("ts").cast("timestamp").alias("ts"), *[(F.col(c) if c in transitions.columns else F.lit(None)).cast(_MOVE[n]).alias(n) for n, c in told.items()])
    both = moves.join(ledger.select("correlation_id", *_STATE), "correlation_id", "left").select("correlation_id", *_MOVE, *_STATE)
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "timestamp": pa.timestamp("us", "UTC")}

    def walk(batches):
        key, state, n = None, {}, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if n == 0 or row["correlation_id"] != key:
                    key, state, n = row["correlation_id"], {c: row[c] for c in _STATE}, 0
                new = moved(state, row)
                state, n = state if new is None else new, n + 1
                out.append({"correlation_id": key, "action": row["action"], "ts": row["ts"], "n": n, "applied": new is not None} | state)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("correlation_id", pa.string()), ("action", pa.string()), ("ts", kinds["timestamp"]), ("n", pa.int64()), ("applied", pa.bool_()), *[(c, kinds[k]) for c, k in _STATE.items()]]))

    # A receipt's moves are neighbours in one task, so its state is all that a task remembers.
    ordered = both.repartition("correlation_id").sortWithinPartitions("correlation_id", "ts", "action")
    schema = "correlation_id string, action string, ts timestamp, n bigint, applied boolean, " + ", ".join(f"{c} {k}" for c, k in _STATE.items())
    walked = cut(ordered.mapInArrow(walk, schema), "settled")
    last = walked.groupBy(F.col("correlation_id").alias("__id")).agg(F.max_by(F.struct(*_STATE), "n").alias("__s"))
    after = ledger.join(last, F.col("correlation_id") == F.col("__id"), "left")
    after = after.select(*[(F.when(F.col("__id").isNotNull(), F.col(f"__s.{c}")).otherwise(F.col(c)) if c in _STATE else F.col(c)).alias(c) for c in ledger.columns])
    return after, walked.select("correlation_id", "action", "ts", "applied")


def sessions_open(sessions: DataFrame) -> DataFrame:
    return sessions.where("ended_at IS NULL").orderBy("started_at", "id")


def sessions_retention(sessions: DataFrame, cutoff: Column | None) -> DataFrame:
    """Sessions without those that ended before the cutoff; no cutoff keeps all."""
    return sessions if cutoff is None else sessions.where(F.col("ended_at").isNull() | (F.col("ended_at") >= cutoff))


def session_admission(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Requests (idempotency_key, character_id, spot_key, ts) with ``verdict``, as if inserted one by one in the order
    of ``ts``: DUPLICATE if a session, or a request that was admitted before, has the key; else CHARACTER_ACTIVE or
    SPOT_TAKEN if an open session or a request admitted before has the character or spot; else ADMITTED. A request
    that isn't admitted takes nothing. Null spots are free.

    Rounds: requests that come first for their key, character and spot are admitted, and all that meet them are decided
    with them. A request that only one undecided request comes before is admitted if that one isn't, so chains of such
    requests are followed to their heads by pointer jumping and are decided in the round of the head.
    """
    names = ("idempotency_key", "character_id", "spot_key")
    n = F.row_number().over(Window.partitionBy(*names, "ts").orderBy("ts"))
    rows = requests.select("*", F.struct("ts", *names, n.alias("n")).alias("__o"))
    rows = cut(rows, "admission")
    spark = rows.sparkSession
    active = sessions.where("ended_at IS NULL")
    held = {"idempotency_key": sessions.select("idempotency_key"), "character_id": active.select(F.col("active_character_id").alias("character_id")), "spot_key": active.select(F.col("active_spot_key").alias("spot_key"))}
    undecided = rows.select(*names, "__o")
    for c, known in held.items():
        undecided = undecided.join(known.where(F.col(c).isNotNull()).distinct(), c, "left_anti")
    undecided, admissions = cut(undecided, "admission-undecided"), shared_path(spark, "admitted")
    undecided.limit(0).write.parquet(admissions)
    while not undecided.isEmpty():
        ranked = undecided
        for c in names:
            ranked = ranked.join(_first_two(undecided.where(F.col(c).isNotNull()), c, f"__{c}"), c, "left")
        # Who comes before a request for each of the three: nobody, one request, or several.
        ahead = [F.when(F.col(f"__{c}.first") < F.col("__o"), F.col(f"__{c}.first")) for c in names]
        several = F.lit(False)
        for c in names:
            several |= F.coalesce(F.col(f"__{c}.second") < F.col("__o"), F.lit(False))
        one, other = F.least(*ahead), F.greatest(*ahead)
        ranked = cut(ranked.select(*names, "__o", one.alias("q"), (several | (one != other)).alias("several")), "admission-ranked")
        first = ranked.where("q IS NULL").select(*names, "__o")
        links = ranked.where("q IS NOT NULL AND NOT several").select("__o", "q")
        if not links.isEmpty():
            heads = ranked.select("__o").join(links.select("__o"), "__o", "left_anti").select("__o", F.lit(None).cast(links.schema["q"].dataType).alias("q"))
            found, _ = rooted(links.unionByName(heads), "__o", "q")
            chained = found.where("depth > 0 AND depth % 2 = 0").join(first.select(F.col("__o").alias("root")), "root", "left_semi")
            first = first.unionByName(ranked.select(*names, "__o").join(chained.select("__o"), "__o", "left_semi"))
        first = cut(first, "admission-first")
        first.write.mode("append").parquet(admissions)
        for c in names:
            undecided = undecided.join(first.where(F.col(c).isNotNull()).select(c).distinct(), c, "left_anti")
        # What is admitted meets itself by its key at least, unless it has none of the three.
        undecided = cut(undecided.join(first.select("__o"), "__o", "left_anti").select(*names, "__o"), "admission-undecided")
    admitted = spark.read.schema(undecided.schema).parquet(admissions)
    out = rows
    for c, known in held.items():
        own = known.where(F.col(c).isNotNull()).distinct().withColumn(f"__held_{c}", F.lit(True))
        out = out.join(own, c, "left").join(admitted.where(F.col(c).isNotNull()).select(c, F.col("__o").alias(f"__by_{c}")), c, "left")
    meets = lambda c: F.coalesce(F.col(f"__held_{c}"), F.lit(False)) | F.coalesce(F.col(f"__by_{c}") < F.col("__o"), F.lit(False))
    verdict = F.when(meets("idempotency_key"), "DUPLICATE").when(meets("character_id"), "CHARACTER_ACTIVE").when(meets("spot_key"), "SPOT_TAKEN").otherwise("ADMITTED")
    return out.select(*requests.columns, verdict.alias("verdict"))


def flush_active_ms(sessions: DataFrame, updates: DataFrame) -> DataFrame:
    """Open sessions take a larger active time of (id, active_ms); it never falls, and closed ones don't change."""
    most = updates.groupBy("id").agg(F.max("active_ms").alias("__ms"))
    both = sessions.join(most, "id", "left")
    return both.withColumn("active_ms", F.when(F.col("ended_at").isNull(), F.greatest("active_ms", "__ms")).otherwise(F.col("active_ms"))).select(*sessions.columns)


def close_sessions(sessions: DataFrame, closes: DataFrame) -> DataFrame:
    """Open sessions of (id, ended_at, end_reason, optionally active_ms) end, by the earliest close, and free their
    character and spot."""
    ms = F.col("active_ms") if "active_ms" in closes.columns else F.lit(None).cast("bigint")
    first = closes.groupBy("id").agg(F.min("ended_at").alias("__at"), F.min_by(F.struct(F.col("end_reason").alias("why"), ms.alias("ms")), "ended_at").alias("__c"))
    both = sessions.join(first, "id", "left").withColumns({"__why": F.col("__c.why"), "__ms": F.col("__c.ms")})
    ends = F.col("ended_at").isNull() & F.col("__at").isNotNull()
    new = {"active_ms": F.when(ends, F.coalesce("__ms", "active_ms")).otherwise(F.col("active_ms")), "ended_at": F.when(ends, F.col("__at")).otherwise(F.col("ended_at")), "end_reason": F.when(ends, F.col("__why")).otherwise(F.col("end_reason")), "active_character_id": F.when(~ends, F.col("active_character_id")), "active_spot_key": F.when(~ends, F.col("active_spot_key"))}
    return both.select(*[new.get(c, F.col(c)).alias(c) for c in sessions.columns])


def _first_two(rows: DataFrame, by: str, name: str) -> DataFrame:
    """(by, name): the first and the second ``__o`` of each group, aggregated in each task before they are shuffled."""
    first = rows.groupBy(by).agg(F.min("__o").alias("__first"))
    second = rows.join(first, by).where(F.col("__o") > F.col("__first")).groupBy(by).agg(F.min("__o").alias("__second"))
    return first.join(second, by, "left").select(by, F.struct(F.col("__first").alias("first"), F.col("__second").alias("second")).alias(name))


def _placeable(waiting: DataFrame, spots: DataFrame) -> DataFrame:
    """(id, want, __o, verdict) of the waiting placements that ``spots``, the sessions and what they hold, decide."""
    by_id = waiting.groupBy("id").agg(F.min("__o").alias("o_id"))
    by_spot = waiting.groupBy("want").agg(F.min("__o").alias("o_spot"))
    leaves = waiting.join(spots, "id").where("want <> spot").select("id", "__o")
    holders = spots.where("spot IS NOT NULL").join(_first_two(leaves, "id", "leave"), "id", "left")
    holders = holders.join(by_spot.select(F.col("want").alias("spot")), "spot", "left_semi").select(F.col("spot").alias("want"), F.col("id").alias("holder"), F.col("leave.first").alias("leave"), F.col("leave.second").alias("leave2"))
    met = waiting.join(holders, "want", "left")
    stays = F.coalesce(F.col("leave") > F.col("__o"), F.col("holder").isNotNull())
    own = F.col("holder") == F.col("id")
    # A spot that sessions share by mistake is held until the last of them has left.
    met = met.groupBy("id", "want", "__o").agg(
        F.coalesce(F.bool_or(stays & ~own), F.lit(False)).alias("held"),
        F.coalesce(F.bool_or(own & (F.col("leave").isNull() | (F.col("leave") >= F.col("__o")))), F.lit(False)).alias("mine"),
        F.count_if(F.col("holder").isNotNull() & ~own).alias("others"),
        F.min(F.when(~own & (F.col("leave") < F.col("__o")) & (F.col("leave2").isNull() | (F.col("leave2") > F.col("__o"))), F.col("leave"))).alias("q"),
    )
    met = met.join(by_id, "id").join(by_spot, "want")
    next_ = (F.col("o_id") == F.col("__o")) & (F.col("o_spot") == F.col("__o"))
    verdict = F.when(F.col("held"), "SPOT_TAKEN").when((F.col("others") == 0) & (F.col("mine") | next_), "PLACED")
    met = met.select("id", "want", "__o", verdict.alias("verdict"), F.when(verdict.isNull() & next_ & (F.col("others") == 1), F.col("q")).alias("q"))
    met = cut(met, "placements-met")
    ready = met.where("verdict IS NOT NULL").select("id", "want", "__o", "verdict")
    if not met.where("q IS NOT NULL").isEmpty():
        found, _ = rooted(met.select("__o", "q"), "__o", "q")
        chained = found.where("depth > 0").join(ready.select(F.col("__o").alias("root"), "verdict"), "root").select("__o", "verdict")
        ready = ready.unionByName(met.select("id", "want", "__o").join(chained, "__o"))
    return cut(ready.select("id", "want", "__o", "verdict"), "placements-ready")


def place_sessions(sessions: DataFrame, placements: DataFrame, order: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(sessions, placements with ``verdict``) for placements (id, spot_pool, spot_id, optionally started_at and
    type_state), as if made one by one in the ``order`` given: NOT_OPEN if the session isn't open, SPOT_TAKEN if another
    open session holds the spot by then, else PLACED. A session that moves frees its spot for later placements. Only spot
    and spot key change, and start and type state where they are given.

    Rounds: a placement is SPOT_TAKEN as soon as another session is sure to hold the spot until after it, whatever else
    waits for the spot, so all contenders of a held spot are settled together. The first contender of a spot that its
    holder leaves if one other placement succeeds has that one's verdict; such chains are followed to their heads by
    pointer jumping. A session moves at most once a round, so a session with many moves takes that many rounds.
    """
    extra = [c for c in ("started_at", "type_state") if c in placements.columns]
    key = F.concat_ws(":", "spot_pool", F.col("spot_id").cast("string"))
    open_ = sessions.where("ended_at IS NULL").select("id", F.col("active_spot_key").alias("spot"))
    tries = placements.select("id", "spot_id", key.alias("want"), *extra, F.struct(order, "id", key.alias("k"), F.row_number().over(Window.partitionBy("id", order, key).orderBy("id")).alias("n")).alias("__o"))
    tries = cut(tries, "placements")
    spark = tries.sparkSession
    waiting = cut(tries.select("id", "want", "__o").join(open_.select("id"), "id", "left_semi"), "placements-open")
    decided = shared_path(spark, "placements-decided")
    waiting.limit(0).withColumn("verdict", F.lit("")).write.parquet(decided)
    spots = cut(open_.join(waiting.select("id").distinct().unionByName(open_.join(waiting.select(F.col("want").alias("spot")).distinct(), "spot", "left_semi").select("id")).distinct(), "id", "left_semi"), "spots")
    while not waiting.isEmpty():
        ready = _placeable(waiting, spots)
        ready.write.mode("append").parquet(decided)
        now = ready.where("verdict = 'PLACED'").groupBy("id").agg(F.max_by("want", "__o").alias("now"))
        spots = cut(spots.join(now, "id", "left").select("id", F.coalesce("now", "spot").alias("spot")), "spots")
        waiting = cut(waiting.join(ready.select("__o"), "__o", "left_anti").select("id", "want", "__o"), "placements-open")
    done = spark.read.schema(waiting.withColumn("verdict", F.lit("")).schema).parquet(decided)
    judged = tries.join(done.select("__o", "verdict"), "__o", "left").withColumn("verdict", F.coalesce("verdict", F.lit("NOT_OPEN")))
    placed = judged.where("verdict = 'PLACED'").groupBy(F.col("id").alias("__id")).agg(F.max_by(F.struct("spot_id", "want"), "__o").alias("__p"), *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__o"))).alias(f"__{c}") for c in extra])
    both = sessions.join(placed, F.col("id") == F.col("__id"), "left")
    new = {"spot_id": F.coalesce("__p.spot_id", "spot_id").cast("int"), "active_spot_key": F.coalesce("__p.want", "active_spot_key")} | {c: F.coalesce(f"__{c}", c) for c in extra}
    after = both.select(*[new.get(c, F.col(c)).alias(c) for c in sessions.columns])
    return after, judged.select("id", "spot_id", F.col("want").alias("spot_key"), F.col(f"__o.{order}").alias(order), "verdict")


def valid_sessions(sessions: DataFrame, activities: list[str], reasons: list[str]) -> DataFrame:
    """Rows whose activity is known and whose end reason is known or null."""
    return sessions.where(F.col("activity").isin(activities) & (F.col("end_reason").isNull() | F.col("end_reason").isin(reasons)))
