"""Operators on typed event families: sessions, matches, lineage, boards, books, mail, sieges, chats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.apply import latest
from tidemark.operators.trees import shortest_origins
from tidemark.scratch import cut
from tidemark.sources.records import decode_envelope, route_by_type


def typed_events(records: DataFrame, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """A table per message type of a topic's records, with key and payload; unknown types are in none."""
    routed = route_by_type(records, list(schemas))
    return {kind: decode_envelope(routed.where(F.col("msg_type") == kind), schema)[0] for kind, schema in schemas.items()}


def dedup_events(events: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Each event once, for batches."""
    return events.dropDuplicates([event_id])


def presence_sessions(events: DataFrame, key: str = "char_id", time: str = "ts") -> DataFrame:
    """(session_id, key, started, ended, duration_s, reason, resumed): starts and ends by session id; a session
    without an end is open, an event without a session id starts one that stays open."""
    start = events.where(F.col("online")).select("session_id", key, F.col(time).alias("started"), "resumed")
    end = events.where(~F.col("online") & F.col("session_id").isNotNull()).groupBy("session_id").agg(F.min(time).alias("ended"), F.min_by("logout_reason", time).alias("reason"))
    both = start.join(end, "session_id", "left")
    seconds = (F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 1_000_000
    return both.select("session_id", key, "started", "ended", seconds.alias("duration_s"), "reason", "resumed")


def bad_presence(events: DataFrame) -> DataFrame:
    """Presence events that break a rule, with the first ``reason``: no source; an app session without an activity or a
    client session with one; a reason to leave on a start, or none on an end; resumed on anything but the start of an
    app session. A consumer rechecks these, as decoding may skip the producer's checks."""
    resumed, app = F.coalesce("resumed", F.lit(False)), F.coalesce(F.col("source") == "APP", F.lit(False))
    reason = (
        F.when(F.col("source").isNull(), "no source")
        .when(app & F.col("activity").isNull(), "app session without activity")
        .when(~app & F.col("activity").isNotNull(), "client session with activity")
        .when(F.col("online") & F.col("logout_reason").isNotNull(), "start with a reason to leave")
        .when(~F.col("online") & F.col("logout_reason").isNull(), "end without a reason")
        .when(resumed & ~(F.col("online") & app), "resumed without an app start")
    )
    return events.withColumn("reason", reason).where("reason IS NOT NULL")


def match_pairs(results: DataFrame) -> DataFrame:
    """(match_id, char_id, opponent_char_id, outcome, other_outcome, consistent): both sides' views of a match."""
    other = results.select(F.col("match_id").alias("__m"), F.col("char_id").alias("__c"), F.col("outcome").alias("other_outcome"))
    both = results.join(other, (F.col("match_id") == F.col("__m")) & (F.col("opponent_char_id") == F.col("__c")), "left")
    mirror = F.when(F.col("outcome") == "win", "loss").when(F.col("outcome") == "loss", "win").otherwise(F.col("outcome"))
    return both.select("match_id", "char_id", "opponent_char_id", "outcome", "other_outcome", F.col("other_outcome").eqNullSafe(mirror).alias("consistent"))


def item_lineage(moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, lost) over moves (item_id, new_item_id): (item_id, origin_id, steps) with where each item came from,
    followed back any number of moves to items that nothing became, by the fewest steps; and the items whose moves go
    round in circles."""
    edges = moves.where("new_item_id IS NOT NULL AND item_id <> new_item_id").select(F.col("new_item_id").alias("to"), F.col("item_id").alias("origin")).distinct()
    return shortest_origins(edges)


def enrich(events: DataFrame, entity: DataFrame, key: str, entity_key: str, columns: Mapping[str, str]) -> DataFrame:
    """Events with columns of a synced entity, or null where it isn't known; works stream to static as well."""
    own = entity.select(F.col(entity_key).alias("__key"), *[F.col(c).alias(name) for c, name in columns.items()])
    return events.join(own, F.col(key) == F.col("__key"), "left").drop("__key")


def resolve_killers(deaths: DataFrame, characters: DataFrame, npcs: DataFrame) -> DataFrame:
    """Deaths with ``killer_name``: a player's from the characters, a monster's or boss's from the catalogue."""
    player = F.when(F.col("killer_type") == "player", F.col("killer_id"))
    npc = F.when(F.col("killer_type").isin("monster", "boss"), F.col("killer_id"))
    own = deaths.withColumn("__player", player).withColumn("__npc", npc)
    own = enrich(enrich(own, characters, "__player", "char_id", {"name": "__pn"}), npcs, "__npc", "npc_id", {"name": "__nn"})
    return own.withColumn("killer_name", F.coalesce("__pn", "__nn")).drop("__player", "__npc", "__pn", "__nn")


def effect_details(characters: DataFrame, skill_levels: DataFrame) -> DataFrame:
    """A row per effect with its catalogue columns, by (skill_id, skill_level, enchant)."""
    each = characters.select("char_id", F.posexplode("effects").alias("position", "effect")).select("char_id", "position", "effect.*")
    return each.join(skill_levels, ["skill_id", "skill_level", "enchant"], "left")


#: Rows of the largest board up to which a board is ordered by one task.
BOARD_ROWS = 1_000_000


def rating_rank(ratings: DataFrame, by: Sequence[str] = ("rating_type", "season"), points: str = "points", key: str = "char_id") -> DataFrame:
    """Ratings with ``rank`` and ``position``: more points first, ties by key; a null season is the seasonless one. Boards of
    more than BOARD_ROWS rows are ordered in ranges by many tasks."""
    largest = ratings.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if largest <= BOARD_ROWS:
        order = Window.partitionBy(*by).orderBy(F.desc(points), key)
        return ratings.withColumn("position", F.row_number().over(order)).withColumn("rank", F.min("position").over(Window.partitionBy(*by, points)))
    placed = positions(ratings, by, [F.desc(points), F.asc(key)])
    same = [*by, points]
    firsts = placed.groupBy(*same).agg(F.min("position").alias("rank")).toDF(*[f"__{c}" for c in same], "rank")
    match = F.lit(True)
    for c in same:
        match &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return placed.join(firsts, match).select(*placed.columns, "rank")


def positions(rows: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows with ``position``, from 1, in the order of their group. Groups are dealt out by ranges of the order and counted
    by range, so a task orders its share of a group, and one group may hold all rows; ties are dealt out by a number of
    their own."""
    spread = rows.repartitionByRange(*[F.col(c) for c in by], *order, F.monotonically_increasing_id())
    spread = cut(spread.withColumn("__part", F.spark_partition_id()), "positions")
    held = spread.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__held"))
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__part").alias("__of"), F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__start"))
    match = F.col("__part") == F.col("__of")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = F.row_number().over(Window.partitionBy(*by, "__part").orderBy(*order))
    placed = spread.withColumn("__inside", inside).join(starts, match)
    return placed.select(*rows.columns, (F.col("__start") + F.col("__inside")).alias("position"))


def leaderboard(ratings: DataFrame, n: int, by: Sequence[str] = ("rating_type", "season"), points: str = "points", key: str = "char_id") -> DataFrame:
    """The first ``n`` of each board with their rank. Every task keeps ``n`` rows of a board before the shuffle, so one
    board may hold most of the rows; ranks are made of what is left."""
    order = Window.partitionBy(*by).orderBy(F.desc(points), key)
    top = ratings.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)
    return top.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(points))))


def online_series(snapshots: DataFrame, width: str, time: str = "ts", counts: str = "counts") -> DataFrame:
    """(window_start, bucket, mean, most) of snapshots' bucket maps. Buckets overlap, so they are never added up.
    Snapshots without TOTAL or UNIQUE are left out."""
    sound = snapshots.where(F.map_contains_key(counts, F.lit("TOTAL")) & F.map_contains_key(counts, F.lit("UNIQUE")))
    each = sound.select(time, F.explode(counts).alias("bucket", "n"))
    return each.groupBy(F.window(time, width).start.alias("window_start"), "bucket").agg(F.avg("n").alias("mean"), F.max("n").alias("most"))


def raid_contribution(kills: DataFrame) -> DataFrame:
    """(kill_id, owner, damage, rank): participants by damage; those of a party own together."""
    each = kills.select("kill_id", F.inline("participants"))
    owner = F.when(F.col("party_id").isNotNull(), F.concat(F.lit("party:"), F.col("party_id").cast("string"))).otherwise(F.concat(F.lit("char:"), F.col("char_id").cast("string")))
    sums = each.groupBy("kill_id", owner.alias("owner")).agg(F.sum("damage").alias("damage"))
    return sums.withColumn("rank", F.row_number().over(Window.partitionBy("kill_id").orderBy(F.desc("damage"), "owner")))


def sale_totals(purchases: DataFrame, lines: str = "lines") -> DataFrame:
    """(item_template_id, currency_id, n_lines, items, revenue): unit price times count, never across currencies."""
    each = purchases.select(F.inline(lines))
    return each.groupBy("item_template_id", "currency_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("count").alias("items"), F.sum(F.col("unit_price") * F.col("count")).alias("revenue"))


def offer_order() -> list[Column]:
    return [F.asc("unit_price"), F.asc("trader_id"), F.asc_nulls_first("enchant_level"), F.asc("count"), F.asc("currency_id"), F.asc("item_id")]


def private_store_book(events: DataFrame, now: Column, silence_s: int = 1500, key: str = "char_id", time: str = "ts") -> DataFrame:
    """Open stores: each trader's last state unless it is null, which closes the store, or older than ``silence_s``."""
    last = latest(events, [key], time, "event_id")
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(time).cast("timestamp"))
    return last.where(F.col("store").isNotNull() & (age < silence_s * 1_000_000))


def order_book(book: DataFrame, key: str = "char_id") -> DataFrame:
    """Lines of the open stores with ``place`` in canonical order and ``best``, the best price of their template, side
    and currency: the lowest of sellers, the highest of buyers."""
    each = book.select(F.col(key).alias("trader_id"), F.col("store.side").alias("side"), F.inline("store.lines"))
    goods = Window.partitionBy("item_template_id", "side", "currency_id")
    best = F.when(F.col("side") == "BUY", F.max("unit_price").over(goods)).otherwise(F.min("unit_price").over(goods))
    return each.withColumn("place", F.row_number().over(goods.orderBy(*offer_order()))).withColumn("best", best)


MAIL = {"MailSentEvent": "sent", "MailReadEvent": "read", "MailAcceptedEvent": "accepted", "MailCancelledEvent": "cancelled", "MailReturnedEvent": "returned", "MailDeletedEvent": "deleted"}


def mail_lifecycle(events: DataFrame, time: str = "ts", kinds: Mapping[str, str] = MAIL) -> DataFrame:
    """One row a mail with the first time of each step."""
    return events.groupBy("mail_id").agg(*[F.min(F.when(F.col("msg_type") == kind, F.col(time))).alias(f"{name}_at") for kind, name in kinds.items()])


def trade_edges(trades: DataFrame) -> DataFrame:
    """Directed item movements of both parties."""
    side = lambda a, b: trades.select("trade_id", F.col(f"{a}_char_id").alias("from_char_id"), F.col(f"{b}_char_id").alias("to_char_id"), F.inline(f"{a}_items"))
    return side("first", "second").unionByName(side("second", "first"))


def siege_results(sieges: DataFrame) -> DataFrame:
    """A row per clan that took part, with its side and whether it holds the castle."""
    side = lambda name: sieges.select("siege_id", "castle_id", F.lit(name).alias("side"), F.explode(f"{name}s").alias("clan_id"), "owner_clan_id")
    both = side("attacker").unionByName(side("defender"))
    return both.withColumn("holds", F.col("clan_id") == F.col("owner_clan_id")).drop("owner_clan_id")


def purchase_lines(purchases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, breaches): items and services of purchases with the payments of each, a row per line with its place;
    events with neither break a rule and are kept apart."""
    line = lambda c: F.transform(F.coalesce(c, F.array().cast(purchases.schema[c].dataType)), lambda x: F.struct(F.lit(c).alias("kind"), x["id"].alias("id"), x["count"].alias("count"), x["payments"].alias("payments")))
    both = purchases.select("event_id", "char_id", F.concat(line("items"), line("services")).alias("lines"))
    lines = both.select("event_id", "char_id", F.posexplode("lines").alias("line_no", "l")).select("event_id", "char_id", "line_no", "l.*")
    return lines, both.where(F.size("lines") == 0).select("event_id", "char_id")


def purchase_payments(lines: DataFrame) -> DataFrame:
    """A row per payment (currency_id, amount) of :func:`purchase_lines`' lines; a line without payments was free and
    keeps one row of nulls."""
    kept = [c for c in lines.columns if c != "payments"]
    return lines.select(*kept, F.explode_outer("payments").alias("p")).select(*kept, F.col("p.currency_id").alias("currency_id"), F.col("p.amount").alias("amount"))


def deaths_by_killer(deaths: DataFrame) -> DataFrame:
    """(killer_type, farm_mode, n); unknown types count under ``other``."""
    kind = F.when(F.col("killer_type").isin("player", "monster", "boss"), F.col("killer_type")).otherwise("other")
    return deaths.groupBy(kind.alias("killer_type"), F.coalesce("farm_mode", F.lit(False)).alias("farm_mode")).agg(F.count(F.lit(1)).alias("n"))


def milestones(log: DataFrame, key: str = "char_id", time: str = "ts") -> DataFrame:
    """The first time of each log type and character, unknown types included."""
    return log.groupBy(key, "log_type").agg(F.min(time).alias("first_at"), F.count(F.lit(1)).alias("n"))


def auth_failures(attempts: DataFrame, by: str, width: str, time: str = "ts", failed: Column | None = None) -> DataFrame:
    """(window_start, by, failures) of failed attempts in tumbling windows."""
    failed = failed if failed is not None else F.col("outcome") != "success"
    return attempts.where(failed).groupBy(F.window(time, width).start.alias("window_start"), by).agg(F.count(F.lit(1)).alias("failures"))


def chat_messages(chats: DataFrame) -> DataFrame:
    """Messages with the sender null where the platform spoke (id 0)."""
    return chats.withColumn("char_id", F.nullif("char_id", F.lit(0)))


def chat_lists(chats: DataFrame, column: str) -> DataFrame:
    """A row per entry of an additive list; hosts that don't send it (null) add none."""
    return chats.select("event_id", F.explode(column).alias("entry"))


def match_points(results: DataFrame) -> DataFrame:
    """(cycle, class_id, char_id, delta, wins, losses)."""
    return results.groupBy("cycle", "class_id", "char_id").agg(F.sum(F.col("points_after") - F.col("points_before")).alias("delta"), *[F.count_if(F.col("outcome") == o).alias(n) for o, n in (("win", "wins"), ("loss", "losses"))])


def hero_history(grants: DataFrame) -> DataFrame:
    """(cycle, class_id, heroes): ids of the granted per cycle and class, sorted."""
    return grants.groupBy("cycle", "class_id").agg(F.array_sort(F.collect_set("char_id")).alias("heroes"))


def raid_drops(kills: DataFrame) -> DataFrame:
    """(npc_id, item_id, kills, items) of dropped items per boss."""
    each = kills.select("kill_id", "npc_id", F.inline("drops"))
    return each.groupBy("npc_id", "item_id").agg(F.count_distinct("kill_id").alias("kills"), F.sum("count").alias("items"))
