"""Event families over the given tables: ``events`` rows stand for presence, stores, matches, mail and more by their
type; orders and their lines stand for kills, trades and purchases."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import ids, values
from tidemark.operators import apply, counters, events, lookups, stats
from tidemark.plans.book import dealt, query, table
from tidemark.scratch import cut
from tidemark.sources import families, records

NEWEST = "SELECT user_id, max(event_id) AS e FROM events GROUP BY 1"


def lines_of(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


@query("SELECT event_id, user_id, event_type FROM events")
def events_deduplicated(spark, sf_dir):
    """At-least-once delivery: a third of the events comes once, another twice, another three times."""
    e = table(spark, sf_dir, "events")
    again = e.where("event_id % 3 > 0")
    return events.dedup_events(e.unionByName(again).unionByName(again.where("event_id % 3 = 2"))).select("event_id", "user_id", "event_type")


@query("SELECT user_id, event_id, value, event_type FROM events WHERE event_id IN (SELECT e FROM (" + NEWEST + "))")
def latest_per_key(spark, sf_dir):
    return apply.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "value", "event_type"), ["user_id"], "event_id")


@query("""WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'), x AS (SELECT user_id, ts, event_type FROM events WHERE event_type = 'error')
SELECT s.event_id AS session_id, s.user_id AS char_id, s.ts AS started, (SELECT min(x.ts) FROM x WHERE x.user_id = s.user_id AND x.ts > s.ts) AS ended FROM s""")
def presence_sessions(spark, sf_dir):
    """Signups start a session; the user's next error ends it."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").where("event_type IN ('signup', 'error')")
    after = Window.partitionBy("user_id").orderBy("ts").rowsBetween(1, Window.unboundedFollowing)
    e = e.withColumn("end_ts", F.first(F.when(F.col("event_type") == "error", F.col("ts")), ignorenulls=True).over(after))
    start = e.where("event_type = 'signup'").select(F.col("event_id").alias("session_id"), F.col("user_id").alias("char_id"), F.lit(True).alias("online"), "ts", F.lit(False).alias("resumed"), F.lit(None).cast("string").alias("logout_reason"), "end_ts")
    end = start.where("end_ts IS NOT NULL").select("session_id", "char_id", F.lit(False).alias("online"), F.col("end_ts").alias("ts"), "resumed", F.lit("exit").alias("logout_reason"), "end_ts")
    return events.presence_sessions(start.unionByName(end).drop("end_ts")).select("session_id", "char_id", "started", "ended")


@query("""WITH m AS (SELECT event_id // 2 AS match_id, user_id AS char_id, event_id, CASE WHEN value > 50 THEN 'win' ELSE 'loss' END AS outcome FROM events WHERE event_id // 2 <= (SELECT (max(event_id) - 1) // 2 FROM events))
SELECT a.match_id, a.char_id, b.char_id AS opponent_char_id, a.outcome, b.outcome AS other_outcome, a.outcome <> b.outcome AS consistent FROM m a JOIN m b ON a.match_id = b.match_id AND a.event_id <> b.event_id WHERE a.char_id <> b.char_id""")
def match_pairs(spark, sf_dir):
    """Two neighbouring events are the two sides of a match; they often contradict each other."""
    e = table(spark, sf_dir, "events")
    m = e.select(F.floor(F.col("event_id") / 2).alias("match_id"), F.col("user_id").alias("char_id"), "event_id", F.when(F.col("value") > 50, "win").otherwise("loss").alias("outcome"))
    sides = m.groupBy("match_id").agg(F.min("event_id").alias("lo"), F.min_by("char_id", "event_id").alias("a"), F.max_by("char_id", "event_id").alias("b"), F.count(F.lit(1)).alias("n")).where("n = 2 AND a <> b")
    both = m.join(sides, "match_id").withColumn("opponent_char_id", F.when(F.col("event_id") == F.col("lo"), F.col("b")).otherwise(F.col("a")))
    return events.match_pairs(both.select("match_id", "char_id", "opponent_char_id", "outcome"))


@query("""WITH RECURSIVE up(item_id, origin, steps) AS (SELECT p_partkey, p_partkey // 2, 1 FROM part WHERE p_partkey > 0 UNION ALL SELECT item_id, origin // 2, steps + 1 FROM up WHERE origin > 0)
SELECT item_id, origin AS origin_id, steps FROM up WHERE origin = 0""")
def item_lineage(spark, sf_dir):
    """Each part came from the one of half its number."""
    moves = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("new_item_id"), F.floor(F.col("p_partkey") / 2).alias("item_id"))
    return events.item_lineage(moves)[0]


@query("SELECT p_partkey AS item_id FROM part WHERE p_partkey // 100 IN (SELECT p_partkey // 100 FROM part GROUP BY 1 HAVING count(*) = 100)")
def item_circles(spark, sf_dir):
    """Each hundred parts move round in a circle, so none has an origin; a hundred with gaps is a chain and has."""
    k = F.col("p_partkey")
    moves = table(spark, sf_dir, "part").select(k.alias("item_id"), (k - k % 100 + (k + 1) % 100).alias("new_item_id"))
    return events.item_lineage(moves)[1]


@query("SELECT event_id, user_id, c_name AS name, c_mktsegment AS segment FROM events LEFT JOIN customer ON user_id = c_custkey")
def enriched_events(spark, sf_dir):
    return events.enrich(table(spark, sf_dir, "events").select("event_id", "user_id"), table(spark, sf_dir, "customer"), "user_id", "c_custkey", {"c_name": "name", "c_mktsegment": "segment"})


@query("""SELECT event_id, CASE WHEN event_type = 'purchase' THEN c_name WHEN event_type IN ('click', 'view') THEN p_name END AS killer_name
FROM events LEFT JOIN customer ON c_custkey = user_id LEFT JOIN part ON p_partkey = user_id""")
def killers_resolved(spark, sf_dir):
    kind = F.when(F.col("event_type") == "purchase", "player").when(F.col("event_type") == "click", "monster").when(F.col("event_type") == "view", "boss")
    deaths = table(spark, sf_dir, "events").select("event_id", kind.alias("killer_type"), F.col("user_id").alias("killer_id"))
    chars = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("char_id"), F.col("c_name").alias("name"))
    npcs = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("npc_id"), F.col("p_name").alias("name"))
    return events.resolve_killers(deaths, chars, npcs).select("event_id", "killer_name")


@query("SELECT o_orderkey AS char_id, count(*) AS effects, count(p_name) AS known FROM orders JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey AND p_size = l_linenumber GROUP BY 1")
def effect_details(spark, sf_dir):
    """Order lines as effects, looked up by (part, size) in the catalogue."""
    line = F.struct(F.col("l_partkey").alias("skill_id"), F.col("l_linenumber").alias("skill_level"), F.lit(0).alias("enchant"))
    chars = lines_of(spark, sf_dir).groupBy(F.col("l_orderkey").alias("char_id")).agg(F.collect_list(line).alias("effects"))
    chars = chars.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("char_id")), "char_id", "left_semi")
    skills = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("skill_id"), F.col("p_size").alias("skill_level"), F.lit(0).alias("enchant"), F.col("p_name").alias("name"))
    return events.effect_details(chars, skills).groupBy("char_id").agg(F.count(F.lit(1)).alias("effects"), F.count("name").alias("known"))


@query("SELECT c_custkey AS custkey, CASE WHEN c_acctbal < 0 THEN 1 WHEN c_acctbal <= 5000 THEN 2 WHEN c_acctbal >= 6000 THEN 3 END AS value FROM customer")
def bracket_lookup(spark, sf_dir):
    steps = spark.createDataFrame([(-1e9, -0.005, 1), (0.0, 5000.0, 2), (6000.0, None, 3)], "from double, to double, value int")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("balance"))
    return lookups.bracket_lookup(rows, steps, "balance").select("custkey", "value")


RATED = "SELECT c_custkey AS char_id, c_mktsegment AS rating_type, CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey % 3 END AS season, CAST(floor(c_acctbal / 100) AS BIGINT) AS points FROM customer"


def ratings_of(spark, sf_dir):
    nation = F.col("c_nationkey") % 3
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("char_id"), F.col("c_mktsegment").alias("rating_type"), F.when(nation > 0, nation).alias("season"), F.floor(F.col("c_acctbal") / 100).alias("points"))


@query(f"SELECT *, rank() OVER (PARTITION BY rating_type, season ORDER BY points DESC) AS rank, row_number() OVER (PARTITION BY rating_type, season ORDER BY points DESC, char_id) AS position FROM ({RATED})")
def rating_rank(spark, sf_dir):
    return events.rating_rank(ratings_of(spark, sf_dir)).withColumn("rank", F.col("rank").cast("bigint")).withColumn("position", F.col("position").cast("bigint"))


@query(f"SELECT char_id, rating_type, season, points FROM (SELECT *, row_number() OVER (PARTITION BY rating_type, season ORDER BY points DESC, char_id) AS p FROM ({RATED})) WHERE p <= 10")
def leaderboard_top10(spark, sf_dir):
    return events.leaderboard(ratings_of(spark, sf_dir), 10).select("char_id", "rating_type", "season", "points")


@query("""WITH h AS (SELECT date_trunc('hour', ts) AS ts, count(*) AS t, count(DISTINCT user_id) AS u, count(*) FILTER (event_type = 'view') AS v FROM events GROUP BY 1),
b AS (SELECT ts, 'TOTAL' AS bucket, t AS n FROM h UNION ALL SELECT ts, 'UNIQUE', u FROM h UNION ALL SELECT ts, 'VIEW', v FROM h)
SELECT date_trunc('day', ts) AS window_start, bucket, avg(n) AS mean, max(n) AS most FROM b GROUP BY 1, 2""")
def online_series(spark, sf_dir):
    hours = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("t"), F.count_distinct("user_id").alias("u"), F.count_if(F.col("event_type") == "view").alias("v"))
    counts = F.create_map(F.lit("TOTAL"), F.col("t"), F.lit("UNIQUE"), F.col("u"), F.lit("VIEW"), F.col("v"))
    found = events.online_series(hours.select("ts", counts.alias("counts")), "1 day")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH d AS (SELECT l_orderkey AS kill_id, CASE WHEN l_suppkey % 2 = 0 THEN 'party:' || (l_suppkey % 4) ELSE 'char:' || l_partkey END AS owner, CAST(sum(l_quantity) AS BIGINT) AS damage FROM lineitem GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY kill_id ORDER BY damage DESC, owner) AS rank FROM d""")
def raid_contribution(spark, sf_dir):
    """Orders as kills; lines of even suppliers fight in parties."""
    fighter = F.struct(F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey") % 4).alias("party_id"), F.col("l_partkey").alias("char_id"), F.col("l_quantity").cast("bigint").alias("damage"))
    kills = dealt(lines_of(spark, sf_dir), "l_orderkey").groupBy(F.col("l_orderkey").alias("kill_id")).agg(F.collect_list(fighter).alias("participants"))
    return events.raid_contribution(kills).withColumn("rank", F.col("rank").cast("bigint"))


LINES = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@query(f"SELECT l_partkey AS item_template_id, CASE WHEN l_linenumber % 2 = 0 THEN 57 ELSE 4037 END AS currency_id, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS items, CAST(sum({LINES} * CAST(l_quantity AS BIGINT)) AS BIGINT) AS revenue FROM lineitem GROUP BY 1, 2")
def sale_totals(spark, sf_dir):
    line = F.struct(F.col("l_partkey").alias("item_template_id"), F.when(F.col("l_linenumber") % 2 == 0, 57).otherwise(4037).alias("currency_id"), F.col("l_quantity").cast("bigint").alias("count"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("unit_price"))
    return events.sale_totals(dealt(lines_of(spark, sf_dir), "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines")))


BOOK_SQL = f"""book AS (SELECT e.user_id, e.event_id, e.value, e.ts FROM events e JOIN ({NEWEST}) n ON e.event_id = n.e WHERE event_type <> 'error' AND e.ts > (SELECT max(ts) FROM events) - INTERVAL 2 DAY)"""


def store_book(spark, sf_dir):
    """Each user's last event is its store: errors close it, and two days of silence do."""
    e = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    line = F.struct((F.col("user_id") % 10).alias("item_template_id"), (F.col("event_id") % 2).alias("currency_id"), F.col("user_id").alias("item_id"), F.lit(1).cast("bigint").alias("count"), cents.alias("unit_price"), F.lit(None).cast("int").alias("enchant_level"))
    store = F.when(F.col("event_type") != "error", F.struct(F.when(F.col("user_id") % 3 == 0, "BUY").otherwise("SELL").alias("side"), F.array(line).alias("lines")))
    now = e.agg(F.max("ts")).first()[0]
    return events.private_store_book(e.select(F.col("user_id").alias("char_id"), "event_id", "ts", store.alias("store")), F.lit(now).cast("timestamp_ntz"), 2 * 86400)


@query(f"WITH {BOOK_SQL} SELECT user_id AS char_id, event_id FROM book")
def private_store_book(spark, sf_dir):
    return store_book(spark, sf_dir).select("char_id", "event_id")


@query(
    f"""WITH {BOOK_SQL}, l AS (SELECT user_id AS trader_id, CASE WHEN user_id % 3 = 0 THEN 'BUY' ELSE 'SELL' END AS side, user_id % 10 AS item_template_id, event_id % 2 AS currency_id, CAST(round(value * 100) AS BIGINT) AS unit_price FROM book)
SELECT *, row_number() OVER (g ORDER BY unit_price, trader_id) AS place, CASE WHEN side = 'BUY' THEN max(unit_price) OVER g ELSE min(unit_price) OVER g END AS best FROM l WINDOW g AS (PARTITION BY item_template_id, side, currency_id)"""
)
def order_book(spark, sf_dir):
    found = events.order_book(store_book(spark, sf_dir))
    return found.select("trader_id", "side", "item_template_id", "currency_id", "unit_price", F.col("place").cast("bigint").alias("place"), "best")


@query("""SELECT user_id AS mail_id, min(ts) FILTER (event_type = 'signup') AS sent_at, min(ts) FILTER (event_type = 'view') AS read_at, min(ts) FILTER (event_type = 'purchase') AS accepted_at,
min(ts) FILTER (event_type = 'error') AS cancelled_at, min(ts) FILTER (event_type = 'click') AS returned_at FROM events GROUP BY 1""")
def mail_lifecycle(spark, sf_dir):
    kinds = {"signup": "sent", "view": "read", "purchase": "accepted", "error": "cancelled", "click": "returned"}
    return events.mail_lifecycle(table(spark, sf_dir, "events").select(F.col("user_id").alias("mail_id"), F.col("event_type").alias("msg_type"), "ts"), kinds=kinds)


@query("""SELECT o_orderkey AS trade_id, CASE WHEN l_linenumber % 2 = 0 THEN o_custkey ELSE l_suppkey END AS from_char_id, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE o_custkey END AS to_char_id, l_partkey AS item_id
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def trade_edges(spark, sf_dir):
    """A line is a trade of customer and supplier; even lines go one way, odd ones the other."""
    each = lines_of(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    items = lambda even: F.when((F.col("l_linenumber") % 2 == 0) == F.lit(even), F.array(F.struct(F.col("l_partkey").alias("item_id")))).otherwise(F.array().cast("array<struct<item_id: bigint>>"))
    trades = each.select(F.col("o_orderkey").alias("trade_id"), F.col("o_custkey").alias("first_char_id"), F.col("l_suppkey").alias("second_char_id"), items(True).alias("first_items"), items(False).alias("second_items"))
    return events.trade_edges(trades)


@query("SELECT o_orderkey AS siege_id, side, clan_id, clan_id = o_custkey % 7 AS holds FROM (SELECT o_orderkey, o_custkey, 'attacker' AS side, unnest([o_custkey % 7, o_custkey % 5]) AS clan_id FROM orders UNION ALL SELECT o_orderkey, o_custkey, 'defender', unnest([o_custkey % 3]) FROM orders)")
def siege_results(spark, sf_dir):
    k = F.col("o_custkey")
    sieges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("siege_id"), F.lit(1).alias("castle_id"), F.array(k % 7, k % 5).alias("attackers"), F.array(k % 3).alias("defenders"), (k % 7).alias("owner_clan_id"))
    return events.siege_results(sieges).select("siege_id", "side", "clan_id", "holds")


@query("SELECT l_orderkey AS event_id, CASE WHEN l_linenumber % 2 = 0 THEN 'items' ELSE 'services' END AS kind, l_partkey AS id, CAST(l_quantity AS BIGINT) AS count FROM lineitem WHERE l_quantity > 10")
def purchase_lines(spark, sf_dir):
    """Lines of more than ten pieces are bought; the others are left out of the events."""
    lines, _ = events.purchase_lines(purchases(spark, sf_dir))
    return lines.select("event_id", "kind", "id", "count")


@query("SELECT l_orderkey AS event_id, l_partkey AS id, p.currency_id, p.amount FROM lineitem, LATERAL (SELECT 57 AS currency_id, CAST(l_quantity AS BIGINT) AS amount WHERE l_suppkey % 3 > 0 UNION ALL SELECT 4037, 1 WHERE l_suppkey % 3 > 1 UNION ALL SELECT NULL, NULL WHERE l_suppkey % 3 = 0) p WHERE l_quantity > 10")
def purchase_payments(spark, sf_dir):
    """None, one or two payments a line."""
    return events.purchase_payments(events.purchase_lines(purchases(spark, sf_dir))[0]).select("event_id", "id", "currency_id", "amount")


@query("SELECT l_orderkey AS event_id FROM lineitem GROUP BY 1 HAVING max(l_quantity) <= 10")
def purchase_breaches(spark, sf_dir):
    """Purchases of nothing."""
    return events.purchase_lines(purchases(spark, sf_dir))[1].select("event_id")


def purchases(spark, sf_dir):
    pay = lambda currency, amount: F.struct(F.lit(currency).alias("currency_id"), amount.cast("bigint").alias("amount"))
    third = F.col("l_suppkey") % 3
    paid = F.when(third == 0, F.array().cast("array<struct<currency_id: int, amount: bigint>>")).when(third == 1, F.array(pay(57, F.col("l_quantity")))).otherwise(F.array(pay(57, F.col("l_quantity")), pay(4037, F.lit(1))))
    line = F.struct(F.col("l_partkey").alias("id"), F.col("l_quantity").cast("bigint").alias("count"), paid.alias("payments"))
    big, even = F.col("l_quantity") > 10, F.col("l_linenumber") % 2 == 0
    return lines_of(spark, sf_dir).groupBy(F.col("l_orderkey").alias("event_id")).agg(F.lit(1).alias("char_id"), F.collect_list(F.when(big & even, line)).alias("items"), F.collect_list(F.when(big & ~even, line)).alias("services"))


@query("SELECT CASE event_type WHEN 'purchase' THEN 'player' WHEN 'click' THEN 'monster' ELSE 'other' END AS killer_type, coalesce(CASE WHEN user_id % 3 > 0 THEN user_id % 3 = 1 END, false) AS farm_mode, count(*) AS n FROM events GROUP BY 1, 2")
def deaths_by_killer(spark, sf_dir):
    kind = F.when(F.col("event_type") == "purchase", "player").when(F.col("event_type") == "click", "monster").otherwise(F.col("event_type"))
    farm = F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 3 == 1)
    return events.deaths_by_killer(table(spark, sf_dir, "events").select(kind.alias("killer_type"), farm.alias("farm_mode")))


@query("SELECT user_id AS char_id, event_type AS log_type, min(ts) AS first_at, count(*) AS n FROM events GROUP BY 1, 2")
def milestones(spark, sf_dir):
    return events.milestones(table(spark, sf_dir, "events").select(F.col("user_id").alias("char_id"), F.col("event_type").alias("log_type"), "ts"))


@query("SELECT date_trunc('hour', ts) AS window_start, user_id, count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY 1, 2")
def auth_failures(spark, sf_dir):
    found = events.auth_failures(table(spark, sf_dir, "events"), "user_id", "1 hour", failed=F.col("event_type") == "error")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT conv_id AS event_id, CASE WHEN turn % 3 > 0 THEN turn % 3 END AS char_id, length(text) AS n FROM conversations")
def chat_messages(spark, sf_dir):
    """Conversation turns as chat; every third is spoken by the platform."""
    chats = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("event_id"), (F.col("turn") % 3).alias("char_id"), F.char_length("text").cast("bigint").alias("n"))
    return events.chat_messages(chats)


@query("SELECT conv_id AS event_id, unnest(string_split(role, 's')) AS entry FROM conversations WHERE turn % 2 = 0")
def chat_lists(spark, sf_dir):
    """Entries of a list that hosts of odd turns don't send."""
    chats = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("event_id"), F.when(F.col("turn") % 2 == 0, F.split("role", "s", -1)).alias("parts"))
    return events.chat_lists(chats, "parts")


@query("SELECT dayofmonth(ts) AS cycle, user_id % 5 AS class_id, user_id AS char_id, CAST(sum(event_id % 11 - event_id % 7) AS BIGINT) AS delta, count(*) FILTER (value > 50) AS wins, count(*) FILTER (value <= 50) AS losses FROM events GROUP BY 1, 2, 3")
def match_points(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    rows = e.select(F.dayofmonth("ts").cast("bigint").alias("cycle"), (F.col("user_id") % 5).alias("class_id"), F.col("user_id").alias("char_id"), (F.col("event_id") % 11).alias("points_after"), (F.col("event_id") % 7).alias("points_before"), F.when(F.col("value") > 50, "win").otherwise("loss").alias("outcome"))
    return events.match_points(rows)


@query("SELECT dayofmonth(ts) AS cycle, user_id % 5 AS class_id, string_agg(DISTINCT user_id, ',' ORDER BY user_id) AS heroes FROM events GROUP BY 1, 2")
def hero_history(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    found = events.hero_history(e.select(F.dayofmonth("ts").cast("bigint").alias("cycle"), (F.col("user_id") % 5).alias("class_id"), F.col("user_id").alias("char_id")))
    return found.withColumn("heroes", F.array_join(F.transform("heroes", lambda x: x.cast("string")), ","))


@query("SELECT l_suppkey AS npc_id, l_partkey AS item_id, count(DISTINCT l_orderkey) AS kills, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS items FROM lineitem GROUP BY 1, 2")
def raid_drops(spark, sf_dir):
    drop = F.struct(F.col("l_partkey").alias("item_id"), F.col("l_quantity").cast("bigint").alias("count"))
    kills = dealt(lines_of(spark, sf_dir), "l_orderkey", "l_suppkey").groupBy(F.col("l_orderkey").alias("kill_id"), F.col("l_suppkey").alias("npc_id")).agg(F.collect_list(drop).alias("drops"))
    return events.raid_drops(kills)


@query("SELECT user_id AS server_id, max_by(event_type, event_id) AS last_type, CASE max_by(event_type, event_id) WHEN 'signup' THEN 'online' WHEN 'error' THEN 'stopping' END AS status FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1")
def server_status(spark, sf_dir):
    kind = F.when(F.col("event_type") == "signup", "ServerStartedEvent").otherwise("ServerStoppingEvent")
    e = table(spark, sf_dir, "events").where("event_type IN ('signup', 'error')").select(F.col("user_id").alias("server_id"), kind.alias("msg_type"), F.col("event_id").alias("event_time"), F.col("event_type").alias("last_type"))
    return apply.server_status(e).select("server_id", "last_type", "status")


@query("WITH s AS (SELECT *, user_id % 4 AS server FROM events WHERE event_type IN ('signup', 'error')), k AS (SELECT server, max(event_id) AS t FROM s WHERE event_id < (SELECT count(*) / 2 FROM events) GROUP BY 1) SELECT server AS server_id, CASE max_by(event_type, event_id) WHEN 'signup' THEN 'online' ELSE 'stopping' END AS status FROM s JOIN k USING (server) WHERE event_id > t GROUP BY 1")
def server_status_replayed(spark, sf_dir):
    """All events are replayed to a table that knows the first half: only later ones count."""
    e = table(spark, sf_dir, "events")
    half = e.count() / 2
    kind = F.when(F.col("event_type") == "signup", "ServerStartedEvent").otherwise("ServerStoppingEvent")
    e = e.where("event_type IN ('signup', 'error')").select((F.col("user_id") % 4).alias("server_id"), kind.alias("msg_type"), F.col("event_id").alias("event_time"))
    return apply.server_status(e, e.where(F.col("event_time") < half)).select("server_id", "status")


@query("SELECT event_id FROM (SELECT event_id, user_id, ts - to_hours(CAST(event_id % 7 * 24 AS INTEGER)) AS t, max(ts - to_hours(CAST(event_id % 7 * 24 AS INTEGER))) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM events) WHERE m IS NULL OR t > m")
def late_events_dropped(spark, sf_dir):
    """Events up to six days late: one that comes after a newer one of its user is dropped."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("event_id").alias("seq"), (F.unix_micros(F.col("ts").cast("timestamp")) - F.col("event_id") % 7 * 86_400_000_000).alias("t"))
    return apply.drop_older(e, "user_id", "t").select("event_id")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'no source' WHEN event_id % 5 < 3 AND event_type = 'view' THEN 'app session without activity' WHEN event_id % 5 >= 3 AND event_type <> 'view' THEN 'client session with activity'
WHEN event_id % 2 = 0 AND user_id % 3 > 0 THEN 'start with a reason to leave' WHEN event_id % 2 = 1 AND user_id % 3 = 0 THEN 'end without a reason' WHEN value > 50 AND NOT (event_id % 2 = 0 AND event_id % 5 < 3) THEN 'resumed without an app start' END AS reason FROM events WHERE reason IS NOT NULL""")
def presence_breaches(spark, sf_dir):
    """Presence events whose source, activity, reason and resumption contradict each other."""
    k = F.col("event_id")
    source = F.when(k % 5 == 0, F.lit(None)).when(k % 5 < 3, "APP").otherwise("CLIENT")
    e = table(spark, sf_dir, "events").select(k, (k % 2 == 0).alias("online"), source.alias("source"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("activity"), (F.col("value") > 50).alias("resumed"), F.when(F.col("user_id") % 3 > 0, "exit").alias("logout_reason"))
    return events.bad_presence(e).select("event_id", "reason")


@query("SELECT user_id AS char_id, max_by(source, (ts, source)) AS source, max_by(online, (ts, source)) AS online FROM (SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'db' WHEN 'click' THEN 'runtime' ELSE 'presence' END AS source, value > 50 AS online FROM events) GROUP BY 1")
def online_state(spark, sf_dir):
    """Three sources of one truth; the last statement wins."""
    source = F.when(F.col("event_type") == "view", "db").when(F.col("event_type") == "click", "runtime").otherwise("presence")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("char_id"), "ts", source.alias("source"), (F.col("value") > 50).alias("online"))
    return apply.online_state(e).select("char_id", "source", "online")


@query("WITH l AS (SELECT l_returnflag, max(l_orderkey) AS o FROM lineitem GROUP BY 1) SELECT l.l_returnflag AS server, l.o AS snapshot, l_partkey AS boss FROM l JOIN lineitem x ON x.l_returnflag = l.l_returnflag AND x.l_orderkey = l.o")
def snapshot_state(spark, sf_dir):
    """Each order is a full snapshot of its flag's bosses; only the latest one counts."""
    snaps = lines_of(spark, sf_dir).groupBy(F.col("l_returnflag").alias("server"), F.col("l_orderkey").alias("snapshot")).agg(F.collect_list("l_partkey").alias("bosses"))
    return apply.replace_snapshot_state(snaps, "server", "snapshot", "bosses").withColumnRenamed("entry", "boss")


@query(f"SELECT e.user_id AS pk, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS hp, event_type <> 'error' AS has_state FROM events e JOIN ({NEWEST}) n ON e.event_id = n.e")
def runtime_state(spark, sf_dir):
    """Latest runtime row per user; an error is a tombstone."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("pk"), F.when(F.col("event_type") != "error", F.col("value")).alias("hp"), F.col("event_id").alias("ts_ms"))
    return apply.apply_runtime(e, ["hp"]).select("pk", "hp", "has_state")


@query(f"""WITH s AS (SELECT e.user_id, e.event_type <> 'error' AS live, e.event_id % 100 AS elapsed FROM events e JOIN ({NEWEST}) n ON e.event_id = n.e)
SELECT user_id AS char_id, id AS effect, CASE WHEN NOT live AND id = 2 THEN 50 - elapsed ELSE 50 END AS remaining FROM s, range(1, 4) t(id) WHERE live OR id = 1 OR (id = 2 AND elapsed < 50)""")
def effects_state(spark, sf_dir):
    """Three effects each: on a tombstone one is frozen, one ticks and one is dropped."""
    e = apply.latest(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")
    effect = lambda k, mode: F.struct(F.lit(k).cast("bigint").alias("id"), F.lit(mode).alias("offline"), F.lit(50).cast("bigint").alias("remaining_s"))
    state = e.select(F.col("user_id").alias("char_id"), (F.col("event_type") != "error").alias("has_state"), (F.col("event_id") % 100).alias("elapsed_s"), F.array(effect(1, "FROZEN"), effect(2, "TICKING"), effect(3, "DROPPED")).alias("effects"))
    return apply.apply_effects(state).select("char_id", F.inline("effects")).select("char_id", F.col("id").alias("effect"), F.col("remaining_s").alias("remaining"))


@query("WITH b AS (SELECT *, event_id // 1000 AS block FROM events), l AS (SELECT user_id, max(block) AS block FROM b GROUP BY 1) SELECT user_id AS char_id, event_type AS type, count(*) AS used FROM b JOIN l USING (user_id, block) GROUP BY 1, 2")
def usages_state(spark, sf_dir):
    """Complete sets per user and thousand of events; a user's newest set replaces all others."""
    e = table(spark, sf_dir, "events")
    sets = e.groupBy("user_id", F.floor(F.col("event_id") / 1000).alias("block"), "event_type").agg(F.count(F.lit(1)).alias("used"))
    sets = sets.groupBy(F.col("user_id").alias("char_id"), "block").agg(F.collect_list(F.struct(F.col("event_type").alias("type"), "used")).alias("usages"))
    return apply.apply_usages(sets, "char_id", "block")


# Records, commands and metrics.


def records_of(spark, sf_dir):
    """Events as records of a topic, one type header each, keyed by user."""
    e = table(spark, sf_dir, "events")
    return records.encode_envelope(e, F.col("user_id"), F.struct("event_id", "user_id", "value"), F.lit("topic"), F.col("event_type"), F.col("event_id") % 10 == 0)


@query("SELECT event_type AS msg_type, user_id AS pk, CASE WHEN event_id % 10 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events WHERE event_type IN ('view', 'click')")
def records_decoded(spark, sf_dir):
    """Encoded, routed by type and decoded again; every tenth is a tombstone."""
    routed = records.route_by_type(records_of(spark, sf_dir), ["view", "click"])
    decoded, _ = records.decode_envelope(routed, "event_id bigint, user_id bigint, value double")
    return decoded.select("msg_type", ids.key_number(F.col("key")).alias("pk"), F.col("payload.event_id").alias("event_id"), F.col("payload.value").alias("value"))


@query("SELECT event_type AS msg_type, count(*) AS dead FROM events WHERE event_id % 7 = 0 GROUP BY 1")
def records_dead(spark, sf_dir):
    """Every seventh record is cut off, goes to the dead letters and stops nothing."""
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 7 == 0, F.lit('{"event_id": 1')).otherwise(F.to_json(F.struct("event_id")))
    _, dead = records.decode_envelope(e.select("event_type", F.encode(text, "utf-8").alias("value")), "event_id bigint")
    return dead.groupBy(F.col("event_type").alias("msg_type")).agg(F.count(F.lit(1)).alias("dead"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN 't.view' ELSE 't.click' END AS topic FROM events WHERE event_type IN ('view', 'click')")
def topics_resolved(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("entity_name"))
    return records.resolve_topics(e, {"view": "t.view", "click": "t.click"})[0].select("event_id", "topic")


@query("SELECT event_type AS entity_name, count(*) AS dropped FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY 1")
def topics_missing(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("entity_name"))
    return records.resolve_topics(e, {"view": "t.view", "click": "t.click"})[1]


@query("SELECT DISTINCT event_type AS entity_name, CASE WHEN event_type IN ('view', 'click') THEN 't.' || event_type END AS topic, CASE WHEN event_type IN ('view', 'click') THEN 'ACTIVE' ELSE 'DEGRADED' END AS state FROM events")
def topic_states(spark, sf_dir):
    entities = table(spark, sf_dir, "events").select(F.col("event_type").alias("entity_name")).distinct()
    return records.entity_states(entities, {"view": "t.view", "click": "t.click"})


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'DISABLED' WHEN user_id % 3 = 0 OR value > 100 THEN 'DEGRADED' ELSE 'ACTIVE' END AS state FROM events")
def module_states(spark, sf_dir):
    topic = F.when(F.col("user_id") % 3 != 0, "replies")
    state = stats.module_state(F.col("event_type") != "error", topic, F.when(F.col("value") > 100, 1).otherwise(0))
    return table(spark, sf_dir, "events").select("event_id", state.alias("state"))


@query("SELECT DISTINCT event_type AS family FROM events WHERE event_type IN ('error', 'signup')")
def families_disabled(spark, sf_dir):
    families = table(spark, sf_dir, "events").select(F.col("event_type").alias("family")).distinct()
    return stats.disabled_families(families, families.where("family NOT IN ('error', 'signup')"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN printf('%016x', user_id) WHEN 'click' THEN printf('%016x', event_id) WHEN 'purchase' THEN lower(hex('user' || user_id)) END AS key_hex FROM events")
def partition_keys(spark, sf_dir):
    """Views are keyed by character, clicks by mail, purchases by the account's name and the rest by nothing."""
    kind = F.when(F.col("event_type") == "view", "ChatMessageEvent").when(F.col("event_type") == "click", "MailReadEvent").when(F.col("event_type") == "purchase", "AccountAuthAttemptEvent").otherwise("ServerStartedEvent")
    key = ids.partition_key(kind, {"char_id": F.col("user_id"), "mail_id": F.col("event_id"), "account_name": F.concat(F.lit("USER"), F.col("user_id").cast("string"))})
    return table(spark, sf_dir, "events").select("event_id", F.lower(F.hex(key)).alias("key_hex"))


SERVER = "0190a1b2-c3d4-7000-8000-000000000001"


@query("SELECT CASE WHEN event_type = 'view' THEN 'other_server' ELSE 'no_target' END AS reason, count(*) AS skipped FROM events WHERE event_type NOT IN ('click', 'purchase') GROUP BY 1")
def commands_skipped(spark, sf_dir):
    """Clicks and purchases are for this server, views for another, the rest names none or garbage."""
    kind = F.col("event_type")
    target = F.when(kind.isin("click", "purchase"), ids.uuid_bytes(F.lit(SERVER))).when(kind == "view", ids.uuid_bytes(F.lit(SERVER[:-1] + "2"))).when(kind == "error", F.encode(F.lit("x"), "utf-8"))
    rows = table(spark, sf_dir, "events").select(F.array(F.struct(F.lit(records.TARGET_HEADER).alias("key"), target.alias("value"))).alias("headers"))
    return records.for_server(rows, SERVER)[1]


@query("""SELECT count(*) AS consumed, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'purchase') AS handled, count(*) FILTER (event_type = 'click') AS unsupported,
count(*) FILTER (event_type = 'signup') AS validation_failed, count(*) FILTER (event_type = 'error') AS internal_error, count(*) FILTER (value > 20) AS replies_published, count(*) FILTER (value <= 20) AS replies_failed FROM events""")
def command_counters(spark, sf_dir):
    names = dict(zip(("view", "purchase", "click", "signup", "error"), stats.COMMAND_OUTCOMES[:1] + stats.COMMAND_OUTCOMES[1:]))
    book = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
    e = table(spark, sf_dir, "events").select(book[F.col("event_type")].alias("outcome"), F.when(F.col("value") > 20, "published").otherwise("failed").alias("reply"))
    return stats.command_counters(e)


@query("SELECT count(*) FILTER (event_type = 'view') AS other_server, count(*) FILTER (event_type NOT IN ('click', 'purchase', 'view')) AS no_target, count(*) FILTER (event_type IN ('click', 'purchase')) AS kept FROM events")
def commands_observed(spark, sf_dir):
    """Skipped commands are counted while those for this server are written: one read."""
    kind = F.col("event_type")
    target = F.when(kind.isin("click", "purchase"), ids.uuid_bytes(F.lit(SERVER))).when(kind == "view", ids.uuid_bytes(F.lit(SERVER[:-1] + "2"))).when(kind == "error", F.encode(F.lit("x"), "utf-8"))
    rows = table(spark, sf_dir, "events").select("event_id", F.array(F.struct(F.lit(records.TARGET_HEADER).alias("key"), target.alias("value"))).alias("headers"))
    mine, seen = records.for_server_observed(rows, SERVER)
    cut(mine, "commands")
    return counters.count_row(spark, seen.get)


@query("SELECT event_type AS family, count(*) FILTER (value > 30) AS published, count(*) FILTER (value BETWEEN 10 AND 30) AS dropped, count(*) FILTER (value < 10) AS failed, event_type <> 'error' AS enabled FROM events GROUP BY 1, 5 UNION ALL SELECT 'mail', 0, 0, 0, false")
def publish_observed(spark, sf_dir):
    """Outcomes per configured family, counted while the attempts are written."""
    enabled = {"view": True, "click": True, "purchase": True, "signup": True, "error": False, "mail": False}
    outcome = F.when(F.col("value") > 30, "published").when(F.col("value") >= 10, "dropped").otherwise("failed")
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("family"), outcome.alias("outcome"))
    rows, seen = counters.counted(e, counters.publish_flags(list(enabled)))
    cut(rows, "attempts")
    return counters.publish_table(spark, seen.get, enabled)


@query("SELECT c.event_id, r.ts AS reply_ts FROM events c LEFT JOIN events r ON r.event_id = c.event_id + 1 AND r.event_type = 'view' WHERE c.event_type = 'click'")
def command_replies(spark, sf_dir):
    """A view right after a click is its reply."""
    e = table(spark, sf_dir, "events")
    commands = e.where("event_type = 'click'").select("event_id", F.col("event_id").alias("correlation_id"), F.lit("ClickCommand").alias("msg_type"))
    replies = e.where("event_type = 'view'").select((F.col("event_id") - 1).alias("correlation_id"), F.lit("ClickResult").alias("msg_type"), "ts", F.lit("ok").alias("status"))
    return stats.command_replies(commands, replies).select("event_id", "reply_ts")


@query("SELECT event_type AS family, count(*) FILTER (value > 30) AS published, count(*) FILTER (value BETWEEN 10 AND 30) AS dropped, count(*) FILTER (value < 10) AS failed, event_type <> 'error' AS enabled FROM events GROUP BY 1, 5 UNION ALL SELECT 'mail', 0, 0, 0, false")
def publish_counters(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    outcome = F.when(F.col("value") > 30, "published").when(F.col("value") >= 10, "dropped").otherwise("failed")
    families = e.select(F.col("event_type").alias("family")).distinct().withColumn("enabled", F.col("family") != "error")
    families = families.unionByName(spark.range(1).select(F.lit("mail").alias("family"), F.lit(False).alias("enabled")))
    return stats.publish_counters(e.select(F.col("event_type").alias("family"), outcome.alias("outcome")), families)


@query("""WITH c AS (SELECT event_type AS entity, dayofmonth(ts) AS cycle, CASE WHEN count(*) FILTER (value > 120) > 0 THEN 'DEGRADED' ELSE 'HEALTHY' END AS state FROM events GROUP BY 1, 2),
l AS (SELECT entity, max(cycle) AS cycle, coalesce(max(cycle) FILTER (state = 'HEALTHY'), 0) AS h FROM c GROUP BY 1)
SELECT l.entity, l.cycle, c.state, (SELECT count(*) FROM c x WHERE x.entity = l.entity AND x.cycle > l.h) AS consecutive_errors FROM l JOIN c USING (entity, cycle)""")
def entity_stats(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cycles = e.groupBy(F.col("event_type").alias("entity"), F.dayofmonth("ts").cast("bigint").alias("cycle")).agg(F.when(F.count_if(F.col("value") > 120) > 0, "DEGRADED").otherwise("HEALTHY").alias("state"))
    return stats.entity_stats(cycles)


ESCALATED = """r AS (SELECT event_id, user_id, ts, event_type = 'purchase' AS ok, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events),
f AS (SELECT *, row_number() OVER w AS n, ts - min(ts) OVER w >= INTERVAL 15 HOUR AS past FROM r WHERE NOT ok WINDOW w AS (PARTITION BY user_id, run ORDER BY ts, event_id)),
g AS (SELECT *, sum(past::INT) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS late FROM f)"""


@query(f"WITH {ESCALATED} SELECT user_id AS key, ts, CASE WHEN n = 1 THEN 'FIRST' WHEN late = 0 THEN 'REPEAT' WHEN past AND late = 1 THEN 'ESCALATED' ELSE 'SILENT' END AS level FROM g")
def escalations(spark, sf_dir):
    """Everything but purchases fails; the grace is 15 hours."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), "ts", (F.col("event_type") == "purchase").alias("ok"), "event_id")
    return stats.escalate(e, 15 * 3600, seq="event_id").where("NOT ok").select("key", "ts", "level")


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis, printf('%016x', user_id) AS key_hex FROM events")
def event_ids(spark, sf_dir):
    """Ids made for the instants of events give those instants back, through text and bytes."""
    e = table(spark, sf_dir, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    made = e.select("event_id", "user_id", ids.uuid7_at(millis, F.col("event_id")).alias("u"))
    return made.select("event_id", ids.uuid7_millis(ids.uuid_text(ids.uuid_bytes(ids.uuid_or_null(F.concat(F.lit(" "), F.col("u")))))).alias("millis"), F.lower(F.hex(ids.key_bytes(F.col("user_id")))).alias("key_hex"))


KINDS = [(family, kind) for family, types in families.FAMILIES.items() for kind in types]
_NUMBERED = [kind for _, kind in KINDS if kind in families.KEYS and families.KEYS[kind] != "accountName"]


def wire_records(spark, sf_dir):
    """Each event as a record of one of all types in turn, with an id of its instant, its key field, metadata and a field
    that no schema knows."""
    e = table(spark, sf_dir, "events")
    at = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("event_id") % len(KINDS)).cast("int") + 1)
    kind, field = at([k for _, k in KINDS]), at([families.KEYS.get(k, "unknown") for _, k in KINDS])
    uuid = ids.uuid7_at(F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id"))
    value = F.format_string('{"eventId":"%s","%s":%s,"metadata":{"event":"%d"},"later":[1]}', uuid, field, F.when(field == "accountName", F.format_string('"User%d"', "user_id")).otherwise(F.col("user_id").cast("string")), "event_id")
    number = F.when(kind.isin(_NUMBERED), F.col("user_id"))
    header = F.array(F.struct(F.lit(records.TYPE_HEADER).alias("key"), F.encode(kind, "utf-8").alias("value")))
    return e.select(at([f for f, _ in KINDS]).alias("topic"), ids.key_bytes(number).alias("key"), F.encode(value, "utf-8").alias("value"), header.alias("headers"))


def typed(spark, sf_dir, family):
    """(event_id, millis, msg_type, key_number, field): a family's tables, with the key field as the payload has it."""
    rows, out = wire_records(spark, sf_dir).where(F.col("topic") == family), None
    for kind, one in families.family_tables(rows, family)[0].items():
        field = F.col(f"payload.{families.KEYS[kind]}").cast("string") if kind in families.KEYS else F.lit(None).cast("string")
        noted = F.col("payload.metadata.event").cast("bigint") if "metadata" in families.FAMILIES[family][kind] else F.lit(None).cast("bigint")
        one = one.select(F.unix_millis("event_time").alias("millis"), "msg_type", "key_number", field.alias("field"), noted.alias("noted"))
        out = one if out is None else out.unionByName(one)
    return out


def _family_sql(family):
    rows = []
    for kind in families.FAMILIES[family]:
        key, noted = families.KEYS.get(kind), "event_id" if "metadata" in families.FAMILIES[family][kind] else "CAST(NULL AS BIGINT)"
        field = "CAST(NULL AS VARCHAR)" if key is None else "'User' || user_id" if key == "accountName" else "CAST(user_id AS VARCHAR)"
        number = "user_id" if kind in _NUMBERED else "CAST(NULL AS BIGINT)"
        rows.append(f"SELECT epoch_us(ts) // 1000 AS millis, '{kind}' AS msg_type, {number} AS key_number, {field} AS field, {noted} AS noted FROM events WHERE event_id % {len(KINDS)} = {KINDS.index((family, kind))}")
    return " UNION ALL ".join(rows)


def _family_query(family):
    def run(spark, sf_dir):
        return typed(spark, sf_dir, family)

    run.__name__ = f"family_{family}"
    run.__doc__ = f"The typed tables of the family ``{family}``."
    return query(_family_sql(family))(run)


for _family in families.FAMILIES:
    _family_query(_family)


@query("SELECT event_type, count(*) AS n, count(*) FILTER (event_id % 10 = 0) AS tombstones, CAST(sum(user_id) FILTER (event_id % 10 <> 0) AS BIGINT) AS users FROM events GROUP BY 1")
def typed_event_tables(spark, sf_dir):
    """A topic of five types with schemas of one's own; every tenth record is a tombstone."""
    found = events.typed_events(records_of(spark, sf_dir), dict.fromkeys(("view", "click", "purchase", "signup", "error"), "event_id bigint, user_id bigint"))
    out = None
    for kind, df in found.items():
        one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("payload").isNull()).alias("tombstones"), F.sum("payload.user_id").alias("users")).select(F.lit(kind).alias("event_type"), "n", "tombstones", "users")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'dead' ELSE 'alive' END AS bucket FROM orders")
def status_buckets(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "dead").when(F.col("o_orderstatus") == "O", "in_combat").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", values.status_bucket(status).alias("bucket"))
