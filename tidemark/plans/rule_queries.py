"""Scalar rules, hashes, nested catalogues and ledgers over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import hashing, ids, values
from tidemark.operators import catalogue, ledger
from tidemark.plans.book import query, table
from tidemark.sources import entities

MD5 = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT)"


@query("SELECT c_custkey, " + MD5.format("concat_ws(',', c_custkey, c_name, c_mktsegment)") + " AS row_hash FROM customer")
def row_hashes(spark, sf_dir):
    """The compatible row hash, in the variant that both engines have."""
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.row_hash(["c_custkey", "c_name", "c_mktsegment"], "md5").alias("row_hash"))


@query(
    "WITH c AS (SELECT l_orderkey, bit_xor(" + MD5.format("concat_ws(',', l_partkey, l_suppkey, l_linenumber)") + ") AS h FROM lineitem GROUP BY 1) "
    "SELECT o_orderkey AS pk, xor(" + MD5.format("concat_ws(',', o_orderkey, o_custkey)") + ", coalesce(h, 0)) AS row_hash FROM orders LEFT JOIN c ON l_orderkey = o_orderkey"
)
def entity_hashes_compatible(spark, sf_dir):
    """Primary hash and the XOR of the children's, folded."""
    from tidemark.operators.capture import ChildSpec, EntitySpec, entity_hashes

    lines = ChildSpec("lines", table(spark, sf_dir, "lineitem"), "l_orderkey", ("l_partkey", "l_suppkey", "l_linenumber"))
    return entity_hashes(EntitySpec("order", table(spark, sf_dir, "orders"), "o_orderkey", ("o_orderkey", "o_custkey"), (), (lines,)), exact=False, algo="md5")


#: The CRC-32 of a string, bit by bit.
CRC_SQL = """WITH s AS (SELECT c_custkey, encode(concat_ws(',', c_custkey, c_name, c_mktsegment)) AS t FROM customer),
d AS (SELECT c_custkey, flatten(list_transform(range(0, octet_length(t)), lambda i: [CAST('0x' || hex(t)[2 * i + 1 : 2 * i + 2] AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM s)
SELECT c_custkey, xor(list_reduce(list_prepend(4294967295, steps), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS row_hash FROM d"""


@query(CRC_SQL)
def row_hashes_crc32(spark, sf_dir):
    """The compatible row hash itself."""
    return table(spark, sf_dir, "customer").select("c_custkey", hashing.row_hash(["c_custkey", "c_name", "c_mktsegment"]).alias("row_hash"))


@query("SELECT c_custkey, true AS differs FROM customer")
def hashes_perturbed(spark, sf_dir):
    """A forced row's hash differs from its own in one bit."""
    h = hashing.row_hash(["c_custkey", "c_name"])
    return table(spark, sf_dir, "customer").select("c_custkey", (F.bit_count(hashing.perturb(h).bitwiseXOR(h)) == 1).alias("differs"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 2 = 0 THEN 'CLASS_' || c_nationkey END, CAST(c_nationkey AS VARCHAR)) AS class FROM customer")
def canonical_classes(spark, sf_dir):
    clazz = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("CLASS_"), F.col("c_nationkey").cast("string")))
    return table(spark, sf_dir, "customer").select("c_custkey", values.prefer_canonical_class(clazz, F.col("c_nationkey")).alias("class"))


FNV_SQL = """WITH p AS (SELECT DISTINCT user_id, event_type FROM events),
d AS (SELECT user_id, event_type, list_concat(list_transform(range(0, 8), lambda i: (user_id >> (8 * i)) & 255), flatten(list_transform(range(1, length(event_type) + 1), lambda i: [ascii(event_type[i]), 0]))) AS bytes FROM p),
h AS (SELECT user_id, event_type, list_reduce(list_prepend(14695981039346656037::HUGEINT, list_transform(bytes, lambda b: b::HUGEINT)), lambda h, b: (xor(h, b) * 435 + ((xor(h, b) % 16777216) << 40)) % 18446744073709551616::HUGEINT) AS u FROM d)
SELECT event_id, CAST(CASE WHEN u >= 9223372036854775808::HUGEINT THEN u - 18446744073709551616::HUGEINT ELSE u END AS BIGINT) AS fnv FROM events JOIN h USING (user_id, event_type)"""


@query(FNV_SQL)
def fnv_hashes(spark, sf_dir):
    """FNV-1a of user and type. In SQL, a product with the prime is 435 times the number and its low 24 bits 40 up."""
    return hashing.fnv1a64(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"]).select("event_id", "fnv")


@query("""WITH o AS (SELECT l_orderkey // 4 AS book, l_orderkey % 4 AS side, list_sort(list((l_partkey % 3, CASE WHEN l_linenumber % 2 = 0 THEN l_linenumber END, l_suppkey % 2))) AS lines FROM lineitem GROUP BY 1, 2)
SELECT a.book, a.side AS a_side, b.side AS b_side, a.lines = b.lines AS same FROM o a JOIN o b ON a.book = b.book AND a.side < b.side""")
def offer_hashes(spark, sf_dir):
    """Lists of few different lines, of neighbouring orders: two have the same hash if and only if they hold the same
    lines, however often and in whatever order; a null enchantment isn't 0."""
    line = F.struct((F.col("l_partkey") % 3).alias("item_id"), F.lit(1).cast("bigint").alias("trader_id"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linenumber")).alias("enchant_level"), F.create_map(F.lit("FIRE"), (F.col("l_suppkey") % 2).cast("int")).alias("attributes"), F.lit(1).cast("bigint").alias("count"), F.lit(100).cast("bigint").alias("unit_price"), F.lit(57).cast("bigint").alias("currency_id"), F.lit(False).alias("packaged"))
    lists = table(spark, sf_dir, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 4).alias("book"), (F.col("l_orderkey") % 4).alias("side")).agg(hashing.offers_hash(F.collect_list(line)).alias("h"))
    other = lists.select(F.col("book").alias("b_book"), F.col("side").alias("b_side"), F.col("h").alias("b_h"))
    both = lists.join(other, (F.col("book") == F.col("b_book")) & (F.col("side") < F.col("b_side")))
    return both.select("book", F.col("side").alias("a_side"), "b_side", (F.col("h") == F.col("b_h")).alias("same"))


@query("SELECT p_partkey FROM part WHERE p_brand <> 'Brand#1' AND NOT starts_with(p_name, 'red') AND p_type = 'SMALL'")
def row_filters(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    keep = values.row_filter(F.col("p_brand"), "NOT_EQ", "Brand#1") & values.row_filter(F.col("p_name"), "NOT_STARTS_WITH", "red") & values.row_filter(F.col("p_type"), "EQ", "SMALL")
    return part.where(keep).select("p_partkey")


@query("""SELECT event_id, nullif(user_id, 0) AS user_id, CASE WHEN event_id % 5 > 0 THEN make_timestamp(event_id % 5 * 1000) END AS at, CASE WHEN event_id % 3 > 0 THEN ' x ' END AS note,
try_cast(substr(props, 7, length(props) - 7) AS INTEGER) AS k, CASE WHEN event_id % 3 = 0 THEN 'fr' ELSE 'en' END AS name FROM events""")
def null_forms(spark, sf_dir):
    """Zeros, sentinels, blanks, open metadata and localised names of events."""
    e, m = table(spark, sf_dir, "events"), F.col("event_id") % 3
    props = F.from_json("props", "map<string,string>")
    names = F.when(m == 0, F.create_map(F.lit("fr"), F.lit("fr"), F.lit("en"), F.lit("en"))).otherwise(F.create_map(F.lit("en"), F.lit("en")))
    at = values.millis_or_null(F.when(F.col("event_id") % 5 == 0, F.lit(-1)).otherwise(F.col("event_id") % 5), -1)
    return e.select("event_id", values.zero_to_null(F.col("user_id")).alias("user_id"), at.cast("timestamp_ntz").alias("at"), values.blank_to_null(F.when(m > 0, " x ").otherwise("  ")).alias("note"), values.metadata(props, "k", "int").alias("k"), values.localized(names, "fr", "en").alias("name"))


@query("SELECT event_id, CASE WHEN user_id % 2 = 0 AND event_id % 60 <= 50 THEN event_id % 60 END AS percent FROM events")
def seller_fees(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    fee = F.create_map(F.lit("feeAdena"), F.when(F.col("user_id") % 2 == 0, "10").otherwise("-1"), F.lit("feePercent"), (F.col("event_id") % 60).cast("string"))
    return e.select("event_id", values.seller_fee(fee)["percent"].cast("bigint").alias("percent"))


@query("""SELECT p_partkey, p_size <= 45 AND NOT (p_size % 5 = 0) AS valid, CASE WHEN p_size % 5 > 0 THEN greatest(p_size % 5 * 10 - p_size, 0) END AS remaining,
CASE WHEN p_size >= 30 THEN 0.25 WHEN p_size >= 10 THEN 0.5 ELSE 1.0 END AS multiplier, CASE WHEN p_size >= 20 THEN 3 WHEN p_size <= 9 THEN 1 END AS scaled, least(p_size, CASE WHEN p_size % 2 = 0 THEN 20 END) AS capped FROM part""")
def usage_rules(spark, sf_dir):
    """Usages, tiers, scaling steps and caps of part sizes."""
    size = F.col("p_size")
    limit = F.when(size % 5 > 0, size % 5 * 10)
    used = F.when(size <= 45, size).otherwise(-1)
    remaining = values.usage_remaining(limit, size)
    told = F.when(limit.isNull(), F.lit(1)).otherwise(remaining)
    tiers = F.array(*[F.struct(F.lit(a).alias("after"), F.lit(m).alias("multiplier")) for a, m in ((30, 0.25), (10, 0.5))])
    steps = F.array(F.struct(F.lit(0).alias("from"), F.lit(9).alias("to"), F.lit(1).alias("value")), F.struct(F.lit(20).alias("from"), F.lit(None).cast("int").alias("to"), F.lit(3).alias("value")))
    return table(spark, sf_dir, "part").select("p_partkey", values.usage_valid(used, limit, told).alias("valid"), remaining.alias("remaining"), values.tier_multiplier(size, tiers).alias("multiplier"), values.scaling_value(size, steps).alias("scaled"), values.capped(size, F.when(size % 2 == 0, F.lit(20))).alias("capped"))


@query("SELECT o_orderkey, o_orderstatus <> 'P' OR o_orderdate > TIMESTAMP '1998-06-01' AS active, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' END AS outcome FROM orders")
def bans_and_outcomes(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ends = F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate"))
    return o.select("o_orderkey", values.ban_active(ends, F.lit("1998-06-01").cast("timestamp_ntz")).alias("active"), values.auth_outcome_class(F.col("o_orderstatus"), ("F",), ("O",)).alias("outcome"))


@query("SELECT l_orderkey, count(*) FILTER (l_shipdate > TIMESTAMP '1999-01-01') AS active FROM lineitem GROUP BY 1")
def active_cooldowns(spark, sf_dir):
    each = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_partkey").alias("instance_id"), F.col("l_shipdate").alias("reentry_at"))).alias("cooldowns"))
    return each.select("l_orderkey", F.size(values.active_cooldowns(F.col("cooldowns"), F.lit("1999-01-01").cast("timestamp_ntz"))).cast("bigint").alias("active"))


@query("SELECT user_id, block, max(n) > 1 AS twice FROM (SELECT user_id, event_id // 200 AS block, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2")
def usage_duplicates(spark, sf_dir):
    """A user's events of each two hundred as a set of usages; those of errors have no key, which is one identity too."""
    key = F.when(F.col("event_type") != "error", F.col("event_type"))
    sets = table(spark, sf_dir, "events").groupBy("user_id", F.floor(F.col("event_id") / 200).alias("block")).agg(F.collect_list(F.struct(F.lit("t").alias("type"), key.alias("key"))).alias("usages"))
    return sets.select("user_id", "block", values.duplicate_usages(F.col("usages")).alias("twice"))


# Nested catalogues: suppliers as monsters, parts of a line as their drops.


def nested(spark, sf_dir, key, entry, name):
    return table(spark, sf_dir, "lineitem").groupBy(F.col(key)).agg(F.array_sort(F.collect_list(entry)).alias(name))


@query("SELECT l_suppkey AS npc_id, l_partkey AS item_id, l_linenumber * 10 AS item_chance, CASE WHEN l_linenumber % 2 = 0 THEN 50 / 100.0 * (l_linenumber * 10) END AS chance FROM lineitem")
def npc_drops(spark, sf_dir):
    item = F.struct(F.col("l_partkey").alias("item_id"), (F.col("l_linenumber") * 10).alias("chance"))
    even = F.col("l_linenumber") % 2 == 0
    groups = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("npc_id"), F.when(even, 50.0).alias("chance")).agg(F.collect_list(item).alias("items"))
    npcs = groups.groupBy("npc_id").agg(F.collect_list(F.struct("chance", "items")).alias("drop_groups"))
    return catalogue.npc_drops(npcs).select("npc_id", "item_id", F.col("item_chance").alias("item_chance"), "chance")


@query("SELECT s_suppkey, l_partkey, count(l_partkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2")
def nested_rows(spark, sf_dir):
    """Nested entries as rows; owners without any keep one of nulls."""
    lists = nested(spark, sf_dir, "l_suppkey", F.struct("l_partkey", "l_orderkey"), "entries")
    owners = table(spark, sf_dir, "supplier").select("s_suppkey").join(lists, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return catalogue.nested_table(owners, "s_suppkey", "entries", keep_empty=True).groupBy("s_suppkey", "l_partkey").agg(F.count("l_partkey").alias("n"))


@query("WITH RECURSIVE t(k, root, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part WHERE p_partkey % 50 = 0 UNION ALL SELECT p_partkey, root, depth + 1 FROM part JOIN t ON p_partkey % 50 <> 0 AND p_partkey - 1 = k) SELECT k AS p_partkey, root, depth FROM t")
def class_tree(spark, sf_dir):
    """Each part's parent is the one before; every fiftieth is a root."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 50 != 0, F.col("p_partkey") - 1).alias("parent"))
    return catalogue.tree_depth(part, "p_partkey", "parent")[0]


@query("SELECT p_partkey, 6 - p_partkey % 7 AS steps FROM part WHERE p_partkey - p_partkey % 7 + 6 <= (SELECT max(p_partkey) FROM part)")
def crystal_chain(spark, sf_dir):
    """Parts upgrade to the next one up to every seventh."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 6, F.col("p_partkey") + 1).alias("following"))
    return catalogue.chain_steps(part, "p_partkey", "following")[0].select("p_partkey", F.col("steps").cast("bigint").alias("steps"))


@query("SELECT p_partkey FROM part WHERE p_partkey - p_partkey % 7 + 6 > (SELECT max(p_partkey) FROM part)")
def crystals_lost(spark, sf_dir):
    """Parts whose chain ends at one that isn't there."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 7 != 6, F.col("p_partkey") + 1).alias("following"))
    return catalogue.chain_steps(part, "p_partkey", "following")[1]


@query("""SELECT a.p_partkey AS crystal_id, o.outcome, o.id AS result_id, b.p_size AS result_level FROM part a, LATERAL (SELECT 'next' AS outcome, a.p_partkey + 1 AS id WHERE a.p_partkey % 7 <> 6 UNION ALL SELECT 'cursed', a.p_partkey + 1000000 WHERE a.p_partkey % 2 = 0 AND a.p_partkey % 7 <> 6) o LEFT JOIN part b ON b.p_partkey = o.id""")
def crystal_outcomes(spark, sf_dir):
    """What levelling yields: the next crystal, or on failure a cursed one, which the catalogue lacks here."""
    k = F.col("p_partkey")
    up = k % 7 != 6
    crystals = table(spark, sf_dir, "part").select(k.alias("crystal_id"), F.col("p_size").alias("level"), F.when(up, k + 1).alias("next_id"), F.when(up & (k % 2 == 0), k + 1_000_000).alias("cursed_id"))
    return catalogue.crystal_levels(crystals)


@query("SELECT l_orderkey AS recipe_id, 'ingredient' AS part, l_partkey AS item_id FROM lineitem UNION ALL SELECT l_orderkey, 'product', min(l_partkey) FROM lineitem GROUP BY 1 UNION ALL SELECT l_orderkey, 'rare_product', max(l_partkey) FROM lineitem GROUP BY 1 HAVING count(*) > 3")
def recipe_bom(spark, sf_dir):
    item = lambda c: F.struct(c.alias("item_id"), F.lit(1).alias("count"))
    recipes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("recipe_id")).agg(F.collect_list(item(F.col("l_partkey"))).alias("ingredients"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"), F.count(F.lit(1)).alias("n"))
    recipes = recipes.select("recipe_id", "ingredients", item(F.col("lo")).alias("product"), F.when(F.col("n") > 3, item(F.col("hi"))).alias("rare_product"))
    return catalogue.recipe_bom(recipes).select("recipe_id", "part", "item_id")


@query("SELECT event_id AS id, unnest(['/0', '/1/0', '/1/1']) AS path, unnest([user_id % 2 = 1, user_id % 2 = 0, user_id % 2 = 0]) AS negated, unnest([event_id, event_id + 1, event_id + 2]) AS v FROM events")
def condition_leaves(spark, sf_dir):
    """A tree of three leaves per event, negated at the root for odd users and once more in a branch."""
    i = F.col("event_id")
    tree = F.format_string('{"logic":"AND","negated":%s,"children":[{"v":%d},{"logic":"OR","negated":true,"children":[{"v":%d},{"v":%d}]}]}', (F.col("user_id") % 2 == 1).cast("string"), i, i + 1, i + 2)
    leaves = catalogue.condition_leaves(table(spark, sf_dir, "events").select(i.alias("id"), tree.alias("c")), "id", "c")
    return leaves.select("id", "path", "negated", F.get_json_object("leaf", "$.v").cast("bigint").alias("v"))


@query("SELECT l_suppkey AS group_id, l_linenumber AS step_from, count(*) AS n FROM lineitem GROUP BY 1, 2")
def gear_rules(spark, sf_dir):
    """Suppliers as groups, their orders as rules, the lines as scaling steps."""
    step = F.struct(F.col("l_linenumber").alias("from"), F.lit(None).cast("int").alias("to"), F.lit(1).alias("value"))
    rules = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_orderkey").agg(F.collect_list(step).alias("steps"))
    groups = rules.groupBy(F.col("l_suppkey").alias("group_id")).agg(F.collect_list(F.struct(F.lit(None).cast("int").alias("cap"), "steps")).alias("rules"))
    return catalogue.gear_rules(groups).groupBy("group_id", F.col("from").alias("step_from")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, ts, (SELECT min(d) FROM (SELECT date_trunc('day', ts + INTERVAL 2 HOUR) + to_days(CAST(i AS INTEGER)) + INTERVAL 20 HOUR - INTERVAL 2 HOUR AS d FROM range(8) r(i)) WHERE d > ts AND isodow(d + INTERVAL 2 HOUR) IN (1, 6)) AS following FROM events")
def next_slots(spark, sf_dir):
    """The next Monday or Saturday, 20:00 at two hours east, after each event."""
    slot = catalogue.next_slot(F.array(F.lit("Mon"), F.lit("Sat")), F.lit("20:00"), F.lit(120), F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", "ts", slot.cast("timestamp_ntz").alias("following"))


@query("SELECT p_partkey, greatest(p_size - 10, 0) AS lo, p_size + 10 AS hi, p_size % 3 <> 0 AS one_place FROM part")
def spawn_ranges(spark, sf_dir):
    third = F.col("p_size") % 3
    spawns = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("respawn_s"), F.lit(10).alias("random_s"), F.when(third != 1, F.lit("p")).alias("point"), F.when(third != 2, F.lit("a")).alias("area"))
    return catalogue.spawn_ranges(spawns).select("p_partkey", F.col("respawn_min_s").alias("lo"), F.col("respawn_max_s").alias("hi"), "one_place")


@query("SELECT o_orderkey AS npc_id, o_custkey AS minion_id, c_name AS minion_name, c_nationkey BETWEEN 5 AND 15 AS absorbs FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def minion_groups(spark, sf_dir):
    minions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("npc_id"), F.col("o_custkey").alias("minion_id"))
    npcs = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    found = catalogue.minion_groups(minions, npcs.select(F.col("c_custkey").alias("npc_id"), F.col("c_name").alias("name")))
    levels = npcs.select(F.col("c_custkey").alias("__k"), "c_nationkey")
    return found.join(levels, F.col("minion_id") == F.col("__k"), "left").select("npc_id", "minion_id", "minion_name", catalogue.absorb_fits(F.col("c_nationkey"), F.lit(5), F.lit(15)).alias("absorbs"))


@query("""WITH m AS (SELECT l_suppkey AS npc_id, CASE WHEN l_linenumber > 1 THEN l_linenumber END AS group_no, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS ids FROM lineitem GROUP BY 1, 2)
SELECT npc_id, group_no, n, ids, group_no IS NULL AS fixed, CASE WHEN group_no IS NOT NULL THEN count(group_no) OVER (PARTITION BY npc_id) END AS sets FROM m""")
def minion_sets(spark, sf_dir):
    """Lines of a supplier as its minions, by line number; those of number one always come."""
    minions = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("npc_id"), F.col("l_partkey").alias("minion_id"), F.lit(1).alias("count"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("group_no"))
    found = catalogue.minion_sets(minions)
    return found.select("npc_id", "group_no", F.size("minions").cast("bigint").alias("n"), F.aggregate("minions", F.lit(0).cast("bigint"), lambda a, x: a + x["minion_id"]).alias("ids"), "fixed", "sets")


@query("SELECT p_partkey AS item_id, unnest(['size', 'price']) AS stat, unnest([CAST(p_size AS DOUBLE), p_retailprice]) AS value FROM part")
def item_stats(spark, sf_dir):
    stats = F.create_map(F.lit("size"), F.col("p_size").cast("double"), F.lit("price"), F.col("p_retailprice"))
    return catalogue.item_catalogue(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_name", stats.alias("stats")), ["p_name"])["stats"]


def items_of(spark, sf_dir):
    part, line = table(spark, sf_dir, "part"), F.struct(F.col("l_suppkey").alias("skill_id"), F.col("l_linenumber").alias("level"))
    skills = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.collect_list(line).alias("skills"))
    own = part.join(skills, F.col("p_partkey") == F.col("l_partkey"), "left")
    restrictions = F.when(F.col("p_size") > 10, F.struct(F.col("p_size").alias("min_level"), (F.col("p_size") % 2 == 0).alias("hero_only")))
    upgrade = F.when(F.col("p_size") % 3 == 0, F.struct((F.col("p_partkey") + 1).alias("item_id"), F.lit(5).alias("count")))
    return own.select(F.col("p_partkey").alias("item_id"), "p_name", "skills", restrictions.alias("restrictions"), upgrade.alias("upgrade"))


@query("SELECT p_partkey AS item_id, p_name, CASE WHEN p_size > 10 THEN p_size END AS restrictions_min_level, CASE WHEN p_size > 10 THEN p_size % 2 = 0 END AS restrictions_hero_only, CASE WHEN p_size % 3 = 0 THEN p_partkey + 1 END AS upgrade_item_id, CASE WHEN p_size % 3 = 0 THEN 5 END AS upgrade_count FROM part")
def item_scalars(spark, sf_dir):
    """Names, restrictions and upgrades of items; either may be absent."""
    return catalogue.item_catalogue(items_of(spark, sf_dir), ["p_name"])["items"]


@query("SELECT l_partkey AS item_id, l_suppkey AS skill_id, l_linenumber AS level FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)")
def item_skills(spark, sf_dir):
    """Order lines as the skills of their part."""
    return catalogue.item_catalogue(items_of(spark, sf_dir), ["p_name"])["skills"].select("item_id", "skill_id", "level")


@query("SELECT l_suppkey AS skill_id, l_linenumber * 5 AS chance, l_partkey AS item_id FROM lineitem")
def produced_items(spark, sf_dir):
    groups = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("skill_id"), (F.col("l_linenumber") * 5).alias("chance")).agg(F.collect_list(F.struct(F.col("l_partkey").alias("item_id"))).alias("items"))
    skills = groups.groupBy("skill_id").agg(F.collect_list(F.struct("chance", "items")).alias("produced"))
    return catalogue.produced_items(skills).select("skill_id", "chance", "item_id")


@query("SELECT p_partkey FROM part WHERE p_size % 4 = 0 OR p_size % 4 = 2 OR (p_size - 1) % 4 = 2")
def gear_contributions(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.array(F.col("p_size") % 4, (F.col("p_size") - 1) % 4)).alias("class_ids"))
    return catalogue.gear_contributions(part, 2).select("p_partkey")


@query("SELECT o_orderkey, greatest(least(CAST(floor(o_totalprice / 10000) AS BIGINT), 20), 0) AS level FROM orders")
def experience_levels(spark, sf_dir):
    levels = spark.range(21).select(F.col("id").alias("level"), (F.col("id") * 10000.0).alias("required"))
    return catalogue.level_of(table(spark, sf_dir, "orders"), levels, "o_totalprice").select("o_orderkey", "level")


# Entities: rows of the tables as the records of their topics, decoded into typed tables.


def spread(rows, key):
    """Rows of a table by key over many tasks: a small file lies in one or two splits, but its records are long work."""
    return rows.repartition(key)


def entity_records(rows, key, payload, missing=None):
    """Records of a payload struct; where ``missing`` holds a tombstone."""
    value = F.encode(F.to_json(payload), "utf-8")
    value = value if missing is None else F.when(~missing, value)
    return rows.select(ids.key_bytes(key).alias("key"), value.alias("value"))


@query("SELECT c_custkey AS id, c_name AS name, c_nationkey AS level, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS race, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS lock FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0")
def entity_characters(spark, sf_dir):
    """Customers as characters, a fifth deleted, a seventh without the name that must be there."""
    c = spread(table(spark, sf_dir, "customer"), "c_custkey")
    k, one = F.col("c_custkey"), F.lit(1)
    display = F.when(k % 2 == 0, F.struct(F.col("c_mktsegment").alias("race"), one.alias("face")))
    locks = F.when(k % 3 == 0, F.array(F.struct(F.lit("name").alias("lockType"), F.col("c_name").alias("lockValue"))))
    payload = F.struct(k.alias("id"), F.when(k % 7 != 0, F.col("c_name")).alias("name"), F.col("c_nationkey").alias("level"), display.alias("display"), locks.alias("locks"), one.alias("unknown"))
    rows = entities.entity_table(entity_records(c, k, payload, k % 5 == 0), "character")[0]
    return rows.select("id", "name", "level", F.col("display.race").alias("race"), F.get("locks", 0)["lockValue"].alias("lock"))


@query("SELECT c_custkey AS id, c_custkey % 5 = 0 AS deleted FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0")
def entity_losses(spark, sf_dir):
    """What isn't a row: tombstones by their key, and records without a field that must be there."""
    k = F.col("c_custkey")
    payload = F.struct(k.alias("id"), F.when(k % 7 != 0, F.col("c_name")).alias("name"))
    _, deleted, dead = entities.entity_table(entity_records(spread(table(spark, sf_dir, "customer"), "c_custkey"), k, payload, k % 5 == 0), "clan")
    return deleted.select(F.col("key_number").alias("id"), F.lit(True).alias("deleted")).unionByName(dead.select(ids.key_number(F.col("key")).alias("id"), F.lit(False).alias("deleted")))


@query("SELECT o_orderdate AS season, o_custkey AS char_id, CAST(floor(o_totalprice) AS BIGINT) AS points, o_orderpriority AS priority FROM orders")
def entity_ratings(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    payload = F.struct(F.lit("pvp").alias("ratingType"), F.col("o_orderdate").cast("string").alias("season"), F.col("o_custkey").alias("charId"), F.floor("o_totalprice").alias("points"), F.create_map(F.lit("priority"), F.col("o_orderpriority")).alias("metadata"))
    rows = entities.entity_table(entity_records(o, F.col("o_custkey"), payload), "rating")[0]
    return rows.select(F.col("season").cast(o.schema["o_orderdate"].dataType).alias("season"), F.col("charId").alias("char_id"), "points", F.col("metadata")["priority"].alias("priority"))


@query("SELECT l_suppkey AS npc_id, l_partkey AS item_id, CAST(l_linenumber * 10 AS DOUBLE) AS item_chance, CASE WHEN l_linenumber % 2 = 0 THEN CAST(50 / 100.0 * (l_linenumber * 10) AS DOUBLE) END AS chance, CAST(l_quantity AS BIGINT) AS n FROM lineitem")
def entity_npc_drops(spark, sf_dir):
    """Suppliers as NPC templates whose drops are their lines: from records to flat drops."""
    item = F.struct(F.col("l_partkey").alias("itemTemplateId"), F.col("l_quantity").cast("bigint").alias("min"), F.col("l_quantity").cast("bigint").alias("max"), (F.col("l_linenumber") * 10).alias("chancePercent"))
    groups = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.when(F.col("l_linenumber") % 2 == 0, 50.0).alias("groupChancePercent")).agg(F.collect_list(item).alias("items"))
    npcs = groups.groupBy("l_suppkey").agg(F.collect_list(F.struct("groupChancePercent", "items")).alias("drops"))
    rows = entities.entity_table(entity_records(npcs, F.col("l_suppkey"), F.struct(F.col("l_suppkey").alias("id"), F.lit("npc").alias("type"), "drops")), "npc_template")[0]
    drops = catalogue.npc_drops(entities.npc_drop_groups(rows))
    return drops.select(F.col("npc_id").cast("bigint").alias("npc_id"), F.col("item_id").cast("bigint").alias("item_id"), "item_chance", "chance", F.col("max").alias("n"))


@query("SELECT p_partkey AS npc_id, greatest(p_size - 10, 0) AS lo, p_size + 10 AS hi, p_size % 3 <> 0 AS one_place FROM part")
def entity_npc_spawns(spark, sf_dir):
    """Parts as NPC templates with a spawn at a point, in an area, or wrongly at both."""
    part, third = spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey"), F.col("p_size") % 3
    corner = F.array(F.struct(F.lit(1).alias("x"), F.lit(2).alias("y")))
    spawn = F.struct(F.when(third != 1, 5).alias("x"), F.col("p_size").alias("respawnSec"), F.lit(10).alias("respawnRandomSec"), F.when(third != 2, corner).otherwise(F.slice(corner, 1, 0)).alias("territory"))
    rows = entities.entity_table(entity_records(part, F.col("p_partkey"), F.struct(F.col("p_partkey").alias("id"), F.lit("npc").alias("type"), F.array(spawn).alias("spawns"))), "npc_template")[0]
    found = catalogue.spawn_ranges(entities.npc_spawns(rows))
    return found.select(F.col("npc_id").cast("bigint").alias("npc_id"), F.col("respawn_min_s").alias("lo"), F.col("respawn_max_s").alias("hi"), "one_place")


@query("SELECT l_orderkey AS recipe_id, 'ingredient' AS part, l_partkey AS item_id FROM lineitem UNION ALL SELECT l_orderkey, 'product', min(l_partkey) FROM lineitem GROUP BY 1 UNION ALL SELECT l_orderkey, 'rare_product', max(l_partkey) FROM lineitem GROUP BY 1 HAVING count(*) > 3")
def entity_recipes(spark, sf_dir):
    """Orders as recipe records, flattened to their parts."""
    line = F.struct(F.col("l_partkey").alias("itemTemplateId"), F.lit(1).alias("count"))
    r = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("ingredients"), F.min("l_partkey").alias("lo"), F.max("l_partkey").alias("hi"), F.count(F.lit(1)).alias("n"))
    payload = F.struct(F.col("l_orderkey").alias("id"), "ingredients", F.col("lo").alias("productItemTemplateId"), F.lit(1).alias("productCount"), F.when(F.col("n") > 3, F.col("hi")).alias("rareItemTemplateId"))
    rows = entities.entity_table(entity_records(r, F.col("l_orderkey"), payload), "recipe")[0]
    return catalogue.recipe_bom(entities.recipe_parts(rows)).select(F.col("recipe_id").cast("bigint").alias("recipe_id"), "part", F.col("item_id").cast("bigint").alias("item_id"))


# Ledgers: orders as receipts, their status, and events as sessions.

LEDGER = """ledger AS (SELECT CAST(o_orderkey AS VARCHAR) AS correlation_id, CASE WHEN o_custkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS command,
CASE o_orderkey % 5 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'CHARGED' WHEN 2 THEN 'FAILED' ELSE 'OK' END AS status, o_orderdate AS created_at, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS steps_done_at, o_orderkey % 1000 AS charged FROM orders)"""


def ledger_of(spark, sf_dir):
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    status = F.when(k % 5 == 0, "STARTED").when(k % 5 == 1, "CHARGED").when(k % 5 == 2, "FAILED").otherwise("OK")
    none = lambda t: F.lit(None).cast(t)
    return table(spark, sf_dir, "orders").select(
        k.cast("string").alias("correlation_id"), F.when(F.col("o_custkey") % 2 == 0, "buy").otherwise("sell").alias("command"), F.col("o_custkey").cast("int").alias("buyer_char_id"), none("int").alias("seller_char_id"),
        status.alias("status"), (k % 1000).alias("charged_adena"), F.lit(7).alias("mail_id"), F.lit("{}").alias("claim_json"), F.when(status == "OK", F.concat(F.lit("r"), k.cast("string"))).alias("result_json"),
        at.alias("created_at"), F.when(status.isin("OK", "FAILED"), at).alias("completed_at"), F.when(k % 3 == 0, at).alias("steps_done_at"),
    )


CUT = "1998-01-01"


@query(f"WITH {LEDGER} SELECT correlation_id, status FROM ledger WHERE status IN ('STARTED', 'CHARGED') AND command = 'buy'")
def receipts_open(spark, sf_dir):
    return ledger.receipts_open(ledger_of(spark, sf_dir), "buy").select("correlation_id", "status")


@query(f"WITH {LEDGER} SELECT DISTINCT command FROM ledger WHERE status IN ('STARTED', 'CHARGED')")
def receipts_open_commands(spark, sf_dir):
    return ledger.open_commands(ledger_of(spark, sf_dir))


@query(f"WITH {LEDGER} SELECT correlation_id FROM ledger WHERE status = 'STARTED' AND command = 'buy' AND created_at < TIMESTAMP '{CUT}'")
def receipts_stale(spark, sf_dir):
    return ledger.receipts_stale(ledger_of(spark, sf_dir), "buy", F.lit(CUT).cast("timestamp")).select("correlation_id")


@query(f"WITH {LEDGER} SELECT correlation_id FROM ledger WHERE status = 'OK' AND command = 'sell' AND steps_done_at IS NULL")
def receipts_open_steps(spark, sf_dir):
    return ledger.receipts_open_steps(ledger_of(spark, sf_dir), "sell").select("correlation_id")


@query(f"WITH {LEDGER} SELECT correlation_id, status FROM ledger WHERE NOT (status IN ('OK', 'FAILED') AND created_at < TIMESTAMP '{CUT}' AND NOT (status = 'OK' AND steps_done_at IS NULL AND command = 'buy'))")
def receipts_pruned(spark, sf_dir):
    return ledger.receipts_prune(ledger_of(spark, sf_dir), F.lit(CUT).cast("timestamp"), ["buy"]).select("correlation_id", "status")


@query(f"""WITH {LEDGER}, asked AS (SELECT event_id, CAST(event_id // 2 * 2 AS VARCHAR) AS correlation_id, event_id % 2 = 0 OR event_id = 0 AS first FROM events)
SELECT event_id, CASE WHEN status = 'OK' THEN 'REPLAY_OK' WHEN (status IS NULL OR status = 'FAILED') AND first THEN 'CLAIMED' ELSE 'IN_FLIGHT' END AS outcome, CASE WHEN status = 'OK' THEN 'r' || correlation_id END AS result_json FROM asked LEFT JOIN ledger USING (correlation_id)""")
def claim_outcomes(spark, sf_dir):
    """Two requests for each even receipt; the second of a free one finds it in flight."""
    asked = table(spark, sf_dir, "events").select("event_id", (F.floor(F.col("event_id") / 2) * 2).cast("string").alias("correlation_id"), F.col("event_id").alias("ts"))
    return ledger.claim_outcome(asked, ledger_of(spark, sf_dir)).select("event_id", "outcome", "result_json")


@query(f"WITH {LEDGER} SELECT correlation_id, CASE WHEN status = 'STARTED' THEN 'OK' WHEN status = 'CHARGED' THEN 'OK' ELSE status END AS status, CASE WHEN status = 'STARTED' THEN 42 ELSE charged END AS charged, status IN ('STARTED', 'CHARGED') AND correlation_id IS NOT NULL AS settled FROM ledger")
def receipts_settled(spark, sf_dir):
    """Guarded charge, then guarded success, on every receipt: only open ones move."""
    book = ledger_of(spark, sf_dir)
    move = lambda action, ts: book.select("correlation_id", F.lit(action).alias("action"), F.lit(ts).cast("timestamp").alias("ts"), F.lit(42).cast("bigint").alias("amount"), F.lit("done").alias("result_json"))
    after, _ = ledger.settle(book, move("charge_if_started", "2024-01-01").unionByName(move("ok_if_charged", "2024-01-02")))
    return after.select("correlation_id", "status", F.col("charged_adena").alias("charged"), F.coalesce(F.col("result_json") == "done", F.lit(False)).alias("settled"))


SESSIONS = """sessions AS (SELECT event_id AS id, user_id AS character_id, ts AS started_at, CASE WHEN event_type <> 'signup' THEN ts + INTERVAL 1 HOUR END AS ended_at, event_type AS activity FROM events)"""


def sessions_of(spark, sf_dir):
    e, at = table(spark, sf_dir, "events"), F.col("ts").cast("timestamp")
    is_open = F.col("event_type") == "signup"
    spot = F.when(is_open, F.concat(F.lit("p:"), (F.col("event_id") % 5000).cast("string")))
    given = {"id": F.col("event_id"), "idempotency_key": F.concat(F.lit("k"), F.col("event_id").cast("string")), "character_id": F.col("user_id").cast("int"), "active_character_id": F.when(is_open, F.col("user_id")).cast("int"), "activity": F.col("event_type"), "spot_pool": F.lit("p"), "spot_id": (F.col("event_id") % 5000).cast("int"), "active_spot_key": spot, "started_at": at, "active_ms": F.lit(1000).cast("bigint"), "ended_at": F.when(~is_open, at + F.expr("INTERVAL 1 HOUR")), "end_reason": F.when(~is_open, F.when(F.col("event_type") == "error", "lost").otherwise("done"))}
    from pyspark.sql import types as T

    return e.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(ledger.SESSIONS).fields])


@query(f"WITH {SESSIONS} SELECT id FROM sessions WHERE ended_at IS NULL")
def sessions_open(spark, sf_dir):
    return ledger.sessions_open(sessions_of(spark, sf_dir)).select("id")


@query(f"WITH {SESSIONS} SELECT id FROM sessions WHERE ended_at IS NULL OR ended_at >= TIMESTAMP '2024-01-15'")
def sessions_retained(spark, sf_dir):
    return ledger.sessions_retention(sessions_of(spark, sf_dir), F.lit("2024-01-15").cast("timestamp")).select("id")


@query(f"WITH {SESSIONS} SELECT id FROM sessions WHERE activity IN ('signup', 'view') UNION ALL SELECT id FROM sessions WHERE activity = 'error'")
def sessions_valid(spark, sf_dir):
    return ledger.valid_sessions(sessions_of(spark, sf_dir), ["signup", "view", "error"], ["done", "lost"]).select("id")


@query(f"WITH {SESSIONS} SELECT id, CASE WHEN ended_at IS NULL THEN greatest(1000, (id % 3) * 1000) ELSE 1000 END AS active_ms FROM sessions")
def sessions_flushed(spark, sf_dir):
    sessions = sessions_of(spark, sf_dir)
    updates = sessions.select("id", (F.col("id") % 3 * 1000).alias("active_ms"))
    return ledger.flush_active_ms(sessions, updates.unionByName(updates)).select("id", "active_ms")


@query(f"WITH {SESSIONS} SELECT id, ended_at IS NULL AND id % 2 = 0 AS closed_now, CASE WHEN ended_at IS NULL AND id % 2 = 1 THEN character_id END AS active FROM sessions")
def sessions_closed(spark, sf_dir):
    sessions = sessions_of(spark, sf_dir)
    closes = sessions.where("id % 2 = 0").select("id", F.lit("2025-01-01").cast("timestamp").alias("ended_at"), F.lit("closed").alias("end_reason"))
    found = ledger.close_sessions(sessions, closes)
    return found.select("id", F.coalesce(F.col("end_reason") == "closed", F.lit(False)).alias("closed_now"), F.col("active_character_id").cast("bigint").alias("active"))


@query(f"WITH {SESSIONS}, o AS (SELECT id, 'p:' || (id % 5000) AS key FROM sessions WHERE ended_at IS NULL), t AS (SELECT id, 'q:' || (id % 2) AS key FROM o) SELECT o.id, CASE WHEN t.id IN (SELECT min(id) FROM t GROUP BY key) THEN t.key ELSE o.key END AS spot FROM o JOIN t USING (id)")
def sessions_placed(spark, sf_dir):
    """All sessions want one of two new spots; the lowest ids that are open get them."""
    sessions = sessions_of(spark, sf_dir)
    wish = sessions.select("id", F.lit("q").alias("spot_pool"), (F.col("id") % 2).cast("int").alias("spot_id"), F.col("id").alias("ts"))
    return ledger.place_sessions(sessions, wish)[0].where("ended_at IS NULL").select("id", F.col("active_spot_key").alias("spot"))


@query(f"""WITH {SESSIONS}, o AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM sessions WHERE ended_at IS NULL)
SELECT s.id, CASE WHEN s.ended_at IS NOT NULL THEN 'NOT_OPEN' WHEN o.n % 3 = 0 THEN 'SPOT_TAKEN' ELSE 'PLACED' END AS verdict FROM sessions s LEFT JOIN o USING (id)""")
def placements_judged(spark, sf_dir):
    """Of each three open sessions the first leaves its spot, the second takes that, and the third wants it too late."""
    from pyspark.sql import Window

    sessions = sessions_of(spark, sf_dir).withColumn("active_spot_key", F.when(F.col("ended_at").isNull(), F.concat(F.lit("p:"), F.col("id").cast("string"))))
    n = F.row_number().over(Window.partitionBy(F.col("ended_at").isNull()).orderBy("id"))
    rows = sessions.select("id", "ended_at", n.alias("n"))
    thirds = rows.where("ended_at IS NULL").select(F.floor((F.col("n") - 1) / 3).alias("third"), F.col("id").alias("first_id"), "n").where("n % 3 = 1").drop("n")
    rows = rows.withColumn("third", F.floor((F.col("n") - 1) / 3)).join(thirds, "third", "left")
    leaves = (F.col("n") % 3 == 1) | F.col("ended_at").isNotNull()
    wish = rows.select("id", F.when(leaves, "free").otherwise("p").alias("spot_pool"), F.when(leaves, F.col("id")).otherwise(F.col("first_id")).cast("int").alias("spot_id"), F.col("n").alias("ts"))
    return ledger.place_sessions(sessions, wish)[1].select("id", "verdict")


def admissions_asked(spark, sf_dir):
    k = F.col("o_orderkey")
    key = F.when(k % 10 == 0, F.concat(F.lit("k"), F.floor(k / 10).cast("string"))).otherwise(F.concat(F.lit("n"), (k - k % 3).cast("string")))
    spot = F.when(k % 4 > 0, F.concat(F.lit("p:"), (k % 700).cast("string")))
    return table(spark, sf_dir, "orders").select(k, key.alias("idempotency_key"), (F.col("o_custkey") % 300).cast("int").alias("character_id"), spot.alias("spot_key"), k.alias("ts"))


@query(f"""WITH RECURSIVE {SESSIONS}, a AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'k' || (o_orderkey // 10) ELSE 'n' || (o_orderkey - o_orderkey % 3) END AS key, o_custkey % 300 AS ch, CASE WHEN o_orderkey % 4 > 0 THEN 'p:' || (o_orderkey % 700) END AS spot FROM orders),
h AS (SELECT *, key IN (SELECT 'k' || id FROM sessions) AS dup, ch IN (SELECT character_id FROM sessions WHERE ended_at IS NULL) AS act, coalesce(spot IN (SELECT 'p:' || (id % 5000) FROM sessions WHERE ended_at IS NULL), false) AS taken FROM a),
r AS (SELECT *, CASE WHEN dup OR act OR taken THEN 0 END AS won, 0 AS round FROM h UNION ALL
SELECT k, key, ch, spot, dup, act, taken, CASE WHEN won IS NOT NULL THEN won WHEN by_key OR by_ch OR (spot IS NOT NULL AND by_spot) THEN 0 WHEN k = first_key AND k = first_ch AND (spot IS NULL OR k = first_spot) THEN 1 END, round + 1
FROM (SELECT *, count(*) FILTER (won IS NULL) OVER () AS left_over, coalesce(max(won) OVER y, 0) = 1 AS by_key, coalesce(max(won) OVER c, 0) = 1 AS by_ch, coalesce(max(won) OVER s, 0) = 1 AS by_spot,
min(k) FILTER (won IS NULL) OVER y AS first_key, min(k) FILTER (won IS NULL) OVER c AS first_ch, min(k) FILTER (won IS NULL) OVER s AS first_spot FROM r WINDOW y AS (PARTITION BY key), c AS (PARTITION BY ch), s AS (PARTITION BY spot)) WHERE left_over > 0),
d AS (SELECT *, min(k) FILTER (won = 1) OVER (PARTITION BY key) AS wk, min(k) FILTER (won = 1) OVER (PARTITION BY ch) AS wc, min(k) FILTER (won = 1) OVER (PARTITION BY spot) AS ws FROM r WHERE round = (SELECT max(round) FROM r))
SELECT k, CASE WHEN dup OR coalesce(wk < k, false) THEN 'DUPLICATE' WHEN act OR coalesce(wc < k, false) THEN 'CHARACTER_ACTIVE' WHEN taken OR coalesce(spot IS NOT NULL AND ws < k, false) THEN 'SPOT_TAKEN' ELSE 'ADMITTED' END AS verdict FROM d""")
def session_admissions(spark, sf_dir):
    """Orders as requests, three of a key, many of a character and of a spot."""
    return ledger.session_admission(admissions_asked(spark, sf_dir), sessions_of(spark, sf_dir)).select(F.col("o_orderkey").alias("k"), "verdict")


CLAIMED = f"""{LEDGER}, asked AS (SELECT CAST(event_id * 2 AS VARCHAR) AS correlation_id, event_id, ts FROM events)"""


def claims_of(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    asked = e.select((F.col("event_id") * 2).cast("string").alias("correlation_id"), F.lit("claimed").alias("command"), F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("int").alias("buyer_char_id"), F.col("event_id").cast("int").alias("mail_id"), F.col("props").alias("claim_json"))
    return ledger.claim_outcome(asked, ledger_of(spark, sf_dir))


@query(f"""WITH {CLAIMED}, c AS (SELECT a.correlation_id, a.event_id, user_id, props, l.correlation_id IS NULL AS fresh FROM asked a JOIN events USING (event_id) LEFT JOIN ledger l USING (correlation_id) WHERE l.status IS NULL OR l.status = 'FAILED')
SELECT correlation_id, coalesce(CASE WHEN fresh THEN 'claimed' END, command) AS command, CASE WHEN fresh THEN user_id ELSE o_custkey END AS buyer, coalesce(event_id, 7) AS mail_id, CASE WHEN event_id IS NULL THEN '{{}}' ELSE props END AS claim_json, CASE WHEN event_id IS NULL THEN charged END AS charged, CASE WHEN event_id IS NULL THEN status ELSE 'STARTED' END AS status
FROM ledger FULL JOIN c USING (correlation_id) LEFT JOIN orders ON CAST(o_orderkey AS VARCHAR) = correlation_id""")
def receipts_claimed(spark, sf_dir):
    """The ledger after claims: reopened receipts keep their parties and take mail and claim, new ones take all."""
    after = ledger.apply_claims(ledger_of(spark, sf_dir), claims_of(spark, sf_dir))
    return after.select("correlation_id", "command", F.col("buyer_char_id").cast("bigint").alias("buyer"), F.col("mail_id").cast("bigint").alias("mail_id"), "claim_json", F.col("charged_adena").alias("charged"), "status")


@query(f"WITH {CLAIMED} SELECT event_id, CASE WHEN status = 'OK' THEN 'REPLAY_OK' WHEN status <> 'FAILED' THEN 'IN_FLIGHT' END AS outcome FROM asked LEFT JOIN ledger USING (correlation_id)")
def receipts_looked_up(spark, sf_dir):
    """What a receipt tells without claiming it; failed ones and none tell nothing."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 2).cast("string").alias("correlation_id"))
    return ledger.lookup(e, ledger_of(spark, sf_dir)).select("event_id", "outcome")


@query(f"WITH {LEDGER} SELECT correlation_id, status, charged FROM ledger WHERE command = 'buy'")
def ledger_read(spark, sf_dir):
    """The ledger table written and read by its schema."""
    from tidemark.scratch import shared_path

    path = shared_path(spark, "ledger")
    ledger_of(spark, sf_dir).write.parquet(path)
    return ledger.read_ledger(spark, path).where("command = 'buy'").select("correlation_id", "status", F.col("charged_adena").alias("charged"))


@query(f"WITH {SESSIONS} SELECT id, character_id, activity FROM sessions")
def sessions_read(spark, sf_dir):
    from tidemark.scratch import shared_path

    path = shared_path(spark, "sessions")
    sessions_of(spark, sf_dir).write.parquet(path)
    return ledger.read_sessions(spark, path).select("id", F.col("character_id").cast("bigint").alias("character_id"), "activity")
