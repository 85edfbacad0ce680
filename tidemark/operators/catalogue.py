"""Flattening of nested catalogues, self-referencing trees, schedules and rule tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookups import bracket_lookup
from tidemark.operators.trees import rooted
from tidemark.scratch import cut


def npc_drops(npcs: DataFrame) -> DataFrame:
    """A row per drop with ``chance`` in percent of both rolls, the group's and the item's; null if the group has none."""
    groups = npcs.select("npc_id", F.posexplode("drop_groups").alias("group_no", "g"))
    items = groups.select("npc_id", "group_no", F.col("g.chance").alias("group_chance"), F.inline("g.items"))
    return items.withColumnRenamed("chance", "item_chance").withColumn("chance", F.col("group_chance") / 100 * F.col("item_chance"))


def nested_table(df: DataFrame, key: str, column: str, keep_empty: bool = False) -> DataFrame:
    """A row per entry of a nested list of structs, with its place: skill levels, learns, effects, enchant routes,
    armour set pieces and skills, spawns, minions, absorbs. ``keep_empty``: a null row for empty lists."""
    explode = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(key, explode(column).alias("place", "__e")).select(key, "place", "__e.*")


def tree_depth(df: DataFrame, key: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """(found, lost): (key, root, depth) of rows under a root, whose parent is null, at any depth; and the keys on or
    below a cycle or a parent that isn't there."""
    return rooted(df, key, parent)


def chain_steps(df: DataFrame, key: str, following: str) -> tuple[DataFrame, DataFrame]:
    """(found, lost): (key, top, steps) with how many rows follow each over ``following`` up to the top; and the keys
    whose chain goes round or ends at a key that isn't there."""
    found, lost = rooted(df, key, following)
    return found.select(key, F.col("root").alias("top"), F.col("depth").alias("steps")), lost


def crystal_levels(crystals: DataFrame) -> DataFrame:
    """A row per outcome of levelling a crystal (crystal_id, level, next_id, cursed_id): (crystal_id, outcome ``next`` or
    ``cursed``, result_id, result_level). A crystal at the top has neither; a result may be absent from the catalogue."""
    outcomes = F.array(*[F.struct(F.lit(n).alias("outcome"), F.col(c).alias("result_id")) for n, c in (("next", "next_id"), ("cursed", "cursed_id"))])
    each = crystals.select("crystal_id", F.inline(outcomes)).where("result_id IS NOT NULL")
    levels = crystals.select(F.col("crystal_id").alias("__id"), F.col("level").alias("result_level"))
    return each.join(levels, F.col("result_id") == F.col("__id"), "left").drop("__id")


def recipe_bom(recipes: DataFrame) -> DataFrame:
    """(recipe_id, part, item_id, count): ingredients, product and rare product as rows."""
    part = lambda name, e: F.struct(F.lit(name).alias("part"), e["item_id"].alias("item_id"), e["count"].alias("count"))
    one = lambda name: F.filter(F.array(F.when(F.col(name).isNotNull(), part(name, F.col(name)))), lambda x: x.isNotNull())
    return recipes.select("recipe_id", F.inline(F.concat(F.transform("ingredients", lambda e: part("ingredient", e)), one("product"), one("rare_product"))))


def condition_trees(df: DataFrame, key: str, condition: str) -> tuple[DataFrame, DataFrame]:
    """(leaves, rejected) of a JSON condition tree {logic, negated, children | ...}. Leaves are its nodes without children,
    down to the deepest: (key, path, negated, leaf), where ``negated`` tells whether the negations above, and its own, are
    odd, and ``leaf`` is the node's JSON with its fields in the order of their names. Rejected are (key, path, json) of a
    text that isn't JSON, with an empty path, and of nodes whose ``children`` are no list or whose ``negated`` is no
    boolean; what is beside them stands. A null tree, or null child, is neither.

    A text is parsed once, to a VARIANT; each level is then one written table.
    """
    k, text = F.col(key).alias("k"), F.col(condition).cast("string")
    start = cut(df.select(k, text.alias("text"), F.try_parse_json(text).alias("node")).where("text IS NOT NULL"), "conditions")
    rejected = start.where("node IS NULL").select("k", F.lit("").alias("path"), F.col("text").alias("json"))
    leaves, front = None, start.where("node IS NOT NULL").select("k", F.lit("").alias("path"), F.lit(False).alias("above"), "node")
    inside = lambda path, kind: F.try_variant_get("node", path, kind)
    wrong = lambda path, value: inside(path, "variant").isNotNull() & ~F.is_variant_null(inside(path, "variant")) & F.col(value).isNull()
    while not front.isEmpty():
        step = front.where(~F.is_variant_null("node")).select("*", inside("$.children", "array<variant>").alias("children"), inside("$.negated", "boolean").alias("own"))
        bad, inner = wrong("$.children", "children") | wrong("$.negated", "own"), F.coalesce(F.size("children") > 0, F.lit(False))
        step = step.select("k", "path", (F.col("above") != F.coalesce("own", F.lit(False))).alias("negated"), "node", "children", bad.alias("bad"), inner.alias("inner"))
        step = cut(step, "conditions")
        found = step.where("NOT bad AND NOT inner").select("k", "path", "negated", F.to_json("node").alias("leaf"))
        leaves = found if leaves is None else leaves.unionByName(found)
        rejected = rejected.unionByName(step.where("bad").select("k", "path", F.to_json("node").alias("json")))
        front = step.where("inner AND NOT bad").select("k", "path", "negated", F.posexplode("children").alias("no", "node"))
        front = front.select("k", F.concat("path", F.lit("/"), F.col("no").cast("string")).alias("path"), F.col("negated").alias("above"), "node")
    if leaves is None:
        leaves = rejected.where("false").select("k", "path", F.lit(False).alias("negated"), F.col("json").alias("leaf"))
    return leaves.withColumnRenamed("k", key), rejected.withColumnRenamed("k", key)


def condition_leaves(df: DataFrame, key: str, condition: str) -> DataFrame:
    """The leaves of :func:`condition_trees`."""
    return condition_trees(df, key, condition)[0]


def gear_rules(groups: DataFrame) -> DataFrame:
    """A row per scaling step: group, rule, cap and the step's range and value."""
    rules = groups.select("group_id", F.posexplode("rules").alias("rule_no", "r"))
    return rules.select("group_id", "rule_no", F.col("r.cap").alias("cap"), F.inline_outer("r.steps"))


def next_slot(days: Column, time: Column, offset_min: Column, now: Column) -> Column:
    """The next UTC instant after ``now`` of a slot: weekdays (``Mon``...), local time ``HH:mm``, offset in minutes.
    Null without days. Jitter is left to who runs the slot."""
    minutes = F.split(time, ":")[0].cast("int") * 60 + F.split(time, ":")[1].cast("int")
    local = F.unix_seconds(now.cast("timestamp")) + offset_min * 60
    day = F.floor(local / 86400)
    starts = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda d: (day + d) * 86400 + minutes * 60)
    names = F.array(*[F.lit(d) for d in ("Thu", "Fri", "Sat", "Sun", "Mon", "Tue", "Wed")])  # day 0 was a Thursday
    fit = F.filter(starts, lambda s: (s > local) & F.array_contains(days, F.get(names, F.pmod(F.floor(s / 86400), F.lit(7)).cast("int"))))
    return F.timestamp_seconds(F.array_min(fit) - offset_min * 60)


def spawn_ranges(spawns: DataFrame) -> DataFrame:
    """Spawns with the shortest and longest respawn and whether they say one place: a point or an area, never both."""
    low, high = F.greatest(F.col("respawn_s") - F.coalesce("random_s", F.lit(0)), F.lit(0)), F.col("respawn_s") + F.coalesce("random_s", F.lit(0))
    return spawns.select("*", low.alias("respawn_min_s"), high.alias("respawn_max_s"), (F.col("point").isNotNull() != F.col("area").isNotNull()).alias("one_place"))


def minion_groups(minions: DataFrame, npcs: DataFrame) -> DataFrame:
    """Minions with their NPC's name, null where the catalogue lacks it; those of one group spawn together."""
    return minions.join(npcs.select(F.col("npc_id").alias("minion_id"), F.col("name").alias("minion_name")), "minion_id", "left")


def minion_sets(minions: DataFrame) -> DataFrame:
    """What an NPC may spawn with, from (npc_id, minion_id, count, group_no): (npc_id, group_no, minions, fixed, sets).
    Minions of one group number spawn together; different numbers exclude each other, so one of ``sets`` is rolled;
    those without a number are a fixed set, which always spawns."""
    one = minions.groupBy("npc_id", "group_no").agg(F.array_sort(F.collect_list(F.struct("minion_id", "count"))).alias("minions"))
    sets = one.where("group_no IS NOT NULL").groupBy(F.col("npc_id").alias("__npc")).agg(F.count(F.lit(1)).alias("sets"))
    both = one.join(sets, F.col("npc_id") == F.col("__npc"), "left").drop("__npc")
    return both.select("npc_id", "group_no", "minions", F.col("group_no").isNull().alias("fixed"), F.when(F.col("group_no").isNotNull(), F.col("sets")).alias("sets"))


def absorb_fits(level: Column, low: Column, high: Column) -> Column:
    return level.between(low, high)


def item_catalogue(items: DataFrame, scalars: list[str]) -> dict[str, DataFrame]:
    """Item templates flattened: ``items`` with their scalar columns and the fields of the ``restrictions`` and
    ``upgrade`` structs under a prefix; ``stats`` (item_id, stat, value) of the stats map; ``skills`` (item_id, place and
    the fields of each skill reference). Structs and lists that the items don't have are left out."""
    flat = [F.col(f"{part}.{f.name}").alias(f"{part}_{f.name}") for part in ("restrictions", "upgrade") if part in items.columns for f in items.schema[part].dataType.fields]
    out = {"items": items.select("item_id", *scalars, *flat)}
    if "stats" in items.columns:
        out["stats"] = items.select("item_id", F.explode("stats").alias("stat", "value"))
    if "skills" in items.columns:
        out["skills"] = nested_table(items, "item_id", "skills")
    return out


def produced_items(skills: DataFrame) -> DataFrame:
    """A row per produced item; one group is rolled by its chance and gives all its items."""
    groups = skills.select("skill_id", F.posexplode("produced").alias("group_no", "g"))
    return groups.select("skill_id", "group_no", F.col("g.chance").alias("chance"), F.inline("g.items"))


def gear_contributions(contributions: DataFrame, class_id: int) -> DataFrame:
    """Contributions that count for a class; without a list they count for every class."""
    return contributions.where(F.col("class_ids").isNull() | F.array_contains("class_ids", F.lit(class_id)))


def level_of(totals: DataFrame, levels: DataFrame, total: str = "experience") -> DataFrame:
    """Totals with the highest level (level, required) that they reach, null below all. The requirement grows with the
    level, so it is the step that holds the total."""
    steps = levels.select(F.col("required").alias("from"), F.lit(None).cast(levels.schema["required"].dataType).alias("to"), F.col("level").alias("value"))
    found = bracket_lookup(totals.withColumnsRenamed({"value": "__value"}), steps, "__value" if total == "value" else total)
    return found.withColumnsRenamed({"value": "level", "__value": "value"})
