"""The synced entities: schemas of database and catalogue records, typed tables of them, and the columns that
``operators.catalogue`` takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ids import key_number
from tidemark.sources.records import decode_envelope

# Names and types on the wire.
_LOCALIZED = "map<string, string>"

#: Database entities: name: fields of the payload. All are keyed by ``id`` but ratings.
DATABASE: dict[str, str] = {
    "character": """id bigint, name string, accountName string, title string, level int,
        display struct<race: string, sex: string, face: int, hairStyle: int, hairColor: int, nameColor: int, titleColor: int>,
        classId string, baseClassId string, classes array<struct<classId: string, kind: string, level: int, exp: bigint, sp: bigint>>,
        clanId bigint, pvpCounter int, pkCounter int, karma int, noblesse boolean, scheduledDeletionAt timestamp, online boolean,
        onlineTimeSeconds bigint, hero boolean, expBlocked boolean, gearScore int, fame bigint, accessLevel string,
        instanceCooldowns array<struct<instanceId: int, reentryAt: timestamp>>, locks array<struct<lockType: string, lockValue: string>>""",
    "clan": "id bigint, name string, level int, leaderId bigint, allyId bigint, skills array<struct<id: int, level: int>>, icon binary",
    "alliance": "id bigint, name string, icon binary",
    "item": """id bigint, itemTemplateId bigint, ownerId bigint, count bigint, enchantLevel int, location string,
        attributes array<struct<type: string, value: int>>, augmentation struct<option1Id: int, option2Id: int>""",
    "ban": "id bigint, targetType string, targetValue string, targetName string, banType string, expiresAt timestamp, reason string, issuedBy string",
    "rating": "ratingType string, season string, charId bigint, points bigint, metadata map<string, string>",
    "announcement": "id bigint, content string, critical boolean, initialMs bigint, delayMs bigint, cycle int",
}
#: Catalogue entities.
CATALOGUE: dict[str, str] = {
    "item_template": f"""id int, type string, icon string, name {_LOCALIZED}, weight int, referencePrice bigint, material string, grade string,
        equipSlot string, weaponType string, armorType string, etcItemType string, stackable boolean, questItem boolean, petUsable boolean,
        consumable boolean, defaultAction string, useHandler string, duration int, reuseDelayMs int,
        skills array<struct<id: int, level: int, type: string, chancePercent: int>>,
        stats struct<magicWeapon: boolean, stats: map<string, double>>,
        restrictions struct<tradable: boolean, dropable: boolean, sellable: boolean, destroyable: boolean, warehouseDepositable: boolean,
            freightable: boolean, olympiadRestricted: boolean, eventRestricted: boolean>,
        upgrade struct<enchantable: boolean, defaultEnchantLevel: int, attributable: boolean, crystallizable: boolean, crystalCount: int>,
        gearScore int, gearScoreEnchantProfile string""",
    "npc_template": f"""id int, type string, displayId int, level int, race string, aiType string, shots string, randomMinions boolean,
        lethalImmune boolean, championEligible boolean, noRandomWalk boolean, movementDisabled boolean, maxPursueRange int,
        canSeeInSilentMove boolean, globalAggro boolean, raceIcon string, collisionRadius double, collisionHeight double, atkType string,
        stats map<string, double>, rewardExp bigint, rewardSp bigint, rewardRp int, faction struct<name: string, range: int>,
        transformOnDeadNpcTemplateId int, transformChancePercent int, spawnOnDeathCount int, spawnOnDeathChancePercent int,
        name {_LOCALIZED}, title {_LOCALIZED}, rightHand int, leftHand int, skills array<struct<id: int, level: int>>,
        drops array<struct<category: string, groupIndex: int, groupChancePercent: double,
            items: array<struct<itemTemplateId: int, min: bigint, max: bigint, chancePercent: double>>>>,
        minions array<struct<minionNpcTemplateId: int, count: int, groupIndex: int>>,
        absorbs array<struct<type: string, minLevel: int, maxLevel: int, chancePercent: int, cursedChancePercent: int, skill: boolean>>,
        spawns array<struct<x: int, y: int, z: int, heading: int, count: int, respawnSec: int, respawnRandomSec: int, periodOfDay: string,
            respawnPattern: string, territory: array<struct<x: int, y: int, zmin: int, zmax: int>>>>""",
    "recipe": """id int, recipeItemTemplateId int, recipeName string, craftLevel int, dwarven boolean, successRatePercent int,
        productItemTemplateId int, productCount int, rareItemTemplateId int, rareCount int, rarityPercent int, mpConsume int, hpConsume int,
        ingredients array<struct<itemTemplateId: int, count: int>>""",
    "armor_set": """id int, statBonus struct<str: int, dex: int, con: int, intBonus: int, wit: int, men: int>,
        items array<struct<slot: string, itemTemplateId: int>>,
        skills array<struct<skillTemplateId: int, skillLevel: int, kind: string, minPieces: int, enchantLevel: int>>""",
    "soul_crystal": "id int, level int, nextItemTemplateId int, cursedNextItemTemplateId int",
    "class": "clazz string, parentClazz string, race string, type string, tier string",
    "experience_level": "level int, requiredExp bigint",
    "instance": f"id int, name {_LOCALIZED}",
}
ENTITIES = {**DATABASE, **CATALOGUE}
#: Entities with a field other than ``id`` that tells their rows apart, and what must be there besides.
IDENTITY = {"rating": ("ratingType", "season", "charId"), "class": ("clazz",), "experience_level": ("level",)}
REQUIRED = {"character": ("name",), "clan": ("name",), "alliance": ("name",), "announcement": ("content",), "item_template": ("type",), "npc_template": ("type",)}


def entity_table(records: DataFrame, entity: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, deleted, dead) of the records of an entity's topic. ``rows``: ``key_number`` (null for keys that aren't
    numbers) and the payload's fields as columns; ``deleted``: (key, key_number) of tombstones; ``dead``: records whose
    JSON can't be read, or which lack their identity or a field that must be there. Unknown fields are ignored."""
    good, dead = decode_envelope(records, ENTITIES[entity])
    needed = [F.col(f"payload.{c}").isNotNull() for c in (*IDENTITY.get(entity, ("id",)), *REQUIRED.get(entity, ()))]
    sound = needed[0]
    for c in needed[1:]:
        sound &= c
    number, there = key_number(F.col("key")).alias("key_number"), F.col("value").isNotNull()
    rows = good.where(there & sound).select(number, "payload.*")
    deleted = good.where(~there).select("key", number)
    return rows, deleted, dead.unionByName(good.where(there & ~sound).drop("payload"))


def _structs(entries: str, **fields: str) -> Column:
    return F.transform(entries, lambda e: F.struct(*[e[f].alias(c) for c, f in fields.items()]))


def npc_drop_groups(npcs: DataFrame) -> DataFrame:
    """NPC templates as ``catalogue.npc_drops`` takes them."""
    items = lambda g: F.transform(g["items"], lambda i: F.struct(i["itemTemplateId"].alias("item_id"), i["min"].alias("min"), i["max"].alias("max"), i["chancePercent"].alias("chance")))
    groups = F.transform("drops", lambda g: F.struct(g["category"].alias("category"), g["groupChancePercent"].alias("chance"), items(g).alias("items")))
    return npcs.select(F.col("id").alias("npc_id"), groups.alias("drop_groups"))


def npc_minions(npcs: DataFrame) -> DataFrame:
    """(npc_id, minion_id, count, group_no) as ``catalogue.minion_groups`` and ``minion_sets`` take them."""
    return npcs.select(F.col("id").alias("npc_id"), F.inline(_structs("minions", minion_id="minionNpcTemplateId", count="count", group_no="groupIndex")))


def npc_spawns(npcs: DataFrame) -> DataFrame:
    """(npc_id, respawn_s, random_s, point, area, count) as ``catalogue.spawn_ranges`` takes them; an empty territory is none."""
    each = npcs.select(F.col("id").alias("npc_id"), F.explode("spawns").alias("s"))
    point = F.when(F.col("s.x").isNotNull(), F.struct("s.x", "s.y", "s.z", "s.heading"))
    area = F.when(F.size(F.coalesce("s.territory", F.array())) > 0, F.col("s.territory"))
    return each.select("npc_id", F.col("s.respawnSec").alias("respawn_s"), F.col("s.respawnRandomSec").alias("random_s"), point.alias("point"), area.alias("area"), F.col("s.count").alias("count"))


def recipe_parts(recipes: DataFrame) -> DataFrame:
    """Recipes as ``catalogue.recipe_bom`` takes them; a recipe without a product, or rare product, has none."""
    part = lambda item, n: F.when(F.col(item).isNotNull(), F.struct(F.col(item).alias("item_id"), F.col(n).alias("count")))
    ingredients = F.coalesce(_structs("ingredients", item_id="itemTemplateId", count="count"), F.array().cast("array<struct<item_id: int, count: int>>"))
    return recipes.select(F.col("id").alias("recipe_id"), ingredients.alias("ingredients"), part("productItemTemplateId", "productCount").alias("product"), part("rareItemTemplateId", "rareCount").alias("rare_product"))


def crystal_steps(crystals: DataFrame) -> DataFrame:
    """Soul crystals as ``catalogue.crystal_levels`` takes them."""
    return crystals.select(F.col("id").alias("crystal_id"), "level", F.col("nextItemTemplateId").alias("next_id"), F.col("cursedNextItemTemplateId").alias("cursed_id"))


def item_templates(items: DataFrame) -> DataFrame:
    """Item templates as ``catalogue.item_catalogue`` takes them: its stats are the map alone, ``magic_weapon`` a scalar."""
    return items.select(F.col("id").alias("item_id"), F.col("stats.magicWeapon").alias("magic_weapon"), F.col("stats.stats").alias("stats"), *[c for c in items.columns if c not in ("id", "stats", "key_number")])


def requirements(levels: DataFrame) -> DataFrame:
    """Experience levels as ``catalogue.level_of`` takes them."""
    return levels.select("level", F.col("requiredExp").alias("required"))
