"""Roots of self-references, in rounds that grow with the logarithm of the depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import cut


def rooted(rows: DataFrame, key: str, parent: str) -> tuple[DataFrame, DataFrame]:
    """(found, lost) of rows whose ``parent`` is the key of another one, null for a root: (key, root, depth) of the rows
    below a root, and the (key) of those that no root is above: rows on a cycle, below one, or below a key that isn't
    there. Depth is not bounded.

    Each round a row takes over the pointer of the row it points at, so pointers double their reach. A row that has a
    root gets it from a row that has it already, so a round in which no row does ends the search.
    """
    has = F.col(parent).isNotNull()
    state = cut(rows.select(F.col(key).alias("k"), F.coalesce(parent, key).alias("at"), has.cast("bigint").alias("d"), (~has).alias("done")), "tree")
    reached = state.where("done").count()
    while True:
        there = state.select(F.col("k").alias("at"), F.col("at").alias("further"), F.col("d").alias("more"), F.col("done").alias("ends"))
        step = state.where("NOT done").join(there, "at", "left")
        step = step.select("k", F.col("further").alias("at"), (F.col("d") + F.col("more")).alias("d"), F.coalesce("ends", F.lit(False)).alias("done"))
        state = cut(state.where("done").unionByName(step), "tree")
        now = state.where("done").count()
        if now == reached:
            found = state.where("done").select(F.col("k").alias(key), F.col("at").alias("root"), F.col("d").cast("int").alias("depth"))
            return found, state.where("NOT done").select(F.col("k").alias(key))
        reached = now


def shortest_origins(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, lost) of distinct edges (to, origin): (item_id, origin_id, steps) for every ``to`` and every origin above
    it that nothing leads to, with the fewest steps between them, and the (item_id) of those that have none, being on
    cycles or below nothing else.

    Runs without a merge are followed by pointer jumping. Ways through merges of several origins double their hops each
    round, so rounds grow with the logarithm of the merges one after another. A way that isn't shortest is part of no
    shortest one and is dropped, so cycles end too.
    """
    edges = cut(edges, "moves")
    several = edges.groupBy("to").agg(F.count(F.lit(1)).alias("n"), F.min("origin").alias("origin"))
    items = edges.select(F.col("to").alias("k")).unionByName(edges.select(F.col("origin").alias("k"))).distinct()
    forest = items.join(several.where("n = 1").select(F.col("to").alias("k"), F.col("origin").alias("p")), "k", "left")
    tops, _ = rooted(forest, "k", "p")
    tops = cut(tops.select("k", F.col("root").alias("top"), F.col("depth").cast("bigint").alias("d")), "tops")
    merges = cut(several.where("n > 1").select(F.col("to").alias("m")), "merges")
    hops = edges.join(merges.withColumnRenamed("m", "to"), "to", "left_semi").join(tops.withColumnRenamed("k", "origin"), "origin")
    hops = cut(hops.groupBy(F.col("to").alias("m"), F.col("top").alias("at")).agg(F.min(F.col("d") + 1).alias("w")), "hops")
    best = exact = hops.withColumnRenamed("w", "steps")
    while True:
        # ``best`` are the shortest ways of up to n hops, ``exact`` those of them that have n hops; n doubles.
        onward = exact.select(F.col("m").alias("at"), F.col("at").alias("next"), F.col("steps").alias("w"))
        reach = lambda ways: ways.join(onward, "at").groupBy("m", F.col("next").alias("at")).agg(F.min(F.col("steps") + F.col("w")).alias("steps"))  # noqa: E731, B023
        known = best.select("m", "at", F.col("steps").alias("known"))
        better = cut(reach(best).join(known, ["m", "at"], "left").where("known IS NULL OR steps < known").select("m", "at", "steps"), "ways-better")
        if better.isEmpty():
            break
        best = cut(best.unionByName(better).groupBy("m", "at").agg(F.min("steps").alias("steps")), "ways")
        exact = cut(reach(exact).join(best, ["m", "at", "steps"], "left_semi"), "ways-exact")
    ends = best.join(merges.withColumnRenamed("m", "at"), "at", "left_anti").select(F.col("m").alias("top"), "at", "steps")
    own = tops.join(edges.select(F.col("to").alias("k")).distinct(), "k", "left_semi")
    direct = own.join(merges.withColumnRenamed("m", "top"), "top", "left_anti").select(F.col("k").alias("item_id"), F.col("top").alias("origin_id"), F.col("d").alias("steps"))
    through = own.join(ends, "top").select(F.col("k").alias("item_id"), F.col("at").alias("origin_id"), (F.col("d") + F.col("steps")).alias("steps"))
    found = cut(direct.unionByName(through).withColumn("steps", F.col("steps").cast("int")), "origins")
    lost = edges.select(F.col("to").alias("item_id")).distinct().join(found.select("item_id"), "item_id", "left_anti")
    return found, lost
