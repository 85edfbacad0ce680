"""Op 13: a Merkle manifest of a dataset that stores only every few levels and recomputes the others.

Each row is a leaf, the rows of each tree (a language, say) are numbered in the order of their ids, and every ``arity``
consecutive nodes become their hash until one is left, the tree's subroot. Subroots in the order of the trees' names are
the leaves of one more tree, whose last node is the root.

:func:`build` stores the leaves and each ``every``-th level. Between two stored levels lie aligned subtrees of
``arity ** every`` nodes, which fit in one row. :meth:`Manifest.proofs` goes down from the root: at each stored level it
regenerates the missing nodes of every subtree in which a wanted leaf lies, emits the siblings of the subtree's members,
puts those of the levels above behind them, and drops the nodes. A proof is a list of levels, each with what stands left
and right of the node in its run, so :func:`folded` can compute the root that a leaf belongs to.

Numbering takes no sort by one task: leaves are dealt out by ranges of tree and id, counted by range, and ordered within
their range. Rows alike in tree, id and leaf are spread by a number of their own, so they may be any share of the rows.

Cases: null fields have a mark of their own; a null text hence differs from an empty one; null ids come first, ties of
ids go by their leaves, and alike rows take places next to each other; a null tree is a tree and comes first; an empty
table has no root and no proofs; further columns, of any name, are ignored; ids may be of any type that has an order. A
very long text is hashed where it is read and doesn't move.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.scratch import cleared, written

#: Nodes that become one, and levels between two stored ones.
ARITY, EVERY = 2, 6
_ROOT = ""


def field(c: Column) -> Column:
    """``-`` for null, else the bytes of its text form, a colon and the text form."""
    text = c.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def joined(nodes: Column) -> Column:
    """Hash of consecutive nodes' hashes."""
    return F.sha2(F.array_join(nodes, ""), 256)


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(siblings, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(siblings: Column) -> Column:
    """Hash of all siblings, level by level from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(siblings, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _up(nodes: Column, arity: int) -> Column:
    """The level above an array of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / arity).cast("int"))
    return F.transform(runs, lambda k: joined(F.slice(nodes, k * arity + 1, arity)))


def _steps(levels: Column, every: int) -> Column:
    """0 to ``levels`` - 1."""
    return F.slice(F.array(*[F.lit(k) for k in range(every)]), 1, levels)


def _beside(nodes: Column, at: Column, arity: int) -> Column:
    """What stands left and right of a node in its run."""
    first = at - at % arity
    return F.struct(F.array_join(F.slice(nodes, first + 1, at - first), "").alias("left"), F.array_join(F.slice(nodes, at + 2, first + arity - at - 1), "").alias("right"))


def tree_key(tree: Column) -> Column:
    """Text form of a tree's name with nulls first."""
    return F.coalesce(F.concat(F.lit("="), tree.cast("string")), F.lit(""))


def tree_name(key: Column) -> Column:
    return F.when(key != "", F.substring(key, 2, 1 << 30))


def _numbered(rows: DataFrame) -> DataFrame:
    """Stored rows of (tree, id, leaf, ...) with ``at``, their place in their tree from 0, and ``height``, the levels
    above the leaves that come before the subroot does."""
    order = ["id", "leaf"]
    spread = rows.repartitionByRange("tree", *order, F.monotonically_increasing_id())
    spread = cut(spread.withColumn("part", F.spark_partition_id()), "merkle-ranges")
    counts = spread.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("tree", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"), F.sum("held").over(Window.partitionBy("tree")).alias("leaves"))
    within = Window.partitionBy("tree", "part").orderBy(*order)
    return spread.withColumn("inside", F.row_number().over(within) - 1).join(starts, ["tree", "part"]).withColumn("at", F.col("start") + F.col("inside")).drop("part", "inside", "start")


def _height(leaves: Column, arity: int) -> Column:
    powers = [arity**k for k in range(63) if arity**k < 1 << 63]
    return F.size(F.filter(F.array(*[F.lit(p).cast("bigint") for p in powers]), lambda p: p < leaves))


class Forest(NamedTuple):
    """Stored levels of trees: ``levels[0]`` the numbered leaves, ``levels[j]`` the nodes ``j * every`` levels above them,
    the last the subroots. Trees that are lower end with their subroot and pass it on."""

    levels: list[DataFrame]
    arity: int
    every: int

    def _left(self, j: int) -> Column:
        """Levels from stored level j to the next one, or to the subroot if that comes first."""
        return F.greatest(F.least(F.col("height") - j * self.every, F.lit(self.every)), F.lit(0))

    def _block(self) -> Column:
        return F.floor(F.col("at") / self.arity**self.every).cast("bigint")

    def subroots(self) -> DataFrame:
        return self.levels[-1].select("tree", F.col("leaf").alias("subroot"))

    def proofs(self, above: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        """The leaf rows with ``siblings``, and all of ``above``: (tree, siblings, ...) of the subroots. ``wanted`` (tree,
        at) are the leaves to prove, without repeats, else all."""
        chosen = [wanted]
        for _ in self.levels[1:]:
            chosen.append(None if wanted is None else chosen[-1].select("tree", self._block().alias("at")).distinct())
        upper = above.withColumn("at", F.lit(0).cast("bigint"))
        more = [c for c in above.columns if c not in ("tree", "siblings")]
        for j in range(len(self.levels) - 2, -1, -1):
            own = [c for c in self.levels[j].columns if c not in ("tree", "at", "height")]
            rows = self.levels[j].withColumn("block", self._block())
            if wanted is not None:
                rows = rows.join(chosen[j + 1].withColumnRenamed("at", "block"), ["tree", "block"], "left_semi")
            blocks = rows.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct("at", *own))).alias("members"), F.max("height").alias("height"))
            blocks = blocks.join(upper.withColumnRenamed("at", "block"), ["tree", "block"])
            nodes = F.array(F.transform("members", lambda m: m["leaf"]))
            levels = F.aggregate(_steps(self._left(j), self.every), nodes, lambda found, _: F.concat(found, F.array(_up(F.element_at(found, -1), self.arity))))
            blocks = blocks.withColumn("levels", levels)
            powers = F.array(*[F.lit(self.arity**k) for k in range(self.every)])

            def path(at, j=j, powers=powers):
                own = F.transform(_steps(self._left(j), self.every), lambda k: _beside(F.get("levels", k), F.floor(at / F.get(powers, k)).cast("int"), self.arity))
                return F.concat(own, F.col("siblings"))

            each = F.transform("members", lambda m, k: F.struct(m.alias("m"), path(k).alias("siblings")))
            blocks = blocks.select("tree", *more, F.explode(each).alias("x"))
            upper = blocks.select("tree", *more, F.col("x.m.at").alias("at"), "x.siblings", *([F.col(f"x.m.{c}").alias(c) for c in own] if j == 0 else []))
            if wanted is not None:
                upper = upper.join(chosen[j], ["tree", "at"], "left_semi")
        return upper


def _grow(rows: DataFrame, path: str, arity: int, every: int) -> Forest:
    """Number leaves and store every ``every``-th level below ``path``."""
    first = _numbered(rows)
    first = written(first.withColumn("height", _height(F.col("leaves"), arity)).drop("leaves"), f"{path}/level-0")
    highest = first.agg(F.max("height")).first()[0] or 0
    forest = Forest([first], arity, every)
    for j in range(max(1, -(-highest // every))):
        blocks = forest.levels[j].groupBy("tree", forest._block().alias("at")).agg(F.sort_array(F.collect_list(F.struct(F.col("at").alias("k"), "leaf"))).alias("members"), F.max("height").alias("height"))
        nodes = F.aggregate(_steps(forest._left(j), every), F.transform("members", lambda m: m["leaf"]), lambda found, _: _up(found, arity))
        forest.levels.append(written(blocks.select("tree", "at", F.get(nodes, F.lit(0)).alias("leaf"), "height"), f"{path}/level-{(j + 1) * every}"))
    return forest


class Manifest(NamedTuple):
    trees: Forest
    top: Forest
    root: str | None

    def subroots(self) -> DataFrame:
        """(tree, subroot), trees by their names."""
        return self.trees.subroots().select(tree_name(F.col("tree")).alias("tree"), "subroot")

    def proofs(self, ids: DataFrame | None = None) -> DataFrame:
        """(tree, at, id, leaf, subroot, root, siblings, ...) of all leaves, or of those whose id is in the one column of
        ``ids``; what :func:`build` took along comes as well."""
        tops = self.top.proofs(self.top.subroots().select("tree", F.array().cast("array<struct<left: string, right: string>>").alias("siblings")))
        above = tops.select(F.col("id").alias("tree"), F.col("leaf").alias("subroot"), "siblings")
        wanted = None
        if ids is not None:
            wanted = cut(self.trees.levels[0].join(ids.toDF("wanted"), F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("tree", "at"), "merkle-wanted")
        found = self.trees.proofs(above, wanted)
        own = [c for c in found.columns if c not in ("tree", "at", "siblings", "subroot", "id", "leaf")]
        return found.select(tree_name(F.col("tree")).alias("tree"), "at", "id", "leaf", "subroot", F.lit(self.root).cast("string").alias("root"), "siblings", *own)


def build(docs: DataFrame, path: str, fields: Sequence[Column], id_col: str = "doc_id", tree_col: str = "lang", also: Mapping[str, Column] | None = None, arity: int = ARITY, every: int = EVERY) -> Manifest:
    """Write the manifest of ``docs`` below ``path``, a folder that all executors share.

    ``fields`` make a leaf. ``also`` are small columns to store with it, computed while the row is at hand.
    """
    rows = docs.select(tree_key(F.col(tree_col)).alias("tree"), F.col(id_col).alias("id"), leaf_of(fields).alias("leaf"), *[c.alias(name) for name, c in (also or {}).items()])
    with cleared(docs.sparkSession):
        # The texts are hashed once: what follows reads this table.
        trees = _grow(cut(rows, "merkle-leaves"), f"{path}/trees", arity, every)
        tops = trees.subroots().select(F.lit(_ROOT).alias("tree"), F.col("tree").alias("id"), F.col("subroot").alias("leaf"))
        top = _grow(tops, f"{path}/top", arity, every)
    root = top.levels[-1].first()
    return Manifest(trees, top, root.leaf if root else None)


def opened(spark: SparkSession, path: str, arity: int = ARITY, every: int = EVERY) -> Manifest:
    """A manifest that :func:`build` has written."""

    def forest(folder: str) -> Forest:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
        marks = sorted(int(n.removeprefix("level-")) for n in names if n.startswith("level-"))
        return Forest([spark.read.parquet(f"{folder}/level-{k}") for k in marks], arity, every)

    trees, top = forest(f"{path}/trees"), forest(f"{path}/top")
    root = top.levels[-1].first()
    return Manifest(trees, top, root.leaf if root else None)
