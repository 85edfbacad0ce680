"""Look-ups in tables of ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import cut

#: Rows of a rule table up to which it is a constant of the plan, one sorted array.
SHORT_TABLE = 10_000
_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def bracket_lookup(rows: DataFrame, steps: DataFrame, level: str) -> DataFrame:
    """Rows with ``value`` of the step (from, to, value) that holds their level; steps don't overlap, and a null ``to``
    is open. Of a table of up to SHORT_TABLE steps each row's step is found by halving a sorted array, in as many looks as the
    logarithm of its length; a longer one is merged with the distinct levels in their order, and rows join their level."""
    if steps.limit(SHORT_TABLE + 1).count() <= SHORT_TABLE:
        table = sorted_steps(steps)
        step = F.get(table[0], _last_at_or_below(*table, F.col(level)))
        return rows.withColumn("value", F.when(step["to"].isNull() | (F.col(level) <= step["to"]), step["value"]))
    levels = rows.select(F.col(level).alias("__level")).where(F.col(level).isNotNull()).distinct()
    found = _as_of(levels, steps.select(F.col("from").alias("__at"), F.struct("to", "value").alias("__s")), "__level")
    found = found.select("__level", F.when(F.col("__s.to").isNull() | (F.col("__level") <= F.col("__s.to")), F.col("__s.value")).alias("value"))
    return rows.join(found, F.col(level) == F.col("__level"), "left").drop("__level")


def sorted_steps(steps: DataFrame) -> tuple[Column, int]:
    """(from, to, value) of a short table as a constant array in the order of ``from``, and its length."""
    kind = steps.select(F.collect_list(F.struct("from", "to", "value")).alias("s"))
    found = kind.select(F.to_json(F.array_sort("s"), _TIMES).alias("text"), F.size("s").alias("n")).first()
    return F.from_json(F.lit(found.text), kind.schema["s"].dataType, _TIMES), found.n


def _last_at_or_below(table: Column, n: int, level: Column) -> Column:
    """Index of the last step that starts at or below a level; -1 if none does, and for a null level."""
    middle = lambda span: F.shiftright(span["lo"] + span["hi"], 1)
    span = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    halve = lambda s, _: F.when(s["lo"] >= s["hi"], s).when(F.get(table, middle(s))["from"] <= level, span(middle(s) + 1, s["hi"])).otherwise(span(s["lo"], middle(s)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, n.bit_length()))), span(F.lit(0), F.lit(n)), halve)["lo"] - 1


def _as_of(rows: DataFrame, table: DataFrame, level: str) -> DataFrame:
    """Rows with ``__s`` of the last row of ``table`` (__at, __s) at or below their level, null below all. Both are dealt
    out by level in ranges; the first rows of a range take the last step of the ranges before it."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    steps = table.select(F.col("__at").alias("__l"), F.lit(0).alias("__kind"), "__s", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    own = rows.select(F.col(level).alias("__l"), F.lit(1).alias("__kind"), F.lit(None).cast(table.schema["__s"].dataType).alias("__s"), *[F.col(c) for c in rows.columns])
    dealt = cut(steps.unionByName(own).repartitionByRange(n, "__l").withColumn("__part", F.spark_partition_id()), "as-of")
    carry = dealt.where("__kind = 0").groupBy("__part").agg(F.max_by(F.struct(F.col("__l").alias("l"), F.col("__s").alias("s")), "__l").alias("__c"))
    # One row a partition: the last step of those before it.
    carry = carry.withColumnRenamed("__part", "__from")
    parts = rows.sparkSession.range(n).select(F.col("id").cast("int").alias("__part"))
    carry = parts.join(F.broadcast(carry), F.col("__from") < F.col("__part"), "left").groupBy("__part").agg(F.max_by("__c", F.col("__c.l")).alias("__c"))
    order = Window.partitionBy("__part").orderBy(F.col("__l").asc_nulls_first(), "__kind").rowsBetween(Window.unboundedPreceding, 0)
    both = dealt.join(F.broadcast(carry), "__part").withColumn("__s", F.coalesce(F.last("__s", ignorenulls=True).over(order), F.col("__c.s")))
    return both.where("__kind = 1").withColumn("__s", F.when(F.col("__l").isNotNull(), F.col("__s"))).select(*rows.columns, "__s")
