"""Kafka-shaped rows: decoding and encoding of envelopes, routing, topics, and the Kafka source and sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ids import key_bytes, uuid_text
from tidemark.operators.counters import split
from tidemark.scratch import written_over

TYPE_HEADER, TARGET_HEADER, CORRELATION_HEADER = "nx-type", "nx-target-server", "nx-correlation-id"
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
    ]
)


def read_events_kafka(spark: SparkSession, servers: str, topics: list[str], **options: str) -> DataFrame:
    """A stream of records with headers. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "includeHeaders": "true", **options}).load()


def read_events_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the same rows from Parquet files."""
    return spark.readStream.schema(RECORD).parquet(path)


def header(name: str) -> Column:
    """Bytes of the last header of a name, or null."""
    return F.element_at(F.filter(F.concat(F.array(F.struct(F.lit(name).alias("key"), F.lit(None).cast("binary").alias("value"))), F.coalesce("headers", F.array().cast("array<struct<key: string, value: binary>>"))), lambda h: h["key"] == name), -1)["value"]


def message_type() -> Column:
    return F.decode(header(TYPE_HEADER), "utf-8")


def correlation_id() -> Column:
    return uuid_text(header(CORRELATION_HEADER))


def decode_envelope(records: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(decoded, dead): records whose JSON can't be read go to the second and stop nothing. A null value, which is
    a tombstone, is decoded as a null payload.

    A record is parsed once: the payload is a generated column, which filters on it and its fields don't repeat."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    marked = T.StructType([*schema.fields, T.StructField("__bad", T.StringType())])
    text = F.decode("value", "utf-8")
    payload = F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    parsed = records.select("*", F.explode(F.array(payload)).alias("payload"))
    bad = F.col("value").isNotNull() & (F.col("payload").isNull() | F.col("payload.__bad").isNotNull())
    return parsed.where(~bad).withColumn("payload", F.when(F.col("value").isNotNull(), F.col("payload").dropFields("__bad"))), parsed.where(bad).drop("payload")


def encode_envelope(events: DataFrame, pk: Column, payload: Column, topic: Column, msg_type: Column, deleted: Column | None = None) -> DataFrame:
    """Records of events: eight-byte key, JSON value without null fields, type header; a null value is a tombstone."""
    value = F.encode(F.to_json(payload, {"ignoreNullFields": "true"}), "utf-8")
    value = value if deleted is None else F.when(~deleted, value)
    headers = F.array(F.struct(F.lit(TYPE_HEADER).alias("key"), F.encode(msg_type, "utf-8").alias("value")))
    return events.select(key_bytes(pk).alias("key"), value.alias("value"), topic.alias("topic"), headers.alias("headers"))


def write_events(records: DataFrame, servers: str | None = None, path: str | None = None, **options: str) -> None:
    """To Kafka, or as Parquet for tests and archives."""
    if servers:
        records.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, "includeHeaders": "true", **options}).save()
    else:
        records.write.mode("append").parquet(path)


def write_batch(records: DataFrame, number: int, path: str) -> DataFrame:
    """Records of a micro-batch as Parquet in a folder of the batch: written again, a batch replaces itself, so a sink of
    such folders has each record once whatever failed in between. Returns what was written."""
    return written_over(records, f"{path}/batch={number}")


def read_batches(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """What :func:`write_batch` has written, with ``batch``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def consume(records: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, tries: int = 1, seconds: int | None = None):
    """Run ``handle`` (records, batch number) on a stream of records, of Kafka or of files. Offsets are the checkpoint's and
    move on only when ``handle`` has returned: a batch that fails ``tries`` times ends the query, and the next one on the
    same checkpoint starts at that batch's first record with the same records and number. So what ``handle`` does must be
    safe to do again, as :func:`write_batch` is. Without ``seconds`` it runs over what there is."""

    def batch(rows: DataFrame, number: int) -> None:
        for left in range(max(1, tries) - 1, -1, -1):
            try:
                return handle(rows, number)
            except Exception:
                if not left:
                    raise

    writer = records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def resolve_topics(df: DataFrame, topics: Mapping[str, str], by: str = "entity_name") -> tuple[DataFrame, DataFrame]:
    """(routed, counts): rows with their ``topic``, and (by, dropped) of those without one. The map is the caller's
    configuration, a literal of the plan."""
    book = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))]) if topics else F.lit(None).cast("map<string,string>")
    routed = df.withColumn("topic", F.try_element_at(book, F.col(by)))
    return routed.where("topic IS NOT NULL"), routed.where("topic IS NULL").groupBy(by).agg(F.count(F.lit(1)).alias("dropped"))


def resolve_topics_observed(df: DataFrame, topics: Mapping[str, str], by: str = "entity_name") -> tuple[DataFrame, Observation]:
    """:func:`resolve_topics` in one read: rows with their ``topic``, and counts of those ``kept`` and ``without_topic``."""
    book = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))]) if topics else F.lit(None).cast("map<string,string>")
    return split(df.withColumn("topic", F.try_element_at(book, F.col(by))), {"without_topic": F.col("topic").isNull()})


def entity_states(entities: DataFrame, topics: Mapping[str, str], by: str = "entity_name") -> DataFrame:
    """(by, topic, state) of the entities to sync: DEGRADED for one without a topic, as it can't be published."""
    book = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))]) if topics else F.lit(None).cast("map<string,string>")
    topic = F.try_element_at(book, F.col(by))
    return entities.select(by, topic.alias("topic"), F.when(topic.isNull(), "DEGRADED").otherwise("ACTIVE").alias("state"))


def route_by_type(records: DataFrame, known: list[str]) -> DataFrame:
    """Records of the known types with their ``msg_type``; others are skipped."""
    return records.withColumn("msg_type", message_type()).where(F.col("msg_type").isin(known))


def for_server(records: DataFrame, server_id: str) -> tuple[DataFrame, DataFrame]:
    """(mine, counts): commands whose target header names this server, and how many had another or none."""
    target = uuid_text(header(TARGET_HEADER))
    mine = F.coalesce(target == F.lit(server_id), F.lit(False))
    reason = F.when(target.isNull(), "no_target").otherwise("other_server")
    return records.where(mine), records.where(~mine).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("skipped"))


def for_server_observed(records: DataFrame, server_id: str) -> tuple[DataFrame, Observation]:
    """:func:`for_server` in one read: the commands for this server, and counts of those ``kept``, with ``no_target`` and
    for an ``other_server``."""
    target = uuid_text(header(TARGET_HEADER))
    return split(records, {"no_target": target.isNull(), "other_server": target != F.lit(server_id)})
