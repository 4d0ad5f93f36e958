"""Kafka source and sink. The connector package has to be on the cluster's class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def source_options(servers: Sequence[str], topics: Sequence[str], group_id: str | None = None,
                   max_per_trigger: int | None = None, starting: str = "latest",
                   fail_on_data_loss: bool = True, **kafka: str) -> dict[str, str]:
    """Options of the Kafka source; extra settings are passed on as ``kafka.*``. A stream whose messages
    are gone before they were read fails, unless the caller accepts that loss."""
    if not servers or not topics:
        raise ValueError("servers and topics are needed")
    opts = {"kafka.bootstrap.servers": ",".join(servers), "subscribe": ",".join(topics),
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return opts | {f"kafka.{k.replace('_', '.')}": str(v) for k, v in kafka.items()}


def kafka_source(spark: SparkSession, servers: Sequence[str], topics: Sequence[str], schema: str,
                 group_id: str | None = None, filter_empty: bool = True, metadata: bool = False,
                 max_per_trigger: int | None = None, **kafka: str) -> DataFrame:
    """Stream of JSON messages as columns of ``schema``; ``metadata`` keeps topic, partition, offset
    and time."""
    raw = spark.readStream.format("kafka").options(
        **source_options(servers, topics, group_id, max_per_trigger, **kafka)).load()
    return decode(raw, schema, filter_empty, metadata)


def decode(raw: DataFrame, schema: str, filter_empty: bool = True, metadata: bool = False) -> DataFrame:
    """Message rows (``value`` and the Kafka columns) to sample rows."""
    rows = raw.filter(F.length("value") > 0) if filter_empty else raw
    extra = ["topic", "partition", "offset", "timestamp"] if metadata else []
    out = rows.select(F.from_json(F.col("value").cast("string"), schema).alias("_m"), *extra)
    return (out.filter("_m is not null") if filter_empty else out).select("_m.*", *extra)


def plain_source(spark: SparkSession, servers: Sequence[str], topics: Sequence[str],
                 group_id: str | None = None) -> DataFrame:
    """Raw payloads as text. Run it with ``trigger(availableNow=True)`` to stop at the end."""
    return spark.readStream.format("kafka").options(
        **source_options(servers, topics, group_id, starting="earliest")).load().select(
        F.col("value").cast("string").alias("value"))


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows to messages: JSON value and optional key."""
    cols = [F.to_json(F.struct("*")).alias("value")]
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), *cols)


def kafka_sink(df: DataFrame, servers: Sequence[str], topic: str, checkpoint: str, key: str | None = None):
    """Started streaming query that produces ``df`` to a topic."""
    return (encode(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", ",".join(servers))
            .option("topic", topic).option("checkpointLocation", checkpoint).start())
