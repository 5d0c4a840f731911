"""Message topics: Kafka where its connector is installed, or folders of gzip text files.

A folder topic is `<root>/topic=<name>/`, one message per line. Both kinds give the columns
`topic` and `value`, and everything behind this module is the same for both.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_OFFSETS = 5_000_000  # messages of a stream's batch, so that a first batch does not hold a whole topic
# Delivery settings of the producer.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.compression.type": "gzip"}


def keyed_messages(
    messages: DataFrame, topic: str, key: str | None = None, partitions: int | None = None
) -> DataFrame:
    """Columns `topic`, `key`, `value` and, if `partitions` is given, `partition`.

    The key is the column named by `key`, else the topic's name. One key means one topic
    partition, so give `partitions` with it: rows are then spread over them by content.
    """
    keyed = messages.select(
        F.lit(topic).alias("topic"),
        (F.col(key).cast("string") if key else F.lit(topic)).alias("key"),
        F.col("value"),
    )
    if partitions is None:
        return keyed
    return keyed.withColumn("partition", F.pmod(F.xxhash64("value"), F.lit(partitions)).cast("int"))


def kafka_sink_options(servers: list[str], client_id: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": ",".join(servers), "kafka.client.id": client_id, **PRODUCER_OPTIONS}


def kafka_source_options(
    servers: list[str], topics: str | list[str], partitions: dict[str, list[int]] | None = None
) -> dict[str, str]:
    """Read from the earliest offset: all partitions of the topics, or the assigned ones."""
    options = {"kafka.bootstrap.servers": ",".join(servers), "startingOffsets": "earliest"}
    if partitions is not None:
        return {**options, "assign": json.dumps(partitions)}
    return {**options, "subscribe": topics if isinstance(topics, str) else ",".join(topics)}


def publish_kafka(keyed: DataFrame, servers: list[str], client_id: str = "producer") -> None:
    keyed.write.format("kafka").options(**kafka_sink_options(servers, client_id)).save()


def publish_files(keyed: DataFrame, root: str, files: int | None = None) -> None:
    """Append the messages to the folder topics under `root`.

    A packed file is read by one task, so ask for as many `files` a topic as tasks shall read.
    """
    if files:
        keyed = keyed.repartition(files, F.xxhash64("value"))
    lines = keyed.select("topic", "value")
    lines.write.mode("append").partitionBy("topic").option("compression", "gzip").text(root)


def read_kafka(
    spark: SparkSession,
    servers: list[str],
    topics: str | list[str],
    partitions: dict[str, list[int]] | None = None,
    stream: bool = True,
    **options: Any,
) -> DataFrame:
    """Messages of Kafka topics, with Kafka's columns; a stream takes at most MOST_OFFSETS at once unless told otherwise."""
    reader = spark.readStream.option("maxOffsetsPerTrigger", MOST_OFFSETS) if stream else spark.read
    reader = reader.format("kafka").options(**kafka_source_options(servers, topics, partitions), **options)
    return reader.load()


def read_files(
    spark: SparkSession,
    root: str,
    topics: str | list[str],
    stream: bool = True,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """Messages of one or more folder topics, all files from the first on."""
    wanted = [topics] if isinstance(topics, str) else topics
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if stream else spark.read
    messages = reader.schema("value string, topic string").format("text").load(root)
    return messages.where(F.col("topic").isin(wanted)).select("topic", "value")
