"""Publish rows to a topic, or sort messages into parts, and say how many went where.

The counts are observed while the rows are written, so nothing is read twice. They are exact
for what the write's tasks have put out; a task that ran again because its output was lost
may count twice, which Spark's observations allow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.messages import decode, publish_envelope
from orderloom.sources.topics import keyed_messages

# Fixed value: the brokers' own limit of a message, in bytes.
MAX_BYTES = 1048588
GOOD, ERROR, UNDECODABLE = "good", "error", "undecodable"


@dataclass(frozen=True)
class Published:
    """How many messages were written to the topic, and how many could not be."""

    successes: int
    failures: int


def publish(rows: DataFrame, topic: str, write: Callable[[DataFrame], None], *, timestamp_ms: int | None = None, **options) -> Published:
    """Publish every row as an envelope; options as for publish_messages()."""
    return publish_messages(publish_envelope(rows, timestamp_ms), topic, write, **options)


def publish_messages(
    messages: DataFrame,
    topic: str,
    write: Callable[[DataFrame], None],
    *,
    key: str | None = None,
    partitions: int | None = None,
    max_bytes: int = MAX_BYTES,
    rejected: str | None = None,
) -> Published:
    """Write the messages (column `value`) to the topic in one pass and count them.

    `write` takes what keyed_messages() gives: publish_files or publish_kafka with their
    arguments bound. A message without a value or with more than `max_bytes` is a failure; one
    that is too long goes to the topic `rejected`, if that is given.
    """
    fits = F.col("value").isNotNull() & (F.octet_length("value") <= max_bytes)
    observation = Observation("published")
    observed = messages.withColumn("_fits", F.coalesce(fits, F.lit(False))).observe(
        observation, F.count_if("_fits").alias("successes"), F.count_if(~F.col("_fits")).alias("failures")
    )
    fitting = F.octet_length("value") <= max_bytes
    kept = observed.where("value IS NOT NULL") if rejected else observed.where("_fits")
    keyed = keyed_messages(kept, topic, key, partitions)
    if rejected:
        keyed = keyed.withColumn("topic", F.when(fitting, F.lit(topic)).otherwise(F.lit(rejected)))
    write(keyed)
    counted = observation.get
    return Published(counted["successes"], counted["failures"])


@dataclass(frozen=True)
class Triage:
    """How many messages could be decoded, how many of these are of type ERROR, and how many could not."""

    processed: int
    errors: int
    undecodable: int


def _sorted(messages: DataFrame) -> DataFrame:
    """value and part: good, error or undecodable."""
    decoded = decode(messages, T.StructType([T.StructField("type", T.StringType())]))
    part = F.when(F.col("undecodable"), UNDECODABLE).when(F.col("message.type") == "ERROR", ERROR).otherwise(GOOD)
    return decoded.select("value", part.alias("part"))


def _counts() -> list[Column]:
    return [
        F.count_if(F.col("part") != UNDECODABLE).alias("processed"),
        F.count_if(F.col("part") == ERROR).alias("errors"),
        F.count_if(F.col("part") == UNDECODABLE).alias("undecodable"),
    ]


def triage_to(messages: DataFrame, path: str) -> Triage:
    """Write every message to its part's folder under a new `path`, in one pass, and count the parts."""
    observation = Observation("triage")
    _sorted(messages).observe(observation, *_counts()).write.partitionBy("part").parquet(path)
    return Triage(**observation.get)


def stream_triage(messages: DataFrame, path: str, checkpoint: str, continuous: bool = False) -> StreamingQuery:
    """The same for a stream, which goes on adding to the parts; triage_totals() tells their numbers."""
    writer = _sorted(messages).observe("triage", *_counts()).writeStream.format("parquet").partitionBy("part")
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return (writer if continuous else writer.trigger(availableNow=True)).start()


def triage_totals(query: StreamingQuery) -> Triage:
    """Counts over the batches whose progress Spark still keeps (spark.sql.streaming.numRecentProgressUpdates)."""
    seen = [row for row in (p.observedMetrics.get("triage") for p in query.recentProgress) if row is not None]
    return Triage(*[sum(row[name] for row in seen) for name in ("processed", "errors", "undecodable")])
