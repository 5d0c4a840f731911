"""Messages of one or more topics to stored tables, each key once, in one streaming query.

The query's state, in RocksDB on the executors' disks, knows every key it has passed on. So
repeats within the stream are found without reading what is stored; only keys that another run
has written are looked up, in the buckets that a batch touches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.messages import decode_topics
from orderloom.functions.text import clean
from orderloom.operators.append import BUCKETS, append_unseen, write_bucketed, write_run
from orderloom.operators.numbering import number_batch
from orderloom.schemas import KEYS, SOURCE_TABLES, TABLES
from orderloom.session import settings

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the keys costs one more read for each of them.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
KEY = "_key"


@dataclass(frozen=True)
class Route:
    """Where the rows of a topic go. `id_order` gives them ids that stay, in this order within a batch."""

    schema: T.StructType
    keys: list[str]
    target: str
    id_order: tuple[tuple[str, str], ...] = ()


def source_routes(root: str, topics: list[str] | None = None) -> dict[str, Route]:
    """Routes of the declared source tables: topic `orders` goes to `<root>/src_orders`."""
    named = {name.removeprefix("src_"): name for name in SOURCE_TABLES}
    return {
        topic: Route(TABLES[named[topic]], KEYS[named[topic]][0], f"{root.rstrip('/')}/{named[topic]}")
        for topic in (topics or named)
    }


def unseen_rows(messages: DataFrame, routes: dict[str, Route], sanitize: bool = False) -> DataFrame:
    """topic, value, undecodable, a struct `row_<n>` for the n-th route: the first message of each key.

    Messages that cannot be decoded and rows with an incomplete key are all passed on. Of
    repeats the first to arrive is taken; of those that arrive at once from several files or
    topic partitions it may be any.
    """
    decoded = decode_topics(messages, {topic: route.schema for topic, route in routes.items()})
    rows, key = {}, None
    for n, (topic, route) in enumerate(routes.items()):
        path = f"message_{n}.data"
        values = [_value(f"{path}.{field.name}", field, sanitize) for field in route.schema.fields]
        # A message without data is a row of NULLs.
        rows[f"row_{n}"] = F.when(F.col("topic") == topic, F.struct(*values))
        here = F.when(F.col("topic") == topic, _key(f"row_{n}", route.keys))
        key = here if key is None else F.coalesce(key, here)
    shown = decoded.select("topic", "value", "undecodable", *[value.alias(name) for name, value in rows.items()])
    # What cannot be a repeat gets a key that nothing else has.
    keyed = shown.withColumn(KEY, F.coalesce(F.when(~F.col("undecodable"), key), F.concat(F.lit("-"), F.uuid())))
    return keyed.dropDuplicates(["topic", KEY]).drop(KEY)


def _value(path: str, field: T.StructField, sanitize: bool) -> Column:
    value = F.col(path)
    return (clean(value, field.dataType) if sanitize else value).alias(field.name)


def _key(row: str, keys: list[str]) -> Column:
    """The key as text, NULL if a part is missing."""
    parts = [F.col(f"{row}.{name}") for name in keys]
    whole = parts[0].isNotNull()
    for part in parts[1:]:
        whole = whole & part.isNotNull()
    return F.when(whole, F.to_json(F.struct(*parts)))


def stream_tables(
    messages: DataFrame,
    routes: dict[str, Route],
    checkpoint: str,
    quarantine: str,
    continuous: bool = False,
    sanitize: bool = False,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append the rows in `messages` (topic, value) to the targets of their topics, once per key.

    By default the query takes what is there and ends. Offsets, state and batch ids live in
    `checkpoint`; the query id kept there marks the rows of this stream in the targets, so a
    batch that runs again overwrites its own. Messages that cannot be decoded, and those of
    topics without a route, go to `quarantine`. The state has as many partitions as
    spark.sql.shuffle.partitions says when the checkpoint is new.
    """
    spark = messages.sparkSession
    names = list(routes)

    def store(batch: DataFrame, batch_id: int) -> None:
        ingest_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            good = F.when(~F.col("undecodable"), F.col("topic"))
            present = {row[0] for row in batch.select(good).distinct().collect()}
            for topic in present.intersection(names):
                route, column = routes[topic], f"row_{names.index(topic)}"
                rows = batch.where(~F.col("undecodable") & (F.col("topic") == topic)).select(f"{column}.*")
                if route.id_order:
                    empty = rows.withColumn("id", F.lit(0).cast("bigint")).select("id", *rows.columns)
                    rows = append_unseen(empty, route.target, route.keys, ingest_id, batch_id, buckets).drop("id")
                    rows = number_batch(rows, route.target, list(route.id_order), ingest_id, batch_id)
                else:
                    rows = append_unseen(rows, route.target, route.keys, ingest_id, batch_id, buckets)
                write_bucketed(rows, route.target, route.keys, ingest_id, batch_id, buckets)
            if None in present:
                write_run(batch.where("undecodable").select("topic", "value"), quarantine, ingest_id, batch_id)
        finally:
            batch.unpersist()

    writer = unseen_rows(messages, routes, sanitize).writeStream.foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    with settings(spark, STATE_SETTINGS):
        return (writer if continuous else writer.trigger(availableNow=True)).start()
