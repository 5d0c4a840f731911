"""The queries the driver runs: one per operator, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.messages import parse_envelope, publish_batch_stats, publish_envelope, triage_messages
from orderloom.functions.temporal import micros
from orderloom.functions.text import sanitize_values
from orderloom.operators.append import append_if_absent, write_run
from orderloom.operators.keys import declared_key_violations, key_violations
from orderloom.operators.numbering import number_batch
from orderloom.plans import reports, star, stored
from orderloom.plans.reports import REPORTS, materialize_report, read_report
from orderloom.schemas import FACT_COLUMNS, FACT_KEYS, FACT_MESSAGE, MONEY
from orderloom.session import PARTITIONS, scratch_path, store, tune
from orderloom.sources.csv_files import read_source_csv, write_source_csv
from orderloom.sources.publish import publish_messages, triage_to
from orderloom.sources.tables import Sources, create_source_tables, load_source_tables
from orderloom.sources.topics import keyed_messages, publish_files, read_files
from orderloom.streaming.facts import FACT_ORDER, stream_facts
from orderloom.streaming.tables import source_routes, stream_tables
from orderloom.testbed.adapter import DriverSources, table
from orderloom.testbed.primitives import PRIMITIVES
from orderloom.testbed.shown import SHOWN

Query = Callable[[SparkSession, str], DataFrame]
SENT = 1700000000000  # a fixed time of sending, in ms
IS_DELIVERED = "is_delivered"
YEAR = 2000  # the report's own default, 2018, lies outside the driver's data


def plain(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both sides of a comparison have the same type."""
    decimals = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return rows.withColumns({name: F.col(name).cast("double") for name in decimals})


# -- ingestion ---------------------------------------------------------------------------


def _item_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_envelope(DriverSources(spark, sf_dir, numbered=True).order_items, SENT)


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "csv")
    write_source_csv(DriverSources(spark, sf_dir, numbered=True).order_items, folder)
    items = read_source_csv(spark, folder, "src_order_items")
    return items.withColumns({name: F.col(name).cast(MONEY) for name in ("price", "freight_value")})


def _envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = publish_envelope(DriverSources(spark, sf_dir).orders, SENT)

    def field(path: str):
        return F.get_json_object("value", f"$.{path}")

    return messages.select(
        field("timestamp").cast("bigint").alias("timestamp"),
        *[field(f"data.{name}").alias(name) for name in ("order_id", "customer_id", "order_status")],
        field("data.order_purchase_timestamp").alias("purchased"),
        field("data.order_delivered_customer_date").alias("delivered"),
        F.col("value").contains('"order_delivered_customer_date":null').alias("writes_null"),
    )


def _sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "topics")
    publish_files(keyed_messages(_item_messages(spark, sf_dir), "order_items"), root)
    stored = read_files(spark, root, "order_items", stream=False)
    facts = parse_envelope(stored, FACT_MESSAGE)
    return facts.select(F.lit("order_items").alias("topic"), "order_id", "order_item_id", "product_id", "price")


def _batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages; an error event has no body."""
    body = F.when(F.col("event_type") != "error", F.to_json(F.struct("event_id", "value")))
    return publish_batch_stats(table(spark, sf_dir, "events").select(body.alias("value")))


def _publish_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events published with their counts; what is in the topic, beside what publishing has counted."""
    root = scratch_path(spark, "topics")
    body = F.when(F.col("event_type") != "error", F.to_json(F.struct("event_id", "value")))
    events = table(spark, sf_dir, "events").select(body.alias("value"))
    counted = publish_messages(events, "events", partial(publish_files, root=root))
    stored = read_files(spark, root, "events", stream=False)
    return stored.select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.lit(counted.successes).cast("bigint").alias("successes"),
        F.lit(counted.failures).cast("bigint").alias("failures"),
    )


def _topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics published, then subscribed to together."""
    src, root, sink = DriverSources(spark, sf_dir), scratch_path(spark, "topics"), scratch_path(spark, "received")
    publish_files(keyed_messages(publish_envelope(src.orders, SENT), "orders"), root)
    publish_files(keyed_messages(publish_envelope(src.sellers, SENT), "sellers"), root)
    received = read_files(spark, root, ["orders", "sellers"])
    writer = received.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "offsets"))
    writer.trigger(availableNow=True).start(sink).awaitTermination()
    ids = [F.get_json_object("value", f"$.data.{name}") for name in ("order_id", "seller_id")]
    return spark.read.schema("topic string, value string").parquet(sink).select("topic", F.coalesce(*ids).alias("id"))


def _parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_envelope(_item_messages(spark, sf_dir), FACT_MESSAGE)


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages; a signup loses the end of its JSON."""
    events = table(spark, sf_dir, "events")
    whole = F.to_json(F.struct(F.upper("event_type").alias("type"), F.struct("event_id", "value").alias("data")))
    cut = F.substring(whole, F.lit(1), F.length(whole) - 2)
    return events.select(F.when(F.col("event_type") == "signup", cut).otherwise(whole).alias("value"))


def _triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage_messages(_event_messages(spark, sf_dir))


def _triage_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of every part as stored, beside the numbers counted in the same pass."""
    path = scratch_path(spark, "parts")
    counted = triage_to(_event_messages(spark, sf_dir), path)
    return spark.read.schema("value string, part string").parquet(path).select(
        "part",
        F.regexp_extract("value", '"event_id":([0-9]+)', 1).cast("bigint").alias("event_id"),
        *[F.lit(getattr(counted, f.name)).cast("bigint").alias(f.name) for f in fields(counted)],
    )


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, target = scratch_path(spark, "topics"), scratch_path(spark, "facts")
    publish_files(keyed_messages(_item_messages(spark, sf_dir), "order_items"), root, files=72)
    messages = read_files(spark, root, "order_items", files_per_trigger=24)
    stream_facts(messages, target, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(target).select(*FACT_COLUMNS)


def _stream_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics, each published twice over, streamed to their tables by one query."""
    src, root, tables = DriverSources(spark, sf_dir), scratch_path(spark, "topics"), scratch_path(spark, "tables")
    shown = {"orders": ["order_id", "order_status"], "sellers": ["seller_id", "seller_state"], "customers": ["customer_id", "customer_state"]}
    for topic in shown:
        messages = publish_envelope(getattr(src, topic), SENT)
        publish_files(keyed_messages(messages.unionAll(messages), topic), root, files=24)
    received = read_files(spark, root, list(shown), files_per_trigger=24)
    offsets, bad = scratch_path(spark, "offsets"), scratch_path(spark, "undecodable")
    stream_tables(received, source_routes(tables, list(shown)), offsets, bad).awaitTermination()
    parts = []
    for topic, columns in shown.items():
        stored = spark.read.parquet(f"{tables}/src_{topic}")
        named = [F.col(column).alias(name) for column, name in zip(columns, ("id", "detail"), strict=True)]
        parts.append(stored.select(F.lit(f"src_{topic}").alias("table_name"), *named))
    return reduce(DataFrame.unionAll, parts)


def _marked(rows: DataFrame, src: Sources) -> DataFrame:
    """Whether a row's order is among the delivered ones, beside each row."""
    delivered = src.orders.where("order_status = 'delivered'").select("order_id").distinct().withColumn(IS_DELIVERED, F.lit(True))
    return rows.join(delivered, "order_id", "left").withColumn(IS_DELIVERED, F.coalesce(IS_DELIVERED, F.lit(False)))


def _append_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of delivered orders get the first ids, all others go on behind them; the second batch runs twice."""
    target, src = scratch_path(spark, "facts"), DriverSources(spark, sf_dir, numbered=True, kept=True)
    facts = star.facts_order_items(src)
    delivered = src.orders.where("order_status = 'delivered'").select("order_id")
    batches = [facts.join(delivered, "order_id", how).select(*FACT_COLUMNS) for how in ("left_semi", "left_anti")]
    for batch_id in (0, 1, 1):
        numbered = number_batch(batches[batch_id], target, list(FACT_ORDER), "run", batch_id)
        write_run(numbered, target, "run", batch_id)
    return spark.read.parquet(target).select("id", *FACT_COLUMNS)


def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of delivered orders first, then all facts twice over, and each order's first item without its keys."""
    target, src = scratch_path(spark, "facts"), DriverSources(spark, sf_dir, numbered=True)
    found = star.with_customer_of_order(_marked(src.order_items, src), src).select(*FACT_COLUMNS, IS_DELIVERED)
    found = store(found, "found")
    facts = found.drop(IS_DELIVERED)
    append_if_absent(found.where(IS_DELIVERED).drop(IS_DELIVERED), target, FACT_KEYS, "first", 0)
    lost = facts.where("order_item_id = 1").withColumns({key: F.lit(None).cast(facts.schema[key].dataType) for key in FACT_KEYS})
    append_if_absent(facts.unionByName(facts).unionByName(lost), target, FACT_KEYS, "second", 0)
    return spark.read.parquet(target).select(*FACT_COLUMNS)


def _sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat("lang", F.lit("'s "), "source").alias("source"),
        "text",
        F.col("n_chars").cast("string").alias("n_chars"),
    )
    return sanitize_values(raw, T.StructType.fromDDL("doc_id bigint, source string, text string, n_chars bigint"))


def _tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tables")
    database = "orderloom_" + folder.rsplit("-", 1)[1]
    names = create_source_tables(spark, database, folder)
    src = DriverSources(spark, sf_dir, numbered=True)
    load_source_tables(src, database)
    star.facts_surrogate_id(star.facts_order_items(src)).write.insertInto(f"{database}.facts_order_items")
    counts = [
        spark.table(name).agg(F.count("*").alias("row_count"))
        .select(F.lit(name.split(".")[1]).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionAll, counts)


def _violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared key of the source tables, and one that the raw item table breaks."""
    raw = key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).agg(
        F.count("*").alias("keys_repeated"), F.sum("copies").alias("rows_concerned")
    )
    labels = [F.lit("lineitem").alias("table_name"), F.lit("l_orderkey, l_linenumber").alias("key")]
    declared = declared_key_violations(DriverSources(spark, sf_dir, numbered=True).named())
    return raw.select(*labels, "keys_repeated", "rows_concerned").unionAll(declared)


INGEST: dict[str, Query] = {
    "read_source_csv": _csv,
    "publish_envelope": _envelope,
    "publish_sink": _sink,
    "publish_batch_stats": _batch_stats,
    "publish_counted": _publish_counted,
    "read_topic": _topics,
    "parse_envelope": _parse,
    "triage_messages": _triage,
    "triage_parts": _triage_parts,
    "stream_facts": _stream,
    "stream_tables": _stream_tables,
    "append_if_absent": _append,
    "append_numbered": _append_numbered,
    "sanitize_values": _sanitize,
    "create_source_tables": _tables,
    "key_violations": _violations,
}

# -- star schema and reports -------------------------------------------------------------


def _of_sources(plan: Callable[[star.Sources], DataFrame], numbered: bool = False) -> Query:
    return lambda spark, sf_dir: plan(DriverSources(spark, sf_dir, numbered))


def _of_star(plan: Callable[[star.Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(star.SourceStar(DriverSources(spark, sf_dir)))


STAR: dict[str, Query] = {
    "facts_order_items": _of_sources(star.facts_order_items, numbered=True),
    "facts_surrogate_id": _of_sources(lambda src: star.facts_surrogate_id(star.facts_order_items(src)), numbered=True),
    "dimension_order_data": _of_sources(star.dimension_order_data),
    "dimension_product_data": _of_sources(star.dimension_product_data),
    "dimension_seller_data": _of_sources(star.dimension_seller_data),
    "staging_customers_deliveries": _of_star(star.staging_customers_deliveries),
}


def _period_in_seconds(of: star.Star) -> DataFrame:
    """The report's interval column as seconds, which both engines can show."""
    return _seconds(reports.orders_avg_period(of))


def _seconds(periods: DataFrame) -> DataFrame:
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    seconds = micros(day + F.col("interval"), day).cast("double") / 1e6
    return periods.select("customer_unique_id", seconds.alias("interval_seconds"))


PARAMETERS = {"analytics_cumulative_product_sales": {"year": YEAR}}

ANALYTICS: dict[str, Query] = {
    name.removeprefix("analytics_"): _of_star(partial(report, **PARAMETERS.get(name, {})))
    for name, report in REPORTS.items()
}
ANALYTICS["orders_avg_period"] = _of_star(_period_in_seconds)


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[Sources, Sources]:
    """The sources in two parts: delivered orders with their items, and all the rest; both are stored with their part."""
    src = DriverSources(spark, sf_dir, numbered=True)
    items = store(_marked(src.order_items, src), "items")
    parts = {"order_items": items, "orders": store(_marked(src.orders_of(items), src), "orders")}

    def part(delivered: Column) -> Sources:
        own = {name: rows.where(delivered).drop(IS_DELIVERED) for name, rows in parts.items()}
        return Sources(**{**{f.name: getattr(src, f.name) for f in fields(Sources)}, **own})

    return part(F.col(IS_DELIVERED)), part(~F.col(IS_DELIVERED))


def _stored_in_two_loads(spark: SparkSession, sf_dir: str) -> stored.StoredStar:
    root = scratch_path(spark, "star")
    first, second = _two_loads(spark, sf_dir)
    stored.write_star(first, root)
    stored.extend_star(second, root, "second")
    return stored.StoredStar(spark, root)


def _materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the star in two loads, store every report over it, and show what is stored."""
    of = _stored_in_two_loads(spark, sf_dir)
    for name in REPORTS:
        materialize_report(of, name, of.root, **PARAMETERS.get(name, {}))

    def shown(name: str) -> DataFrame:
        rows = read_report(spark, f"analytics_{name}", of.root)
        label, amount = SHOWN[name]
        if name == "orders_avg_period":
            rows = _seconds(rows)
        label = F.col(label) if label else F.lit(None).cast("string")
        return rows.select(F.lit(name).alias("report"), label.alias("label"), F.col(amount).cast("double").alias("amount"))

    return reduce(DataFrame.unionAll, [shown(name) for name in SHOWN])


def _stored_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and months of the facts stored in two loads."""
    return _stored_in_two_loads(spark, sf_dir).facts.select("id", *FACT_COLUMNS, stored.MONTH, stored.LOAD).withColumn(
        stored.MONTH, F.col(stored.MONTH).cast("timestamp_ntz")
    )


def _stored_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "staging")
    of = star.SourceStar(DriverSources(spark, sf_dir))
    return spark.read.parquet(stored.write_staging(of, root)).drop(stored.MONTH)


def _primitive(query: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(partial(table, spark, sf_dir))


def _ready(query: Query) -> Query:
    return lambda spark, sf_dir: plain(query(tune(spark, PARTITIONS), sf_dir))


QUERIES: dict[str, Query] = {
    key: _ready(query)
    for key, query in {
        **INGEST,
        **STAR,
        **ANALYTICS,
        "materialize_report": _materialize,
        "stored_facts": _stored_facts,
        "stored_staging": _stored_staging,
        **{key: _primitive(query) for key, (query, _) in PRIMITIVES.items()},
    }.items()
}
