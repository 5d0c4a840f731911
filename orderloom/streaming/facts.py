"""Order-item messages to stored facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.operators.append import BUCKETS, read_target
from orderloom.plans.star import with_customer_of_order
from orderloom.schemas import FACT_COLUMNS, FACT_KEYS, FACT_MESSAGE
from orderloom.sources.tables import Sources
from orderloom.streaming.tables import Route, stream_tables

FACT_ORDER = tuple((name, "asc") for name in FACT_COLUMNS)


def stream_facts(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    quarantine: str | None = None,
    continuous: bool = False,
    sanitize: bool = False,
    numbered: bool = False,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Append the facts in `messages` to the parquet folder `target`, once per key.

    All messages count as order items, whatever their topic. Messages that cannot be decoded
    go to `quarantine`, by default a folder beside the target. `sanitize` replaces quotes in
    the strings, for targets that need it; `numbered` adds a dense `id` that goes on from
    batch to batch. The rest is as stream_tables() says.
    """
    quarantine = quarantine or f"{target.rstrip('/')}_undecodable"
    route = Route(FACT_MESSAGE, FACT_KEYS, target, FACT_ORDER if numbered else ())
    items = messages.select(F.lit("order_items").alias("topic"), "value")
    return stream_tables(items, {"order_items": route}, checkpoint, quarantine, continuous, sanitize, buckets)


def read_facts(empty: DataFrame, target: str) -> DataFrame:
    """The stored facts, or `empty` before the first batch."""
    stored = read_target(empty, target)
    return empty if stored is None else stored.select(*empty.columns)


def enrich_facts(facts: DataFrame, src: Sources) -> DataFrame:
    """Fill in the customer, which order-item messages do not carry, through the order."""
    return with_customer_of_order(facts.drop("customer_unique_id"), src).select(*FACT_COLUMNS)
