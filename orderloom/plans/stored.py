"""A stored star: the fact by month of purchase, and sums over it that later loads keep right.

    facts_order_items/       fact with its order's columns, a folder a month and load
    monthly_sums/            sums per month: of sellers and products, and of customers
    dimension_*/             dimensions, a folder a load

The fact carries its order's columns, so no report joins the order dimension, and a report
about a period opens only the months it touches. The sums have one row per month, seller and
product, and one per month, customer, month of delivery and status; all reports about all of
history read them instead of the fact. A load adds to the fact and computes the sums of the
months it touches anew, so running a load again leaves the same tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.numeric import sum_cents
from orderloom.functions.temporal import months, truncate
from orderloom.operators.numbering import first_id, marks_path, number_batch
from orderloom.plans.star import (
    DELIVERY,
    PURCHASE,
    Star,
    customers_orders,
    dimension_product_data,
    dimension_seller_data,
    item_lines,
    staging_customers_deliveries,
)
from orderloom.schemas import DELIVERED, FACT_COLUMNS, ORDER_COLUMNS, TABLES
from orderloom.session import settings
from orderloom.sources.tables import Sources

MONTH, LOAD = "purchase_month", "load"
FACTS, SUMS, STAGING = "facts_order_items", "monthly_sums", "staging_customers_deliveries"
FIRST_LOAD = "first"

_time = T.TimestampNTZType()
_PARTITIONS = [T.StructField(MONTH, T.DateType()), T.StructField(LOAD, T.StringType())]
_ORDER_FIELDS = [field for field in TABLES["src_orders"].fields if field.name in ORDER_COLUMNS]
FACT_SCHEMA = T.StructType([*TABLES["facts_order_items"].fields, *_ORDER_FIELDS, *_PARTITIONS])
SUM_SCHEMA = (
    "seller_id string, product_id string, customer_unique_id string, delivery_month timestamp_ntz, order_status string,"
    " cents bigint, prices bigint, orders bigint, last_delivery timestamp_ntz, first_purchase timestamp_ntz,"
    f" last_purchase timestamp_ntz, kind string, {MONTH} date"
)
BY_PRODUCT, BY_CUSTOMER = "product", "customer"
# Aggregates of sorted rows go group by group.
SORTED = {"spark.sql.execution.replaceHashWithSortAgg": "true"}
DIMENSIONS = {"dimension_order_data": "order_id", "dimension_product_data": "product_id", "dimension_seller_data": "seller_id"}


class StoredStar(Star):
    """The star under `root`; what has no sum of its own is read from the months of the fact it concerns."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.facts = spark.read.schema(FACT_SCHEMA).parquet(f"{self.root}/{FACTS}")
        self.sums = spark.read.schema(SUM_SCHEMA).parquet(f"{self.root}/{SUMS}")
        self.orders = self._dimension("dimension_order_data").drop("customer_unique_id")
        self.products = self._dimension("dimension_product_data")
        self.sellers = self._dimension("dimension_seller_data")

    def _dimension(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}").drop(LOAD)

    def lines(
        self, with_customer: bool = False, how: str = "left", since: Column | None = None, before: Column | None = None
    ) -> DataFrame:
        customer = ["customer_unique_id"] if with_customer else []
        facts = _months(self.facts, since, before)
        if since is not None:
            facts = facts.where(F.col(PURCHASE) >= since)
        if before is not None:
            facts = facts.where(F.col(PURCHASE) < before)
        lines = facts.select("order_id", "product_id", "seller_id", *customer, "price", *ORDER_COLUMNS)
        return lines if how == "left" else lines.where("order_id IS NOT NULL")

    def per_order(self) -> DataFrame:
        """An order's items lie in one month, so neither its customer nor its columns need a join."""
        same = [F.max(name).alias(name) for name in ("customer_unique_id", *ORDER_COLUMNS)]
        return self.facts.groupBy("order_id").agg(sum_cents("price").alias("order_cents"), *same)

    def sales(self, *keys: str, since: Column | None = None, before: Column | None = None) -> DataFrame:
        sums = _months(self._sums(BY_PRODUCT), since, before, exact=True)
        sums = sums.withColumn("month", F.col(MONTH).cast(_time))
        return sums.groupBy(*keys).agg(F.sum("cents").alias("cents"), F.sum("prices").alias("prices"))

    def months_to_compare(self, number: int) -> Column:
        latest = self._sums(BY_PRODUCT).agg((F.max(MONTH).cast(_time) - months(number - 1)).alias("start"))
        return latest.scalar()

    def order_counts(self) -> DataFrame:
        counted = self._sums(BY_PRODUCT).where("orders > 0")
        return counted.select(F.col(MONTH).cast(_time).alias("month"), "seller_id", "product_id", "orders")

    def by_customer(self, *keys: str, delivered_only: bool = False) -> DataFrame:
        sums = self._sums(BY_CUSTOMER).withColumn("month", F.col("delivery_month"))
        if delivered_only:
            sums = sums.where(F.col("order_status") == DELIVERED)
        return sums.groupBy(*keys).agg(
            F.sum("cents").alias("cents"),
            F.sum("orders").alias("orders"),
            F.max("last_delivery").alias("last_delivery"),
            F.min("first_purchase").alias("first_purchase"),
            F.max("last_purchase").alias("last_purchase"),
            F.sum(F.when(F.col(MONTH).isNull(), 0).otherwise(F.col("orders"))).alias("dated"),
        )

    def _sums(self, kind: str) -> DataFrame:
        return self.sums.where(F.col("kind") == kind)


def _months(rows: DataFrame, since: Column | None, before: Column | None, exact: bool = False) -> DataFrame:
    """Rows in the months from `since` to `before`, found by the folders' names; `exact` bounds are starts of months."""
    if since is not None:
        rows = rows.where(F.col(MONTH) >= F.trunc(since.cast("date"), "month"))
    if before is not None:
        end = before.cast("date")
        rows = rows.where(F.col(MONTH) < end if exact else F.col(MONTH) <= end)
    return rows


def write_star(src: Sources, root: str, load: str = FIRST_LOAD) -> None:
    """Store the star under `root` in place of what is there."""
    orders = customers_orders(src).select("order_id", "customer_unique_id", *ORDER_COLUMNS)
    dimensions = [orders, dimension_product_data(src), dimension_seller_data(src)]
    for name, rows in zip(DIMENSIONS, dimensions, strict=True):
        rows.withColumn(LOAD, F.lit(load)).write.mode("overwrite").partitionBy(LOAD).parquet(f"{root}/{name}")
    spark = orders.sparkSession
    # Ids start anew.
    empty = spark.createDataFrame([], "first_id bigint, row_count bigint, ingest_id string, batch_id bigint")
    empty.write.mode("overwrite").parquet(marks_path(f"{root}/{FACTS}"))
    known = spark.read.parquet(f"{root}/dimension_order_data").drop(LOAD)
    _write_facts(item_lines(src.order_items, known), root, load, "static")
    refresh_sums(spark, root, None)


def extend_star(src: Sources, root: str, load: str) -> None:
    """Add a load: its items, and the orders, products and sellers that are not stored yet.

    Items must be new; they find their orders among the load's and the stored ones. The ids of
    stored facts stay, new ones go on behind them. A load that runs again under its name, with
    the same rows, leaves the same tables. One writer per star.
    """
    orders = customers_orders(src).select("order_id", "customer_unique_id", *ORDER_COLUMNS)
    dimensions = [orders, dimension_product_data(src), dimension_seller_data(src)]
    spark = orders.sparkSession
    for (name, key), rows in zip(DIMENSIONS.items(), dimensions, strict=True):
        others = spark.read.parquet(f"{root}/{name}").where(F.col(LOAD) != load).select(key)
        fresh = rows.join(others, key, "left_anti").select(*rows.columns).withColumn(LOAD, F.lit(load))
        _write(fresh, f"{root}/{name}", [LOAD], "dynamic")
    known = spark.read.parquet(f"{root}/dimension_order_data").drop(LOAD)
    before = _touched(spark, root, load)
    _write_facts(item_lines(src.order_items, known), root, load, "dynamic")
    refresh_sums(spark, root, before | _touched(spark, root, load))


def _write_facts(lines: DataFrame, root: str, load: str, mode: str) -> None:
    path = f"{root}/{FACTS}"
    columns = [*FACT_COLUMNS, *ORDER_COLUMNS]
    numbered = number_batch(lines.select(*columns), path, [(name, "asc") for name in FACT_COLUMNS], load, 0)
    placed = numbered.withColumn(MONTH, F.trunc(F.col(PURCHASE).cast("date"), "month"))
    # A month's rows together, in order of their orders; AQE splits a month that is too large for a task.
    placed = placed.hint("rebalance", MONTH).withColumn(LOAD, F.lit(load))
    _write(placed.sortWithinPartitions(MONTH, LOAD, "order_id"), path, [MONTH, LOAD], mode)


def _write(rows: DataFrame, path: str, partitions: list[str], mode: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partitions).parquet(path)


def _touched(spark: SparkSession, root: str, load: str) -> set:
    """The months a load has written to: as many as the calendar has, None among them."""
    stored = spark.read.schema(FACT_SCHEMA).parquet(f"{root}/{FACTS}").where(F.col(LOAD) == load)
    return {row[0] for row in stored.select(MONTH).distinct().collect()}


def refresh_sums(spark: SparkSession, root: str, touched: set | None) -> None:
    """Compute the sums of the touched months anew, or all of them; the fact is read once for both kinds."""
    facts = spark.read.schema(FACT_SCHEMA).parquet(f"{root}/{FACTS}")
    if touched is not None:
        if not touched:
            return
        named = [F.col(MONTH).isin(sorted(month for month in touched if month is not None))] if touched - {None} else []
        facts = facts.where(reduce(Column.__or__, named + ([F.col(MONTH).isNull()] if None in touched else [])))
    with settings(spark, SORTED):
        _write(monthly_sums(facts), f"{root}/{SUMS}", ["kind", MONTH], "static" if touched is None else "dynamic")


def monthly_sums(facts: DataFrame) -> DataFrame:
    """Sums per month, seller and product, and per month, customer, month of delivery and status.

    Each fact stands once for either kind and moves once: the ranges keep a group's facts in one task, so distinct
    orders need no exchange of their own, and keep months together, so a month has few files without one more. The
    window sorts them, so that under SORTED a task holds a group and not all of its groups.
    """
    product, customer = ["seller_id", "product_id"], ["customer_unique_id", "order_status"]
    own = {BY_PRODUCT: product, BY_CUSTOMER: customer}
    kinds = [F.struct(F.lit(kind).alias("kind"), *_only(own[kind], product + customer, facts)) for kind in own]
    rows = facts.select(MONTH, "order_id", "price", DELIVERY, PURCHASE, F.explode(F.array(*kinds)).alias("_kind"))
    rows = rows.select(MONTH, "order_id", "price", DELIVERY, PURCHASE, "_kind.*")
    rows = rows.repartitionByRange("kind", MONTH, *product, "customer_unique_id")
    delivery_month = F.when(F.col("kind") == BY_CUSTOMER, truncate(DELIVERY, "month"))
    keys = ["kind", MONTH, *product, *customer, "delivery_month"]
    rows = rows.withColumn("delivery_month", delivery_month)
    same_order = F.row_number().over(Window.partitionBy(*keys, "order_id").orderBy("order_id"))
    sums = rows.withColumn("_nth", same_order).groupBy(*keys).agg(
        sum_cents("price").alias("cents"),
        F.count("price").alias("prices"),
        F.count(F.when(F.col("_nth") == 1, F.col("order_id"))).alias("orders"),
        F.max(DELIVERY).alias("last_delivery"),
        F.min(PURCHASE).alias("first_purchase"),
        F.max(PURCHASE).alias("last_purchase"),
    )
    return sums.select(*[field.split()[0] for field in SUM_SCHEMA.split(", ")])


def _only(own: list[str], names: list[str], rows: DataFrame) -> list[Column]:
    """The named columns, but NULL in place of those that are not its own."""
    return [(F.col(name) if name in own else F.lit(None).cast(rows.schema[name].dataType)).alias(name) for name in names]


def write_staging(star: Star, root: str) -> str:
    """Store the wide delivery rows by month of purchase; returns their path."""
    path = f"{root}/{STAGING}"
    wide = staging_customers_deliveries(star).withColumn(MONTH, F.trunc(F.col(PURCHASE).cast("date"), "month"))
    _write(wide.hint("rebalance", MONTH), path, [MONTH], "static")
    return path


def next_id(spark: SparkSession, root: str) -> int:
    """The id that the next new fact will get."""
    return first_id(spark, f"{root}/{FACTS}", "", -1)
