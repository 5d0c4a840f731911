"""Fact, dimensions and the wide delivery row; where the reports get their rows from."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.numeric import sum_cents
from orderloom.functions.temporal import truncate
from orderloom.operators.ranking import with_ranks
from orderloom.schemas import DELIVERED, FACT_COLUMNS, MONEY, ORDER_COLUMNS
from orderloom.sources.tables import Sources

PURCHASE, DELIVERY = "order_purchase_timestamp", "order_delivered_customer_date"


def dimension_order_data(src: Sources) -> DataFrame:
    return src.orders.select("order_id", *ORDER_COLUMNS)


def dimension_product_data(src: Sources) -> DataFrame:
    """English category per product, NULL where there is no translation."""
    named = src.products.join(src.translations, "product_category_name", "left")
    return named.select("product_id", "product_category_name_english")


def dimension_seller_data(src: Sources) -> DataFrame:
    return src.sellers.select("seller_id", "seller_state")


def customers_orders(src: Sources) -> DataFrame:
    """Orders with their customer. Joined first, so the larger item table moves only once."""
    customers = src.customers.select("customer_id", "customer_unique_id")
    return src.orders.join(customers, "customer_id", "left")


def facts_order_items(src: Sources) -> DataFrame:
    """One row per order item; order and customer are NULL where the order is not known.

    Products would add neither columns nor rows, so they are not joined.
    """
    return with_customer_of_order(src.order_items, src).select(*FACT_COLUMNS)


def with_customer_of_order(items: DataFrame, src: Sources) -> DataFrame:
    """Items with the order and customer they belong to."""
    return item_lines(items, customers_orders(src))


def item_lines(items: DataFrame, orders: DataFrame, how: str = "left") -> DataFrame:
    """Items with the columns of their orders; the order id is the order's, NULL where it is not known."""
    items = items.withColumn("price", F.col("price").cast(MONEY))
    items = items.withColumnRenamed("order_id", "_item_order")
    return items.join(orders, F.col("_item_order") == F.col("order_id"), how)


def facts_surrogate_id(facts: DataFrame) -> DataFrame:
    """Facts with a dense `id` from 1, in key order."""
    order = [(name, "asc") for name in FACT_COLUMNS]
    numbered = with_ranks(facts.select(*FACT_COLUMNS), order, row_number="id")
    return numbered.select("id", *FACT_COLUMNS)


def staging_customers_deliveries(star: Star) -> DataFrame:
    """The fact joined to its three dimensions."""
    lines = star.lines(with_customer=True)
    lines = lines.join(star.products, "product_id", "left").join(star.sellers, "seller_id", "left")
    return lines.select(
        "customer_unique_id",
        "seller_id",
        "order_delivered_customer_date",
        "price",
        "order_id",
        "order_status",
        "product_id",
        "order_purchase_timestamp",
        "product_category_name_english",
        "seller_state",
    )


def _between(rows: DataFrame, since: Column | None, before: Column | None) -> DataFrame:
    if since is not None:
        rows = rows.where(F.col(PURCHASE) >= since)
    return rows if before is None else rows.where(F.col(PURCHASE) < before)


class Star:
    """A star of facts and dimensions. Reports ask it for lines or sums instead of joining themselves.

    `since` and `before` bound the time of purchase; sums take whole months only.
    """

    def __init__(self, facts: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame):
        self.facts = facts
        self.orders = orders
        self.products = products
        self.sellers = sellers

    def lines(
        self, with_customer: bool = False, how: str = "left", since: Column | None = None, before: Column | None = None
    ) -> DataFrame:
        """Facts joined to the order dimension on order_id; `how` is "left" or "inner"."""
        facts = self.facts if with_customer else self.facts.drop("customer_unique_id")
        return _between(facts.join(self.orders, "order_id", how), since, before)

    def per_order(self) -> DataFrame:
        """Sum of prices in cents per order, with its customer and the order's columns.

        Items are added up before the join, so an order with very many items is small by
        then. The customer follows from the order; items without a known order are one row.
        """
        sums = self.facts.groupBy("order_id").agg(
            F.max("customer_unique_id").alias("customer_unique_id"), sum_cents("price").alias("order_cents")
        )
        return sums.join(self.orders, "order_id", "left")

    def sales(self, *keys: str, since: Column | None = None, before: Column | None = None) -> DataFrame:
        """`cents` and number of `prices` per keys, which are among product_id, seller_id and month of purchase."""
        lines = self.lines(since=since, before=before).withColumn("month", truncate(PURCHASE, "month"))
        return lines.groupBy(*keys).agg(sum_cents("price").alias("cents"), F.count("price").alias("prices"))

    def months_to_compare(self, number: int) -> Column | None:
        """Start of the last `number` months with sales, where it is known without reading the fact; else None."""
        return None

    def order_counts(self) -> DataFrame:
        """month of purchase, seller_id, product_id and the number of known orders, `orders`."""
        known = self.lines(how="inner").withColumn("month", truncate(PURCHASE, "month"))
        return known.groupBy("month", "seller_id", "product_id").agg(F.countDistinct("order_id").alias("orders"))

    def by_customer(self, *keys: str, delivered_only: bool = False) -> DataFrame:
        """Sums over orders per keys, which are among customer_unique_id and month of delivery.

        `cents`, `orders`, `last_delivery`, `first_purchase`, `last_purchase`, and `dated`, the
        number of orders with a time of purchase. Orders not delivered form a NULL month.
        """
        orders = self.per_order().withColumn("month", truncate(DELIVERY, "month"))
        if delivered_only:
            orders = orders.where(F.col("order_status") == DELIVERED)
        return orders.groupBy(*keys).agg(
            F.sum("order_cents").alias("cents"),
            F.count("order_id").alias("orders"),
            F.max(DELIVERY).alias("last_delivery"),
            F.min(PURCHASE).alias("first_purchase"),
            F.max(PURCHASE).alias("last_purchase"),
            F.count(PURCHASE).alias("dated"),
        )


class SourceStar(Star):
    """A star derived from the sources.

    The fact takes its order id from the orders table, so the order's columns are at hand
    when the fact is formed; joining the order dimension again would add nothing. The
    customer is looked up only for reports that name it.
    """

    def __init__(self, src: Sources):
        self.src = src

    facts = cached_property(lambda self: facts_order_items(self.src))
    orders = cached_property(lambda self: dimension_order_data(self.src))
    products = cached_property(lambda self: dimension_product_data(self.src))
    sellers = cached_property(lambda self: dimension_seller_data(self.src))

    def lines(
        self, with_customer: bool = False, how: str = "left", since: Column | None = None, before: Column | None = None
    ) -> DataFrame:
        orders = customers_orders(self.src) if with_customer else self.src.orders
        customer = ["customer_unique_id"] if with_customer else []
        lines = item_lines(self.src.order_items, orders, how)
        lines = lines.select("order_id", "product_id", "seller_id", *customer, "price", *ORDER_COLUMNS)
        return _between(lines, since, before)

    def per_order(self) -> DataFrame:
        items = self.src.order_items.withColumn("price", F.col("price").cast(MONEY))
        sums = items.groupBy(F.col("order_id").alias("_item_order")).agg(sum_cents("price").alias("order_cents"))
        joined = sums.join(customers_orders(self.src), F.col("_item_order") == F.col("order_id"), "left")
        return joined.select("order_id", "customer_unique_id", "order_cents", *ORDER_COLUMNS)


def register_views(star: Star, src: Sources | None = None) -> None:
    """Temporary views under the tables' names, for SQL of one's own."""
    views = {
        "facts_order_items": star.facts.select(*[name for name in ("id", *FACT_COLUMNS) if name in star.facts.columns]),
        "dimension_order_data": star.orders,
        "dimension_product_data": star.products,
        "dimension_seller_data": star.sellers,
        "staging_customers_deliveries": staging_customers_deliveries(star),
        **(src.named() if src else {}),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)


def write_star(src: Sources, root: str) -> None:
    """Store the star under `root` in place of what is there; see plans/stored.py."""
    from orderloom.plans.stored import write_star as write

    write(src, root)


def read_star(spark: SparkSession, root: str) -> Star:
    """The star that write_star() has stored."""
    from orderloom.plans.stored import StoredStar

    return StoredStar(spark, root)
