"""The driver's tables as source tables. The DuckDB twin of these expressions is in oracle.py."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.operators.ranking import asc, with_ranks
from orderloom.session import store
from orderloom.sources.tables import Sources

# Explicit schemas save Spark a pass over the footers.
RAW = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

ITEM_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_shipdate",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
]
# What items show of their lines, beside the order and the number.
ITEM_SHOWN = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax"]
# An order with more items than this is numbered over several tasks.
HOT = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{sf_dir}/{name}.parquet")


class DriverSources(Sources):
    """The seven source tables, each built when first used; item numbers only if asked for.

    `kept` stores the numbered items, for queries that take them several times.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, numbered: bool = False, kept: bool = False):
        self.__dict__.update(spark=spark, sf_dir=sf_dir, numbered=numbered, kept=kept)

    customers = cached_property(lambda self: _customers(self.spark, self.sf_dir))
    products = cached_property(lambda self: _products(self.spark, self.sf_dir))
    translations = cached_property(lambda self: _translations(self.spark, self.sf_dir))
    sellers = cached_property(lambda self: _sellers(self.spark, self.sf_dir))
    geolocation = cached_property(lambda self: _geolocation(self.spark, self.sf_dir))
    order_items = cached_property(lambda self: _order_items(self.spark, self.sf_dir, self.numbered, self.kept))
    orders = cached_property(lambda self: _orders(self.spark, self.sf_dir))

    def orders_of(self, items: DataFrame) -> DataFrame:
        """The orders, from items that are stored already."""
        return _orders(self.spark, self.sf_dir, items)


def _id(name: str):
    return F.col(name).cast("string")


def _state(nationkey: str):
    return F.concat(F.lit("N"), F.col(nationkey).cast("string"))


def _zip(nationkey: str):
    return F.lpad(F.col(nationkey).cast("string"), 5, "0")


def _nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key by construction, so Catalyst drops the join where the name is not used."""
    return table(spark, sf_dir, "nation").groupBy("n_nationkey").agg(F.min("n_name").alias("n_name"))


def _numbered(lines: DataFrame, hot: int = HOT) -> DataFrame:
    """The lines with their number in the order: a window for each order, but ranges for those with more than `hot` lines."""
    lines = lines.select("l_orderkey", _id("l_orderkey").alias("order_id"), *ITEM_ORDER)
    large = store(lines.groupBy("l_orderkey").agg(F.count("*").alias("_lines")).where(F.col("_lines") > hot), "hot")
    # By the id that items are joined by: the lines then lie as a join with their orders needs them.
    in_order = Window.partitionBy("order_id").orderBy(*[asc(name) for name in ITEM_ORDER])
    number = F.row_number().over(in_order).cast("bigint").alias("_number")
    if large.isEmpty():
        return lines.select("*", number)
    same = lines["l_orderkey"].eqNullSafe(large["l_orderkey"])
    order = [(name, "asc") for name in ITEM_ORDER]
    ranged = with_ranks(lines.join(F.broadcast(large), same, "left_semi"), order, partition_by=["l_orderkey"], row_number="_number")
    return lines.join(F.broadcast(large), same, "left_anti").select("*", number).unionByName(ranged)


def _order_items(spark: SparkSession, sf_dir: str, numbered: bool, kept: bool) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    number = []
    if numbered:
        lines = _numbered(lines)
        if kept:
            lines = store(lines.select("order_id", "_number", *ITEM_SHOWN), "items")
        number = [F.col("_number").cast("int").alias("order_item_id")]
    return lines.select(
        F.col("order_id") if numbered else _id("l_orderkey").alias("order_id"),
        *number,
        _id("l_partkey").alias("product_id"),
        _id("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_tax") * 100).alias("freight_value"),
    )


def _orders(spark: SparkSession, sf_dir: str, items: DataFrame | None = None) -> DataFrame:
    """Orders with the times their items were shipped; stored `items` lie by order, so that less is moved for it."""
    items = _order_items(spark, sf_dir, False, False) if items is None else items
    # By the id that orders are joined by: they then lie as such a join needs them.
    shipped = items.groupBy("order_id")
    shipped = shipped.agg(F.min("shipping_limit_date").alias("_first"), F.max("shipping_limit_date").alias("_last"))
    orders = table(spark, sf_dir, "orders").withColumn("order_id", _id("o_orderkey")).join(shipped, "order_id", "left")
    flag = F.col("o_orderstatus")
    return orders.select(
        "order_id",
        _id("o_custkey").alias("customer_id"),
        F.when(flag == "F", "delivered").when(flag == "O", "processing").when(flag == "P", "canceled")
        .alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.col("o_orderdate").alias("order_approved_at"),
        F.col("_first").alias("order_delivered_carrier_date"),
        F.when(flag == "F", F.col("_last")).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("order_estimated_delivery_date"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _nation(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")
    customers = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return customers.select(
        _id("c_custkey").alias("customer_id"),
        _id("c_custkey").alias("customer_unique_id"),
        _zip("c_nationkey").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        _state("c_nationkey").alias("customer_state"),
    )


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("float")
    return table(spark, sf_dir, "part").select(
        _id("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_brand")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.length("p_type").alias("product_description_lenght"),
        F.lit(1).alias("product_photos_qty"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def _translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct().where(F.col("p_brand") != "Brand#25")
    return brands.select(
        F.col("p_brand").alias("product_category_name"),
        F.lower(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("product_category_name_english"),
    )


def _sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _nation(spark, sf_dir)
    sellers = table(spark, sf_dir, "supplier")
    sellers = sellers.join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return sellers.select(
        _id("s_suppkey").alias("seller_id"),
        _zip("s_nationkey").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        _state("s_nationkey").alias("seller_state"),
    )


def _geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        _zip("n_nationkey").alias("geolocation_zip_code_prefix"),
        F.col("n_nationkey").cast("float").alias("geolocation_lat"),
        (-F.col("n_nationkey")).cast("float").alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        _state("n_nationkey").alias("geolocation_state"),
    )
