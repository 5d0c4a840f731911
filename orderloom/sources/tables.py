"""The seven source tables, in memory as DataFrames or in the catalog as parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.keys import complete, keep_first
from orderloom.schemas import KEYS, TABLES


@dataclass(frozen=True)
class Sources:
    """One DataFrame per source table."""

    customers: DataFrame
    products: DataFrame
    translations: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    order_items: DataFrame
    orders: DataFrame

    def named(self) -> dict[str, DataFrame]:
        """The same frames under their table names."""
        return {
            "src_customers": self.customers,
            "src_products": self.products,
            "src_products_categories_translations": self.translations,
            "src_sellers": self.sellers,
            "src_geolocation": self.geolocation,
            "src_order_items": self.order_items,
            "src_orders": self.orders,
        }


def create_source_tables(spark: SparkSession, database: str, location: str) -> list[str]:
    """Create the source tables and the facts table in `database` unless they exist."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, schema in TABLES.items():
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
    return [f"{database}.{name}" for name in TABLES]


def load_source_tables(sources: Sources, database: str, unique: bool = False) -> None:
    """Append every source frame to its catalog table, cast to the declared types.

    Spark enforces no keys. With `unique` a row is loaded only if no row of the table or of
    this load has its key; rows with a NULL in the key are not compared.
    """
    for name, rows in sources.named().items():
        if unique:
            keys = KEYS[name][0]
            held = rows.sparkSession.table(f"{database}.{name}").select(*keys)
            fresh = keep_first(rows.where(complete(keys)), keys).join(held, keys, "left_anti").select(*rows.columns)
            rows = fresh.unionByName(rows.where(~complete(keys)))
        typed = rows.select(*[rows[field.name].cast(field.dataType) for field in TABLES[name].fields])
        typed.write.insertInto(f"{database}.{name}")


def read_source_tables(spark: SparkSession, database: str) -> Sources:
    """The catalog tables as `Sources`."""
    def table(name: str) -> DataFrame:
        return spark.table(f"{database}.src_{name}")

    return Sources(
        customers=table("customers"),
        products=table("products"),
        translations=table("products_categories_translations"),
        sellers=table("sellers"),
        geolocation=table("geolocation"),
        order_items=table("order_items"),
        orders=table("orders"),
    )
