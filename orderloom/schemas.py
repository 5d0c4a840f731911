"""Declared tables: column types, declared keys, message envelope."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
MONEY_SUM = T.DecimalType(38, 2)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_text, _int, _float, _time = T.StringType(), T.IntegerType(), T.FloatType(), T.TimestampNTZType()

# Column names (with the misspelling found in the data) and types.
TABLES: dict[str, T.StructType] = {
    "src_customers": _struct(
        customer_id=_text,
        customer_unique_id=_text,
        customer_zip_code_prefix=_text,
        customer_city=_text,
        customer_state=_text,
    ),
    "src_products": _struct(
        product_id=_text,
        product_category_name=_text,
        product_name_lenght=_int,
        product_description_lenght=_int,
        product_photos_qty=_int,
        product_weight_g=_float,
        product_length_cm=_float,
        product_height_cm=_float,
        product_width_cm=_float,
    ),
    "src_products_categories_translations": _struct(
        product_category_name=_text,
        product_category_name_english=_text,
    ),
    "src_sellers": _struct(
        seller_id=_text,
        seller_zip_code_prefix=_text,
        seller_city=_text,
        seller_state=_text,
    ),
    "src_geolocation": _struct(
        geolocation_zip_code_prefix=_text,
        geolocation_lat=_float,
        geolocation_lng=_float,
        geolocation_city=_text,
        geolocation_state=_text,
    ),
    "src_order_items": _struct(
        order_id=_text,
        order_item_id=_int,
        product_id=_text,
        seller_id=_text,
        shipping_limit_date=_time,
        price=_float,
        freight_value=_float,
    ),
    "src_orders": _struct(
        order_id=_text,
        customer_id=_text,
        order_status=_text,
        order_purchase_timestamp=_time,
        order_approved_at=_time,
        order_delivered_carrier_date=_time,
        order_delivered_customer_date=_time,
        order_estimated_delivery_date=_time,
    ),
    # The id is an INTEGER by declaration; a bigint holds any number of facts.
    "facts_order_items": _struct(
        id=T.LongType(),
        order_id=_text,
        order_item_id=_int,
        product_id=_text,
        seller_id=_text,
        customer_unique_id=_text,
        price=MONEY,
    ),
}

SOURCE_TABLES = [name for name in TABLES if name.startswith("src_")]

# Declared primary or unique keys.
KEYS: dict[str, list[list[str]]] = {
    "src_customers": [["customer_id"]],
    "src_products": [["product_id"]],
    "src_products_categories_translations": [["product_category_name"]],
    "src_sellers": [["seller_id"]],
    "src_geolocation": [
        ["geolocation_zip_code_prefix"],
        ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    ],
    "src_order_items": [["order_id", "order_item_id"]],
    "src_orders": [["order_id"]],
    "facts_order_items": [["id"]],
}

FACT_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "customer_unique_id", "price"]
FACT_KEYS = ["order_id", "order_item_id"]
ORDER_COLUMNS = ["order_delivered_customer_date", "order_status", "order_purchase_timestamp"]

DELIVERED, CANCELED, PROCESSING = "delivered", "canceled", "processing"

# The fields a fact is made of, as they arrive in a message.
FACT_MESSAGE = T.StructType([TABLES["facts_order_items"][name] for name in FACT_COLUMNS])


def envelope(data: T.StructType) -> T.StructType:
    """`{timestamp: epoch ms, data: {row}}`."""
    return _struct(timestamp=T.LongType(), data=data)
