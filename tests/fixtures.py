"""Small hand-made source tables."""

from datetime import datetime

from orderloom.schemas import TABLES
from orderloom.sources.tables import Sources

_ATTRIBUTE = {
    "src_customers": "customers",
    "src_products": "products",
    "src_products_categories_translations": "translations",
    "src_sellers": "sellers",
    "src_geolocation": "geolocation",
    "src_order_items": "order_items",
    "src_orders": "orders",
}


def day(text):
    return None if text is None else datetime.fromisoformat(text)


def sources(spark, **rows):
    """Sources from lists of dicts; a column that is not given is NULL."""
    def frame(table):
        schema = TABLES[table]
        given = rows.get(_ATTRIBUTE[table], [])
        values = [[row.get(field.name) for field in schema.fields] for row in given]
        return spark.createDataFrame(values, schema)

    return Sources(**{attribute: frame(table) for table, attribute in _ATTRIBUTE.items()})


def order(order_id, customer_id, purchased, delivered=None, status="delivered"):
    return {
        "order_id": order_id,
        "customer_id": customer_id,
        "order_status": status,
        "order_purchase_timestamp": day(purchased),
        "order_delivered_customer_date": day(delivered),
    }


def item(order_id, number, product_id, seller_id, price):
    return {
        "order_id": order_id,
        "order_item_id": number,
        "product_id": product_id,
        "seller_id": seller_id,
        "price": price,
    }


def customer(customer_id, unique_id=None):
    return {"customer_id": customer_id, "customer_unique_id": unique_id or customer_id}


def product(product_id, category=None):
    return {"product_id": product_id, "product_category_name": category}


def translation(category, english):
    return {"product_category_name": category, "product_category_name_english": english}


def seller(seller_id, state):
    return {"seller_id": seller_id, "seller_state": state}


def rows_of(frame, *columns):
    return [tuple(row) for row in (frame.select(*columns) if columns else frame).collect()]
