"""DuckDB SQL for every query, over the driver's tables.

The first block of common table expressions is the twin of adapter.py, the second the star.
A query names the ones it needs; DuckDB ignores none, so only those are put in front.
"""

from __future__ import annotations

from orderloom.schemas import KEYS, SOURCE_TABLES
from orderloom.testbed.primitives import PRIMITIVES
from orderloom.testbed.shown import SHOWN

SOURCE_CTES = {
    "src_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
            CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                l_extendedprice, l_quantity, l_discount, l_tax) AS INTEGER) AS order_item_id,
            CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
            l_shipdate AS shipping_limit_date, l_extendedprice AS price, l_tax * 100 AS freight_value
        FROM lineitem""",
    "src_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
            CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing' WHEN 'P' THEN 'canceled' END
                AS order_status,
            o_orderdate AS order_purchase_timestamp, o_orderdate AS order_approved_at,
            first_shipped AS order_delivered_carrier_date,
            CASE WHEN o_orderstatus = 'F' THEN last_shipped END AS order_delivered_customer_date,
            o_orderdate + INTERVAL 30 DAY AS order_estimated_delivery_date
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_shipped, max(l_shipdate) AS last_shipped
            FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "src_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_custkey AS VARCHAR) AS customer_unique_id,
            lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix, n_name AS customer_city,
            'N' || c_nationkey AS customer_state
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "src_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id,
            CASE WHEN p_partkey % 50 <> 0 THEN p_brand END AS product_category_name
        FROM part""",
    "src_products_categories_translations": """
        SELECT DISTINCT p_brand AS product_category_name,
            lower(replace(p_brand, '#', '_')) AS product_category_name_english
        FROM part WHERE p_brand <> 'Brand#25'""",
    "src_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, 'N' || s_nationkey AS seller_state FROM supplier""",
    "src_geolocation": """
        SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
            n_nationkey AS geolocation_lat, -n_nationkey AS geolocation_lng
        FROM nation""",
    "fact": """
        SELECT o.order_id, i.order_item_id, i.product_id, i.seller_id, c.customer_unique_id,
            CAST(i.price AS DECIMAL(10,2)) AS price
        FROM src_order_items i LEFT JOIN src_orders o USING (order_id)
            LEFT JOIN src_customers c ON c.customer_id = o.customer_id""",
    "dim_order": """
        SELECT order_id, order_delivered_customer_date, order_status, order_purchase_timestamp FROM src_orders""",
    "dim_product": """
        SELECT product_id, product_category_name_english
        FROM src_products LEFT JOIN src_products_categories_translations USING (product_category_name)""",
    "dim_seller": "SELECT seller_id, seller_state FROM src_sellers",
    # Each fact with its order's columns, under short names.
    "sale": """
        SELECT f.order_id, f.product_id, f.seller_id, f.customer_unique_id AS customer, f.price,
            d.order_status AS status, d.order_purchase_timestamp AS purchased,
            d.order_delivered_customer_date AS delivered
        FROM fact f LEFT JOIN dim_order d ON d.order_id = f.order_id""",
}

# What each of them reads, in the order in which they are listed above.
_READS = {
    "fact": ["src_order_items", "src_orders", "src_customers"],
    "dim_order": ["src_orders"],
    "dim_product": ["src_products", "src_products_categories_translations"],
    "dim_seller": ["src_sellers"],
    "sale": ["fact", "dim_order"],
}


def over(needs: list[str], sql: str) -> str:
    """`sql` behind the common table expressions it needs."""
    wanted: set[str] = set()
    pending = list(needs)
    while pending:
        name = pending.pop()
        wanted.add(name)
        pending += _READS.get(name, [])
    ctes = [f"{name} AS ({text})" for name, text in SOURCE_CTES.items() if name in wanted]
    return f"WITH {', '.join(ctes)} SELECT * FROM ({sql})"


FACT_SQL = """SELECT order_id, order_item_id, product_id, seller_id, customer_unique_id,
    CAST(price AS DOUBLE) AS price FROM fact"""
# Facts as messages carry them: no customer, and the order id of the item itself.
MESSAGE_FACT_SQL = """SELECT order_id, order_item_id, product_id, seller_id, CAST(NULL AS VARCHAR) AS customer_unique_id,
    CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price FROM src_order_items"""
TEXT_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"

INGEST = {
    "read_source_csv": over(["src_order_items"], """
        SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
            CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
            CAST(CAST(freight_value AS DECIMAL(10,2)) AS DOUBLE) AS freight_value FROM src_order_items"""),
    "publish_envelope": over(["src_orders"], f"""
        SELECT 1700000000000 AS timestamp, order_id, customer_id, order_status,
            {TEXT_TIME.format('order_purchase_timestamp')} AS purchased,
            {TEXT_TIME.format('order_delivered_customer_date')} AS delivered,
            order_delivered_customer_date IS NULL AS writes_null FROM src_orders"""),
    "publish_sink": over(["src_order_items"], """
        SELECT 'order_items' AS topic, order_id, order_item_id, product_id,
            CAST(CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price FROM src_order_items"""),
    "publish_batch_stats": """
        SELECT count(*) FILTER (WHERE event_type <> 'error') AS successes,
            count(*) FILTER (WHERE event_type = 'error') AS failures FROM events""",
    "publish_counted": """
        SELECT event_id, (SELECT count(*) FROM events WHERE event_type <> 'error') AS successes,
            (SELECT count(*) FROM events WHERE event_type = 'error') AS failures
        FROM events WHERE event_type <> 'error'""",
    "triage_parts": """
        SELECT CASE event_type WHEN 'signup' THEN 'undecodable' WHEN 'error' THEN 'error' ELSE 'good' END AS part, event_id,
            (SELECT count(*) FROM events WHERE event_type <> 'signup') AS processed,
            (SELECT count(*) FROM events WHERE event_type = 'error') AS errors,
            (SELECT count(*) FROM events WHERE event_type = 'signup') AS undecodable FROM events""",
    "read_topic": over(["src_orders", "src_sellers"], """
        SELECT 'orders' AS topic, order_id AS id FROM src_orders
        UNION ALL SELECT 'sellers', seller_id FROM src_sellers"""),
    "parse_envelope": over(["src_order_items"], MESSAGE_FACT_SQL),
    "triage_messages": """
        SELECT count(*) FILTER (WHERE event_type <> 'signup') AS processed,
            count(*) FILTER (WHERE event_type = 'error') AS errors,
            count(*) FILTER (WHERE event_type = 'signup') AS undecodable FROM events""",
    "stream_facts": over(["src_order_items"], MESSAGE_FACT_SQL),
    "append_if_absent": over(["fact"], f"""{FACT_SQL} UNION ALL
        SELECT NULL, NULL, product_id, seller_id, customer_unique_id, CAST(price AS DOUBLE) AS price FROM fact
        WHERE order_item_id = 1"""),
    "stream_tables": over(["src_orders", "src_sellers", "src_customers"], """
        SELECT 'src_orders' AS table_name, order_id AS id, order_status AS detail FROM src_orders
        UNION ALL SELECT 'src_sellers', seller_id, seller_state FROM src_sellers
        UNION ALL SELECT 'src_customers', customer_id, customer_state FROM src_customers"""),
    "append_numbered": over(["fact", "dim_order"], """
        SELECT row_number() OVER (ORDER BY (order_status IS NOT DISTINCT FROM 'delivered') DESC, order_id NULLS LAST,
                order_item_id, product_id, seller_id) AS id, order_id, order_item_id, product_id, seller_id,
            customer_unique_id, CAST(price AS DOUBLE) AS price FROM fact LEFT JOIN dim_order USING (order_id)"""),
    "sanitize_values": """
        SELECT doc_id, replace(lang || '''s ' || source, '''', '?') AS source, replace(text, '''', '?') AS text, n_chars
        FROM documents""",
    "create_source_tables": over([name for name in SOURCE_CTES if name.startswith("src_")] + ["fact"], " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cte}"
        for name, cte in [*[(n, n) for n in SOURCE_CTES if n.startswith("src_")], ("facts_order_items", "fact")])),
    "key_violations": over([name for name in SOURCE_CTES if name.startswith("src_")], " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{key}' AS key, count(*) AS keys_repeated,
            CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_concerned
        FROM (SELECT count(*) AS n FROM {table} GROUP BY {key} HAVING count(*) > 1)"""
        for table, key in [
            ("lineitem", "l_orderkey, l_linenumber"),
            *[(table, ", ".join(columns)) for table in SOURCE_TABLES for columns in KEYS[table]],
        ])),
}

STAR = {
    "facts_order_items": over(["fact"], FACT_SQL),
    "facts_surrogate_id": over(["fact"], """
        SELECT row_number() OVER (ORDER BY order_id NULLS LAST, order_item_id, product_id, seller_id) AS id, order_id,
            order_item_id, product_id, seller_id, customer_unique_id, CAST(price AS DOUBLE) AS price FROM fact"""),
    "dimension_order_data": over(["dim_order"], "SELECT * FROM dim_order"),
    "dimension_product_data": over(["dim_product"], "SELECT * FROM dim_product"),
    "dimension_seller_data": over(["dim_seller"], "SELECT * FROM dim_seller"),
    "staging_customers_deliveries": over(["sale", "dim_product", "dim_seller"], """
        SELECT customer AS customer_unique_id, seller_id, delivered AS order_delivered_customer_date,
            CAST(price AS DOUBLE) AS price, order_id, status AS order_status, product_id,
            purchased AS order_purchase_timestamp, product_category_name_english, seller_state
        FROM sale LEFT JOIN dim_product USING (product_id) LEFT JOIN dim_seller USING (seller_id)"""),
}

REPORTS = {
    "most_valuable_customers": over(["sale"], """
        SELECT customer_unique_id, CAST(spent AS DOUBLE) AS total_spent, total_orders, last_order_date,
            rank() OVER (ORDER BY spent DESC NULLS LAST) AS customer_rating
        FROM (SELECT customer AS customer_unique_id, sum(price) AS spent, count(DISTINCT order_id) AS total_orders,
                max(delivered) AS last_order_date
            FROM sale WHERE status = 'delivered' GROUP BY customer, date_trunc('month', delivered))"""),
    "rolling_quarters": over(["sale"], """
        SELECT customer_unique_id, month, CAST(sales AS DOUBLE) AS monthly_total,
            CAST(sum(sales) OVER recent AS DOUBLE) / count(sales) OVER recent AS rolling_quartal_avg
        FROM (SELECT customer AS customer_unique_id, date_trunc('month', delivered) AS month, sum(price) AS sales
            FROM sale GROUP BY 1, 2)
        WINDOW recent AS (PARTITION BY customer_unique_id ORDER BY month ASC NULLS LAST
            ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""),
    "top_ten_products_q_sales": over(["sale"], """
        SELECT product_id, row_number() OVER (ORDER BY sales DESC NULLS LAST, product_id) AS rank_by_quarter_sales,
            CAST(sales AS DOUBLE) AS total_quarter_sales
        FROM (SELECT product_id, sum(price) AS sales FROM sale,
                (SELECT date_trunc('quarter', max(order_purchase_timestamp)) AS q FROM dim_order)
            WHERE purchased >= q AND purchased < q + INTERVAL 3 MONTH GROUP BY product_id)
        ORDER BY rank_by_quarter_sales LIMIT 10"""),
    "top_ten_products_q_by_category": over(["sale", "dim_product"], """
        SELECT category AS product_category_name_english, product_id, CAST(sales AS DOUBLE) AS total_sales,
            rank_by_category
        FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sales DESC NULLS LAST, product_id)
                AS rank_by_category
            FROM (SELECT product_category_name_english AS category, product_id, sum(price) AS sales
                FROM sale LEFT JOIN dim_product USING (product_id),
                    (SELECT date_trunc('quarter', max(order_purchase_timestamp)) AS q FROM dim_order)
                WHERE purchased >= q AND purchased < q + INTERVAL 3 MONTH GROUP BY 1, 2))
        WHERE rank_by_category <= 10 AND category IS NOT NULL"""),
    "raise_sales_gradient": over(["sale", "dim_product"], """
        SELECT category AS product_category, month, CAST(round(CAST((CAST(sales AS DOUBLE) - before)
            / nullif(before, 0) * 100 AS DECIMAL(28,10)), 2) AS DOUBLE) AS growth_percentage
        FROM (SELECT *, CAST(lag(sales) OVER (PARTITION BY category ORDER BY month ASC NULLS LAST) AS DOUBLE) AS before
            FROM (SELECT product_category_name_english AS category, date_trunc('month', purchased) AS month,
                    sum(price) AS sales
                FROM sale LEFT JOIN dim_product USING (product_id)
                WHERE product_category_name_english IN (
                    SELECT product_category_name_english FROM sale LEFT JOIN dim_product USING (product_id)
                    GROUP BY 1 ORDER BY sum(price) DESC, 1 NULLS LAST LIMIT 5)
                GROUP BY 1, 2))
        WHERE before IS NOT NULL"""),
    "cumulative_product_sales": over(["sale"], "SELECT product_id, " + ", ".join(
        f"CAST(sum(CASE WHEN m <= {number} THEN sales ELSE 0 END) AS DOUBLE) AS {name}"
        for number, name in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), start=1)
    ) + """ FROM (SELECT product_id, extract(month FROM purchased) AS m, sum(price) AS sales
        FROM sale WHERE extract(year FROM purchased) = 2000 GROUP BY 1, 2) GROUP BY product_id"""),
    "daily_rebates": over(["sale"], """
        SELECT date_trunc('day', purchased) AS day_of_month, CAST(sum(price) AS DOUBLE) AS daily_rebates
        FROM sale WHERE purchased >= (SELECT max(order_purchase_timestamp) - INTERVAL 1 MONTH FROM dim_order)
        GROUP BY 1"""),
    "daily_avgs_states_comparison": over(["sale", "dim_seller"], """
        SELECT state, coalesce(cur, 0) AS current_avg_order_value, coalesce(prev, 0) AS prev_avg_order_value,
            CAST(round(CAST((coalesce(cur, 0) - prev) / nullif(prev, 0) * 100 AS DECIMAL(28,10)), 2) AS DOUBLE)
                AS percentage_change
        FROM (SELECT DISTINCT seller_state AS state FROM dim_seller)
        LEFT JOIN (
            SELECT seller_state AS state,
                CAST(sum(CASE WHEN purchased >= m THEN price END) AS DOUBLE)
                    / nullif(count(CASE WHEN purchased >= m THEN price END), 0) AS cur,
                CAST(sum(CASE WHEN purchased < m THEN price END) AS DOUBLE)
                    / nullif(count(CASE WHEN purchased < m THEN price END), 0) AS prev
            FROM sale LEFT JOIN dim_seller USING (seller_id), (SELECT date_trunc('month', max(purchased)) AS m FROM sale)
            WHERE purchased >= m - INTERVAL 1 MONTH AND purchased < m + INTERVAL 1 MONTH
            GROUP BY seller_state) USING (state)"""),
    "seller_rating": over(["sale"], """
        SELECT seller_id, row_number() OVER (ORDER BY 0.5::DOUBLE * p + 0.5::DOUBLE * a DESC, seller_id)
            AS performance_rank
        FROM (SELECT seller_id, percent_rank() OVER (ORDER BY revenue DESC NULLS LAST) AS p,
                percent_rank() OVER (ORDER BY mean_price DESC NULLS LAST) AS a
            FROM (SELECT seller_id, sum(price) AS revenue, CAST(sum(price) AS DOUBLE) / count(price) AS mean_price
                FROM sale, (SELECT max(order_purchase_timestamp) AS last FROM dim_order)
                WHERE purchased BETWEEN last - INTERVAL 1 YEAR AND last GROUP BY seller_id))"""),
    "orders_avg_period": over(["fact", "dim_order"], """
        SELECT customer_unique_id, round(CAST(sum(date_diff('microsecond', purchased, next_purchased)) AS DOUBLE)
            / count(*)) / 1e6 AS interval_seconds
        FROM (SELECT customer_unique_id, order_purchase_timestamp AS purchased,
                lead(order_purchase_timestamp) OVER (PARTITION BY customer_unique_id
                    ORDER BY order_purchase_timestamp NULLS LAST) AS next_purchased
            FROM (SELECT DISTINCT customer_unique_id, order_id FROM fact) LEFT JOIN dim_order USING (order_id))
        WHERE next_purchased IS NOT NULL GROUP BY customer_unique_id"""),
    "trend_products_by_seller": over(["fact", "dim_order"], """
        SELECT date_trunc('month', order_purchase_timestamp) AS month, seller_id, product_id,
            count(DISTINCT order_id) AS orders_count
        FROM fact JOIN dim_order USING (order_id) GROUP BY 1, 2, 3"""),
}

def _shown(name: str) -> str:
    label, amount = SHOWN[name]
    label = f"CAST({label} AS VARCHAR)" if label else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{name}' AS report, {label} AS label, CAST({amount} AS DOUBLE) AS amount FROM ({REPORTS[name]})"


STORED = {
    "materialize_report": " UNION ALL ".join(_shown(name) for name in SHOWN),
    "stored_facts": over(["fact", "dim_order"], """
        SELECT row_number() OVER (ORDER BY (order_status IS NOT DISTINCT FROM 'delivered') DESC, order_id NULLS LAST,
                order_item_id, product_id, seller_id) AS id, order_id, order_item_id, product_id, seller_id,
            customer_unique_id, CAST(price AS DOUBLE) AS price,
            CAST(date_trunc('month', order_purchase_timestamp) AS TIMESTAMP) AS purchase_month,
            CASE WHEN order_status = 'delivered' THEN 'first' ELSE 'second' END AS load
        FROM fact LEFT JOIN dim_order USING (order_id)"""),
    "stored_staging": STAR["staging_customers_deliveries"],
}

ORACLE: dict[str, str] = {
    **INGEST, **STAR, **REPORTS, **STORED, **{key: sql for key, (_, sql) in PRIMITIVES.items()}
}
