"""One small query per relational building block, each with the SQL that checks it.

`t` gives a driver table by name. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.messages import decode, publish_envelope
from orderloom.functions.numeric import mean_of, round2, sum_cents, units
from orderloom.functions.temporal import micros, months, truncate
from orderloom.operators.ranking import asc, desc, with_ranks
from orderloom.schemas import MONEY, envelope

Tables = Callable[[str], DataFrame]
PRIMITIVES: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {}


def checked_by(sql: str):
    def register(query: Callable[[Tables], DataFrame]):
        PRIMITIVES[query.__name__] = (query, sql)
        return query

    return register


def price():
    return F.col("l_extendedprice").cast(MONEY)


def same_order():
    return F.col("l_orderkey") == F.col("o_orderkey")


@checked_by("SELECT o_orderkey AS order_id, o_orderdate AS purchased, o_orderstatus, o_totalprice FROM orders")
def op_project_alias(t: Tables) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("purchased"), "o_orderstatus", "o_totalprice"
    )


@checked_by("""SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity >= 10 AND l_quantity < 40 AND l_discount <= 0.05""")
def op_filter_compare(t: Tables) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    amount = (F.col("l_quantity") >= 10) & (F.col("l_quantity") < 40)
    kept = t("lineitem").where(returned & amount & (F.col("l_discount") <= 0.05))
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


@checked_by("""SELECT o_orderkey, closed FROM
    (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS closed FROM orders)
    WHERE closed IS NOT NULL""")
def op_filter_null(t: Tables) -> DataFrame:
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return t("orders").select("o_orderkey", closed.alias("closed")).where(F.col("closed").isNotNull())


@checked_by("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate BETWEEN
    (SELECT max(o_orderdate) - INTERVAL 1 YEAR FROM orders) AND (SELECT max(o_orderdate) FROM orders)""")
def op_between(t: Tables) -> DataFrame:
    last = t("orders").agg(F.max("o_orderdate").alias("last"))
    year_before = last.select(F.col("last") - months(12))
    inside = F.col("o_orderdate").between(year_before.scalar(), last.scalar())
    return t("orders").where(inside).select("o_orderkey", "o_orderdate")


@checked_by("""SELECT p_partkey, p_brand FROM part WHERE p_brand IN
    (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 5)""")
def op_in_subquery(t: Tables) -> DataFrame:
    brands = t("part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(desc("n"), asc("p_brand")).limit(5)
    return t("part").join(brands.select("p_brand"), "p_brand", "left_semi").select("p_partkey", "p_brand")


@checked_by("""SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def op_left_join(t: Tables) -> DataFrame:
    joined = t("orders").join(t("lineitem"), same_order(), "left")
    return joined.select("o_orderkey", "l_partkey", "l_quantity")


@checked_by("""SELECT l_orderkey, o_custkey, l_suppkey, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def op_inner_join(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("orders"), same_order())
    return joined.select("l_orderkey", "o_custkey", "l_suppkey", "l_quantity")


@checked_by("""WITH latest AS (SELECT date_trunc('quarter', max(o_orderdate)) AS start FROM orders)
    SELECT o_orderkey, o_orderdate FROM orders CROSS JOIN latest
    WHERE o_orderdate >= latest.start AND o_orderdate < latest.start + INTERVAL 3 MONTH""")
def op_cross_join_scalar(t: Tables) -> DataFrame:
    # The one-row side is a scalar subquery, so the bound reaches the scan and nothing is crossed.
    start = t("orders").agg(truncate(F.max("o_orderdate"), "quarter").alias("start")).scalar()
    ordered = F.col("o_orderdate")
    return t("orders").where((ordered >= start) & (ordered < start + months(3))).select("o_orderkey", "o_orderdate")


@checked_by("""SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def op_anti_join_absent(t: Tables) -> DataFrame:
    return t("orders").join(t("lineitem"), same_order(), "left_anti").select("o_orderkey", "o_custkey")


@checked_by("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def op_distinct(t: Tables) -> DataFrame:
    return t("orders").select("o_custkey", "o_orderstatus").distinct()


@checked_by("""WITH monthly AS (SELECT date_trunc('month', l_shipdate) AS month,
        sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS sales FROM lineitem GROUP BY 1),
    best AS (SELECT max(sales) AS top_sales FROM monthly)
    SELECT month, CAST(sales AS DOUBLE) AS sales FROM monthly, best WHERE sales * 2 >= top_sales""")
def op_cte_chain(t: Tables) -> DataFrame:
    monthly = t("lineitem").groupBy(truncate("l_shipdate", "month").alias("month")).agg(F.sum(price()).alias("sales"))
    best = monthly.agg(F.max("sales")).scalar()
    return monthly.where(F.col("sales") * 2 >= best).select("month", F.col("sales").cast("double").alias("sales"))


@checked_by("""SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) AS revenue,
    max(l_shipdate) AS last_shipped, CAST(sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS DOUBLE) / count(*) AS mean_price,
    count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_suppkey""")
def op_hash_agg(t: Tables) -> DataFrame:
    return t("lineitem").groupBy("l_suppkey").agg(
        F.sum(price()).cast("double").alias("revenue"),
        F.max("l_shipdate").alias("last_shipped"),
        mean_of(units(sum_cents(price())), F.count("*")).alias("mean_price"),
        F.countDistinct("l_orderkey").alias("orders"),
    )


@checked_by("SELECT max(o_orderdate) AS last_order, count(*) AS orders FROM orders")
def op_global_agg(t: Tables) -> DataFrame:
    return t("orders").agg(F.max("o_orderdate").alias("last_order"), F.count("*").alias("orders"))


@checked_by("""SELECT date_trunc('month', o_orderdate) AS month, o_orderstatus, count(*) AS orders
    FROM orders GROUP BY 1, 2""")
def op_group_by_expr(t: Tables) -> DataFrame:
    grouped = t("orders").groupBy(truncate("o_orderdate", "month").alias("month"), "o_orderstatus")
    return grouped.agg(F.count("*").alias("orders"))


@checked_by("""SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned,
    sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END)::BIGINT AS kept FROM lineitem GROUP BY l_suppkey""")
def op_agg_case(t: Tables) -> DataFrame:
    def lines_with(flag: str):
        return F.sum(F.when(F.col("l_returnflag") == flag, 1).otherwise(0))

    return t("lineitem").groupBy("l_suppkey").agg(lines_with("R").alias("returned"), lines_with("N").alias("kept"))


@checked_by("""SELECT l_suppkey, CAST(round(CAST(sum(date_diff('microsecond', o_orderdate, l_shipdate)) AS DECIMAL(28,6))
        / count(*) / 1000000, 2) AS DOUBLE) AS mean_seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey""")
def op_agg_interval(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("orders"), same_order())
    means = joined.groupBy("l_suppkey").agg(F.avg(F.col("l_shipdate") - F.col("o_orderdate")).alias("mean_wait"))
    # An interval counted from a fixed day, to show it as seconds.
    day = F.lit("2000-01-01").cast("timestamp_ntz")
    seconds = micros(day + F.col("mean_wait"), day).cast("decimal(28,6)") / 1000000
    return means.select("l_suppkey", F.round(seconds, 2).cast("double").alias("mean_seconds"))


@checked_by("""SELECT o_custkey, orders, rank() OVER (ORDER BY orders DESC) AS place
    FROM (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey)""")
def op_rank(t: Tables) -> DataFrame:
    counts = t("orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    return with_ranks(counts, [("orders", "desc")], tiebreak=["o_custkey"], rank="place")


@checked_by("""SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS place,
    row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS place_in_brand FROM part""")
def op_row_number(t: Tables) -> DataFrame:
    by_price = {"order_by": [("p_retailprice", "desc")], "tiebreak": ["p_partkey"]}
    parts = with_ranks(t("part").select("p_partkey", "p_brand", "p_retailprice"), row_number="place", **by_price)
    parts = with_ranks(parts, partition_by=["p_brand"], row_number="place_in_brand", **by_price)
    return parts.drop("p_retailprice")


@checked_by("""SELECT c_custkey, percent_rank() OVER (ORDER BY c_nationkey DESC) AS share FROM customer""")
def op_percent_rank(t: Tables) -> DataFrame:
    customers = t("customer").select("c_custkey", "c_nationkey")
    ranked = with_ranks(customers, [("c_nationkey", "desc")], tiebreak=["c_custkey"], percent_rank="share")
    return ranked.drop("c_nationkey")


_MONTHLY = """(SELECT o_orderstatus, date_trunc('month', o_orderdate) AS month, count(*) AS orders
    FROM orders GROUP BY 1, 2)"""


def _monthly_orders(t: Tables) -> DataFrame:
    grouped = t("orders").groupBy("o_orderstatus", truncate("o_orderdate", "month").alias("month"))
    return grouped.agg(F.count("*").alias("orders"))


@checked_by(f"""SELECT o_orderstatus, month, orders,
    lag(orders) OVER (PARTITION BY o_orderstatus ORDER BY month) AS orders_before FROM {_MONTHLY}""")
def op_lag(t: Tables) -> DataFrame:
    # Added up per month first, so that a partition holds calendar months, not orders.
    in_time = Window.partitionBy("o_orderstatus").orderBy(asc("month"))
    return _monthly_orders(t).withColumn("orders_before", F.lag("orders").over(in_time))


@checked_by("""SELECT o_custkey, day, lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS next_day
    FROM (SELECT DISTINCT o_custkey, date_trunc('day', o_orderdate) AS day FROM orders)""")
def op_lead(t: Tables) -> DataFrame:
    # Distinct first: a customer has at most one row per calendar day.
    days = t("orders").select("o_custkey", truncate("o_orderdate", "day").alias("day")).distinct()
    in_time = Window.partitionBy("o_custkey").orderBy(asc("day"))
    return days.withColumn("next_day", F.lead("day").over(in_time))


@checked_by(f"""SELECT o_orderstatus, month, CAST(sum(orders) OVER w AS DOUBLE) / count(orders) OVER w AS rolling_mean
    FROM {_MONTHLY} WINDOW w AS (PARTITION BY o_orderstatus ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def op_rows_frame(t: Tables) -> DataFrame:
    recent = Window.partitionBy("o_orderstatus").orderBy(asc("month")).rowsBetween(-2, 0)
    average = mean_of(F.sum("orders").over(recent), F.count("orders").over(recent))
    return _monthly_orders(t).select("o_orderstatus", "month", average.alias("rolling_mean"))


@checked_by("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    ORDER BY c_mktsegment ASC NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey""")
def op_sort(t: Tables) -> DataFrame:
    rows = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return rows.orderBy(asc("c_mktsegment"), desc("c_acctbal"), asc("c_custkey"))


@checked_by("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def op_top_k(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", "o_totalprice").orderBy(desc("o_totalprice"), asc("o_orderkey")).limit(10)


@checked_by("""SELECT o_orderkey, date_trunc('day', o_orderdate) AS day, date_trunc('month', o_orderdate) AS month,
    date_trunc('quarter', o_orderdate) AS quarter FROM orders""")
def op_date_trunc(t: Tables) -> DataFrame:
    units = ["day", "month", "quarter"]
    return t("orders").select("o_orderkey", *[truncate("o_orderdate", unit).alias(unit) for unit in units])


@checked_by("""SELECT o_orderkey, extract(month FROM o_orderdate) AS month, extract(year FROM o_orderdate) AS year
    FROM orders""")
def op_extract(t: Tables) -> DataFrame:
    parts = {"month": F.month("o_orderdate"), "year": F.year("o_orderdate")}
    return t("orders").select("o_orderkey", *[part.cast("bigint").alias(name) for name, part in parts.items()])


@checked_by("""SELECT o_orderkey, o_orderdate - INTERVAL 1 MONTH AS month_before, o_orderdate - INTERVAL 2 MONTH AS
    two_months_before, o_orderdate + INTERVAL 3 MONTH AS quarter_after, o_orderdate - INTERVAL 1 YEAR AS year_before
    FROM orders""")
def op_interval_arith(t: Tables) -> DataFrame:
    ordered = F.col("o_orderdate")
    return t("orders").select(
        "o_orderkey",
        (ordered - months(1)).alias("month_before"),
        (ordered - months(2)).alias("two_months_before"),
        (ordered + months(3)).alias("quarter_after"),
        (ordered - months(12)).alias("year_before"),
    )


@checked_by("""SELECT l_orderkey, l_shipdate, date_diff('microsecond', o_orderdate, l_shipdate) / 1e6 AS wait_seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def op_ts_diff(t: Tables) -> DataFrame:
    joined = t("lineitem").join(t("orders"), same_order())
    wait = micros(F.col("l_shipdate"), F.col("o_orderdate")).cast("double") / 1e6
    return joined.select("l_orderkey", "l_shipdate", wait.alias("wait_seconds"))


@checked_by("""SELECT o_orderkey, l_partkey, coalesce(l_quantity, 0) AS quantity, nullif(l_discount, 0) AS discount
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def op_null_scalar(t: Tables) -> DataFrame:
    joined = t("orders").join(t("lineitem"), same_order(), "left")
    return joined.select(
        "o_orderkey",
        "l_partkey",
        F.coalesce("l_quantity", F.lit(0.0)).alias("quantity"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
    )


@checked_by("""SELECT l_orderkey, l_partkey, CAST(round(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,10)), 2)
        AS DOUBLE) AS net, CAST(round(CAST((l_tax - l_discount) / (1 + l_tax) * 100 AS DECIMAL(28,10)), 2) AS DOUBLE)
        AS spread FROM lineitem""")
def op_math(t: Tables) -> DataFrame:
    tax, discount = F.col("l_tax"), F.col("l_discount")
    return t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        round2(F.col("l_extendedprice") * (1 - discount)).alias("net"),
        round2((tax - discount) / (1 + tax) * 100).alias("spread"),
    )


@checked_by("""SELECT o_orderkey, CASE WHEN o_totalprice >= 200000 THEN 'large' WHEN o_totalprice >= 50000 THEN 'middle'
    ELSE 'small' END AS size FROM orders""")
def op_case(t: Tables) -> DataFrame:
    total_price = F.col("o_totalprice")
    size = F.when(total_price >= 200000, "large").when(total_price >= 50000, "middle").otherwise("small")
    return t("orders").select("o_orderkey", size.alias("size"))


@checked_by("""SELECT event_id, replace(replace(props, '"', chr(39)), chr(39), '?') AS props FROM events""")
def op_string_replace(t: Tables) -> DataFrame:
    quoted = F.replace("props", F.lit('"'), F.lit("'"))
    return t("events").select("event_id", F.replace(quoted, F.lit("'"), F.lit("?")).alias("props"))


@checked_by("""SELECT event_id, 1700000000000 + event_id AS timestamp, event_type, value, NULL::VARCHAR AS missing
    FROM events""")
def op_json(t: Tables) -> DataFrame:
    stamp = F.lit(1700000000000) + F.col("event_id")
    messages = publish_envelope(t("events").select("event_id", "event_type", "value"), stamp)
    row = "event_id bigint, event_type string, value double, missing string"
    read = decode(messages, envelope(T.StructType.fromDDL(row)))
    return read.select("message.timestamp", "message.data.*")
