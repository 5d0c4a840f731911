"""The eleven analytic reports over a star.

Columns and meaning follow the reports' SQL definitions. Ties that SQL leaves open are
broken by the id columns. NULLs sort last everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.numeric import mean_of, money, percent_change, sum_cents, units
from orderloom.functions.temporal import months, truncate
from orderloom.operators.ranking import asc, desc, with_percent_ranks, with_ranks
from orderloom.plans.star import PURCHASE, Star

CATEGORY = "product_category_name_english"
MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def most_valuable_customers(star: Star) -> DataFrame:
    """Customers per delivery month, ranked by what they spent; the month is not shown."""
    groups = star.by_customer("customer_unique_id", "month", delivered_only=True)
    ranked = with_ranks(groups, [("cents", "desc")], tiebreak=["customer_unique_id", "month"], rank="customer_rating")
    shown = ranked.select(
        "customer_unique_id",
        money("cents").alias("total_spent"),
        F.col("orders").alias("total_orders"),
        F.col("last_delivery").alias("last_order_date"),
        "customer_rating",
    )
    return shown.orderBy("customer_rating", asc("customer_unique_id"), asc("last_order_date"))


def rolling_quarters(star: Star) -> DataFrame:
    """Monthly total per customer and its mean over this and the two rows before.

    Orders not delivered form a NULL month, which sorts last. A customer has one row per
    calendar month by the time the window runs, however many orders there are.
    """
    monthly = star.by_customer("customer_unique_id", "month")
    recent = Window.partitionBy("customer_unique_id").orderBy(asc("month")).rowsBetween(-2, 0)
    average = mean_of(units(F.sum("cents").over(recent)), F.count("cents").over(recent))
    rolled = monthly.select(
        "customer_unique_id", "month", money("cents").alias("monthly_total"), average.alias("rolling_quartal_avg")
    )
    return rolled.orderBy(asc("customer_unique_id"), asc("month"))


def _last_quarter_sales(star: Star) -> DataFrame:
    """Sales per product since the start of the quarter of the latest purchase.

    The latest purchase ends the period, so only its start needs testing; as a scalar
    subquery it reaches the scan of the orders, or the folders of a stored star.
    """
    start = star.orders.agg(truncate(F.max(PURCHASE), "quarter").alias("start")).scalar()
    return star.sales("product_id", since=start)


def top_ten_products_q_sales(star: Star, top_n: int = 10) -> DataFrame:
    """Best-selling products of the latest quarter; only the first rows get a number."""
    best = _last_quarter_sales(star).orderBy(desc("cents"), asc("product_id")).limit(top_n)
    place = F.row_number().over(Window.orderBy(desc("cents"), asc("product_id")))
    return best.select(
        "product_id",
        place.cast("bigint").alias("rank_by_quarter_sales"),
        money("cents").alias("total_quarter_sales"),
    ).orderBy("rank_by_quarter_sales")


def top_ten_products_q_by_category(star: Star, top_n: int = 10) -> DataFrame:
    """Best-selling products of the latest quarter in every named category."""
    sales = _last_quarter_sales(star).join(star.products, "product_id", "left")
    in_category = Window.partitionBy(CATEGORY).orderBy(desc("cents"), asc("product_id"))
    ranked = sales.withColumn("rank_by_category", F.row_number().over(in_category))
    kept = ranked.where((F.col("rank_by_category") <= top_n) & F.col(CATEGORY).isNotNull())
    return kept.select(
        CATEGORY,
        "product_id",
        money("cents").alias("total_sales"),
        F.col("rank_by_category").cast("bigint").alias("rank_by_category"),
    ).orderBy(asc(CATEGORY), "rank_by_category")


def _monthly_sales(star: Star, dimension: DataFrame, key: str, attribute: str, since: Column | None = None) -> DataFrame:
    """Cents and number of prices per attribute of the dimension and month of purchase.

    The lines are added up per key and month first, so what is joined has no hot key and is
    smaller than the fact; how it is joined is left to the sizes Spark measures.
    """
    per_key = star.sales(key, "month", since=since).join(dimension, key, "left")
    return per_key.groupBy(attribute, "month").agg(F.sum("cents").alias("cents"), F.sum("prices").alias("prices"))


def raise_sales_gradient(star: Star, top_n: int = 5) -> DataFrame:
    """Monthly growth in percent of the categories that sold most over all time.

    Each category keeps its months, at most one entry per calendar month, until the top is
    known, so the fact is read once. The NULL category may take one of the places, but then
    is not shown.
    """
    monthly = _monthly_sales(star, star.products, "product_id", CATEGORY)
    categories = monthly.groupBy(CATEGORY).agg(
        F.sum("cents").alias("_all_time"), F.collect_list(F.struct("month", "cents")).alias("_months")
    )
    top = categories.orderBy(desc("_all_time"), asc(CATEGORY)).limit(top_n).where(F.col(CATEGORY).isNotNull())
    shown = top.select(CATEGORY, F.inline("_months"))
    before = F.lag("cents").over(Window.partitionBy(CATEGORY).orderBy(asc("month")))
    grown = shown.withColumn("_before", before).where(F.col("_before").isNotNull())
    return grown.select(
        F.col(CATEGORY).alias("product_category"),
        "month",
        percent_change(units("cents"), units("_before")).alias("growth_percentage"),
    ).orderBy(asc("product_category"), asc("month"))


def cumulative_product_sales(star: Star, year: int = 2018) -> DataFrame:
    """Running year-to-date sales per product, one column per month."""
    first, after = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    monthly = star.sales("product_id", "month", since=first, before=after)

    def until(month: int):
        return money(F.sum(F.when(F.month("month") <= month, F.col("cents")).otherwise(0)))

    running = [until(month).alias(name) for month, name in enumerate(MONTH_NAMES, start=1)]
    return monthly.groupBy("product_id").agg(*running)


def daily_rebates(star: Star) -> DataFrame:
    """Sales per day of the month that ends with the latest purchase."""
    cutoff = star.orders.agg((F.max(PURCHASE) - months(1)).alias("cutoff")).scalar()
    recent = star.lines(since=cutoff)
    daily = recent.groupBy(truncate(PURCHASE, "day").alias("day_of_month"))
    return daily.agg(money(sum_cents("price")).alias("daily_rebates"))


def daily_avgs_states_comparison(star: Star) -> DataFrame:
    """Mean item price per seller state in the latest month with sales, against the month before.

    A stored star knows its latest months and only these are read. Else one pass over the fact
    adds everything up per state and month. Each state keeps its months, at most one entry per
    calendar month, until the latest month of all states is known; that last window sees one
    row per state.
    """
    by_state = _monthly_sales(star, star.sellers, "seller_id", "seller_state", star.months_to_compare(2))
    by_state = by_state.where(F.col("month").isNotNull())
    kept = by_state.groupBy("seller_state").agg(
        F.collect_list(F.struct("month", "cents", "prices")).alias("_months"), F.max("month").alias("_last")
    )
    kept = kept.withColumn("_latest", F.max("_last").over(Window.partitionBy()))

    def mean_in(month):
        row = F.get(F.filter("_months", lambda entry: entry["month"] == month), 0)
        return mean_of(units(row["cents"]), row["prices"])

    means = kept.select(
        "seller_state",
        mean_in(F.col("_latest")).alias("_current"),
        mean_in(F.col("_latest") - months(1)).alias("_previous"),
    )
    states = star.sellers.select("seller_state").distinct().join(means, "seller_state", "left")
    current = F.coalesce("_current", F.lit(0.0))
    return states.select(
        F.col("seller_state").alias("state"),
        current.alias("current_avg_order_value"),
        F.coalesce("_previous", F.lit(0.0)).alias("prev_avg_order_value"),
        percent_change(current, F.col("_previous")).alias("percentage_change"),
    )


def seller_rating(star: Star, revenue_weight: float = 0.5, price_weight: float = 0.5) -> DataFrame:
    """Sellers of the last year by weighted percent ranks of revenue and mean price.

    Both percent ranks are 0 for the best seller and the final order is descending, so
    rank 1 is the weakest seller. That is how the report is defined.
    """
    start = star.orders.agg((F.max(PURCHASE) - months(12)).alias("start")).scalar()
    last_year = star.lines(since=start)
    metrics = last_year.groupBy("seller_id").agg(
        sum_cents("price").alias("_revenue"), mean_of(units(sum_cents("price")), F.count("price")).alias("_mean_price")
    )

    metrics = with_percent_ranks(metrics, ["seller_id"], {"_revenue": "_by_revenue", "_mean_price": "_by_price"})
    score = F.lit(revenue_weight) * F.col("_by_revenue") + F.lit(price_weight) * F.col("_by_price")
    scored = metrics.select("seller_id", score.alias("_score"))
    placed = with_ranks(scored, [("_score", "desc")], tiebreak=["seller_id"], row_number="performance_rank")
    return placed.select("seller_id", "performance_rank").orderBy("performance_rank")


def orders_avg_period(star: Star) -> DataFrame:
    """Mean time from an order to the customer's next one, for customers with two or more.

    The gaps of a customer add up to the time from the first order to the last, so no
    window over the customer's orders is needed.
    """
    spans = star.by_customer("customer_unique_id").where(F.col("dated") > 1)
    mean = (F.col("last_purchase") - F.col("first_purchase")) / (F.col("dated") - 1)
    return spans.select("customer_unique_id", mean.alias("interval")).orderBy(desc("interval"), asc("customer_unique_id"))


def trend_products_by_seller(star: Star) -> DataFrame:
    """Number of orders per purchase month, seller and product."""
    counted = star.order_counts().select("month", "seller_id", "product_id", F.col("orders").alias("orders_count"))
    return counted.orderBy(asc("seller_id"), asc("product_id"), asc("month"))


REPORTS: dict[str, Callable[..., DataFrame]] = {
    f"analytics_{report.__name__}": report
    for report in (
        most_valuable_customers,
        rolling_quarters,
        top_ten_products_q_sales,
        top_ten_products_q_by_category,
        raise_sales_gradient,
        cumulative_product_sales,
        daily_rebates,
        daily_avgs_states_comparison,
        seller_rating,
        orders_avg_period,
        trend_products_by_seller,
    )
}


def materialize_report(star: Star, table: str, root: str, **parameters) -> str:
    """Run the report with this table name, store it under `root` and return its path."""
    path = f"{root}/{table}"
    REPORTS[table](star, **parameters).write.mode("overwrite").parquet(path)
    return path


def read_report(spark: SparkSession, table: str, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")
