"""What the plans must look like to hold at a thousand times the data."""

import contextlib

import pytest
from pyspark.sql import functions as F

from orderloom.plans import reports, star
from orderloom.plans.star import SourceStar
from orderloom.testbed.adapter import DriverSources
from tests.conftest import SF_SMALL


@contextlib.contextmanager
def settings(spark, **conf):
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot_star(spark, tmp_path_factory):
    """A stored star where a third of all items belong to one order, one customer and one seller."""
    ids = spark.range(60_000)
    hot = F.col("id") % 3 == 0
    name = F.when(hot, "hot").otherwise((F.col("id") % 5_000).cast("string"))
    facts = ids.select(
        F.col("id").cast("int"),
        name.alias("order_id"),
        F.col("id").cast("int").alias("order_item_id"),
        F.when(hot, (F.col("id") % 7_000).cast("string")).otherwise((F.col("id") % 90).cast("string")).alias("product_id"),
        F.when(hot, "hot").otherwise((F.col("id") % 70).cast("string")).alias("seller_id"),
        F.when(hot, "hot").otherwise((F.col("id") % 400).cast("string")).alias("customer_unique_id"),
        (F.col("id") % 1000 / 10).cast("decimal(10,2)").alias("price"),
    )
    day = F.lit("2018-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.xxhash64("order_id") % 300)
    orders = facts.select("order_id").distinct().select(
        "order_id",
        day.alias("order_delivered_customer_date"),
        F.lit("delivered").alias("order_status"),
        day.alias("order_purchase_timestamp"),
    )
    products = facts.select("product_id").distinct().withColumn(
        "product_category_name_english", F.concat(F.lit("c"), F.length("product_id"))
    )
    sellers = facts.select("seller_id").distinct().withColumn("seller_state", F.substring("seller_id", 1, 1))
    root = str(tmp_path_factory.mktemp("hot"))
    tables = {"facts_order_items": facts, "dimension_order_data": orders}
    tables |= {"dimension_product_data": products, "dimension_seller_data": sellers}
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/{name}")
    return star.Star(*[spark.read.parquet(f"{root}/{name}") for name in tables])


# A third of the rows in one partition stands out only among enough partitions.
SKEW = {
    "spark__sql__shuffle__partitions": "40",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
}


def test_a_hot_order_is_split_in_the_join(spark, hot_star):
    for build in (
        lambda: hot_star.lines(with_customer=True),
        lambda: reports.trend_products_by_seller(hot_star),
        lambda: reports.cumulative_product_sales(hot_star),
    ):
        want = sorted(build().collect(), key=str)
        with settings(spark, **SKEW):
            frame = build()
            got = sorted(frame.collect(), key=str)
            assert "skew=true" in _plan(frame)
        assert got == want


def test_orders_are_added_up_before_the_join(spark, hot_star):
    with settings(spark, **SKEW):
        frame = reports.rolling_quarters(hot_star)
        frame.collect()
        assert "skew=true" not in _plan(frame)


@pytest.fixture(scope="module")
def source_star(spark):
    return SourceStar(DriverSources(spark, SF_SMALL))


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_no_report_crosses_tables(spark, source_star, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        frame = reports.REPORTS[name](source_star)
        plan = _plan(frame)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_the_period_reaches_the_scan_and_columns_are_pruned(source_star):
    plan = _plan(reports.top_ten_products_q_sales(source_star))
    assert "GreaterThanOrEqual(o_orderdate,ScalarSubquery" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in plan
    assert "l_shipdate" not in plan and "c_custkey" not in plan
    plan = _plan(reports.cumulative_product_sales(source_star, year=2000))
    assert "GreaterThanOrEqual(o_orderdate,2000-01-01T00:00)" in plan


def test_top_per_category_is_limited_before_the_shuffle(source_star):
    assert _plan(reports.top_ten_products_q_by_category(source_star)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["raise_sales_gradient", "daily_avgs_states_comparison"])
def test_the_fact_is_scanned_once(spark, source_star, name):
    report = reports.REPORTS[f"analytics_{name}"]
    want = sorted(report(source_star).collect(), key=str)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        frame = report(source_star)
        assert sorted(frame.collect(), key=str) == want
        final = _plan(frame).split("Initial Plan")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1, final
    assert "BroadcastHashJoin" not in final


def test_surrogate_ids_need_no_global_window(spark, source_star):
    facts = spark.range(5000).select(
        F.col("id").cast("string").alias("order_id"),
        F.lit(1).alias("order_item_id"),
        *[F.lit("x").alias(name) for name in ("product_id", "seller_id", "customer_unique_id")],
        F.lit(1).cast("decimal(10,2)").alias("price"),
    )
    numbered = star.facts_surrogate_id(facts)
    assert numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 5000, 5000)
    # Numbering has exchanged the rows once and cut the plan; what is left moves one row a range.
    assert "rangepartitioning" not in _plan(numbered) and "hashpartitioning(order_id" not in _plan(numbered)
    # The only unpartitioned window runs over the summary, one row per range.
    assert _plan(numbered).count("SinglePartition") <= 1
