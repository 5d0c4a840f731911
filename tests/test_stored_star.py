"""The stored star: months of the fact, sums that later loads keep right, ids that stay."""

from datetime import date

import pytest

from orderloom.plans import reports, star, stored
from orderloom.plans.star import SourceStar
from orderloom.session import INITIAL, MERGED, PACKED, PARTITIONS, READ, settings, tune
from orderloom.testbed import adapter, queries
from tests.fixtures import customer, day, item, order, product, rows_of, seller, sources, translation
from tests.test_scale import _plan

ORDERS = [
    order("o1", "c1", "2018-01-05", "2018-01-20"), order("o2", "c1", "2018-02-05", "2018-03-02"), order("o3", "c2", "2018-02-07", status="processing"),
    order("o4", "c2", None, "2018-02-11"), order("o5", "c1", "2018-03-31 23:00:00", "2018-04-05"), order("o6", "c3", "2018-04-01", "2018-04-20"),
    order("o7", "c2", "2018-04-02", "2018-04-21"), order("o8", "gone", "2018-02-28", "2018-03-01"),
]
ITEMS = [item(f"o{n}", k, f"p{(n + k) % 4}", f"s{(n * k) % 3}", float(n + k)) for n in range(1, 9) for k in range(1, n % 3 + 3)]
ITEMS += [item("lost", 1, "p1", "s1", 4.0), item(None, 1, "p2", None, 5.0), {**item("o6", 9, "p1", "s1", None)}]
REST = {
    "customers": [customer(f"c{n}", f"u{n % 2}") for n in range(1, 4)],
    "products": [product("p0", "a"), product("p1", "b"), product("p2")],
    "translations": [translation("a", "A"), translation("b", "B")],
    "sellers": [seller("s0", "X"), seller("s1", "Y"), seller("s2", "X")],
}


@pytest.fixture(scope="module")
def everything(spark):
    return sources(spark, orders=ORDERS, order_items=ITEMS, **REST)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Loaded in two parts: both touch February; a product and a seller come with the second, which runs twice."""
    root = str(tmp_path_factory.mktemp("star"))
    early = {"o1", "o2", "o4"}
    first = sources(
        spark, orders=[o for o in ORDERS if o["order_id"] in early], order_items=[i for i in ITEMS if i["order_id"] in early],
        **{**REST, "products": REST["products"][:2], "sellers": REST["sellers"][:2]},
    )
    stored.write_star(first, root)
    before = {tuple(row) for row in rows_of(stored.StoredStar(spark, root).facts, "id", "order_id", "order_item_id")}
    # An order that is stored gets one more item in the second load.
    second = sources(
        spark, orders=[o for o in ORDERS if o["order_id"] not in early - {"o1"}], order_items=[i for i in ITEMS if i["order_id"] not in early], **REST
    )
    for _ in range(2):
        stored.extend_star(second, root, "second")
    return stored.StoredStar(spark, root), before


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_reports_after_a_second_load_equal_a_full_run(everything, loaded, name):
    report = reports.REPORTS[name]
    want = report(SourceStar(everything))
    got = report(loaded[0])
    assert got.columns == want.columns and [f.dataType for f in got.schema.fields] == [f.dataType for f in want.schema.fields]
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_tables_after_a_second_load(spark, everything, loaded):
    of, before = loaded
    whole = SourceStar(everything)
    for attribute in ("orders", "products", "sellers"):
        assert sorted(getattr(of, attribute).collect(), key=str) == sorted(getattr(whole, attribute).collect(), key=str)
    names = ["order_id", "order_item_id", "product_id", "customer_unique_id", "price"]
    assert sorted(rows_of(of.facts, *names), key=str) == sorted(rows_of(whole.facts, *names), key=str)
    now = {tuple(row) for row in rows_of(of.facts, "id", "order_id", "order_item_id")}
    assert before < now and sorted(row[0] for row in now) == list(range(1, len(ITEMS) + 1))
    assert stored.next_id(spark, of.root) == len(ITEMS) + 1
    # Items without a known time of purchase have a folder of their own.
    assert rows_of(of.facts.where("purchase_month IS NULL").select("order_id").distinct().orderBy("order_id")) == [(None,), ("o4",)]
    wide = star.staging_customers_deliveries(whole)
    path = stored.write_staging(of, of.root)
    back = spark.read.parquet(path).select(*wide.columns)
    assert sorted(back.collect(), key=str) == sorted(wide.collect(), key=str)
    star.register_views(of)
    assert spark.sql("SELECT count(*) FROM staging_customers_deliveries").first()[0] == len(ITEMS)


def test_a_load_computes_only_its_months_anew(spark, everything, loaded):
    of, _ = loaded
    touched = {date(2018, 4, 1)}
    old = {path for path in of.sums.inputFiles() if "2018-02" in path or "HIVE_DEFAULT" in path}
    stored.refresh_sums(spark, of.root, touched)
    again = stored.StoredStar(spark, of.root)
    assert old and old <= set(again.sums.inputFiles())
    assert sorted(again.sums.collect(), key=str) == sorted(stored.monthly_sums(again.facts).collect(), key=str)
    plan = _plan(stored.monthly_sums(again.facts))
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_sums_move_the_facts_once(spark, loaded):
    plan = _plan(stored.monthly_sums(loaded[0].facts))
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1, plan


def test_sums_count_an_order_once_in_each_group(spark):
    """A hot order over several products, orders without an id and a product without a price, against plain aggregates."""
    ids = spark.range(900)
    when = stored.F.expr("timestamp_ntz'2018-01-05' + make_dt_interval(cast(id % 70 as int))")
    facts = ids.select(
        stored.F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 > 1 THEN cast(id % 50 as string) END").alias("order_id"),
        stored.F.expr("CASE WHEN id % 7 > 0 THEN cast(id % 5 as string) END").alias("seller_id"),
        stored.F.expr("cast(id % 4 as string)").alias("product_id"),
        stored.F.expr("CASE WHEN id % 11 > 0 THEN cast(id % 6 as string) END").alias("customer_unique_id"),
        stored.F.expr("CASE WHEN id % 4 > 0 THEN cast(id / 10 as decimal(10,2)) END").alias("price"),
        stored.F.when(ids.id % 13 > 0, when).alias(star.DELIVERY),
        stored.F.expr("CASE WHEN id % 2 = 0 THEN 'delivered' END").alias("order_status"),
        stored.F.when(ids.id % 17 > 0, when).alias(star.PURCHASE),
    ).withColumn(stored.MONTH, stored.F.trunc(stored.F.col(star.PURCHASE).cast("date"), "month"))
    sums = stored.monthly_sums(facts)
    for kind, keys in ((stored.BY_PRODUCT, ["seller_id", "product_id"]), (stored.BY_CUSTOMER, ["customer_unique_id", "delivery_month", "order_status"])):
        rows = facts.withColumn("delivery_month", stored.truncate(star.DELIVERY, "month"))
        want = rows.groupBy(stored.MONTH, *keys).agg(
            stored.sum_cents("price"), stored.F.count("price"), stored.F.countDistinct("order_id"),
            stored.F.max(star.DELIVERY), stored.F.min(star.PURCHASE), stored.F.max(star.PURCHASE),
        )
        got = sums.where(stored.F.col("kind") == kind)
        assert sorted(rows_of(got, stored.MONTH, *keys, *got.columns[5:11]), key=str) == sorted(rows_of(want), key=str)


def test_the_two_loads_are_parted_once(spark, tmp_path):
    """Repeated orders of both parts, orders and items without a key, items without an order."""
    lines = [(n % 6 if n % 7 else None, n, 1, n % 4, 1.0, float(n), 0.0, 0.01, "N", "O", day("2018-01-05")) for n in range(40)]
    orders = [(0, 1, "F"), (1, 1, "O"), (2, 2, "F"), (2, 2, "O"), (3, None, "P"), (None, 3, "F"), (9, 3, "F")]
    orders = [(key, customer, status, 1.0, day("2018-01-01"), "1-URGENT") for key, customer, status in orders]
    empty = dict.fromkeys(("customer", "part", "supplier", "nation"), [])
    for name, rows in {"lineitem": lines, "orders": orders, **empty}.items():
        spark.createDataFrame(rows, adapter.RAW[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    src = adapter.DriverSources(spark, str(tmp_path), numbered=True)
    delivered = src.orders.where("order_status = 'delivered'").select("order_id")
    for how, part in zip(("left_semi", "left_anti"), queries._two_loads(spark, str(tmp_path)), strict=True):
        for name in ("orders", "order_items"):
            want, got = getattr(src, name).join(delivered, "order_id", how), getattr(part, name)
            assert sorted(rows_of(got, *want.columns), key=str) == sorted(rows_of(want), key=str)
            assert "Exchange" not in _plan(got)


def test_queries_pack_their_files(spark, tmp_path):
    with settings(spark, dict.fromkeys([INITIAL, MERGED, READ], "16m") | {INITIAL: "16", PACKED: "snappy"}):
        spark.conf.unset(PACKED)
        tune(spark, PARTITIONS)
        spark.range(3).write.parquet(str(tmp_path / "rows"))
    assert list((tmp_path / "rows").glob("*.zstd.parquet"))


def _scans(frame, table):
    """The scans of a stored table in a plan, subqueries included."""
    text = frame._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "FileScan" in line and table in line]


@pytest.mark.parametrize("name", ["top_ten_products_q_sales", "top_ten_products_q_by_category", "cumulative_product_sales", "daily_avgs_states_comparison"])
def test_a_period_opens_its_months_of_the_sums(loaded, name):
    frame = reports.REPORTS[f"analytics_{name}"](loaded[0])
    assert not _scans(frame, stored.FACTS)
    filters = [line.split("PartitionFilters: ")[1].split("PushedFilters")[0] for line in _scans(frame, stored.SUMS)]
    assert any("purchase_month" in text and ">=" in text for text in filters), filters


@pytest.mark.parametrize("name", ["daily_rebates", "seller_rating"])
def test_a_period_opens_its_months_of_the_fact(loaded, name):
    """Without the report's own rank, which cuts the plan."""
    start = loaded[0].orders.agg(stored.F.max(star.PURCHASE).alias("start")).scalar()
    frame = loaded[0].lines(since=start) if name == "seller_rating" else reports.daily_rebates(loaded[0])
    filters = [line.split("PartitionFilters: ")[1].split("PushedFilters")[0] for line in _scans(frame, stored.FACTS)]
    assert any("purchase_month" in text and "trunc" in text for text in filters), filters
    assert frame.count() > 0


@pytest.mark.parametrize("name", ["raise_sales_gradient", "rolling_quarters", "orders_avg_period", "trend_products_by_seller"])
def test_all_of_history_comes_from_the_sums(loaded, name):
    frame = reports.REPORTS[f"analytics_{name}"](loaded[0])
    assert not _scans(frame, stored.FACTS) and _scans(frame, stored.SUMS)
