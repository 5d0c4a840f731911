"""Hand-made rows with known answers, for what the driver's tables do not hold."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from orderloom.plans import reports, star
from orderloom.plans.star import SourceStar
from orderloom.testbed.adapter import DriverSources
from tests.conftest import SF_SMALL
from tests.fixtures import customer, item, order, product, rows_of, seller, sources, translation


def _month(year, month):
    return datetime(year, month, 1)


def test_item_without_order_and_order_without_customer(spark):
    src = sources(
        spark,
        orders=[order("o1", "c1", "2018-01-05"), order("o2", "gone", "2018-01-06")],
        customers=[customer("c1", "u1")],
        order_items=[
            item("o1", 1, "p", "s", 1.5),
            item("o2", 1, "p", "s", 2.5),
            item("lost", 1, "p", "s", 3.5),
            item(None, 1, "p", "s", 4.5),
        ],
    )
    facts = rows_of(star.facts_order_items(src), "order_id", "customer_unique_id", "price")
    assert sorted(facts, key=lambda row: row[2]) == [
        ("o1", "u1", Decimal("1.50")),
        ("o2", None, Decimal("2.50")),
        (None, None, Decimal("3.50")),
        (None, None, Decimal("4.50")),
    ]
    ids = rows_of(star.facts_surrogate_id(star.facts_order_items(src)), "id", "order_id", "price")
    assert sorted(ids) == [
        (1, "o1", Decimal("1.50")),
        (2, "o2", Decimal("2.50")),
        (3, None, Decimal("3.50")),
        (4, None, Decimal("4.50")),
    ]
    wide = star.staging_customers_deliveries(SourceStar(src))
    assert wide.count() == 4 and len(wide.columns) == 10


def test_customers_are_ranked_per_month_with_ties(spark):
    src = sources(
        spark,
        orders=[
            order("o1", "a", "2018-01-01", "2018-01-10"),
            order("o2", "a", "2018-01-02", "2018-01-20"),
            order("o3", "a", "2018-02-01", "2018-02-10"),
            order("o4", "b", "2018-01-01", "2018-01-11"),
            order("o5", "b", "2018-03-01", "2018-03-11", status="canceled"),
        ],
        customers=[customer("a"), customer("b")],
        order_items=[
            item("o1", 1, "p", "s", 10.0),
            item("o1", 2, "p", "s", 5.0),
            item("o2", 1, "p", "s", 5.0),
            item("o3", 1, "p", "s", 7.0),
            item("o4", 1, "p", "s", 20.0),
            item("o5", 1, "p", "s", 99.0),
        ],
    )
    assert rows_of(reports.most_valuable_customers(SourceStar(src))) == [
        ("a", Decimal("20.00"), 2, datetime(2018, 1, 20), 1),
        ("b", Decimal("20.00"), 1, datetime(2018, 1, 11), 1),
        ("a", Decimal("7.00"), 1, datetime(2018, 2, 10), 3),
    ]


def test_rolling_mean_takes_three_rows_and_the_null_month_last(spark):
    src = sources(
        spark,
        orders=[
            order("o1", "a", "2018-01-01", "2018-01-10"),
            order("o2", "a", "2018-01-01", "2018-03-10"),
            order("o3", "a", "2018-01-01", "2018-09-10"),
            order("o4", "a", "2018-01-01", None, status="processing"),
        ],
        customers=[customer("a")],
        order_items=[item(f"o{n}", 1, "p", "s", price) for n, price in [(1, 1.0), (2, 2.0), (3, 6.0), (4, 40.0)]],
    )
    assert rows_of(reports.rolling_quarters(SourceStar(src)), "month", "rolling_quartal_avg") == [
        (_month(2018, 1), 1.0),
        (_month(2018, 3), 1.5),
        (_month(2018, 9), 3.0),
        (None, 16.0),
    ]


def _category_sales(spark):
    """Categories x (grows), y (one month only) and unnamed products; the quarter starts in April."""
    return sources(
        spark,
        orders=[
            order("jan", "a", "2018-01-05"),
            order("mar", "a", "2018-03-31 23:59:59"),
            order("apr", "a", "2018-04-01"),
            order("may", "a", "2018-05-02"),
        ],
        customers=[customer("a")],
        products=[product("p1", "equis"), product("p2", "equis"), product("p3", "ye"), product("p4"), product("p5", "?")],
        translations=[translation("equis", "x"), translation("ye", "y")],
        order_items=[
            item("jan", 1, "p1", "s", 100.0),
            item("mar", 1, "p1", "s", 150.0),
            item("apr", 1, "p1", "s", 30.0),
            item("apr", 2, "p2", "s", 30.0),
            item("may", 1, "p2", "s", 15.0),
            item("may", 2, "p3", "s", 20.0),
            item("may", 3, "p4", "s", 500.0),
            item("may", 4, "p5", "s", 1.0),
            item("lost", 1, "p1", "s", 5.0),
        ],
    )


def test_views_serve_sql(spark):
    src = _category_sales(spark)
    star.register_views(SourceStar(src), src)
    counted = spark.sql("""
        SELECT order_status, count(*) AS items FROM facts_order_items f
        LEFT JOIN dimension_order_data USING (order_id) GROUP BY order_status""")
    assert sorted(rows_of(counted), key=str) == [("delivered", 8), (None, 1)]
    assert spark.table("src_products").count() == 5


def test_top_products_of_the_quarter(spark):
    of = SourceStar(_category_sales(spark))
    assert rows_of(reports.top_ten_products_q_sales(of, top_n=3)) == [
        ("p4", 1, Decimal("500.00")),
        ("p2", 2, Decimal("45.00")),
        ("p1", 3, Decimal("30.00")),
    ]
    assert rows_of(reports.top_ten_products_q_by_category(of)) == [
        ("x", "p2", Decimal("45.00"), 1),
        ("x", "p1", Decimal("30.00"), 2),
        ("y", "p3", Decimal("20.00"), 1),
    ]


def test_growth_counts_the_unnamed_category_but_does_not_show_it(spark):
    of = SourceStar(_category_sales(spark))
    grown = [
        ("x", _month(2018, 3), 50.0),
        ("x", _month(2018, 4), -60.0),
        ("x", _month(2018, 5), -75.0),
        ("x", None, -66.67),
    ]
    assert rows_of(reports.raise_sales_gradient(of)) == grown
    # The unnamed category takes the first of two places, x the other.
    assert rows_of(reports.raise_sales_gradient(of, top_n=2)) == grown
    assert rows_of(reports.raise_sales_gradient(of, top_n=1)) == []


def test_year_to_date(spark):
    of = SourceStar(_category_sales(spark))
    running = {row["product_id"]: row for row in reports.cumulative_product_sales(of).collect()}
    months = [running["p1"][name] for name in reports.MONTH_NAMES]
    assert months == [Decimal(n) for n in [100, 100, 250] + [280] * 9]
    assert set(running) == {"p1", "p2", "p3", "p4", "p5"}
    assert reports.cumulative_product_sales(of, year=2017).isEmpty()


def test_year_to_date_never_falls(spark):
    rows = reports.cumulative_product_sales(SourceStar(DriverSources(spark, SF_SMALL)), year=2000).collect()
    assert rows
    for row in rows:
        values = [row[name] for name in reports.MONTH_NAMES]
        assert values == sorted(values)


def test_daily_sales_start_one_month_before_the_latest_purchase(spark):
    src = sources(
        spark,
        orders=[
            order("o1", "a", "2018-02-28 09:59:59"),
            order("o2", "a", "2018-02-28 10:00:00"),
            order("o3", "a", "2018-03-31 10:00:00"),
        ],
        order_items=[item(f"o{n}", 1, "p", "s", float(n)) for n in (1, 2, 3)],
    )
    # 31 March less a month is the end of February.
    assert sorted(rows_of(reports.daily_rebates(SourceStar(src)))) == [
        (datetime(2018, 2, 28), Decimal("2.00")),
        (datetime(2018, 3, 31), Decimal("3.00")),
    ]


def test_states_compare_the_latest_month_with_sales(spark):
    src = sources(
        spark,
        orders=[
            order("mar", "a", "2018-03-05"),
            order("apr", "a", "2018-04-05"),
            order("empty", "a", "2018-06-05"),
        ],
        sellers=[seller("s1", "S"), seller("s2", "T"), seller("s3", "U"), seller("s4", None), seller("s5", "V")],
        order_items=[
            item("mar", 1, "p", "s1", 10.0),
            item("apr", 1, "p", "s1", 15.0),
            item("apr", 2, "p", "s1", 20.0),
            item("apr", 3, "p", "s2", 8.0),
            item("mar", 2, "p", "s3", 4.0),
            item("apr", 4, "p", "s4", 77.0),
            item("mar", 3, "p", "s5", 0.0),
        ],
    )
    compared = rows_of(reports.daily_avgs_states_comparison(SourceStar(src)))
    assert sorted(compared, key=str) == sorted(
        [
            ("S", 17.5, 10.0, 75.0),
            ("T", 8.0, 0.0, None),
            ("U", 0.0, 4.0, -100.0),
            ("V", 0.0, 0.0, None),
            (None, 0.0, 0.0, None),
        ],
        key=str,
    )


def test_weakest_seller_comes_first(spark):
    src = sources(
        spark,
        orders=[order("old", "a", "2017-03-31"), order("first", "a", "2017-04-01"), order("last", "a", "2018-04-01")],
        order_items=[
            item("old", 1, "p", "gone", 1000.0),
            item("first", 1, "p", "weak", 1.0),
            item("last", 1, "p", "strong", 50.0),
            item("last", 2, "p", "middle", 20.0),
            item("last", 3, "p", "equal", 20.0),
        ],
    )
    assert rows_of(reports.seller_rating(SourceStar(src))) == [("weak", 1), ("equal", 2), ("middle", 3), ("strong", 4)]


def test_mean_period_needs_two_dated_orders(spark):
    src = sources(
        spark,
        orders=[
            order("o1", "a", "2018-01-01"),
            order("o2", "a", "2018-01-11"),
            order("o3", "a", "2018-01-31"),
            order("o4", "a", None),
            order("o5", "b", "2018-01-01"),
            order("o6", "b", None),
            order("o7", "c", "2018-01-01"),
            order("o8", "c", "2018-01-01"),
            order("none", "c", "2019-01-01"),
        ],
        customers=[customer(name) for name in "abc"],
        order_items=[item(f"o{n}", number, "p", "s", 1.0) for n in range(1, 9) for number in (1, 2)],
    )
    assert rows_of(reports.orders_avg_period(SourceStar(src))) == [
        ("a", timedelta(days=15)),
        ("c", timedelta(0)),
    ]


def test_trend_counts_orders_once_and_skips_unknown_orders(spark):
    src = sources(
        spark,
        orders=[order("o1", "a", "2018-01-05"), order("o2", "a", "2018-01-09", status=None), order("o3", "a", None)],
        order_items=[
            item("o1", 1, "p", "s", 1.0),
            item("o1", 2, "p", "s", 1.0),
            item("o2", 1, "p", "s", 1.0),
            item("o3", 1, "p", "s", 1.0),
            item("lost", 1, "p", "s", 1.0),
        ],
    )
    assert rows_of(reports.trend_products_by_seller(SourceStar(src))) == [
        (_month(2018, 1), "s", "p", 2),
        (None, "s", "p", 1),
    ]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("star"))
    star.write_star(DriverSources(spark, SF_SMALL, numbered=True), root)
    return root


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_stored_star_gives_the_same_reports(spark, stored, name):
    parameters = {"year": 2000} if "cumulative" in name else {}
    reports.materialize_report(star.read_star(spark, stored), name, stored, **parameters)
    got = reports.read_report(spark, name, stored)
    want = reports.REPORTS[name](SourceStar(DriverSources(spark, SF_SMALL)), **parameters)
    assert got.columns == want.columns
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)
