"""Range-wise ranks must equal Spark's own windows on every row."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators.ranking import asc, desc, with_ranks
from orderloom.session import INITIAL, MERGED, MERGED_BYTES, READ, tune
from orderloom.testbed import adapter


def _rows(spark, n, hot_share):
    """Ids 0..n-1 with NULLs, ties and one value that holds `hot_share` of the rows."""
    ids = spark.range(n)
    draw = F.pmod(F.xxhash64("id"), F.lit(1000))
    value = F.when(draw < hot_share * 1000, 7).when(draw > 980, None).otherwise(draw % 40)
    group = F.when(draw < hot_share * 1000, "hot").when(draw > 970, None).otherwise((draw % 5).cast("string"))
    return ids.select("id", group.alias("g"), value.cast("int").alias("v"))


def _same(left, right):
    assert left.columns == right.columns
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("ranges", [1, 7, 23, None])
@pytest.mark.parametrize("way", ["asc", "desc"])
def test_global_ranks(spark, ranges, way):
    rows = _rows(spark, 3000, 0.4)
    got = with_ranks(
        rows, [("v", way)], tiebreak=["id"], row_number="rn", rank="r", percent_rank="pr", ranges=ranges
    )
    value = desc("v") if way == "desc" else asc("v")
    by_value = Window.orderBy(value)
    want = rows.select(
        "*",
        F.row_number().over(Window.orderBy(value, "id")).cast("bigint").alias("rn"),
        F.rank().over(by_value).cast("bigint").alias("r"),
        F.percent_rank().over(by_value).alias("pr"),
    )
    _same(got, want)


@pytest.mark.parametrize("ranges", [1, 11, 40])
def test_ranks_within_partitions(spark, ranges):
    rows = _rows(spark, 3000, 0.35)
    got = with_ranks(
        rows, [("v", "desc")], partition_by=["g"], tiebreak=["id"], row_number="rn", rank="r", ranges=ranges
    )
    by_value = Window.partitionBy("g").orderBy(desc("v"))
    want = rows.select(
        "*",
        F.row_number().over(Window.partitionBy("g").orderBy(desc("v"), "id")).cast("bigint").alias("rn"),
        F.rank().over(by_value).cast("bigint").alias("r"),
    )
    _same(got, want)


def test_hot_value_is_spread_over_ranges(spark):
    rows = _rows(spark, 4000, 0.5).where("v = 7")
    ranked = rows.repartitionByRange(8, desc("v"), asc("id")).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in ranked.collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * rows.count() / 8


def test_one_row_and_no_row(spark):
    one = with_ranks(spark.range(1), [("id", "asc")], row_number="rn", percent_rank="pr")
    assert [tuple(row) for row in one.collect()] == [(0, 1, 0.0)]
    assert with_ranks(spark.range(0), [("id", "asc")], row_number="rn").isEmpty()


def test_items_of_hot_orders_are_numbered_over_ranges(spark):
    rows = [(order, n, order, n % 3, float(n % 5)) for order in (1, 2, None) for n in range(40 if order == 2 else 7)]
    names = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double"
    lines = spark.createDataFrame(rows, names).withColumns({name: F.lit(None).cast("double") for name in ("l_quantity", "l_discount", "l_tax")})
    lines = lines.withColumn("l_shipdate", F.lit(None).cast("timestamp_ntz")).repartition(5)
    want = {(order, n, n + 1) for order, n, *_ in rows}
    for hot in (100, 10, 3):
        found = adapter._numbered(lines, hot).select("l_orderkey", "l_linenumber", "_number").collect()
        assert len(found) == len(rows) and {tuple(row) for row in found} == want


def test_ranges_are_stored_where_columns_can_be_left_out(spark):
    ranked = with_ranks(spark.range(100).withColumn("text", F.lit("long")), [("id", "asc")], row_number="rn")
    assert "FileScan parquet" in ranked._jdf.queryExecution().executedPlan().toString()


def test_a_large_querys_shuffles_start_with_many_partitions(spark):
    names = (INITIAL, MERGED, READ)
    before = [spark.conf.get(name, None) for name in names]
    try:
        for name in names:
            spark.conf.unset(name)
        assert [tune(spark, 256).conf.get(name) for name in names] == ["256", MERGED_BYTES, MERGED_BYTES]
        for name in names:
            spark.conf.set(name, "9000000")
        assert [tune(spark, 256).conf.get(name) for name in names] == ["9000000"] * 3
    finally:
        for name, value in zip(names, before, strict=True):
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
