"""Ranks, row numbers and percent ranks that no single task has to compute.

A window without PARTITION BY, or with one hot partition, sends all its rows to one task.
Here the rows are range-partitioned on the complete sort key instead, so even a run of
equal values is spread over many ranges. Each range is ranked by itself; one summary row
per range then says how many rows come before it and where the group it begins with
began. The ranged rows are stored once, in Parquet, because both steps must see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.session import shared_dir, store

def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def _order(sorts: list[tuple[str, str]]) -> list[Column]:
    return [desc(name) if way == "desc" else asc(name) for name, way in sorts]


def with_ranks(
    rows: DataFrame,
    order_by: list[tuple[str, str]],
    *,
    partition_by: list[str] | None = None,
    tiebreak: list[str] | None = None,
    row_number: str | None = None,
    rank: str | None = None,
    percent_rank: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add the named rank columns, as SQL defines them.

    `order_by` holds pairs of column name and "asc" or "desc"; NULLs sort last either way.
    `tiebreak` columns order rows that are equal under `order_by` for `row_number`, and let
    their ranges be split; they do not change `rank` and `percent_rank`. By default Spark
    chooses the number of ranges from the data volume.
    """
    shared_dir(rows.sparkSession)
    partition_by, tiebreak = partition_by or [], tiebreak or []
    if percent_rank and partition_by:
        raise ValueError("percent_rank takes no partition_by")
    sorts = [(name, "asc") for name in partition_by] + order_by + [(name, "asc") for name in tiebreak]
    order = _order(sorts)
    if row_number and not (rank or percent_rank or partition_by):
        return _numbered(rows, order, row_number, ranges)
    # Columns that define a group: the partition, and the partition with the ranked values.
    levels = {"p": len(partition_by)} if partition_by else {}
    if rank or percent_rank:
        levels["v"] = len(partition_by) + len(order_by)

    ranged = rows.repartitionByRange(*([ranges] if ranges else []), *order)
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    in_range = Window.partitionBy("_range")
    ranged = ranged.withColumn("_pos", F.row_number().over(in_range.orderBy(*order)).cast("bigint"))
    for level, width in levels.items():
        start = F.rank().over(in_range.orderBy(*order[:width]))
        ranged = ranged.withColumn(f"_start_{level}", start.cast("bigint"))
    ranged = store(ranged, "ranged")

    summary = _summary(ranged, {level: [name for name, _ in sorts[:width]] for level, width in levels.items()})
    placed = ranged.join(F.broadcast(summary), "_range")
    position = F.col("_before") + F.col("_pos")

    def first_position(level: str) -> Column:
        here = F.col("_before") + F.col(f"_start_{level}")
        return F.when(F.col(f"_start_{level}") == 1, F.coalesce(f"_began_{level}", here)).otherwise(here)

    group_start = first_position("p") if partition_by else F.lit(1).cast("bigint")
    added = {}
    if row_number:
        added[row_number] = position - group_start + 1
    if rank:
        added[rank] = first_position("v") - group_start + 1
    if percent_rank:
        share = F.try_divide((first_position("v") - 1).cast("double"), (F.col("_total") - 1).cast("double"))
        added[percent_rank] = F.coalesce(share, F.lit(0.0))
    return placed.select(*rows.columns, *[value.alias(name) for name, value in added.items()])


def with_percent_ranks(rows: DataFrame, ids: list[str], ranked: dict[str, str]) -> DataFrame:
    """The ids and a percent rank, descending, for each ranked column: one range partition, stored once, for all.

    Each row stands once for every column it is ranked by; the columns are ranked side by side
    as partitions, and the ranks of an id come together again in one aggregate. `ids` name a
    row; NULLs rank last.
    """
    values = [F.struct(F.lit(n).alias("_which"), *_only(list(ranked), n)) for n in range(len(ranked))]
    long = rows.select(*ids, F.explode(F.array(*values)).alias("_value")).select(*ids, "_value.*")
    order = [(f"_value_{n}", "desc") for n in range(len(ranked))]
    placed = with_ranks(long, order, partition_by=["_which"], tiebreak=ids, rank="_rank")
    others = placed.agg((F.count("*") / len(ranked) - 1).alias("others")).scalar()

    def share(n: int) -> Column:
        return F.coalesce(F.try_divide((F.max(F.when(F.col("_which") == n, F.col("_rank"))) - 1).cast("double"), others), F.lit(0.0))

    return placed.groupBy(*ids).agg(*[share(n).alias(name) for n, name in enumerate(ranked.values())])


def _only(columns: list[str], n: int) -> list[Column]:
    """All columns, but NULL in place of those that are not the n-th."""
    return [
        (F.col(name) if k == n else F.when(F.lit(False), F.col(name))).alias(f"_value_{k}") for k, name in enumerate(columns)
    ]


def _numbered(rows: DataFrame, order: list[Column], row_number: str, ranges: int | None) -> DataFrame:
    """Row numbers over all rows: one exchange, a sort within the ranges and no window over them.

    An id that grows within a range holds the range in its upper bits and the place in its
    lower 33, so both are read off it; what comes before a range is summed over one row a range.
    """
    ranged = rows.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_place", F.monotonically_increasing_id())
    ranged = store(ranged, "ranged")
    span = F.shiftright("_place", 33).alias("_range")
    sizes = ranged.groupBy(span).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_range", span).join(F.broadcast(before), "_range")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*rows.columns, (F.col("_before") + within + 1).alias(row_number))


def _summary(ranged: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """One row per range, so its size follows the number of shuffle partitions, not the data.

    `_before`: rows in earlier ranges. `_total`: rows in all. `_began_<level>`: position of
    the first row of the range's first group, where that lies in an earlier range.
    """
    aggregates = [F.count("*").alias("_rows")]
    for level, names in levels.items():
        group = F.struct(*names)
        aggregates += [
            F.min_by(group, "_pos").alias(f"_first_{level}"),
            F.max_by(group, "_pos").alias(f"_last_{level}"),
            F.max(f"_start_{level}").alias(f"_tail_{level}"),
        ]
    per_range = ranged.groupBy("_range").agg(*aggregates)
    by_range = Window.orderBy("_range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    summary = per_range.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    summary = summary.withColumn("_total", F.sum("_rows").over(Window.partitionBy()))
    for level in levels:
        first, last, tail = F.col(f"_first_{level}"), F.col(f"_last_{level}"), F.col(f"_tail_{level}")
        previous = F.lag(F.struct(last.alias("group"))).over(by_range)
        continues = previous.isNotNull() & first.eqNullSafe(previous.getField("group"))
        # Where the range's last group begins, unless the whole range continues an earlier group.
        summary = summary.withColumn("_continues", continues)
        begins = F.when((tail > 1) | ~F.col("_continues"), F.col("_before") + tail)
        begun = F.last(begins, ignorenulls=True).over(earlier)
        summary = summary.withColumn(f"_began_{level}", F.when(F.col("_continues"), begun))
    return summary.select("_range", "_before", "_total", *[f"_began_{level}" for level in levels])
