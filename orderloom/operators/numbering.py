"""Ids that stay with their rows: later appends go on where earlier ones ended.

Beside the rows lies a small table of marks, one a batch: the batch's first id and its number
of rows. A new batch starts behind the highest mark, so ids are dense over all batches; a batch
that runs again finds its own mark and gives the same ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.append import read_target, write_run
from orderloom.operators.ranking import with_ranks

MARK = "first_id bigint, row_count bigint"


def marks_path(path: str) -> str:
    return f"{path.rstrip('/')}_marks"


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """One row a batch: first_id, row_count, ingest_id, batch_id."""
    return read_target(spark.createDataFrame([], MARK), marks_path(path))


def first_id(spark: SparkSession, path: str, ingest_id: str, batch_id: int) -> int:
    """Where this batch's ids start: at its own mark, or behind the highest."""
    marks = read_marks(spark, path)
    if marks is None:
        return 1
    own = (F.col("ingest_id") == ingest_id) & (F.col("batch_id") == batch_id)
    found = marks.agg(
        F.min(F.when(own, F.col("first_id"))).alias("own"), F.max(F.col("first_id") + F.col("row_count")).alias("next")
    ).first()
    return found["own"] if found["own"] is not None else found["next"] or 1


def number_batch(
    rows: DataFrame, path: str, order_by: list[tuple[str, str]], ingest_id: str, batch_id: int, name: str = "id"
) -> DataFrame:
    """The rows of a batch with ids that continue those of `path`; the batch's mark is written at once.

    Rows get their ids in the given order. One writer per path. Without rows no mark is set.
    """
    spark = rows.sparkSession
    start = first_id(spark, path, ingest_id, batch_id)
    numbered = with_ranks(rows, order_by, row_number=name)
    numbered = numbered.withColumn(name, F.col(name) + F.lit(start - 1)).select(name, *rows.columns)
    count = numbered.count()
    if count:
        mark = spark.createDataFrame([(start, count)], MARK)
        write_run(mark, marks_path(path), ingest_id, batch_id)
    return numbered
