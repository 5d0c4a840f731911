"""Append only the rows whose key the target does not hold yet.

A target is a folder of Parquet files in partitions: a bucket, which is a hash of the key, then
the run that wrote them. An append reads the keys of the buckets that its own keys fall into;
rows with an incomplete key lie in a bucket of their own, which nothing reads.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.keys import complete, keep_first

RUN_COLUMNS = ["ingest_id", "batch_id"]
BUCKETS = 8


def bucket_column(buckets: int) -> str:
    """The partition column's name tells the number of buckets, so that it cannot change unnoticed."""
    return f"bucket_of_{buckets}"


def bucket(keys: list[str], buckets: int) -> Column:
    """The key's bucket, NULL where the key is incomplete; it does not depend on the columns' types."""
    hashed = F.xxhash64(*[F.col(name).cast("string") for name in keys])
    return F.when(complete(keys), F.pmod(hashed, F.lit(buckets)).cast("int"))


def read_target(rows: DataFrame, path: str, buckets: int | None = None) -> DataFrame | None:
    """The target as stored, with its run columns and, if `buckets` is given, the bucket; None if there is none."""
    spark = rows.sparkSession
    layout = [T.StructField("ingest_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    if buckets is not None:
        layout.insert(0, T.StructField(bucket_column(buckets), T.IntegerType()))
    try:
        if buckets is not None:
            _check_buckets(spark.read.parquet(path).columns, path, buckets)
        return spark.read.schema(T.StructType([*rows.schema.fields, *layout])).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _check_buckets(columns: list[str], path: str, buckets: int) -> None:
    found = [name for name in columns if name.startswith(bucket_column(0)[:-1])]
    if found != [bucket_column(buckets)]:
        raise ValueError(f"{path} is not laid out in {buckets} buckets: {', '.join(found) or 'no buckets'}")


def held_keys(stored: DataFrame, keys: list[str], buckets: int, wanted: list[int], ingest_id: str, batch_id: int | None) -> DataFrame:
    """Keys in the wanted buckets, but for those of this run's batch, or of the whole run if batch_id is None."""
    own = F.col("ingest_id") == ingest_id
    if batch_id is not None:
        own = own & (F.col("batch_id") == batch_id)
    return stored.where(F.col(bucket_column(buckets)).isin(wanted) & ~own).select(*keys)


def append_if_absent(
    rows: DataFrame,
    path: str,
    keys: list[str],
    ingest_id: str,
    batch_id: int,
    first_by: list[str] | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Write the first row of each new key to `path`, and every row whose key holds a NULL.

    A NULL equals nothing, so a row with an incomplete key is no repeat of another and is kept.
    Each (ingest_id, batch_id) owns its partitions of the target and overwrites them, and is
    left out when looking for existing keys. A batch that runs again after a failure so
    writes the same rows once more instead of adding to them; the same input under another
    ingest_id adds its incomplete rows again. One writer per target. `rows` are read up to three
    times, so what is costly to compute is better stored before.
    """
    fresh = rows_to_append(rows, path, keys, ingest_id, batch_id, first_by, buckets)
    _write_owned(fresh, path, ingest_id, batch_id, [bucket_column(buckets)])


def rows_to_append(
    rows: DataFrame, path: str, keys: list[str], ingest_id: str, batch_id: int, first_by: list[str] | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """What append_if_absent() writes, with its bucket.

    The first rows of keys are found by bucket and key: the lookup needs them in the same place, so they move once,
    and a task writes at most a file a bucket.
    """
    name, columns = bucket_column(buckets), [name for name in rows.columns if name not in (first_by or [])]
    whole, lacking = (rows.where(which).withColumn(name, bucket(keys, buckets)) for which in (complete(keys), ~complete(keys)))
    fresh = keep_first(whole, [name, *keys], first_by).select(*columns, name)
    stored = read_target(fresh.drop(name), path, buckets)
    if stored is not None:
        held = held_keys(stored, [name, *keys], buckets, _wanted(whole, keys, buckets), ingest_id, batch_id)
        fresh = fresh.join(held, [name, *keys], "left_anti").select(*columns, name)
    return fresh.unionByName(lacking.select(*columns, name).hint("rebalance"))


def append_unseen(rows: DataFrame, path: str, keys: list[str], ingest_id: str, batch_id: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows whose key no other run has written; `rows` hold no key that this run has had before.

    For streams, which know their own keys: what they wrote themselves is not read again.
    """
    stored = read_target(rows, path, buckets)
    if stored is None or stored.where(F.col("ingest_id") != ingest_id).select("ingest_id").isEmpty():
        return rows
    fresh = _absent(rows.where(complete(keys)), stored, keys, ingest_id, None, buckets)
    return fresh.unionByName(rows.where(~complete(keys)))


def _absent(
    rows: DataFrame, stored: DataFrame, keys: list[str], ingest_id: str, batch_id: int | None, buckets: int
) -> DataFrame:
    held = held_keys(stored, keys, buckets, _wanted(rows, keys, buckets), ingest_id, batch_id)
    return rows.join(held, keys, "left_anti").select(*rows.columns)


def _wanted(rows: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """The buckets that keys fall into, at most as many values as there are buckets."""
    return sorted(row[0] for row in rows.select(bucket(keys, buckets)).distinct().collect())


def write_bucketed(rows: DataFrame, path: str, keys: list[str], ingest_id: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Write rows as this run's batch, a bucket's together; the buckets of an earlier try are replaced."""
    name = bucket_column(buckets)
    placed = rows.withColumn(name, bucket(keys, buckets)).hint("rebalance", name)
    _write_owned(placed, path, ingest_id, batch_id, [name])


def write_run(rows: DataFrame, path: str, ingest_id: str, batch_id: int) -> None:
    """Write rows as the partition of this run's batch, replacing what an earlier try left there."""
    _write_owned(rows, path, ingest_id, batch_id, [])


def _write_owned(rows: DataFrame, path: str, ingest_id: str, batch_id: int, before: list[str]) -> None:
    owned = rows.withColumn("ingest_id", F.lit(ingest_id)).withColumn("batch_id", F.lit(batch_id))
    writer = owned.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*before, *RUN_COLUMNS).parquet(path)
