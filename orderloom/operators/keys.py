"""Declared keys: find repeats, keep one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import KEYS


def complete(keys: list[str]) -> Column:
    """Whether no column of the key is NULL."""
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in keys])


def incomplete_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a NULL in the key, which a primary key forbids and a unique key allows."""
    return rows.where(~complete(keys))


def key_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Every key that occurs more than once, with its number of `copies`; keys with a NULL never equal another."""
    return rows.where(complete(keys)).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def declared_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per declared key of the named tables: how many keys repeat, in how many rows."""
    def summed(name: str, keys: list[str]) -> DataFrame:
        found = key_violations(tables[name], keys).agg(
            F.count("*").alias("keys_repeated"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_concerned")
        )
        labels = [F.lit(name).alias("table_name"), F.lit(", ".join(keys)).alias("key")]
        return found.select(*labels, "keys_repeated", "rows_concerned")

    return reduce(DataFrame.unionAll, [summed(name, keys) for name in tables for keys in KEYS[name]])


def keep_first(rows: DataFrame, keys: list[str], first_by: list[str] | None = None) -> DataFrame:
    """One row per key: the first by `first_by`, then by the other columns.

    An aggregate rather than a window: the copies of a hot key are reduced before the
    shuffle, and a retry picks the same row again. A NULL in `first_by` comes last.
    """
    order = first_by or []
    rest = [name for name in rows.columns if name not in keys and name not in order]
    missing = [F.col(name).isNull().alias(f"_no_{name}") for name in order]
    ordered = [column for pair in zip(missing, order, strict=True) for column in pair]
    kept = rows.groupBy(*keys).agg(F.min(F.struct(*ordered, *rest)).alias("_kept"))
    return kept.select(*[F.col(name if name in keys else f"_kept.{name}") for name in rows.columns])
