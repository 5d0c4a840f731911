"""Headed CSV files with the declared schemas; Spark's file splits are the chunks.

Columns are found by the header's names, quotes inside quotes are doubled, as spreadsheet
programs and pandas write them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.messages import TIME_FORMAT
from orderloom.schemas import TABLES

_OPTIONS = {"header": True, "timestampNTZFormat": TIME_FORMAT, "quote": '"', "escape": '"', "enforceSchema": False}


def read_source_csv(
    spark: SparkSession, path: str, table: str, quarantine: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Read the CSV file or folder holding source table `table`.

    Columns may stand in any order and others may be there too; a missing one is an error, and
    so is a file of a folder whose header differs from the first. Rows with a value that is
    not of the declared type are written to `quarantine` as they were read; without it they
    end the read. `multi_line` allows line breaks inside quotes; files are then not split.
    """
    raw = spark.read.options(**_OPTIONS, multiLine=multi_line).csv(path)
    names = {name.strip().lstrip("\ufeff"): name for name in raw.columns}
    missing = [field.name for field in TABLES[table].fields if field.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    rows = raw.select(*[F.col(f"`{names[field.name]}`").alias(field.name) for field in TABLES[table].fields])
    if quarantine is None:
        return rows.select(*[_typed(field, Column.cast) for field in TABLES[table].fields])
    lost = [F.col(field.name).isNotNull() & _typed(field, Column.try_cast).isNull() for field in TABLES[table].fields]
    bad = reduce(Column.__or__, lost)
    rows.where(bad).write.mode("overwrite").parquet(quarantine)
    return rows.where(~bad).select(*[_typed(field, Column.try_cast) for field in TABLES[table].fields])


def _typed(field: T.StructField, cast) -> Column:
    return cast(F.col(field.name), field.dataType).alias(field.name)


def stream_source_csv(spark: SparkSession, folder: str, table: str, files_per_trigger: int = 100) -> DataFrame:
    """The same for files that keep arriving in `folder`; their columns must stand in the declared order."""
    reader = spark.readStream.schema(TABLES[table]).options(**_OPTIONS)
    return reader.option("maxFilesPerTrigger", files_per_trigger).csv(folder)


def write_source_csv(rows: DataFrame, folder: str) -> None:
    rows.write.options(**{name: value for name, value in _OPTIONS.items() if name != "enforceSchema"}).csv(folder)
