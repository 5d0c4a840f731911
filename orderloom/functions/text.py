"""Value cleaning before a load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean(value: Column, kind: T.DataType) -> Column:
    """The value as the declared type, `'` replaced by `?` in strings; NULL if it cannot be cast."""
    if isinstance(kind, T.StringType):
        return F.replace(value.cast("string"), F.lit("'"), F.lit("?"))
    return value.try_cast(kind)


def sanitize_values(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column to the declared type and replace `'` by `?` in strings.

    A value that cannot be cast becomes NULL.
    """
    return rows.select(*[clean(F.col(field.name), field.dataType).alias(field.name) for field in schema.fields])
