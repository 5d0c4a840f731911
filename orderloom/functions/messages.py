"""Message envelopes: rows to JSON and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import envelope

# Fixed value: how timestamps are spelled in the CSV files and the messages.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
_JSON = {"timestampNTZFormat": TIME_FORMAT}
_BAD = "_undecodable"


def publish_envelope(rows: DataFrame, timestamp_ms: Column | int | None = None) -> DataFrame:
    """One message per row in column `value`; missing values are written as null."""
    stamp = F.unix_millis(F.current_timestamp()) if timestamp_ms is None else F.lit(timestamp_ms)
    body = F.struct(stamp.alias("timestamp"), F.struct(*rows.columns).alias("data"))
    return rows.select(F.to_json(body, {**_JSON, "ignoreNullFields": "false"}).alias("value"))


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """`messages` plus struct `message` and flag `undecodable`.

    Undecodable is what is not UTF-8 JSON, is no object, or has a field of another type. A
    whole number may be written as a decimal, as writers do for columns with gaps (1.0).
    The explode of one element makes Spark parse a message once; as a plain column the
    parse would be repeated in the filter and in every field taken from it.
    """
    wanted = T.StructType([*_lenient(schema).fields, T.StructField(_BAD, T.StringType())])
    options = {**_JSON, "columnNameOfCorruptRecord": _BAD}
    text = F.try_validate_utf8(F.col("value").cast("string"))
    message = F.from_json(text, wanted, options)
    parsed = messages.select("*", F.explode(F.array(message)).alias("message"))
    bad = F.col("message").isNull() | F.col(f"message.{_BAD}").isNotNull()
    for path, kind in _whole_numbers(schema, "message"):
        bad = bad | _odd(path, kind)
    return parsed.withColumn("undecodable", F.coalesce(bad, F.lit(False))).withColumn("message", _settled("message", schema))


def decode_topics(messages: DataFrame, schemas: dict[str, T.StructType]) -> DataFrame:
    """`messages` plus, for the n-th topic, struct `message_<n>` with `timestamp` and `data`, and flag `undecodable`.

    A message is parsed once, by the schema of its own topic; one of a topic that is not
    named is undecodable. The rest is as decode() says.
    """
    text = F.try_validate_utf8(F.col("value").cast("string"))
    options = {**_JSON, "columnNameOfCorruptRecord": _BAD}
    parses, settled, bad = [], [], F.lit(None).cast("boolean")
    for n, (topic, schema) in enumerate(schemas.items()):
        whole = envelope(schema)
        wanted = T.StructType([*_lenient(whole).fields, T.StructField(_BAD, T.StringType())])
        parses.append(F.when(F.col("topic") == topic, F.from_json(text, wanted, options)).alias(f"m{n}"))
        path = f"_parsed.m{n}"
        odd = F.col(path).isNull() | F.col(f"{path}.{_BAD}").isNotNull()
        for own, kind in _whole_numbers(whole, path):
            odd = odd | _odd(own, kind)
        bad = F.coalesce(bad, F.when(F.col("topic") == topic, F.coalesce(odd, F.lit(False))))
        settled.append(_settled(path, whole).alias(f"message_{n}"))
    parsed = messages.select("*", F.explode(F.array(F.struct(*parses))).alias("_parsed"))
    return parsed.select(*messages.columns, F.coalesce(bad, F.lit(True)).alias("undecodable"), *settled)


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DECIMAL = T.DecimalType(38, 10)


def _lenient(schema: T.StructType) -> T.StructType:
    """The schema with whole numbers read as decimals."""
    def kind(of: T.DataType) -> T.DataType:
        if isinstance(of, T.StructType):
            return _lenient(of)
        return _DECIMAL if isinstance(of, _WHOLE) else of

    return T.StructType([T.StructField(field.name, kind(field.dataType)) for field in schema.fields])


def _whole_numbers(schema: T.StructType, path: str) -> list[tuple[str, T.DataType]]:
    found = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            found += _whole_numbers(field.dataType, f"{path}.{field.name}")
        elif isinstance(field.dataType, _WHOLE):
            found.append((f"{path}.{field.name}", field.dataType))
    return found


def _odd(path: str, kind: T.DataType) -> Column:
    """Whether a number is there that is not whole or does not fit its type."""
    whole = F.col(path).try_cast(kind)
    return F.col(path).isNotNull() & (whole.isNull() | (whole.cast(_DECIMAL) != F.col(path)))


def _settled(path: str, schema: T.StructType) -> Column:
    """The struct with the declared types, NULL where it is NULL."""
    fields = []
    for field in schema.fields:
        own = f"{path}.{field.name}"
        if isinstance(field.dataType, T.StructType):
            value = _settled(own, field.dataType)
        else:
            value = F.col(own).try_cast(field.dataType) if isinstance(field.dataType, _WHOLE) else F.col(own)
        fields.append(value.alias(field.name))
    return F.when(F.col(path).isNotNull(), F.struct(*fields))


def parse_envelope(messages: DataFrame, data: T.StructType) -> DataFrame:
    """The `data` fields of every decodable message; a message without `data` gives NULLs."""
    decoded = decode(messages, envelope(data))
    return decoded.where(~F.col("undecodable")).select("message.data.*")


def triage_messages(messages: DataFrame) -> DataFrame:
    """One row: messages processed, those of type ERROR among them, and undecodable ones."""
    decoded = decode(messages, T.StructType([T.StructField("type", T.StringType())]))
    good = ~F.col("undecodable")
    return decoded.agg(
        F.count_if(good).alias("processed"),
        F.count_if(good & (F.col("message.type") == "ERROR")).alias("errors"),
        F.count_if(~good).alias("undecodable"),
    )


def publish_batch_stats(messages: DataFrame) -> DataFrame:
    """One row: how many messages can be encoded and how many cannot."""
    encodable = F.col("value").isNotNull()
    return messages.agg(F.count_if(encodable).alias("successes"), F.count_if(~encodable).alias("failures"))
