"""Messages, files, tables and the streaming load."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions.messages import parse_envelope, publish_batch_stats, publish_envelope, triage_messages
from orderloom.functions.text import sanitize_values
from orderloom.operators.append import append_if_absent
from orderloom.operators.keys import declared_key_violations, incomplete_keys, keep_first, key_violations
from orderloom.schemas import FACT_COLUMNS, FACT_MESSAGE, SOURCE_TABLES, TABLES
from orderloom.sources import topics
from orderloom.sources.csv_files import read_source_csv, stream_source_csv, write_source_csv
from orderloom.sources.tables import create_source_tables, load_source_tables, read_source_tables
from orderloom.streaming import facts as facts_stream
from tests.fixtures import customer, item, order, rows_of, sources


def _message(order_id, number, price="1.50", sent=1, **more):
    data = {"order_id": order_id, "order_item_id": number, "product_id": "p", "seller_id": "s", "price": price, **more}
    return json.dumps({"timestamp": sent, "data": data})


def _put(folder, name, *lines, topic="items"):
    place = folder / f"topic={topic}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text("\n".join(lines) + "\n")


def _load(spark, root, target, checkpoint, quarantine=None):
    messages = topics.read_files(spark, str(root), "items", files_per_trigger=1)
    query = facts_stream.stream_facts(
        messages, str(target), str(checkpoint), quarantine=str(quarantine) if quarantine else None
    )
    query.awaitTermination()
    return rows_of(spark.read.parquet(str(target)), "order_id", "order_item_id", "price")


def test_stream_is_idempotent(spark, tmp_path):
    root, target, bad = tmp_path / "topics", tmp_path / "facts", tmp_path / "bad"
    _put(root, "a.txt", _message("o1", 1), _message("o1", 1, "9.99", sent=2), _message("o1", 2), '{"timestamp": 1,')
    _put(root, "b.txt", _message("o1", 1, "7.77"), _message("o2", 1), "[1]", _message("o3", "one"))
    _put(root, "c.txt", _message("elsewhere", 1), topic="other")
    once = [("o1", 1, Decimal("1.50")), ("o1", 2, Decimal("1.50")), ("o2", 1, Decimal("1.50"))]
    first = sorted(_load(spark, root, target, tmp_path / "c1", bad))
    # Which of the two files comes first is open; within a file the earlier message wins.
    assert [row[:2] for row in first] == [row[:2] for row in once] and first[1:] == once[1:]
    assert first[0][2] in (Decimal("1.50"), Decimal("7.77"))
    assert spark.read.parquet(str(bad)).count() == 3
    # The same checkpoint again, then a new one over the same messages.
    assert sorted(_load(spark, root, target, tmp_path / "c1")) == first
    assert sorted(_load(spark, root, target, tmp_path / "c2")) == first
    _put(root, "d.txt", _message("o4", 1), _message("o2", 1))
    assert len(_load(spark, root, target, tmp_path / "c2")) == 4


def test_stream_can_sanitize(spark, tmp_path):
    _put(tmp_path / "topics", "a.txt", _message("it's", 1))
    messages = topics.read_files(spark, str(tmp_path / "topics"), "items")
    facts_stream.stream_facts(
        messages, str(tmp_path / "facts"), str(tmp_path / "c"), sanitize=True
    ).awaitTermination()
    assert rows_of(spark.read.parquet(str(tmp_path / "facts")), "order_id") == [("it?s",)]


def test_retried_batch_writes_the_same_rows(spark, tmp_path):
    target = str(tmp_path / "facts")
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "k string, v int")
    append_if_absent(rows.where("k = 'a'"), target, ["k"], "run", 0)
    for _ in range(2):
        append_if_absent(rows, target, ["k"], "run", 1)
    stored = spark.read.parquet(target)
    assert sorted(rows_of(stored, "k", "v"), key=str) == [("a", 1), ("b", 3), (None, 4), (None, 5)]


def test_append_keeps_one_row_a_key_and_all_without_key(spark, tmp_path):
    target = str(tmp_path / "facts")
    ids = spark.range(300).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id")
    append_if_absent(ids.where("id < 40"), target, ["k"], "run", 0)
    append_if_absent(ids, target, ["k"], "run", 1)
    stored = spark.read.parquet(target)
    # 0 to 39 hold 14 ids without a key, which the second run adds again.
    assert stored.where("k IS NULL").count() == 100 + 14
    assert stored.where("k IS NOT NULL").count() == ids.where("k IS NOT NULL").select("k").distinct().count()
    assert key_violations(stored, ["k"]).isEmpty()


def test_keep_first_follows_the_given_order(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), (None, 5, "n")], "k string, t int, v string")
    assert sorted(rows_of(keep_first(rows, ["k"], ["t"])), key=str) == [("a", 1, "y"), (None, 5, "n")]
    assert rows_of(key_violations(rows, ["k"])) == [("a", 3)]


def test_streamed_facts_get_their_customer_from_the_order(spark, tmp_path):
    root = tmp_path / "topics"
    _put(root, "a.txt", _message("o1", 1), _message("lost", 1))
    _load(spark, root, tmp_path / "facts", tmp_path / "c")
    empty = spark.createDataFrame([], FACT_MESSAGE)
    stored = facts_stream.read_facts(empty, str(tmp_path / "facts"))
    assert set(rows_of(stored, "customer_unique_id")) == {(None,)}
    src = sources(spark, orders=[order("o1", "c1", "2018-01-01")], customers=[customer("c1", "u1")])
    enriched = facts_stream.enrich_facts(stored, src)
    assert enriched.columns == FACT_COLUMNS
    assert sorted(rows_of(enriched, "order_id", "customer_unique_id"), key=str) == [("o1", "u1"), (None, None)]
    assert facts_stream.read_facts(empty, str(tmp_path / "nothing")).isEmpty()


def test_envelope_round_trip_keeps_nulls(spark):
    rows = spark.createDataFrame([("o1", 1, None, "s", None, Decimal("2.50"))], FACT_MESSAGE)
    messages = publish_envelope(rows)
    text = json.loads(messages.first()["value"])
    assert text["data"]["product_id"] is None and text["timestamp"] > 1_600_000_000_000
    assert parse_envelope(messages, FACT_MESSAGE).collect() == rows.collect()


def test_parse_skips_what_is_no_message(spark):
    values = [_message("o1", 1), '{"data":', "5", "[1]", None, '{"timestamp": 3}', _message("o2", 1, "much")]
    messages = spark.createDataFrame([(value,) for value in values], "value string")
    parsed = parse_envelope(messages, FACT_MESSAGE)
    # A message without data is a row of NULLs, as a lookup with default gives.
    assert sorted(rows_of(parsed, "order_id", "price"), key=str) == [("o1", Decimal("1.50")), (None, None)]
    assert rows_of(publish_batch_stats(messages)) == [(6, 1)]


def test_bytes_that_are_not_utf8_are_undecodable(spark):
    values = [_message("ö", 1).encode(), b'{"timestamp": 1, "data": {"order_id": "\xff\xfe"}}']
    messages = spark.createDataFrame([(bytearray(value),) for value in values], "value binary")
    assert rows_of(parse_envelope(messages, FACT_MESSAGE), "order_id") == [("ö",)]


def test_triage(spark):
    values = ['{"type": "ERROR"}', '{"type": "VIEW"}', '{"data": {}}', "{", None]
    messages = spark.createDataFrame([(value,) for value in values], "value string")
    assert rows_of(triage_messages(messages)) == [(3, 1, 2)]


def test_sanitize(spark):
    raw = spark.createDataFrame([("it's 'so'", "7", "x"), (None, None, "2.5")], "a string, b string, c string")
    clean = sanitize_values(raw, spark.createDataFrame([], "a string, b int, c double").schema)
    assert rows_of(clean) == [("it?s ?so?", 7, None), (None, None, 2.5)]


def test_csv_keeps_declared_types_nulls_and_leading_zeros(spark, tmp_path):
    src = sources(
        spark,
        orders=[order("o1", "c1", "2018-01-01 10:11:12"), order("o2", None, None)],
        customers=[{**customer("c1"), "customer_zip_code_prefix": "01234"}],
    )
    for attribute, table in (("orders", "src_orders"), ("customers", "src_customers")):
        rows, folder = getattr(src, attribute), str(tmp_path / table)
        write_source_csv(rows, folder)
        read = read_source_csv(spark, folder, table)
        assert read.schema == TABLES[table]
        assert sorted(read.collect(), key=str) == sorted(rows.collect(), key=str)


def test_csv_with_byte_order_mark_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    text = "﻿product_category_name,product_category_name_english\nbeleza,beauty\n"
    (folder / "a.csv").write_text(text, encoding="utf-8")
    table = "src_products_categories_translations"
    assert rows_of(read_source_csv(spark, str(folder), table)) == [("beleza", "beauty")]
    query = (
        stream_source_csv(spark, str(folder), table).writeStream.format("memory").queryName("translations")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows_of(spark.table("translations")) == [("beleza", "beauty")]


def test_csv_is_read_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'seller_state,more,seller_id,seller_city,seller_zip_code_prefix\n'
        'SP,"a ""b"" c, d",s1,Santos,01\n"R\nJ",x,s2,,02\n',
        encoding="utf-8",
    )
    read = read_source_csv(spark, str(tmp_path / "a.csv"), "src_sellers", multi_line=True)
    assert sorted(rows_of(read.select("seller_id", "seller_state"))) == [("s1", "SP"), ("s2", "R\nJ")]
    (tmp_path / "b.csv").write_text("seller_state\nSP\n")
    with pytest.raises(ValueError, match="seller_id"):
        read_source_csv(spark, str(tmp_path / "b.csv"), "src_sellers")
    header = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state"
    (tmp_path / "c.csv").write_text(f"{header}\n01,1.5,2,a,SP\n02,much,2,a,SP\n03,,2,a,SP\n")
    good = read_source_csv(spark, str(tmp_path / "c.csv"), "src_geolocation", quarantine=str(tmp_path / "bad"))
    assert sorted(rows_of(good), key=str) == [("01", 1.5, 2.0, "a", "SP"), ("03", None, 2.0, "a", "SP")]
    assert rows_of(spark.read.parquet(str(tmp_path / "bad"))) == [("02", "much", "2", "a", "SP")]


def test_no_message_is_lost(spark, tmp_path):
    root, target = tmp_path / "topics", tmp_path / "facts"
    lost = {"product_id": "q"}
    texts = [_message("o1", 1.0), _message("o2", 1.5), _message("o3", 1, float("nan")), "{}", "{", _message(None, None), _message(None, None, **lost)]
    _put(root, "a.txt", *texts)
    stored = _load(spark, root, target, tmp_path / "c")
    assert sorted(stored, key=str) == [("o1", 1, Decimal("1.50")), *[(None, None, Decimal("1.50"))] * 2, (None, None, None)]
    assert spark.read.parquet(f"{target}_undecodable").count() == len(texts) - len(stored)


def test_a_stamped_message_beats_one_without_time(spark):
    rows = spark.createDataFrame([("a", None, "x"), ("a", 7, "y")], "k string, t int, v string")
    assert rows_of(keep_first(rows, ["k"], ["t"])) == [("a", 7, "y")]


def test_kafka_options_and_keys(spark):
    servers = ["one:9092", "two:9092"]
    assert topics.kafka_sink_options(servers, "producer") == {
        "kafka.bootstrap.servers": "one:9092,two:9092",
        "kafka.client.id": "producer",
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.compression.type": "gzip",
    }
    subscribed = topics.kafka_source_options(servers, ["a", "b"])
    assert subscribed["subscribe"] == "a,b" and subscribed["startingOffsets"] == "earliest"
    assigned = topics.kafka_source_options(servers, "a", {"a": [0, 2]})
    assert json.loads(assigned["assign"]) == {"a": [0, 2]} and "subscribe" not in assigned
    messages = publish_envelope(spark.range(1000))
    assert rows_of(topics.keyed_messages(messages, "ids").select("topic", "key").distinct()) == [("ids", "ids")]
    spread = topics.keyed_messages(messages, "ids", partitions=4).groupBy("partition").count()
    assert {row[0] for row in rows_of(spread)} == {0, 1, 2, 3}


def test_tables_are_created_once(spark, tmp_path):
    names = create_source_tables(spark, "shop_test", str(tmp_path / "db"))
    src = sources(spark, order_items=[item("o1", 1, "p", "s", 1.25)], customers=[customer("c1")])
    load_source_tables(src, "shop_test")
    assert create_source_tables(spark, "shop_test", str(tmp_path / "db")) == names
    read = read_source_tables(spark, "shop_test")
    assert read.order_items.count() == 1 and read.customers.count() == 1 and read.orders.isEmpty()
    for name in SOURCE_TABLES:
        assert spark.table(f"shop_test.{name}").schema == TABLES[name]
    twice = [item("o2", 1, "p", "s", 2.0), item("o2", 1, "p", "s", 3.0)]
    nulls = [item(None, 1, "p", "s", 4.0), item(None, 1, "p", "s", 5.0)]
    repeated = sources(spark, order_items=twice + nulls)
    found = declared_key_violations({"src_order_items": repeated.order_items}).where("keys_repeated > 0")
    assert rows_of(found, "keys_repeated", "rows_concerned") == [(1, 2)]
    assert incomplete_keys(repeated.order_items, ["order_id", "order_item_id"]).count() == 2
    load_source_tables(repeated, "shop_test", unique=True)
    prices = rows_of(read_source_tables(spark, "shop_test").order_items, "price")
    assert sorted(prices) == [(1.25,), (2.0,), (4.0,), (5.0,)]
    load_source_tables(sources(spark, order_items=twice + [item("o1", 1, "p", "s", 9.0)]), "shop_test", unique=True)
    assert sorted(rows_of(read_source_tables(spark, "shop_test").order_items, "price")) == sorted(prices)
    spark.sql("DROP DATABASE shop_test CASCADE")
