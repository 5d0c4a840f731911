"""Stateful streams to stored tables, bucketed targets and ids that stay."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.functions.messages import publish_envelope
from orderloom.operators.append import append_if_absent, append_unseen, bucket_column, held_keys, read_target, rows_to_append, write_bucketed
from orderloom.operators.numbering import number_batch, read_marks
from orderloom.operators.append import write_run
from orderloom.schemas import FACT_COLUMNS, FACT_MESSAGE, TABLES
from orderloom.session import settings
from orderloom.sources.topics import keyed_messages, publish_files, read_files
from orderloom.streaming.facts import read_facts, stream_facts
from orderloom.streaming.tables import source_routes, stream_tables, unseen_rows
from tests.fixtures import customer, order, rows_of, seller, sources
from tests.test_ingest import _message, _put
from tests.test_scale import _plan


def _stream(spark, root, target, checkpoint, **options):
    query = stream_facts(read_files(spark, str(root), "items", files_per_trigger=1), str(target), str(checkpoint), **options)
    query.awaitTermination()
    return query


def test_the_stream_knows_its_keys_by_state(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for n in range(3):
        _put(tmp_path / "t", f"{n}.txt", _message("o1", 1, f"{n}.00"), _message("o1", 1, "8.00"), _message(f"n{n}", 1))
    query = _stream(spark, tmp_path / "t", tmp_path / "facts", tmp_path / "c")
    progress = [json.loads(p.json) for p in query.recentProgress]
    operators = [p["stateOperators"][0] for p in progress if p["numInputRows"]]
    assert [o["operatorName"] for o in operators] == ["dedupe"] * 3
    assert all(any(name.startswith("rocksdb") for name in o["customMetrics"]) for o in operators)
    # The session keeps its own state store.
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    stored = rows_of(spark.read.parquet(str(tmp_path / "facts")), "order_id")
    assert sorted(stored) == [("n0",), ("n1",), ("n2",), ("o1",)]
    messages = read_files(spark, str(tmp_path / "t"), "items")
    plan = unseen_rows(messages, source_routes("x", ["order_items"]))._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan


def test_a_stream_does_not_read_what_it_wrote(spark, tmp_path):
    """Nothing is looked up while no other run has written, however much the stream has."""
    target = str(tmp_path / "facts")
    rows = spark.range(100).select(F.col("id").alias("k"), "id")
    write_bucketed(rows, target, ["k"], "me", 0)
    more = spark.range(50, 150).select(F.col("id").alias("k"), "id")
    assert append_unseen(more, target, ["k"], "me", 1) is more
    assert sorted(rows_of(append_unseen(more, target, ["k"], "you", 0), "k")) == [(k,) for k in range(100, 150)]


def test_an_append_reads_only_its_buckets(spark, tmp_path):
    target = str(tmp_path / "target")
    rows = spark.range(2000).select(F.col("id").cast("string").alias("k"), "id")
    append_if_absent(rows, target, ["k"], "run", 0, buckets=64)
    stored = read_target(rows, target, 64)
    held = held_keys(stored, ["k"], 64, [5], "run", 1)
    plan = _plan(held)
    assert f"{bucket_column(64)}" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert 0 < held.count() < 2000 / 16 and set(held.columns) == {"k"}
    # One more row and one that is there; other files than those of their buckets are not opened.
    one = spark.createDataFrame([("7", 1), ("new", 2)], "k string, id bigint")
    append_if_absent(one, target, ["k"], "run", 1, buckets=64)
    assert rows_of(spark.read.parquet(target).where("batch_id = 1"), "k") == [("new",)]
    with pytest.raises(ValueError, match="8 buckets"):
        append_if_absent(one, target, ["k"], "run", 2, buckets=8)


def test_an_append_moves_its_rows_once(spark, tmp_path):
    """Into buckets and for the lookup alike, besides the rows without a key; nothing is kept in memory for it."""
    target = str(tmp_path / "target")
    rows = spark.range(200).select(F.when(F.col("id") % 5 > 0, F.col("id") % 70).alias("k"), (-F.col("id")).alias("t"), "id")
    append_if_absent(rows.where("id < 20"), target, ["k"], "run", 0, ["t"])
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(rows_to_append(rows.unionByName(rows), target, ["k"], "run", 1, ["t"]))
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(bucket_of_8" in line for line in moved) == 2 and len(moved) == 3 and "InMemoryTableScan" not in plan, plan
    append_if_absent(rows.unionByName(rows), target, ["k"], "run", 1, ["t"])
    found = spark.read.parquet(target).where("batch_id = 1")
    latest = {k: max(n for n in range(200) if n % 5 and n % 70 == k) for k in range(70) if k % 5}
    want = [(k, n) for k, n in latest.items() if k >= 20] + 2 * [(None, n) for n in range(0, 200, 5)]
    assert sorted(rows_of(found, "k", "id"), key=str) == sorted(want, key=str)


def test_ids_stay_and_stay_dense(spark, tmp_path):
    target = str(tmp_path / "facts")
    order_by = [("k", "asc")]
    batches = [["b", "a"], ["c", "aa", "a"], [], ["z"]]
    seen = {}
    for batch_id, keys in enumerate(batches):
        rows = spark.createDataFrame([(key, batch_id) for key in keys], "k string, batch int")
        for _ in range(2):  # once more, as after a failure
            write_run(number_batch(rows, target, order_by, "run", batch_id), target, "run", batch_id)
        now = {(row["batch"], row["k"]): row["id"] for row in spark.read.parquet(target).collect()}
        assert seen.items() <= now.items()
        seen = now
    assert seen == {(0, "a"): 1, (0, "b"): 2, (1, "a"): 3, (1, "aa"): 4, (1, "c"): 5, (3, "z"): 6}
    assert sorted(rows_of(read_marks(spark, target), "first_id", "row_count")) == [(1, 2), (3, 3), (6, 1)]


def test_streamed_facts_are_numbered(spark, tmp_path):
    for n in range(3):
        _put(tmp_path / "t", f"{n}.txt", *[_message(f"o{n}", k) for k in range(5)], _message("o0", 1), _message(None, n))
    _stream(spark, tmp_path / "t", tmp_path / "facts", tmp_path / "c", numbered=True)
    first = {tuple(row[:3]) for row in rows_of(spark.read.parquet(str(tmp_path / "facts")), "id", "order_id", "order_item_id")}
    assert sorted(row[0] for row in first) == list(range(1, 19))
    _put(tmp_path / "t", "3.txt", _message("late", 1), _message("o1", 1))
    _stream(spark, tmp_path / "t", tmp_path / "facts", tmp_path / "c", numbered=True)
    # Another stream over the same messages adds its messages without a key, and nothing else.
    _stream(spark, tmp_path / "t", tmp_path / "facts", tmp_path / "c2", numbered=True)
    stored = spark.read.parquet(str(tmp_path / "facts"))
    now = {tuple(row[:3]) for row in rows_of(stored, "id", "order_id", "order_item_id")}
    assert first < now and (19, "late", 1) in now
    assert sorted(row[0] for row in now) == list(range(1, 23))
    assert stored.where("order_id IS NULL").count() == 6
    empty = spark.createDataFrame([], FACT_MESSAGE)
    assert read_facts(empty, str(tmp_path / "facts")).columns == FACT_COLUMNS


def test_several_topics_in_one_query(spark, tmp_path):
    src = sources(
        spark,
        orders=[order("o1", "c1", "2018-01-01", "2018-01-05"), order("o2", "c1", None), order("o1", "c9", "2019-01-01")],
        customers=[customer("c1", "u1"), customer(None, "u2"), customer(None, "u2")],
        sellers=[seller("s1", "it's")],
    )
    root, tables, bad = str(tmp_path / "topics"), str(tmp_path / "tables"), str(tmp_path / "bad")
    for topic in ("orders", "customers", "sellers"):
        publish_files(keyed_messages(publish_envelope(getattr(src, topic), 7), topic), root)
    _put(tmp_path / "topics", "x.txt", "{", topic="orders")
    _put(tmp_path / "topics", "x.txt", "{}", topic="elsewhere")
    _put(tmp_path / "topics", "y.txt", '{"data": {"order_id": "o2", "customer_id": "c7"}}', topic="orders")

    def run():
        received = read_files(spark, root, ["orders", "customers", "sellers", "elsewhere"])
        routes = source_routes(tables, ["orders", "customers", "sellers"])
        stream_tables(received, routes, str(tmp_path / "c"), bad, sanitize=True).awaitTermination()
        return {name: spark.read.parquet(f"{tables}/src_{name}") for name in ("orders", "customers", "sellers")}

    stored = run()
    assert sorted(rows_of(stored["orders"], "order_id")) == [("o1",), ("o2",)]
    assert sorted(rows_of(stored["customers"], "customer_id", "customer_unique_id"), key=str) == [("c1", "u1"), (None, "u2"), (None, "u2")]
    assert rows_of(stored["sellers"], "seller_id", "seller_state") == [("s1", "it?s")]
    for name, rows in stored.items():
        fields = {f.name: f.dataType for f in rows.schema.fields}
        assert {f.name: f.dataType for f in TABLES[f"src_{name}"].fields}.items() <= fields.items()
    assert sorted(rows_of(spark.read.parquet(bad), "topic", "value")) == [("elsewhere", "{}"), ("orders", "{")]
    # More messages and the same checkpoint: only what is new is added.
    _put(tmp_path / "topics", "z.txt", '{"data": {"seller_id": "s1"}}', '{"data": {"seller_id": "s2"}}', topic="sellers")
    assert sorted(rows_of(run()["sellers"], "seller_id")) == [("s1",), ("s2",)]


def test_prices_keep_their_type(spark, tmp_path):
    _put(tmp_path / "t", "a.txt", _message("o1", 1.0, "2.50"), _message("o2", 1.5), _message("o3", 1, "much"))
    _stream(spark, tmp_path / "t", tmp_path / "facts", tmp_path / "c")
    assert rows_of(spark.read.parquet(str(tmp_path / "facts")), "order_id", "price") == [("o1", Decimal("2.50"))]
    assert spark.read.parquet(f"{tmp_path / 'facts'}_undecodable").count() == 2
