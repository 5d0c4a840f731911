"""Publishing with its counts, and triage in one pass."""

from functools import partial

from pyspark.sql import functions as F

from orderloom.functions.messages import parse_envelope, triage_messages
from orderloom.sources import publish as pub
from orderloom.sources.topics import publish_files, read_files
from tests.fixtures import rows_of
from tests.test_ingest import _put

MESSAGES = ['{"type": "ERROR"}', '{"type": "VIEW"}', '{"data": {}}', "{", "[1]"]


def test_publish_says_what_it_wrote(spark, tmp_path):
    rows = spark.range(50).withColumn("note", F.repeat(F.lit("x"), (F.col("id") * 10).cast("int")))
    write = partial(publish_files, root=str(tmp_path), files=3)
    found = pub.publish(rows, "ids", write, timestamp_ms=5, max_bytes=300, rejected="ids.rejected")
    stored = {topic: read_files(spark, str(tmp_path), topic, stream=False) for topic in ("ids", "ids.rejected")}
    assert found == pub.Published(stored["ids"].count(), stored["ids.rejected"].count()) and found.failures > 20
    back = parse_envelope(stored["ids"].unionAll(stored["ids.rejected"]), rows.schema)
    assert sorted(rows_of(back)) == sorted(rows_of(rows))


def test_failures_are_not_written(spark, tmp_path):
    messages = spark.createDataFrame([("a",), (None,), ("b" * 40,)], "value string")
    found = pub.publish_messages(messages, "t", partial(publish_files, root=str(tmp_path)), max_bytes=10, key="value")
    assert found == pub.Published(1, 2)
    assert rows_of(read_files(spark, str(tmp_path), "t", stream=False), "value") == [("a",)]
    nothing = pub.publish_messages(messages.where("false"), "u", partial(publish_files, root=str(tmp_path / "u")))
    assert nothing == pub.Published(0, 0)


def test_triage_sorts_and_counts_in_one_pass(spark, tmp_path):
    messages = spark.createDataFrame([(value,) for value in [*MESSAGES, None]], "value string")
    counted = pub.triage_to(messages, str(tmp_path / "parts"))
    assert counted == pub.Triage(3, 1, 3)
    assert rows_of(triage_messages(messages)) == [(counted.processed, counted.errors, counted.undecodable)]
    parts = spark.read.parquet(str(tmp_path / "parts"))
    want = [("error", MESSAGES[0]), ("good", MESSAGES[1]), ("good", MESSAGES[2]), ("undecodable", MESSAGES[3]), ("undecodable", MESSAGES[4]), ("undecodable", None)]
    assert sorted(rows_of(parts, "part", "value"), key=str) == sorted(want, key=str)


def test_triage_of_a_stream(spark, tmp_path):
    parts, totals = str(tmp_path / "parts"), []
    for n in range(2):
        for name in ("a", "b"):
            _put(tmp_path / "t", f"{name}{n}.txt", *MESSAGES)
        messages = read_files(spark, str(tmp_path / "t"), "items", files_per_trigger=1)
        query = pub.stream_triage(messages, parts, str(tmp_path / "c"))
        query.awaitTermination()
        totals.append(pub.triage_totals(query))
    assert totals == [pub.Triage(6, 2, 4)] * 2
    counts = spark.read.parquet(parts).groupBy("part").count()
    assert sorted(rows_of(counts)) == [("error", 4), ("good", 8), ("undecodable", 8)]
