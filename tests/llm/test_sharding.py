"""Histogram sort against exact prefix sums, with every awkward kind of row."""

import zlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import sharding
from orderloom.llm.common import ship_package
from orderloom.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id bigint, text string, shard string, size string, piece string, key_hash string"


@pytest.fixture(scope="module")
def docs(spark):
    """A third of the rows are one text, some are the same row; ids and texts may be missing."""
    ship_package(spark)
    rows = [(k, f"text {k} " * (k % 23), "a", "b", "c", "d") for k in range(600)]
    rows += [(1000 + 3 * k, "hot " * 9, "a", "b", "c", "d") for k in range(500)]
    rows += [(7, "the same row", "a", "b", "c", "d")] * 400
    rows += [(None, None, None, None, None, None)] * 3 + [(5000, "", "", "", "", ""), (5001, "é" * 5000, "", "", "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def check(rows, shards, allowed):
    """The contract of the law `bytes`: slots without gaps, each boundary within what is allowed."""
    total = sum(row["size"] for row in rows)
    below = 0
    for shard in range(shards):
        own = [row for row in rows if row["shard"] == shard]
        assert sorted(row["slot"] for row in own) == list(range(len(own)))
        below += sum(row["size"] for row in own)
        assert abs(below - total * (shard + 1) / shards) <= allowed
    assert below == total


@pytest.mark.parametrize("piece_bytes", [1 << 30, 700])
@pytest.mark.parametrize("tolerance", [0.0, 0.001])
def test_every_row_once_and_bytes_near_equal(docs, piece_bytes, tolerance):
    rows = sharding.shard_documents(docs, 16, piece_bytes=piece_bytes, tolerance=tolerance).collect()
    given = sorted(((row["doc_id"], row["text"], row["shard"]) for row in docs.collect()), key=str)
    assert sorted(((r["document"]["doc_id"], r["document"]["text"], r["document"]["shard"]) for r in rows), key=str) == given
    for row in rows:
        data = (row["document"]["text"] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    largest = max(row["size"] for row in rows)
    check(rows, 16, max(largest / 2, tolerance * sum(row["size"] for row in rows) / 16))


def test_boundaries_are_the_nearest_by_brute_force(spark, docs):
    """With no tolerance each boundary is the best cut of the sorted keys."""
    keys = docs.select(
        F.xxhash64("text").alias("key_hash"), F.coalesce("doc_id", F.lit(0)).alias("key_id"),
        F.monotonically_increasing_id().alias("key_row"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
    ).cache()
    rows = sorted(tuple(row) for row in keys.collect())
    sums = [0]
    for row in rows:
        sums.append(sums[-1] + row[3])
    shares = [k / 40 for k in range(1, 40)]
    found, count, total = sharding.find_boundaries(keys, shares, [0.0] * len(shares))
    assert (count, total) == (len(rows), sums[-1])
    for share, (_, rows_below, bytes_below) in zip(shares, found, strict=True):
        assert sums[rows_below] == bytes_below
        assert abs(bytes_below - share * total) == min(abs(s - share * total) for s in sums)


def test_equal_texts_stand_together(docs):
    """With the tolerance a group of equal texts lies in neighbouring shards and slots."""
    rows = sorted(sharding.shard_documents(docs).collect(), key=lambda r: (r["shard"], r["slot"]))
    texts = [row["document"]["text"] or "" for row in rows]
    assert sum(a != b for a, b in zip(texts, texts[1:])) + 1 == len(set(texts))


def test_nothing_and_one_row(docs):
    assert sharding.shard_documents(docs.where("false")).isEmpty()
    one = sharding.shard_documents(docs.where("doc_id = 5001")).collect()
    assert [(row["slot"], row["size"]) for row in one] == [(0, 10001)]


def test_files_hold_the_shards_in_slot_order(spark, docs, tmp_path):
    sharding.write_shards(sharding.shard_documents(docs, 4), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.groupBy("shard").count().count() == 4 and back.count() == docs.count()
    slots = [row["slot"] for row in spark.read.parquet(str(tmp_path / "s" / "shard=2")).coalesce(1).collect()]
    assert slots == sorted(slots)


def test_the_rows_move_once(docs):
    plan = sharding.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") - plan.count("BroadcastExchange") == 1 and "direct" in plan.lower()


def test_query(spark):
    found = QUERIES["op11_shards"](spark, SF_SMALL)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    check(rows, 16, max(row["size"] for row in rows) / 2 + 1)
    assert {(row["law"], row["grown_shard"]) for row in rows} == {("bytes", None)}
