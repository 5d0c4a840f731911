"""Nearest neighbours by a permutation index.

A vector is represented by the pivots nearest to it, in order. It is posted in the inverted
files of its first pivots; a query looks into the files of its own first pivots and ranks what
it finds by the footrule distance of the two orders. The best by footrule are measured by
their true distance.

Equal vectors are one posting with the smallest ids of the class, one more than neighbours are
wanted: others cannot be among the answers. A long file is dealt out in parts, so a hot pivot
is shared by many tasks; each part answers for itself and the parts' answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import store

# Pivots are vectors of the index, those first by a hash of their components; 256 at most.
PIVOTS = 128
# Pivots kept of a vector's order, files it is posted in, files a query looks into. Vectors whose
# neighbours lie in all directions need most files for nine tenths of the neighbours; a posting
# in each of several files costs as many footrules and several times the shuffle.
PREFIX, POSTED, PROBED = 128, 1, 96
# Of each part of a file, the share that is measured, best by footrule, and the least number.
SHARE, LEAST = 0.1, 64
# Postings and queries that meet in one task at a time.
PART, QUERY_PART = 4096, 1024


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v of vectors that are not null or zero and have finite components only."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("v", lambda x: x != 0))


def choose_pivots(classes: DataFrame, count: int) -> np.ndarray:
    """A bounded sample of the distinct vectors, first by a hash of the components."""
    rows = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(count).collect()
    return np.array([row["v"] for row in rows], np.float64)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector in order; ties go to the lower number."""
    squares = (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.argsort(squares, axis=1, kind="stable")[:, :prefix].astype(np.uint8)


def with_orders(rows: DataFrame, pivots: np.ndarray, prefix: int, files: int) -> DataFrame:
    """Add perm, the whole prefix as bytes, and files, the first few pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.stack([np.array(x, np.float64) for x in batch["v"].to_pylist()])
                found = orders(vectors, pivots, prefix)
                made = [pa.array([x.tobytes() for x in found], pa.binary())]
                made.append(pa.array(found[:, :files].astype(np.int32).tolist(), pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "perm", "files"])

    before = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{before}, perm binary, files array<int>")


def footrules(queries: np.ndarray, vectors: np.ndarray, pivots: int) -> np.ndarray:
    """Footrule distance of each query's order to each vector's; a pivot not in a prefix counts as just after it."""
    prefix = queries.shape[1]

    def places(perms: np.ndarray) -> np.ndarray:
        found = np.full((len(perms), pivots), prefix, np.int16)
        np.put_along_axis(found, perms.astype(np.int64), np.arange(prefix, dtype=np.int16)[None, :], axis=1)
        return found.T.copy()

    q, v = places(queries), places(vectors)
    # Prefixes with no pivot in common are farthest apart.
    total = np.zeros((len(queries), len(vectors)), np.int16 if prefix * (prefix + 1) < 1 << 15 else np.int32)
    for k in range(pivots):
        total += np.abs(q[k][:, None] - v[k][None, :])
    return total


def nearest_in_part(held: pd.DataFrame, wanted: pd.DataFrame, pivots: int, k: int, share: float, least: int = LEAST) -> list[tuple]:
    """The k nearest of some postings to each of some queries: by footrule first, then by distance.

    Only the `share` best by footrule, `least` of them or more, are measured.
    """
    found = []
    held = held.sort_values("first_id")
    perms = np.stack([np.frombuffer(x, np.uint8) for x in held["perm"]])
    points = np.stack([np.asarray(x, np.float64) for x in held["v"]])
    ids = held["ids"].to_numpy()
    take = min(len(held), max(least, int(np.ceil(share * len(held)))))
    for begin in range(0, len(wanted), 128):
        block = wanted.iloc[begin : begin + 128]
        rules = footrules(np.stack([np.frombuffer(x, np.uint8) for x in block["perm"]]), perms, pivots)
        best = np.sort(np.argsort(rules, axis=1, kind="stable")[:, :take], axis=1)
        for own, query_id, v in zip(best, block["query_id"].tolist(), block["v"], strict=True):
            away = np.sqrt(((points[own] - np.asarray(v, np.float64)) ** 2).sum(axis=1))
            # A class holds an id besides the query's own, or none: k + 1 classes have k answers.
            limit = np.partition(away, k)[k] if len(away) > k + 1 else np.inf
            near = np.flatnonzero(away <= limit)
            mine = [(x, int(number)) for x, place in zip(away[near].tolist(), own[near], strict=True) for number in ids[place] if number != query_id]
            found += [(query_id, number, x) for x, number in sorted(mine)[:k]]
    return found


def search(
    vectors: DataFrame, query: Column, *, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    pivots: int = PIVOTS, prefix: int = PREFIX, posted: int = POSTED, probed: int = PROBED, share: float = SHARE,
    least: int = LEAST, part: int = PART, query_part: int = QUERY_PART,
) -> DataFrame:
    """The k nearest rows to each row that `query` (on vec_id) selects, itself left out: query_id, rank, vec_id, score.

    The score is the Euclidean distance in double precision, ties go to the smaller id.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows without an id. Fewer than k other rows give fewer neighbours, a lone vector and an
    empty table none. Rows with equal id and vector count once; vectors must have one length.
    Other columns are ignored.
    """
    rows = store(usable(vectors, id_col, vector_col).distinct(), "vectors")
    smallest = Window.partitionBy("v").orderBy("vec_id")
    classes = rows.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
    classes = store(classes.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    chosen = choose_pivots(classes, pivots)
    count = len(chosen)
    if not count:
        return rows.selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "0D AS score").where("false")
    prefix = min(prefix, count)

    index = store(with_orders(classes, chosen, prefix, posted).withColumn("first_id", F.col("ids")[0]), "index")
    asked = store(with_orders(rows.where(query), chosen, prefix, probed).withColumnRenamed("vec_id", "query_id"), "queries")
    # One row a pivot: into how many parts its file and its queries are dealt.
    held = index.select(F.explode("files").alias("file")).groupBy("file").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    wanted = asked.select(F.explode("files").alias("file")).groupBy("file").agg(
        F.ceil(F.count("*") / query_part).cast("int").alias("query_parts")
    )
    dealt = F.broadcast(store(held.join(wanted, "file"), "files"))

    def own(id_column: str, parts: str) -> Column:
        return F.pmod(F.xxhash64(id_column), F.col(parts)).cast("int")

    def every(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))

    left = index.select(F.explode("files").alias("file"), "first_id", "ids", "perm", "v").join(dealt, "file")
    left = left.withColumn("piece", own("first_id", "parts")).withColumn("block", every("query_parts")).drop("parts", "query_parts")
    right = asked.select(F.explode("files").alias("file"), "query_id", "perm", "v").join(dealt, "file")
    right = right.withColumn("piece", every("parts")).withColumn("block", own("query_id", "query_parts")).drop("parts", "query_parts")

    def look_up(posts: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = nearest_in_part(posts, queries, count, k, share, least) if len(posts) and len(queries) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["file", "piece", "block"]
    grouped = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    met = grouped.applyInPandas(look_up, "query_id bigint, vec_id bigint, score double").dropDuplicates(["query_id", "vec_id"])
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
