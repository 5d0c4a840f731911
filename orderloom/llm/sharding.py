"""Shards of near equal bytes by histogram sort.

Rows are put in the order of a key: a hash of the text, then the id, then a number given when
the rows were stored, so that every row has its own key, equal texts stand together, and a hot
text can be cut anywhere. A key is a whole number of 192 bits. Each round counts, over all
rows, the exact bytes and rows between candidate boundaries; a boundary is refined inside the
cell that holds its target until it is within the tolerance or the cell is one row. Only then
do the rows move, once, to the task of their piece.

A shard may be cut into several pieces, one a task, so that no task grows with the table;
counts of the rows before each piece make its slots go on without a gap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import store

SHARDS = 16
TOLERANCE = 0.001  # of a shard's bytes
PIECE_BYTES = 256 << 20
LOOSE = 0.25  # tolerance of boundaries inside a shard, of a piece
PROBES = 32  # candidate boundaries for each that is sought in a round
MOST_PROBES = 1 << 16
KEY = ["key_hash", "key_id", "key_row"]
WIDTH = 8 * len(KEY)


def _key_bytes(columns: list[np.ndarray]) -> np.ndarray:
    """Keys as byte strings that sort like the three signed numbers."""
    parts = [np.asarray(column, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for column in columns]
    return np.stack(parts, axis=1).astype(">u8", order="C").view(f"S{WIDTH}").reshape(-1)


def _as_bytes(keys: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(key.to_bytes(WIDTH, "big") for key in keys), f"S{WIDTH}")


def _as_int(key: bytes) -> int:
    return int.from_bytes(bytes(key).ljust(WIDTH, b"\0"), "big")


@dataclass(frozen=True)
class Cell:
    """Neighbouring keys: the least and the greatest, and rows and bytes before and in the cell."""

    low: int
    high: int
    rows_before: int
    bytes_before: int
    rows: int
    bytes: int


def count_cells(keys: DataFrame, bounds: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Rows, bytes, least and greatest key from each boundary up to the next, where there are any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _as_bytes(bounds)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _key_bytes([batch[name].to_numpy() for name in KEY])
            order = np.argsort(own, kind="stable")
            own, size = own[order], batch["size"].to_numpy()[order]
            cell = np.searchsorted(edges, own, side="right") - 1
            each, first, times = np.unique(cell, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(each, pa.int64()),
                    pa.array(times, pa.int64()),
                    pa.array(np.add.reduceat(size, first), pa.int64()),
                    pa.array([bytes(key).ljust(WIDTH, b"\0") for key in own[first]], pa.binary()),
                    pa.array([bytes(key).ljust(WIDTH, b"\0") for key in own[first + times - 1]], pa.binary()),
                ],
                ["cell", "rows", "bytes", "low", "high"],
            )

    counted = keys.mapInArrow(count, "cell bigint, rows bigint, bytes bigint, low binary, high binary")
    summed = counted.groupBy("cell").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return {row["cell"]: (row["rows"], row["bytes"], _as_int(row["low"]), _as_int(row["high"])) for row in summed.collect()}


def find_boundaries(keys: DataFrame, shares: list[float], tolerances: list[float]) -> tuple[list[tuple[int, int, int]], int, int]:
    """For ascending shares of all bytes the boundary (key, rows below, bytes below) nearest to each.

    Tolerances are shares too. Returns the boundaries and all rows and bytes. What comes to
    the driver in a round is a row for each candidate.
    """
    counted = count_cells(keys, [0])
    if not counted:
        return [(0, 0, 0)] * len(shares), 0, 0
    rows, total, low, high = counted[0]
    cells = [Cell(low, high, 0, 0, rows, total)]
    targets = [share * total for share in shares]
    allowed = [share * total for share in tolerances]
    while True:
        ends = np.array([cell.bytes_before + cell.bytes for cell in cells], float)
        inside: dict[int, int] = {}
        for target, error in zip(targets, allowed, strict=True):
            at = min(int(np.searchsorted(ends, target)), len(cells) - 1)
            cell = cells[at]
            miss = min(target - cell.bytes_before, cell.bytes_before + cell.bytes - target)
            if miss > error and cell.rows > 1:
                inside[at] = inside.get(at, 0) + 1
        if not inside:
            break
        each = max(1, min(PROBES, MOST_PROBES // sum(inside.values())))
        bounds, starts = [], {}
        for at, sought in inside.items():
            cell = cells[at]
            steps = min(sought * each + 1, cell.high - cell.low + 1)
            span = cell.high - cell.low
            edges = sorted({cell.low + max(1, span * k // steps) for k in range(1, steps)} | {cell.high})
            starts[at] = (len(bounds), len(edges) + 1)
            bounds += [cell.low, *edges, cell.high + 1]
        # Cells are in order, so the bounds are too; the last one of a cell opens a gap that nothing asks for.
        counted = count_cells(keys, bounds)
        refined = []
        for at, cell in enumerate(cells):
            if at not in starts:
                refined.append(cell)
                continue
            first, number = starts[at]
            rows_before, bytes_before = cell.rows_before, cell.bytes_before
            for k in range(first, first + number):
                if k in counted:
                    r, b, low, high = counted[k]
                    refined.append(Cell(low, high, rows_before, bytes_before, r, b))
                    rows_before, bytes_before = rows_before + r, bytes_before + b
        cells = refined
    found = []
    for target in targets:
        cell = cells[min(int(np.searchsorted(ends, target)), len(cells) - 1)]
        if target - cell.bytes_before <= cell.bytes_before + cell.bytes - target:
            found.append((cell.low, cell.rows_before, cell.bytes_before))
        else:
            found.append((cell.high + 1, cell.rows_before + cell.rows, cell.bytes_before + cell.bytes))
    return found, rows, total


def shard_documents(
    docs: DataFrame,
    shards: int = SHARDS,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tolerance: float = TOLERANCE,
    piece_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """size, text_crc32, shard, slot and the whole row as struct `document`; shards are near equal in bytes.

    Size is the text's UTF-8 bytes and 1. Each boundary between shards misses its share of all
    bytes by `tolerance` of a shard at most, or by half of one row. Equal texts, null and empty
    among them, stand together and are parted only where a boundary must lie within them; rows
    equal in all columns are placed one by one. A null id comes first among equal texts. The
    struct keeps every column, so no name can clash. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = store(
        docs.select(
            F.xxhash64(text).alias("key_hash"),
            F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("key_id"),
            F.monotonically_increasing_id().alias("key_row"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.struct(*[docs[name] for name in docs.columns]).alias("document"),
        ),
        "keyed",
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, -(-total // (shards * piece_bytes)))
    pieces = shards * per_shard
    places = range(1, pieces)
    exact, loose = tolerance / shards, LOOSE / pieces
    found, all_rows, _ = find_boundaries(
        rows.select(*KEY, "size"),
        [k / pieces for k in places],
        [exact if k % per_shard == 0 else loose for k in places],
    )
    below = [0, *(rows_below for _, rows_below, _ in found)]
    edges = [key for key, _, _ in found]

    @F.pandas_udf("int")
    def piece_of(key_hash: pd.Series, key_id: pd.Series, key_row: pd.Series) -> pd.Series:
        own = _key_bytes([key_hash.to_numpy(), key_id.to_numpy(), key_row.to_numpy()])
        return pd.Series(np.searchsorted(_as_bytes(edges), own, side="right").astype(np.int32))

    piece = piece_of(*KEY) if edges else F.lit(0)
    moved = rows.withColumn("piece", piece).repartitionById(pieces, "piece").sortWithinPartitions(*KEY)
    # The lower 33 bits of the growing id are the place in the partition, which is the piece.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    moved = moved.withColumn("place", place)
    offsets = spark.createDataFrame(
        [(k, k // per_shard, below[k] - below[k - k % per_shard]) for k in range(pieces)],
        "piece int, shard int, before bigint",
    )
    # One row a task.
    placed = moved.join(F.broadcast(offsets), "piece")
    return placed.select("size", "text_crc32", "shard", (F.col("before") + F.col("place")).alias("slot"), "document")


def write_shards(sharded: DataFrame, path: str) -> None:
    """The documents in a folder a shard, each piece a file in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
