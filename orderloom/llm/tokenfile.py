"""Token files: the ids of documents, Simple-8b packed, in document order.

A file is a folder of Parquet part files, so that Spark's committer publishes whole tasks and
any store that Spark reaches will do. A row is a frame: the ids of consecutive documents of
one range of doc_id, with their directory. Inside a frame the ids are cut into blocks of
BLOCK ids; `block_words` says where in the packed words each block begins, so that a block
can be read alone and all blocks can be decoded at once by numpy.

A packed word has 64 bits: a selector of 4 bits says how many values of how many bits follow.
Values of 60 bits or more leave ESCAPE in their place and stand in `escapes` in full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, texts_of
from orderloom.llm.tokens import BYTE_LEVEL, END_ID, encode_texts, with_end_ids

BLOCK = 1024
# Simple-8b's selectors, as pairs of values in a word and bits of each.
SELECTORS = (
    (240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
COUNTS = np.array([count for count, _ in SELECTORS])
BITS = np.array([bits for _, bits in SELECTORS])
ESCAPE = (1 << 60) - 1

FRAME = (
    "part int, frame int, first_id bigint, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>,"
    " words binary, block_words binary, escapes binary"
)


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed words, the first word of each block, and the escaped values of an array of uint64.

    Each word takes as many values as fit; the last word of a block may be part empty.
    """
    values = np.asarray(values, np.uint64)
    large = values >= ESCAPE
    escapes = values[large]
    values = np.where(large, np.uint64(ESCAPE), values)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), escapes
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    # Bits of each value, a block a row, with room for the widest selector after the block's end.
    widths = np.zeros((len(starts), block + 240), np.uint8)
    bits_of = np.minimum(np.frexp(values.astype(np.float64))[1], 60)
    flat = np.zeros(len(starts) * block, np.uint8)
    flat[:n] = bits_of
    widths[:, :block] = flat.reshape(-1, block)
    choice = np.full((len(starts), block), len(SELECTORS) - 1, np.uint8)
    most, span = widths, 1
    for selector in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[selector]
        # The widest of `count` values from each place: two overlapping windows of the last span.
        while span < count:
            add = min(count - span, span)
            most = np.maximum(most[:, : most.shape[1] - add], most[:, add:])
            span += add
        choice[most[:, :block] <= bits] = selector
    choice = choice.reshape(-1)[:n]
    step = np.minimum(COUNTS[choice], np.repeat(ends, ends - starts) - np.arange(n))
    at, found = starts.copy(), []
    alive = np.arange(len(starts))
    while len(alive):
        found.append(at[alive])
        at[alive] += step[at[alive]]
        alive = alive[at[alive] < ends[alive]]
    begins = np.sort(np.concatenate(found))
    block_words = np.searchsorted(begins, starts)
    chosen = choice[begins]
    padded = np.concatenate([values, np.zeros(COUNTS.max(), np.uint64)])
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(chosen == selector)
        if bits and len(mine):
            places = begins[mine, None] + np.arange(count)
            held = np.where(places < (begins[mine] + step[begins[mine]])[:, None], padded[places], np.uint64(0))
            shifts = (np.arange(count) * bits).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(held << shifts, axis=1)
    return words, block_words.astype(np.int64), escapes


def unpack(words: np.ndarray, block_words: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The values that pack() has packed, all blocks at once."""
    values = np.zeros(n, np.uint64)
    if not n:
        return values
    selectors = (words >> np.uint64(60)).astype(np.int64)
    held = COUNTS[selectors]
    before = np.cumsum(held) - held
    of_block = np.repeat(np.arange(len(block_words)), np.diff(np.append(block_words, len(words))))
    starts = of_block * block + before - before[block_words][of_block]
    ends = np.minimum((of_block + 1) * block, n)
    for selector, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(selectors == selector)
        if bits and len(mine):
            shifts = (np.arange(count) * bits).astype(np.uint64)
            found = (words[mine, None] >> shifts) & np.uint64((1 << bits) - 1)
            places = starts[mine, None] + np.arange(count)
            inside = places < ends[mine, None]
            values[places[inside]] = found[inside]
    values[values == ESCAPE] = escapes
    return values


def unpack_block(frame: dict, number: int, block: int = BLOCK) -> np.ndarray:
    """The ids of one block of a frame without escapes, read alone."""
    words = np.frombuffer(frame["words"], "<u8")
    first = np.append(np.frombuffer(frame["block_words"], "<i8"), len(words))
    size = min(block, frame["n_ids"] - number * block)
    return unpack(words[first[number] : first[number + 1]], np.zeros(1, np.int64), np.zeros(0, np.uint64), size)


def write_token_file(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = BYTE_LEVEL,
    end_id: int = END_ID,
) -> None:
    """Encode every whole text and write the ids in ascending id order to a new folder `path`.

    A null text counts as empty and yields the end id alone. Rows with equal ids are all
    written, ordered by a hash of the text; a null id comes first. Other columns are ignored.
    An empty table gives a file without frames. A text longer than a chunk is one frame.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("part", F.spark_partition_id())

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number = 0, 0
        for batch in chunks(batches, "text"):
            ids, starts = with_end_ids(*encode_texts(texts_of(batch["text"]), tokenizer, rule), end_id)
            words, block_words, escapes = pack(ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([batch["part"][0].as_py()], pa.int32()),
                    "frame": pa.array([number], pa.int32()),
                    "first_id": [first],
                    "n_ids": [len(ids)],
                    "doc_ids": pa.array([batch["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    "doc_tokens": [np.diff(starts).tolist()],
                    "words": [words.astype("<u8").tobytes()],
                    "block_words": [block_words.astype("<i8").tobytes()],
                    "escapes": [escapes.astype("<u8").tobytes()],
                }
            )
            first, number = first + len(ids), number + 1

    ranged.mapInArrow(frames, FRAME).write.parquet(path)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a token file: doc_id, start, n_tokens, ids (little-endian uint32), ids_crc32.

    `start` counts the ids of all documents before it. Each range of documents knows its own
    positions; what comes before a range is summed over one row per range.
    """
    frames = spark.read.schema(FRAME).parquet(path)
    sizes = frames.groupBy("part").agg(F.sum("n_ids").alias("_size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frame in batch.to_pylist():
                parts = [np.frombuffer(frame[name], kind) for name, kind in ARRAYS]
                ids = unpack(*parts, frame["n_ids"]).astype("<u4")
                lengths = np.array(frame["doc_tokens"], np.int64)
                ends = np.cumsum(lengths)
                pieces = [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([frame["part"]] * len(pieces), pa.int32()),
                        "doc_id": pa.array(frame["doc_ids"], pa.int64()),
                        "start": pa.array(frame["first_id"] + ends - lengths, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids": pa.array(pieces, pa.binary()),
                        "ids_crc32": pa.array([zlib.crc32(piece) for piece in pieces], pa.int64()),
                    }
                )

    found = frames.mapInArrow(
        documents, "part int, doc_id bigint, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint"
    )
    placed = found.join(bases, F.col("part") == F.col("_part"))
    return placed.select("doc_id", (F.col("start") + F.col("_base")).alias("start"), "n_tokens", "ids", "ids_crc32")


ARRAYS = (("words", "<u8"), ("block_words", "<i8"), ("escapes", "<u8"))
