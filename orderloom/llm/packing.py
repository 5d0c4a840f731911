"""Documents packed into sequences of bounded length: a cutting-stock problem.

A document longer than a sequence is cut into whole sequences and a rest. The rests are
counted by length class (multiples of `unit` tokens). Which mixes of classes fill a sequence
is found by column generation: a linear program over the histogram says how often each
pattern is used, a knapsack by dynamic programming prices new patterns with the program's
duals, until no pattern is worth adding. Pattern counts are rounded down and what is left is
filled greedily. All this works on at most sequence/unit counts, whatever the data's size.

Spark then ranks the documents of each class over range partitions; a rank names a pattern, a
copy of it and a place. Classes round up, so sequences have some room left: within a block of
neighbouring sequences, the emptiest are taken apart and their documents, cut, fill the rest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, store, texts_of
from orderloom.llm.tokens import CACHE_BYTES, END_ID, WORD_END, encode_texts, library_words, with_end_ids
from orderloom.operators.ranking import with_ranks

SEQUENCE = 4096
UNIT = 16
BLOCK = 256


# -- patterns: on the driver, over a histogram of sequence/unit counts at most ------------


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best total value within the capacity, and how many of each item."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fits = int(np.searchsorted(sizes, room, side="right"))
        best[room] = best[room - 1]
        if fits:
            totals = best[room - sizes[:fits]] + values[:fits]
            k = int(np.argmax(totals))
            if totals[k] > best[room] + 1e-12:
                best[room], took[room] = totals[k], k
    counts, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            counts[took[room]] += 1
            room -= sizes[took[room]]
    return float(best[capacity]), counts


def column_generation(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 1e-4):
    """Patterns (a column each) and how often each is used, by the linear program.

    Revised simplex on the inverse of the basis. It ends when the bound that the last price
    gives is within `gap` of the value, or within half a sequence, and after 6 steps a class at
    the latest: any basis on the way is a valid answer. Demands are told apart by a millionth,
    so that steps without gain do not go round in circles.
    """
    m = len(sizes)
    demand = demand * (1 + 1e-6 * np.arange(m) / m)
    fill = capacity // sizes
    basis = np.diag(fill).astype(float)
    inverse = np.diag(1.0 / fill)
    used = demand / fill
    for step in range(6 * m):
        duals = inverse.sum(axis=0)
        value, column = price(duals, sizes, capacity)
        total = used.sum()
        if value <= 1 + 1e-9 or total - total / value <= max(0.5, gap * total):
            break
        direction = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(direction > 1e-9, used / direction, np.inf)
        leaving = int(np.argmin(ratios))
        amount = ratios[leaving]
        used = np.maximum(used - amount * direction, 0)
        used[leaving] = amount
        basis[:, leaving] = column
        inverse[leaving] /= direction[leaving]
        others = np.arange(m) != leaving
        inverse[others] -= np.outer(direction[others], inverse[leaving])
        if step % 500 == 499:
            inverse = np.linalg.inv(basis)
            used = np.maximum(inverse @ demand, 0)
    return np.rint(basis).astype(np.int64), used


def patterns_for(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (how many of each size) with their whole counts; together they hold the demand exactly."""
    sizes = np.array(sorted(size for size, count in demand.items() if count), np.int64)
    if not len(sizes):
        return []
    left = np.array([demand[size] for size in sizes.tolist()], np.int64)
    columns, used = column_generation(left.astype(float), sizes, capacity)
    found = []
    for k in np.argsort(-used, kind="stable").tolist():
        column = columns[:, k]
        held = column > 0
        times = min(int(used[k] + 1e-3), int((left[held] // column[held]).min()))
        if times > 0:
            found.append(({int(s): int(c) for s, c in zip(sizes[held], column[held], strict=True)}, times))
            left = left - times * column
    while left.any():
        room, filled = capacity, {}
        for k in range(len(sizes) - 1, -1, -1):
            fits = min(int(left[k]), room // int(sizes[k]))
            if fits:
                filled[int(sizes[k])] = fits
                left[k] -= fits
                room -= fits * int(sizes[k])
        found.append((filled, 1))
    return found


class Slots:
    """From a size and a rank within it to a sequence and a place: sorted arrays, a few hundred patterns."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]]):
        counts = np.array([times for _, times in patterns], np.int64)
        bases = np.cumsum(counts) - counts
        self.sequences = int(counts.sum())
        self.of_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in {size for pattern, _ in patterns for size in pattern}:
            holding = [k for k, (pattern, _) in enumerate(patterns) if size in pattern]
            each = np.array([patterns[k][0][size] for k in holding], np.int64)
            held = each * counts[holding]
            self.of_size[size] = (np.cumsum(held) - held, each, bases[holding])

    def place(self, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        firsts, each, bases = self.of_size[size]
        k = np.searchsorted(firsts, ranks, side="right") - 1
        within = ranks - firsts[k]
        return bases[k] + within // each[k], within % each[k]


# -- one block of sequences ---------------------------------------------------------------


def settle_block(rows: pd.DataFrame, sequence: int) -> pd.DataFrame:
    """Offsets for the pieces of one block; its emptiest sequences fill the room in the others.

    The block keeps as few sequences as its tokens need. The pieces of the others are laid end
    to end over the room that is left and cut where a sequence is full.
    """
    rows = rows.sort_values(["sequence_id", "length", "slot", "doc_id", "start"], ascending=[True, False, True, True, True])
    filled = rows.groupby("sequence_id")["length"].sum().sort_values(ascending=False, kind="stable")
    need = -(-int(filled.sum()) // sequence)
    kept, spare = filled.iloc[:need], filled.index[need:]
    loose = rows["sequence_id"].isin(spare)
    stay = rows[~loose].copy()
    stay["offset"] = stay.groupby("sequence_id")["length"].cumsum() - stay["length"]
    moved = rows[loose].sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
    if not len(moved):
        return stay
    room = (sequence - kept).sort_values(ascending=False, kind="stable")
    room = room[room > 0]
    room_ends, piece_ends = np.cumsum(room.to_numpy()), np.cumsum(moved["length"].to_numpy())
    cuts = np.union1d(room_ends[room_ends < piece_ends[-1]], piece_ends)
    begins = np.concatenate([[0], cuts[:-1]])
    piece = np.searchsorted(piece_ends, begins, side="right")
    slot = np.searchsorted(room_ends, begins, side="right")
    parts = moved.iloc[piece].copy()
    piece_begin = piece_ends[piece] - moved["length"].to_numpy()[piece]
    room_begin = room_ends[slot] - room.to_numpy()[slot]
    whole = (cuts - begins) == parts["length"].to_numpy()
    parts["start"] = parts["start"].to_numpy() + begins - piece_begin
    parts["length"] = cuts - begins
    parts["sequence_id"] = room.index.to_numpy()[slot]
    parts["offset"] = kept[room.index].to_numpy()[slot] + begins - room_begin
    parts["ids_crc32"] = parts["ids_crc32"].where(whole)
    return pd.concat([stay, parts])


# -- the operator -------------------------------------------------------------------------


def pack_pieces(pieces: DataFrame, *, sequence: int = SEQUENCE, unit: int = UNIT, block: int = BLOCK) -> DataFrame:
    """Give pieces of at most `sequence` tokens a sequence and an offset.

    `pieces` has doc_id, text_hash, start, length, ids_crc32 and doc_tokens, a row per piece.
    The result has the same columns, sequence_id and offset. A piece that had to be cut comes
    as several rows without ids_crc32. Ties in length are broken by doc_id and start; equal
    rows are packed one by one. Without rows there are no sequences.
    """
    classed = pieces.withColumn("size", F.ceil(F.col("length") / unit).cast("int"))
    histogram = {row["size"]: row["count"] for row in classed.groupBy("size").count().collect()}
    slots = Slots(patterns_for(histogram, sequence // unit))
    ranked = with_ranks(
        classed, [("doc_id", "asc"), ("start", "asc")], partition_by=["size"], tiebreak=["text_hash"], row_number="rank"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            ranks = batch["rank"].to_numpy() - 1
            where, place_in = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes).tolist():
                mine = sizes == size
                where[mine], place_in[mine] = slots.place(size, ranks[mine])
            columns = [batch[name] for name in PIECE_COLUMNS]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(where), pa.array(place_in)], [*PIECE_COLUMNS, "sequence_id", "slot"])

    placed = ranked.mapInArrow(place, f"{PIECE_SCHEMA}, sequence_id bigint, slot bigint")
    full = F.col("length") == sequence
    settled = (
        placed.where(~full)
        .groupBy(F.floor(F.col("sequence_id") / block).alias("block"))
        .applyInPandas(lambda rows: settle_block(rows, sequence)[RESULT_COLUMNS], f"{PIECE_SCHEMA}, sequence_id bigint, offset bigint")
    )
    alone = placed.where(full).select(*PIECE_COLUMNS, "sequence_id", F.lit(0).cast("bigint").alias("offset"))
    return alone.unionByName(settled)


TEXT_BYTES = 512 << 10  # of texts tokenized at a time
PIECE_SCHEMA = "doc_id bigint, text_hash bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PIECE_COLUMNS = ["doc_id", "text_hash", "start", "length", "ids_crc32", "doc_tokens"]
RESULT_COLUMNS = [*PIECE_COLUMNS, "sequence_id", "offset"]


def first_pieces(
    docs: DataFrame, tokenizer: str, rule: str, end_id: int, sequence: int, word_bytes: int = CACHE_BYTES
) -> DataFrame:
    """Every document's ids cut into whole sequences and a rest, with a checksum of each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", TEXT_BYTES):
            words = library_words(tokenizer, word_bytes)
            ids, firsts = with_end_ids(*encode_texts(texts_of(batch["text"]), tokenizer, rule, words), end_id)
            lengths = np.diff(firsts)
            count = -(-lengths // sequence)
            doc = np.repeat(np.arange(len(lengths)), count)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * sequence
            length = np.minimum(lengths[doc] - start, sequence)
            raw = memoryview(ids.astype("<u4").tobytes())
            begin = (firsts[:-1][doc] + start) * 4
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + length * 4).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(doc)),
                    batch["text_hash"].take(pa.array(doc)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(lengths[doc], pa.int64()),
                ],
                PIECE_COLUMNS,
            )

    return docs.mapInArrow(run, PIECE_SCHEMA)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = WORD_END,
    end_id: int = END_ID,
    sequence: int = SEQUENCE,
    unit: int = UNIT,
    block: int = BLOCK,
    word_bytes: int = CACHE_BYTES,
) -> DataFrame:
    """Pack the ids of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece.

    A null or empty text is its end id alone, so every row has a piece. Rows with equal ids
    or equal texts are packed one by one. Very long texts give many whole sequences. Other
    columns are ignored; an empty table gives no rows. Only documents that were cut to fill
    room are encoded a second time, for the checksums of their parts. A Python worker remembers
    words in `word_bytes`; the rows are the same whatever it is.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")
    )
    pieces = store(first_pieces(rows, tokenizer, rule, end_id, sequence, word_bytes), "pieces")
    packed = store(pack_pieces(pieces, sequence=sequence, unit=unit, block=block), "packed")
    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = packed.where("ids_crc32 IS NULL")
    parts = cut.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "length", "doc_tokens", "sequence_id", "offset")).alias("parts")
    )
    again = rows.alias("r").join(
        parts.alias("p"), F.expr("r.doc_id <=> p.doc_id AND r.text_hash = p.text_hash"), "left_semi"
    )
    texts = again.dropDuplicates(["doc_id", "text_hash"])
    both = texts.alias("r").join(parts.alias("p"), F.expr("r.doc_id <=> p.doc_id AND r.text_hash = p.text_hash"))
    both = both.select("r.doc_id", "r.text", "p.parts")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", TEXT_BYTES):
            words = library_words(tokenizer, word_bytes)
            ids, firsts = with_end_ids(*encode_texts(texts_of(batch["text"]), tokenizer, rule, words), end_id)
            found = []
            for doc, held, first in zip(batch["doc_id"].to_pylist(), batch["parts"].to_pylist(), firsts.tolist(), strict=False):
                for part in held:
                    begin = first + part["start"]
                    crc = zlib.crc32(ids[begin : begin + part["length"]].astype("<u4").tobytes())
                    found.append({**part, "doc_id": doc, "ids_crc32": crc})
            yield pa.RecordBatch.from_pylist(found, schema=PART_SCHEMA)

    summed = both.mapInArrow(sums, ", ".join(f"{name} bigint" for name in result))
    return packed.where("ids_crc32 IS NOT NULL").select(*result).unionByName(summed)


PART_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)
