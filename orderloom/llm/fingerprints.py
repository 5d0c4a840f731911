"""Context-triggered piecewise hashes of documents.

A rolling hash over the last WINDOW bytes marks boundaries where its remainder by the block
size is the largest one, so a change moves only the boundaries next to it. Each chunk between
boundaries gives a signature of two letters. The block size is the smallest of 3, 6, 12, ...
by which the text has at most LETTERS blocks; the fingerprint also holds the signature at
twice that size, so texts up to four times as long as each other can be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, store

WINDOW = 7
SMALLEST = 3
LETTERS = 64
RUN = 3
STEP = 1 << 20
TEXT_BYTES = 2 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL, _CHUNK = 0x01000193, 0x9E3779B97F4A7C15  # odd multipliers of the two hashes


def _table(factor: int) -> np.ndarray:
    """factor ** k for k up to STEP, by 64-bit arithmetic."""
    factors = np.full(STEP + 1, factor, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


_POWERS, _INVERSE = _table(_CHUNK), _table(pow(_CHUNK, -1, 1 << 64))


def _power(places: np.ndarray, table: np.ndarray, factor: int) -> np.ndarray:
    high = places // STEP
    by_step = np.array([pow(factor, STEP * int(k), 1 << 64) for k in range(int(high.max(initial=0)) + 1)], np.uint64)
    return table[places % STEP] * by_step[high]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _rolled(data: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The rolling hash at each byte of a stretch; before the first byte there are zeros."""
    lead = min(begin, WINDOW - 1)
    wide = np.concatenate([np.zeros(WINDOW - 1 - lead, np.uint32), data[begin - lead : end].astype(np.uint32)])
    roll = np.zeros(end - begin, np.uint32)
    for k in range(WINDOW):
        roll = roll * np.uint32(_ROLL) + wide[k : k + end - begin]
    roll ^= roll >> np.uint32(15)
    roll *= np.uint32(0x2C1B3C6D)
    return roll ^ (roll >> np.uint32(13))


def block_size(length: int) -> int:
    size = SMALLEST
    while size * LETTERS < length:
        size *= 2
    return size


def _signatures(places, sums, owner, starts, sizes, hashes, ends) -> list[str]:
    """The signature of each text at its size: two letters a chunk, at most RUN equal neighbours."""
    held = ends | (hashes % sizes[owner] == sizes[owner] - 1)
    places, sums, owner = places[held], sums[held], owner[held]
    first = np.ones(len(owner), bool)
    first[1:] = owner[1:] != owner[:-1]
    begins = np.where(first, starts[owner], np.concatenate([[0], places[:-1]]))
    content = np.diff(sums, prepend=np.uint64(0)) * _power(begins, _INVERSE, pow(_CHUNK, -1, 1 << 64))
    marks = (_mixed(content + (places - begins).astype(np.uint64)) >> np.uint64(52)).astype(np.int64)
    if len(marks) > RUN:
        same = (marks[1:] == marks[:-1]) & (owner[1:] == owner[:-1])
        again = np.logical_and.reduce([same[k : len(same) - RUN + 1 + k] for k in range(RUN)])
        kept = np.concatenate([np.ones(RUN, bool), ~again])
        marks, owner = marks[kept], owner[kept]
    letters = ALPHABET[np.stack([marks >> 6, marks & 63], axis=1)].tobytes().decode()
    stops = 2 * np.searchsorted(owner, np.arange(len(starts) + 1))
    return [letters[a:b] for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def fingerprint_all(texts: list[bytes]) -> list[str]:
    """`size:signature:signature at twice the size` of texts in UTF-8; an empty text gives `3::`.

    The texts are laid out with WINDOW - 1 zeros before each and walked in steps of bounded
    size; only what is known at possible boundaries is kept. The running sum at a place is
    that of byte * multiplier ** place, so the difference of two is a hash of what lies between.
    """
    if not any(texts):
        return [f"{SMALLEST}::"] * len(texts)
    gap = bytes(WINDOW - 1)
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.cumsum(lengths + WINDOW - 1)
    starts = stops - lengths
    inside = np.ones(len(data), bool)
    inside[(starts[:, None] - np.arange(1, WINDOW)).ravel()] = False
    last = np.zeros(len(data), bool)
    last[stops[lengths > 0] - 1] = True
    kept: list[list[np.ndarray]] = [[], [], [], []]
    total = np.uint64(0)
    for begin in range(0, len(data), STEP):
        end = min(begin + STEP, len(data))
        roll = _rolled(data, begin, end)
        at = np.flatnonzero((roll % np.uint32(SMALLEST) == SMALLEST - 1) & inside[begin:end] | last[begin:end])
        weights = _POWERS[: end - begin] * np.uint64(pow(_CHUNK, begin, 1 << 64))
        values = (data[begin:end].astype(np.uint64) + np.uint64(1)) * inside[begin:end]
        running = np.cumsum(values * weights, dtype=np.uint64) + total
        for column, value in zip(kept, (at + begin + 1, running[at], roll[at].astype(np.int64), last[begin:end][at]), strict=True):
            column.append(value)
        total = running[-1]
    places, sums, hashes, ends = map(np.concatenate, kept)
    owner = np.searchsorted(stops, places)
    sizes = np.array([block_size(length) for length in lengths.tolist()], np.int64)
    fine = _signatures(places, sums, owner, starts, sizes, hashes, ends)
    coarse = _signatures(places, sums, owner, starts, 2 * sizes, hashes, ends)
    return [f"{size}:{a}:{b}" for size, a, b in zip(sizes.tolist(), fine, coarse, strict=True)]


def fingerprint(text: bytes) -> str:
    return fingerprint_all([text])[0]


def _likeness(a: str, b: str) -> float:
    """Signatures (two letters a chunk) by the edits, insertions and deletions, from one to the other."""
    if a == b:
        return 1.0
    left, right = [a[k : k + 2] for k in range(0, len(a), 2)], [b[k : k + 2] for k in range(0, len(b), 2)]
    if not left or not right:
        return 0.0
    places: dict[str, int] = {}
    for k, mark in enumerate(left):
        places[mark] = places.get(mark, 0) | 1 << k
    if places.keys().isdisjoint(right):
        return 0.0
    full = (1 << len(left)) - 1
    row = full
    for mark in right:
        hit = row & places.get(mark, 0)
        row = ((row + hit) | (row - hit)) & full
    common = len(left) - row.bit_count()
    edits = len(left) + len(right) - 2 * common
    return 1 - edits / (len(left) + len(right))


def likeness(a: str, b: str) -> float:
    """0 to 1: signatures compared at each block size that both fingerprints have; 0 if there is none.

    Equal fingerprints are 1, so two empty texts are alike; an empty and another text are 0.
    """
    if a == b:
        return 1.0
    (x, a1, a2), (y, b1, b2) = a.split(":"), b.split(":")
    at = {int(x): a1, 2 * int(x): a2}
    other = {int(y): b1, 2 * int(y): b2}
    return max([0.0, *(_likeness(at[size], other[size]) for size in at.keys() & other.keys())])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars and fingerprint of every whole text, a row per row.

    A null text counts as empty. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", TEXT_BYTES):
            texts = [value or "" for value in batch["text"].to_pylist()]
            prints = fingerprint_all([text.encode() for text in texts])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(map(len, texts), pa.int64()), pa.array(prints, pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The text with its last third replaced by the first characters, as many or all, of the following."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


NEIGHBOURS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double, text string, part int, role string"
)
RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(ids: list, texts: list[str], own: list[str], following: list[str], next_prints: list[str]) -> list[dict]:
    edited = [edited_text(text, after).encode() for text, after in zip(texts, following, strict=True)]
    prints = fingerprint_all(edited)
    return [
        {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(new).hexdigest(),
            "fingerprint": old_print,
            "edited_fingerprint": new_print,
            "near_edited": likeness(old_print, new_print),
            "near_next": likeness(old_print, next_print),
        }
        for doc_id, text, new, old_print, new_print, next_print in zip(
            ids, texts, edited, own, prints, next_prints, strict=True
        )
    ]


def edited_neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Compare each document with its edited text and with the next document, in descending doc_id.

    After the last document comes the first; a lone document is its own next. Rows with equal
    ids are ordered by a hash of the text; a null id comes last, a null text counts as empty.
    Other columns are ignored; an empty table gives no rows.

    The documents are dealt out in ranges and walked in order. Only the last document of a
    range needs one from elsewhere, the first of the next range: those pairs, two rows a
    range, are joined afterwards.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose next has not come yet: doc_id, text, fingerprint
        part = None
        for batch in chunks(batches, "text", TEXT_BYTES):
            texts = batch["text"].to_pylist()
            mine = list(zip(batch["doc_id"].to_pylist(), texts, fingerprint_all([x.encode() for x in texts]), strict=True))
            found = []
            if held is None:
                part = batch["part"][0].as_py()
                found.append({"doc_id": mine[0][0], "text": mine[0][1], "fingerprint": mine[0][2], "part": part, "role": "head"})
            else:
                mine.insert(0, held)
            ids, texts, prints = (list(column) for column in zip(*mine, strict=True))
            found += _compared(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:])
            held = mine[-1]
            yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)
        if held is not None:
            last = {"doc_id": held[0], "text": held[1], "fingerprint": held[2], "part": part, "role": "tail"}
            yield pa.RecordBatch.from_pylist([last], schema=_SCHEMA)

    walked = store(ranged.drop("text_hash").mapInArrow(walk, NEIGHBOURS), "neighbours")
    heads, tails = walked.where("role = 'head'"), walked.where("role = 'tail'")
    # Which range follows which: one row of two numbers a range.
    parts = heads.select("part")
    following = parts.crossJoin(F.broadcast(parts.agg(F.min("part").alias("first")))).selectExpr(
        "part", "coalesce(lead(part) OVER (ORDER BY part), first) AS next_part"
    )
    pairs = tails.join(following, "part").join(
        heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print")),
        "next_part",
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[x].to_pylist() for x in ("doc_id", "text", "fingerprint", "next_text", "next_print")]
            yield pa.RecordBatch.from_pylist(_compared(*columns), schema=_SHORT)

    ends = pairs.select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(
        compare, ", ".join(NEIGHBOURS.split(", ")[: len(RESULT)])
    )
    return walked.where("role IS NULL").select(*RESULT).unionByName(ends)


_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("text", pa.string()), ("part", pa.int32()), ("role", pa.string()),
    ]
)
_SHORT = pa.schema(list(_SCHEMA)[: len(RESULT)])
