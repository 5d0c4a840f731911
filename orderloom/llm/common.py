"""What several operators share: the table reader, batches of bounded size, runs of characters."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

from orderloom.session import store  # noqa: F401

# Bytes of text that a task works on at a time; a longer text is a batch of its own.
CHUNK_BYTES = 2 << 20


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Its functions run there by name. A cluster where the package is installed has the same code.
    """
    context = spark.sparkContext
    if getattr(context, "_has_this_package", None) == __name__:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for module in sorted(package.rglob("*.py")):
            target.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._has_this_package = __name__


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices with at most `limit` bytes of text, or one row."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        at, before = 0, 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at, before = stop, int(ends[stop - 1])


def texts_of(column: pa.Array) -> list[str]:
    """The texts as Python strings; null is empty."""
    return [value or "" for value in column.to_pylist()]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def byte_widths(codes: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (codes > 0x7F).astype(np.int8) + (codes > 0x7FF) + (codes > 0xFFFF)


def joined_words(data: bytes, byte_starts: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """Pieces of one buffer by their starts: for each its number among the distinct, and these."""
    offsets = np.append(byte_starts, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(byte_starts), pa.py_buffer(offsets), pa.py_buffer(data))
    coded = pieces.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def expand(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[s:s+n] for all pairs (s, n), one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return values[:0]
    return values[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
