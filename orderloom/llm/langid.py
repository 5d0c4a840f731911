"""Language by compression: the language whose dictionary makes a text smallest.

For each language passages of labelled texts become a zstandard raw-content dictionary. A text is cut
into segments, and each is compressed with every dictionary; a segment is short, so it is the
dictionary and not the text's own past that decides. The language with the fewest bytes over
all segments wins; where the next one comes within a margin, the answer is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks

UNKNOWN = "und"
# The dictionaries are fitted on a bounded sample: of each language as many segments, from
# anywhere in its labelled texts, as fill this many bytes.
DICTIONARY_BYTES = 110_000
SEGMENT = 1000
# Segments of a language that are looked at, for each one that a dictionary of full segments
# holds: short ones and copies leave room for more.
SPARE = 8
LEVEL, SHORTEST_MATCH = 9, 3
# Zeros after each segment: a segment that would not shrink is else stored as it is, at the
# same size by every dictionary.
TAIL = bytes(40)
# Bytes a thousand characters by which the best language must lead.
MARGIN = 1.0
FOLDS = 5
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """The fold that no language is learned from; a row without an id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit_dictionaries(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    size: int = DICTIONARY_BYTES, segment: int = SEGMENT,
) -> dict[str, bytes]:
    """A dictionary for each language of the labelled rows; rows without text or label teach nothing.

    Every text, whole, is cut into segments of `segment` characters. A first pass counts them by
    language; a second draws by hash of text and place about SPARE times as many as fill a
    dictionary, equal ones once, and the driver takes them in the order of the hash until `size`
    bytes are full. So what is gathered is bounded by the number of languages, a language with
    many rows is one group of counts, and every passage has the same chance.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0)).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    pieces = F.ceil(F.length("text") / segment).cast("int")
    counted = labelled.groupBy("lang").agg(F.sum(pieces.cast("bigint")).alias("pieces"))
    shares = {row["lang"]: min(1.0, SPARE * size / segment / row["pieces"]) for row in counted.collect()}
    if not shares:
        return {}
    share = F.create_map(*[F.lit(x) for pair in sorted(shares.items()) for x in pair])[F.col("lang")]
    places = labelled.withColumn("hash", F.xxhash64("text")).withColumn("last", pieces - 1)
    places = places.withColumn("places", F.filter(F.sequence(F.lit(0), "last"), lambda k: _drawn("hash", k) < share))
    drawn = places.where(F.size("places") > 0).select("lang", "text", "hash", F.explode("places").alias("place"))
    piece = F.lower(F.col("text").substr(F.col("place") * segment + 1, F.lit(segment)))
    drawn = drawn.select("lang", _drawn("hash", F.col("place")).alias("order"), piece.alias("piece"))
    texts: dict[str, list[bytes]] = {lang: [] for lang in sorted(shares)}
    room = dict.fromkeys(shares, size)
    for row in sorted(drawn.distinct().collect(), key=lambda row: (row["order"], row["lang"], row["piece"])):
        content = row["piece"].encode()
        if room[row["lang"]] > 0:
            texts[row["lang"]].append(content[: room[row["lang"]]])
            room[row["lang"]] -= len(content) + 1
    return {lang: b"\n".join(own) for lang, own in texts.items()}


def _drawn(hashed: str, place: Column) -> Column:
    """A number from 0 to 1 for a place of a text, the same for equal texts."""
    return F.xxhash64(F.col(hashed), place).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))


@lru_cache(maxsize=4)
def _compressors(dictionaries: tuple[tuple[str, bytes], ...], level: int) -> list:
    import zstandard as zstd

    made = []
    for _, content in dictionaries:
        settings = zstd.ZstdCompressionParameters.from_level(
            level, dict_size=len(content), source_size=SEGMENT, min_match=SHORTEST_MATCH,
            write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        shared = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(compression_params=settings)
        made.append(zstd.ZstdCompressor(compression_params=settings, dict_data=shared))
    return made


def segments(text: str, size: int = SEGMENT) -> list[bytes]:
    """The whole text in pieces of about equal length, at most `size` characters."""
    count = max(1, -(-len(text) // size))
    cuts = [len(text) * k // count for k in range(count + 1)]
    return [text[a:b].encode() + TAIL for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def classify(text: str, compressors: list) -> np.ndarray:
    """Compressed bytes of the text by each language."""
    pieces = segments(text)
    return np.array([sum(len(compressor.compress(piece)) for piece in pieces) for compressor in compressors])


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text",
    level: int = LEVEL, margin: float = MARGIN, keep_columns: bool = False,
) -> DataFrame:
    """doc_id, lang_pred, score and accepted for every row, after all columns of `docs` with `keep_columns`.

    A null text, one without letters, and any text when no language was learned are `und`
    with score 0 and not accepted. Else lang_pred is the language of the smallest size (of
    equal ones the first by name), score is between 0 and 1, larger where the lead per
    character is larger, and accepted says that the lead is at least `margin` bytes a thousand
    characters. Texts are used whole. Equal texts get equal answers; an empty table gives no rows.
    With `keep_columns`, columns of `docs` named lang_pred, score or accepted are replaced.
    """
    learned = tuple(sorted(dictionaries.items()))
    names = [name for name, _ in learned]
    found = {"lang_pred": pa.string(), "score": pa.float64(), "accepted": pa.bool_()}
    rows = docs if keep_columns else docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    text_name = text_col if keep_columns else "text"
    rows = rows.drop(*found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(learned, level)
        for batch in chunks(batches, text_name):
            langs, scores, sure = [], [], []
            for text in batch[text_name].to_pylist():
                if not names or not text or not _LETTER.search(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    sure.append(False)
                    continue
                sizes = classify(text.lower(), compressors)
                best = int(np.argmin(sizes))
                lead = float(np.partition(sizes, 1)[1] - sizes[best]) * 1000 / len(text) if len(sizes) > 1 else 1000.0
                langs.append(names[best])
                scores.append(lead / (lead + 10))
                sure.append(lead >= margin)
            kept = batch.columns if keep_columns else [batch["doc_id"]]
            labels = batch.schema.names if keep_columns else ["doc_id"]
            made = [pa.array(x, kind) for x, kind in zip((langs, scores, sure), found.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*kept, *made], [*labels, *found])

    before = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] if keep_columns else ["doc_id bigint"]
    return rows.mapInArrow(run, ", ".join([*before, "lang_pred string", "score double", "accepted boolean"]))


def learn(docs: DataFrame, **options) -> dict[str, bytes]:
    """Dictionaries from the documents outside the held-out fold, texts in lower case."""
    return fit_dictionaries(docs.where(~held_out(F.col("doc_id"))), **options)
