"""Documents chosen by importance: how much likelier a text is among good texts than in the raw corpus.

Both corpora are bags of hashed n-grams: how often each bucket occurs. A document's log weight
is the sum over its n-grams of log(share in the target / share in the raw text): the log ratio
of the likelihoods that two bags of n-grams give to the text. Sampling without replacement with
chances that follow the weights is the choice of the k largest of log weight plus Gumbel noise.
By default the weight is the mean per n-gram: a sum grows with the length of the text, so that
one long good text of an odd kind puts the cut that is fitted on few labels below all bad texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, joined_words, store
from orderloom.operators.ranking import with_ranks

BUCKETS = 1 << 15
SMOOTHING = 0.5
# N-grams by which the target model is drawn towards the raw one, so that a small target does
# not call all unseen n-grams bad.
PRIOR = 100_000
# Up to so many ids of good documents are sent to the scan; with more of them texts move to their ids.
SENT_IDS = 2_000_000
# Nats of log weight that count as one unit of noise: of the sum, and of the mean per n-gram.
TEMPERATURE, MEAN_TEMPERATURE = 1.0, 0.01
# Of labelled good documents, this share may lie below the cut that says how many are kept.
LOSS = 0.002
_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def hashed_ngrams(texts: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, marks and pairs of neighbours, and how many each text has.

    A word is a run of letters and digits, a mark a run of other characters but white space.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    joined = b"".join(texts)
    if not joined:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    kinds = _KIND[np.frombuffer(joined, np.uint8)]
    new = np.ones(len(kinds), bool)
    new[1:] = kinds[1:] != kinds[:-1]
    new[firsts[:-1][sizes > 0]] = True
    starts = np.flatnonzero(new)
    numbers, pieces = joined_words(joined, starts)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(piece) for piece in pieces), np.uint64, len(pieces))
    held = kinds[starts] > 0
    words = hashes[numbers[held]]
    owner = np.searchsorted(firsts, starts[held], side="right") - 1
    pairs = (words[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ words[1:]
    pairs = pairs[owner[1:] == owner[:-1]]
    pair_owner = owner[1:][owner[1:] == owner[:-1]]
    every = np.concatenate([words, pairs])
    owners = np.concatenate([owner, pair_owner])
    order = np.argsort(owners, kind="stable")
    every = every[order]
    every = (every ^ (every >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (every >> np.uint64(49)).astype(np.int64) % buckets, np.bincount(owners, minlength=len(texts))


def held_back(id_col: str) -> Column:
    """The fifth of the labelled documents that fits the cut and not the target model."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("cut")), F.lit(5)) == 0


def fit(docs: DataFrame, target_ids: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of each bucket: target documents against all documents, both counted whole.

    All of `target_ids` are used, repeated ones once. Up to SENT_IDS of them are sent to the scan,
    so that no text moves. Each task sends one count per bucket. Without target documents every ratio is 0.
    """
    ids = target_ids.select(F.col(id_col).alias("doc_id")).distinct()
    few = ids.limit(SENT_IDS + 1).count() <= SENT_IDS
    ids = ids.withColumn("target", F.lit(True))
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids) if few else ids, "doc_id", "left"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in chunks(batches, "text"):
            found, sizes = hashed_ngrams([(x or "").encode() for x in batch["text"].to_pylist()], buckets)
            raw += np.bincount(found, minlength=buckets)
            mine = np.array([bool(x) for x in batch["target"].to_pylist()], bool)
            target += np.bincount(found[np.repeat(mine, sizes)], minlength=buckets)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(target[seen])], ["bucket", "raw", "target"]
        )

    counted = marked.select("text", "target").mapInArrow(count, "bucket int, raw bigint, target bigint")
    totals = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.full(buckets, SMOOTHING), np.zeros(buckets)
    for row in totals.collect():
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    share = raw / raw.sum()
    return np.log((target + PRIOR * share) / (target.sum() + PRIOR)) - np.log(share)


def weigh(docs: DataFrame, ratios: np.ndarray, *, text_col: str = "text", per_ngram: bool = True) -> DataFrame:
    """All columns of `docs`, then log_weight, the mean or the sum over all n-grams (0 without any), and n_ngrams."""
    rows = docs.drop("log_weight", "n_ngrams")
    sent = rows.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in chunks(batches, text_col):
            found, sizes = hashed_ngrams([(x or "").encode() for x in batch[text_col].to_pylist()], len(weights))
            sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights[found], len(sizes))
            sums = np.round(sums / np.maximum(sizes, 1), 9) if per_ngram else np.round(sums, 6)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())],
                [*batch.schema.names, "log_weight", "n_ngrams"],
            )

    before = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(run, ", ".join([*before, "log_weight double", "n_ngrams bigint"]))


def gumbel(*columns: str | Column) -> Column:
    """Noise that depends on the named columns alone, so that a retry or another layout draws it again."""
    uniform = (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, found by ranks over ranges; None where there are fewer."""
    ranked = with_ranks(keys.select(column), [(column, "desc")], row_number="_place")
    found = ranked.where(F.col("_place") == k).select(column).collect()
    return found[0][0] if found else None


def quantile(rows: DataFrame, column: str, share: float) -> float | None:
    """The exact percentile of a column without nulls, between two values by their distance; found by ranks over ranges."""
    count = rows.count()
    if not count:
        return None
    place = share * (count - 1)
    low, high = math.floor(place), math.ceil(place)
    ranked = with_ranks(rows.select(column), [(column, "asc")], row_number="_place")
    found = {row["_place"]: row[column] for row in ranked.where(F.col("_place").isin(low + 1, high + 1)).collect()}
    below, above = found[low + 1], found[high + 1]
    return below if below == above else (high - place) * below + (place - low) * above


def share_to_keep(weighed: DataFrame, labels: DataFrame, *, id_col: str, quality_col: str, loss: float) -> float:
    """The share of documents at or above a cut that all but `loss` of the labelled good documents reach.

    The cut is fitted on all labelled good documents that the target model has not seen; the
    share counts all documents. Without such documents everything is kept.
    """
    good = labels.where((F.col(quality_col) == 1) & held_back(id_col)).select(id_col)
    known = weighed.select(id_col, "log_weight").join(good, id_col, "left_semi").select("log_weight")
    cut = quantile(store(known, "known"), "log_weight", loss)
    if cut is None:
        return 1.0
    counted = weighed.agg(F.avg((F.col("log_weight") >= cut).cast("int")).alias("share")).collect()[0]["share"]
    return 1.0 if counted is None else float(counted)


def resample(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality",
    share: float | None = None, per_ngram: bool = True, temperature: float | None = None, loss: float = LOSS, seed: int = 0,
) -> DataFrame:
    """All columns of `docs`, then log_weight, n_ngrams, sample_key and selected.

    `labels` names good documents (quality 1); ids without a row or with a null are not used.
    The round(share * rows) rows with the largest sample_key are selected, with all that tie
    with the last; `share` None takes share_to_keep's. The weight is the mean over the n-grams,
    or with `per_ngram` False their sum; `temperature` None is the constant for either. Null, empty and wordless texts have
    weight 0, as much as the raw corpus. Equal rows have equal keys. Columns of `docs` with the
    names of the new ones are replaced; an empty table gives no rows.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(quality_col).isNotNull())
    good = known.where((F.col(quality_col) == 1) & ~held_back(id_col))
    ratios = fit(docs, good, id_col=id_col, text_col=text_col)
    rows = docs.drop("log_weight", "n_ngrams", "sample_key", "selected")
    noise = gumbel(id_col, text_col, F.lit(seed))
    weighed = weigh(rows, ratios, text_col=text_col, per_ngram=per_ngram)
    temperature = temperature or (MEAN_TEMPERATURE if per_ngram else TEMPERATURE)
    weighed = store(weighed.withColumn("sample_key", F.col("log_weight") / temperature + noise), "weighed")
    if share is None:
        share = share_to_keep(weighed, known, id_col=id_col, quality_col=quality_col, loss=loss)
    last = kth_largest(weighed, "sample_key", round(share * weighed.count()))
    limit = F.lit(float("inf") if last is None else last)
    return weighed.withColumn("selected", F.col("sample_key") >= limit)
