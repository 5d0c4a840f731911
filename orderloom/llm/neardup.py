"""Near-duplicates of documents by b-bit MinHash, confirmed on full shingle sets.

1. A task turns each text into its set of shingle hashes, takes the minima under many hash
   functions, hashes them by bands into buckets, and packs the low bits of the minima.
2. Documents with one and the same set are one class; only its smallest id goes on.
3. Buckets with several classes give candidates. First a bucket's pivot is tested against all
   other members: the pivot is the member that shares most buckets with others, so of a group
   of copies most likely their common source. Pairs whose packed bits agree too rarely for the
   wanted similarity, corrected for chance, fall out; the rest is compared set against set.
4. Linked classes are joined into components. In some more rounds each bucket's members
   outside its largest component are tested against one member of that component, another in
   each bucket and round; so a large group of copies comes together at a cost in proportion
   to its rows. What then still lies outside meets the members of other components by its
   rarest shingles (the prefix filter of set similarity joins, which is exact). In the end
   every pair of a bucket lies in one component, has been tested or has too few shingles in
   common: no link between members of a bucket is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, expand, joined_words, store

BANDS, ROWS = 32, 5
LOW_BITS = 4
WORDS = BANDS * ROWS * LOW_BITS // 64  # 64-bit words of a packed signature
# A pair whose estimate lies this much below the wanted similarity is not compared: with 160
# minima an estimate's standard deviation is below 0.04.
SLACK = 0.2
SHINGLE_WORDS = 5
PERCENT = 80
SIZE_STEP = 1.05  # sizes of one class differ by this factor at most
_SEEDS = np.array([xxhash.xxh3_64_intdigest(b"minimum", seed) for seed in range(BANDS * ROWS)], np.uint64)
_FACTORS = np.array([xxhash.xxh3_64_intdigest(b"factor", seed) | 1 for seed in range(BANDS * ROWS)], np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the first word of each text (and the end).

    Words are runs of bytes other than the blank and the controls from tab to return.
    """
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    new = np.ones(len(data), bool)
    new[1:] = gap[1:] != gap[:-1]
    new[firsts[:-1][sizes > 0]] = True
    starts = np.flatnonzero(new)
    numbers, pieces = joined_words(data.tobytes(), starts)
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(piece) for piece in pieces), np.uint64, len(pieces))
    words = ~gap[starts]
    return hashed[numbers[words]], np.searchsorted(starts[words], firsts)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a text with fewer words is one shingle, without words none."""
    words, firsts = word_hashes(texts)
    rolled = np.zeros(len(words), np.uint64)
    for k in range(size):
        moved = np.concatenate([words[k:], np.zeros(min(k, len(words)), np.uint64)])[: len(words)]
        rolled = (rolled ^ moved) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
    found = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(rolled[a : b - size + 1])
            found.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(words[a:b].tobytes(), b - a)
            found.append(np.array([whole], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum of each hash function over each set; a row a set, none of them empty."""
    values = np.concatenate(sets)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    starts = np.cumsum(sizes) - sizes
    found = np.empty((len(sets), len(_SEEDS)), np.uint64)
    for k, (seed, factor) in enumerate(zip(_SEEDS, _FACTORS, strict=True)):
        mixed = (values ^ seed) * factor
        found[:, k] = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(32)), starts)
    return found


def band_keys(minimum: np.ndarray) -> np.ndarray:
    """A bucket key for each band, of all its minima and its number."""
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(minimum), BANDS)).copy()
    parts = minimum.reshape(len(minimum), BANDS, ROWS)
    for k in range(ROWS):
        keys = (keys ^ parts[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys.view(np.int64)


def packed_bits(minimum: np.ndarray) -> np.ndarray:
    """The low bits of all minima, sixteen to a 64-bit word."""
    low = (minimum & np.uint64((1 << LOW_BITS) - 1)).reshape(len(minimum), WORDS, 64 // LOW_BITS)
    shifts = (np.arange(64 // LOW_BITS) * LOW_BITS).astype(np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=2).view(np.int64)


def estimate(a: str, b: str) -> Column:
    """Similarity estimated from two packed signatures, corrected for low bits that agree by chance."""
    differ = f"zip_with({a}, {b}, (x, y) -> x ^ y)"
    spread = " | ".join(f"shiftrightunsigned(x, {k})" for k in range(LOW_BITS))
    ones = int("1" * (64 // LOW_BITS), 2 ** 4)
    count = f"aggregate({differ}, 0, (n, x) -> n + cast(bit_count(({spread}) & {ones}L) as int))"
    chance = 1 / (1 << LOW_BITS)
    return (1 - F.expr(count) / (BANDS * ROWS) - chance) / (1 - chance)


SIGNED = "doc_id bigint, n_shingles bigint, set_key binary, bands array<bigint>, bits array<bigint>"


def signatures(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Size and digest of each text's shingle set, its bucket keys and packed bits; null where it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = shingle_sets([(value or "").encode() for value in batch["text"].to_pylist()], shingle_words)
            full = [k for k, own in enumerate(sets) if len(own)]
            keys: list = [None] * len(sets)
            bands: list = [None] * len(sets)
            bits: list = [None] * len(sets)
            if full:
                least = minima([sets[k] for k in full])
                for k, band, packed in zip(full, band_keys(least), packed_bits(least), strict=True):
                    keys[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest()
                    bands[k], bits[k] = band, packed
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(map(len, sets), pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "set_key", "bands", "bits"],
            )

    return docs.mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, shingle_words: int) -> DataFrame:
    """Full shingle sets, as arrays of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            sets = shingle_sets([(value or "").encode() for value in batch["text"].to_pylist()], shingle_words)
            ends = np.cumsum([0, *map(len, sets)])
            values = pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64))
            shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], shingles], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets overlap enough."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.where(100 * common >= percent * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """doc_id and component (its smallest id) of all documents with a link.

    Every document takes the smallest label among itself, its neighbours and its label's own
    label, until nothing changes. Links to a hot document are added up before they move.
    """
    edges = store(links.selectExpr("a AS x", "b AS y").unionAll(links.selectExpr("b AS x", "a AS y")), "edges")
    labels = edges.groupBy(F.col("x").alias("doc_id")).agg(F.min("y").alias("m")).selectExpr("doc_id", "least(doc_id, m) AS component")
    labels = store(labels, "labels")
    while True:
        near = edges.join(labels, edges.y == labels.doc_id).groupBy("x").agg(F.min("component").alias("near"))
        own = labels.alias("l").join(near.alias("n"), F.col("l.doc_id") == F.col("n.x"), "left").select(
            "l.doc_id", F.col("l.component").alias("old"), F.least("l.component", F.coalesce("n.near", "l.component")).alias("new")
        )
        up = labels.select(F.col("doc_id").alias("of"), F.col("component").alias("further"))
        jumped = own.join(up, own.new == up.of, "left").select(
            "doc_id", "old", F.least("new", F.coalesce("further", "new")).alias("component")
        )
        jumped = store(jumped, "labels")
        labels = jumped.select("doc_id", "component")
        if not jumped.where("old <> component").limit(1).count():
            return labels


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    linear_rounds: int = 4,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept.

    Documents are linked where 100 * common shingles >= percent * shingles of either. A null
    or empty text, or one without words, has no shingles and is linked with nothing; a text
    with fewer words than a shingle is one shingle. Rows with equal ids count as one class and
    each give a row. Other columns are ignored; an empty table gives no rows. Long texts are
    used whole. A null id is linked with nothing and kept; two different texts should not share
    an id, and if they do, their links count for both.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = store(signatures(rows, shingle_words), "signatures")
    classes = signed.where("set_key IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("head"))
    classes = store(classes, "classes")
    heads = signed.join(classes.select(F.col("head").alias("doc_id"), "set_key"), ["doc_id", "set_key"]).dropDuplicates(["set_key"])
    heads = store(heads.select("doc_id", "bands", "bits"), "heads")

    posted = heads.select("doc_id", F.explode("bands").alias("bucket"))
    shared = posted.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    crowded = store(posted.join(shared, "bucket"), "buckets")
    weights = crowded.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    crowded = store(crowded.select("bucket", "doc_id").join(weights, "doc_id"), "weighted")
    wanted = rows.join(crowded.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = store(sets_of(wanted, shingle_words).dropDuplicates(["doc_id"]), "sets")

    bits = heads.select("doc_id", "bits")
    labels = store(weights.select("doc_id", F.col("doc_id").alias("component")), "labels")
    open_buckets = crowded.withColumn("component", F.col("doc_id"))
    tested: DataFrame | None = None
    for number in range(linear_rounds + 2):
        if not number:
            pairs = _heaviest_pairs(open_buckets)
        elif number <= linear_rounds:
            pairs = _picked_pairs(open_buckets, number)
        else:
            pairs = _rest_pairs(open_buckets, sets, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        tested = pairs if tested is None else tested.unionAll(pairs)
        near = pairs.join(bits.withColumnsRenamed({"doc_id": "a", "bits": "bits_a"}), "a")
        near = near.join(bits.withColumnsRenamed({"doc_id": "b", "bits": "bits_b"}), "b")
        near = near.where(_alike("bits_a", "bits_b", percent)).select("a", "b")
        labels = joined_up(labels, store(confirmed(near, sets, percent), "links"))
        labelled = crowded.join(labels, "doc_id")
        mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        mixed = mixed.where("low < high").select("bucket")
        open_buckets = store(labelled.join(mixed, "bucket"), "open")

    own = classes.join(labels.select(F.col("doc_id").alias("head"), "component"), "head", "left")
    own = own.select("set_key", F.coalesce("component", "head").alias("component"))
    result = signed.select("doc_id", "n_shingles", "set_key").join(own, "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")).distinct()


def _heaviest_pairs(members: DataFrame) -> DataFrame:
    """Each bucket's member that shares most buckets, with all others of the bucket."""
    most = members.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("id"))).alias("most"))
    most = most.select("bucket", (-F.col("most.id")).alias("pivot"))
    return _pairs(members.join(most, "bucket").where("doc_id <> pivot"))


def _main(members: DataFrame, number: int) -> DataFrame:
    """Each bucket's largest component and one of its members, by a hash of bucket and number."""
    pick = F.struct(F.xxhash64("doc_id", "bucket", F.lit(number)).alias("hash"), "doc_id")
    each = members.groupBy("bucket", "component").agg(F.count("*").alias("size"), F.min(pick).alias("pick"))
    most = each.groupBy("bucket").agg(F.max(F.struct("size", "component", "pick")).alias("most"))
    return most.select("bucket", F.col("most.component").alias("main"), F.col("most.pick.doc_id").alias("pivot"))


def _picked_pairs(members: DataFrame, number: int) -> DataFrame:
    """One member of each bucket's largest component with all members of the other components."""
    return _pairs(members.join(_main(members, number), "bucket").where("component <> main"))


def _outside(members: DataFrame) -> DataFrame:
    return members.join(_main(members, 0), "bucket").where("component <> main").drop("main", "pivot")


def _rest_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of the buckets' members outside their largest component with members of other components.

    Shingles are ordered by how many of these members have them. Sets of n and m shingles are
    alike enough only with `need` = percent * (n + m) / (100 + percent) in common, so the first
    common one is among the first n - need + 1 and m - need + 1, and what follows it in either
    set must still suffice. Sets meet by shingle and by the classes of both sizes.
    """
    apart = _outside(members).select("doc_id", F.lit(True).alias("apart")).distinct()
    docs = members.select("doc_id", "component").distinct().join(apart, "doc_id", "left")
    shingles = docs.join(sets, "doc_id").select(
        "doc_id", "component", "apart", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("shingle")
    )
    shingles = store(shingles, "shingles")
    holders = shingles.groupBy("shingle").agg(F.count("*").alias("holders"))
    rare = Window.partitionBy("doc_id").orderBy("holders", "shingle")
    placed = shingles.join(holders, "shingle").withColumn("place", F.row_number().over(rare)).where("holders > 1")
    placed = placed.withColumn("own", _size_class(F.col("n")))
    low, high = F.col("n") * percent / 100, F.col("n") * 100 / percent
    placed = placed.withColumn("other", F.explode(F.sequence(_size_class(low), _size_class(high))))
    least = F.floor(F.pow(F.lit(SIZE_STEP), F.col("other")) * (1 - 1e-9))  # no set of that class is smaller
    posted = store(placed.where((100 + percent) * (F.col("n") - F.col("place") + 1) >= percent * (F.col("n") + least)), "posted")
    x = posted.where("apart").select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("doc_id", "component", "n", "place", "own", "other")))
    y = posted.select("shingle", *(F.col(c).alias(f"y_{c}") for c in ("doc_id", "component", "n", "place", "own", "other")))
    enough = F.expr(f"{100 + percent} * (1 + least(x_n - x_place, y_n - y_place)) >= {percent} * (x_n + y_n)")
    classes = (F.col("x_own") == F.col("y_other")) & (F.col("x_other") == F.col("y_own"))
    met = x.join(y, (x.shingle == y.shingle) & classes & (F.col("x_component") != F.col("y_component")) & enough)
    return _pairs(met.select(F.col("x_doc_id").alias("pivot"), F.col("y_doc_id").alias("doc_id")))


def _size_class(size: Column) -> Column:
    return F.floor(F.log(size) / F.log(F.lit(SIZE_STEP)) + 1e-9)


def _alike(a: str, b: str, percent: int) -> Column:
    return estimate(a, b) >= percent / 100 - SLACK


def joined_up(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (doc_id, component) after linked components have become one."""
    a = labels.select(F.col("doc_id").alias("a"), F.col("component").alias("x"))
    b = labels.select(F.col("doc_id").alias("b"), F.col("component").alias("y"))
    between = links.join(a, "a").join(b, "b").where("x <> y")
    between = between.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    merged = components(between).select(F.col("doc_id").alias("component"), F.col("component").alias("into"))
    moved = labels.join(merged, "component", "left")
    return store(moved.select("doc_id", F.coalesce("into", "component").alias("component")), "labels")
