"""Spelling variants: words one edit apart, and the frequent word a rare one stands for.

The vocabulary is cut into blocks. Two words one edit apart share the first half of the
shorter one's length, or else that many code points less at the end; so each word is put
under both halves, once for a partner of its own length or longer and once for a shorter one.
What lies between the shared ends, the middle, is all that can differ within a block.

Each block is the sorted list of its middles. An edit matrix of a list entry against a query
word needs, for at most one edit, a band of three cells a row; the row of depth d depends on
the entry's first d code points alone. The common prefixes of neighbours (LCPs) tell where
ranges of entries with the same first d code points begin: their row is computed once and
serves the whole range, and a range whose row holds no value below two is skipped with all its
entries. numpy walks the depths for the queries of many blocks at once.

A block of more than LIMIT code points is cut again: its middle is halved like the words were,
down to middles of one code point, of which an alphabet allows few.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, expand, store

LEAST = 7  # code points of the shortest word
OCCURRENCES = 2
RATIO = 10  # a form occurs at least this many times as often as its variant
LIMIT = 1 << 22  # code points of middles in a block that one task holds
TEXT_BYTES = 2 << 20
HELD_WORDS = 200_000  # distinct words that a task counts before it passes them on
HELD_ROWS = 1 << 16
HELD_PAIRS = 1 << 20
DEAD = 2  # any number of edits above one


def count_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    occurrences: int = OCCURRENCES,
    slip_every: int | None = None,
) -> DataFrame:
    """word, n: runs of Latin letters of whole texts with A-Z lower-cased, and how often they occur.

    With `slip_every`, a run whose crc32 of "<id>:<run>" that number divides loses one code
    point: a reproducible slip of the pen. A null id makes no slips; a null or empty text has
    no words; repeated rows count each time. Other columns are ignored.
    """
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def of_text(doc: int | None, text: str, held: Counter) -> None:
        found = Counter(runs.findall(text.encode().lower().decode()))
        if doc is None or not slip_every:
            held.update(found)
            return
        before = zlib.crc32(f"{doc}:".encode())
        for word, times in found.items():
            mark = zlib.crc32(word.encode(), before)
            if mark % slip_every == 0:
                place = mark % len(word)
                word = word[:place] + word[place + 1 :]
                if len(word) < least:
                    continue
            held[word] += times

    def rows(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in chunks(batches, "text", TEXT_BYTES):
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if text:
                    of_text(doc, text, held)
            if len(held) > HELD_WORDS:
                yield rows(held)
                held.clear()
        yield rows(held)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    counted = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= occurrences)


# -- blocks -------------------------------------------------------------------------------

# A block: pairs whose shorter word has `size` code points, that share the first `head` and the
# last `tail` code points, and (where `apart` is not 0) do not share the first `apart`.
PLACE = ["size", "head", "tail", "apart"]
KEY = [*PLACE, "first", "last"]


def _halved(words: DataFrame) -> DataFrame:
    """Both blocks below each place: one shares half of the middle in front, the other its rest behind."""
    middle = F.col("size") - F.col("head") - F.col("tail")
    half = F.ceil(middle / 2).cast("int")
    front = [F.col("size"), F.col("head") + half, F.col("tail"), F.col("apart")]
    behind = [F.col("size"), F.col("head"), F.col("tail") + middle - half, F.col("head") + half]

    def place(columns: list[Column]) -> Column:
        return F.struct(*[column.cast("int").alias(name) for column, name in zip(columns, PLACE, strict=True)])

    placed = words.withColumn("place", F.explode(F.array(place(front), place(behind))))
    placed = placed.select("word", "n", "place.*")
    return placed.select(
        "word", "n", *PLACE,
        F.substring("word", F.lit(1), F.col("head")).alias("first"),
        F.substring("word", F.length("word") - F.col("tail") + 1, F.col("tail")).alias("last"),
    )


def _blocks(words: DataFrame, least: int, limit: int) -> DataFrame:
    """Each word under every block it belongs to; no block's middles exceed `limit` while they can be cut."""
    sizes = F.array(F.length("word"), F.length("word") - 1)
    sized = words.select("word", "n", F.explode(sizes).alias("size")).where(F.col("size") >= least)
    open_rows = _halved(sized.withColumns({name: F.lit(0) for name in PLACE[1:]}))
    settled = None
    while True:
        middle = F.col("size") - F.col("head") - F.col("tail")
        large = open_rows.groupBy(*KEY).agg(F.sum(middle).alias("points"))
        # So many are at most the code points of all middles divided by the limit.
        large = store(large.where((F.col("points") > limit) & (middle > 1)).select(*KEY), "large")
        if large.isEmpty():
            return open_rows if settled is None else settled.unionByName(open_rows)
        small = open_rows.join(F.broadcast(large), KEY, "left_anti").select(*open_rows.columns)
        settled = small if settled is None else settled.unionByName(small)
        cut = open_rows.join(F.broadcast(large), KEY, "left_semi")
        open_rows = store(_halved(cut.select("word", "n", *PLACE)), "cut")


# -- the scan -----------------------------------------------------------------------------


def near_pairs(middles: list[str], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of at most one edit within blocks; `first` holds the place where each entry's block begins.

    Entries of a block stand together, sorted and distinct, and their lengths differ by one at
    most. The first of a pair is the earlier. Memory is bounded by HELD_PAIRS rows of bands a depth.
    """
    text = np.frombuffer(("\0\0".join(middles) + "\0\0").encode("latin-1"), np.uint8)
    length = np.fromiter(map(len, middles), np.int64, len(middles))
    start = np.cumsum(length + 2) - (length + 2)
    shared = _common_prefixes(text, start, first)
    query = np.flatnonzero(first < np.arange(len(first)))
    work = [(0, first[query], query, query, *_row_zero(len(query)))]
    heads: dict[int, np.ndarray] = {}
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while work:
        depth, low, high, query, below, level, above = work.pop()
        if depth not in heads:
            heads[depth] = np.flatnonzero(shared <= depth)
        begins = heads[depth]
        at = np.searchsorted(begins, low)
        ranges = np.searchsorted(begins, high) - at
        if ranges.sum() > HELD_PAIRS and len(query) > 1:
            half = len(query) // 2
            for part in (slice(0, half), slice(half, None)):
                work.append((depth, *(values[part] for values in (low, high, query, below, level, above))))
            continue
        mine = np.repeat(np.arange(len(query)), ranges)
        at = expand(np.arange(len(begins)), at, ranges)
        entry = begins[at]
        end = np.minimum(np.append(begins, len(first))[at + 1], high[mine])
        query = query[mine]
        char, place = text[start[entry] + depth], start[query] + depth
        below = np.minimum(below[mine] + (text[place - 1] != char), level[mine] + 1)
        level = np.minimum(level[mine] + (text[place] != char), np.minimum(above[mine], below) + 1)
        above = np.minimum(above[mine] + (text[place + 1] != char), level + 1)
        done = length[entry] == depth + 1
        longer = length[query] - depth - 1
        edits = np.where(longer == 0, level, np.where(longer < 0, below, above))
        near = done & (edits < DEAD)
        found.append((entry[near], query[near]))
        alive = (np.minimum(np.minimum(below, level), above) < DEAD) & (char > 0) & ((end - entry > 1) | ~done)
        if alive.any():
            work.append((depth + 1, *(values[alive] for values in (entry, end, query, below, level, above))))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True)) if found else (query, query)


def _row_zero(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits between the empty prefix of an entry and a query's first -1, 0 and 1 code points."""
    return np.full(n, DEAD, np.int8), np.zeros(n, np.int8), np.ones(n, np.int8)


def _common_prefixes(text: np.ndarray, start: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each entry the code points it shares with the one before; -1 where a block begins."""
    places = np.arange(len(start))
    shared = np.where(first == places, -1, 0)
    active, depth = places[first < places], 0
    while len(active):
        char = text[start[active] + depth]
        active = active[(char == text[start[active - 1] + depth]) & (char > 0)]
        depth += 1
        shared[active] = depth
    return shared


def _same_front(text: list[str], pairs: tuple[np.ndarray, np.ndarray], width: np.ndarray) -> np.ndarray:
    a, b = (side.tolist() for side in pairs)
    return np.fromiter((text[x][:w] == text[y][:w] for x, y, w in zip(a, b, width[pairs[0]].tolist(), strict=True)), bool, len(a))


def _scan(rows: pa.Table) -> pa.RecordBatch:
    """For each word of whole blocks with a near word there: how many, and the one of largest n."""
    names = pc.run_end_encode(rows["key"].combine_chunks())
    ends = names.run_ends.to_numpy()
    sizes = np.diff(np.append(0, ends))
    kept = np.repeat(sizes > 1, sizes)
    rows = rows.filter(pa.array(kept))
    sizes = sizes[sizes > 1]
    if not len(sizes):
        return pa.RecordBatch.from_pylist([], schema=PARTIAL)
    words, middles = rows["word"].to_pylist(), rows["middle"].to_pylist()
    n = rows["n"].to_numpy()
    earlier, later = near_pairs(middles, np.repeat(np.cumsum(sizes) - sizes, sizes))
    points = rows["points"].to_numpy()
    length = np.fromiter(map(len, middles), np.int64, len(middles))
    # Two longer words are a pair of the next size; what shares its front is a pair of another block.
    own = np.minimum(length[earlier], length[later]) == points[earlier]
    apart = rows["front"].to_numpy()
    own &= ~((apart[earlier] > 0) & _same_front(middles, (earlier, later), apart))
    word, near = np.concatenate([earlier[own], later[own]]), np.concatenate([later[own], earlier[own]])
    by_name = {name: place for place, name in enumerate(sorted({words[k] for k in near.tolist()}))}
    place = np.fromiter((by_name[words[k]] for k in near.tolist()), np.int64, len(near))
    order = np.lexsort((place, -n[near], word))
    word, near = word[order], near[order]
    each, at, times = np.unique(word, return_index=True, return_counts=True)
    best = near[at]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([words[k] for k in each.tolist()], pa.string()),
            pa.array(n[each], pa.int64()),
            pa.array(times, pa.int64()),
            pa.array([words[k] for k in best.tolist()], pa.string()),
            pa.array(n[best], pa.int64()),
        ],
        schema=PARTIAL,
    )


PARTIAL = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())]
)
PARTIAL_DDL = "word string, n bigint, n_near bigint, near string, near_n bigint"


def _scan_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole blocks at a time; a block that goes on in the next batch waits for it."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count < HELD_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        last = table["key"][-1]
        whole = pc.index(table["key"], last).as_py()
        if whole:
            yield _scan(table.slice(0, whole))
        held = table.slice(whole).to_batches()
        count = table.num_rows - whole if whole else 0
    if held:
        yield _scan(pa.Table.from_batches(held))


def near_words(words: DataFrame, *, least: int = LEAST, limit: int = LIMIT) -> DataFrame:
    """word, n, n_near, near, near_n: of each word the number of words one edit apart and the most frequent.

    `words` holds distinct words of at least `least` Latin-1 code points and their n. Ties in n
    go to the smaller word in code-point order; a word without near words has 0 and nulls.
    """
    blocks = _blocks(words, least, limit)
    middle = F.col("size") - F.col("head") - F.col("tail")
    rows = blocks.select(
        F.concat_ws("/", *KEY).alias("key"),
        F.substring("word", F.col("head") + 1, F.length("word") - F.col("head") - F.col("tail")).alias("middle"),
        "word", "n", middle.alias("points"), F.greatest(F.col("apart") - F.col("head"), F.lit(0)).alias("front"),
    ).repartition("key").sortWithinPartitions("key", "middle")
    partial = rows.mapInArrow(_scan_blocks, PARTIAL_DDL)
    alone = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near"))))
    summed = alone.unionByName(partial).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("best")
    )
    return summed.select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def group_variants(words: DataFrame, *, least: int = LEAST, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary as count_words() gives it.

    `form` is the near word of largest n if that is at least `ratio` times the word's own, else
    null; `root` is where the forms end. n grows along forms, so they end, and the rounds
    grow with the logarithm of their number. Without words there are no rows.
    """
    words = store(words, "vocabulary")
    near = near_words(words, least=least, limit=limit)
    chosen = F.col("near_n") >= ratio * F.col("n")
    found = store(
        near.select(
            "word", F.when(chosen, F.col("near")).alias("form"), "n", "n_near", F.when(chosen, F.col("near_n")).alias("form_n")
        ),
        "near",
    )
    jumps = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        next_one = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = store(jumps.join(next_one, "root", "left").select("word", "root", "further"), "jumps")
        jumps = joined.select("word", F.coalesce("further", "root").alias("root"))
        if joined.where("further IS NOT NULL").isEmpty():
            break
    placed = found.join(jumps, "word", "left")
    return placed.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, **options) -> DataFrame:
    """group_variants() of the words of `docs`; options as for count_words()."""
    return group_variants(count_words(docs, **options), least=options.get("least", LEAST))
