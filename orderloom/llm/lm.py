"""Documents scored by masked pseudo-likelihood.

A token is a character: one of the corpus's most frequent code points, or the mark for all
others. A small network sees SIDE tokens on each side of a masked one and says how likely each
token is there; the logarithms for all tokens of a text are summed. Where the token is the mark,
the code point's share among all the marked ones of the corpus comes on top, so every code point
has a probability and a text in a rare script is not taken for a run of one token.

Code points are counted over all documents, and every position of every document is a training
window. Equal windows are added up and weigh as much as they occur; a frequent one is cut into
several pieces of about the mean weight, so there are at most about twice as many pieces as
distinct windows. Pieces are dealt out evenly to copies of the network, as many as they need; in
each round every copy is trained in a task and Spark averages the copies. Which copy gets a piece, and in which order,
hangs on the windows alone, and the mean is a sum of whole numbers: the same corpus gives the
same scores whatever its partitions. When texts are scored, each distinct window of a batch goes
through the network once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, code_points, store, texts_of

SIDE = 2
WIDTH = 2 * SIDE + 1
TOKENS = 96  # 0: outside the text, 1: any other character
HIDDEN = 32
EVERY = 1  # one position in so many is a training window: all of them
ROUNDS = 3
BATCH = 2048
STEP = 0.01
PER_COPY = 1 << 17  # pieces of windows that one copy of the network is trained on in a round
HELD = 1 << 20  # distinct windows that a task adds up before it sends them on
FINE = 1 << 24  # parameters are averaged in steps of one over this
CODES = 0x110000  # code points of Unicode

Network = dict[str, np.ndarray]


def fresh_network(seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    return {
        "tables": rng.normal(0, 0.3, (2 * SIDE, TOKENS, HIDDEN)).astype(np.float32),
        "bias": np.zeros(HIDDEN, np.float32),
        "out": rng.normal(0, 0.1, (HIDDEN, TOKENS)).astype(np.float32),
        "out_bias": np.zeros(TOKENS, np.float32),
    }


def _flat(network: Network) -> np.ndarray:
    return np.concatenate([value.ravel() for value in network.values()])


def _shaped(flat: np.ndarray) -> Network:
    found, at = {}, 0
    for name, value in fresh_network().items():
        found[name] = flat[at : at + value.size].reshape(value.shape).astype(np.float32)
        at += value.size
    return found


def split_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Context and middle token of windows, a row a window."""
    return np.delete(windows, SIDE, axis=1), windows[:, SIDE]


def hidden_layer(network: Network, context: np.ndarray) -> np.ndarray:
    total = network["bias"] + network["tables"][0][context[:, 0]]
    for k in range(1, 2 * SIDE):
        total += network["tables"][k][context[:, k]]
    return np.maximum(total, 0)


def log_probabilities(network: Network, windows: np.ndarray, block: int = 16_384) -> np.ndarray:
    """Log-probability of the middle token of each window.

    In double precision, so that what else stands in a block moves it far less than `score` rounds.
    """
    found = np.empty(len(windows))
    out, out_bias = network["out"].astype(np.float64), network["out_bias"].astype(np.float64)
    for begin in range(0, len(windows), block):
        context, middle = split_windows(windows[begin : begin + block])
        scores = hidden_layer(network, context).astype(np.float64) @ out + out_bias
        scores[:, 0] = -np.inf  # nothing inside a text is outside
        top = scores.max(axis=1, keepdims=True)
        norm = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
        found[begin : begin + block] = scores[np.arange(len(middle)), middle] - norm
    return found


def train(network: Network, batches: Iterator[tuple[np.ndarray, np.ndarray]], step: float = STEP) -> Network:
    """Adam over batches of windows with their weights; the trained copy."""
    network = {name: value.copy() for name, value in network.items()}
    first = {name: np.zeros_like(value) for name, value in network.items()}
    second = {name: np.zeros_like(value) for name, value in network.items()}
    eye = np.eye(TOKENS, dtype=np.float32)
    steps = 0
    for windows, weights in batches:
        context, middle = split_windows(windows)
        hidden = hidden_layer(network, context)
        scores = hidden @ network["out"] + network["out_bias"]
        scores[:, 0] = -1e30
        chances = np.exp(scores - scores.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        wrong = (chances - eye[middle]) * (weights / weights.sum()).astype(np.float32)[:, None]
        back = (wrong @ network["out"].T) * (hidden > 0)
        slopes = {
            "tables": np.stack([eye[context[:, k]].T @ back for k in range(2 * SIDE)]),
            "bias": back.sum(axis=0),
            "out": hidden.T @ wrong,
            "out_bias": wrong.sum(axis=0),
        }
        steps += 1
        for name, slope in slopes.items():
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            move = first[name] / (1 - 0.9**steps) / (np.sqrt(second[name] / (1 - 0.99**steps)) + 1e-8)
            network[name] -= np.float32(step) * move.astype(np.float32)
    return network


def fit_alphabet(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All code points of all texts and how often each occurs, most frequent first, of equal ones the lower.

    The driver gets a row a code point, at most CODES. The first TOKENS - 2 are tokens of their own.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES, np.int64)
        for batch in chunks(batches, "text"):
            total += np.bincount(code_points("".join(texts_of(batch["text"]))), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], ["code", "times"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "code int, times bigint")
    found = counted.groupBy("code").agg(F.sum("times").alias("times")).toArrow()
    codes, times = (found[name].to_numpy().astype(np.int64) for name in ("code", "times"))
    order = np.lexsort((codes, -times))
    return codes[order], times[order]


def token_table(codes: np.ndarray) -> np.ndarray:
    """The token of every code point."""
    own = codes[: TOKENS - 2]
    table = np.ones(CODES, np.uint8)
    table[own] = np.arange(len(own)) + 2
    return table


def shares_among_others(codes: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Logarithm of every code point's share among those without a token of their own; 0 for the others.

    Code points that the corpus lacks share one occurrence.
    """
    others = times[TOKENS - 2 :]
    total = others.sum() + 1
    found = np.full(CODES, -np.log(total) - np.log(max(1, CODES - len(codes))))
    found[codes[TOKENS - 2 :]] = np.log(others / total)
    found[codes[: TOKENS - 2]] = 0
    return found


def _laid_out(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points and tokens of all texts with SIDE zeros before, between and after them; where texts begin; lengths."""
    gap = "\0" * SIDE
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths + SIDE) - lengths
    codes = code_points(gap + gap.join(texts) + gap)
    tokens = table[codes]
    tokens[(starts[:, None] - np.arange(1, SIDE + 1)).ravel()] = 0
    tokens[-SIDE:] = 0
    return codes, tokens, starts, lengths


def _coded(tokens: np.ndarray, places: np.ndarray | slice) -> np.ndarray:
    """The windows around places, each as one number."""
    inside = len(tokens) - 2 * SIDE
    coded = np.zeros(len(tokens[SIDE : SIDE + inside][places]), np.int64)
    for k in range(WIDTH):
        coded = coded * TOKENS + tokens[k : k + inside][places]
    return coded


def _decoded(coded: np.ndarray) -> np.ndarray:
    """The windows, a row each."""
    return np.stack([coded // TOKENS ** (WIDTH - 1 - k) % TOKENS for k in range(WIDTH)], axis=1)


def _added_up(parts: list[pa.Table]) -> pa.Table:
    """window and times, a row a window."""
    summed = pa.concat_tables(parts).group_by("window", use_threads=False).aggregate([("times", "sum")])
    return pa.table([summed["window"], summed["times_sum"]], ["window", "times"])


def training_windows(docs: DataFrame, table: np.ndarray, *, text_col: str = "text", every: int = EVERY) -> DataFrame:
    """The windows around all positions of the whole corpus, or one in `every`; equal ones added up and stored: window, times."""
    rows = docs.select(F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chunks(batches, "text"):
            _, tokens, starts, lengths = _laid_out(texts_of(batch["text"]), sent.value)
            # A text's first position hangs on its hash, so short texts have their share too.
            first = (batch["key"].to_numpy().view(np.uint64) % np.uint64(every)).astype(np.int64)
            counts = np.maximum(0, -(-(lengths - first) // every))
            rank = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            places = np.repeat(starts + first, counts) + rank * every
            counted = pa.array(_coded(tokens, places - SIDE)).value_counts()
            held.append(pa.table([counted.field("values"), counted.field("counts")], ["window", "times"]))
            size += len(counted)
            if size > HELD:
                held = [_added_up(held)]
                size = len(held[0])
                if size > HELD // 2:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from _added_up(held).to_batches()

    found = rows.mapInArrow(pick, "window bigint, times bigint")
    return store(found.groupBy("window").agg(F.sum("times").alias("times")), "windows")


def dealt(windows: DataFrame, copies: int) -> DataFrame:
    """copy, window and times, then any other columns: each window's times spread over the copies, as evenly as whole numbers go.

    A window seen once goes to the copy its hash names, a frequent one to all of them, so no
    copy gets more than its share of a hot one.
    """
    others = [name for name in windows.columns if name not in ("window", "times")]
    step = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("times", F.lit(copies)) - 1))
    spread = windows.select("window", "times", *others, step.alias("step"))
    extra = (F.col("step") < F.col("times") % copies).cast("bigint")
    return spread.select(
        F.pmod(F.pmod(F.xxhash64("window"), F.lit(copies)) + F.col("step"), F.lit(copies)).alias("copy"),
        "window",
        (F.floor(F.col("times") / copies) + extra).alias("times"),
        *others,
    )


def in_pieces(windows: DataFrame, unit: int) -> DataFrame:
    """window, times and weight: the number of pieces of at most `unit` occurrences, and what each of them weighs, in units."""
    pieces = F.ceil(F.col("times") / unit)
    return windows.select("window", pieces.alias("times"), (F.col("times") / (pieces * unit)).alias("weight"))


def trained_copies(shares: DataFrame, flat: np.ndarray, number: int) -> DataFrame:
    """Every copy of the network after a round on its share: a row a parameter, times the weight it has seen, in units."""
    sent = shares.sparkSession.sparkContext.broadcast(flat)

    def run(share: pa.Table) -> pa.Table:
        found, times = share["window"].to_numpy(), share["times"].to_numpy()
        order = np.argsort(found)
        mixed = np.random.default_rng(number).permutation(np.repeat(order, times[order]))
        weights = share["weight"].to_numpy()
        parts = (mixed[begin : begin + BATCH] for begin in range(0, len(mixed), BATCH))
        trained = train(_shaped(sent.value), ((_decoded(found[part]), weights[part]) for part in parts), STEP / (1 + number))
        seen = max(1, round(float(weights[mixed].sum())))
        values = np.rint(_flat(trained).astype(np.float64) * FINE).astype(np.int64) * seen
        return pa.table({"place": pa.array(np.arange(len(values)), pa.int32()), "value": values, "seen": np.full(len(values), seen)})

    return shares.groupBy("copy").applyInArrow(run, "place int, value bigint, seen bigint")


def fit_network(windows: DataFrame, *, rounds: int = ROUNDS, seed: int = 0, per_copy: int = PER_COPY) -> Network:
    """Rounds of training copies of the network on all windows, each on about `per_copy` pieces, and averaging them by the weight seen.

    A copy goes out as one row a parameter and the mean is a grouped sum of whole numbers, so the
    driver gets one row a parameter, however many copies there are. Without windows the network stays fresh.
    """
    flat = _flat(fresh_network(seed))
    total, distinct = windows.agg(F.sum("times"), F.count("*")).first()
    if not total:
        return _shaped(flat)
    pieces = in_pieces(windows, -(-total // max(distinct, PER_COPY)))
    shares = store(dealt(pieces, -(-pieces.agg(F.sum("times")).first()[0] // per_copy)), "shares")
    value = F.sum(F.col("value").cast("decimal(20,0)")).alias("value")
    for number in range(rounds):
        mean = trained_copies(shares, flat, number).groupBy("place").agg(value, F.sum("seen").alias("seen"))
        flat = np.zeros(len(flat), np.float32)
        for row in mean.collect():
            flat[row["place"]] = int(row["value"]) / row["seen"] / FINE
    return _shaped(flat)


def score(
    docs: DataFrame,
    alphabet: tuple[np.ndarray, np.ndarray],
    network: Network,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, log_prob (the sum over all tokens) and mean_log_prob, a row per row.

    `alphabet` is what `fit_alphabet` gives. Null and empty texts have no tokens, log_prob 0 and a
    null mean. Texts are used whole; equal texts get equal scores; a row without id is scored as any
    other. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast((*alphabet, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times, trained = sent.value
        table = token_table(codes)
        # Whole numbers, so that a text's sum does not hang on what stands before it in the batch.
        among = np.round(shares_among_others(codes, times) * 2**20).astype(np.int64)
        for batch in chunks(batches, "text"):
            points, tokens, starts, lengths = _laid_out(texts_of(batch["text"]), table)
            known = pa.array(_coded(tokens, slice(None))).dictionary_encode()
            windows = _decoded(known.dictionary.to_numpy())
            real = windows[:, SIDE] > 0
            values = np.zeros(len(windows))
            values[real] = log_probabilities(trained, windows[real])
            parts = np.round(values * 2**20).astype(np.int64)[known.indices.to_numpy()]
            parts += among[points[SIDE : len(points) - SIDE]]
            running = np.concatenate([[0], np.cumsum(parts)])
            sums = (running[starts - SIDE + lengths] - running[starts - SIDE]) / 2**20
            mean = pa.array(sums / np.maximum(lengths, 1), pa.float64(), mask=lengths == 0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(lengths), pa.array(sums), mean], ["doc_id", "n_tokens", "log_prob", "mean_log_prob"]
            )

    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, log_prob double, mean_log_prob double")


def train_and_score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count code points and fit the network on the whole corpus and score every document of it."""
    alphabet = fit_alphabet(docs, text_col)
    windows = training_windows(docs, token_table(alphabet[0]), text_col=text_col)
    return score(docs, alphabet, fit_network(windows), id_col=id_col, text_col=text_col)
