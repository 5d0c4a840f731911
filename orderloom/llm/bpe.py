"""BPE by a walk over the trie of a batch's distinct words.

The encoding of a word ends with one certain token, and what stands before that token is the
encoding of a shorter prefix of the same word. So it is enough to know, for every prefix, its
last token. The distinct words, in byte order, are the depth-first walk over their trie: the
states of the path to the current node are kept on a stack, a word takes over those of the
prefix it shares with the word before, and only new nodes are worked out.

A token t may follow a prefix that ends with token s if BPE itself leaves s and t apart. That
is found from the merges that build the right edge of s and the left edge of t: in order of
rank, no merge across the border may come first. It is remembered per pair.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import chunks, texts_of
from orderloom.llm.tokens import BYTE_LEVEL, WordCache, encode_texts

NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte.

    Fixed rule: printable Latin-1 characters stand for themselves, the other bytes take the
    code points from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + k): byte for k, byte in enumerate(others)}


class Merges:
    """A byte-level vocabulary with its merges, and the encoder of distinct words."""

    def __init__(self, path: str, pair_limit: int = 1 << 20):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_letters()
        self.bytes_of = {number: bytes(letters[c] for c in token) for token, number in model["vocab"].items() if set(token) <= letters.keys()}
        self.ids = {value: number for number, value in self.bytes_of.items()}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = (model["vocab"][x] for x in (left, right, left + right))
            self.rank[a, b] = rank
            self.halves[whole] = (a, b, rank)
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pair_limit = pair_limit

    def edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces at one edge of a token (0 left, 1 right) from the byte up to the whole.

        Each with the rank of the merge that takes it into the next; the whole has none.
        """
        found = self.edges.get((token, side))
        if found is None:
            up, piece, found = NEVER, token, []
            while True:
                found.append((piece, up))
                if piece not in self.halves:
                    break
                up = self.halves[piece][2]
                piece = self.halves[piece][side]
            self.edges[token, side] = found = found[::-1]
        return found

    def apart(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens gives just these two."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= self.pair_limit:
                self.pairs.clear()
            self.pairs[left, right] = known = self._apart(left, right)
        return known

    def _apart(self, left: int, right: int) -> bool:
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        while True:
            (s, s_up), (t, t_up) = a[i], b[j]
            across = self.rank.get((s, t), NEVER)
            # Of equal merges the one further left comes first.
            if across < s_up and across <= t_up and across < NEVER:
                return False
            if s_up == t_up == NEVER:
                return True
            if s_up <= t_up:
                i += 1
            else:
                j += 1

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has."""
        spelled = [word.encode("utf-8", "surrogatepass") for word in words]
        order = sorted(range(len(spelled)), key=spelled.__getitem__)
        results: list[list[int]] = [[]] * len(spelled)
        ids, apart, pairs, longest = self.ids, self.apart, self.pairs, self.longest
        path, last, size = b"", [-1], [0]
        for number in order:
            word = spelled[number]
            shared, limit = 0, min(len(word), len(path))
            while shared < limit and word[shared] == path[shared]:
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = ids.get(word[start:end])
                    if token is None:
                        continue
                    before = last[start]
                    if not start:
                        # The whole prefix is one token, if its own halves are left to merge.
                        if self.whole(token):
                            break
                        continue
                    known = pairs.get((before, token))
                    if apart(before, token) if known is None else known:
                        break
                last.append(token)
                size.append(end - start)
            found, end = [], len(word)
            while end:
                found.append(last[end])
                end -= size[end]
            results[number] = found[::-1]
            path = word
        lengths = np.fromiter(map(len, results), np.int64, len(results))
        flat = np.fromiter((x for ids in results for x in ids), np.uint32, int(lengths.sum()))
        return flat, lengths

    def whole(self, token: int) -> bool:
        """Whether BPE over a token's bytes gives that token: its two halves would stay apart but for its merge."""
        if token not in self.halves:
            return True
        left, right, rank = self.halves[token]
        a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
        known = self.pairs.get((-1, token))
        if known is not None:
            return known
        good = self.whole(left) and self.whole(right)
        while good:
            (s, s_up), (t, t_up) = a[i], b[j]
            if s_up == t_up == NEVER:
                break
            across = self.rank.get((s, t), NEVER)
            if across < s_up and across <= t_up and across < NEVER:
                good = False
            elif s_up <= t_up:
                i += 1
            else:
                j += 1
        self.pairs[-1, token] = good
        return good


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def trie_words(path: str) -> WordCache:
    """The trie encoder, with the words that a Python worker met first remembered."""
    return WordCache(merges_of(path).encode_words)


@lru_cache(maxsize=2)
def decoder_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens in one array, with start and length by id; special strings are their own text."""
    from orderloom.llm.tokens import special_ids

    spelled = dict(merges_of(path).bytes_of)
    spelled |= {number: text.encode() for text, number in special_ids(path).items()}
    size = max(spelled) + 1
    lengths = np.array([len(spelled.get(k, b"")) for k in range(size)], np.int64)
    data = np.frombuffer(b"".join(spelled.get(k, b"") for k in range(size)), np.uint8)
    return data, np.cumsum(lengths) - lengths, lengths


def decode_ids(ids: np.ndarray, path: str) -> str:
    """The text of a list of ids; bytes that are not UTF-8 become replacement characters."""
    from orderloom.llm.common import expand

    data, starts, lengths = decoder_table(path)
    return expand(data, starts[ids], lengths[ids]).tobytes().decode("utf-8", "replace")


def encode_decode(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", keep: bool = True
) -> DataFrame:
    """Encode every whole text and decode the ids again: doc_id, n_tokens, ids, decoded, and their SHA-256.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows each give a row.
    Other columns are ignored; an empty table gives no rows. A long text is a chunk of its own.
    `keep` = False leaves `ids` and `decoded` null, for callers that need only the digests.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = trie_words(tokenizer)
        written = np.array([str(k) for k in range(len(decoder_table(tokenizer)[1]))], object)
        for batch in chunks(batches, "text"):
            ids, firsts = encode_texts(texts_of(batch["text"]), tokenizer, BYTE_LEVEL, encoder)
            digits = written[ids].tolist()
            found, decoded, digests, back = [], [], [], []
            for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                text = decode_ids(ids[a:b], tokenizer)
                digests.append(hashlib.sha256(",".join(digits[a:b]).encode()).hexdigest())
                back.append(hashlib.sha256(text.encode()).hexdigest())
                if keep:
                    found.append(ids[a:b])
                    decoded.append(text)
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_tokens": pa.array(np.diff(firsts), pa.int64()),
                    "ids": pa.array(found if keep else [None] * n, pa.list_(pa.int32())),
                    "decoded": pa.array(decoded if keep else [None] * n, pa.string()),
                    "ids_sha256": digests,
                    "decoded_sha256": back,
                }
            )

    schema = "doc_id bigint, n_tokens bigint, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema)
