"""Token ids of whole texts by a public tokenizer, with each distinct word of a batch encoded once.

The tokenizer cuts a text into words and encodes each by itself. Here numpy cuts a batch of
texts by the same rule, Arrow finds the distinct words, an encoder turns only these into ids,
and the ids are laid out again in text order.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

import regex

from orderloom.llm.common import byte_widths, code_points, expand, joined_words

END_ID = 2
BYTE_LEVEL, WORD_END = "byte-level", "word-end"
OTHER, LETTER, NUMBER, SPACE = range(4)
# The code points with Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# An encoder of distinct words: their ids one after the other, and how many each word has.
WordEncoder = Callable[[list[str]], tuple[np.ndarray, np.ndarray]]


@lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The library's tokenizer. Truncation and padding stay off; batches run in one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=4)
def special_ids(path: str) -> dict[str, int]:
    """Strings that the library finds in a text before it cuts words."""
    return {token.content: number for number, token in load_tokenizer(path).get_added_tokens_decoder().items()}


CACHE_BYTES = 96 << 20
ENTRY_BYTES = 160  # of a remembered word besides its text: string header, place in the index, ids


class WordCache:
    """An encoder that remembers the first distinct words it has seen, as many as `limit` bytes hold."""

    def __init__(self, encoder: WordEncoder, limit: int = CACHE_BYTES):
        self.encoder, self.room = encoder, limit
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = self.lengths = np.zeros(0, np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        places = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(places < 0)
        ids, starts, lengths = self.ids, self.starts, self.lengths
        if len(missing):
            new = [words[k] for k in missing.tolist()]
            new_ids, new_lengths = self.encoder(new)
            places[missing] = len(starts) + np.arange(len(missing))
            starts = np.concatenate([starts, len(ids) + np.cumsum(new_lengths) - new_lengths])
            lengths = np.concatenate([lengths, new_lengths])
            ids = np.concatenate([ids, new_ids])
            # A word's ids take no more than four bytes for each of its own.
            sizes = np.cumsum(8 * np.fromiter(map(len, new), np.int64, len(new)) + ENTRY_BYTES)
            if room := int(np.searchsorted(sizes, self.room, side="right")):
                self.room -= int(sizes[room - 1])
                kept = len(self.index) + room
                self.index.update(zip(new[:room], range(len(self.index), kept), strict=True))
                self.starts, self.lengths = starts[:kept], lengths[:kept]
                self.ids = ids[: int(self.lengths[-1] + self.starts[-1])]
        found = lengths[places]
        return expand(ids, starts[places], found), found


@lru_cache(maxsize=4)
def library_words(path: str, limit: int = CACHE_BYTES) -> WordEncoder:
    """The library's encoder of single words, remembered for the life of a Python worker in at most `limit` bytes."""
    tokenizer = load_tokenizer(path)

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [found.ids for found in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths

    return WordCache(encode, limit)


@lru_cache(maxsize=1)
def char_kinds() -> np.ndarray:
    """For each code point: letter, number, white space or other, as the tokenizer library sees it.

    `regex` knows all letters and numbers; of those that Python's older tables do not know,
    the library, whose version of Unicode lies between, is asked one by one.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    ask = ByteLevel(add_prefix_space=False).pre_tokenize_str
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, range(0x110000)))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        for char in regex.findall(pattern, every):
            if unicodedata.category(char) != "Cn" or len(ask(("a" if kind == LETTER else "1") + char)) == 1:
                kinds[ord(char)] = kind
    kinds[list(WHITE_SPACE)] = SPACE
    return kinds


def word_starts(codes: np.ndarray, begins: np.ndarray, rule: str) -> np.ndarray:
    """Where words start in the joined texts; `begins` marks the first character of each text.

    Both rules cut runs of letters, of other marks and of white space, and split the English
    endings 's 't 're 've 'm 'll 'd off. BYTE_LEVEL puts one blank before a run into the
    word and keeps runs of digits; WORD_END cuts digits one by one, and its white space
    encodes to nothing.
    """
    kinds = char_kinds()[codes]
    new = begins.copy()
    new[1:] |= kinds[1:] != kinds[:-1]
    if rule == WORD_END:
        new |= kinds == NUMBER
    else:
        after = np.flatnonzero(new[1:] & (kinds[1:] != SPACE) & (kinds[:-1] == SPACE) & ~begins[1:]) + 1
        new[after - 1] = True
        new[after[codes[after - 1] == 0x20]] = False
    _split_endings(codes, kinds, begins, new)
    return np.flatnonzero(new)


def _split_endings(codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray, new: np.ndarray) -> None:
    marks = np.flatnonzero((codes == 0x27) & new)
    if not len(marks):
        return
    padded = np.concatenate([codes, np.zeros(3, codes.dtype)])
    apart = np.concatenate([begins, np.ones(3, bool)])
    first, second = padded[marks + 1], padded[marks + 2]
    inside = ~apart[marks + 1]
    one = inside & np.isin(first, [ord(letter) for letter in "stmd"])
    two = inside & ~apart[marks + 2] & np.logical_or.reduce(
        [(first == ord(a)) & (second == ord(b)) for a, b in ("re", "ve", "ll")]
    )
    new[marks[one | two] + 1] = False
    ends = np.concatenate([marks[one] + 2, marks[two] + 3])
    new[ends[ends < len(new)]] = True


def _prepare(text: str, rule: str) -> str:
    """What the rule's normalizer does that can move a cut: composition, and the one growing capital."""
    if rule == WORD_END and not text.isascii():
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("İ", "i̇")
    return text


def encode_plain(texts: list[str], rule: str, encoder: WordEncoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts without special strings: all ids, and the first id of each text (and the end)."""
    texts = [_prepare(text, rule) for text in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    if not firsts[-1]:
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    joined = "".join(texts)
    codes = code_points(joined)
    begins = np.zeros(len(codes), bool)
    begins[firsts[:-1][sizes > 0]] = True
    starts = word_starts(codes, begins, rule)
    data = joined.encode()
    where = np.cumsum(byte_widths(codes), dtype=np.int64)
    numbers, words = joined_words(data, np.where(starts > 0, where[starts - 1], 0))
    ids, lengths = encoder(words)
    offsets = np.cumsum(lengths) - lengths
    flat = expand(ids, offsets[numbers], lengths[numbers])
    before = np.concatenate([[0], np.cumsum(lengths[numbers])])
    return flat, before[np.searchsorted(starts, firsts)]


def encode_texts(
    texts: list[str], path: str, rule: str, encoder: WordEncoder | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts as the library gives them without adding special tokens.

    Returns all ids and the first id of each text, with the total at the end. Special strings
    that stand in a text are single ids, as in the library.
    """
    encoder = encoder or library_words(path)
    special = special_ids(path)
    if not any(mark in text for text in texts for mark in special):
        return encode_plain(texts, rule, encoder)
    cut = re.compile("(" + "|".join(re.escape(mark) for mark in sorted(special, key=len, reverse=True)) + ")")
    pieces = [cut.split(text) for text in texts]
    ids, firsts = encode_plain([x for p in pieces for x in p[::2]], rule, encoder)
    parts, counts, at = [], [], 0
    for piece in pieces:
        count = 0
        for k, x in enumerate(piece):
            if k % 2:
                parts.append(np.array([special[x]], np.uint32))
            else:
                parts.append(ids[firsts[at] : firsts[at + 1]])
                at += 1
            count += len(parts[-1])
        counts.append(count)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def with_end_ids(ids: np.ndarray, firsts: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(ids, firsts[1:], end_id).astype(np.uint32), firsts + np.arange(len(firsts))
