"""Spelling groups against brute force on all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import spelling
from orderloom.llm.common import ship_package
from orderloom.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(counts):
    """word to (form, root, n, n_near, form_n)."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best is not None and counts[best] >= 10 * counts[word] else None
    found = {}
    for word in counts:
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        found[word] = (form, root, counts[word], len(near[word]), counts[form] if form is not None else None)
    return found


def as_dict(frame):
    rows = frame.collect()
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(found) == len(rows)
    return found


def words_of(documents, slip_every=31):
    """The contract's words, code point by code point."""
    counts = Counter()
    for doc, text in documents:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for word in re.findall("[a-zÀ-ÿ]+", lowered):
            mark = zlib.crc32(f"{doc}:{word}".encode())
            if doc is not None and slip_every and mark % slip_every == 0:
                word = word[: mark % len(word)] + word[mark % len(word) + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if n >= 2 and len(word) >= 7}


def vocabulary(seed, n, letters="abé", least=7, most=10):
    """Many words close to one another: few letters, and changed copies."""
    draw = random.Random(seed)
    words = set()
    while len(words) < n:
        word = "".join(draw.choices(letters, k=draw.randint(least, most)))
        words.add(word)
        place = draw.randrange(len(word))
        words.add(word[:place] + draw.choice([*letters, ""]) + word[place + 1 :])
    return {word: draw.choice([2, 3, 30, 400, 5000]) for word in words if len(word) >= least}


def frame_of(spark, counts):
    ship_package(spark)
    return spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)


@pytest.mark.parametrize("limit", [spelling.LIMIT, 60, 1])
@pytest.mark.parametrize(("letters", "least", "most"), [("abé", 7, 10), ("ab", 7, 9), ("abcdefghij", 7, 8)])
def test_groups_are_those_of_brute_force(spark, limit, letters, least, most):
    counts = vocabulary(limit, 250, letters, least, most)
    assert as_dict(spelling.group_variants(frame_of(spark, counts), limit=limit)) == brute(counts)


def test_repeated_letters_ties_and_one_very_long_word(spark):
    counts = {"a" * 7: 2, "a" * 8: 20, "a" * 9: 200, "a" * 10: 2000, "ab" * 4: 3, "ab" * 4 + "a": 30, "bab" + "ab" * 3: 30}
    counts |= {"x" * 20_000: 2, "x" * 19_999: 50, "x" * 10_000 + "y" + "x" * 9_999: 50}
    assert as_dict(spelling.group_variants(frame_of(spark, counts))) == brute(counts)


def test_a_hot_front_is_cut_again(spark):
    """A third of the words begin alike, and a third end alike."""
    draw = random.Random(9)
    counts = {"zzzzzzzz" + "".join(draw.choices("abc", k=4)): draw.randint(2, 90) for _ in range(120)}
    counts |= {"".join(draw.choices("abc", k=4)) + "zzzzzzzz": draw.randint(2, 90) for _ in range(120)}
    words = frame_of(spark, counts)
    blocks = spelling._blocks(words, 7, 100)
    sizes = blocks.selectExpr("*", "size - head - tail AS middle").groupBy(*spelling.KEY, "middle").count().collect()
    assert all(row["middle"] * row["count"] <= 100 or row["middle"] <= 1 for row in sizes)
    assert as_dict(spelling.group_variants(words, limit=100)) == brute(counts)


def test_pairs_do_not_depend_on_how_many_are_held(monkeypatch):
    middles = sorted(vocabulary(5, 300, "abc", 5, 6))
    middles = sorted({m[:5] if len(m) > 6 else m for m in middles if len(m) >= 5})
    first = np.zeros(len(middles), np.int64)
    want = sorted((a, b) for a in range(len(middles)) for b in range(a + 1, len(middles)) if one_edit(middles[a], middles[b]))
    for held in (spelling.HELD_PAIRS, 50):
        monkeypatch.setattr(spelling, "HELD_PAIRS", held)
        earlier, later = spelling.near_pairs(middles, first)
        assert sorted(zip(earlier.tolist(), later.tolist())) == want


def test_ranges_are_skipped(monkeypatch):
    """Entries behind a prefix that is two edits from a query cost it nothing."""
    middles = sorted("ab"[k % 2] * 3 + f"{k:05d}".translate(str.maketrans("0123456789", "cdefghijkl")) for k in range(2000))
    steps = []
    real = spelling.expand
    monkeypatch.setattr(spelling, "expand", lambda *a: steps.append(len(out := real(*a))) or out)
    spelling.near_pairs(middles, np.zeros(len(middles), np.int64))
    assert sum(steps) < 0.1 * len(middles) ** 2


DOCS = [
    (1, "Straßenbahn STRAßENBAHN straßenbahn ÉCOLES Écoles écoles x×y÷zabcde"), (2, None), (3, ""), (None, "elephant elephant Elephant"),
    (4, "elephant elepant elephant " * 40), (5, "elephants, elephan7ts; elephan" * 3), (5, "elephants, elephan7ts; elephan" * 3),
    (6, "abcdefgh" * 3000), (6, "abcdefgh" * 3000), *[(k, "elephant umbrella umbrela Umbrella mountains mountins") for k in range(10, 90)],
]


def test_words_of_whole_texts(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(d, t, "n", "w", "f") for d, t in DOCS], "doc_id bigint, text string, n string, word string, form string")
    for slip in (31, None):
        counted = {r["word"]: r["n"] for r in spelling.count_words(docs, slip_every=slip).collect()}
        assert counted == words_of(DOCS, slip)
    assert as_dict(spelling.spelling_groups(docs, slip_every=31)) == brute(words_of(DOCS))
    assert spelling.spelling_groups(docs.where("false")).isEmpty()


def test_query_on_the_whole_table(spark):
    documents = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    counts = words_of(documents)
    found = as_dict(QUERIES["op13_spelling"](spark, SF_SMALL))
    assert {word: row[2] for word, row in found.items()} == counts
    # Brute force by deletion: two words one edit apart share a word with one place taken out.
    keys = {}
    for word in counts:
        for key in {word, *((word[:k] + "\0" + word[k + 1 :]) for k in range(len(word)))}:
            keys.setdefault(key, []).append(word)
    near = {word: set() for word in counts}
    for key, words in keys.items():
        for word in words:
            near[word] |= {other for other in words if one_edit(word, other)}
            if "\0" not in key:
                near[word] |= {v for k in range(len(key)) for v in [key[:k] + key[k + 1 :]] if v in counts and one_edit(word, v)}
    for word, others in list(near.items()):
        for other in others:
            near[other].add(word)
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * counts[word] else None
        assert (found[word][0], found[word][3]) == (form, len(others))
