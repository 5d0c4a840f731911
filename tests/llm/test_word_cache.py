"""The memory of encoded words gives the same ids however little it may hold."""

import random

import numpy as np
import pytest

from orderloom.llm.common import ship_package
from orderloom.llm.packing import pack_documents
from orderloom.llm.queries import WORD_BPE
from orderloom.llm.tokens import ENTRY_BYTES, WordCache
from tests.conftest import SF_SMALL


def _spell(words):
    lengths = np.array([len(word) for word in words], np.int64)
    return np.array([ord(char) for word in words for char in word], np.uint32), lengths


@pytest.mark.parametrize("limit", [0, ENTRY_BYTES + 20, 20 * ENTRY_BYTES, 1 << 20])
def test_ids_do_not_depend_on_the_limit(limit):
    draw, cache = random.Random(limit), WordCache(_spell, limit)
    for _ in range(50):
        words = sorted({"".join(draw.choices("abc", k=draw.randint(1, 5))) for _ in range(30)})
        ids, lengths = cache(words)
        want, sizes = _spell(words)
        assert ids.tolist() == want.tolist() and lengths.tolist() == sizes.tolist()
        assert sum(8 * len(word) + ENTRY_BYTES for word in cache.index) <= limit


def test_packing_does_not_depend_on_the_word_memory(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    much, little = (sorted(map(tuple, pack_documents(docs, WORD_BPE, word_bytes=limit).collect())) for limit in (64 << 20, 5000))
    assert much == little
