"""Language-model scores: the same whatever the partitions, better than single counts, no script for free."""

from collections import Counter
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import lm
from orderloom.llm.common import ship_package
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def real(spark):
    ship_package(spark)
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")


def test_scores_do_not_depend_on_partitions(spark, real):
    def fitted(docs):
        alphabet = lm.fit_alphabet(docs)
        network = lm.fit_network(lm.training_windows(docs, lm.token_table(alphabet[0])), per_copy=300)
        return network, {row["doc_id"]: row["log_prob"] for row in lm.score(docs, alphabet, network).collect()}

    before = spark.conf.get("spark.sql.shuffle.partitions")
    network, found = fitted(real)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        again, others = fitted(real.repartition(7, "text"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all((again[name] == network[name]).all() for name in network)
    assert others == found


def test_training_windows_are_every_nth_position(spark):
    texts = ["abcabcabc", "abcabcabc", None, "", "zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ship_package(spark)
    table = lm.token_table(lm.fit_alphabet(docs)[0])
    expected = Counter()
    for text in texts:
        tokens = [0] * lm.SIDE + [int(table[ord(c)]) for c in text or ""] + [0] * lm.SIDE
        expected.update(tuple(tokens[p : p + lm.WIDTH]) for p in range(len(text or "")))
    found = lm.training_windows(docs, table, every=1).collect()
    windows = lm._decoded(np.array([row["window"] for row in found]))
    assert dict(zip(map(tuple, windows.tolist()), (row["times"] for row in found), strict=True)) == expected


def test_every_position_is_trained_on(spark, real):
    alphabet = lm.fit_alphabet(real)
    found = lm.training_windows(real, lm.token_table(alphabet[0]))
    assert found.agg(F.sum("times")).first()[0] == real.agg(F.sum(F.length("text"))).first()[0]
    rows = [(1, 1), (2, 100), (3, 101), (4, 12_345)]
    pieces = lm.in_pieces(spark.createDataFrame(rows, "window bigint, times bigint"), 100).collect()
    assert {row["window"]: row["times"] for row in pieces} == {1: 1, 2: 1, 3: 2, 4: 124}
    assert {row["window"]: row["times"] * row["weight"] * 100 for row in pieces} == pytest.approx(dict(rows))


@pytest.mark.parametrize("copies", [1, 3, 10])
def test_windows_are_dealt_evenly(spark, copies):
    times = {k: k % 7 + 1 for k in range(200)} | {500: 100_003}
    rows = spark.createDataFrame(list(times.items()), "window bigint, times bigint")
    total, shares = Counter(), {}
    for copy, window, n in lm.dealt(rows, copies).collect():
        total[window] += n
        shares.setdefault(window, Counter())[copy] += n
        assert 0 <= copy < copies
    assert total == times
    for window, own in shares.items():
        every = [own[copy] for copy in range(copies)]
        assert max(every) - min(every) <= 1, window


def test_held_out_texts_are_likelier_than_by_single_counts(real):
    learned, held = real.where("doc_id % 5 > 0"), real.where("doc_id % 5 = 0")
    alphabet = lm.fit_alphabet(learned)
    network = lm.fit_network(lm.training_windows(learned, lm.token_table(alphabet[0]), every=8))
    share = dict(zip(alphabet[0].tolist(), np.log(alphabet[1] / alphabet[1].sum()), strict=True))
    rows = lm.score(held, alphabet, network).collect()
    single = sum(share.get(ord(c), -log(lm.CODES)) for row in held.collect() for c in row["text"] or "")
    assert sum(row["log_prob"] for row in rows) > 0.8 * single


def test_a_rare_script_is_not_predictable(spark, real):
    rare = [(10_000_000 + k, "".join(chr(0x4E00 + (k * 997 + j * 131) % 5000) for j in range(200))) for k in range(3)]
    found = {row["doc_id"]: row["mean_log_prob"] for row in lm.train_and_score(real.unionAll(spark.createDataFrame(rare, real.schema))).collect()}
    usual = sorted(v for k, v in found.items() if k < 10_000_000 and v is not None)
    assert max(found[k] for k, _ in rare) < usual[len(usual) // 10]


def test_shares_sum_to_one():
    codes, times = np.arange(200), np.arange(200, 0, -1)
    found = lm.shares_among_others(codes, times)
    assert (found[: lm.TOKENS - 2] == 0).all()
    assert np.exp(found[lm.TOKENS - 2 :]).sum() == pytest.approx(1)
