"""Quality weights by brute force, surrogates of names and addresses, dictionaries, recall of the permutation index."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import ann, langid, pii, quality
from orderloom.llm.common import ship_package
from tests.conftest import SF_SMALL

TEXTS = ["good words here, good words", "bad bad noise", None, "", "other plain words", "good plain words", "good plain words"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("per_ngram", [True, False])
def test_quality_equals_brute_force(spark, per_ngram):
    docs = spark.createDataFrame([(k, text, "mine") for k, text in enumerate(TEXTS)], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(k, 1) for k in range(7)], "doc_id bigint, quality int")
    good = {row["doc_id"] for row in labels.where(~quality.held_back("doc_id")).collect()}
    assert 0 < len(good) < 7
    grams = [quality.hashed_ngrams([(text or "").encode()])[0].tolist() for text in TEXTS]
    raw, target = Counter(), Counter()
    for k, own in enumerate(grams):
        raw.update(own)
        target.update(own if k in good else ())
    total = sum(raw.values()) + quality.SMOOTHING * quality.BUCKETS
    want = []
    for own in grams:
        weight = 0.0
        for gram in own:
            share = (raw[gram] + quality.SMOOTHING) / total
            weight += math.log((target[gram] + quality.PRIOR * share) / (sum(target.values()) + quality.PRIOR) / share)
        want.append(weight / max(1, len(own)) if per_ngram else weight)
    rows = {row["doc_id"]: row for row in quality.resample(docs, labels, share=3 / 7, per_ngram=per_ngram).collect()}
    assert [rows[k]["log_weight"] for k in range(7)] == pytest.approx(want, abs=1e-6) and rows[0]["score"] == "mine"
    assert [rows[k]["n_ngrams"] for k in range(7)] == list(map(len, grams))
    noise = {row["doc_id"]: row["n"] for row in docs.select("doc_id", quality.gumbel("doc_id", "text", F.lit(0)).alias("n")).collect()}
    keys = {k: want[k] / (quality.MEAN_TEMPERATURE if per_ngram else quality.TEMPERATURE) + noise[k] for k in rows}
    assert {k for k in rows if rows[k]["selected"]} == set(sorted(keys, key=keys.get)[-3:])


def test_the_cut_and_the_target_use_all_labels(spark):
    labels = spark.range(120_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    weighed = labels.select("doc_id", (F.xxhash64("doc_id") / 2.0**63).alias("log_weight"))
    weights = weighed.withColumn("held", quality.held_back("doc_id")).toPandas()
    held = weights["log_weight"][weights["held"]]
    assert len(held) > 20_000
    for loss in (0.002, 0.37):
        share = quality.share_to_keep(weighed, labels, id_col="doc_id", quality_col="quality", loss=loss)
        assert share == (weights["log_weight"] >= np.percentile(held, 100 * loss)).mean()
    docs = labels.select("doc_id", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("text"))
    even = labels.where("doc_id % 2 = 0")
    target = even.where(~quality.held_back("doc_id")).count()
    weight = quality.resample(docs, even, share=1.0).where("text = 'even'").agg(F.max("log_weight"), F.min("log_weight")).first()
    share = (60_000 + quality.SMOOTHING) / (120_000 + quality.SMOOTHING * quality.BUCKETS)
    expected = math.log((target + quality.PRIOR * share) / (target + quality.PRIOR) / share)
    assert target > 20_000 and list(weight) == pytest.approx([expected] * 2, abs=1e-6)


def test_quality_keeps_ties(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    found = quality.resample(docs, labels, share=0.25).where("selected").collect()
    assert len(found) in (1, 3) and len({row["sample_key"] for row in found}) == 1


def test_noise_is_gumbel(spark):
    noise = [row["n"] for row in spark.range(20_000).select(quality.gumbel("id").alias("n")).collect()]
    assert np.mean(noise) == pytest.approx(0.5772, abs=0.05) and np.var(noise) == pytest.approx(math.pi**2 / 6, abs=0.1)


def _pseudonyms(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {row["doc_id"]: row["text"] for row in pii.pseudonymize(rows).collect()}


def test_names_keep_their_links(spark):
    found = _pseudonyms(
        spark,
        [
            "Mr John Smith came. Mr Smith's car. Then Smith left, and John Smith called.",
            "Mrs Anna Smith and Dr. Smith",
            "Herr Jean-Luc Picard",
            "Herr John Brown, Smith is a trade",
        ],
    )
    first, last = found[0].split()[1:3]
    last = last.removesuffix(" came.")
    assert found[0] == f"Mr {first} {last} came. Mr {last}'s car. Then {last} left, and {first} {last} called."
    assert first in pii.FIRST_NAMES["latin", "m"] and last != "Smith"
    anna = found[1].split()[1]
    assert anna in pii.FIRST_NAMES["latin", "f"] and found[1] == f"Mrs {anna} {last} and Dr. {last}"
    assert found[2].count("-") == 1 and "Jean" not in found[2] and "Picard" not in found[2]
    # Without a title in the same text a name is not known.
    assert found[3].startswith(f"Herr {first} ") and found[3].endswith(", Smith is a trade") and "Brown" not in found[3]


def test_domains_keep_their_links(spark):
    found = _pseudonyms(spark, ["a.b@one.example.com or c@one.example.com", "A.B@ONE.EXAMPLE.COM, c@two.example.org"])
    a, c = (x.split("@") for x in found[0].split(" or "))
    upper, other = (x.split("@") for x in found[1].split(", "))
    assert a[1] == c[1] != "one.example.com" and a[1].endswith(".com") and a[1].count(".") == 2
    assert upper == [a[0].upper(), a[1].upper()] and other[0] == c[0] and other[1] != c[1]


@pytest.mark.parametrize(("kind", "entities"), [
    ("local", [chr(97 + k) for k in range(26)] + [f"{chr(97 + a)}{b}" for a in range(26) for b in range(10)]),
    ("domain", [f"{chr(97 + k)}.co" for k in range(26)]),
    ("phone", [f"+49{k:04}" for k in range(3000)]),
    ("secret", ["sk_----------------", "sk_---------------_"]),
    ("first", [f"A{chr(97 + k)}" for k in range(26)]),
])
def test_an_exhausted_shape_ends(spark, kind, entities):
    rows = spark.createDataFrame([(kind, x, "n" if kind == "first" else "") for x in entities], "kind string, entity string, gender string")
    pairs = [tuple(row)[1:] for row in pii.assign(rows).collect()]
    assert sorted(x for x, _ in pairs) == sorted(entities)
    assert len({new for _, new in pairs}) == len(entities) and not {new for _, new in pairs} & set(entities)


def test_a_kind_that_cannot_grow_fails_by_name(spark, monkeypatch):
    monkeypatch.setattr(pii, "ATTEMPTS", 1)
    rows = spark.createDataFrame([("ssn", f"{k:03}", "") for k in range(1000)], "kind string, entity string, gender string")
    with pytest.raises(ValueError, match="'ssn'"):
        pii.assign(rows)


def test_longer_phone_numbers_keep_all_digits():
    assert pii.dressed("+49 12 34", "+49567899", "phone") == "+49 56 7899"


def test_surrogates_leave_other_columns(spark):
    rows = spark.createDataFrame([(1, "x@y.co", "a", "b", "c", "d"), (2, None, None, None, None, None)],
                                 "doc_id bigint, text string, _row string, _found string, _New string, row string")
    found = {row["doc_id"]: row for row in pii.pseudonymize(rows).collect()}
    assert tuple(found[1])[2:] == ("a", "b", "c", "d", 1) and found[1]["text"] != "x@y.co" and found[2]["n_entities"] == 0


def test_a_row_without_id_is_learned_from(spark):
    rows = spark.createDataFrame([(None, "abc def", "en"), (4, None, "en"), (5, "", "de"), (6, "xyz", None)], "doc_id bigint, text string, lang string")
    assert {row[0] for row in rows.select(langid.held_out(F.col("doc_id"))).collect()} <= {True, False}
    assert langid.learn(rows) == {"en": b"abc def"}


def test_dictionaries_hold_all_of_a_text(spark):
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows = [(k, " ".join(words), "en") for k in range(5)] + [(100, "Zulu yankee", "en"), (101, " ".join(words).upper(), "de")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    found = langid.fit_dictionaries(docs)
    # Copies count once, everything fits: the whole text is there, none of it twice.
    assert len(found["en"]) == len(" ".join(words)) + 21 + len("zulu yankee")
    assert b"zulu yankee" in found["en"] and all(found["en"].count(word.encode()) <= 2 for word in words[::100])
    assert len(found["de"]) == len(" ".join(words)) + 20
    assert found == langid.fit_dictionaries(docs.repartition(3))
    small = langid.fit_dictionaries(docs, size=2500)
    assert all(2000 <= len(content) <= 2500 for content in small.values())


def test_recall_of_the_index_with_its_filter(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/../sf0.1/embeddings.parquet")
    usable = {row["vec_id"]: np.array(row["v"], np.float64) for row in ann.usable(rows, "vec_id", "embedding").collect()}
    ids, points = np.array(list(usable)), np.stack(list(usable.values()))
    got = {}
    # A file holds about 16 vectors, of which 4 are measured.
    for row in ann.search(rows, F.col("vec_id") % 100 == 0, share=0.25, least=4).collect():
        got.setdefault(row["query_id"], set()).add(row["vec_id"])
    hits = 0
    for n, own in got.items():
        away = ((points - usable[n]) ** 2).sum(axis=1)
        hits += len(own & set(ids[ids != n][np.lexsort((ids[ids != n], away[ids != n]))[:10]].tolist()))
    assert len(got) == len([n for n in usable if n % 100 == 0]) and hits >= 0.9 * 10 * len(got)


@pytest.mark.parametrize("prefix", [3, 180, 256])
def test_footrule_is_its_definition(prefix):
    draw = np.random.default_rng(prefix)
    perms = np.stack([draw.permutation(256)[:prefix].astype(np.uint8) for _ in range(6)] + [np.arange(256)[:prefix].astype(np.uint8), np.arange(256)[::-1][:prefix].astype(np.uint8)])
    places = [{int(p): k for k, p in enumerate(perm)} for perm in perms]
    want = [[sum(abs(a.get(p, prefix) - b.get(p, prefix)) for p in range(256)) for b in places] for a in places]
    assert ann.footrules(perms, perms, 256).tolist() == want
