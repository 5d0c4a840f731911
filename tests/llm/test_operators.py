"""Operators for training data against brute force, on hand-made rows with all awkward cases."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import ann, fingerprints, langid, lm, neardup, pii, quality, tokenfile
from orderloom.llm.bpe import encode_decode, merges_of
from orderloom.llm.common import ship_package
from orderloom.llm.packing import column_generation, pack_documents, patterns_for
from orderloom.llm.queries import BYTE_BPE, QUERIES, WORD_BPE
from orderloom.llm.tokens import BYTE_LEVEL, WORD_END, encode_texts, load_tokenizer
from tests.conftest import SF_SMALL

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, part string, rank string"
AWKWARD = [
    None, "", " \n\t ", "a", "Don't we're she'll 's 'tis x'd", "one two three four five six seven eight nine ten",
    "one two three four five six seven eight nine TEN", "one two three four five six seven eight nine ten",
    "Größe ÉCOLE niño 日本語 😀 é İ", "12345 1,000.50 ²³ ٣", "<|endoftext|> x <|startoftext|>", "$$$ ###", "ab " * 30000,
]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    rows = [(k, text, "en", "s", len(text or ""), "x", "y", "z") for k, text in enumerate(AWKWARD)]
    rows += [(5, AWKWARD[5], "en", "s", 3, "x", "y", "z"), (100, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


@pytest.mark.parametrize(("path", "rule"), [(BYTE_BPE, BYTE_LEVEL), (WORD_BPE, WORD_END)])
def test_tokens_are_the_librarys(path, rule):
    draw = random.Random(3)
    pieces = ["'s", "'re", " ", "  ", "\n", "a", "É", "é", "12", "!", "'", " '", "ß", "日本", "<|endoftext|>", "İ", "Σ", "\xa0"]
    texts = [text or "" for text in AWKWARD] + ["".join(draw.choices(pieces, k=draw.randint(0, 25))) for _ in range(400)]
    ids, firsts = encode_texts(texts, path, rule)
    want = [found.ids for found in load_tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(firsts[:-1], firsts[1:])] == want


def test_trie_gives_the_librarys_words():
    draw = random.Random(4)
    words = sorted({"".join(draw.choices("abcdeht in", k=draw.randint(1, 14))).replace(" ", "") for _ in range(3000)} - {""})
    ids, lengths = merges_of(BYTE_BPE).encode_words(words)
    ends = np.cumsum(lengths)
    want = [found.ids for found in load_tokenizer(BYTE_BPE).encode_batch(words, add_special_tokens=False)]
    assert [ids[b - n : b].tolist() for b, n in zip(ends, lengths)] == want


def test_bpe_round_trip(docs, nothing):
    found = encode_decode(docs, BYTE_BPE)
    rows = by_id(found)
    tokenizer = load_tokenizer(BYTE_BPE)
    assert found.count() == docs.count() and encode_decode(nothing, BYTE_BPE).isEmpty()
    for k, text in enumerate(AWKWARD):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert rows[k]["ids"] == ids and rows[k]["decoded"] == tokenizer.decode(ids, skip_special_tokens=False)
        assert rows[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("most", [1, 2, 300, 50_000, 1 << 31, 1 << 62])
@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_simple8b_round_trip(n, most):
    values = np.random.default_rng(n).integers(0, most, n).astype(np.uint64)
    if n > 3:
        values[:3] = (1 << 64) - 1, (1 << 60) - 1, 0
    words, blocks, escapes = tokenfile.pack(values)
    assert (tokenfile.unpack(words, blocks, escapes, n) == values).all()
    if n > 1024 and not len(escapes):
        frame = {"words": words.tobytes(), "block_words": blocks.tobytes(), "n_ids": n}
        assert (tokenfile.unpack_block(frame, 1) == values[1024:2048]).all()


def test_token_file(spark, docs, nothing, tmp_path):
    tokenfile.write_token_file(docs, str(tmp_path / "a"), BYTE_BPE)
    rows = sorted(tokenfile.read_token_file(spark, str(tmp_path / "a")).collect(), key=lambda r: r["start"])
    assert [row["doc_id"] for row in rows] == sorted(row["doc_id"] for row in docs.collect())
    start = 0
    for row in rows:
        text = AWKWARD[row["doc_id"]] if row["doc_id"] < 100 else None
        ids = np.array([*load_tokenizer(BYTE_BPE).encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    tokenfile.write_token_file(nothing, str(tmp_path / "b"), BYTE_BPE)
    assert tokenfile.read_token_file(spark, str(tmp_path / "b")).isEmpty()


def test_patterns_hold_the_demand_at_the_bound():
    draw = np.random.default_rng(5)
    demand = {int(size): int(count) for size, count in enumerate(draw.integers(0, 40, 65)) if size and count}
    found = patterns_for(demand, 64)
    held = dict.fromkeys(demand, 0)
    for pattern, times in found:
        assert sum(size * count for size, count in pattern.items()) <= 64
        for size, count in pattern.items():
            held[size] += count * times
    assert held == demand
    # No packing needs fewer sequences than the linear program; rounding adds a few.
    sizes = np.array(sorted(demand))
    _, used = column_generation(np.array([float(demand[s]) for s in sizes]), sizes, 64)
    assert sum(times for _, times in found) <= used.sum() * 1.01 + 3
    assert patterns_for({}, 64) == []


@pytest.mark.parametrize("sequence", [64, 4096])
def test_packing_places_every_id_once(docs, nothing, sequence):
    pieces = [row.asDict() for row in pack_documents(docs, WORD_BPE, sequence=sequence, unit=4, block=3).collect()]
    places = {}
    for piece in pieces:
        places.setdefault(piece["sequence_id"], []).append((piece["offset"], piece["length"]))
    for held in places.values():
        ends = np.cumsum([length for _, length in sorted(held)])
        assert [offset for offset, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= sequence
    for k in {piece["doc_id"] for piece in pieces}:
        text = AWKWARD[k] if k < 100 else None
        ids = np.array([*load_tokenizer(WORD_BPE).encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces if p["doc_id"] == k)
        assert sum(length for _, length, _, _ in own) == len(ids) * (2 if k == 5 else 1)
        for start, length, crc, total in own:
            assert (crc, total) == (zlib.crc32(ids[start : start + length].tobytes()), len(ids))
    assert pack_documents(nothing, WORD_BPE).isEmpty()


def test_fingerprint_is_its_definition():
    text = " ".join(f"word{k * k % 97}" for k in range(120)).encode()
    size = fingerprints.block_size(len(text))
    chunks, begin = [], 0
    for end in range(1, len(text) + 1):
        roll = 0
        for byte in bytes(max(0, 7 - end)) + text[max(0, end - 7) : end]:
            roll = (roll * fingerprints._ROLL + byte) % (1 << 32)
        roll ^= roll >> 15
        roll = roll * 0x2C1B3C6D % (1 << 32)
        if (roll ^ roll >> 13) % size == size - 1 or end == len(text):
            chunks.append(text[begin:end])
            begin = end
    name, fine, coarse = fingerprints.fingerprint(text).split(":")
    assert int(name) == size and len(fine) == 2 * len(chunks) and len(coarse) < len(fine)
    # Equal chunks have equal letters, others hardly ever.
    assert len({fine[2 * k : 2 * k + 2] for k in range(len(chunks))}) >= 0.9 * len(set(chunks))
    assert fingerprints.fingerprint_all([b"", text, b"x", text])[1::2] == [fingerprints.fingerprint(text)] * 2


def test_likeness_is_edit_distance():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for x in a:
            last, row = row, [row[0] + 1]
            for k, y in enumerate(b):
                row.append(min(row[-1] + 1, last[k + 1] + 1, last[k] + (0 if x == y else 2)))
        return row[-1]

    draw = random.Random(6)
    for _ in range(100):
        a, b = (["".join(draw.choices("ab", k=2)) for _ in range(draw.randint(1, 12))] for _ in range(2))
        want = 1 - edits(a, b) / (len(a) + len(b))
        assert fingerprints._likeness("".join(a), "".join(b)) == pytest.approx(max(want, 0))
    assert fingerprints.likeness("3:AABB:AA", "96:AABB:AA") == 0 and fingerprints.likeness("3::", "3::") == 1


def test_edited_neighbours(docs, nothing):
    rows = fingerprints.edited_neighbours(docs).collect()
    assert len(rows) == docs.count() and fingerprints.edited_neighbours(nothing).isEmpty()
    order = sorted((row["doc_id"], row["text"] or "") for row in docs.collect())[::-1]
    want = {}
    for k, (number, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        third = len(text) // 3
        edited = (text[: len(text) - third] + following[:third]).encode()
        a, b, c = fingerprints.fingerprint_all([text.encode(), edited, following.encode()])
        want.setdefault(number, []).append((len(text), hashlib.sha256(edited).hexdigest(), a, b, fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    got = {}
    for row in rows:
        got.setdefault(row["doc_id"], []).append(tuple(row)[1:7])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def _brute_components(texts, size, percent):
    sets = []
    for text in texts:
        words = neardup_words(text)
        grams = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for a in range(len(texts)):
            for b in range(a):
                union = len(sets[a] | sets[b])
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * union and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label, list(map(len, sets))


def neardup_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for gap in "\t\n\v\f\r":
        lowered = lowered.replace(gap, " ")
    return [word for word in lowered.split(" ") if word]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, docs, nothing, size):
    draw = random.Random(size)
    words = [f"w{k}" for k in range(60)]
    texts = [text if len(text or "") < 999 else "ab " * 50 for text in AWKWARD]
    for _ in range(12):
        source = draw.choices(words, k=80)
        texts.append(" ".join(source))
        for _ in range(draw.randint(0, 8)):
            near = list(source)
            for _ in range(draw.randint(0, 5)):
                near[draw.randrange(80)] = draw.choice(words)
            texts.append(" ".join(near))
    label, sizes = _brute_components(texts, size, 80)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(neardup.near_duplicates(rows, shingle_words=size, linear_rounds=1))
    assert [(found[k]["component_id"], found[k]["n_shingles"], found[k]["kept"]) for k in range(len(texts))] == [
        (label[k], sizes[k], label[k] == k) for k in range(len(texts))
    ]
    if size == 2:
        repeated = neardup.near_duplicates(docs, shingle_words=size)
        assert repeated.count() == docs.count() and neardup.near_duplicates(nothing).isEmpty()


def test_estimate_follows_similarity(spark):
    draw = np.random.default_rng(7)
    base = draw.integers(0, 1 << 63, 1000).astype(np.uint64)
    sets = [base, np.concatenate([base[:800], draw.integers(0, 1 << 63, 200).astype(np.uint64)])]
    bits = neardup.packed_bits(neardup.minima(sets))
    frame = spark.createDataFrame([tuple(x.tolist() for x in bits)], "a array<bigint>, b array<bigint>")
    assert frame.select(neardup.estimate("a", "b")).first()[0] == pytest.approx(800 / 1200, abs=0.15)
    assert frame.select(neardup.estimate("a", "a")).first()[0] == pytest.approx(1)


def test_language(spark, docs, nothing):
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    learned = langid.learn(real)
    rows = langid.identify(real, learned).join(real.select("doc_id", "lang"), "doc_id").where(langid.held_out(F.col("doc_id"))).collect()
    assert sum(row["lang"] == row["lang_pred"] for row in rows) >= 0.9 * len(rows) > 0
    found = by_id(langid.identify(docs, learned))
    assert {found[k]["lang_pred"] for k in (0, 1, 2, 11, 100)} == {"und"} and not found[0]["accepted"]
    assert found[12]["lang_pred"] in learned and 0 <= found[12]["score"] <= 1
    assert langid.identify(nothing, learned).isEmpty() and langid.learn(nothing) == {}
    kept = langid.identify(docs, learned, keep_columns=True)
    assert kept.columns.count("score") == 1 and kept.count() == docs.count()
    assert {row["lang_pred"] for row in langid.identify(docs, {}).collect()} == {"und"}


def test_quality(spark, docs, nothing):
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = quality.resample(real, labels).join(labels, "doc_id").collect()
    good = [row["selected"] for row in rows if row["quality"] == 1]
    bad = [row["selected"] for row in rows if row["quality"] == 0]
    assert np.mean(good) > 0.9 and np.mean(bad) < 0.5
    half = quality.resample(real, labels, share=0.5)
    assert half.where("selected").count() == 100
    texts = [b"a b, c", b"", b"a"]
    found, sizes = quality.hashed_ngrams(texts)
    assert sizes.tolist() == [7, 0, 1] and found[0] == found[-1]
    assert quality.resample(docs, labels.where("false")).count() == docs.count()
    assert quality.resample(nothing, labels).isEmpty()


def test_surrogates(spark, docs, nothing):
    mail, phone, card = "anna.k@mail.example.com", "+1 (423) 555-7379", "4111 1111 1111 1111"
    texts = [f"Write {mail} or {phone}.", f"{mail.upper()} {card} 10.1.2.3", "Frau Anna Weber met Mr. Иван Петров", None, "nothing here"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = by_id(pii.pseudonymize(rows))
    assert [found[k]["n_entities"] for k in range(5)] == [2, 3, 2, 0, 0]
    assert found[3]["text"] is None and found[4]["text"] == texts[4]
    new_mail = found[0]["text"].split()[1]
    assert new_mail != mail and found[1]["text"].startswith(new_mail.upper())
    for kind, before in (("phone", phone), ("card", card)):
        text = found[0 if kind == "phone" else 1]["text"]
        assert before not in text and any(k == kind for _, _, k, _ in pii.find(text))
    names = [found[2]["text"][a:b] for a, b, _, _ in pii.find(found[2]["text"])]
    assert names[0].split()[0] in pii.FIRST_NAMES["latin", "f"] and names[1].split()[0] in pii.FIRST_NAMES["cyrillic", "m"]
    assert pii.pseudonymize(docs).count() == docs.count() and pii.pseudonymize(nothing).isEmpty()
    assert set(pii.pseudonymize(docs).columns) == {*docs.columns, "n_entities"}


def test_surrogates_are_distinct_and_no_entities(spark):
    entities = [("ip", f"{a}.{b}.1.1", "") for a in range(1, 20) for b in range(1, 20)] + [("name", f"N{k}", "n") for k in range(900)]
    rows = spark.createDataFrame(entities, "kind string, entity string, gender string")
    pairs = [tuple(row) for row in pii.assign(rows).collect()]
    assert len(pairs) == len(entities) == len({(kind, new) for kind, _, new in pairs})
    assert not {(kind, new) for kind, _, new in pairs} & {(kind, entity) for kind, entity, _ in entities}


def _brute_neighbours(rows, k):
    usable = {n: np.array(v, np.float64) for n, v in rows if n is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)}
    found = {}
    for n, v in usable.items():
        away = sorted((float(np.sqrt(((w - v) ** 2).sum())), m) for m, w in usable.items() if m != n)
        found[n] = away[:k]
    return found


def test_neighbours(spark):
    draw = np.random.default_rng(8)
    rows = [(k, draw.normal(size=8).astype(np.float32).tolist()) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(300, 340)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [None] * 8), (None, rows[1][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x"))
    got = {}
    for row in ann.search(frame, F.col("vec_id") % 10 == 0, pivots=32, prefix=32, part=50, query_part=7).collect():
        got.setdefault(row["query_id"], {})[row["rank"]] = (row["score"], row["vec_id"])
    want = {n: away for n, away in _brute_neighbours(rows, 10).items() if n % 10 == 0}
    assert got.keys() == want.keys()
    hits = 0
    for n, away in want.items():
        own = [got[n][k] for k in range(1, 11)]
        assert own == sorted(own)
        hits += len({m for _, m in own} & {m for _, m in away})
    assert hits >= 0.9 * 10 * len(want)
    assert [m for _, m in sorted(got[0].values())] == list(range(300, 310))
    assert ann.search(frame.where("false"), F.lit(True)).isEmpty()
    assert ann.search(frame.where("vec_id = 1"), F.lit(True)).isEmpty()
    assert ann.search(frame.where("vec_id < 3"), F.lit(True)).count() == 6


def test_language_model(spark, docs, nothing):
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    alphabet = lm.fit_alphabet(real)
    table = lm.token_table(alphabet[0])
    network = lm.fit_network(lm.training_windows(real, table, every=16))
    trained, fresh = (by_id(lm.score(real, alphabet, n)) for n in (network, lm.fresh_network()))
    total = sum(row["n_tokens"] for row in trained.values())
    assert sum(row["log_prob"] for row in trained.values()) / total > sum(row["log_prob"] for row in fresh.values()) / total + 0.5
    found = by_id(lm.score(docs, alphabet, network))
    for k in (0, 1, 100):
        assert (found[k]["n_tokens"], found[k]["log_prob"], found[k]["mean_log_prob"]) == (0, 0.0, None)
    for k in (3, 4, 8):
        tokens = [0, 0, *table[[ord(c) for c in AWKWARD[k]]], 0, 0]
        windows = np.array([tokens[p : p + lm.WIDTH] for p in range(len(AWKWARD[k]))], np.int64)
        others = lm.shares_among_others(*alphabet)[[ord(c) for c in AWKWARD[k]]].sum()
        assert found[k]["log_prob"] == pytest.approx(lm.log_probabilities(network, windows).sum() + others, abs=1e-3)
    assert lm.score(nothing, alphabet, network).isEmpty() and lm.train_and_score(nothing).isEmpty()


def test_pipeline_stages(spark, docs, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, SF_SMALL).columns == docs.columns
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
    rows = docs.where("doc_id < 100")
    kept = corpus_pipeline.near_duplicate(spark, rows, SF_SMALL)
    assert sorted(row["doc_id"] for row in kept.collect()) == [k for k in range(len(AWKWARD)) if k not in (6, 7)]
    assert corpus_pipeline.packing(spark, nothing, SF_SMALL).isEmpty()


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert public_tokenizers.path("byte_bpe_50k.json") == BYTE_BPE
