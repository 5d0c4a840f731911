"""The queries of this subpackage: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.ann import search
from orderloom.llm.bpe import encode_decode
from orderloom.llm.common import ship_package
from orderloom.llm.fingerprints import edited_neighbours
from orderloom.llm.langid import held_out, identify, learn
from orderloom.llm.lm import train_and_score
from orderloom.llm.neardup import near_duplicates
from orderloom.llm.packing import pack_documents
from orderloom.llm.pii import pseudonymize
from orderloom.llm.quality import resample
from orderloom.llm.sharding import shard_documents
from orderloom.llm.spelling import spelling_groups
from orderloom.llm.tokenfile import read_token_file, write_token_file
from orderloom.llm.whitening import whiten
from orderloom.session import scratch_path, tune

Query = Callable[[SparkSession, str], DataFrame]
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_neighbours(table(spark, sf_dir, "documents"))


def near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_ngrams", "log_weight", "sample_key", "selected")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_score(table(spark, sf_dir, "documents"))


def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "tokens")
    write_token_file(docs, path, BYTE_BPE)
    return read_token_file(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE, keep=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `bytes`: the order of the texts' hashes is cut where the bytes come out equal."""
    found = shard_documents(table(spark, sf_dir, "documents"))
    return found.select(
        "document.doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"), slip_every=31)


QUERIES: dict[str, Query] = {
    "op1_fingerprints": fingerprints,
    "op2_near_duplicates": near_dups,
    "op3_language": language,
    "op4_packing": packing,
    "op5_surrogates": surrogates,
    "op6_quality": quality,
    "op7_neighbours": neighbours,
    "op8_lm_scores": lm_scores,
    "op9_token_file": token_file,
    "op10_bpe": bpe,
    "op11_shards": shards,
    "op12_whitening": whitened,
    "op13_spelling": variants,
}
ORACLE: dict[str, str] = {}
