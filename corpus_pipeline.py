"""A corpus pipeline of five stages: each takes what its predecessor kept.

Language, quality, near-duplicates, personal data, packing. The first three decide which
documents stay, the fourth rewrites texts, the last gives pieces of sequences. Columns other
than doc_id, text and lang are carried along; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.common import ship_package, store
from orderloom.llm.langid import identify, learn
from orderloom.llm.neardup import near_duplicates
from orderloom.llm.packing import pack_documents
from orderloom.llm.pii import pseudonymize
from orderloom.llm.quality import resample
from orderloom.llm.queries import WORD_BPE, table
from orderloom.session import tune

# Words that a Python worker remembers while it packs: the workers of earlier stages live on beside it.
WORD_BYTES = 32 << 20


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; those without text or letters go."""
    rows = _plain(_shipped(spark, docs))
    return _restored(identify(rows, learn(rows), keep_columns=True).where("accepted"), docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by importance; the share kept is that of documents like the labelled good ones."""
    rows = _plain(_shipped(spark, docs))
    return _restored(resample(rows, table(spark, sf_dir, "labels")).where("selected"), docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; of repeated rows one."""
    rows = _plain(_shipped(spark, docs))
    copies = near_duplicates(rows).where("NOT kept").select("doc_id")
    return _restored(rows.join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows a text that has changed."""
    found = pseudonymize(_plain(_shipped(spark, docs)))
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_entities") > 0, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return _restored(found, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return pack_documents(_shipped(spark, docs), WORD_BPE, word_bytes=WORD_BYTES)


# The columns of documents.
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
# All other columns go through a stage as one struct of this name.
CARRIED = "carried"


def _others(docs: DataFrame) -> list[str]:
    return [name for name in docs.columns if name not in DOCUMENT]


def _plain(docs: DataFrame) -> DataFrame:
    """Documents whose further columns cannot clash with those that an operator adds."""
    others = _others(docs)
    if not others:
        return docs
    own = [name for name in docs.columns if name in DOCUMENT]
    held = [F.col(f"`{name}`").alias(f"c{k}") for k, name in enumerate(others)]
    return docs.select(*own, F.struct(*held).alias(CARRIED))


def _restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` out of what an operator has made of _plain(docs)."""
    held = {name: F.col(f"{CARRIED}.c{k}").alias(name) for k, name in enumerate(_others(docs))}
    return rows.select(*[held.get(name, F.col(f"`{name}`")) for name in docs.columns])


def _shipped(spark: SparkSession, docs: DataFrame) -> DataFrame:
    ship_package(tune(spark))
    return docs


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near-duplicates", near_duplicate),
    ("personal data", personal_data),
    ("packing", packing),
]
# Compression, random sampling, minima and tokenizers have no DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents; each stage's rows are stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
