"""Columns that the documents bring along go through every stage as they are."""

import corpus_pipeline
from orderloom.llm.common import ship_package
from tests.conftest import SF_SMALL

CLASHES = ["score", "accepted", "selected", "n_ngrams", "n_entities", "_row", "_found", "_new", "lang_pred", "carried", "a.b"]
STAGES = [stage for name, stage in corpus_pipeline.STAGES if name != "packing"]


def test_values_and_types_of_other_columns_are_kept(spark):
    ship_package(spark)
    texts = [
        "The committee met on Tuesday and wrote to Mr John Smith at john.smith@example.org about the harbour works.",
        "A long report on rivers, bridges and markets that says how the town has grown over the last hundred years.",
        "Children of the valley walk to school along the old road, past the mill and over the narrow wooden bridge.",
    ]
    rows = [(k, texts[k % 3] + f" Note {k}.", "en", "s", 9, *[f"{name}-{k}" for name in CLASHES]) for k in range(12)]
    columns = ", ".join(f"`{name}` string" for name in CLASHES)
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {columns}")
    given = {row["doc_id"]: tuple(row[name] for name in CLASHES) for row in docs.collect()}
    for stage in STAGES:
        found = stage(spark, docs, SF_SMALL)
        assert found.schema.fieldNames() == docs.columns
        assert [f.dataType for f in found.schema.fields] == [f.dataType for f in docs.schema.fields]
        kept = found.collect()
        assert {row["doc_id"]: tuple(row[name] for name in CLASHES) for row in kept}.items() <= given.items()
    assert corpus_pipeline.packing(spark, docs, SF_SMALL).where("doc_id = 3").count() >= 1
    changed = corpus_pipeline.personal_data(spark, docs, SF_SMALL).collect()
    assert len(changed) == len(given) and any(row["n_chars"] != 9 for row in changed)
