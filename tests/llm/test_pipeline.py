"""The pipeline, stage by stage, each judged on its own input."""

import corpus_pipeline
from tests.llm import helpers
from tests.llm.helpers import SF
from tramline.llm import toxicity
from tramline.llm.common import staged


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs, columns = [], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        inputs.append(docs.toPandas())
        docs = staged(stage(spark, docs, SF), name)
        if name != "packing":
            assert docs.columns == columns
    raw, clean, unique, single, mixed = inputs
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = toxicity.toxic_scores(spark.read.parquet(f"{SF}/documents.parquet"), labels).filter("predicted = 0")
    assert sorted(clean["doc_id"]) == sorted(r["doc_id"] for r in judged.collect())
    keys = clean["text"].map(lambda t: "".join(t.split()))
    assert len(unique) == keys.nunique()
    classes = helpers.near_classes(list(zip(unique["doc_id"], unique["text"], strict=True)))
    assert sorted(single["doc_id"]) == sorted(set(classes.values()))
    count = lambda frame: frame["text"].map(lambda t: len(t.encode().split())).sum()
    assert abs(count(mixed) - count(single)) <= single["source"].nunique()
    packed = docs.toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert (packed["start"] == 0).sum() == len(mixed)
    assert corpus_pipeline.run(spark, SF).count() == len(packed)
