"""The pipeline, stage by stage, and the registered queries."""

from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from stayflow.llm import quality_crf, simhash_index
from stayflow.sources.scratch import keep

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = [stage for _, stage in corpus_pipeline.STAGES]
    good = keep(stages[0](spark, docs, FOLDER))
    assert good.columns == docs.columns
    bad = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 0").collect()}
    left = {r["doc_id"] for r in good.collect()}
    assert len(left & bad) <= 0.1 * len(bad) and len(left) >= 0.9 * (docs.count() - len(bad)) - len(bad)
    single = keep(stages[1](spark, good, FOLDER))
    groups = {r["component_id"] for r in simhash_index.simhash_groups(good).collect()}
    assert {r["doc_id"] for r in single.collect()} == groups and single.count() == len(groups)
    mixed = keep(stages[2](spark, single, FOLDER))
    texts = {r["doc_id"]: r["text"] for r in single.collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and max(times.values()) <= 2 and set(times) <= set(texts)
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    coded = stages[3](spark, mixed, FOLDER).collect()
    assert Counter(r["doc_id"] for r in coded) == times
    assert all(r["ids"] == lib.encode(r["text"]) for r in keep(stages[3](spark, mixed, FOLDER).join(single.select("doc_id", "text"), "doc_id")).collect())
    assert all(r["exact"] and r["n_ids"] == len(r["ids"]) for r in coded)


def test_stages_on_awkward_rows(spark, awkward, none):
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, awkward, FOLDER).columns == awkward.columns
        assert stage(spark, none, FOLDER).count() == 0
    encoded = corpus_pipeline.STAGES[3][1](spark, awkward, FOLDER)
    assert encoded.count() == awkward.count()
    assert corpus_pipeline.STAGES[3][1](spark, none, FOLDER).count() == 0


def test_registered(spark):
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    held = __spark_entry__.queries()["op4_quality"](spark, FOLDER)
    assert held.columns == ["doc_id", "held_out", "score", "predicted"]


def test_labels_are_no_input_of_a_score(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    seen = labels.filter(quality_crf.remainder("doc_id", 3) != 1)
    a, b = (quality_crf.train(docs, seen) for _ in range(2))
    assert (a.near == b.near).all() and (a.step == b.step).all()


def test_repeated_ids_do_not_enlarge_the_sample(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    once = quality_crf.train(docs, labels)
    again = docs.unionByName(docs).unionByName(docs.withColumn("text", F.concat("text", F.lit(" and more"))))
    many = quality_crf.train(again, labels.unionByName(labels))
    assert (once.near == many.near).all() and (once.step == many.step).all()
