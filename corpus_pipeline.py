"""From raw documents to a training mixture: quality, near duplicates, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import mixing, quality_crf, sentencepiece_codec, simhash_index
from stayflow.llm.queries import PIECES, labelled, table
from stayflow.sources.scratch import keep

WORDS_HELD = 300_000  # words that a Python worker remembers: the rows here are wide, so memory is short


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects (score under 0.5); null texts count as empty.

    The classifier learns from the labelled documents of the table ``documents``.
    """
    field = quality_crf.train(table(spark, sf_dir, "documents"), labelled(spark, sf_dir))
    return docs.filter(quality_crf.quality("text", field) >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest doc_id of each group of near duplicates."""
    return simhash_index.keep_one(docs, width=3, distance=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mixture takes them (0, 1 or 2 times)."""
    return mixing.Mix(docs, carry=True).mixed().select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number and whether they decode to the text."""
    both = sentencepiece_codec.encode_and_decode("text", PIECES, most=WORDS_HELD)
    return docs.select("doc_id", "source", "text", both.alias("coded")).select(
        "doc_id",
        "source",
        "coded.ids",
        F.size("coded.ids").cast("long").alias("n_ids"),
        F.col("coded.decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

# The field, XXH64 and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each one's rows written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = keep(docs)
    return docs
