"""One query per operator over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import (
    bottomk,
    chat_format,
    ctw,
    html_text,
    licenses,
    mixing,
    pivot_index,
    prefix_trie,
    quality_crf,
    sentencepiece_codec,
    simhash_index,
    spelling_kd,
    token_prefix,
)
from stayflow.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES: dict = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096
CHAT = chat_format.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = docs.withColumn("coded", sentencepiece_codec.encode_and_decode("text", PIECES))
    return coded.select(
        "doc_id",
        "coded.ids",
        F.size("coded.ids").cast("long").alias("n_ids"),
        "coded.decoded",
    )


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text, and the code points that fit the limit."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = docs.withColumn("answer", token_prefix.token_budget("text", PIECES, TOKEN_LIMIT))
    return counted.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        "answer.n_tokens",
        (F.col("answer.n_tokens") > TOKEN_LIMIT).alias("over_limit"),
        F.col("answer.cut").alias("kept_chars"),
    )


@query
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every text."""
    return simhash_index.simhash_groups(table(spark, folder, "documents"), width=3, distance=3)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """The labels that a quality model may learn from."""
    return table(spark, folder, "labels").filter(quality_crf.remainder("doc_id", 3) != 1)


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every text by a field fitted on the labels that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = quality_crf.train(docs, labelled(spark, folder))
    scored = docs.select(
        "doc_id",
        F.coalesce(quality_crf.remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        quality_crf.quality("text", field).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that the mixture takes."""
    mix = mixing.Mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mix.taken().select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = bottomk.with_next(docs, "doc_id", ["text"], {"sketch": bottomk.sketch("text")})
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next.text", F.lit(1), cut))
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", bottomk.sketch("edited"))
    rows = rows.withColumn("both", bottomk.merge("sketch", "edited_sketch"))
    both = F.col("both")
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        bottomk.digits("sketch").alias("fingerprint"),
        bottomk.digits("edited_sketch").alias("edited_fingerprint"),
        bottomk.resemblance("sketch", "edited_sketch", both=both).alias("near_edited"),
        bottomk.resemblance("sketch", "next.sketch").alias("near_next"),
        bottomk.distinct_shingles("sketch").alias("n_shingles"),
        bottomk.containment("sketch", "edited_sketch", both=both).alias("kept_in_edited"),
    )


@query
def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every text by word frequencies and by context-tree weighting."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    train = F.coalesce(quality_crf.remainder("doc_id", 5) != 1, F.lit(True))
    scored = ctw.score(docs, train)
    return scored.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "n_bytes",
    )


@query
def op6_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and near-duplicate group of every vector."""
    return pivot_index.near_vectors(table(spark, folder, "embeddings"), least=0.95)


@query
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", html_text.extract("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in every text: where they stand and how much of the template is there."""
    docs = table(spark, folder, "documents").select("doc_id", licenses.scan("text").alias("found"))
    return docs.select("doc_id", F.explode("found").alias("match")).select("doc_id", "match.*")


@query
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all texts, the words one edit away, and the form each is a variant of."""
    counted = spelling_kd.words(table(spark, folder, "documents"))
    return spelling_kd.variants(counted, ratio=10)


@query
def op12_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and what its tokens say when they are read back."""
    looks_like_marks = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast("int").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(looks_like_marks).alias("text"),
    )
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat_format.format_turns(conversations, CHAT)
    return chat_format.digests(chat_format.read_turns(formatted, CHAT))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with totals over the prefixes that continue it."""
    turns = prefix_trie.turns_of(table(spark, folder, "conversations"))
    base = F.expr("try_subtract(conv_id, pmod(conv_id, 100))")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    prefixes, conversations = prefix_trie.shared_prefixes(turns, base, shared, most=5)
    nodes = prefix_trie.build(prefixes, conversations)
    weighed = nodes.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("n_chars"),
            "_parent_depth": F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1),
        }
    )
    key = ["conv_id", "depth"]
    totals = prefix_trie.subtree_totals(weighed, key, ["parent_conv_id", "_parent_depth"], ["n_leaves", "saved_tokens"])
    ends = prefix_trie.ends(prefixes, conversations)
    named = nodes.join(totals, key).join(ends, ["depth", "p", "q"], "left")
    return named.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
