"""The operators applied to the given tables, each next to its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import byte_bpe, conversation_trie, hard_negatives, jaccard_join, language, main_text, near_vectors, ngram_lm, packing, quality, substrings, suffix_dedup, toxicity
from quern.llm.frames import id_remainder
from quern.llm.twins import HARD_NEGATIVES, PREFIXES, QUALITY, VECTORS
from quern.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return add


@query("op1_substring_dedup")
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has."""
    told = substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return told.select("row.doc_id", F.col("kept").alias("text"), removed.alias("n_removed"), "spans")


@query("op2_near_vectors", VECTORS)
def near_vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label with a cosine of 0.98 or more."""
    return near_vectors.near_classes(table(spark, sf_dir, "embeddings"))


@query("op3_quality_rules", QUALITY)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    told = quality.document_quality(table(spark, sf_dir, "documents"))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_main_text")
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


@query("op5_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    told = toxicity.score(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return told.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of the rows that have one."""
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = language.fit(docs.where(~held_out))
    told = language.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return told.select("row.doc_id", "row.held_out", "lang_pred", "score")


@query("op7_jaccard_join")
def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with near-equal shingle sets."""
    return jaccard_join.classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_byte_bpe")
def byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with digests of the ids and of the bytes."""
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_RANKS)


@query("op9_ngram_lm")
def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 7) == 2
    told = ngram_lm.score_corpus(docs, ~held_out)
    return told.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op10_packing")
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into sequences of a power of two, at most 1024 ids."""
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    parts = packing.pack(docs, BYTE_TOKENIZER)
    return parts.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op11_conversation_trie", PREFIXES)
def shared_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes of the conversations, each of which begins with turns of the one that its twenty belong to."""
    source, heads = F.expr("conv - conv % 20"), F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"), source, heads)


@query("op12_suffix_dedup")
def texts_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a repeated string of 400 bytes covers."""
    told = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    size = F.octet_length(F.coalesce(F.col("row.text"), F.lit(""))).cast("long")
    return told.select(
        "row.doc_id",
        size.alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op13_hard_negatives", HARD_NEGATIVES)
def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh vector has the next label."""
    label = F.expr("if(vec_id % 7 = 0, (cast(label as long) + 1) % 10, cast(label as long))")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)
