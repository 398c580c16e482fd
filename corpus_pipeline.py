"""From raw documents to packed training sequences: five stages, each over all rows the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import jaccard_join, language, quality, substrings
from quern.llm.queries import packed
from quern.sources.staging import staged
from quern.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are like no language of the documents' own ``lang`` column go."""
    told = language.identify(docs, language.fit(docs))
    return told.where("not rejected").select("row.*")


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go; ``n_chars`` follows the text."""
    told = substrings.without_repeats(docs)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return told.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document cut into sequences of a power of two."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

# A trained classifier, a rolling hash and a tokenizer are no SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
