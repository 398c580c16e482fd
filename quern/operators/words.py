"""Word rows, word counts, vocabularies and term weights."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.binding import let
from quern.sources.staging import staged

# Words that ``coded`` counts together in a task; a single row may have more.
SLICE_WORDS = 1 << 18


def explode_words(df: DataFrame, words: Column, keep: list[str] | None = None) -> DataFrame:
    """One row per word; ``keep`` lists the parent columns to repeat (default: none)."""
    return df.select(*(keep or []), F.explode(words).alias("word"))


def word_counts(df: DataFrame, words: Column, keys: list[str] | None = None) -> DataFrame:
    """Occurrences per word (and keys); counted in the map tasks before the shuffle."""
    keys = keys or []
    return explode_words(df, words, keys).groupBy(*keys, "word").agg(F.count("*").alias("count"))


def vocabulary(df: DataFrame, words: Column, size: int, min_df: int = 1) -> DataFrame:
    """The ``size`` most frequent words found in at least ``min_df`` rows: word, n, df.

    Words are counted inside the row first, so a row sends each word once. Equal counts go by word.
    """
    counted = (
        df.select(F.inline(counted_words(words)))
        .groupBy("word")
        .agg(F.sum("count").alias("n"), F.count("*").alias("df"))
    )
    return counted.where(F.col("df") >= min_df).orderBy(F.desc("n"), "word").limit(size)


def counts_by_part(df: DataFrame, words: str, part: str) -> DataFrame:
    """``part, word, n, df``: occurrences of every word and rows that hold it, by the column ``part``.

    Tasks count a slice of words at a time and send each word of a slice once; a null array is empty.
    """
    schema = T.StructType([df.schema[part], *T.StructType.fromDDL("word string, n long, df long")])
    most = SLICE_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, size in slices(batches, words, most):
            coded = batch.column(words).flatten().dictionary_encode()
            owner = np.repeat(np.arange(batch.num_rows), size)
            kinds = batch.column(part).dictionary_encode("encode")
            wide = max(1, len(coded.dictionary))
            pairs, count = np.unique(owner * wide + coded.indices.to_numpy(), return_counts=True)
            cell = kinds.indices.to_numpy()[pairs // wide] * wide + pairs % wide
            cells, place, rows = np.unique(cell, return_inverse=True, return_counts=True)
            n = np.bincount(place, count, len(cells)).astype(np.int64)
            found = [kinds.dictionary.take(pa.array(cells // wide)), coded.dictionary.take(pa.array(cells % wide)), pa.array(n), pa.array(rows.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(found, names=schema.names)

    sent = df.select(part, words).mapInArrow(run, schema)
    return sent.groupBy(part, "word").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def top_words_outside(df: DataFrame, words: str, part: str, parts: int, size: int, min_df: int = 1) -> DataFrame:
    """``word``, ascending: the vocabularies (see ``vocabulary``) of all rows and of the rows outside each ``part`` together.

    ``part`` is 0..parts-1. Words are counted in one pass; the result has at most ``size`` * (``parts`` + 1) rows.
    """
    counts = counts_by_part(df, words, part)
    inside = [F.col(part) == k for k in range(parts)]
    sums = [F.sum(F.when(here, F.col(c))).alias(f"{c}{k}") for k, here in enumerate(inside) for c in ("n", "df")]
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("df").alias("df"), *sums)
    counts = staged(counts.where(F.col("df") >= min_df).na.fill(0), "word-counts")

    def top(n: Column, rows: Column) -> DataFrame:
        return counts.select("word", n.alias("n"), rows.alias("df")).where(F.col("df") >= min_df).orderBy(F.desc("n"), "word").limit(size)

    tops = [top(F.col("n"), F.col("df"))]
    tops += [top(F.col("n") - F.col(f"n{k}"), F.col("df") - F.col(f"df{k}")) for k in range(parts)]
    return reduce(DataFrame.union, tops).select("word").distinct().orderBy("word")


def counted_words(words: Column) -> Column:
    """Sorted (word, count) pairs of an array of words: sorted, then cut where the word changes."""

    def folded(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        heads = F.filter(places, lambda i: ~F.coalesce(F.get(ordered, i - 1) == F.get(ordered, i), F.lit(False)))

        def pairs(starts: Column) -> Column:
            return F.transform(
                starts,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("word"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start).cast("long").alias("count"),
                ),
            )

        return let(heads, pairs)

    # Without words sequence(0, -1) would run backwards.
    return let(F.sort_array(words), lambda ordered: F.when(F.size(ordered) > 0, folded(ordered)))


def slices(batches: Iterator[pa.RecordBatch], lists: str, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows in slices whose ``lists`` have at most ``most`` elements together (or one row), and the size of each list."""
    for batch in batches:
        size = pc.fill_null(pc.list_value_length(batch.column(lists)), 0).to_numpy(zero_copy_only=False)
        edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(edges, edges[start] + most, "right")) - 1)
            yield batch.slice(start, stop - start), np.diff(edges[start : stop + 1])
            start = stop


def coded(df: DataFrame, words: str, terms: list[str]) -> DataFrame:
    """``df`` with ``features`` and ``values`` for the array column ``words``: places in ``terms``, ascending, and counts.

    Words that are no terms are passed over, a null array is empty. The terms are broadcast.
    """
    sent = df.sparkSession.sparkContext.broadcast(terms)
    schema = T.StructType([*df.drop(words).schema, *T.StructType.fromDDL("features array<int>, `values` array<int>")])
    keep = df.drop(words).columns

    most = SLICE_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.string())
        for batch, size in slices(batches, words, most):
            yield counted(batch, size, known)

    def counted(batch: pa.RecordBatch, size: np.ndarray, known: pa.Array) -> pa.RecordBatch:
        place = pc.fill_null(pc.index_in(batch.column(words).flatten(), known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), size)
        both, count = np.unique((owner * (len(known) + 1) + place)[place >= 0], return_counts=True)
        ends = np.concatenate([[0], np.cumsum(np.bincount(both // (len(known) + 1), minlength=batch.num_rows))]).astype(np.int32)
        arrays = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (both % (len(known) + 1), count)]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], names=schema.names)

    return df.mapInArrow(run, schema)


def term_counts(df: DataFrame, key: str, words: Column, terms: DataFrame | None = None) -> DataFrame:
    """``key, word, count`` rows: the bag of words as a table, counted inside the row; ``key`` is unique.

    ``terms`` is a vocabulary of limited size; it is broadcast. Nothing is shuffled.
    """
    rows = df.select(key, F.inline(counted_words(words)))
    return rows if terms is None else rows.join(F.broadcast(terms.select("word")), "word", "left_semi").select(key, "word", "count")


def bag_of(df: DataFrame, key: str, words: Column, size: int, min_df: int = 1) -> tuple[DataFrame, DataFrame]:
    """The bag restricted to its vocabulary, and the vocabulary (which is of limited size, and written once).

    The bag itself is neither written nor shuffled; texts are read for the vocabulary and again for the bag.
    """
    terms = staged(vocabulary(df, words, size, min_df), "vocabulary")
    return term_counts(df, key, words, terms), terms


def tf_idf(counts: DataFrame, key: str, terms: DataFrame, documents: DataFrame) -> DataFrame:
    """count * ln((N + 1) / (df + 1)); ``terms`` is a vocabulary of limited size with ``df``."""
    n = documents.agg(F.count("*").alias("n")).scalar()
    idf = terms.select("word", F.log((n + 1) / (F.col("df") + 1)).alias("idf"))
    return counts.join(F.broadcast(idf), "word").select(
        key, "word", "count", (F.col("count") * F.col("idf")).alias("tf_idf")
    )
