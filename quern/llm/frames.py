"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from quern.sources.staging import staged

# Text handled at once inside a task, in characters: a batch of longer texts is cut between rows.
SLICE_CHARS = 4_000_000
BROADCAST_DRAWS = 1 << 20


def id_remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Columns ``id`` and ``text`` (null text: empty) and ``more``; no other column of ``docs`` remains."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), *more)


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in their order, in pieces of about ``chars`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
        start = total = 0
        for row, size in enumerate(sizes):
            if row > start and total + size > chars:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        yield batch.slice(start)


def map_texts(docs: DataFrame, text_col: str, fn: Callable[[list[str]], list[pa.Array]], fields: str) -> DataFrame:
    """``docs`` as one struct column ``row`` beside the columns ``fields`` that ``fn`` makes of each slice of texts.

    Null texts come as empty ones. Whatever the columns of ``docs`` are called, nothing clashes; rows neither move
    between tasks nor change.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([whole.schema["row"], *T.StructType.fromDDL(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *fn(texts)], names=schema.names)

    return whole.mapInArrow(run, schema)


def sampled_rows(rows: DataFrame, label_col: str, per_label: int, *content: str) -> DataFrame:
    """Label and ``content`` of ``per_label`` rows of each label at most; the same ones on any layout.

    Equal rows count once, so that neither a hot id nor a text with many copies fills or empties the sample; of the
    others, those with the least hashes are taken. Hashes above twice the share that is wanted are passed over before
    they are ranked, so that no task sees the rows of a label. Labels may be many: nothing is collected, and what was
    drawn is broadcast only up to BROADCAST_DRAWS hashes. Rows without a label are not drawn.
    """
    named = [F.col(c) if isinstance(rows.schema[c].dataType, T.ArrayType) else F.col(c).cast("string") for c in content]
    marked = rows.select(label_col, *content, F.xxhash64(*named, F.lit("sample")).alias("_draw"))
    drawn = marked.select(label_col, "_draw").distinct()
    share = F.lit(2.0 * per_label + 50) / F.count("*")
    low = drawn.groupBy(label_col).agg(share.alias("_share"))
    unit = F.pmod("_draw", F.lit(1 << 30)) / F.lit(float(1 << 30))
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy(unit, "_draw"))
    chosen = drawn.join(low, label_col).where(unit < F.col("_share")).withColumn("_rank", rank).where(F.col("_rank") <= per_label)
    chosen = staged(chosen.select(label_col, "_draw"), "drawn")
    small = F.broadcast(chosen) if chosen.count() <= BROADCAST_DRAWS else chosen
    return marked.join(small, [label_col, "_draw"], "left_semi").drop("_draw").distinct()


def split_words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words between ASCII blanks -> (distinct words, number of each word in that list, words of each text).

    ``lower`` turns A-Z into a-z, nothing else.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(lists)
    empty = pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        owner = np.repeat(np.arange(len(counts)), counts)
        counts -= np.bincount(owner[empty], minlength=len(counts))
        flat = flat.filter(pa.array(~empty))
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), counts


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word."""
    return np.array([xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64)
