"""CSV whose quoted values hold line breaks, read in as many tasks as the files have splits.

A split may begin inside a quoted value. A first pass says of every split in which state it ends, outside or inside a
quoted value, for either state at its start. These small functions are composed along each file, which gives the true
state at every start. In the second pass each split joins its lines to records from there; a record that reaches into
other splits leaves one piece in each, and the pieces are put together by a shuffle of at most two rows a split.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Ends = Callable[[str], tuple[int, int]]


def line_ends(delimiter: str, quote: str, escape: str) -> Ends:
    """Of a line: 1 if it ends inside a quoted value, else 0; when begun outside, and when begun inside.

    As for Spark's reader, a quote sign opens a value only as its first character.
    """
    d, q, e = (re.escape(sign) for sign in (delimiter, quote, escape))
    body = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+" if q == e else f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
    field = f"(?:{q}{body}{q}[^{d}]*+|(?!{q})[^{d}]*+)"
    opened = f"{q}{body}" + ("" if q == e else f"(?:{e})?+")
    from_outside = re.compile(f"(?:{field}{d})*+{opened}", re.S)
    from_inside = re.compile(f"{body}(?:{q}[^{d}]*+(?:{d}{field})*+{d}{opened}|" + ("" if q == e else f"(?:{e})?+") + ")", re.S)

    def ends(line: str) -> tuple[int, int]:
        if quote not in line:
            return 0, 1
        return int(from_outside.fullmatch(line) is not None), int(from_inside.fullmatch(line) is not None)

    return ends


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """value, file (a hash of its path) and block (where the split begins) of every line, in the order of the split."""
    place = (F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return spark.read.option("lineSep", "\n").text(path).select("value", *place)


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], list[str]]]:
    """The lines of a batch by split; a split's lines follow each other."""
    places = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), strict=True))
    values, start = batch.column("value").to_pylist(), 0
    for k in range(1, len(places) + 1):
        if k == len(places) or places[k] != places[start]:
            yield places[start], values[start:k]
            start = k


def split_states(lines: DataFrame, quote: str, ends: Ends) -> DataFrame:
    """file, block and state: the splits that end in another state than the one before them in their file ended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: dict[tuple[int, int], tuple[int, int]] = {}
        for batch in batches:
            for place, values in _by_split(batch):
                outside, inside = told.get(place, (0, 1))
                for value in values:
                    step = ends(value)
                    outside, inside = step[outside], step[inside]
                told[place] = outside, inside
        rows = [(*place, *states) for place, states in told.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "outside", "inside"), r, strict=True)) for r in rows], schema)

    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("outside", pa.int32()), ("inside", pa.int32())])
    told = lines.where(F.col("value").contains(quote)).mapInArrow(run, "file long, block long, outside int, inside int")
    # One row a split: a split forgets the state before it, keeps it or turns it over.
    along = Window.partitionBy("file").orderBy("block")
    told = told.withColumn("turns", F.sum(F.when(F.col("outside") > F.col("inside"), 1).otherwise(0)).over(along))
    told = told.withColumn("set", F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns")))
    last = F.last("set", ignorenulls=True).over(along)
    state = F.coalesce(last["outside"], F.lit(0)) + F.col("turns") - F.coalesce(last["turns"], F.lit(0))
    told = told.select("file", "block", (state % 2).cast("int").alias("state"))
    before = F.lag("state", 1, 0).over(along)
    return told.withColumn("before", before).where("state <> before").drop("before")


def records(spark: SparkSession, path: str | list[str], delimiter: str, quote: str, escape: str) -> DataFrame:
    """``record``: the records of the files without the first of each, which is the header; empty lines are passed over.

    The driver holds two numbers for a split that ends in another state than the one before; Spark's own plan of the
    scan, which it holds anyway, has more for each split.
    """
    lines, ends = _lines(spark, path), line_ends(delimiter, quote, escape)
    told: dict[int, list[tuple[int, int]]] = {}
    for r in split_states(lines, quote, ends).orderBy("file", "block").collect():
        told.setdefault(r["file"], []).append((r["block"], r["state"]))
    known = spark.sparkContext.broadcast(told)

    def begins(file: int, block: int) -> int:
        changes = known.value.get(file, [])
        before = bisect_left(changes, (block, 0))
        return changes[before - 1][1] if before else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, state, head, first = None, [], 0, False, False

        def row(opened: bool) -> tuple:
            """A record or piece: ``tail`` begins a record that the split does not end, ``head`` goes on with one."""
            return (*place, first, head, opened, "\n".join(held))

        for batch in batches:
            out = []
            for new, values in _by_split(batch):
                if new != place:
                    if held:
                        out.append(row(True))
                    place, held, state, first = new, [], begins(*new), new[1] == 0
                    head = state == 1
                for value in values:
                    held.append(value)
                    state = ends(value)[state]
                    if not state:
                        out.append(row(False))
                        held, head, first = [], False, False
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row(True), strict=True))], schema)

    schema = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("first", pa.bool_()), ("head", pa.bool_()), ("open", pa.bool_()), ("record", pa.string())])
    parts = lines.mapInArrow(run, "file long, block long, first boolean, head boolean, open boolean, record string")
    whole = parts.where("not head and not open").select("first", "record")
    # Pieces of a record: one that begins it, those of splits inside it, one that ends it.
    begun = F.when(~F.col("head"), 1).otherwise(0)
    along = Window.partitionBy("file").orderBy("block", F.col("head").desc())
    pieces = parts.where("head or open").withColumn("number", F.sum(begun).over(along))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda p: p["record"])
    glued = pieces.groupBy("file", "number").agg(F.bool_or("first").alias("first"), F.array_join(texts, "\n").alias("record"))
    every = whole.union(glued.select("first", "record")).where("not first")
    return every.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record <> ''")


def read_quoted_csv(
    spark: SparkSession, path: str | list[str], schema: str, *, delimiter: str = ",", quote: str = '"', escape: str = "\\"
) -> DataFrame:
    """CSV with a header whose quoted values may hold delimiters and line breaks; one file is read by many tasks.

    Values are parsed by Spark's own CSV parser, record by record, with its rules for empty and malformed ones. Signs
    are single characters. The files are read twice and must not change in between.
    """
    options = {"sep": delimiter, "quote": quote, "escape": escape}
    parsed = records(spark, path, delimiter, quote, escape).select(F.from_csv("record", schema, options).alias("row"))
    return parsed.select("row.*")
