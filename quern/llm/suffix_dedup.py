"""Removal of every byte that a repeated window covers, by radix passes over suffixes cut off at the window's length.

Two suffixes repeat each other if their first ``window`` bytes are equal, so suffixes are ordered through that depth only,
by most significant digits: a pass splits the groups of suffixes by one more digit, a group of one is done and leaves, and
the groups left after the last digit are exactly the repeated windows.

* First digit: the window's minimizer, the gram with the least hash (the first of several). Equal windows have it at the
  same place, and neighbouring windows mostly share it, so suffixes travel as runs: a run is the string that its windows
  cover. Equal runs, of whole copies above all, are one run with a count, and are repeated as they stand.
* Further digits, for runs with a gram in common that differ: the windows of a run are cut at fixed distances from the
  gram into pieces, and a digit is what all windows of a piece share. Pieces get shorter from pass to pass, the last have
  one window and the digit is all of it. Pieces that are equal as a whole are repeated as they stand, like runs.

A pass is a count of digests per key (summed in the tasks first) and a join back, so a gram or passage that a third of
all documents hold is no group that anything gathers. Text is read from the table, not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from quern.sources.staging import staged

BATCH_BYTES = 8 << 20
SEGMENT = 1 << 18
PIECES = (48, 8, 1)
SIGNS = np.random.default_rng(31).integers(1, 1 << 32, 256, dtype=np.uint32)
BASE = 0x9E3779B1
RUNS = "place long, mark long, start long, windows int, at int, gram long, high long, low long, times long"
DIGITS = "high long, low long, whole long, place long, mark long, start long, number int, sure boolean, first long, windows int"
RUN_NAMES = [part.split()[0] for part in RUNS.split(", ")]
DIGIT_NAMES = [part.split()[0] for part in DIGITS.split(", ")]


def gram_length(window: int) -> int:
    return max(1, window * 4 // 25)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of the ``gram`` bytes from every place on that has so many."""
    have, out = 0, None
    power, length = SIGNS[data], 1
    while True:
        if gram & length:
            if out is None:
                out, have = power, length
            else:
                n = len(data) - have - length + 1
                out = out[:n] * np.uint32(pow(BASE, length, 1 << 32)) + power[have : have + n]
                have += length
        if 2 * length > gram:
            break
        n = len(data) - 2 * length + 1
        power = power[:n] * np.uint32(pow(BASE, length, 1 << 32)) + power[length : length + n]
        length *= 2
    out = (out ^ (out >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return out ^ (out >> np.uint32(13))


def minimizers(data: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``data``, the place of its first gram of least hash."""
    gram = gram_length(window)
    least = gram_hashes(data, gram).astype(np.uint64) << np.uint64(32)
    least |= np.arange(len(least), dtype=np.uint64)
    span, width = 1, window - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        more = width - span
        least = np.minimum(least[:-more], least[more:])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs(data: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, place of the gram) of all runs in ``data``, texts that end at ``ends``."""
    starts, counts, grams = [], [], []
    for low in range(0, len(data) - window + 1, SEGMENT):
        high = min(low + SEGMENT, len(data) - window + 1)
        place = minimizers(data[low : high + window - 1], window) + low
        whole = np.ones(high - low, bool)
        for end in ends[np.searchsorted(ends, low, "right") : np.searchsorted(ends, high + window - 1)].tolist():  # windows over an end
            whole[max(0, end - window + 1 - low) : max(0, min(end, high) - low)] = False
        head = np.ones(high - low, bool)
        head[1:] = (place[1:] != place[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(head)
        count = np.diff(np.append(first, high - low))
        real = whole[first]
        starts.append(first[real] + low)
        counts.append(count[real])
        grams.append(place[first[real]])
    if not starts:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(grams)


def batch_runs(places: list[int], marks: list[int], texts: list[bytes], window: int) -> pa.RecordBatch:
    """RUNS rows of one batch: its distinct runs, and without a gram the spans of windows it repeats itself."""
    raw = b"".join(texts)
    data, ends = np.frombuffer(raw, np.uint8), np.cumsum([len(t) for t in texts])
    start, count, gram = runs(data, ends, window)
    size = gram_length(window)
    digests = b"".join([xxh3_128_digest(raw[s : s + n]) for s, n in zip(start.tolist(), (count + (window - 1)).tolist(), strict=True)])
    digest = np.frombuffer(digests, ">i8").reshape(-1, 2).astype(np.int64)
    order = np.lexsort((np.arange(len(start)), digest[:, 1], digest[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (digest[order[1:]] != digest[order[:-1]]).any(1)
    firsts = np.flatnonzero(new)
    times = np.diff(np.append(firsts, len(order)))
    repeated = np.zeros(len(order), bool)
    repeated[order] = np.repeat(times > 1, times)
    # Neighbouring runs of a text that the batch repeats are one span.
    low, high = start[repeated], (start + count)[repeated]
    text = np.searchsorted(ends, low, "right")
    head = np.ones(len(low), bool)
    head[1:] = (low[1:] != high[:-1]) | (text[1:] != text[:-1])
    span, span_end = low[head], high[np.append(head[1:], True)] if len(low) else high
    one = order[firsts]
    begins = ends - np.array([len(t) for t in texts], np.int64)
    owner = np.concatenate([np.searchsorted(ends, span, "right"), np.searchsorted(ends, start[one], "right")])
    none = np.zeros(len(span), np.int64)
    prints = np.array([xxh3_64_intdigest(raw[g : g + size]) for g in gram[one].tolist()], np.uint64).view(np.int64)
    columns = [
        np.array(places, np.int64)[owner],
        np.array(marks, np.int64)[owner],
        np.concatenate([span, start[one]]) - begins[owner],
        np.concatenate([span_end - span, count[one]]).astype(np.int32),
        np.concatenate([none, (gram - start)[one]]).astype(np.int32),
        np.concatenate([none, prints]),
        np.concatenate([none, digest[one, 0]]),
        np.concatenate([none, digest[one, 1]]),
        np.concatenate([none, times]),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=RUN_NAMES)


def all_runs(rows: DataFrame, window: int) -> DataFrame:
    """RUNS rows of ``rows`` (place, mark, text)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: list[int] = []
        marks: list[int] = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for place, mark, text in zip(batch.column("place"), batch.column("mark"), batch.column("text").cast(pa.binary()), strict=True):
                if len(raw := text.as_py()) < window:
                    continue
                places.append(place.as_py())
                marks.append(mark.as_py())
                texts.append(raw)
                size += len(raw)
                if size >= BATCH_BYTES:
                    yield batch_runs(places, marks, texts, window)
                    places, marks, texts, size = [], [], [], 0
        if texts:
            yield batch_runs(places, marks, texts, window)

    return rows.mapInArrow(cut, RUNS)


def strings(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """place, mark, start, windows, at, sure and the bytes of the runs ``wanted``."""
    asked = wanted.groupBy("place", F.col("mark").alias("known")).agg(F.collect_list(F.struct("start", "windows", "at", "sure")).alias("runs"))
    met = rows.join(asked.hint("merge"), "place").select("place", checked("known", "mark"), "text", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for place, mark, text, found in zip(*(batch.column(c) for c in ("place", "mark", "text", "runs")), strict=True):
                raw = text.as_py().encode()
                for r in found.as_py():
                    piece = raw[r["start"] : r["start"] + r["windows"] + window - 1]
                    out.append((place.as_py(), mark.as_py(), r["start"], r["windows"], r["at"], r["sure"], piece))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            names = ["place", "mark", "start", "windows", "at", "sure", "piece"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return met.mapInArrow(cut, "place long, mark long, start long, windows int, at int, sure boolean, piece binary")


def checked(known: str, mark: str) -> Column:
    """``mark``, or a failure if the row at this place is another one than when it was read first."""
    wrong = F.raise_error(F.lit("the documents came in another order when they were read again")).cast("long")
    return F.when(F.col(known) == F.col(mark), F.col(mark)).otherwise(wrong).alias("mark")


def digits(found: DataFrame, before: int, now: int, window: int) -> DataFrame:
    """DIGITS rows: the next digit of the pieces of ``found`` (strings, with ``pieces`` or null).

    A window's offset is its gram's place in it. Piece j of a pass has the offsets from j times its length on; all windows
    of a piece share the bytes between the start of the last and the end of the first: ``high`` and ``low`` are their
    digest, ``whole`` that of all bytes of the piece. ``pieces`` are those of the pass before, null stands for all.
    ``first`` is the piece's first window, counted from the start of the text.
    """
    offsets = window - gram_length(window) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, whole, owner, numbers, firsts, counts, sures = [], [], [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("start", "piece", "at", "windows", "sure", "pieces"))
            for row, (start, raw, at, windows, sure, pieces) in enumerate(zip(*columns, strict=True)):
                low, high = at - windows + 1, at
                known = [(low, high, sure)] if pieces is None else [(max(low, p["number"] * before), min(high, p["number"] * before + before - 1), p["sure"]) for p in pieces]
                for least, most, told in known:
                    for j in range(least // now, most // now + 1):
                        longest = min(j * now + now, offsets) - 1
                        x, y = min(most, longest), max(least, j * now)
                        prints.append(xxh3_128_digest(raw[at - j * now : at - longest + window], j))
                        whole.append(xxh3_64_intdigest(raw[at - x : at - y + window], x))
                        owner.append(row)
                        numbers.append(j)
                        firsts.append(start + at - x)
                        counts.append(x - y + 1)
                        sures.append(told)
            digest = np.frombuffer(b"".join(prints), ">i8").reshape(-1, 2).astype(np.int64)
            taken = batch.select(["place", "mark", "start"]).take(pa.array(owner, pa.int64()))
            arrays = [pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(np.array(whole, np.uint64).view(np.int64)), *taken.columns]
            arrays += [pa.array(x, t) for x, t in ((numbers, pa.int32()), (sures, pa.bool_()), (firsts, pa.int64()), (counts, pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=DIGIT_NAMES)

    return found.mapInArrow(cut, DIGITS)


def repeated_pieces(found: DataFrame, window: int) -> list[DataFrame]:
    """place, mark, start, windows: what other strings repeat of the strings ``found``, by passes."""
    out, asked, before = [], found.withColumn("pieces", F.lit(None).cast("array<struct<number: int, sure: boolean>>")), 0
    for now in PIECES:
        told = staged(digits(asked.select("place", "mark", "start", "piece", "at", "windows", "sure", "pieces"), before, now, window), "digits")
        one = F.min(F.struct("place", "start", "number")).alias("one")
        classes = told.groupBy("high", "low", "whole").agg(F.count("*").alias("n"), F.bool_or("sure").alias("sure"), one)
        classes = staged(classes, "digit-classes")
        equal = classes.where("n > 1").select("high", "low", "whole")
        out.append(told.where("not sure").join(equal, ["high", "low", "whole"]).select("place", "mark", F.col("first").alias("start"), "windows"))
        if now > 1:
            # Equal pieces go on as one, and only beside others that are still open.
            open_ = F.bool_or(F.expr("n = 1 and not sure")).alias("open")
            groups = classes.groupBy("high", "low").agg(F.count("*").alias("kinds"), open_).where("kinds > 1 and open").select("high", "low")
            left = classes.join(groups, ["high", "low"]).select("one.*", F.expr("sure or n > 1").alias("sure"))
            pieces = left.groupBy("place", "start").agg(F.collect_list(F.struct("number", "sure")).alias("pieces"))
            asked, before = found.join(pieces, ["place", "start"]), now
    return out


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """place, mark, spans: (start, windows) of the repeated windows of ``rows`` (place, mark, text), in bytes, unordered."""
    told = staged(all_runs(rows, window), "runs")
    asks = told.where("times > 0")
    # A gram that one batch alone has, once, is met nowhere else.
    grams = asks.groupBy("gram").agg(F.sum("times").alias("n")).where("n > 1").select("gram")
    shared = staged(asks.join(grams, "gram"), "shared-runs")
    one = F.struct("place", "start", "mark", "windows", "at")
    classes = shared.groupBy("gram", "high", "low").agg(F.sum("times").alias("times"), F.min(one).alias("one"))
    classes = staged(classes, "run-classes")
    equal = classes.where("times > 1").select("high", "low")
    whole = shared.where("times = 1").join(equal, ["high", "low"]).select("place", "mark", "start", "windows")
    mixed = classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("times").alias("least")).where("kinds > 1 and least = 1")
    wanted = classes.join(mixed.select("gram"), "gram").select("one.*", (F.col("times") > 1).alias("sure"))
    found = staged(strings(rows, wanted, window), "strings")
    known = told.where("times = 0").select("place", "mark", "start", "windows")
    for parts in repeated_pieces(found, window):
        known = known.union(parts)
    return known.union(whole).groupBy("place", "mark").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))


def without_repeats(docs: DataFrame, window: int = 400, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (all of ``docs`` as a struct), ``kept`` (the bytes that stay) and ``spans`` (what went).

    A byte of a text's UTF-8 form goes if a string of ``window`` bytes that covers it starts anywhere else too, in the same
    text or another; the first occurrence goes as well. Strings do not cross texts and are judged on the input. Spans are
    (start, length) in bytes, ascending, apart from each other; none: an empty list. What stays need not be whole
    characters.

    A null text counts as empty; texts below ``window`` bytes stay whole. Repeated rows are texts like others; ids play no
    part. Texts are used whole, an empty table gives no rows. Rows are known by their place: if a table comes in another
    order when it is read again, the job fails.
    """
    if window < 1:
        raise ValueError("a window has one byte at least")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("place"))
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    whole = whole.withColumn("mark", F.xxhash64(text))
    spans = staged(repeated_spans(whole.select("place", "mark", text.alias("text")), window), "repeated-spans")
    # One plan at every size: the table of spans grows with the corpus, so it is never broadcast.
    joined = whole.join(spans.withColumnRenamed("mark", "known").hint("merge"), "place", "left")
    joined = joined.withColumn("known", F.coalesce("known", "mark")).select("row", text.alias("text"), checked("known", "mark"), "spans")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest, gone = [], []
            for text, found in zip(batch.column("text").cast(pa.binary()), batch.column("spans"), strict=True):
                raw, at, out, cut = text.as_py(), 0, [], []
                for span in sorted(found.as_py() or [], key=lambda s: s["start"]):
                    start, end = span["start"], span["start"] + span["windows"] + window - 1
                    if cut and start <= cut[-1]["start"] + cut[-1]["length"]:
                        cut[-1]["length"] = max(cut[-1]["length"], end - cut[-1]["start"])
                    else:
                        cut.append({"start": start, "length": end - start})
                for span in cut:
                    out.append(raw[at : span["start"]])
                    at = span["start"] + span["length"]
                rest.append(b"".join(out) + raw[at:])
                gone.append(cut)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(rest, pa.binary()), pa.array(gone, kind)], names=["row", "kept", "spans"])

    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL("kept binary, spans array<struct<start: long, length: long>>")])
    return joined.mapInArrow(kept, schema)
