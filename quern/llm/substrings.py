"""Removal of passages that occurred before, by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends after a blank where two bits of the hash are zero (in text
without blanks, before a character where seven are) and no such place lies in the LEAST bytes before. Ends depend on the
last bytes alone, so an insertion moves no later end. Chunks are equal if their 128-bit digests are. Of equal chunks the
first in the table stays; later ones go where they follow each other over LEAST_RUN bytes or more, which a passage of
over 50 words does and a chance agreement of a few words does not.

Texts are handled in batches. A batch sends each of its distinct chunks once to the shard of the digest, however often
it holds it, and gets back which of them another batch had before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from quern.llm.packed import packed, unpacked
from quern.sources.staging import staged

BATCH_BYTES = 8 << 20
SHARD_BYTES = 16 << 20
LEAST = 16
LONGEST = 4096
LEAST_RUN = 128
BLANK_BITS, OTHER_BITS = np.uint16(0x6000), np.uint16(0x7F00)
GEAR = np.random.default_rng(20240229).integers(1, 1 << 16, 256, dtype=np.uint16)
GEAR[0] = 0
PAD = 64  # zero bytes between texts: more than a hash or a rule looks back


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions of ``data`` (texts with PAD zero bytes before each) before which a chunk may end."""
    rolled = GEAR[data]
    for step in (1, 2, 4, 8):  # after each, a place has the hash of its last 2 * step bytes
        shifted = rolled.copy()
        shifted[step:] += rolled[:-step] << np.uint16(step)
        rolled = shifted
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    ends = blank & ((rolled & BLANK_BITS) == 0)
    near = np.cumsum(blank | (data == 0))
    lonely = np.zeros(len(data), bool)
    lonely[PAD:] = near[PAD:] == near[:-PAD]
    lonely[:-1] &= (data[1:] & 0xC0) != 0x80
    ends |= lonely & ((rolled & OTHER_BITS) == 0)
    count = np.cumsum(ends)
    before = np.zeros(len(data), np.int64)
    before[1:] = count[:-1]
    before[LEAST + 1 :] -= count[: -LEAST - 1]
    return np.flatnonzero(ends & (before == 0)) + 1


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(text, start, length, digest) of all chunks, text after text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(b"\0" * PAD + t for t in texts), np.uint8)
    ends = np.cumsum(sizes + PAD)
    starts = ends - sizes
    found = cuts(data)
    owner = np.searchsorted(ends, found)
    inside = (found > starts[np.minimum(owner, len(sizes) - 1)]) & (owner < len(sizes))
    found = np.unique(np.concatenate([found[inside], starts[sizes > 0], ends[sizes > 0]]))
    is_end = np.isin(found, ends[sizes > 0])
    begin, length = found[:-1][~is_end[:-1]], np.diff(found)[~is_end[:-1]]
    if len(length) and length.max() > LONGEST:
        more = [begin[length <= LONGEST]]
        for b, n in zip(begin[length > LONGEST].tolist(), length[length > LONGEST].tolist(), strict=True):
            at = b
            while at < b + n:
                more.append(np.array([at]))
                at += LONGEST
                while at < b + n and data[at] & 0xC0 == 0x80:
                    at += 1
        begin = np.sort(np.concatenate(more))
        owner = np.searchsorted(ends, begin, "right")
        length = np.minimum(np.append(begin[1:], len(data)), ends[owner]) - begin
    owner = np.searchsorted(ends, begin, "right")
    raw = data.tobytes()
    digests = [xxh3_128_digest(raw[b : b + n]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
    return owner, begin - starts[owner], length, digests


ROUTED = "place long, payload binary"


def messages(places: np.ndarray, texts: list[bytes], shards: int, name: int) -> Iterator[tuple[int, bytes]]:
    """To shards (places from 0 on) the batch's distinct chunks; to the batch itself its rows and own repetitions."""
    owner, start, length, digests = chunks(texts)
    digest = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((np.arange(len(digest)), digest[:, 1], digest[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (digest[order[1:]] != digest[order[:-1]]).any(1)
    again, first = order[~new], order[new]
    yield -1 - name, packed([places.view(np.uint64), *(x[again].astype(np.uint32) for x in (owner, start, length))])
    shard = (((digest[first, 0] >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(shard, np.arange(shards + 1))
    for s in range(shards):
        mine = first[edges[s] : edges[s + 1]]
        if len(mine):
            yield s, packed([np.array([name], np.uint64), digest[mine, 0], digest[mine, 1], *(x[mine].astype(np.uint32) for x in (owner, start, length))])


def seen_before(payloads: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """Of one shard: for each batch, its chunks that an earlier batch has."""
    parts = sorted((unpacked(p) for p in payloads), key=lambda p: int(p[0][0]))
    names = [int(p[0][0]) for p in parts]
    high, low, owner, start, length = (np.concatenate(x) for x in list(zip(*parts, strict=True))[1:])
    batch = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
    order = np.lexsort((batch, low, high))
    same = np.zeros(len(order), bool)
    same[1:] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    late = np.sort(order[same])
    edges = np.searchsorted(batch[late], np.arange(len(parts) + 1))
    for k, name in enumerate(names):
        mine = late[edges[k] : edges[k + 1]]
        if len(mine):
            yield -1 - name, packed([np.empty(0, np.uint64), owner[mine], start[mine], length[mine]])


def spans(payloads: list[bytes]) -> pa.Table:
    """Of one batch: place and byte spans to remove, for every text that has some."""
    parts = [unpacked(p) for p in payloads]
    places = np.concatenate([p[0] for p in parts]).view(np.int64)
    owner, start, length = (np.concatenate(x).astype(np.int64) for x in list(zip(*parts, strict=True))[1:])
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], (start + length)[order]
    head = np.ones(len(owner), bool)
    head[1:] = (owner[1:] != owner[:-1]) | (start[1:] != end[:-1])
    firsts = np.flatnonzero(head)
    lasts = np.append(firsts[1:], len(owner)) - 1
    keep = end[lasts] - start[firsts] >= LEAST_RUN if len(firsts) else np.empty(0, bool)
    owner, start, end = owner[firsts[keep]], start[firsts[keep]], end[lasts[keep]]
    texts, at = np.unique(owner, return_index=True)
    ends = np.append(at, len(owner))[1:]
    pairs = [[{"start": int(a), "end": int(b)} for a, b in zip(start[i:j], end[i:j], strict=True)] for i, j in zip(at, ends, strict=True)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.table({"place": pa.array(places[texts], pa.int64()), "spans": pa.array(pairs, kind)})


def repeated_spans(rows: DataFrame) -> DataFrame:
    """place, spans: byte spans of ``rows`` (place, text) that repeat something earlier in the table."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first().bytes or 0
    shards = max(1, math.ceil(total / SHARD_BYTES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        places: list[int] = []
        texts: list[bytes] = []
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for place, payload in messages(np.array(places, np.int64), texts, shards, (task << 24) | number):
                yield pa.RecordBatch.from_arrays([pa.array([place]), pa.array([payload], pa.binary())], names=["place", "payload"])

        for batch in batches:
            for place, text in zip(batch.column("place").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                places.append(place)
                texts.append(text)
                size += len(text) + PAD
                if size >= BATCH_BYTES:
                    yield from emit()
                    places, texts, size, number = [], [], 0, number + 1
        if texts:
            yield from emit()

    def at_shard(group: pa.Table) -> pa.Table:
        payloads, place = [p.as_py() for p in group["payload"]], group["place"][0].as_py()
        out = list(seen_before(payloads)) if place >= 0 else [(place, p) for p in payloads]
        return pa.table({"place": pa.array([p for p, _ in out], pa.int64()), "payload": pa.array([b for _, b in out], pa.binary())})

    def at_batch(group: pa.Table) -> pa.Table:
        return spans([p.as_py() for p in group["payload"]])

    sent = rows.mapInArrow(cut, ROUTED).groupBy("place").applyInArrow(at_shard, ROUTED)
    return sent.groupBy("place").applyInArrow(at_batch, "place long, spans array<struct<start: long, end: long>>")


def without_repeats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (all of ``docs`` as a struct), ``kept`` (the text that stays) and ``spans`` (what went).

    Spans are (start, length) in characters of the text, ascending; none: an empty list. A null text stays null, an
    empty one empty. A copy of a whole earlier text keeps nothing. Repeated rows are texts like others; ids play no
    part. Texts are used whole; an empty table gives no rows. Rows are known by their place, so ``docs`` must come in the
    same order when read again, as tables do.
    """
    # The text travels once, inside the row.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("place"))
    text = F.col("row")[text_col]
    found = staged(repeated_spans(whole.select("place", F.coalesce(text, F.lit("")).alias("text"))), "repeated-spans")
    # One plan at every size: the table of spans grows with the corpus, so it is never broadcast.
    joined = whole.join(found.hint("merge"), "place", "left")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = [], []
            for text, cut in zip(batch.column("text"), batch.column("spans"), strict=True):
                if cut.as_py() is None or text.as_py() is None:
                    texts.append(text.as_py())
                    gone.append([])
                    continue
                raw, at, rest, out, chars = text.as_py().encode(), 0, [], [], 0
                for span in cut.as_py():
                    before, piece = raw[at : span["start"]].decode(), raw[span["start"] : span["end"]].decode()
                    rest.append(before)
                    chars += len(before)
                    out.append({"start": chars, "length": len(piece)})
                    chars, at = chars + len(piece), span["end"]
                texts.append("".join(rest) + raw[at:].decode())
                gone.append(out)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(gone, kind)], names=["row", "kept", "spans"])

    schema = T.StructType([joined.schema["row"], *T.StructType.fromDDL("kept string, spans array<struct<start: long, length: long>>")])
    return joined.select("row", text.alias("text"), "spans").mapInArrow(kept, schema)
