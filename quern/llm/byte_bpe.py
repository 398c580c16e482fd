"""Byte-level BPE: encoding as rounds over padded matrices, and decoding.

A text is split by the vocabulary's pattern. The distinct pieces of a slice of texts are put into matrices, one for
each piece length, a row a piece and a column a byte. In each round every row merges its leftmost pair of least rank;
ranks of pairs come from a hash table in numpy arrays. Rows without a mergeable pair leave the matrix, the others move
up by one column. Pieces that a worker has met before come from a table of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quern.llm.frames import id_and_text, slices

# The splitting pattern that the rank files come with; ``\s`` is Unicode's White_Space.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NONE = np.iinfo(np.int32).max
ENCODED = "id long, ids array<int>"


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[0], ... starts[0] + lengths[0] - 1, starts[1], ... in one array."""
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return shift + np.arange(ends[-1] if len(ends) else 0)


class PairRanks:
    """Hash table (left id, right id) -> id of the merged token, in two arrays with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(4 * len(merged)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        keys = self.key(left, right)
        place = self.place(keys)
        waiting = np.arange(len(keys))
        while len(waiting):
            free = waiting[self.keys[place[waiting]] == -1]
            _, first = np.unique(place[free], return_index=True)
            put = free[first]
            self.keys[place[put]], self.values[place[put]] = keys[put], merged[put]
            waiting = np.setdiff1d(waiting, put, assume_unique=True)
            place[waiting] = (place[waiting] + 1) & self.mask

    @staticmethod
    def key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, NONE for pairs that do not merge; any shape."""
        keys = self.key(left, right).ravel()
        place = self.place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.values[place], NONE)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            place[open_] = (place[open_] + 1) & self.mask
            held = self.keys[place[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[place[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out.reshape(np.shape(left))


class ByteBpe:
    """Encoder and decoder of one rank file; ``widest`` bounds the matrices' columns."""

    def __init__(self, path: str, pattern: str = SPLIT_PATTERN, widest: int = 256, kept: int = 400_000):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.split = regex.compile(pattern).findall
        self.widest, self.kept = widest, kept
        pairs = [
            (self.ranks[t[:k]], self.ranks[t[k:]], r)
            for t, r in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.pairs = PairRanks(table[:, 0], table[:, 1], table[:, 2])
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        spelled = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            spelled[rank] = token
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_length = np.array([len(t) for t in spelled], np.int64)
        self.spelled_start = np.cumsum(self.spelled_length) - self.spelled_length
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.start, self.length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of token ids of one length -> (ids row after row, number of ids of each row)."""
        count, width = rows.shape
        done, sizes = np.empty((count, width), np.int32), np.full(count, width, np.int64)
        alive, tokens = np.arange(count), rows.astype(np.int32)
        ranks = self.pairs.find(tokens[:, :-1], tokens[:, 1:])
        while tokens.shape[1] > 1 and len(alive):
            at = ranks.argmin(1)
            best = np.take_along_axis(ranks, at[:, None], 1)[:, 0]
            stuck = best == NONE
            if stuck.any():
                done[alive[stuck], : tokens.shape[1]] = tokens[stuck]
                sizes[alive[stuck]] = tokens.shape[1]
                go = ~stuck
                alive, tokens, ranks, at, best = alive[go], tokens[go], ranks[go], at[go], best[go]
                if not len(alive):
                    break
            n, wide = tokens.shape
            row = np.arange(n)
            rest = np.arange(wide - 1)
            tokens = np.where(rest > at[:, None], tokens[:, 1:], tokens[:, :-1])
            tokens[row, at] = best
            if wide > 2:
                ranks = np.where(rest[:-1] > at[:, None], ranks[:, 1:], ranks[:, :-1])
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self.pairs.find(tokens[before, at[before] - 1], tokens[before, at[before]])
                after = np.flatnonzero(at < wide - 2)
                ranks[after, at[after]] = self.pairs.find(tokens[after, at[after]], tokens[after, at[after] + 1])
        if len(alive):
            done[alive, : tokens.shape[1]] = tokens
            sizes[alive] = tokens.shape[1]
        keep = np.arange(width) < sizes[:, None]
        return done[keep], sizes

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one piece that is too long for a matrix, by a heap over linked positions."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.find(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        spelled = lambda t: self.spelled[self.spelled_start[t] : self.spelled_start[t] + self.spelled_length[t]].tobytes()
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] == left else n
            if j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else n
                if b < n and (r := self.ranks.get(spelled(ids[a]) + spelled(ids[b]))) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [t for t in ids if t >= 0]

    def learn(self, pieces: list[str]) -> None:
        """Encode new distinct pieces and keep their ids."""
        encoded = [p.encode() for p in pieces]
        whole = [self.ranks.get(p, -1) for p in encoded]
        lengths = np.array([len(p) for p in encoded], np.int64)
        known = np.array(whole, np.int64) >= 0
        sizes, parts, order = [], [], []
        order.append(np.flatnonzero(known))
        parts.append(np.array(whole, np.int32)[known])
        sizes.append(np.ones(len(order[0]), np.int64))
        for width in np.unique(lengths[~known]):
            rows = np.flatnonzero((lengths == width) & ~known)
            if width > self.widest:
                for row in rows:
                    ids = np.array(self.merge_long(encoded[row]), np.int32)
                    order.append(np.array([row]))
                    parts.append(ids)
                    sizes.append(np.array([len(ids)]))
                continue
            data = np.frombuffer(b"".join(encoded[r] for r in rows), np.uint8).reshape(len(rows), width)
            ids, size = self.merge_rows(self.of_byte[data])
            order.append(rows)
            parts.append(ids)
            sizes.append(size)
        order, sizes = np.concatenate(order), np.concatenate(sizes)
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        base = len(self.start)
        start, length = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        start[order], length[order] = starts, sizes
        self.flat = np.concatenate([self.flat, *parts])
        self.start, self.length = np.append(self.start, start), np.append(self.length, length)
        self.slot.update(zip(pieces, range(base, base + len(pieces)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts in one array, and the number of ids of each text."""
        split = [self.split(t) for t in texts]
        if len(self.slot) > self.kept:
            self.forget()
        slot = self.slot
        new = {p for pieces in split for p in pieces if p not in slot}
        if new:
            self.learn(list(new))
        counts = np.array([len(p) for p in split], np.int64)
        slots = np.fromiter((slot[p] for pieces in split for p in pieces), np.int64, int(counts.sum()))
        lengths = self.length[slots]
        ids = self.flat[ragged(self.start[slots], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)]
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell."""
        return self.spelled[ragged(self.spelled_start[ids], self.spelled_length[ids])].tobytes()


@lru_cache(maxsize=2)
def codec(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids of every row, as the rank file at ``ranks`` merges its text; no special tokens.

    ``ranks`` is a file that every executor finds at that path. A null text counts as empty and gives no ids. Texts of
    any length are encoded whole; null and repeated ids are kept row by row; an empty table gives no rows. Other
    columns are ignored, whatever their names. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in slices(batches):
            ids, sizes = bpe.encode(batch.column("text").to_pylist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), lists], names=["id", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ENCODED).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id") -> DataFrame:
    """id, ids and the bytes they spell, as ``decoded``; null ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        for batch in batches:
            lists = batch.column("ids")
            values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            spelled = [bpe.decode(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spelled, pa.binary())], names=["id", "ids", "decoded"])

    rows = encoded.selectExpr(f"`{id_col}` as id", "coalesce(ids, array()) as ids")
    return rows.mapInArrow(run, f"{ENCODED}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, and SHA-256 in hex of the ids (decimal, joined by blanks) and of the bytes they decode to.

    Encoder and decoder as in ``encode`` and ``decode``, one after the other in a task, so that ids of all texts need
    not travel. Cases as there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks)
        numbers = [b"%d" % i for i in range(len(bpe.spelled_length))]
        for batch in slices(batches):
            ids, sizes = bpe.encode(batch.column("text").to_pylist())
            ends = np.cumsum(sizes)
            parts = [ids[e - n : e] for n, e in zip(sizes, ends, strict=True)]
            listed = [hashlib.sha256(b" ".join([numbers[i] for i in part.tolist()])).hexdigest() for part in parts]
            spelled = [hashlib.sha256(bpe.decode(part)).hexdigest() for part in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(listed), pa.array(spelled)],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
