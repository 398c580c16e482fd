"""Hard negatives for anchors, by slots between the upper limits of their positives.

An anchor's positives are its best rows of the same label. A positive with score u asks for the best rows of other labels
with scores from a share of u up to u. These windows overlap, so rows are not searched once per positive: the distinct
upper limits, descending, cut the scores into disjoint slots (u1, u0], (u2, u1], ..., and a row belongs to one slot at
most. A task keeps the best k rows per anchor and slot, tasks are merged by rank, and the best k below any upper limit
are the slots from there down, merged from the last slot upwards.

Anchors are taken in blocks of bounded size that every task gets; rows are read where they lie and never move. Only the
best k per anchor and slot leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.sources.staging import fresh_path, staged

BLOCK_BYTES = 4 << 20  # vectors of the anchors that are searched for in one pass
MATRIX = 1 << 21  # scores held at once
EXACT = 2.0**53
LEAST, MOST = -(1 << 63), (1 << 63) - 1
BEST = "anchor int, slot int, score long, id long"


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """id, label (as text) and vector of the rows that take part."""
    told = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = "x is not null and not isnan(x) and abs(x) * 256 < double('Infinity')"
    return told.where(f"id is not null and label is not null and vector is not null and forall(vector, x -> {finite})")


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: as doubles where no sum can pass 2^53, else as whole numbers held within 64 bits."""
    most = np.abs(anchors).max(initial=0) * np.abs(rows).max(initial=0) * max(1, anchors.shape[1])
    if most < EXACT:
        return anchors @ rows.T
    whole = [np.array([[int(x) for x in row] for row in side], object).reshape(side.shape) for side in (anchors, rows)]
    return np.clip(whole[0] @ whole[1].T, LEAST + 1, MOST).astype(np.int64)


class Best:
    """The best k rows per anchor and slot; higher scores first, then smaller ids."""

    def __init__(self, upper: np.ndarray, lower: np.ndarray, k: int):
        self.upper, self.lower, self.k = upper, lower, k
        self.top, self.floor = upper[:, 0], lower.min(1)
        self.worst = np.full(upper.shape, LEAST)
        self.worst_id = np.full(upper.shape, MOST)
        self.found = [np.empty(0, np.int64)] * 4
        self.new: list[list[np.ndarray]] = []

    def offer(self, anchors: np.ndarray, score: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """``score`` and ``allowed``: anchors x rows."""
        low = self.floor[anchors]
        if self.upper.shape[1] == 1:
            low = np.maximum(low, self.worst[anchors, 0])
        near = allowed & (score >= low[:, None]) & (score <= self.top[anchors, None])
        a, b = np.nonzero(near)
        s, i, a = score[a, b].astype(np.int64), ids[b], anchors[a]
        slot = (s[:, None] <= self.upper[a]).sum(1) - 1
        better = (s > self.worst[a, slot]) | ((s == self.worst[a, slot]) & (i < self.worst_id[a, slot]))
        keep = better & (s >= self.lower[a, slot])
        if keep.any():
            self.new.append([x[keep] for x in (a, slot, s, i)])
            if sum(len(n[0]) for n in self.new) > max(len(self.found[0]), 1 << 15):
                self.merge()

    def merge(self) -> None:
        a, slot, s, i = (np.concatenate(x) for x in zip(self.found, *self.new, strict=True))
        order = np.lexsort((i, -s, slot, a))
        a, slot, s, i = a[order], slot[order], s[order], i[order]
        head = np.ones(len(a), bool)
        head[1:] = (a[1:] != a[:-1]) | (slot[1:] != slot[:-1])
        rank = np.arange(len(a)) - np.maximum.accumulate(np.where(head, np.arange(len(a)), 0))
        last = rank == self.k - 1
        self.worst[a[last], slot[last]], self.worst_id[a[last], slot[last]] = s[last], i[last]
        keep = rank < self.k
        self.found, self.new = [x[keep] for x in (a, slot, s, i)], []


def search(rows: DataFrame, anchors: pa.Table, upper: np.ndarray, lower: np.ndarray, same: bool, k: int) -> DataFrame:
    """BEST rows: per anchor (its place in ``anchors``) and slot the best k rows of the same or of other labels.

    Slot j of an anchor has the scores from ``lower`` j up to ``upper`` j that are above ``upper`` j + 1.
    """
    ids = anchors["id"].to_numpy()
    labels = anchors["label"].combine_chunks().unique() if len(ids) else pa.array([], pa.string())
    label = pc.index_in(anchors["label"], labels).to_numpy()
    lists = anchors["vector"].to_pylist()
    lengths = np.array([len(v) for v in lists])
    vectors = {n: np.floor(256 * np.array([v for v in lists if len(v) == n], np.float64).reshape((lengths == n).sum(), n)) for n in set(lengths.tolist())}
    sent = rows.sparkSession.sparkContext.broadcast((ids, labels, label, lengths, vectors, upper, lower))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, label, lengths, vectors, upper, lower = sent.value
        best = Best(upper, lower, k)
        for batch in batches:
            codes = pc.fill_null(pc.index_in(batch.column("label"), labels), -1).to_numpy(zero_copy_only=False)
            row_ids, sizes = batch.column("id").to_numpy(), pc.list_value_length(batch.column("vector")).to_numpy()
            for n in set(sizes.tolist()) & set(vectors):
                mine, at = np.flatnonzero(sizes == n), np.flatnonzero(lengths == n)
                flat = batch.column("vector").take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False)
                points = np.floor(256 * flat.reshape(len(mine), n))
                step = max(1, MATRIX // len(at))
                for start in range(0, len(mine), step):
                    part = mine[start : start + step]
                    equal = label[at][:, None] == codes[part][None, :]
                    allowed = (equal == same) & (ids[at][:, None] != row_ids[part][None, :])
                    best.offer(at, scores(vectors[n], points[start : start + step]), allowed, row_ids[part])
        best.merge()
        a, slot, s, i = best.found
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(slot, pa.int32()), pa.array(s), pa.array(i)], names=["anchor", "slot", "score", "id"])

    told = rows.mapInArrow(run, BEST)
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return told.withColumn("rank", rank).where(F.col("rank") <= k)


def limits(found: list, anchors: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Upper and lower limits of the slots of each anchor from the scores of its positives."""
    distinct: list[set] = [set() for _ in range(anchors)]
    for r in found:
        distinct[r["anchor"]].add(r["score"])
    width = max(map(len, distinct), default=0) or 1
    upper, lower = np.full((anchors, width), LEAST), np.full((anchors, width), MOST)
    for a, values in enumerate(distinct):
        for j, u in enumerate(sorted(values, reverse=True)):
            upper[a, j], lower[a, j] = u, -(-percent * u // 100)
    return upper, lower


def merged(positives: list[tuple[int, int]], slots: dict[int, list[tuple[int, int]]], k: int, percent: int) -> list[tuple]:
    """(positive, rank, negative) of one anchor: suffixes of the slots, from the last one up, answer every window.

    ``positives`` and the rows of a slot are (score, id), best first; slots are numbered by descending upper limit.
    """
    best: list[tuple[int, int]] = []
    below = {}
    uppers = sorted({s for s, _ in positives}, reverse=True)
    for j in reversed(range(len(uppers))):
        best = (slots.get(j, []) + best)[:k]
        below[uppers[j]] = best
    return [(p, rank, n) for p in positives for rank, n in enumerate((x for x in below[p[0]] if percent * p[0] <= 100 * x[0]), 1)]


def mine(
    rows: DataFrame,
    anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    percent: int = 80,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the best negatives of every positive.

    ``anchor`` marks the rows to search for, ``label`` is a column of ``rows``. Components x count as floor(256 x); the
    score of two rows is the inner product of these, the order is by descending score, then by id. An anchor's positives
    are its first ``positives`` rows of its label; a positive's negatives are the first ``negatives`` rows of other
    labels whose score is at most the positive's and at least ``percent`` hundredths of it.

    Rows with a null id, label or vector, or a null or non-finite component (256 x included), take no part. Rows with
    the anchor's id are the anchor itself and no partners; repeated rows of other ids are rows like others; anchors equal
    in id, label and vector are one. Vectors of another length than the anchor's do not meet it; empty ones score 0.
    Scores beyond 64 bits count as the largest or least number. No anchors or an empty table give no rows; other columns
    are ignored.
    """
    ready = usable(rows, id_col, vector_col, label)
    asked = usable(rows.where(anchor), id_col, vector_col, label).distinct()
    told = staged(asked, "anchors")
    size = told.agg(F.sum(F.size("vector") * 8 + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    told = told.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)).cast("int"))
    spark, spots = rows.sparkSession, [fresh_path(rows.sparkSession, name) for name in ("anchor-ids", "positives", "slots")]
    for b in range(blocks):
        block = told.where(F.col("block") == b).orderBy("id", "label", "vector").toArrow()
        every = np.full((len(block), 1), MOST), np.full((len(block), 1), LEAST)
        numbered = pa.table({"anchor": pa.array(range(len(block)), pa.int32()), "anchor_id": block["id"]})
        search(ready, block, *every, True, positives).withColumn("block", F.lit(b)).write.mode("append").parquet(spots[1])
        found = spark.read.parquet(spots[1]).where(F.col("block") == b).select("anchor", "score").collect()
        upper, lower = limits(found, len(block), percent)
        search(ready, block, upper, lower, False, negatives).withColumn("block", F.lit(b)).write.mode("append").parquet(spots[2])
        spark.createDataFrame(numbered).withColumn("block", F.lit(b)).write.mode("append").parquet(spots[0])
    names, near, slots = (spark.read.parquet(p) for p in spots)
    # At most ``positives`` rows and ``positives`` x ``negatives`` rows an anchor.
    near = near.groupBy("block", "anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("near"))
    slots = slots.groupBy("block", "anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "rank", "score", "id"))).alias("slots"))
    met = names.join(near, ["block", "anchor"]).join(slots, ["block", "anchor"]).select("anchor_id", "near", "slots")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                at: dict[int, list] = {}
                for r in row["slots"]:
                    at.setdefault(r["slot"], []).append((r["score"], r["id"]))
                for p, rank, n in merged([(r["score"], r["id"]) for r in row["near"]], at, negatives, percent):
                    out.append((row["anchor_id"], p[1], rank, n[1], p[0], n[0]))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return met.mapInArrow(answer, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
