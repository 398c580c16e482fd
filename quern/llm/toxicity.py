"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are its distinct character n-grams (four to seven signs, lower-case letters, words set off by
blanks), hashed to a fixed number of places. A feature's value is its log-count ratio: how much likelier it is in toxic
texts than in others, smoothed. Features whose ratio is well above chance enter a logistic regression with ridge
penalty, so a feature weighs as much as Bayes suggests and the data confirm.

Training uses a bounded sample of labelled rows (ROWS_PER_LABEL of each label); rows are weighted so that labels keep
the shares they have among all labelled rows of the given documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.frames import map_texts, sampled_rows
from quern.llm.language import letters
from quern.sources.staging import staged

BITS = 20
ORDERS = (4, 5, 6, 7)
ROWS_PER_LABEL = 5000
SMOOTHING = 1.0
# A feature is used if its log-count ratio is so many standard errors from 0, the best MOST_FEATURES of them.
LEAST_Z = 3.0
MOST_FEATURES = 1 << 15
RIDGE = 1e-4
STEPS = 150


def features(text: str) -> Iterator[np.ndarray]:
    """Hashed places of the text's n-grams, one array for each order; repeated ones are still there."""
    signs = letters(text)
    for order in ORDERS:
        n = len(signs) - order + 1
        if n < 1:
            return
        mixed = np.full(n, np.uint32(order * 0x01000193), np.uint32)
        for k in range(order):
            mixed = (mixed ^ signs[k : k + n]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        yield mixed >> np.uint32(32 - BITS)


@dataclass
class Classifier:
    """Weight of every place (0: not used) and the intercept; 4 MB whatever the data."""

    weights: np.ndarray
    intercept: float


def solved(rows: list[np.ndarray], toxic: np.ndarray, weight: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on binary features times ``ratio``, by limited-memory BFGS; weights sum to 1."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.concatenate(rows) if rows else np.empty(0, np.int64)
    value, size = ratio[column], len(ratio)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = np.bincount(owner, value * x[column], len(rows)) + x[-1]
        chance = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        error = weight * (chance - toxic)
        slope = np.append(np.bincount(column, value * error[owner], size) + RIDGE * x[:-1], error.sum())
        fit_loss = weight @ (np.logaddexp(0, margin) - toxic * margin)
        return float(fit_loss + RIDGE / 2 * (x[:-1] @ x[:-1])), slope

    x = np.zeros(size + 1)
    now, slope = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, kept = slope.copy(), []
        for s, y in reversed(past):
            a = (s @ way) / (s @ y)
            kept.append(a)
            way -= a * y
        if past:
            s, y = past[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(kept), strict=True):
            way += (a - (y @ way) / (s @ y)) * s
        step, gain = 1.0 if past else 1.0 / max(1.0, np.abs(slope).sum()), slope @ way
        while True:
            new, new_slope = loss(x - step * way)
            if new <= now - 1e-4 * step * gain or step < 1e-10:
                break
            step /= 2
        s, y = -step * way, new_slope - slope
        x, done, now, slope = x + s, now - new < 1e-9, new, new_slope
        if done:
            break
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y)]
    return x[:-1], float(x[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """Classifier from the texts of ``docs`` that ``labels`` (id and 0 or 1) names, ROWS_PER_LABEL a label at most.

    Rows with a null id, another label or no document in ``docs`` are not used; a null text counts as empty. A repeated
    label row counts in the labels' shares, but teaches once; of several texts with one id the least teaches. With one label only, or none, every score is that label's share (0.5 without rows).
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
    known = staged(known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi"), "toxicity-labels")
    total = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(total) < 2:
        share = sum(k * v for k, v in total.items()) / max(1, sum(total.values())) if total else 0.5
        return Classifier(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    # ROWS_PER_LABEL documents a label at most, and as many rows: a document's first text, should it have several.
    picked = sampled_rows(known, "toxic", ROWS_PER_LABEL, "id")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), "id")
    sample = staged(texts.groupBy("id", "toxic").agg(F.min("text").alias("text")).select("toxic", "text"), "toxicity-sample")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for label, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for places in features(text):
                    seen[label, np.unique(places)] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["place", "n0", "n1"])

    tallies = sample.mapInArrow(tally, "place long, n0 long, n1 long").groupBy("place").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    m0, m1 = sizes.get(0, 0), sizes.get(1, 0)
    p1 = (F.col("n1") + SMOOTHING) / (m1 + 2 * SMOOTHING)
    p0 = (F.col("n0") + SMOOTHING) / (m0 + 2 * SMOOTHING)
    scored = tallies.withColumn("ratio", F.log(p1 / p0)).withColumn("z", F.abs("ratio") / F.sqrt(1 / (F.col("n1") + SMOOTHING) + 1 / (F.col("n0") + SMOOTHING)))
    best = scored.where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "place").limit(MOST_FEATURES).select("place", "ratio").toArrow()
    place, ratio = best["place"].to_numpy(), best["ratio"].to_numpy()
    column = np.full(1 << BITS, -1, np.int32)
    column[place] = np.arange(len(place))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                hits = [column[p] for p in features(text)]
                hits = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int32)
                found.append(hits[hits >= 0])
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "columns"])

    matrix = sample.mapInArrow(chosen, "toxic int, columns array<int>").toArrow()
    toxic = matrix["toxic"].to_numpy().astype(float)
    rows = [np.asarray(r.values) for r in matrix["columns"]]
    everyone = total[0] + total[1]
    weight = np.where(toxic == 1, total[1] / everyone / max(m1, 1), total[0] / everyone / max(m0, 1))
    beta, bias = solved(rows, toxic, weight, ratio)
    weights = np.zeros(1 << BITS, np.float32)
    weights[place] = beta * ratio
    return Classifier(weights, bias)


def score(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (all of ``docs`` as a struct) and score, 0 to 1, higher: toxic is likelier.

    A null text counts as empty; empty texts get the intercept's score. Texts are read whole, rows are kept one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: list[str]) -> list[pa.Array]:
        known = shared.value
        margins = np.full(len(texts), known.intercept)
        for k, text in enumerate(texts):
            hits = [p[known.weights[p] != 0] for p in features(text)]
            if hits:
                margins[k] += known.weights[np.unique(np.concatenate(hits))].sum(dtype=np.float64)
        return [pa.array(1 / (1 + np.exp(-np.clip(margins, -700, 700))))]

    return map_texts(docs, text_col, predict, "score double")
