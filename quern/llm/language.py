"""Language identification by the nearest of several centroids per language.

A text becomes a vector of its character n-grams (one to three letters, words set off by blanks), hashed to a fixed
number of places, weighted by tf-idf and set to length one. Each language has a few centroids: the clusters of its
sampled texts by cosine. A text takes the language of the centroid with the largest cosine and is rejected where that
cosine falls below the language's limit, which follows from the cosines of its own sampled texts.

Training uses a bounded sample of labelled texts (ROWS_PER_LANGUAGE); a language's texts are clustered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.frames import map_texts, sampled_rows
from quern.sources.staging import staged

PLACES = 1 << 15
ROWS_PER_LANGUAGE = 600
CENTROIDS = 4
ROUNDS = 8
# A text is rejected below this part of the cosine that 99 % of its language's sampled texts reach.
REJECT_PART = 0.5
UNKNOWN = "und"
FACTORS = np.array([[0x9E3779B1, 0, 0], [0x85EBCA77, 0xC2B2AE3D, 0], [0x27D4EB2F, 0x165667B1, 0x2545F491]], np.uint32)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, a blank for everything else."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        sign = chr(point)
        if sign.isalpha():
            low = sign.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str) -> np.ndarray:
    """Code points of the lower-case letters; one blank between words and at both ends."""
    signs = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    word = signs != 32
    keep = word.copy()
    keep[1:] |= word[:-1]
    blank = np.full(1, 32, np.uint32)
    signs = np.concatenate([blank, signs[keep], blank])
    return signs[:-1] if len(signs) > 2 and signs[-2] == 32 else signs


def counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None without a letter."""
    signs = letters(text)
    if (signs == 32).all():
        return None
    total = np.zeros(PLACES, np.int64)
    for order, factors in enumerate(FACTORS, 1):
        n = len(signs) - order + 1
        if n < 1:
            continue
        mixed = np.full(n, np.uint32(order * 0x01000193), np.uint32)
        for k in range(order):
            mixed += signs[k : k + n] * factors[k]
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        total += np.bincount(mixed >> np.uint32(32 - 15), minlength=PLACES)
    return total


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def clustered(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means over unit rows -> (centroids, index of each row's centroid); starts at far rows."""
    centers = unit_rows(rows.mean(0, keepdims=True))
    nearest = rows @ centers[0]
    picked = [int(nearest.argmax())]
    while len(picked) < min(k, len(rows)):
        nearest = (rows @ rows[picked].T).max(1)
        picked.append(int(nearest.argmin()))
    centers = rows[picked]
    for _ in range(ROUNDS):
        home = (rows @ centers.T).argmax(1)
        centers = unit_rows(np.stack([rows[home == c].mean(0) if (home == c).any() else centers[c] for c in range(len(centers))]))
    return centers, (rows @ centers.T).argmax(1)


@dataclass
class Centroids:
    """Fitted model: idf per place; unit centroids, their languages and limits. Bounded by languages x CENTROIDS."""

    idf: np.ndarray
    centers: np.ndarray
    langs: list[str]
    limits: np.ndarray


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Centroids from ROWS_PER_LANGUAGE rows a language at most that have a text and a language.

    Rows equal in id and text are one; no rows give a model that knows no language.
    """
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, places, times = [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if (row := counts(text)) is not None:
                    at = np.flatnonzero(row)
                    langs.append(lang)
                    places.append(at.astype(np.int32))
                    times.append(row[at].astype(np.int32))
            arrays = [pa.array(langs, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "places", "times"])

    sample = sampled_rows(known, "lang", ROWS_PER_LANGUAGE, "id", "text")
    sparse = staged(sample.mapInArrow(vectors, "lang string, places array<int>, times array<int>"), "language-sample")
    documents = sparse.count()
    idf = np.full(PLACES, np.log(1 + documents) + 1, np.float32)
    for place, n in sparse.select(F.explode("places").alias("place")).groupBy("place").count().collect():
        idf[place] = np.log((1 + documents) / (1 + n)) + 1

    def centroids(rows: pd.DataFrame) -> pd.DataFrame:
        matrix = np.zeros((len(rows), PLACES), np.float32)
        for k, (places, times) in enumerate(zip(rows["places"], rows["times"], strict=True)):
            matrix[k, places] = times
        matrix = unit_rows(matrix * idf)
        centers, home = clustered(matrix, CENTROIDS)
        bound = REJECT_PART * float(np.quantile((matrix * centers[home]).sum(1), 0.01))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "center": [c.tolist() for c in centers], "bound": bound})

    found = sparse.groupBy("lang").applyInPandas(centroids, "lang string, center array<float>, bound double").collect()
    found.sort(key=lambda r: (r.lang, r.center))
    centers = np.array([r.center for r in found], np.float32).reshape(-1, PLACES)
    return Centroids(idf, centers, [r.lang for r in found], np.array([r.bound for r in found]))


def identify(docs: DataFrame, model: Centroids, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (all of ``docs`` as a struct), lang_pred, score (cosine, 0 to 1) and rejected.

    ``und`` with score 0, rejected: a null text, one without a letter, or a model that knows no language. Ties go to
    the language first in the alphabet. Texts are read whole; rows are kept one by one, repeated ones too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(texts: list[str]) -> list[pa.Array]:
        known = shared.value
        langs, scores, rejected = [], [], []
        for start in range(0, len(texts), 128):
            rows = [counts(t) for t in texts[start : start + 128]]
            found = [k for k, row in enumerate(rows) if row is not None and len(known.langs)]
            names, values, out = [UNKNOWN] * len(rows), [0.0] * len(rows), [True] * len(rows)
            if found:
                matrix = np.stack([rows[k] for k in found]).astype(np.float32) * known.idf
                cosines = unit_rows(matrix) @ known.centers.T
                best = cosines.argmax(1)
                for k, c, cosine in zip(found, best, cosines[np.arange(len(best)), best], strict=True):
                    names[k], values[k], out[k] = known.langs[c], min(1.0, float(cosine)), bool(cosine < known.limits[c])
            langs += names
            scores += values
            rejected += out
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())]

    return map_texts(docs, text_col, predict, "lang_pred string, score double, rejected boolean")
