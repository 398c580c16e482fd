"""Multinomial naive Bayes: fitted by joins and aggregates, applied as a sparse product.

One fit gives a model per entity and one over all rows under ``*``: the counts
of the latter are the sums of the former, so the texts are tokenised once.
Only pairs of class and word that occur are stored. A document's score is

    log prior + n_known * log_default + sum(log_theta - log_default)

over its words that the model knows. Documents are scored in slices of bounded size: the matrix of a slice's word counts
is multiplied with what each word adds to each class. A model of bounded size is broadcast; of a larger one, its most
frequent words are, and the few other words of the documents are joined with the model as rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.operators.relational import lookup_with_default
from quern.operators.skew import hot_keys, salted_join
from quern.sources.staging import staged

ALL = "*"
# Words of the documents that are scored together; a single document may have more.
BLOCK_WORDS = 1 << 18
# A model with more words, over all its classes, is not broadcast whole (some 50 MB).
BROADCAST_WORDS = 1 << 21
# So many words, over all its classes, are broadcast of a larger model.
COMMON_WORDS = 1 << 20
# Products added up at once.
PRODUCTS = 1 << 22


@dataclass(frozen=True)
class BayesModel:
    """``classes``: entity, label, place (among the entity's labels), docs, words, rows (distinct words), vocabulary,
    log_prior, log_default.

    ``theta``: entity, label, place, word, n, log_theta, gain (over log_default).
    """

    classes: DataFrame
    theta: DataFrame


def fit(
    docs: DataFrame,
    words: Column,
    label: str,
    *,
    entity: str | None = None,
    smoothing: float = 1.0,
    prior_smoothing: float | None = None,
    terms: DataFrame | None = None,
) -> BayesModel:
    """Count and smooth. ``prior_smoothing`` defaults to ``smoothing``; 0 leaves class shares as they are.

    ``terms`` (a vocabulary of limited size) restricts the words.
    """
    if prior_smoothing is None:
        prior_smoothing = smoothing
    own = F.lower(F.col(entity)) if entity else F.lit(ALL)
    rows = docs.select(own.alias("entity"), F.col(label).alias("label"), F.explode(words).alias("word"))
    if terms is not None:
        rows = rows.join(F.broadcast(terms.select("word")), "word", "left_semi")
    counts = rows.groupBy("entity", "label", "word").agg(F.count("*").alias("n"))
    sizes = docs.groupBy(own.alias("entity"), F.col(label).alias("label")).agg(F.count("*").alias("docs"))
    counts = staged(counts, "bayes-counts")
    if entity:
        pooled = counts.groupBy("label", "word").agg(F.sum("n").alias("n"))
        pooled = staged(pooled.withColumn("entity", F.lit(ALL)), "bayes-pooled")
        counts = counts.unionByName(pooled)
        together = sizes.groupBy("label").agg(F.sum("docs").alias("docs"))
        sizes = sizes.unionByName(together.withColumn("entity", F.lit(ALL)))
    return smoothed(counts, sizes, smoothing, prior_smoothing)


def fit_folds(
    docs: DataFrame, words: Column, label: str, fold: str, k: int, *, smoothing: float = 1.0, prior_smoothing: float | None = None
) -> BayesModel:
    """One model per fold 1..k (its number is the entity), trained on the other folds.

    The texts are counted once: the counts of a training set are those of all rows minus the fold's own.
    """
    rows = docs.select(F.col(fold).alias("fold"), F.col(label).alias("label"), F.explode(words).alias("word"))
    own = staged(rows.groupBy("fold", "label", "word").agg(F.count("*").alias("n")), "fold-counts")
    own_sizes = docs.groupBy(F.col(fold).alias("fold"), F.col(label).alias("label")).agg(F.count("*").alias("docs"))

    def others(parts: DataFrame, keys: list[str], n: str) -> DataFrame:
        whole = parts.groupBy(*keys).agg(F.sum(n).alias("_all"))
        asked = whole.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(k))))
        rest = asked.join(parts, ["fold", *keys], "left").withColumn(n, F.col("_all") - F.coalesce(n, F.lit(0)))
        return rest.where(F.col(n) > 0).select(F.col("fold").cast("string").alias("entity"), *keys, n)

    counts = staged(others(own, ["label", "word"], "n"), "bayes-counts")
    return smoothed(counts, others(own_sizes, ["label"], "docs"), smoothing, smoothing if prior_smoothing is None else prior_smoothing)


def smoothed(counts: DataFrame, sizes: DataFrame, smoothing: float, prior_smoothing: float) -> BayesModel:
    """The model of counted words (entity, label, word, n) and documents (entity, label, docs)."""
    totals = counts.groupBy("entity", "label").agg(F.sum("n").alias("words"), F.count("*").alias("rows"))
    breadth = (
        counts.groupBy("entity", "word")
        .agg(F.lit(1).alias("one"))
        .groupBy("entity")
        .agg(F.count("*").alias("vocabulary"))
    )
    # A few rows per entity: one per class.
    per_entity = Window.partitionBy("entity")
    lam = F.lit(float(smoothing))
    mass = F.col("words") + lam * F.col("vocabulary")
    classes = (
        sizes.join(totals, ["entity", "label"], "left")
        .na.fill(0, ["words", "rows"])
        .join(breadth, "entity")
        .select(
            "entity",
            "label",
            (F.row_number().over(per_entity.orderBy("label")) - 1).alias("place"),
            "docs",
            "words",
            "rows",
            "vocabulary",
            F.log(
                (F.col("docs") + F.lit(float(prior_smoothing)))
                / (F.sum("docs").over(per_entity) + F.lit(float(prior_smoothing)) * F.count("*").over(per_entity))
            ).alias("log_prior"),
            F.log(lam / mass).alias("log_default"),
        )
    )
    classes = staged(classes, "bayes-classes")
    # A class may hold most of all words: its rows are dealt by word.
    on = ["entity", "label"]
    asked = classes.select(*on, "place", "words", "vocabulary", "log_default")
    theta = salted_join(counts, asked, on, hot_keys(classes, on, "rows"), F.col("word"))
    theta = theta.withColumn("log_theta", F.log((F.col("n") + lam) / mass))
    return BayesModel(classes, theta.select(*on, "place", "word", "n", "log_theta", (F.col("log_theta") - F.col("log_default")).alias("gain")))


class Gains:
    """What words add to classes, by model and word, in arrays."""

    def __init__(self, table: pa.Table):
        """``table``: entity, place, word, gain."""
        entity, word = (table[c].combine_chunks().dictionary_encode() for c in ("entity", "word"))
        self.entities, self.terms = entity.dictionary, word.dictionary
        pair = entity.indices.to_numpy().astype(np.int64) * len(word.dictionary) + word.indices.to_numpy()
        order = np.argsort(pair, kind="stable")
        self.pair, self.place, self.gain = pair[order], table["place"].to_numpy()[order].astype(np.int64), table["gain"].to_numpy()[order]

    def known(self, entities: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of models and words; -1: unknown."""
        told = (pc.fill_null(pc.index_in(asked, known), -1) for asked, known in ((entities, self.entities), (terms, self.terms)))
        return tuple(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in told)


@dataclass(frozen=True)
class BayesWeights:
    """A model laid out for scoring; fill it once and use it for any number of batches.

    ``classes``: one row per model with its ``layout``, the sorted classes. ``words``: model_entity, word and ``gains``,
    what the word adds to the score of the classes that have it; ``common`` has that of the most frequent ones,
    broadcast. Of a small model ``small`` has all of it, broadcast, with the layouts. ``breadth``: the largest number of
    classes of a model.
    """

    words: DataFrame | None
    classes: DataFrame
    breadth: int
    label: T.DataType
    small: Broadcast | None
    common: Broadcast | None = None


def weights(model: BayesModel) -> BayesWeights:
    """Only sizes reach the driver, and BROADCAST_WORDS words of the model at most."""
    layout = F.array_sort(F.collect_list(F.struct("label", "log_prior", "log_default"))).alias("layout")
    size = model.classes.agg(F.sum("rows").alias("rows"), F.max("place").alias("place")).first()
    label = model.classes.schema["label"].dataType
    breadth = 0 if size.place is None else size.place + 1
    classes = model.classes.groupBy(F.col("entity").alias("model_entity")).agg(layout)
    context = classes.sparkSession.sparkContext
    if (size.rows or 0) <= BROADCAST_WORDS:
        layouts = {r.model_entity: r.layout for r in classes.collect()}
        told = Gains(model.theta.select("entity", "place", "word", "gain").toArrow())
        return BayesWeights(None, classes.drop("layout"), breadth, label, context.broadcast((told, layouts)))
    gains = F.collect_list(F.struct("place", "gain")).alias("gains")
    # Eighths of powers of two: a few hundred steps whatever the counts.
    step = F.floor(F.log2(F.sum("n")) * 8).cast("int").alias("step")
    words = staged(model.theta.groupBy(F.col("entity").alias("model_entity"), "word").agg(gains, step), "bayes-weights")
    cut, total = None, 0
    for r in words.groupBy("step").agg(F.sum(F.size("gains")).alias("rows")).orderBy(F.desc("step")).collect():
        total += r.rows
        if total > COMMON_WORDS:
            break
        cut = r.step
    often = words.where(F.col("step") >= F.lit(cut)).select(F.col("model_entity").alias("entity"), "word", F.inline("gains"))
    common = context.broadcast(Gains(often.select("entity", "place", "word", "gain").toArrow()))
    return BayesWeights(words.drop("step"), staged(classes, "bayes-layout"), breadth, label, None, common)


def with_model(docs: DataFrame, model: BayesWeights, entity: Column) -> DataFrame:
    """Add ``model_entity``: the lower-cased entity if it has a model, else ``*``."""
    known = model.classes.select("model_entity")
    return lookup_with_default(docs, known, entity, "model_entity", ALL)


def _added(owner: np.ndarray, pair: np.ndarray, count: np.ndarray, docs: int, gains: Gains, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known words, sums per class) of ``docs`` documents: their cells times the gains of the pair; whether a cell has any."""
    first, last = np.searchsorted(gains.pair, pair, "left"), np.searchsorted(gains.pair, pair, "right")
    known, sums = np.bincount(owner, count * (last > first), docs), np.zeros(docs * width)
    edges = np.concatenate([[0], np.cumsum(last - first)])
    start = 0
    while width and start < len(owner):
        stop = min(len(owner), max(start + 1, int(np.searchsorted(edges, edges[start] + PRODUCTS))))
        size = (last - first)[start:stop]
        cell = np.repeat(np.arange(start, stop), size)
        entry = np.arange(len(cell)) - np.repeat(np.cumsum(size) - size, size) + first[cell]
        sums += np.bincount(owner[cell] * width + gains.place[entry], count[cell] * gains.gain[entry], len(sums))
        start = stop
    return known, sums.reshape(docs, width), last > first


def _slices(batch: pa.RecordBatch, gains: Gains, width: int, most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, pa.ListArray]]:
    """The rows of a batch (key, model_entity, words) in slices of ``most`` words, one row at least.

    Each with its known words, its sums per class, and the words and counts that ``gains`` does not have.
    """
    lists = batch.column("words")
    edges = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    word = lists.flatten().dictionary_encode()
    terms = word.dictionary.cast(pa.string())
    entity, term = gains.known(batch.column("model_entity").cast(pa.string()), terms)
    many, start = max(1, len(terms)), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(edges, edges[start] + most, "right")) - 1)
        owner = np.repeat(np.arange(stop - start), np.diff(edges[start : stop + 1]))
        number = word.indices.slice(edges[start], edges[stop] - edges[start]).to_numpy()
        cells, count = np.unique(owner * many + number, return_counts=True)
        owner, number = cells // many, cells % many
        mine, told = entity[start:stop][owner], term[number]
        pair = np.where((mine >= 0) & (told >= 0), mine * len(gains.terms) + told, -1)
        known, sums, found = _added(owner, pair, count, stop - start, gains, width)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner[~found], minlength=stop - start))]).astype(np.int32)
        rest = pa.StructArray.from_arrays([terms.take(pa.array(number[~found])), pa.array(count[~found].astype(np.int64))], names=["word", "count"])
        yield batch.slice(start, stop - start), known, sums, pa.ListArray.from_arrays(pa.array(ends), rest)
        start = stop


def _by_small(rows: DataFrame, model: BayesWeights, schema: T.StructType) -> DataFrame:
    """Scores of ``rows`` (key, model_entity, words) with a broadcast model: nothing is shuffled."""
    sent, width, kind, most = model.small, model.breadth, to_arrow_schema(schema), BLOCK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, layouts = sent.value
        for batch in batches:
            for part, known, sums, _ in _slices(batch, gains, width, most):
                asked = part.column("model_entity").cast(pa.string())
                mine = [layouts.get(m, []) for m in asked.to_pylist()]
                labels = [[c["label"] for c in layout] for layout in mine]
                told = [[c["log_prior"] + known[k] * c["log_default"] + sums[k, i] for i, c in enumerate(layout)] for k, layout in enumerate(mine)]
                arrays = [part.column("key"), asked, pa.array(labels, kind.field("labels").type), pa.array(told, pa.list_(pa.float64()))]
                yield from pa.table(arrays, schema=kind).to_batches()

    return rows.mapInArrow(run, schema)


def _by_rows(rows: DataFrame, model: BayesWeights, schema: T.StructType) -> DataFrame:
    """Scores of ``rows`` (key, model_entity, words) with a model of any size.

    Tasks add up the frequent words; the others become rows, which meet the model in a join and are added up per document.
    """
    sent, width, most = model.common, model.breadth, BLOCK_WORDS
    fields = T.StructType.fromDDL("known double, sums array<double>, rest array<struct<word: string, count: long>>")
    parts = T.StructType([T.StructField("row", T.LongType()), schema["key"], schema["model_entity"], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, number = sent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, known, sums, rest in _slices(batch, gains, width, most):
                lists = pa.ListArray.from_arrays(pa.array((np.arange(len(sums) + 1) * width).astype(np.int32)), pa.array(sums.ravel()))
                row = pa.array(np.arange(number, number + part.num_rows))
                arrays = [row, part.column("key"), part.column("model_entity").cast(pa.string()), pa.array(known.astype(float)), lists, rest]
                yield pa.RecordBatch.from_arrays(arrays, names=parts.names)
                number += part.num_rows

    told = staged(rows.mapInArrow(run, parts), "bayes-parts")
    asked = told.select("row", "model_entity", F.inline("rest")).join(model.words, ["model_entity", "word"])
    # Place -1 counts the words that the model knows.
    one = F.array(F.struct(F.lit(-1).alias("place"), F.lit(1.0).alias("gain")))
    cells = asked.select("row", "count", F.inline(F.concat(F.col("gains").cast("array<struct<place: int, gain: double>>"), one)))
    sums = cells.groupBy("row", "place").agg(F.sum(F.col("count") * F.col("gain")).alias("sum"))
    more = sums.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "sum"))).alias("more"))
    whole = told.drop("rest").join(more, "row", "left").join(model.classes, "model_entity", "left")
    extra = lambda place: F.coalesce(F.try_element_at("more", place), F.lit(0.0))
    known = F.col("known") + extra(F.lit(-1))
    score = lambda c, i: c["log_prior"] + known * c["log_default"] + F.get("sums", i) + extra(i)
    layout = F.coalesce("layout", F.array().cast(model.classes.schema["layout"].dataType))
    return whole.select("key", "model_entity", F.transform(layout, lambda c: c["label"]).alias("labels"), F.transform(layout, score).alias("scores"))


def _scored(docs: DataFrame, key: str, words: Column, model: BayesWeights, entity: str | None = None) -> DataFrame:
    """key, model_entity and ``scored``, an array of (label, score) in the order of labels."""
    own = F.col("model_entity") if entity is None else F.lit(entity)
    rows = docs.select(F.col(key).alias("key"), own.cast("string").alias("model_entity"), words.alias("words"))
    fields = [T.StructField("key", rows.schema["key"].dataType), T.StructField("model_entity", T.StringType())]
    schema = T.StructType([*fields, T.StructField("labels", T.ArrayType(model.label)), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    found = _by_small(rows, model, schema) if model.small else _by_rows(rows, model, schema)
    scored = F.arrays_zip(F.col("labels").alias("label"), F.col("scores").alias("score"))
    return found.select(F.col("key").alias(key), "model_entity", scored.alias("scored"))


def scores(docs: DataFrame, key: str, words: Column, model: BayesWeights, entity: str | None = None) -> DataFrame:
    """Per document and class: ``score`` (log joint); ``key`` may be a struct.

    All documents use the model of ``entity``; without one, each the model named in its column ``model_entity``.
    """
    return _scored(docs, key, words, model, entity).select(key, "model_entity", F.inline("scored"))


def classify(docs: DataFrame, key: str, words: Column, model: BayesWeights, entity: str | None = None) -> DataFrame:
    """``key, model_entity, prediction, score``, the best class of the row; equal scores go to the first label."""
    ranked = F.transform("scored", lambda c: F.struct((-F.round(c["score"], 6)).alias("loss"), c["label"].alias("label")))
    best = _scored(docs, key, words, model, entity).select(key, "model_entity", F.array_min(ranked).alias("b"))
    return best.select(key, "model_entity", F.col("b.label").alias("prediction"), (-F.col("b.loss")).alias("score"))
