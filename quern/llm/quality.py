"""Quality rules whose limits come from the data: one quantile sketch per language, source and measure.

A sketch is a histogram over buckets that do not depend on the data (values below 1024 exactly, larger ones by their
first ten binary digits), so sketches of parts of the data add up to the sketch of the whole, and the same rows give
the same limits on any layout. Sketches of a source with few documents are replaced by those of its language, and these
by those of everything. A measure passes between ``q25 - 3 * spread`` and ``q75 + 3 * spread``, where the spread is the
distance of the quartiles and never below a floor.

DataFrame functions only. Words are counted inside the row; what is shuffled are bucket counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.functions.binding import let
from quern.sources.staging import staged

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# Measures and the least spread each is given: thousandths of characters, of lines, of words; hundredths of a character.
FLOORS = {"symbol_share": 10, "dup_line_share": 150, "repeat_share": 100, "word_length": 60}
FENCE = 3
LEAST_DOCUMENTS = 100
# A table of limits with at most so many rows (about 100 bytes each) is broadcast; a longer one is joined by shuffle.
BROADCAST_GROUPS = 50_000
SALTS = 16
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _word_list(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), p - F.get(places, i - 1))))
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def repeated(windows: Column) -> Column:
        numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(rows: Column) -> Column:
            def same(row: Column, k: Column) -> Column:
                return F.coalesce(F.get(rows, k)["h"] == row["h"], F.lit(False))

            again = F.filter(rows, lambda row, k: same(row, k - 1) | same(row, k + 1))
            return let(F.sort_array(F.transform(again, lambda row: row["i"])), covered)

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(numbered, twice))

    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    return let(first, lambda w: let(F.transform(w, lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2))), repeated))


def counted(docs: DataFrame, text_col: str = "text", name: str = "counts") -> DataFrame:
    """``docs`` with a struct column ``name`` of the COUNTS of each whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(" \t\x0b\x0c\r")) != "")
    return docs.withColumn(name, let(_word_list(text), counts))


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])


def measures(counts: Column) -> dict[str, Column]:
    """Whole numbers, so that buckets and limits are exact; null where there is nothing to divide by."""

    def share(part: str, whole: str, times: int) -> Column:
        return F.floor(counts[part] * times / F.nullif(counts[whole], F.lit(0))).cast("long")

    return {
        "symbol_share": share("n_symbols", "word_chars", 1000),
        "dup_line_share": share("n_dup_lines", "n_lines", 1000),
        "repeat_share": share("n_repeat_words", "n_words", 1000),
        "word_length": share("word_chars", "n_words", 100),
    }


def bucket(value: Column) -> Column:
    """The least value of the bucket that holds ``value`` (0 or more)."""
    drop = F.greatest(F.length(F.bin(value)) - 10, F.lit(0))
    size = F.pow(F.lit(2.0), drop).cast("long")
    return value - value % size


def sketches(rows: DataFrame, lang: str, source: str, counts: str = "counts") -> DataFrame:
    """lang, source, measure, bucket, n: the sketches of the documents that pass the base rules."""

    def passed(c: Column) -> Column:
        kinds = F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("value")) for m, v in measures(c).items()])
        return F.when(~base_failed(c), kinds)

    # No filter on the counts: it would be moved below their computation, which would then be made twice.
    values = rows.select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.inline(let(F.col(counts), passed)))
    return values.where("value is not null").groupBy("lang", "source", "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"))


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Sketches with the given keys out of finer ones."""
    return parts.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(parts: DataFrame, *keys: str) -> DataFrame:
    """keys, measure, n, q25, q75 of every sketch; a sketch has a bounded number of buckets."""
    all_ = W.partitionBy(*keys, "measure")
    run = parts.withColumn("upto", F.sum("n").over(all_.orderBy("bucket"))).withColumn("total", F.sum("n").over(all_))
    return run.groupBy(*keys, "measure").agg(
        F.max("total").alias("n"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q25"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q75"),
    )


def limits(parts: DataFrame) -> DataFrame:
    """lang, source and a map measure -> (low, high) for every language and source of the sketches."""
    own = quartiles(parts, "lang", "source").withColumnsRenamed({"n": "n0", "q25": "a0", "q75": "b0"})
    by_lang = merged(parts, "lang")
    lang = quartiles(by_lang, "lang").select(F.col("lang").alias("lang1"), F.col("measure").alias("measure1"), F.col("n").alias("n1"), F.col("q25").alias("a1"), F.col("q75").alias("b1"))
    every = quartiles(merged(by_lang)).select(F.col("measure").alias("measure2"), F.col("q25").alias("a2"), F.col("q75").alias("b2"))
    rows = own.join(lang, F.col("lang").eqNullSafe(F.col("lang1")) & (F.col("measure") == F.col("measure1"))).join(every, F.col("measure") == F.col("measure2"))

    def pick(kind: str) -> Column:
        return F.when(F.col("n0") >= LEAST_DOCUMENTS, F.col(f"{kind}0")).when(F.col("n1") >= LEAST_DOCUMENTS, F.col(f"{kind}1")).otherwise(F.col(f"{kind}2"))

    floors = F.create_map(*[F.lit(x) for pair in FLOORS.items() for x in pair])
    picked = rows.select("lang", "source", "measure", pick("a").alias("q25"), pick("b").alias("q75"))
    spread = F.greatest(F.col("q75") - F.col("q25"), floors[F.col("measure")])
    bounds = F.struct((F.col("q25") - FENCE * spread).alias("low"), (F.col("q75") + FENCE * spread).alias("high"))
    entries = F.collect_list(F.struct("measure", bounds.alias("bounds")))  # one entry a measure
    return picked.groupBy("lang", "source").agg(F.map_from_entries(entries).alias("bounds"))


def judged(rows: DataFrame, bounds: DataFrame, groups: int, lang: str, source: str, counts: str = "counts") -> DataFrame:
    """``rows`` with booleans ``base_failed`` and ``kept``; ``groups`` is the number of rows of ``bounds``.

    Up to BROADCAST_GROUPS rows of limits are broadcast. Beyond, both sides are shuffled, every limit to SALTS places,
    so that the documents of one large source do not meet in one task.
    """
    if groups <= BROADCAST_GROUPS:
        there, salt = F.broadcast(bounds.withColumn("_salt", F.lit(0))), F.lit(0)
    else:
        there = bounds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(F.col(counts)), F.lit(SALTS)).cast("int")
    there = there.withColumnsRenamed({"lang": "_lang", "source": "_source", "bounds": "_bounds"})
    same = F.col(lang).eqNullSafe(F.col("_lang")) & F.col(source).eqNullSafe(F.col("_source")) & (salt == F.col("_salt"))
    inside = F.lit(True)
    for measure, value in measures(F.col(counts)).items():
        limit = F.col("_bounds")[measure]
        inside = inside & F.coalesce(value.between(limit["low"], limit["high"]), F.lit(True))
    failed = base_failed(F.col(counts))
    # One CASE, so that no part of the verdict is moved below the join and the counts are made once.
    kept = F.when(failed, F.lit(False)).otherwise(inside)
    return rows.join(there, same, "left").withColumn("base_failed", failed).withColumn("kept", kept).drop("_lang", "_source", "_bounds", "_salt")


def document_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: id, lang, source, the COUNTS, base_failed and kept.

    A null or empty text has no words and fails the base rules. Null languages and sources are groups of their own.
    Null and repeated ids are kept row by row; an empty table gives no rows; other columns are ignored. A document on a
    limit passes. Texts are read once: their counts are written to the shared folder, the rest works on those.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = staged(counted(narrow).drop("text"), "quality-counts")
    bounds = staged(limits(sketches(rows, "lang", "source")), "quality-limits")
    told = judged(rows, bounds, bounds.count(), "lang", "source")
    return told.select(F.col("id").alias(id_col), F.col("lang").alias(lang_col), F.col("source").alias(source_col), *[F.col("counts")[c].alias(c) for c in COUNTS], "base_failed", "kept")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Counts are made twice, for the sketches and for the verdict, so that no text is shuffled or written. Cases as in
    ``document_quality``; added columns have names that ``docs`` does not use.
    """
    narrow = docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    bounds = staged(limits(sketches(counted(narrow), "lang", "source")), "quality-limits")
    told = judged(
        counted(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))),
        bounds, bounds.count(), "lang", "source",
    )
    return told.where("kept").select("row.*")
