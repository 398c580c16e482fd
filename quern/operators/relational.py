"""Small relational building blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.prefix import SLOT, positions, quantile_slots
from quern.operators.skew import hot_keys, salted_join
from quern.sources.staging import staged


def all_but(df: DataFrame, *names: str) -> list[str]:
    """Column names except the given ones (labels, keys)."""
    return [c for c in df.columns if c not in names]


def top(df: DataFrame, n: int, *order: Column | str, skip: int = 0) -> DataFrame:
    """The first ``n`` rows after ``skip`` in a total order: one pass, a bounded heap per task."""
    out = df.orderBy(*order).limit(n + skip)
    return out.offset(skip) if skip else out


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Frames of one layout under each other, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_values(df: DataFrame, column: str) -> list[str]:
    """Distinct values, sorted, for use as column names: they are the schema of the result.

    For columns of few values; ``flag_vectors`` takes any number.
    """
    rows = df.select(column).distinct().where(F.col(column).isNotNull()).collect()
    return sorted(r[0] for r in rows)


def membership_flags(
    df: DataFrame, list_col: str, values: list[str], skip: tuple[str, ...] = ()
) -> DataFrame:
    """One boolean column per value telling whether the list contains it."""
    flags = [F.array_contains(list_col, v).alias(v) for v in values if v not in skip]
    return df.select("*", *flags)


def numbered(values: DataFrame, name: str) -> DataFrame:
    """The distinct values of the one column ``name`` with ``code``: 0, 1, ... in the order of their bytes.

    Slots are cut by the first six bytes as a number, rows are numbered inside them; no value reaches the driver.
    """
    lead = F.conv(F.rpad(F.substring(F.hex(F.encode(name, "utf-8")), 1, 12), 12, "0"), 16, 10).cast("double")
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    marked = quantile_slots(distinct.withColumn("_lead", lead), "_lead").drop("_lead")
    places = positions(marked, name, slot=F.col(SLOT), name="_place")
    return places.select(name, (F.col("_place") - 1).alias("code"))


def flag_vectors(df: DataFrame, key: str, values: Column, skip: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """A sparse vector of flags per row instead of a column per value, for any number of values, and their dictionary.

    The first frame has ``key`` (unique in ``df``), ``size`` (of the dictionary) and ``indices``, the ascending codes of
    the distinct ``values`` in the row, none for an empty or null list. The dictionary has ``value`` and ``code``. Values
    that very many rows share are dealt to several tasks.
    """
    listed = df.select(F.col(key).alias("_key"), F.array_except(values, F.array(*[F.lit(s) for s in skip]).cast("array<string>")).alias("_values"))
    pairs = listed.select("_key", F.explode(F.array_compact("_values")).alias("value"))
    counts = pairs.groupBy("value").agg(F.count("*").alias("_n"))
    dictionary = staged(numbered(counts, "value").join(counts, "value"), "dictionary")
    coded = salted_join(pairs, dictionary.select("value", "code"), ["value"], hot_keys(dictionary, ["value"], "_n"), F.col("_key"))
    marks = coded.select("_key", "code").union(listed.select("_key", F.lit(None).cast("bigint").alias("code")))
    size = dictionary.agg(F.count("*").alias("size")).scalar()
    vectors = marks.groupBy("_key").agg(F.array_sort(F.collect_list("code")).alias("indices"))
    return vectors.select(F.col("_key").alias(key), size.alias("size"), "indices"), dictionary.select("value", "code")


def lookup_with_default(
    df: DataFrame, known: DataFrame, key: Column, name: str, default: str = "*", spread: int = 16
) -> DataFrame:
    """Add ``name``: the lower-cased key if ``known`` (one distinct column ``name``) has it, else the default.

    The few distinct keys may be held by very many rows. When adaptive execution finds ``known`` small it is broadcast;
    otherwise the rows of a key are dealt to ``spread`` tasks by a hash of the row, and ``known`` is sent to each.
    """
    deal = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    found = known.select(F.col(name).alias("_key"), deal.alias("_deal"), F.lit(True).alias("_found"))
    place = F.pmod(F.xxhash64(*df.columns), F.lit(spread)).cast("int")
    marked = df.withColumns({"_key": F.lower(key), "_deal": place}).join(found, ["_key", "_deal"], "left")
    return marked.withColumn(
        name, F.when(F.col("_found"), F.col("_key")).otherwise(F.lit(default))
    ).drop("_key", "_deal", "_found")


def ordered_text(df: DataFrame, keys: list[str], order_col: str, text_col: str, separator: str, name: str) -> DataFrame:
    """Texts of a key joined in the order of a numeric column that is unique per key: one row per key.

    The order column is cut into slots by quantiles over all rows. Texts are joined inside key and slot, then the slots
    of a key in their order, so the rows of one large key are sorted in many tasks; only its text itself is one value.
    """
    # A struct is never null itself, so texts without a key stay too.
    keyed = quantile_slots(df, order_col).withColumn("_key", F.struct(*keys))

    def glued(column: str, order: str) -> Column:
        return F.expr(f"listagg(`{column}`, {_literal(separator)}) WITHIN GROUP (ORDER BY `{order}`)")

    parts = keyed.groupBy("_key", SLOT).agg(glued(text_col, order_col).alias("_part"))
    whole = parts.groupBy("_key").agg(glued("_part", SLOT).alias(name))
    return whole.select(*[F.col("_key")[k].alias(k) for k in keys], name)


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")
    return f"'{escaped}'"
