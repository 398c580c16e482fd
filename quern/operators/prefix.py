"""Positions and running totals over a whole ordered table.

A window without partitions (or with one hot key) runs in a single task. Here
the order column is cut into slots whose order follows the order of the rows.
Rows are numbered or summed inside a slot, and the small table of slot totals
supplies what came before. Slots come from the caller (dates, hash prefixes) or
from quantiles of the order column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOT = "_slot"


def default_slots(spark: SparkSession) -> int:
    """Four slots per shuffle partition, so that they grow with the work; 64 at least."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def quantile_slots(df: DataFrame, order_col: str, slots: int | None = None) -> DataFrame:
    """Add a slot number with about 1/slots of the rows each.

    Only the cut points (one number a slot) reach the driver. They are
    constants of the plan, so recomputed tasks see the same slots.
    """
    slots = slots or default_slots(df.sparkSession)
    work = df.withColumn("_order", F.col(order_col).cast("double"))
    cuts = work.approxQuantile("_order", [i / slots for i in range(1, slots)], 1.0 / (4 * slots))
    inner = sorted(set(cuts))
    if not inner:
        return df.withColumn(SLOT, F.lit(0))
    edges = [float("-inf"), *inner, float("inf")]
    cut = Bucketizer(splits=edges, inputCol="_order", outputCol=SLOT, handleInvalid="keep")
    return cut.transform(work).drop("_order").withColumn(SLOT, F.col(SLOT).cast("int"))


def positions(
    df: DataFrame,
    order_col: str,
    keys: tuple[str, ...] = (),
    *,
    slot: Column | None = None,
    slots: int | None = None,
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """1-based position of every row by ``order_col`` (unique per key).

    ``slot`` must not decrease with ``order_col``. ``total`` adds the number of
    rows of the key. The join with the slot totals and the numbering inside a
    slot use the same partitioning, so the rows are shuffled once.
    """
    marked = df.withColumn(SLOT, slot) if slot is not None else quantile_slots(df, order_col, slots)
    # A struct is never null itself: rows whose key or order is null keep their group.
    marked = marked.withColumn("_group", F.struct(*keys, SLOT)).drop(SLOT)
    sizes = marked.groupBy("_group").agg(F.count("*").alias("_n"))
    # At most one row per key and slot: the window below never sees the data itself.
    per_key = Window.partitionBy(*[F.col("_group")[k] for k in keys]) if keys else Window.partitionBy(F.lit(0))
    before = per_key.orderBy(F.col("_group")[SLOT]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_group",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(per_key).alias("_total"),
    )
    if not keys and slot is None:
        offsets = F.broadcast(offsets)  # no more rows than quantile slots
    inside = Window.partitionBy("_group").orderBy(order_col)
    out = marked.join(offsets, "_group").withColumn(name, F.col("_before") + F.row_number().over(inside))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_group", "_before", "_total")


def cut_values(
    marked: DataFrame, order_col: str, keys: tuple[str, ...], places: Callable[[Column], Column]
) -> DataFrame:
    """_key (a struct of ``keys``) and ``_cuts``: the values of ``order_col`` at some positions of each key.

    ``marked`` has slots; ``places`` maps a key's number of rows to an ascending array of 1-based positions. Rows are
    counted per slot, and only the slots that hold a position are ranked. The result has one row per key.
    """
    marked = marked.select(F.struct(*keys, F.lit(0).alias("_all")).alias("_key"), SLOT, F.col(order_col).alias("_value"))
    sizes = marked.groupBy("_key", SLOT).agg(F.count("*").alias("_n"))
    per_key = Window.partitionBy("_key")
    before = per_key.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.select(
        "_key", SLOT, "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(per_key).alias("_total")
    )
    inside = F.filter(places(F.col("_total")), lambda p: (p > F.col("_before")) & (p <= F.col("_before") + F.col("_n")))
    ranks = F.transform(inside, lambda p: (p - F.col("_before")).cast("int"))
    wanted = spans.select("_key", SLOT, ranks.alias("_ranks")).where(F.size("_ranks") > 0)
    wanted = wanted.withColumn("_slot_key", F.struct("_key", SLOT)).select("_slot_key", "_ranks")
    # No more rows than keys times positions.
    rows = marked.withColumn("_slot_key", F.struct("_key", SLOT)).join(F.broadcast(wanted), "_slot_key")
    place = F.row_number().over(Window.partitionBy("_slot_key").orderBy("_value"))
    found = rows.withColumn("_place", place).where(F.array_contains("_ranks", F.col("_place")))
    return found.groupBy("_key").agg(F.sort_array(F.collect_list("_value")).alias("_cuts"))


def with_block(
    df: DataFrame, marked: DataFrame, order_col: str, keys: tuple[str, ...], places: Callable[[Column], Column], name: str
) -> DataFrame:
    """``df`` with the number of the block a row falls in: 1 up to the first cut, 2 up to the second, ...

    ``marked`` are the rows of ``df`` with slots and ``order_col``. The cuts (one row per key) are broadcast.
    """
    cuts = cut_values(marked, order_col, keys, places)
    if keys:
        joined = df.withColumn("_key", F.struct(*keys, F.lit(0).alias("_all"))).join(F.broadcast(cuts), "_key", "left")
    else:
        joined = df.withColumn("_cuts", cuts.select("_cuts").scalar()).withColumn("_key", F.lit(0))
    block = F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c < F.col(order_col))) + 1
    return joined.withColumn(name, block.cast("int")).drop("_key", "_cuts")


def running_totals(
    df: DataFrame,
    order_col: str,
    columns: dict[str, str],
    *,
    descending: bool = False,
    slots: int | None = None,
) -> DataFrame:
    """Running sums of ``columns`` (source -> new name) by a unique ``order_col``.

    The caller groups equal values of ``order_col`` first.
    """
    marked = quantile_slots(df, order_col, slots)
    direction = F.desc if descending else F.asc
    before = Window.partitionBy(F.lit(0)).orderBy(direction(SLOT)).rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(SLOT).agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    offsets = sums.select(
        SLOT,
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in columns],
    )
    inside = (
        Window.partitionBy(SLOT).orderBy(direction(order_col)).rowsBetween(Window.unboundedPreceding, 0)
    )
    out = marked.join(F.broadcast(offsets), SLOT)  # no more rows than quantile slots
    out = out.withColumns(
        {new: F.col(f"_before_{c}") + F.sum(c).over(inside) for c, new in columns.items()}
    )
    return out.drop(SLOT, *[f"_before_{c}" for c in columns])


def tile_ends(total: Column, k: int) -> Column:
    """Last positions of the first k - 1 of k blocks of ``total`` rows; the first blocks are the larger ones."""
    size, extra = F.floor(total / k), total % k
    ends = F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda j: j * size + F.least(j, extra)) if k > 1 else F.array()
    return F.array_distinct(ends)
