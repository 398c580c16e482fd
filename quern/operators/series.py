"""Ordered analytics on series indexed by a gapless integer position.

A series is cut into blocks of consecutive positions. Each block also gets
copies of the few rows around it that its windows reach into (the halo), so
every window runs inside one block: a series of any length, and one that holds
most of the rows, is spread over many tasks. Results are exact.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = 100_000


def blocked(
    df: DataFrame, t: str, keys: tuple[str, ...], before: int, after: int, block: int = BLOCK
) -> tuple[DataFrame, WindowSpec, Column]:
    """Rows with their block and halo, the window of a block, and the test for non-halo rows."""
    position = F.col(t).cast("bigint")
    # A row serves the blocks of all positions whose window reaches it.
    first = F.floor((position - before) / F.lit(block))
    last = F.floor((position + after) / F.lit(block))
    rows = df.withColumn("_block", F.explode(F.sequence(first, last)))
    window = Window.partitionBy(*keys, "_block").orderBy(t)
    own = F.col("_block") == F.floor(position / F.lit(block))
    return rows, window, own


def with_stats(df: DataFrame, keys: tuple[str, ...], stats: dict[str, Column]) -> DataFrame:
    """Add per-series aggregates to every row: a scalar subquery, or a join when there are keys."""
    summary = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    if keys:
        return df.join(summary, list(keys))
    packed = summary.select(F.struct(*stats).alias("s")).scalar()
    return df.withColumn("_s", packed).select(*df.columns, *[F.col(f"_s.{n}").alias(n) for n in stats])


def lags(
    df: DataFrame, t: str, y: str, count: int, keys: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """Columns ``lag_0`` .. ``lag_{count-1}`` next to the series, null before its start."""
    rows, window, own = blocked(df.select(*keys, t, y), t, keys, 0, count - 1, block)
    shifted = [F.lag(y, i).over(window).alias(f"lag_{i}") for i in range(count)]
    return rows.select(*keys, t, *shifted, own.alias("_own")).where("_own").drop("_own")


def _pairs(
    df: DataFrame, t: str, y: str, max_lag: int, keys: tuple[str, ...], carry: list[str], block: int
) -> DataFrame:
    """``lag, x, z`` for every value and the one ``lag`` positions later, lag 0..max_lag."""
    rows, window, own = blocked(df, t, keys, max_lag, 0, block)
    ahead = F.collect_list(F.struct(F.col(y).alias("y"))).over(window.rowsBetween(0, max_lag))
    return (
        rows.select(*keys, t, *carry, ahead.alias("_ahead"), own.alias("_own"))
        .where("_own")
        .select(*keys, t, *carry, F.col("_ahead")[0]["y"].alias("x"), F.posexplode("_ahead").alias("lag", "_z"))
        .select(*keys, t, *carry, "lag", "x", F.col("_z.y").alias("z"))
    )


def autocorrelation(
    df: DataFrame, t: str, y: str, max_lag: int = 40, keys: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """``lag, acf, band``: biased estimator with the full mean and variance, and its 95 % Bartlett band.

    ``acf`` is null for a constant series.
    """
    centred = with_stats(
        df.select(*keys, t, F.col(y).cast("double").alias("_y")), keys, {"_mean": F.avg("_y"), "_n": F.count("_y")}
    ).select(*keys, t, "_n", (F.col("_y") - F.col("_mean")).alias("_d"))
    sums = (
        _pairs(centred, t, "_d", max_lag, keys, ["_n"], block)
        .groupBy(*keys, "lag")
        .agg(F.sum(F.col("x") * F.col("z")).alias("c"), F.first("_n").alias("_n"))
    )
    # max_lag + 1 rows per series from here on.
    per_series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    zero = F.max(F.when(F.col("lag") == 0, F.col("c"))).over(per_series)
    earlier = per_series.orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    rho = sums.select(*keys, "lag", "_n", (F.col("c") / F.nullif(zero, F.lit(0.0))).alias("acf"))
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)).over(earlier)
    band = F.lit(1.959963984540054) * F.sqrt((1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("_n"))
    return rho.select(
        *keys, "lag", "acf", F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(band).alias("band")
    )


def lag_correlations(
    df: DataFrame, t: str, y: str, count: int = 40, keys: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """Pearson correlations ``i, j, r`` (i < j) of the series shifted by i and by j, over complete pairs.

    The pair (i, j) uses the products of values j-i apart, without the last i
    of them. So each product is summed once per distance, and the few at the
    end of the series are taken off again for the pairs that do not reach them.
    """
    centred = with_stats(
        df.select(*keys, t, F.col(y).cast("double").alias("_y")), keys, {"_mean": F.avg("_y"), "_end": F.max(t)}
    ).select(*keys, t, "_end", (F.col("_y") - F.col("_mean")).alias("_d"))
    pairs = (
        _pairs(centred, t, "_d", count - 1, keys, ["_end"], block)
        .where((F.col("lag") > 0) & F.col("x").isNotNull() & F.col("z").isNotNull())
        # rows between the later value and the end of the series
        .withColumn("_rest", F.least(F.col("_end") - F.col(t) - F.col("lag"), F.lit(count)))
    )
    x, z = F.col("x"), F.col("z")
    tails = pairs.groupBy(*keys, "lag", "_rest").agg(
        F.count("*").alias("n"),
        F.sum(x).alias("sx"),
        F.sum(z).alias("sz"),
        F.sum(x * x).alias("sxx"),
        F.sum(z * z).alias("szz"),
        F.sum(x * z).alias("sxz"),
    )
    # count * count rows per series: shift i keeps the products at least i rows before the end.
    shifts = F.explode(F.sequence(F.lit(0), F.least(F.col("_rest"), F.lit(count - 1) - F.col("lag")))).alias("i")
    sums = (
        tails.select("*", shifts)
        .groupBy(*keys, "i", (F.col("i") + F.col("lag")).alias("j"))
        .agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sz", "sxx", "szz", "sxz")])
    )
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vz = F.col("n") * F.col("szz") - F.col("sz") * F.col("sz")
    r = (F.col("n") * F.col("sxz") - F.col("sx") * F.col("sz")) / F.nullif(
        F.sqrt(F.greatest(vx, F.lit(0.0))) * F.sqrt(F.greatest(vz, F.lit(0.0))), F.lit(0.0)
    )
    return sums.select(*keys, F.col("i").cast("int").alias("i"), F.col("j").cast("int").alias("j"), r.alias("r"))


def seasonal_parts(
    df: DataFrame, t: str, y: str, period: int = 30, keys: tuple[str, ...] = (), block: int = BLOCK
) -> DataFrame:
    """Additive decomposition ``t, y, trend, seasonal, resid``; positions start at 1.

    trend: centred moving average over one period (half weights at both ends
    when the period is even), null where it does not fit. seasonal: mean of
    y - trend per phase, shifted to sum to zero.
    """
    half = period // 2
    series = df.select(*keys, t, F.col(y).cast("double").alias("y"))
    rows, window, own = blocked(series, t, keys, half, half, block)
    around = window.rowsBetween(-half, half)
    total = F.sum("y").over(around)
    if period % 2 == 0:
        total = total - (F.lag("y", half).over(window) + F.lead("y", half).over(window)) / 2
    full = F.count("y").over(around) == 2 * half + 1
    trended = (
        rows.select(*keys, t, "y", F.when(full, total / F.lit(float(period))).alias("trend"), own.alias("_own"))
        .where("_own")
        .drop("_own")
        .withColumn("_phase", (F.col(t) - 1) % period)
    )
    # ``period`` rows per series.
    phases = trended.groupBy(*keys, "_phase").agg(F.avg(F.col("y") - F.col("trend")).alias("_mean"))
    per_series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    seasonal = phases.select(
        *keys, "_phase", (F.col("_mean") - F.avg("_mean").over(per_series)).alias("seasonal")
    )
    if not keys:
        seasonal = F.broadcast(seasonal)  # exactly ``period`` rows
    return trended.join(seasonal, [*keys, "_phase"]).select(
        *keys, t, "y", "trend", "seasonal", (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid")
    )


def spectrum(
    df: DataFrame, t: str, y: str, frequencies: int = 39, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Amplitudes ``k, amplitude`` of k = 1.. full waves over the series: ``2/N * |sum(y * e^(-2 pi i k t / N))|``.

    Two sums per frequency, started in the map tasks. The phase is reduced in
    integers first, so long series keep full precision.
    """
    series = with_stats(
        df.select(*keys, F.col(t).cast("bigint").alias("_t"), F.col(y).cast("double").alias("_y")),
        keys,
        {"_n": F.count("*")},
    )
    k = F.explode(F.sequence(F.lit(1), F.lit(frequencies))).alias("k")
    angle = F.lit(2 * math.pi) * ((F.col("k") * F.col("_t")) % F.col("_n")) / F.col("_n")
    sums = (
        series.select(*keys, "_n", "_t", "_y", k)
        .groupBy(*keys, "k")
        .agg(
            F.sum(F.col("_y") * F.cos(angle)).alias("re"),
            F.sum(F.col("_y") * F.sin(angle)).alias("im"),
            F.first("_n").alias("_n"),
        )
    )
    amplitude = F.lit(2.0) / F.col("_n") * F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    return sums.select(*keys, "k", amplitude.alias("amplitude"))


def between(df: DataFrame, t: str, start: int, end: int | None = None) -> DataFrame:
    """Rows of the half-open position range; without ``end`` up to the last one."""
    keep = F.col(t) >= start
    return df.where(keep if end is None else keep & (F.col(t) < end))
