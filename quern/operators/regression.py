"""Least squares by aggregates: one line per key, with standard errors and limits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.sources.ranges import even_grid

Z975 = 1.959963984540054
# 97.5 % points of Student's t for 1 to 30 degrees of freedom.
T975 = [
    12.7062047362, 4.3026527297, 3.1824463053, 2.7764451052, 2.5705818356, 2.4469118511, 2.3646242516, 2.3060041352,
    2.2621571628, 2.228138852, 2.2009851601, 2.1788128297, 2.1603686565, 2.1447866879, 2.1314495456, 2.1199052992,
    2.1098155778, 2.1009220402, 2.0930240544, 2.0859634473, 2.0796138447, 2.0738730679, 2.0686576104, 2.0638985616,
    2.0595385528, 2.0555294386, 2.0518305165, 2.0484071418, 2.0452296421, 2.0422724563,
]
# From so many degrees of freedom on, p-values come from the normal distribution.
MANY_FREE = 400


def t_quantile_975(df: Column) -> Column:
    """97.5 % point of Student's t: exact up to 30 degrees of freedom, then by its expansion around the normal one."""
    z = Z975
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    out = F.lit(z)
    power = F.lit(1.0)
    for term in terms:
        power = power * df
        out = out + F.lit(term) / power
    return F.coalesce(F.get(F.lit(T975), df.cast("int") - 1), out)


def two_sided_p(t: Column, df: Column) -> Column:
    """Probability of a larger absolute value of Student's t; ``df`` are whole degrees of freedom.

    The closed sum of powers of the cosine below MANY_FREE degrees, Wallace's normal approximation from there on.
    """
    angle = F.atan(F.abs(t) / F.sqrt(df))
    cos, sin, odd = F.cos(angle), F.sin(angle), df % 2
    few = F.least(df, F.lit(MANY_FREE)).cast("int")
    count = F.floor((few - odd) / 2).cast("int")
    first = F.struct(F.lit(0.0).alias("sum"), F.when(odd == 1, cos).otherwise(F.lit(1.0)).alias("term"))

    def step(state: Column, k: Column) -> Column:
        factor = cos * cos * F.when(odd == 1, 2 * k / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        return F.struct((state["sum"] + state["term"]).alias("sum"), (state["term"] * factor).alias("term"))

    terms = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    series = sin * F.aggregate(terms, first, step)["sum"]
    inside = F.when(odd == 1, (angle + series) * (2 / math.pi)).otherwise(series)
    z = (8 * df + 1) / (8 * df + 3) * F.sqrt(df * F.log1p(t * t / df))
    return F.when(df < MANY_FREE, F.greatest(1 - inside, F.lit(0.0))).otherwise(_normal_two_sided(z))


def _normal_two_sided(z: Column) -> Column:
    """Probability that a normal variable lies beyond -z and z, for z of 0 or more."""
    density = F.exp(-z * z / 2) * math.sqrt(2 / math.pi)
    first = F.struct(F.lit(0.0).alias("sum"), z.alias("term"))
    step = lambda s, k: F.struct((s["sum"] + s["term"]).alias("sum"), (s["term"] * z * z / (2 * k + 1)).alias("term"))
    near = 1 - density * F.aggregate(F.sequence(F.lit(1), F.lit(60)), first, step)["sum"]
    tail = z
    for k in range(12, 0, -1):
        tail = z + k / tail
    return F.when(z < 4, near).otherwise(density / tail)


def ols(df: DataFrame, x: str, y: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """n, slope, intercept, r2, standard errors, t values, p-values and 95 % limits; null where undefined."""
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    sums = df.where(xc.isNotNull() & yc.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(xc).alias("_mx"),
        F.avg(yc).alias("_my"),
        F.regr_sxx(yc, xc).alias("_sxx"),
        F.regr_syy(yc, xc).alias("_syy"),
        F.regr_sxy(yc, xc).alias("_sxy"),
    )
    sxx = F.nullif("_sxx", F.lit(0.0))
    fit = sums.withColumn("slope", F.col("_sxy") / sxx).withColumns(
        {
            "intercept": F.col("_my") - F.col("slope") * F.col("_mx"),
            "_sse": F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0)),
            "_free": F.nullif(F.greatest(F.col("n") - 2, F.lit(0)), F.lit(0)),
        }
    )
    s2 = F.col("_sse") / F.col("_free")
    fit = fit.withColumns(
        {
            "slope_se": F.sqrt(s2 / sxx),
            "intercept_se": F.sqrt(s2 * (1 / F.col("n") + F.col("_mx") * F.col("_mx") / sxx)),
            "_t": t_quantile_975(F.col("_free").cast("double")),
        }
    )
    return fit.select(
        *keys,
        "n",
        "slope",
        "intercept",
        (1 - F.col("_sse") / F.nullif("_syy", F.lit(0.0))).alias("r2"),
        "slope_se",
        "intercept_se",
        (F.col("slope") / F.nullif("slope_se", F.lit(0.0))).alias("slope_t"),
        (F.col("intercept") / F.nullif("intercept_se", F.lit(0.0))).alias("intercept_t"),
        two_sided_p(F.col("slope") / F.nullif("slope_se", F.lit(0.0)), F.col("_free")).alias("slope_p"),
        two_sided_p(F.col("intercept") / F.nullif("intercept_se", F.lit(0.0)), F.col("_free")).alias("intercept_p"),
        (F.col("slope") - F.col("_t") * F.col("slope_se")).alias("slope_lo"),
        (F.col("slope") + F.col("_t") * F.col("slope_se")).alias("slope_hi"),
        (F.col("intercept") - F.col("_t") * F.col("intercept_se")).alias("intercept_lo"),
        (F.col("intercept") + F.col("_t") * F.col("intercept_se")).alias("intercept_hi"),
    )


def limit_lines(df: DataFrame, x: str, y: str, points: int = 100, keys: tuple[str, ...] = ()) -> DataFrame:
    """The lines of the lower and of the upper coefficient limits over an even grid of x."""
    limits = ["slope_lo", "slope_hi", "intercept_lo", "intercept_hi"]
    fit, grid = ols(df, x, y, keys), even_grid(df, x, points, keys=keys)
    if keys:
        both = grid.join(fit.select(*keys, F.struct(*limits).alias("_fit")), list(keys))
    else:
        both = grid.withColumn("_fit", fit.select(F.struct(*limits).alias("fit")).scalar())
    return both.select(
        *keys,
        "point",
        x,
        (F.col("_fit.intercept_lo") + F.col("_fit.slope_lo") * F.col(x)).alias("lower"),
        (F.col("_fit.intercept_hi") + F.col("_fit.slope_hi") * F.col(x)).alias("upper"),
    )


def with_fit(df: DataFrame, x: str, y: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Add the ``prediction`` of the fitted line to every row."""
    fit = ols(df, x, y, keys)
    if keys:
        joined = df.join(fit.select(*keys, "slope", "intercept"), list(keys))
    else:
        line = fit.select(F.struct("slope", "intercept").alias("line")).scalar()
        joined = df.withColumn("_line", line).select(*df.columns, "_line.slope", "_line.intercept")
    return joined.withColumn("prediction", F.col("intercept") + F.col("slope") * F.col(x)).drop(
        "slope", "intercept"
    )


def fold_lines(df: DataFrame, x: str, y: str, fold: str) -> DataFrame:
    """Per fold: the line fitted on all other folds and its RMSE on the fold.

    The sums of a training set are the total minus the fold's own, so the data
    is read once for all k models. Values are centred first to keep digits.
    """
    centres = df.agg(F.struct(F.avg(x).alias("x"), F.avg(y).alias("y")).alias("c")).scalar()
    moved = df.withColumn("_c", centres).select(
        fold,
        "_c",
        (F.col(x) - F.col("_c.x")).alias("x"),
        (F.col(y) - F.col("_c.y")).alias("y"),
    )
    xc, yc = F.col("x"), F.col("y")
    sums = {"n": F.lit(1), "sx": xc, "sy": yc, "sxx": xc * xc, "sxy": xc * yc, "syy": yc * yc}
    own = moved.groupBy(fold, "_c").agg(*[F.sum(e).alias(k) for k, e in sums.items()])
    # One row per fold from here on.
    whole = Window.partitionBy(F.lit(0))
    rest = own.select("*", *[(F.sum(k).over(whole) - F.col(k)).alias(f"o_{k}") for k in sums])
    slope = (F.col("o_n") * F.col("o_sxy") - F.col("o_sx") * F.col("o_sy")) / F.nullif(
        F.col("o_n") * F.col("o_sxx") - F.col("o_sx") * F.col("o_sx"), F.lit(0.0)
    )
    fit = rest.withColumn("slope", slope).withColumn(
        "_a", (F.col("o_sy") - F.col("slope") * F.col("o_sx")) / F.nullif("o_n", F.lit(0))
    )
    a, b = F.col("_a"), F.col("slope")
    sse = (
        F.col("syy") + F.col("n") * a * a + b * b * F.col("sxx")
        - 2 * a * F.col("sy") - 2 * b * F.col("sxy") + 2 * a * b * F.col("sx")
    )
    return fit.select(
        fold,
        "n",
        "slope",
        (a + F.col("_c.y") - b * F.col("_c.x")).alias("intercept"),
        F.sqrt(F.greatest(sse, F.lit(0.0)) / F.col("n")).alias("rmse"),
    )
