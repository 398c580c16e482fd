"""Elastic-net jobs from moments, with SQL twins that walk the same descent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import hashing as hs
from quern.functions import time as tm
from quern.operators import features as ft
from quern.operators import gram
from quern.operators import metrics as mt
from quern.operators import sampling as sp
from quern.operators.relational import all_but, union_all
from quern.plans import standins as st
from quern.plans.registry import job
from quern.plans.series import PERIODS, SPLIT
from quern.sources import ranges
from quern.sources.staging import staged

# The elastic-net grid of the demand model and the settings (steps, penalty, share) of single fits.
REG_PARAMS = [0.1, 0.5, 1.0, 2.0, 3.0, 5.0, 10.0]
ELASTIC_NET = [0.0, 0.25, 0.5, 0.75, 1.0]
SETTINGS = [(p, s) for p in REG_PARAMS for s in ELASTIC_NET]
CURVE_FIT = (0.3, 0.8)
DEMAND_FIT = (3.0, 0.5)
PERIODIC_FIT = (0.01, 0.9)
# A report counts sweeps up to a change of this size.
REPORT_TOLERANCE = 1e-6
DEMAND_COLUMNS = ["season", "yr", "mnth", "weekday", "workingday", "weathersit", "temp", "hum", "windspeed", "unixdate"]


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand table with a numeric date and without date and running number."""
    days = st.days(spark, sf_dir).withColumn("unixdate", tm.utc_epoch(F.col("dteday")))
    numeric = days.drop("dteday")
    return numeric.select(*[F.col(c).cast("double").alias(c) if c != "instant" else c for c in numeric.columns])


def curve_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X: words in thousands, Y: letters in thousands, of every labelled document."""
    return st.exam(spark, sf_dir).select("doc_id", (F.col("n_words") / 1000).alias("X"), (F.col("n_chars") / 1000).alias("Y"))


DEMAND = f"{st.DAYS}, demand AS (SELECT *, epoch(dteday)::DOUBLE AS unixdate FROM days)"
CURVE = f"{st.EXAM}, points AS (SELECT doc_id, n_words / 1000 AS X, n_chars / 1000 AS Y FROM exam)"


# Unrounded measures of a prediction {p} of {y}.
METRICS = """1 - avg(pow({y} - {p}, 2)) / var_pop({y}) AS r2, sqrt(avg(pow({y} - {p}, 2))) AS rmse, avg(pow({y} - {p}, 2)) AS mse,
  avg(abs({y} - {p})) AS mae"""


def descent(name: str, rows: str, columns: list[str], label: str, settings: list[tuple], sweeps: int, tolerance: float = 1e-12, key: str = "0") -> str:
    """SQL: ``{name}_b`` (key, reg, alpha, sweeps, b, a) of elastic nets, by sweeps over the columns; ``rows`` follows FROM.

    ``{name}_s`` has all sweeps, ``{name}_m`` the correlations per key. The statement must be WITH RECURSIVE.
    """
    cells = ", ".join("[" + ", ".join(f"coalesce(corr({a}, {b}), 0)" for b in columns) + "]" for a in columns)
    pull = "ry[e[1]::INT] - list_dot_product(rr[e[1]::INT], w) + w[e[1]::INT] * rr[e[1]::INT][e[1]::INT]"
    grid = ", ".join(f"({p}, {s})" for p, s in settings)
    return f"""{name}_m AS (
  SELECT {key} AS key, [{", ".join(f"avg({c})" for c in columns)}] AS mx, avg({label}) AS my, [{", ".join(f"stddev_pop({c})" for c in columns)}] AS sx,
    stddev_pop({label}) AS sy, [{cells}] AS rr, [{", ".join(f"coalesce(corr({c}, {label}), 0)" for c in columns)}] AS ry FROM {rows} GROUP BY 1),
{name}_f AS (SELECT *, reg * alpha / sy AS l1, reg * (1 - alpha) / sy AS l2 FROM {name}_m, (VALUES {grid}) g(reg, alpha)),
{name}_s AS (
  SELECT key, reg, alpha, 0 AS i, list_transform(mx, lambda x: 0.0::DOUBLE) AS w, 1e300::DOUBLE AS moved FROM {name}_f
  UNION ALL
  SELECT key, reg, alpha, i, new, list_max(list_transform(list_zip(w, new), lambda x: abs(x[1] - x[2]))) FROM (
    SELECT s.key, s.reg, s.alpha, i + 1 AS i, s.w, list_reduce([w] || [[j::DOUBLE] FOR j IN range(1, {len(columns) + 1})], lambda w, e:
      w[:e[1]::INT - 1] || [(greatest({pull} - l1, 0) - greatest(-({pull}) - l1, 0)) / (1 + l2)] || w[e[1]::INT + 1:]) AS new
    FROM {name}_s s JOIN {name}_f f ON f.key = s.key AND f.reg = s.reg AND f.alpha = s.alpha WHERE i < {sweeps} AND moved > {tolerance})),
{name}_b AS (
  SELECT key, reg, alpha, i AS sweeps, list_transform(list_zip(w, sx), lambda x: x[1] * sy / x[2]) AS b,
         my - list_dot_product(list_transform(list_zip(w, sx), lambda x: x[1] * sy / x[2]), mx) AS a
  FROM {name}_s JOIN {name}_m USING (key) QUALIFY row_number() OVER (PARTITION BY key, reg, alpha ORDER BY i DESC) = 1)"""


def prediction(columns: list[str], b: str = "b", a: str = "a") -> str:
    return f"({a} + list_dot_product({b}, [{', '.join(f'{c}::DOUBLE' for c in columns)}]))"


def line(df: DataFrame, columns: list[str], label: str, setting: tuple[float, float], **limits) -> gram.Line:
    """An elastic-net line over all rows."""
    return gram.elastic_net([(gram.moments(df, columns, label)[None], *setting)], **limits)[0]


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _report_sql(name: str, table: str, columns: list[str], label: str, setting: tuple, sweeps: int) -> tuple[str, str]:
    with_ = descent(name, table, columns, label, [setting], sweeps, REPORT_TOLERANCE)
    measures = METRICS.format(y=label, p=prediction(columns))
    return with_, f"SELECT '{name}' AS model, any_value(sweeps)::INT AS iterations, {measures} FROM {table}, {name}_b"


def _reports() -> str:
    parts = [
        _report_sql("letters_by_words", "points", ["X"], "Y", CURVE_FIT, 10),
        _report_sql("demand_by_all", "demand", DEMAND_COLUMNS, "cnt", DEMAND_FIT, 100),
        _report_sql("sales_by_year", "sales", ["year"], "millions", DEMAND_FIT, 10),
    ]
    tables = f"{CURVE}, {DEMAND}, {st.ENERGY}, sales AS (SELECT *, electricity_demand / 1000000 AS millions FROM energy WHERE electricity_demand IS NOT NULL)"
    rows = " UNION ALL ".join(select for _, select in parts)
    rows = f"SELECT model, iterations, round(mse, 4) AS mse, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) + 0 AS r2 FROM ({rows})"
    return f"WITH RECURSIVE {tables}, " + ", ".join(with_ for with_, _ in parts) + " " + rows


@job("linreg_enet", _reports())
def linreg_enet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elastic-net lines of text length, demand and yearly sales: sweeps used and training metrics side by side."""
    sales = st.energy(spark, sf_dir).where("electricity_demand is not null").withColumn("millions", F.col("electricity_demand") / 1000000)
    fits = {
        "letters_by_words": (curve_points(spark, sf_dir), ["X"], "Y", CURVE_FIT, 10),
        "demand_by_all": (demand(spark, sf_dir), DEMAND_COLUMNS, "cnt", DEMAND_FIT, 100),
        "sales_by_year": (sales, ["year"], "millions", DEMAND_FIT, 10),
    }
    tables = []
    for name, (rows, columns, label, setting, sweeps) in fits.items():
        rows = staged(rows.select(*columns, label), "fit-rows")
        found = line(rows, columns, label, setting, sweeps=sweeps, tolerance=REPORT_TOLERANCE)
        measured = mt.regression_metrics(rows.withColumn("prediction", found.score()), label, "prediction")
        tables.append(measured.select(F.lit(name).alias("model"), F.lit(found.sweeps).alias("iterations"), "mse", "rmse", "mae", "r2"))
    return _rounded(union_all(tables), "mse", "rmse", "mae", "r2").withColumn("r2", F.col("r2") + F.lit(0.0))


@job(
    "linreg_coefficients",
    f"""WITH RECURSIVE {DEMAND}, {descent("d", "demand", DEMAND_COLUMNS, "cnt", [DEMAND_FIT, (0.1, 0.5)], 3000)},
terms AS (SELECT reg, unnest({DEMAND_COLUMNS + ["intercept"]}) AS term, unnest(b || [a]) AS coefficient FROM d_b)
SELECT reg::DOUBLE AS reg, term, round(coefficient, 4) + 0 AS coefficient FROM terms""",
)
def linreg_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the demand model, with the given penalty and with a light one, from one aggregate."""
    told = gram.moments(demand(spark, sf_dir), DEMAND_COLUMNS, "cnt")[None]
    settings = [DEMAND_FIT, (0.1, 0.5)]
    rows = []
    for (penalty, _), found in zip(settings, gram.elastic_net([(told, *s) for s in settings]), strict=True):
        values = [*found.weights.tolist(), found.intercept]
        rows += [(penalty, term, value) for term, value in zip([*DEMAND_COLUMNS, "intercept"], values, strict=True)]
    out = spark.createDataFrame(rows, "reg DOUBLE, term STRING, coefficient DOUBLE")
    return out.withColumn("coefficient", F.round("coefficient", 4) + F.lit(0.0))


HISTORY = "history AS (SELECT i, reg * alpha / sy AS l1, reg * (1 - alpha) / sy AS l2, rr, ry, w FROM d_s JOIN d_m USING (key))"


@job(
    "objective_history",
    f"""WITH RECURSIVE {DEMAND}, {descent("d", "demand", DEMAND_COLUMNS, "cnt", [(0.1, 0.5)], 100, REPORT_TOLERANCE)}, {HISTORY}
SELECT i::INT AS iteration, round(0.5 - list_dot_product(ry, w) + 0.5 * list_dot_product(w, list_transform(rr, lambda x: list_dot_product(x, w)))
  + l1 * list_sum(list_transform(w, lambda x: abs(x))) + 0.5 * l2 * list_dot_product(w, w), 6) AS objective FROM history""",
)
def objective_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objective of the demand model before the first sweep and after each."""
    found = line(demand(spark, sf_dir), DEMAND_COLUMNS, "cnt", (0.1, 0.5), sweeps=100, tolerance=REPORT_TOLERANCE)
    rows = spark.createDataFrame(list(enumerate(found.objective)), "iteration INT, objective DOUBLE")
    return _rounded(rows, "objective", digits=6)


DEGREES = (1, 2, 3, 5)


def _powers(degree: int) -> list[str]:
    return [f"pow(X, {k})" for k in range(1, degree + 1)]


def _poly_sql() -> str:
    fits = ", ".join(descent(f"p{d}", "parts WHERE part = 'train'", _powers(d), "Y", [CURVE_FIT], 3000) for d in DEGREES)
    rows = " UNION ALL ".join(
        f"SELECT {d} AS degree, part, count(*) AS n, {METRICS.format(y='Y', p=prediction(_powers(d)))} FROM parts, p{d}_b GROUP BY part" for d in DEGREES
    )
    cut = "row_number() OVER (ORDER BY md5(doc_id || ':3')) <= floor(count(*) OVER () * 0.7::DOUBLE)"
    parts = f"parts AS (SELECT *, CASE WHEN {cut} THEN 'train' ELSE 'test' END AS part FROM points)"
    return f"WITH RECURSIVE {CURVE}, {parts}, {fits} SELECT degree, part, n, round(r2, 4) AS r2, round(rmse, 4) AS rmse, round(mse, 4) AS mse, round(mae, 4) AS mae FROM ({rows})"


@job("linreg_poly", _poly_sql())
def linreg_poly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polynomials of degree 1 to 5 from words to letters, measured on both parts of an exact 70/30 split."""
    points = ft.polynomial(sp.head_split(curve_points(spark, sf_dir), "doc_id", 0.7, seed=3), ["X"], max(DEGREES))
    points = staged(points, "curve-parts")
    names = ["*".join(["X"] * k) for k in range(1, max(DEGREES) + 1)]
    # The moments of the highest degree hold those of all others.
    every = gram.moments(points.where("part = 'train'"), names, "Y")[None]
    scores = {}
    for degree in DEGREES:
        keep = [*range(degree), len(names)]
        some = gram.Moments(names[:degree], every.n, every.mean[keep], every.cov[keep][:, keep])
        scores[degree] = gram.elastic_net([(some, *CURVE_FIT)])[0].score()
    rows = points.select("part", "Y", F.explode(F.array(*[F.struct(F.lit(d).alias("degree"), s.alias("p")) for d, s in scores.items()])).alias("s"))
    measured = mt.regression_metrics(rows.select("part", "Y", "s.*"), "Y", "p", keys=("degree", "part"))
    return _rounded(measured, "r2", "rmse", "mse", "mae")


WAVES = [f"{f}(2 * pi() * instant / {k})" for k in PERIODS for f in ("sin", "cos") if (f, k) not in (("sin", 1), ("cos", 1), ("sin", 2))]
TREND = [*WAVES, *(f"pow(instant, {k})" for k in range(1, 6))]


@job(
    "linreg_periodic",
    f"""WITH RECURSIVE {st.DAYS}, {descent("w", "days", TREND, "cnt", [PERIODIC_FIT], 2000, REPORT_TOLERANCE)}
SELECT n, sweeps, round(r2, 4) AS r2, round(rmse, 4) AS rmse, round(mse, 4) AS mse, round(mae, 4) AS mae
FROM (SELECT count(*) AS n, any_value(sweeps)::INT AS sweeps, {METRICS.format(y="cnt", p=prediction(TREND))} FROM days, w_b)""",
)
def linreg_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polynomial of degree 5 with sine and cosine columns; those that are constant up to rounding get no weight."""
    days = st.days(spark, sf_dir).select(F.col("instant").cast("double").alias("instant"), F.col("cnt").cast("double").alias("cnt"))
    waves = ft.polynomial(ft.with_fourier(days, "instant", PERIODS), ["instant"], 5)
    periodic = [c for c in all_but(waves, "cnt") if c.startswith(("sin", "cos"))]
    powers = ["*".join(["instant"] * k) for k in range(1, 6)]
    waves = staged(waves, "waves")
    found = line(waves, [*periodic, *powers], "cnt", PERIODIC_FIT, sweeps=2000, tolerance=REPORT_TOLERANCE)
    measured = mt.regression_metrics(waves.withColumn("prediction", found.score()), "cnt", "prediction")
    return _rounded(measured.select("n", F.lit(found.sweeps).alias("sweeps"), "r2", "rmse", "mse", "mae"), "r2", "rmse", "mse", "mae")


@job(
    "predict_grid",
    f"""WITH RECURSIVE {CURVE}, {descent("g", "points", _powers(3), "Y", [CURVE_FIT], 3000)},
ends AS (SELECT min(X) - 0.05 * (max(X) - min(X)) AS lo, max(X) + 0.05 * (max(X) - min(X)) AS hi FROM points),
grid AS (SELECT CAST(p AS INT) AS point, lo + (hi - lo) * p / 99 AS X FROM ends, range(100) r(p))
SELECT point, round(X, 6) AS X, round({prediction(_powers(3))}, 4) AS prediction FROM grid, g_b""",
)
def predict_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a cubic over 100 evenly spaced lengths, five percent beyond both ends."""
    points = staged(curve_points(spark, sf_dir), "curve-points")
    names = ["X", "X*X", "X*X*X"]
    found = line(ft.polynomial(points, ["X"], 3), names, "Y", CURVE_FIT)
    grid = ft.polynomial(ranges.even_grid(points, "X", 100, pad_share=0.05), ["X"], 3)
    return _rounded(grid.select("point", F.round("X", 6).alias("X"), found.score().alias("prediction")), "prediction")


FOLD_OF = "('0x' || substr(md5(instant || ':7'), 1, 8))::BIGINT % 5"


@job(
    "cv_grid_enet",
    f"""WITH RECURSIVE {DEMAND}, train AS (
  SELECT *, {FOLD_OF} AS fold FROM (SELECT *, {SPLIT.format(k="instant", seed=42, w=0.8)} AS part FROM demand) WHERE part = 'train'),
{descent("c", "train, range(5) k(k) WHERE fold <> k", DEMAND_COLUMNS, "cnt", SETTINGS, 1500, key="k")},
judged AS (
  SELECT reg, alpha, key, 1 - avg(pow(cnt - {prediction(DEMAND_COLUMNS)}, 2)) / var_pop(cnt) AS r2
  FROM train JOIN c_b ON fold = key GROUP BY ALL),
told AS (SELECT reg, alpha, avg(r2) AS mean, stddev_pop(r2) AS spread FROM judged GROUP BY ALL)
SELECT reg::DOUBLE AS reg, alpha::DOUBLE AS alpha, round(mean, 4) AS mean, round(spread, 4) AS stddev,
  row_number() OVER (ORDER BY round(mean, 7) DESC, reg, alpha) = 1 AS best FROM told""",
)
def cv_grid_enet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35 elastic-net settings, 5 folds, r2: all 175 fits and their scores from one aggregate over the rows."""
    rows = demand(spark, sf_dir).where(sp.split_column("instant", {"train": 0.8, "test": 0.2}, seed=42) == "train")
    folds = gram.moments(rows.withColumn("fold", hs.hash_bucket(F.col("instant"), 7, 5)), DEMAND_COLUMNS, "cnt", "fold")
    table = gram.grid_search(folds, SETTINGS)
    best = min(table, key=lambda r: (-round(r[2], 7), r[0], r[1]))
    out = spark.createDataFrame([(*r, r == best) for r in table], "reg DOUBLE, alpha DOUBLE, mean DOUBLE, stddev DOUBLE, best BOOLEAN")
    return _rounded(out, "mean", "stddev")
