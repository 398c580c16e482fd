"""Daily-demand series, feature and regression jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import features as ft
from quern.operators import metrics as mt
from quern.operators import regression as rg
from quern.operators import sampling as sp
from quern.operators import series as se
from quern.operators import stats
from quern.operators.prefix import positions
from quern.plans import standins as st
from quern.plans.registry import job
from quern.sources import ranges
from quern.sources.staging import staged
from quern.sources.tables import table

# The periods of the sine and cosine features, in days.
PERIODS = [1, 2, 3, 5, 8, 11, 30]
MEASURES = ["season", "yr", "mnth", "weekday", "workingday", "weathersit", "temp", "hum", "windspeed"]


def _round(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily counts, written once: several branches of a job read them."""
    return staged(st.days(spark, sf_dir).select("instant", "cnt"), "daily-counts")


@job("daily_demand", f"WITH {st.DAYS} SELECT instant, dteday, season, yr, mnth, weekday, workingday, weathersit, cnt FROM days")
def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.days(spark, sf_dir).drop("temp", "hum", "windspeed")


PEARSON = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, cnt), 6) AS r FROM days" for c in MEASURES
)


@job("pearson_with_target", f"WITH {st.DAYS} {PEARSON}")
def pearson_with_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(stats.correlations(st.days(spark, sf_dir), MEASURES, "cnt"), "r")


@job(
    "lag_features",
    f"WITH {st.DAYS} SELECT instant, "
    + ", ".join(f"lag(cnt, {i}) OVER (ORDER BY instant) AS lag_{i}" for i in range(40))
    + " FROM days",
)
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return se.lags(st.days(spark, sf_dir), "instant", "cnt", 40)


@job(
    "lag_matrix",
    f"""WITH {st.DAYS}, shifts AS (SELECT instant + s AS t, CAST(s AS INT) AS s, cnt FROM days, range(40) r(s))
SELECT a.s AS i, b.s AS j, round(corr(a.cnt, b.cnt), 6) AS r
FROM shifts a JOIN shifts b ON a.t = b.t AND a.s < b.s
WHERE a.t <= (SELECT max(instant) FROM days) GROUP BY a.s, b.s""",
)
def lag_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(se.lag_correlations(_counts(spark, sf_dir), "instant", "cnt", 40), "r")


ACF = """m AS (SELECT avg(cnt) AS mu, count(*) AS n FROM days),
c AS (SELECT CAST(k AS INT) AS lag, sum((a.cnt - mu) * (b.cnt - mu)) AS c
      FROM range(41) r(k), m, days a JOIN days b ON b.instant = a.instant + k GROUP BY k),
rho AS (SELECT lag, c / (SELECT c FROM c WHERE lag = 0) AS acf FROM c)"""


@job(
    "acf40",
    f"""WITH {st.DAYS}, {ACF}
SELECT lag, round(acf, 6) AS acf, round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(
  sum(CASE WHEN lag > 0 THEN acf * acf ELSE 0 END) OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  0)) / (SELECT n FROM m)) END, 6) AS band FROM rho""",
)
def acf40(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(se.autocorrelation(_counts(spark, sf_dir), "instant", "cnt", 40), "acf", "band")


HOURLY = """hourly AS (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('hour', ts)) AS t,
         count(*) AS n FROM events GROUP BY event_type, date_trunc('hour', ts))"""


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and hour with a running number per type (numbered day by day)."""
    counts = (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.count("*").alias("n"))
    )
    return positions(counts, "hour", ("event_type",), slot=F.to_date("hour"), name="t")


@job(
    "acf_by_event_type",
    f"""WITH {HOURLY}, m AS (SELECT event_type, avg(n) AS mu FROM hourly GROUP BY event_type),
c AS (SELECT event_type, CAST(k AS INT) AS lag, sum((a.n - mu) * (b.n - mu)) AS c
      FROM range(25) r(k), hourly a JOIN hourly b USING (event_type) JOIN m USING (event_type)
      WHERE b.t = a.t + k GROUP BY event_type, k)
SELECT event_type, lag, round(c / first_value(c) OVER (PARTITION BY event_type ORDER BY lag), 6) AS acf FROM c""",
)
def acf_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one series per event type."""
    acf = se.autocorrelation(hourly_events(spark, sf_dir), "t", "n", 24, keys=("event_type",))
    return _round(acf.drop("band"), "acf")


@job(
    "seasonal_parts",
    f"""WITH {st.DAYS}, s AS (
  SELECT instant, cnt, (instant - 1) % 30 AS phase,
    CASE WHEN count(*) OVER w = 31 THEN
      (sum(cnt) OVER w - (lag(cnt, 15) OVER o + lead(cnt, 15) OVER o) / 2) / 30 END AS trend
  FROM days WINDOW w AS (ORDER BY instant ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING), o AS (ORDER BY instant)),
p AS (SELECT phase, avg(cnt - trend) AS m FROM s GROUP BY phase),
q AS (SELECT phase, m - (SELECT avg(m) FROM p) AS seasonal FROM p)
SELECT instant, CAST(cnt AS DOUBLE) AS y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
  round(cnt - trend - seasonal, 6) AS resid FROM s JOIN q USING (phase)""",
)
def seasonal_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = se.seasonal_parts(_counts(spark, sf_dir), "instant", "cnt", 30)
    return _round(parts, "trend", "seasonal", "resid")


@job(
    "spectrum39",
    f"""WITH {st.DAYS}, n AS (SELECT count(*) AS n FROM days)
SELECT CAST(k AS INT) AS k, round(2.0 / any_value(n) * sqrt(
  pow(sum(cnt * cos(2 * pi() * ((k * instant) % n) / n)), 2)
  + pow(sum(cnt * sin(2 * pi() * ((k * instant) % n) / n)), 2)), 6) AS amplitude
FROM days, n, range(1, 40) r(k) GROUP BY k""",
)
def spectrum39(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(se.spectrum(_counts(spark, sf_dir), "instant", "cnt", 39), "amplitude")


@job(
    "fourier_features",
    f"WITH {st.DAYS} SELECT instant, "
    + ", ".join(
        f"round({f}(2 * pi() * instant / {k}), 6) + 0 AS {f}_{k}" for k in PERIODS for f in ("sin", "cos")
    )
    + " FROM days",
)
def fourier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ft.with_fourier(st.days(spark, sf_dir).select("instant"), "instant", PERIODS)
    names = [c for c in rows.columns if c != "instant"]
    return rows.withColumns({c: F.round(c, 6) + F.lit(0) for c in names})


@job(
    "poly_features",
    f"WITH {st.DAYS} SELECT instant, "
    + ", ".join(
        f"round({c} * {c}, 6) AS {c}_squared, round({c} * {c} * {c}, 6) AS {c}_cubed"
        for c in ("temp", "hum", "windspeed")
    )
    + ', round(temp * hum, 6) AS "temp*hum" FROM days',
)
def poly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = st.days(spark, sf_dir).select("instant", "temp", "hum", "windspeed")
    cubes = ft.with_powers(base, ["temp", "hum", "windspeed"])
    rows = ft.polynomial(cubes, ["temp", "hum"], 2).drop("temp", "hum", "windspeed", "temp*temp", "hum*hum")
    return _round(rows, *[c for c in rows.columns if c != "instant"])


# The codes that occur in the daily table.
HOT = {"mnth": range(1, 13), "weekday": range(7), "season": range(1, 5), "weathersit": range(1, 4)}


@job(
    "one_hot_features",
    f"WITH {st.DAYS} SELECT instant, "
    + ", ".join(f"CAST({c} = {v} AS INT) AS {c}_{v}" for c, codes in HOT.items() for v in codes[:-1])
    + " FROM days",
)
def one_hot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes that occur come from the data; the largest one is the level without a column."""
    days = st.days(spark, sf_dir).select("instant", *HOT)
    return ft.one_hot(days, ft.category_codes(days, list(HOT)))


@job(
    "country_filter",
    f"""WITH {st.ENERGY} SELECT country, year, population, round(electricity_demand, 2) AS electricity_demand
FROM energy WHERE country LIKE 'NATION_1%' AND year >= 1997""",
)
def country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.energy(spark, sf_dir).where("country like 'NATION_1%' and year >= 1997")
    return _round(found, "electricity_demand", digits=2)


@job(
    "country_series",
    f"""WITH {st.ENERGY} SELECT year, population, round(electricity_demand, 2) AS electricity_demand
FROM energy WHERE country = 'NATION_7' AND electricity_demand IS NOT NULL""",
)
def country_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = st.energy(spark, sf_dir).where("country = 'NATION_7' and electricity_demand is not null")
    return _round(found.drop("country"), "electricity_demand", digits=2).orderBy("year")


@job(
    "trend_by_country",
    f"""WITH {st.ENERGY} SELECT country, count(*) AS n,
  CASE WHEN count(*) > 1 THEN round(regr_slope(electricity_demand, year - 1995), 4) END AS slope,
  CASE WHEN count(*) > 1 THEN round(regr_intercept(electricity_demand, year - 1995), 4) END AS intercept,
  CASE WHEN count(*) > 1 THEN round(regr_r2(electricity_demand, year - 1995), 6) END AS r2
FROM energy WHERE electricity_demand IS NOT NULL GROUP BY country""",
)
def trend_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A demand line per country over the years since 1995, all fitted in one aggregate."""
    energy = st.energy(spark, sf_dir).withColumn("since", F.col("year") - 1995)
    fits = rg.ols(energy, "since", "electricity_demand", keys=("country",))
    return _round(_round(fits.select("country", "n", "slope", "intercept", "r2"), "r2"), "slope", "intercept", digits=4)


OLS = """f AS (
  SELECT count(*) AS n, regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS a, avg({x}) AS mx,
         regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, regr_sxy({y}, {x}) AS sxy FROM {t}),
g AS (SELECT *, syy - b * sxy AS sse, sqrt((syy - b * sxy) / (n - 2) / sxx) AS b_se,
  sqrt((syy - b * sxy) / (n - 2) * (1.0 / n + mx * mx / sxx)) AS a_se FROM f)"""
LINE_OLS = OLS.format(x="n_words", y="n_chars", t="exam")


@job(
    "ols_stats",
    f"""WITH {st.EXAM}, {LINE_OLS}
SELECT n, round(b, 6) AS slope, round(a, 6) AS intercept, round(1 - sse / syy, 6) AS r2,
  round(b_se, 6) AS slope_se, round(a_se, 6) AS intercept_se, round(b / b_se, 4) AS slope_t,
  round(a / a_se, 4) AS intercept_t FROM g""",
)
def ols_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = rg.ols(st.exam(spark, sf_dir), "n_words", "n_chars")
    fit = fit.drop("slope_lo", "slope_hi", "intercept_lo", "intercept_hi", "slope_p", "intercept_p")
    return _round(_round(fit, "slope", "intercept", "r2", "slope_se", "intercept_se"), "slope_t", "intercept_t", digits=4)


# One line per country: limits and p-values by closed forms for up to five degrees of freedom.
COUNTRY_OLS = f"""{st.ENERGY}, f AS (
  SELECT country, count(*) AS n, regr_slope(electricity_demand, year - 1995) AS b,
         regr_intercept(electricity_demand, year - 1995) AS a, avg(year - 1995) AS mx,
         regr_sxx(electricity_demand, year - 1995) AS sxx, regr_syy(electricity_demand, year - 1995) AS syy,
         regr_sxy(electricity_demand, year - 1995) AS sxy
  FROM energy WHERE electricity_demand IS NOT NULL GROUP BY country HAVING count(*) > 2),
g AS (SELECT *, n - 2 AS v, sqrt((syy - b * sxy) / (n - 2) / sxx) AS b_se,
  sqrt((syy - b * sxy) / (n - 2) * (1.0 / n + mx * mx / sxx)) AS a_se FROM f),
q AS (SELECT *, [12.7062047362, 4.3026527297, 3.1824463053, 2.7764451052, 2.5705818356][v] AS t975,
  atan(abs(b / b_se) / sqrt(v)) AS th FROM g)"""


@job(
    "country_limits",
    f"""WITH {COUNTRY_OLS} SELECT country, n, round(b - t975 * b_se, 2) AS slope_lo, round(b + t975 * b_se, 2) AS slope_hi,
  round(a - t975 * a_se, 2) AS intercept_lo, round(a + t975 * a_se, 2) AS intercept_hi, round(CASE v
    WHEN 1 THEN 1 - 2 * th / pi() WHEN 2 THEN 1 - sin(th) WHEN 3 THEN 1 - 2 / pi() * (th + sin(th) * cos(th))
    WHEN 4 THEN 1 - sin(th) * (1 + pow(cos(th), 2) / 2)
    ELSE 1 - 2 / pi() * (th + sin(th) * (cos(th) + 2 / 3 * pow(cos(th), 3))) END, 6) AS slope_p FROM q""",
)
def country_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95 % limits and the slope's p-value of a country's demand line."""
    energy = st.energy(spark, sf_dir).withColumn("since", F.col("year") - 1995)
    fits = rg.ols(energy, "since", "electricity_demand", keys=("country",)).where("n > 2")
    limits = ["slope_lo", "slope_hi", "intercept_lo", "intercept_hi"]
    return _round(_round(fits.select("country", "n", *limits, "slope_p"), "slope_p"), *limits, digits=2)


@job(
    "residuals",
    f"""WITH {st.DAYS}, {OLS.format(x="instant", y="cnt", t="days")}
SELECT instant, cnt, round(a + b * instant, 6) AS prediction, round(cnt - a - b * instant, 6) AS residual FROM days, g""",
)
def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the line through the daily counts leaves over."""
    days = st.days(spark, sf_dir).select("instant", "cnt")
    fitted = rg.with_fit(days, "instant", "cnt").withColumn("residual", F.col("cnt") - F.col("prediction"))
    return _round(fitted, "prediction", "residual")


@job(
    "confidence_lines",
    f"""WITH {st.DAYS}, {OLS.format(x="instant", y="cnt", t="days")},
q AS (SELECT *, n - 2.0 AS v, 1.959963984540054 AS z FROM g),
l AS (SELECT *, z + (pow(z, 3) + z) / 4 / v + (5 * pow(z, 5) + 16 * pow(z, 3) + 3 * z) / 96 / pow(v, 2) AS t FROM q)
SELECT CAST(p AS INT) AS point, round(lo + (hi - lo) * p / 99, 6) AS instant,
  round(a - t * a_se + (b - t * b_se) * (lo + (hi - lo) * p / 99), 5) AS lower,
  round(a + t * a_se + (b + t * b_se) * (lo + (hi - lo) * p / 99), 5) AS upper
FROM l, (SELECT min(instant) AS lo, max(instant) AS hi FROM days), range(100) r(p)""",
)
def confidence_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rg.limit_lines(st.days(spark, sf_dir), "instant", "cnt")
    return _round(_round(lines, "instant"), "lower", "upper", digits=5)


@job(
    "even_grid",
    f"""WITH {st.EXAM}, e AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM exam)
SELECT CAST(p AS INT) AS point, round((lo - 0.05 * (hi - lo)) + ((hi + 0.05 * (hi - lo)) - (lo - 0.05 * (hi - lo)))
  * p / 99, 4) AS n_chars FROM e, range(100) r(p)""",
)
def even_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round(ranges.even_grid(st.exam(spark, sf_dir), "n_chars", 100, pad_share=0.05), "n_chars", digits=4)


METRICS = """round(1 - avg(pow({y} - {p}, 2)) / var_pop({y}), 6) AS r2, round(sqrt(avg(pow({y} - {p}, 2))), 6) AS rmse,
  round(avg(pow({y} - {p}, 2)), 4) AS mse, round(avg(abs({y} - {p})), 6) AS mae"""


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return _round(_round(df, "r2", "rmse", "mae"), "mse", digits=4)


@job(
    "regression_metrics",
    f"""WITH {st.EXAM}, f AS (SELECT regr_slope(n_chars, n_words) AS b, regr_intercept(n_chars, n_words) AS a FROM exam)
SELECT count(*) AS n, {METRICS.format(y="n_chars", p="(a + b * n_words)")} FROM exam, f""",
)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    exam = staged(st.exam(spark, sf_dir).select("n_words", "n_chars"), "exam")
    fitted = rg.with_fit(exam, "n_words", "n_chars")
    return _rounded_metrics(mt.regression_metrics(fitted, "n_chars", "prediction"))


@job(
    "model_table",
    f"""WITH {st.DAYS}, long AS (
  SELECT unnest(['instant', 'temp', 'hum', 'windspeed']) AS model, unnest([instant, temp, hum, windspeed]) AS x, cnt
  FROM days),
f AS (SELECT model, regr_slope(cnt, x) AS b, regr_intercept(cnt, x) AS a FROM long GROUP BY model)
SELECT model, count(*) AS n, {METRICS.format(y="cnt", p="(a + b * x)")}
FROM long JOIN f USING (model) GROUP BY model""",
)
def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of one line per feature side by side; the models are a key, not a loop."""
    features = ["instant", "temp", "hum", "windspeed"]
    pairs = F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("x")) for c in features])
    long = st.days(spark, sf_dir).select("cnt", F.inline(pairs))
    fitted = rg.with_fit(long, "x", "cnt", keys=("model",))
    return _rounded_metrics(mt.regression_metrics(fitted, "cnt", "prediction", keys=("model",)))


@job(
    "prediction_slice",
    f"""WITH {st.DAYS}, f AS (SELECT regr_slope(cnt, instant) AS b, regr_intercept(cnt, instant) AS a FROM days)
SELECT instant, cnt, round(a + b * instant, 6) AS prediction FROM days, f WHERE instant >= 101 AND instant < 201""",
)
def prediction_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = rg.with_fit(st.days(spark, sf_dir).select("instant", "cnt"), "instant", "cnt")
    return _round(se.between(fitted, "instant", 101, 201), "prediction")


SPLIT = """CASE WHEN ('0x' || substr(md5({k} || ':{seed}'), 1, 8))::BIGINT / 4294967296.0 < {w} THEN 'train' ELSE 'test' END"""


@job(
    "train_test_evaluation",
    f"""WITH {st.DAYS}, parts AS (
  SELECT *, {SPLIT.format(k="instant", seed=42, w=0.8 / 1.1)} AS part FROM days),
f AS (SELECT regr_slope(cnt, temp) AS b, regr_intercept(cnt, temp) AS a FROM parts WHERE part = 'train')
SELECT part, count(*) AS n, {METRICS.format(y="cnt", p="(a + b * temp)")} FROM parts, f GROUP BY part""",
)
def train_test_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line fitted on the training part, measured on both parts in one aggregate; weights 0.8 and 0.3."""
    days = staged(st.days(spark, sf_dir).select("instant", "temp", "cnt"), "days")
    parts = days.withColumn("part", sp.split_column("instant", {"train": 0.8, "test": 0.3}, seed=42))
    fit = rg.ols(parts.where("part = 'train'"), "temp", "cnt").select(F.struct("slope", "intercept").alias("f"))
    scored = parts.withColumn("_f", fit.scalar()).withColumn(
        "prediction", F.col("_f.intercept") + F.col("_f.slope") * F.col("temp")
    )
    return _rounded_metrics(mt.regression_metrics(scored, "cnt", "prediction", keys=("part",)))


@job(
    "fold_lines",
    f"""WITH {st.DAYS}, folds AS (SELECT *, CAST(ntile(5) OVER (ORDER BY instant) AS INT) AS fold FROM days),
f AS (SELECT k.fold, regr_slope(cnt, temp) AS b, regr_intercept(cnt, temp) AS a
      FROM (SELECT DISTINCT fold FROM folds) k JOIN folds d ON d.fold <> k.fold GROUP BY k.fold)
SELECT fold, count(*) AS n, round(any_value(b), 6) AS slope, round(any_value(a), 6) AS intercept,
  round(sqrt(avg(pow(cnt - a - b * temp, 2))), 6) AS rmse FROM folds JOIN f USING (fold) GROUP BY fold""",
)
def fold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-fold cross-validation of a line from one aggregate per fold."""
    days = staged(st.days(spark, sf_dir).select("instant", "temp", "cnt"), "days")
    folded = sp.plain_folds(days, "instant", 5)
    return _round(rg.fold_lines(folded, "temp", "cnt", "fold"), "slope", "intercept", "rmse")


@job(
    "numeric_histograms",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(least(floor(({c} - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, lo + 0 AS lo, hi + 0 AS hi, count(*) AS count
FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY ALL"""
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
)
def numeric_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 bins for each numeric column, all in two passes."""
    bars = stats.histograms(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 20
    )
    return bars.withColumns({c: F.col(c) + F.lit(0.0) for c in ("lo", "hi")})
