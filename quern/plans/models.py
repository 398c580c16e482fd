"""Jobs that fit MLlib models; the deterministic ones have SQL twins."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, OneHotEncoder, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import maths as mx
from quern.functions import text as tx
from quern.functions import time as tm
from quern.functions.vectors import register_array_max
from quern.models import authors as au
from quern.models import linear as ln
from quern.models import logistic as lg
from quern.models import perceptron as pc
from quern.models import regressors as rs
from quern.models import tuning as tu
from quern.operators import features as ft
from quern.operators import irls
from quern.operators import metrics as mt
from quern.operators import sampling as sp
from quern.operators import words as wd
from quern.operators.relational import union_all
from quern.plans import standins as st
from quern.plans.evaluation import THRESHOLD
from quern.plans.linear import CURVE, curve_points
from quern.plans.linear import demand as daily_demand
from quern.plans.registry import job
from quern.plans.series import OLS, SPLIT
from quern.plans.texts import TOKENS
from quern.sources import ranges
from quern.sources.staging import staged
from quern.sources.tables import text_table



def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _demand_parts(spark: SparkSession, sf_dir: str, train: float, test: float) -> DataFrame:
    demand = daily_demand(spark, sf_dir)
    parts = demand.withColumn("part", sp.split_column("instant", {"train": train, "test": test}, seed=42))
    return rs.assemble(parts.drop("instant"), "cnt", keep=("part",))


@job(
    "ols_mllib",
    f"""WITH {st.EXAM}, {OLS.format(x="n_words", y="n_chars", t="exam")}
SELECT 'n_words' AS term, round(b, 6) AS coefficient, round(b_se, 6) AS se, round(b / b_se, 4) AS t,
  abs(b / b_se) > 1.96 AS significant FROM g
UNION ALL SELECT 'intercept', round(a, 6), round(a_se, 6), round(a / a_se, 4), abs(a / a_se) > 1.96 FROM g""",
)
def ols_mllib(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normal-equation fit with standard errors and t values."""
    exam = staged(st.exam(spark, sf_dir).select("n_words", "n_chars"), "exam")
    fit = ln.ols_summary(exam, ["n_words"], "n_chars").withColumn("significant", F.col("p") < 0.05).drop("p")
    return _rounded(_rounded(fit, "coefficient", "se"), "t", digits=4)


@job(
    "enet_one_feature",
    f"""WITH {CURVE}, m AS (
  SELECT avg(X) AS mx, avg(Y) AS my, stddev_pop(X) AS sx, stddev_pop(Y) AS sy, corr(X, Y) AS r FROM points),
w AS (SELECT *, greatest(abs(r) - 0.3 * 0.8 / sy, 0) * sign(r) / (1 + 0.3 * 0.2 / sy) AS w FROM m)
SELECT round(w * sy / sx, 4) AS slope, round(my - w * sy / sx * mx, 4) AS intercept FROM w""",
)
def enet_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The elastic-net line from words to letters; with one feature it is a soft threshold of the correlation."""
    model = ln.line_pipeline(["X"], "Y", maxIter=100, regParam=0.3, elasticNetParam=0.8, tol=1e-10).fit(curve_points(spark, sf_dir))
    wide = ln.coefficients(spark, model, ["slope"]).groupBy().pivot("term", ["slope", "intercept"]).agg(F.first("coefficient"))
    return _rounded(wide, "slope", "intercept", digits=4)


POLYNOMIAL = f"""{CURVE}, s AS (
  SELECT count(*) AS n, sum(X) AS x1, sum(X*X) AS x2, sum(X*X*X) AS x3, sum(X*X*X*X) AS x4,
         sum(Y) AS y0, sum(X*Y) AS y1, sum(X*X*Y) AS y2 FROM points),
d AS (SELECT *, n*(x2*x4 - x3*x3) - x1*(x1*x4 - x2*x3) + x2*(x1*x3 - x2*x2) AS det FROM s),
c AS (SELECT (y0*(x2*x4 - x3*x3) - x1*(y1*x4 - y2*x3) + x2*(y1*x3 - y2*x2)) / det AS c0,
             (n*(y1*x4 - y2*x3) - y0*(x1*x4 - x2*x3) + x2*(x1*y2 - x2*y1)) / det AS c1,
             (n*(x2*y2 - x3*y1) - x1*(x1*y2 - x2*y1) + y0*(x1*x3 - x2*x2)) / det AS c2 FROM d)"""


@job(
    "poly_grid",
    f"""WITH {POLYNOMIAL}, e AS (SELECT min(X) AS lo, max(X) AS hi FROM points)
SELECT CAST(p AS INT) AS point, round(lo + (hi - lo) * p / 99, 6) AS X,
  round(c0 + c1 * (lo + (hi - lo) * p / 99) + c2 * pow(lo + (hi - lo) * p / 99, 2), 4) AS prediction
FROM c, e, range(100) r(p)""",
)
def poly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parabola without penalty, fitted by normal equations, over an even grid of lengths."""
    points = staged(curve_points(spark, sf_dir), "curve-points")
    model = ln.polynomial_pipeline(["X"], "Y", 2, solver="normal", regParam=0.0).fit(points)
    grid = ranges.even_grid(points, "X", 100)
    return _rounded(_rounded(ln.predictions(model, grid, ["point", "X"]), "X"), "prediction", digits=4)


@job("tree_regressors")
def tree_regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision tree and random forest on one-hot and power features."""
    demand = ft.with_powers(daily_demand(spark, sf_dir), ["temp", "hum", "windspeed"])
    hot = ["mnth", "weekday", "season", "weathersit"]
    wide = ft.one_hot(demand, ft.category_codes(demand, hot))
    parts = wide.withColumn("part", sp.split_column("instant", {"train": 0.8, "test": 0.3}, seed=42)).drop("instant")
    models = {"decision_tree": rs.decision_tree("cnt"), "random_forest": rs.random_forest("cnt")}
    return rs.compare(rs.assemble(parts, "cnt", keep=("part",)), "cnt", models)


@job("compare_regressors")
def compare_regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear, tree, forest and boosted trees: metrics on training and test rows."""
    return rs.compare(_demand_parts(spark, sf_dir, 0.8, 0.2), "cnt", rs.standard_set("cnt"))


@job(
    "ml_polynomial",
    f"""WITH {st.DAYS} SELECT instant, round(temp, 6) AS x, round(temp * temp, 6) AS xx, round(hum, 6) AS y,
  round(temp * hum, 6) AS xy, round(hum * hum, 6) AS yy FROM days""",
)
def ml_polynomial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of MLlib's expansion: x, x², y, xy, y²."""
    days = st.days(spark, sf_dir).select("instant", "temp", "hum")
    stages = [
        VectorAssembler(inputCols=["temp", "hum"], outputCol="v"),
        PolynomialExpansion(degree=2, inputCol="v", outputCol="p"),
    ]
    terms = vector_to_array(F.col("p"))
    rows = Pipeline(stages=stages).fit(days).transform(days)
    return rows.select("instant", *[F.round(terms[i], 6).alias(n) for i, n in enumerate(("x", "xx", "y", "xy", "yy"))])


@job(
    "ml_one_hot",
    f"""WITH {st.DAYS} SELECT instant, 12::INT AS mnth_size, CASE WHEN mnth < 12 THEN mnth + 1 ELSE 0 END::BIGINT AS mnth_hot,
  6::INT AS weekday_size, CASE WHEN weekday < 6 THEN weekday + 1 ELSE 0 END::BIGINT AS weekday_hot FROM days""",
)
def ml_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-hot vectors without the last category: their size and the place of the 1 (0: none)."""
    days = st.days(spark, sf_dir).select("instant", "mnth", "weekday")
    encoder = OneHotEncoder(inputCols=["mnth", "weekday"], outputCols=["m", "w"])
    rows = encoder.fit(days).transform(days)
    month, weekday = vector_to_array(F.col("m")), vector_to_array(F.col("w"))
    return rows.select(
        "instant",
        F.size(month).alias("mnth_size"),
        F.array_position(month, 1.0).alias("mnth_hot"),
        F.size(weekday).alias("weekday_size"),
        F.array_position(weekday, 1.0).alias("weekday_hot"),
    )


@job(
    "label_index",
    """SELECT lang AS author, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS by_count,
  CAST(row_number() OVER (ORDER BY lang) - 1 AS DOUBLE) AS by_name, count(*) AS count FROM documents GROUP BY lang""",
)
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class numbers by frequency and by name."""
    books = st.books(spark, sf_dir).select("author")
    stages = [au.label_indexer("author", "by_count"), au.label_indexer("author", "by_name", alphabetical=True)]
    return Pipeline(stages=stages).fit(books).transform(books).groupBy("author", "by_count", "by_name").count()


def _exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    exam = st.exam(spark, sf_dir)
    return exam.select(
        "doc_id", "n_chars", "n_words", tm.utc_epoch(F.col("exam_day")).alias("timestamp"), "result"
    )


EXAM_FEATURES = ["n_chars", "n_words", "timestamp"]


def _newton(steps: int) -> str:
    """SQL: Newton steps of an unpenalised logistic regression of ``result`` on one feature ``x`` of table ``t``."""
    parts = ["b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(steps):
        parts.append(f"""g{k} AS (
  SELECT sum(result - p) AS ga, sum((result - p) * x) AS gb, sum(p * (1 - p)) AS haa, sum(p * (1 - p) * x) AS hab,
         sum(p * (1 - p) * x * x) AS hbb FROM (SELECT result, x, 1 / (1 + exp(-(a + b * x))) AS p FROM t, b{k})),
b{k + 1} AS (SELECT a + (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
  b + (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM b{k}, g{k})""")
    return ",\n".join(parts)


@job(
    "logreg_one_feature",
    f"""WITH {st.EXAM}, t AS (SELECT doc_id, result, ln(1 + n_words) AS x FROM exam), {_newton(12)}
SELECT doc_id, round(1 / (1 + exp(-(a + b * x))), 4) AS p1, round(greatest(1 / (1 + exp(-(a + b * x))),
  1 - 1 / (1 + exp(-(a + b * x)))), 4) AS prob FROM t, b12""",
)
def logreg_one_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression without penalty of the result on the logarithm of the number of words."""
    exam = st.exam(spark, sf_dir).select("doc_id", "result", F.log1p("n_words").alias("x"))
    model = lg.logistic_pipeline(["x"], "result", maxIter=200, regParam=0.0, tol=1e-12).fit(exam)
    return _rounded(lg.scored(model, exam).select("doc_id", "p1", "prob"), "p1", "prob", digits=4)


@job(
    "tree_stump",
    f"""WITH {st.DAYS}, marks AS (
  SELECT instant, cnt, unnest([{{'f': 0, 'v': mnth}}, {{'f': 1, 'v': season}}, {{'f': 2, 'v': weekday}}, {{'f': 3, 'v': weathersit}}]) AS m FROM days),
levels AS (SELECT m.f AS f, m.v AS v, count(*) AS n, sum(cnt) AS s FROM marks GROUP BY ALL),
cuts AS (
  SELECT f, v, sum(n) OVER up AS n1, sum(s) OVER up AS s1, sum(n) OVER (PARTITION BY f) AS n, sum(s) OVER (PARTITION BY f) AS s
  FROM levels WINDOW up AS (PARTITION BY f ORDER BY v)),
best AS (
  SELECT * FROM cuts WHERE n1 < n
  ORDER BY round(s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1), 6) DESC, f, v LIMIT 1)
SELECT instant, round(CASE WHEN m.v <= best.v THEN s1 / n1 ELSE (s - s1) / (n - n1) END, 6) AS prediction
FROM marks JOIN best ON m.f = best.f""",
)
def tree_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A regression tree of depth 1 over calendar columns with fewer values than bins."""
    days = st.days(spark, sf_dir).select("instant", F.col("cnt").cast("double").alias("cnt"), "mnth", "season", "weekday", "weathersit")
    rows = staged(rs.assemble(days, "cnt", keep=("instant",)), "calendar")
    found = rs.decision_tree("cnt", maxDepth=1).fit(rows).transform(rows)
    return _rounded(found.select("instant", "prediction"), "prediction")


@job(
    "vector_max_sql",
    f"WITH {st.DAYS} SELECT instant, round(greatest(temp, hum, windspeed), 6) AS largest FROM days",
)
def vector_max_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest element of an assembled vector, by a function that SQL text calls by name."""
    days = st.days(spark, sf_dir).select("instant", "temp", "hum", "windspeed")
    vectors = VectorAssembler(inputCols=["temp", "hum", "windspeed"], outputCol="v").transform(days)
    register_array_max(spark)
    arrays = vectors.select("instant", vector_to_array("v").alias("a"))
    return spark.sql("SELECT instant, round(maxVectorElement(a), 6) AS largest FROM {arrays}", arrays=arrays)


@job(
    "regex_tokens",
    f"SELECT doc_id, len({TOKENS})::INT AS n_tokens, len(list_distinct({TOKENS}))::INT AS n_distinct FROM documents",
)
def regex_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLlib's tokenizer on every document."""
    tokens = au.tokenizer("text").transform(text_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return tokens.select("doc_id", F.size("words").alias("n_tokens"), F.size(F.array_distinct("words")).alias("n_distinct"))


def _logit(name: str, penalty: float, share: float, steps: int = 8) -> str:
    """SQL: ``{name}_b{steps}`` (w: intercept, then a weight per scaled column) by reweighted steps over table ``xs``.

    A step solves its penalised parabola by 60 sweeps over the weights.
    """
    k = len(EXAM_FEATURES) + 1
    sums = ", ".join(f"avg((p - result) * x[{j}])" for j in range(1, k + 1))
    rows = ", ".join("[" + ", ".join(f"avg(p * (1 - p) * x[{i}] * x[{j}])" for j in range(1, k + 1)) + "]" for i in range(1, k + 1))
    j = "e[1]::INT"
    pull = f"(h[{j}][{j}] * v[{j}] - g[{j}] - list_dot_product(h[{j}], list_transform(list_zip(v, w), lambda d: d[1] - d[2])))"
    soft = f"(greatest({pull} - {penalty * share}, 0) - greatest(-{pull} - {penalty * share}, 0)) / (h[{j}][{j}] + {penalty * (1 - share)})"
    turn = f"v[:{j} - 1] || [CASE WHEN {j} = 1 THEN {pull} / h[1][1] ELSE {soft} END] || v[{j} + 1:]"
    parts = [f"{name}_b0 AS (SELECT [ln(avg(result) / (1 - avg(result)))] || [0.0::DOUBLE FOR i IN range({k - 1})] AS w FROM xs)"]
    for s in range(steps):
        parts.append(f"""{name}_g{s} AS (
  SELECT any_value(w) AS w, [{sums}] AS g, [{rows}] AS h FROM (SELECT x, result, w, 1 / (1 + exp(-list_dot_product(x, w))) AS p FROM xs, {name}_b{s})),
{name}_b{s + 1} AS (SELECT list_reduce([w] || flatten([[[i::DOUBLE] FOR i IN range(1, {k + 1})] FOR s IN range(60)]), lambda v, e: {turn}) AS w FROM {name}_g{s})""")
    return ",\n".join(parts)


EXAM_SCALED = f"""{st.EXAM}, raw AS (SELECT doc_id, result, n_chars, n_words, epoch(exam_day::TIMESTAMP)::BIGINT AS timestamp FROM exam),
ends AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in EXAM_FEATURES)} FROM raw),
xs AS (SELECT raw.*, [1.0::DOUBLE, {", ".join(f"({c} - m_{c}) / s_{c}" for c in EXAM_FEATURES)}] AS x FROM raw, ends)"""


@job(
    "logreg_exam",
    f"""WITH {EXAM_SCALED}, {_logit("e", 0.1, 0.5)}, told AS (SELECT *, 1 / (1 + exp(-list_dot_product(x, w))) AS p FROM xs, e_b8)
SELECT doc_id, n_chars, n_words, timestamp, result, round(p, 4) AS p1, round(greatest(p, 1 - p), 4) AS prob, (p > 0.5)::INT::DOUBLE AS prediction FROM told""",
)
def logreg_exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document with probability, prediction and the larger probability."""
    exam = staged(_exam(spark, sf_dir), "exam")
    p = F.col("p1")
    told = exam.withColumn("p1", irls.fit(exam, EXAM_FEATURES, "result", 0.1, 0.5).probability())
    told = told.withColumns({"prob": F.greatest(p, 1 - p), "prediction": (p > 0.5).cast("double")})
    return _rounded(told, "p1", "prob", digits=4)


@job(
    "logreg_coefficients",
    f"""WITH {EXAM_SCALED}, {_logit("c", 0.01, 0.5)},
own AS (SELECT {", ".join(f"w[{i + 2}] / s_{c} AS w_{c}" for i, c in enumerate(EXAM_FEATURES))},
  w[1] - {" - ".join(f"w[{i + 2}] / s_{c} * m_{c}" for i, c in enumerate(EXAM_FEATURES))} AS w_intercept FROM c_b8, ends),
terms AS ({" UNION ALL ".join(f"SELECT '{c}' AS term, w_{c} AS coefficient FROM own" for c in [*EXAM_FEATURES, "intercept"])})
SELECT term, round(coefficient, 9) + 0 AS coefficient, round(exp(coefficient), 6) AS odds_ratio, round((exp(coefficient) - 1) * 100, 5) + 0 AS percent FROM terms""",
)
def logreg_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logit as a table: coefficients, odds ratios and changes of the odds in percent."""
    found = irls.fit(staged(_exam(spark, sf_dir), "exam"), EXAM_FEATURES, "result", 0.01, 0.5)
    rows = [*zip(EXAM_FEATURES, found.weights.tolist(), strict=True), ("intercept", found.intercept)]
    c = F.col("coefficient")
    told = spark.createDataFrame(rows, "term STRING, coefficient DOUBLE").select("term", c, mx.odds_ratio(c).alias("odds_ratio"), mx.odds_percent(c).alias("percent"))
    return told.select("term", (F.round(c, 9) + F.lit(0.0)).alias("coefficient"), F.round("odds_ratio", 6).alias("odds_ratio"), (F.round("percent", 5) + F.lit(0.0)).alias("percent"))


@job(
    "logreg_history",
    f"""WITH {EXAM_SCALED}, {_logit("h", 0.01, 0.5, 4)}, steps AS ({" UNION ALL ".join(f"SELECT {s} AS step, w FROM h_b{s}" for s in range(4))})
SELECT step, round(avg(ln(1 + exp(list_dot_product(x, w))) - result * list_dot_product(x, w))
  + any_value(0.005 * list_sum(list_transform(w[2:], lambda v: abs(v))) + 0.0025 * list_dot_product(w[2:], w[2:])), 6) AS objective FROM steps, xs GROUP BY step""",
)
def logreg_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The penalised loss of the logit before each of its first four steps."""
    found = irls.fit(staged(_exam(spark, sf_dir), "exam"), EXAM_FEATURES, "result", 0.01, 0.5, steps=4, tolerance=0.0)
    return _rounded(spark.createDataFrame(list(enumerate(found.objective)), "step INT, objective DOUBLE"), "objective", digits=6)


@job("logreg_test_metrics")
def logreg_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class metrics and rates of the held-out part with the threshold overridden."""
    exam = _exam(spark, sf_dir)
    parts = exam.withColumn("part", sp.split_column("doc_id", {"train": 0.7, "test": 0.3}, seed=123))
    parts = staged(parts, "exam-parts")
    model = lg.logistic_pipeline(EXAM_FEATURES, "result", maxIter=100, regParam=0.3).fit(parts.where("part = 'train'"))
    called = lg.scored(model, parts.where("part = 'test'"), THRESHOLD).withColumn(
        "prediction", F.col("prediction").cast("int")
    )
    called = staged(called.select("result", "prediction", "p1"), "exam-scores")
    summary = mt.class_summary(mt.per_class(mt.confusion(called, "result", "prediction")))
    area = mt.area_under_roc(mt.threshold_counts(called, "p1", "result"))
    # Two tables of one row each.
    return summary.withColumn("auc", area.scalar())


@job("scored_grid")
def scored_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, labelled or not, with the model's verdict as text."""
    exam = _exam(spark, sf_dir)
    model = lg.logistic_pipeline(EXAM_FEATURES, "result", maxIter=100, regParam=0.3).fit(exam)
    docs = text_table(spark, sf_dir, "documents").select(
        "doc_id",
        "n_chars",
        F.size(tx.words(F.col("text"))).alias("n_words"),
        F.lit(1452729600).cast("bigint").alias("timestamp"),
    )
    verdict = lg.named_result(lg.scored(model, docs, THRESHOLD), "Zdał", "Nie zdał", "Wynik")
    return verdict.drop("timestamp")


AUTHOR_TERMS = f"""all_toks AS (SELECT doc_id, lang AS label, unnest({TOKENS}) AS word FROM documents),
terms AS (
  SELECT word FROM all_toks GROUP BY word HAVING count(DISTINCT doc_id) >= 2 ORDER BY count(*) DESC, word LIMIT 10000),
toks AS (SELECT * FROM all_toks SEMI JOIN terms USING (word)),
n AS (SELECT label, word, count(*) AS n FROM toks GROUP BY ALL),
v AS (SELECT count(*) AS v FROM terms),
totals AS (SELECT label, sum(n) AS words FROM n GROUP BY label),
prior AS (
  SELECT label, ln((docs + 0.2) / (sum(docs) OVER () + 0.2 * count(*) OVER ())) AS log_prior,
         ln(0.2 / (words + 0.2 * v)) AS log_default
  FROM (SELECT lang AS label, count(*) AS docs FROM documents GROUP BY lang) JOIN totals USING (label), v),
gain AS (
  SELECT label, word, ln((n + 0.2) / (words + 0.2 * v)) - log_default AS gain
  FROM n JOIN totals USING (label) JOIN prior USING (label), v),
known AS (SELECT doc_id, count(*) AS known FROM toks GROUP BY doc_id),
gains AS (SELECT t.doc_id, g.label, sum(gain) AS gain FROM toks t JOIN gain g USING (word) GROUP BY ALL),
scored AS (
  SELECT doc_id, lang, label, log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0) AS score
  FROM documents CROSS JOIN prior LEFT JOIN known USING (doc_id) LEFT JOIN gains USING (doc_id, label))"""


def bags(spark: SparkSession, sf_dir: str, folds: int = 0) -> DataFrame:
    """Documents as word lists with their author, written once for all stages; with ``folds`` also their fold (0..folds-1)."""
    books = st.books(spark, sf_dir).select("doc_id", "author", "content")
    books = author_folds(books, folds) if folds else books
    return staged(books.select("*", tx.tokens(F.col("content")).alias("words")).drop("content"), "author-words")


@job(
    "author_nb_mllib",
    f"""WITH {AUTHOR_TERMS} SELECT doc_id, lang AS author, label AS predicted FROM scored
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1""",
)
def author_nb_mllib(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MLlib naive Bayes on the 10,000 most frequent words of at least two documents."""
    rows = bags(spark, sf_dir)
    bag = au.fixed_bag(rows, F.col("words"))
    indexer = au.label_indexer("author").fit(rows)
    vectors = staged(indexer.transform(bag.transform(rows)).drop("words"), "author-vectors")
    found = au.naive_bayes(0.2).fit(vectors).transform(vectors)
    return au.named_predictions(found, indexer.labels).select("doc_id", "author", "predicted")


@job("linear_sgd_reaimed")
def linear_sgd_reaimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear classifier of the sentiment from word counts: metrics on training and test rows."""
    rows = staged(
        st.tweets(spark, sf_dir).select("doc_id", "sentiment", tx.tokens_2plus(F.col("text")).alias("words")),
        "tweet-words",
    )
    parts = rows.withColumn("part", sp.split_column("doc_id", {"train": 0.8, "test": 0.2}, seed=42))
    training = parts.where("part = 'train'")
    bag = au.fixed_bag(training, F.col("words"), 10_000, 1)
    vectors = bag.transform(parts).select("part", F.col("sentiment").alias("label"), "features")
    vectors = staged(vectors, "tweet-vectors")
    model = lg.linear_classifier("label", classes=2).fit(vectors.where("part = 'train'"))
    found = model.transform(vectors)
    tables = []
    for part in ("train", "test"):
        cells = mt.confusion(found.where(F.col("part") == part), "label", "prediction")
        tables.append(mt.class_summary(mt.per_class(cells)).select(F.lit(part).alias("part"), "*"))
    return union_all(tables)


@job("linear_perceptron")
def linear_perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averaged perceptron of the sentiment from word counts, 3 stratified folds: class metrics of each fold and of its rest."""
    rows = st.tweets(spark, sf_dir).select("doc_id", F.col("sentiment").alias("class"), tx.tokens_2plus(F.col("text")).alias("words"))
    rows = staged(sp.stratified_folds(rows, "doc_id", "class", 3, seed=42), "tweet-words")
    terms = [r.word for r in wd.vocabulary(rows, F.col("words"), 10_000).select("word").collect()]
    coded = staged(wd.coded(rows, "words", terms), "tweet-counts")
    tables = []
    for fold in (1, 2, 3):
        model = pc.fit(coded.where(F.col("fold") != fold), F.col("doc_id"), len(terms), 2, l2=1e-3)
        found = pc.predicted(coded, model).withColumn("part", F.when(F.col("fold") == fold, "test").otherwise("train"))
        cells = mt.confusion(found, "class", "prediction", ("part",))
        tables.append(mt.class_summary(mt.per_class(cells, ("part",)), ("part",)).select(F.lit(fold).alias("fold"), "*"))
    return union_all(tables)


def author_folds(rows: DataFrame, folds: int) -> DataFrame:
    return sp.stratified_folds(rows, "doc_id", "author", folds, seed=1).withColumn("fold", F.col("fold") - 1)


@job(
    "cv_nb_fixed",
    f"""WITH {AUTHOR_TERMS}, k AS (SELECT CAST(unnest(range(1, 4)) AS INT) AS fold),
own AS (SELECT doc_id, lang, ntile(3) OVER (PARTITION BY lang ORDER BY md5(doc_id || ':1')) AS own FROM documents),
ftoks AS (SELECT doc_id, own, label, word FROM toks JOIN own USING (doc_id)),
fn AS (SELECT fold, label, word, count(*) AS n FROM ftoks, k WHERE own <> fold GROUP BY ALL),
ft AS (SELECT fold, label, sum(n) AS words FROM fn GROUP BY ALL),
fp AS (
  SELECT fold, label, words, ln((docs + 0.2) / (sum(docs) OVER (PARTITION BY fold) + 0.2 * count(*) OVER (PARTITION BY fold))) AS log_prior,
         ln(0.2 / (words + 0.2 * v)) AS log_default
  FROM (SELECT fold, lang AS label, count(*) AS docs FROM own, k WHERE own <> fold GROUP BY ALL) JOIN ft USING (fold, label), v),
fg AS (SELECT fold, label, word, ln((n + 0.2) / (words + 0.2 * v)) - log_default AS gain FROM fn JOIN fp USING (fold, label), v),
fgains AS (SELECT t.doc_id, g.fold, g.label, sum(gain) AS gain FROM ftoks t JOIN fg g ON t.word = g.word AND t.own = g.fold GROUP BY ALL),
fs AS (
  SELECT o.doc_id, o.lang, p.fold, p.label, log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0) AS score
  FROM own o JOIN fp p ON o.own = p.fold LEFT JOIN known USING (doc_id)
  LEFT JOIN fgains g ON g.doc_id = o.doc_id AND g.fold = p.fold AND g.label = p.label),
fr AS (SELECT fold, lang, label FROM fs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1),
cells AS (
  SELECT fold, c.class, count(*) FILTER (lang = c.class) AS support, count(*) FILTER (label = c.class) AS predicted,
         count(*) FILTER (lang = c.class AND label = c.class) AS tp
  FROM fr, (SELECT DISTINCT lang AS class FROM documents) c GROUP BY ALL),
f1 AS (SELECT fold, sum(support * coalesce(2 * tp / nullif(predicted + support, 0), 0)) / sum(support) AS f1 FROM cells GROUP BY fold)
SELECT round(avg(f1), 6) AS mean FROM f1""",
)
def cv_nb_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes over 3 stratified folds with a vocabulary whose ties are broken by word: the mean F1."""
    rows = bags(spark, sf_dir, folds=3)
    vectors = staged(au.fixed_bag(rows, F.col("words")).transform(rows).select("author", "fold", "features"), "author-vectors")
    pipeline = Pipeline(stages=[au.label_indexer("author"), au.naive_bayes(0.2)])
    judge = MulticlassClassificationEvaluator(metricName="f1")
    maps = tu.grid([])
    model = tu.cross_validate(pipeline, maps, judge, vectors, folds=3, fold_col="fold")
    return tu.grid_table(vectors, model, maps).select(F.round("mean", 6).alias("mean"))


@job("cv_nb")
def cv_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes over 3 stratified folds, F1."""
    rows = bags(spark, sf_dir, folds=3)
    # All that any training set may choose: every fit takes its own 10,000 words from these.
    terms = wd.top_words_outside(rows, "words", "fold", 3, 10_000, 2)
    terms = [r.word for r in terms.collect()]
    counts = staged(wd.coded(rows.select("author", "fold", "words"), "words", terms), "author-counts")
    pipeline = Pipeline(stages=[au.label_indexer("author"), au.TopTerms(10_000, 2), au.naive_bayes(0.2)])
    maps = tu.grid([])
    judge = MulticlassClassificationEvaluator(metricName="f1")
    model = tu.cross_validate(pipeline, maps, judge, counts, folds=3, fold_col="fold")
    return tu.grid_table(counts, model, maps)


@job("author_metrics_union")
def author_metrics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same naive Bayes pipeline trained and tested on two data sets, their metrics under each other."""
    books = st.books(spark, sf_dir).select(
        "doc_id", "author", "work", tx.tokens(F.col("content")).alias("words"),
        sp.split_column("doc_id", {"train": 0.8, "test": 0.2}, seed=1).alias("part"),
    )
    books = staged(books, "book-words")
    rows = []
    for name, target in (("authors", "author"), ("works", "work")):
        bag = CountVectorizer(inputCol="words", outputCol="features", vocabSize=10_000, minDF=2)
        indexer = au.label_indexer(target).setHandleInvalid("skip")
        model = Pipeline(stages=[bag, indexer, au.naive_bayes(0.2)]).fit(books.where("part = 'train'"))
        rows.append(au.metrics_row(name, model, books.where("part = 'test'")))
    return union_all(rows)


def _author_metrics_sql(name: str, target: str) -> str:
    """SQL: naive Bayes of ``target`` on 80 % of the documents and a fixed vocabulary, measured on the rest."""
    return f"""{name}_rows AS (SELECT doc_id, {target} AS label, text, {SPLIT.format(k="doc_id", seed=1, w=0.8)} AS part FROM documents),
{name}_all AS (SELECT doc_id, label, part, unnest({TOKENS}) AS word FROM {name}_rows),
{name}_terms AS (
  SELECT word FROM {name}_all WHERE part = 'train' GROUP BY word HAVING count(DISTINCT doc_id) >= 2
  ORDER BY count(*) DESC, word LIMIT 10000),
{name}_toks AS (SELECT * FROM {name}_all SEMI JOIN {name}_terms USING (word)),
{name}_n AS (SELECT label, word, count(*) AS n FROM {name}_toks WHERE part = 'train' GROUP BY ALL),
{name}_t AS (SELECT label, sum(n) AS words FROM {name}_n GROUP BY label),
{name}_v AS (SELECT count(*) AS v FROM {name}_terms),
{name}_p AS (
  SELECT label, docs, words, ln((docs + 0.2) / (sum(docs) OVER () + 0.2 * count(*) OVER ())) AS log_prior,
         ln(0.2 / (words + 0.2 * v)) AS log_default
  FROM (SELECT label, count(*) AS docs FROM {name}_rows WHERE part = 'train' GROUP BY label) JOIN {name}_t USING (label), {name}_v),
{name}_g AS (
  SELECT label, word, ln((n + 0.2) / (words + 0.2 * v)) - log_default AS gain FROM {name}_n JOIN {name}_p USING (label), {name}_v),
{name}_known AS (SELECT doc_id, count(*) AS known FROM {name}_toks WHERE part = 'test' GROUP BY doc_id),
{name}_gains AS (SELECT t.doc_id, g.label, sum(gain) AS gain FROM {name}_toks t JOIN {name}_g g USING (word) WHERE part = 'test' GROUP BY ALL),
{name}_s AS (
  SELECT r.doc_id, r.label, p.label AS found, docs, log_prior + coalesce(known, 0) * log_default + coalesce(gain, 0) AS score
  FROM {name}_rows r CROSS JOIN {name}_p p LEFT JOIN {name}_known USING (doc_id)
  LEFT JOIN {name}_gains g ON g.doc_id = r.doc_id AND g.label = p.label
  WHERE r.part = 'test' AND r.label IN (SELECT label FROM {name}_p)),
{name}_f AS (SELECT label, found FROM {name}_s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, docs DESC, found) = 1),
{name}_c AS (
  SELECT c.label AS class, count(*) FILTER (f.label = c.label) AS support, count(*) FILTER (found = c.label) AS predicted,
         count(*) FILTER (f.label = c.label AND found = c.label) AS tp FROM {name}_f f, {name}_p c GROUP BY ALL),
{name}_m AS (
  SELECT '{name}' AS data_set, round(sum(tp) / sum(support), 6) AS accuracy,
         round(sum(support * coalesce(tp / nullif(predicted, 0), 0)) / sum(support), 6) AS weighted_precision,
         round(sum(support * coalesce(2 * tp / nullif(predicted + support, 0), 0)) / sum(support), 6) AS f1 FROM {name}_c)"""


@job(
    "author_metrics_fixed",
    f"WITH {_author_metrics_sql('authors', 'lang')}, {_author_metrics_sql('works', 'source')} "
    "SELECT * FROM authors_m UNION ALL SELECT * FROM works_m",
)
def author_metrics_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes of authors and of works on a vocabulary with fixed ties, each measured on held-out documents."""
    books = st.books(spark, sf_dir).select(
        "doc_id", "author", "work", tx.tokens(F.col("content")).alias("words"),
        sp.split_column("doc_id", {"train": 0.8, "test": 0.2}, seed=1).alias("part"),
    )
    books = staged(books, "book-words")
    training, test = books.where("part = 'train'"), books.where("part = 'test'")
    bag = au.fixed_bag(training, F.col("words"))
    rows = []
    for name, target in (("authors", "author"), ("works", "work")):
        indexer = au.label_indexer(target).setHandleInvalid("skip")
        model = Pipeline(stages=[bag, indexer, au.naive_bayes(0.2)]).fit(training)
        metrics = au.metrics_row(name, model, test)
        rows.append(metrics.select(
            F.col("Filename").alias("data_set"), F.round("Accuracy", 6).alias("accuracy"),
            F.round("Weighted Precision", 6).alias("weighted_precision"), F.round("F1 Score", 6).alias("f1"),
        ))
    return union_all(rows)
