"""Classification metrics, thresholds, scoring, sampling and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import maths as mx
from quern.functions import time as tm
from quern.operators import metrics as mt
from quern.operators import sampling as sp
from quern.operators.circle import circle_share, even_points, hash_points
from quern.operators.relational import top, union_all
from quern.plans import standins as st
from quern.plans.registry import job
from quern.sources.staging import staged
from quern.sources.tables import table, text_table

# Language guessed from one frequent short word: predictions for the class metrics.
GUESS = """guessed AS (
  SELECT doc_id, lang AS label, CASE WHEN contains(lower(text), ' the ') THEN 'en'
    WHEN contains(lower(text), ' der ') THEN 'de' WHEN contains(lower(text), ' le ') THEN 'fr' ELSE 'es' END
    AS prediction FROM documents),
cells AS (SELECT label, prediction, count(*) AS count FROM guessed GROUP BY ALL)"""


def _guessed(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lower("text")
    guess = (
        F.when(F.contains(text, F.lit(" the ")), "en")
        .when(F.contains(text, F.lit(" der ")), "de")
        .when(F.contains(text, F.lit(" le ")), "fr")
        .otherwise("es")
    )
    docs = text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("lang").alias("label"), guess.alias("prediction"))


@job("confusion", f"WITH {GUESS} SELECT * FROM cells")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.confusion(_guessed(spark, sf_dir), "label", "prediction")


PER_CLASS = f"""{GUESS}, classes AS (
  SELECT class, CAST(coalesce(support, 0) AS BIGINT) AS support, CAST(coalesce(predicted, 0) AS BIGINT) AS predicted,
         CAST(coalesce(tp, 0) AS BIGINT) AS tp
  FROM (SELECT label AS class, sum(count) AS support FROM cells GROUP BY 1)
  FULL JOIN (SELECT prediction AS class, sum(count) AS predicted FROM cells GROUP BY 1) USING (class)
  LEFT JOIN (SELECT label AS class, sum(count) AS tp FROM cells WHERE label = prediction GROUP BY 1) USING (class)),
per_class AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * tp / (support + predicted) END AS f1 FROM classes)"""


@job(
    "per_class",
    f"""WITH {PER_CLASS} SELECT class, support, predicted, tp, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM per_class""",
)
def per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = mt.per_class(mt.confusion(_guessed(spark, sf_dir), "label", "prediction"))
    return classes.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


SUMMARY = """round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(support * precision) / sum(support), 6) AS weighted_precision,
  round(sum(support * recall) / sum(support), 6) AS weighted_recall,
  round(sum(support * f1) / sum(support), 6) AS weighted_f1, round(avg(precision), 6) AS macro_precision,
  round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1"""


def _summary(df: DataFrame, label: str, prediction: str) -> DataFrame:
    row = mt.class_summary(mt.per_class(mt.confusion(df, label, prediction)))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@job("macro_metrics", f"WITH {PER_CLASS} SELECT {SUMMARY} FROM per_class")
def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(_guessed(spark, sf_dir), "label", "prediction")


# Fixed weights of the scoring jobs, and the decision threshold.
WEIGHTS = {"n_chars": 0.0004, "n_words": -0.002}
INTERCEPT = 0.4
THRESHOLD = 0.530044012725942

LOGIT = f"""{st.EXAM}, logits AS (
  SELECT *, 0.4::DOUBLE + 0.0004::DOUBLE * n_chars + -0.002::DOUBLE * n_words AS z FROM exam),
scored AS (SELECT *, 1.0 / (1.0 + exp(-z)) AS p1 FROM logits)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = st.exam(spark, sf_dir).withColumn("z", mx.linear_score(WEIGHTS, INTERCEPT))
    return scored.withColumn("p1", mx.logistic(F.col("z")))


@job(
    "logit_score",
    f"""WITH {LOGIT} SELECT doc_id, result, round(z, 6) AS logit, round(p1, 6) AS p1,
  CASE WHEN p1 > {THRESHOLD} THEN 1 ELSE 0 END::INT AS prediction FROM scored""",
)
def logit_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select(
        "doc_id",
        "result",
        F.round("z", 6).alias("logit"),
        F.round("p1", 6).alias("p1"),
        F.when(F.col("p1") > THRESHOLD, 1).otherwise(0).alias("prediction"),
    )


@job(
    "logit_diagnostics",
    f"""WITH {LOGIT} SELECT doc_id, round(z, 6) AS logit, round(1 - p1, 6) AS p0, round(p1, 6) AS p1,
  round(greatest(p1, 1 - p1), 6) AS prob, (z > 0)::INT AS label FROM scored""",
)
def logit_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per row: logit, both probabilities, the larger one, and the label of the larger raw score."""
    p1 = F.col("p1")
    return _scored(spark, sf_dir).select(
        "doc_id",
        F.round("z", 6).alias("logit"),
        F.round(1 - p1, 6).alias("p0"),
        F.round(p1, 6).alias("p1"),
        F.round(F.array_max(F.array(1 - p1, p1)), 6).alias("prob"),
        F.when(F.col("z") > 0, 1).otherwise(0).alias("label"),
    )


@job(
    "odds_ratio",
    f"""WITH {st.EXAM}, long AS (
  SELECT unnest(['long_text', 'many_words', 'late_day']) AS feature,
         unnest([n_chars > 500, n_words > 60, exam_day > DATE '2016-01-28']) AS flag, result FROM exam),
cells AS (
  SELECT feature, count(*) FILTER (flag AND result = 1) + 0.5::DOUBLE AS a,
         count(*) FILTER (flag AND result = 0) + 0.5::DOUBLE AS b,
         count(*) FILTER (NOT flag AND result = 1) + 0.5::DOUBLE AS c,
         count(*) FILTER (NOT flag AND result = 0) + 0.5::DOUBLE AS d FROM long GROUP BY feature)
SELECT feature, round(ln(a * d / (b * c)), 6) AS coefficient, round(a * d / (b * c), 6) AS odds_ratio,
  round((a * d / (b * c) - 1) * 100, 4) AS percent FROM cells""",
)
def odds_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logit coefficient of single 0/1 features (from their counts, half a case added), as odds ratios."""
    flags = F.array(
        F.struct(F.lit("long_text").alias("feature"), (F.col("n_chars") > 500).alias("flag")),
        F.struct(F.lit("many_words").alias("feature"), (F.col("n_words") > 60).alias("flag")),
        F.struct(
            F.lit("late_day").alias("feature"),
            (F.col("exam_day") > F.lit("2016-01-28").cast("date")).alias("flag"),
        ),
    )

    def cell(flag: Column, result: int) -> Column:
        return F.count_if(flag & (F.col("result") == result)) + F.lit(0.5)

    flag = F.col("flag")
    coefficients = (
        st.exam(spark, sf_dir)
        .select("result", F.inline(flags))
        .groupBy("feature")
        .agg(F.log(cell(flag, 1) * cell(~flag, 0) / (cell(flag, 0) * cell(~flag, 1))).alias("coefficient"))
    )
    c = F.col("coefficient")
    return coefficients.select(
        "feature",
        F.round(c, 6).alias("coefficient"),
        F.round(mx.odds_ratio(c), 6).alias("odds_ratio"),
        F.round(mx.odds_percent(c), 4).alias("percent"),
    )


@job(
    "binary_rates",
    f"""WITH {LOGIT}, cells AS (
  SELECT count(*) FILTER (p1 > {THRESHOLD} AND result = 1) AS tp, count(*) FILTER (p1 > {THRESHOLD} AND result = 0) AS fp,
         count(*) FILTER (p1 <= {THRESHOLD} AND result = 0) AS tn, count(*) FILTER (p1 <= {THRESHOLD} AND result = 1) AS fn
  FROM scored)
SELECT *, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS tpr,
  round(CASE WHEN fp + tn = 0 THEN 0 ELSE fp / (fp + tn) END, 6) AS fpr FROM cells""",
)
def binary_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    called = _scored(spark, sf_dir).withColumn("called", F.when(F.col("p1") > THRESHOLD, 1).otherwise(0))
    rates = mt.binary_rates(called, "result", "called")
    return rates.withColumns({c: F.round(c, 6) for c in ("tpr", "fpr")})


CURVE = f"""{st.EXAM}, per_score AS (
  SELECT n_chars AS threshold, sum(result) AS pos, sum(1 - result) AS neg FROM exam GROUP BY 1),
curve AS (
  SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp,
         sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM per_score)"""


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.threshold_counts(st.exam(spark, sf_dir), "n_chars", "result")


@job(
    "roc_curve",
    f"""WITH {CURVE} SELECT round(fp / n, 6) AS "FPR", round(tp / p, 6) AS "TPR" FROM curve
UNION ALL SELECT 0.0, 0.0""",
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.roc(_curve(spark, sf_dir)).select(F.round("FPR", 6).alias("FPR"), F.round("TPR", 6).alias("TPR"))


@job("auc", f"WITH {CURVE} SELECT round(sum(neg * (tp - pos / 2.0)) / any_value(p) / any_value(n), 6) AS auc FROM curve")
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.area_under_roc(_curve(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


@job(
    "f_by_threshold",
    f"""WITH {CURVE} SELECT threshold, round(2 * tp / (tp + fp + p), 6) AS "F-Measure" FROM curve""",
)
def f_by_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mt.f_by_threshold(_curve(spark, sf_dir)).withColumn("F-Measure", F.round("F-Measure", 6))


@job(
    "f_by_threshold_page",
    f"""WITH {CURVE} SELECT threshold, round(2 * tp / (tp + fp + p), 6) AS "F-Measure" FROM curve
ORDER BY threshold DESC LIMIT 20 OFFSET 30""",
)
def f_by_threshold_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty thresholds after the first thirty, from the highest down."""
    measures = mt.f_by_threshold(_curve(spark, sf_dir)).withColumn("F-Measure", F.round("F-Measure", 6))
    return top(measures, 20, F.desc("threshold"), skip=30)


@job(
    "best_threshold",
    f"""WITH {CURVE}, f AS (SELECT threshold, round(2 * tp / (tp + fp + p), 6) AS "F-Measure" FROM curve)
SELECT * FROM f ORDER BY "F-Measure" DESC, threshold LIMIT 1""",
)
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = mt.f_by_threshold(_curve(spark, sf_dir)).withColumn("F-Measure", F.round("F-Measure", 6))
    return mt.best_threshold(measures)


def _metric_row(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS "Filename", round(sum(tp) / sum(support), 6) AS "Accuracy",
  round(sum(support * p) / sum(support), 6) AS "Weighted Precision",
  round(sum(support * r) / sum(support), 6) AS "Weighted Recall", round(sum(support * f) / sum(support), 6) AS "F1 Score"
FROM (SELECT k, support, tp, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS p,
        CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r,
        CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f
      FROM (SELECT k, count(*) FILTER (result = k) AS support, count(*) FILTER (({condition})::INT = k) AS predicted,
              count(*) FILTER (result = k AND ({condition})::INT = k) AS tp FROM exam, range(2) q(k) GROUP BY k))"""


RULES = {"long": "n_chars > 500", "wordy": "n_words > 60", "any": "n_chars > 0"}


@job("union_metrics", f"WITH {st.EXAM} " + " UNION ALL ".join(_metric_row(n, c) for n, c in RULES.items()))
def union_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics row per rule, under each other."""
    exam = staged(st.exam(spark, sf_dir), "exam")
    rows = []
    for name, condition in RULES.items():
        called = exam.withColumn("called", F.expr(f"int({condition})"))
        summary = _summary(called, "result", "called")
        rows.append(
            summary.select(
                F.lit(name).alias("Filename"),
                F.col("accuracy").alias("Accuracy"),
                F.col("weighted_precision").alias("Weighted Precision"),
                F.col("weighted_recall").alias("Weighted Recall"),
                F.col("weighted_f1").alias("F1 Score"),
            )
        )
    return union_all(rows)


@job(
    "fold_means",
    f"""WITH {st.EXAM}, folds AS (
  SELECT *, ntile(10) OVER (PARTITION BY result ORDER BY md5(doc_id || ':5')) AS fold FROM exam)
SELECT count(*) AS folds, round(avg(a), 6) AS mean_accuracy, round(min(a), 6) AS min_accuracy, round(max(a), 6) AS max_accuracy
FROM (SELECT fold, avg(CASE WHEN (n_chars > 500)::INT = result THEN 1 ELSE 0 END) AS a FROM folds GROUP BY fold)""",
)
def fold_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy per stratified fold, averaged over the folds."""
    folded = sp.stratified_folds(st.exam(spark, sf_dir), "doc_id", "result", 10, seed=5)
    right = F.when(F.expr("int(n_chars > 500)") == F.col("result"), 1).otherwise(0)
    per_fold = folded.groupBy("fold").agg(F.avg(right).alias("a"))
    return per_fold.agg(
        F.count("*").alias("folds"),
        F.round(F.avg("a"), 6).alias("mean_accuracy"),
        F.round(F.min("a"), 6).alias("min_accuracy"),
        F.round(F.max("a"), 6).alias("max_accuracy"),
    )


# --- sampling, splits, folds -------------------------------------------------------------------

MD5_8 = "('0x' || substr(md5({k} || ':{seed}'), 1, 8))::BIGINT"


@job(
    "md5_sample",
    f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {MD5_8.format(k='o_orderkey', seed=11)} % 1000 < 5",
)
def md5_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.sample(table(spark, sf_dir, "orders"), "o_orderkey", 5, seed=11).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@job("md5_shuffle", "SELECT o_orderkey, row_number() OVER (ORDER BY md5(o_orderkey || ':1')) AS shuffle_pos FROM orders")
def md5_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.shuffled(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", seed=1)


@job(
    "head_split",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || ':3')) <=
  floor((SELECT count(*) FROM orders) * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM orders""",
)
def head_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 70 % of a seeded shuffle for training, the rest for testing."""
    return sp.head_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 0.7, seed=3)


@job(
    "train_test_split",
    f"""SELECT doc_id, CASE WHEN {MD5_8.format(k='doc_id', seed=123)} / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END
  AS part FROM documents""",
)
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.withColumn("part", sp.split_column("doc_id", {"train": 0.7, "test": 0.3}, seed=123))


@job(
    "stratified_folds",
    """SELECT doc_id, quality, CAST(ntile(10) OVER (PARTITION BY quality ORDER BY md5(doc_id || ':9')) AS INT) AS fold
FROM labels""",
)
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sp.stratified_folds(labels, "doc_id", "quality", 10, seed=9)


@job(
    "ordered_stratified_folds",
    "SELECT doc_id, quality, CAST(ntile(10) OVER (PARTITION BY quality ORDER BY doc_id) AS INT) AS fold FROM labels",
)
def ordered_stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return sp.ordered_stratified_folds(labels, "doc_id", "quality", 10)


@job("plain_folds", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) AS INT) AS fold FROM orders")
def plain_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp.plain_folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


@job(
    "offset_page",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 30""",
)
def offset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top(orders, 20, F.desc("o_totalprice"), "o_orderkey", skip=30)


@job("offset_rest", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey OFFSET 1000")
def offset_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything after the first thousand rows."""
    return sp.skip_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 1000)


@job(
    "random_split",
    """SELECT count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, 0::BIGINT AS in_both, true AS share_as_asked FROM orders""",
)
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of Spark's own seeded split on any layout: nothing lost, nothing twice, about the shares asked for."""
    orders = staged(table(spark, sf_dir, "orders").select("o_orderkey"), "split-orders")
    train, test = sp.random_split(orders, [0.7, 0.3], seed=123)
    parts = train.select("o_orderkey", F.lit(1).alias("a"), F.lit(0).alias("b")).union(test.select("o_orderkey", F.lit(0), F.lit(1)))
    keyed = parts.groupBy("o_orderkey").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows, share = F.sum(F.col("a") + F.col("b")), F.sum("a") / F.sum(F.col("a") + F.col("b"))
    return keyed.agg(
        rows.alias("rows"),
        F.sum(F.col("o_orderkey") * (F.col("a") + F.col("b"))).alias("keys"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("in_both"),
        (F.abs(share - 0.7) < 4 * F.sqrt(0.21 / rows)).alias("share_as_asked"),
    )


# --- pi ------------------------------------------------------------------------------------------

LINE_KEY = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber || ':17'"


@job(
    "monte_carlo_pi",
    f"""WITH points AS (
  SELECT ('0x' || substr(md5({LINE_KEY}), 1, 8))::BIGINT / 4294967296.0 * 2 - 1 AS x,
         ('0x' || substr(md5({LINE_KEY}), 9, 8))::BIGINT / 4294967296.0 * 2 - 1 AS y FROM lineitem)
SELECT count(*) AS samples, count(*) FILTER (x * x + y * y < 1) AS inside,
  round(4.0 * count(*) FILTER (x * x + y * y < 1) / count(*), 6) AS pi FROM points""",
)
def monte_carlo_pi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed random point per line item; the share inside the circle."""
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")])
    return circle_share(hash_points(table(spark, sf_dir, "lineitem"), key, seed=17))


@job(
    "pi_low_discrepancy",
    """WITH points AS (
  SELECT (o_orderkey * 0.7548776662466927::DOUBLE) % 1 * 2 - 1 AS x,
         (o_orderkey * 0.5698402909980532::DOUBLE) % 1 * 2 - 1 AS y FROM orders)
SELECT count(*) AS samples, count(*) FILTER (x * x + y * y <= 1) AS inside,
  round(4.0 * count(*) FILTER (x * x + y * y <= 1) / count(*), 6) AS pi FROM points""",
)
def pi_low_discrepancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circle_share(even_points(table(spark, sf_dir, "orders"), F.col("o_orderkey")), closed=True)


@job(
    "exam_unix_time",
    f"""WITH {st.EXAM} SELECT doc_id, exam_day, CAST(epoch(exam_day) AS BIGINT) AS timestamp,
  CAST(CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END AS INT) AS long_text,
  CASE WHEN result = 0 THEN 'Nie zdał' ELSE 'Zdał' END AS "Wynik" FROM exam""",
)
def exam_unix_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date as seconds since 1970, a 0/1 column and a two-valued text."""
    return st.exam(spark, sf_dir).select(
        "doc_id",
        "exam_day",
        tm.utc_epoch(F.col("exam_day")).alias("timestamp"),
        F.when(F.col("n_chars") >= 500, 1).otherwise(0).alias("long_text"),
        F.when(F.col("result") == 0, "Nie zdał").otherwise("Zdał").alias("Wynik"),
    )
