"""Scans, sinks, projections, lookups and table descriptions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import text as tx
from quern.operators import profile as pf
from quern.operators import relational as rel
from quern.plans import standins as st
from quern.plans.registry import job
from quern.sources import batches, csv, inline, staging
from quern.sources.tables import TABLES, table, text_table


@job(
    "projection_basics",
    """SELECT c_custkey AS customer, lower(c_name) AS c_name, c_nationkey, c_acctbal,
  CASE WHEN c_acctbal >= 0 THEN 'credit' ELSE 'debt' END AS side FROM customer WHERE c_acctbal IS NOT NULL""",
)
def projection_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Computed, renamed and dropped columns; dropping an absent one does nothing."""
    customer = table(spark, sf_dir, "customer")
    shaped = (
        customer.where(F.col("c_acctbal").isNotNull())
        .withColumn("c_name", F.lower("c_name"))
        .withColumn("side", F.when(F.col("c_acctbal") >= 0, "credit").otherwise("debt"))
        .withColumnRenamed("c_custkey", "customer")
        .drop("c_mktsegment", "no_such_column")
    )
    return shaped.select("customer", *rel.all_but(shaped, "customer"))


@job(
    "summary_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
  CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM orders"""
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ),
)
def summary_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pf.numeric_profile(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return rows.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@job(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES),
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.union_all([pf.row_count(table(spark, sf_dir, t), t) for t in TABLES])


@job(
    "first_by_key",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return pf.first_by_key(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderdate", "o_orderkey", "o_totalprice"]
    )


@job("lower_key", "SELECT lower(p_brand) AS brand, upper(p_type) AS type, count(*) AS count FROM part GROUP BY ALL")
def lower_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.groupBy(F.lower("p_brand").alias("brand"), F.upper("p_type").alias("type")).count()


@job(
    "lookup_default",
    """SELECT CASE WHEN lower(event_type) IN ('click', 'view') THEN lower(event_type) ELSE '*' END AS kind,
  count(*) AS count FROM events GROUP BY 1""",
)
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known keys keep their own entry, all others use the one under ``*``."""
    known = inline.from_strings(spark, ["click", "view"], "kind")
    marked = rel.lookup_with_default(table(spark, sf_dir, "events"), known, F.col("event_type"), "kind")
    return marked.groupBy("kind").count()


@job(
    "inline_tables",
    """SELECT o_orderpriority, coalesce(weight, 1)::INT AS weight, o_orderstatus IN ('F', 'O') AS listed, count(*) AS count
FROM orders LEFT JOIN (VALUES ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) w(p, weight) ON o_orderpriority = p
GROUP BY ALL""",
)
def inline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders joined with a table built from rows (default 1) and marked by one built from strings."""
    weights = inline.from_rows(
        spark, [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], "o_orderpriority STRING, weight INT"
    )
    wanted = inline.from_strings(spark, ["F", "O"], "o_orderstatus").withColumn("listed", F.lit(True))
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")
    # Both tables are literals of this function.
    found = orders.join(F.broadcast(wanted), "o_orderstatus", "left").join(F.broadcast(weights), "o_orderpriority", "left")
    found = found.withColumns({"weight": F.coalesce("weight", F.lit(1)), "listed": F.coalesce("listed", F.lit(False))})
    return found.groupBy("o_orderpriority", "weight", "listed").count()


@job(
    "csv_roundtrip",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice, o_orderpriority FROM orders""",
)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with ``;``, read back with a declared schema including a date."""
    path = staging.fresh_path(spark, "orders-csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice", "o_orderpriority"
    )
    csv.write_csv(orders, path, delimiter=";")
    schema = "o_orderkey BIGINT, o_orderdate DATE, o_totalprice DOUBLE, o_orderpriority STRING"
    return csv.read_csv(spark, path, schema, delimiter=";", required=("o_orderkey", "o_orderdate"))


@job(
    "csv_gzip_inferred",
    "SELECT CAST(p_partkey AS INT) AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
)
def csv_gzip_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip files are one task each: the rows are dealt out after the scan. Types are inferred."""
    path = staging.fresh_path(spark, "part-csv-gz")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    part.write.option("header", True).option("compression", "gzip").csv(path)
    return csv.read_csv(spark, path, partitions=spark.sparkContext.defaultParallelism)


@job(
    "csv_apostrophes",
    """SELECT c_custkey, '''' || c_name || '''' AS quoted, 'it''s, ' || c_mktsegment AS inner_sign FROM customer""",
)
def csv_apostrophes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the default quote sign apostrophes stay part of the value."""
    path = staging.fresh_path(spark, "customer-csv")
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("'"), "c_name", F.lit("'")).alias("quoted"),
        F.concat(F.lit("it's, "), "c_mktsegment").alias("inner_sign"),
    )
    csv.write_csv(customer, path)
    return csv.read_csv(spark, path, "c_custkey BIGINT, quoted STRING, inner_sign STRING")


@job("csv_single_quotes", "SELECT conv_id, turn, role, md5(text) AS text_md5 FROM conversations")
def csv_single_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files quoted with ``'``, with delimiters and line breaks inside the texts."""
    path = staging.fresh_path(spark, "turns-csv")
    turns = text_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns.write.option("header", True).option("quote", "'").option("escape", "\\").csv(path)
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    back = csv.read_csv(spark, path, schema, quote="'", multiline=True)
    return back.select("conv_id", "turn", "role", F.md5("text").alias("text_md5"))


def _count_words(batch: pd.DataFrame) -> pd.DataFrame:
    words = batch["text"].str.split().str.len()
    return pd.DataFrame({"lang": batch["lang"], "words": words}).groupby("lang", as_index=False).agg(
        rows=("words", "size"), words=("words", "sum")
    )


@job(
    "batch_iter",
    f"SELECT lang, count(*) AS rows, CAST(sum(len({st.DUCK_WORDS})) AS BIGINT) AS words FROM documents GROUP BY lang",
)
def batch_iter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word totals from pandas batches of at most 256 rows, added up afterwards."""
    docs = text_table(spark, sf_dir, "documents").select("lang", "text")
    partial = batches.map_batches(docs, _count_words, "lang STRING, rows BIGINT, words BIGINT", 256)
    return partial.groupBy("lang").agg(F.sum("rows").alias("rows"), F.sum("words").alias("words"))


@job(
    "rows_with_words",
    f"SELECT conv_id, turn, role, len({st.DUCK_WORDS})::INT AS word_count, list_aggregate({st.DUCK_WORDS}, 'string_agg', ' ') AS words FROM conversations",
)
def rows_with_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its words (joined by blanks) and their number."""
    words = tx.words(F.col("text"))
    return text_table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.size(words).alias("word_count"), F.array_join(words, " ").alias("words")
    )


@job("first_rows", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 25")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows in the order of a key: a bounded heap per task."""
    return rel.top(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 25, "o_orderkey")
