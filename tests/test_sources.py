"""CSV options, inline tables, ranges, batches, staging."""

import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from quern.sources import batches, csv, inline, ranges, schemas, staging, tables


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_semicolon_and_date(spark, tmp_path):
    path = write(tmp_path / "e.csv", "ImieNazwisko;OcenaC;DataC;OcenaCpp;Egzamin\nX Y;3.5;2016-01-14;4;3\n")
    row = csv.read_csv(spark, path, schemas.EXAM, delimiter=";").first()
    assert (row.OcenaC, row.DataC, row.Egzamin) == (3.5, datetime.date(2016, 1, 14), 3.0)


def test_apostrophes_are_data_by_default_and_quotes_on_request(spark, tmp_path):
    path = write(tmp_path / "g.csv", "a,b\n'x,y',2\n")
    assert csv.read_csv(spark, path, "a STRING, b STRING").first().a == "'x"
    assert csv.read_csv(spark, path, "a STRING, b INT", quote="'").first().a == "x,y"


def test_inferred_gzip_is_spread(spark, tmp_path):
    path = tmp_path / "x.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("country,year,v\n" + "".join(f"P{i},{2000 + i},{i}.5\n" for i in range(50)))
    df = csv.read_csv(spark, str(path), partitions=4)
    assert dict(df.dtypes) == {"country": "string", "year": "int", "v": "double"}
    assert df.rdd.getNumPartitions() == 4 and df.count() == 50


def test_required_columns_fail_on_empty_values(spark, tmp_path):
    path = write(tmp_path / "r.csv", "userId,MovieId,rating,timestamp\n1,2,3.5,4\n,2,3.5,4\n")
    assert csv.read_csv(spark, path, schemas.RATINGS).count() == 2
    with pytest.raises(Exception, match="userId is empty"):
        csv.read_csv(spark, path, schemas.RATINGS, required=("userId",)).collect()


def test_single_file_export(spark, tmp_path):
    out = tmp_path / "out"
    for _ in range(2):
        csv.write_csv(spark.range(10).repartition(3), str(out), delimiter=";", single_file=True)
    assert len(list(out.glob("part-*.csv"))) == 1
    assert csv.read_csv(spark, str(out), "id INT", delimiter=";").count() == 10


def test_inline(spark):
    assert [r.value for r in inline.from_strings(spark, ["a", "b"]).collect()] == ["a", "b"]
    assert inline.from_rows(spark, [(1, 2.0)], "a INT, b DOUBLE").first().b == 2.0


def test_even_grid(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 5.0)], "k STRING, x DOUBLE")
    grid = [r.x for r in ranges.even_grid(df.where("k = 'a'"), "x", 5, pad_share=0.1).orderBy("point").collect()]
    assert grid == pytest.approx([-1, 2, 5, 8, 11])
    keyed = ranges.even_grid(df, "x", 3, pad_abs=1.0, keys=("k",)).where("k = 'b'").orderBy("point").collect()
    assert [r.x for r in keyed] == [4, 5, 6]


def test_range_is_partitioned(spark):
    assert ranges.index_range(spark, 100, 7).rdd.getNumPartitions() == 7


def test_batches(spark):
    assert len(list(batches.first_rows(spark.range(10), 3))) == 3
    sized = batches.map_batches(spark.range(0, 10, 1, 2), lambda p: p.assign(id=len(p)).head(1), "id BIGINT", 2)
    assert sorted(r.id for r in sized.collect()) == [1, 1, 2, 2, 2, 2]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        sized = batches.map_batches(spark.range(0, 10, 1, 1), lambda p: p.assign(id=len(p)).head(1), "id BIGINT", 4)
        assert [r.id for r in sized.collect()] == [4, 4, 2]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_scratch_tables_go(spark):
    with staging.scratch(spark):
        df = staging.staged(spark.range(5), "gone")
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        assert df.count() == 5 and staging.exists(spark, path)
    assert not staging.exists(spark, path)


def test_staging_uses_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging.fresh_path(spark, "x").startswith(folder)
    df = staging.staged(spark.range(5).withColumn("v", F.col("id") * 2), "t")
    assert df.count() == 5 and "parquet" in df._jdf.queryExecution().toString().lower()


def test_spread_only_small_scans(spark, sf_dir):
    docs = tables.text_table(spark, sf_dir, "documents")
    assert docs.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 64)
    assert tables.spread(wide) is wide
    with pytest.raises(ValueError, match="unknown table"):
        tables.table(spark, sf_dir, "nope")


def test_batches_become_pandas_one_at_a_time(spark):
    """Only the rows of one batch are pandas objects, whatever the size of what Spark sends; types stay."""
    df = spark.range(0, 1000, 1, 1).selectExpr("id", "concat('t', id) t", "timestamp '2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) at", "date '2020-01-01' d")

    def told(p):
        import gc

        import pandas as pd

        alive = sum(len(x) for x in gc.get_objects() if isinstance(x, pd.DataFrame) and "t" in x and "alive" not in x)
        return p.assign(alive=alive, ok=(p["at"].dt.hour == p["id"] % 24) & (p["t"] == "t" + p["id"].astype(str)))

    found = batches.map_batches(df, told, "id BIGINT, alive BIGINT, ok BOOLEAN, at TIMESTAMP, d DATE, t STRING", 7)
    assert found.select("id", "at", "d", "t").exceptAll(df.select("id", "at", "d", "t")).count() == 0
    rows = found.collect()
    assert len(rows) == 1000 and all(r.ok for r in rows) and max(r.alive for r in rows) <= 40
