"""Records of quoted CSV do not depend on where the files are cut."""

import random

import pytest
from pyspark.sql import functions as F

from quern.sources import csv, quoted_csv
from quern.sources.staging import fresh_path

SCHEMA = "id INT, a STRING, b STRING"


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("size", [23, 1 << 20])
def test_same_rows_wherever_files_are_cut(spark, small_splits, size):
    draw = random.Random(size)
    bits = ["x", "it's", "\n", ",", "'", "ü", "two words", "", "\n\n", "',"]
    rows = [(k, "".join(draw.choice(bits) for _ in range(draw.randrange(6))) or None, draw.choice(["plain", None, "a\nb", "long " * 30])) for k in range(30)]
    path = fresh_path(spark, "quoted")
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    df.write.option("header", True).option("quote", "'").option("escape", "\\").csv(path)
    whole = spark.read.schema(SCHEMA).option("header", True).option("quote", "'").option("multiLine", True).csv(path)
    want = sorted_rows(whole)
    small_splits(size)
    got = csv.read_csv(spark, path, SCHEMA, quote="'", multiline=True)
    assert sorted_rows(got) == want and len(want) == 30
    splits = spark.read.text(path).select("_metadata.file_block_start", "_metadata.file_path").distinct().count()
    assert splits == 2 if size == 1 << 20 else splits > 10


def test_quotes_inside_plain_values_open_nothing(spark, small_splits, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,a,b\r\n1,it's,'x\r\n2,y'\r\n\r\n3,d'or,'say \\'so\\',\n4,no'\r\n5,'',e\r\n", encoding="utf-8")
    for size in (11, 1 << 20):
        small_splits(size)
        rows = quoted_csv.read_quoted_csv(spark, str(path), SCHEMA, quote="'").orderBy("id").collect()
        assert [(r.id, r.a) for r in rows] == [(1, "it's"), (3, "d'or"), (5, None)]
        assert rows[0].b.replace("\r", "") == "x\n2,y" and rows[1].b == "say 'so',\n4,no"


def test_doubled_quotes_and_many_tasks(spark, small_splits, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("id,a,b\n" + "".join(f'{k},"say ""{k}""\n{k},no",z\n' for k in range(200)), encoding="utf-8")
    small_splits(500)
    df = quoted_csv.read_quoted_csv(spark, str(path), SCHEMA, escape='"')
    assert sorted(r.a for r in df.collect()) == sorted(f'say "{k}"\n{k},no' for k in range(200))
    assert df.select(F.spark_partition_id()).distinct().count() > 1


def test_empty_files(spark, tmp_path):
    for text in ("", "id,a,b\n", "id,'a\nx',b\n"):
        path = tmp_path / f"e{len(text)}.csv"
        path.write_text(text, encoding="utf-8")
        assert quoted_csv.read_quoted_csv(spark, str(path), SCHEMA, quote="'").count() == 0


def test_ends_of_lines():
    ends = quoted_csv.line_ends(",", "'", "\\")
    assert ends("a,b") == (0, 1) and ends("a,'b") == (1, 0) and ends("b',c") == (0, 0) and ends("b','c") == (1, 1)
    assert ends("it's,'b") == (1, 1) and ends("\\'") == (0, 1) and ends("'\\") == (1, 0) and ends("'a','") == (1, 1)
