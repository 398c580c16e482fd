"""Jobs that score texts several times cut them into words once."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from quern.functions import text as tx
from quern.operators import bayes as nb


@pytest.mark.parametrize("name", ["nb_classify", "nb_folds", "nb_entity_report"])
def test_words_are_cut_once(spark, sf_dir, monkeypatch, name):
    seen = []
    classify = nb._scored

    def scored(docs, *rest):
        seen.append(docs._jdf.queryExecution().toString())
        return classify(docs, *rest)

    monkeypatch.setattr(nb, "_scored", scored)
    last = contract.queries()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert len(seen) == 1
    # The scored rows and the report come from staged words, not from the table of texts.
    assert all("documents.parquet" not in plan and "regexp_extract_all" not in plan and "split(" not in plan for plan in [*seen, last])


def test_words_without_empty_ones(spark):
    rows = spark.createDataFrame([("  a  B,c ",), ("",), (None,), (" ",)], "t STRING")
    told = [(r.w, r.k) for r in rows.select(tx.words(F.col("t")).alias("w"), tx.tokens(F.col("t")).alias("k")).collect()]
    assert told == [(["a", "B,c"], ["a", "b", "c"]), ([], []), (None, None), ([], [])]
