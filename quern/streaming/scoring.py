"""Naive Bayes predictions for texts as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators import bayes as nb
from quern.sources import staging


def start_scoring(
    texts: DataFrame, key: str, entity: Column, words: Column, model: nb.BayesWeights, folder: str, state: str
) -> StreamingQuery:
    """Score what is there and stop. The model's tables are static; every batch writes its own folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        with staging.scratch(batch.sparkSession):
            asked = nb.with_model(batch, model, entity)
            found = nb.classify(asked, key, words, model)
            found.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    return (
        texts.writeStream.foreachBatch(save)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )


def predictions(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All predictions so far; no rows when nothing has arrived."""
    found = spark.read.schema(schema).parquet(folder) if staging.exists(spark, folder) else spark.createDataFrame([], schema)
    return found.drop("batch_id")
