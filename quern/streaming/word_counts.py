"""Word counts that grow as texts arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.words import explode_words
from quern.sources import staging

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# After so many micro-batches their totals are merged into one folder.
MERGE_EVERY = 20
# The most frequent words are kept by bucket of their hash; a reader of n words takes the levels that hold n of each.
HEAD_BUCKETS = 64
HEAD_LEVELS = (10, 100, 1000)


def batch_path(folder: str, batch_id: int, kind: str = "new") -> str:
    return f"{folder}/kind={kind}/batch_id={batch_id}"


def merge_before(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Totals of all earlier batches into one folder; what it covers is removed once it is whole.

    A repeated call finds the folder whole and only removes. Storage follows the number of words, not of batches.
    """
    whole = batch_path(folder, batch_id - 1, "merged")
    if not staging.exists(spark, f"{whole}/_SUCCESS"):
        current_counts(spark, folder, before=batch_id).write.mode("overwrite").parquet(whole)
    for earlier in range(max(0, batch_id - 2 * MERGE_EVERY), batch_id):
        staging.remove(spark, batch_path(folder, earlier))
        if earlier < batch_id - 1:
            staging.remove(spark, batch_path(folder, earlier, "merged"))


def head_path(folder: str, batch_id: int) -> str:
    # Names with a leading _ are no part of the totals when the folder is read.
    return f"{folder}/_head/batch_id={batch_id}"


def last_head(spark: SparkSession, folder: str, before: int | None = None) -> int | None:
    """The latest batch whose heads are whole, of those ``before`` one if given."""
    names = staging.children(spark, f"{folder}/_head")
    ids = sorted((int(n.split("=")[1]) for n in names), reverse=True)
    whole = (i for i in ids if (before is None or i < before) and staging.exists(spark, f"{head_path(folder, i)}/_SUCCESS"))
    return next(whole, None)


def read_head(spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
    return spark.read.schema("word STRING, count BIGINT, bucket INT, level INT").parquet(head_path(folder, batch_id))


def keep_heads(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Write the most frequent words of every bucket after this batch.

    Totals only grow, so a word that the batch did not touch and that was in no head before is in none now: the old
    heads and the batch's totals are enough. Without old heads all totals are read once. A repeated batch starts from
    the same old heads.
    """
    spark = batch.sparkSession
    old = last_head(spark, folder, before=batch_id)
    past = read_head(spark, folder, old) if old is not None else current_counts(spark, folder, before=batch_id)
    totals = past.select("word", "count").union(batch.select("word", "count")).groupBy("word").agg(F.max("count").alias("count"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(HEAD_BUCKETS)).cast("int")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("count"), "word"))
    head = totals.withColumn("bucket", bucket).withColumn("place", place).where(F.col("place") <= HEAD_LEVELS[-1])
    level = F.size(F.filter(F.array(*[F.lit(n) for n in HEAD_LEVELS]), lambda n: n < F.col("place")))
    head = head.select("word", "count", "bucket", level.alias("level"))
    head.write.mode("overwrite").partitionBy("level").parquet(head_path(folder, batch_id))
    for name in staging.children(spark, f"{folder}/_head"):
        if int(name.split("=")[1]) < (batch_id if old is None else old):
            staging.remove(spark, f"{folder}/_head/{name}")


def start_counts(texts: DataFrame, words: Column, folder: str, state: str) -> StreamingQuery:
    """Process what is there and stop; call again when more has arrived.

    Each micro-batch writes the new totals of the words it touched (update
    mode) to a folder of its own. A repeated batch overwrites its folder, so a
    restart counts nothing twice. Totals are kept on disk next to the
    executors and saved below ``state``.
    """
    spark = texts.sparkSession
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ON_DISK_STATE)
    try:
        counts = explode_words(texts, words).groupBy("word").agg(F.count("*").alias("count"))

        def save(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(batch_path(folder, batch_id))
            # Read back, so that the state is not asked for a second time.
            written = batch.sparkSession.read.schema(batch.schema).parquet(batch_path(folder, batch_id))
            keep_heads(written, folder, batch_id)
            if batch_id and batch_id % MERGE_EVERY == 0:
                merge_before(batch.sparkSession, folder, batch_id)

        return (
            counts.writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def current_counts(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The latest total of every word, of the batches ``before`` one if given; no rows when nothing has arrived."""
    schema = "word STRING, count BIGINT, kind STRING, batch_id BIGINT"
    saved = spark.read.schema(schema).parquet(folder) if staging.exists(spark, folder) else spark.createDataFrame([], schema)
    if before is not None:
        saved = saved.where(F.col("batch_id") < before)
    return saved.groupBy("word").agg(F.max_by("count", "batch_id").alias("count"))


def top_candidates(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """Words and totals with the ``n`` most frequent words among them; all totals only beyond the last level of the heads."""
    last = last_head(spark, folder) if n <= HEAD_LEVELS[-1] else None
    if last is None:
        return current_counts(spark, folder)
    level = next(k for k, most in enumerate(HEAD_LEVELS) if n <= most)
    return read_head(spark, folder, last).where(F.col("level") <= level).select("word", "count")


def top_words(spark: SparkSession, folder: str, n: int) -> DataFrame:
    """The ``n`` most frequent words so far, ties by word; reads at most ten times n rows of each bucket, or all for a large n."""
    return top_candidates(spark, folder, n).orderBy(F.desc("count"), "word").limit(n)
