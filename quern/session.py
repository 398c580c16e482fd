"""Spark session settings shared by tests, the bench and notebooks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "quern",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with UTC, adaptive execution and no web page.

    ``master`` is left to spark-submit unless given. Local masters get a small
    shuffle partition count; on a cluster the number stays with the cluster's
    own configuration and adaptive coalescing.
    """
    builder = SparkSession.builder.appName(app)
    settings = dict(SETTINGS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings["spark.sql.shuffle.partitions"] = os.environ.get("QUERN_PARTITIONS", "8")
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
