"""A session for local runs; on a cluster use the one the cluster gives."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str | None = None, app: str = "subjectlog") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": str(cpus if str(cpus).isdigit() else 8),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
