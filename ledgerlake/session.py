"""Session for local runs, tests and the benchmark; on a cluster use the session that spark-submit gives."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "ledgerlake", cores: int | str = 8, **extra: str) -> SparkSession:
    """A local[N] session with UTC, AQE on, as many shuffle partitions as cores and a checkpoint folder."""
    conf = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerlake-"),
    } | extra
    spark = SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
