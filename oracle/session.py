"""A local session for tests and benchmarks, with the settings that also suit a cluster."""

from __future__ import annotations

import os
import sys

from pyspark.sql import SparkSession

# Valid on a laptop and on a cluster alike; partition counts adapt to the data.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Small local data would otherwise be gathered in one or two tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
}


def local_session(cpus: str | int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("hailgrid")
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
