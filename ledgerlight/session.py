"""Session settings used by the tests and the benchmark.

Library code never builds a session; on a cluster the caller brings one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", app: str = "ledgerlight", conf: dict[str, str] | None = None
) -> SparkSession:
    partitions = "8" if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # building a plan otherwise records a call site for every expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
