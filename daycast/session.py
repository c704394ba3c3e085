"""Spark session settings the engine is tuned for.

Adaptive execution decides, at run time and on measured sizes, whether a
data-dependent side table is broadcast, how many shuffle partitions to
keep and whether a skewed partition is split.  Cluster jobs get these from
their own configuration; `local_session` sets them for tests and the
benchmark.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daycast",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**TUNING, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/daycast-checkpoints") -> str:
    """Use the cluster's `spark.checkpoint.dir`; set `fallback` only in local mode where it is unset (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        sc.setCheckpointDir(fallback)
        current = fallback
    return current
