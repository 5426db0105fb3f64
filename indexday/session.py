"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# fileCompressionFactor makes the planner count compressed columnar files nearer to their size in
# memory when it picks a broadcast by itself.
# canChangeCachedPlanOutputPartitioning lets AQE coalesce a cached frame, so the passes of a model
# fit over a few covariate patterns do not each run a task per shuffle partition.
# forceOptimizeSkewedJoin lets AQE split a hot join partition even where the split costs the
# aggregate behind it one more exchange; without it a heavy person would stay in one task.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay with the cluster."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "indexday", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
