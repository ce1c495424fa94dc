"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps zone-less times comparable. AQE coalesces small shuffle partitions,
# switches to broadcast by measured size and splits skewed join partitions; the
# force flag lets it split even where the next step then needs its own shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(
    app_name: str = "edmart", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
