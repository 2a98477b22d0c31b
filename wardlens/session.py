"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time SQL settings, safe to change on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE split a hot partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Largest part of a file that one task reads: the partial aggregate of a task's rows, which may
# all be different, then stays in memory instead of being spilled.
SCAN_BYTES = 32 << 20

_TUNED: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session, once per application.

    Parts of files are made smaller where they are larger than ``SCAN_BYTES``, never larger.
    """
    app = spark.sparkContext.applicationId
    if app not in _TUNED:
        for key, value in RUNTIME_SETTINGS.items():
            spark.conf.set(key, value)
        if _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes")) > SCAN_BYTES:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(SCAN_BYTES))
        _TUNED.add(app)
    return spark


def _bytes(spark: SparkSession, text: str) -> int:
    """A size setting such as ``64m`` or ``134217728b`` in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def local_session(
    cores: int | str = 8, memory: str = "8g", app: str = "wardlens", shared: str | None = None
) -> SparkSession:
    """A local session for tests and benchmarks.

    On a cluster the session comes from ``spark-submit``; only ``tune`` applies there.
    ``shared`` is the folder for intermediate tables, by default the warehouse.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.files.maxPartitionBytes", "64m")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    return tune(builder.getOrCreate())
