"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Where in the Python source a column was made is only named in error messages, and noting it takes
# several calls into the JVM for every operation: most of the time that a small query takes to be put together.
# Can only be set when a session is made.
CALL_SITES = "spark.python.sql.dataFrameDebugging.enabled"


def pin_session(spark: SparkSession) -> SparkSession:
    """Fix the two settings that change results: time zone UTC and ANSI casts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def build_session(master: str, shuffle_partitions: int, app: str = "recordloom", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the one it provides."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config(CALL_SITES, "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return pin_session(spark)
