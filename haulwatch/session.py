"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Set at runtime on any session. Timestamps are read and printed in UTC; AQE splits skewed
# join partitions even where that costs another exchange.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to an existing session."""
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def configure_streaming(spark: SparkSession) -> SparkSession:
    """``configure`` plus the state store the keyed-state queries need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return configure(spark)


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("haulwatch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    return configure_streaming(builder.getOrCreate())

