"""Settings of stateful streams."""

from __future__ import annotations

from pyspark.sql import SparkSession

STATE_CONF = {
    # state on local disk of the executors, not on their heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def use_rocksdb(spark: SparkSession) -> None:
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
