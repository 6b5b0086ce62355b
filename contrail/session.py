"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results, the state layout or the shape of generated code, as opposed to sizing, which belongs
# to the cluster. Event times are read in the session zone, so the zone is part of the contract. The method limit is
# the JVM's own: beyond it generated methods are not compiled, and the wide normaliser runs twice as fast split up.
CONTRACT = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to a session somebody else built."""
    for key, value in CONTRACT.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("contrail")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites for error messages cost about half of the time it takes to build a plan from Python.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in CONTRACT.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="contrail-")


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder every executor can reach.

    It lies under the cluster's ``spark.checkpoint.dir``. A machine-local temporary folder is used only
    when that setting is absent and the whole session runs on this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def landed(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it from there: worked out once, with its lineage cut, whatever
    number of readers follow."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
