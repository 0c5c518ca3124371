"""Spark session settings and the shared folder for durable intermediate data."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "skyledger", **conf) -> SparkSession:
    """Session for jobs: UTC, ANSI, AQE with skew handling, RocksDB state."""
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        **{key: str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that results or speed depend on, for a session made here or elsewhere.

    Dates are UTC dates and arithmetic errors are not NULLs. The validation rules make large
    functions: above 8000 bytes the JVM would interpret them, so larger stages use Spark's
    split code instead (about twice as fast here).
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir``. Only a local master may go without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = os.path.join(tempfile.gettempdir(), "skyledger")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job made, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
