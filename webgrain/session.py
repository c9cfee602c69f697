"""Session settings the operators are written for (used by tests and the bench)."""

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a hot key travels as a few sessions
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # stream state on disk, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that sessions made
    elsewhere can run the Python steps too."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="webgrain-"), "webgrain")
    archive = shutil.make_archive(
        base, "zip", root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def build_session(master="local[8]", shuffle_partitions=8, app="webgrain", memory="8g"):
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark
