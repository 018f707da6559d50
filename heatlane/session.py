"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "heatlane", **conf) -> SparkSession:
    """Session with the settings the library expects; on a cluster, leave
    ``master`` unset and let spark-submit choose it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, wherever the driver was started."""
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="heatlane-package-")  # Spark copies the file to the executors
    name = os.path.basename(here)
    skip = shutil.ignore_patterns("__pycache__")
    shutil.copytree(here, os.path.join(folder, "root", name), ignore=skip)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", os.path.join(folder, "root")))


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    go without: its driver and executors share one disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="heatlane-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; one parent folder per application, so
    that a finished job's scratch tables can be dropped together."""
    return f"{scratch_root(spark)}/heatlane/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; call it when its results are written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/heatlane/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def durable(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and fixes anything that depends on physical placement, so a
    lost executor re-reads files instead of re-deriving different values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
