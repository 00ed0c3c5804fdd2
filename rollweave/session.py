"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs more than building the expressions of the rule families.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: Arrow batches end at this size, whatever the length of a row; ten thousand long texts would be hundreds of megabytes.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def local_session(cores: str = "8", memory: str = "12g", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rollweave")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in {**DEFAULTS, **dict([ARROW_BYTES]), **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or a test folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        # A running session does not take this setting; all sessions of the context share the folder.
        folder = getattr(context, "_rollweave_folder", None) or tempfile.mkdtemp(prefix="rollweave-")
        context._rollweave_folder = folder
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise_stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a stage to the shared folder and read it back.

    The plan that follows starts from files, so a lost executor only costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """A session that sets no size for Arrow batches gets one."""
    if spark.conf.get(ARROW_BYTES[0], None) is None:
        spark.conf.set(*ARROW_BYTES)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each session, so that their workers can import it.

    A session that sets no size for Arrow batches gets one.
    """
    bound_batches(spark)
    context = spark.sparkContext
    if getattr(context, "_rollweave_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    package = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
    # The driver serves this file for as long as the session lives.
    folder = tempfile.mkdtemp(prefix=f"{package}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{package}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top, _, names in os.walk(os.path.join(root, package)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    archive.write(full, os.path.relpath(full, root))
    context.addPyFile(path)
    context._rollweave_shipped = True
