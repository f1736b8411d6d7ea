"""Session helpers: a local builder for tests and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("queuecraft")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUEUECRAFT_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Wide feature projections compile to methods the JVM never optimises (over 8000 bytes of bytecode).
# With this limit Spark falls back to its split form for those stages only; all others stay fused.
# Python stages read texts: smaller Arrow batches keep a task's memory small where texts are long.
# Each option: Spark's own default, and what stands in its place.
RUNTIME_OPTIONS = {"spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
                   "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000")}


def tuned(spark: SparkSession) -> SparkSession:
    """Set the runtime options above, unless the session already says otherwise."""
    for name, (default, value) in RUNTIME_OPTIONS.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Only a session whose executors are threads of this process gets a private folder where none is named;
    a cluster without the setting is an error, since its executors would each write to their own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    For a frame that several passes read and that is dear to compute (a join, a model).
    Written rows survive the loss of an executor, a cached block does not.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: lineage ends there, and the planner sees how large it is."""
    path = scratch_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scrapped(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("table-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the JVM hand back shuffle files of finished jobs now instead of at its next full collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shipped(spark: SparkSession) -> SparkSession:
    """Send this package to the workers once per session, so that Python functions load wherever a worker starts."""
    context = spark.sparkContext
    if getattr(context, "_queuecraft_shipped", False):
        return spark
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="package-")
    archive = os.path.join(folder, "queuecraft_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(at, name)
                out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    context._queuecraft_shipped = True
    return spark
