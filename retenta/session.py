"""Session defaults for local runs; a cluster brings its own session."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "retenta") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the cluster's checkpoint folder.

    A local session that names none gets a temporary folder; a cluster must name one,
    since its executors do not share their own disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="retenta-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df, name: str):
    """Write df to the shared folder and read it back: a short lineage that survives lost executors."""
    import uuid

    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


_COALESCE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def keep(df):
    """df persisted in the partitions that adaptive execution gives it when it is not; `unpersist` ends it."""
    conf = df.sparkSession.conf
    before = conf.get(_COALESCE)
    conf.set(_COALESCE, "true")
    try:
        return df.persist()
    finally:
        conf.set(_COALESCE, before)


def release(df) -> None:
    """Delete a table that `settle` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
