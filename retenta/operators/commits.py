"""A table of changed rows in numbered commits, for metadata that several writers extend.

Each commit is a folder `snapshot=N` that holds the rows it changes.  It is
written beside the table and then renamed, so readers see all of a commit or
nothing.  Two writers that aim at the same number meet at the rename: one gets
it, the other reads the table again, rebuilds its rows and takes the next one.
This needs a file system whose rename of a folder is atomic (HDFS, local disks).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

MARK = "_by-"


class CommitConflict(RuntimeError):
    """Other writers took every number that was tried."""


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path
    return where, where(path).getFileSystem(spark._jsc.hadoopConfiguration())


def last_commit(spark: SparkSession, path: str) -> int:
    """Number of the newest commit, 0 for a table without one."""
    where, fs = _files(spark, path)
    if not fs.exists(where(path)):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(where(path))]
    return max((int(n.split("=")[1]) for n in names if n.startswith("snapshot=")), default=0)


def read_commits(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """The newest row of each key as of commit `upto` (default: the newest one); later commits are not seen.

    The listing happens once, here, so one DataFrame always answers from one
    state of the table.  Rows whose `deleted` is true are gone.
    """
    upto = last_commit(spark, path) if upto is None else upto
    folders = [f"{path}/snapshot={n}" for n in range(1, upto + 1)]
    if not folders:
        return spark.createDataFrame([], schema)
    stored = StructType([*schema.fields]).add("deleted", "boolean")
    log = spark.read.schema(StructType([*stored.fields]).add("snapshot", LongType())).option("basePath", path).parquet(*folders)
    values = [c for c in stored.names if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "snapshot").alias("_v")).where("not coalesce(_v.deleted, false)")
    return last.select(*[F.col(c) if c in keys else F.col(f"_v.{c}").alias(c) for c in schema.names])


def commit(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
           change: Callable[[DataFrame], DataFrame], attempts: int = 20) -> int:
    """Append the rows that `change` makes of the current table; returns the number of the commit.

    `change` runs again on the newer table whenever another writer was first,
    so what it derives (a next version) is right for the number it gets.
    """
    where, fs = _files(spark, path)
    for _ in range(attempts):
        base = last_commit(spark, path)
        rows = change(read_commits(spark, path, schema, keys, base))
        if "deleted" not in rows.columns:
            rows = rows.withColumn("deleted", F.lit(False))
        token = uuid.uuid4().hex
        own, target = f"{path}/_work/_{token}", f"{path}/snapshot={base + 1}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], F.col("deleted").cast("boolean")).write.parquet(own)
        fs.create(where(f"{own}/{MARK}{token}")).close()
        fs.rename(where(own), where(target))
        # where the number was taken, a rename either fails or puts the folder inside the other one
        if fs.exists(where(f"{target}/{MARK}{token}")):
            return base + 1
        for left in (own, f"{target}/_{token}"):
            if fs.exists(where(left)):
                fs.delete(where(left), True)
    raise CommitConflict(f"{path}: no commit in {attempts} attempts")
