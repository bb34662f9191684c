"""Streaming forms of sessions, rolling sums and scored KPIs.

Each takes a DataFrame with an event-time column and works on a stream (with
its watermark) or on a batch alike.  Late rows beyond the watermark are dropped
by the engine; state is kept per key and open window only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from retenta.params import Transactions


def read_stream(spark: SparkSession, folder: str, file: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", file)
            .option("maxFilesPerTrigger", files_per_trigger).parquet(folder))


def event_time(df: DataFrame, tx: Transactions, lateness: str) -> DataFrame:
    """Zone-free timestamps become instants (watermarks need them) and get the watermark."""
    return df.withColumn(tx.date, F.col(tx.date).cast("timestamp")).withWatermark(tx.date, lateness)


def session_totals(df: DataFrame, gap: str = "24 hours", lateness: str = "10 minutes", tx: Transactions = Transactions()) -> DataFrame:
    """Sessions by inactivity gap; in append mode a session appears once the watermark passes its end."""
    window = F.session_window(tx.date, gap)
    g = event_time(df, tx, lateness).groupBy(tx.customer, window).agg(
        F.min(tx.date).alias("first"), F.max(tx.date).alias("last"), F.count(tx.date).alias("session_count"),
        F.sum(tx.value).alias("session_sum"))
    return g.select(tx.customer, F.col("first").alias("session_start"), F.col("last").alias("session_end"), "session_count", "session_sum")


def open_sessions(spark: SparkSession, checkpoint: str, tx: Transactions = Transactions()) -> DataFrame:
    """Sessions that a `session_totals` query has begun and not yet emitted, read from its state.

    With what the query appended that is every session so far, each once: a
    session leaves the state when it is emitted.
    """
    held = spark.read.format("statestore").load(checkpoint).select("value.*")
    _, _, first, last, count, total = held.columns  # the grouping columns, then the aggregates in their order
    return held.select(tx.customer, F.col(first).alias("session_start"), F.col(last).alias("session_end"), F.col(count).alias("session_count"),
                       F.col(total).alias("session_sum"))


def rolling_totals(df: DataFrame, width: str = "30 days", slide: str = "1 day", lateness: str = "10 minutes",
                   tx: Transactions = Transactions()) -> DataFrame:
    """Sliding-window sum, count and mean per customer."""
    g = event_time(df, tx, lateness).groupBy(tx.customer, F.window(tx.date, width, slide)).agg(
        F.sum(tx.value).alias("window_sum"), F.count(tx.value).alias("window_count"), F.avg(tx.value).alias("window_mean"))
    return g.select(tx.customer, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "window_sum", "window_count", "window_mean")


def window_kpis(df: DataFrame, width: str = "1 day", lateness: str = "10 minutes", tx: Transactions = Transactions(),
                score: str = "score", high: float = 0.7) -> DataFrame:
    """Scored rows, high-risk share and mean score per tumbling window."""
    g = event_time(df, tx, lateness).groupBy(F.window(tx.date, width)).agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col(score) > high).alias("high_risk"), F.avg(score).alias("avg_risk"))
    return g.select(F.col("window.start").alias("window_start"), "scored", "high_risk",
                    (F.col("high_risk") * 100.0 / F.col("scored")).alias("high_risk_pct"), "avg_risk")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process what is there, append to Parquet, stop; returns the written table."""
    q = (stream.writeStream.outputMode("append").format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> DataFrame:
    """Process what is there in update mode and stop; returns the newest row of each key, open windows included.

    Every micro-batch writes its changed rows to a folder named by its number; a
    batch that runs again after a failure replaces its own folder, so nothing is
    counted twice.  The folders are the merge log: readers take the row of the
    highest batch, and files are never changed in place.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = (stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return newest(stream.sparkSession, path, stream.schema, keys)


def newest(spark: SparkSession, path: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The newest row of each key in a folder that `run_updates` writes; no rows where it has not written yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema)
    log = spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(path)
    values = [c for c in schema.names if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return last.select(*[F.col(c) if c in keys else F.col(f"_v.{c}") for c in schema.names])
