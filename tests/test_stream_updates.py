"""Streams in update mode: several files, open windows, a batch that runs again."""

import datetime

from pyspark.sql import functions as F

from retenta.params import Transactions
from retenta.streaming import operators as ST

TX = Transactions("k", "at", "v")
SCHEMA = "k long, at timestamp_ntz, v double"


def rows(first, count):
    start = datetime.datetime(2024, 3, 1)
    return [(i % 4, start + datetime.timedelta(hours=5 * i), float(i)) for i in range(first, first + count)]


def test_windows_over_several_files_equal_a_batch(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    seen = []
    for part in range(3):
        new = rows(40 * part, 40)
        seen += new
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = ST.rolling_totals(ST.read_stream(spark, folder, "*.parquet", spark.createDataFrame([], SCHEMA).schema), "7 days", "1 day", tx=TX)
        got = ST.run_updates(stream, ["k", "window_start"], out, check)  # goes on where the last run stopped
        plain = ST.rolling_totals(spark.createDataFrame(seen, SCHEMA), "7 days", "1 day", tx=TX)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    # a batch that runs again replaces its own rows
    last = spark.read.parquet(out).agg(F.max("batch")).first()[0]
    again = spark.createDataFrame(spark.read.parquet(f"{out}/batch={last}").collect(), stream.schema)
    again.write.mode("overwrite").parquet(f"{out}/batch={last}")
    assert sorted(map(tuple, ST.newest(spark, out, stream.schema, ["k", "window_start"]).collect())) == sorted(map(tuple, plain.collect()))


def test_nothing_written_yet(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, n long").schema
    assert ST.newest(spark, str(tmp_path / "none"), schema, ["k"]).collect() == []


def test_closed_and_open_sessions_are_every_session(spark, tmp_path):
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    start = datetime.datetime(2024, 3, 1)
    seen = []
    for part in range(3):
        new = [(i % 3 if i % 4 == 0 else 0, start + datetime.timedelta(hours=7 * i), float(i)) for i in range(30 * part, 30 * part + 30)]
        seen += new
        spark.createDataFrame(new, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = ST.session_totals(ST.read_stream(spark, folder, "*.parquet", spark.createDataFrame([], SCHEMA).schema), tx=TX)
        closed = ST.run_available(stream, out, check)
        got = closed.unionByName(ST.open_sessions(spark, check, TX)).collect()
        assert closed.count() < len(got)
        assert sorted(map(tuple, got)) == sorted(map(tuple, ST.session_totals(spark.createDataFrame(seen, SCHEMA), tx=TX).collect()))
