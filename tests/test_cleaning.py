import datetime as dt

import pytest
from pyspark.sql import functions as F

from retenta.operators import cleaning as C
from retenta.operators import quality as Q
from retenta.operators import splits as L
from retenta.sources import files as IO

TELCO = [
    ("1", " Male ", 0, "Yes", "No", 0, "No", "Yes", "No", "Yes", "No internet service", "Monthly", 50.0, None, "No"),
    ("2", "Female", 1, "No", "maybe", 10, "Yes", "No phone service", "DSL", "Yes", "No", "Monthly", 60.0, 600.0, "Yes"),
    ("3", "Female", 1, "No", "Yes", 10, "Yes", "Yes", "DSL", " Yes", "No", "Yearly", 60.0, None, "Yes"),
    ("4", "Male", 0, None, "Yes", 10, "Yes", "Yes", "DSL", "Yes", "No", "Yearly", 60.0, 9000.0, "No"),
]
COLS = ("customerID string, gender string, SeniorCitizen long, Partner string, Dependents string, tenure long, PhoneService string, "
        "MultipleLines string, InternetService string, OnlineSecurity string, TechSupport string, Contract string, "
        "MonthlyCharges double, TotalCharges double, Churn string")


def test_clean_telco(spark):
    got = {r["customerID"]: r for r in C.clean_telco(spark.createDataFrame(TELCO, COLS)).collect()}
    assert got["1"]["gender"] == "Male" and got["1"]["MultipleLines"] == "No" and got["1"]["OnlineSecurity"] == "No"
    assert got["2"]["Dependents"] is None and got["2"]["MultipleLines"] == "No" and got["4"]["Partner"] is None
    assert got["3"]["OnlineSecurity"] == "Yes" and got["3"]["TotalCharges"] == pytest.approx(600.0)
    assert [got[i]["Churn"] for i in "1234"] == [0, 1, 1, 0]


def test_charge_flags(spark):
    df = C.fill_total_charges(spark.createDataFrame(TELCO, COLS))
    assert [r["customerID"] for r in C.unreasonable_charges(df).collect()] == ["4"]


def test_clean_orders(spark):
    d = dt.datetime(2024, 1, 10)
    rows = [("a", d, d - dt.timedelta(days=1), -5.0, 1, None), ("b", d, d, 10.0, 0, 1.0), ("c", d, None, 10.0, 1, 1.0), ("d", d, d, None, None, 2.0)]
    df = spark.createDataFrame(rows, "order_id string, order_purchase_timestamp timestamp, order_delivered_customer_date timestamp, total_price double, total_items long, total_freight double")
    got = {r["order_id"]: r for r in C.clean_orders(df).collect()}
    assert set(got) == {"a", "d"}
    assert got["a"]["total_price"] == 0.0 and got["a"]["order_delivered_customer_date"] is None


def test_codes_sort_like_text(spark):
    values = ["b", "a", "abcdefgh", "abcdefgi", "abcdefghijklmno", "abcdefghijklmnp", "é", "Z", ""]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = {r["value"]: r["code"] for r in C.fit_codes(df, ["t"]).collect()}
    want = {v: i for i, v in enumerate(sorted(values, key=lambda s: s.encode()))}
    assert got == want
    more = spark.createDataFrame([("a",), (None,), ("new",)], "t string")
    assert sorted(r["t"] for r in C.apply_codes(more, ["t"], C.fit_codes(df, ["t"])).collect()) == [-1, -1, want["a"]]


def test_search_ignores_case(spark):
    df = spark.createDataFrame([("Anna", 10), ("bob", 201)], "n string, k int")
    assert C.search(df, "AN").count() == 1 and C.search(df, "20").count() == 1


def test_imputation_order_matters(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (3, 5.0, None), (4, 100.0, None)], "id int, x double, t string")
    got = Q.impute(df, {"t": "drop", "x": "median"}).orderBy("id").collect()
    assert [r["x"] for r in got] == [1.0, 1.0]
    with pytest.raises(ValueError):
        Q.impute(df, {"x": "guess"})


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("a",), (None,)], "t string")
    assert Q.impute(df, {"t": "mode"}).where("t = 'a'").count() == 3


def test_forward_fill_crosses_bins(spark):
    df = spark.createDataFrame([(i, i % 3, 1.0 if i == 5 else None) for i in range(200)], "k int, tie int, x double")
    got = {r["k"]: r["x"] for r in Q.forward_fill(df, "x", "k", "tie").collect()}
    assert got[4] is None and all(got[i] == 1.0 for i in range(5, 200))


def test_quality_report_and_duplicates(spark):
    df = spark.createDataFrame([(float(i), "x") for i in range(20)] + [(500.0, None), (5.0, "x")], "v double, t string")
    got = {r["column"]: r for r in Q.quality_report(df).collect()}
    assert got["v"]["outlier_count"] == 1 and got["t"]["missing_count"] == 1 and got["t"]["outlier_count"] is None
    assert Q.duplicate_rows(df).first()["duplicate_rows"] == 1


def test_constant_column_is_no_zscore_outlier(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert Q.zscore_outliers(df, ["v"]).where("is_outlier").count() == 0


def test_splits_sizes_and_folds(spark):
    df = spark.createDataFrame([(i, int(i % 10 < 3)) for i in range(1000)], "id long, label int")
    n = {r["split"]: r["count"] for r in L.stratified_split(df, "id", "label").groupBy("split").count().collect()}
    assert n == {"test": 200, "val": 200, "train": 600}
    assert L.class_drift(L.stratified_split(df, "id", "label"), "label").where("drifts").count() == 0
    f = {(r["label"], r["fold"]): r["count"] for r in L.stratified_folds(df, "id", "label").groupBy("label", "fold").count().collect()}
    assert all(v == (60 if k[0] else 140) for k, v in f.items()) and len(f) == 10
    assert L.sample_rows(df, "id", 7).collect() == L.sample_rows(df.repartition(5), "id", 7).collect()


def test_temporal_split_shares(spark):
    df = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i // 2)) for i in range(100)], "id long, d timestamp")
    n = {r["split"]: r["count"] for r in L.temporal_split(df, "d", "id").groupBy("split").count().collect()}
    assert n == {"train": 64, "val": 16, "test": 20}


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "id long, split string")
    IO.save_splits(df, str(tmp_path / "s"))
    assert [r["id"] for r in IO.read_split(spark, str(tmp_path / "s"), "val").collect()] == [2]
    recs = spark.createDataFrame([(1, ["a", "b"])], "id long, acts array<string>")
    IO.export_recommendations(recs, str(tmp_path / "r"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "r")).first()["acts"] == "a; b"
    IO.export_recommendations(recs, str(tmp_path / "j"), "json")
    assert spark.read.json(str(tmp_path / "j")).first()["acts"] == "a; b"
    with pytest.raises(ValueError):
        IO.export_recommendations(recs, str(tmp_path / "x"), "excel")


def test_upload_fills_gaps(spark, tmp_path):
    (tmp_path / "u.csv").write_text("a,b,c\n1,x,\n3,,\n,x,\n")
    got = IO.read_upload(spark, str(tmp_path / "u.csv")).orderBy("a").collect()
    assert [r["a"] for r in got] == [1.0, 2.0, 3.0] and {r["b"] for r in got} == {"x"} and {r["c"] for r in got} == {"Unknown"}


def test_telco_schema_failures(spark, tmp_path):
    df = spark.createDataFrame([("a", "Yes"), ("a", "No"), ("b", "perhaps")], "customerID string, Churn string")
    assert IO.telco_violations(df).count() > 0  # columns missing
    path = str(tmp_path / "t")
    full = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit("1")).alias(f.name) for f in IO.TELCO_SCHEMA])
    full.write.option("header", True).csv(path)
    with pytest.raises(ValueError):
        IO.read_telco(spark, path)
    bad = {r["violation"]: r["n"] for r in IO.telco_violations(IO.read_telco(spark, path, check=False)).collect()}
    assert bad == {"duplicate_id": 1, "invalid_label": 1}
