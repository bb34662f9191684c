"""Sparse category features: any number of categories, NULLs, unseen values."""

from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from retenta.operators.transform import fit_category_codes, places_on, sparse_one_hot
from retenta.plans.order import number_rows


def test_vectors_of_small_columns(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "x"), (3, None, "x"), (4, "c", None), (5, "c", "x"), (6, "é", "x")], "id long, `k.1` string, one string")
    codes = fit_category_codes(df, ["k.1", "one"])
    out = {r["id"]: r["features"] for r in sparse_one_hot(df, ["k.1", "one"], codes).collect()}
    # values a < b < c < é: a is dropped, c is the most frequent; a column with one value has no place
    assert {i: (v.size, v.toArray().tolist()) for i, v in out.items()} == {
        1: (3, [1, 0, 0]), 2: (3, [0, 0, 0]), 3: (3, [0, 1, 0]), 4: (3, [0, 1, 0]), 5: (3, [0, 1, 0]), 6: (3, [0, 0, 1])}
    unseen = spark.createDataFrame([(7, "zz", "x"), (8, "", "y")], "id long, `k.1` string, one string")
    assert all(r["features"].toArray().tolist() == [0, 0, 0] for r in sparse_one_hot(unseen, ["k.1", "one"], codes).collect())


def test_a_hundred_thousand_categories(spark):
    df = spark.range(200_000).select("id", F.concat(F.lit("https://example.org/a/common/prefix/"), F.lpad((F.col("id") % 100_000).cast("string"), 6, "0")).alias("url"))
    codes = fit_category_codes(df, ["url"])
    out = sparse_one_hot(df, ["url"], codes)
    some = {r["id"]: r["features"] for r in out.where("id % 50000 < 2").collect()}
    assert len(some) == 8 and {v.size for v in some.values()} == {99_999}
    assert all(list(v.indices) == ([i % 100_000 - 1] if i % 100_000 else []) for i, v in some.items())
    assert out.count() == 200_000


def test_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], "id long, a string")
    assert sparse_one_hot(df, ["a"], fit_category_codes(df, ["a"])).collect() == []
    one = spark.createDataFrame([(1, "x")], "id long, a string")
    assert sparse_one_hot(one, ["a"], fit_category_codes(df, ["a"])).first()["features"] == DenseVector([])


def test_row_numbers_along_text_with_ties(spark):
    rows = [("g", v) for v in ["b", "a", None, "b", "é", "Z"]] + [("h", "q")]
    df = spark.createDataFrame(rows, "g string, v string").repartition(3)
    got = number_rows(df, ["v"], ["g"], "n").collect()
    assert [r["v"] for r in sorted((r for r in got if r["g"] == "g"), key=lambda r: r["n"])] == [None, "Z", "a", "b", "b", "é"]
    assert sorted((r["g"], r["n"]) for r in got) == [("g", i) for i in range(1, 7)] + [("h", 1)]


def test_a_vector_costs_its_entries(spark):
    df = spark.range(5_000).select("id", F.concat(F.lit("v"), F.col("id")).alias("name"), F.lit("x").alias("one"))
    out = sparse_one_hot(df, ["name", "one"], fit_category_codes(df, ["name", "one"]))
    assert len(str(out.schema["features"].metadata)) < 100  # no name for each place
    got = out.select("id", places_on(F.col("features")).alias("p")).collect()
    first, *rest = sorted(([tuple(p) for p in r["p"]] for r in got), key=len)
    assert first == [] and sorted(rest) == [[(i, 1.0)] for i in range(4_999)]


def test_places_of_dense_and_sparse_vectors(spark):
    rows = [(1, DenseVector([0.0, 2.0, 0.0, -1.0])), (2, SparseVector(9, [4, 7], [0.0, 3.0])), (3, DenseVector([])), (4, SparseVector(3, [], []))]
    got = {r["id"]: [tuple(p) for p in r["p"]] for r in spark.createDataFrame(rows, ["id", "v"]).select("id", places_on(F.col("v")).alias("p")).collect()}
    assert got == {1: [(1, 2.0), (3, -1.0)], 2: [(7, 3.0)], 3: [], 4: []}
