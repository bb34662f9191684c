from pyspark.sql import functions as F

from retenta.operators.transactions import customer_orders


def test_customer_orders_keeps_all_customers(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "customer_id long, city string")
    o = spark.createDataFrame([(10, 1), (11, 1), (12, 9)], "order_id long, customer_id long")
    got = sorted((r["city"], r["order_id"]) for r in customer_orders(c, o).collect() if r["order_id"])
    assert got == [("a", 10), ("a", 11)]
    assert customer_orders(c, o).where(F.col("order_id").isNull()).count() == 2
