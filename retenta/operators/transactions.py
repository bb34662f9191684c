"""Customer, order and item joins of the transaction data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retenta.functions.expr import cents, elapsed_days


def customer_orders(customers: DataFrame, orders: DataFrame, key: str = "customer_id") -> DataFrame:
    """All customers with their orders; those without keep NULLs.

    Written as an inner join plus the customers without orders: the engine can
    split a busy customer's rows in an inner join, but not on the right side
    of a left join.
    """
    matched = customers.join(orders, key)
    alone = customers.join(orders.select(key).distinct(), key, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def order_summary(items: DataFrame, *, order: str = "order_id", item: str = "order_item_id",
                  product: str = "product_id", price: str = "price", freight: str = "freight_value") -> DataFrame:
    """Items, products and money per order, rounded half-even to cents.

    The mean starts from a sum rounded to 6 digits, so summation order cannot flip a tie.
    """
    return items.groupBy(order).agg(
        F.count(item).alias("total_items"), F.count_distinct(product).alias("unique_products"),
        cents(F.sum(price)).alias("total_price"), cents(F.round(F.sum(price), 6) / F.count(price)).alias("avg_item_price"),
        cents(F.sum(freight)).alias("total_freight"))


def with_order_summary(orders: DataFrame, summary: DataFrame, order: str = "order_id") -> DataFrame:
    """The items were aggregated first, so this join never multiplies rows."""
    return orders.join(summary, order, "left")


def churn_label(df: DataFrame, date: str = "order_purchase_timestamp", days: int = 180) -> DataFrame:
    """1 when the row's date lies more than `days` before the newest date; NULL dates give 0."""
    since = elapsed_days(F.col(date), df.agg(F.max(date)).scalar())
    return df.withColumn("days_since_last_order", since).withColumn(
        "churn", F.coalesce(F.col("days_since_last_order") > days, F.lit(False)).cast("int"))
