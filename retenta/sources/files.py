"""Readers and writers: fixed-schema CSV scans, split and result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from retenta.functions.expr import finite
from retenta.operators.quality import impute, numeric_columns
from retenta.operators.transactions import churn_label, customer_orders, order_summary, with_order_summary

# fixed values: the subscription data set's columns and types
TELCO_SCHEMA = StructType([
    StructField("customerID", StringType()), StructField("gender", StringType()), StructField("SeniorCitizen", LongType()),
    StructField("Partner", StringType()), StructField("Dependents", StringType()), StructField("tenure", LongType()),
    StructField("PhoneService", StringType()), StructField("MultipleLines", StringType()),
    StructField("InternetService", StringType()), StructField("OnlineSecurity", StringType()),
    StructField("OnlineBackup", StringType()), StructField("DeviceProtection", StringType()),
    StructField("TechSupport", StringType()), StructField("StreamingTV", StringType()),
    StructField("StreamingMovies", StringType()), StructField("Contract", StringType()),
    StructField("PaperlessBilling", StringType()), StructField("PaymentMethod", StringType()),
    StructField("MonthlyCharges", DoubleType()), StructField("TotalCharges", StringType()), StructField("Churn", StringType()),
])
# fixed values: the order data set's timestamp columns and file names
ORDER_DATES = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date")
ORDER_FILES = {"customers": "olist_customers_dataset.csv", "orders": "olist_orders_dataset.csv",
               "items": "olist_order_items_dataset.csv"}
ORDER_COLUMNS = ("customer_id", "order_id", "customer_city", "customer_state")


def read_telco(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Subscription CSV with explicit types; text that is no number becomes NULL."""
    df = spark.read.schema(TELCO_SCHEMA).option("header", True).csv(path)
    df = df.withColumn("TotalCharges", F.expr("try_cast(trim(TotalCharges) AS DOUBLE)"))
    if check:
        bad = [r["violation"] for r in telco_violations(df).collect()]
        if bad:
            raise ValueError(f"schema check failed: {bad}")
    return df


def telco_violations(df: DataFrame) -> DataFrame:
    """Rows (violation, n): missing columns, repeated ids, label values other than Yes/No.  Empty = valid."""
    spark = df.sparkSession
    missing = [c for c in TELCO_SCHEMA.names if c not in df.columns]
    if missing:
        return spark.createDataFrame([(f"missing_column:{c}", 1) for c in missing], "violation string, n long")
    repeats = df.groupBy("customerID").agg(F.count(F.lit(1)).alias("k")).agg(
        F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("n")).select(F.lit("duplicate_id").alias("violation"), "n")
    labels = df.agg(F.count_if(F.coalesce(~F.col("Churn").isin("Yes", "No"), F.lit(True))).alias("n")).select(
        F.lit("invalid_label").alias("violation"), "n")
    return repeats.unionByName(labels).where("n > 0")


def order_violations(df: DataFrame) -> DataFrame:
    """Missing required columns (errors) and negative prices (a warning)."""
    spark = df.sparkSession
    missing = [c for c in ORDER_COLUMNS if c not in df.columns]
    if missing:
        return spark.createDataFrame([("error", f"missing_column:{c}", 1) for c in missing], "level string, violation string, n long")
    if "total_price" not in df.columns:
        return spark.createDataFrame([], "level string, violation string, n long")
    return df.agg(F.count_if(F.col("total_price") < 0).alias("n")).select(
        F.lit("warning").alias("level"), F.lit("negative_price").alias("violation"), "n").where("n > 0")


def read_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Three CSV scans joined: customers, orders, pre-aggregated items; bad dates are NULL; recency label added."""
    customers = spark.read.option("header", True).csv(f"{folder}/{ORDER_FILES['customers']}")
    orders = spark.read.option("header", True).csv(f"{folder}/{ORDER_FILES['orders']}")
    items = spark.read.option("header", True).csv(f"{folder}/{ORDER_FILES['items']}")
    orders = orders.withColumns({c: F.try_to_timestamp(F.col(c)).cast("timestamp_ntz") for c in ORDER_DATES if c in orders.columns})
    items = items.withColumns({c: F.expr(f"try_cast({c} AS DOUBLE)") for c in ("price", "freight_value")})
    df = with_order_summary(customer_orders(customers, orders, "customer_id"), order_summary(items), "order_id")
    return churn_label(df, "order_purchase_timestamp")


def read_upload(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV: subscription-like files are cleaned, others get median / mode fills ('Unknown' without a mode)."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    if {"customerID", "TotalCharges", "Churn"} <= set(df.columns):
        from retenta.operators.cleaning import clean_telco

        return clean_telco(df.withColumn("TotalCharges", F.expr("try_cast(trim(CAST(TotalCharges AS STRING)) AS DOUBLE)")))
    nums = numeric_columns(df)
    df = df.withColumns({c: finite(F.col(c)) for c in nums}) if nums else df
    df = impute(df, {c: "median" if c in nums else "mode" for c in df.columns})
    texts = [c for c in df.columns if c not in nums and dict(df.dtypes)[c] == "string"]
    return df.na.fill("Unknown", texts) if texts else df


def save_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One table partitioned by split, so reading one split skips the others."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    return spark.read.parquet(path).where(F.col(split) == name).drop(split)


def write_table_csv(df: DataFrame, path: str) -> None:
    """Result tables with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_recommendations(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Recommendations with the action lists joined by '; ', as csv or json."""
    lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
    flat = df.withColumns({c: F.array_join(c, "; ") for c in lists}) if lists else df
    if fmt == "csv":
        write_table_csv(flat, path)
    elif fmt == "json":
        flat.write.mode("overwrite").json(path)
    else:
        raise ValueError(f"unsupported format: {fmt}")
