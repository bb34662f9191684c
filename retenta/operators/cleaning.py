"""Cleaning rules of the subscription and order data sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.operators.quality import fit_quantiles, numeric_columns, text_columns, winsorise
from retenta.plans.order import number_rows

# fixed values: columns the rules apply to and the texts they replace
INTERNET_SERVICES = ("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")
SERVICE_COLUMNS = ("MultipleLines", *INTERNET_SERVICES)
ABSENT_SERVICE = ("No internet service", "No phone service")
FLAG_COLUMNS = ("Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn")
CHARGE_COLUMNS = ("tenure", "MonthlyCharges", "TotalCharges")


def fill_total_charges(df: DataFrame) -> DataFrame:
    """New customers (tenure 0) get 0 first; the median of the result fills the rest."""
    total = F.col("TotalCharges")
    df = df.withColumn("TotalCharges", F.when((F.col("tenure") == 0) & total.isNull(), F.lit(0.0)).otherwise(total))
    median = fit_quantiles(df, ["TotalCharges"], [0.5])["TotalCharges"][0]
    return df.withColumn("TotalCharges", F.coalesce(F.col("TotalCharges"), F.lit(median)))


def standardise_texts(df: DataFrame, ident: str = "customerID") -> DataFrame:
    """Trim every text but the id; 'No ... service' becomes 'No'.  NULL stays NULL."""
    changes = {}
    for c in text_columns(df):
        if c != ident:
            t = F.trim(F.col(c))
            changes[c] = F.when(t.isin(*ABSENT_SERVICE), F.lit("No")).otherwise(t) if c in SERVICE_COLUMNS else t
    return df.withColumns(changes)


def map_flags(df: DataFrame, cols: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """Yes -> 1, No -> 0, anything else -> NULL."""
    return df.withColumns({c: F.when(F.col(c) == "Yes", 1).when(F.col(c) == "No", 0) for c in cols if c in df.columns})


def apply_telco_rules(df: DataFrame) -> DataFrame:
    """No phone means no multiple lines; no internet means none of its services.  Works before or after map_flags."""
    phone = F.col("PhoneService").cast("string")
    no_phone = F.coalesce(phone.isin("No", "0"), F.lit(False))
    no_net = F.coalesce(F.col("InternetService") == "No", F.lit(False))

    def reset(c: str, cond: Column) -> Column:
        return F.when(cond & (F.col(c) == "Yes"), F.lit("No")).otherwise(F.col(c))

    changes = {"MultipleLines": reset("MultipleLines", no_phone)} if {"PhoneService", "MultipleLines"} <= set(df.columns) else {}
    if "InternetService" in df.columns:
        changes |= {c: reset(c, no_net) for c in INTERNET_SERVICES if c in df.columns}
    return df.withColumns(changes)


def unreasonable_charges(df: DataFrame) -> DataFrame:
    """Rows with tenure whose total lies outside 0.5x to 1.5x of tenure * monthly charge."""
    expected = F.col("tenure") * F.col("MonthlyCharges")
    return df.where((F.col("tenure") > 0) & ((F.col("TotalCharges") > expected * 1.5) | (F.col("TotalCharges") < expected * 0.5)))


def clean_telco(df: DataFrame) -> DataFrame:
    """Fill charges, standardise, map flags, apply rules, clip the charge columns; in this order."""
    out = apply_telco_rules(map_flags(standardise_texts(fill_total_charges(df))))
    return winsorise(out, [c for c in CHARGE_COLUMNS if c in out.columns])


def apply_order_rules(df: DataFrame) -> DataFrame:
    """Negative prices to 0, delivery before purchase to NULL, orders without items dropped (unknown kept)."""
    if "total_price" in df.columns:
        df = df.withColumn("total_price", F.when(F.col("total_price") < 0, F.lit(0.0)).otherwise(F.col("total_price")))
    delivered, bought = F.col("order_delivered_customer_date"), F.col("order_purchase_timestamp")
    df = df.withColumn("order_delivered_customer_date", F.when(~F.coalesce(delivered < bought, F.lit(False)), delivered))
    if "total_items" in df.columns:
        df = df.where(F.col("total_items").isNull() | (F.col("total_items") > 0))
    return df


def clean_orders(df: DataFrame) -> DataFrame:
    """Fill money with 0, drop rows without dates, apply the rules, clip the money columns."""
    money = [c for c in ("total_price", "total_freight") if c in df.columns]
    df = df.na.fill(0.0, money).na.drop(subset=["order_purchase_timestamp", "order_delivered_customer_date"])
    df = apply_order_rules(df)
    return winsorise(df, [c for c in ("total_price", "avg_item_price", "total_freight") if c in df.columns])


def fit_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, code): position of each distinct text in sorted order, from 0.

    Values are dealt by ranges of whole texts, so a long common prefix does not
    put them into one task.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    values = df.select(F.explode(cells).alias("r")).select("r.*").where("value is not null").distinct()
    ranked = number_rows(values, ["value"], ["column"], "rank")
    return ranked.select("column", "value", (F.col("rank") - 1).cast("int").alias("code"))


def apply_codes(df: DataFrame, cols: Sequence[str], codes: DataFrame) -> DataFrame:
    """Texts replaced by fitted codes; NULL and unseen values become -1."""
    for c in cols:
        one = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(f"_{c}"))
        df = df.join(one, c, "left").withColumn(c, F.coalesce(F.col(f"_{c}"), F.lit(-1))).drop(f"_{c}")
    return df


def scoring_features(df: DataFrame, drop: Sequence[str] = ("Churn",), keep: Sequence[str] = ("customerID",),
                     codes: DataFrame | None = None) -> DataFrame:
    """Feature columns for batch scoring: texts as codes, numbers median-filled, label dropped."""
    df = df.drop(*drop)
    texts = [c for c in text_columns(df) if c not in keep]
    nums = [c for c in numeric_columns(df) if c not in keep]
    medians = fit_quantiles(df, nums, [0.5])
    df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m[0])) for c, m in medians.items()})
    return apply_codes(df, texts, fit_codes(df, texts) if codes is None else codes)


def search(df: DataFrame, term: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows where any column's text contains the term, ignoring case."""
    hay = [F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(term.lower())), F.lit(False)) for c in (cols or df.columns)]
    cond = hay[0]
    for h in hay[1:]:
        cond = cond | h
    return df.where(cond)
