"""Cleaning and file queries.  A subscription table and an order table are derived from
customer and orders by expression, on both sides."""

from pyspark.sql import functions as F

from retenta.operators import cleaning as C
from retenta.session import work_folder
from retenta.sources import files as IO
from workload.registry import query

SERVICES = C.INTERNET_SERVICES


def telco(t):
    i = F.col("c_custkey")
    cents = F.floor(F.col("c_acctbal") + 2000.0).cast("long") * (i % 72)
    service = {s: F.when((i + k) % 3 == 0, "Yes").when((i + k) % 3 == 1, " No").otherwise("No internet service")
               for k, s in enumerate(SERVICES)}
    return t.customer.select(
        F.concat(F.lit("C"), i.cast("string")).alias("customerID"),
        F.when(i % 2 == 0, " Male ").otherwise("Female").alias("gender"),
        F.when(i % 3 == 0, 1).otherwise(0).cast("long").alias("SeniorCitizen"),
        F.when(i % 2 == 0, "Yes").otherwise("No").alias("Partner"),
        F.when(i % 4 == 0, "Yes").when(i % 4 == 1, "maybe").otherwise("No").alias("Dependents"),
        (i % 72).alias("tenure"),
        F.when(i % 5 == 0, "No").otherwise("Yes").alias("PhoneService"),
        F.when(i % 3 == 0, "Yes").when(i % 3 == 1, "No").otherwise("No phone service").alias("MultipleLines"),
        F.when(i % 7 == 0, "No").when(i % 7 < 4, "DSL").otherwise("Fiber optic").alias("InternetService"),
        *[service[s].alias(s) for s in SERVICES],
        F.when(i % 3 == 0, "One year").otherwise("Month-to-month").alias("Contract"),
        F.when(i % 2 == 0, "No").otherwise("Yes").alias("PaperlessBilling"),
        F.lit("Mailed check").alias("PaymentMethod"),
        (F.floor(F.col("c_acctbal") + 2000.0) / F.lit(100.0)).alias("MonthlyCharges"),
        F.when(i % 13 == 0, " ").when(i % 11 == 0, F.concat((cents * 2).cast("string"), F.lit(".5")))
        .otherwise(F.concat(F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))).alias("TotalCharges"),
        F.when(i % 4 == 0, "Yes").otherwise("No").alias("Churn"),
    )


def _service(k: int, s: str) -> str:
    return (f"CASE WHEN (i + {k}) % 3 = 0 THEN 'Yes' WHEN (i + {k}) % 3 = 1 THEN ' No' ELSE 'No internet service' END AS {s}")


TELCO = f"""src AS (SELECT c_custkey AS i, CAST(floor(c_acctbal + 2000e0) AS BIGINT) AS m FROM customer),
telco AS (SELECT 'C' || i AS "customerID", CASE WHEN i % 2 = 0 THEN ' Male ' ELSE 'Female' END AS gender,
  CAST(CASE WHEN i % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS "SeniorCitizen", CASE WHEN i % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
  CASE WHEN i % 4 = 0 THEN 'Yes' WHEN i % 4 = 1 THEN 'maybe' ELSE 'No' END AS "Dependents", i % 72 AS tenure,
  CASE WHEN i % 5 = 0 THEN 'No' ELSE 'Yes' END AS "PhoneService",
  CASE WHEN i % 3 = 0 THEN 'Yes' WHEN i % 3 = 1 THEN 'No' ELSE 'No phone service' END AS "MultipleLines",
  CASE WHEN i % 7 = 0 THEN 'No' WHEN i % 7 < 4 THEN 'DSL' ELSE 'Fiber optic' END AS "InternetService",
  {', '.join(_service(k, f'"{s}"') for k, s in enumerate(SERVICES))},
  CASE WHEN i % 3 = 0 THEN 'One year' ELSE 'Month-to-month' END AS "Contract", CASE WHEN i % 2 = 0 THEN 'No' ELSE 'Yes' END AS "PaperlessBilling",
  'Mailed check' AS "PaymentMethod", m / 100e0 AS "MonthlyCharges",
  CASE WHEN i % 13 = 0 THEN ' ' WHEN i % 11 = 0 THEN (m * (i % 72) * 2) || '.5'
    ELSE (m * (i % 72) // 100) || '.' || lpad(CAST(m * (i % 72) % 100 AS VARCHAR), 2, '0') END AS "TotalCharges",
  CASE WHEN i % 4 = 0 THEN 'Yes' ELSE 'No' END AS "Churn" FROM src),
loaded AS (SELECT * REPLACE (TRY_CAST(trim("TotalCharges") AS DOUBLE) AS "TotalCharges") FROM telco)"""

FILLED = TELCO + """,
zeroed AS (SELECT * REPLACE (CASE WHEN tenure = 0 AND "TotalCharges" IS NULL THEN 0 ELSE "TotalCharges" END AS "TotalCharges") FROM loaded),
filled AS (SELECT * REPLACE (coalesce("TotalCharges", (SELECT quantile_cont("TotalCharges", 0.5) FROM zeroed)) AS "TotalCharges") FROM zeroed)"""


def _no(c: str) -> str:
    return f"""CASE WHEN trim("{c}") IN ('No internet service', 'No phone service') THEN 'No' ELSE trim("{c}") END"""


TRIMMED = ["gender", "Partner", "Dependents", "PhoneService", "InternetService", "Contract", "PaperlessBilling", "PaymentMethod", "Churn"]
FLAGS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling", "Churn"]
CLEAN = FILLED + f""",
std AS (SELECT * REPLACE ({', '.join(f'trim("{c}") AS "{c}"' for c in TRIMMED)}, {', '.join(f'{_no(c)} AS "{c}"' for c in C.SERVICE_COLUMNS)}) FROM filled),
ruled AS (SELECT * REPLACE (CASE WHEN "PhoneService" = 'No' AND "MultipleLines" = 'Yes' THEN 'No' ELSE "MultipleLines" END AS "MultipleLines",
  {', '.join(f'''CASE WHEN "InternetService" = 'No' AND "{s}" = 'Yes' THEN 'No' ELSE "{s}" END AS "{s}"''' for s in SERVICES)}) FROM std),
flagged AS (SELECT * REPLACE ({', '.join(f'''CASE "{c}" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS "{c}"''' for c in FLAGS)}) FROM ruled),
lim AS (SELECT quantile_cont(tenure, 0.01) t1, quantile_cont(tenure, 0.99) t9, quantile_cont("MonthlyCharges", 0.01) m1, quantile_cont("MonthlyCharges", 0.99) m9,
  quantile_cont("TotalCharges", 0.01) c1, quantile_cont("TotalCharges", 0.99) c9 FROM flagged),
cleaned AS (SELECT flagged.* REPLACE (least(greatest(tenure, t1), t9) AS tenure, least(greatest("MonthlyCharges", m1), m9) AS "MonthlyCharges",
  least(greatest("TotalCharges", c1), c9) AS "TotalCharges") FROM flagged, lim)"""


@query("load_telco_csv", f"WITH {TELCO} SELECT * FROM loaded", real="MonthlyCharges TotalCharges")
def load_telco_csv(t):
    import uuid

    path = f"{work_folder(t.spark)}/telco-{uuid.uuid4().hex}"
    telco(t).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return IO.read_telco(t.spark, path)


def telco_loaded(t):
    return telco(t).withColumn("TotalCharges", F.expr("try_cast(trim(TotalCharges) AS DOUBLE)"))


@query("telco_schema_check", f"""WITH {TELCO}, d AS (SELECT * REPLACE (CASE WHEN tenure = 5 THEN 'C0' ELSE "customerID" END AS "customerID",
  CASE WHEN tenure = 7 THEN 'unknown' ELSE "Churn" END AS "Churn") FROM loaded)
  SELECT 'duplicate_id' AS violation, count(*) - count(DISTINCT "customerID") AS n FROM d UNION ALL SELECT 'invalid_label', count(*) FROM d WHERE "Churn" NOT IN ('Yes', 'No')""", whole="n")
def telco_schema_check(t):
    d = telco_loaded(t).withColumns({"customerID": F.when(F.col("tenure") == 5, "C0").otherwise(F.col("customerID")),
                                     "Churn": F.when(F.col("tenure") == 7, "unknown").otherwise(F.col("Churn"))})
    return IO.telco_violations(d)


@query("fill_total_charges", f'WITH {FILLED} SELECT "customerID", "TotalCharges" FROM filled', real="TotalCharges")
def fill_total_charges(t):
    return C.fill_total_charges(telco_loaded(t)).select("customerID", "TotalCharges")


@query("standardise_texts", f'WITH {CLEAN} SELECT "customerID", gender, "MultipleLines", {", ".join(chr(34) + s + chr(34) for s in SERVICES)} FROM std')
def standardise_texts(t):
    return C.standardise_texts(telco_loaded(t)).select("customerID", "gender", "MultipleLines", *SERVICES)


@query("map_flags", f'WITH {CLEAN} SELECT "customerID", {", ".join(chr(34) + s + chr(34) for s in FLAGS)} FROM flagged')
def map_flags(t):
    return C.map_flags(telco_loaded(t)).select("customerID", *FLAGS)


@query("unreasonable_charges", f"""WITH {FILLED} SELECT "customerID" FROM filled WHERE tenure > 0 AND ("TotalCharges" > tenure * "MonthlyCharges" * 1.5e0 OR "TotalCharges" < tenure * "MonthlyCharges" * 5e-1)""")
def unreasonable_charges(t):
    return C.unreasonable_charges(C.fill_total_charges(telco_loaded(t))).select("customerID")


@query("clean_telco", f"WITH {CLEAN} SELECT * FROM cleaned", real="tenure MonthlyCharges TotalCharges")
def clean_telco(t):
    return C.clean_telco(telco_loaded(t))


def shop(t):
    i = F.col("o_orderkey")
    return t.orders.select(
        i.cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(i % 17 != 0, F.col("o_orderdate")).alias("order_purchase_timestamp"),
        F.when(i % 19 != 0, F.col("o_orderdate") + F.make_dt_interval(((i % 20) - 3).cast("int"))).alias("order_delivered_customer_date"),
        F.when(i % 23 == 0, -F.col("o_totalprice")).when(i % 29 != 0, F.col("o_totalprice")).alias("total_price"),
        F.when(i % 31 != 0, (i % 6) - 1).alias("total_items"), F.when(i % 7 != 0, F.col("o_totalprice") / 16.0).alias("total_freight"))


SHOP = """shop AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate END AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 19 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 20 - 3 AS INTEGER)) END AS order_delivered_customer_date,
  CASE WHEN o_orderkey % 23 = 0 THEN -o_totalprice WHEN o_orderkey % 29 <> 0 THEN o_totalprice END AS total_price,
  CASE WHEN o_orderkey % 31 <> 0 THEN o_orderkey % 6 - 1 END AS total_items, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice / 16e0 END AS total_freight FROM orders)"""
RULED = """ruled AS (SELECT * REPLACE (CASE WHEN total_price < 0 THEN 0 ELSE total_price END AS total_price,
  CASE WHEN order_delivered_customer_date < order_purchase_timestamp THEN NULL ELSE order_delivered_customer_date END AS order_delivered_customer_date)
  FROM {src} WHERE total_items IS NULL OR total_items > 0)"""


@query("order_rules", f"WITH {SHOP}, {RULED.format(src='shop')} SELECT * FROM ruled", real="total_price total_freight", whole="total_items")
def order_rules(t):
    return C.apply_order_rules(shop(t))


@query("clean_orders", f"""WITH {SHOP}, kept AS (SELECT * REPLACE (coalesce(total_price, 0) AS total_price, coalesce(total_freight, 0) AS total_freight) FROM shop
  WHERE order_purchase_timestamp IS NOT NULL AND order_delivered_customer_date IS NOT NULL), {RULED.format(src='kept')},
  lim AS (SELECT quantile_cont(total_price, 0.01) p1, quantile_cont(total_price, 0.99) p9, quantile_cont(total_freight, 0.01) f1, quantile_cont(total_freight, 0.99) f9 FROM ruled)
  SELECT ruled.* REPLACE (least(greatest(total_price, p1), p9) AS total_price, least(greatest(total_freight, f1), f9) AS total_freight) FROM ruled, lim""",
       real="total_price total_freight", whole="total_items")
def clean_orders(t):
    return C.clean_orders(shop(t))


@query("order_schema_check", f"WITH {SHOP} SELECT 'warning' AS level, 'negative_price' AS violation, count(*) AS n FROM shop WHERE total_price < 0", whole="n")
def order_schema_check(t):
    return IO.order_violations(shop(t).withColumns({"customer_city": F.lit("x"), "customer_state": F.lit("y")}))


@query("load_orders_csv", """WITH c AS (SELECT c_custkey FROM customer),
  o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS d FROM orders),
  i AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS p, round_even(sum(l_extendedprice), 2) AS s FROM lineitem GROUP BY 1)
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(o_orderkey AS VARCHAR) AS order_id, d AS order_purchase_timestamp, n AS total_items, p AS unique_products, s AS total_price,
    CASE WHEN date_sub('day', d, (SELECT max(d) FROM o)) > 180 THEN 1 ELSE 0 END AS churn
  FROM c LEFT JOIN o ON o_custkey = c_custkey LEFT JOIN i ON l_orderkey = o_orderkey""",
       real="total_price", whole="total_items unique_products churn", digits=2)
def load_orders_csv(t):
    import uuid

    base = f"{work_folder(t.spark)}/shop-{uuid.uuid4().hex}"
    t.customer.select(F.col("c_custkey").alias("customer_id")).write.option("header", True).csv(f"{base}/{IO.ORDER_FILES['customers']}")
    t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 9 == 0, "not a date").otherwise(F.col("o_orderdate").cast("string")).alias("order_purchase_timestamp"),
    ).write.option("header", True).csv(f"{base}/{IO.ORDER_FILES['orders']}")
    t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"), F.col("l_partkey").alias("product_id"),
                      F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("freight_value")
                      ).write.option("header", True).csv(f"{base}/{IO.ORDER_FILES['items']}")
    return IO.read_orders(t.spark, base).select("customer_id", "order_id", "order_purchase_timestamp", "total_items",
                                                "unique_products", "total_price", "churn")


@query("scoring_features", """WITH g AS (SELECT c_custkey, CASE WHEN c_custkey % 8 <> 0 THEN c_mktsegment END AS s, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS b FROM customer),
  codes AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS code FROM (SELECT DISTINCT s FROM g WHERE s IS NOT NULL))
  SELECT c_custkey, CAST(coalesce(code, -1) AS INTEGER) AS c_mktsegment, coalesce(b, (SELECT quantile_cont(b, 0.5) FROM g)) AS c_acctbal FROM g LEFT JOIN codes USING (s)""", real="c_acctbal")
def scoring_features(t):
    g = t.customer.select("c_custkey", F.when(F.col("c_custkey") % 8 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
                          F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    return C.scoring_features(g, drop=(), keep=("c_custkey",))


@query("category_codes", """SELECT 'p_name' AS "column", p_name AS value, CAST(row_number() OVER (ORDER BY p_name) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT p_name FROM part)
  UNION ALL SELECT 'p_brand', p_brand, CAST(row_number() OVER (ORDER BY p_brand) - 1 AS INTEGER) FROM (SELECT DISTINCT p_brand FROM part)""")
def category_codes(t):
    return C.fit_codes(t.part, ["p_name", "p_brand"])


@query("search", """SELECT * FROM customer WHERE lower(c_name) LIKE '%99%' OR CAST(c_custkey AS VARCHAR) LIKE '%99%'
  OR CAST(c_nationkey AS VARCHAR) LIKE '%99%' OR lower(c_mktsegment) LIKE '%99%'""")
def search(t):
    return C.search(t.customer, "99", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
