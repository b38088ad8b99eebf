"""Adapter from the driver's TPC-H-like tables to the conformed relations.

Pure column expressions, so the same mapping is written once for Spark
(:func:`load_testdata`) and once as DuckDB SQL (:data:`ADAPTER_SQL`, used by
the oracle queries).  Every relation is derived from the given tables, so
the work grows with the scale factor.

Mapping (see FIXTURES.md section 3):
  orders      <- orders (purchase = o_orderdate; lifecycle dates offset by key)
  items       <- lineitem (seller = supplier, product = part)
  payments    <- lineitem, one payment per line, method by line number
  reviews     <- orders that are not pending, score from the priority digit
  products    <- part
  customers   <- customer + nation (state = nation name)
  sellers     <- supplier + nation + region
  geolocation <- nation x 40 points
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.marketplace import Marketplace

TESTDATA_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the adapter: payment method by line number (7 -> NULL type).
PAYMENT_TYPE_BY_LINE = {1: "credit_card", 2: "boleto", 3: "voucher", 4: "debit_card", 5: "other", 6: "other"}
NULL_CATEGORY_BRAND = "Brand#25"
NULL_WEIGHT_SIZE = 50
GEO_POINTS_PER_NATION = 40


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _plus_days(ts: Column, days: Column) -> Column:
    return F.timestamp_add("DAY", days.cast("int"), ts)


def load_testdata(spark: SparkSession, sf_dir: str) -> Marketplace:
    t = {name: _read(spark, sf_dir, name) for name in TESTDATA_TABLES}
    o, li = t["orders"], t["lineitem"]
    key, day0 = F.col("o_orderkey"), F.col("o_orderdate")

    orders = o.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        day0.alias("order_purchase_timestamp"),
        _plus_days(day0, key % 3).alias("order_approved_at"),
        _plus_days(day0, 3 + key % 7).alias("order_delivered_carrier_date"),
        F.when(F.col("o_orderstatus") != "P", _plus_days(day0, 6 + key % 29)).alias("order_delivered_customer_date"),
        _plus_days(day0, F.lit(20)).alias("order_estimated_delivery_date"),
    )

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    # Order date per order key (the key is unique): written as an aggregate on the key so
    # Spark can prove uniqueness and drop this join wherever shipping_limit_date is unused.
    order_day = o.groupBy("o_orderkey").agg(F.min("o_orderdate").alias("o_orderdate"))
    items = li.join(order_day, li.l_orderkey == order_day.o_orderkey, "left").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,4)").alias("freight_value"),
        _plus_days(F.col("o_orderdate"), 2 + F.col("l_linenumber")).alias("shipping_limit_date"),
    )

    ptype = F.lit(None).cast("string")
    for line in sorted(PAYMENT_TYPE_BY_LINE, reverse=True):
        ptype = F.when(F.col("l_linenumber") == line, PAYMENT_TYPE_BY_LINE[line]).otherwise(ptype)
    payments = li.select(
        F.col("l_orderkey").alias("order_id"),
        ptype.alias("payment_type"),
        F.round(F.col("l_discount") * 100).cast("int").alias("payment_installments"),
        price.alias("payment_value"),
    )

    reviews = o.where(F.col("o_orderstatus") != "P").select(
        key.alias("order_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("review_score"),
        _plus_days(day0, key % 60).alias("review_creation_date"),
    )

    size = F.col("p_size")
    products = t["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_brand") != NULL_CATEGORY_BRAND, F.col("p_brand")).alias("product_category_name"),
        F.length("p_name").alias("product_description_lenght"),
        (size % 7).alias("product_photos_qty"),
        F.when(size != NULL_WEIGHT_SIZE, size * 100).alias("product_weight_g"),
        size.alias("product_length_cm"),
        (size % 10 + 1).alias("product_height_cm"),
        (size % 5 + 1).alias("product_width_cm"),
    )

    nation = t["nation"].select("n_nationkey", "n_name", "n_regionkey")
    customers = t["customer"].join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        (F.col("c_nationkey") * 100 + F.col("c_custkey") % 10).alias("customer_zip_code_prefix"),
        F.concat(F.col("n_name"), F.lit("-"), (F.col("c_custkey") % 3).cast("string")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )

    region = t["region"].select("r_regionkey", "r_name")
    seller_city = F.concat(F.col("n_name"), F.lit("-"), (F.col("s_suppkey") % 3).cast("string"))
    sellers = (
        t["supplier"]
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").alias("seller_id"),
            (F.col("s_nationkey") * 100 + F.col("s_suppkey") % 10).alias("seller_zip_code_prefix"),
            seller_city.alias("seller_city"),
            F.col("n_name").alias("seller_state"),
            F.col("r_name").alias("seller_region"),
            F.when(seller_city.endswith("-0"), 1).otherwise(0).alias("seller_is_capital"),
        )
    )

    # 40 points per nation, 4 per zip prefix; generated per nation row, no join.
    z = F.col("z")
    nk = F.col("n_nationkey")
    geolocation = (
        t["nation"]
        .select(nk, F.explode(F.sequence(F.lit(0), F.lit(GEO_POINTS_PER_NATION - 1))).alias("z"))
        .select(
            (nk * 100 + z % 10).alias("geolocation_zip_code_prefix"),
            (F.lit(-30) + F.lit(1.1).cast("decimal(2,1)") * nk
             + F.lit(0.05).cast("decimal(3,2)") * (z % 7)).alias("geolocation_lat"),
            (F.lit(-68) + F.lit(1.2).cast("decimal(2,1)") * nk
             + F.lit(0.05).cast("decimal(3,2)") * (z % 11)).alias("geolocation_lng"),
        )
    )

    return Marketplace(orders=orders, items=items, payments=payments, reviews=reviews, products=products,
                       customers=customers, sellers=sellers, geolocation=geolocation)


# The same adapter in DuckDB SQL: a WITH-list prefix for the oracle queries.
ADAPTER_SQL = f"""
mk_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_purchase_timestamp,
         o_orderdate + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS order_approved_at,
         o_orderdate + to_days(CAST(3 + o_orderkey % 7 AS INTEGER)) AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days(CAST(6 + o_orderkey % 29 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + to_days(20) AS order_estimated_delivery_date
  FROM orders
),
mk_items AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS order_item_id, l.l_partkey AS product_id,
         l.l_suppkey AS seller_id, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(12,4))
           AS freight_value,
         o.o_orderdate + to_days(CAST(2 + l.l_linenumber AS INTEGER)) AS shipping_limit_date
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
mk_payments AS (
  SELECT l_orderkey AS order_id,
         CASE l_linenumber {" ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(PAYMENT_TYPE_BY_LINE.items()))} END
           AS payment_type,
         CAST(ROUND(l_discount * 100) AS INTEGER) AS payment_installments,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS payment_value
  FROM lineitem
),
mk_reviews AS (
  SELECT o_orderkey AS order_id, CAST(SUBSTR(o_orderpriority, 1, 1) AS INTEGER) AS review_score,
         o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS review_creation_date
  FROM orders WHERE o_orderstatus <> 'P'
),
mk_products AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_brand <> '{NULL_CATEGORY_BRAND}' THEN p_brand END AS product_category_name,
         LENGTH(p_name) AS product_description_lenght, p_size % 7 AS product_photos_qty,
         CASE WHEN p_size <> {NULL_WEIGHT_SIZE} THEN p_size * 100 END AS product_weight_g,
         p_size AS product_length_cm, p_size % 10 + 1 AS product_height_cm, p_size % 5 + 1 AS product_width_cm
  FROM part
),
mk_customers AS (
  SELECT c.c_custkey AS customer_id, c.c_custkey AS customer_unique_id,
         c.c_nationkey * 100 + c.c_custkey % 10 AS customer_zip_code_prefix,
         n.n_name || '-' || CAST(c.c_custkey % 3 AS VARCHAR) AS customer_city, n.n_name AS customer_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
mk_sellers AS (
  SELECT s.s_suppkey AS seller_id, s.s_nationkey * 100 + s.s_suppkey % 10 AS seller_zip_code_prefix,
         n.n_name || '-' || CAST(s.s_suppkey % 3 AS VARCHAR) AS seller_city, n.n_name AS seller_state,
         r.r_name AS seller_region,
         CASE WHEN ends_with(n.n_name || '-' || CAST(s.s_suppkey % 3 AS VARCHAR), '-0') THEN 1 ELSE 0 END
           AS seller_is_capital
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
mk_geolocation AS (
  SELECT n.n_nationkey * 100 + g.z % 10 AS geolocation_zip_code_prefix,
         -30 + CAST(1.1 AS DECIMAL(2,1)) * n.n_nationkey + CAST(0.05 AS DECIMAL(3,2)) * (g.z % 7) AS geolocation_lat,
         -68 + CAST(1.2 AS DECIMAL(2,1)) * n.n_nationkey + CAST(0.05 AS DECIMAL(3,2)) * (g.z % 11) AS geolocation_lng
  FROM nation n, (SELECT range AS z FROM range({GEO_POINTS_PER_NATION})) g
)"""
