"""The eight conformed marketplace relations every feature group reads.

Column contract (names as in the public e-commerce schema the features were
written for; types are what the operators expect):

* orders:      order_id, customer_id, order_purchase_timestamp,
               order_approved_at, order_delivered_carrier_date,
               order_delivered_customer_date, order_estimated_delivery_date
* items:       order_id, order_item_id, product_id, seller_id, price,
               freight_value, shipping_limit_date
* payments:    order_id, payment_type, payment_installments, payment_value
* reviews:     order_id, review_score, review_creation_date
* products:    product_id, product_category_name, product_description_lenght,
               product_photos_qty, product_weight_g, product_length_cm,
               product_height_cm, product_width_cm
* customers:   customer_id, customer_unique_id, customer_zip_code_prefix,
               customer_city, customer_state
* sellers:     seller_id, seller_zip_code_prefix, seller_city, seller_state
               [, seller_region, seller_is_capital -- optional overrides]
* geolocation: geolocation_zip_code_prefix, geolocation_lat, geolocation_lng

Money columns are best kept DECIMAL so sums are exact; the operators cast
to double only at the output edge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "items", "payments", "reviews", "products", "customers", "sellers", "geolocation")

# Physical table names of the public dataset, by conformed relation.
DEFAULT_TABLE_NAMES = {
    "orders": "orders",
    "items": "order_items",
    "payments": "order_payments",
    "reviews": "order_reviews",
    "products": "products",
    "customers": "customers",
    "sellers": "sellers",
    "geolocation": "geolocation",
}


@dataclass(frozen=True)
class Marketplace:
    orders: DataFrame
    items: DataFrame
    payments: DataFrame
    reviews: DataFrame
    products: DataFrame
    customers: DataFrame
    sellers: DataFrame
    geolocation: DataFrame

    @property
    def spark(self) -> SparkSession:
        return self.orders.sparkSession


def from_catalog(spark: SparkSession, database: str | None = None,
                 names: dict[str, str] | None = None) -> Marketplace:
    """Bind the relations to catalog tables (``database.table``)."""
    names = {**DEFAULT_TABLE_NAMES, **(names or {})}
    prefix = f"{database}." if database else ""
    return Marketplace(**{t: spark.table(prefix + names[t]) for t in TABLES})


def from_parquet(spark: SparkSession, root: str, names: dict[str, str] | None = None) -> Marketplace:
    """Bind the relations to ``{root}/{table}`` parquet folders or files."""
    names = {**DEFAULT_TABLE_NAMES, **(names or {})}
    return Marketplace(**{t: spark.read.parquet(f"{root.rstrip('/')}/{names[t]}") for t in TABLES})
