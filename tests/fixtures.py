"""Hand-made marketplace rows for paths the driver testdata never takes (FIXTURES.md section 4)."""

import datetime as dt
from decimal import Decimal

from marketlens.sources.marketplace import Marketplace

SCHEMAS = {
    "orders": "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz, "
              "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "items": "order_id string, order_item_id int, product_id string, seller_id string, price decimal(12,2), "
             "freight_value decimal(12,2), shipping_limit_date timestamp_ntz",
    "payments": "order_id string, payment_type string, payment_installments int, payment_value decimal(12,2)",
    "reviews": "order_id string, review_score int, review_creation_date timestamp_ntz",
    "products": "product_id string, product_category_name string, product_description_lenght int, "
                "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, "
                "product_width_cm int",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double",
}


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def money(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.01"))


def order(oid, cust, when, approved=None, carrier=None, delivered=None, estimated=None):
    return (oid, cust, ts(when), *(ts(x) if x else None for x in (approved, carrier, delivered, estimated)))


def item(oid, n, pid, sid, price, freight=0, limit=None):
    return (oid, n, pid, sid, money(price), money(freight), ts(limit) if limit else None)


def marketplace(spark, **rows) -> Marketplace:
    frames = {name: spark.createDataFrame(rows.get(name, []), SCHEMAS[name]) for name in SCHEMAS}
    return Marketplace(**frames)
