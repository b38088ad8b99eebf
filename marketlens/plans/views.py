"""Expose the feature tables to SQL users as temporary views.

    register_feature_views(spark, mk, "2018-07-01")
    spark.sql("SELECT idSeller, vlPrecoKgVida FROM fs_products ORDER BY idSeller")

The views are lazy DataFrames -- Catalyst prunes the columns and pushes the
filters of each query into the feature plan like any other view -- except
that the location view writes its (seller, order) base once when registered.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from marketlens.functions.dates import DateLike
from marketlens.operators import customers, delivery, geo, payments, products, reputation
from marketlens.sources.marketplace import Marketplace

VIEWS = {
    "fs_products": lambda mk, ref: products.products_snapshot(mk, ref),
    "fs_reputation": lambda mk, ref: reputation.reputation_snapshot(mk, ref),
    "fs_seller_meio_pagamento": lambda mk, ref: payments.payments_snapshot(mk, ref),
    "fs_customers": lambda mk, ref: customers.customers_snapshot(mk, ref),
    "fs_delivery": lambda mk, ref: delivery.delivery_snapshot(mk, ref),
    "fs_geoloc": lambda mk, ref: geo.geo_snapshot(mk, ref),
}


def register_feature_views(spark: SparkSession, mk: Marketplace, ref: DateLike,
                           names: list[str] | None = None) -> list[str]:
    """Register the feature tables at ``ref`` as temp views; returns the view names."""
    chosen = names or list(VIEWS)
    for name in chosen:
        VIEWS[name](mk, ref).createOrReplaceTempView(name)
    return chosen
