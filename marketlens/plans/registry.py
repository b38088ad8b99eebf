"""Named queries over the driver testdata: Spark builders and their DuckDB oracles.

Every query reads the full testdata tables through the adapter; reference
dates are parameters (FIXTURES.md section 3).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import customers as C
from marketlens.operators import delivery as D
from marketlens.operators import geo as G
from marketlens.operators import payments as PM
from marketlens.operators import products as P
from marketlens.operators import reputation as R
from marketlens.functions.geo import zip_centroids
from marketlens.functions.money import to_double
from marketlens.plans import oracle_groups as OG
from marketlens.plans import oracle_products as OP
from marketlens.functions.dates import month_starts
from marketlens.plans import snapshots as S
from marketlens.plans.sqlkit import with_adapter
from marketlens.sources.testdata import load_testdata

REF_DATE = dt.date(2000, 1, 1)
# Backfill spine of the testdata: 19 month starts (FIXTURES.md section 3).
SPINE_FIRST, SPINE_LAST = dt.date(1999, 1, 1), dt.date(2000, 7, 1)
SHORT_SPINE = month_starts(dt.date(1999, 11, 1), REF_DATE)
# The days whose orders come late in the refresh query.
LATE_DAYS = (dt.date(1999, 11, 10), dt.date(1999, 11, 20))
# A date at which many sellers have not sold yet.
IDLE_DATE = dt.date(1995, 1, 5)
BACKFILLS = ("reputation", "customers", "delivery", "geo")
# Every state of the region rule, one that it does not know, and no state; capitals as they may be written, and others.
RULE_STATES = (*(x for states in G.REGION_STATES.values() for x in states), "XX", None)
RULE_CITIES = (*G.CAPITALS, "sao paulo", "Rio de Janeiro", "campinas", "SANTOS", None)

Query = Callable[[SparkSession, str], DataFrame]


def _mk(spark: SparkSession, sf_dir: str):
    return load_testdata(spark, sf_dir)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product sales at the reference date (input of every product feature)."""
    return P.product_sales(_mk(spark, sf_dir), REF_DATE)


def product_queries() -> dict[str, Query]:
    def scales(s, sf):
        return P.money_scales(_mk(s, sf))

    return {
        "seller_revenue_horizons": lambda s, sf: P.seller_revenue_horizons(_sales(s, sf), scales(s, sf), REF_DATE),
        "category_sale_flags": lambda s, sf: P.category_sale_flags(_sales(s, sf), REF_DATE),
        "product_sale_flags": lambda s, sf: P.product_sale_flags(_sales(s, sf), REF_DATE),
        "catalog_diversity": lambda s, sf: P.catalog_diversity(_sales(s, sf), REF_DATE),
        "category_competitors": lambda s, sf: P.category_competitors(_sales(s, sf), REF_DATE),
        "product_competitors": lambda s, sf: P.product_competitors(_sales(s, sf), REF_DATE),
        "item_weight_stats": lambda s, sf: P.item_weight_stats(_sales(s, sf), scales(s, sf), REF_DATE),
        "item_volume_stats": lambda s, sf: P.item_volume_stats(_sales(s, sf), scales(s, sf), REF_DATE),
        "price_freight_per_kg": lambda s, sf: P.price_freight_per_kg(_sales(s, sf), scales(s, sf), REF_DATE),
        "top_categories": lambda s, sf: P.top_categories(P.category_sales(_sales(s, sf), REF_DATE), scales(s, sf)),
        "portfolio_attributes": lambda s, sf: P.portfolio_attributes(_sales(s, sf), scales(s, sf), REF_DATE),
        "products_snapshot": lambda s, sf: P.products_snapshot(_mk(s, sf), REF_DATE),
        "products_by_seller": lambda s, sf: P.products_snapshot(_mk(s, sf), REF_DATE, seller_key="seller_id",
                                                                with_ref=False),
        "backfill_products": backfill_products,
        "snapshot_readback": snapshot_readback,
        "snapshot_positions": snapshot_positions,
        "refresh_delivery": refresh_delivery,
        "payments_overwrite": payments_overwrite,
        **{f"backfill_{g}": (lambda s, sf, g=g: backfill_group(s, sf, g)) for g in BACKFILLS},
    }


def backfill_products(s: SparkSession, sf: str) -> DataFrame:
    """R3 + R6 + X6: every month snapshot of the spine in one job."""
    return P.products_snapshot(_mk(s, sf), month_starts(SPINE_FIRST, SPINE_LAST))


def backfill_group(s: SparkSession, sf: str, group: str) -> DataFrame:
    """R3 + R6 + X6: three month snapshots of a group, built and written by ``backfill`` and read back."""
    path = S.scratch_path(s, f"backfill_{group}/{uuid.uuid4().hex}")
    S.backfill(group, _mk(s, sf), SHORT_SPINE[0], SHORT_SPINE[-1], path=path)
    return S.read_snapshot(s, path=path)


def snapshot_readback(s: SparkSession, sf: str) -> DataFrame:
    """Write three snapshots, replace the last (idempotent, the others stay), read all in key order."""
    path = S.scratch_path(s, f"snapshot_readback/{uuid.uuid4().hex}")
    S.write_group("products", _mk(s, sf), SHORT_SPINE, path=path)
    S.write_group("products", _mk(s, sf), SHORT_SPINE[-1:], path=path)
    return S.read_snapshot(s, path=path, order_by=["idSeller"]).select(*P.SNAPSHOT_COLS)


def snapshot_positions(s: SparkSession, sf: str) -> DataFrame:
    """S9 + O1: one written snapshot read in key order, with each row's place in it."""
    path = S.scratch_path(s, f"snapshot_positions/{uuid.uuid4().hex}")
    S.write_group("delivery", _mk(s, sf), SHORT_SPINE, path=path)
    return S.read_positions(s, ["seller_id"], path=path, ref=REF_DATE, group="delivery")


def refresh_delivery(s: SparkSession, sf: str) -> DataFrame:
    """Three snapshots built before the orders of some days came, refreshed when they are there."""
    path = S.scratch_path(s, f"refresh_delivery/{uuid.uuid4().hex}")
    mk = _mk(s, sf)
    early = replace(mk, orders=mk.orders.where(~F.to_date("order_purchase_timestamp").between(*map(F.lit, LATE_DAYS))))
    S.refresh("delivery", early, SHORT_SPINE, path)
    S.refresh("delivery", mk, SHORT_SPINE, path)
    return S.read_snapshot(s, path=path)


def payments_overwrite(s: SparkSession, sf: str) -> DataFrame:
    """S13 + S9: overwrite the whole payment table, first up to an earlier date; read one month back in key order."""
    path = S.scratch_path(s, f"payments_overwrite/{uuid.uuid4().hex}")
    for ref in (SHORT_SPINE[0], REF_DATE):
        S.write_group("payments", _mk(s, sf), [ref], path=path)
    return S.read_snapshot(s, path=path, ref=SHORT_SPINE[1], group="payments", order_by=["seller_id"])


def seller_region_rules(s: SparkSession, sf: str) -> DataFrame:
    """F46, F47 by their default rules, on sellers in the states and cities that the rules name."""
    n = F.col("s_suppkey")
    state = F.element_at(F.array(*[F.lit(x) for x in RULE_STATES]), (n % len(RULE_STATES) + 1).cast("int"))
    city = F.element_at(F.array(*[F.lit(x) for x in RULE_CITIES]), (n % len(RULE_CITIES) + 1).cast("int"))
    sellers = s.read.parquet(f"{sf}/supplier.parquet").select(
        n.alias("seller_id"), F.col("s_nationkey").alias("seller_zip_code_prefix"), city.alias("seller_city"),
        state.alias("seller_state"))
    return G.seller_attributes(sellers).select("seller_id", "seller_city", "seller_state", "regiao_seller", "flag_seller_capital")


def customers_of_several_ids(s: SparkSession, sf: str) -> DataFrame:
    """Three customer ids are one person, whose orders count together."""
    mk = _mk(s, sf)
    person = F.floor(F.col("customer_id") / 3).cast("long")
    return C.customers_snapshot(replace(mk, customers=mk.customers.withColumn("customer_unique_id", person)), REF_DATE)


def reputation_of_several_reviews(s: SparkSession, sf: str) -> DataFrame:
    """Orders with an even key have a second review, three days later and of the opposite score."""
    mk = _mk(s, sf)
    second = mk.reviews.where(F.col("order_id") % 2 == 0).select(
        "order_id", (6 - F.col("review_score")).alias("review_score"),
        F.timestamp_add("DAY", F.lit(3), "review_creation_date").alias("review_creation_date"))
    return R.reputation_snapshot(replace(mk, reviews=mk.reviews.unionByName(second)), REF_DATE)


PERSONS_SQL = "SELECT * REPLACE (customer_id // 3 AS customer_unique_id) FROM mk_customers"
REVIEWS_SQL = """SELECT * FROM mk_reviews UNION ALL
  SELECT order_id, 6 - review_score, review_creation_date + to_days(3) FROM mk_reviews WHERE order_id % 2 = 0"""


def delivery_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        k: (lambda s, sf, k=k: D.delivery_features(_mk(s, sf), REF_DATE, [k])) for k in D.FAMILIES}
    out["delivery_snapshot"] = lambda s, sf: D.delivery_snapshot(_mk(s, sf), REF_DATE)
    return out


def reputation_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        k: (lambda s, sf, k=k: R.reputation_features(_mk(s, sf), REF_DATE, [k])) for k in R.SNAPSHOT_ORDER}
    out["reputation_snapshot_reviews"] = reputation_of_several_reviews
    out["reputation_snapshot"] = lambda s, sf: R.reputation_snapshot(_mk(s, sf), REF_DATE)
    return out


def customer_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        k: (lambda s, sf, k=k: C.customer_features(_mk(s, sf), REF_DATE, k)) for k in C.FAMILY_KEYS}
    out["customers_snapshot_persons"] = customers_of_several_ids
    out["customers_snapshot"] = lambda s, sf: C.customers_snapshot(_mk(s, sf), REF_DATE)
    out["customer_period_base"] = lambda s, sf: C.customer_period_base(_mk(s, sf), REF_DATE)
    return out


def _rollup(s: SparkSession, sf: str) -> DataFrame:
    payments = _mk(s, sf).payments
    r, scale = PM.order_payment_rollup(payments), PM.value_scale(payments)
    return r.select("order_id", *[to_double(F.col(f"vlr_{m}"), scale).alias(f"vlr_{m}") for m in PM.ALL_METHODS],
                    *[f"qtde_{m}" for m in PM.ALL_METHODS], "max_payment_installments")


def payments_of_doubles(s: SparkSession, sf: str) -> DataFrame:
    """The payment mix of values that are doubles; the sums are those of the decimals they were made from."""
    mk = _mk(s, sf)
    doubles = mk.payments.withColumn("payment_value", F.col("payment_value").cast("double"))
    return PM.payments_snapshot(replace(mk, payments=doubles), REF_DATE)


def payment_queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        k: (lambda s, sf, k=k: PM.payment_features(_mk(s, sf), REF_DATE, [k])) for k in PM.SNAPSHOT_ORDER}
    out["payments_snapshot"] = lambda s, sf: PM.payments_snapshot(_mk(s, sf), REF_DATE)
    out["payments_snapshot_double"] = payments_of_doubles
    out["order_payment_rollup"] = _rollup
    out["seller_month_grid"] = lambda s, sf: PM.seller_month_grid(PM.seller_orders(_mk(s, sf), REF_DATE))
    return out


def geo_queries() -> dict[str, Query]:
    out: dict[str, Query] = {k: (lambda s, sf, k=k: G.geo_features(_mk(s, sf), REF_DATE, k)) for k in G.FAMILIES}
    out["geo_snapshot"] = lambda s, sf: G.geo_snapshot(_mk(s, sf), REF_DATE)
    out["geo_snapshot_idle"] = lambda s, sf: G.geo_snapshot(_mk(s, sf), IDLE_DATE)
    out["seller_region_rules"] = seller_region_rules
    out["zip_centroids"] = lambda s, sf: zip_centroids(_mk(s, sf).geolocation)
    out["order_distance"] = lambda s, sf: G.order_distance(_mk(s, sf), REF_DATE)
    return out


def _oracles(ctes: str, selects: dict[str, str]) -> dict[str, str]:
    return {k: with_adapter(ctes, sel) for k, sel in selects.items()}


def _rollup_oracle(ctes: str) -> str:
    cols = ", ".join([f"CAST(vlr_{m} AS DOUBLE) AS vlr_{m}" for m in PM.ALL_METHODS]
                     + [f"CAST(qtde_{m} AS BIGINT) AS qtde_{m}" for m in PM.ALL_METHODS])
    return with_adapter(ctes, f"SELECT order_id, {cols}, max_payment_installments FROM pm_roll")


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (product_queries, delivery_queries, reputation_queries, customer_queries, payment_queries,
                 geo_queries):
        out.update(part())
    return out


def _products_oracle(dates: list[dt.date]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({with_adapter(OP.ctes(d), OP.snapshot_select(d))})" for d in dates)


def _group_oracle(build, name: str, with_ref: bool) -> str:
    """A group's snapshots of the short spine, each by its own query."""
    parts = []
    for d in SHORT_SPINE:
        ctes, sel = build(d)
        parts.append(f"SELECT {f'DATE {chr(39)}{d}{chr(39)} AS dtRef, ' if with_ref else ''}* FROM ({with_adapter(ctes, sel[name])})")
    return "\nUNION ALL\n".join(parts)


def _region_rules_oracle() -> str:
    def q(x):
        return "NULL" if x is None else f"'{x}'"

    regions = " ".join(f"WHEN seller_state IN ({', '.join(map(q, states))}) THEN {q(region)}"
                       for region, states in G.REGION_STATES.items())
    return f"""SELECT seller_id, seller_city, seller_state, CASE {regions} ELSE {q(G.UNKNOWN_REGION)} END AS regiao_seller,
  CASE WHEN upper(seller_city) IN ({', '.join(map(q, G.CAPITALS))}) THEN 1 ELSE 0 END::INTEGER AS flag_seller_capital
FROM (SELECT s_suppkey AS seller_id, ([{', '.join(map(q, RULE_CITIES))}])[s_suppkey % {len(RULE_CITIES)} + 1] AS seller_city,
        ([{', '.join(map(q, RULE_STATES))}])[s_suppkey % {len(RULE_STATES)} + 1] AS seller_state FROM supplier)"""


def oracle_sql() -> dict[str, str]:
    out = _oracles(OP.ctes(REF_DATE), OP.selects(REF_DATE))
    out["backfill_products"] = _products_oracle(month_starts(SPINE_FIRST, SPINE_LAST))
    out["snapshot_readback"] = _products_oracle(SHORT_SPINE)
    for build in (OG.delivery, OG.reputation, OG.customers, OG.payments, OG.geo):
        ctes, sel = build(REF_DATE)
        out.update(_oracles(ctes, sel))
    ctes, _ = OG.payments(REF_DATE)
    out["order_payment_rollup"] = _rollup_oracle(ctes)
    out["payments_snapshot_double"] = out["payments_snapshot"]
    month = S.GROUPS["payments"].label(SHORT_SPINE[1])
    out["payments_overwrite"] = f"SELECT * FROM ({out['payments_snapshot']}) WHERE ref_month = '{month}'"
    for group, build, with_ref in (("reputation", OG.reputation, False), ("customers", OG.customers, False),
                                   ("delivery", OG.delivery, True), ("geo", OG.geo, True)):
        out[f"backfill_{group}"] = _group_oracle(build, f"{group}_snapshot", with_ref)
    ctes, sel = OG.customers(REF_DATE)
    out["customers_snapshot_persons"] = with_adapter(ctes, sel["customers_snapshot"], customers=PERSONS_SQL)
    ctes, sel = OG.reputation(REF_DATE)
    out["reputation_snapshot_reviews"] = with_adapter(ctes, sel["reputation_snapshot"], reviews=REVIEWS_SQL)
    out["refresh_delivery"] = out["backfill_delivery"]
    out["snapshot_positions"] = (f"SELECT *, row_number() OVER (ORDER BY seller_id) AS position FROM ({out['backfill_delivery']}) "
                                 f"WHERE dtRef = DATE '{REF_DATE}'")
    ctes, sel = OG.geo(IDLE_DATE)
    out["geo_snapshot_idle"] = with_adapter(ctes, sel["geo_snapshot"])
    out["seller_region_rules"] = _region_rules_oracle()
    return out
