"""Freight and delivery features (F36-F43), one row per seller.

Items are added up by seller, days between estimate and delivery, and order
day; that histogram's trailing sums at every reference date
(:mod:`marketlens.functions.timeline`) give all features, the exact
percentiles with the counts as frequencies.  Items are scanned once and never
copied for a date.  The reference date bound is inclusive (``ts <= ref``): an
order placed at midnight counts on its own day, any other from the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import horizons as H
from marketlens.functions.dates import DateLike, keep_ref, snapshot_dates
from marketlens.functions.horizons import REF, Horizon
from marketlens.functions.money import to_double, whole_units
from marketlens.functions.ratios import safe_ratio, stddev_from_moments
from marketlens.functions.timeline import dated_sums, sum_name
from marketlens.sources.marketplace import Marketplace

HORIZONS = H.make(("vida", None), ("28d", 28), ("56d", 56), ("365d", 365))
LIFETIME = HORIZONS[0]
TS = "order_purchase_timestamp"
KEY = [REF, "seller_id"]
#: Durations in days: measure -> (end, start).
DURATIONS = {
    "promised": ("order_estimated_delivery_date", "order_approved_at"),
    "arrival": ("order_delivered_customer_date", "order_approved_at"),
    "transit": ("order_delivered_customer_date", "order_delivered_carrier_date"),
    "limit": ("shipping_limit_date", "order_approved_at"),
    "dispatch": ("order_delivered_carrier_date", "shipping_limit_date"),
}


def shipped_items(mk: Marketplace, refs: DateLike | list[DateLike], inclusive: bool = True) -> DataFrame:
    """Items of orders up to the last reference date, with their measures in whole units."""
    last, ts, day = F.lit(snapshot_dates(refs)[-1]), F.col(TS), F.to_date(TS)
    o = mk.orders.where(ts <= last if inclusive else ts < last)
    price, freight = (whole_units(mk.items, c)[0] for c in ("price", "freight_value"))
    i = mk.items.select("order_id", "seller_id", price.alias("price"), freight.alias("freight"), "shipping_limit_date")
    rows = o.join(i, "order_id")
    after = F.when(ts == day, F.date_sub(day, 1)).otherwise(day) if inclusive else day
    spans = [c for name, (end, start) in DURATIONS.items() for c in (
        F.datediff(end, start).alias(name), F.datediff(end, start).isNotNull().cast("int").alias(f"{name}_n"))]
    return rows.select("seller_id", day.alias("day"), after.alias("after"),
                       F.datediff("order_estimated_delivery_date", "order_delivered_customer_date").alias("diff_days"),
                       F.lit(1).alias("items"), "price", "freight", F.col("freight").isNotNull().cast("int").alias("freight_n"),
                       *spans)


def delivery_histogram(mk: Marketplace, refs: DateLike | list[DateLike], inclusive: bool = True) -> DataFrame:
    """By (dtRef, seller, diff_days): items and money of each horizon, and lifetime sums of the durations."""
    measures = {m: HORIZONS for m in ("items", "price", "freight", "freight_n")}
    measures |= {m: (LIFETIME,) for name in DURATIONS for m in (name, f"{name}_n")}
    return dated_sums(shipped_items(mk, refs, inclusive), ["seller_id", "diff_days"], measures, HORIZONS, refs, after="after",
                      by=["seller_id"])


def _sum(measure: str, h: Horizon = LIFETIME) -> Column:
    return F.sum(sum_name(measure, h))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _mean(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n.cast("double"))


def _late(value: Column) -> Column:
    """Over late items only.  'Late' keeps the source rule: estimated minus delivered > 0."""
    return F.sum(F.when(F.col("diff_days") > 0, value).otherwise(0))


def freight_ratio_cols(sc: dict) -> list[Column]:
    return [_or_zero(safe_ratio(to_double(_sum("freight", h), sc["freight"]), to_double(_sum("price", h), sc["price"])) * 100)
            .alias(f"pct_frete_ped_{h.name}") for h in HORIZONS]


def freight_avg_cols(sc: dict) -> list[Column]:
    return [_or_zero(F.try_divide(to_double(_sum("freight", h), sc["freight"]), _sum("freight_n", h).cast("double")))
            .alias(f"avg_frete_{h.name}") for h in HORIZONS]


def _duration(name: str) -> Column:
    return _or_zero(_mean(_sum(name), _sum(f"{name}_n")))


def delivery_time_cols(sc: dict | None = None) -> list[Column]:
    return [_duration("promised").alias("avg_sla_entrega"), _duration("arrival").alias("avg_entrega"),
            _duration("transit").alias("avg_transp_ped")]


def early_late_cols(sc: dict | None = None) -> list[Column]:
    """F39, F40."""
    n = lambda h: F.col(sum_name("items", h))
    out = [_late(n(LIFETIME)).alias("n_ped_atrasados")]
    out += [_or_zero(safe_ratio(_late(n(h)), F.sum(n(h))) * 100).alias(f"pct_ped_atrasados_{h.name}") for h in HORIZONS]
    out += [_or_zero(_mean(_late(n(h) * F.col("diff_days")), _late(n(h)))).alias(f"avg_entrega_ped_atrasados_{h.name}")
            for h in HORIZONS]
    return out


def diff_percentile_cols(sc: dict | None = None) -> list[Column]:
    n = F.col(sum_name("items", LIFETIME))
    return [F.percentile("diff_days", p, n).alias(f"diff_entrega_ped_{int(p * 100)}p") for p in (0.25, 0.5, 0.75)]


def dispatch_time_cols(sc: dict | None = None) -> list[Column]:
    return [_duration("limit").alias("avg_tempo_limite_vendedor"), _duration("dispatch").alias("avg_tempo_atraso_vendedor"),
            _duration("transit").alias("avg_tempo_transportadora")]


def consistency_cols(sc: dict | None = None) -> list[Column]:
    """coefficient of variation of (estimated - delivered) days, exact moments."""
    x, k = F.col("diff_days"), F.col(sum_name("items", LIFETIME))
    n, s1, s2 = F.sum(F.when(x.isNotNull(), k).otherwise(0)), F.sum(x * k), F.sum(x * x * k)
    cv = safe_ratio(stddev_from_moments(n, s1, s2), F.try_divide(s1.cast("double"), n.cast("double")))
    return [_or_zero(cv).alias("consistencia")]


FAMILIES = {
    "freight_ratio": freight_ratio_cols,
    "freight_avg": freight_avg_cols,
    "delivery_times": delivery_time_cols,
    "early_late_orders": early_late_cols,
    "delivery_diff_percentiles": diff_percentile_cols,
    "seller_dispatch_times": dispatch_time_cols,
    "delivery_consistency": consistency_cols,
}
SNAPSHOT_ORDER = ["freight_ratio", "freight_avg", "delivery_times", "early_late_orders",
                  "delivery_diff_percentiles", "seller_dispatch_times", "delivery_consistency"]


def delivery_features(mk: Marketplace, refs: DateLike | list[DateLike], families: list[str],
                      with_ref: bool = False, inclusive: bool = True) -> DataFrame:
    hist = delivery_histogram(mk, refs, inclusive)
    sc = {"price": whole_units(mk.items, "price")[1], "freight": whole_units(mk.items, "freight_value")[1]}
    cols = [c for fam in families for c in FAMILIES[fam](sc)]
    return keep_ref(hist.groupBy(*KEY).agg(*cols), refs, with_ref)


def delivery_snapshot(mk: Marketplace, refs: DateLike | list[DateLike], with_ref: bool = False,
                      inclusive: bool = True) -> DataFrame:
    """All 27 delivery features, one row per seller with items up to ``ref`` (inclusive)."""
    return delivery_features(mk, refs, SNAPSHOT_ORDER, with_ref, inclusive)
