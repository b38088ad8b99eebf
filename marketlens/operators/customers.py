"""Customer loyalty and churn features (F28-F35), one row per seller and safra.

Periods are [ref - n days, ref) for n = 28, 56, 365 and all history
('full'); churn compares with the equal-length period just before.

Orders are added up by (seller, customer, day); the trailing sums of that
table at every reference date (:mod:`marketlens.functions.timeline`) hold, for
each pair and date, the orders of each period and of twice its length, the
first and last order day and the last day before each period.  Pairs are
shuffled once for any number of dates, without a range join or LAG window, and
the rows of a date are added up to the seller in the task that makes them.

Repurchase interval (F33): consecutive purchase dates telescope.  For the
orders of one (seller, customer) inside a period, sorted by time, the sum
of day gaps to the previous purchase is ``last_in - predecessor`` where the
predecessor is the latest purchase before the period, or -- if none -- the
first purchase inside it (which then has no gap); the number of gaps is
``n`` or ``n - 1`` accordingly.  This equals the average of
``datediff(ts, lag(ts))`` over the period, ties included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import horizons as H
from marketlens.functions.dates import DateLike, as_of, snapshot_dates
from marketlens.functions.horizons import REF, ref_col
from marketlens.functions.ratios import safe_ratio
from marketlens.functions.timeline import dated_sums, sum_name
from marketlens.sources.marketplace import Marketplace

PERIODS = (("28d", 28), ("56d", 56), ("365d", 365), ("full", None))
#: The periods, and those of twice the length, from which the previous one follows.
HORIZONS = H.make(*PERIODS)
DOUBLE = H.make(*((f"2x{name}", 2 * days) for name, days in PERIODS if days))
FULL_START = dt.date(1900, 1, 1)
TS = "order_purchase_timestamp"
KEY = [REF, "seller_id"]
DEC = "decimal(38,0)"


def seller_customer_orders(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """Distinct (seller, order, person, purchase day) before the last reference date."""
    o = mk.orders.where(F.col(TS) < F.lit(snapshot_dates(refs)[-1])).select("order_id", "customer_id", TS)
    i = mk.items.select("order_id", "seller_id")
    c = mk.customers.select("customer_id", "customer_unique_id")
    pairs = o.join(i, "order_id").join(c, "customer_id").select("seller_id", "order_id", "customer_unique_id", TS).distinct()
    return pairs.select("seller_id", "customer_unique_id", F.to_date(TS).alias("day"), F.lit(1).alias("orders"))


def period_base(orders: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """period definitions per seller (dt_inicio, dt_fim, prev_dt_fim)."""
    sellers = as_of(orders.groupBy("seller_id").agg(F.min("day").alias("first")), "first", refs)
    start = lambda days: F.lit(FULL_START) if days is None else F.date_sub(ref_col(), days)
    periods = F.array(*[
        F.struct(F.lit(name).alias("periodo"), start(days).alias("dt_fim"), start(days and 2 * days).alias("prev_dt_fim"))
        for name, days in PERIODS])
    return sellers.select(
        "seller_id", F.col(REF).alias("safra_mes"), F.inline(periods)
    ).select("seller_id", "safra_mes", "periodo", F.col("safra_mes").alias("dt_inicio"), "dt_fim", "prev_dt_fim")


def per_customer(orders: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """A row a (dtRef, seller, customer) with an order before it."""
    return dated_sums(orders, ["seller_id", "customer_unique_id"], ["orders"], (*HORIZONS, *DOUBLE), refs, days_before=HORIZONS)


def per_seller(cust: DataFrame) -> DataFrame:
    aggs = []
    for h in HORIZONS:
        n, name = F.col(sum_name("orders", h)), h.name
        active = n > 0
        before = F.lit(None).cast("date") if h.lifetime else F.col(f"before_{name}")
        gaps = F.when(before.isNotNull(), n).otherwise(n - 1)
        new = F.lit(True) if h.lifetime else F.col("first") >= F.date_sub(ref_col(), h.days)
        aggs += [
            F.count(F.when(active, 1)).alias(f"qtd_{name}"),
            F.sum(n).alias(f"tot_{name}"),
            F.count(F.when(n >= 2, 1)).alias(f"rep_{name}"),
            F.sum((n * n).cast(DEC)).alias(f"sq_{name}"),
            F.sum(F.when(active, F.datediff("last", F.coalesce(before, F.col("first"))))).alias(f"gsum_{name}"),
            F.sum(F.when(active, gaps)).alias(f"gcnt_{name}"),
            F.max(F.when(new, F.col("first"))).alias(f"lastnew_{name}"),
        ]
        if not h.lifetime:
            aggs.append(F.count(F.when(F.col(f"orders_2x{name}") > n, 1)).alias(f"prev_{name}"))
    return cust.groupBy(*KEY).agg(*aggs)


def _metric_columns() -> dict[str, tuple[str, Column]]:
    """Output name -> (family, column)."""
    c = F.col
    out: dict[str, tuple[str, Column]] = {}
    for name, days in PERIODS:
        has = c(f"qtd_{name}") > 0

        def z(expr, zero=0.0, has=has):
            # Periods with no current customer have no metrics row: every feature is 0.
            return F.when(has, F.coalesce(expr, F.lit(zero))).otherwise(F.lit(zero))

        qtd = c(f"qtd_{name}")
        tot = c(f"tot_{name}").cast(DEC)
        prev = c(f"prev_{name}") if days is not None else None
        cols = [
            ("repeat", "vl_qtd_clientes_distintos", qtd),
            ("repeat", "pct_taxa_recompra_periodo", z(F.round(safe_ratio(c(f"rep_{name}"), qtd), 4))),
            ("repeat", "vl_avg_pedidos_por_cliente", z(F.round(safe_ratio(c(f"tot_{name}"), qtd), 4))),
            ("hhi", "pct_concentracao_ihh", z(F.round(safe_ratio(c(f"sq_{name}"), tot * tot), 6))),
            ("interval", "vl_tempo_medio_recompra",
             z(F.round(safe_ratio(c(f"gsum_{name}"), c(f"gcnt_{name}")), 2))),
        ]
        if prev is not None:
            lost = F.greatest(prev - qtd, F.lit(0))
            cols.append(("churn", "pct_churn_clientes", z(F.round(safe_ratio(lost, prev), 4))))
        cols.append(("new", "vl_dias_desde_ultimo_cliente_novo",
                     z(F.datediff(ref_col(), c(f"lastnew_{name}")), 0).cast("int")))
        for fam, stem, col in cols:
            out[f"{stem}_{name}"] = (fam, col.alias(f"{stem}_{name}"))
    return out


FAMILY_KEYS = {
    "customer_repeat_rate": "repeat",
    "customer_hhi": "hhi",
    "repurchase_interval": "interval",
    "customer_churn": "churn",
    "days_since_new_customer": "new",
}


def _keys() -> list[Column]:
    return [F.col("seller_id"), F.trunc(F.col(REF), "month").alias("dtSafra")]


def customer_features(mk: Marketplace, refs: DateLike | list[DateLike], key: str | None = None) -> DataFrame:
    """Loyalty features of one family (a FAMILY_KEYS key), or all 27 when ``key`` is None."""
    sums = per_seller(per_customer(seller_customer_orders(mk, refs), refs))
    fam = FAMILY_KEYS.get(key)
    cols = [col for f, col in _metric_columns().values() if fam is None or f == fam]
    return sums.select(*_keys(), *cols)


def customers_snapshot(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """All 27 loyalty features with keys (seller_id, dtSafra = month of the reference date)."""
    return customer_features(mk, refs)


def customer_period_base(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    return period_base(seller_customer_orders(mk, refs), refs)
