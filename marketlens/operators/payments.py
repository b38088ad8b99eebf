"""Payment-mix features (F21-F27), one row per seller and month with a sale.

For each (seller, month m) the features use the seller's orders with
purchase time in [m - n days, m) (n = 28, 56, 365) or before m (lifetime);
each seller's first month is therefore all NULL.

The reference writes this as a range join of the month grid to the order
history, which copies each order into every later month of its seller.
Here every feature is a ratio of sums, so:

1. payments are rolled up per order (one pass over payments);
2. orders are reduced to exact partial sums per (seller, month), parted by
   the windows of a later month that begin inside it;
3. a window of month m is made of whole months before m and the part of one
   month, so a frame over the seller's months with a sale gives its total.
   Those months are the grid: no row is made for a window.

A window partition holds one seller's *months*, not orders, so its size is
bounded by the calendar whatever the seller's volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import DateLike, to_date
from marketlens.functions.money import to_double, whole_units
from marketlens.functions.ratios import safe_ratio
from marketlens.functions.skew import deal
from marketlens.sources.marketplace import Marketplace

# The four named payment methods; anything else with a type is 'outros'.
METHODS = ("credit_card", "boleto", "voucher", "debit_card")
ALL_METHODS = (*METHODS, "outros")
WINDOWS = (("d28", 28), ("d56", 56), ("d365", 365), ("vida", None))
# So many months before its own a window begins: n days are more than any one month less, and no more than so many.
MONTHS_BACK = {28: 1, 56: 2, 365: 12}
TS = "order_purchase_timestamp"


def value_scale(payments: DataFrame) -> int:
    """Scale of the whole units the payment values are summed in."""
    return whole_units(payments, "payment_value")[1]


def _is_double(payments: DataFrame) -> bool:
    return payments.schema["payment_value"].dataType.typeName() in ("double", "float")


def order_payment_rollup(payments: DataFrame) -> DataFrame:
    """value and count by method per order, and the largest positive installment count.

    Values are whole units (see :func:`value_scale`), so their sums do not
    depend on an order; counts are longs.  Doubles that are no number or
    infinite cannot be units: they are counted apart, in ``up_`` (infinite or
    no number) and ``down_`` (minus infinite or no number), and spoil only the
    windows that hold them.
    """
    t = F.col("payment_type")
    v, odd = F.col("payment_value"), {}
    if _is_double(payments):
        infinite = F.lit(float("inf"))
        odd = {"up": F.isnan(v) | (v == infinite), "down": F.isnan(v) | (v == -infinite)}
        finite = F.when(~(odd["up"] | odd["down"]), v)
        payments = payments.withColumns({"payment_value": finite, **{f"__{k}": c for k, c in odd.items()}})
    v = whole_units(payments, "payment_value")[0]
    is_m = {m: t == m for m in METHODS}
    is_m["outros"] = ~t.isin(*METHODS)  # NULL type: neither a method nor 'outros'
    aggs = [F.sum(F.when(is_m[m], v).otherwise(0)).alias(f"vlr_{m}") for m in ALL_METHODS]
    aggs += [F.sum(F.when(is_m[m], 1).otherwise(0)).alias(f"qtde_{m}") for m in ALL_METHODS]
    aggs += [F.sum(F.when(is_m[m] & F.col(f"__{k}"), 1).otherwise(0)).alias(f"{k}_{m}") for k in odd for m in ALL_METHODS]
    inst = F.col("payment_installments")
    aggs.append(F.max(F.when(inst > 0, inst)).alias("max_payment_installments"))
    return payments.groupBy("order_id").agg(*aggs)


def seller_orders(mk: Marketplace, cutoff: DateLike) -> DataFrame:
    """(seller, order) pairs before the cutoff with the whole order's payments."""
    o = mk.orders.where(F.col(TS) < F.lit(to_date(cutoff))).select("order_id", TS)
    pairs = deal(mk.items.select("order_id", "seller_id"), "order_id").distinct()
    return o.join(pairs, "order_id").join(order_payment_rollup(mk.payments), "order_id", "left")


def seller_month_grid(base: DataFrame) -> DataFrame:
    """Months in which the seller sold (``ref_month`` as yyyyMM)."""
    return base.select(
        "seller_id", F.trunc(F.to_date(TS), "month").alias("month")
    ).distinct().select("seller_id", "month", F.date_format("month", "yyyyMM").alias("ref_month"))


def _parts(base: DataFrame) -> DataFrame:
    """Sums by (seller, month) and, for each window length n, whether a day is in the window that begins in its month.

    That window is the one of ``MONTHS_BACK[n]`` months later.
    """
    aggs = [F.count(f"vlr_{METHODS[0]}").alias("n_paid")]
    aggs += [F.sum(c).alias(c) for c in base.columns if c.startswith(("vlr_", "qtde_", "up_", "down_"))]
    aggs += [F.sum("max_payment_installments").alias("inst_sum"), F.count("max_payment_installments").alias("inst_cnt")]
    day = F.to_date(TS)
    month = F.trunc(day, "month").cast("date")
    late = [(day >= F.date_sub(F.add_months(month, back), n)).alias(f"in_{n}") for n, back in MONTHS_BACK.items()]
    return base.groupBy("seller_id", month.alias("month"), *late).agg(*aggs)


MEASURES = (["n_paid", "vlr_total", "qtde_total", "inst_sum", "inst_cnt"]
            + [f"vlr_{m}" for m in ALL_METHODS] + [f"qtde_{m}" for m in ALL_METHODS])


def windowed_totals(base: DataFrame) -> DataFrame:
    """Per (seller, month m): each measure summed over [m - n days, m) and over all days before m.

    A window's total is the sum of the whole months between its first and m,
    and of the part of its first month that it holds.  Frames of months hold
    12 rows at most, the lifetime's grows by a row.  Empty windows give 0 here
    and their counts are 0 too, so every feature -- a ratio over a count or a
    total -- is NULL exactly as with a NULL sum.  The rows come in ranges of
    sellers, each in order.
    """
    parts = _parts(base)
    measures = [c for c in parts.columns if c not in ("seller_id", "month") and not c.startswith("in_")]
    parts = parts.repartitionByRange("seller_id")
    sums = [F.sum(m).alias(m) for m in measures]
    sums += [F.sum(F.when(F.col(f"in_{n}"), F.col(m))).alias(f"{m}_in_{n}") for n in MONTHS_BACK for m in measures]
    months = parts.groupBy("seller_id", "month").agg(*sums).withColumn("number", F.year("month") * 12 + F.month("month"))
    line = Window.partitionBy("seller_id").orderBy("number")

    def over(m: str, first: int, last: int) -> Column:
        return F.coalesce(F.sum(m).over(line.rangeBetween(first, last)), F.lit(0))

    def total(m: str, days: int | None) -> Column:
        if days is None:
            return over(m, Window.unboundedPreceding, -1)
        back = MONTHS_BACK[days]
        first = over(f"{m}_in_{days}", -back, -back)
        return first if back == 1 else first + over(m, 1 - back, -1)

    out = months.select("seller_id", F.date_format("month", "yyyyMM").alias("ref_month"),
                        *[total(m, days).alias(f"{m}__{name}") for name, days in WINDOWS for m in measures])
    of_methods = lambda stem, w: sum((_c(f"{stem}_{m}", w) for m in ALL_METHODS[1:]), _c(f"{stem}_{ALL_METHODS[0]}", w))
    return out.withColumns({f"{stem}_total__{w}": of_methods(stem, w) for w, _ in WINDOWS for stem in ("vlr", "qtde")})


def _c(m: str, w: str) -> Column:
    return F.col(f"{m}__{w}")


def family_columns(scale: int, double: bool = False) -> dict[str, list[Column]]:
    def money(m: str, w: str) -> Column:
        value = to_double(_c(m, w), scale)
        if not double:
            return value
        methods = ALL_METHODS if m == "vlr_total" else (m.removeprefix("vlr_"),)
        up, down = (sum((_c(f"{k}_{x}", w) for x in methods), F.lit(0)) > 0 for k in ("up", "down"))
        infinite = float("inf")
        return (F.when(up & down, F.lit(float("nan"))).when(up, F.lit(infinite)).when(down, F.lit(-infinite)).otherwise(value))

    avg_value = [safe_ratio(money(f"vlr_{m}", w), _c("n_paid", w)).alias(f"avg_vlr_{m}_{w}")
                 for w, _ in WINDOWS for m in ALL_METHODS]
    installments = [safe_ratio(_c("inst_sum", w), _c("inst_cnt", w)).alias(f"avg_payment_installments_{w}")
                    for w, _ in WINDOWS]
    count_share = [safe_ratio(_c(f"qtde_{m}", w), _c("qtde_total", w)).alias(f"share_qtde_{m}_{w}")
                   for w, _ in WINDOWS for m in ALL_METHODS]
    value_share = [safe_ratio(money(f"vlr_{m}", w), money("vlr_total", w)).alias(f"share_valor_{m}_{w}")
                   for w, _ in WINDOWS for m in ALL_METHODS]
    return {"payment_avg_value": avg_value, "payment_installments": installments,
            "payment_count_share": count_share, "payment_value_share": value_share}


SNAPSHOT_ORDER = ["payment_avg_value", "payment_installments", "payment_count_share", "payment_value_share"]


def payment_features(mk: Marketplace, cutoff: DateLike, families: list[str] | None = None) -> DataFrame:
    scale = value_scale(mk.payments)
    totals = windowed_totals(seller_orders(mk, cutoff))
    fam = family_columns(scale, _is_double(mk.payments))
    return totals.select("seller_id", "ref_month", *[c for f in (families or SNAPSHOT_ORDER) for c in fam[f]])


def payments_snapshot(mk: Marketplace, cutoff: DateLike) -> DataFrame:
    """All 64 payment-mix features for every (seller, month with a sale) before ``cutoff``."""
    return payment_features(mk, cutoff)


__all__ = ["order_payment_rollup", "payment_features", "payments_snapshot", "seller_month_grid", "seller_orders",
           "windowed_totals"]
