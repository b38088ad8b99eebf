"""Review reputation features (F12-F20), one row per seller (NULL seller kept) and dtRef.

Source grain is order x review x item (the fan-out is part of the
definition: a review on an n-item order counts n times).  That product is
never made: an order's reviews are reduced to sums and its items to a count a
seller before they meet, and a (seller, order) has the reviews' sums times its
items.  All three are dealt by order into all shuffle partitions, so a task
holds its share of the orders.  Rows are one per (seller, order), with flags
and exact partial sums, then summed per seller with map-side aggregation, so a
hot seller never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import horizons as H
from marketlens.functions.dates import DateLike, as_of, snapshot_dates
from marketlens.functions.horizons import REF, in_horizon, ref_col
from marketlens.functions.ratios import safe_ratio, stddev_from_moments
from marketlens.functions.skew import deal
from marketlens.sources.marketplace import Marketplace

WINDOWS = H.make(("28", 28), ("56", 56), ("365", 365))
TS = "order_purchase_timestamp"
KEY = [REF, "seller_id"]


def review_rows(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """Orders before ref, left-joined to their reviews and their items: a row a (seller, order).

    The fan-out is kept in numbers: ``orders`` and ``items`` say how many rows
    of each there are, and the reviews' sums are those of one order and item.
    """
    score = F.col("review_score")
    o = mk.orders.select("order_id", TS).where(F.col(TS) < F.lit(snapshot_dates(refs)[-1]))
    o = deal(o, "order_id").groupBy("order_id", TS).agg(F.count(F.lit(1)).alias("orders"))
    r = deal(mk.reviews.select("order_id", "review_score", "review_creation_date"), "order_id").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"), F.count(score).alias("n_sc"), F.sum(score).alias("s1"), F.sum(score * score).alias("s2"),
        *[F.sum(F.when(score == k, 1).otherwise(0)).alias(f"c{k}") for k in range(1, 6)],
        F.collect_set(F.to_date("review_creation_date")).alias("review_days"))
    i = deal(mk.items.select("order_id", "seller_id"), "order_id").groupBy("order_id", "seller_id").agg(F.count(F.lit(1)).alias("items"))
    return o.join(r, "order_id", "left").join(i, "order_id", "left")


def per_order(rows: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """One row per (dtRef, seller, order): flags and exact partial sums, from ``review_rows``.

    The reference dates are attached last.
    """
    times = F.col("orders") * F.coalesce("items", F.lit(1))
    n_rows = times * F.coalesce("reviews", F.lit(1))
    sums = [
        n_rows.alias("n_rows"),
        F.when(F.col("items").isNotNull(), n_rows).otherwise(0).alias("n_item_rows"),
        (times * F.coalesce("n_sc", F.lit(0))).alias("n_sc"),
        *[(times * F.col(s)).alias(s) for s in ("s1", "s2")],
        *[(times * F.coalesce(f"c{k}", F.lit(0))).alias(f"c{k}") for k in range(1, 6)],
        F.col("reviews").isNotNull().cast("int").alias("has_review"),
        F.coalesce("review_days", F.array().cast("array<date>")).alias("review_days"),
    ]
    rows = rows.select("seller_id", "order_id", TS, *sums)
    orders = as_of(rows, TS, refs)

    def reviewed(days: int) -> Column:
        lo, hi = F.date_sub(ref_col(), days), ref_col()
        return F.exists("review_days", lambda d: (d >= lo) & (d <= hi)).cast("int")

    return orders.withColumns({f"rv{w.name}": reviewed(w.days) for w in WINDOWS})


def _sum_in(w, c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(F.when(in_horizon(TS, w), c).otherwise(0)) if w is not None else F.sum(c)


def reputation_sums(orders: DataFrame) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_orders"), F.sum("has_review").alias("n_reviewed"),
            F.sum("n_rows").alias("rows_all"), F.sum("n_item_rows").alias("item_rows_all")]
    for w in [*WINDOWS, None]:
        sfx = w.name if w else "L"
        aggs += [
            _sum_in(w, F.lit(1)).alias(f"ord_{sfx}"),
            _sum_in(w, "has_review").alias(f"revd_{sfx}"),
            _sum_in(w, "n_rows").alias(f"rows_{sfx}"),
            _sum_in(w, "n_sc").alias(f"n_{sfx}"),
            _sum_in(w, "s1").alias(f"s1_{sfx}"),
            _sum_in(w, "s2").alias(f"s2_{sfx}"),
            *[_sum_in(w, f"c{k}").alias(f"c{k}_{sfx}") for k in range(1, 6)],
        ]
    aggs += [F.sum(f"rv{w.name}").alias(f"rv_{w.name}") for w in WINDOWS]
    return orders.groupBy(*KEY).agg(*aggs)


def _perc3_name(k: int, w) -> str:
    if w is None:
        return f"percNota{k}Lifetime"
    return "perc_nota_3_d56" if (k == 3 and w.name == "56") else f"percNota{k}D{w.name}"


def family_columns() -> dict[str, list[Column]]:
    c = F.col
    ws = [*WINDOWS, None]
    counts = [c(f"rv_{w.name}").alias(f"reviews{w.name}d") for w in WINDOWS] + [c("n_orders").alias("reviewsLifetime")]
    coverage = [F.round(safe_ratio(c(f"revd_{w.name}") * 100, c(f"ord_{w.name}")), 2).alias(f"percentual{w.name}d")
                for w in WINDOWS]
    coverage.append(F.round(safe_ratio(c("revd_L") * 100, c("ord_L")), 2).alias("percentualLifetime"))
    score_stats = []
    for stem, fn in (("mediaAvaliacoes", lambda s: safe_ratio(c(f"s1_{s}"), c(f"n_{s}"))),
                     ("desvpadAvaliacoes", lambda s: stddev_from_moments(c(f"n_{s}"), c(f"s1_{s}"), c(f"s2_{s}")))):
        score_stats.append(F.round(fn("L"), 2).alias(f"{stem}Lifetime"))
        score_stats += [F.round(fn(w.name), 2).alias(f"{stem}D{w.name}") for w in WINDOWS]
    notes = []
    for k in (1, 2):
        notes.append(F.round(safe_ratio(c(f"c{k}_L"), c("rows_all")), 2).alias(f"pctNota{k}"))
        notes += [F.round(safe_ratio(c(f"c{k}_{w.name}"), c("rows_all")), 2).alias(f"pctNota{k}D{w.name}")
                  for w in WINDOWS]
    for k in (3, 4, 5):
        notes += [safe_ratio(c(f"c{k}_{w.name if w else 'L'}"), c(f"rows_{w.name if w else 'L'}")).alias(
            _perc3_name(k, w)) for w in ws]
    good_bad = []
    for stem, ks in (("pctNotasBoas", (4, 5)), ("pctNotasRuins", (1, 2))):
        for w in ws:
            s = w.name if w else "L"
            hits = c(f"c{ks[0]}_{s}") + c(f"c{ks[1]}_{s}")
            den = c(f"rows_{s}") if w else c("item_rows_all")
            good_bad.append(safe_ratio(hits, den).alias(f"{stem}D{w.name}" if w else f"{stem}Lifetime"))
    return {"review_counts": counts, "review_coverage": coverage, "review_score_stats": score_stats,
            "review_note_shares": notes, "good_bad_reviews": good_bad}


SNAPSHOT_ORDER = ["review_counts", "review_coverage", "review_score_stats", "review_note_shares", "good_bad_reviews"]


def reputation_features(mk: Marketplace, refs: DateLike | list[DateLike], families: list[str],
                        seller_col: str = "seller_id") -> DataFrame:
    sums = reputation_sums(per_order(review_rows(mk, refs), refs))
    fam = family_columns()
    cols = [col for f in families for col in fam[f]]
    return sums.select(F.col(REF), F.col("seller_id").alias(seller_col), *cols)


def reputation_snapshot(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """All 44 review features with keys (dtRef, idSeller)."""
    return reputation_features(mk, refs, SNAPSHOT_ORDER, seller_col="idSeller")
