"""Location, distance and market-coverage features (F44-F59), one row per seller.

Sellers with no order before the reference date are kept (flagged).

Items are rolled up to (seller, order) once, with both places and the distance,
and no date.  That table is written and read three times, whatever the number
of dates: for the orders by place, for each seller's destinations and for its
distances, each as trailing sums at every date
(:mod:`marketlens.functions.timeline`).

Scale notes:
* Distinct orders across sellers (state volume, market size) are one distinct
  of (kind of place, place, order), so a state holding a third of all orders
  is spread over tasks, and then counted.
* The median distance is the first element of the (seller, km) histogram whose
  running count reaches half of the orders.
* Seller rank inside its state (RANK() OVER state ORDER BY orders DESC) is
  computed from a per-state histogram of order counts: rank = 1 + number of
  sellers with a larger count.  The window then runs over distinct count
  values of a state, not over all its sellers.
* Main destination (top-1 per seller with tie-break) is a ``min`` over a
  struct (-orders, state, city): one partial-aggregated ``groupBy``.
* Coverage gap: the reference compares the seller's share of orders per
  destination state with the market share on a dense seller x state grid.
  For states the seller never served the gap is just ``-market share``, so
  the sums only need the states the seller served plus the market share of
  the rest:  with n_i orders of the seller in state i (N in total), D_i
  market orders in state i (T in total, Dnn over non-NULL states)

      sum|gap| = ( sum_i |n_i T - D_i N| + (Dnn - sum_i D_i) N ) / (N T)
      sum gap+ = sum_i max(n_i T - D_i N, 0) / (N T)

  evaluated on exact integers with a single final division.  No cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import horizons as H
from marketlens.functions.dates import DateLike, keep_ref, snapshot_dates
from marketlens.functions.horizons import REF
from marketlens.functions.geo import haversine_km, zip_centroids
from marketlens.functions.money import to_double, whole_units_at
from marketlens.functions.ratios import as_double, safe_ratio
from marketlens.functions.timeline import Spine, dated_sums
from marketlens.session import materialize
from marketlens.sources.marketplace import Marketplace

LIFETIME = H.make(("all", None))
TS = "order_purchase_timestamp"
DEC = "decimal(38,0)"
KEY = [REF, "seller_id"]
UNKNOWN_REGION = "Não identificado"

# State -> region, and state capitals (upper case, no accents).
REGION_STATES = {
    "Norte": ("AM", "RR", "AP", "PA", "TO", "RO", "AC"),
    "Nordeste": ("MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"),
    "Centro-Oeste": ("MT", "MS", "GO", "DF"),
    "Sudeste": ("SP", "RJ", "MG", "ES"),
    "Sul": ("PR", "SC", "RS"),
}
CAPITALS = (
    "RIO BRANCO", "MACEIO", "MACAPA", "MANAUS", "SALVADOR", "FORTALEZA", "BRASILIA", "VITORIA", "GOIANIA",
    "SAO LUIS", "CUIABA", "CAMPO GRANDE", "BELO HORIZONTE", "BELEM", "JOAO PESSOA", "CURITIBA", "RECIFE",
    "TERESINA", "RIO DE JANEIRO", "NATAL", "PORTO ALEGRE", "PORTO VELHO", "BOA VISTA", "FLORIANOPOLIS",
    "SAO PAULO", "ARACAJU", "PALMAS",
)


def region_of(state: Column) -> Column:
    """F46 default rule: state code -> region name."""
    expr = F.lit(UNKNOWN_REGION)
    for region, states in reversed(list(REGION_STATES.items())):
        expr = F.when(state.isin(*states), F.lit(region)).otherwise(expr)
    return expr


def capital_flag(city: Column) -> Column:
    """F47 default rule: 1 when the upper-cased city is a state capital."""
    return F.when(F.upper(city).isin(*CAPITALS), 1).otherwise(0)


def seller_order_revenue(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """total revenue per (seller, order) before the last reference date, in whole units."""
    o = mk.orders.select("order_id", "customer_id", TS).where(F.col(TS) < F.lit(snapshot_dates(refs)[-1]))
    (price, freight), _ = whole_units_at(mk.items, ["price", "freight_value"])
    i = mk.items.select("order_id", "seller_id", (price + freight).alias("revenue"))
    return o.join(i, "order_id").groupBy("seller_id", "order_id", "customer_id", TS).agg(F.sum("revenue").alias("revenue"))


def revenue_scale(mk: Marketplace) -> int:
    """Scale of the whole units revenue is summed in."""
    return whole_units_at(mk.items, ["price", "freight_value"])[1]


def seller_attributes(sellers: DataFrame) -> DataFrame:
    """Seller place, region and capital flag (F46, F47).  Optional columns override the rules."""
    cols = set(sellers.columns)
    first = F.min(F.struct("seller_state", "seller_city", "seller_zip_code_prefix",
                           *[c for c in ("seller_region", "seller_is_capital") if c in cols]))
    sellers = sellers.groupBy("seller_id").agg(first.alias("p")).select("seller_id", "p.*")
    region = F.col("seller_region") if "seller_region" in cols else region_of(F.col("seller_state"))
    capital = F.col("seller_is_capital") if "seller_is_capital" in cols else capital_flag(F.col("seller_city"))
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
                          region.alias("regiao_seller"), capital.cast("int").alias("flag_seller_capital"))


def seller_orders(mk: Marketplace, refs: DateLike | list[DateLike]) -> DataFrame:
    """Every (seller, order) before the last reference date with its day, places, revenue and distance in whole km.

    Customers and sellers are one row per id: of repeated ids the smallest (state, city, zip) counts, so an
    order is one row per seller and order counts are counts of distinct orders.  The seller dimension can be
    broadcast, so a seller holding a third of all orders is never gathered into one join partition.
    """
    geo = zip_centroids(mk.geolocation)
    gs, gc = (geo.select(F.col("geolocation_zip_code_prefix").alias(f"{x}_zip"), F.col("latitude").alias(f"{x}_lat"),
                         F.col("longitude").alias(f"{x}_lng")) for x in "sc")
    place = F.struct("customer_state", "customer_city", "customer_zip_code_prefix")
    cust = mk.customers.groupBy(F.col("customer_id").alias("c_id")).agg(F.min(place).alias("p")).select(
        "c_id", "p.customer_zip_code_prefix", "p.customer_city", "p.customer_state")
    joined = (
        seller_order_revenue(mk, refs).join(seller_attributes(mk.sellers), "seller_id")
        .join(cust, F.col("customer_id") == F.col("c_id"), "left")
        .join(gs, F.col("seller_zip_code_prefix") == F.col("s_zip"), "left")
        .join(gc, F.col("customer_zip_code_prefix") == F.col("c_zip"), "left")
    )
    coords = [F.col(c) for c in ("s_lat", "s_lng", "c_lat", "c_lng")]
    return joined.select("seller_id", "seller_city", "seller_state", "order_id", F.to_date(TS).alias("day"), "customer_city",
                         "customer_state", F.coalesce("revenue", F.lit(0)).alias("revenue"), haversine_km(*coords).alias("km"),
                         F.lit(1).alias("orders"))


def place_orders(orders: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """(dtRef, kind, state, city, orders, revenue): distinct orders of each place and, for the market, their revenue.

    Kinds: ``state`` and ``city`` of the sellers (F54), ``market``, the customers' city (F53, F58).
    """
    place = lambda kind, state, city: F.struct(F.lit(kind).alias("kind"), state.alias("state"), city.alias("city"))
    c = F.col
    kinds = F.array(place("state", c("seller_state"), F.lit(None).cast("string")),
                    place("city", c("seller_state"), c("seller_city")), place("market", c("customer_state"), c("customer_city")))
    rows = orders.select("order_id", "day", "revenue", F.inline(kinds))
    once = rows.groupBy("kind", "state", "city", "order_id", "day").agg(F.sum("revenue").alias("revenue"))
    found = dated_sums(once.withColumn("orders", F.lit(1)), ["kind", "state", "city"], ["orders", "revenue"], LIFETIME, refs)
    return found.withColumnsRenamed({"orders_all": "orders", "revenue_all": "revenue"})


def distances(orders: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """F49, F50 from the (seller, km) histogram of every date; the median is an element of it."""
    hist = dated_sums(orders.where(F.col("km").isNotNull()), ["seller_id", "km"], ["orders"], LIFETIME, refs)
    n, km = F.col("orders_all"), F.col("km")
    line = Window.partitionBy(*KEY).orderBy("km")
    hist = hist.withColumns({"upto": F.sum(n).over(line), "all": F.sum(n).over(Window.partitionBy(*KEY))})
    between = lambda a, b: F.sum(F.when((km > a) & (km <= b), n).otherwise(0))
    return hist.groupBy(*KEY).agg(
        safe_ratio(F.sum(km * n), F.sum(n)).alias("media_distancia_km"),
        F.min(F.when(2 * F.col("upto") >= F.col("all"), km)).alias("mediana_distancia_km"),
        F.max(km).alias("max_distancia_km"), F.min(km).alias("min_distancia_km"),
        F.sum(F.when(km <= 100, n).otherwise(0)).alias("qtd_pedidos_curta_distancia"),
        between(100, 500).alias("qtd_pedidos_media_distancia"),
        F.sum(F.when(km > 500, n).otherwise(0)).alias("qtd_pedidos_longa_distancia"))


def destinations(orders: DataFrame, market: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """Totals, reach, local sales, main destinations and coverage of every seller with an order.

    ``market``: (dtRef, customer_state, d_mkt), the distinct orders of each
    customer state.  Cities are counted by the concatenated key 'state|city',
    as the source does (pairs that concatenate to the same text count once).
    """
    n, revenue = F.col("orders_all"), F.col("revenue_all")
    state, city = F.col("customer_state"), F.col("customer_city")
    same_state = state == F.col("seller_state")
    same_city = same_state & (city == F.col("seller_city"))
    key = ["seller_id", "seller_state", "seller_city", "customer_state", "customer_city"]
    cities = dated_sums(orders, key, ["orders", "revenue"], LIFETIME, refs)
    only = lambda c, x: F.sum(F.when(c, x).otherwise(0))
    states = cities.groupBy(*KEY, "customer_state").agg(
        F.sum(n).alias("n"), F.sum(revenue).alias("revenue"), only(same_state, n).alias("n_state"),
        only(same_city, n).alias("n_city"), only(same_state, revenue).alias("r_state"), only(same_city, revenue).alias("r_city"),
        F.min(F.struct((-n).alias("minus"), "customer_state", "customer_city")).alias("top"),
        F.collect_set(F.concat(state, F.lit("|"), city)).alias("cities"))
    # Market totals: a row a date (T with the NULL state, Dnn without).
    totals = F.broadcast(market.groupBy(REF).agg(F.sum("d_mkt").alias("t_all"),
                                                 F.sum(F.when(state.isNotNull(), F.col("d_mkt"))).alias("d_nonnull")))
    in_market = market.where(state.isNotNull())
    present = F.when(state.isNotNull(), F.col("n"))
    states = states.join(in_market, [REF, "customer_state"], "left").join(totals, REF)
    states = states.withColumn("n_seller", F.sum(present).over(Window.partitionBy(*KEY)))
    diff = F.when(state.isNotNull(), F.col("n").cast(DEC) * F.col("t_all").cast(DEC)
                  - F.col("d_mkt").cast(DEC) * F.col("n_seller").cast(DEC))
    return states.groupBy(*KEY).agg(
        F.sum("n").alias("qtd_pedidos_seller"), F.sum("revenue").alias("receita_total_seller"),
        F.sum("n_state").alias("qtd_pedidos_proprio_estado"), F.sum("n_city").alias("qtd_pedidos_propria_cidade"),
        F.sum("r_state").alias("receita_proprio_estado"), F.sum("r_city").alias("receita_propria_cidade"),
        F.count("customer_state").alias("qtd_ufs_atendidas"),
        F.size(F.array_distinct(F.flatten(F.collect_list("cities")))).cast("long").alias("qtd_cidades_atendidas"),
        F.min(F.struct((-F.col("n")).alias("minus"), "customer_state")).alias("top_state"), F.min("top").alias("top_city"),
        F.first("n_seller").alias("n_seller"), F.sum(F.abs(diff)).alias("abs_num"),
        F.sum(F.greatest(diff, F.lit(0).cast(DEC))).alias("pos_num"), F.sum("d_mkt").alias("d_present"))


def coverage_columns() -> list[Column]:
    """positive gap sum, absolute gap sum, coverage score (exact rational form)."""
    total, nonnull = F.col("t_all"), F.col("d_nonnull")
    n_dec = F.col("n_seller").cast(DEC)
    served = F.col("n_seller") > 0
    abs_gap = F.when(served, as_double(F.col("abs_num") + (nonnull - F.col("d_present")).cast(DEC) * n_dec)
                     / as_double(n_dec * total.cast(DEC))).otherwise(as_double(nonnull) / as_double(total))
    pos_gap = F.when(served, as_double(F.col("pos_num")) / as_double(n_dec * total.cast(DEC))).otherwise(F.lit(0.0))
    any_state = F.coalesce(nonnull, F.lit(0)) > 0
    return [F.when(any_state, pos_gap).otherwise(0.0).alias("soma_gap_estado_positivo"),
            F.when(any_state, abs_gap).otherwise(0.0).alias("soma_abs_gap_estado"),
            F.when(any_state, 1 - abs_gap / 2).otherwise(0.0).alias("score_cobertura_estado")]


def rank_within(summary: DataFrame, part: list[str], out: str) -> DataFrame:
    """(part, orders, RANK() of that number of orders in its place, mean orders of the place's sellers), via a histogram.

    RANK's window partitions NULL places together; so does this one.
    """
    part = [REF, *part]
    n = F.col("qtd_pedidos_seller")
    hist = summary.groupBy(*part, n).agg(F.count(F.lit(1)).alias("k"))
    line = Window.partitionBy(*part)
    above = line.orderBy(n.desc()).rowsBetween(Window.unboundedPreceding, -1)
    return hist.select(*[F.col(c).alias(f"__{c}") for c in (*part, "qtd_pedidos_seller")],
                       (F.coalesce(F.sum("k").over(above), F.lit(0)) + 1).cast("int").alias(f"rank_seller_pedidos_{out[0]}"),
                       safe_ratio(F.sum(n * F.col("k")).over(line), F.sum("k").over(line)).alias(f"media_pedidos_sellers_{out[1]}"))


FAMILIES = {
    "seller_region_capital": ["regiao_seller", "flag_seller_capital"],
    "place_volume": ["volume_total_pedidos_estado_seller", "volume_total_pedidos_cidade_seller"],
    "seller_reach": ["qtd_pedidos_seller", "receita_total_seller", "qtd_ufs_atendidas", "qtd_cidades_atendidas"],
    "local_sales": ["qtd_pedidos_proprio_estado", "qtd_pedidos_propria_cidade", "pct_pedidos_proprio_estado",
                    "pct_pedidos_propria_cidade", "receita_proprio_estado", "receita_propria_cidade"],
    "local_market_share": ["participacao_pedidos_seller_proprio_estado", "participacao_pedidos_seller_propria_cidade",
                           "participacao_receita_proprio_estado", "participacao_receita_propria_cidade"],
    "place_rank": ["rank_seller_pedidos_estado", "rank_seller_pedidos_cidade"],
    "main_destination": ["estado_maior_qtd_pedidos_seller", "cidade_maior_qtd_pedidos_seller",
                         "principal_cidade_pedidos_seller", "principal_estado_pedidos_seller",
                         "qtd_pedidos_principal_estado", "qtd_pedidos_principal_cidade",
                         "pct_pedidos_principal_estado_destino", "pct_pedidos_principal_cidade_destino"],
    "distance_profile": ["media_distancia_km", "mediana_distancia_km", "max_distancia_km", "min_distancia_km",
                         "qtd_pedidos_curta_distancia", "qtd_pedidos_media_distancia",
                         "qtd_pedidos_longa_distancia", "pct_pedidos_curta_distancia",
                         "pct_pedidos_media_distancia", "pct_pedidos_longa_distancia"],
    "peer_comparison": ["media_pedidos_sellers_mesmo_estado", "media_pedidos_sellers_mesma_cidade",
                        "dif_pedidos_vs_media_estado", "dif_pedidos_vs_media_cidade",
                        "razao_pedidos_vs_media_estado", "razao_pedidos_vs_media_cidade"],
    "state_coverage_gap": ["soma_gap_estado_positivo", "soma_abs_gap_estado", "score_cobertura_estado"],
}

SNAPSHOT_COLS = [
    "seller_id", "seller_city", "seller_state", "regiao_seller", "flag_seller_capital",
    "volume_total_pedidos_estado_seller", "volume_total_pedidos_cidade_seller", "qtd_pedidos_seller",
    "receita_total_seller", "qtd_ufs_atendidas", "qtd_cidades_atendidas", "qtd_pedidos_proprio_estado",
    "qtd_pedidos_propria_cidade", "pct_pedidos_proprio_estado", "pct_pedidos_propria_cidade",
    "participacao_pedidos_seller_proprio_estado", "participacao_pedidos_seller_propria_cidade",
    "rank_seller_pedidos_estado", "rank_seller_pedidos_cidade", "receita_proprio_estado", "receita_propria_cidade",
    "participacao_receita_proprio_estado", "participacao_receita_propria_cidade", "estado_maior_qtd_pedidos_seller",
    "cidade_maior_qtd_pedidos_seller", "principal_cidade_pedidos_seller", "principal_estado_pedidos_seller",
    "qtd_pedidos_principal_estado", "qtd_pedidos_principal_cidade", "pct_pedidos_principal_estado_destino",
    "pct_pedidos_principal_cidade_destino", "media_distancia_km", "mediana_distancia_km", "max_distancia_km",
    "min_distancia_km", "qtd_pedidos_curta_distancia", "qtd_pedidos_media_distancia", "qtd_pedidos_longa_distancia",
    "pct_pedidos_curta_distancia", "pct_pedidos_media_distancia", "pct_pedidos_longa_distancia",
    "media_pedidos_sellers_mesmo_estado", "media_pedidos_sellers_mesma_cidade", "dif_pedidos_vs_media_estado",
    "dif_pedidos_vs_media_cidade", "razao_pedidos_vs_media_estado", "razao_pedidos_vs_media_cidade",
    "soma_gap_estado_positivo", "soma_abs_gap_estado", "score_cobertura_estado", "flag_seller_sem_pedido",
]


def seller_rows(mk: Marketplace, orders: DataFrame, places: DataFrame, refs: DateLike | list[DateLike]) -> DataFrame:
    """Every seller at every reference date with what is its own; idle ones have no order."""
    market = places.where("kind = 'market'").groupBy(REF, F.col("state").alias("customer_state")).agg(
        F.sum("orders").alias("d_mkt"))
    spine = Spine.of(refs)
    sellers = seller_attributes(mk.sellers).drop("seller_zip_code_prefix").withColumn(REF, F.explode(spine.all()))
    found = (sellers.join(destinations(orders, market, refs), KEY, "left").join(distances(orders, refs), KEY, "left"))
    zero = [c for c in found.columns if c.startswith(("qtd_", "receita_"))]
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})


def geo_snapshot(mk: Marketplace, refs: DateLike | list[DateLike], with_ref: bool = False) -> DataFrame:
    """All 50 location features plus seller_id, for every seller (idle ones included).

    Written on the way: the (seller, order) table, the orders by place and the
    sellers' own numbers (:func:`marketlens.session.materialize`).
    """
    orders = materialize(seller_orders(mk, refs), "geo_orders")
    places = materialize(place_orders(orders, refs), "geo_places")
    s = materialize(seller_rows(mk, orders, places, refs), "geo_sellers")

    def placed(kind: str, keys: list[str], **cols: Column) -> DataFrame:
        rows = places.where(F.col("kind") == kind).withColumnsRenamed({"state": "seller_state", "city": "seller_city"})
        return rows.groupBy(REF, *keys).agg(*[c.alias(n) for n, c in cols.items()])

    n, revenue = F.sum("orders"), F.sum("revenue")
    by_state, by_city = ["seller_state"], ["seller_state", "seller_city"]
    totals = places.where("kind = 'market'").groupBy(REF).agg(
        n.alias("t_all"), F.sum(F.when(F.col("state").isNotNull(), F.col("orders"))).alias("d_nonnull"))
    j = s
    for keys, part in (
            (by_state, placed("state", by_state, volume_total_pedidos_estado_seller=n)),
            (by_city, placed("city", by_city, volume_total_pedidos_cidade_seller=n)),
            (by_state, placed("market", by_state, mkt_orders_state=n, mkt_revenue_state=revenue)),
            (by_city, placed("market", by_city, mkt_orders_city=n, mkt_revenue_city=revenue))):
        j = j.join(part, [REF, *keys], "left")
    j = j.join(F.broadcast(totals), REF, "left")
    for keys, out in ((by_state, ("estado", "mesmo_estado")), (by_city, ("cidade", "mesma_cidade"))):
        ranks = rank_within(s, keys, out)
        on = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (REF, *keys, "qtd_pedidos_seller")]
        j = j.join(ranks, on, "left").drop(*[f"__{c}" for c in (REF, *keys, "qtd_pedidos_seller")])
    # A place without a state (or city) has no peers to compare with.
    alone = F.col("seller_state").isNull()
    j = j.withColumns({
        "media_pedidos_sellers_mesmo_estado": F.when(~alone, F.col("media_pedidos_sellers_mesmo_estado")),
        "media_pedidos_sellers_mesma_cidade": F.when(~alone & F.col("seller_city").isNotNull(), F.col("media_pedidos_sellers_mesma_cidade"))})
    top = lambda c, f: F.col(c).getField(f)
    j = j.select("*", *coverage_columns(), top("top_state", "customer_state").alias("principal_estado_pedidos_seller"),
                 (-top("top_state", "minus")).alias("qtd_pedidos_principal_estado"),
                 top("top_city", "customer_city").alias("principal_cidade_pedidos_seller"),
                 (-top("top_city", "minus")).alias("qtd_pedidos_principal_cidade"))

    c = F.col
    qtd = c("qtd_pedidos_seller")
    scale = revenue_scale(mk)

    def money(name: str) -> Column:
        return to_double(c(name), scale)

    def per_order(x: Column) -> Column:
        return F.when(qtd == 0, F.lit(0.0)).otherwise(as_double(x) / as_double(qtd))

    def share_of(x: Column, whole: Column) -> Column:
        return F.when(whole.isNull() | (whole == 0), F.lit(0.0)).otherwise(as_double(x) / as_double(whole))

    def ratio_to_mean(mean_col: Column) -> Column:
        return F.when(mean_col == 0, F.lit(None).cast("double")).otherwise(as_double(qtd) / mean_col)

    cols = {
        "seller_id": c("seller_id"), "seller_city": c("seller_city"), "seller_state": c("seller_state"),
        "regiao_seller": c("regiao_seller"), "flag_seller_capital": c("flag_seller_capital"),
        "volume_total_pedidos_estado_seller": F.coalesce(c("volume_total_pedidos_estado_seller"), F.lit(0)),
        "volume_total_pedidos_cidade_seller": F.coalesce(c("volume_total_pedidos_cidade_seller"), F.lit(0)),
        "qtd_pedidos_seller": qtd,
        "receita_total_seller": to_double(F.coalesce(c("receita_total_seller"), F.lit(0)), scale),
        "qtd_ufs_atendidas": F.coalesce(c("qtd_ufs_atendidas"), F.lit(0)),
        "qtd_cidades_atendidas": F.coalesce(c("qtd_cidades_atendidas"), F.lit(0)),
        "qtd_pedidos_proprio_estado": c("qtd_pedidos_proprio_estado"),
        "qtd_pedidos_propria_cidade": c("qtd_pedidos_propria_cidade"),
        "pct_pedidos_proprio_estado": per_order(c("qtd_pedidos_proprio_estado")),
        "pct_pedidos_propria_cidade": per_order(c("qtd_pedidos_propria_cidade")),
        "participacao_pedidos_seller_proprio_estado": share_of(c("qtd_pedidos_proprio_estado"), c("mkt_orders_state")),
        "participacao_pedidos_seller_propria_cidade": share_of(c("qtd_pedidos_propria_cidade"), c("mkt_orders_city")),
        "rank_seller_pedidos_estado": c("rank_seller_pedidos_estado"),
        "rank_seller_pedidos_cidade": c("rank_seller_pedidos_cidade"),
        "receita_proprio_estado": to_double(F.coalesce(c("receita_proprio_estado"), F.lit(0)), scale),
        "receita_propria_cidade": to_double(F.coalesce(c("receita_propria_cidade"), F.lit(0)), scale),
        "participacao_receita_proprio_estado": share_of(money("receita_proprio_estado"), money("mkt_revenue_state")),
        "participacao_receita_propria_cidade": share_of(money("receita_propria_cidade"), money("mkt_revenue_city")),
        "estado_maior_qtd_pedidos_seller": c("principal_estado_pedidos_seller"),
        "cidade_maior_qtd_pedidos_seller": c("principal_cidade_pedidos_seller"),
        "principal_cidade_pedidos_seller": c("principal_cidade_pedidos_seller"),
        "principal_estado_pedidos_seller": c("principal_estado_pedidos_seller"),
        "qtd_pedidos_principal_estado": F.coalesce(c("qtd_pedidos_principal_estado"), F.lit(0)),
        "qtd_pedidos_principal_cidade": F.coalesce(c("qtd_pedidos_principal_cidade"), F.lit(0)),
        "pct_pedidos_principal_estado_destino": per_order(c("qtd_pedidos_principal_estado")),
        "pct_pedidos_principal_cidade_destino": per_order(c("qtd_pedidos_principal_cidade")),
        "media_distancia_km": c("media_distancia_km"),
        "mediana_distancia_km": c("mediana_distancia_km"),
        "max_distancia_km": c("max_distancia_km"),
        "min_distancia_km": c("min_distancia_km"),
        "qtd_pedidos_curta_distancia": c("qtd_pedidos_curta_distancia"),
        "qtd_pedidos_media_distancia": c("qtd_pedidos_media_distancia"),
        "qtd_pedidos_longa_distancia": c("qtd_pedidos_longa_distancia"),
        "pct_pedidos_curta_distancia": per_order(c("qtd_pedidos_curta_distancia")),
        "pct_pedidos_media_distancia": per_order(c("qtd_pedidos_media_distancia")),
        "pct_pedidos_longa_distancia": per_order(c("qtd_pedidos_longa_distancia")),
        "media_pedidos_sellers_mesmo_estado": c("media_pedidos_sellers_mesmo_estado"),
        "media_pedidos_sellers_mesma_cidade": c("media_pedidos_sellers_mesma_cidade"),
        "dif_pedidos_vs_media_estado": qtd - c("media_pedidos_sellers_mesmo_estado"),
        "dif_pedidos_vs_media_cidade": qtd - c("media_pedidos_sellers_mesma_cidade"),
        "razao_pedidos_vs_media_estado": ratio_to_mean(c("media_pedidos_sellers_mesmo_estado")),
        "razao_pedidos_vs_media_cidade": ratio_to_mean(c("media_pedidos_sellers_mesma_cidade")),
        "soma_gap_estado_positivo": F.coalesce(c("soma_gap_estado_positivo"), F.lit(0.0)),
        "soma_abs_gap_estado": F.coalesce(c("soma_abs_gap_estado"), F.lit(0.0)),
        "score_cobertura_estado": F.coalesce(c("score_cobertura_estado"), F.lit(0.0)),
        "flag_seller_sem_pedido": F.when(qtd == 0, 1).otherwise(0),
    }
    out = j.select(REF, *[cols[name].alias(name) for name in SNAPSHOT_COLS])
    return keep_ref(out, refs, with_ref)


def geo_features(mk: Marketplace, ref: DateLike, family: str) -> DataFrame:
    return geo_snapshot(mk, ref).select("seller_id", *FAMILIES[family])


def order_distance(mk: Marketplace, ref: DateLike) -> DataFrame:
    """distance in whole km per (seller, order); NULL order rows are idle sellers."""
    orders = seller_orders(mk, ref).select("seller_id", "order_id", F.col("km").alias("distancia_km"))
    ids = seller_attributes(mk.sellers).select("seller_id")
    return ids.join(orders, "seller_id", "left")


__all__ = ["geo_snapshot", "geo_features", "order_distance", "zip_centroids"]
