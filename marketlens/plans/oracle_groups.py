"""DuckDB oracles for delivery, reputation, customers, payments and location.

Written in the plain relational style (range joins, COUNT DISTINCT, LAG,
dense aggregates) so they check the Spark rewrites independently.  Shared
numeric conventions are in :mod:`marketlens.plans.sqlkit`.
"""

from __future__ import annotations

from marketlens.plans.sqlkit import d, dbl, div, moments_stddev, rnd, since


def dminus(ref, days: int) -> str:
    return f"CAST({d(ref)} - INTERVAL {days} DAY AS DATE)"


def ddiff(end: str, start: str) -> str:
    return f"date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE))"


# --------------------------------------------------------------------------- delivery
DL_H = [("vida", None), ("28d", 28), ("56d", 56), ("365d", 365)]


def delivery(ref) -> tuple[str, dict[str, str]]:
    def w(days, val):
        return val if days is None else f"CASE WHEN {since(ref, days)} THEN {val} END"

    late = "dd > 0"
    fam = {
        "freight_ratio": [f"COALESCE({div(f'SUM({w(x, "fr")})', f'SUM({w(x, "pr")})')} * 100, 0.0)"
                          f" AS pct_frete_ped_{n}" for n, x in DL_H],
        "freight_avg": [f"COALESCE({div(f'SUM({w(x, "fr")})', f'COUNT({w(x, "fr")})')}, 0.0)"
                        f" AS avg_frete_{n}" for n, x in DL_H],
        "delivery_times": [
            f"COALESCE({div(f'SUM({ddiff(e, s)})', f'COUNT({ddiff(e, s)})')}, 0.0) AS {name}"
            for name, e, s in (("avg_sla_entrega", "est", "appr"), ("avg_entrega", "deliv", "appr"),
                               ("avg_transp_ped", "deliv", "carr"))],
        "early_late_orders": (
            [f"COUNT(CASE WHEN {late} THEN 1 END) AS n_ped_atrasados"]
            + [f"COALESCE({div(f'COUNT({w(x, f'CASE WHEN {late} THEN 1 END')})', f'COUNT({w(x, 1)})')} * 100, 0.0)"
               f" AS pct_ped_atrasados_{n}" for n, x in DL_H]
            + [f"COALESCE({div(f'SUM({w(x, f'CASE WHEN {late} THEN dd END')})', f'COUNT({w(x, f'CASE WHEN {late} THEN dd END')})')}"
               f", 0.0) AS avg_entrega_ped_atrasados_{n}" for n, x in DL_H]),
        "delivery_diff_percentiles": [f"quantile_cont(dd, {p}) AS diff_entrega_ped_{int(p * 100)}p"
                                      for p in (0.25, 0.5, 0.75)],
        "seller_dispatch_times": [
            f"COALESCE({div(f'SUM({ddiff(e, s)})', f'COUNT({ddiff(e, s)})')}, 0.0) AS {name}"
            for name, e, s in (("avg_tempo_limite_vendedor", "lim", "appr"),
                               ("avg_tempo_atraso_vendedor", "carr", "lim"),
                               ("avg_tempo_transportadora", "deliv", "carr"))],
        "delivery_consistency": [
            f"COALESCE({div(moments_stddev('COUNT(dd)', 'SUM(dd)', 'SUM(dd * dd)'), div('SUM(dd)', 'COUNT(dd)'))}, 0.0)"
            " AS consistencia"],
    }
    ctes = f"""
dl_base AS (
  SELECT i.seller_id, o.order_purchase_timestamp AS ts, i.price AS pr, i.freight_value AS fr,
         o.order_approved_at AS appr, o.order_delivered_carrier_date AS carr,
         o.order_delivered_customer_date AS deliv, o.order_estimated_delivery_date AS est,
         i.shipping_limit_date AS lim,
         {ddiff('o.order_estimated_delivery_date', 'o.order_delivered_customer_date')} AS dd
  FROM mk_orders o JOIN mk_items i ON i.order_id = o.order_id
  WHERE o.order_purchase_timestamp <= {d(ref)}
)"""
    sel = {k: f"SELECT seller_id, {', '.join(v)} FROM dl_base GROUP BY seller_id" for k, v in fam.items()}
    order = ["freight_ratio", "freight_avg", "delivery_times", "early_late_orders", "delivery_diff_percentiles",
             "seller_dispatch_times", "delivery_consistency"]
    sel["delivery_snapshot"] = (f"SELECT seller_id, {', '.join(c for k in order for c in fam[k])} "
                                "FROM dl_base GROUP BY seller_id")
    return ctes, sel


# --------------------------------------------------------------------------- reputation
RP_W = [28, 56, 365]


def reputation(ref) -> tuple[str, dict[str, str]]:
    def inw(days):
        return since(ref, days)

    counts = [f"COUNT(DISTINCT CASE WHEN CAST(rdt AS DATE) BETWEEN {dminus(ref, x)} AND {d(ref)} THEN order_id END)"
              f" AS reviews{x}d" for x in RP_W] + ["COUNT(DISTINCT order_id) AS reviewsLifetime"]
    coverage = [rnd(div(f"100 * COUNT(DISTINCT CASE WHEN {inw(x)} AND r_oid IS NOT NULL THEN order_id END)",
                        f"COUNT(DISTINCT CASE WHEN {inw(x)} THEN order_id END)"), 2) + f" AS percentual{x}d"
                for x in RP_W]
    coverage.append(rnd(div("100 * COUNT(DISTINCT CASE WHEN r_oid IS NOT NULL THEN order_id END)",
                            "COUNT(DISTINCT order_id)"), 2) + " AS percentualLifetime")

    def sc(days):
        return "sc" if days is None else f"CASE WHEN {inw(days)} THEN sc END"

    stats = [rnd(div(f"SUM({sc(None)})", f"COUNT({sc(None)})"), 2) + " AS mediaAvaliacoesLifetime"]
    stats += [rnd(div(f"SUM({sc(x)})", f"COUNT({sc(x)})"), 2) + f" AS mediaAvaliacoesD{x}" for x in RP_W]
    stats.append(rnd(moments_stddev("COUNT(sc)", "SUM(sc)", "SUM(sc * sc)"), 2) + " AS desvpadAvaliacoesLifetime")
    stats += [rnd(moments_stddev(f"COUNT({sc(x)})", f"SUM({sc(x)})", f"SUM({sc(x)} * {sc(x)})"), 2)
              + f" AS desvpadAvaliacoesD{x}" for x in RP_W]
    notes = []
    for k in (1, 2):
        notes.append(rnd(f"AVG(CASE WHEN sc = {k} THEN 1 ELSE 0 END)", 2) + f" AS pctNota{k}")
        notes += [rnd(f"AVG(CASE WHEN {inw(x)} AND sc = {k} THEN 1 ELSE 0 END)", 2) + f" AS pctNota{k}D{x}"
                  for x in RP_W]
    for k in (3, 4, 5):
        for x in RP_W:
            name = "perc_nota_3_d56" if (k == 3 and x == 56) else f"percNota{k}D{x}"
            notes.append(f"AVG(CASE WHEN {inw(x)} AND sc = {k} THEN 1 WHEN {inw(x)} THEN 0 END) AS {name}")
        notes.append(f"AVG(CASE WHEN sc = {k} THEN 1 ELSE 0 END) AS percNota{k}Lifetime")
    good_bad = []
    for stem, ks in (("pctNotasBoas", "4, 5"), ("pctNotasRuins", "1, 2")):
        good_bad += [div(f"SUM(CASE WHEN {inw(x)} AND sc IN ({ks}) THEN 1 ELSE 0 END)",
                         f"SUM(CASE WHEN {inw(x)} THEN 1 ELSE 0 END)") + f" AS {stem}D{x}" for x in RP_W]
        good_bad.append(div(f"SUM(CASE WHEN sc IN ({ks}) THEN 1 ELSE 0 END)", "COUNT(i_oid)") + f" AS {stem}Lifetime")
    fam = {"review_counts": counts, "review_coverage": coverage, "review_score_stats": stats,
           "review_note_shares": notes, "good_bad_reviews": good_bad}
    ctes = f"""
rp_rows AS (
  SELECT o.order_id, o.order_purchase_timestamp AS ts, r.order_id AS r_oid, r.review_score AS sc,
         r.review_creation_date AS rdt, i.order_id AS i_oid, i.seller_id
  FROM mk_orders o LEFT JOIN mk_reviews r ON r.order_id = o.order_id LEFT JOIN mk_items i ON i.order_id = o.order_id
  WHERE o.order_purchase_timestamp < {d(ref)}
)"""
    head = f"{d(ref)} AS dtRef, seller_id"
    sel = {k: f"SELECT {head}, {', '.join(v)} FROM rp_rows GROUP BY seller_id" for k, v in fam.items()}
    allc = [c for k in ("review_counts", "review_coverage", "review_score_stats", "review_note_shares",
                        "good_bad_reviews") for c in fam[k]]
    sel["reputation_snapshot"] = (f"SELECT {d(ref)} AS dtRef, seller_id AS idSeller, {', '.join(allc)} "
                                  "FROM rp_rows GROUP BY seller_id")
    return ctes, sel


# --------------------------------------------------------------------------- customers
CU_P = [("28d", 28), ("56d", 56), ("365d", 365), ("full", None)]


def customers(ref) -> tuple[str, dict[str, str]]:
    periods = " UNION ALL ".join(
        f"SELECT '{n}' AS periodo, {dminus(ref, x) if x else "DATE '1900-01-01'"} AS lo, "
        f"{dminus(ref, 2 * x) if x else "DATE '1900-01-01'"} AS prev_lo" for n, x in CU_P)
    ctes = f"""
cu_os AS (
  SELECT DISTINCT i.seller_id, o.order_id, c.customer_unique_id AS cu, o.order_purchase_timestamp AS ts
  FROM mk_orders o JOIN mk_items i ON i.order_id = o.order_id JOIN mk_customers c ON c.customer_id = o.customer_id
  WHERE o.order_purchase_timestamp < {d(ref)}
),
cu_periods AS ({periods}),
cu_per AS (SELECT s.seller_id, p.* FROM (SELECT DISTINCT seller_id FROM cu_os) s, cu_periods p),
cu_cli AS (
  SELECT p.periodo, p.seller_id, o.cu, COUNT(DISTINCT o.order_id) AS k
  FROM cu_per p JOIN cu_os o ON o.seller_id = p.seller_id AND o.ts >= p.lo GROUP BY ALL
),
cu_m AS (
  SELECT periodo, seller_id, COUNT(*) AS qtd, SUM(k) AS tot, COUNT(CASE WHEN k >= 2 THEN 1 END) AS rep,
         SUM(CAST(k AS HUGEINT) * k) AS sq
  FROM cu_cli GROUP BY ALL
),
cu_lag AS (SELECT seller_id, cu, ts, LAG(ts) OVER (PARTITION BY seller_id, cu ORDER BY ts) AS prev_ts FROM cu_os),
cu_t AS (
  SELECT p.periodo, p.seller_id, AVG({ddiff('l.ts', 'l.prev_ts')}) AS tm
  FROM cu_per p JOIN cu_lag l ON l.seller_id = p.seller_id AND l.ts >= p.lo AND l.prev_ts IS NOT NULL GROUP BY ALL
),
cu_prev AS (
  SELECT p.periodo, p.seller_id, COUNT(DISTINCT o.cu) AS prev
  FROM cu_per p JOIN cu_os o ON o.seller_id = p.seller_id AND o.ts < p.lo AND o.ts >= p.prev_lo
  WHERE p.periodo <> 'full' GROUP BY ALL
),
cu_first AS (SELECT seller_id, cu, MIN(ts) AS f FROM cu_os GROUP BY ALL),
cu_new AS (
  SELECT p.periodo, p.seller_id, MAX(f.f) AS lastnew
  FROM cu_per p JOIN cu_first f ON f.seller_id = p.seller_id AND f.f >= p.lo GROUP BY ALL
),
cu_all AS (
  SELECT m.*, t.tm, pr.prev, n.lastnew FROM cu_m m
  LEFT JOIN cu_t t USING (periodo, seller_id) LEFT JOIN cu_prev pr USING (periodo, seller_id)
  LEFT JOIN cu_new n USING (periodo, seller_id)
)"""
    cols: dict[str, list[tuple[str, str]]] = {k: [] for k in ("repeat", "hhi", "interval", "churn", "new")}
    order = []
    for n, x in CU_P:
        def pick(expr, zero="0.0", n=n):
            return f"COALESCE(MAX(CASE WHEN periodo = '{n}' THEN {expr} END), {zero})"

        items = [
            ("repeat", f"CAST({pick('qtd', '0')} AS BIGINT) AS vl_qtd_clientes_distintos_{n}"),
            ("repeat", f"{pick(rnd(div('rep', 'qtd'), 4))} AS pct_taxa_recompra_periodo_{n}"),
            ("repeat", f"{pick(rnd(div('tot', 'qtd'), 4))} AS vl_avg_pedidos_por_cliente_{n}"),
            ("hhi", f"{pick(rnd(div('sq', 'CAST(tot AS HUGEINT) * tot'), 6))} AS pct_concentracao_ihh_{n}"),
            ("interval", f"{pick(rnd('tm', 2))} AS vl_tempo_medio_recompra_{n}"),
        ]
        if x is not None:
            items.append(("churn", f"{pick(rnd(div('GREATEST(prev - qtd, 0)', 'prev'), 4))} AS pct_churn_clientes_{n}"))
        items.append(("new", f"CAST({pick(ddiff(d(ref), 'lastnew'), '0')} AS INTEGER) "
                             f"AS vl_dias_desde_ultimo_cliente_novo_{n}"))
        for fam, c in items:
            cols[fam].append(c)
            order.append(c)
    head = f"seller_id, CAST(date_trunc('month', {d(ref)}) AS DATE) AS dtSafra"
    keymap = {"customer_repeat_rate": "repeat", "customer_hhi": "hhi", "repurchase_interval": "interval",
              "customer_churn": "churn", "days_since_new_customer": "new"}
    sel = {k: f"SELECT {head}, {', '.join(cols[f])} FROM cu_all GROUP BY seller_id" for k, f in keymap.items()}
    sel["customers_snapshot"] = f"SELECT {head}, {', '.join(order)} FROM cu_all GROUP BY seller_id"
    sel["customer_period_base"] = (
        f"SELECT seller_id, {d(ref)} AS safra_mes, periodo, {d(ref)} AS dt_inicio, lo AS dt_fim, "
        "prev_lo AS prev_dt_fim FROM cu_per")
    return ctes, sel


# --------------------------------------------------------------------------- payments
PM_M = ["credit_card", "boleto", "voucher", "debit_card", "outros"]
PM_W = [("d28", 28), ("d56", 56), ("d365", 365), ("vida", None)]


def payments(ref) -> tuple[str, dict[str, str]]:
    named = ", ".join(f"'{m}'" for m in PM_M[:4])
    roll = []
    for m in PM_M:
        cond = f"payment_type NOT IN ({named})" if m == "outros" else f"payment_type = '{m}'"
        roll.append(f"SUM(CASE WHEN {cond} THEN payment_value ELSE 0 END) AS vlr_{m}")
    for m in PM_M:
        cond = f"payment_type NOT IN ({named})" if m == "outros" else f"payment_type = '{m}'"
        roll.append(f"SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS qtde_{m}")
    roll.append("MAX(CASE WHEN payment_installments > 0 THEN payment_installments END) AS max_payment_installments")
    vt = " + ".join(f"b.vlr_{m}" for m in PM_M)
    qt = " + ".join(f"b.qtde_{m}" for m in PM_M)

    def w(days, val):
        return val if days is None else f"CASE WHEN b.ts >= g.m - INTERVAL {days} DAY THEN {val} END"

    fam = {
        "payment_avg_value": [f"{div(f'SUM({w(x, f'b.vlr_{m}')})', f'COUNT({w(x, f'b.vlr_{m}')})')} AS avg_vlr_{m}_{n}"
                              for n, x in PM_W for m in PM_M],
        "payment_installments": [
            f"{div(f'SUM({w(x, 'b.max_payment_installments')})', f'COUNT({w(x, 'b.max_payment_installments')})')}"
            f" AS avg_payment_installments_{n}" for n, x in PM_W],
        "payment_count_share": [f"{div(f'SUM({w(x, f'b.qtde_{m}')})', f'SUM({w(x, qt)})')} AS share_qtde_{m}_{n}"
                                for n, x in PM_W for m in PM_M],
        "payment_value_share": [f"{div(f'SUM({w(x, f'b.vlr_{m}')})', f'SUM({w(x, vt)})')} AS share_valor_{m}_{n}"
                                for n, x in PM_W for m in PM_M],
    }
    ctes = f"""
pm_roll AS (SELECT order_id, {', '.join(roll)} FROM mk_payments GROUP BY order_id),
pm_base AS (
  SELECT s.seller_id, o.order_purchase_timestamp AS ts, pg.* EXCLUDE (order_id)
  FROM mk_orders o JOIN (SELECT DISTINCT order_id, seller_id FROM mk_items) s ON s.order_id = o.order_id
  LEFT JOIN pm_roll pg ON pg.order_id = o.order_id
  WHERE o.order_purchase_timestamp < {d(ref)}
),
pm_grid AS (SELECT DISTINCT seller_id, CAST(date_trunc('month', ts) AS DATE) AS m FROM pm_base)"""
    tail = ("FROM pm_grid g LEFT JOIN pm_base b ON b.seller_id = g.seller_id AND b.ts < g.m "
            "GROUP BY g.seller_id, g.m")
    head = "g.seller_id AS seller_id, strftime(g.m, '%Y%m') AS ref_month"
    sel = {k: f"SELECT {head}, {', '.join(v)} {tail}" for k, v in fam.items()}
    sel["payments_snapshot"] = f"SELECT {head}, {', '.join(c for v in fam.values() for c in v)} {tail}"
    sel["order_payment_rollup"] = "SELECT * FROM pm_roll"
    sel["seller_month_grid"] = "SELECT seller_id, m AS month, strftime(m, '%Y%m') AS ref_month FROM pm_grid"
    return ctes, sel


# --------------------------------------------------------------------------- location
def geo(ref) -> tuple[str, dict[str, str]]:
    hav = ("6371 * 2 * ASIN(SQRT(POWER(SIN(RADIANS(gc.lat - gs.lat) / 2), 2) + COS(RADIANS(gs.lat)) * "
           "COS(RADIANS(gc.lat)) * POWER(SIN(RADIANS(gc.lng - gs.lng) / 2), 2)))")
    ctes = f"""
ge_so AS (
  SELECT i.seller_id, o.order_id, o.customer_id, SUM(i.price + i.freight_value) AS receita_total
  FROM mk_orders o JOIN mk_items i ON i.order_id = o.order_id
  WHERE o.order_purchase_timestamp < {d(ref)} GROUP BY i.seller_id, o.order_id, o.customer_id
),
ge_geo AS (
  SELECT geolocation_zip_code_prefix AS zip, {dbl('SUM(geolocation_lat)')} / COUNT(geolocation_lat) AS lat,
         {dbl('SUM(geolocation_lng)')} / COUNT(geolocation_lng) AS lng
  FROM mk_geolocation GROUP BY geolocation_zip_code_prefix
),
ge_base AS (
  SELECT s.seller_id, s.seller_city, s.seller_state, s.seller_region AS regiao_seller,
         s.seller_is_capital AS flag, so.order_id, c.customer_city, c.customer_state,
         COALESCE(so.receita_total, 0) AS receita_total,
         CASE WHEN so.order_id IS NOT NULL AND gs.lat IS NOT NULL AND gs.lng IS NOT NULL AND gc.lat IS NOT NULL
                   AND gc.lng IS NOT NULL THEN {rnd(hav, 0)} END AS dist
  FROM mk_sellers s LEFT JOIN ge_so so ON so.seller_id = s.seller_id
  LEFT JOIN mk_customers c ON c.customer_id = so.customer_id
  LEFT JOIN ge_geo gs ON gs.zip = s.seller_zip_code_prefix LEFT JOIN ge_geo gc ON gc.zip = c.customer_zip_code_prefix
),
ge_seller AS (
  SELECT seller_id, MAX(seller_city) AS seller_city, MAX(seller_state) AS seller_state,
         MAX(regiao_seller) AS regiao_seller, MAX(flag) AS flag_seller_capital,
         COUNT(DISTINCT order_id) AS qtd, SUM(receita_total) AS receita,
         COUNT(DISTINCT customer_state) AS ufs,
         COUNT(DISTINCT CASE WHEN customer_state IS NOT NULL THEN customer_state || '|' || customer_city END) AS cidades,
         COUNT(DISTINCT CASE WHEN customer_state = seller_state THEN order_id END) AS qpe,
         COUNT(DISTINCT CASE WHEN customer_state = seller_state AND customer_city = seller_city THEN order_id END) AS qpc,
         SUM(CASE WHEN customer_state = seller_state THEN receita_total ELSE 0 END) AS rpe,
         SUM(CASE WHEN customer_state = seller_state AND customer_city = seller_city THEN receita_total ELSE 0 END) AS rpc,
         {div('SUM(dist)', 'COUNT(dist)')} AS media, quantile_disc(dist, 0.5) AS mediana,
         MAX(dist) AS dmax, MIN(dist) AS dmin,
         COUNT(DISTINCT CASE WHEN dist <= 100 THEN order_id END) AS curta,
         COUNT(DISTINCT CASE WHEN dist > 100 AND dist <= 500 THEN order_id END) AS media_d,
         COUNT(DISTINCT CASE WHEN dist > 500 THEN order_id END) AS longa
  FROM ge_base GROUP BY seller_id
),
ge_at AS (  -- every order at each place that it touches
  SELECT order_id, receita_total, unnest([
    {{'kind': 'from_state', 'state': seller_state, 'city': NULL}}, {{'kind': 'from_city', 'state': seller_state, 'city': seller_city}},
    {{'kind': 'to_state', 'state': customer_state, 'city': NULL}}, {{'kind': 'to_city', 'state': customer_state, 'city': customer_city}}],
    recursive := true)
  FROM ge_base WHERE order_id IS NOT NULL
),
ge_place AS (SELECT kind, state, city, COUNT(DISTINCT order_id) AS n, SUM(receita_total) AS r FROM ge_at GROUP BY ALL),
ge_standing AS (  -- a seller among those of its state, and of its city
  SELECT seller_id, RANK() OVER (in_state ORDER BY qtd DESC) AS state_rank, RANK() OVER (in_city ORDER BY qtd DESC) AS city_rank,
         CASE WHEN seller_state IS NOT NULL THEN AVG(qtd) OVER in_state END AS state_mean,
         CASE WHEN seller_state IS NOT NULL AND seller_city IS NOT NULL THEN AVG(qtd) OVER in_city END AS city_mean
  FROM ge_seller WINDOW in_state AS (PARTITION BY seller_state), in_city AS (PARTITION BY seller_state, seller_city)
),
ge_dest AS (
  SELECT seller_id, customer_state, customer_city, GROUPING(customer_city) AS whole_state, COUNT(DISTINCT order_id) AS n
  FROM ge_base WHERE order_id IS NOT NULL
  GROUP BY GROUPING SETS ((seller_id, customer_state), (seller_id, customer_state, customer_city))
),
ge_main AS (
  SELECT * FROM ge_dest QUALIFY ROW_NUMBER() OVER (
    PARTITION BY seller_id, whole_state ORDER BY n DESC, customer_state NULLS FIRST, customer_city NULLS FIRST) = 1
),
ge_tot AS (SELECT SUM(n) AS t_all, SUM(n) FILTER (state IS NOT NULL) AS d_nonnull FROM ge_place WHERE kind = 'to_state'),
ge_grid AS (
  SELECT s.seller_id, m.state, m.n AS d_mkt, COALESCE(p.n, 0) AS n_st, t.t_all,
         SUM(COALESCE(p.n, 0)) OVER (PARTITION BY s.seller_id) AS n_seller
  FROM ge_seller s CROSS JOIN (SELECT * FROM ge_place WHERE kind = 'to_state' AND state IS NOT NULL) m CROSS JOIN ge_tot t
  LEFT JOIN ge_dest p ON p.seller_id = s.seller_id AND p.customer_state = m.state AND p.whole_state = 1
),
ge_cell AS (
  SELECT *, CASE WHEN n_seller > 0 THEN CAST(n_st AS HUGEINT) * t_all - CAST(d_mkt AS HUGEINT) * n_seller ELSE -d_mkt END AS gap,
         CASE WHEN n_seller > 0 THEN CAST(n_seller AS HUGEINT) * t_all ELSE t_all END AS den FROM ge_grid
),
ge_gap AS (
  SELECT seller_id, {dbl('SUM(GREATEST(gap, 0))')} / {dbl('MAX(den)')} AS pos, {dbl('SUM(ABS(gap))')} / {dbl('MAX(den)')} AS absg
  FROM ge_cell GROUP BY seller_id
),
ge_final AS (
  SELECT s.seller_id, s.seller_city, s.seller_state, s.regiao_seller, CAST(s.flag_seller_capital AS INTEGER)
           AS flag_seller_capital,
    CAST(COALESCE(ve.n, 0) AS BIGINT) AS volume_total_pedidos_estado_seller,
    CAST(COALESCE(vc.n, 0) AS BIGINT) AS volume_total_pedidos_cidade_seller,
    CAST(s.qtd AS BIGINT) AS qtd_pedidos_seller, {dbl('COALESCE(s.receita, 0)')} AS receita_total_seller,
    CAST(s.ufs AS BIGINT) AS qtd_ufs_atendidas, CAST(s.cidades AS BIGINT) AS qtd_cidades_atendidas,
    CAST(s.qpe AS BIGINT) AS qtd_pedidos_proprio_estado, CAST(s.qpc AS BIGINT) AS qtd_pedidos_propria_cidade,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('s.qpe')} / {dbl('s.qtd')} END AS pct_pedidos_proprio_estado,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('s.qpc')} / {dbl('s.qtd')} END AS pct_pedidos_propria_cidade,
    CASE WHEN me.n IS NULL OR me.n = 0 THEN 0.0 ELSE {dbl('s.qpe')} / {dbl('me.n')} END
      AS participacao_pedidos_seller_proprio_estado,
    CASE WHEN mc.n IS NULL OR mc.n = 0 THEN 0.0 ELSE {dbl('s.qpc')} / {dbl('mc.n')} END
      AS participacao_pedidos_seller_propria_cidade,
    CAST(o.state_rank AS INTEGER) AS rank_seller_pedidos_estado, CAST(o.city_rank AS INTEGER) AS rank_seller_pedidos_cidade,
    {dbl('COALESCE(s.rpe, 0)')} AS receita_proprio_estado, {dbl('COALESCE(s.rpc, 0)')} AS receita_propria_cidade,
    CASE WHEN me.r IS NULL OR me.r = 0 THEN 0.0 ELSE {dbl('s.rpe')} / {dbl('me.r')} END
      AS participacao_receita_proprio_estado,
    CASE WHEN mc.r IS NULL OR mc.r = 0 THEN 0.0 ELSE {dbl('s.rpc')} / {dbl('mc.r')} END
      AS participacao_receita_propria_cidade,
    pe.customer_state AS estado_maior_qtd_pedidos_seller, pc.customer_city AS cidade_maior_qtd_pedidos_seller,
    pc.customer_city AS principal_cidade_pedidos_seller, pe.customer_state AS principal_estado_pedidos_seller,
    CAST(COALESCE(pe.n, 0) AS BIGINT) AS qtd_pedidos_principal_estado,
    CAST(COALESCE(pc.n, 0) AS BIGINT) AS qtd_pedidos_principal_cidade,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('pe.n')} / {dbl('s.qtd')} END AS pct_pedidos_principal_estado_destino,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('pc.n')} / {dbl('s.qtd')} END AS pct_pedidos_principal_cidade_destino,
    s.media AS media_distancia_km, s.mediana AS mediana_distancia_km, s.dmax AS max_distancia_km,
    s.dmin AS min_distancia_km,
    CAST(s.curta AS BIGINT) AS qtd_pedidos_curta_distancia, CAST(s.media_d AS BIGINT) AS qtd_pedidos_media_distancia,
    CAST(s.longa AS BIGINT) AS qtd_pedidos_longa_distancia,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('s.curta')} / {dbl('s.qtd')} END AS pct_pedidos_curta_distancia,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('s.media_d')} / {dbl('s.qtd')} END AS pct_pedidos_media_distancia,
    CASE WHEN s.qtd = 0 THEN 0.0 ELSE {dbl('s.longa')} / {dbl('s.qtd')} END AS pct_pedidos_longa_distancia,
    o.state_mean AS media_pedidos_sellers_mesmo_estado, o.city_mean AS media_pedidos_sellers_mesma_cidade,
    s.qtd - o.state_mean AS dif_pedidos_vs_media_estado, s.qtd - o.city_mean AS dif_pedidos_vs_media_cidade,
    CASE WHEN o.state_mean = 0 THEN NULL ELSE {dbl('s.qtd')} / o.state_mean END AS razao_pedidos_vs_media_estado,
    CASE WHEN o.city_mean = 0 THEN NULL ELSE {dbl('s.qtd')} / o.city_mean END AS razao_pedidos_vs_media_cidade,
    COALESCE(gp.pos, 0.0) AS soma_gap_estado_positivo, COALESCE(gp.absg, 0.0) AS soma_abs_gap_estado,
    COALESCE(1 - gp.absg / 2, 0.0) AS score_cobertura_estado,
    CASE WHEN s.qtd = 0 THEN 1 ELSE 0 END AS flag_seller_sem_pedido
  FROM ge_seller s
  JOIN ge_standing o ON o.seller_id = s.seller_id
  LEFT JOIN ge_place ve ON ve.kind = 'from_state' AND ve.state = s.seller_state
  LEFT JOIN ge_place vc ON vc.kind = 'from_city' AND vc.state = s.seller_state AND vc.city = s.seller_city
  LEFT JOIN ge_place me ON me.kind = 'to_state' AND me.state = s.seller_state
  LEFT JOIN ge_place mc ON mc.kind = 'to_city' AND mc.state = s.seller_state AND mc.city = s.seller_city
  LEFT JOIN ge_main pe ON pe.seller_id = s.seller_id AND pe.whole_state = 1
  LEFT JOIN ge_main pc ON pc.seller_id = s.seller_id AND pc.whole_state = 0
  LEFT JOIN ge_gap gp ON gp.seller_id = s.seller_id
)"""
    from marketlens.operators.geo import FAMILIES

    sel = {k: f"SELECT seller_id, {', '.join(v)} FROM ge_final" for k, v in FAMILIES.items()}
    sel["geo_snapshot"] = "SELECT * FROM ge_final"
    sel["zip_centroids"] = "SELECT zip AS geolocation_zip_code_prefix, lat AS latitude, lng AS longitude FROM ge_geo"
    sel["order_distance"] = "SELECT seller_id, order_id, dist AS distancia_km FROM ge_base"
    return ctes, sel
