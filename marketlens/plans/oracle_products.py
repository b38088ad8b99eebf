"""DuckDB oracle for the product features (independent SQL over the testdata adapter)."""

from __future__ import annotations

from marketlens.plans.sqlkit import d, dbl, div, rnd, since

HS = [("D14", 14), ("D28", 28), ("D56", 56), ("D365", 365), ("Vida", None)]


def _w(ref, days, val, other=None):
    if days is None:
        return val
    tail = f" ELSE {other}" if other is not None else ""
    return f"CASE WHEN {since(ref, days)} THEN {val}{tail} END"


def _flags(ref):
    return ", ".join(("1" if days is None else f"MAX({_w(ref, days, 1, 0)})") + f" AS f_{n}" for n, days in HS)


def ctes(ref) -> str:
    div_cols = ", ".join(f"CAST(SUM(f_{n}) AS BIGINT) AS {{stem}}{n}" for n, _ in HS)
    comp = ", ".join(f"CAST(SUM(t.ct_{n} - f.f_{n}) AS BIGINT) AS {{stem}}{n}" for n, _ in HS)
    ct = ", ".join(f"SUM(f_{n}) AS ct_{n}" for n, _ in HS)
    m = []
    for n, days in HS:
        m += [
            f"SUM({_w(ref, days, 'COALESCE(price, 0)', 0)}) AS vlReceitaTot{n}",
            f"SUM({_w(ref, days, 'COALESCE(freight_value, 0)', 0)}) AS vlFreteTot{n}",
            f"SUM({_w(ref, days, 'wg')}) AS ws_{n}", f"COUNT({_w(ref, days, 'wg')}) AS wc_{n}",
            f"SUM({_w(ref, days, 'wg', 0)}) AS wt_{n}",
            f"MIN({_w(ref, days, 'wkg')}) AS vlMinPesoProduto{n}",
            f"MAX({_w(ref, days, 'wkg')}) AS vlMaxPesoProduto{n}",
            f"quantile_cont({_w(ref, days, 'wkg')}, 0.25) AS p25_{n}",
            f"quantile_cont({_w(ref, days, 'wkg')}, 0.5) AS p50_{n}",
            f"quantile_cont({_w(ref, days, 'wkg')}, 0.75) AS p75_{n}",
            f"SUM({_w(ref, days, 'vol')}) AS vs_{n}", f"COUNT({_w(ref, days, 'vol')}) AS vc_{n}",
            f"SUM({_w(ref, days, 'vol', 0)}) AS vt_{n}",
        ]
    mo = []
    for n, _ in HS:
        kg = f"({dbl(f'wt_{n}')} / 1000)"
        mo += [
            f"{rnd(f'({div(f'ws_{n}', f'wc_{n}')} / 1000)', 3)} AS vlMediaPesoProduto{n}",
            f"{rnd(f'p50_{n}', 3)} AS vlMedianaPesoProduto{n}",
            f"{rnd(f'p25_{n}', 3)} AS vlP25PesoProduto{n}",
            f"{rnd(f'p75_{n}', 3)} AS vlP75PesoProduto{n}",
            f"vlMinPesoProduto{n}", f"vlMaxPesoProduto{n}",
            f"{rnd(kg, 3)} AS vlTotalPesoProduto{n}",
            f"{rnd(div(f'vs_{n}', f'vc_{n}'), 1)} AS vlMediaCubagemProduto{n}",
            f"{rnd(dbl(f'vt_{n}'), 1)} AS vlTotalCubagemProduto{n}",
            f"{rnd(div(f'vlReceitaTot{n}', kg), 2)} AS vlPrecoKg{n}",
            f"{rnd(div(f'vlFreteTot{n}', kg), 2)} AS vlFreteKg{n}",
            f"{dbl(f'vlReceitaTot{n}')} AS rev_{n}", f"{dbl(f'vlFreteTot{n}')} AS frt_{n}",
        ]
    catrev = ", ".join(f"SUM({_w(ref, days, 'COALESCE(price, 0)', 0)}) AS r_{n}" for n, days in HS)
    long = " UNION ALL ".join(f"SELECT seller_id, cat, '{n}' AS janela, r_{n} AS rev FROM pr_catrev" for n, _ in HS)
    top = []
    for k in (1, 2, 3):
        top += [f"MAX(CASE WHEN janela = '{n}' AND rk = {k} THEN cat END) AS descTopCategoria{k}{n}" for n, _ in HS]
    for k in (1, 2, 3):
        top += [f"{rnd(f"MAX(CASE WHEN janela = '{n}' AND rk = {k} THEN share END)", 3)} "
                f"AS shareTopCategoria{k}{n}" for n, _ in HS]
    return f"""
pr_base AS (
  SELECT i.seller_id, o.order_id, o.order_purchase_timestamp AS ts, i.product_id, i.price, i.freight_value,
         COALESCE(p.product_category_name, 'NA') AS cat, COALESCE(p.product_description_lenght, 0) AS dlen,
         COALESCE(p.product_photos_qty, 0) AS photos, p.product_weight_g AS wg, p.product_weight_g / 1000 AS wkg,
         p.product_length_cm * p.product_height_cm * p.product_width_cm AS vol
  FROM mk_orders o JOIN mk_items i ON i.order_id = o.order_id LEFT JOIN mk_products p ON p.product_id = i.product_id
  WHERE o.order_purchase_timestamp < {d(ref)}
),
pr_catf AS (SELECT seller_id, cat, {_flags(ref)} FROM pr_base GROUP BY seller_id, cat),
pr_prodf AS (SELECT seller_id, product_id, {_flags(ref)} FROM pr_base GROUP BY seller_id, product_id),
pr_div AS (
  SELECT * FROM (SELECT seller_id, {div_cols.format(stem='vlCategoriasDistintas')} FROM pr_catf GROUP BY seller_id)
  JOIN (SELECT seller_id, {div_cols.format(stem='vlProdutosDistintos')} FROM pr_prodf GROUP BY seller_id)
  USING (seller_id)
),
pr_catcomp AS (
  SELECT f.seller_id, {comp.format(stem='vlContagemCategoriaConcorrentes')}
  FROM pr_catf f LEFT JOIN (SELECT cat, {ct} FROM pr_catf GROUP BY cat) t ON t.cat = f.cat GROUP BY f.seller_id
),
pr_prodcomp AS (
  SELECT f.seller_id, {comp.format(stem='vlContagemProdutosConcorrentes')}
  FROM pr_prodf f LEFT JOIN (SELECT product_id, {ct} FROM pr_prodf GROUP BY product_id) t
    ON t.product_id = f.product_id GROUP BY f.seller_id
),
pr_m AS (SELECT seller_id, {", ".join(m)} FROM pr_base GROUP BY seller_id),
pr_metrics AS (SELECT seller_id, {", ".join(mo)} FROM pr_m),
pr_catrev AS (SELECT seller_id, cat, {catrev} FROM pr_base GROUP BY seller_id, cat),
pr_long AS ({long}),
pr_rank AS (
  SELECT seller_id, cat, janela, {dbl('rev')} / {dbl('SUM(rev) OVER (PARTITION BY seller_id, janela)')} AS share,
         ROW_NUMBER() OVER (PARTITION BY seller_id, janela ORDER BY rev DESC, cat ASC) AS rk
  FROM pr_long WHERE rev > 0
),
pr_top AS (
  SELECT s.seller_id, {", ".join(top)}
  FROM (SELECT DISTINCT seller_id FROM pr_base) s LEFT JOIN pr_rank r ON r.seller_id = s.seller_id AND r.rk <= 3
  GROUP BY s.seller_id
),
pr_port AS (
  SELECT seller_id,
    {rnd(div('SUM(dlen)', 'COUNT(dlen)'), 1)} AS vlMediaCaracteresDescricao,
    {rnd('quantile_cont(dlen, 0.5)', 1)} AS vlMedianaCaracteresDescricao,
    {rnd('quantile_cont(dlen, 0.25)', 1)} AS vlP25CaracteresDescricao,
    {rnd('quantile_cont(dlen, 0.75)', 1)} AS vlP75CaracteresDescricao,
    {rnd('MIN(dlen)', 1)} AS vlMinCaracteresDescricao,
    {rnd('MAX(dlen)', 1)} AS vlMaxCaracteresDescricao,
    {rnd(div('SUM(photos)', 'COUNT(photos)'), 1)} AS vlMediaFotosProduto,
    {rnd(f"({div('SUM(wg)', 'COUNT(wg)')} / 1000)", 3)} AS vlMediaPesoPortfolio,
    {rnd('quantile_cont(wkg, 0.5)', 3)} AS vlMedianaPesoPortfolio,
    {rnd('quantile_cont(wkg, 0.25)', 3)} AS vlP25PesoPortfolio,
    {rnd('quantile_cont(wkg, 0.75)', 3)} AS vlP75PesoPortfolio,
    {rnd('MIN(wkg)', 3)} AS vlMinPesoPortfolio,
    {rnd('MAX(wkg)', 3)} AS vlMaxPesoPortfolio,
    {rnd(f"({dbl('SUM(wg)')} / 1000)", 3)} AS vlTotalPesoPortfolio
  FROM (SELECT DISTINCT seller_id, product_id, dlen, photos, wg, wkg FROM pr_base) GROUP BY seller_id
)"""


def _h(stem):
    return [f"{stem}{n}" for n, _ in HS]


DIVERSITY = _h("vlCategoriasDistintas") + _h("vlProdutosDistintos")
CAT_COMP = _h("vlContagemCategoriaConcorrentes")
PROD_COMP = _h("vlContagemProdutosConcorrentes")
WEIGHT = [f"vl{s}PesoProduto{n}" for s in ("Media", "Mediana", "P25", "P75", "Min", "Max", "Total") for n, _ in HS]
VOLUME = [f"vl{s}CubagemProduto{n}" for s in ("Media", "Total") for n, _ in HS]
PER_KG = [f"vl{s}Kg{n}" for s in ("Preco", "Frete") for n, _ in HS]
TOP = ([f"descTopCategoria{k}{n}" for k in (1, 2, 3) for n, _ in HS]
       + [f"shareTopCategoria{k}{n}" for k in (1, 2, 3) for n, _ in HS])
PORTFOLIO = ["vlMediaCaracteresDescricao", "vlMedianaCaracteresDescricao", "vlP25CaracteresDescricao",
             "vlP75CaracteresDescricao", "vlMinCaracteresDescricao", "vlMaxCaracteresDescricao",
             "vlMediaFotosProduto", "vlMediaPesoPortfolio", "vlMedianaPesoPortfolio", "vlP25PesoPortfolio",
             "vlP75PesoPortfolio", "vlMinPesoPortfolio", "vlMaxPesoPortfolio", "vlTotalPesoPortfolio"]


def snapshot_select(ref, key="idSeller", with_ref=True) -> str:
    cols = DIVERSITY + CAT_COMP + PROD_COMP + WEIGHT + VOLUME + PER_KG + TOP + PORTFOLIO
    head = f"{d(ref)} AS dtRef, " if with_ref else ""
    return f"""SELECT {head}pr_div.seller_id AS {key}, {", ".join(cols)}
FROM pr_div LEFT JOIN pr_catcomp USING (seller_id) LEFT JOIN pr_prodcomp USING (seller_id)
LEFT JOIN pr_metrics USING (seller_id) LEFT JOIN pr_top USING (seller_id) LEFT JOIN pr_port USING (seller_id)"""


def selects(ref) -> dict[str, str]:
    """Final SELECT per registry key (all read the CTEs from :func:`ctes`)."""
    k = f"{d(ref)} AS dtRef, seller_id"
    flag_cols = ", ".join(f"CAST(f_{n} AS INTEGER) AS hadCatSale{n[1:] + 'd' if n != 'Vida' else 'Vida'}"
                          for n, _ in HS)
    pflag_cols = flag_cols.replace("hadCatSale", "hadProdSale")
    rev = ", ".join(f"rev_{n} AS vlReceitaTot{n}" for n, _ in HS) + ", " + \
        ", ".join(f"frt_{n} AS vlFreteTot{n}" for n, _ in HS)
    return {
        "seller_revenue_horizons": f"SELECT {k}, {rev} FROM pr_metrics",
        "category_sale_flags": f"SELECT {k}, cat AS product_category_name, {flag_cols} FROM pr_catf",
        "product_sale_flags": f"SELECT {k}, product_id, {pflag_cols} FROM pr_prodf",
        "catalog_diversity": f"SELECT {k}, {', '.join(DIVERSITY)} FROM pr_div",
        "category_competitors": f"SELECT {k}, {', '.join(CAT_COMP)} FROM pr_catcomp",
        "product_competitors": f"SELECT {k}, {', '.join(PROD_COMP)} FROM pr_prodcomp",
        "item_weight_stats": f"SELECT {k}, {', '.join(WEIGHT)} FROM pr_metrics",
        "item_volume_stats": f"SELECT {k}, {', '.join(VOLUME)} FROM pr_metrics",
        "price_freight_per_kg": f"SELECT {k}, {', '.join(PER_KG)} FROM pr_metrics",
        "top_categories": f"SELECT {k}, {', '.join(TOP)} FROM pr_top",
        "portfolio_attributes": f"SELECT {k}, {', '.join(PORTFOLIO)} FROM pr_port",
        "products_snapshot": snapshot_select(ref),
        "products_by_seller": snapshot_select(ref, key="seller_id", with_ref=False),
    }
