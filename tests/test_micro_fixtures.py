"""Edge cases on hand-made rows (FIXTURES.md section 4, M1-M18)."""

import datetime as dt

import pytest

from marketlens.operators import customers as C
from marketlens.operators import delivery as D
from marketlens.operators import geo as G
from marketlens.operators import payments as PM
from marketlens.operators import products as P
from marketlens.operators import reputation as R
from marketlens.plans import snapshots as S
from tests.fixtures import item, marketplace, money, order, ts

REF = "2018-07-01"


def one(df, **key):
    rows = df.collect()
    for r in rows:
        if all(r[k] == v for k, v in key.items()):
            return r
    raise AssertionError(f"no row {key} in {rows}")


def test_m1_cutoff_and_horizon_bounds(spark):
    mk = marketplace(
        spark,
        orders=[order("at_ref", "c", "2018-07-01 00:00:00"), order("d14", "c", "2018-06-17 00:00:00"),
                order("before_d14", "c", "2018-06-16 23:59:59")],
        items=[item("at_ref", 1, "p", "s", 10, 1), item("d14", 1, "p", "s", 20, 2),
               item("before_d14", 1, "p", "s", 40, 3)],
        products=[("p", "cat", 10, 1, 1000, 1, 1, 1)],
    )
    rev = one(P.seller_revenue_horizons(P.product_sales(mk, REF), P.money_scales(mk), REF), seller_id="s")
    assert rev["vlReceitaTotD14"] == 20.0        # ts >= ref - 14 days, midnight bound
    assert rev["vlReceitaTotVida"] == 60.0       # the order at ref midnight is excluded (ts < ref)
    dl = one(D.delivery_snapshot(mk, REF), seller_id="s")
    assert dl["avg_frete_vida"] == 2.0           # delivery admits ts <= ref: all 3 items counted (Q2)
    assert dl["avg_frete_28d"] == 2.0
    assert D.delivery_features(mk, REF, ["freight_avg"]).count() == 1


def test_m2_m3_reviews_fanout_and_null_seller(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c", "2018-06-20"), order("o_noitem", "c", "2018-06-25")],
        items=[item("o1", 1, "p", "s", 10), item("o1", 2, "p", "s", 10)],
        reviews=[("o1", 5, ts("2018-07-01 10:00")), ("o1", 1, ts("2018-08-01")),
                 ("o_noitem", 3, ts("2018-06-26"))],
    )
    rep = R.reputation_snapshot(mk, REF)
    s = one(rep, idSeller="s")
    assert s["reviews28d"] == 1                  # review on the ref day counts (closed interval)
    assert s["reviewsLifetime"] == 1
    assert s["mediaAvaliacoesLifetime"] == 3.0   # 2 reviews x 2 items, later review included (Q6, Q7)
    assert s["pctNota1"] == 0.5
    assert s["percNota5D28"] == 0.5
    nul = one(rep, idSeller=None)                # order without items: NULL seller group (Q8)
    assert nul["reviewsLifetime"] == 1 and nul["pctNotasBoasLifetime"] is None


def test_m4_m5_m6_payments(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c", "2018-01-10"), order("o2", "c", "2018-02-10"), order("o3", "c", "2018-03-05")],
        items=[item("o1", 1, "p", "a", 10), item("o1", 2, "p", "b", 10), item("o2", 1, "p", "a", 5),
               item("o3", 1, "p", "a", 5)],
        payments=[("o1", "credit_card", 3, money(20)), ("o1", None, 0, money(7)), ("o2", "boleto", 0, money(5)),
                  ("o3", "x", 1, money(5))],
    )
    pm = PM.payments_snapshot(mk, REF)
    first = one(pm, seller_id="a", ref_month="201801")
    assert first["avg_vlr_credit_card_vida"] is None and first["share_qtde_boleto_vida"] is None   # M5
    feb_b = one(pm, seller_id="b", ref_month="201801")
    assert feb_b["avg_vlr_credit_card_vida"] is None
    mar = one(pm, seller_id="a", ref_month="201803")
    assert mar["avg_vlr_credit_card_vida"] == 10.0       # (20 + 0) / 2 orders, zeros included
    assert mar["share_qtde_credit_card_vida"] == 0.5     # NULL type counts in no method (M6)
    assert mar["avg_payment_installments_vida"] == 3.0   # installments 0 ignored
    assert mar["avg_vlr_credit_card_d28"] == 0.0         # only o2 (2018-02-10) is in [Mar 1 - 28d, Mar 1)
    assert {r["seller_id"] for r in pm.where("ref_month = '201801'").collect()} == {"a", "b"}   # M4


def test_m7_churn_without_current_customers(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c1", "2018-05-20"), order("o2", "c2", "2017-01-01")],
        items=[item("o1", 1, "p", "s", 10), item("o2", 1, "p", "s", 10)],
        customers=[("c1", "u1", "1", "x", "SP"), ("c2", "u2", "1", "x", "SP")],
    )
    r = one(C.customers_snapshot(mk, REF), seller_id="s")
    assert r["vl_qtd_clientes_distintos_28d"] == 0
    assert r["pct_churn_clientes_28d"] == 0.0           # Q11: no current row, churn stays 0
    assert r["pct_churn_clientes_56d"] == 0.0
    assert r["vl_qtd_clientes_distintos_full"] == 2
    assert r["vl_dias_desde_ultimo_cliente_novo_56d"] == 42
    assert r["dtSafra"] == dt.date(2018, 7, 1)


def test_m8_same_instant_repurchase(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c1", "2018-06-10"), order("o2", "c1", "2018-06-10"), order("o3", "c1", "2018-06-20")],
        items=[item(o, 1, "p", "s", 1) for o in ("o1", "o2", "o3")],
        customers=[("c1", "u1", "1", "x", "SP")],
    )
    r = one(C.customers_snapshot(mk, REF), seller_id="s")
    assert r["vl_tempo_medio_recompra_28d"] == 5.0      # gaps 0 and 10
    assert r["pct_concentracao_ihh_28d"] == 1.0
    assert r["pct_taxa_recompra_periodo_28d"] == 1.0


GEO = [("10", -23.5, -46.6), ("20", -22.9, -43.2)]


def test_m9_m10_m11_idle_seller_missing_customer_and_zip(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c1", "2018-06-01"), order("o2", "c_missing", "2018-06-02"),
                order("o3", "c2", "2018-06-03")],
        items=[item("o1", 1, "p", "s1", 10), item("o2", 1, "p", "s1", 10), item("o3", 1, "p", "s1", 10)],
        customers=[("c1", "u1", "20", "rio de janeiro", "RJ"), ("c2", "u2", "99", "santos", "SP")],
        sellers=[("s1", "10", "sao paulo", "SP"), ("idle", "10", "sao paulo", "SP")],
        geolocation=GEO,
    )
    g = G.geo_snapshot(mk, REF)
    idle = one(g, seller_id="idle")
    assert idle["flag_seller_sem_pedido"] == 1 and idle["qtd_pedidos_seller"] == 0
    assert idle["media_distancia_km"] is None and idle["pct_pedidos_proprio_estado"] == 0.0
    # market: 3 orders, one with NULL state -> non-NULL states hold 2/3 of the market (Q14, Q15)
    assert idle["soma_abs_gap_estado"] == pytest.approx(2 / 3)
    assert idle["score_cobertura_estado"] == pytest.approx(1 - 1 / 3)
    s1 = one(g, seller_id="s1")
    assert s1["regiao_seller"] == "Sudeste" and s1["flag_seller_capital"] == 1
    assert s1["qtd_ufs_atendidas"] == 2
    assert s1["max_distancia_km"] == s1["min_distancia_km"]     # only o1 has both zips (M11)
    assert s1["qtd_pedidos_curta_distancia"] + s1["qtd_pedidos_media_distancia"] + \
        s1["qtd_pedidos_longa_distancia"] == 1
    assert s1["rank_seller_pedidos_estado"] == 1 and idle["rank_seller_pedidos_estado"] == 2


def test_m13_rank_ties(spark):
    mk = marketplace(
        spark,
        orders=[order(f"o{i}", "c1", "2018-06-01") for i in range(5)],
        items=[item("o0", 1, "p", "a", 1), item("o1", 1, "p", "a", 1), item("o2", 1, "p", "b", 1),
               item("o3", 1, "p", "b", 1), item("o4", 1, "p", "c", 1)],
        customers=[("c1", "u1", "20", "x", "RJ")],
        sellers=[(s, "10", "x", "SP") for s in "abc"],
        geolocation=GEO,
    )
    ranks = {r["seller_id"]: r["rank_seller_pedidos_estado"] for r in G.geo_snapshot(mk, REF).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3}


def test_m14_m15_zero_prices_null_weights_single_row(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c", "2018-06-01", "2018-06-01", "2018-06-03", "2018-06-08", "2018-06-21")],
        items=[item("o1", 1, "p", "s", 0, 0, "2018-06-04")],
        products=[("p", None, None, None, None, 1, 1, 1)],
        reviews=[("o1", 4, ts("2018-06-10"))],
    )
    dl = one(D.delivery_snapshot(mk, REF), seller_id="s")
    assert dl["pct_frete_ped_vida"] == 0.0             # 0 / 0 under ANSI: NULL -> 0, no error (Q4)
    assert dl["consistencia"] == 0.0                   # one row: stddev NULL -> 0
    assert dl["diff_entrega_ped_50p"] == 13.0
    assert dl["n_ped_atrasados"] == 1                  # 'late' keeps the source sign (Q1)
    pr = one(P.products_snapshot(mk, REF), idSeller="s")
    assert pr["vlTotalPesoProdutoVida"] is None and pr["vlTotalPesoProdutoD56"] is None   # Q19
    assert pr["vlTotalPesoProdutoD14"] == 0.0          # window without the item: ELSE 0
    assert pr["vlPrecoKgVida"] is None
    assert pr["descTopCategoria1Vida"] is None         # revenue 0 is never ranked
    assert pr["vlMediaCaracteresDescricao"] == 0.0     # NULL length -> 0
    rep = one(R.reputation_snapshot(mk, REF), idSeller="s")
    assert rep["desvpadAvaliacoesLifetime"] is None    # M15


def test_m16_m18_top_categories_and_competitors(spark):
    mk = marketplace(
        spark,
        orders=[order("o1", "c", "2018-06-20"), order("o2", "c", "2018-06-21"), order("o3", "c", "2016-01-01")],
        items=[item("o1", 1, "p1", "a", 30), item("o1", 2, "p2", "a", 10), item("o2", 1, "p1", "b", 5),
               item("o2", 2, "p2", "b", 5), item("o3", 1, "p3", "a", 99)],
        products=[("p1", "toys", 1, 1, 100, 1, 1, 1), ("p2", "books", 1, 1, 100, 1, 1, 1),
                  ("p3", "old", 1, 1, 100, 1, 1, 1)],
    )
    pr = {r["idSeller"]: r for r in P.products_snapshot(mk, REF).collect()}
    a = pr["a"]
    assert (a["descTopCategoria1D14"], a["descTopCategoria2D14"], a["descTopCategoria3D14"]) == ("toys", "books", None)
    assert a["shareTopCategoria1D14"] == 0.75
    assert a["vlContagemCategoriaConcorrentesD14"] == 2     # rival b counted once per shared category
    assert a["vlContagemCategoriaConcorrentesVida"] == 2     # 'old' has no rival
    assert a["vlCategoriasDistintasD14"] == 2 and a["vlCategoriasDistintasVida"] == 3
    assert pr["b"]["descTopCategoria1D14"] == "books"        # tie 5 / 5: name ascending


def test_m17_snapshot_replace_is_idempotent(spark, tmp_path):
    mk = marketplace(
        spark,
        orders=[order("o1", "c", "2018-05-20"), order("o2", "c", "2018-06-20")],
        items=[item("o1", 1, "p", "s", 10), item("o2", 1, "p", "s", 20)],
        products=[("p", "cat", 10, 1, 1000, 1, 1, 1)],
    )
    path = str(tmp_path / "fs_products")
    first = P.products_snapshot(mk, ["2018-06-01", "2018-07-01"])
    S.replace_snapshots(first, path=path)                    # first write: table absent
    S.replace_snapshots(P.products_snapshot(mk, "2018-07-01"), path=path)   # replace one snapshot
    S.replace_snapshots(P.products_snapshot(mk, "2018-07-01"), path=path)   # and again
    back = S.read_snapshot(spark, path=path)
    assert back.count() == 2
    jul = S.read_snapshot(spark, path=path, ref="2018-07-01").collect()
    assert len(jul) == 1 and jul[0]["vlPrecoKgVida"] == 15.0
