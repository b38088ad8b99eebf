"""Location features on random orders against a literal reading of the source query."""

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.operators import geo as G
from tests.fixtures import item, marketplace, order

REF = dt.date(2018, 7, 1)
SELLERS = [("s1", "10", "sao paulo", "SP"), ("s2", "10", "sao paulo", "SP"), ("s3", "20", "rio", "RJ"),
           ("s4", "20", "rio", "RJ")]
CUSTOMERS = [("c1", "u1", "10", "sao paulo", "SP"), ("c2", "u2", "20", "rio", "RJ"),
             ("c3", "u3", "20", "niteroi", "RJ"), ("c4", "u4", "30", "bh", "MG")]
GEO = [("10", -23.5, -46.6), ("20", -22.9, -43.2), ("30", -19.9, -43.9)]

orders_st = st.lists(
    st.tuples(st.sampled_from(["c1", "c2", "c3", "c4", "c_missing"]),
              st.lists(st.sampled_from(["s1", "s2", "s3", "s4"]), min_size=1, max_size=3)),
    min_size=1, max_size=10)


def brute(data):
    seller_state = {s: st_ for s, _, _, st_ in SELLERS}
    cust_state = {c: st_ for c, _, _, _, st_ in CUSTOMERS}
    pairs = {(s, f"o{i}", cust_state.get(c)) for i, (c, ss) in enumerate(data) for s in ss}
    qtd = defaultdict(int)
    by_state = defaultdict(lambda: defaultdict(set))
    market = defaultdict(set)
    vol = defaultdict(set)
    for s, o, cs in pairs:
        qtd[s] += 1
        by_state[s][cs].add(o)
        market[cs].add(o)
        vol[seller_state[s]].add(o)
    out = {}
    total = sum(len(v) for v in market.values())
    states = sorted(k for k in market if k is not None)
    for s, _, _, sst in SELLERS:
        peers = [qtd[x] for x, _, _, y in SELLERS if y == sst]
        rank = 1 + sum(1 for p in peers if p > qtd[s])
        dest = sorted(((-len(o), cs is not None, cs or "") for cs, o in by_state[s].items()))
        counts = {k: len(by_state[s].get(k, ())) for k in states}
        n = sum(counts.values())
        gaps = [(counts[k] / n if n else 0.0) - len(market[k]) / total for k in states]
        out[s] = {
            "qtd_pedidos_seller": qtd[s],
            "qtd_ufs_atendidas": len([k for k in by_state[s] if k is not None]),
            "rank_seller_pedidos_estado": rank,
            "volume_total_pedidos_estado_seller": len(vol[sst]),
            "principal_estado_pedidos_seller": (dest[0][2] if dest[0][1] else None) if dest else None,
            "qtd_pedidos_principal_estado": -dest[0][0] if dest else 0,
            "soma_abs_gap_estado": sum(abs(g) for g in gaps) if states else 0.0,
            "flag_seller_sem_pedido": int(qtd[s] == 0),
        }
    return out


@settings(max_examples=10, deadline=None)
@given(orders_st)
def test_geo_matches_literal_definition(spark, data):
    orders, items = [], []
    for i, (c, ss) in enumerate(data):
        orders.append(order(f"o{i}", c, "2018-06-01"))
        items += [item(f"o{i}", k + 1, "p", s, 10) for k, s in enumerate(ss)]
    mk = marketplace(spark, orders=orders, items=items, customers=CUSTOMERS, sellers=SELLERS, geolocation=GEO)
    got = {r["seller_id"]: r.asDict() for r in G.geo_snapshot(mk, REF).collect()}
    want = brute(data)
    assert set(got) == set(want)
    for s, feats in want.items():
        for k, v in feats.items():
            if isinstance(v, float):
                assert got[s][k] == pytest.approx(v, abs=1e-12), (s, k, got[s][k], v)
            else:
                assert got[s][k] == v, (s, k, got[s][k], v)
