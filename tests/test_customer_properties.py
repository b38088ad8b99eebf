"""Customer features on random order histories against a brute-force Python definition.

The brute force follows the source definition literally: LAG over each
(seller, customer) history, per-period distinct customers and orders,
churn against the previous equal period.
"""

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.operators import customers as C
from tests.fixtures import item, marketplace, order

REF = dt.date(2018, 7, 1)
PERIODS = [("28d", 28), ("56d", 56), ("365d", 365), ("full", None)]

history = st.lists(
    st.tuples(st.sampled_from(["s1", "s2"]), st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 420),
              st.sampled_from([0, 12])),
    min_size=1, max_size=14)


def spark_round(x: float, digits: int) -> float:
    """Spark's ROUND(double): the shortest decimal text, rounded half up."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute(rows):
    """rows: (seller, customer, order_id, ts) with ts < REF."""
    ref = dt.datetime.combine(REF, dt.time())
    out = {}
    by_seller = defaultdict(list)
    for s, u, o, t in rows:
        by_seller[s].append((u, o, t))
    for s, orders in by_seller.items():
        hist = defaultdict(list)
        for u, o, t in orders:
            hist[u].append(t)
        gaps = []  # (ts, days since previous purchase of the same customer)
        for u, ts in hist.items():
            ts = sorted(ts)
            gaps += [(b, (b.date() - a.date()).days) for a, b in zip(ts, ts[1:])]
        first = {u: min(ts) for u, ts in hist.items()}
        feats = {}
        for name, days in PERIODS:
            lo = ref - dt.timedelta(days=days) if days else dt.datetime(1900, 1, 1)
            cur = defaultdict(int)
            for u, o, t in orders:
                if t >= lo:
                    cur[u] += 1
            q = len(cur)
            g = [d for t, d in gaps if t >= lo]
            feats[f"vl_qtd_clientes_distintos_{name}"] = q
            feats[f"vl_tempo_medio_recompra_{name}"] = spark_round(sum(g) / len(g), 2) if (q and g) else 0.0
            if days:
                plo = ref - dt.timedelta(days=2 * days)
                prev = {u for u, o, t in orders if plo <= t < lo}
                feats[f"pct_churn_clientes_{name}"] = (
                    spark_round(max(len(prev) - q, 0) / len(prev), 4) if (q and prev) else 0.0)
            new = [f for f in first.values() if f >= lo]
            feats[f"vl_dias_desde_ultimo_cliente_novo_{name}"] = (REF - max(new).date()).days if (q and new) else 0
        out[s] = feats
    return out


@settings(max_examples=12, deadline=None)
@given(history)
def test_customer_features_match_brute_force(spark, hist):
    ref = dt.datetime.combine(REF, dt.time())
    rows, orders, items = [], [], []
    for i, (s, u, back, hour) in enumerate(hist):
        ts = ref - dt.timedelta(days=back) + dt.timedelta(hours=hour) if back else ref - dt.timedelta(hours=1)
        oid = f"o{i}"
        orders.append(order(oid, u, ts.isoformat(sep=" ")))
        items.append(item(oid, 1, "p", s, 1))
        rows.append((s, u, oid, ts))
    customers = [(u, u, "1", "x", "SP") for u in ("u1", "u2", "u3")]
    mk = marketplace(spark, orders=orders, items=items, customers=customers)
    got = {r["seller_id"]: r.asDict() for r in C.customers_snapshot(mk, REF).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for s, feats in want.items():
        for k, v in feats.items():
            assert got[s][k] == v, (s, k, got[s][k], v)
