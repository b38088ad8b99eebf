"""Reputation features on random orders / reviews / items against the literal COUNT(DISTINCT) definition."""

import datetime as dt
import math
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.operators import reputation as R
from tests.fixtures import item, marketplace, order

REF = dt.date(2018, 7, 1)

orders_st = st.lists(
    st.tuples(st.integers(1, 400),                                   # days before ref
              st.lists(st.sampled_from(["s1", "s2"]), max_size=3),   # item sellers (may be empty)
              st.lists(st.tuples(st.integers(1, 5), st.integers(-30, 60)), max_size=2)),  # (score, review day)
    min_size=1, max_size=10)


def spark_round(x: float, digits: int) -> float:
    """Spark's ROUND(double): the shortest decimal text, rounded half up (1.625 -> 1.63)."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def brute(rows, ref):
    """rows: joined (order_id, purchase ts, review or None, seller or None) -- the source's LEFT JOINs."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    out = {}
    for seller, rs in groups.items():
        def in_w(t, n):
            return t >= ref - dt.timedelta(days=n)
        f = {"reviewsLifetime": len({r[0] for r in rs})}
        for n in (28, 56, 365):
            lo = (ref - dt.timedelta(days=n)).date()
            f[f"reviews{n}d"] = len({r[0] for r in rs if r[2] and lo <= r[2][1].date() <= ref.date()})
            inw = [r for r in rs if in_w(r[1], n)]
            good = sum(1 for r in inw if r[2] and r[2][0] in (4, 5))
            f[f"pctNotasBoasD{n}"] = good / len(inw) if inw else None
            sc = [r[2][0] for r in inw if r[2]]
            f[f"mediaAvaliacoesD{n}"] = spark_round(sum(sc) / len(sc), 2) if sc else None
        items_rows = sum(1 for r in rs if r[3] is not None)
        bad = sum(1 for r in rs if r[2] and r[2][0] in (1, 2))
        f["pctNotasRuinsLifetime"] = bad / items_rows if items_rows else None
        f["percNota5Lifetime"] = sum(1 for r in rs if r[2] and r[2][0] == 5) / len(rs)
        out[seller] = f
    return out


@settings(max_examples=10, deadline=None)
@given(orders_st)
def test_reputation_matches_count_distinct_definition(spark, data):
    ref = dt.datetime.combine(REF, dt.time())
    orders, items, reviews, rows = [], [], [], []
    for i, (back, sellers, revs) in enumerate(data):
        oid, t = f"o{i}", ref - dt.timedelta(days=back)
        orders.append(order(oid, "c", t.isoformat(sep=" ")))
        items += [item(oid, k + 1, "p", s, 1) for k, s in enumerate(sellers)]
        rv = [(sc, ref + dt.timedelta(days=d)) for sc, d in revs]
        reviews += [(oid, sc, when) for sc, when in rv]
        for review in (rv or [None]):
            for s in (sellers or [None]):
                rows.append((oid, t, review, s))
    mk = marketplace(spark, orders=orders, items=items, reviews=reviews)
    got = {r["idSeller"]: r.asDict() for r in R.reputation_snapshot(mk, REF).collect()}
    want = brute(rows, ref)
    assert set(got) == set(want)
    for s, feats in want.items():
        for k, v in feats.items():
            g = got[s][k]
            if v is None or g is None:
                assert g is None and v is None, (s, k, g, v)
            else:
                assert math.isclose(g, v, rel_tol=1e-12, abs_tol=1e-12), (s, k, g, v)


def test_reviews_and_items_meet_as_sums(spark):
    """An order's reviews and items are dealt by order and reduced before they are joined: no product of their rows."""
    from pyspark.sql import functions as F

    ref = dt.datetime.combine(REF, dt.time())
    when = ref - dt.timedelta(days=9)
    mk = marketplace(spark, orders=[order("o1", "c", when.isoformat(sep=" "))],
                     items=[item("o1", k, "p", "s1" if k % 3 else None, 1) for k in range(30)],
                     reviews=[("o1", 1 + k % 5, when) for k in range(20)])
    rows = R.review_rows(mk, REF)
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3
    found = {r.idSeller: r for r in R.reputation_snapshot(mk, REF).collect()}
    sums = {r.seller_id: r for r in R.reputation_sums(R.per_order(rows, REF)).collect()}
    assert {s: (r.n_orders, r.rows_all, r.c5_L, r.n_28) for s, r in sums.items()} == {
        "s1": (1, 400, 80, 400), None: (1, 200, 40, 200)}
    assert found["s1"].percNota5Lifetime == 0.2 and found["s1"].reviews28d == 1
    assert R.per_order(rows, REF).agg(F.sum("n_item_rows")).first()[0] == 600
