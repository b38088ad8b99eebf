"""Payment-mix windows on random histories against the brute-force range-join definition."""

import datetime as dt
import math
from dataclasses import replace
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.operators import payments as PM
from tests.fixtures import item, marketplace, money, order

CUTOFF = dt.date(2018, 7, 1)
METHODS = ["credit_card", "boleto", "voucher", "debit_card", "other", None]

sales = st.lists(
    st.tuples(st.sampled_from(["s1", "s2"]), st.integers(1, 420),
              st.lists(st.tuples(st.sampled_from(METHODS), st.integers(0, 5), st.integers(1, 9999)),
                       min_size=0, max_size=3)),
    min_size=1, max_size=12)


def brute(orders):
    """orders: (seller, ts, payments) -> {(seller, yyyyMM): features} following the source query."""
    named = ["credit_card", "boleto", "voucher", "debit_card"]
    out = {}
    months = {(s, t.replace(day=1).date()) for s, t, _ in orders}
    for s, m in months:
        feats = {}
        for w, days in (("d28", 28), ("d56", 56), ("d365", 365), ("vida", None)):
            mstart = dt.datetime.combine(m, dt.time())
            rows = [p for ss, t, p in orders if ss == s and t < mstart
                    and (days is None or t >= mstart - dt.timedelta(days=days))]
            paid = [p for p in rows if p]  # orders without payments have NULL rollups
            def vlr(p, meth):
                return sum((Decimal(v) / 100 for typ, _, v in p
                            if (typ == meth if meth != "outros" else (typ is not None and typ not in named))),
                           Decimal(0))
            cc = [vlr(p, "credit_card") for p in paid]
            feats[f"avg_vlr_credit_card_{w}"] = float(sum(cc)) / len(cc) if cc else None
            inst = [max(i for _, i, _ in p if i > 0) for p in paid if any(i > 0 for _, i, _ in p)]
            feats[f"avg_payment_installments_{w}"] = sum(inst) / len(inst) if inst else None
            qb = sum(sum(1 for typ, _, _ in p if typ == "boleto") for p in paid)
            qall = sum(sum(1 for typ, _, _ in p if typ is not None) for p in paid)
            feats[f"share_qtde_boleto_{w}"] = qb / qall if paid and qall else None
            vo = sum((vlr(p, "outros") for p in paid), Decimal(0))
            vall = sum((sum(vlr(p, mm) for mm in named + ["outros"]) for p in paid), Decimal(0))
            feats[f"share_valor_outros_{w}"] = float(vo) / float(vall) if paid and vall else None
        out[(s, m.strftime("%Y%m"))] = feats
    return out


@settings(max_examples=10, deadline=None)
@given(sales)
def test_payment_windows_match_range_join(spark, hist):
    ref = dt.datetime.combine(CUTOFF, dt.time())
    orders, items, payments, rows = [], [], [], []
    for i, (s, back, pays) in enumerate(hist):
        ts = ref - dt.timedelta(days=back)
        oid = f"o{i}"
        orders.append(order(oid, "c", ts.isoformat(sep=" ")))
        items.append(item(oid, 1, "p", s, 1))
        payments += [(oid, typ, inst, money(Decimal(v) / 100)) for typ, inst, v in pays]
        rows.append((s, ts, pays))
    mk = marketplace(spark, orders=orders, items=items, payments=payments)
    got = {(r["seller_id"], r["ref_month"]): r.asDict() for r in PM.payments_snapshot(mk, CUTOFF).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for key, feats in want.items():
        for k, v in feats.items():
            g = got[key][k]
            assert (g is None and v is None) or (g is not None and v is not None and abs(g - v) <= 1e-12 * max(1, abs(v))), \
                (key, k, g, v)


def test_windows_of_doubles_are_sums_of_their_own_days(spark):
    """Doubles of very different size, infinite ones and no number: an early payment leaves no trace in later windows.

    Sums are those of the decimals that the doubles print as, whatever the order.
    """
    pays = {"o1": (400, 1e9 + 0.1), "o2": (390, float("inf")), "o3": (45, 0.2), "o4": (20, 0.1), "o5": (-1, 0.3),
            "o6": (700, float("-inf")), "o7": (1100, float("nan"))}
    ref = dt.datetime.combine(CUTOFF, dt.time())
    when = {o: ref - dt.timedelta(days=back) for o, (back, _) in pays.items()}
    mk = marketplace(spark, orders=[order(o, "c", t.isoformat(sep=" ")) for o, t in when.items()],
                     items=[item(o, 1, "p", "s1", 1) for o in pays])
    payments = spark.createDataFrame([(o, "boleto", 1, v) for o, (_, v) in pays.items()],
                                     "order_id string, payment_type string, payment_installments int, payment_value double")
    found = PM.payments_snapshot(replace(mk, payments=payments), CUTOFF + dt.timedelta(days=9)).collect()
    assert {r.ref_month for r in found} == {t.strftime("%Y%m") for t in when.values()}
    for r in found:
        month = dt.datetime.strptime(r.ref_month, "%Y%m")
        for w, days in (("d28", 28), ("d56", 56), ("d365", 365), ("vida", 10**4)):
            own = [pays[o][1] for o, t in when.items() if month - dt.timedelta(days=days) <= t < month]
            if all(map(math.isfinite, own)):
                assert r[f"avg_vlr_boleto_{w}"] == (float(sum(Decimal(str(v)) for v in own)) / len(own) if own else None)
            else:
                assert repr(r[f"avg_vlr_boleto_{w}"]) == repr(sum(own) / len(own))


def test_windows_make_no_row_for_a_marker(spark):
    """Month starts in and out of leap years: windows begin inside a month, and the only rows are months with a sale."""
    days = [dt.date(2016, 1, 1) + dt.timedelta(days=k) for k in range(0, 900, 1)]
    mk = marketplace(spark, orders=[order(f"o{k}", "c", f"{d} 13:00:00") for k, d in enumerate(days)],
                     items=[item(f"o{k}", 1, "p", "s1", 1) for k in range(len(days))],
                     payments=[(f"o{k}", "boleto", 1, money(k)) for k in range(len(days))])
    base = PM.seller_orders(mk, CUTOFF)
    found = PM.windowed_totals(base)
    for r in found.collect():
        month = dt.datetime.strptime(r.ref_month, "%Y%m").date()
        for w, back in (("d28", 28), ("d56", 56), ("d365", 365), ("vida", 10**4)):
            own = [k for k, d in enumerate(days) if month - dt.timedelta(days=back) <= d < month]
            assert (r[f"n_paid__{w}"], r[f"vlr_total__{w}"]) == (len(own), 100 * sum(own)), (month, w)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "Generate" not in plan


def test_the_grid_deals_orders_once(spark, mk_small):
    """Pairs of seller and order are dealt by order into all partitions, where they become distinct and are joined."""
    plan = PM.seller_month_grid(PM.seller_orders(mk_small, CUTOFF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1
