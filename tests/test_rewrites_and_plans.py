"""Rewrites checked against brute force, invariants, and the shape of the physical plans."""

import datetime as dt
from functools import reduce
from collections import defaultdict

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import customers as C
from marketlens.operators import geo as G
from marketlens.operators import payments as PM
from marketlens.operators import products as P
from marketlens.operators import reputation as R
from marketlens.plans import snapshots as S

REF = dt.date(2000, 1, 1)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_coverage_gap_equals_dense_grid(spark, mk_small):
    """The exact rational form equals the reference's seller x state grid, brute force in Python."""
    base = G.seller_orders(mk_small, REF).collect()
    sellers = {r.seller_id for r in mk_small.sellers.collect()}
    per_seller_state = defaultdict(set)
    market = defaultdict(set)
    for r in base:
        per_seller_state[(r.seller_id, r.customer_state)].add(r.order_id)
        market[r.customer_state].add(r.order_id)
    total = sum(len(v) for v in market.values())
    states = sorted(s for s in market if s is not None)
    expected = {}
    for s in sellers:
        counts = {st: len(per_seller_state.get((s, st), ())) for st in states}
        n = sum(counts.values())
        gaps = [(counts[st] / n if n else 0.0) - len(market[st]) / total for st in states]
        expected[s] = (sum(g for g in gaps if g > 0), sum(abs(g) for g in gaps))
    got = {r.seller_id: r for r in G.geo_snapshot(mk_small, REF).collect()}
    assert set(got) == sellers
    for s, (pos, ab) in expected.items():
        assert got[s].soma_gap_estado_positivo == pytest.approx(pos, abs=1e-12)
        assert got[s].soma_abs_gap_estado == pytest.approx(ab, abs=1e-12)
        assert got[s].score_cobertura_estado == pytest.approx(1 - ab / 2, abs=1e-12)


def test_backfill_in_one_job_equals_single_builds(spark, mk_small):
    dates = [dt.date(1999, 11, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 1)]
    many = P.products_snapshot(mk_small, dates)
    single = reduce(DataFrame.unionByName, [P.products_snapshot(mk_small, d) for d in dates])
    cols = P.SNAPSHOT_COLS
    assert sorted(many.select(*cols).collect()) == sorted(single.select(*cols).collect())
    plan = physical(many)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nested_horizons_and_bounds(spark, mk_small):
    pr = P.products_snapshot(mk_small, REF).collect()
    for r in pr:
        for stem in ("vlCategoriasDistintas", "vlProdutosDistintos"):
            v = [r[f"{stem}{h}"] for h in ("D14", "D28", "D56", "D365", "Vida")]
            assert v == sorted(v)
        shares = [r[f"shareTopCategoria{k}Vida"] for k in (1, 2, 3) if r[f"shareTopCategoria{k}Vida"] is not None]
        assert shares == sorted(shares, reverse=True) and sum(shares) <= 1.0 + 1e-3
    for r in R.reputation_snapshot(mk_small, REF).collect():
        v = [r["reviews28d"], r["reviews56d"], r["reviews365d"]]
        assert v == sorted(v)
    for r in C.customers_snapshot(mk_small, REF).collect():
        for p in ("28d", "56d", "365d", "full"):
            q = r[f"vl_qtd_clientes_distintos_{p}"]
            if q:
                assert 1 / q - 1e-6 <= r[f"pct_concentracao_ihh_{p}"] <= 1.0
        for p in ("28d", "56d", "365d"):
            assert 0.0 <= r[f"pct_churn_clientes_{p}"] <= 1.0
    for r in G.geo_snapshot(mk_small, REF).collect():
        assert 0.0 <= r["score_cobertura_estado"] <= 1.0
        assert r["soma_gap_estado_positivo"] == pytest.approx(r["soma_abs_gap_estado"] / 2, abs=1e-12)


def test_payment_shares_total_one(spark, mk_small):
    for r in PM.payments_snapshot(mk_small, REF).collect():
        for w in ("d28", "d56", "d365", "vida"):
            qs = [r[f"share_qtde_{m}_{w}"] for m in PM.ALL_METHODS]
            if qs[0] is None:
                assert all(q is None for q in qs)
            else:
                assert sum(qs) == pytest.approx(1.0)


def test_plans_have_no_blowups(spark, mk_small):
    rep = physical(R.reputation_snapshot(mk_small, REF))
    assert "Expand" not in rep                     # no COUNT(DISTINCT) row multiplication
    geo = physical(G.geo_snapshot(mk_small, REF))
    assert "Cartesian" not in geo and "NestedLoop" not in geo
    cust = physical(C.customers_snapshot(mk_small, REF))
    assert "Window" not in cust and "NestedLoop" not in cust
    pay = physical(PM.payments_snapshot(mk_small, REF))
    assert "NestedLoop" not in pay and "Cartesian" not in pay


def test_cutoff_reaches_the_parquet_scan(spark, mk_small):
    plan = physical(P.product_sales(mk_small, REF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan


def test_region_and_capital_rules(spark):
    df = spark.createDataFrame([("SP", "Sao Paulo"), ("AM", "manaus"), ("XX", "Campinas"), (None, None)],
                               "st string, city string")
    got = df.select(G.region_of(F.col("st")).alias("r"), G.capital_flag(F.col("city")).alias("c")).collect()
    assert [(r.r, r.c) for r in got] == [("Sudeste", 1), ("Norte", 1), ("Não identificado", 0),
                                         ("Não identificado", 0)]


def _geo_dated(mk, refs):
    return G.geo_snapshot(mk, refs, with_ref=True)


@pytest.mark.parametrize("builder", [R.reputation_snapshot, C.customers_snapshot, _geo_dated])
def test_other_builders_many_dates_equal_single_builds(spark, mk_small, builder):
    """Backfill any builder (Q21): one spine job equals the single-date builds."""
    from marketlens.operators import delivery as D

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    dates = [dt.date(1999, 12, 1), dt.date(2000, 1, 1)]
    assert rows(builder(mk_small, dates)) == sorted(
        (r for d in dates for r in rows(builder(mk_small, d))), key=lambda t: tuple((v is None, str(v)) for v in t))
    dl_many = D.delivery_snapshot(mk_small, dates, with_ref=True)
    with pytest.raises(ValueError):
        D.delivery_snapshot(mk_small, dates)
    for d in dates:
        assert rows(dl_many.where(F.col("dtRef") == F.lit(d)).drop("dtRef")) == rows(D.delivery_snapshot(mk_small, d))


def test_batch_job_writes_every_group(spark, mk_small, tmp_path):
    """The command-line job builds and writes each group; re-running a spine replaces it."""
    from marketlens.plans import jobs
    from marketlens.sources.marketplace import DEFAULT_TABLE_NAMES, TABLES

    root = tmp_path / "src"
    for name in TABLES:
        getattr(mk_small, name).write.parquet(str(root / DEFAULT_TABLE_NAMES[name]))
    for group in S.GROUPS:
        out = tmp_path / group
        args = ["--group", group, "--parquet-root", str(root), "--path", str(out)]
        if group == "payments":
            with pytest.raises(SystemExit):
                jobs.main(args + ["--first", "1999-11-01", "--last", "2000-01-01"])
            jobs.main(args + ["--ref", "2000-01-01"])
            assert S.read_snapshot(spark, path=str(out), ref="1999-12-01", group=group).count() > 0
            continue
        jobs.main(args + ["--first", "1999-11-01", "--last", "2000-01-01"])
        jobs.main(args + ["--first", "1999-12-01", "--last", "2000-01-01"])
        back = S.read_snapshot(spark, path=str(out))
        assert back.count() > 0
        if group in ("products", "reputation", "delivery", "geo"):
            assert back.select("dtRef").distinct().count() == 3
            twice = back.groupBy("dtRef", *[c for c in back.columns if c in ("seller_id", "idSeller")]).count()
            assert twice.where("count > 1").count() == 0   # replaced, not appended


def test_feature_views_for_sql_users(spark, mk_small):
    from marketlens.plans.views import register_feature_views

    names = register_feature_views(spark, mk_small, REF, ["fs_products", "fs_delivery"])
    assert names == ["fs_products", "fs_delivery"]
    top = spark.sql("SELECT idSeller, vlPrecoKgVida FROM fs_products ORDER BY vlPrecoKgVida DESC LIMIT 3")
    assert len(top.collect()) == 3
    plan = spark.sql("SELECT seller_id, avg_frete_vida FROM fs_delivery")._jdf.queryExecution().executedPlan()
    assert "order_approved_at" not in plan.toString()   # unused feature inputs are pruned away


def test_as_of_invariance_and_review_leakage(spark, mk_small):
    """Orders placed after ref change nothing; reviews written after ref do change reputation (Q6)."""
    from dataclasses import replace

    from marketlens.operators import delivery as D

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    ts = F.col("order_purchase_timestamp")
    cut = replace(mk_small, orders=mk_small.orders.where(ts < F.lit(REF)))
    for build in (P.products_snapshot, R.reputation_snapshot, C.customers_snapshot, G.geo_snapshot,
                  PM.payments_snapshot):
        assert rows(build(mk_small, REF)) == rows(build(cut, REF))
    cut_incl = replace(mk_small, orders=mk_small.orders.where(ts <= F.lit(REF)))
    assert rows(D.delivery_snapshot(mk_small, REF)) == rows(D.delivery_snapshot(cut_incl, REF))
    no_late_reviews = replace(mk_small, reviews=mk_small.reviews.where(F.col("review_creation_date") < F.lit(REF)))
    assert rows(R.reputation_snapshot(mk_small, REF)) != rows(R.reputation_snapshot(no_late_reviews, REF))


def test_no_single_task_funnels(spark, mk_small):
    """No snapshot plan gathers rows into one task (SinglePartition) or pairs rows (cartesian / nested loop)."""
    from marketlens.operators import delivery as D

    builds = [P.products_snapshot(mk_small, REF), R.reputation_snapshot(mk_small, REF),
              PM.payments_snapshot(mk_small, REF), C.customers_snapshot(mk_small, REF),
              D.delivery_snapshot(mk_small, REF), G.geo_snapshot(mk_small, REF),
              P.products_snapshot(mk_small, [dt.date(1999, 12, 1), REF])]
    for df in builds:
        plan = physical(df)
        assert "SinglePartition" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_replacing_in_a_table_made_by_sql_keeps_the_others(spark):
    """The write asks for dynamic overwrite itself: a session's default mode would empty the table."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.sql("DROP TABLE IF EXISTS made_by_sql")
    spark.sql("CREATE TABLE made_by_sql (v INT, dtRef DATE) USING parquet PARTITIONED BY (dtRef)")
    try:
        spark.conf.set(mode, "static")
        for day, v in (("2018-01-01", 1), ("2018-02-01", 2), ("2018-02-01", 3)):
            S.replace_snapshots(spark.createDataFrame([(v, dt.date.fromisoformat(day))], "v int, dtRef date"), table="made_by_sql")
        assert sorted((str(r.dtRef), r.v) for r in spark.table("made_by_sql").collect()) == [("2018-01-01", 1), ("2018-02-01", 3)]
        assert spark.conf.get(mode) == "static"  # asked for by the write, not by the session
    finally:
        spark.conf.set(mode, before)
        spark.sql("DROP TABLE IF EXISTS made_by_sql")


def test_one_customer_snapshot_a_month(spark, mk_small):
    with pytest.raises(ValueError):
        S.GROUPS["customers"].build(mk_small, [dt.date(2000, 1, 1), dt.date(2000, 1, 15)])


def nodes(df, kind: str, plan: str = "optimizedPlan") -> list[str]:
    return [x for x in getattr(df._jdf.queryExecution(), plan)().toString().splitlines() if kind in x]


def test_items_are_scanned_once_and_never_copied_for_a_date(spark, mk_small):
    """Products and delivery: one scan of items for any number of dates, no generator and no object aggregate over items."""
    from marketlens.operators import delivery as D

    for dates in ([REF], S.month_starts(dt.date(1999, 1, 1), REF)):
        for df in (P.product_sales(mk_small, dates), D.delivery_histogram(mk_small, dates)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert len([x for x in plan.splitlines() if "Relation" in x and "l_suppkey" in x]) == 1
            assert "Generate" not in plan or "Aggregate" in plan[plan.rindex("Generate"):]  # generators stand above the daily sums
            assert "ObjectHashAggregate" not in physical(df)
    snapshot = P.products_snapshot(mk_small, REF)
    assert "l_orderkey" not in physical(snapshot)  # everything comes from the written sales


def test_location_reads_its_base_three_times(spark, mk_small, monkeypatch):
    """The (seller, order) table is written once and read for places, destinations and distances; no object or sort
    aggregate over its rows but the sets of cities."""
    written = {}

    def keep(df, name):
        written[name] = df
        return spark.createDataFrame([], df.schema)  # the plans only

    monkeypatch.setattr(G, "materialize", keep)
    for dates in ([REF], S.month_starts(dt.date(1999, 9, 1), REF)):
        G.geo_snapshot(mk_small, dates, with_ref=True)
        assert len([x for x in nodes(written["geo_orders"], "Relation") if "l_suppkey" in x]) == 1
        orders = spark.createDataFrame([], written["geo_orders"].schema)
        for df in (G.place_orders(orders, dates), G.distances(orders, dates)):
            plan = physical(df)
            assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "SinglePartition" not in plan
    places = spark.createDataFrame([], written["geo_places"].schema)
    plan = physical(G.seller_rows(mk_small, orders, places, dates))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("LogicalRDD") + plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 4  # destinations, distances, market twice


def test_customer_pairs_are_shuffled_once_for_any_number_of_dates(spark, mk_small):
    """The rows of the dates are made above the last exchange by pair: as many pair rows are dealt for 19 dates as for one run's events."""
    dates = S.month_starts(dt.date(1998, 7, 1), REF)
    orders = C.seller_customer_orders(mk_small, dates)
    pairs = C.per_customer(orders, dates)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    top = plan[:plan.index("Window")]
    assert "Generate explode" in top and "Aggregate" not in top  # dates after the last aggregate and window
    last = {(r.seller_id, r.customer_unique_id) for r in pairs.where(F.col("dtRef") == F.lit(REF)).select(
        "seller_id", "customer_unique_id").collect()}
    assert len(last) == orders.select("seller_id", "customer_unique_id").distinct().count()


def test_five_thousand_dates_plan_in_seconds(spark, mk_small):
    import time

    days = [dt.date(1990, 1, 1) + dt.timedelta(d) for d in range(5000)]
    began = time.time()
    physical(P.item_metrics(P.product_sales(mk_small, days), P.money_scales(mk_small), days))
    assert time.time() - began < 20


def test_dated_sums_equal_their_definition(spark):
    """Random facts, dates and horizons, inclusive or not, against sums over the facts of each window."""
    import random

    from marketlens.functions import horizons as H
    from marketlens.functions.timeline import dated_sums

    r = random.Random(6)
    hs = H.make(("w", 7), ("m", 30), ("all", None))
    start = dt.date(2020, 1, 1)
    facts = [(r.choice("ab"), r.choice([None, 1, 2]), start + dt.timedelta(r.randrange(120)), r.random() < 0.2,
              r.choice([None, *range(9)])) for _ in range(300)]
    frame = spark.createDataFrame(facts, "k string, j int, day date, midnight boolean, v int").withColumn("one", F.lit(1))
    frame = frame.withColumn("after", F.when(F.col("midnight"), F.date_sub("day", 1)).otherwise(F.col("day")))
    for dates in ([start + dt.timedelta(60)], sorted({start + dt.timedelta(r.randrange(140)) for _ in range(25)})):
        for after in (None, "after"):
            found = dated_sums(frame, ["k", "j"], {"v": hs, "one": hs[1:]}, hs, dates, after=after).collect()
            want = {}
            for ref in dates:
                for k, j, day, midnight, v in facts:
                    if day < ref or after and midnight and day == ref:
                        row = want.setdefault((ref, k, j), [0] * 5)
                        for i, days in enumerate((7, 30, None)):
                            if days is None or day >= ref - dt.timedelta(days):
                                row[i] += v or 0
                                if i:
                                    row[2 + i] += 1
            assert {(x.dtRef, x.k, x.j): [x.v_w, x.v_m, x.v_all, x.one_m, x.one_all] for x in found} == want
            assert len(found) == len(want)


def test_a_product_of_every_seller_is_spread(spark, mk_small):
    """Frequent keys come back by a broadcast of their totals; the result is that of a plain join."""
    from marketlens.functions.skew import join_totals

    rows = spark.createDataFrame([(k, i, i % 2) for i in range(50) for k in ["hot", *([None, "warm"] if i < 9 else []), f"k{i}"]],
                                 "k string, s int, f int")
    plain = sorted(map(tuple, join_totals(rows, ["k"], {"n": F.sum("f")}, 10**9).collect()), key=str)
    assert len(plain) == rows.count()
    for frequent in (1, 9, 20):
        df = join_totals(rows, ["k"], {"n": F.sum("f")}, frequent)
        assert sorted(map(tuple, df.collect()), key=str) == plain
        assert "BroadcastHashJoin" in physical(df)
    for dates in ([REF], [dt.date(1999, 12, 1), REF]):
        sales = P.product_sales(mk_small, dates)
        want, some, every = (sorted(map(tuple, P.product_rivals(sales, dates, frequent).collect())) for frequent in (10**9, 35, 1))
        assert some == want and every == want


def test_rivals_of_pairs_sold_on_several_days(spark):
    """Distinct products and rivals equal brute force, and no pair of seller and product is copied for a date."""
    import random

    r, start = random.Random(8), dt.date(2020, 1, 1)
    days = sorted({(r.choice("abc"), r.choice("pqrs"), start + dt.timedelta(r.randrange(900))) for _ in range(60)})
    for dates in ([start + dt.timedelta(600)], sorted({start + dt.timedelta(r.randrange(300, 950)) for _ in range(12)})):
        sold = defaultdict(list)
        for s, p, day in days:
            if day < dates[-1]:
                sold[s, p].append(max(day, dates[0] - dt.timedelta(366)))
        rows = [(s, p, d, 1, int(i == 0), x[i - 1] if i else None, x[i + 1] if i + 1 < len(x) else None)
                for (s, p), found in sold.items() for x in [sorted(set(found))] for i, d in enumerate(x)]
        sales = spark.createDataFrame(rows, "seller_id string, product_id string, day date, items int, new int, last_day date, next_day date")
        want = {}
        for ref in dates:
            seen = lambda s, p, h: any(d < ref and (h.lifetime or d >= ref - dt.timedelta(h.days)) for d in sold.get((s, p), ()))
            for s in {s for s, p in sold if seen(s, p, P.HORIZONS[-1])}:
                mine = [p for t, p in sold if t == s and seen(s, p, P.HORIZONS[-1])]
                want[ref, s] = [sum(seen(s, p, h) for p in mine) for h in P.HORIZONS] + [
                    sum(seen(t, p, h) for p in mine for t in "abc" if t != s) for h in P.HORIZONS]
        for frequent in (10**9, 20):
            df = P.product_rivals(sales, dates, frequent)
            assert {(x.dtRef, x.seller_id): list(x)[2:] for x in df.collect()} == want
        windows = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in x]
        assert windows and not any("dtRef" in x and "product_id" in x for x in windows)


def test_facts_meet_their_order_as_hashes(spark, mk_small):
    """The digests of the facts are those of whole rows, but only hashes are joined with the orders."""
    found = S.day_digests(mk_small)
    lines = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not any("xxhash64" in above and "Join Inner" in below for above, below in zip(lines, lines[1:]))
    rows = mk_small.reviews
    joined = rows.join(mk_small.orders.select("order_id", F.to_date("order_purchase_timestamp").alias("day")), "order_id")
    want = joined.groupBy("day").agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).cast("string"))
    assert set(map(tuple, found.where("relation = 'reviews'").drop("relation").collect())) == set(map(tuple, want.collect()))


def test_dates_are_attached_below_no_fact_exchange(spark, mk_small):
    """The reference dates are generated after the roll-up to (seller, order), not on items or reviews."""
    dates = [dt.date(1999, 12, 1), dt.date(2000, 1, 1)]
    for df in (R.reputation_snapshot(mk_small, dates), C.customers_snapshot(mk_small, dates),
               G.distances(G.seller_orders(mk_small, dates), dates)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan[plan.index("Generate explode"):]


def test_repeated_customers_and_sellers_count_orders_once(spark, mk_small):
    from dataclasses import replace

    twice = replace(mk_small, customers=mk_small.customers.union(mk_small.customers), sellers=mk_small.sellers.union(mk_small.sellers))
    rows = [sorted(map(str, G.geo_snapshot(m, REF).collect())) for m in (mk_small, twice)]
    assert rows[0] == rows[1]
