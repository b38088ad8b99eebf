"""What the product build shuffles, and the keys that hold very many items."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlens import session
from marketlens.functions.skew import among, deal, frequent_values
from marketlens.operators import products as P
from marketlens.plans import snapshots as S
from tests.test_rewrites_and_plans import physical

DATES = [dt.date(1999, 11, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 1)]


def test_items_meet_orders_and_products_by_one_exchange_each(spark, mk_small):
    """Days, pairs and attributes of the sales need no exchange but that by product."""
    plan = physical(P.product_sales(mk_small, DATES, []))
    assert plan.count("Exchange hashpartitioning") == 4  # orders and items by order, items and products by product


def test_a_pair_goes_to_its_seller_in_one_row(spark, mk_small):
    """Stored by product, the sales meet the curves where they are; one row a pair is shuffled, whatever the number of dates."""
    sales = session.materialize(P.product_sales(mk_small, DATES, []), "product_sales", by="product_id")
    df = P.rivals_seen(sales, DATES, often=[])
    plan = physical(df)
    dealt = plan[plan.index("REPARTITION_BY_NUM"):]
    assert "Generate" not in dealt[:dealt.index("ShuffledHashJoin")]
    below = [x for x in dealt[dealt.index("ShuffledHashJoin"):].splitlines() if "Exchange" in x]
    assert "hashpartitioning(seller_id" in below[0]  # the next one is that of the products with a broadcast curve
    session.release(sales)


def test_the_build_stays_dealt_by_seller(spark, mk_small, monkeypatch):
    """The histograms are made where the seller's sales are, and what is not needed later is deleted."""
    kept = {}

    def keep(df, name="stage", by=None, found=session.materialize):
        kept[name] = found(df, name, by)
        return kept[name]

    monkeypatch.setattr(P, "materialize", keep)
    before = set(session._scratch.get(spark.sparkContext.applicationId, []))
    P.products_snapshot(mk_small, DATES)
    left = set(session._scratch[spark.sparkContext.applicationId]) - before
    assert sorted(x[0].rpartition("/")[2].partition("-")[0] for x in left) == ["category_sales", "rivals_seen", "seller_sales"]
    for build in (P.weight_histogram, P.category_sales, P.item_totals):
        assert "Exchange" not in physical(build(kept["seller_sales"], DATES, dealt=True))


def test_percentiles_share_their_aggregate_with_no_money(spark, mk_small):
    """Only items and products are summed by weight, money and volume by seller; the extremes are those of the sales."""
    sales = P.product_sales(mk_small, DATES, [])
    assert not {"price_Vida", "freight_Vida", "vsum_Vida"} & set(P.weight_histogram(sales, DATES).columns)
    got = P.item_metrics(sales, P.money_scales(mk_small), DATES).where(F.col("dtRef") == F.lit(DATES[-1]))
    want = sales.groupBy("seller_id").agg(F.min("weight_g") / 1000, F.max("weight_g") / 1000)
    cols = ["seller_id", "vlMinPesoProdutoVida", "vlMaxPesoProdutoVida"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_a_written_snapshot_is_made_once(spark, mk_small, monkeypatch, tmp_path):
    """The ranges of a write are found in the stored rows, not in the plan that makes them."""
    seen = []
    monkeypatch.setattr(S, "publish", lambda df, *a, **b: seen.append(physical(df)))
    S.write_group("products", mk_small, DATES[-1:], path=str(tmp_path / "t"))
    assert len(seen) == 1 and "Join" not in seen[0] and "Aggregate" not in seen[0]


def test_keys_of_very_many_items_change_nothing(spark, mk_small):
    want = sorted(map(str, P.products_snapshot(mk_small, DATES).collect()))
    counts = [r[0] for r in mk_small.items.groupBy("seller_id").count().select("count").collect()]
    for frequent in (sorted(counts)[len(counts) // 2], 35, 1):
        assert sorted(map(str, P.products_snapshot(mk_small, DATES, frequent=frequent).collect())) == want


def test_frequent_values(spark):
    rows = spark.createDataFrame([(k,) for k in [*"aaaabbbcc", None, None, None]], "k string")
    for frequent, want in ((5, set()), (4, {"a"}), (3, {"a", "b", None}), (1, {"a", "b", "c", None})):
        found = frequent_values(rows, "k", frequent)
        assert set(found) == want and len(found) == len(want)
        assert {r.k for r in rows.where(among("k", found)).collect()} == want
        assert rows.where(~among("k", found)).count() + rows.where(among("k", found)).count() == rows.count()


@pytest.mark.parametrize("dates, most", [(1, 1), (3, 500_000), (19, 500_000), (19, 10**9), (5000, 500_000), (20_000, 2**40)])
def test_codes_add_up_to_their_changes(spark, dates, most):
    r, names = random.Random(dates), [h.name for h in P.HORIZONS]
    rows = [(k, r.randrange(dates), *[r.choice([0, 0, 1, -1, r.randint(-most, most), most, -most]) for _ in names]) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, number int, " + ", ".join(f"{n} long" for n in names))
    codes = P._Codes(dates, most)
    read = codes.of(df, "k", names).select("k", *codes.read(F.col("code"), names))
    found = read.groupBy("k", "number").agg(*[F.sum(n) for n in names])
    assert sorted(map(tuple, found.collect())) == sorted(x for x in rows if any(x[2:]))


def test_tables_kept_dealt_need_no_exchange(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    kept = session.materialize(deal(rows, "k"), "kept", by="k")
    df = kept.groupBy("k", "id").count()
    assert "Exchange" not in physical(df) and df.count() == 100
    session.release(kept)
    assert not [x for x in session._scratch[spark.sparkContext.applicationId] if "kept-" in x[0]]


def test_what_was_shuffled_goes_with_its_job(spark):
    import os
    import time

    def files():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return sum(f.startswith("shuffle_") for d in manager.localDirsString() for _, _, names in os.walk(d) for f in names)

    session.drop_shuffles(spark)
    time.sleep(1)
    before = files()
    session.materialize(deal(spark.range(1000), "id").groupBy("id").count(), "shuffled")
    assert files() > before
    session.drop_shuffles(spark)
    time.sleep(1)
    assert files() <= before
