"""Atomic publishing, refresh by digests, and ordered read-back of snapshot tables."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from marketlens.plans import publish as P
from marketlens.plans import snapshots as S

DAYS = [dt.date(2018, m, 1) for m in (1, 2, 3)]


def frame(spark, rows):
    return spark.createDataFrame([(f"s{i}", v, d) for d, v in rows for i in range(40)], "seller_id string, v int, dtRef date")


def table(spark, path):
    return sorted({(r.dtRef, r.v) for r in S.read_snapshot(spark, path=path).collect()}), S.read_snapshot(spark, path=path).count()


def test_a_failed_write_leaves_all_snapshots_as_they_were(spark, tmp_path):
    path = str(tmp_path / "t")
    S.replace_snapshots(frame(spark, [(d, 1) for d in DAYS]), path=path)
    old = table(spark, path)
    assert old == ([(d, 1) for d in DAYS], 120)
    # The last rows of the last snapshot raise: by then other files of the write are there.
    bad = frame(spark, [(d, 2) for d in DAYS]).repartitionByRange(3, "dtRef").withColumn(
        "v", F.when((F.col("dtRef") == F.lit(DAYS[2])) & (F.col("seller_id") == "s39"), F.raise_error(F.lit("lost")).cast("int"))
        .otherwise(F.col("v")))
    with pytest.raises(Exception):
        S.replace_snapshots(bad, path=path)
    assert table(spark, path) == old
    S.replace_snapshots(frame(spark, [(DAYS[1], 5)]), path=path)
    assert table(spark, path) == ([(DAYS[0], 1), (DAYS[1], 5), (DAYS[2], 1)], 120)
    assert P.read_published(spark, path, version=1).where("v = 5").count() == 0  # the older table is still whole
    P.expire(spark, path, keep=1)
    assert table(spark, path) == ([(DAYS[0], 1), (DAYS[1], 5), (DAYS[2], 1)], 120)
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_the_later_of_two_writers_keeps_the_others_snapshots(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    S.replace_snapshots(frame(spark, [(DAYS[0], 1)]), path=path)
    write = P._Folder.write
    state = {"first": True}

    def overtaken(self, name, text):
        if state.pop("first", False):  # another writer commits between this one's look and its record
            S.replace_snapshots(frame(spark, [(DAYS[1], 2)]), path=path)
        return write(self, name, text)

    monkeypatch.setattr(P._Folder, "write", overtaken)
    S.replace_snapshots(frame(spark, [(DAYS[2], 3)]), path=path)
    assert table(spark, path) == ([(d, i + 1) for i, d in enumerate(DAYS)], 120)


def test_whole_tables_empty_frames_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    S.overwrite_table(spark.createDataFrame([("200001", 1)], "ref_month string, seller_id int"), path=path)
    S.overwrite_table(spark.createDataFrame([("200002", 1)], "ref_month string, seller_id int"), path=path)
    assert [tuple(r) for r in S.read_snapshot(spark, path=path).collect()] == [("200002", 1)]
    S.replace_snapshots(frame(spark, []).limit(0), path=str(tmp_path / "e"))
    assert S.read_snapshot(spark, path=str(tmp_path / "e")).collect() == []
    by_text = spark.createDataFrame([("007", 1)], "k string, v int")
    S.replace_snapshots(by_text, path=str(tmp_path / "k"), partition_col="k")
    assert S.read_snapshot(spark, path=str(tmp_path / "k")).collect()[0].k == "007"


def test_refresh_rebuilds_what_late_facts_touch(spark, mk_small, tmp_path):
    path, dates = str(tmp_path / "t"), [dt.date(1999, 11, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 1)]
    day = F.to_date("order_purchase_timestamp")
    early = replace(mk_small, orders=mk_small.orders.where(~day.between(dt.date(1999, 11, 10), dt.date(1999, 11, 20))))
    assert S.refresh("delivery", early, dates[:2], path) == dates[:2]
    assert S.refresh("delivery", early, dates[:2], path) == []  # nothing changed
    assert S.refresh("delivery", mk_small, dates, path) == dates[1:]  # a late day, and a date that was not there
    dearer = replace(mk_small, sellers=mk_small.sellers.withColumn("seller_city", F.lit("x")))
    assert S.refresh("delivery", dearer, dates, path) == dates  # a dimension changed
    want = S.GROUPS["delivery"].build(mk_small, dates)
    got = S.read_snapshot(spark, path=path).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_positions_follow_the_order(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("seller_id"), F.lit(DAYS[0]).alias("dtRef"))
    S.replace_snapshots(rows, path=path)
    got = {r.seller_id: r.position for r in S.read_positions(spark, ["seller_id"], path=path).collect()}
    assert [got[x] for x in sorted(got)] == list(range(1, 5001))
