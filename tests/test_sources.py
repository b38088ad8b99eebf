"""The eight relations from catalog tables and from Parquet folders, as every build reads them."""

from marketlens.operators import delivery as D
from marketlens.operators import geo as G
from marketlens.sources.marketplace import DEFAULT_TABLE_NAMES, TABLES, from_catalog, from_parquet
from tests.fixtures import item, marketplace, order

REF = "2018-07-01"
GEO = [(100, -10.0, -50.0), (200, -20.0, -45.0)]


def small(spark):
    return marketplace(
        spark,
        orders=[order("o1", "c1", "2018-06-20"), order("o2", "c2", "2018-05-01")],
        items=[item("o1", 1, "p", "s", 10, 1), item("o2", 1, "p", "s", 20, 2)],
        customers=[("c1", "u1", 100, "a", "SP"), ("c2", "u2", 200, "b", "RJ")],
        sellers=[("s", 100, "a", "SP"), ("idle", 200, "b", "RJ")], geolocation=GEO,
        products=[("p", "cat", 10, 1, 1000, 1, 1, 1)])


def results(mk):
    return [sorted(map(tuple, df.collect()), key=str) for df in (D.delivery_snapshot(mk, REF), G.geo_snapshot(mk, REF))]


def test_catalog_and_folders_give_the_same_features(spark, tmp_path):
    mk = small(spark)
    names = {"orders": "pedidos"}
    spark.sql("CREATE DATABASE IF NOT EXISTS bound")
    try:
        for name in TABLES:
            frame = getattr(mk, name)
            frame.write.mode("overwrite").saveAsTable(f"bound.{names.get(name, DEFAULT_TABLE_NAMES[name])}")
            frame.write.parquet(str(tmp_path / DEFAULT_TABLE_NAMES[name]))
        want = results(mk)
        assert results(from_catalog(spark, "bound", names)) == want
        assert results(from_parquet(spark, str(tmp_path))) == want
        spark.catalog.setCurrentDatabase("bound")
        assert results(from_catalog(spark, names=names)) == want
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE bound CASCADE")
