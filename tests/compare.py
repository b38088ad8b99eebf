"""Order-insensitive comparison of a Spark result with DuckDB rows."""

import math


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(float(v)))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (3, str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    cols = sorted(rel.columns)
    idx = [rel.columns.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


def assert_same(df, con, sql):
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    assert sc == dc, (set(sc) ^ set(dc))
    assert len(sr) == len(dr), (len(sr), len(dr))
    for a, b in zip(sr, dr):
        assert a == b, [(c, x, y) for c, x, y in zip(sc, a, b) if x != y][:5]
