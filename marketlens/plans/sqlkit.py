"""Small text helpers for the DuckDB oracle queries (tests and the driver check).

The oracle is independent SQL over the same parquet tables.  Two helpers keep
its numbers comparable with Spark bit for bit:

* ``rnd``: Spark rounds a DOUBLE by taking its shortest decimal text and
  rounding that HALF_UP; DuckDB's ``round(double)`` scales in binary.  The
  helper rounds the decimal text in DuckDB too.
* ``dbl`` / ``div``: exact sums are cast to DOUBLE right before a division,
  the same single rounding step the library performs.
"""

from __future__ import annotations

import datetime as dt


def d(ref: dt.date | str) -> str:
    return f"DATE '{ref}'"


def since(ref, days: int, ts: str = "ts") -> str:
    """``ts >= ref - days``."""
    return f"{ts} >= ({d(ref)} - INTERVAL {days} DAY)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def div(num: str, den: str) -> str:
    """``num / NULLIF(den, 0)`` in double."""
    return f"({dbl(num)} / {dbl(f'NULLIF({den}, 0)')})"


def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def moments_stddev(n: str, s1: str, s2: str) -> str:
    """Sample stddev from exact count / sum / sum of squares (same steps as the library)."""
    nn, a, b = (f"CAST({x} AS DECIMAL(38,0))" for x in (n, s1, s2))
    return (f"CASE WHEN {n} >= 2 THEN sqrt({dbl(f'{nn} * {b} - {a} * {a}')} / "
            f"{dbl(f'{nn} * ({nn} - 1)')}) END")


def with_adapter(body_ctes: str, select: str, **relations: str) -> str:
    """``select`` over the adapter's relations; ``relations`` are queries that replace some (``mk_x`` is then the one before)."""
    from marketlens.sources.testdata import ADAPTER_SQL

    for name, query in relations.items():
        body_ctes = f"other_{name} AS ({query}),\n" + body_ctes.replace(f"mk_{name}", f"other_{name}")
    return f"WITH {ADAPTER_SQL},\n{body_ctes}\n{select}"
