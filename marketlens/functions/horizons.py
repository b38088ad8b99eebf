"""Trailing horizons and the as-of reference date.

A horizon of ``n`` days admits facts with ``ts >= ref - n days`` (calendar
days, midnight bound); the lifetime horizon has no lower bound.  The upper
bound (``ts < ref``) is applied once, when facts are attached to their
reference dates (:func:`marketlens.functions.dates.as_of`).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

REF = "dtRef"


@dataclass(frozen=True)
class Horizon:
    name: str
    days: int | None = None  # None: lifetime

    @property
    def lifetime(self) -> bool:
        return self.days is None


def make(*spec: tuple[str, int | None]) -> tuple[Horizon, ...]:
    return tuple(Horizon(name, days) for name, days in spec)


def ref_col() -> Column:
    return F.col(REF)


def window_start(h: Horizon, ref: Column | None = None) -> Column:
    return F.date_sub(ref if ref is not None else ref_col(), h.days)


def in_horizon(ts: str | Column, h: Horizon, ref: Column | None = None) -> Column:
    """``ts >= ref - h`` (always true for lifetime)."""
    if h.lifetime:
        return F.lit(True)
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts >= window_start(h, ref)


def within(h: Horizon, ts: str | Column, value: Column, otherwise: Column | int | None = None,
           ref: Column | None = None) -> Column:
    """``CASE WHEN ts in h THEN value [ELSE otherwise] END``; lifetime: ``value``."""
    if h.lifetime:
        return value
    expr = F.when(in_horizon(ts, h, ref), value)
    if otherwise is not None:
        expr = expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
    return expr
