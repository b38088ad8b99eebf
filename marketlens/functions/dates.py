"""Reference dates: one snapshot, or many in one job.

``as_of`` attaches every fact row to the reference dates it belongs to
(``ts < ref``, or ``ts <= ref`` when ``inclusive``) and names that column
``dtRef``.  With one date it is a filter plus a literal column, so Catalyst
folds the date into every horizon predicate and pushes ``ts < ref`` into
the Parquet scan.  With many dates the dates are a literal array on each
row: ``explode(dates)`` then ``ts < dtRef`` -- a generator in the same
stage as the scan, no join and no shuffle, and the partial aggregation that
follows runs before any exchange.  Builders reduce facts to a date-free grain
first, where the features allow it, and attach the dates to that.  The array
is built from driver-side parameters.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.horizons import REF

DateLike = str | dt.date | dt.datetime


def to_date(d: DateLike) -> dt.date:
    """A reference date is a day: a time of day other than midnight is an error, not cut off."""
    if isinstance(d, str):
        d = dt.datetime.fromisoformat(d.strip())
    if isinstance(d, dt.datetime):
        if d.time() != dt.time.min:
            raise ValueError(f"reference dates are days; {d} has a time")
        return d.date()
    return d


def snapshot_dates(refs: DateLike | Iterable[DateLike]) -> tuple[dt.date, ...]:
    if isinstance(refs, (str, dt.date, dt.datetime)):
        refs = [refs]
    dates = tuple(sorted({to_date(r) for r in refs}))
    if not dates:
        raise ValueError("at least one reference date is required")
    return dates


def month_starts(first: DateLike, last: DateLike) -> list[dt.date]:
    """Calendar month starts from ``first`` to ``last`` inclusive (a parameter, not data)."""
    a, b = to_date(first).replace(day=1), to_date(last)
    out = []
    while a <= b:
        out.append(a)
        a = (a.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return out


def literal_array(values: Iterable, kind: str) -> Column:
    """An array in one literal, folded once when the plan is optimised, whatever its length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def as_of(df: DataFrame, ts: str, refs: DateLike | Iterable[DateLike], inclusive: bool = False) -> DataFrame:
    dates = snapshot_dates(refs)
    t = F.col(ts)
    last = F.lit(dates[-1])
    df = df.where(t <= last if inclusive else t < last)
    if len(dates) == 1:
        return df.withColumn(REF, last)
    # explode the literal array, then filter: both stay in generated code (a
    # lambda inside filter() would be interpreted per element).
    ref = F.col(REF)
    df = df.withColumn(REF, F.explode(literal_array(dates, "date")))
    return df.where(t <= ref if inclusive else t < ref)


def keep_ref(df: DataFrame, refs: DateLike | Iterable[DateLike], with_ref: bool) -> DataFrame:
    """``df`` with ``dtRef`` or without; rows of several dates cannot go without."""
    if not with_ref and len(snapshot_dates(refs)) > 1:
        raise ValueError("several reference dates need with_ref=True")
    return df if with_ref else df.drop(REF)
