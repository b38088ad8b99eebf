"""Trailing sums at many reference dates from daily partial sums.

A fact counts at the dates after its day, and in a horizon of n days until n
days later: at a sorted list of dates that is one date at which it comes and
one for each finite horizon at which it goes.  ``dated_sums`` adds facts up by
key and day, writes each day's sums as such comings and goings, adds them up
by key and date, and a running sum over the dates of a key gives every horizon
at every date.  No fact is copied for every date; the only rows that are made
for each date are the result's.

A date's number is looked up by the day's distance from the first date in one
literal array, which is as long as the calendar between the dates, so the plan
has the same size for any number of dates.
"""

from __future__ import annotations

import bisect
import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.dates import DateLike, literal_array, snapshot_dates
from marketlens.functions.horizons import REF, Horizon
from marketlens.functions.skew import deal


@dataclass(frozen=True)
class Spine:
    """Sorted reference dates, numbered from 0."""

    dates: tuple[dt.date, ...]

    @staticmethod
    def of(refs: DateLike | Iterable[DateLike]) -> Spine:
        return Spine(snapshot_dates(refs))

    def first_after(self, day: Column) -> Column:
        """Number of the first date after ``day``; the number of dates if there is none."""
        first, last, n = self.dates[0], self.dates[-1], len(self.dates)
        if n == 1:
            return F.when(day < F.lit(first), 0).otherwise(1)
        days = range((last - first).days)
        numbers = literal_array((bisect.bisect_right(self.dates, first + dt.timedelta(d)) for d in days), "int")
        at = F.least(F.greatest(F.datediff(day, F.lit(first)), F.lit(0)), F.lit(len(days) - 1))
        return (F.when(day < F.lit(first), 0).when(day >= F.lit(last), n).otherwise(F.element_at(numbers, at + 1)))

    def all(self) -> Column:
        """Every date, in an array."""
        return literal_array(self.dates, "date")

    def date(self, number: Column) -> Column:
        if len(self.dates) == 1:
            return F.lit(self.dates[0])
        return F.element_at(self.all(), (number + 1).cast("int"))

    def running(self, changes: DataFrame, key: Sequence[str], number: str, sums: Sequence[str]) -> DataFrame:
        """(dtRef, ``key``, ``sums``): running sums of changes by key and number, at every date from a key's first change on."""
        line = Window.partitionBy(*key).orderBy(number)
        until = F.coalesce(F.lead(number).over(line), F.lit(len(self.dates)))
        states = changes.select(*key, F.col(number).alias("__number"), until.alias("__until"),
                                *[F.sum(c).over(line).alias(c) for c in sums])
        found = states.withColumn("__number", F.explode(F.sequence("__number", F.col("__until") - 1)))
        return found.select(self.date(F.col("__number")).alias(REF), *key, *sums)


def sum_name(measure: str, h: Horizon) -> str:
    return f"{measure}_{h.name}"


def dated_sums(facts: DataFrame, key: Sequence[str], measures: Sequence[str] | Mapping[str, Sequence[Horizon]],
               horizons: Sequence[Horizon], refs: DateLike | Iterable[DateLike], day: str = "day",
               after: str | None = None, days_before: Sequence[Horizon] | None = None, by: Sequence[str] | None = None,
               dealt: bool = False) -> DataFrame:
    """(dtRef, ``key``, ``measure_horizon``...): sums of whole-number measures at every date after a key's first fact.

    ``day`` is the fact's day: horizon h of date r holds days >= r - h.
    ``after`` is the last day on which the fact does not count yet (default:
    ``day``, so a fact counts from the next day on).  Null measures add
    nothing; a sum without facts is 0.  A mapping gives a measure horizons of
    its own.  ``by``: columns of the key that the daily sums are dealt by, so
    that an aggregate by these needs no other exchange.  ``dealt``: the facts
    come dealt by a column of the key and stay where they are.
    """
    spine, key = Spine.of(refs), list(key)
    wanted = dict(measures) if isinstance(measures, Mapping) else {m: horizons for m in measures}
    after = after or day
    facts = facts.where(F.col(after) < F.lit(spine.dates[-1]))
    names = [sum_name(m, h) for m, own in wanted.items() for h in own]
    value = lambda m: F.coalesce(F.col(m), F.lit(0))
    edges = [h for h in days_before or () if not h.lifetime]
    ends = [] if days_before is None else ["first", "last", *(f"before_{h.name}" for h in edges)]
    if len(spine.dates) == 1:
        ref = F.lit(spine.dates[0])
        sums = [F.sum(value(m) if h.lifetime else F.when(F.col(day) >= F.date_sub(ref, h.days), value(m)).otherwise(0))
                .cast("long").alias(sum_name(m, h)) for m, own in wanted.items() for h in own]
        if ends:
            sums += [F.min(day).alias("first"), F.max(day).alias("last")]
            sums += [F.max(F.when(F.col(day) < F.date_sub(ref, h.days), F.col(day))).alias(f"before_{h.name}") for h in edges]
        found = facts.groupBy(*key).agg(*sums)
        return (deal(found, *by) if by and not dealt else found).select(ref.alias(REF), *key, *names, *ends)
    days = [day] if after == day else [day, after]
    if not ends:  # older days are alike at every date
        oldest = F.date_sub(F.lit(spine.dates[0]), max((h.days for own in wanted.values() for h in own if not h.lifetime), default=0) + 1)
        facts = facts.withColumns({c: F.greatest(F.col(c), oldest) for c in days})
    lengths = sorted({h.days for own in (*wanted.values(), edges) for h in own if not h.lifetime})
    if dealt:  # to sum up days first would spare no exchange
        daily = facts.select(*key, *days, *[value(m).cast("long").alias(m) for m in wanted])
    else:
        daily = facts.groupBy(*key, *days).agg(*[F.sum(value(m)).cast("long").alias(m) for m in wanted])
        daily = deal(daily, *(by or key))  # into all partitions: a few bytes here are rows for many dates above
    # Numbers of the date at which a fact comes, and of those at which it goes from the horizons of each length.  It
    # never counts in horizons that it leaves before a date has seen it: those shorter than ``__least``.
    numbered = daily.select(*key, *wanted, *([day] if ends else []), spine.first_after(F.col(after)).cast("int").alias("__come"),
                            *[spine.first_after(F.date_add(day, n)).cast("int").alias(f"__go_{n}") for n in lengths])
    least = F.coalesce(*[F.when(F.col(f"__go_{n}") > F.col("__come"), n) for n in lengths], F.lit(1 << 30))
    # A move is one whole number: that of the date, and 0 for a coming or the place of the length for a going.
    kinds = len(lengths) + 1
    moves = [F.col("__come") * kinds]
    for i, n in enumerate(lengths, 1):
        seen = F.lit(True) if ends else F.col("__least") <= n
        moves.append(F.when(seen, F.col(f"__go_{n}") * kinds + i))
    events = numbered.select("*", least.alias("__least")).select(
        *key, *wanted, *([day] if ends else []), "__least", F.explode(F.array(*moves)).alias("__move"))
    events = events.where(F.col("__move") < len(spine.dates) * kinds).withColumns({
        "__number": F.floor(F.col("__move") / kinds).cast("int"),
        "__length": F.element_at(literal_array([0, *lengths], "int"), F.col("__move") % kinds + 1)}).drop("__move")
    comes, length = F.col("__length") == 0, F.col("__length")
    sign = {n: F.when(comes, (F.col("__least") <= n).cast("int")).when((length == n) & (F.col("__least") <= n), -1).otherwise(0)
            for n in lengths}
    events = events.select("*", comes.cast("int").alias("__sign_None"), *[c.alias(f"__sign_{n}") for n, c in sign.items()])
    sums = [F.sum(F.col(f"__sign_{h.days}") * F.col(m)).alias(sum_name(m, h)) for m, own in wanted.items() for h in own]
    line = Window.partitionBy(*key).orderBy("__number")
    running = [F.sum(n).over(line).alias(n) for n in names]
    if ends:
        at = lambda n: F.when(length == n, F.col(day))
        sums += [F.min(at(0)).alias("first"), F.max(at(0)).alias("last")]
        sums += [F.max(at(h.days)).alias(f"before_{h.name}") for h in edges]
        running += [F.min("first").over(line).alias("first"), *[F.max(n).over(line).alias(n) for n in ends[1:]]]
    events = events.groupBy(*key, "__number").agg(*sums)
    until = F.coalesce(F.lead("__number").over(line), F.lit(len(spine.dates)))
    states = events.select(*key, "__number", until.alias("__until"), *running)
    found = states.withColumn("__number", F.explode(F.sequence("__number", F.col("__until") - 1)))
    return found.select(spine.date(F.col("__number")).alias(REF), *key, *names, *ends)
