"""UTC text, day ranges and evaluation-tick arithmetic."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch.functions.numeric import col

MICROS = 1_000_000


def micros(value: Column | str) -> Column:
    return F.unix_micros(col(value))


def timestamp_of(value: Column | str) -> Column:
    return F.timestamp_micros(col(value))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(1e6)


def millis_between(later: Column | str, earlier: Column | str) -> Column:
    return (micros(later) - micros(earlier)).cast("double") / F.lit(1e3)


def clock(value: dt.datetime | Column | str) -> Column:
    """A fixed instant as a literal; columns pass through."""
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=dt.timezone.utc)
        delta = value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        return F.timestamp_micros(F.lit(delta // dt.timedelta(microseconds=1)))
    return col(value)


def _with_fraction(value: Column, suffix: str) -> Column:
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.pmod(micros(value), F.lit(MICROS))
    return F.when(
        part == 0, F.concat(whole, F.lit(suffix))
    ).otherwise(F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(suffix)))


def utc_text(value: Column | str) -> Column:
    """ISO text ending in Z; microseconds only when they are not zero."""
    return _with_fraction(col(value), "Z")


def iso_text(value: Column | str) -> Column:
    """ISO text ending in +00:00; microseconds only when they are not zero."""
    return _with_fraction(col(value), "+00:00")


def utc_date(value: Column | str) -> Column:
    return F.to_date(col(value))


def in_days(value: Column | str, first: dt.date, last: dt.date) -> Column:
    """Inclusive day range as a half-open timestamp range.

    The bounds are literals and the column stays bare, so the predicate reaches
    the file scan.
    """
    start = dt.datetime.combine(first, dt.time(), dt.timezone.utc)
    end = dt.datetime.combine(last + dt.timedelta(days=1), dt.time(), dt.timezone.utc)
    return (col(value) >= F.lit(start)) & (col(value) < F.lit(end))


@dataclass(frozen=True)
class Cadence:
    """Evaluations every ``step`` seconds over the ``lookback`` seconds before.

    A tick at T covers ``(T - lookback, T]``.  Rows are first folded into panes
    of ``gcd(lookback, step)`` seconds, so what is copied to several ticks is a
    pane, not an observation.
    """

    lookback: float
    step: float

    def __post_init__(self) -> None:
        if self.lookback <= 0 or self.step <= 0:
            raise ValueError("lookback and step must be positive")

    @property
    def lookback_us(self) -> int:
        return round(self.lookback * MICROS)

    @property
    def step_us(self) -> int:
        return round(self.step * MICROS)

    @property
    def pane_us(self) -> int:
        return math.gcd(self.lookback_us, self.step_us)

    def pane(self, event_time: Column | str) -> Column:
        """End of the pane holding this instant, in epoch microseconds."""
        before = micros(event_time) - F.lit(1)
        return before - F.pmod(before, F.lit(self.pane_us)) + F.lit(self.pane_us)

    def ticks_of(self, pane: Column | str) -> Column:
        """All ticks whose lookback covers the pane, in epoch microseconds."""
        end = col(pane)
        step = F.lit(self.step_us)
        first = end + F.pmod(-end, step)
        reach = end + F.lit(self.lookback_us - self.pane_us)
        last = reach - F.pmod(reach, step)
        return F.when(first <= last, F.sequence(first, last, step)).otherwise(
            F.array().cast("array<bigint>")
        )

    def tick_at_or_after(self, value: Column | str) -> Column:
        us = micros(value)
        return us + F.pmod(-us, F.lit(self.step_us))


def explode_ticks(df: DataFrame, first: Column, last: Column, step_us: int) -> DataFrame:
    """Copy each row to every tick from ``first`` to ``last`` as ``tick_us``.

    Unfolds a day at a time, so no array grows with the length of the range;
    rows with ``first > last`` yield nothing.
    """
    day = max(86_400 * MICROS // step_us, 1) * step_us
    none = F.array().cast("array<bigint>")

    def run(start: Column, end: Column, by: int) -> Column:
        return F.when(start <= end, F.sequence(start, end, F.lit(by))).otherwise(none)

    days = df.withColumns({"_last": last, "_day": F.explode(run(first, last, day))})
    stop = F.least(F.col("_last"), F.col("_day") + F.lit(day - step_us))
    return days.withColumn(
        "tick_us", F.explode(F.sequence(F.col("_day"), stop, F.lit(step_us)))
    ).drop("_last", "_day")


@dataclass(frozen=True)
class TickSpan:
    """First and last evaluation tick, in epoch microseconds."""

    first: Column
    last: Column

    @classmethod
    def between(cls, start: dt.datetime, end: dt.datetime, cadence: Cadence) -> TickSpan:
        step = cadence.step_us
        zero = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
        one = dt.timedelta(microseconds=1)
        first = -(-((start - zero) // one) // step) * step
        last = ((end - zero) // one) // step * step
        return cls(F.lit(first), F.lit(last))

    @classmethod
    def covering(cls, rows: DataFrame, time_column: str, cadence: Cadence) -> TickSpan:
        """Ticks from the first row's to the last row's, as scalar subqueries."""
        bounds = rows.agg(
            cadence.tick_at_or_after(F.min(time_column)).alias("first"),
            cadence.tick_at_or_after(F.max(time_column)).alias("last"),
        )
        return cls(bounds.select("first").scalar(), bounds.select("last").scalar())
