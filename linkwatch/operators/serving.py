"""Dashboard series and keyset pages."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.operators.daily import GRAIN
from linkwatch.operators.views import live_measurements

LONGEST_RANGE_DAYS = 366
LARGEST_PAGE = 200


def _between(start, end) -> Column:
    return (F.col("event_time") >= F.lit(start)) & (F.col("event_time") <= F.lit(end))


def _series(rows: DataFrame, value: Column) -> DataFrame:
    label = F.concat_ws(" / ", "agent_id", "target_id", "measurement_type")
    return rows.select(
        F.col("event_time").alias("time"), value.alias("value"), label.alias("metric")
    )


def daily_success_series(view: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return (
        view.where(F.col("date_utc").between(first, last))
        .select(
            F.col("date_utc").alias("time"),
            F.col("success_rate_pct").alias("value"),
            F.col("agent_id").alias("metric"),
        )
        .orderBy("time")
    )


def live_latency_series(measurements: DataFrame, start, end) -> DataFrame:
    rows = live_measurements(measurements.where(_between(start, end)))
    return _series(rows.where(F.col("latency_ms").isNotNull()), F.col("latency_ms")).orderBy("time")


def live_loss_series(measurements: DataFrame, start, end) -> DataFrame:
    rows = live_measurements(measurements.where(_between(start, end)))
    pings = rows.where(F.col("measurement_type").isin("router_ping", "external_ping"))
    return _series(pings, F.col("packet_loss_pct")).orderBy("time")


def live_success_series(measurements: DataFrame, start, end) -> DataFrame:
    rows = live_measurements(measurements.where(_between(start, end)))
    value = F.when(F.col("success"), F.lit(100.0)).otherwise(F.lit(0.0))
    return _series(rows, value).orderBy("time")


def latest_readings(measurements: DataFrame, start, end, limit: int = 100) -> DataFrame:
    """Newest readings; ties are settled by the remaining columns, so a rerun agrees."""
    rows = live_measurements(measurements.where(_between(start, end)))
    rest = [c for c in rows.columns if c != "event_time"]
    return rows.orderBy(F.desc("event_time"), *rest).limit(limit)


def agent_freshness(status: DataFrame) -> DataFrame:
    return status.orderBy("agent_id")


def current_incidents(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.desc("start_time"), "incident_id")


def latest_or_sentinel(status: DataFrame) -> DataFrame:
    """The newest workflow run, or one ``no_runs`` row when there is none."""
    shown = (
        "status",
        "source_status",
        "from_date",
        "through_date",
        "attempt_count",
        "source_observation_count",
        "daily_mismatch_rows",
        "incident_mismatch_rows",
        "failed_task_id",
        "error_type",
        "started_at",
        "completed_at",
        "duration_seconds",
    )
    newest = status.orderBy(F.desc("started_at"), "run_key").limit(1).select(*shown)
    kinds = dict(newest.dtypes)
    blank = {
        "status": F.lit("no_runs"),
        "source_status": F.lit("not_applicable"),
        "attempt_count": F.lit(0),
        "source_observation_count": F.lit(0),
    }
    # the aggregate over no rows yields the row that the filter then keeps
    sentinel = status.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        *[blank.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in shown]
    )
    return newest.unionByName(sentinel)


@dataclass(frozen=True)
class PageFilters:
    from_date: dt.date | None = None
    through_date: dt.date | None = None
    agent_id: str | None = None
    endpoint_id: str | None = None
    source_kind: str | None = None
    probe_type: str | None = None

    def __post_init__(self) -> None:
        if (self.from_date is None) != (self.through_date is None):
            raise ValueError("from_date and through_date go together")
        if self.from_date is not None:
            if self.from_date > self.through_date:
                raise ValueError("from_date must not follow through_date")
            if (self.through_date - self.from_date).days + 1 > LONGEST_RANGE_DAYS:
                raise ValueError(f"a range holds at most {LONGEST_RANGE_DAYS} days")
        if self.source_kind is not None and self.source_kind not in S.SOURCE_KINDS:
            raise ValueError(f"source_kind must be one of {S.SOURCE_KINDS}")

    def apply(self, view: DataFrame) -> DataFrame:
        for field in fields(self):
            value = getattr(self, field.name)
            if value is None:
                continue
            if field.name == "from_date":
                view = view.where(F.col("date_utc") >= F.lit(value))
            elif field.name == "through_date":
                view = view.where(F.col("date_utc") <= F.lit(value))
            else:
                view = view.where(F.col(field.name) == F.lit(value))
        return view


@dataclass(frozen=True)
class PageKey:
    """Last row of a page."""

    date_utc: dt.date
    agent_id: str
    endpoint_id: str
    source_kind: str
    probe_type: str

    def after(self) -> Column:
        """Later keys of the same date, or any older date.

        The plain bound on the date is implied; spelled out it prunes
        partitions.
        """
        rest = GRAIN[1:]
        mine = F.struct(*[F.lit(getattr(self, c)).alias(c) for c in rest])
        date = F.lit(self.date_utc)
        return (F.col("date_utc") <= date) & (
            (F.col("date_utc") < date) | (F.struct(*rest) > mine)
        )


def page(
    view: DataFrame,
    filters: PageFilters = PageFilters(),
    after: PageKey | None = None,
    limit: int = 50,
) -> DataFrame:
    """One page, newest date first, with ``has_more`` from one row of look-ahead.

    Only ``limit + 1`` rows leave the top-k, so the row number over them is a
    window over at most 201 rows.
    """
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= LARGEST_PAGE:
        raise ValueError(f"limit must be an integer between 1 and {LARGEST_PAGE}")
    rows = filters.apply(view)
    if after is not None:
        rows = rows.where(after.after())
    order = [F.desc("date_utc"), *[F.asc(c) for c in GRAIN[1:]]]
    top = rows.orderBy(*order).limit(limit + 1)
    packed = top.agg(F.collect_list(F.struct(*top.columns)).alias("rows"))
    in_order = F.array_sort("rows", _page_order)
    return packed.select(
        (F.size("rows") > limit).alias("has_more"),
        F.explode(F.slice(in_order, 1, limit)).alias("r"),
    ).select("r.*", "has_more")


def _page_order(a: Column, b: Column) -> Column:
    newer = a["date_utc"] > b["date_utc"]
    older = a["date_utc"] < b["date_utc"]

    def rest(x: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in GRAIN[1:]])

    return (
        F.when(newer, F.lit(-1))
        .when(older, F.lit(1))
        .when(rest(a) < rest(b), F.lit(-1))
        .when(rest(a) > rest(b), F.lit(1))
        .otherwise(F.lit(0))
    )
