"""Service-level series over a log of processing outcomes.

The log has ``ts``, ``outcome`` and ``duration_s``.  Sliding windows are built
from panes as in the snapshot operator: every row is combined once per pane,
and only panes are copied to the evaluations they belong to.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from linkwatch.functions.numeric import at_least_zero, count_true
from linkwatch.functions.temporal import (
    MICROS,
    Cadence,
    TickSpan,
    clock,
    explode_ticks,
    seconds_between,
    timestamp_of,
)

GOOD = ("valid", "duplicate")
CLAMP = 0.000001
ERROR_BUDGET = 0.01
FIRING, ENDED = "firing", "ended"
# Upper bounds of the duration histogram, in seconds.
BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def sliding(log: DataFrame, cadence: Cadence, measures: dict[str, Column], keys=()) -> DataFrame:
    """Sums of additive measures over ``(tick - lookback, tick]``."""
    panes = log.groupBy(*keys, cadence.pane("ts").alias("pane_us")).agg(
        *[value.alias(name) for name, value in measures.items()]
    )
    ticks = panes.withColumn("tick_us", F.explode(cadence.ticks_of("pane_us")))
    return ticks.groupBy(*keys, "tick_us").agg(*[F.sum(m).alias(m) for m in measures])


def on_spine(series: DataFrame, spark, span: TickSpan, cadence: Cadence, fill: Sequence[str]):
    """Add the evaluations with no traffic, their measures zero."""
    seed = spark.range(1).select(F.lit(0).alias("_"))
    ticks = explode_ticks(seed, span.first, span.last, cadence.step_us).select("tick_us")
    joined = ticks.join(series, "tick_us", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in fill})


def success_counts(log: DataFrame, cadence: Cadence) -> DataFrame:
    return sliding(
        log,
        cadence,
        {"good": count_true(F.col("outcome").isin(*GOOD)), "total": F.count(F.lit(1))},
    )


def success_ratio(counts: DataFrame, cadence: Cadence) -> DataFrame:
    """Ratio of rates with the denominator kept off zero."""
    width = F.lit(float(cadence.lookback))
    return counts.select(
        timestamp_of("tick_us").alias("ts"),
        "good",
        "total",
        (
            (F.col("good") / width) / F.greatest(F.col("total") / width, F.lit(CLAMP))
        ).alias("success_ratio"),
    )


def burn(ratios: DataFrame, budget: float = ERROR_BUDGET) -> DataFrame:
    value = (F.lit(1.0) - F.col("success_ratio")) / F.lit(budget)
    return ratios.withColumn("burn", F.greatest(F.lit(0.0), value))


def duration_quantile(log: DataFrame, cadence: Cadence, q: float = 0.95) -> DataFrame:
    """Quantile from cumulative duration buckets, linear inside a bucket.

    Bucket counts add up over panes, which exact samples would not.
    """
    measures = {
        f"le_{i}": count_true(F.col("duration_s") <= bound) for i, bound in enumerate(BUCKETS)
    }
    measures["total"] = F.count("duration_s")
    rows = sliding(log, cadence, measures)
    rank = F.lit(q) * F.col("total")
    value = F.when(F.col("total") == 0, F.lit(None).cast("double"))
    lower_bound, lower_count = F.lit(0.0), F.lit(0)
    for i, bound in enumerate(BUCKETS):
        here = F.col(f"le_{i}")
        inside = lower_bound + (F.lit(bound) - lower_bound) * F.try_divide(
            rank - lower_count, (here - lower_count).cast("double")
        )
        value = value.when(here >= rank, inside)
        lower_bound, lower_count = F.lit(bound), here
    return rows.select(
        timestamp_of("tick_us").alias("ts"),
        F.col("total").alias("samples"),
        value.otherwise(F.lit(BUCKETS[-1])).alias("quantile_s"),
    )


def freshness(log: DataFrame, now) -> DataFrame:
    """Seconds since the last success, never negative."""
    last = F.max(F.when(F.col("outcome").isin(*GOOD), F.col("ts")))
    return log.agg(last.alias("last_success_at")).withColumn(
        "freshness_seconds", at_least_zero(seconds_between(clock(now), "last_success_at"))
    )


def consumer_lag(source: DataFrame, committed: DataFrame) -> DataFrame:
    """Records not yet committed, per partition; both sides reduce to one row per
    partition before they meet."""
    keys = ["source_topic", "source_partition"]
    end = source.groupBy(*keys).agg((F.max("source_offset") + 1).alias("end_offset"))
    done = committed.groupBy(*keys).agg((F.max("source_offset") + 1).alias("committed_offset"))
    return (
        end.join(done, keys, "left")
        .withColumn("committed_offset", F.coalesce("committed_offset", F.lit(0).cast("bigint")))
        .withColumn(
            "lag", F.greatest(F.lit(0), F.col("end_offset") - F.col("committed_offset"))
        )
    )


def total_lag(lags: DataFrame) -> DataFrame:
    return lags.agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("consumer_lag"))


def growth(log: DataFrame, cadence: Cadence, outcome: str) -> DataFrame:
    """Evaluations at which the outcome occurred within the lookback."""
    rows = sliding(log.where(F.col("outcome") == outcome), cadence, {"n": F.count(F.lit(1))})
    return rows.where("n > 0").select(
        timestamp_of("tick_us").alias("ts"), F.col("n").alias("increase")
    )


def throughput(log: DataFrame, cadence: Cadence) -> DataFrame:
    rows = sliding(log, cadence, {"n": F.count(F.lit(1))}, keys=("outcome",))
    return rows.select(
        "outcome",
        timestamp_of("tick_us").alias("ts"),
        (F.col("n") / F.lit(float(cadence.lookback))).alias("records_per_second"),
    )


def sustained(
    series: DataFrame, condition: Column, hold: float, step: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Stretches of consecutive evaluations at which a condition held for ``hold``.

    Stretches are found inside each day, in parallel, and only those touching a
    day's edge are stitched afterwards, so a long series is never one task.
    Returns pending_since, firing_at, last_true_at and the number of
    evaluations.
    """
    step_us, hold_us = round(step * MICROS), round(hold * MICROS)
    day_us = max(86_400 * MICROS // step_us, 1) * step_us
    at = F.unix_micros("ts")
    true_rows = series.where(condition).select(
        *keys, at.alias("at"), (at - F.pmod(at, F.lit(day_us))).alias("day")
    )
    inside = Window.partitionBy(*keys, "day").orderBy("at")
    pieces = (
        true_rows.withColumn("n", F.row_number().over(inside))
        .withColumn("run", F.col("at") - F.col("n").cast("bigint") * F.lit(step_us))
        .groupBy(*keys, "day", "run")
        .agg(F.min("at").alias("a"), F.max("at").alias("b"), F.count(F.lit(1)).alias("n"))
    )
    edge = (F.col("a") - F.col("day") < step_us) | (
        F.col("day") + F.lit(day_us) - F.col("b") <= step_us
    )
    whole = pieces.where(~edge).select(*keys, "a", "b", "n")
    across = Window.partitionBy(*keys).orderBy("a") if keys else Window.orderBy("a")
    stitched = (
        pieces.where(edge)
        .withColumn(
            "new", F.coalesce(F.col("a") - F.lag("b").over(across) != step_us, F.lit(True))
        )
        .withColumn("island", F.sum(F.col("new").cast("int")).over(across))
        .groupBy(*keys, "island")
        .agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
        .select(*keys, "a", "b", "n")
    )
    held = whole.unionByName(stitched).where(F.col("b") - F.col("a") >= hold_us)
    wait = F.ceil(F.lit(hold_us) / F.lit(step_us)) * F.lit(step_us)
    return held.select(
        *keys,
        timestamp_of("a").alias("pending_since"),
        timestamp_of(F.col("a") + wait).alias("firing_at"),
        timestamp_of("b").alias("last_true_at"),
        F.col("n").alias("evaluations"),
    )


def alert_events(stretches: DataFrame, last: Column, step: float, keys: Sequence[str] = ()):
    """What ``sustained`` stretches mean to who is told: an alert fires once its
    condition has held, and ends at the first evaluation without it, if there
    was one by ``last`` (epoch microseconds)."""
    step_us = round(step * MICROS)
    since, fires, true_at = (
        F.unix_micros(c) for c in ("pending_since", "firing_at", "last_true_at")
    )
    shared = [*keys, "pending_since"]
    fired = stretches.select(
        F.lit(FIRING).alias("kind"),
        F.col("firing_at").alias("at"),
        *shared,
        F.col("firing_at").alias("last_true_at"),
        ((fires - since) / F.lit(step_us) + 1).cast("bigint").alias("evaluations"),
    )
    ended = stretches.where(true_at < last).select(
        F.lit(ENDED).alias("kind"),
        timestamp_of(true_at + F.lit(step_us)).alias("at"),
        *shared,
        "last_true_at",
        "evaluations",
    )
    return fired.unionByName(ended)
