"""Event-time window metrics, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.functions.numeric import count_true, exact_mean, ratio

GROUP = ("agent_id", "target_id", "measurement_type")
PERCENTILES = (0.5, 0.95, 0.99)
ACCURACY = 10_000


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("event_count"),
        count_true(F.col("success")).alias("success_count"),
        F.min("latency_ms").alias("latency_min_ms"),
        F.max("latency_ms").alias("latency_max_ms"),
        exact_mean("latency_ms").alias("latency_mean_ms"),
        F.stddev_pop("latency_ms").alias("latency_stddev_ms"),
        F.percentile_approx("latency_ms", list(PERCENTILES), ACCURACY).alias("percentiles"),
        exact_mean("jitter_ms").alias("jitter_mean_ms"),
        exact_mean("packet_loss_pct").alias("packet_loss_mean_pct"),
        exact_mean("ingestion_latency_ms").alias("ingestion_latency_mean_ms"),
    ]


def _layout(grouped: DataFrame, start: Column, end: Column, size: Column) -> DataFrame:
    events, successes = F.col("event_count"), F.col("success_count")
    return grouped.select(
        start.alias("window_start"),
        end.alias("window_end"),
        size.alias("window_size_seconds"),
        *GROUP,
        "event_count",
        "success_count",
        (events - successes).alias("failure_count"),
        ratio(successes, events, 100.0).alias("success_rate_pct"),
        "latency_min_ms",
        "latency_max_ms",
        "latency_mean_ms",
        "latency_stddev_ms",
        *[
            F.col("percentiles")[i].alias(f"latency_p{int(p * 100)}_ms")
            for i, p in enumerate(PERCENTILES)
        ],
        "jitter_mean_ms",
        "packet_loss_mean_pct",
        "ingestion_latency_mean_ms",
        F.current_timestamp().alias("calculated_at"),
    )


def _one_pass(rows: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """All sizes from a single scan: each row is copied to one window per size
    and combined in the task that read it, before anything is shuffled."""
    at = F.unix_micros("event_time")

    def start(seconds: int) -> Column:
        return at - F.pmod(at, F.lit(seconds * 1_000_000))

    windows = F.array(
        *[
            F.struct(F.lit(s).alias("size"), start(s).alias("start"))
            for s in sizes.values()
        ]
    )
    needed = ("success", "latency_ms", "jitter_ms", "packet_loss_pct", "ingestion_latency_ms")
    copied = rows.select(*GROUP, *needed, F.explode(windows).alias("w")).select(
        "*", F.col("w.size").alias("size"), F.col("w.start").alias("start_us")
    )
    grouped = copied.groupBy("size", "start_us", *GROUP).agg(*_measures())
    end = F.col("start_us") + F.col("size").cast("bigint") * F.lit(1_000_000)
    return _layout(
        grouped, F.timestamp_micros("start_us"), F.timestamp_micros(end), F.col("size")
    )


def _per_size(rows: DataFrame, sizes: Mapping[str, int]) -> DataFrame:
    """One aggregate per size.  A stream needs this form: only a native window
    carries the watermark that evicts state and drops late rows."""
    result = None
    for duration, seconds in sizes.items():
        grouped = rows.groupBy(F.window("event_time", duration).alias("w"), *GROUP).agg(
            *_measures()
        )
        part = _layout(grouped, F.col("w.start"), F.col("w.end"), F.lit(seconds))
        result = part if result is None else result.unionByName(part)
    return result


def window_metrics(
    rows: DataFrame,
    delay: str | None = None,
    sizes: Mapping[str, int] = S.WINDOW_SIZES,
    dedup: bool = False,
) -> DataFrame:
    """Metrics per (window, agent, target, type) for every window size.

    ``dedup`` drops repeated event ids first; the default counts every record.
    """
    if rows.isStreaming:
        rows = rows.withWatermark("event_time", delay or S.WATERMARK)
        if dedup:
            rows = rows.dropDuplicatesWithinWatermark(["event_id"])
        return _per_size(rows, sizes)
    if dedup:
        rows = rows.dropDuplicates(["event_id"])
    return _one_pass(rows, sizes)
