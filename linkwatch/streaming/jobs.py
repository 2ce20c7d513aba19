"""The two streaming queries over measurement records, and how they are run."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from linkwatch import schemas as S
from linkwatch.operators.validate import split
from linkwatch.operators.windows import window_metrics
from linkwatch.sources import sinks

log = logging.getLogger(__name__)
WriteBatch = Callable[[DataFrame, int], None]


def start_query(
    rows: DataFrame,
    write_batch: WriteBatch,
    *,
    name: str,
    checkpoint: str,
    mode: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Start a query; without a trigger interval it drains what is there and stops."""
    writer = (
        rows.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_measurement_queries(
    records: DataFrame,
    out: str,
    *,
    delay: str = S.WATERMARK,
    trigger: str | None = None,
    largest: int | None = None,
    now=None,
    dedup: bool = False,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Window metrics in update mode and rejects in append mode, each with its
    own checkpoint below ``out``."""
    valid, invalid = split(records, now)
    metrics = start_query(
        window_metrics(valid, delay, dedup=dedup),
        sinks.metrics_writer(f"{out}/metrics", f"{out}/ledger", largest),
        name="window-metrics",
        checkpoint=f"{out}/checkpoints/metrics",
        mode="update",
        trigger=trigger,
    )
    rejects = start_query(
        invalid,
        sinks.rejects_writer(f"{out}/rejects", f"{out}/ledger", largest),
        name="invalid-measurements",
        checkpoint=f"{out}/checkpoints/rejects",
        mode="append",
        trigger=trigger,
    )
    return metrics, rejects


class ProgressLog(StreamingQueryListener):
    """One structured log line per finished trigger."""

    def onQueryStarted(self, event) -> None:
        log.info("query started %s", event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        log.info(
            json.dumps(
                {
                    "query": p.name,
                    "batch_id": p.batchId,
                    "input_rows": p.numInputRows,
                    "input_rows_per_second": p.inputRowsPerSecond,
                    "processed_rows_per_second": p.processedRowsPerSecond,
                    "event_time": dict(p.eventTime or {}),
                    "state": [
                        {
                            "rows": s.numRowsTotal,
                            "updated": s.numRowsUpdated,
                            "dropped_late": s.numRowsDroppedByWatermark,
                        }
                        for s in p.stateOperators
                    ],
                }
            )
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("query ended %s", event.id)
