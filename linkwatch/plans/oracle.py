"""The same results in ANSI SQL, for checking on a second engine.

Each name in ``PARTS`` is a common table expression; ``sql`` puts the ones a
query needs, with what they need, in front of it.  The SQL is written from the
definitions (band joins, recursion, direct grouping), not from the Spark plans.
"""

from __future__ import annotations

import re

from linkwatch import schemas as S
from linkwatch.operators.rules import TEXTS

DECIMAL = "DECIMAL(28,6)"


def ts(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def esum(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS {DECIMAL})) AS DOUBLE)"


def emean(expression: str) -> str:
    return f"{esum(expression)} / COUNT({expression})"


def micros(expression: str) -> str:
    return f"epoch_us({expression})"


def uuid5(name: str) -> str:
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"(SELECT substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||"
        f"translate(substr(h,17,1),'0123456789abcdef','89ab89ab89ab89ab')||substr(h,18,3)||'-'||"
        f"substr(h,21,12) FROM (SELECT {digest} AS h))"
    )


def iso(expression: str, suffix: str) -> str:
    return (
        f"CASE WHEN epoch_us({expression}) % 1000000 = 0 "
        f"THEN strftime({expression}, '%Y-%m-%dT%H:%M:%S') "
        f"ELSE strftime({expression}, '%Y-%m-%dT%H:%M:%S.%f') END || '{suffix}'"
    )


def pseudonym(expression: str) -> str:
    return f"'agent_' || substr(sha256('linkwatch-agent-v1' || chr(0) || {expression}), 1, 12)"


def identity(number: str, pairs: int | None) -> str:
    site = f"({number} - {number} % 2) // 2"
    if pairs:
        site = f"({site}) // {pairs}"
    return f"""'site-' || CAST({site} AS VARCHAR) AS site_id,
      CASE WHEN {number} % 2 = 0 THEN 'wired-' ELSE 'wifi-' END || CAST({site} AS VARCHAR) AS agent_id,
      CASE WHEN {number} % 2 = 0 THEN '{S.WIRED}' ELSE '{S.WIFI}' END AS agent_role"""


def telemetry(pairs: int | None) -> dict[str, str]:
    return {
        "base": f"""
    SELECT event_id AS event_no,
      substr(md5(CAST(event_id AS VARCHAR)),1,8)||'-'||substr(md5(CAST(event_id AS VARCHAR)),9,4)||'-4'||
      substr(md5(CAST(event_id AS VARCHAR)),14,3)||'-a'||substr(md5(CAST(event_id AS VARCHAR)),18,3)||'-'||
      substr(md5(CAST(event_id AS VARCHAR)),21,12) AS event_id,
      ts AS event_time, value AS v, k,
      CASE event_type WHEN 'view' THEN 'router_ping' WHEN 'click' THEN 'external_ping'
        WHEN 'purchase' THEN CASE WHEN user_id % 2 = 1 THEN 'wifi_diagnostics'
          WHEN k % 4 = 0 THEN 'speed_test' ELSE 'router_ping' END
        WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'dns' ELSE 'http' END
        ELSE CASE WHEN day(ts) % 10 = 9 AND user_id % 2 = 1 THEN 'router_ping'
          ELSE 'heartbeat' END END AS kind,
      day(ts) % 10 AS sc,
      {identity('user_id', pairs)}
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)""",
        "measurements": f"""
  SELECT event_no, event_id, site_id, agent_id, agent_role, event_time, kind AS measurement_type,
    CASE kind WHEN 'router_ping' THEN 'router' WHEN 'external_ping' THEN 'public-a'
      ELSE 'wifi-interface' END AS target_id,
    success,
    CASE WHEN success AND kind <> 'wifi_diagnostics' THEN
      CASE WHEN sc = 1 AND wifi THEN (CASE WHEN kind = 'external_ping' THEN 145 ELSE 85 END) + v / 100
           WHEN sc = 7 AND kind = 'external_ping' THEN 240 + v / 100
           ELSE v / 10 END END AS latency_ms,
    CAST(CASE WHEN NOT success THEN 100 WHEN kind = 'wifi_diagnostics' THEN 0
         WHEN sc = 1 AND wifi THEN 18 WHEN sc = 8 THEN 35 ELSE 0 END AS DOUBLE) AS packet_loss_pct,
    CASE WHEN success AND kind <> 'wifi_diagnostics' THEN CAST(k AS DOUBLE) / 10 END AS jitter_ms,
    CAST(CASE WHEN success AND kind = 'wifi_diagnostics' THEN
      CASE WHEN sc = 1 THEN -84 ELSE -57 END END AS DOUBLE) AS signal_dbm,
    CASE WHEN kind = 'wifi_diagnostics' THEN success END AS connected,
    CASE WHEN NOT success THEN 'HostUnreachable' END AS error_class, k
  FROM (SELECT *, agent_role = '{S.WIFI}' AS wifi,
          k >= 2 AND sc <> 3 AND NOT (sc = 2 AND agent_role = '{S.WIFI}')
            AND NOT (sc = 4 AND kind = 'external_ping') AS success
        FROM base WHERE kind IN ('router_ping','external_ping','wifi_diagnostics'))""",
        "checks": f"""
  SELECT event_no, event_id, site_id, agent_id, agent_role, event_time, kind AS check_type,
    endpoint_id, success,
    CASE WHEN kind = 'dns' AND success THEN v / 10 END AS lookup_duration_ms,
    CASE WHEN kind = 'http' AND success THEN v / 10 END AS total_duration_ms,
    CASE WHEN kind = 'http' THEN CASE WHEN success THEN 200 ELSE 503 END END AS http_status,
    CASE WHEN NOT success THEN 'CheckFailed' END AS error_class, k
  FROM (SELECT *, k >= 2 AND sc NOT IN (3,4,5) AND NOT (sc = 2 AND agent_role = '{S.WIFI}')
            AND NOT (sc = 6 AND endpoint_id = 'web-a') AS success
        FROM (SELECT *, CASE WHEN kind = 'dns' THEN 'dns-check' WHEN k % 4 = 1 THEN 'web-a'
                ELSE 'web-b' END AS endpoint_id
              FROM base WHERE kind IN ('dns','http')))""",
        "heartbeats": """
  SELECT event_no, event_id, site_id, agent_id, agent_role, event_time, k % 5 AS local_queue_depth,
    CASE WHEN k % 3 = 0 THEN 1 WHEN k % 3 = 1 THEN 0 WHEN k % 5 = 0 THEN NULL ELSE 2 END AS n_errors, k
  FROM base WHERE kind = 'heartbeat'""",
        "speed_tests": """
  SELECT event_no, event_id, site_id, agent_id, agent_role, event_time, k,
    k >= 2 AND sc NOT IN (3,4) AS success, k * 1000 AS bytes_transferred
  FROM base WHERE kind = 'speed_test'""",
        "agents": f"""
  SELECT agent_id, agent_role, site_id, MIN(c_name) AS display_name, MAX(c_acctbal) > 0 AS enabled
  FROM (SELECT c_name, c_acctbal, {identity('c_custkey', pairs)} FROM customer)
  GROUP BY ALL""",
        "endpoints": """
  SELECT * FROM (VALUES ('router','router','Local router',TRUE), ('public-a','external_ip','Public address',TRUE),
    ('wifi-interface','interface','Wireless interface',TRUE), ('dns-check','dns','Name lookup',TRUE),
    ('web-a','http','First web service',TRUE), ('web-b','http','Second web service',TRUE),
    ('retired','http','Retired web service',FALSE))
    AS e(endpoint_id, endpoint_type, display_name, enabled)""",
        "raw_log": f"""
  SELECT event_no, event_id, agent_id, event_time, k,
    CASE WHEN kind IN ('router_ping','external_ping','wifi_diagnostics') THEN '{S.MEASUREMENT}'
      WHEN kind IN ('dns','http') THEN '{S.SERVICE_CHECK}' WHEN kind = 'speed_test' THEN '{S.SPEED_TEST}'
      ELSE '{S.HEARTBEAT}' END AS event_type,
    event_time + to_seconds(CASE WHEN event_no % 50 = 0 THEN -600 ELSE k END) AS received_at
  FROM base""",
    }


_TOPIC_CASE = (
    "CASE truth "
    + " ".join(f"WHEN '{t}' THEN '{topic}'" for t, topic in S.TOPICS.items())
    + " END"
)

RECORDS = {
    "truths": f"""
  SELECT event_no, event_id, agent_id, agent_role, event_time, k, success, '{S.MEASUREMENT}' AS truth,
    measurement_type, target_id, latency_ms, packet_loss_pct, jitter_ms, signal_dbm, connected, error_class
  FROM measurements
  UNION ALL BY NAME
  SELECT event_no, event_id, agent_id, agent_role, event_time, k, success, '{S.SERVICE_CHECK}' AS truth,
    check_type, endpoint_id, total_duration_ms, http_status, error_class,
    CASE WHEN check_type = 'dns' THEN 'public-a' END AS resolver,
    CASE WHEN check_type = 'dns' THEN 'example.test' END AS domain
  FROM checks
  UNION ALL BY NAME
  SELECT event_no, event_id, agent_id, agent_role, event_time, k, success, '{S.SPEED_TEST}' AS truth,
    'line-test' AS provider, bytes_transferred
  FROM speed_tests
  UNION ALL BY NAME
  SELECT event_no, event_id, agent_id, agent_role, event_time, k, CAST(NULL AS BOOLEAN) AS success,
    '{S.HEARTBEAT}' AS truth, 'host-' || agent_id AS hostname, CAST(k AS DOUBLE) AS cpu_utilization_pct
  FROM heartbeats""",
    "records": f"""
  SELECT event_no, k, truth, {_TOPIC_CASE} AS source_topic, CAST(event_no % 3 AS INTEGER) AS source_partition,
    event_no // 3 + copy * 1000000000 AS source_offset, c, c = 0 AS truncated,
    event_time + to_seconds(CASE WHEN event_no % 50 = 0 THEN -600 ELSE k END) + to_seconds(copy * 60)
      AS kafka_timestamp,
    CASE WHEN c = 5 THEN 'other-agent' WHEN c = 11 THEN 'Unknown Agent' WHEN c = 12 THEN 'ghost-agent'
      ELSE agent_id END AS source_key,
    CASE WHEN c = 0 THEN NULL WHEN c = 8 THEN 'not-a-uuid' ELSE event_id END AS event_id,
    CASE WHEN c IN (0,16) THEN NULL WHEN c = 10 THEN 'network.unknown' ELSE truth END AS event_type,
    CASE WHEN c = 0 THEN NULL WHEN c = 7 THEN 2 ELSE 1 END AS schema_version,
    CASE WHEN c = 0 THEN NULL WHEN c = 11 THEN 'Unknown Agent' WHEN c = 12 THEN 'ghost-agent'
      ELSE agent_id END AS agent_id,
    CASE WHEN c = 0 THEN NULL WHEN c = 1 THEN 'rooftop_sensor' ELSE agent_role END AS agent_role,
    CASE WHEN c = 0 THEN NULL WHEN c = 15 THEN event_time - INTERVAL 2 HOUR ELSE event_time END AS event_time,
    CASE WHEN c = 0 THEN NULL WHEN c = 2 THEN -1 ELSE event_no END AS sequence_number,
    CASE WHEN c = 0 THEN NULL ELSE measurement_type END AS measurement_type,
    CASE WHEN c IN (0,9) OR target_id IS NULL THEN NULL WHEN c = 13 THEN 'ghost-endpoint' ELSE target_id END AS target_id,
    CASE WHEN c = 0 THEN NULL WHEN c = 4 AND truth = '{S.MEASUREMENT}' THEN FALSE
      WHEN c = 4 AND check_type = 'http' THEN TRUE ELSE success END AS success,
    CASE WHEN c = 0 THEN NULL WHEN c = 4 AND truth = '{S.MEASUREMENT}' THEN 5
      WHEN c = 17 AND latency_ms IS NOT NULL THEN -5 ELSE latency_ms END AS latency_ms,
    CASE WHEN c = 0 THEN NULL WHEN c = 3 AND truth = '{S.MEASUREMENT}' THEN 101 ELSE packet_loss_pct END AS packet_loss_pct,
    CASE WHEN c = 0 THEN NULL ELSE jitter_ms END AS jitter_ms,
    CASE WHEN c = 0 THEN NULL ELSE signal_dbm END AS signal_dbm,
    CASE WHEN c = 0 THEN NULL ELSE connected END AS connected,
    check_type,
    CASE WHEN c = 9 OR endpoint_id IS NULL THEN NULL WHEN c = 13 THEN 'ghost-endpoint' ELSE endpoint_id END AS endpoint_id,
    CASE WHEN c <> 4 THEN total_duration_ms END AS total_duration_ms,
    CASE WHEN c <> 4 THEN resolver END AS resolver,
    CASE WHEN c = 3 AND truth = '{S.SERVICE_CHECK}' THEN 999 ELSE http_status END AS http_status,
    CASE WHEN c = 3 AND truth = '{S.SPEED_TEST}' THEN -1 ELSE bytes_transferred END AS bytes_transferred,
    CASE WHEN c = 3 AND truth = '{S.HEARTBEAT}' THEN 150 ELSE cpu_utilization_pct END AS cpu_utilization_pct
  FROM (SELECT *, event_no % 40 AS c FROM truths),
    LATERAL (SELECT unnest(CASE WHEN event_no % 25 = 3 THEN [0, 1] ELSE [0] END) AS copy)""",
    "stream_checked": f"""
  SELECT *, concat_ws(',',
    CASE WHEN truncated THEN 'malformed_json' END,
    CASE WHEN event_id IS NULL THEN 'missing_or_invalid:event_id' END,
    CASE WHEN event_id = 'not-a-uuid' THEN 'invalid:event_id' END,
    CASE WHEN event_type IS DISTINCT FROM '{S.MEASUREMENT}' THEN 'unsupported:event_type' END,
    CASE WHEN schema_version IS DISTINCT FROM 1 THEN 'unsupported:schema_version' END,
    CASE WHEN agent_role IS NULL OR agent_role NOT IN ('{S.WIRED}','{S.WIFI}') THEN 'invalid:agent_role' END,
    CASE WHEN agent_id IS NULL THEN 'missing:agent_id' END,
    CASE WHEN truncated THEN 'missing_or_invalid:event_time' END,
    CASE WHEN truncated THEN 'missing_or_invalid:published_time' END,
    CASE WHEN sequence_number IS NULL OR sequence_number < 0 THEN 'invalid:sequence_number' END,
    CASE WHEN truncated THEN 'missing:source_version' END,
    CASE WHEN measurement_type IS NULL THEN 'invalid:measurement_type' END,
    CASE WHEN target_id IS NULL THEN 'missing:target_id' END,
    CASE WHEN success IS NULL THEN 'missing_or_invalid:success' END,
    CASE WHEN packet_loss_pct IS NULL OR packet_loss_pct < 0 OR packet_loss_pct > 100
      THEN 'invalid:packet_loss_pct' END,
    CASE WHEN NOT success AND latency_ms IS NOT NULL THEN 'invalid:failed_latency' END,
    CASE WHEN measurement_type = 'wifi_diagnostics' AND connected IS NULL THEN 'missing:connected' END,
    CASE WHEN source_key <> agent_id THEN 'invalid:agent_key' END) AS errors
  FROM records WHERE truth = '{S.MEASUREMENT}'""",
    "contract": f"""
  SELECT *, CASE WHEN truncated THEN 'malformed_json'
    WHEN event_type IS NULL OR event_type = 'network.unknown' THEN 'unsupported:event_type'
    ELSE concat_ws(',',
      CASE WHEN event_id = 'not-a-uuid' THEN 'invalid:event_id' END,
      CASE WHEN schema_version <> 1 THEN 'unsupported:schema_version' END,
      CASE WHEN agent_id = 'Unknown Agent' THEN 'invalid:agent_id' END,
      CASE WHEN agent_role = 'rooftop_sensor' THEN 'invalid:agent_role' END,
      CASE WHEN c = 15 THEN 'not_utc:event_time' END,
      CASE WHEN sequence_number < 0 THEN 'invalid:sequence_number' END,
      CASE WHEN c = 14 THEN 'invalid:source_version' END,
      CASE WHEN truth = '{S.MEASUREMENT}' AND target_id IS NULL THEN 'invalid:target_id' END,
      CASE WHEN latency_ms < 0 THEN 'invalid:latency_ms' END,
      CASE WHEN packet_loss_pct > 100 THEN 'invalid:packet_loss_pct' END,
      CASE WHEN truth = '{S.MEASUREMENT}' AND NOT success AND latency_ms IS NOT NULL
        THEN 'forbidden:latency_ms' END,
      CASE WHEN truth = '{S.SERVICE_CHECK}' AND endpoint_id IS NULL THEN 'invalid:endpoint_id' END,
      CASE WHEN http_status > 599 THEN 'invalid:http_status' END,
      CASE WHEN check_type = 'dns' AND resolver IS NULL THEN 'missing:domain_or_resolver' END,
      CASE WHEN check_type = 'http' AND success AND total_duration_ms IS NULL
        THEN 'missing:total_duration_ms' END,
      CASE WHEN truth = '{S.SPEED_TEST}' AND c = 9 THEN 'invalid:provider' END,
      CASE WHEN bytes_transferred < 0 THEN 'invalid:bytes_transferred' END,
      CASE WHEN truth = '{S.HEARTBEAT}' AND c = 9 THEN 'invalid:hostname' END,
      CASE WHEN cpu_utilization_pct > 100 THEN 'invalid:cpu_utilization_pct' END) END AS errors
  FROM records""",
    "referenced": """
  SELECT * REPLACE (CASE WHEN errors <> '' THEN errors
      WHEN agent_id NOT IN (SELECT agent_id FROM agents WHERE enabled) THEN 'unrecognized:agent_id'
      WHEN coalesce(target_id, endpoint_id) NOT IN (SELECT endpoint_id FROM endpoints WHERE enabled)
        THEN 'unrecognized:endpoint' ELSE '' END AS errors)
  FROM contract""",
    "outcomes": """
  SELECT *, CASE WHEN errors <> '' THEN 'dead_lettered'
      WHEN row_number() OVER (PARTITION BY errors <> '', event_id
        ORDER BY kafka_timestamp, source_topic, source_partition, source_offset) = 1 THEN 'valid'
      ELSE 'duplicate' END AS outcome
  FROM referenced""",
    "outcome_log": """
  SELECT kafka_timestamp AS ts, outcome, CAST(k + 1 AS DOUBLE) / 20 AS duration_s FROM outcomes""",
}

WINDOWS = {
    "valid_stream": """
  SELECT *, greatest(0, (epoch_us(kafka_timestamp) - epoch_us(event_time)) / 1000.0) AS ingestion_latency_ms
  FROM stream_checked WHERE errors = ''""",
    "window_metrics": f"""
  SELECT make_timestamp(w) AS window_start, make_timestamp(w + s * 1000000) AS window_end, s AS window_size_seconds,
    agent_id, target_id, measurement_type, COUNT(*) AS event_count,
    COUNT(*) FILTER (WHERE success) AS success_count, COUNT(*) FILTER (WHERE NOT success) AS failure_count,
    100.0 * CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) / COUNT(*) AS success_rate_pct,
    MIN(latency_ms) AS latency_min_ms, MAX(latency_ms) AS latency_max_ms,
    {emean('latency_ms')} AS latency_mean_ms, round(stddev_pop(latency_ms), 6) AS latency_stddev_ms,
    quantile_disc(latency_ms, 0.5) AS latency_p50_ms, quantile_disc(latency_ms, 0.95) AS latency_p95_ms,
    quantile_disc(latency_ms, 0.99) AS latency_p99_ms, {emean('jitter_ms')} AS jitter_mean_ms,
    {emean('packet_loss_pct')} AS packet_loss_mean_pct,
    {emean('ingestion_latency_ms')} AS ingestion_latency_mean_ms
  FROM (SELECT *, epoch_us(event_time) - epoch_us(event_time) % (s * 1000000) AS w
        FROM valid_stream, (VALUES (CAST(60 AS BIGINT)), (300), (900), (86400)) AS sizes(s))
  GROUP BY w, s, agent_id, target_id, measurement_type""",
}


def rules(cfg: S.Thresholds) -> dict[str, str]:
    look, step = int(cfg.lookback_seconds), int(cfg.interval_seconds)
    ok, bad = cfg.healthy_success_pct, cfg.failed_success_pct
    lat, loss = cfg.high_latency_ms, cfg.high_packet_loss_pct
    stale = int(cfg.heartbeat_stale_seconds)

    def every(where: str, holds: str) -> str:
        return f"coalesce(bool_and({holds}) FILTER (WHERE {where}), FALSE)"

    def some(where: str) -> str:
        return f"(COUNT(*) FILTER (WHERE {where}) > 0)"

    wired, wifi = f"agent_role = '{S.WIRED}'", f"agent_role = '{S.WIFI}'"
    router, ext = "probe_type = 'router_ping'", "probe_type = 'external_ping'"
    diag, ping = "probe_type = 'wifi_diagnostics'", "probe_type IN ('router_ping','external_ping')"
    healthy, failed = f"success_rate_pct >= {ok}", f"success_rate_pct <= {bad}"
    lossy = f"({ping} AND mean_packet_loss_pct >= {loss})"
    slow = f"(probe_type NOT IN ('dns','http') AND coalesce(peak_latency_ms >= {lat}, FALSE))"
    impaired = f"({ping} AND ({failed} OR {lossy} OR {slow}))"

    def cased(field: str) -> str:
        quote = field not in ("confidence",)
        arms = " ".join(
            f"WHEN '{n}' THEN " + (f"'{getattr(t, field)}'" if quote else f"{getattr(t, field)}")
            for n, t in TEXTS.items()
            if n != "agent_offline"
        )
        return f"CASE incident_type {arms} END"

    return {
        "observations": """
  SELECT site_id, agent_id, event_time, target_id AS endpoint_id, measurement_type AS probe_type, success,
    latency_ms, packet_loss_pct, signal_dbm, connected FROM measurements
  UNION ALL
  SELECT site_id, agent_id, event_time, endpoint_id, check_type, success, NULL, NULL, NULL, NULL FROM checks""",
        "summaries": f"""
  SELECT o.site_id, tick, o.agent_id, a.agent_role, endpoint_id, probe_type, COUNT(*) AS sample_count,
    100.0 * CAST(COUNT(*) FILTER (WHERE success) AS DOUBLE) / COUNT(*) AS success_rate_pct,
    MAX(latency_ms) AS peak_latency_ms, {emean('packet_loss_pct')} AS mean_packet_loss_pct,
    MIN(signal_dbm) AS weakest_signal_dbm,
    100.0 * CAST(COUNT(*) FILTER (WHERE connected) AS DOUBLE) / NULLIF(COUNT(connected), 0) AS connected_rate_pct
  FROM (SELECT *, unnest(generate_series(
          (epoch_us(event_time) + {step * 1000000 - 1}) // {step * 1000000},
          (epoch_us(event_time) + {look * 1000000 - 1}) // {step * 1000000})) AS tick_no FROM observations) o
    JOIN agents a ON a.agent_id = o.agent_id,
    LATERAL (SELECT make_timestamp(tick_no * {step * 1000000}) AS tick)
  WHERE event_time > tick - INTERVAL {look} SECOND AND event_time <= tick
  GROUP BY o.site_id, tick, o.agent_id, a.agent_role, endpoint_id, probe_type""",
        "span": f"""
  SELECT -(-MIN(epoch_us(event_time)) // {step * 1000000}) AS a0, MIN(epoch_us(event_time)) AS lo,
    MAX(epoch_us(event_time)) AS hi FROM base""",
        "ticks": f"""
  SELECT make_timestamp(n * {step * 1000000}) AS tick, n FROM (
    SELECT unnest(generate_series((lo + {step * 1000000 - 1}) // {step * 1000000},
                                  (hi + {step * 1000000 - 1}) // {step * 1000000})) AS n FROM span)""",
        "latest_heartbeats": """
  SELECT g.site_id, g.tick, g.agent_id, g.agent_role, MAX(h.event_time) AS last_event_time
  FROM (SELECT a.*, t.tick FROM agents a, ticks t WHERE a.enabled) g
    LEFT JOIN heartbeats h ON h.agent_id = g.agent_id AND h.event_time <= g.tick
  GROUP BY ALL""",
        "gated": f"SELECT * FROM summaries WHERE sample_count >= {cfg.minimum_samples}",
        "decided": f"""
  SELECT *, CASE
      WHEN wr_dead AND fr_dead THEN 'router_unavailable'
      WHEN wr_ok AND we_ok AND fr_dead AND unlinked THEN 'wifi_outage'
      WHEN wr_ok AND fr_ok AND we_dead AND fe_dead THEN 'isp_outage'
      WHEN wr_ok AND we_ok AND fr_seen AND strained AND weak THEN 'wifi_degradation'
      WHEN wr_ok AND fr_ok AND we_ok AND fe_ok AND dns_w AND dns_f THEN 'dns_failure'
      WHEN wr_ok AND fr_ok AND we_ok AND fe_ok AND dns_ok AND http_dead AND (http_ok OR http_n = 1)
        THEN 'external_service_failure'
      WHEN lossy_w AND lossy_f THEN 'high_packet_loss'
      WHEN slow_w AND slow_f THEN 'high_latency'
      WHEN impaired THEN 'unknown_network_incident' END AS incident_type
  FROM (SELECT site_id, tick,
      {every(f"{wired} AND {router}", healthy)} AS wr_ok, {every(f"{wired} AND {router}", failed)} AS wr_dead,
      {every(f"{wifi} AND {router}", healthy)} AS fr_ok, {every(f"{wifi} AND {router}", failed)} AS fr_dead,
      {some(f"{wifi} AND {router}")} AS fr_seen,
      {every(f"{wired} AND {ext}", healthy)} AS we_ok, {every(f"{wired} AND {ext}", failed)} AS we_dead,
      {every(f"{wifi} AND {ext}", healthy)} AS fe_ok, {every(f"{wifi} AND {ext}", failed)} AS fe_dead,
      {every(f"{wifi} AND {diag}", f"coalesce(connected_rate_pct <= {bad}, FALSE)")} AS unlinked,
      {some(f"{wifi} AND {ping} AND (coalesce(peak_latency_ms >= {lat * 0.5}, FALSE) OR mean_packet_loss_pct >= {loss * 0.75})")} AS strained,
      {some(f"{wifi} AND {diag} AND weakest_signal_dbm <= {cfg.weak_signal_dbm}")} AS weak,
      {some(f"{wired} AND probe_type = 'dns' AND {failed}")} AS dns_w,
      {some(f"{wifi} AND probe_type = 'dns' AND {failed}")} AS dns_f,
      {every("probe_type = 'dns'", healthy)} AS dns_ok,
      {some(f"probe_type = 'http' AND {failed}")} AS http_dead,
      {some(f"probe_type = 'http' AND {healthy}")} AS http_ok,
      COUNT(DISTINCT endpoint_id) FILTER (WHERE probe_type = 'http') AS http_n,
      {some(f"{wired} AND {lossy}")} AS lossy_w, {some(f"{wifi} AND {lossy}")} AS lossy_f,
      {some(f"{wired} AND {slow}")} AS slow_w, {some(f"{wifi} AND {slow}")} AS slow_f,
      {some(impaired)} AS impaired
    FROM gated GROUP BY site_id, tick)""",
        "network_findings": f"""
  SELECT site_id, tick, incident_type || CASE WHEN incident_type IN ('dns_failure','external_service_failure')
      THEN ':' || endpoints ELSE '' END AS incident_key, incident_type,
    {cased('severity')} AS severity, CAST({cased('confidence')} AS DOUBLE) AS confidence_score,
    agents, endpoints, evidence_rows,
    CASE WHEN incident_type NOT IN ('dns_failure','external_service_failure') THEN peak END AS peak_latency_ms,
    CASE WHEN incident_type NOT IN ('dns_failure','external_service_failure') THEN worst END AS maximum_packet_loss_pct,
    {cased('summary')} AS summary
  FROM (SELECT g.site_id, g.tick, incident_type, string_agg(DISTINCT agent_id, ',' ORDER BY agent_id) AS agents,
      string_agg(DISTINCT endpoint_id, ',' ORDER BY endpoint_id) AS endpoints, COUNT(*) AS evidence_rows,
      MAX(peak_latency_ms) AS peak, MAX(mean_packet_loss_pct) AS worst
    FROM gated g JOIN decided d ON d.site_id = g.site_id AND d.tick = g.tick
    WHERE CASE incident_type
      WHEN 'router_unavailable' THEN {router}
      WHEN 'wifi_outage' THEN {wifi} AND ({router} OR {diag})
      WHEN 'isp_outage' THEN {ping}
      WHEN 'wifi_degradation' THEN {wifi} AND ({ping} OR {diag})
      WHEN 'dns_failure' THEN probe_type = 'dns'
      WHEN 'external_service_failure' THEN probe_type = 'http' AND {failed}
      WHEN 'high_packet_loss' THEN {lossy}
      WHEN 'high_latency' THEN {slow}
      WHEN 'unknown_network_incident' THEN {impaired} ELSE FALSE END
    GROUP BY g.site_id, g.tick, incident_type)""",
        "offline": f"""
  SELECT h.site_id, h.tick, 'agent_offline:' || agent_id AS incident_key, 'agent_offline' AS incident_type,
    'warning' AS severity, CAST(0.86 AS DOUBLE) AS confidence_score, agent_id AS agents, '' AS endpoints,
    CAST(1 AS BIGINT) AS evidence_rows, CAST(NULL AS DOUBLE) AS peak_latency_ms,
    CAST(NULL AS DOUBLE) AS maximum_packet_loss_pct,
    'Agent ' || agent_id || ' stopped reporting while another agent remained current.' AS summary
  FROM latest_heartbeats h
    JOIN (SELECT DISTINCT site_id, tick FROM latest_heartbeats
          WHERE epoch_us(tick) - epoch_us(last_event_time) <= {stale * 1000000}) r
      ON r.site_id = h.site_id AND r.tick = h.tick
  WHERE last_event_time IS NULL OR epoch_us(h.tick) - epoch_us(last_event_time) > {stale * 1000000}""",
        "findings": "SELECT * FROM network_findings UNION ALL SELECT * FROM offline",
    }


def lifecycle(cfg: S.Thresholds) -> dict[str, str]:
    step = int(cfg.interval_seconds)
    return {
        "hits": f"""
  SELECT site_id, incident_key, epoch_us(tick) // {step * 1000000} AS n, severity, incident_type, agents,
    endpoints, peak_latency_ms, maximum_packet_loss_pct FROM findings""",
        "grid": """
  SELECT k.site_id, k.incident_key, t.n, h.n IS NOT NULL AS hit,
    row_number() OVER (PARTITION BY k.site_id, k.incident_key ORDER BY t.n) AS i
  FROM (SELECT site_id, incident_key, MIN(n) AS first_n FROM hits GROUP BY ALL) k
    JOIN (SELECT n FROM ticks UNION SELECT n FROM hits) t ON t.n >= k.first_n
      AND t.n <= (SELECT MAX(n) FROM ticks)
    LEFT JOIN hits h ON h.site_id = k.site_id AND h.incident_key = k.incident_key AND h.n = t.n""",
        "fold": f"""
  SELECT site_id, incident_key, n, i, hit, 'candidate' AS status, n AS start_n, CAST(1 AS BIGINT) AS revision,
    CAST(1 AS BIGINT) AS positives, CAST(0 AS BIGINT) AS recoveries, n AS last_hit
  FROM grid WHERE i = 1
  UNION ALL
  SELECT g.site_id, g.incident_key, g.n, g.i, g.hit,
    CASE WHEN f.status IN ('resolved','none') THEN CASE WHEN g.hit THEN 'candidate' ELSE 'none' END
      WHEN g.hit THEN CASE f.status
        WHEN 'candidate' THEN CASE WHEN f.positives + 1 >= {cfg.open_observations} THEN 'open' ELSE 'candidate' END
        WHEN 'recovering' THEN 'open' ELSE 'ongoing' END
      WHEN f.status = 'candidate' OR (f.status = 'recovering' AND f.recoveries + 1 >= {cfg.resolve_observations})
        THEN 'resolved' ELSE 'recovering' END,
    CASE WHEN f.status IN ('resolved','none') THEN g.n ELSE f.start_n END,
    CASE WHEN f.status IN ('resolved','none') THEN 1 ELSE f.revision + 1 END,
    CASE WHEN f.status IN ('resolved','none') THEN 1 WHEN g.hit THEN f.positives + 1 ELSE f.positives END,
    CASE WHEN f.status IN ('resolved','none') OR g.hit THEN 0 ELSE f.recoveries + 1 END,
    CASE WHEN g.hit THEN g.n ELSE f.last_hit END
  FROM fold f JOIN grid g ON g.site_id = f.site_id AND g.incident_key = f.incident_key AND g.i = f.i + 1""",
        "transitions": f"""
  SELECT {uuid5(f"'linkwatch-incident:' || x.site_id || ':' || x.incident_key || ':' || "
                + iso(f"make_timestamp(start_n * {step * 1000000})", "+00:00"))} AS incident_id,
    x.site_id, x.incident_key, make_timestamp(x.n * {step * 1000000}) AS observed_at,
    make_timestamp(start_n * {step * 1000000}) AS start_time,
    CASE WHEN status = 'resolved' THEN make_timestamp(x.n * {step * 1000000}) END AS end_time, status,
    revision AS state_revision, positives AS positive_observations, recoveries AS recovery_observations,
    h.severity, h.incident_type, h.agents, h.endpoints, h.peak_latency_ms, h.maximum_packet_loss_pct
  FROM (SELECT * FROM fold WHERE status <> 'none') x
    JOIN hits h ON h.site_id = x.site_id AND h.incident_key = x.incident_key AND h.n = x.last_hit""",
        "incidents": """
  SELECT incident_id, arg_max(site_id, state_revision) AS site_id, arg_max(incident_key, state_revision) AS incident_key,
    MIN(start_time) AS start_time, arg_max(struct_pack(e := end_time), state_revision).e AS end_time,
    arg_max(status, state_revision) AS status, arg_max(severity, state_revision) AS severity,
    arg_max(incident_type, state_revision) AS incident_type, arg_max(agents, state_revision) AS agents,
    arg_max(endpoints, state_revision) AS endpoints, MAX(peak_latency_ms) AS peak_latency_ms,
    MAX(maximum_packet_loss_pct) AS maximum_packet_loss_pct, MAX(state_revision) AS state_revision,
    MAX(observed_at) AS last_observed_at,
    (epoch_us(MAX(observed_at)) - epoch_us(MIN(start_time))) / 1000.0 AS duration_ms
  FROM transitions GROUP BY incident_id""",
        "bridge_agents": """
  SELECT DISTINCT incident_id, unnest(string_split(agents, ',')) AS agent_id FROM incidents WHERE agents <> ''""",
        "bridge_endpoints": """
  SELECT DISTINCT incident_id, unnest(string_split(endpoints, ',')) AS endpoint_id FROM incidents
  WHERE endpoints <> ''""",
        "incident_view": """
  SELECT i.*, (SELECT COUNT(*) FROM bridge_agents b WHERE b.incident_id = i.incident_id) AS affected_agent_count,
    (SELECT COUNT(*) FROM bridge_endpoints b WHERE b.incident_id = i.incident_id) AS affected_endpoint_count
  FROM incidents i""",
        "state_log": f"""
  SELECT {uuid5("'linkwatch-incident-state:' || incident_id || ':' || CAST(state_revision AS VARCHAR)")} AS event_id,
    incident_id, state_revision, status, observed_at AS event_time FROM transitions""",
        "acks": """
  SELECT event_id FROM state_log WHERE state_revision = 1""",
    }


DAILY = {
    "probe_rows": """
  SELECT CAST(event_time AS DATE) AS date_utc, event_time, agent_id, target_id AS endpoint_id,
    'network_measurement' AS source_kind, measurement_type AS probe_type, success, latency_ms, packet_loss_pct
  FROM measurements
  UNION ALL
  SELECT CAST(event_time AS DATE), event_time, agent_id, endpoint_id, 'service_check', check_type, success,
    total_duration_ms, NULL FROM checks""",
    "daily_fact": f"""
  SELECT date_utc, agent_id, endpoint_id, source_kind, probe_type, COUNT(*) AS total_count,
    COUNT(*) FILTER (WHERE success) AS success_count, COUNT(*) FILTER (WHERE NOT success) AS failure_count,
    {esum('latency_ms')} AS latency_sum_ms, COUNT(latency_ms) AS latency_count,
    {esum('packet_loss_pct')} AS packet_loss_sum_pct, COUNT(packet_loss_pct) AS packet_loss_count
  FROM probe_rows GROUP BY date_utc, agent_id, endpoint_id, source_kind, probe_type""",
    "daily_view": """
  SELECT date_utc, agent_id, endpoint_id, source_kind, probe_type, total_count, success_count, failure_count,
    100.0 * CAST(success_count AS DOUBLE) / NULLIF(total_count, 0) AS success_rate_pct, latency_count,
    latency_sum_ms, latency_sum_ms / NULLIF(latency_count, 0) AS mean_latency_ms, packet_loss_count,
    packet_loss_sum_pct, packet_loss_sum_pct / NULLIF(packet_loss_count, 0) AS mean_packet_loss_pct
  FROM daily_fact""",
    "role_rows": """
  SELECT d.*, a.agent_role FROM daily_view d LEFT JOIN agents a ON a.agent_id = d.agent_id""",
}


def sql(body: str, *, cfg: S.Thresholds, pairs: int | None, extra: dict[str, str] | None = None) -> str:
    """The query with every table expression it mentions, directly or not, in front."""
    parts = {
        **telemetry(pairs),
        **RECORDS,
        **WINDOWS,
        **rules(cfg),
        **lifecycle(cfg),
        **DAILY,
        **(extra or {}),
    }
    needed: list[str] = []

    def visit(text: str, own: str | None = None) -> None:
        for name in parts:
            if name != own and name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(parts[name], name)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    recursive = [n for n in needed if n.endswith("fold")]
    clauses = ",\n".join(
        f"{n} AS {'' if n in recursive else 'MATERIALIZED '}({parts[n]})" for n in needed
    )
    head = "WITH RECURSIVE " if recursive else "WITH "
    return f"{head}{clauses}\n{body}"
