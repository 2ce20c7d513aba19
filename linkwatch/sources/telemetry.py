"""Telemetry views over the generic ``events`` and ``customer`` tables.

Every view is a set of plain column expressions over a scan, so it stays a
narrow projection of the file.  ``pairs`` folds that many pairs of users onto one
site with one wired and one Wi-Fi agent; left out, every pair of users is a
site of its own.  Either way the number of sites grows with the data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch import schemas as S
from linkwatch.sources.tables import table

# Day of month modulo ten picks the condition of the day.
HEALTHY, WIFI_WEAK, WIFI_DOWN, ROUTER_DOWN, ISP_DOWN = 0, 1, 2, 3, 4
DNS_DOWN, WEB_DOWN, SLOW, LOSSY, WIFI_SILENT = 5, 6, 7, 8, 9

REPLAY_OFFSET = 1_000_000_000

ENDPOINTS = (
    ("router", "router", "Local router", True),
    ("public-a", "external_ip", "Public address", True),
    ("wifi-interface", "interface", "Wireless interface", True),
    ("dns-check", "dns", "Name lookup", True),
    ("web-a", "http", "First web service", True),
    ("web-b", "http", "Second web service", True),
    ("retired", "http", "Retired web service", False),
)


def _half(number: Column) -> Column:
    return (number - F.pmod(number, F.lit(2))) / F.lit(2)


class Telemetry:
    def __init__(self, spark: SparkSession, folder: str, pairs: int | None = None) -> None:
        self.spark = spark
        self.folder = folder
        self.pairs = pairs

    def _identity(self, number: Column) -> dict[str, Column]:
        site = _half(number).cast("bigint")
        if self.pairs:
            site = F.floor(site / F.lit(self.pairs)).cast("bigint")
        wired = F.pmod(number, F.lit(2)) == 0
        return {
            "site_id": F.concat(F.lit("site-"), site),
            "agent_id": F.concat(F.when(wired, F.lit("wired-")).otherwise(F.lit("wifi-")), site),
            "agent_role": F.when(wired, F.lit(S.WIRED)).otherwise(F.lit(S.WIFI)),
        }

    @cached_property
    def base(self) -> DataFrame:
        """One row per event with identity, kind and condition of the day."""
        number = F.col("user_id")
        k = F.get_json_object("props", "$.k").cast("int")
        wired = F.pmod(number, F.lit(2)) == 0
        condition = F.pmod(F.dayofmonth(F.col("ts").cast("timestamp")), F.lit(10))
        silent = condition == WIFI_SILENT
        kind = (
            F.when(F.col("event_type") == "view", F.lit("router_ping"))
            .when(F.col("event_type") == "click", F.lit("external_ping"))
            .when(
                F.col("event_type") == "purchase",
                F.when(~wired, F.lit("wifi_diagnostics"))
                .when(F.pmod(k, F.lit(4)) == 0, F.lit("speed_test"))
                .otherwise(F.lit("router_ping")),
            )
            .when(
                F.col("event_type") == "signup",
                F.when(F.pmod(k, F.lit(2)) == 0, F.lit("dns")).otherwise(F.lit("http")),
            )
            # a silent day's heartbeats never come; the agent still probes
            .when(silent & ~wired, F.lit("router_ping"))
            .otherwise(F.lit("heartbeat"))
        )
        md5 = F.md5(F.col("event_id").cast("string"))
        uuid = F.concat(
            F.substring(md5, 1, 8),
            F.lit("-"),
            F.substring(md5, 9, 4),
            F.lit("-4"),
            F.substring(md5, 14, 3),
            F.lit("-a"),
            F.substring(md5, 18, 3),
            F.lit("-"),
            F.substring(md5, 21, 12),
        )
        rows = table(self.spark, self.folder, "events").select(
            F.col("event_id").alias("event_no"),
            uuid.alias("event_id"),
            F.col("ts").cast("timestamp").alias("event_time"),
            F.col("value").alias("v"),
            k.alias("k"),
            kind.alias("kind"),
            condition.alias("sc"),
            *[c.alias(n) for n, c in self._identity(number).items()],
        )
        return rows

    @cached_property
    def measurements(self) -> DataFrame:
        sc, k, v, kind = F.col("sc"), F.col("k"), F.col("v"), F.col("kind")
        wifi = F.col("agent_role") == S.WIFI
        external, diagnostics = kind == "external_ping", kind == "wifi_diagnostics"
        success = (
            (k >= 2)
            & (sc != ROUTER_DOWN)
            & ~((sc == WIFI_DOWN) & wifi)
            & ~((sc == ISP_DOWN) & external)
        )
        latency = (
            F.when(
                (sc == WIFI_WEAK) & wifi,
                F.when(external, F.lit(145.0)).otherwise(F.lit(85.0)) + v / F.lit(100.0),
            )
            .when((sc == SLOW) & external, F.lit(240.0) + v / F.lit(100.0))
            .otherwise(v / F.lit(10.0))
        )
        loss = (
            F.when(~success, F.lit(100.0))
            .when(diagnostics, F.lit(0.0))
            .when((sc == WIFI_WEAK) & wifi, F.lit(18.0))
            .when(sc == LOSSY, F.lit(35.0))
            .otherwise(F.lit(0.0))
        )
        signal = F.when(sc == WIFI_WEAK, F.lit(-84.0)).otherwise(F.lit(-57.0))
        target = (
            F.when(kind == "router_ping", F.lit("router"))
            .when(external, F.lit("public-a"))
            .otherwise(F.lit("wifi-interface"))
        )
        return self.base.where(kind.isin(*S.MEASUREMENT_TYPES)).select(
            "event_no",
            "event_id",
            "site_id",
            "agent_id",
            "agent_role",
            "event_time",
            kind.alias("measurement_type"),
            target.alias("target_id"),
            success.alias("success"),
            F.when(success & ~diagnostics, latency).alias("latency_ms"),
            loss.alias("packet_loss_pct"),
            F.when(success & ~diagnostics, k / F.lit(10.0)).alias("jitter_ms"),
            F.when(success & diagnostics, signal).alias("signal_dbm"),
            F.when(diagnostics, success).alias("connected"),
            F.when(~success, F.lit("HostUnreachable")).alias("error_class"),
            "k",
        )

    @cached_property
    def checks(self) -> DataFrame:
        sc, k, v, kind = F.col("sc"), F.col("k"), F.col("v"), F.col("kind")
        wifi = F.col("agent_role") == S.WIFI
        endpoint = (
            F.when(kind == "dns", F.lit("dns-check"))
            .when(F.pmod(k, F.lit(4)) == 1, F.lit("web-a"))
            .otherwise(F.lit("web-b"))
        )
        success = (
            (k >= 2)
            & ~sc.isin(ROUTER_DOWN, ISP_DOWN, DNS_DOWN)
            & ~((sc == WIFI_DOWN) & wifi)
            & ~((sc == WEB_DOWN) & (endpoint == "web-a"))
        )
        dns = kind == "dns"
        return self.base.where(kind.isin(*S.CHECK_TYPES)).select(
            "event_no",
            "event_id",
            "site_id",
            "agent_id",
            "agent_role",
            "event_time",
            kind.alias("check_type"),
            endpoint.alias("endpoint_id"),
            success.alias("success"),
            F.when(dns & success, v / F.lit(10.0)).alias("lookup_duration_ms"),
            F.when(~dns & success, v / F.lit(10.0)).alias("total_duration_ms"),
            F.when(~dns, F.when(success, F.lit(200)).otherwise(F.lit(503))).alias("http_status"),
            F.when(~success, F.lit("CheckFailed")).alias("error_class"),
            "k",
        )

    @cached_property
    def heartbeats(self) -> DataFrame:
        k = F.col("k")
        errors = (
            F.when(F.pmod(k, F.lit(3)) == 0, F.array(F.lit("collector_timeout")))
            .when(F.pmod(k, F.lit(3)) == 1, F.array().cast("array<string>"))
            .when(F.pmod(k, F.lit(5)) == 0, F.lit(None).cast("array<string>"))
            .otherwise(F.array(F.lit("dns"), F.lit("http")))
        )
        return self.base.where(F.col("kind") == "heartbeat").select(
            "event_no",
            "event_id",
            "site_id",
            "agent_id",
            "agent_role",
            "event_time",
            F.pmod(k, F.lit(5)).alias("local_queue_depth"),
            errors.alias("collection_errors"),
            "k",
        )

    @cached_property
    def speed_tests(self) -> DataFrame:
        k, v = F.col("k"), F.col("v")
        success = (k >= 2) & ~F.col("sc").isin(ROUTER_DOWN, ISP_DOWN)
        return self.base.where(F.col("kind") == "speed_test").select(
            "event_no",
            "event_id",
            "site_id",
            "agent_id",
            "agent_role",
            "event_time",
            success.alias("success"),
            F.when(success, v).alias("download_mbps"),
            F.when(success, v / F.lit(4.0)).alias("upload_mbps"),
            (k * F.lit(1000)).cast("bigint").alias("bytes_transferred"),
            "k",
        )

    @cached_property
    def agents(self) -> DataFrame:
        """Agent registry, one row per agent, out of the customer table."""
        number = F.col("c_custkey")
        rows = table(self.spark, self.folder, "customer").select(
            "c_name",
            "c_acctbal",
            *[c.alias(n) for n, c in self._identity(number).items()],
        )
        return rows.groupBy("agent_id", "agent_role", "site_id").agg(
            F.min("c_name").alias("display_name"),
            (F.max("c_acctbal") > 0).alias("enabled"),
        )

    @cached_property
    def endpoints(self) -> DataFrame:
        return self.spark.createDataFrame(
            list(ENDPOINTS),
            "endpoint_id string, endpoint_type string, display_name string, enabled boolean",
        )

    @cached_property
    def raw_log(self) -> DataFrame:
        """Accepted source log: when each event was received."""
        event_type = (
            F.when(F.col("kind").isin(*S.MEASUREMENT_TYPES), F.lit(S.MEASUREMENT))
            .when(F.col("kind").isin(*S.CHECK_TYPES), F.lit(S.SERVICE_CHECK))
            .when(F.col("kind") == "speed_test", F.lit(S.SPEED_TEST))
            .otherwise(F.lit(S.HEARTBEAT))
        )
        return self.base.select(
            "event_no",
            "event_id",
            "agent_id",
            "event_time",
            event_type.alias("event_type"),
            self.received_at().alias("received_at"),
            "k",
        )

    @staticmethod
    def received_at() -> Column:
        """k seconds after the event; one in fifty clocks runs ten minutes ahead."""
        delay = F.when(F.pmod("event_no", F.lit(50)) == 0, F.lit(-600)).otherwise(F.col("k"))
        return F.timestamp_micros(
            F.unix_micros("event_time") + delay.cast("bigint") * F.lit(1_000_000)
        )

    @cached_property
    def kafka(self) -> DataFrame:
        """Kafka-shaped JSON records of all four raw topics.

        ``event_no % 40`` picks a defect (see ``_defects``), one record in
        twenty-five is delivered again at a later offset.
        """
        common = ("event_no", "event_id", "agent_id", "agent_role", "event_time", "k", "success")
        m = self.measurements.select(
            *common, F.lit(S.MEASUREMENT).alias("event_type"), "measurement_type", "target_id",
            "latency_ms", "packet_loss_pct", "jitter_ms", "signal_dbm", "connected", "error_class",
        )
        dns = F.col("check_type") == "dns"
        c = self.checks.select(
            *common, F.lit(S.SERVICE_CHECK).alias("event_type"), "check_type", "endpoint_id",
            "lookup_duration_ms", "total_duration_ms", "http_status", "error_class",
            F.when(dns, F.lit("public-a")).alias("resolver"),
            F.when(dns, F.lit("example.test")).alias("domain"),
        )
        s = self.speed_tests.select(
            *common, F.lit(S.SPEED_TEST).alias("event_type"), "download_mbps", "upload_mbps",
            F.lit("line-test").alias("provider"), F.lit(1500.0).alias("duration_ms"),
            "bytes_transferred",
        )
        h = self.heartbeats.select(
            *[x for x in common if x != "success"], F.lit(S.HEARTBEAT).alias("event_type"),
            F.concat(F.lit("host-"), F.col("agent_id")).alias("hostname"),
            F.lit("1.4.2").alias("agent_version"), F.lit("linux").alias("os_version"),
            (F.col("k") * F.lit(60.0)).alias("uptime_seconds"),
            F.col("k").cast("double").alias("cpu_utilization_pct"),
            F.lit(40.0).alias("memory_utilization_pct"),
            F.lit(55.5).alias("disk_utilization_pct"),
            F.array(F.lit("eth0")).alias("network_interfaces"), "collection_errors",
            "local_queue_depth",
        )
        merged = m.unionByName(c, True).unionByName(s, True).unionByName(h, True)
        return self._records(self._defects(merged))

    @staticmethod
    def _defects(df: DataFrame) -> DataFrame:
        case = F.pmod("event_no", F.lit(40))

        def swap(name: str, when: Column, value) -> dict[str, Column]:
            return {name: F.when(when, F.lit(value)).otherwise(F.col(name))}

        kind = F.col("event_type")
        zone = F.when(case == 15, F.lit("+02:00")).otherwise(F.lit("Z"))
        stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        published = F.timestamp_micros(F.unix_micros("event_time") + F.lit(1_000_000))
        new: dict[str, Column] = {
            "topic": F.create_map(*[F.lit(x) for p in S.TOPICS.items() for x in p])[kind],
            "truth": kind,
            "case_no": case,
            "sequence_number": F.when(case == 2, F.lit(-1).cast("bigint")).otherwise(
                F.col("event_no")
            ),
            "schema_version": F.when(case == 7, F.lit(2)).otherwise(F.lit(1)),
            "source_version": F.when(case == 14, F.lit("one.two")).otherwise(F.lit("1.0.0")),
            "event_time_text": F.concat(stamp, zone),
            "published_time_text": F.concat(
                F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")
            ),
            "future_field": F.when(case == 6, F.lit("kept")),
            "success": F.when((case == 4) & (kind == S.MEASUREMENT), F.lit(False)).when(
                (case == 4) & (F.col("check_type") == "http"), F.lit(True)
            ).otherwise(F.col("success")),
            "latency_ms": F.when((case == 4) & (kind == S.MEASUREMENT), F.lit(5.0)).when(
                (case == 17) & F.col("latency_ms").isNotNull(), F.lit(-5.0)
            ).otherwise(F.col("latency_ms")),
            "resolver": F.when(case == 4, F.lit(None)).otherwise(F.col("resolver")),
            "total_duration_ms": F.when(case == 4, F.lit(None)).otherwise(
                F.col("total_duration_ms")
            ),
            "agent_id": F.when(case == 11, F.lit("Unknown Agent"))
            .when(case == 12, F.lit("ghost-agent"))
            .otherwise(F.col("agent_id")),
            "true_agent": F.col("agent_id"),
            "event_id": F.when(case == 8, F.lit("not-a-uuid")).otherwise(F.col("event_id")),
            "event_type": F.when(case == 10, F.lit("network.unknown"))
            .when(case == 16, F.lit(None))
            .otherwise(kind),
        }
        new |= swap("agent_role", case == 1, "rooftop_sensor")
        new |= swap("packet_loss_pct", (case == 3) & (kind == S.MEASUREMENT), 101.0)
        new |= swap("http_status", (case == 3) & (kind == S.SERVICE_CHECK), 999)
        new |= swap("bytes_transferred", (case == 3) & (kind == S.SPEED_TEST), -1)
        new |= swap("cpu_utilization_pct", (case == 3) & (kind == S.HEARTBEAT), 150.0)
        for name in ("target_id", "endpoint_id"):
            new[name] = (
                F.when(case == 9, F.lit(None))
                .when((case == 13) & F.col(name).isNotNull(), F.lit("ghost-endpoint"))
                .otherwise(F.col(name))
            )
        for name in ("provider", "hostname"):
            new[name] = F.when(case == 9, F.lit(None)).otherwise(F.col(name))
        return df.withColumns(new)

    @staticmethod
    def _records(df: DataFrame) -> DataFrame:
        hidden = {
            "event_no", "k", "topic", "truth", "case_no", "true_agent",
            "event_time", "event_time_text", "published_time_text",
        }
        body = F.to_json(
            F.struct(
                *[F.col(c) for c in df.columns if c not in hidden],
                F.col("event_time_text").alias("event_time"),
                F.col("published_time_text").alias("published_time"),
            )
        )
        text = F.when(
            F.col("case_no") == 0, F.expr("substring(body, 1, length(body) - 12)")
        ).otherwise(F.col("body"))
        copies = F.when(
            F.pmod("event_no", F.lit(25)) == 3, F.array(F.lit(0), F.lit(1))
        ).otherwise(F.array(F.lit(0)))
        return (
            df.withColumn("received_at", Telemetry.received_at())
            .withColumn("body", body)
            .select(
                F.when(F.col("case_no") == 5, F.lit("other-agent"))
                .otherwise(F.col("agent_id"))
                .cast("binary")
                .alias("key"),
                text.cast("binary").alias("value"),
                "topic",
                F.pmod("event_no", F.lit(3)).cast("int").alias("partition"),
                F.floor(F.col("event_no") / F.lit(3)).alias("first_offset"),
                "received_at",
                F.explode(copies).alias("copy"),
            )
            .select(
                "key",
                "value",
                "topic",
                "partition",
                (F.col("first_offset") + F.col("copy") * F.lit(REPLAY_OFFSET)).alias("offset"),
                F.timestamp_micros(
                    F.unix_micros("received_at") + F.col("copy") * F.lit(60_000_000)
                ).alias("timestamp"),
            )
        )
