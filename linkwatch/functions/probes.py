"""Fields read out of probe command output and probe numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwatch.functions.ids import protect
from linkwatch.functions.numeric import clamp, col

# What ping and iw print.
PACKET_LOSS = r"(\d+(?:\.\d+)?)%\s+packet loss"
ROUND_TRIP = (
    r"(?:rtt|round-trip).*?=\s*"
    r"(\d+(?:\.\d+)?)/(\d+(?:\.\d+)?)/(\d+(?:\.\d+)?)/(\d+(?:\.\d+)?)"
)
BSSID = r"Connected to\s+([0-9a-fA-F:]{17})"
SSID = r"(?m)^\s*SSID:\s*(.+)$"
FREQUENCY = r"(?m)^\s*freq:\s*(\d+)"
SIGNAL = r"(?m)^\s*signal:\s*(-?\d+(?:\.\d+)?)\s*dBm"
BITRATE = r"(?m)^\s*tx bitrate:\s*(\d+(?:\.\d+)?)\s*MBit/s"
NOT_CONNECTED = "Not connected"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The matched group, or NULL where the pattern does not occur."""
    hit = F.regexp_extract(text, pattern, group)
    return F.when(hit != "", hit)


def first_text(*texts: Column, longest: int | None = None) -> Column:
    """First non-empty text, trimmed; cut only where ``longest`` says so."""
    chosen = F.coalesce(*[F.when(t != "", t) for t in texts], F.lit(""))
    text = F.regexp_replace(chosen, r"^\s+|\s+$", "")
    return text if longest is None else F.substring(text, 1, longest)


def ping_fields(
    stdout: Column | str,
    stderr: Column | str,
    return_code: Column | str,
    *,
    longest_message: int | None = None,
) -> dict:
    out, err, code = col(stdout), col(stderr), col(return_code)
    both = F.concat_ws("\n", F.coalesce(out, F.lit("")), F.coalesce(err, F.lit("")))
    loss = F.coalesce(found(both, PACKET_LOSS).cast("double"), F.lit(100.0))
    average = found(both, ROUND_TRIP, 2).cast("double")
    jitter = found(both, ROUND_TRIP, 4).cast("double")
    success = F.coalesce((code == 0) & (loss < 100) & average.isNotNull(), F.lit(False))
    return {
        "success": success,
        "latency_ms": F.when(success, average),
        "packet_loss_pct": loss,
        "jitter_ms": F.when(success, jitter),
        "error_class": F.when(~success, F.lit("PingFailed")),
        "error_message": F.when(~success, first_text(err, out, longest=longest_message)),
    }


def wifi_fields(
    stdout: Column | str,
    stderr: Column | str,
    return_code: Column | str,
    *,
    ssid_mode: str = "hash",
    bssid_mode: str = "hash",
    salt: str = "",
    longest_message: int | None = None,
) -> dict:
    out, err, code = col(stdout), col(stderr), col(return_code)
    connected = F.coalesce((code == 0) & ~out.contains(NOT_CONNECTED), F.lit(False))

    def when_linked(value: Column) -> Column:
        return F.when(connected, value)

    return {
        "success": connected,
        "connected": connected,
        "packet_loss_pct": F.when(connected, F.lit(0.0)).otherwise(F.lit(100.0)),
        "ssid": when_linked(protect(F.trim(found(out, SSID)), ssid_mode, salt)),
        "bssid": when_linked(protect(F.lower(found(out, BSSID)), bssid_mode, salt)),
        "signal_dbm": when_linked(found(out, SIGNAL).cast("double")),
        "frequency_mhz": when_linked(found(out, FREQUENCY).cast("int")),
        "bitrate_mbps": when_linked(found(out, BITRATE).cast("double")),
        "error_class": F.when(~connected, F.lit("WifiDisconnected")),
        "error_message": F.when(~connected, first_text(err, out, longest=longest_message)),
    }


def http_success(status: Column | str) -> Column:
    return F.coalesce((col(status) >= 200) & (col(status) < 400), F.lit(False))


def http_error_class(status: Column | str, timed_out: Column | str) -> Column:
    return F.when(col(timed_out), F.lit("Timeout")).when(
        ~http_success(status), F.lit("HttpStatusError")
    )


def megabits(bits_per_second: Column | str) -> Column:
    return col(bits_per_second).cast("double") / F.lit(1e6)


def utilization(used: Column | str, total: Column | str) -> Column:
    share = F.try_divide(col(used).cast("double"), col(total).cast("double")) * F.lit(100.0)
    return F.when(col(total) > 0, clamp(share, 0.0, 100.0)).otherwise(F.lit(0.0))
