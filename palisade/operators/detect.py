"""Detections over the gold tables, for batch and streaming inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prefixes of admin pages and of internal addresses.
ADMIN_PREFIX = "/admin"
INTERNAL_PREFIXES = ("192.168.", "10.")
BROADCAST_ROWS = 1_000_000


def alert(df: DataFrame, source: str, kind: str, level: str) -> DataFrame:
    """All columns of each row as JSON text, with time, source, type and level of the alert."""
    return df.select(
        F.to_json(F.struct("*")).alias("details"), F.current_timestamp().alias("detection_time"), F.lit(source).alias("detection_source"),
        F.lit(kind).alias("detection_type"), F.lit(level).alias("detection_level"),
    )


def details_map(alerts: DataFrame) -> DataFrame:
    """Alerts with ``details`` as map of texts; nested objects stay JSON text."""
    return alerts.withColumn("details", F.from_json("details", "map<string,string>"))


def ioc_matches(network: DataFrame, iocs: DataFrame, ioc_type: str = "IPv4", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Connections whose destination is an indicator; a repeated indicator repeats the match.

    The list is broadcast while it has at most ``limit`` rows, beyond that the join shuffles
    (a static side of a stream as well). Null addresses match nothing.
    """
    side = iocs.where(F.col("ioc_type") == ioc_type)
    if side.limit(limit + 1).count() <= limit:
        side = F.broadcast(side)
    return network.join(side, F.col("dst_endpoint.ip") == F.col("ioc"))


def detect_network_iocs(network: DataFrame, iocs: DataFrame) -> DataFrame:
    return alert(ioc_matches(network, iocs), "network", "ioc_match", "warn")


def _starts(c: str, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | F.col(c).startswith(p)
    return out


def admin_scans(http: DataFrame, internal: tuple[str, ...] = INTERNAL_PREFIXES) -> DataFrame:
    """Requests of admin pages from outside. A null source address is dropped (unknown, not outside)."""
    return http.where(F.col("http_request.url").startswith(ADMIN_PREFIX) & ~_starts("src_endpoint.ip", internal))


def detect_admin_scans(http: DataFrame) -> DataFrame:
    return alert(admin_scans(http), "http", "http_admin_page_scan", "info")
