"""Silver tables → gold tables of the Open Cybersecurity Schema Framework."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category, class and type ids of the two activities written here.
CATEGORY, ACTIVITY, SEVERITY = 4, 99, 99
HTTP_CLASS, NETWORK_CLASS = 4002, 4001
VERSION = "1.0.0"


def _ids(class_uid: int) -> list[Column]:
    return [
        F.lit(ACTIVITY).alias("activity_id"), F.lit(CATEGORY).alias("category_uid"), F.lit(class_uid).alias("class_uid"),
        F.col("timestamp").alias("time"), F.lit(SEVERITY).alias("severity_id"), F.lit(class_uid * 100 + ACTIVITY).alias("type_uid"),
    ]


def _struct(name: str, **fields: str | Column) -> Column:
    return F.struct(*((F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items())).alias(name)


def normalize_access(df: DataFrame) -> DataFrame:
    """Web-server lines → HTTP activity. Unparsed lines stay rows; the host is both name and address."""
    return df.select(
        *_ids(HTTP_CLASS),
        _struct("src_endpoint", hostname="host", ip="host"),
        _struct("http_request", http_method="method", user_agent="agent", version="version", url="path", referrer="referrer"),
        _struct("http_response", code="code", length="size"),
        _struct("metadata", product=F.lit("apache_web"), version=F.lit(VERSION), processed_time="ingest_time"),
    )


def normalize_zeek_http(df: DataFrame) -> DataFrame:
    """Zeek HTTP records → HTTP activity."""
    return df.select(
        *_ids(HTTP_CLASS),
        _struct("src_endpoint", ip="id_origin_host", port="id_origin_port"),
        _struct("dst_endpoint", hostname="host", ip="id_response_host", port="id_response_port"),
        _struct("http_request", http_method="method", user_agent="user_agent", version="version", url="uri"),
        _struct("http_response", code="status_code"),
        _struct("metadata", product=F.lit("zeek"), version=F.lit(VERSION), uid="uid", processed_time="ingest_time"),
    )


def normalize_zeek_conn(df: DataFrame) -> DataFrame:
    """Zeek connections → network activity; durations in milliseconds, sums null if a side is null."""
    return df.select(
        *_ids(NETWORK_CLASS),
        (F.col("duration") * 1000).alias("duration"),
        _struct("dst_endpoint", ip="id_response_host", port="id_response_port"),
        _struct("metadata", product=F.lit("zeek"), version=F.lit(VERSION), uid="uid", processed_time="ingest_time"),
        _struct("src_endpoint", ip="id_origin_host", port="id_origin_port"),
        _struct(
            "traffic", bytes_in="response_bytes", packets_in="response_packets", bytes_out="origin_bytes", packets_out="origin_packets",
            bytes_missed="missed_bytes", bytes=F.col("response_bytes") + F.col("origin_bytes"), packets=F.col("response_packets") + F.col("origin_packets"),
        ),
        _struct("connection_info", direction_id=F.lit(0), protocol_name="proto", flag_history="history"),
    )


def merge_schemas(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name, fields of nested structs included; what a side lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
