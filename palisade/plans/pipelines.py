"""Queries of the log pipelines over logs rendered from the tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.functions import community_id, ocsf, protocols
from palisade.operators import detect, feeds, insert_new, normalize, parsers
from palisade.plans.preparation import table
from palisade.sources import synthesize
from palisade.sources.schemas import OCSF_HTTP, ZEEK_CONN, ZEEK_HTTP


def _us(c: str) -> Column:
    return F.unix_micros(c)


def _access(spark: SparkSession, d: str) -> DataFrame:
    return parsers.parse_access(synthesize.access_lines(table(spark, d, "events")))


def _records(rows: DataFrame, schema) -> DataFrame:
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def _conn(spark: SparkSession, d: str) -> DataFrame:
    return parsers.parse_zeek_conn(_records(synthesize.conn_json(table(spark, d, "lineitem")), ZEEK_CONN))


def _http(spark: SparkSession, d: str) -> DataFrame:
    return parsers.parse_zeek_http(_records(synthesize.http_json(table(spark, d, "zeek_http")), ZEEK_HTTP))


def _trail(spark: SparkSession, d: str) -> DataFrame:
    documents = synthesize.trail_documents(table(spark, d, "orders"))
    return parsers.parse_cloudtrail(documents.select(F.try_parse_json("value").alias("_raw")))


def _bronze(spark: SparkSession, d: str) -> DataFrame:
    return parsers.decode_envelope(synthesize.envelopes(table(spark, d, "documents")))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return parsers.decode_message(_bronze(spark, d))


def _gold_http(df: DataFrame) -> DataFrame:
    """Scalar columns of HTTP activity, whichever its writer; missing ones null."""
    wide = normalize.merge_schemas(df, df.sparkSession.createDataFrame([], OCSF_HTTP))
    return wide.select(
        "activity_id", "category_uid", "class_uid", "severity_id", "type_uid", _us("time").alias("time_us"),
        F.col("src_endpoint.hostname").alias("src_hostname"), F.col("src_endpoint.ip").alias("src_ip"), F.col("src_endpoint.port").alias("src_port"),
        F.col("dst_endpoint.hostname").alias("dst_hostname"), F.col("dst_endpoint.ip").alias("dst_ip"), F.col("dst_endpoint.port").alias("dst_port"),
        F.col("http_request.http_method").alias("http_method"), F.col("http_request.user_agent").alias("user_agent"), F.col("http_request.url").alias("url"),
        F.col("http_request.version").alias("http_version"), F.col("http_request.referrer").alias("referrer"), F.col("http_response.code").alias("code"),
        F.col("http_response.length").alias("length"), F.col("metadata.product").alias("product"), F.col("metadata.uid").alias("uid"),
    )


def apache_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = _access(spark, d)
    return rows.select("event_id", "host", "user", _us("timestamp").alias("time_us"), "code", "size", "referrer", "agent", "method", "path", "version")


def apache_ocsf_http(spark: SparkSession, d: str) -> DataFrame:
    return _gold_http(normalize.normalize_access(_access(spark, d)))


def admin_scan(spark: SparkSession, d: str) -> DataFrame:
    hits = detect.admin_scans(normalize.normalize_access(_access(spark, d)))
    return hits.select(F.col("src_endpoint.ip").alias("src_ip"), F.col("http_request.url").alias("url"), F.col("http_response.code").alias("code"), _us("time").alias("time_us"))


def apache_scan_alert_map(spark: SparkSession, d: str) -> DataFrame:
    alerts = detect.details_map(detect.detect_admin_scans(normalize.normalize_access(_access(spark, d))))
    entry = lambda k: F.col("details")[k]
    request = F.from_json(entry("http_request"), "url string, http_method string")
    return alerts.select(
        "detection_source", "detection_type", "detection_level", entry("class_uid").alias("class_uid"), entry("type_uid").alias("type_uid"),
        request["url"].alias("url"), request["http_method"].alias("http_method"),
    )


def zeek_conn_parse(spark: SparkSession, d: str) -> DataFrame:
    return _conn(spark, d).select(
        _us("timestamp").alias("time_us"), "uid", "id_origin_host", "id_origin_port", "id_response_host", "id_response_port", "proto", "duration",
        "origin_bytes", "response_bytes", "origin_packets", "response_packets", "missed_bytes", "history",
    )


def zeek_conn_ocsf_network(spark: SparkSession, d: str) -> DataFrame:
    return normalize.normalize_zeek_conn(_conn(spark, d)).select(
        "activity_id", "category_uid", "class_uid", "severity_id", "type_uid", _us("time").alias("time_us"), "duration",
        F.col("dst_endpoint.ip").alias("dst_ip"), F.col("dst_endpoint.port").alias("dst_port"), F.col("src_endpoint.ip").alias("src_ip"),
        F.col("src_endpoint.port").alias("src_port"), F.col("metadata.product").alias("product"), F.col("metadata.uid").alias("uid"), "traffic.bytes_in",
        "traffic.bytes_out", "traffic.packets_in", "traffic.packets_out", "traffic.bytes_missed", "traffic.bytes", "traffic.packets",
        "connection_info.direction_id", "connection_info.protocol_name", "connection_info.flag_history",
    )


def zeek_http_parse(spark: SparkSession, d: str) -> DataFrame:
    return _http(spark, d).select(
        _us("timestamp").alias("time_us"), "uid", "trans_depth", "id_origin_host", "id_origin_port", "id_response_host", "id_response_port", "host", "method",
        "uri", "user_agent", "version", "status_code",
    )


def zeek_http_ocsf(spark: SparkSession, d: str) -> DataFrame:
    return _gold_http(normalize.normalize_zeek_http(_http(spark, d)))


def http_union(spark: SparkSession, d: str) -> DataFrame:
    both = normalize.merge_schemas(normalize.normalize_access(_access(spark, d)), normalize.normalize_zeek_http(_http(spark, d)))
    return _gold_http(both)


def _matches(spark: SparkSession, d: str, kind: str) -> DataFrame:
    network = normalize.normalize_zeek_conn(_conn(spark, d))
    found = detect.ioc_matches(network, synthesize.supplier_iocs(table(spark, d, "supplier")), kind)
    return found.select(F.col("metadata.uid").alias("uid"), F.col("dst_endpoint.ip").alias("dst_ip"), "duration", "traffic.bytes", "ioc_type", "ioc")


def ioc_match(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d, "IPv4")


def ioc_match_dup(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d, "IPv4").groupBy("dst_ip").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum("duration").alias("duration"))


def bronze_envelope(spark: SparkSession, d: str) -> DataFrame:
    rows = _bronze(spark, d)
    return rows.select("offset", _us("kafka_ts").alias("kafka_us"), _us("timestamp").alias("time_us"), "dataset", "service", "msg_hash", "date")


def bronze_dedup(spark: SparkSession, d: str) -> DataFrame:
    return insert_new.first_of_keys(_bronze(spark, d), ["msg_hash"], ["offset"]).select("msg_hash", "offset")


def bronze_merge_incremental(spark: SparkSession, d: str) -> DataFrame:
    """What the second half of the rows adds to a table that holds the first half."""
    rows = _bronze(spark, d)
    first, second = rows.where("offset % 2 = 0"), rows.where("offset % 2 = 1")
    target = insert_new.rows_to_insert(first, None, ["msg_hash"], ["offset"])
    return insert_new.rows_to_insert(second, target, ["msg_hash"], ["offset"]).select("msg_hash", "offset")


def feed_otx(spark: SparkSession, d: str) -> DataFrame:
    rows = feeds.handle_otx(_messages(spark, d))
    return rows.select("dataset", _us("timestamp").alias("time_us"), "ioc_type", "ioc", "ioc_id", "ioc_title", "ioc_description", _us("first_seen").alias("first_us"))


def feed_abuseurl(spark: SparkSession, d: str) -> DataFrame:
    rows = feeds.handle_abuseurl(_messages(spark, d))
    return rows.select("dataset", "ioc_type", "ioc", "ioc_id", _us("first_seen").alias("first_us"), F.col("abuseurl.tags")[0].alias("tag"), F.col("abuseurl.host").alias("host"))


def feed_malwarebazaar(spark: SparkSession, d: str) -> DataFrame:
    rows = feeds.handle_malwarebazaar(_messages(spark, d))
    return rows.select("dataset", "ioc_type", "ioc", "file_name", "file_size", _us("first_seen").alias("first_us"), _us("last_seen").alias("last_us"))


def feed_abusemalware(spark: SparkSession, d: str) -> DataFrame:
    rows = feeds.handle_abusemalware(_messages(spark, d))
    return rows.select("dataset", "ioc_type", "ioc", "file_size", _us("first_seen").alias("first_us"))


def iocs_silver_keys(spark: SparkSession, d: str) -> DataFrame:
    return insert_new.first_of_keys(feeds.all_feeds(_messages(spark, d)).select("ioc_type", "ioc"), ["ioc_type", "ioc"])


def cloudtrail_records(spark: SparkSession, d: str) -> DataFrame:
    return _trail(spark, d).select("event_id", "event_name", _us("event_time").alias("time_us"), "read_only", "error_code").distinct()


def cloudtrail_resources(spark: SparkSession, d: str) -> DataFrame:
    return _trail(spark, d).select("event_id", "resources_account_id")


def cloudtrail_identity(spark: SparkSession, d: str) -> DataFrame:
    mfa = "user_identity_session_context_attributes_mfa_authenticated"
    return _trail(spark, d).groupBy("user_identity_type", "user_identity_username", mfa).agg(F.count(F.lit(1)).alias("n"))


def _codes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", (F.col("event_id") % 300).cast("int").alias("code"), (F.col("event_id") % 16).cast("int").alias("activity"))


def proto_name_to_code(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, PROTO_NAMES))
    rows = table(spark, d, "events").select("event_id", F.element_at(names, (F.col("event_id") % len(PROTO_NAMES) + 1).cast("int")).alias("name"))
    return rows.select("event_id", "name", protocols.proto_name_to_code(F.col("name")).alias("code"))


PROTO_NAMES = ["tcp", "UDP", "Icmp", "IPv6-ICMP", "argus", "swipe", "no such protocol", "", "sctp", "bit-emu", "reserved", "any local network"]


def proto_code_to_name(spark: SparkSession, d: str) -> DataFrame:
    return _codes(spark, d).select("event_id", "code", protocols.proto_code_to_name(F.col("code")).alias("name"))


def _activity(function):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return _codes(spark, d).select("event_id", "activity", function(F.col("activity")).alias("name"))

    return query


def ocsf_http_id(spark: SparkSession, d: str) -> DataFrame:
    verb = F.element_at(F.array(*map(F.lit, HTTP_VERBS)), (F.col("event_id") % len(HTTP_VERBS) + 1).cast("int"))
    rows = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 13 != 0, verb).alias("verb"))
    return rows.select("event_id", "verb", ocsf.ocsf_http_activity_id(F.col("verb")).alias("id"))


HTTP_VERBS = ["GET", "post", "Put", "", "BREW", "connect", "delete", "HEAD", "options", "trace", "patch"]


def community_id_flows(spark: SparkSession, d: str) -> DataFrame:
    """The id of each flow and whether the reverse flow has the same one."""
    ends = ["id_origin_host", "id_origin_port", "id_response_host", "id_response_port"]
    conn = _conn(spark, d).select("uid", *ends, protocols.proto_name_to_code(F.col("proto")).alias("code"))
    rows = community_id.with_community_id(conn, *ends, F.col("code"))
    rows = community_id.with_community_id(rows, *ends[2:], *ends[:2], F.col("code"), "back")
    return rows.select("uid", "community_id", (F.col("community_id") == F.col("back")).alias("same"))


QUERIES = {
    "apache_parse": apache_parse, "apache_ocsf_http": apache_ocsf_http, "admin_scan": admin_scan, "apache_scan_alert_map": apache_scan_alert_map,
    "zeek_conn_parse": zeek_conn_parse, "zeek_conn_ocsf_network": zeek_conn_ocsf_network, "zeek_http_parse": zeek_http_parse,
    "zeek_http_ocsf": zeek_http_ocsf, "http_union": http_union, "ioc_match": ioc_match, "ioc_match_dup": ioc_match_dup,
    "bronze_envelope": bronze_envelope, "bronze_dedup": bronze_dedup, "bronze_merge_incremental": bronze_merge_incremental,
    "feed_otx": feed_otx, "feed_abuseurl": feed_abuseurl, "feed_malwarebazaar": feed_malwarebazaar, "feed_abusemalware": feed_abusemalware,
    "iocs_silver_keys": iocs_silver_keys, "cloudtrail_records": cloudtrail_records, "cloudtrail_resources": cloudtrail_resources,
    "cloudtrail_identity": cloudtrail_identity, "proto_name_to_code": proto_name_to_code, "proto_code_to_name": proto_code_to_name,
    "ocsf_network_name": _activity(ocsf.ocsf_network_activity_name), "ocsf_dns_name": _activity(ocsf.ocsf_dns_activity_name),
    "ocsf_http_name": _activity(ocsf.ocsf_http_activity_name), "ocsf_file_name": _activity(ocsf.ocsf_file_activity_name),
    "ocsf_http_id": ocsf_http_id, "community_id": community_id_flows,
}
