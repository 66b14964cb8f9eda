"""Explicit schemas, as DDL, of all inputs and of the normalized tables."""

from __future__ import annotations

#: Zeek connection log, JSON lines; optional fields that a file lacks are null
ZEEK_CONN = (
    "ts double, uid string, `id.orig_h` string, `id.orig_p` int, `id.resp_h` string, `id.resp_p` int, proto string, "
    "service string, duration double, orig_bytes bigint, resp_bytes bigint, conn_state string, local_orig boolean, "
    "local_resp boolean, missed_bytes bigint, history string, orig_pkts bigint, orig_ip_bytes bigint, resp_pkts bigint, "
    "resp_ip_bytes bigint, orig_l2_addr string, resp_l2_addr string"
)
#: Zeek HTTP log, JSON lines
ZEEK_HTTP = (
    "ts double, uid string, `id.orig_h` string, `id.orig_p` int, `id.resp_h` string, `id.resp_p` int, trans_depth int, "
    "method string, host string, uri string, referrer string, version string, user_agent string, request_body_len bigint, "
    "response_body_len bigint, status_code int, status_msg string"
)
#: the part of a threat-intel envelope that is read
ENVELOPE = "`@timestamp` timestamp, fileset struct<name:string>, service struct<type:string>, message string"
#: the columns a Kafka source delivers
KAFKA = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
)

#: the message of each feed
FEED_MESSAGES = {
    "otx": "content string, description string, id bigint, indicator string, title string, type string",
    "abuseurl": (
        "blacklists struct<spamhaus_dbl:string,surbl:string>, date_added string, host string, id string, larted string, "
        "reporter string, tags array<string>, threat string, url string, url_status string, urlhaus_reference string"
    ),
    "malwarebazaar": (
        "anonymous bigint, code_sign array<string>, dhash_icon string, file_name string, file_size bigint, file_type string, "
        "file_type_mime string, first_seen string, imphash string, "
        "intelligence struct<clamav:string,downloads:string,mail:string,uploads:string>, last_seen string, md5_hash string, "
        "origin_country string, reporter string, sha1_hash string, sha256_hash string, sha3_384_hash string, signature string, "
        "ssdeep string, tags array<string>, telfhash string, tlsh string"
    ),
    "abusemalware": (
        "file_size string, file_type string, firstseen string, imphash string, md5_hash string, sha256_hash string, "
        "signature string, ssdeep string, tlsh string, urlhaus_download string, virustotal string"
    ),
}

#: the indicator list that detections join with
IOC_LIST = "ioc_type string, ioc string"
#: demonstration indicators: addresses of the documentation ranges
DEMO_IOCS = [("IPv4", "192.0.2.10"), ("IPv4", "198.51.100.20"), ("IPv4", "203.0.113.30"), ("IPv4", "203.0.113.40")]

_IDS = "activity_id int, category_uid int, class_uid int, severity_id int, type_uid int, time timestamp"
#: gold table of HTTP activity (OCSF class 4002), the by-name union of its writers
OCSF_HTTP = (
    f"{_IDS}, src_endpoint struct<hostname:string,ip:string,port:int>, dst_endpoint struct<hostname:string,ip:string,port:int>, "
    "http_request struct<http_method:string,user_agent:string,version:string,url:string,referrer:string>, "
    "http_response struct<code:int,length:bigint>, metadata struct<product:string,version:string,uid:string,processed_time:timestamp>"
)
#: gold table of network activity (OCSF class 4001)
OCSF_NETWORK = (
    f"{_IDS}, duration double, dst_endpoint struct<ip:string,port:int>, "
    "metadata struct<product:string,version:string,uid:string,processed_time:timestamp>, src_endpoint struct<ip:string,port:int>, "
    "traffic struct<bytes_in:bigint,packets_in:bigint,bytes_out:bigint,packets_out:bigint,bytes_missed:bigint,bytes:bigint,packets:bigint>, "
    "connection_info struct<direction_id:int,protocol_name:string,flag_history:string>"
)
#: detections
ALERTS = ("details string, detection_time timestamp, detection_source string, detection_type string, detection_level string")
#: columns a gold table has from its creation on, before the first writer adds its own
GOLD_STUB = "activity_id int, category_uid int, class_uid int, time timestamp"
