"""DuckDB SQL for the pipeline queries, straight from the columns behind the rendered logs."""

from __future__ import annotations

from palisade.functions import ocsf, protocols
from palisade.plans.pipelines import HTTP_VERBS, PROTO_NAMES
from palisade.sources.synthesize import HASH_FIELDS

_EVENTS = """
e AS (SELECT event_id, event_id % 97 = 0 AS bad,
  (CASE event_id % 4 WHEN 0 THEN '10.0.' WHEN 1 THEN '192.168.' WHEN 2 THEN '172.16.' ELSE '203.0.' END)
    || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS host,
  'u' || CAST(user_id AS VARCHAR) AS "user", epoch_us(date_trunc('second', ts)) AS us,
  CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS code,
  CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id * 7 % 5000 END AS size,
  'Agent/' || CAST(user_id AS VARCHAR) AS agent, CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
  CASE event_type WHEN 'error' THEN '/admin/' || CAST(event_id % 50 AS VARCHAR) WHEN 'signup' THEN '/administrator'
    WHEN 'click' THEN '/x/admin' ELSE '/item/' || CAST(event_id % 50 AS VARCHAR) END AS path FROM events)"""


def _t(column: str) -> str:
    """Text of a parsed line, '' where the line is garbage."""
    return f"CASE WHEN bad THEN '' ELSE {column} END"


def _n(column: str) -> str:
    return f"CASE WHEN bad THEN NULL ELSE {column} END"


_IDS = "99 AS activity_id, 4 AS category_uid, 4002 AS class_uid, 99 AS severity_id, 400299 AS type_uid"
_APACHE_HTTP = f"""SELECT {_IDS}, {_n('us')} AS time_us, {_t('host')} AS src_hostname, {_t('host')} AS src_ip, CAST(NULL AS INTEGER) AS src_port,
  CAST(NULL AS VARCHAR) AS dst_hostname, CAST(NULL AS VARCHAR) AS dst_ip, CAST(NULL AS INTEGER) AS dst_port, {_t('method')} AS http_method,
  {_t('agent')} AS user_agent, {_t('path')} AS url, {_t("'HTTP/1.1'")} AS http_version, {_t("'-'")} AS referrer, {_n('code')} AS code,
  {_n('size')} AS length, 'apache_web' AS product, CAST(NULL AS VARCHAR) AS uid FROM e"""
_ZEEK_HTTP = f"""SELECT {_IDS}, epoch_us(date_trunc('second', "timestamp")) AS time_us, CAST(NULL AS VARCHAR) AS src_hostname, id_origin_host AS src_ip,
  id_origin_port AS src_port, host AS dst_hostname, id_response_host AS dst_ip, id_response_port AS dst_port, method AS http_method, user_agent, uri AS url,
  version AS http_version, CAST(NULL AS VARCHAR) AS referrer, status_code AS code, CAST(NULL AS BIGINT) AS length, 'zeek' AS product, uid FROM zeek_http"""
_CONN = """
c AS (SELECT epoch_us(date_trunc('second', l_shipdate)) + 250000 AS time_us, 'C' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid,
  '10.1.' || CAST(l_partkey % 256 AS VARCHAR) || '.' || CAST(l_orderkey % 256 AS VARCHAR) AS orig_h, CAST(1024 + l_orderkey % 60000 AS INTEGER) AS orig_p,
  '198.51.100.' || CAST(l_suppkey % 200 AS VARCHAR) AS resp_h, CASE l_returnflag WHEN 'A' THEN 443 WHEN 'R' THEN 53 ELSE 80 END AS resp_p,
  CASE WHEN l_returnflag = 'R' THEN 'udp' ELSE 'tcp' END AS proto, l_quantity AS duration,
  CASE WHEN l_linenumber <> 7 THEN l_partkey END AS ob, CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS rb,
  CAST(l_linenumber AS BIGINT) AS op, CAST(l_linenumber + 1 AS BIGINT) AS rp FROM lineitem),
i AS (SELECT CASE WHEN s_suppkey % 30 = 0 THEN 'URL' ELSE 'IPv4' END AS ioc_type, '198.51.100.' || CAST(s_suppkey % 200 AS VARCHAR) AS ioc
  FROM supplier WHERE s_suppkey % 10 = 0 UNION ALL
  SELECT 'IPv4', '198.51.100.' || CAST(s_suppkey % 200 AS VARCHAR) FROM supplier WHERE s_suppkey % 20 = 0)"""
_DOCS = """
d AS (SELECT doc_id, doc_id % 5 AS turn, CAST(doc_id % 300 AS VARCHAR) AS n, (1700000000 + doc_id * 60) * 1000000 AS us,
  CASE doc_id % 5 WHEN 0 THEN 'otx' WHEN 1 THEN 'abuseurl' WHEN 2 THEN 'malwarebazaar' WHEN 3 THEN 'abusemalware' ELSE 'other' END AS dataset FROM documents)"""
_SEEN = "1709618828000000"
_TYPES = {
    "md5_hash": "FileHash-MD5", "imphash": "FileHash-ImpHash", "sha1_hash": "FileHash-SHA1", "sha256_hash": "FileHash-SHA256", "sha3_384_hash": "FileHash-SHA384",
    "ssdeep": "FileHash-SSDEEP", "telfhash": "FileHash-TElfHash", "tlsh": "FileHash-TLSH",
}
_FIVE = ["md5_hash", "imphash", "sha256_hash", "ssdeep", "tlsh"]


def _hashes(names: list[str], turn: int, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT dataset, '{_TYPES[h]}' AS ioc_type, sha256('{h}' || n) AS ioc, {columns} FROM d WHERE turn = {turn} AND doc_id % {HASH_FIELDS[h]} <> 0" for h in names
    )


def _message() -> str:
    """The text of each message, as JSON writers spell it."""
    field = lambda h: f"""CASE WHEN doc_id % {HASH_FIELDS[h]} <> 0 THEN '"{h}":"' || sha256('{h}' || n) || '",' ELSE '' END"""
    bazaar = " || ".join(field(h) for h in HASH_FIELDS)
    malware = " || ".join(field(h) for h in _FIVE)
    stamp = "2024-03-05 06:07:08 UTC"
    return f"""CASE turn
      WHEN 0 THEN '{{"id":' || CAST(doc_id AS VARCHAR) || ',"indicator":"198.51.100.' || n || '","type":"IPv4","title":"t"}}'
      WHEN 1 THEN '{{"url":"http://h' || n || '.example/x","id":"' || n || '","date_added":"{stamp}","tags":["elf"]}}'
      WHEN 2 THEN '{{' || {bazaar} || '"file_name":"f' || n || '","file_size":' || CAST(doc_id AS VARCHAR) || ',"first_seen":"{stamp}"}}'
      WHEN 3 THEN '{{' || {malware} || '"file_size":"' || CAST(doc_id AS VARCHAR) || '","firstseen":"{stamp}"}}'
      ELSE 'note ' || n END"""


_HASHED = _DOCS + f",\nh AS (SELECT *, sha256({_message()}) AS msg_hash FROM d)"
_ORDERS = """
o AS (SELECT CAST(o_orderkey AS VARCHAR) AS event_id, CASE WHEN o_orderstatus = 'F' THEN 'GetObject' ELSE 'PutObject' END AS event_name,
  epoch_us(date_trunc('second', o_orderdate)) AS time_us, o_orderstatus = 'F' AS read_only, o_orderkey AS k FROM orders),
r AS (SELECT o.*, CAST(NULL AS VARCHAR) AS account FROM o WHERE k % 3 = 0 UNION ALL SELECT o.*, 'A' FROM o WHERE k % 3 > 0
  UNION ALL SELECT o.*, 'B' FROM o WHERE k % 3 = 2)"""


def _case(key: str, values: dict, default: str) -> str:
    q = lambda v: "'" + v + "'" if isinstance(v, str) else str(v)
    return f"CASE {key} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in values.items()) + f" ELSE {default} END"


def _pick(values: list[str]) -> str:
    return f"CASE event_id % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _name(values: dict) -> str:
    activity = "CAST(event_id % 16 AS INTEGER)"
    return f"SELECT event_id, {activity} AS activity, {_case(activity, values, chr(39) + 'Other' + chr(39))} AS name FROM events"


SQL = {
    "apache_parse": f"""WITH {_EVENTS} SELECT event_id, {_t('host')} AS host, {_t('"user"')} AS "user", {_n('us')} AS time_us, {_n('code')} AS code, {_n('size')} AS size,
  {_t("'-'")} AS referrer, {_t('agent')} AS agent, {_t('method')} AS method, {_t('path')} AS path, {_t("'HTTP/1.1'")} AS version FROM e""",
    "apache_ocsf_http": f"WITH {_EVENTS} {_APACHE_HTTP}",
    "admin_scan": f"WITH {_EVENTS} SELECT host AS src_ip, path AS url, code, us AS time_us FROM e WHERE NOT bad AND path LIKE '/admin%' AND NOT (host LIKE '192.168.%' OR host LIKE '10.%')",
    "apache_scan_alert_map": f"""WITH {_EVENTS} SELECT 'http' AS detection_source, 'http_admin_page_scan' AS detection_type, 'info' AS detection_level, '4002' AS class_uid,
  '400299' AS type_uid, path AS url, method AS http_method FROM e WHERE NOT bad AND path LIKE '/admin%' AND NOT (host LIKE '192.168.%' OR host LIKE '10.%')""",
    "zeek_conn_parse": f"""WITH {_CONN} SELECT time_us, uid, orig_h AS id_origin_host, orig_p AS id_origin_port, resp_h AS id_response_host, resp_p AS id_response_port, proto,
  duration, ob AS origin_bytes, rb AS response_bytes, op AS origin_packets, rp AS response_packets, CAST(NULL AS BIGINT) AS missed_bytes, 'ShADadFf' AS history FROM c""",
    "zeek_conn_ocsf_network": f"""WITH {_CONN} SELECT 99 AS activity_id, 4 AS category_uid, 4001 AS class_uid, 99 AS severity_id, 400199 AS type_uid, time_us,
  duration * 1000 AS duration, resp_h AS dst_ip, resp_p AS dst_port, orig_h AS src_ip, orig_p AS src_port, 'zeek' AS product, uid, rb AS bytes_in, ob AS bytes_out,
  rp AS packets_in, op AS packets_out, CAST(NULL AS BIGINT) AS bytes_missed, rb + ob AS bytes, rp + op AS packets, 0 AS direction_id, proto AS protocol_name,
  'ShADadFf' AS flag_history FROM c""",
    "zeek_http_parse": """SELECT epoch_us(date_trunc('second', "timestamp")) AS time_us, uid, trans_depth, id_origin_host, id_origin_port, id_response_host, id_response_port,
  host, method, uri, user_agent, version, status_code FROM zeek_http""",
    "zeek_http_ocsf": _ZEEK_HTTP,
    "http_union": f"WITH {_EVENTS} {_APACHE_HTTP} UNION ALL {_ZEEK_HTTP}",
    "ioc_match": f"WITH {_CONN} SELECT uid, resp_h AS dst_ip, duration * 1000 AS duration, rb + ob AS bytes, ioc_type, ioc FROM c JOIN i ON resp_h = ioc WHERE ioc_type = 'IPv4'",
    "ioc_match_dup": f"""WITH {_CONN} SELECT resp_h AS dst_ip, count(*) AS n, CAST(sum(rb + ob) AS BIGINT) AS bytes, sum(duration * 1000) AS duration
  FROM c JOIN i ON resp_h = ioc WHERE ioc_type = 'IPv4' GROUP BY resp_h""",
    "bronze_envelope": f"""WITH {_HASHED} SELECT doc_id AS "offset", us AS kafka_us, us AS time_us, dataset, 'threatintel' AS service, msg_hash,
  CAST(make_timestamp(us) AS DATE) AS date FROM h""",
    "bronze_dedup": f'WITH {_HASHED} SELECT msg_hash, min(doc_id) AS "offset" FROM h GROUP BY msg_hash',
    "bronze_merge_incremental": f"""WITH {_HASHED} SELECT msg_hash, min(doc_id) AS "offset" FROM h WHERE doc_id % 2 = 1
  AND msg_hash NOT IN (SELECT msg_hash FROM h WHERE doc_id % 2 = 0) GROUP BY msg_hash""",
    "feed_otx": f"""WITH {_DOCS} SELECT dataset, us AS time_us, 'IPv4' AS ioc_type, '198.51.100.' || n AS ioc, CAST(doc_id AS VARCHAR) AS ioc_id, 't' AS ioc_title,
  CAST(NULL AS VARCHAR) AS ioc_description, us AS first_us FROM d WHERE turn = 0""",
    "feed_abuseurl": f"""WITH {_DOCS} SELECT dataset, 'URL' AS ioc_type, 'http://h' || n || '.example/x' AS ioc, n AS ioc_id, {_SEEN} AS first_us, 'elf' AS tag,
  CAST(NULL AS VARCHAR) AS host FROM d WHERE turn = 1""",
    "feed_malwarebazaar": f"WITH {_DOCS} {_hashes(list(HASH_FIELDS), 2, f'chr(102) || n AS file_name, doc_id AS file_size, {_SEEN} AS first_us, CAST(NULL AS BIGINT) AS last_us')}",
    "feed_abusemalware": f"WITH {_DOCS} {_hashes(_FIVE, 3, f'doc_id AS file_size, {_SEEN} AS first_us')}",
    "iocs_silver_keys": f"""WITH {_DOCS} SELECT DISTINCT ioc_type, ioc FROM (SELECT 'IPv4' AS ioc_type, '198.51.100.' || n AS ioc FROM d WHERE turn = 0
  UNION ALL SELECT 'URL', 'http://h' || n || '.example/x' FROM d WHERE turn = 1
  UNION ALL SELECT ioc_type, ioc FROM ({_hashes(list(HASH_FIELDS), 2, '1 AS one')}) UNION ALL SELECT ioc_type, ioc FROM ({_hashes(_FIVE, 3, '1 AS one')}))""",
    "cloudtrail_records": f"WITH {_ORDERS} SELECT DISTINCT event_id, event_name, time_us, read_only, CAST(NULL AS VARCHAR) AS error_code FROM o",
    "cloudtrail_resources": f"WITH {_ORDERS} SELECT event_id, account AS resources_account_id FROM r",
    "cloudtrail_identity": f"""WITH {_ORDERS} SELECT 'IAMUser' AS user_identity_type, 'user' || CAST(k % 100 AS VARCHAR) AS user_identity_username,
  k % 2 = 0 AS user_identity_session_context_attributes_mfa_authenticated, count(*) AS n FROM r GROUP BY ALL""",
    "proto_name_to_code": f"SELECT event_id, {_pick(PROTO_NAMES)} AS name, {_case(f'lower({_pick(PROTO_NAMES)})', protocols.CODES, 'NULL')} AS code FROM events",
    "proto_code_to_name": f"SELECT event_id, CAST(event_id % 300 AS INTEGER) AS code, {_case('event_id % 300', protocols.PROTOCOLS, chr(39) + 'Unassigned' + chr(39))} AS name FROM events",
    "ocsf_network_name": _name(ocsf.NETWORK), "ocsf_dns_name": _name(ocsf.DNS), "ocsf_http_name": _name(ocsf.HTTP), "ocsf_file_name": _name(ocsf.FILE),
    "community_id": f"""WITH {_CONN},
x AS (SELECT 'C' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid,
  printf('0A01%02X%02X%04X', l_partkey % 256, l_orderkey % 256, 1024 + l_orderkey % 60000) AS a,
  printf('C63364%02X%04X', l_suppkey % 200, CASE l_returnflag WHEN 'A' THEN 443 WHEN 'R' THEN 53 ELSE 80 END) AS b,
  CASE WHEN l_returnflag = 'R' THEN '11' ELSE '06' END AS proto FROM lineitem),
y AS (SELECT uid, least(a, b) AS lo, greatest(a, b) AS hi, proto FROM x)
SELECT uid, '1:' || to_base64(unhex(sha1(unhex('0000' || left(lo, 8) || left(hi, 8) || proto || '00' || right(lo, 4) || right(hi, 4))))) AS community_id, true AS same FROM y""",
    "ocsf_http_id": f"""WITH v AS (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN {_pick(HTTP_VERBS)} END AS verb FROM events)
  SELECT event_id, verb, {_case('lower(verb)', ocsf.HTTP_VERBS, '99')} AS id FROM v""",
}
