"""Logs rendered from plain tables, so that parsers can be checked against the columns behind them.

All formulas are integer arithmetic, CASE and concatenation, the same in any SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: (column, SQL expression) of the fields behind each access line of ``events``.
ACCESS_FIELDS = {
    "host": "concat(CASE event_id % 4 WHEN 0 THEN '10.0.' WHEN 1 THEN '192.168.' WHEN 2 THEN '172.16.' ELSE '203.0.' END, CAST(user_id % 256 AS STRING), '.', CAST(event_id % 256 AS STRING))",
    "user": "concat('u', CAST(user_id AS STRING))",
    "method": "CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END",
    "path": "CASE event_type WHEN 'error' THEN concat('/admin/', CAST(event_id % 50 AS STRING)) WHEN 'signup' THEN '/administrator' WHEN 'click' THEN '/x/admin' ELSE concat('/item/', CAST(event_id % 50 AS STRING)) END",
    "code": "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END",
    "size": "CASE WHEN event_id % 10 = 0 THEN '-' ELSE CAST(event_id * 7 % 5000 AS STRING) END",
    "agent": "concat('Agent/', CAST(user_id AS STRING))",
}


def access_lines(events: DataFrame) -> DataFrame:
    """One access line an event; every 97th is garbage, every 11th lacks its last quote."""
    f = {k: F.expr(v) for k, v in ACCESS_FIELDS.items()}
    time = F.date_format(F.col("ts").cast("timestamp"), "dd/MMM/yyyy:HH:mm:ss")
    quote = F.when(F.col("event_id") % 11 == 0, "").otherwise('"')
    line = F.concat(
        f["host"], F.lit(" - "), f["user"], F.lit(" ["), time, F.lit(' +0000] "'), f["method"], F.lit(" "), f["path"], F.lit(' HTTP/1.1" '),
        f["code"].cast("string"), F.lit(" "), f["size"], F.lit(' "-" "'), f["agent"], quote,
    )
    garbage = F.concat(F.lit("garbage "), F.col("event_id").cast("string"))
    return events.select("event_id", F.when(F.col("event_id") % 97 == 0, garbage).otherwise(line).alias("value"))


def conn_json(lineitem: DataFrame) -> DataFrame:
    """One Zeek connection record, as JSON text, a line item; byte counts lack on line 7."""
    counts = F.col("l_linenumber") != 7
    text = lambda c: F.col(c).cast("string")
    record = F.struct(
        (F.unix_seconds(F.col("l_shipdate").cast("timestamp")) + 0.25).alias("ts"),
        F.concat(F.lit("C"), text("l_orderkey"), F.lit("-"), text("l_linenumber")).alias("uid"),
        F.concat(F.lit("10.1."), (F.col("l_partkey") % 256).cast("string"), F.lit("."), (F.col("l_orderkey") % 256).cast("string")).alias("id.orig_h"),
        (1024 + F.col("l_orderkey") % 60000).alias("id.orig_p"),
        F.concat(F.lit("198.51.100."), (F.col("l_suppkey") % 200).cast("string")).alias("id.resp_h"),
        F.when(F.col("l_returnflag") == "A", 443).when(F.col("l_returnflag") == "R", 53).otherwise(80).alias("id.resp_p"),
        F.when(F.col("l_returnflag") == "R", "udp").otherwise("tcp").alias("proto"),
        F.col("l_quantity").alias("duration"),
        F.when(counts, F.col("l_partkey")).alias("orig_bytes"),
        F.when(counts, F.col("l_suppkey")).alias("resp_bytes"),
        F.col("l_linenumber").alias("orig_pkts"),
        (F.col("l_linenumber") + 1).alias("resp_pkts"),
        F.lit("ShADadFf").alias("history"),
    )
    return lineitem.select(F.to_json(record).alias("value"))


def supplier_iocs(supplier: DataFrame) -> DataFrame:
    """Indicators: every tenth supplier's address, with deliberate repeats."""
    ioc = F.concat(F.lit("198.51.100."), (F.col("s_suppkey") % 200).cast("string")).alias("ioc")
    kind = F.when(F.col("s_suppkey") % 30 == 0, "URL").otherwise("IPv4").alias("ioc_type")
    first = supplier.where(F.col("s_suppkey") % 10 == 0).select(kind, ioc)
    return first.unionAll(supplier.where(F.col("s_suppkey") % 20 == 0).select(F.lit("IPv4").alias("ioc_type"), ioc))


def http_json(http: DataFrame) -> DataFrame:
    """Zeek HTTP records, as JSON text, of the HTTP table with whole seconds."""
    record = F.struct(
        F.unix_seconds("timestamp").cast("double").alias("ts"), "uid", "trans_depth", F.col("id_origin_host").alias("id.orig_h"),
        F.col("id_origin_port").alias("id.orig_p"), F.col("id_response_host").alias("id.resp_h"), F.col("id_response_port").alias("id.resp_p"),
        "host", "method", "uri", "user_agent", "version", "status_code",
    )
    return http.select(F.to_json(record).alias("value"))


def trail_documents(orders: DataFrame) -> DataFrame:
    """One CloudTrail document, as JSON text, an order: one record with 0 to 2 resources."""
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    final = F.col("o_orderstatus") == "F"
    account = lambda c: F.struct(F.lit(c).alias("accountId"))
    resources = F.when(key % 3 == 1, F.array(account("A"))).when(key % 3 == 2, F.array(account("A"), account("B")))
    session = F.struct(F.struct((key % 2 == 0).cast("string").alias("mfaAuthenticated")).alias("attributes"))
    identity = F.struct(F.lit("IAMUser").alias("type"), F.concat(F.lit("user"), (key % 100).cast("string")).alias("userName"), session.alias("sessionContext"))
    record = F.struct(
        text.alias("eventID"), F.when(final, "GetObject").otherwise("PutObject").alias("eventName"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"),
        final.alias("readOnly"), identity.alias("userIdentity"), resources.alias("resources"),
    )
    return orders.select(F.to_json(F.struct(F.array(record).alias("Records"))).alias("value"))


_N = "CAST(doc_id % 300 AS STRING)"
#: hash fields and the divisor of doc_id at which a message lacks them
HASH_FIELDS = {"md5_hash": 2, "imphash": 3, "sha1_hash": 5, "sha256_hash": 7, "sha3_384_hash": 11, "ssdeep": 13, "telfhash": 17, "tlsh": 19}


def envelopes(documents: DataFrame) -> DataFrame:
    """Threat-intel envelopes, as Kafka rows, of the documents; feeds and other data sets take turns."""
    n = F.expr(_N)
    stamp = F.lit("2024-03-05 06:07:08 UTC")
    hashes = lambda names: [F.when(F.col("doc_id") % HASH_FIELDS[h] != 0, F.sha2(F.concat(F.lit(h), n), 256)).alias(h) for h in names]
    otx = F.to_json(F.struct(F.col("doc_id").alias("id"), F.concat(F.lit("198.51.100."), n).alias("indicator"), F.lit("IPv4").alias("type"), F.lit("t").alias("title")))
    url = F.to_json(F.struct(F.concat(F.lit("http://h"), n, F.lit(".example/x")).alias("url"), n.alias("id"), stamp.alias("date_added"), F.array(F.lit("elf")).alias("tags")))
    bazaar = F.to_json(F.struct(*hashes(HASH_FIELDS), F.concat(F.lit("f"), n).alias("file_name"), F.col("doc_id").alias("file_size"), stamp.alias("first_seen")))
    malware = F.to_json(F.struct(*hashes(["md5_hash", "imphash", "sha256_hash", "ssdeep", "tlsh"]), F.col("doc_id").cast("string").alias("file_size"), stamp.alias("firstseen")))
    turn = F.col("doc_id") % 5
    message = F.when(turn == 0, otx).when(turn == 1, url).when(turn == 2, bazaar).when(turn == 3, malware).otherwise(F.concat(F.lit("note "), n))
    name = F.element_at(F.array(*map(F.lit, ("otx", "abuseurl", "malwarebazaar", "abusemalware", "other"))), (turn + 1).cast("int"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id") * 60)
    envelope = F.struct(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("@timestamp"), F.struct(name.alias("name")).alias("fileset"),
        F.struct(F.lit("threatintel").alias("type")).alias("service"), message.alias("message"),
    )
    return documents.select(
        F.lit(None).cast("binary").alias("key"), F.to_json(envelope).cast("binary").alias("value"), F.lit("iocs").alias("topic"), F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"), at.alias("timestamp"), F.lit(0).alias("timestampType"),
    )
