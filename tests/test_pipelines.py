import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from palisade.config import PipelineConfig, flow_name, normalized_table_name, qualified_table_name
from palisade.operators import detect, feeds, insert_new, normalize, parsers
from palisade.sources import readers
from palisade.streaming import runner as runner_module
from palisade.streaming.runner import Flow, Runner

GOOD = '10.0.0.1 - bob [05/Mar/2025:08:05:03 +0200] "GET /admin/x HTTP/1.1" 200 12 "-" "Agent/1.0 (a; b)"'


def lines(spark, *values):
    return parsers.parse_access(spark.createDataFrame([(v,) for v in values], "value string"))


def test_access_line(spark):
    r = lines(spark, GOOD).first()
    assert (r.value, r.host, r.user, r.code, r.size, r.referrer, r.agent) == (GOOD, "10.0.0.1", "bob", 200, 12, "-", "Agent/1.0 (a; b)")
    assert (r.method, r.path, r.version) == ("GET", "/admin/x", "HTTP/1.1")
    assert r.timestamp.isoformat() == "2025-03-05T06:05:03" and r.ingest_time is not None


@pytest.mark.parametrize("line", ["garbage", "", GOOD.replace('"-"', '""'), "x" * 200_000])
def test_unmatched_lines_stay(spark, line):
    r = lines(spark, line).first()
    assert (r.host, r.user, r.referrer, r.agent, r.method, r.path, r.version) == ("",) * 7
    assert (r.timestamp, r.code, r.size) == (None,) * 3 and r.value == line


def test_access_variants(spark):
    got = lines(spark, GOOD[:-1], GOOD.replace(" 12 ", " - "), GOOD.replace("GET /admin/x HTTP/1.1", "-"), GOOD.replace("05/Mar", "35/Mar"), None).collect()
    assert got[0].agent == "Agent/1.0 (a; b)" and got[1].size is None and got[1].host == "10.0.0.1"
    assert got[2].method == "" and got[2].host == "10.0.0.1" and got[3].timestamp is None and got[3].host == "10.0.0.1"
    assert got[4].host is None and got[4].path is None


def test_zeek_and_gold(spark, tmp_path):
    conn = {"ts": 1741180596.25, "uid": "C1", "id.orig_h": "10.0.0.1", "id.orig_p": 1, "id.resp_h": "192.0.2.10", "id.resp_p": 443, "proto": "tcp", "duration": 0.25, "orig_bytes": 3, "resp_bytes": None}
    os.makedirs(tmp_path / "conn")
    with gzip.open(tmp_path / "conn/a.log.gz", "wt") as f:
        f.write(json.dumps(conn) + "\n" + json.dumps(conn | {"uid": "C2", "resp_bytes": 4, "missed_bytes": 1}) + "\n")
    silver = readers.read_zeek_conn(spark, str(tmp_path / "conn"), streaming=False).orderBy("uid")
    assert "origin_bytes" in silver.columns and "id.orig_h" not in silver.columns
    gold = normalize.normalize_zeek_conn(silver).collect()
    assert gold[0].duration == 250.0 and gold[0].traffic.bytes is None and gold[1].traffic.bytes == 7 and gold[0].traffic.bytes_missed is None
    assert gold[0].time.isoformat() == "2025-03-05T13:16:36.250000" and gold[0].type_uid == 400199
    iocs = spark.createDataFrame([("IPv4", "192.0.2.10"), ("IPv4", "192.0.2.10"), ("URL", "192.0.2.10"), (None, None)], "ioc_type string, ioc string")
    network = normalize.normalize_zeek_conn(silver)
    assert detect.ioc_matches(network, iocs).count() == 4  # a repeated indicator repeats the match
    assert detect.ioc_matches(network, iocs, limit=1).count() == 4  # without broadcast
    alert = detect.detect_network_iocs(network, iocs).first()
    assert alert.detection_type == "ioc_match" and json.loads(alert.details)["ioc_type"] == "IPv4"


def test_admin_scan_cases(spark):
    rows = [("/admin", "172.16.0.1"), ("/administrator", "8.8.8.8"), ("/Admin", "8.8.8.8"), ("/admin", "10.1.1.1"), ("/admin", "192.168.1.1"), ("/admin", None), (None, "8.8.8.8")]
    http = spark.createDataFrame(rows, "u string, i string").select(F.struct(F.col("u").alias("url")).alias("http_request"), F.struct(F.col("i").alias("ip")).alias("src_endpoint"))
    assert {(r.http_request.url, r.src_endpoint.ip) for r in detect.admin_scans(http).collect()} == {("/admin", "172.16.0.1"), ("/administrator", "8.8.8.8")}


def test_http_union_has_all_fields(spark):
    empty = spark.createDataFrame([], "timestamp timestamp, uid string, id_origin_host string, id_origin_port int, id_response_host string, id_response_port int, host string, method string, uri string, user_agent string, version string, status_code int, ingest_time timestamp")
    both = normalize.merge_schemas(normalize.normalize_access(lines(spark, GOOD)), normalize.normalize_zeek_http(empty))
    r = both.first()
    assert r.dst_endpoint is None and r.src_endpoint.port is None and r.metadata.uid is None and r.http_request.referrer == "-"


def trail(spark, *docs):
    return parsers.parse_cloudtrail(spark.createDataFrame([(d,) for d in docs], "j string").select(F.try_parse_json("j").alias("_raw")))


def test_cloudtrail(spark):
    record = {"eventID": "e", "eventTime": "2025-03-05T00:00:00Z", "readOnly": "false", "userIdentity": {"sessionContext": {"sessionIssuer": {"userName": "u"}}}}
    docs = [{"Records": [record, record | {"eventID": "f", "eventTime": "soon", "resources": [{"accountId": "A"}, {"accountId": "B"}]}, record | {"eventID": "g", "resources": None}]}, {"other": 1}]
    got = trail(spark, *map(json.dumps, docs), "{broken", None)
    assert len(got.columns) == 42
    rows = got.select("event_id", "event_time", "read_only", "resources_account_id", "user_identity_session_context_sesion_issuer_user_name").collect()
    assert sorted((r[0], r[3]) for r in rows if r[3]) == [("f", "A"), ("f", "B")] and len(rows) == 4
    assert rows[0][1].year == 2025 and rows[0][2] is False and rows[0][4] == "u" and next(r for r in rows if r[0] == "f")[1] is None


def kafka(spark, *messages):
    rows = [(None, bytearray(m.encode()) if m is not None else None, "iocs", 0, i, None, 0) for i, m in enumerate(messages)]
    return spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int")


def envelope(dataset, message):
    return json.dumps({"@timestamp": "2024-03-05T06:07:08Z", "fileset": {"name": dataset}, "service": {"type": "threatintel"}, "message": message})


def test_envelope_and_feeds(spark):
    mb = json.dumps({"md5_hash": "m", "sha3_384_hash": "s", "first_seen": "2024-01-02 03:04:05 UTC", "file_size": 5})
    rows = kafka(spark, envelope("malwarebazaar", mb), envelope("otx", json.dumps({"indicator": None, "type": "IPv4", "id": 3})), envelope("abuseurl", json.dumps({"url": "u", "date_added": "bad"})), envelope("abusemalware", json.dumps({"file_size": "x"})), "{broken", None)
    bronze = parsers.decode_envelope(rows)
    assert "timestampType" not in bronze.columns and bronze.where("dataset is null").count() == 2
    found = feeds.all_feeds(parsers.decode_message(bronze)).select("dataset", "ioc_type", "ioc", "first_seen").collect()
    assert sorted((r[0], r[1], r[2] or "") for r in found) == [("abuseurl", "URL", "u"), ("malwarebazaar", "FileHash-MD5", "m"), ("malwarebazaar", "FileHash-SHA384", "s"), ("otx", "IPv4", "")]
    assert next(r for r in found if r[0] == "abuseurl").first_seen is None


def test_insert_new(spark, tmp_path):
    target = insert_new.ParquetTarget(spark, str(tmp_path / "t"))
    df = lambda *rows: spark.createDataFrame(list(rows), "k string, v int")
    target.insert_new(df(), ["k"])
    assert not target.exists()
    target.insert_new(df(("a", 2), ("a", 1), (None, 5)), ["k"], ["v"])
    target.insert_new(df(("a", 0), ("b", 3), (None, 6)), ["k"], ["v"])
    assert sorted((r.k or "", r.v) for r in target.read().collect()) == [("", 5), ("", 6), ("a", 1), ("b", 3)]
    with pytest.raises(ValueError):
        insert_new.ParquetTarget(spark)


def test_insert_new_guard_and_table(spark):
    spark.sql("DROP TABLE IF EXISTS merge_target")
    target = insert_new.ParquetTarget(spark, name="merge_target", partition_by=["d"])
    day = lambda k, d: spark.sql(f"SELECT '{k}' k, DATE'{d}' d")
    target.insert_new(day("a", "2020-01-01"), ["k"])
    target.insert_new(day("a", "2020-01-01"), ["k"])
    assert target.read().count() == 1
    target.insert_new(day("a", "2020-01-01"), ["k"], match_only_recent_days=("d", 10))  # too old to match: inserted again
    assert target.read().count() == 2


def test_names(spark):
    for k in ("catalog", "schema"):
        spark.conf.unset(f"conf.gold_{k}_name")
    assert flow_name("/Volumes/cybersecurity/logs/logs/demo/logs/apache/") == "gs_demo_logs_apache"
    assert qualified_table_name("silver", "x", spark) == "x"
    with pytest.raises(ValueError):
        normalized_table_name("http", spark=spark)
    spark.conf.set("conf.gold_catalog_name", "c")
    with pytest.raises(ValueError):
        qualified_table_name("gold", "x", spark)
    config = PipelineConfig("c", "s", "g", "/logs")
    config.apply(spark)
    assert normalized_table_name("http", spark=spark) == "c.g.http" == qualified_table_name("gold", "http", spark)
    assert normalized_table_name("http", "a", "b", spark) == "a.b.http" and not config.pushes_to_kafka
    with pytest.raises(ValueError):
        PipelineConfig("c", "", "g", "/logs")
    for k in ("catalog", "schema"):
        spark.conf.unset(f"conf.gold_{k}_name")


SENT: list[str] = []


def to_file(url, headers, body):
    with open(url.removeprefix("file:"), "ab") as f:
        f.write(body + b"\n")
    return 200


def test_stream_end_to_end(spark, tmp_path):
    logs, root = str(tmp_path / "logs"), str(tmp_path / "root")
    run = Runner(spark, root)
    runner_module.setup(run, logs)
    outside = GOOD.replace("10.0.0.1", "203.0.113.9")
    with open(f"{logs}/apache/a.log", "w") as f:
        f.write(f"{GOOD}\n{outside}\n")
    with open(f"{logs}/nginx/b.log", "w") as f:
        f.write(f"{outside}\nbroken\n")
    conn = {"ts": 1.5, "uid": "C1", "id.orig_h": "10.0.0.1", "id.resp_h": "192.0.2.10", "duration": 1.0}
    with open(f"{logs}/zeek_conn/c.log", "w") as f:
        f.write(json.dumps(conn) + "\n")
    with open(f"{logs}/zeek_http/d.log", "w") as f:
        f.write(json.dumps({"ts": 1.5, "uid": "C1", "id.orig_h": "9.9.9.9", "uri": "/admin", "status_code": 200}) + "\n")
    with open(f"{logs}/cloudtrail/e.json", "w") as f:
        f.write(json.dumps({"Records": [{"eventID": "e"}]}) + "\n")
    runner_module.ingest_flows(run, logs)
    with pytest.raises(ValueError):
        runner_module.access_flows(run, f"{logs}/apache")
    run.run()
    assert run.read("apache_web").count() == 4 and run.read("http").count() == 5 and run.read("aws_cloudtrail").count() == 1
    batch = detect.detect_admin_scans(run.read("http")).count()
    runner_module.detection_flows(run)
    run.run("match_network_iocs", "check_http_logs_admin_scan")
    kinds = [r.detection_type for r in run.read("detections").collect()]
    assert kinds.count("http_admin_page_scan") == batch == 3 and kinds.count("ioc_match") == 1
    run.run()  # a second run finds nothing new
    assert run.read("detections").count() == 4 and run.read("http").count() == 5
    with open(f"{logs}/nginx/late.log", "w") as f:
        f.write(outside + "\n")
    run.run()
    assert run.read("detections").count() == 5
    config = PipelineConfig("c", "s", "g", logs, push_to_splunk="true", splunk_url=f"file:{tmp_path}/sent", splunk_hec_token="t")
    assert runner_module.push_alerts(run, config, {}, {"transport": "tests.test_pipelines.to_file"}) == ["collector"]
    sent = [json.loads(x) for x in open(tmp_path / "sent")]
    assert len(sent) == 5 and all("time" in e and e["source"] == "palisade" for e in sent) and isinstance(sent[0]["event"]["details"], dict)


def test_intel_streams(spark, tmp_path):
    root, inbox = str(tmp_path), str(tmp_path / "inbox")
    url = lambda i: envelope("abuseurl", json.dumps({"url": f"u{i}", "id": str(i)}))
    schema = kafka(spark).schema if False else "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"
    source = lambda: spark.readStream.schema(schema).parquet(inbox)
    kafka(spark, url(1), url(1), url(2), envelope("other", "x")).write.parquet(inbox)
    runner_module.ingest_intel(spark, root, source())
    runner_module.ingest_feeds(spark, root)
    kafka(spark, url(2), url(3)).write.mode("append").parquet(inbox)
    runner_module.ingest_intel(spark, root, source())
    runner_module.ingest_feeds(spark, root)
    assert spark.read.parquet(f"{root}/bronze/threatintel").count() == 4
    assert sorted(r.ioc for r in spark.read.parquet(f"{root}/silver/iocs").collect()) == ["u1", "u2", "u3"]


def test_kafka_options():
    source = readers.kafka_source_options("ns", "t", "secret", 8)
    assert source["minPartitions"] == "8" and source["startingOffsets"] == "earliest" and source["subscribe"] == "t"
    sink = readers.kafka_sink_options("ns", "t", "i", "s", "tenant")
    assert sink["kafka.sasl.mechanism"] == "OAUTHBEARER" and sink["topic"] == "t"


def test_gold_catalog_tables(spark):
    runner_module.create_gold_tables(spark, "gold_test")
    runner_module.create_gold_tables(spark, "gold_test")
    assert spark.table("gold_test.http").columns == ["activity_id", "category_uid", "class_uid", "time"]


def test_flow_names_are_unique(spark, tmp_path):
    run = Runner(spark, str(tmp_path))
    run.add(Flow("a", "t", lambda s: None))
    with pytest.raises(ValueError):
        run.add(Flow("a", "u", lambda s: None))


def test_access_lines_with_control_characters(spark):
    """The byte that the parser puts between groups may stand in a line as well."""
    from palisade.operators import parsers

    c = chr(1)
    lines = [f'1.2.3.4 - u{c}z [04/May/2025:16:05:05 +0000] "GET /a{c}b HTTP/1.1" 200 5 "r{c}" "ag{c}ent"', f"{c}junk", f'{c} - u [x] "GET / HTTP/1.1" 200 5 "r" "a"']
    got = parsers.parse_access(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert (got[0].host, got[0].user, got[0].path, got[0].code, got[0].referrer, got[0].agent) == ("1.2.3.4", f"u{c}z", f"/a{c}b", 200, f"r{c}", f"ag{c}ent")
    assert (got[1].host, got[1].code, got[1].agent) == ("", None, "") and (got[2].host, got[2].user, got[2].agent) == (c, "u", "a")
