"""Flows: named streaming queries that append to tables, each with its own checkpoint.

Several flows may share a target (Apache and Nginx lines, two writers of the HTTP table, two
detections); flows can be added and removed without touching the others. A table's rows are
found by the next stage as new files, so stages form a chain without further coordination.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from palisade.config import LOG_TYPES, PipelineConfig, flow_name
from palisade.operators import detect, feeds, normalize, parsers
from palisade.operators.insert_new import ParquetTarget
from palisade.sources import readers
from palisade.sources.schemas import ALERTS, DEMO_IOCS, GOLD_STUB, IOC_LIST, OCSF_HTTP, OCSF_NETWORK
from palisade.storage import _fs
from palisade.streaming import sinks


@dataclass(frozen=True)
class Flow:
    name: str
    target: str
    build: Callable[[SparkSession], DataFrame]


class Runner:
    """Runs flows below one root folder: ``tables/<target>/<flow>`` and ``checkpoints/<flow>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.flows = spark, root.rstrip("/"), {}

    def table(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def add(self, flow: Flow) -> None:
        if flow.name in self.flows:
            raise ValueError(f"two flows are named {flow.name}")
        self.flows[flow.name] = flow

    def _parts(self, name: str) -> list[str]:
        """Folders of a table: one a flow that feeds it, for a file sink's log admits one writer."""
        feeding = [f"{self.table(name)}/{f.name}" for f in self.flows.values() if f.target == name]
        return feeding or [self.table(name)]

    def run(self, *names: str) -> None:
        """Drains the named flows (all, if none is named), one after the other, and stops."""
        for name in names or list(self.flows):
            f = self.flows[name]
            query = sinks.start(f.build(self.spark), f"{self.table(f.target)}/{f.name}", f"{self.root}/checkpoints/{f.name}", f.name)
            query.awaitTermination()

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """All committed rows of a table, columns by name; parts that were never written are left out."""
        parts = []
        for path in self._parts(name):
            fs, p = _fs(self.spark, path)
            if fs.exists(p) and len(fs.listStatus(p)):
                reader = self.spark.read.schema(schema) if schema else self.spark.read.option("mergeSchema", "true")
                parts.append(reader.parquet(path))
        return normalize.merge_schemas(*parts)

    def stream(self, name: str, schema: str | None = None) -> DataFrame:
        """New rows of a table; the schema is the table's own unless one is given."""
        schema = schema or self.read(name).schema
        for path in self._parts(name):
            fs, p = _fs(self.spark, path)
            fs.mkdirs(p)
        return normalize.merge_schemas(*(self.spark.readStream.schema(schema).parquet(path) for path in self._parts(name)))


def access_flows(runner: Runner, *paths: str) -> None:
    """One flow a location of access logs, all into ``apache_web``."""
    for path in paths:
        runner.add(Flow(f"apache_web_{flow_name(path)}", "apache_web", lambda s, p=path: readers.read_access(s, p)))


def ingest_flows(runner: Runner, logs: str) -> None:
    """Silver tables of all log types below ``logs``, then the gold tables fed from them."""
    access_flows(runner, f"{logs}/apache", f"{logs}/nginx")
    runner.add(Flow("zeek_conn", "zeek_conn", lambda s: readers.read_zeek_conn(s, f"{logs}/zeek_conn")))
    runner.add(Flow("zeek_http", "zeek_http", lambda s: readers.read_zeek_http(s, f"{logs}/zeek_http")))
    runner.add(Flow("aws_cloudtrail", "aws_cloudtrail", lambda s: readers.read_cloudtrail(s, f"{logs}/cloudtrail")))
    for source, target, shape in (
        ("apache_web", "http", normalize.normalize_access),
        ("zeek_http", "http", normalize.normalize_zeek_http),
        ("zeek_conn", "network", normalize.normalize_zeek_conn),
    ):
        runner.add(Flow(f"{source}_normalized", target, lambda s, n=source, f=shape: f(runner.stream(n))))


def detection_flows(runner: Runner) -> None:
    """Both detections, into one table, from the gold tables and the indicator list."""
    runner.add(Flow("match_network_iocs", "detections", lambda s: detect.detect_network_iocs(runner.stream("network", OCSF_NETWORK), runner.read("iocs", IOC_LIST))))
    runner.add(Flow("check_http_logs_admin_scan", "detections", lambda s: detect.detect_admin_scans(runner.stream("http", OCSF_HTTP))))


def run_all(runner: Runner, logs: str) -> None:
    """Everything in order: setup, ingestion and normalization of all log types, detections."""
    setup(runner, logs)
    ingest_flows(runner, logs)
    runner.run()
    detection_flows(runner)
    runner.run("match_network_iocs", "check_http_logs_admin_scan")


def push_alerts(runner: Runner, config: PipelineConfig, secrets: dict[str, str], collector_options: dict[str, str] | None = None) -> list[str]:
    """Starts the pushes that the settings turn on; returns which."""
    started = []
    alerts = lambda: runner.stream("detections", ALERTS)
    if config.pushes_to_kafka:
        options = readers.kafka_sink_options(config.eventhub_namespace, config.eventhub_topic, secrets["id"], secrets["secret"], config.azure_tenant_id)
        sinks.start_kafka(alerts(), options, f"{runner.root}/checkpoints/push_kafka")
        started.append("kafka")
    if config.pushes_to_splunk:
        options = {"url": config.splunk_url, "token": config.splunk_hec_token} | (collector_options or {})
        query = sinks.start_collector(alerts(), options, f"{runner.root}/checkpoints/push_collector")
        query.processAllAvailable()
        query.stop()
        started.append("collector")
    return started


def setup(runner: Runner, logs: str) -> None:
    """Folders of all log types and the demonstration indicator list, replaced if there is one."""
    for kind in LOG_TYPES:
        fs, path = _fs(runner.spark, f"{logs}/{kind}")
        fs.mkdirs(path)
    runner.spark.createDataFrame(DEMO_IOCS, IOC_LIST).write.mode("overwrite").parquet(runner.table("iocs"))


def create_gold_tables(spark: SparkSession, schema: str) -> None:
    """Catalog tables of the gold level, with the columns every writer has; existing ones stay."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name in ("http", "network"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({GOLD_STUB}) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.iocs ({IOC_LIST}) USING parquet COMMENT 'Indicators that detections join with'")


def _merge_into(target: ParquetTarget, keys: list[str], order_by: list[str], guard: tuple[str, int] | None = None):
    def each(batch: DataFrame, epoch: int) -> None:
        target.insert_new(batch, keys, order_by, guard)

    return each


def ingest_intel(spark: SparkSession, root: str, kafka_rows: DataFrame, match_only_recent_days: int | None = None) -> None:
    """Bronze: envelopes of a stream of Kafka rows, one row a message hash, partitioned by date.

    ``match_only_recent_days`` lets only batch rows of the last days match stored ones; older
    ones are then inserted even if they are there. It is off by default.
    """
    target = ParquetTarget(spark, f"{root}/bronze/threatintel", partition_by=["date"])
    guard = ("date", match_only_recent_days) if match_only_recent_days is not None else None
    query = (
        parsers.decode_envelope(kafka_rows)
        .writeStream.option("checkpointLocation", f"{root}/checkpoints/threatintel-bronze")
        .trigger(availableNow=True)
        .foreachBatch(_merge_into(target, ["msg_hash"], ["kafka_ts", "offset"], guard))
        .start()
    )
    query.awaitTermination()


def ingest_feeds(spark: SparkSession, root: str, only: list[str] | None = None) -> None:
    """Silver: the feeds, one after the other, each with its own reader and checkpoint of bronze.

    All go into one table, one row an indicator, partitioned by type; the first writer wins.
    """
    bronze = f"{root}/bronze/threatintel"
    target = ParquetTarget(spark, f"{root}/silver/iocs", partition_by=["ioc_type"])
    schema = spark.read.option("mergeSchema", "true").parquet(bronze).schema
    for name in only or list(feeds.FEEDS):
        rows = parsers.decode_message(spark.readStream.schema(schema).parquet(bronze))
        query = (
            feeds.FEEDS[name](rows)
            .writeStream.option("checkpointLocation", f"{root}/checkpoints/threatintel-silver-{name}")
            .trigger(availableNow=True)
            .foreachBatch(_merge_into(target, ["ioc_type", "ioc"], ["first_seen", "msg_hash"]))
            .start()
        )
        query.awaitTermination()
