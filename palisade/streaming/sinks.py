"""Streaming sinks: parquet tables, Kafka, and an HTTP event collector.

The event collector is a Python data source. What it sends goes through a transport, a
function (url, headers, body) → status, so that tests and dry runs can put a file or a list in
its place; the default uses the standard library.
"""

from __future__ import annotations

import importlib
import json
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from palisade.operators.detect import details_map

Transport = Callable[[str, dict, bytes], int]


def start(df: DataFrame, path: str, checkpoint: str, name: str | None = None, partition_by: list[str] | None = None, available_now: bool = True) -> StreamingQuery:
    """Appends a stream to a parquet table; readers merge the schemas of its writers."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path).outputMode("append")
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def kafka_rows(df: DataFrame) -> DataFrame:
    """Rows as Kafka values: all columns as JSON text."""
    return df.select(F.to_json(F.struct("*")).alias("value"))


def start_kafka(df: DataFrame, options: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Pushes alerts to a topic; needs Spark's Kafka package on the class path."""
    return kafka_rows(df).writeStream.format("kafka").options(**options).option("checkpointLocation", checkpoint).start()


def http_transport(url: str, headers: dict, body: bytes) -> int:
    request = urllib.request.Request(url, data=body, headers=headers, method="POST")
    with urllib.request.urlopen(request, timeout=60) as answer:  # noqa: S310 - the operator names the URL
        return answer.status


def _transport(name: str | None) -> Transport:
    if not name:
        return http_transport
    module, _, function = name.rpartition(".")
    return getattr(importlib.import_module(module), function)


@dataclass
class Sent(WriterCommitMessage):
    events: int


class _CollectorWriter:
    def __init__(self, options: dict[str, str]):
        self.options = options
        for needed in ("url", "token"):
            if not options.get(needed):
                raise ValueError(f"the event collector needs the option {needed}")

    def write(self, rows: Iterator) -> Sent:
        send = _transport(self.options.get("transport"))
        headers = {"Authorization": f"Splunk {self.options['token']}", "Content-Type": "application/json"}
        time_column, source = self.options.get("time_column"), self.options.get("source")
        limit, sent, batch = int(self.options.get("batch_size", 500)), 0, []

        def flush() -> None:
            nonlocal sent
            if batch:
                status = send(self.options["url"], headers, "\n".join(batch).encode())
                if not 200 <= status < 300:
                    raise RuntimeError(f"the event collector answered {status}")
                sent += len(batch)
                batch.clear()

        for row in rows:
            values = row.asDict(recursive=True)
            event = {"event": {k: v for k, v in values.items() if k != time_column}}
            if time_column and values.get(time_column) is not None:
                event["time"] = values[time_column].timestamp()
            if source:
                event["source"] = source
            batch.append(json.dumps(event, default=str))
            if len(batch) >= limit:
                flush()
        flush()
        return Sent(sent)

    def commit(self, messages, *batch) -> None:
        """Events are delivered at least once; a collector needs no commit."""

    def abort(self, messages, *batch) -> None:
        """What was sent stays sent; the retried batch sends it again."""


class _StreamWriter(_CollectorWriter, DataSourceStreamWriter):
    pass


class _BatchWriter(_CollectorWriter, DataSourceWriter):
    pass


class EventCollector(DataSource):
    """Sink format ``event_collector``: options url, token, time_column, source, batch_size, transport."""

    @classmethod
    def name(cls) -> str:
        return "event_collector"

    def streamWriter(self, schema, overwrite):  # noqa: N802 - names of Spark's interface
        return _StreamWriter(dict(self.options))

    def writer(self, schema, overwrite):
        return _BatchWriter(dict(self.options))


def start_collector(alerts: DataFrame, options: dict[str, str], checkpoint: str) -> StreamingQuery:
    """Pushes alerts to an event collector, their details as a map."""
    alerts.sparkSession.dataSource.register(EventCollector)
    defaults = {"time_column": "detection_time", "source": "palisade"}
    return details_map(alerts).writeStream.format("event_collector").options(**(defaults | options)).option("checkpointLocation", checkpoint).start()
