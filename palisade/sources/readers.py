"""Batch and streaming readers of log files and message queues.

A file stream finds new files by itself and keeps what it has read in the query's
checkpoint; ``.gz`` files are read by their extension. Options of the caller override the
defaults. Schemas are always explicit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palisade.operators import parsers
from palisade.sources.schemas import ZEEK_CONN, ZEEK_HTTP


def _reader(spark: SparkSession, streaming: bool, options: dict[str, str] | None, **defaults: str):
    base = spark.readStream if streaming else spark.read
    return base.options(**(defaults | (options or {})))


def read_access(spark: SparkSession, path: str, options: dict[str, str] | None = None, streaming: bool = True) -> DataFrame:
    """Lines of access logs (Apache or Nginx), parsed."""
    return parsers.parse_access(_reader(spark, streaming, options).format("text").load(path))


def read_zeek_conn(spark: SparkSession, path: str, options: dict[str, str] | None = None, streaming: bool = True) -> DataFrame:
    """JSON lines of Zeek connection logs, parsed."""
    return parsers.parse_zeek_conn(_reader(spark, streaming, options).schema(ZEEK_CONN).format("json").load(path))


def read_zeek_http(spark: SparkSession, path: str, options: dict[str, str] | None = None, streaming: bool = True) -> DataFrame:
    """JSON lines of Zeek HTTP logs, parsed."""
    return parsers.parse_zeek_http(_reader(spark, streaming, options).schema(ZEEK_HTTP).format("json").load(path))


def read_cloudtrail(spark: SparkSession, path: str, options: dict[str, str] | None = None, streaming: bool = True) -> DataFrame:
    """CloudTrail documents, each as one variant, parsed; malformed documents give no row."""
    return parsers.parse_cloudtrail(_reader(spark, streaming, options, singleVariantColumn="_raw").format("json").load(path))


def kafka_source_options(namespace: str, topic: str, connection_string: str, cores: int) -> dict[str, str]:
    """Options of a Kafka source with SASL PLAIN, from the earliest offset, one partition a core at least."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": f"{namespace}.servicebus.windows.net:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f'{login} required username="$ConnectionString" password="{connection_string}";',
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
        "startingOffsets": "earliest",
        "minPartitions": str(cores),
        "subscribe": topic,
    }


def kafka_sink_options(namespace: str, topic: str, client_id: str, client_secret: str, tenant: str) -> dict[str, str]:
    """Options of a Kafka sink with OAUTHBEARER client credentials."""
    server = f"{namespace}.servicebus.windows.net"
    login = "org.apache.kafka.common.security.oauthbearer.OAuthBearerLoginModule"
    return {
        "kafka.bootstrap.servers": f"{server}:9093",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "OAUTHBEARER",
        "kafka.sasl.jaas.config": f'{login} required clientId="{client_id}" clientSecret="{client_secret}" scope="https://{server}/.default";',
        "kafka.sasl.oauthbearer.token.endpoint.url": f"https://login.microsoftonline.com/{tenant}/oauth2/v2.0/token",
        "kafka.sasl.login.callback.handler.class": "org.apache.kafka.common.security.oauthbearer.secured.OAuthBearerLoginCallbackHandler",
        "kafka.request.timeout.ms": "60000",
        "kafka.session.timeout.ms": "30000",
        "topic": topic,
    }


def read_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Bronze rows of a topic; needs Spark's Kafka package on the class path."""
    return parsers.decode_envelope(spark.readStream.format("kafka").options(**options).load())


def source_parallelism(spark: SparkSession) -> int:
    """Cores of the cluster, as partitions of sources and shuffles follow them."""
    return spark.sparkContext.defaultParallelism
