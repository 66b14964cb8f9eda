"""Names of tables and flows, and the settings of the pipelines."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

NETWORK_TABLE, HTTP_TABLE, IOCS_TABLE, DETECTIONS_TABLE = "network", "http", "iocs", "detections"
FLOW_NAME_LENGTH = 20


def _conf(spark: SparkSession | None, level: str, part: str) -> str:
    spark = spark or SparkSession.getActiveSession()
    return (spark.conf.get(f"conf.{level}_{part}_name", "") or "") if spark else ""


def qualified_table_name(level: str, name: str, spark: SparkSession | None = None) -> str:
    """``name`` with the catalog and schema set for ``level`` (bronze, silver, gold).

    Neither set: the bare name. A schema alone is fine, a catalog alone a ValueError.
    """
    catalog, schema = _conf(spark, level, "catalog"), _conf(spark, level, "schema")
    if catalog and not schema:
        raise ValueError(f"the {level} catalog {catalog} needs a schema")
    return ".".join(p for p in (catalog, schema, name) if p)


def normalized_table_name(name: str, catalog: str | None = None, schema: str | None = None, spark: SparkSession | None = None) -> str:
    """Full name of a gold table; catalog and schema by argument or by setting, both are required."""
    catalog = catalog or _conf(spark, "gold", "catalog")
    schema = schema or _conf(spark, "gold", "schema")
    if not catalog or not schema:
        raise ValueError("the gold tables need a catalog and a schema, by argument or by setting")
    return f"{catalog}.{schema}.{name}"


def flow_name(path: str) -> str:
    """A name for the flow of a location: its last characters, others than letters and digits as ``_``.

    Locations that end alike get the same name; a runner refuses to start two of one name.
    """
    return re.sub("[^0-9A-Za-z]+", "_", path)[-FLOW_NAME_LENGTH:].strip("_")


@dataclass(frozen=True)
class PipelineConfig:
    """All settings. Only the first four have no default; the pushes are off unless ``"true"``."""

    catalog_name: str
    silver_schema_name: str
    normalized_schema_name: str
    log_files_path: str
    push_to_eventhubs: str = "false"
    secret_scope_name: str = ""
    sp_id_key_name: str = ""
    sp_secret_key_name: str = ""
    azure_tenant_id: str = ""
    eventhub_namespace: str = ""
    eventhub_topic: str = ""
    push_to_splunk: str = "false"
    splunk_url: str = ""
    splunk_hec_token: str = field(default="", repr=False)

    def __post_init__(self) -> None:
        missing = [f.name for f in fields(self)[:4] if not getattr(self, f.name)]
        if missing:
            raise ValueError(f"missing settings: {', '.join(missing)}")

    @property
    def pushes_to_kafka(self) -> bool:
        return self.push_to_eventhubs == "true"

    @property
    def pushes_to_splunk(self) -> bool:
        return self.push_to_splunk == "true"

    def apply(self, spark: SparkSession) -> None:
        """Sets what the name functions read. Silver names stay unqualified: the default schema holds them."""
        spark.conf.set("conf.gold_catalog_name", self.catalog_name)
        spark.conf.set("conf.gold_schema_name", self.normalized_schema_name)


#: log types with their own folder
LOG_TYPES = ("apache", "nginx", "zeek_conn", "zeek_http", "cloudtrail")
