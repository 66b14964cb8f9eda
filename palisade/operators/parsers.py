"""Raw logs → silver tables. All functions work on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palisade.operators.loglines import ACCESS_PATTERN
from palisade.sources.schemas import ENVELOPE

# Fixed value: the request within an access line.
REQUEST_PATTERN = r"(\w+) (\S+) (.+)"
ACCESS_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
SEPARATOR = chr(1)
_GROUPS = (1, 3, 4, 5, 6, 7, 8, 9)


def parse_access(df: DataFrame, line: str = "value") -> DataFrame:
    """Access lines → value, host, user, timestamp, code, size, referrer, agent, ingest_time, method, path, version.

    Every line stays a row. One that does not match has '' in the text columns and null in the
    others; so has a line with an empty quoted field, which does not match as a whole. A size
    of ``-`` and an unreadable time are null. A null line gives nulls.
    """
    # The pattern is matched once a line: it is replaced by its groups, which are then split. A line that
    # does not match stays as it is and so lacks the leading separator. Lines that hold the separator
    # themselves, which are rare, have their groups taken one by one.
    joined = F.regexp_replace(F.col(line), ACCESS_PATTERN, SEPARATOR + SEPARATOR.join(f"${i}" for i in _GROUPS))
    holds = F.col(line).contains(SEPARATOR)
    singly = F.array(F.lit(""), *(F.regexp_extract(F.col(line), ACCESS_PATTERN, i) for i in _GROUPS))
    groups = F.when(holds, singly).when(joined.startswith(SEPARATOR), F.split(joined, SEPARATOR)).when(F.col(line).isNotNull(), F.array_repeat(F.lit(""), 9))
    parts = df.withColumn("_g", groups)
    group = lambda i: F.col("_g")[i]
    parts = parts.withColumns(
        {
            "host": group(1), "user": group(2), "timestamp": F.try_to_timestamp(group(3), F.lit(ACCESS_TIME)), "_request": group(4),
            "code": group(5).try_cast("int"), "size": group(6).try_cast("long"), "referrer": group(7), "agent": group(8),
            "ingest_time": F.current_timestamp(),
        }
    ).drop("_g")
    word = lambda i: F.regexp_extract("_request", REQUEST_PATTERN, i)
    return parts.withColumns({"method": word(1), "path": word(2), "version": word(3)}).drop("_request")


# Zeek field names and their names here.
ZEEK_HTTP_NAMES = {"id.orig_h": "id_origin_host", "id.orig_p": "id_origin_port", "id.resp_h": "id_response_host", "id.resp_p": "id_response_port", "ts": "timestamp"}
ZEEK_CONN_NAMES = ZEEK_HTTP_NAMES | {
    "orig_bytes": "origin_bytes", "resp_bytes": "response_bytes", "orig_pkts": "origin_packets", "orig_ip_bytes": "origin_ip_bytes",
    "resp_pkts": "response_packets", "resp_ip_bytes": "response_ip_bytes", "local_orig": "local_origin", "local_resp": "local_response",
    "resp_l2_addr": "response_l2_address", "orig_l2_addr": "origin_l2_address",
}


def _zeek(df: DataFrame, names: dict[str, str]) -> DataFrame:
    renamed = df.withColumnsRenamed(names)
    return renamed.withColumns({"timestamp": F.col("timestamp").cast("timestamp"), "ingest_time": F.current_timestamp()})


def parse_zeek_conn(df: DataFrame) -> DataFrame:
    """Zeek connection records: renamed fields, epoch seconds as timestamp, ingest time."""
    return _zeek(df, ZEEK_CONN_NAMES)


def parse_zeek_http(df: DataFrame) -> DataFrame:
    """Zeek HTTP records: renamed fields, epoch seconds as timestamp, ingest time."""
    return _zeek(df, ZEEK_HTTP_NAMES)


# Output columns, JSON paths and types; two names keep their established spelling.
CLOUDTRAIL_FIELDS = [
    ("aws_region", "awsRegion", "string"), ("event_id", "eventID", "string"), ("event_name", "eventName", "string"),
    ("event_source", "eventSource", "string"), ("event_type", "eventType", "string"), ("event_time", "eventTime", "timestamp"),
    ("event_version", "eventVersion", "string"), ("recipient_account_id", "recipientAccountId", "string"), ("request_id", "requestID", "string"),
    ("request_parameters", "requestParameters", "variant"), ("response_elements", "responseElements", "variant"),
    ("response_user_arn", "responseElements.user.arn", "string"), ("response_role_arn", "responseElements.role.arn", "string"),
    ("response_policy_arn", "responseElements.policy.arn", "string"), ("resources_account_id", None, "string"),
    ("source_ip_address", "sourceIPAddress", "string"), ("user_agent", "userAgent", "string"), ("user_identity", "userIdentity", "variant"),
    ("user_identity_type", "userIdentity.type", "string"), ("user_identity_principal", "userIdentity.principalId", "string"),
    ("user_identity_arn", "userIdentity.arn", "string"), ("user_identity_account_id", "userIdentity.accountId", "string"),
    ("user_identity_invoked_by", "userIdentity.invokedBy", "string"), ("user_identity_access_ke", "userIdentity.accessKeyId", "string"),
    ("user_identity_username", "userIdentity.userName", "string"),
    ("user_identity_session_context_attributes_mfa_authenticated", "userIdentity.sessionContext.attributes.mfaAuthenticated", "boolean"),
    ("user_identity_session_context_attributes_creation_date", "userIdentity.sessionContext.attributes.creationDate", "string"),
    ("user_identity_session_context_sesion_issuer_type", "userIdentity.sessionContext.sessionIssuer.type", "string"),
    ("user_identity_session_context_sesion_issuer_principal_id", "userIdentity.sessionContext.sessionIssuer.principalId", "string"),
    ("user_identity_session_context_sesion_issuer_arn", "userIdentity.sessionContext.sessionIssuer.arn", "string"),
    ("user_identity_session_context_sesion_issuer_account_id", "userIdentity.sessionContext.sessionIssuer.accountId", "string"),
    ("user_identity_session_context_sesion_issuer_user_name", "userIdentity.sessionContext.sessionIssuer.userName", "string"),
    ("error_code", "errorCode", "string"), ("error_message", "errorMessage", "string"), ("additional_event_data", "additionalEventData", "variant"),
    ("api_version", "apiVersion", "string"), ("read_only", "readOnly", "boolean"), ("service_event_details", "serviceEventDetails", "string"),
    ("shared_event_id", "sharedEventId", "string"), ("vpc_endpoint_id", "vpcEndpointId", "string"),
]


def parse_cloudtrail(df: DataFrame, raw: str = "_raw") -> DataFrame:
    """Documents as one variant → a row a record and resource, 40 columns and both variants.

    A document without ``Records`` (or a malformed one, null) gives no row. A record without
    resources gives one row, with n resources n rows, so event_id may repeat. A value of the
    wrong type is null.
    """
    records = df.select(F.explode(F.try_variant_get(F.col(raw), "$.Records", "array<variant>")).alias("_record"))
    listed = F.try_variant_get("_record", "$.resources", "array<variant>")
    rows = records.select("_record", F.explode_outer(listed).alias("resource"))
    columns = []
    for name, path, kind in CLOUDTRAIL_FIELDS:
        value = F.try_variant_get("resource", "$.accountId", kind) if path is None else F.try_variant_get("_record", f"$.{path}", kind)
        columns.append(value.alias(name))
    return rows.select(*columns, "_record", "resource")


def decode_envelope(df: DataFrame) -> DataFrame:
    """Kafka rows of threat-intel envelopes → bronze: event time, dataset, service, message hash, date.

    The Kafka time becomes ``kafka_ts``. A malformed envelope keeps its row with nulls.
    """
    text = df.withColumn("value", F.col("value").cast("string")).withColumnRenamed("timestamp", "kafka_ts")
    envelope = text.withColumn("_e", F.from_json("value", ENVELOPE))
    out = envelope.withColumns(
        {
            "timestamp": F.col("_e.`@timestamp`"), "dataset": F.col("_e.fileset.name"), "service": F.col("_e.service.type"),
            "msg_hash": F.sha2(F.col("_e.message"), 256), "date": F.col("_e.`@timestamp`").cast("date"),
        }
    )
    return out.drop("_e", "timestampType")


def decode_message(bronze: DataFrame) -> DataFrame:
    """Bronze rows → dataset, timestamp, msg_hash and the feed's message text."""
    return bronze.select("dataset", "timestamp", "msg_hash", F.from_json("value", "message string")["message"].alias("message"))
