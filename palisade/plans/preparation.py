"""Queries of the general data-preparation problems: pN over the tables of one folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators.delivery import DeliveryStore, message_id
from palisade.operators.kslack import KSlack
from palisade.operators.loglines import log_entries, mine_templates, parse_lines, tokenize_lines
from palisade.operators.schema_drift import Projection, file_schemas, message_changes, property_nodes, text_form
from palisade.operators.sessions import SessionTable, clean_key, slots
from palisade.operators.timestamps import USUAL, TimeDictionary, with_sensor_zone
from palisade.storage import materialize, workspace

BATCHES = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batch_of(column: Column, low: int, high: int, batches: int = BATCHES) -> Column:
    """Number of the batch, 0 to ``batches`` - 1, by equal steps from ``low`` to ``high``; null is in 0."""
    step = max(1, -(-(high - low + 1) // batches))
    return F.floor((F.coalesce(column, F.lit(low)) - F.lit(low)) / F.lit(step)).cast("int")


def bounds(df: DataFrame, column: Column) -> tuple[int, int]:
    low, high = df.agg(F.min(column), F.max(column)).first()
    return (0, 0) if low is None else (low, high)


def _ts_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return property_nodes(table(spark, sf_dir, "zeek_conn"), "log_file", text_form(F.col("ts")), "ts", "form")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout changes between consecutive files of each stream, from their trees' edit scripts."""
    intel = table(spark, sf_dir, "threatintel")
    schemas = materialize(file_schemas(intel), workspace(spark, "schemas"))
    labels = property_nodes(intel, "source_file", F.col("dataset"), "dataset", "label")
    return message_changes(schemas, labels, "threatintel").unionByName(message_changes(None, _ts_forms(spark, sf_dir), "zeek_conn")).distinct()


def p1_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message and every Zeek record in one table: messages read by the compiled edit scripts."""
    intel = table(spark, sf_dir, "threatintel")
    schemas = materialize(file_schemas(intel), workspace(spark, "schemas"))
    wide = Projection.compile(schemas, message_changes(schemas)).apply(intel.select("row_id", "source_file", "message"))
    conn = table(spark, sf_dir, "zeek_conn")
    zeek = conn.select(F.lit("zeek_conn").alias("src"), F.lit(None).cast("bigint").alias("row_id"), F.col("log_file").alias("source_file"), F.to_json(F.struct("*")).alias("record"))
    return wide.select(F.lit("threatintel").alias("src"), "row_id", "source_file", F.to_json("record").alias("record")).unionByName(zeek)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of every origin host, built by merging arrival batches into a session table."""
    conn = table(spark, sf_dir, "zeek_conn").select(
        F.lit(-1).alias("depth"), "uid", "timestamp", "id_origin_host", "ingest_time"
    )
    http = table(spark, sf_dir, "zeek_http").select(
        F.coalesce("trans_depth", F.lit(0)).alias("depth"), "uid", "timestamp", "id_origin_host", "ingest_time"
    )
    arrived = F.unix_micros("ingest_time")
    rows = conn.unionByName(http).select(
        "depth", "uid", clean_key(F.col("id_origin_host")).alias("host"), F.unix_micros("timestamp").alias("ts_us"), arrived.alias("at_us")
    )
    low, high = bounds(conn.unionByName(http), arrived)
    events = (
        rows.where("host is not null and ts_us is not null")
        .groupBy("depth", "uid")
        .agg(F.min(F.struct("at_us", "ts_us", "host")).alias("e"))
        .select("e.*")
    )
    folded = slots(events.withColumn("batch", batch_of(F.col("at_us"), low, high)), ["batch"])
    folded = materialize(folded, workspace(spark, "slots"))
    store = SessionTable(spark, workspace(spark, "sessions"))
    for b in range(BATCHES):
        store.merge_intervals(folded.where(F.col("batch") == b).drop("batch"))
    return store.sessions().withColumnRenamed("host", "id_origin_host")


def _time_texts(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    apache = table(spark, sf_dir, "apache_web").select(
        F.concat("log_file", F.lit(":"), F.col("line_no").cast("string")).alias("rec_key"), F.col("timestamp").alias("text"), "sensor", "ingest_time"
    )
    zeek = table(spark, sf_dir, "zeek_conn").select(F.col("uid").alias("rec_key"), F.col("ts").alias("text"), "sensor", "ingest_time")
    trail = table(spark, sf_dir, "aws_cloudtrail").select(
        F.col("event_id").alias("rec_key"), F.col("event_time").alias("text"), "sensor", "ingest_time"
    )
    iocs = table(spark, sf_dir, "iocs").select(F.col("row_id").cast("string").alias("rec_key"), F.col("first_seen").alias("text"), "sensor", "ingest_time")
    return [("apache_web", apache), ("zeek_conn", zeek), ("aws_cloudtrail", trail), ("iocs", iocs)]


def _instants(times: TimeDictionary, sensors: DataFrame, rows: DataFrame) -> DataFrame:
    """One row a (src, rec_key, text, sensor), by its earliest arrival, with its instant."""
    once = rows.groupBy("src", "rec_key", "text", "sensor").agg(F.min("ingest_time").alias("ingest_time"))
    once = with_sensor_zone(once, sensors)
    return times.normalize(once, F.col("text"), F.col("zone_name"), F.col("date_order"), F.unix_micros("ingest_time"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable time texts that are not in their source's usual form, as UTC instants."""
    times = TimeDictionary(spark, workspace(spark, "times"))
    sensors = table(spark, sf_dir, "sensors")
    texts = [
        rows.where(F.col("text").isNotNull() & ~F.col("text").rlike(USUAL[src]) & F.col("text").rlike("[0-9]")).withColumn("src", F.lit(src))
        for src, rows in _time_texts(spark, sf_dir)
    ]
    found = [_instants(times, sensors, a.unionByName(b)).where("epoch_us is not null") for a, b in (texts[:2], texts[2:])]
    return found[0].unionByName(found[1]).select("src", "rec_key", "epoch_us").distinct()


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows to drop so that one copy of each message stays."""
    intel = table(spark, sf_dir, "threatintel")
    rows = intel.select(message_id(F.col("message")).alias("id"), F.unix_micros("kafka_ts").alias("at_us"), "row_id", "batch_id")
    low, high = bounds(intel, F.col("batch_id"))
    store = DeliveryStore(spark, workspace(spark, "delivery"))
    drops = None
    for b in range(BATCHES):
        part = store.accept(rows.where(batch_of(F.col("batch_id"), low, high) == b))
        drops = part if drops is None else drops.union(part)
    return drops.distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries of all layouts but plain access lines."""
    lines = table(spark, sf_dir, "apache_web").select("log_file", "line_no", "value")
    tokens = materialize(tokenize_lines(lines), workspace(spark, "line-tokens"))
    parsed = materialize(parse_lines(tokens, mine_templates(tokens)), workspace(spark, "parsed-lines"))
    found = log_entries(lines, parsed).where("not access")
    return found.select("log_file", "first_line", "last_line", "level", "component", "method", "path")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours whose count was corrected by late records up to the cut-off."""
    zeek = table(spark, sf_dir, "zeek_conn").select(
        F.lit("zeek_conn").alias("src"), F.col("uid").alias("id"), F.unix_micros("timestamp").alias("event_us"), F.unix_micros("ingest_time").alias("arrived_us")
    )
    trail = table(spark, sf_dir, "aws_cloudtrail").select(
        F.lit("aws_cloudtrail").alias("src"), F.col("event_id").alias("rec_key"), F.col("event_time").alias("text"), "sensor", "ingest_time"
    )
    usual = F.col("text").rlike(USUAL["aws_cloudtrail"])
    plain = trail.where(usual).select("rec_key", "ingest_time", F.unix_micros(F.col("text").try_cast("timestamp")).alias("epoch_us"))
    times = TimeDictionary(spark, workspace(spark, "times"))
    other = _instants(times, table(spark, sf_dir, "sensors"), trail.where(~usual)).select("rec_key", "ingest_time", "epoch_us")
    cloud = plain.unionByName(other).select(
        F.lit("aws_cloudtrail").alias("src"), F.col("rec_key").alias("id"), F.col("epoch_us").alias("event_us"), F.unix_micros("ingest_time").alias("arrived_us")
    )
    rows = zeek.unionByName(cloud)
    low, high = bounds(table(spark, sf_dir, "zeek_conn").select("ingest_time").unionByName(trail.select("ingest_time")), F.unix_micros("ingest_time"))
    # the times are read once, and each push reads its own batch
    rows = materialize(rows.withColumn("batch", batch_of(F.col("arrived_us"), low, high)), workspace(spark, "arrivals"), "batch")
    slack = KSlack(spark, workspace(spark, "kslack"))
    for b in range(BATCHES):
        slack.push(rows.where(F.col("batch") == b))
    slack.close()
    late = slack.finals().where("n_final > n_first")
    return late.select("src", (F.col("hour_start") / 1_000_000).cast("bigint").alias("hour_start"), "n_first", "n_final")


def p7_zeek_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hour of the Zeek connections, with the order-sensitive aggregates of the release."""
    zeek = table(spark, sf_dir, "zeek_conn").select(
        F.lit("zeek_conn").alias("src"), F.col("uid").alias("id"), F.unix_micros("timestamp").alias("event_us"), F.unix_micros("ingest_time").alias("arrived_us")
    )
    low, high = bounds(zeek, F.col("arrived_us"))
    slack = KSlack(spark, workspace(spark, "kslack"))
    for b in range(BATCHES):
        slack.push(zeek.where(batch_of(F.col("arrived_us"), low, high) == b))
    slack.close()
    return slack.finals()


def p1_zeek_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form of the time text in each Zeek log file against the file before."""
    return message_changes(None, _ts_forms(spark, sf_dir)).drop("src")


QUERIES = {"p1_found": p1_found, "p1_unified": p1_unified, "p2_found": p2_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p7_found": p7_found, "p1_zeek_ts": p1_zeek_ts, "p7_zeek_hours": p7_zeek_hours}
