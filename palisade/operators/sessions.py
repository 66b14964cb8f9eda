"""Grouping activity into sessions: an incremental session table.

Each batch is reduced to local sessions, compared with the stored sessions within reach of
the gap, bridged components are merged, and the touched partitions are replaced in one
commit. Batches may come in any order and may be late.

Scale: events are first folded into slots one gap wide. Two events of one slot are never
more than the gap apart, so the fold is exact, runs as a map-side partial aggregate, and a
host with a third of all rows leaves at most one row for each slot of the covered time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palisade.storage import SnapshotTable, materialize, workspace

GAP_US = 30 * 60 * 1_000_000
_DAY_US = 86_400 * 1_000_000


def clean_key(c: Column) -> Column:
    """Outer white space removed, lower case; null where nothing is left."""
    trimmed = F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return F.when(trimmed != "", trimmed)


def slots(events: DataFrame, extra: list[str] | None = None, gap_us: int = GAP_US) -> DataFrame:
    """(host, ts_us) → (host, start_us, end_us, n_events), at most one row a slot.

    Events with a null host or time are left out. ``extra`` names further grouping columns.
    """
    keys = [*(extra or []), "host"]
    return (
        events.where(F.col("host").isNotNull() & F.col("ts_us").isNotNull())
        .groupBy(*keys, F.floor(F.col("ts_us") / F.lit(gap_us)).alias("_slot"))
        .agg(F.min("ts_us").alias("start_us"), F.max("ts_us").alias("end_us"), F.count(F.lit(1)).alias("n_events"))
        .drop("_slot")
    )


def coalesce_intervals(intervals: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """Merges (host, start_us, end_us, n_events) rows that lie at most the gap apart."""
    order = Window.partitionBy("host").orderBy("start_us", "end_us")
    reach = F.max("end_us").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("start_us") - reach > gap_us), 1).otherwise(0)
    return (
        intervals.withColumn("_open", opens)
        .withColumn("_no", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("host", "_no")
        .agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("n_events").alias("n_events"))
        .drop("_no")
    )


class SessionTable:
    """Stored sessions, partitioned by the UTC day of their end and ``buckets`` of hosts.

    ``merge(events)`` takes (host, ts_us) rows, one per event; the caller removes duplicate
    deliveries first. Silence of exactly ``gap_us`` does not split. Null hosts and times are
    left out, an empty batch changes nothing, simultaneous events count each. A batch replaces
    only the partitions that hold a session it bridges or extends: a late event touches the
    sessions of its host around its time, not all that came since.
    """

    SCHEMA = "host string, start_us bigint, end_us bigint, n_events bigint"

    def __init__(self, spark: SparkSession, path: str, gap_us: int = GAP_US, buckets: int = 4):
        self.spark, self.table, self.gap_us, self.buckets = spark, SnapshotTable(spark, path, self.SCHEMA), gap_us, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("host"), F.lit(self.buckets)).cast("string")

    def _part(self) -> Column:
        return F.concat_ws("_", F.floor(F.col("end_us") / F.lit(_DAY_US)).cast("string"), self._bucket())

    def _touched(self, local: DataFrame) -> list[str]:
        """Partitions with a session within the gap of one of the batch's sessions of its host."""
        days = local.select(
            self._bucket().alias("bucket"), F.floor((F.col("start_us") - self.gap_us) / F.lit(_DAY_US)).alias("first"), F.floor((F.col("end_us") + self.gap_us) / F.lit(_DAY_US)).alias("last")
        )
        reach: dict[str, list[tuple[int, int]]] = {}
        for r in days.distinct().collect():  # at most a few rows a day and bucket
            reach.setdefault(r.bucket, []).append((r.first, r.last))
        near = []
        for part, low in self.table.lows().items():
            day, bucket = part.split("_")
            if any(int(day) >= first and low // _DAY_US <= last for first, last in reach.get(bucket, [])):
                near.append(part)
        if not near:
            return []
        own = local.select("host", F.col("start_us").alias("_from"), F.col("end_us").alias("_to"))
        stored = self.table.read(near).withColumn("_p", self._part())
        met = stored.join(own, "host").where((F.col("end_us") >= F.col("_from") - self.gap_us) & (F.col("start_us") <= F.col("_to") + self.gap_us))
        return [r[0] for r in met.select("_p").distinct().collect()]  # at most one row a partition

    def merge(self, events: DataFrame, epoch: int | None = None) -> None:
        """``epoch``, the number of a micro-batch, makes a repeated delivery of it a no-op."""
        self.merge_intervals(slots(events, gap_us=self.gap_us), epoch)

    def merge_intervals(self, batch: DataFrame, epoch: int | None = None) -> None:
        """As ``merge``, for events already folded by :func:`slots`."""
        if epoch is not None and epoch <= self.table.meta.get("epoch", -1):
            return
        local = materialize(coalesce_intervals(batch, self.gap_us), workspace(self.spark, "local-sessions"))
        if local.isEmpty():
            return
        # stored sessions lie more than the gap apart, so what a batch's session does not meet directly stays
        touched = self._touched(local) if self.table.partitions else []
        if touched:
            local = coalesce_intervals(self.table.read(touched).unionByName(local), self.gap_us)
        self.table.write(local, part=self._part(), replace=touched, meta={} if epoch is None else {"epoch": epoch}, low="start_us")

    def sessions(self) -> DataFrame:
        return self.table.read()
