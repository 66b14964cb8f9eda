"""Late and out-of-order events: K-slack reordering before an order-sensitive aggregate.

Events wait in a buffer until the lateness bound K has passed for their period; then they
are released in event-time order to the final aggregation, which is a fold over sorted
events. Until then provisional values are published from the buffer. Events that arrive
after the bound are counted, not aggregated. The state is bounded by K: a second delivery
of an event either meets the first one in the buffer or comes after the bound.

A batch that is pushed again after a failure changes nothing twice: released periods are
closed by the watermark that is committed with their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.storage import SnapshotTable, materialize, workspace

HOUR_US = 3_600_000_000
FIRST_US = 600_000_000
K_US = 24 * HOUR_US

_PARTIAL = "src string, hour_start bigint, n_first bigint, n_final bigint, first_us bigint, last_us bigint, max_gap_us bigint"


def _fold(period_us: int, first_us: int):
    """The order-sensitive part: one pass over a sorted partition, a row a period."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[tuple, int] = {}  # the open period's last event, carried between Arrow batches
        for pdf in batches:
            if pdf.empty:
                continue
            pdf["hour_start"] = pdf["event_us"] // period_us * period_us
            group = pdf.groupby(["src", "hour_start"], sort=False)
            pdf["gap"] = group["event_us"].diff()
            pdf["early"] = (pdf["arrived_us"] <= pdf["hour_start"] + period_us + first_us).astype("int64")
            out = group.agg(
                n_first=("early", "sum"), n_final=("early", "size"), first_us=("event_us", "first"), last_us=("event_us", "last"), max_gap_us=("gap", "max")
            ).reset_index()
            gaps = []
            for src, hour, lo, gap in zip(out["src"], out["hour_start"], out["first_us"], out["max_gap_us"]):
                before = last.get((src, hour))
                gap = 0 if pd.isna(gap) else int(gap)
                gaps.append(gap if before is None else max(gap, lo - before))
            out["max_gap_us"] = gaps
            end = out.iloc[-1]
            last = {(end["src"], end["hour_start"]): end["last_us"]}
            yield out[["src", "hour_start", "n_first", "n_final", "first_us", "last_us", "max_gap_us"]]

    return run


class KSlack:
    """Per-period aggregates by event time, corrected as late events arrive.

    ``push(batch)`` takes (src, id, event_us, arrived_us) rows in arrival order of batches; it
    reads the batch twice, for the latest arrival and for the rows.
    ``finals()`` has a row for each released period: n_first (arrived at most ``first_us``
    after the period's end), n_final (at most ``k_us`` after it), first and last event and the
    longest silence within the period. ``provisional()`` has n_first and the count so far of
    the periods still in the buffer, ``close()`` releases them. An id counts once, with its
    earliest arrival. Rows with a null time or id are left out; an empty batch is a no-op.
    """

    def __init__(self, spark: SparkSession, path: str, k_us: int = K_US, first_us: int = FIRST_US, period_us: int = HOUR_US):
        self.spark, self.k_us, self.first_us, self.period_us = spark, k_us, first_us, period_us
        self.buffer = SnapshotTable(spark, f"{path}/buffer", "src string, id string, event_us bigint, arrived_us bigint")
        self.final = SnapshotTable(spark, f"{path}/final", _PARTIAL)

    def _end(self):
        return (F.floor(F.col("event_us") / F.lit(self.period_us)) + 1) * self.period_us

    def _closed(self) -> int:
        """Watermark up to which periods are released."""
        return self.final.meta.get("released_us", -(1 << 62))

    def push(self, batch: DataFrame) -> None:
        batch = batch.where("event_us is not null and arrived_us is not null and id is not null")
        mark = batch.agg(F.max("arrived_us")).first()[0]
        if mark is not None:
            self._advance(batch, max(mark, self._closed()))

    def close(self) -> None:
        self._advance(None, 1 << 62)

    def _advance(self, batch: DataFrame | None, mark: int) -> None:
        bound = self._end() + self.k_us
        closed = self._closed()
        held = self.buffer.read().where(bound >= closed)
        if batch is not None:
            in_time = batch.where((F.col("arrived_us") <= bound) & (bound >= closed))
            held = held.unionByName(in_time.select("src", "id", "event_us", "arrived_us"))
            held = held.groupBy("src", "id", "event_us").agg(F.min("arrived_us").alias("arrived_us"))
        # written once: it is sampled for the order, released and buffered
        held = materialize(held, workspace(self.spark, "held"))
        done = bound < mark
        # If the driver fails between the two commits, the buffer still holds what was released,
        # and the watermark committed with the release keeps it from counting again.
        old = self.buffer.partitions
        self._release(held.where(done), mark)
        self.buffer.write(held.where(~done), replace=old)

    def _release(self, events: DataFrame, mark: int) -> None:
        ordered = events.repartitionByRange("src", "event_us").sortWithinPartitions("src", "event_us", "arrived_us", "id")
        self.final.write(ordered.select("src", "event_us", "arrived_us").mapInPandas(_fold(self.period_us, self.first_us), _PARTIAL), meta={"released_us": mark})

    def finals(self) -> DataFrame:
        """A period cut by a partition border has several rows; they are joined here, in order."""
        parts = self.final.read().groupBy("src", "hour_start").agg(
            F.sum("n_first").alias("n_first"), F.sum("n_final").alias("n_final"), F.min("first_us").alias("first_us"),
            F.max("last_us").alias("last_us"), F.max("max_gap_us").alias("_gap"),
            F.array_sort(F.collect_list(F.struct("first_us", "last_us"))).alias("_runs"),
        )
        seams = F.transform(
            F.sequence(F.lit(1), F.size("_runs") - 1),
            lambda i: F.element_at("_runs", (i + 1).cast("int"))["first_us"] - F.element_at("_runs", i.cast("int"))["last_us"],
        )
        gap = F.when(F.size("_runs") > 1, F.greatest("_gap", F.array_max(seams))).otherwise(F.col("_gap"))
        return parts.withColumn("max_gap_us", gap).drop("_gap", "_runs")

    def provisional(self) -> DataFrame:
        early = F.col("arrived_us") <= self._end() + self.first_us
        return (
            self.buffer.read()
            .groupBy("src", (self._end() - self.period_us).alias("hour_start"))
            .agg(F.count(F.when(early, 1)).alias("n_first"), F.count(F.lit(1)).alias("n_so_far"))
        )
