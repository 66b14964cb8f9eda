"""The incremental preparation operators as sinks of streams.

Each micro-batch is handed to an operator of ``palisade.operators``; a micro-batch that Spark
delivers again after a failure changes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from palisade.operators.delivery import DeliveryStore
from palisade.operators.kslack import KSlack
from palisade.operators.sessions import SessionTable


def drain(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Hands all available rows, batch by batch, to ``apply(rows, epoch)``."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()
    query.awaitTermination()


def into_sessions(events: DataFrame, table: SessionTable, checkpoint: str) -> None:
    """(host, ts_us) rows into a session table."""
    drain(events, checkpoint, table.merge)


def into_kslack(events: DataFrame, slack: KSlack, checkpoint: str) -> None:
    """(src, id, event_us, arrived_us) rows into the reordering buffer and its aggregates."""
    drain(events, checkpoint, lambda rows, epoch: slack.push(rows))


def drop_repeats(messages: DataFrame, store: DeliveryStore, dropped: str, checkpoint: str) -> None:
    """(id, at_us, row_id) rows into the store; the row_ids to drop go to the folder ``dropped``.

    One folder a micro-batch, overwritten if it comes again.
    """
    drain(messages, checkpoint, lambda rows, epoch: store.accept(rows).write.mode("overwrite").parquet(f"{dropped}/batch={epoch}"))
