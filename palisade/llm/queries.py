"""Queries of the training-text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm.encoding import encode
from palisade.llm.history import HashForest, canonical_rows
from palisade.llm.leakage import find_leaks
from palisade.llm.sentences import split_sentences
from palisade.storage import materialize, workspace

BATCHES = 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators that repeat one accepted earlier, batch after batch against the forest."""
    iocs = _table(spark, sf_dir, "iocs")
    low, high = iocs.agg(F.min("batch_no"), F.max("batch_no")).first()
    rows = materialize(canonical_rows(iocs), workspace(spark, "canonical"))
    forest = HashForest(spark, workspace(spark, "forest"))
    step = max(1, -(-((high or 0) - (low or 0) + 1) // BATCHES))
    found = None
    for b in range(BATCHES):
        start = (low or 0) + b * step
        batch = F.coalesce("batch_no", F.lit(low or 0))
        pairs = forest.accept(rows.where((batch >= start) & (batch < start + step)))
        found = pairs if found is None else found.unionByName(pairs)
    return found


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    encoded = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return encoded.select("doc_id", F.col("ids").cast("array<bigint>").alias("ids"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of an evaluation item."""
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document."""
    return split_sentences(_table(spark, sf_dir, "documents")).distinct()


QUERIES = {"p3_found": p3_found, "p10_found": p10_found, "p8_ids": p8_ids, "p9_found": p9_found}
SQL: dict[str, str] = {}
