"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1000
SALTS = 32


def attach(rows: DataFrame, side: DataFrame, keys: list[str], count: str, total: int, salt: Column) -> DataFrame:
    """Inner join of ``rows`` with ``side``, which has each key once and its number of rows.

    Keys with more than ``total / HOT_KEYS`` rows are hot. There are fewer than ``HOT_KEYS`` of
    them whatever the data, so their list may be broadcast. A hot key's rows are spread over
    ``SALTS`` partitions by ``salt``, a column of ``rows`` that varies within a key, and its row of
    ``side`` is repeated for each; all other keys join as they are. ``count`` names the column of
    ``side`` that holds the number; it is dropped. Null keys match nothing.
    """
    limit = max(1, total // HOT_KEYS)
    hot = F.broadcast(side.where(F.col(count) > limit).select(*keys, F.lit(True).alias("_hot")))
    left = rows.withColumn("_spread", F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).join(hot, keys, "left")
    left = left.withColumn("_salt", F.when(F.col("_hot"), F.col("_spread")).otherwise(0)).drop("_hot", "_spread")
    copies = F.when(F.col(count) > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = side.withColumn("_salt", F.explode(copies)).drop(count)
    return left.join(right, [*keys, "_salt"]).drop("_salt")


def spread_join(probes: DataFrame, filed: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """Inner join where any number of rows of either side may share a key.

    Keys with more than one in ``HOT_KEYS`` of the rows of ``filed`` are hot, fewer than
    ``HOT_KEYS`` whatever the data. Their rows are spread over ``SALTS`` partitions by ``salt``, a
    column of ``filed``, and their probes are repeated for each. Both sides should be written
    tables. Null keys match nothing.
    """
    counts = filed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = filed.count()
    hot = F.broadcast(counts.where(F.col("_n") > max(SALTS, total // HOT_KEYS)).select(*keys, F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt), F.lit(SALTS)).cast("int")).otherwise(0)
    right = filed.join(hot, keys, "left").withColumn("_salt", spread).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = probes.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [*keys, "_salt"]).drop("_salt")
