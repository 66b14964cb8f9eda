"""Insert-only merge: append the rows of a batch whose key the target lacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_of_keys(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row a key; null keys count as equal.

    Without ``order_by`` any row may stay. With it the smallest one stays; it is found by an
    aggregate, not a window, so a frequent key is combined before the shuffle.
    """
    if not order_by:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    key = F.struct(*order_by)
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), key).alias("_r")).select(*(f"_r.`{c}`" if c in rest else c for c in df.columns))


def rows_to_insert(batch: DataFrame, target: DataFrame | None, keys: list[str], order_by: list[str] | None = None, matches_only: Column | None = None) -> DataFrame:
    """Rows of ``batch`` that an insert-only merge adds to ``target``.

    First writer wins. A null key matches nothing, so its row is inserted by each batch.
    ``matches_only`` limits which batch rows may match: others are inserted even if present.
    """
    rows = first_of_keys(batch, keys, order_by)
    if target is None:
        return rows
    present = target.select(*(F.col(k).alias(f"_t_{k}") for k in keys))
    on = [F.col(k) == F.col(f"_t_{k}") for k in keys]
    if matches_only is not None:
        on.append(matches_only)
    return rows.join(present, on, "left_anti")


def recent(date: str, days: int) -> Column:
    """Guard that lets only batch rows of the last ``days`` days match."""
    return F.col(date) >= F.date_sub(F.current_date(), days)


class ParquetTarget:
    """A partitioned parquet table as merge target, given by ``path`` or table ``name``.

    ``insert_new`` creates it with the first non-empty batch and adds rows afterwards; columns
    that come later are merged on read. Neither path nor name is an error. Errors of a write
    surface; the table's existence is asked, not guessed from a failure.
    """

    def __init__(self, spark: SparkSession, path: str = "", name: str = "", partition_by: list[str] | None = None):
        if not path and not name:
            raise ValueError("give the path or the name of the target")
        self.spark, self.path, self.name, self.partition_by = spark, path, name, partition_by or []

    def exists(self) -> bool:
        if self.name:
            return self.spark.catalog.tableExists(self.name)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self) -> DataFrame:
        if self.name:
            return self.spark.read.table(self.name)
        return self.spark.read.option("mergeSchema", "true").parquet(self.path)

    def insert_new(self, batch: DataFrame, keys: list[str], order_by: list[str] | None = None, match_only_recent_days: tuple[str, int] | None = None) -> None:
        if batch.isEmpty():
            return
        there = self.exists()
        guard = recent(*match_only_recent_days) if match_only_recent_days else None
        rows = rows_to_insert(batch, self.read() if there else None, keys, order_by, guard)
        if there and self.name:
            rows = _aligned(rows, self.read().schema)
        writer = rows.write.mode("append").partitionBy(*self.partition_by)
        if self.name:
            (writer.option("path", self.path) if self.path else writer).format("parquet").saveAsTable(self.name)
        else:
            writer.parquet(self.path)


def _aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns as the table has them; missing ones null, unknown ones left out."""
    return rows.select(*(F.col(f.name).cast(f.dataType) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields))
