"""Messages delivered more than once: keep exactly one copy of each.

Method: every time bucket of accepted identifiers has Bloom filters, one a batch that brought some,
sized by the number it brought. A batch's identifiers are tested against the filters; what no
filter knows is definitely new and never touches history. A possible repeat is verified exactly,
and only against the storage of the buckets whose filters answered. The filters are blocked (one
identifier's bits lie in one 32,768-bit block) and are rows of a table, so building and testing
them are plain joins and aggregates in the JVM, and no filter has to fit on the driver or be
broadcast. Filters have a power of two of blocks; a test joins on the block in the filters of each
such size, and small filters are repeated over ``WAYS`` keys, so that they are tested by many tasks.

A later batch may bring an earlier copy; it then takes the place of the accepted one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.storage import SnapshotTable, materialize, workspace

BLOCK_BITS = 32_768  # the bitmap functions work on bitmaps of this size
HASHES = 8
WAYS = 64


def message_id(message: Column) -> Column:
    """SHA-256 of the message as 32 bytes; null for a null message."""
    return F.unhex(F.sha2(message, 256))


def _block(blocks: Column) -> Column:
    """The identifier's block of ``blocks``, a power of two: of twice as many it is this one or this one + ``blocks``."""
    return F.xxhash64("id").bitwiseAND(blocks - 1)


def _bit(i: int) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(BLOCK_BITS))


def _has_bits(bitmap: Column) -> Column:
    test = F.lit(True)
    for i in range(HASHES):
        byte = F.substring(bitmap, (_bit(i) / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        test = test & (F.shiftright(value, 0).bitwiseAND(F.pow(F.lit(2), _bit(i) % 8).cast("int")) != 0)
    return test


class DeliveryStore:
    """Accepted identifiers in day buckets, with a Bloom filter a bucket.

    ``accept(batch)`` takes rows (id binary, at_us bigint, row_id bigint; row_id unique) and
    returns the row_ids to drop: of each identifier all copies but the earliest by
    (at_us, row_id). If the batch supersedes a stored copy, that copy's row_id is returned
    too, and may be so again by later batches with the same identifier. Rows with a null id are ignored (they all stay). A null at_us counts as latest.
    An empty batch returns no row; the same batch again returns the same rows. ``bits_per_id`` sets
    how many new identifiers need the exact check all the same, about one in 7,000 a filter.
    """

    IDS = "id binary, at_us bigint, row_id bigint, bucket string"
    BLOOMS = "bucket string, blocks bigint, block bigint, bitmap binary"
    LATEST = 1 << 62

    def __init__(self, spark: SparkSession, path: str, bits_per_id: int = 20):
        self.spark, self.path, self.bits_per_id = spark, path, bits_per_id
        self.ids = SnapshotTable(spark, f"{path}/ids", self.IDS)
        self.blooms = SnapshotTable(spark, f"{path}/blooms", self.BLOOMS)

    def _bitmaps(self, dated: DataFrame) -> DataFrame:
        """The filters of a batch, one for each bucket it brings identifiers to."""
        need = F.greatest(F.lit(1.0), F.count(F.lit(1)) * self.bits_per_id / F.lit(BLOCK_BITS))
        sizes = dated.groupBy("bucket").agg(F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("bigint").alias("blocks"))
        bits = dated.join(sizes, "bucket").select("bucket", "blocks", _block(F.col("blocks")).alias("block"), F.explode(F.array(*map(_bit, range(HASHES)))).alias("bit"))
        return bits.groupBy("bucket", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))

    def _screen(self, ids: DataFrame) -> DataFrame:
        """(id, bucket) for each bucket with a filter that may hold the id."""
        ways = F.greatest(F.col("blocks"), F.lit(WAYS))
        filters = self.blooms.read().select("bucket", "bitmap", ways.alias("ways"), F.explode(F.sequence("block", ways - 1, F.col("blocks"))).alias("key"))
        sizes = [r[0] for r in self.blooms.read().select(ways).distinct().collect()]  # powers of two
        tests = ids.select("id", F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")).alias("ways"))
        tests = tests.withColumn("key", _block(F.col("ways")))
        return tests.join(filters, ["ways", "key"]).where(_has_bits(F.col("bitmap"))).select("id", "bucket").distinct()

    def _stored(self, ids: DataFrame) -> DataFrame:
        """(id, at_us, row_id): every stored copy of the ids."""
        possible = materialize(self._screen(ids), workspace(self.spark, "possible"))
        buckets = [r[0] for r in possible.select("bucket").distinct().collect()]  # at most one a day
        hits = self.ids.read(buckets).join(possible, ["id", "bucket"], "left_semi")
        return materialize(hits.select("id", "at_us", "row_id"), workspace(self.spark, "stored"))

    def accept(self, batch: DataFrame) -> DataFrame:
        rows = batch.where(F.col("id").isNotNull()).select(
            "id", F.coalesce("at_us", F.lit(self.LATEST)).alias("at_us"), "row_id"
        )
        own = rows.groupBy("id").agg(F.min(F.struct("at_us", "row_id")).alias("k"))
        if self.ids.partitions:
            own = materialize(own, workspace(self.spark, "batch-ids"))
            stored = self._stored(own.select("id"))
        else:
            stored = self.spark.createDataFrame([], "id binary, at_us bigint, row_id bigint")
        best = stored.groupBy("id").agg(F.min(F.struct("at_us", "row_id")).alias("old"))
        own = materialize(own.join(best, "id", "left"), workspace(self.spark, "batch-known"))
        new = own.where(F.col("old").isNull() | (F.col("k") < F.col("old")))
        new = new.select("id", "k.*")
        day = F.to_date(F.timestamp_micros(F.least("at_us", F.lit(253_402_300_799_000_000)))).cast("string")
        dated = new.withColumn("bucket", day)
        dated = materialize(dated, workspace(self.spark, "new-ids"))
        # Filters first: an identifier is never stored without its bits, whatever fails in between.
        self.blooms.write(self._bitmaps(dated), part=F.col("bucket"))
        self.ids.write(dated, part=F.col("bucket"), spread=F.col("id"))
        # row_id is unique, so these joins are even however often one message was delivered. A batch
        # that comes again finds its own rows stored, and the keepers among them stay.
        keepers = own.select(F.least("k", "old")["row_id"].alias("row_id"))
        dropped = rows.select("row_id").join(keepers, "row_id", "left_anti")
        # stored copies that an earlier one has overtaken, be it in this batch or in a failed attempt at it
        return dropped.union(stored.select("row_id").join(keepers, "row_id", "left_anti"))
