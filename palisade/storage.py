"""Shared storage: workspaces below ``spark.checkpoint.dir`` and snapshot tables.

A :class:`SnapshotTable` is a set of immutable parquet directories plus a chain of
numbered manifests. A write first lands its files in a fresh directory and becomes
visible only when the next manifest is renamed into place, so a lost executor or a
failed job never leaves a half-written table behind, and readers of an older snapshot
are not disturbed. Partition values live in the manifest, which gives pruning without
listing files.
"""

from __future__ import annotations

import atexit
import json
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PART = "_part"
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder; on a cluster
    the setting is required, because a machine-local folder would lose data.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("palisade.local.dir", None)
    if not base:
        if not conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="palisade-")
        spark.conf.set("palisade.local.dir", base)
        _made.append((spark, base))
    return base.rstrip("/")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder; removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/palisade/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in reversed(_made):
        try:
            fs, p = _fs(spark, path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone; leftovers are harmless
            pass


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _ls(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then rename: the file appears whole or not at all."""
    fs, p = _fs(spark, path)
    _, tmp = _fs(spark, path + ".tmp-" + uuid.uuid4().hex[:8])
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(p) or not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise RuntimeError(f"another writer committed {path} first")


def _drop(spark: SparkSession, paths: set[str]) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def materialize(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives lost executors.

    ``by`` names a column of few values, of which later reads take one at a time.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Versioned:
    """A chain of numbered manifests below ``path``; the last one is the current state."""

    EMPTY: dict = {}

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/{version:09d}.json"

    def _versions(self) -> list[int]:
        names = [p.rpartition("/")[2] for p in _ls(self.spark, f"{self.path}/manifest")]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _state(self) -> tuple[int, dict]:
        versions = self._versions()
        if not versions:
            return 0, json.loads(json.dumps(self.EMPTY))
        return versions[-1], json.loads(_read_text(self.spark, self._manifest(versions[-1])))

    def _dirs(self, state: dict) -> set[str]:
        raise NotImplementedError

    def _commit(self, version: int, state: dict) -> None:
        """Makes ``state`` the current one. Data and manifests of more than one version before it go:
        who reads the snapshot before is not disturbed, and folders don't pile up."""
        _write_text(self.spark, self._manifest(version + 1), json.dumps(state))
        old = [v for v in self._versions() if v < version]
        if old:
            kept = self._dirs(state) | self._dirs(json.loads(_read_text(self.spark, self._manifest(version))))
            write = lambda d: f"{self.path}/data/{d.rpartition('/data/')[2].partition('/')[0]}"  # noqa: E731 - the folder of one write
            whole = set(map(write, kept))
            for v in old:
                gone = self._dirs(json.loads(_read_text(self.spark, self._manifest(v)))) - kept
                _drop(self.spark, {d if write(d) in whole else write(d) for d in gone})
                _drop(self.spark, {self._manifest(v)})

    @property
    def meta(self) -> dict:
        return self._state()[1]["meta"]


class SnapshotTable(_Versioned):
    """An append/replace table with atomic commits and partition pruning.

    ``schema`` fixes the columns. ``commit`` metadata (a small JSON object) travels with
    the snapshot, e.g. a watermark, so that state and data never disagree.
    """

    EMPTY = {"parts": {}, "lows": {}, "meta": {}}

    def _dirs(self, state: dict) -> set[str]:
        return {d for dirs in state["parts"].values() for d in dirs}

    @property
    def partitions(self) -> list[str]:
        return sorted(self._state()[1]["parts"])

    def read(self, only: list[str] | None = None) -> DataFrame:
        """The current snapshot, or the given partitions of it."""
        parts = self._state()[1]["parts"]
        dirs = [d for k in (parts if only is None else only) for d in parts.get(k, [])]
        if not dirs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*dirs)

    def write(
        self,
        df: DataFrame,
        part: Column | None = None,
        replace: list[str] | None = None,
        meta: dict | None = None,
        spread: Column | None = None,
        sort: list[str] | None = None,
        low: str | None = None,
    ) -> None:
        """Add the rows of ``df``; ``replace`` lists partitions whose old rows go.

        ``part`` gives each row's partition value. ``spread`` (a column that varies within
        a partition) distributes rows so that one large partition is written by many tasks.
        ``sort`` orders the rows of each file, for narrow row groups in later range searches.
        ``low`` names a number column whose smallest value in each partition :meth:`lows` knows.
        """
        version, state = self._state()
        out = f"{self.path}/data/{version + 1:09d}-{uuid.uuid4().hex[:8]}"
        rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        parts: dict[str, list[str]] = {k: v for k, v in state["parts"].items() if k not in (replace or [])}
        lows: dict[str, int] = state["lows"]
        if part is None:
            rows.write.parquet(out)
            parts.setdefault("all", []).append(out)
        else:
            rows = rows.withColumn(_PART, part.cast("string"))
            if spread is not None:
                rows = rows.repartition(F.col(_PART), F.pmod(F.xxhash64(spread), F.lit(4)))
            if sort:
                rows = rows.sortWithinPartitions(_PART, *sort)
            rows.write.partitionBy(_PART).parquet(out)
            written = {d.rpartition("/")[2][len(_PART) + 1 :]: d for d in _ls(self.spark, out) if f"/{_PART}=" in d}
            for name, d in written.items():
                parts.setdefault(name, []).append(d)
            if low and written:  # one row a written partition
                found = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField(_PART, T.StringType())])).parquet(out).groupBy(_PART).agg(F.min(low).alias("low"))
                lows |= {written[r[_PART]]: r.low for r in found.collect()}
        kept = {d for dirs in parts.values() for d in dirs}
        self._commit(version, {"parts": parts, "lows": {d: v for d, v in lows.items() if d in kept}, "meta": state["meta"] | (meta or {})})

    def lows(self) -> dict[str, int]:
        """The smallest ``low`` value in each partition."""
        state = self._state()[1]
        return {k: min(state["lows"][d] for d in dirs) for k, dirs in state["parts"].items()}


class SortedRuns(_Versioned):
    """A table in sorted runs, whose files are known by the range of the key they hold.

    ``add`` writes a batch as a run sorted by ``key`` (a bigint), cut into files of about
    ``rows_per_file`` rows. A run that is less than twice as large as what follows is merged into
    it, so there are logarithmically many runs and each row is rewritten about as often at most.
    ``find`` reads only the files whose range holds a looked-up key: the cost of a lookup follows
    the batch, not the history.
    """

    EMPTY = {"runs": [], "meta": {}}

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, rows_per_file: int = 250_000):
        super().__init__(spark, path, schema)
        self.key, self.rows_per_file = key, rows_per_file

    def _dirs(self, state: dict) -> set[str]:
        return {r["dir"] for r in state["runs"]}

    def _files(self, runs: list[dict]) -> list[str]:
        return [f"{r['dir']}/{name}" for r in runs for name, _, _ in r["files"]]

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    @property
    def files(self) -> list[str]:
        return self._files(self._state()[1]["runs"])

    def read(self) -> DataFrame:
        return self._read(self.files)

    def add(self, df: DataFrame) -> None:
        """``df`` is read twice, so it should be a written table. An empty batch adds nothing."""
        version, state = self._state()
        rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        n = rows.count()
        if not n:
            return
        runs, merged = state["runs"], []
        while runs and runs[-1]["rows"] < 2 * n:
            merged.append(runs.pop())
            n += merged[-1]["rows"]
        if merged:
            rows = rows.unionByName(self._read(self._files(merged)))
        out = f"{self.path}/data/{version + 1:09d}-{uuid.uuid4().hex[:8]}"
        parts = -(-n // self.rows_per_file)
        rows = rows.repartitionByRange(parts, self.key) if parts > 1 else rows.coalesce(1)
        rows.sortWithinPartitions(self.key).write.parquet(out)
        ranges = self.spark.read.schema(self.schema).parquet(out).groupBy(F.input_file_name().alias("file")).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))
        files = sorted(((r.file.rpartition("/")[2], r.low, r.high) for r in ranges.collect()), key=lambda f: f[1])  # one row a file of this run
        runs.append({"dir": out, "rows": n, "files": files})
        self._commit(version, {"runs": runs, "meta": state["meta"]})

    def files_of(self, ranges: DataFrame) -> list[str]:
        """Files that hold a key of one of the ``ranges`` (low, high, both inclusive)."""
        runs = [r for r in self._state()[1]["runs"]]
        if not runs:
            return []
        lows, highs = ([np.array([f[i] for f in r["files"]], dtype="int64") for r in runs] for i in (1, 2))

        def touched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hit: set[tuple[int, int]] = set()
            for pdf in batches:
                for k, (low, high) in enumerate(zip(lows, highs)):
                    first, last = np.searchsorted(high, pdf["low"], "left"), np.searchsorted(low, pdf["high"], "right")
                    steps = np.zeros(len(low) + 1, dtype="int64")  # how many ranges begin and end at each file
                    some = first < last
                    np.add.at(steps, first[some], 1)
                    np.add.at(steps, last[some], -1)
                    hit.update((k, int(i)) for i in np.flatnonzero(np.cumsum(steps)[:-1]))
            yield pd.DataFrame(sorted(hit), columns=["run", "file"])

        found = ranges.select(F.col("low").cast("bigint"), F.col("high").cast("bigint")).mapInPandas(touched, "run int, file int").distinct().collect()  # at most one row a file
        return [f"{runs[r.run]['dir']}/{runs[r.run]['files'][r.file][0]}" for r in sorted(found)]

    def find(self, ranges: DataFrame) -> DataFrame:
        """All rows of the files that hold a key of one of the ``ranges``."""
        return self._read(self.files_of(ranges))
