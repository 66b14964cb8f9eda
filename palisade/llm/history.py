"""Deduplicating new batches against all history: a prefix-tree hash forest of indicators.

Indicators are brought to a canonical spelling. The signature of a fuzzy hash is the sequence of
the hashes of its segments, a sixteenth of the value each; each accepted value is filed in
several permutations of it: permutation p starts with segment p. The permutations are kept as
sorted runs, so all that share a prefix stand in one range. A batch entry is located by prefix,
from the longest on, widened until the recall target: with at most four edits and sixteen
segments three segments in a row at least are untouched, so prefixes of three have a recall of 1,
the default. Candidates are verified by edit distance.

A lookup reads only the files whose range holds one of the batch's prefixes (for values that are
equal or different, their whole signature), so its cost follows the batch. Runs are merged as they
grow.
"""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from itertools import combinations_with_replacement
from math import factorial, prod

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators.skew import attach, spread_join
from palisade.storage import SortedRuns, materialize, workspace

EDITS, SEGMENTS = 4, 16
LONGEST = 4  # segments in a filed prefix, 16 bits of hash each
FUZZY = ("filehash-ssdeep", "filehash-tlsh")

_DOT = re.compile(r"\s*[\[({<]\s*(?:\.|dot|d0t)\s*[\])}>]\s*|\\\.|\s+dot\s+", re.I)
_COLON = re.compile(r"\s*[\[({<]\s*(?::|colon)\s*[\])}>]\s*", re.I)
_SEPARATOR = re.compile(r"[\[({<]\s*(://|/)\s*[\])}>]")
_SCHEME = re.compile(r"^h[tx*_]{2}p(s?)(?=:)", re.I)
_DOTS = re.compile("[。．｡]")
_URL = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(?:#.*)?$", re.S)
_PERCENT = re.compile(r"%([0-9A-Fa-f]{2})")
_UNRESERVED = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-._~")
_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}


def refang(value: str) -> str:
    """Outer blanks removed, bracketed or worded dots and colons and disguised http restored."""
    value = _SEPARATOR.sub(r"\1", _COLON.sub(":", _DOT.sub(".", value.strip())))
    return _SCHEME.sub(lambda m: "http" + m[1].lower(), value)


def canonical_host(host: str) -> str:
    """Lower case, ASCII (IDNA) labels, no final dot."""
    labels = []
    for label in _DOTS.sub(".", host).removesuffix(".").split("."):
        label = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", label).lower())
        if label.startswith("xn--"):
            try:
                label = unicodedata.normalize("NFC", label[4:].encode("ascii").decode("punycode").lower())
            except (UnicodeError, ValueError):
                pass
        if not label.isascii():
            try:
                label = "xn--" + label.encode("punycode").decode("ascii")
            except UnicodeError:
                pass
        labels.append(label)
    return ".".join(labels)


def canonical_ip(value: str) -> str:
    address, _, prefix = value.strip("[]").partition("/")
    parts = address.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        address = ".".join(str(int(p)) for p in parts)
    try:
        ip = ipaddress.ip_address(address)
    except ValueError:
        return value.lower()
    return str(ip) if prefix in ("", str(ip.max_prefixlen)) else f"{ip}/{prefix}"


def _percent(text: str) -> str:
    return _PERCENT.sub(lambda m: chr(int(m[1], 16)) if int(m[1], 16) in _UNRESERVED else "%" + m[1].upper(), text)


def _without_dots(path: str) -> str:
    out: list[str] = []
    parts = path.split("/")
    for i, part in enumerate(parts):
        if part == "..":
            if len(out) > 1:
                out.pop()
        elif part != ".":
            out.append(part)
            continue
        if i == len(parts) - 1:
            out.append("")
    return "/".join(out)


def canonical_url(value: str) -> str:
    """RFC 3986 6.2.2 and 6.2.3; the fragment goes, the host as by :func:`canonical_host`."""
    m = _URL.match(value)
    if not m:
        return value
    scheme, authority, path, query = m[1].lower(), m[2], _percent(m[3]), _percent(m[4] or "")
    if authority is None:
        return f"{scheme}:{path}{query}"
    user, at, place = authority.rpartition("@")
    host, colon, port = place, "", ""
    if not place.endswith("]"):
        head, colon, tail = place.rpartition(":")
        if colon and tail.isdigit() or colon and not tail:
            host, port = head, tail
    host = host.lower() if host.startswith("[") else canonical_host(_percent(host))
    port = "" if port == _PORTS.get(scheme) else port
    return f"{scheme}://{_percent(user)}{at}{host}{':' + port if port else ''}{_without_dots(path) or '/'}{query}"


def canonical(kind: str, value: str) -> str:
    """The spelling under which equal indicators of a (lower-case) type agree."""
    value = refang(value)
    if kind in ("ipv4", "ipv6", "ip"):
        return canonical_ip(value)
    if kind in ("domain", "hostname"):
        return canonical_host(value)
    if kind in ("url", "uri"):
        return canonical_url(value)
    if kind == "filehash-tlsh":
        return value.upper()
    if kind.startswith("filehash-") and kind != "filehash-ssdeep":
        return value.lower()
    return value


def _canonical_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for row_id, batch, kind, value in zip(pdf["row_id"], pdf["batch_no"], pdf["ioc_type"], pdf["ioc"]):
            kind = (kind or "").strip().lower()
            spelled = canonical(kind, value) if value and value.strip() else ""
            if spelled:
                rows.append((row_id, batch, kind, spelled))
        yield pd.DataFrame(rows, columns=["row_id", "batch_no", "kind", "value"])


def canonical_rows(df: DataFrame) -> DataFrame:
    """(row_id, batch_no, ioc_type, ioc) → (row_id, batch_no, kind, value); blank iocs drop out."""
    return df.select("row_id", "batch_no", "ioc_type", "ioc").where("ioc is not null").mapInPandas(
        _canonical_rows, "row_id bigint, batch_no bigint, kind string, value string"
    )


def sure_depth(segments: int, edits: int = EDITS) -> int:
    """Segments in a row that ``edits`` edits leave untouched wherever they fall."""
    return -(-(segments - edits) // (edits + 1))


def recall_of_depth(depth: int, edits: int = EDITS, segments: int = SEGMENTS) -> float:
    """Share of the placements of ``edits`` edits that leave ``depth`` segments in a row untouched."""
    hit = 0
    for places in combinations_with_replacement(range(segments), edits):
        touched = sorted(set(places))
        free = max(b - a - 1 for a, b in zip([-1, *touched], [*touched, segments]))
        if free >= depth:
            hit += factorial(edits) // prod(factorial(places.count(x)) for x in touched)
    return hit / segments**edits


def prefix_depth(recall: float) -> int:
    """From the longest prefix on, widened one segment at a time until ``recall`` is reached."""
    depth = LONGEST
    while depth > sure_depth(SEGMENTS) and recall_of_depth(depth) < recall:
        depth -= 1
    return depth


class HashForest:
    """Accepted indicators; ``accept(batch)`` finds a batch's repeats and files the rest.

    The batch has (row_id, kind, value), row_ids larger than all accepted ones; it is read more
    than once, so it should be a written table. The result has (row_id_a, row_id_b): row b repeats
    the accepted row a, the first by row_id whose value is equal or, for fuzzy hashes, at most four
    edits away. What repeats an accepted row is not accepted itself. Repeated values within a batch
    follow the order of row_id; an empty batch gives no pair. Equal values are folded before
    anything is compared, so a value that holds a third of all rows is one entry.

    With ``recall`` below 1 longer prefixes are searched, if they reach it: fewer candidates are
    verified, and repeats that share no such prefix with the accepted value are taken as new.
    """

    EXACT = "kind string, value string, row_id bigint, sig bigint"
    RUNS = "kind string, q int, key bigint, at int, value string, row_id bigint"

    def __init__(self, spark: SparkSession, path: str, recall: float = 1.0, rows_per_file: int = 250_000):
        self.spark, self.depth = spark, prefix_depth(recall)
        self.exact = SortedRuns(spark, f"{path}/exact", self.EXACT, "sig", rows_per_file)
        self.runs = SortedRuns(spark, f"{path}/runs", self.RUNS, "key", rows_per_file)

    # -- signatures -------------------------------------------------------------------------
    # A value of n characters has segments of q = n // 16 characters, from 5 to 15 characters n
    # segments of one. All values of up to four characters are within four edits of each other, so
    # at most one a type is accepted; they have no segments and are filed under one key.

    @staticmethod
    def _key(text: str, at: Column, q: Column) -> Column:
        """Hashes of the four segments from ``at`` on, the first in the highest bits."""
        key = F.lit(0).cast("bigint")
        for i in range(LONGEST):
            part = F.substring(F.col(text), at + 1 + q * i, q)
            key = key.bitwiseOR(F.shiftleft(F.xxhash64("kind", q, part).bitwiseAND(F.lit(0xFFFF)), 16 * (LONGEST - 1 - i)))
        return key

    @staticmethod
    def _sure(n: Column) -> Column:
        """:func:`sure_depth` of a value of ``n`` characters, 1 at least."""
        m = F.least(n, F.lit(SEGMENTS))
        return F.greatest(F.lit(1), F.ceil((m - EDITS) / F.lit(EDITS + 1))).cast("int")

    def _filed(self, entries: DataFrame) -> DataFrame:
        """One row a permutation: all places from which a prefix is searched."""
        n = F.length("value")
        q = F.when(n >= SEGMENTS, F.floor(n / F.lit(SEGMENTS))).when(n > EDITS, 1).otherwise(0).cast("int")
        last = F.when(n > EDITS, F.least(n, F.lit(SEGMENTS)) - self._sure(n)).otherwise(0)
        rows = entries.select("kind", "value", "row_id", q.alias("q"), F.explode(F.sequence(F.lit(0), last)).alias("tree"))
        rows = rows.withColumn("at", F.col("tree") * F.col("q"))
        return rows.select("kind", "q", self._key("value", F.col("at"), F.col("q")).alias("key"), "at", "value", "row_id")

    def _probes(self, entries: DataFrame) -> DataFrame:
        """All places where an accepted value's prefix may stand in these values, and how many of
        its segments count (``depth``)."""
        n = F.length("value")
        shortest = F.greatest(n - EDITS, F.lit(EDITS + 1))  # of the accepted values with segments that may be near
        sizes = F.sequence(F.greatest(F.lit(1), F.floor(shortest / F.lit(SEGMENTS))).cast("int"), F.greatest(F.lit(1), F.floor((n + EDITS) / F.lit(SEGMENTS))).cast("int"))
        rows = entries.select("kind", "value", "row_id", F.explode(F.when(n <= 2 * EDITS, F.array_prepend(sizes, F.lit(0))).otherwise(sizes)).alias("q"))
        sure = F.when(F.col("q") == 1, self._sure(shortest)).otherwise(F.lit(sure_depth(SEGMENTS)))
        widest = F.lit(self.depth - sure_depth(SEGMENTS))  # 0 for full recall
        rows = rows.withColumn("depth", F.when(F.col("q") == 0, LONGEST).otherwise(F.least(sure + widest, F.lit(LONGEST))))
        size = F.col("q") * F.col("depth")
        last = F.when(F.col("q") > 0, n - size).otherwise(0)
        rows = rows.where(n >= size).withColumn("at", F.explode(F.sequence(F.lit(0), last)))
        # a filed prefix starts at a multiple of q, and edits move it by four places at most
        off = F.col("at") % F.greatest(F.col("q"), F.lit(1))
        rows = rows.where((off <= EDITS) | (F.col("q") - off <= EDITS))
        rows = rows.withColumn("key", self._key("value", F.col("at"), F.col("q")))
        return rows.select("kind", "q", "depth", self._prefix("depth").alias("prefix"), "at", F.col("value").alias("probe"), F.col("row_id").alias("probe_id"))

    @staticmethod
    def _prefix(depth: str) -> Column:
        """The key with only its first ``depth`` segments: the low end of their range."""
        return F.expr(f"shiftleft(shiftright(key, {16 * LONGEST} - 16 * {depth}), {16 * LONGEST} - 16 * {depth})")

    @staticmethod
    def _ranges(probes: DataFrame) -> DataFrame:
        return probes.select(F.col("prefix").alias("low"), F.expr(f"prefix | (shiftleft(1L, {16 * LONGEST} - 16 * depth) - 1)").alias("high"))

    def _near(self, probes: DataFrame, filed: DataFrame) -> DataFrame:
        """(row_id, probe_id) within four edits: prefix, length and position bounds, then the distance."""
        depths = [r[0] for r in probes.select("depth").distinct().collect()]  # at most four
        by_depth = F.when(F.col("q") == 0, F.array(F.lit(LONGEST))).otherwise(F.array(*map(F.lit, depths)))
        filed = filed.withColumn("depth", F.explode(by_depth)) if depths else filed.withColumn("depth", F.lit(0))
        filed = filed.select("kind", "q", "depth", self._prefix("depth").alias("prefix"), F.col("at").alias("place"), "value", "row_id")
        filed = materialize(filed.join(probes.select("kind", "q", "depth", "prefix").distinct(), ["kind", "q", "depth", "prefix"], "left_semi"), workspace(self.spark, "filed"))
        found = spread_join(probes, filed, ["kind", "q", "depth", "prefix"], F.col("row_id"))
        size = F.col("q") * F.col("depth")
        same = F.substring("probe", F.col("at") + 1, size) == F.substring("value", F.col("place") + 1, size)
        fit = (F.abs(F.length("value") - F.length("probe")) <= EDITS) & (F.abs(F.col("at") - F.col("place")) <= EDITS) & same
        pairs = found.where(fit).select("row_id", "value", "probe_id", "probe").distinct()
        return pairs.where(F.levenshtein("value", "probe", EDITS) >= 0).select("row_id", "probe_id")

    # -- one batch --------------------------------------------------------------------------

    def accept(self, batch: DataFrame) -> DataFrame:
        keys = ["kind", "value"]
        first = batch.groupBy(*keys).agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("n"))
        first = materialize(first.withColumn("sig", F.xxhash64(*keys)), workspace(self.spark, "batch-values"))
        total = first.agg(F.sum("n")).first()[0] or 0
        known = self.exact.find(first.select(F.col("sig").alias("low"), F.col("sig").alias("high"))).select("sig", *keys, F.col("row_id").alias("old"))
        first = materialize(first.join(known, ["sig", *keys], "left"), workspace(self.spark, "values"))
        fuzzy = F.col("kind").isin(*FUZZY)
        near = self._resolve(materialize(first.where(F.col("old").isNull() & fuzzy).select(*keys, "row_id"), workspace(self.spark, "fuzzy")))
        roots = first.join(near, "row_id", "left").withColumn("root", F.coalesce("old", "near", "row_id"))
        roots = materialize(roots.select(*keys, "sig", "row_id", "n", "old", "near", "root"), workspace(self.spark, "roots"))
        # Runs first: a value is never known as accepted without being found by its neighbours. If the
        # second commit fails, the next attempt finds its own runs and comes to the same result.
        accepted = roots.where(fuzzy & F.col("old").isNull() & F.col("near").isNull()).select(*keys, "row_id")
        self.runs.add(materialize(self._filed(accepted), workspace(self.spark, "permutations")))
        # an exact entry stands for each spelling and names the accepted row
        self.exact.add(roots.where("old is null").select(*keys, F.col("root").alias("row_id"), "sig"))
        pairs = attach(batch.select("row_id", *keys), roots.select(*keys, "root", "n"), keys, "n", total, F.col("row_id"))
        return pairs.where("row_id <> root").select(F.col("root").alias("row_id_a"), F.col("row_id").alias("row_id_b"))

    def _resolve(self, values: DataFrame) -> DataFrame:
        """(row_id, near): the accepted row each value repeats; values that are new have no row."""
        probes = materialize(self._probes(values), workspace(self.spark, "probes"))
        if self.runs.files:
            known = self._near(probes, self.runs.find(self._ranges(probes))).groupBy("probe_id").agg(F.min("row_id").alias("near"))
            known = materialize(known.withColumnRenamed("probe_id", "row_id"), workspace(self.spark, "near-history"))
            open_ = values.join(known, "row_id", "left_anti")
            probes = probes.join(open_.select(F.col("row_id").alias("probe_id")), "probe_id", "left_semi")
        else:
            known, open_ = self.spark.createDataFrame([], "row_id bigint, near bigint"), values
        own = materialize(self._filed(open_), workspace(self.spark, "own"))
        # Linear step: each value against the earliest holder of each prefix only. Many variants of
        # one value all find that value here, and no pair of variants is formed.
        depths = [r[0] for r in probes.select("depth").distinct().collect()]  # at most four
        prefixes = own.withColumn("depth", F.explode(F.when(F.col("q") == 0, F.array(F.lit(LONGEST))).otherwise(F.array(*map(F.lit, depths)).cast("array<int>"))))
        prefixes = prefixes.withColumn("prefix", self._prefix("depth"))
        on = ["kind", "q", "depth", "prefix"]
        earliest = prefixes.groupBy(*on).agg(F.min("row_id").alias("pivot"))
        pivots = probes.join(earliest, on).groupBy("probe_id").agg(F.min("pivot").alias("pivot"))
        pivots = open_.join(pivots.withColumnRenamed("probe_id", "row_id"), "row_id", "left")
        pivots = materialize(pivots.withColumn("pivot", F.least("row_id", "pivot")), workspace(self.spark, "pivots"))
        heads = pivots.where("pivot = row_id").select("row_id")  # nothing earlier may be near: accepted
        head_value = pivots.where("pivot = row_id").select(F.col("row_id").alias("pivot"), F.col("value").alias("pivot_value"))
        first = pivots.where("pivot < row_id").join(head_value, "pivot").where(F.levenshtein("value", "pivot_value", EDITS) >= 0)
        first = materialize(first.select("row_id", F.col("pivot").alias("near")), workspace(self.spark, "near-first"))
        # The few that are left: verified links to earlier values, then decided in order of row_id.
        left = materialize(pivots.where("pivot < row_id").join(first, "row_id", "left_anti").select("row_id"), workspace(self.spark, "left"))
        found = known.unionByName(first)
        if left.isEmpty():
            return found
        rest = materialize(probes.join(left.select(F.col("row_id").alias("probe_id")), "probe_id", "left_semi"), workspace(self.spark, "rest"))
        # only what is accepted or still open can be the row that is repeated
        holders = own.join(first.select("row_id"), "row_id", "left_anti")
        links = materialize(self._near(rest, holders).where("row_id < probe_id"), workspace(self.spark, "links"))
        return found.unionByName(self._in_order(left, links, heads))

    def _in_order(self, open_: DataFrame, links: DataFrame, accepted: DataFrame) -> DataFrame:
        """A value is a repeat if an accepted earlier value is linked to it, else accepted.

        Round by round, every value whose earlier linked values are all decided is decided, the
        smallest open one at least. Each round is a written table of all decisions so far, so plans
        don't grow; rounds follow the longest chain of values that wait for each other.
        """
        state = open_.withColumn("near", F.lit(None).cast("bigint")).withColumn("open", F.lit(True))
        state = state.unionByName(accepted.select("row_id", F.lit(None).cast("bigint").alias("near"), F.lit(False).alias("open")))
        while True:
            state = materialize(state, workspace(self.spark, "round"))
            waiting = state.where("open").select("row_id")
            if waiting.isEmpty():
                return state.where("near is not null").select("row_id", "near")
            seen = links.join(waiting.select(F.col("row_id").alias("probe_id")), "probe_id", "left_semi").join(state, "row_id")
            seen = seen.groupBy("probe_id").agg(F.min(F.when(~F.col("open") & F.col("near").isNull(), F.col("row_id"))).alias("taken"), F.min(F.when(F.col("open"), F.col("row_id"))).alias("wait"))
            # settled: no earlier value waits, or none that could come before the accepted one found
            told = state.join(seen.withColumnRenamed("probe_id", "row_id"), "row_id", "left")
            settled = F.expr("wait is null or coalesce(taken < wait, false)")
            state = told.select("row_id", F.when(F.col("open") & settled, F.col("taken")).otherwise(F.col("near")).alias("near"), (F.col("open") & ~settled).alias("open"))
