"""Mixed timestamp formats and time zones → one UTC instant.

Method: the raw strings are reduced to a dictionary of distinct (text, zone, date order),
each entry is parsed exhaustively once, the dictionary is persisted and grows with every
batch, and rows get their instant by a join back to it. Callers may keep texts of the source's
usual form (``USUAL``) away from the dictionary, where a cast reads them or they are not asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.operators.skew import attach
from palisade.storage import SnapshotTable, materialize, workspace

# Month names as they appear in logs, three or more letters, lower case.
_MONTHS = [
    ("jan", "januar", "january", "jän", "janv", "janvier", "ene", "enero", "janeiro", "gen", "gennaio"),
    ("feb", "februar", "february", "févr", "fév", "fevr", "février", "febrero", "fev", "fevereiro", "febbraio"),
    ("mar", "mär", "mrz", "märz", "march", "mars", "marzo", "março"),
    ("apr", "april", "avr", "avril", "abr", "abril", "aprile"),
    ("may", "mai", "mayo", "maio", "mag", "maggio"),
    ("jun", "juni", "june", "juin", "junio", "junho", "giu", "giugno"),
    ("jul", "juli", "july", "juil", "juillet", "julio", "julho", "lug", "luglio"),
    ("aug", "august", "août", "aout", "ago", "agosto"),
    ("sep", "sept", "september", "septembre", "septiembre", "set", "setembro", "settembre"),
    ("oct", "okt", "oktober", "october", "octobre", "octubre", "out", "outubro", "ott", "ottobre"),
    ("nov", "november", "novembre", "noviembre", "novembro"),
    ("dec", "dez", "dezember", "december", "déc", "décembre", "dic", "diciembre", "dezembro", "dicembre"),
]
MONTH_OF = {name: i for i, names in enumerate(_MONTHS, 1) for name in names}

# Zone abbreviations and their offsets from UTC in minutes.
ABBREVIATION_MINUTES = {
    "UTC": 0, "GMT": 0, "Z": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540,
    "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780, "BRT": -180,
    "BRST": -120, "ART": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420,
    "MDT": -360, "PST": -480, "PDT": -420,
}

_CLOCK = r"(?P<H>\d{1,2}):(?P<M>\d{2})(?::(?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?)?"
_ZONE = r"(?:\s*(?P<z>Z|[+-]\d{2}(?::?\d{2})?|[A-Z]{3,4}))?"
_AMPM = r"(?:\s*(?P<p>[AaPp])\.?[Mm]\.?)?"
_LAYOUTS = [
    re.compile(p + "$")
    for p in (
        r"(?P<y>\d{4})-(?P<m>\d{2})-(?P<d>\d{2})[T ]" + _CLOCK + _ZONE,
        r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})T?(?P<H>\d{2})(?P<M>\d{2})(?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?(?P<z>Z|[+-]\d{2}:?\d{2})",
        r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})T(?P<H>\d{2})(?P<M>\d{2})(?P<S>\d{2})(?:[.,](?P<f>\d{1,9}))?",
        r"(?P<d>\d{1,2})[/-](?P<b>[^\W\d_]+)\.?[/-](?P<y>\d{4})[: ]" + _CLOCK + _ZONE,
        r"(?P<a1>\d{1,2})[/.](?P<a2>\d{1,2})[/.](?P<y>\d{4}),? " + _CLOCK + _AMPM + _ZONE,
        r"(?P<y>\d{4})/(?P<m>\d{1,2})/(?P<d>\d{1,2}) " + _CLOCK + _ZONE,
        r"(?P<b>[^\W\d_]+)\.? (?P<d>\d{1,2}), (?P<y>\d{4}),? " + _CLOCK + _AMPM + _ZONE,
        r"[^\W\d_]{2,9}\.?,? (?P<b>[^\W\d_]+)\.? +(?P<d>\d{1,2}) " + _CLOCK + r" (?:(?P<z>[A-Z]{3,4}) )?(?P<y>\d{4})",
        r"(?:[^\W\d_]{2,9}\.?, )?(?P<d>\d{1,2}) (?P<b>[^\W\d_]+)\.? (?P<y>\d{4}) " + _CLOCK + _ZONE,
    )
]
_EPOCH = re.compile(r"(\d{10})(?:[.,](\d{1,9}))?$|(\d{13}|\d{16}|\d{19})$")
_UNIX = datetime(1970, 1, 1)


@lru_cache(maxsize=4096)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except Exception:  # noqa: BLE001 - unknown or null zone: local texts stay unreadable
        return None


def _micros(d: datetime) -> int:
    delta = d - _UNIX
    return (delta.days * 86400 + delta.seconds) * 1_000_000 + delta.microseconds


def parse_time(text: str | None, zone: str | None, date_order: str | None) -> tuple[int, int] | None:
    """Earliest and latest UTC reading in microseconds, or None where unreadable.

    Both are equal unless the text is local and falls into a repeated hour. A local time that
    the clock skips is read with the offset in force before the change. Digits finer than
    microseconds are cut off. Numeric dates follow ``date_order`` (``mdy``, else day first).
    """
    if text is None:
        return None
    s = text.strip()
    if m := _EPOCH.match(s):
        if m[3]:
            n = int(m[3]) * 1000 if len(m[3]) == 13 else int(m[3]) // 10 ** (len(m[3]) - 16)
        else:
            n = int(m[1]) * 1_000_000 + int(((m[2] or "") + "000000")[:6])
        return n, n
    for layout in _LAYOUTS:
        if not (m := layout.match(s)):
            continue
        g = m.groupdict()
        if g.get("b"):
            month, day = MONTH_OF.get(g["b"].lower()), int(g["d"])
            if month is None:
                continue
        elif g.get("a1"):
            month, day = (int(g["a1"]), int(g["a2"])) if date_order == "mdy" else (int(g["a2"]), int(g["a1"]))
        else:
            month, day = int(g["m"]), int(g["d"])
        hour = int(g["H"])
        if g.get("p"):
            if not 1 <= hour <= 12:
                return None
            hour = hour % 12 + 12 * (g["p"] in "pP")
        try:
            local = datetime(int(g["y"]), month, day, hour, int(g["M"]), int(g["S"] or 0), int(((g.get("f") or "") + "000000")[:6]))
        except ValueError:
            return None
        z = g.get("z")
        tz = _zone(zone) if zone else None
        if z and z[0] in "+-":
            digits = z[1:].replace(":", "").ljust(4, "0")
            minutes = int(digits[:2]) * 60 + int(digits[2:])
            if minutes > 18 * 60 or int(digits[2:]) > 59:
                return None
            n = _micros(local) - (-1 if z[0] == "-" else 1) * minutes * 60_000_000
            return n, n
        if z:
            for fold in (0, 1):  # the sensor's own zone decides what its abbreviations mean
                aware = local.replace(tzinfo=tz, fold=fold) if tz else None
                if aware is not None and aware.tzname() == z:
                    n = _micros(local - aware.utcoffset())
                    return n, n
            if z not in ABBREVIATION_MINUTES:
                return None
            n = _micros(local) - ABBREVIATION_MINUTES[z] * 60_000_000
            return n, n
        if tz is None:
            return None
        first = local.replace(tzinfo=tz, fold=0)
        second = local.replace(tzinfo=tz, fold=1)
        a = _micros(local - first.utcoffset())
        b = _micros(local - second.utcoffset())
        return (a, b) if b > a else (a, a)  # b < a: a skipped time, the earlier offset holds
    return None


def _parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        got = [parse_time(t, z, o) for t, z, o in zip(pdf["text"], pdf["zone"], pdf["date_order"])]
        pdf = pdf[["text", "zone", "date_order"]].copy()
        pdf["first_us"] = pd.array([g[0] if g else None for g in got], dtype="Int64")
        pdf["last_us"] = pd.array([g[1] if g else None for g in got], dtype="Int64")
        yield pdf


class TimeDictionary:
    """Persistent dictionary text → instant; see the module docstring.

    ``normalize`` adds ``epoch_us`` to the rows of a batch: null for null, blank, placeholder
    and impossible texts and for zone-less texts of an unknown zone. Input columns may have
    any names: the four inputs are given as columns; one named as the output is replaced. Rows
    are neither lost nor multiplied; repeated rows stay. A text that very many rows share is
    spread over tasks by the rows' ingest time.
    """

    SCHEMA = "text string, zone string, date_order string, first_us bigint, last_us bigint"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, SnapshotTable(spark, path, self.SCHEMA)

    def normalize(self, df: DataFrame, text: Column, zone: Column, date_order: Column, ingest_us: Column, out: str = "epoch_us") -> DataFrame:
        keys = ["text", "zone", "date_order"]
        rows = df.select(
            F.struct("*").alias("_row"), F.trim(text).alias("text"), F.coalesce(zone, F.lit("")).alias("zone"),
            F.coalesce(date_order, F.lit("")).alias("date_order"), ingest_us.alias("_i"),
        )
        digits = F.coalesce(F.col("text").rlike("[0-9]"), F.lit(False))  # placeholders without a digit can't be read
        seen = materialize(rows.where(digits).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), workspace(self.spark, "seen-times"))
        total = seen.agg(F.sum("_n")).first()[0] or 0
        new = seen.select(keys)
        if self.table.partitions:
            new = new.join(self.table.read().select(keys), keys, "left_anti")
        self.table.write(new.mapInPandas(_parse_batches, self.SCHEMA))
        side = seen.join(self.table.read(), keys)
        found = attach(rows.where(digits), side, keys, "_n", total, F.col("_i"))
        instant = F.when(F.col("last_us") <= F.col("_i"), F.col("last_us")).otherwise(F.col("first_us"))
        kept = [F.col(f"_row.`{c}`") for c in df.columns if c != out]
        unread = rows.where(~digits).select(*kept, F.lit(None).cast("bigint").alias(out))
        return found.select(*kept, instant.alias(out)).unionByName(unread)


# The usual form of each source's time text.
USUAL = {
    "apache_web": r"^\d{2}/(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4}$",
    "zeek_conn": r"^\d+\.\d{6}$",
    "aws_cloudtrail": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
    "iocs": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC$",
}


def with_sensor_zone(df: DataFrame, sensors: DataFrame, limit: int = 100_000) -> DataFrame:
    """Adds ``zone_name`` and ``date_order`` of each row's sensor (null where unknown).

    The sensor table is a fixed lookup; it is broadcast only while it has at most ``limit``
    rows, beyond that the join shuffles.
    """
    side = sensors.select("sensor", "zone_name", "date_order").dropDuplicates(["sensor"])
    if side.limit(limit + 1).count() <= limit:
        side = F.broadcast(side)
    return df.join(side, "sensor", "left")
