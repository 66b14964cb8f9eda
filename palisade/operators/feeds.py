"""Threat-intel feeds: messages → indicators, one function a feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palisade.sources.schemas import FEED_MESSAGES

# Indicator types of hash fields. SHA384 comes from the SHA3-384 field.
MALWAREBAZAAR_HASHES = {
    "FileHash-MD5": "md5_hash", "FileHash-ImpHash": "imphash", "FileHash-SHA1": "sha1_hash", "FileHash-SHA256": "sha256_hash",
    "FileHash-SHA384": "sha3_384_hash", "FileHash-SSDEEP": "ssdeep", "FileHash-TElfHash": "telfhash", "FileHash-TLSH": "tlsh",
}
ABUSEMALWARE_HASHES = {
    "FileHash-MD5": "md5_hash", "FileHash-ImpHash": "imphash", "FileHash-SHA256": "sha256_hash", "FileHash-SSDEEP": "ssdeep", "FileHash-TLSH": "tlsh",
}


def _messages(df: DataFrame, feed: str, struct: str) -> DataFrame:
    return df.where(F.col("dataset") == feed).withColumn(struct, F.from_json("message", FEED_MESSAGES[feed]))


def _time(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def handle_otx(df: DataFrame) -> DataFrame:
    """One indicator a message; its type is the message's, its time the envelope's."""
    rows = _messages(df, "otx", "_j").select("*", "_j.*").drop("_j", "message")
    renamed = {"type": "ioc_type", "indicator": "ioc", "description": "ioc_description", "content": "ioc_content", "title": "ioc_title"}
    return rows.withColumnsRenamed(renamed).withColumns({"ioc_id": F.col("id").cast("string"), "first_seen": F.col("timestamp")})


def handle_abuseurl(df: DataFrame) -> DataFrame:
    """One URL a message; the whole message stays as struct ``abuseurl``."""
    rows = _messages(df, "abuseurl", "abuseurl")
    return rows.withColumns(
        {"ioc": F.col("abuseurl.url"), "ioc_id": F.col("abuseurl.id"), "ioc_type": F.lit("URL"), "first_seen": _time("abuseurl.date_added")}
    ).drop("message")


def _hashes(struct: str, fields: dict[str, str]) -> Column:
    """One (ioc_type, ioc) a hash that is there; types without a value never become rows."""
    each = F.array(*(F.struct(F.lit(t).alias("ioc_type"), F.col(f"{struct}.{f}").alias("ioc")) for t, f in fields.items()))
    return F.inline(F.filter(each, lambda h: h["ioc"].isNotNull()))


def handle_malwarebazaar(df: DataFrame) -> DataFrame:
    """A row a hash of the file, up to eight; messages without any hash give none."""
    rows = _messages(df, "malwarebazaar", "malwarebazaar")
    m = "malwarebazaar"
    return rows.select(
        f"{m}.file_name", f"{m}.file_size", f"{m}.file_type", f"{m}.file_type_mime", _time(f"{m}.first_seen").alias("first_seen"),
        _time(f"{m}.last_seen").alias("last_seen"), _hashes(m, MALWAREBAZAAR_HASHES), *(c for c in rows.columns if c != "message"),
    )


def handle_abusemalware(df: DataFrame) -> DataFrame:
    """A row a hash of the file, up to five; messages without any hash give none."""
    rows = _messages(df, "abusemalware", "abusemalware")
    m = "abusemalware"
    return rows.select(
        F.col(f"{m}.file_size").try_cast("long").alias("file_size"), f"{m}.file_type", _time(f"{m}.firstseen").alias("first_seen"),
        _hashes(m, ABUSEMALWARE_HASHES), *(c for c in rows.columns if c != "message"),
    )


#: feed → function; rows of other datasets are ignored by all of them
FEEDS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "otx": handle_otx, "abuseurl": handle_abuseurl, "malwarebazaar": handle_malwarebazaar, "abusemalware": handle_abusemalware,
}


def all_feeds(messages: DataFrame) -> DataFrame:
    """Indicators of all feeds in one table, columns by name, missing ones null."""
    out = None
    for handle in FEEDS.values():
        part = handle(messages)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
