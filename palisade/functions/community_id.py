"""Community ID version 1: a hash that is the same for both directions of a flow.

The column form is built of Spark's own expressions only, for IPv4 and IPv6, with ports, ICMP
messages or neither. The plain function is the same by the standard library.
"""

from __future__ import annotations

import base64
import hashlib
import ipaddress
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TCP, UDP, SCTP, ICMP, ICMP6 = 6, 17, 132, 1, 58
# Fixed values of the public specification: ICMP types that answer each other.
_ICMP_PAIRS = {8: 0, 0: 8, 13: 14, 14: 13, 15: 16, 16: 15, 17: 18, 18: 17, 10: 9, 9: 10}
_ICMP6_PAIRS = {128: 129, 129: 128, 130: 131, 131: 130, 133: 134, 134: 133, 135: 136, 136: 135, 139: 140, 140: 139, 144: 145, 145: 144}


def community_id(src_ip: str | None, src_port: int | None, dst_ip: str | None, dst_port: int | None, proto: int | None, seed: int = 0) -> str | None:
    """The id of one flow; null where an address, the protocol or a needed port is missing or invalid.

    For ICMP the ports are type and code. Ports of other port-less protocols are ignored.
    """
    try:
        a, b = ipaddress.ip_address(src_ip), ipaddress.ip_address(dst_ip)
        proto = int(proto)
        if not 0 <= proto <= 255 or a.version != b.version:
            return None
        ports: tuple[int, int] | None = None
        one_way = False
        if proto in (TCP, UDP, SCTP):
            ports = int(src_port), int(dst_port)
        elif proto in (ICMP, ICMP6):
            pairs = _ICMP_PAIRS if proto == ICMP else _ICMP6_PAIRS
            one_way = int(src_port) not in pairs
            ports = int(src_port), int(dst_port) if one_way else pairs[int(src_port)]
        if ports and not all(0 <= p <= 65535 for p in ports):
            return None
    except (ValueError, TypeError):
        return None
    x, y = (a.packed, ports[0] if ports else 0), (b.packed, ports[1] if ports else 0)
    if not one_way and y < x:
        x, y = y, x
    data = int(seed).to_bytes(2, "big") + x[0] + y[0] + bytes([proto, 0])
    if ports:
        data += x[1].to_bytes(2, "big") + y[1].to_bytes(2, "big")
    return "1:" + base64.b64encode(hashlib.sha1(data).digest()).decode()


_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def _v4_hex(ip: Column, parts: Column | None = None) -> Column:
    """8 hex digits of an IPv4 address; ``parts`` are its numbers as texts, where they are at hand."""
    parts = F.split(ip, r"\.") if parts is None else parts
    return F.concat(*(F.lpad(F.hex(F.get(parts, F.lit(i)).try_cast("int")), 2, "0") for i in range(4)))


def _v6_hex(ip: Column) -> Column:
    """32 hex digits of an IPv6 address, null where it is none."""
    # a dotted tail becomes two groups of hex digits
    tail = F.regexp_extract(ip, r":([^:]*)$", 1)
    dotted = tail.rlike(_IPV4)
    text = F.when(dotted, F.concat(F.regexp_replace(ip, r"[^:]*$", ""), F.regexp_replace(_v4_hex(tail), r"^(....)", "$1:"))).otherwise(ip)
    halves = F.split(F.lower(text), "::")
    groups = lambda i: F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    left, right = groups(0), groups(1)
    missing = 8 - F.size(left) - F.size(right)
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
    joined = F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), "")
    compressed = F.size(halves) == 2
    group = r"[0-9A-Fa-f]{1,4}"
    plain = rf"^(?:{group}:){{7}}{group}$"
    short = rf"^(?:{group}(?::{group})*)?::(?:{group}(?::{group})*)?$"
    valid = F.when(compressed, text.rlike(short) & (missing >= 1)).otherwise(text.rlike(plain))
    return F.when(valid, F.upper(joined))


def _number(c: Column, high: int) -> Column:
    n = c.cast("int")
    return F.when(n.between(0, high), n)


def _pairs_of(d: dict[int, int]) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(d.items())))


def _hex4(c: Column) -> Column:
    return F.lpad(F.hex(c), 4, "0")


def _flow(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column, proto: Column, parts: tuple[Column | None, Column | None] = (None, None)) -> dict[str, Column]:
    """Stage 1: addresses in hex digits, protocol and ports as valid numbers or null."""
    v4 = src_ip.rlike(_IPV4) & dst_ip.rlike(_IPV4)
    # versions may not be mixed: an address of the other version is null in either branch
    src, dst = (F.when(v4, _v4_hex(ip, p)).otherwise(_v6_hex(ip)) for ip, p in zip((src_ip, dst_ip), parts))
    return {"src": src, "dst": dst, "code": _number(proto, 255), "sport": _number(src_port, 65535), "dport": _number(dst_port, 65535)}


def _ends(f: dict[str, Column]) -> dict[str, Column]:
    """Stage 2: either end as address and port, and whether their order is kept."""
    code, sport, dport = f["code"], f["sport"], f["dport"]
    answer = F.when(code == ICMP, F.try_element_at(_pairs_of(_ICMP_PAIRS), sport)).when(code == ICMP6, F.try_element_at(_pairs_of(_ICMP6_PAIRS), sport))
    icmp, has_ports = code.isin(ICMP, ICMP6), code.isin(TCP, UDP, SCTP)
    a = F.concat(f["src"], F.when(has_ports | icmp, _hex4(sport)).otherwise(F.lit("")))
    b = F.concat(f["dst"], F.when(has_ports, _hex4(dport)).when(icmp, _hex4(F.coalesce(answer, dport))).otherwise(F.lit("")))
    return {"a": a, "b": b, "code": code, "one_way": icmp & answer.isNull(), "size": F.length(f["src"])}


def _text(e: dict[str, Column], use_seed: int | None) -> Column:
    """Stage 3: the hex digits that are hashed."""
    keep = e["one_way"] | (e["a"] <= e["b"])
    low, high = F.when(keep, e["a"]).otherwise(e["b"]), F.when(keep, e["b"]).otherwise(e["a"])
    addresses = [F.substring(x, F.lit(1), e["size"]) for x in (low, high)]
    ports = [F.substring(x, e["size"] + 1, F.lit(4)) for x in (low, high)]
    return F.concat(F.lit(f"{use_seed or 0:04X}"), *addresses, F.lpad(F.hex(e["code"]), 2, "0"), F.lit("00"), *ports)


def _digest(text: Column) -> Column:
    return F.concat(F.lit("1:"), F.base64(F.unhex(F.sha1(F.unhex(text)))))


def community_id_hash(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column, proto: Column, seed: Column | None = None, use_seed: int | None = None) -> Column:
    """Community ID of a flow, as :func:`community_id`. ``seed`` is accepted and, as elsewhere,
    without effect; give ``use_seed`` for the specification's seeded form. For many rows
    :func:`with_community_id` is the faster form."""
    struct = lambda d: F.struct(*(c.alias(k) for k, c in d.items()))
    # each stage is bound to a name by a one-element array, so that nothing is computed twice
    flow = F.array(struct(_flow(src_ip, src_port, dst_ip, dst_port, proto)))
    ends = F.transform(flow, lambda f: struct(_ends({k: f[k] for k in ("src", "dst", "code", "sport", "dport")})))
    text = F.transform(ends, lambda e: _text({k: e[k] for k in ("a", "b", "code", "one_way", "size")}, use_seed))[0]
    return _digest(text)


def with_community_id(df: DataFrame, src_ip: str, src_port: str, dst_ip: str, dst_port: str, proto: Column, out: str = "community_id", use_seed: int | None = None) -> DataFrame:
    """Adds :func:`community_id_hash` as column ``out``, by stages of plain columns: all of it is
    generated code. An existing column of that name is replaced."""
    kept = [c for c in df.columns if c != out]
    names = [f"_{k}" for k in ("src", "dst", "code", "sport", "dport")]
    given = dict(zip(("_a", "_p", "_b", "_q", "_c"), (F.col(src_ip), F.col(src_port), F.col(dst_ip), F.col(dst_port), proto)))
    split = {f"{k}_parts": F.split(given[k], r"\.") for k in ("_a", "_b")}
    rows = df.select(F.struct("*").alias("_row"), *(c.alias(k) for k, c in (given | split).items()))
    rows = rows.select("_row", *(c.alias(f"_{k}") for k, c in _flow(*map(F.col, given), tuple(map(F.col, split))).items()))
    rows = rows.select("_row", *(c.alias(f"_{k}") for k, c in _ends({n[1:]: F.col(n) for n in names}).items()))
    rows = rows.select("_row", _text({k: F.col(f"_{k}") for k in ("a", "b", "code", "one_way", "size")}, use_seed).alias("_text"))
    return rows.select(*(F.col(f"_row.`{c}`") for c in kept), _digest(F.col("_text")).alias(out))


def compare_with_baseline(flows: DataFrame) -> DataFrame:
    """Baseline rows (saddr, sport, daddr, dport, proto, communityid) with the computed id and
    ``comparison``: MATCH or MISMATCH, the latter also where either id is null."""
    rows = with_community_id(flows, "saddr", "sport", "daddr", "dport", F.col("proto"), "computed_id")
    return rows.withColumn("comparison", F.when(F.col("communityid") == F.col("computed_id"), "MATCH").otherwise("MISMATCH"))
