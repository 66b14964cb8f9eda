import random

import pytest
from pyspark.sql import functions as F

from palisade.functions import ocsf, protocols
from palisade.functions.community_id import community_id, community_id_hash, compare_with_baseline, with_community_id
from palisade.functions.register import register_all


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_protocol_tables_round_trip():
    assert len(protocols.PROTOCOLS) == 151 and len(protocols.CODES) == 144
    odd = {c for c, n in protocols.PROTOCOLS.items() if protocols.CODES.get(n.lower()) != c}
    assert odd == protocols.UNNAMED | {13, 53, 95, 122}


@pytest.mark.parametrize("name,code", [("TCP", 6), ("ipv6-icmp", 58), ("argus", 13), ("nonsense", None), (None, None), ("", None)])
def test_name_to_code(spark, name, code):
    assert one(spark, protocols.proto_name_to_code(F.lit(name).cast("string"))) == code


@pytest.mark.parametrize("code,name", [(6, "TCP"), (13, "ARGUS (deprecated)"), (148, "Unassigned"), (254, "Experimentation & testing"), (None, "Unassigned")])
def test_code_to_name(spark, code, name):
    assert one(spark, protocols.proto_code_to_name(F.lit(code).cast("int"))) == name


def test_activity_names(spark):
    rows = spark.range(-1, 17).select(F.col("id").cast("int").alias("i"))
    got = {r.i: (r.n, r.d, r.h, r.f) for r in rows.select(
        "i", ocsf.ocsf_network_activity_name(F.col("i")).alias("n"), ocsf.ocsf_dns_activity_name(F.col("i")).alias("d"),
        ocsf.ocsf_http_activity_name(F.col("i")).alias("h"), ocsf.ocsf_file_activity_name(F.col("i")).alias("f")).collect()}
    assert got[7] == ("Listen", "Other", "Put", "Set Security")
    assert got[2] == ("Close", "Response", "Delete", "Read")
    assert all(got[i] == ("Other",) * 4 for i in (-1, *range(10, 17)))
    assert one(spark, ocsf.ocsf_file_activity_name(F.lit(None).cast("int"))) == "Other"


@pytest.mark.parametrize("verb,i", [("GET", 3), ("patch", 9), ("", 0), (None, 99), ("BREW", 99)])
def test_http_id(spark, verb, i):
    assert one(spark, ocsf.ocsf_http_activity_id(F.lit(verb).cast("string"))) == i


FLOWS = [
    ("128.232.110.120", 34855, "66.35.250.204", 80, 6, "1:LQU9qZlK+B5F3KDmev6m5PMibrg="),
    ("192.168.1.52", 54585, "8.8.8.8", 53, 17, "1:d/FP5EW3wiY1vCndhwleRRKHowQ="),
    ("192.168.0.89", 8, "192.168.0.1", 0, 1, "1:X0snYXpgwiv9TZtqg64sgzUn6Dk="),
]


@pytest.mark.parametrize("a,p,b,q,proto,want", FLOWS)
def test_community_id_vectors(spark, a, p, b, q, proto, want):
    assert community_id(a, p, b, q, proto) == want
    df = spark.createDataFrame([(a, p, b, q, proto, 7)], "a string, p int, b string, q int, proto int, seed int")
    got = df.select(community_id_hash(*(F.col(c) for c in ("a", "p", "b", "q", "proto", "seed"))).alias("x")).first().x
    assert got == want  # the seed column has no effect


def test_community_id_symmetry_and_nulls(spark):
    rows = [
        ("10.0.0.1", 1, "10.0.0.2", 2, 6), ("10.0.0.2", 2, "10.0.0.1", 1, 6), ("fe80::1", 5, "fe80::2", 6, 17), ("fe80::2", 6, "fe80::1", 5, 17),
        ("10.0.0.1", None, "10.0.0.2", None, 47), (None, 1, "10.0.0.2", 2, 6), ("300.0.0.1", 1, "10.0.0.2", 2, 6), ("10.0.0.1", 1, "10.0.0.2", 70000, 6), ("10.0.0.1", 1, "10.0.0.2", 2, None),
    ]
    df = spark.createDataFrame(rows, "a string, p int, b string, q int, proto int")
    got = [r.x for r in df.select(community_id_hash(*(F.col(c) for c in ("a", "p", "b", "q", "proto"))).alias("x")).collect()]
    assert got == [community_id(*r) for r in rows]
    staged = with_community_id(df.withColumn("_src", F.lit(1)), "a", "p", "b", "q", F.col("proto"), "proto_id")
    assert [r.proto_id for r in staged.collect()] == got and staged.columns == [*df.columns, "_src", "proto_id"]
    assert got[0] == got[1] and got[2] == got[3] and got[4] and got[5:] == [None] * 4


def test_community_id_of_many_kinds(spark):
    rng = random.Random(1)
    ips = ["10.0.0.1", "10.0.0.2", "255.255.255.255", "::1", "::", "fe80::1:2", "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4", "2001:DB8::", "1::2::3", "1:2:3", "x", "", "1.2.3", "1:2:3:4:5:6:7::8", ":1", "1.2.3.4::"]
    rows = [(rng.choice(ips), rng.choice((0, 1, 8, 128, 135, 65535)), rng.choice(ips), rng.choice((0, 1, 443)), rng.choice((1, 6, 17, 47, 58, 132))) for _ in range(600)]
    rows += [(a, 1, b, 2, 6) for a in ips for b in ips]
    df = spark.createDataFrame(rows, "a string, p int, b string, q int, proto int")
    got = [r.x for r in df.select(community_id_hash(*(F.col(c) for c in ("a", "p", "b", "q", "proto"))).alias("x")).collect()]
    wrong = [(r, g, community_id(*r)) for r, g in zip(rows, got) if g != community_id(*r) and "1:2:3:4:5:6:7::8" not in r]
    assert not wrong


def test_seeded_form(spark):
    df = spark.createDataFrame([("10.0.0.1", 1, "10.0.0.2", 2, 6)], "a string, p int, b string, q int, proto int")
    got = df.select(community_id_hash(*(F.col(c) for c in ("a", "p", "b", "q", "proto")), use_seed=1).alias("x")).first().x
    assert got == community_id("10.0.0.1", 1, "10.0.0.2", 2, 6, 1) != community_id("10.0.0.1", 1, "10.0.0.2", 2, 6)


def test_sql_functions(spark):
    assert "community_id_hash" in register_all(spark)
    row = spark.sql(
        "SELECT proto_name_to_code('UDP') a, proto_code_to_name(NULL) b, ocsf_http_activity_id('') c, ocsf_file_activity_name(12) d, "
        "ocsf_dns_activity_name(6) e, community_id_hash('128.232.110.120', 34855, '66.35.250.204', 80, 6, 0) f"
    ).first()
    assert tuple(row) == (17, "Unassigned", 0, "Other", "Traffic", FLOWS[0][5])


def test_baseline_comparison(spark):
    rows = [(a, p, b, q, proto, want) for a, p, b, q, proto, want in FLOWS] + [("10.0.0.1", 1, "10.0.0.2", 2, 6, "1:other"), (None, 1, "10.0.0.2", 2, 6, None)]
    df = spark.createDataFrame(rows, "saddr string, sport int, daddr string, dport int, proto int, communityid string")
    assert [r.comparison for r in compare_with_baseline(df).collect()] == ["MATCH"] * 3 + ["MISMATCH"] * 2
