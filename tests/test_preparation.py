"""The general data-preparation operators against brute force and on hard inputs."""

import hashlib
import itertools
import json
import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palisade.operators import loglines, schema_drift
from palisade.operators.delivery import DeliveryStore, message_id
from palisade.operators.kslack import HOUR_US, KSlack
from palisade.operators.sessions import GAP_US, SessionTable, clean_key
from palisade.operators.skew import attach
from palisade.operators.timestamps import TimeDictionary, parse_time, with_sensor_zone
from palisade.storage import SnapshotTable, SortedRuns, _ls, materialize, shared_dir, workspace

# -- storage ------------------------------------------------------------------------------------


def test_snapshot_table(spark):
    t = SnapshotTable(spark, workspace(spark, "t"), "k string, v int")
    assert t.read().count() == 0 and t.partitions == []
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    t.write(df, part=F.col("k"), meta={"w": 1})
    old = t.read()
    t.write(df.where("k = 'b'").limit(1), part=F.col("k"), replace=["b"])
    assert sorted(r.k for r in t.read().collect()) == ["a", "b"] and t.meta == {"w": 1}
    assert old.count() == 3  # readers of the snapshot before are not disturbed
    assert t.read(["a"]).count() == 1 and t.read(["none"]).count() == 0
    t.write(df.where("false"), part=F.col("k"), replace=["a", "b"])
    assert t.read().count() == 0


def test_replaced_folders_are_removed(spark):
    path = workspace(spark, "t")
    t = SnapshotTable(spark, path, "v int")
    for _ in range(5):
        t.write(spark.range(3).select(F.col("id").alias("v")), part=F.lit("a"), replace=["a"])
    assert t.read().count() == 3 and len(_ls(spark, f"{path}/manifest")) == 2
    assert sum(bool(_ls(spark, d)) for d in _ls(spark, f"{path}/data")) == 2  # the current version and the one before


def test_sorted_runs_read_what_a_lookup_needs(spark):
    runs = SortedRuns(spark, workspace(spark, "r"), "k bigint, v string", "k", rows_per_file=100)
    key = F.xxhash64("id")
    look = lambda lo, hi: runs.files_of(spark.createDataFrame([(lo, hi)], "low bigint, high bigint"))
    assert look(0, 1) == [] and runs.read().count() == 0
    for i in range(6):  # later batches are smaller: runs stay apart or merge, nothing is lost
        runs.add(materialize(spark.range(i * 3000, i * 3000 + 3000 // (i + 1)).select(key.alias("k"), F.col("id").cast("string").alias("v")), workspace(spark, "b")))
    total = sum(3000 // (i + 1) for i in range(6))
    assert runs.read().count() == total and len(runs._state()[1]["runs"]) < 6 and len(runs.files) > 50
    for i in (0, 5, 3001, 15_010):
        k = spark.range(i, i + 1).select(key).first()[0]
        files = look(k, k)
        assert len(files) <= 5 and runs._read(files).where(F.col("k") == k).count() == 1
    assert len(look(-(1 << 63), (1 << 63) - 1)) == len(runs.files)
    runs.add(spark.createDataFrame([], "k bigint, v string"))
    assert runs.read().count() == total


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_attach_hot_and_cold_keys(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    side = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("m"))
    out = attach(rows, side, ["k"], "n", 3000, F.col("id"))
    assert out.count() == 3000 and out.where("k = 'hot' and m = 0").count() == 2000 and set(out.columns) == {"k", "id", "m"}


# -- 1 schema drift -----------------------------------------------------------------------------


def messages(spark, files):
    rows = [(f, json.dumps(m) if isinstance(m, dict) else m, "clash") for f, ms in files.items() for m in ms]
    return spark.createDataFrame(rows, "source_file string, message string, path string")


def changes(spark, files):
    found = schema_drift.message_changes(schema_drift.file_schemas(messages(spark, files)))
    return {(r.source_file, r.field, r.change, r.new_field) for r in found.collect()}


def test_layout_changes(spark):
    who = lambda i: f"hunter_{i:02d}"
    files = {
        "f/c/1": [{"id": str(i), "reporter": who(i % 4), "geo": {"country": "DE"}, "note": None} for i in range(8)],
        "f/c/2": [{"id": str(i), "submitted_by": who(i % 4), "geo": {"country": "FR"}, "tags": ["a"], "note": None} for i in range(8)] + ['{"cut', None, "", "[1]"],
        "f/c/3": [{"id": None, "submitted_by": who(i % 4), "country": "DE" if i % 2 else "FR", "tags": ["a"]} for i in range(8)],
        "f/c/4": [{"id": i, "submitted_by": who(i % 4), "country": "FR", "tags": "a", "score": 5} for i in range(8)],
        "f/d/9": [{"other": 1}],
        "f/c/5": [None, "{broken"],
        "f/c/6": [{"id": 1, "submitted_by": "hunter_01", "country": "FR", "tags": "a", "is_c2": True}],
    }
    assert changes(spark, files) == {
        ("f/c/2", "reporter", "renamed", "submitted_by"), ("f/c/2", "tags", "added", ""),
        ("f/c/3", "geo.country", "renamed", "country"), ("f/c/3", "note", "removed", ""),
        ("f/c/4", "id", "retyped", ""), ("f/c/4", "tags", "retyped", ""), ("f/c/4", "score", "added", ""),
        ("f/c/6", "score", "removed", ""), ("f/c/6", "is_c2", "added", ""),
    }


@pytest.mark.parametrize("parts", [1, 5])
def test_rename_of_a_text_field_with_many_words(spark, parts):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(700)]
    text = lambda words: " ".join(rng.choices(words, k=12))
    files = {f"s/{i}": [{key: text(vocabulary), "id": "x"} for _ in range(400)] for i, key in enumerate(["note", "remark"])}
    files["s/2"] = [{"comment": text([w + "x" for w in vocabulary]), "id": "x"} for _ in range(400)]  # other words
    df = messages(spark, files).repartition(parts)
    found = schema_drift.message_changes(schema_drift.file_schemas(df))
    assert {tuple(r) for r in found.drop("src").collect()} == {("s/1", "note", "renamed", "remark"), ("s/2", "remark", "removed", ""), ("s/2", "comment", "added", "")}


def test_drift_of_nothing_and_unified_table(spark):
    assert changes(spark, {}) == set()
    files = {"s/1": [{"a": {"b": "x y"}, "n": 1}], "s/2": [{"b": "x z", "n": 2}, "broken"]}
    df = messages(spark, files)
    schemas = schema_drift.file_schemas(df)
    found = schema_drift.message_changes(schemas)
    wide = schema_drift.Projection.compile(schemas, found).apply(df)
    values = [r.record.asDict() if r.record else None for r in wide.collect()]
    assert None in values and {tuple(sorted(map(str, v.values()))) for v in values if v} == {("1", "x y"), ("2", "x z")}


def test_unified_table_keeps_every_value(spark):
    who = lambda i: f"hunter_{i % 4}"
    files = {
        "s/1": [{"reporter": who(i), "n": i} for i in range(8)],
        "s/2": [{"owner": who(i), "n": i} for i in range(8)],
        # both linked paths in one message, each another field; odd keys
        "t/1": [{"reporter": "first one", "owner": "second one", "it's": "q'", "x.y": "dotted", "x": {"z": "nested"}, 'a"?[b': "odd", "a.b": {"c'": "deep"}, "x_y": "plain", "big": 9007199254740993, "huge": 12345678901234567890123, "part": 0.25}],
        "u/1": [{"owner": who(i)} for i in range(8)],
    }
    df = messages(spark, files)
    schemas = schema_drift.file_schemas(df)
    found = schema_drift.message_changes(schemas)
    wide = schema_drift.Projection.compile(schemas, found).apply(df)
    got = {}
    for r in wide.select("source_file", "message", "record").collect():
        values = {k: v for k, v in r.record.asDict().items() if v is not None}
        want = [v for _, v in schema_drift.leaves(json.loads(r.message))]
        assert sorted(map(str, values.values())) == sorted(map(str, want))
        got.setdefault(r.source_file, set()).update(values)
    assert got["s/1"] == got["s/2"] and len(got["s/1"]) == 2


def test_columns_after_renames():
    rows = [("1", "a", "added", ""), ("1", "c", "added", ""), ("2", "a", "renamed", "b"), ("3", "a", "added", ""), ("4", "b", "removed", ""), ("5", "b", "added", "")]
    out = schema_drift._maps_of_stream({"a": "a", "b": "a", "c": "c"})(pd.DataFrame(rows, columns=["source_file", "field", "change", "new_field"]))
    assert dict(zip(out.source_file, out.layout)) == {
        "1": {"a": "a", "c": "c"}, "2": {"b": "a", "c": "c"}, "3": {"a": "a#2", "b": "a", "c": "c"},
        "4": {"a": "a#2", "c": "c"}, "5": {"a": "a#2", "b": "a", "c": "c"},
    }


def test_tree_edit_script_moves_and_assignment():
    hexes = lambda n: {"kinds": {f"hex{n}": 9}, "words": {}}
    script = schema_drift.tree_edit_script({"md5_hash": hexes(32), "imphash": hexes(32)}, {"md5": hexes(32)})
    assert sorted(script) == [("delete", "imphash", ""), ("rename", "md5_hash", "md5")]
    word = {"kinds": {"word": 9}, "words": {"listed": 5, "clean": 4}}
    assert schema_drift.tree_edit_script({"lists.surbl": word}, {"surbl": word}) == [("move", "lists.surbl", "surbl")]
    assert schema_drift.tree_edit_script({}, {}) == []


def test_tree_distance():
    leaf = lambda a, b: 0.0 if a.rpartition(".")[2] == b.rpartition(".")[2] else 5.0
    distance = lambda a, b: schema_drift.tree_distance(schema_drift.Tree(a), schema_drift.Tree(b), leaf)
    assert distance(["geo.city", "geo.zip"], ["place.city", "place.zip"]) == (0.2, {"": "", "geo": "place"})  # one relabelled node
    assert distance(["geo.city", "a.x"], ["geo.zip", "a.x"])[0] == 2.0  # delete and add
    cost, same = distance(["geo.city", "geo.zip"], ["at.geo.city", "at.geo.zip"])  # a node put in above
    assert 0 < cost < 1 and same["geo"] == "at.geo"
    assert distance([], ["a.b", "a.c"]) == (2.0, {"": ""}) and distance([], [])[0] == 0.0
    # an object that moves as a whole is a rename of its node, not of leaves that happen to look alike
    word = {"kinds": {"word": 9}, "words": {"x": 5}}
    script = schema_drift.tree_edit_script({"geo.city": word, "geo.zip": word}, {"place.city": word, "place.zip": word})
    assert sorted(script) == [("rename", "geo.city", "place.city"), ("rename", "geo.zip", "place.zip")]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5).flatmap(lambda n: st.lists(st.lists(st.integers(0, 9), min_size=n, max_size=n), min_size=n, max_size=n)))
def test_assignment_is_cheapest(cost):
    got = schema_drift._assign(np.array(cost, dtype=float))
    assert sorted(got) == list(range(len(cost)))
    assert sum(cost[i][j] for i, j in enumerate(got)) == min(sum(cost[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(len(cost))))


def test_property_changes(spark):
    """Properties of files are nodes of their trees; one may be called like a key of the messages."""
    df = spark.createDataFrame([("s/1", "a"), ("s/1", "a"), ("s/1", None), ("s/2", "b"), ("s/3", None), ("s/4", "b"), (None, "c")], "f string, label string")
    labels = schema_drift.property_nodes(df, "f", F.col("label"), "dataset", "label")
    got = schema_drift.message_changes(None, labels, "x").collect()
    assert [tuple(r) for r in got] == [("x", "s/2", "dataset", "renamed", "b")]
    schemas = schema_drift.file_schemas(messages(spark, {"s/1": [{"dataset": "q"}], "s/2": [{"dataset": 1}]}))
    got = schema_drift.message_changes(schemas, labels).collect()
    assert {tuple(r)[1:] for r in got} == {("s/2", "dataset", "renamed", "b"), ("s/2", "dataset", "retyped", "")}


# -- 2 sessions ---------------------------------------------------------------------------------


def sessions_by_force(events, gap):
    out, last = {}, {}
    for host, t in sorted(events):
        if host in last and t - last[host][1] <= gap:
            last[host][1], last[host][2] = t, last[host][2] + 1
        else:
            last[host] = [t, t, 1]
            out.setdefault(host, []).append(last[host])
    return {(h, *s) for h, ss in out.items() for s in map(tuple, ss)}


@pytest.mark.parametrize("seed", range(3))
def test_sessions_in_any_batches(spark, seed):
    rng = random.Random(seed)
    hosts = ["hot"] * 5 + ["a", "b"]
    events = [(rng.choice(hosts), rng.randrange(0, 40) * GAP_US // 2 + rng.choice((0, 0, 1, -1))) for _ in range(120)]
    table = SessionTable(spark, workspace(spark, "s"))
    shuffled = rng.sample(events, len(events))
    for part in (shuffled[:50], [], shuffled[50:90], shuffled[90:]):
        table.merge(spark.createDataFrame(part, "host string, ts_us bigint"))
    assert {tuple(r) for r in table.sessions().collect()} == sessions_by_force(events, GAP_US)


def test_repeated_micro_batch_counts_once(spark):
    table = SessionTable(spark, workspace(spark, "s"))
    df = spark.createDataFrame([("h", 0), ("h", 5)], "host string, ts_us bigint")
    for epoch in (0, 0, 1, 0):
        table.merge(df, epoch)
    assert [r.n_events for r in table.sessions().collect()] == [4]


def test_a_late_event_replaces_few_partitions(spark):
    day = 86_400 * 1_000_000
    table = SessionTable(spark, workspace(spark, "s"))
    table.merge(spark.range(365 * 6).select(F.concat(F.lit("h"), F.col("id") % 6).alias("host"), (F.floor(F.col("id") / 6) * day + 5 * GAP_US).alias("ts_us")))
    before = table.table._state()[1]["parts"]
    table.merge(spark.createDataFrame([("h3", 9 * day + 4 * GAP_US), ("h3", 200 * day + 40 * GAP_US)], "host string, ts_us bigint"))
    after = table.table._state()[1]["parts"]
    assert len(before) > 600 and sum(before[k] != after.get(k) for k in before) <= 2
    assert sum(bool(set(d) - set(after.get(k, []))) for k, d in before.items()) == 1  # replaced: the session it extends
    got = {tuple(r) for r in table.sessions().where("host = 'h3'").collect()}
    assert len(got) == 366 and ("h3", 9 * day + 4 * GAP_US, 9 * day + 5 * GAP_US, 2) in got and table.sessions().count() == 365 * 6 + 1


def test_session_edges(spark):
    table = SessionTable(spark, workspace(spark, "s"))
    rows = [("h", 0), ("h", GAP_US), ("h", 2 * GAP_US + 1), (None, 5), ("n", None), ("h", 0)]
    table.merge(spark.createDataFrame(rows, "host string, ts_us bigint"))
    assert {tuple(r) for r in table.sessions().collect()} == {("h", 0, GAP_US, 3), ("h", 2 * GAP_US + 1, 2 * GAP_US + 1, 1)}
    cleaned = spark.createDataFrame([(" A.Example\t",), (" ",), (None,)], "h string").select(clean_key(F.col("h")).alias("h")).collect()
    assert [r.h for r in cleaned] == ["a.example", None, None]


# -- 4 timestamps -------------------------------------------------------------------------------


def us(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


@pytest.mark.parametrize(
    "text,zone,order,want",
    [
        ("28/Feb/2025:04:32:21 -0500", None, None, "2025-02-28T09:32:21"),
        ("29/Mai/2025:19:06:25 +0200", None, None, "2025-05-29T17:06:25"),
        ("03/04/2025 05:06:07", "UTC", "mdy", "2025-03-04T05:06:07"),
        ("03/04/2025 05:06:07", "UTC", "dmy", "2025-04-03T05:06:07"),
        ("13/05/2025 12:06:07 AM", "UTC", "dmy", "2025-05-13T00:06:07"),
        ("Jun 5, 2025 7:11:38 PM", "Asia/Tokyo", None, "2025-06-05T10:11:38"),
        ("Sun Oct  5 04:52:18 2025", "UTC", None, "2025-10-05T04:52:18"),
        ("Thu, 05 Jun 2025 18:57:42 +0100", None, None, "2025-06-05T17:57:42"),
        ("2025-03-29 10:06:40 EDT", "Asia/Tokyo", None, "2025-03-29T14:06:40"),
        ("20250516T231753Z", None, None, "2025-05-16T23:17:53"),
        ("2025-09-28T01:05Z", None, None, "2025-09-28T01:05:00"),
        ("1747437317", None, None, "2025-05-16T23:15:17"),
        ("2025-03-30 02:30:00", "Europe/Berlin", None, "2025-03-30T01:30:00"),
        ("Mar 30 2025", "UTC", None, None), ("2025-13-45T99:00:00Z", None, None, None), ("31/Feb/2025:10:00:00 +0000", None, None, None),
        ("0000-00-00 00:00:00", "UTC", None, None), ("2025-01-01 00:00:00", None, None, None), ("2025-01-01 00:00:00", "No/Zone", None, None),
        ("", "UTC", None, None), ("n/a", "UTC", None, None), (None, "UTC", None, None), ("9" * 100_000, "UTC", None, None), ("12345", "UTC", None, None),
    ],
)
def test_parse_time(text, zone, order, want):
    got = parse_time(text, zone, order)
    assert (got and got[0]) == (want and us(want))


def test_fractions_are_cut():
    assert parse_time("1747437317.1234569", None, None)[0] % 1_000_000 == 123456
    assert parse_time("1757033574457163999", None, None)[0] % 1_000_000 == 457163
    assert parse_time("2025-05-17 00:10:14,865", "UTC", None)[0] % 1_000_000 == 865000


@settings(max_examples=60, deadline=None)
@given(st.datetimes(datetime(2000, 1, 1), datetime(2035, 1, 1)), st.integers(-14 * 60, 14 * 60))
def test_offset_round_trip(moment, minutes):
    local = moment.replace(tzinfo=timezone(timedelta(minutes=minutes)))
    text = local.strftime("%Y-%m-%dT%H:%M:%S.") + f"{local.microsecond:06d}" + local.strftime("%z")[:5]
    want = (local - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    assert parse_time(text, None, None) == (want, want)


def test_dictionary_grows_and_resolves_repeated_hours(spark):
    times = TimeDictionary(spark, workspace(spark, "t"))
    twice = "2025-10-26 02:30:00"
    early, late = us("2025-10-26T00:30:00"), us("2025-10-26T01:30:00")
    rows = [(1, twice, late), (2, twice, late - 1), (3, twice, 0), (4, None, 0), (5, "unknown", 0), (6, twice, None), (1, twice, late)]
    df = spark.createDataFrame(rows, "zone int, text string, epoch_us bigint")
    run = lambda d: times.normalize(d, F.col("text"), F.lit("Europe/Berlin"), F.lit(None).cast("string"), F.col("epoch_us"), "us")
    got = sorted((r.zone, r.us) for r in run(df).select("zone", "us").collect() if r.us is not None)
    assert got == [(1, late), (1, late), (2, early), (3, early), (6, early)] and run(df).count() == 7
    known = times.table.read().count()
    run(df)
    assert times.table.read().count() == known == 1
    assert run(df.where("false")).count() == 0


def test_sensor_zone_join(spark):
    sensors = spark.createDataFrame([("s", "UTC", "dmy"), ("s", "UTC", "dmy")], "sensor string, zone_name string, date_order string")
    rows = spark.createDataFrame([("s",), ("x",), (None,)], "sensor string")
    for limit in (10, 0):
        assert [r.zone_name for r in with_sensor_zone(rows, sensors, limit).orderBy(F.desc("zone_name")).collect()] == ["UTC", None, None]


# -- 5 delivery ---------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_one_copy_stays(spark, seed):
    rng = random.Random(seed)
    texts = [None, "", "x" * 100_000, *(f"m{i}" for i in range(20))] + ["hot"] * 10
    rows = [(i, rng.choice(texts), rng.randrange(5) * 86_400_000_000 + rng.choice((0, 5)), b) for i, b in enumerate(sorted(rng.randrange(4) for _ in range(150)))]
    store = DeliveryStore(spark, workspace(spark, "d"), bits_per_id=rng.choice((1, 20)))
    dropped = set()
    for b in range(5):
        part = spark.createDataFrame([r[:3] for r in rows if r[3] == b], "row_id bigint, message string, at bigint")
        out = store.accept(part.select(message_id(F.col("message")).alias("id"), F.col("at").alias("at_us"), "row_id", F.lit(1).alias("bucket")))
        again = store.accept(part.select(message_id(F.col("message")).alias("id"), F.col("at").alias("at_us"), "row_id"))
        first = {r[0] for r in out.collect()}
        assert {r[0] for r in again.collect()} <= first  # a repeated batch drops nothing else
        dropped |= first
    best = {}
    for i, m, at, _ in rows:
        if m is not None:
            best[m] = min(best.get(m, (at, i)), (at, i))
    assert dropped == {i for i, m, at, _ in rows if m is not None and best[m] != (at, i)}


def test_filters_grow_with_their_buckets(spark):
    """A bucket with ten times the identifiers screens as well; no filter is filled by what comes later."""
    store = DeliveryStore(spark, workspace(spark, "d"))
    day = 86_400 * 1_000_000
    rows = lambda a, b: spark.range(a, b).select(message_id(F.col("id").cast("string")).alias("id"), (F.col("id") % 11 * F.when(F.col("id") % 11 < 10, 0).otherwise(day)).alias("at_us"), F.col("id").alias("row_id"))
    for a, b in ((0, 2000), (2000, 60_000), (60_000, 62_000)):
        store.accept(rows(a, b))
    assert store.blooms.read().agg(F.max("blocks")).first()[0] >= 32
    fresh = rows(100_000, 110_000)
    assert store._screen(fresh).select("id").distinct().count() < 0.02 * 10_000
    assert store._screen(rows(1000, 3000)).select("id").distinct().count() == 2000


def test_delivery_of_nothing_and_null_times(spark):
    store = DeliveryStore(spark, workspace(spark, "d"))
    df = lambda *rows: spark.createDataFrame(list(rows), "id binary, at_us bigint, row_id bigint")
    assert store.accept(df()).count() == 0
    k = bytearray(hashlib.sha256(b"x").digest())
    assert [r[0] for r in store.accept(df((k, None, 1), (k, 7, 2), (None, 1, 3))).collect()] == [1]
    assert [r[0] for r in store.accept(df((k, 3, 4))).collect()] == [2]  # an earlier copy takes over


# -- 6 log lines --------------------------------------------------------------------------------

LOG = """2025-07-07 23:37:59,162 INFO  [pool-2-thread-2] o.x.pool.Manager - upstream timed out
java.lang.IllegalStateException: closed
\tat o.x.pool.Manager.step0(Unit.java:82)
level=info component=scheduler ts=2025-07-07T18:08:01.642Z msg="disk usage at 880%: rotating"
10.72.0.2 - - [07/Jul/2025:23:38:35 +0530] "GET /administrator HTTP/1.1" 302 16405 "-" "Scanner/0.9"
10.72.0.2 - u2 [2025-07-07 23:44:16,040] "GET /s?q=a HTTP/2.0" 404 4659 "" "Bot/2.1"
{"time": "07/Jul/2025:23:41:01 +0530", "remote_addr": "10.71.0.19", "request": "GET /cgi HTTP/1.1", "status": 404}
{"ts": "2025-07-07T22:23:37.167Z", "lvl": "error", "module": "mailer", "msg": "slow"}
<102>1 2025-07-07T18:19:50.494Z web-1 ledger 3043 ID73 - retrying in 331 ms
<148>Apr 14 16:34:24 web-8 haproxy[2474]: certificate expires
<81>Apr 30 17:26:12 web-1 kernel: child process
[Sat Sep 13 07:30:56.282980 2025] [proxy_http:notice] [pid 7583:tid 53081] AH07583: rule matched
    backend: 10.9.0.236
2025/09/13 07:31:44 [warn] 7555#2: *22665 disk usage, client: 10.9.1.131, request: "GET /p7555 HTTP/1.1"
2025-09-13 07:31:59,563 - ingest.worker - ERROR - rule 809 matched (see INFO above)
Traceback (most recent call last):
ValueError: bad field 'ts'
2025-09-13T05:34:28.924Z TRACE dispatcher: user failed login; dump follows
  2025-01-06 15:39:08 queued item 7848
key_0 = 7221
{
  "ts": "2025-07-07T18:25:00.841Z",
  "level": "crit",
  "logger": "mailer",
  "ctx": {
    "level": "none"
  }
}
2025-04-22 16:17:59 198.18.0.9 GET /search q=a+b 443 - 10.71.0.4 Mobile/17.2 200 0 0 4
www1.corp.example:443 10.71.0.1 - - [01/Jul/2025:00:49:08 +0100] "POST /adm HTTP/1.1" 404 1869 "-" "Scanner/0.9\""""
WANT = [
    (1, 3, "INFO", "o.x.pool.Manager", "", ""), (4, 4, "INFO", "scheduler", "", ""), (6, 6, "", "", "GET", "/s?q=a"), (7, 7, "", "", "GET", "/cgi"),
    (8, 8, "ERROR", "mailer", "", ""), (9, 9, "INFO", "ledger", "", ""), (10, 10, "WARNING", "haproxy", "", ""), (11, 11, "ALERT", "kernel", "", ""),
    (12, 13, "NOTICE", "proxy_http", "", ""), (14, 14, "WARN", "", "", ""), (15, 17, "ERROR", "ingest.worker", "", ""), (18, 20, "TRACE", "dispatcher", "", ""),
    (21, 28, "CRIT", "mailer", "", ""), (29, 29, "", "", "GET", "/search"), (30, 30, "", "", "POST", "/adm"),
]


def parse_log(spark, rows):
    df = spark.createDataFrame(rows, "log_file string, line_no bigint, value string, kind string, first_line int")
    tokens = materialize(loglines.tokenize_lines(df), workspace(spark, "tokens"))
    parsed = loglines.parse_lines(tokens, loglines.mine_templates(tokens))
    found = loglines.log_entries(df, parsed).where("not access").collect()
    return sorted((r.first_line, r.last_line, r.level, r.component, r.method, r.path) for r in found)


def test_log_layouts(spark):
    rows = [("f", i, line, "clash", 0) for i, line in enumerate(LOG.split("\n"), 1)]
    assert parse_log(spark, rows) == WANT
    assert parse_log(spark, rows + rows[:9]) == WANT  # repeated rows


def test_templates_never_hide_a_field(spark):
    """Requests, odd requests and odd times of one layout share a head form but keep their fields."""
    times = ["[07/Jul/2025:23:38:35 +0530]", "[2025-07-07 23:44:16,040]", "[n/a]", "[Fri Apr 11 01:58:14 2025]"]
    asks = ['"GET /a HTTP/1.1"', '"quit"', '"-"', '"POST /b?x=1 HTTP/2.0"']
    rows, want = [], []
    for i in range(160):
        user, tail = ("-", "u2")[i % 2], ('"" "Agent x"', '"-" "Agent \\"1\\" x"', "", '"-" "-" 0.415')[i % 4]
        ask = asks[i // 4 % 4]
        rows.append(("f", i, f"10.0.0.{i} - {user} {times[i // 16 % 4]} {ask} 200 {i} {tail}".strip(), None, None))
        words = ask.strip('"').split(" ")
        want.append((i, i, "", "", *(words[:2] if len(words) > 1 else ("", ""))))
    rows.append(("f", 500, rows[0][2].replace('""', '"-"'), None, None))  # matches the access pattern
    assert parse_log(spark, rows) == sorted(want)


def test_log_edges(spark):
    assert parse_log(spark, []) == []
    rows = [("f", 1, "stray", None, None), ("f", 2, None, None, None), ("f", 3, "<11>Apr 30 17:26:12 w kernel: a", None, None), ("f", 4, "", None, None), ("f", 5, None, None, None), ("f", 9, "x " * 60_000, None, None), (None, 1, "<11>Apr 30 17:26:12 w cron[1]: a", None, None)]
    assert parse_log(spark, rows)[:1] == [(3, 9, "ERR", "kernel", "", "")]


def test_entries_across_blocks(spark):
    rows = [("f", i, "entry" if i in (2, 3, 40) else "more") for i in range(100)]
    got = loglines.entries(spark.createDataFrame(rows, "log_file string, line_no bigint, kind string"), block=4).orderBy("line_no").collect()
    assert [r.first_line for r in got] == [None, None, 2, *[3] * 37, *[40] * 60]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abc*"), max_size=8), st.lists(st.sampled_from("abc*"), max_size=8))
def test_common_subsequence(a, b):
    pairs = loglines.common(a, b)
    assert loglines.common_length(a, b) == len(pairs)
    assert all(a[i] == b[j] != "*" for i, j in pairs) and pairs == sorted(pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


SYSLOG = [
    "<70>Jun 22 15:46:35 web-3 sshd[2559]: slow query: 569 ms [table=sessions]",
    "<86>Jun 22 15:46:36 web-3 auditd[17]: token rejected: issuer mismatch for client 280",
    "<70>Jun 22 15:47:35 web-1 sshd[60]: retrying in 786 ms: pool exhausted",
    "<2>Jun 22 15:47:36 web-1 kernel: disk usage at 436%: rotating",
    "<3>Jun 22 15:47:39 web-1 kernel: slow query: 12 ms [table=users]",
    "<4>Jun 22 15:48:36 web-1 cron[4]: user u1 failed login - bad password",
]


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_templates_do_not_depend_on_tasks_and_keep_each_field(spark, parts):
    """Merging lines of differing messages never moves the program to a word of the message."""
    rows = [("f", i, SYSLOG[i % len(SYSLOG)].replace("2559", str(i))) for i in range(60)]
    df = spark.createDataFrame(rows, "log_file string, line_no bigint, value string").repartition(parts, "line_no")
    tokens = materialize(loglines.tokenize_lines(df), workspace(spark, "tokens"))
    for chunk in (2, 1000):
        templates = loglines.mine_templates(tokens, chunk)
        got = {r.line_no: r.component for r in loglines.parse_lines(tokens, templates).collect()}
        assert got == {i: ("sshd", "auditd", "sshd", "kernel", "kernel", "cron")[i % 6] for i in range(60)}
    none = loglines.parse_lines(tokens, templates.limit(0)).collect()
    assert all(r.kind == "more" and not r.component for r in none)  # without templates nothing is parsed


def test_a_cluster_gives_a_field_that_one_line_does_not_show(spark):
    """VERBOSE is no level word; where all other lines of the template have their level, it is one."""
    lines = [f"[2025-07-07 10:00:{i:02d}] [core:{lv}] [pid {i}] started job {i}" for i, lv in enumerate(["info", "warn"] * 10)]
    rows = [("f", i, x) for i, x in enumerate([*lines, "[2025-07-07 10:01:00] [core:verbose] [pid 3] started job 9"])]
    rows += [("f", 100 + i, f"2025-07-07 10:00:{i:02d},1 {lv} {'' if i % 2 else '[w] '}a.b.C - job {i} ended") for i, lv in enumerate(["INFO", "WARN", "VERBOSE"] * 4)]
    df = spark.createDataFrame(rows, "log_file string, line_no bigint, value string")
    tokens = materialize(loglines.tokenize_lines(df), workspace(spark, "tokens"))
    got = {r.line_no: (r.kind, r.level, r.component) for r in loglines.parse_lines(tokens, loglines.mine_templates(tokens)).collect()}
    assert got[0] == ("entry", "INFO", "core") and got[20][0] == "entry"
    assert got[100] == ("entry", "INFO", "a.b.C")


def test_merges_keep_each_field_on_its_own_token():
    t = lambda line: loglines.Template([k for k, _ in loglines.tokenize(line)])
    lines = [*SYSLOG, SYSLOG[0].replace(" web-3", ""), SYSLOG[3].replace(" web-1", "")]
    own = {line: t(line) for line in lines}
    for a in lines:
        for b in lines:
            both = own[a].merged(own[b])
            for x in (a, b) if both else ():
                assert loglines.places(both, own[x].types) == own[x].roles
    assert own[lines[0]].merged(own[lines[-2]]) is None  # the program is one token further on


def test_long_sequences_are_paired_like_short_ones():
    """The pairs of a plain table of lengths, also beyond a million cells."""
    rng = random.Random(6)
    for n, m in ((0, 3), (5, 1), (40, 60), (1100, 1040)):
        a, b = ([rng.choice("abcdefgh*?") for _ in range(k)] for k in (n, m))
        a[:1], b[:1] = ["x"], ["y"]
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        equal = lambda i, j: a[i] == b[j] and a[i] not in "*?"
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                length[i][j] = length[i + 1][j + 1] + 1 if equal(i, j) else max(length[i + 1][j], length[i][j + 1])
        pairs = loglines.common(a, b)
        assert len(pairs) == length[0][0] == loglines.common_length(a, b)
        assert all(equal(i, j) for i, j in pairs) and all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))


@pytest.mark.parametrize("words", [10, 1100])
def test_fields_of_a_cluster_do_not_depend_on_the_length_of_its_lines(spark, words):
    body = " ".join("w" + "".join("abcdefghij"[int(c)] for c in str(i)) for i in range(words))
    line = lambda level, end: f"2025-07-07 10:00:00 [w] {level} a.b.C: {body} {end}"
    rows = [("f", i, line(*(("INFO", "done") if i else ("VERBOSE", "not done"))), None, None) for i in range(20)]
    assert parse_log(spark, rows) == [(i, i, "INFO" if i else "VERBOSE", "a.b.C", "", "") for i in range(20)]


def test_long_lines_cluster():
    a, b = [["<time>", *(f"{k}{i}" for i in range(6000))] for k in "ab"]
    assert loglines.Template(a).merged(loglines.Template(b)).n == 2


# -- 7 late events ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(2))
def test_kslack(spark, seed):
    rng = random.Random(seed)
    k, first = 3 * HOUR_US, HOUR_US // 6
    events = []
    for i in range(200):
        t = rng.randrange(10 * HOUR_US)
        events += [(f"u{i}", t, t + rng.choice((-5, 0, HOUR_US, 2 * HOUR_US, 5 * HOUR_US)) + rng.randrange(HOUR_US)) for _ in range(rng.choice((1, 1, 2)))]
    events.sort(key=lambda e: e[2])
    slack = KSlack(spark, workspace(spark, "k"), k, first)
    provisional = 0
    for part in (events[:100], [], events[100:180], events[180:]):
        slack.push(spark.createDataFrame([("s", *e, 0) for e in part], "src string, id string, event_us bigint, arrived_us bigint, hour_start int"))
        if part:
            slack.push(spark.createDataFrame([("s", *e, 0) for e in part], "src string, id string, event_us bigint, arrived_us bigint, hour_start int"))  # delivered again
        provisional += slack.provisional().count()
    assert provisional > 0
    slack.close()
    assert slack.provisional().count() == 0
    once = {}
    for i, t, at in events:
        once[i] = (t, min(at, once.get(i, (t, at))[1]))
    want = {}
    for t, at in once.values():
        h = t // HOUR_US * HOUR_US
        if at <= h + HOUR_US + k:
            w = want.setdefault(h, [0, []])
            w[0] += at <= h + HOUR_US + first
            w[1].append(t)
    want = {(h, n, len(ts), min(ts), max(ts), max([b - a for a, b in zip(sorted(ts), sorted(ts)[1:])], default=0)) for h, (n, ts) in want.items()}
    assert {tuple(r)[1:] for r in slack.finals().select("src", "hour_start", "n_first", "n_final", "first_us", "last_us", "max_gap_us").collect()} == want


def test_kslack_of_nothing(spark):
    slack = KSlack(spark, workspace(spark, "k"))
    slack.push(spark.createDataFrame([("s", None, 1, 1), ("s", "a", None, 1), ("s", "a", 1, None)], "src string, id string, event_us bigint, arrived_us bigint"))
    slack.close()
    assert slack.finals().count() == 0
