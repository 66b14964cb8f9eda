import random

from palisade.operators.delivery import DeliveryStore
from palisade.operators.kslack import HOUR_US, KSlack
from palisade.operators.sessions import SessionTable
from palisade.storage import workspace
from palisade.streaming import incremental


def test_streams_equal_one_batch(spark, tmp_path):
    rng = random.Random(5)
    schema = "host string, ts_us bigint, src string, id string, event_us bigint, arrived_us bigint"
    rows = []
    for i in range(90):
        t = rng.randrange(6 * HOUR_US)
        rows.append((rng.choice("ab"), t, "s", f"e{i}", t, t + rng.randrange(2 * HOUR_US)))
    rows.sort(key=lambda r: r[5])
    inbox = str(tmp_path / "in")
    for k in range(3):
        spark.createDataFrame(rows[k * 30 : k * 30 + 30], schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    whole = spark.createDataFrame(rows, schema)
    live, once = (SessionTable(spark, workspace(spark, "s")) for _ in range(2))
    incremental.into_sessions(stream().select("host", "ts_us"), live, str(tmp_path / "c1"))
    once.merge(whole.select("host", "ts_us"))
    assert sorted(map(tuple, live.sessions().collect())) == sorted(map(tuple, once.sessions().collect()))
    fast, slow = (KSlack(spark, workspace(spark, "k")) for _ in range(2))
    incremental.into_kslack(stream().select("src", "id", "event_us", "arrived_us"), fast, str(tmp_path / "c2"))
    slow.push(whole.select("src", "id", "event_us", "arrived_us"))
    for s in (fast, slow):
        s.close()
    assert sorted(map(tuple, fast.finals().collect())) == sorted(map(tuple, slow.finals().collect()))


def test_stream_of_repeats(spark, tmp_path):
    inbox, schema = str(tmp_path / "in"), "id binary, at_us bigint, row_id bigint"
    for part in ([(b"a", 5, 1), (b"b", 5, 2)], [(b"a", 6, 3), (b"b", 4, 4)]):
        spark.createDataFrame([(bytearray(k), t, i) for k, t, i in part], schema).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(schema).parquet(inbox)
    store = DeliveryStore(spark, workspace(spark, "d"))
    incremental.drop_repeats(stream, store, str(tmp_path / "out"), str(tmp_path / "c"))
    assert {r.row_id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2, 3}
