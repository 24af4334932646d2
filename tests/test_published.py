"""State log, replayed batches, and maintenance of dated tables."""

import datetime
import tempfile

from pyspark.sql import functions as F

from conftest import commands_df, orders_df
from haltgate.streaming import control as C
from haltgate.streaming.io import compact_dates, expire_dates, once, read_dated, write_batch, write_dated_batch

STATE = "scope string, status string, updated_ts bigint, updated_by string, reason string, last_cmd_id string, corr_id string"


def publish(spark, path, batch, scopes, status="KILLED"):
    rows = [(s, f'{{"scope":"{s}","status":"{status}","updated_ts":{batch},"last_cmd_id":"c{batch}"}}' if status else None) for s in scopes]
    write_batch(spark.createDataFrame(rows, "key string, value string"), path, batch, fmt="json")


def test_state_log_is_read_from_its_base(spark):
    path = f"{tempfile.mkdtemp(prefix='log-')}/state"
    assert C.snapshot_from_log(spark, path).collect() == []
    files = []
    for batch in range(40):
        publish(spark, path, batch, [f"ACCOUNT:{batch % 7}", "GLOBAL"])
        if batch == 20:
            publish(spark, path, 20, ["ACCOUNT:6"], None)  # a tombstone
        snap = C.snapshot_from_log(spark, path, deltas=4)
        files.append(len(snap.inputFiles()))
    got = {r.scope: r.updated_ts for r in snap.collect()}
    assert got == {"GLOBAL": 39, **{f"ACCOUNT:{k}": max(b for b in range(40) if b % 7 == k) for k in range(7)}}
    per_batch = max(files[:4])
    assert max(files[30:]) <= max(files[6:14]) + per_batch  # batch 40 reads no more than batch 10


def test_tombstone_below_the_base_stays_deleted(spark):
    path = f"{tempfile.mkdtemp(prefix='log-')}/state"
    publish(spark, path, 0, ["ACCOUNT:1", "ACCOUNT:2"])
    publish(spark, path, 1, ["ACCOUNT:1"], None)
    assert [r.scope for r in C.snapshot_from_log(spark, path, deltas=2).collect()] == ["ACCOUNT:2"]
    publish(spark, path, 2, ["ACCOUNT:3"])
    assert sorted(r.scope for r in C.snapshot_from_log(spark, path, deltas=2).collect()) == ["ACCOUNT:2", "ACCOUNT:3"]


def test_replayed_batch_is_published_once(spark):
    """A log that only appends gets a batch again; readers see each record once, and the
    decisions of the first run, though the state has changed since."""
    root = tempfile.mkdtemp(prefix="replay-")
    orders = orders_df(spark, [(f"o{k}", 10 + k, str(k % 2), "A", "BUY", 1, 1.0, "X") for k in range(6)] + [("same", 5, "1", "A", "BUY", 1, 1.0, "X")] * 2)
    sinks = {k: {"format": "json", "path": f"{root}/{k}-log", "append": "true"} for k in ("gated", "audit")}
    C.aggregate_batch(spark, commands_df(spark, [("1", 1, "ACCOUNT:1", "KILL", "r", "op", None, None, None)]), 0, f"{root}/state")
    C.route_batch(spark, orders, 0, f"{root}/state", f"{root}/out", sinks=sinks)
    C.aggregate_batch(spark, commands_df(spark, [("2", 2, "GLOBAL", "KILL", "r", "op", None, None, None)]), 1, f"{root}/state")
    C.route_batch(spark, orders, 0, f"{root}/state", f"{root}/out", sinks=sinks)  # the replay
    C.route_batch(spark, orders.limit(1), 1, f"{root}/state", f"{root}/out", sinks=sinks)
    log = spark.read.schema("key string, value string").json(f"{root}/audit-log")
    assert log.count() == 17
    read = once(log).select("key", F.get_json_object("value", "$.decision").alias("d")).collect()
    assert sorted((r.key, r.d) for r in read) == sorted([(f"o{k}", "DROP" if k % 2 else "ALLOW") for k in range(6)] + [("same", "DROP")] * 2 + [("o0", "DROP")])
    assert once(spark.read.schema("key string, value string").json(f"{root}/gated-log")).count() == 3
    # and as a stream
    got = once(spark.readStream.schema("key string, value string").json(f"{root}/audit-log"))
    (got.writeStream.format("parquet").option("path", f"{root}/read").option("checkpointLocation", f"{root}/ck").trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(f"{root}/read").count() == 9


def dated(spark, path, batch, rows):
    df = spark.createDataFrame([(k, datetime.date(2024, 1, d)) for k, d in rows], "id int, date date")
    write_dated_batch(df, path, batch)


def ids(spark, path):
    return sorted((r.id, r.batch_id) for r in read_dated(spark, path).collect())


def test_maintenance_of_a_dated_table(spark, monkeypatch):
    path = f"{tempfile.mkdtemp(prefix='index-')}/index"
    for batch in range(5):
        dated(spark, path, batch, [(100 * batch + d, d) for d in (1, 2, 3, 20)])
    rows = ids(spark, path)
    assert len(rows) == 20
    today = datetime.date(2024, 1, 20)
    assert compact_dates(spark, path, today) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert ids(spark, path) == rows
    assert len([f for f in read_dated(spark, path).inputFiles() if "date=2024-01-01" in f]) == 1
    dated(spark, path, 5, [(501, 1), (520, 20)])  # a late row on a compacted date, beside the maintenance
    rows = sorted(rows + [(501, 5), (520, 5)])
    assert ids(spark, path) == rows and compact_dates(spark, path, today) == [] and ids(spark, path) == rows
    assert expire_dates(spark, path, datetime.date(2024, 2, 2), 30) == ["2024-01-01", "2024-01-02"]
    assert ids(spark, path) == [r for r in rows if r[0] % 100 not in (1, 2)]


def test_compaction_that_stops_half_way(spark, monkeypatch):
    """Stopped after the new part is written: nothing is read twice, and the next run ends it."""
    from haltgate.streaming import io

    path = f"{tempfile.mkdtemp(prefix='index-')}/index"
    for batch in range(3):
        dated(spark, path, batch, [(10 * batch + 1, 1), (10 * batch + 2, 2)])
    rows, real = ids(spark, path), io._fs

    class Stuck:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            if name == "delete":
                raise OSError("stopped")
            return getattr(self.fs, name)

    monkeypatch.setattr(io, "_fs", lambda spark, p: (Stuck(real(spark, p)[0]), real(spark, p)[1]))
    try:
        compact_dates(spark, path, datetime.date(2024, 1, 9))
    except OSError:
        pass
    monkeypatch.setattr(io, "_fs", real)
    assert ids(spark, path) == rows
    compact_dates(spark, path, datetime.date(2024, 1, 9))
    assert ids(spark, path) == rows and len(read_dated(spark, path).inputFiles()) == 2


def test_lookups_push_their_key_to_the_scan(spark):
    from haltgate.plans.world import World

    w = World(spark, "/root/testdata/sf0.001")
    by_order, by_account = w.audit_of(order_id="42"), w.audit_of(account_id="7")
    for df, pushed in ((by_order, "EqualTo(event_id,42)"), (by_account, "EqualTo(user_id,7)")):
        assert pushed in df._jdf.queryExecution().executedPlan().toString()
    whole = w.audit()
    assert sorted(map(str, by_order.collect())) == sorted(map(str, whole.filter("order_id = '42'").collect()))
    assert sorted(map(str, by_account.collect())) == sorted(map(str, whole.filter("account_id = '7'").collect()))
    for odd in ("042", "4 2", "x", "", "9" * 30):
        assert w.audit_of(order_id=odd).collect() == []


def test_only_equal_records_are_dealt_out(spark, monkeypatch):
    """A record's name is its digest and its number among equal ones; a batch without equal records
    meets no window."""
    from pyspark.sql import Window
    from haltgate.streaming import io
    digest = F.sha2(F.to_json(F.struct("a", "b", "t")), 256)
    rows = spark.createDataFrame([(k % 4, None if k % 5 else "x", k % 3) for k in range(40)], "a int, b string, s int").select(
        "a", "b", F.timestamp_micros(F.col("s").cast("bigint")).alias("t"))  # times that JSON does not tell apart
    names = sorted(r[0] for r in io._numbered_again(rows, digest).select(io.RECORD_ROW).collect())
    by = Window.partitionBy("d").orderBy("d")
    exp = sorted(r[0] for r in rows.select(digest.alias("d")).select(F.concat_ws("-", "d", F.row_number().over(by))).collect())
    assert names == exp and len(set(names)) == 40
    plan = io._numbered_again(spark.range(50).select(F.col("id").alias("a"), F.lit("b").alias("b"), F.lit(1).alias("t")), digest)
    assert "Window" not in plan._jdf.queryExecution().executedPlan().toString()


def test_update_batch_takes_its_batch_once(spark):
    """Whoever asks for the batch again would aggregate the stream's input again."""
    from haltgate.params import RiskParams
    from haltgate.streaming.detector import update_batch
    taken = spark.sparkContext.accumulator(0)

    def seen(frames):
        for f in frames:
            taken.add(f.num_rows)
            yield f

    rows = spark.sql("SELECT named_struct('start', timestamp_seconds(0), 'end', timestamp_seconds(60)) AS window, cast(id % 3 AS string) AS account_id, "
                     "cast(id AS string) AS _inner, 5L AS n, 5L AS n_priced, cast(7 AS decimal(38,10)) AS amount FROM range(12)")
    root = tempfile.mkdtemp(prefix="update-")
    update_batch(spark, rows.mapInArrow(seen, rows.schema), 0, root, RiskParams(max_orders=3), False, 60_000)
    assert taken.value == 12
    assert spark.read.parquet(f"{root}/commands").count() == 3
