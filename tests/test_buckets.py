"""Stateful streams keep their keys in buckets: the state store is met once a bucket and
micro-batch, and a replayed table is worked out once."""

import random
import tempfile

import pandas as pd
from pyspark.sql import functions as F

from conftest import commands_df, orders_df
from haltgate.plans import catalog as C
from haltgate.streaming import stateful as SS
from haltgate.streaming.io import file_stream, state_store, without_empty_batches
from test_stateful import released

KEYS = SS.BUCKETS + 1500


def state_rows(spark, table, operator):
    """The rows that ``operator`` gives for a table in one batch, and how many rows of state that left."""
    run = tempfile.mkdtemp(prefix="buckets-")
    table.write.parquet(f"{run}/in")
    out = operator(file_stream(spark, f"{run}/in", table.schema))
    with state_store(spark), without_empty_batches(spark):
        q = out.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    return spark.read.parquet(f"{run}/out"), q.recentProgress[0]["stateOperators"][0]["numRowsTotal"]


class State:
    """A bucket's state, as Spark hands it to a processor."""

    hasTimedOut, value, now, watermark, wake = False, None, 0, 0, None

    def __init__(self):
        self.writes = 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def remove(self):
        self.value = None

    def getCurrentProcessingTimeMs(self):
        return self.now

    def getCurrentWatermarkMs(self):
        return self.watermark

    def setTimeoutDuration(self, ms):
        self.wake = self.now + ms

    def setTimeoutTimestamp(self, ms):
        assert ms >= self.watermark and ms > 0
        self.wake = ms


def call(processor, state, rows, columns):
    frames = [pd.DataFrame(rows, columns=columns).assign(bucket=0)]
    return [tuple(r) for f in processor((0,), iter(frames), state) for r in f.itertuples(index=False)]


def test_throttled_scopes_share_the_state_of_a_bucket(spark):
    orders = orders_df(spark, [(f"o{k:05d}-{n}", k % 7 * 1000, str(k), "A", "BUY", 1, 1.0, "X") for k in range(KEYS) for n in range(2)])
    commands = commands_df(spark, [(f"c{k}", 0, f"ACCOUNT:{k}", "THROTTLE", None, None, None, 1.0, None) for k in range(0, KEYS, 2)])
    got, rows = state_rows(spark, SS.throttle_input(orders, commands), SS.throttle_stream)
    assert rows <= SS.BUCKETS
    assert {(r.account_id, r.order_id[-1], r.decision) for r in got.collect()} == {
        (str(k), str(n), "THROTTLED" if k % 2 == 0 and n else "ALLOW") for k in range(KEYS) for n in range(2)}
    assert got.count() == 2 * KEYS


def test_a_bucket_of_scopes_is_written_once():
    state, columns = State(), ["scope", *SS._THROTTLE_IN]
    call(SS.ThrottleProcessor(), state, [(f"ACCOUNT:{k}", 0, 0, f"c{k}", None, None, "THROTTLE", k + 1.0) for k in range(3)], columns)
    for batch in range(2):  # the count of a second goes on in the next batch
        orders = [(f"ACCOUNT:{k}", 500, 1, f"o{k}{n}{batch}", str(k), "A", None, None) for k in range(3) for n in range(2)]
        got = call(SS.ThrottleProcessor(), state, orders, columns)
        passed = [sum(r[5] == "ALLOW" and r[2] == str(k) for r in got) for k in range(3)]
        assert passed == ([1, 2, 2], [0, 0, 1])[batch]
    assert state.writes == 3


def test_a_replayed_table_is_worked_out_once(spark):
    rnd, run = random.Random(5), tempfile.mkdtemp(prefix="replay-")
    looked_at = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(x):
        looked_at.add(1)
        return x

    rows = spark.createDataFrame([(f"o{k}", rnd.randrange(10_000)) for k in range(300)], "id string, at bigint").select("id", seen("at").alias("at"))
    batches = []

    def start(stream):
        def run_():
            with without_empty_batches(spark):
                return stream.writeStream.foreachBatch(lambda df, n: batches.append(df.count())).option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start()
        return [run_]

    C._replay(rows, F.col("at"), run, start)
    assert len(batches) == C.TURNS and sum(batches) == 300
    assert looked_at.value == 300


def test_remembered_ids_share_the_state_of_a_bucket(spark):
    orders = spark.createDataFrame([(f"o{k}-{n}", f"x{k}", 1000 * n, "1") for k in range(KEYS) for n in range(2)],
                                   "order_id string, cid string, ts bigint, account_id string")
    got, rows = state_rows(spark, orders, lambda o: SS.duplicate_stream(o, "cid"))
    assert rows <= SS.BUCKETS
    assert {(r.client_order_id, r.order_id, r.prev_seen_ts, r.decision) for r in got.collect()} == {
        (f"x{k}", f"o{k}-{n}", 0 if n else None, "DUPLICATE" if n else "NEW") for k in range(KEYS) for n in range(2)}
    assert got.count() == 2 * KEYS


def test_ids_of_a_bucket_expire_each_in_its_time():
    """An id is forgotten when the order that put it in memory was seen long ago; repeats do not renew it."""
    state, p, columns = State(), SS.DuplicateProcessor(50, 1000), ["client_order_id", "ts", "order_id", "account_id"]

    def decisions(now, *rows):
        state.now = now
        return {r[0]: (r[4], r[5]) for r in call(p, state, [(id_, ts, o, None) for id_, ts, o in rows], columns)}

    assert decisions(0, ("a", 100, "1"), ("a", 100, None)) == {None: (None, "NEW"), "1": (100, "DUPLICATE")}
    assert decisions(600, ("a", 120, "2"), ("b", 10, "3")) == {"2": (100, "DUPLICATE"), "3": (None, "NEW")}
    assert state.wake == 1600
    assert decisions(999, ("a", 90, "4")) == {"4": (100, "DUPLICATE")}
    assert decisions(1000, ("b", 30, "5"), ("a", 120, "6")) == {"5": (10, "DUPLICATE"), "6": (None, "NEW")}
    assert decisions(1500, ("b", 70, "7"), ("b", 20, "8")) == {"7": (None, "NEW"), "8": (10, "DUPLICATE")}
    assert state.wake == 2500
    state.hasTimedOut, state.now = True, 2500
    assert call(p, state, [], columns) == [] and not state.exists


def test_followed_scopes_share_the_state_of_a_bucket(spark):
    commands = commands_df(spark, [(f"c{k}", 10_000_000, f"ACCOUNT:{k}", "KILL", None, "spark", None, None, None) for k in range(KEYS)])
    _, rows = state_rows(spark, commands, lambda c: SS.release_stream(c, 1000, 1000, "1 hour"))
    assert rows <= SS.BUCKETS


def test_scopes_of_a_bucket_are_released_as_the_watermark_passes():
    """A bucket that is woken by rows or by its timeout alone, against a step-by-step version for each scope."""
    rnd, window, cooldown, p = random.Random(21), 10, 25, SS.CooldownProcessor(25, 10)
    kinds = [("KILL", "spark")] * 5 + [("KILL", "ops"), ("UNKILL", "ops"), ("UNKILL", None), ("HOLD", "ops"), ("UNHOLD", "ops"), ("PAUSE", "ops")]
    commands = [(f"c{k:03d}", rnd.randrange(100, 900), f"ACCOUNT:{rnd.randrange(20)}", *rnd.choice(kinds)) for k in range(400)]
    commands += commands[:15]  # some come twice
    state, got, columns = State(), [], ["scope", *SS._COOLDOWN_IN]
    for at in range(100, 1000, 7):
        now = [(scope, ts, id_, action, by) for id_, ts, scope, action, by in commands if at <= ts < at + 7]
        if now:
            state.wake = None
            got += call(p, state, now, columns)
        state.watermark = at  # of the batch after
        if state.wake is not None and state.wake < state.watermark:
            state.hasTimedOut, state.wake = True, None
            got += call(p, state, [], columns)
            state.hasTimedOut = False
    exp = []
    for scope in {c[2] for c in commands}:
        exp += released([(id_, ts, s, action, None, by) for id_, ts, s, action, by in commands if s == scope], cooldown, window, state.watermark - window)
    assert sorted(got) == sorted(exp) and len(exp) > 20
    assert state.wake is None or state.wake >= state.watermark
