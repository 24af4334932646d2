"""Stateful streams against their batch twins and plain versions, over several turns:
every turn starts the query again from its checkpoint."""

import os
import random
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import CMD_COLS, ORDER_COLS, ROOT, commands_df, orders_df
from haltgate.operators import extensions as X
from haltgate.operators.gate import gate_asof
from haltgate.operators.state import state_records
from haltgate.params import RiskParams
from haltgate.streaming import stateful as SS
from haltgate.streaming.detector import multi_window_stream
from haltgate.streaming.io import feed, file_stream, period_cuts, without_empty_batches

DAY = 86_400_000


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """A state operator has a task and a worker for each partition."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


def write(spark, out, run, empty):
    w = out.writeStream.format("parquet").option("path", f"{run}/out").option("checkpointLocation", f"{run}/ck").trigger(availableNow=True)
    if empty:
        q = w.start()
    else:
        with without_empty_batches(spark):
            q = w.start()
    if not q.awaitTermination(120):
        q.stop()
        raise AssertionError("the query does not end")


def replay(spark, table, ts, operator, turns=2, empty=True):
    """All rows that ``operator`` (stream -> stream) gives while the table comes in turns."""
    run = tempfile.mkdtemp(prefix="stateful-")

    def turn():
        out = operator(file_stream(spark, f"{run}/in", table.schema))
        write(spark, out, run, empty)

    feed(table, F.col(ts), period_cuts(table, F.col(ts), turns), f"{run}/in", turn)
    return spark.read.parquet(f"{run}/out")


def rows_of(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_duplicates_are_remembered_over_turns(spark):
    rnd = random.Random(3)
    rows = [(f"o{k:04d}", rnd.choice([f"c{rnd.randrange(40)}", None]), rnd.choice([rnd.randrange(10 * 3_600_000), None]) if k % 50 == 0
             else rnd.randrange(10 * 3_600_000), "1") for k in range(800)]
    orders = spark.createDataFrame(rows, "order_id string, cid string, ts bigint, account_id string")
    columns = ["order_id", "client_order_id", "ts", "account_id", "prev_seen_ts", "decision"]
    got = replay(spark, orders, "ts", lambda o: SS.duplicate_stream(o, "cid"), empty=False)
    assert rows_of(got, columns) == rows_of(X.duplicate_decisions(orders, "cid"), columns)


def test_late_order_of_a_remembered_id_is_a_duplicate(spark):
    run = tempfile.mkdtemp(prefix="late-")
    got = []
    for k, ts in enumerate((5_000_000, 4_990_000, 1_000_000)):  # each turn's order is older than the one before
        spark.createDataFrame([(f"o{k}", "x", ts, "1")], "order_id string, cid string, ts bigint, account_id string").write.mode("append").parquet(f"{run}/in")
        out = SS.duplicate_stream(file_stream(spark, f"{run}/in", "order_id string, cid string, ts bigint, account_id string"), "cid")
        write(spark, out, run, empty=False)
    got = {r.order_id: (r.prev_seen_ts, r.decision) for r in spark.read.parquet(f"{run}/out").collect()}
    assert got == {"o0": (None, "NEW"), "o1": (5_000_000, "DUPLICATE"), "o2": (5_000_000, "DUPLICATE")}


def test_throttle_follows_its_commands(spark):
    rnd = random.Random(4)
    orders = [(f"o{k:05d}", rnd.randrange(0, 60_000), rnd.choice(["0", "1", "2", None]), "A", "BUY", 1, 1.0, "X") for k in range(4000)]
    commands = [(f"c{k:03d}", rnd.randrange(60) * 1000, f"ACCOUNT:{k % 2}", rnd.choice(["THROTTLE", "UNKILL", "THROTTLE", "PAUSE"]), None, None, None,
                 float(rnd.randrange(1, 9)), None) for k in range(30)]
    exp, counts = {}, {}
    for oid, ts, account, *_ in sorted(orders, key=lambda r: (r[1], r[0])):
        mine = [c for c in commands if c[2] == f"ACCOUNT:{account}" and c[1] <= ts]
        last = max(mine, key=lambda c: (c[1], c[0]), default=None)
        rate = int(last[7]) if last and last[3] == "THROTTLE" else None
        n = counts.get((account, ts // 1000), 0)
        allowed = account is None or rate is None or n < rate
        counts[account, ts // 1000] = n + allowed
        exp[oid] = (None if account is None else rate, "ALLOW" if allowed else "THROTTLED")
    tagged = SS.throttle_input(orders_df(spark, orders), commands_df(spark, commands))
    got = replay(spark, tagged, "ts", SS.throttle_stream)
    assert {r.order_id: (r.max_rate_per_second, r.decision) for r in got.collect()} == exp
    assert "THROTTLED" in {v[1] for v in exp.values()}


def test_throttle_equals_the_batch_operator(spark):
    rnd = random.Random(6)
    orders = orders_df(spark, [(f"o{k:05d}", rnd.randrange(0, 30_000), str(rnd.randrange(5)), "A", "BUY", 1, 1.0, "X") for k in range(2000)])
    policy = spark.createDataFrame([("ACCOUNT:0", 3), ("ACCOUNT:1", 9)], "scope string, max_rate_per_second int")
    commands = policy.selectExpr("scope", "-1L AS ts", "scope AS cmd_id", "'THROTTLE' AS action", "CAST(max_rate_per_second AS DOUBLE) AS value")
    columns = ["order_id", "ts", "account_id", "symbol", "max_rate_per_second", "decision"]
    got = replay(spark, SS.throttle_input(orders, commands), "ts", SS.throttle_stream)
    assert rows_of(got, columns) == rows_of(X.throttle_decisions(orders, policy), columns)


def released(commands, cooldown, window, until):
    """Releases of one scope, step by step over its commands and the ends of its episodes."""
    breaches = sorted({c[1] for c in commands if c[3] == "KILL" and c[5] == "spark"})
    steps = [(c[1], 1, c[0], c[3], c[5]) for c in commands]
    for k, end in enumerate(breaches):
        if k + 1 == len(breaches) or breaches[k + 1] - window - end >= cooldown:
            steps.append((end + cooldown, 0, "", "RELEASE", None))
    killed, who, cmd, held, out = False, None, None, False, []
    for ts, _, id_, action, by in sorted(steps, key=lambda s: s[:3]):
        if ts > until:
            break
        if action == "KILL" and not killed:
            killed, who, cmd = True, by, id_
        elif action == "UNKILL":
            killed = False
        elif action in ("HOLD", "UNHOLD"):
            held = action == "HOLD"
        elif action == "RELEASE" and killed and who == "spark" and not held:
            killed = False
            out.append((commands[0][2], ts, cmd))
    return out


def test_releases_after_the_cooldown(spark):
    """Episodes, overrides, holds and kills after a release, at random."""
    rnd = random.Random(12)
    window, cooldown = DAY, 2 * DAY
    commands = []
    for account in range(25):
        for k in range(rnd.randrange(2, 14)):
            if rnd.random() < 0.55:
                row = (rnd.randrange(1, 40) * DAY, "KILL", "spark")
            else:
                row = (rnd.randrange(40 * DAY), rnd.choice(["KILL", "UNKILL", "UNKILL", "HOLD", "UNHOLD"]), "ops")
            commands.append((f"c{account:02d}-{k:02d}", row[0], f"ACCOUNT:{account}", row[1], None, row[2], None, None, None))
    commands += [("lost", None, "ACCOUNT:1", "KILL", None, "spark", None, None, None), ("far", 41 * DAY + 7, "GLOBAL", "UNKILL", None, "ops", None, None, None)]
    until = 41 * DAY + 7 - 3_600_000 - window
    exp = sorted(r for a in range(25) for r in released([c for c in commands if c[2] == f"ACCOUNT:{a}" and c[1] is not None], cooldown, window, until))
    got = replay(spark, commands_df(spark, commands), "ts", lambda c: SS.release_stream(c, cooldown, window, "1 hour"))
    from haltgate.functions.columns import stable_id
    named = spark.createDataFrame(exp, "scope string, ts bigint, cmd string").select("scope", "ts", stable_id(F.lit("auto"), "cmd").alias("cmd_id"))
    assert rows_of(got, ["scope", "ts", "cmd_id"]) == rows_of(named, ["scope", "ts", "cmd_id"]) and len(exp) > 20
    assert {r.action for r in got.collect()} == {"UNKILL"} and got.columns == [c.split()[0] for c in CMD_COLS.split(", ")]


def test_interleaved_gate_equals_the_as_of_gate(spark):
    rnd = random.Random(8)
    commands = [(f"c{k:04d}", rnd.randrange(50_000), rnd.choice(["GLOBAL", "SYMBOL:A", "SYMBOL:B", "STRATEGY:X", *[f"ACCOUNT:{a}" for a in range(6)]]),
                 rnd.choice(["KILL", "UNKILL"]), f"r{k}", "op", None, None, "x") for k in range(150)]
    orders = orders_df(spark, [(f"o{k:05d}", rnd.randrange(50_000) if k % 40 else None, rnd.choice([*"01234567", None]), rnd.choice("ABC"), "BUY", 1, 1.0,
                                rnd.choice("XY")) for k in range(1500)])
    states = state_records(commands_df(spark, commands))
    for strategy in (False, True):
        tagged = SS.tagged_records(orders, states, 3)
        got = replay(spark, tagged, "at", lambda t: SS.interleaved_gate(t, strategy))
        exp = gate_asof(orders, states, include_strategy=strategy)
        assert sorted(got.columns) == sorted(exp.columns)
        assert rows_of(got, exp.columns) == rows_of(exp, exp.columns)


def test_windows_of_several_widths_close_each_in_its_time(spark):
    rnd = random.Random(9)
    orders = spark.createDataFrame([(f"o{k:04d}", rnd.randrange(6 * 3_600_000), str(rnd.randrange(4)), rnd.choice("AB"), "BUY", 1, 100.0, "X") for k in range(600)], ORDER_COLS)
    specs = [RiskParams(window="5 minutes", max_orders=3, max_notional=1e9, max_share=2.0), RiskParams(window="1 hour", max_orders=20, max_notional=2500.0, max_share=2.0)]
    got = replay(spark, orders, "ts", lambda o: multi_window_stream(o, specs))
    newest = orders.agg(F.max("ts")).first()[0]
    exp = X.multi_window_commands(orders, specs).filter(F.col("ts") <= newest - 60_000)
    assert rows_of(got, exp.columns) == rows_of(exp, exp.columns) and {r.window_label for r in exp.collect()} == {"300s", "3600s"}


def test_stateful_queries_run_in_a_session_of_any_kind():
    """A session that names no state store, and a driver started in another folder, whose
    Python path does not reach the library by itself."""
    code = f"""
import sys, tempfile
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config(map={{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": tempfile.mkdtemp(),
                                                            "spark.sql.session.timeZone": "UTC"}}).getOrCreate()
sys.path.insert(0, {ROOT!r})
from pyspark.sql import functions as F
from haltgate.plans import catalog as C
from haltgate.streaming import stateful as SS
provider = "spark.sql.streaming.stateStore.providerClass"
before = spark.conf.get(provider, None)
run = tempfile.mkdtemp()
rows = spark.createDataFrame([("o1", "x", 1), ("o2", "x", 2), ("o3", None, 3)], "order_id string, cid string, ts bigint").withColumn("account_id", F.lit("1"))
def start(o):
    def go():
        with C.without_empty_batches(spark):
            return C._stateful_to_files(SS.duplicate_stream(o, "cid"), run)()
    return [go]
C._replay(rows, F.col("ts"), run, start)
got = sorted((r.order_id, r.decision) for r in spark.read.parquet(run + "/out").collect())
assert got == [("o1", "NEW"), ("o2", "DUPLICATE"), ("o3", "NEW")], got
assert spark.conf.get(provider, None) == before
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(), env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-3000:]
