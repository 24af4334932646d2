import json
import os
import tempfile

from haltgate import jobs
from haltgate.streaming.control import latest_snapshot, read_batches


def _lines(d, name, recs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_file_jobs_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    cmds = [{"cmd_id": "1", "ts": 1000, "scope": "ACCOUNT:7", "action": "KILL", "reason": "manual",
             "triggered_by": "op", "corr_id": "c1"}]
    _lines(f"{root}/commands", "c.json", cmds)
    orders = [{"order_id": f"o{i}", "ts": 2000 + i, "account_id": str(7 + i % 2), "symbol": "AAPL",
               "side": "BUY", "qty": 1, "price": 1.0, "strategy": "X"} for i in range(4)]
    _lines(f"{root}/orders", "o.json", orders)
    common = ["--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck"]
    jobs.run(["aggregate", "--input", f"{root}/commands", "--state-root", f"{root}/state"] + common, spark)
    assert [r.status for r in latest_snapshot(spark, f"{root}/state").collect()] == ["KILLED"]
    jobs.run(["route", "--input", f"{root}/orders", "--state-root", f"{root}/state",
              "--out-root", f"{root}/routed"] + common, spark)
    got = {r.order_id: r.decision for r in read_batches(spark, f"{root}/routed/audit").collect()}
    assert got == {"o0": "DROP", "o1": "ALLOW", "o2": "DROP", "o3": "ALLOW"}
    jobs.run(["detect", "x", "1", "1e9", "1.0", "--window", "60 seconds", "--input", f"{root}/orders",
              "--out-root", f"{root}/detected", "--mode", "first-breach"] + common, spark)
    cmds = read_batches(spark, f"{root}/detected/commands").collect()
    # two orders per account in one minute: 2 > 1 breaches the rate
    assert sorted((c.scope, c.metric) for c in cmds) == [("ACCOUNT:7", "order_rate_60s"),
                                                         ("ACCOUNT:8", "order_rate_60s")]


def test_detect_append_job_writes_keyed_json(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    orders = [{"order_id": f"o{i}", "ts": 60_000 * (i // 3) + i, "account_id": "5", "symbol": "AAPL",
               "side": "BUY", "qty": 1, "price": 1.0, "strategy": "X"} for i in range(9)]
    _lines(f"{root}/orders", "o.json", orders)
    jobs.run(["detect", "x", "2", "1e9", "1.0", "--window", "60 seconds", "--watermark", "0 seconds",
              "--input", f"{root}/orders", "--out-root", f"{root}/det", "--source", "files",
              "--available-now", "--checkpoint-root", f"{root}/ck"], spark)
    sig = spark.read.json(f"{root}/det/signals").collect()
    # windows 0 and 1 are closed by the watermark; the last one stays open
    assert sorted(json.loads(r.value)["order_count"] for r in sig) == [3, 3]
    assert {r.key for r in sig} == {"5"}
    cmd = spark.read.json(f"{root}/det/commands").collect()
    assert {r.key for r in cmd} == {"ACCOUNT:5"} and len(cmd) == 2


def test_keyed_json_and_topic_split(spark):
    from haltgate.sources.orders import to_keyed_json
    from haltgate.streaming.io import split_topics
    df = spark.createDataFrame([(1, "a")], "n int, scope string")
    assert to_keyed_json(df).first().key == "1"          # first column when no account_id
    assert to_keyed_json(df, "scope").first().key == "a"
    rec = spark.createDataFrame([("orders.v1", "x"), ("killswitch.state.v1", "y")], "topic string, value string")
    parts = split_topics(rec, ["orders.v1", "killswitch.state.v1"])
    assert [r.value for r in parts["orders.v1"].collect()] == ["x"]


def test_route_job_gates_orders_without_time_and_keeps_rejects(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    _lines(f"{root}/orders", "o.json", [
        {"order_id": "test-123", "account_id": "99999", "symbol": "TEST", "qty": 100, "price": 50.0},
        {"order_id": "ok", "ts": 5, "account_id": "1", "symbol": "A", "side": "BUY", "qty": 1, "price": 1.0, "strategy": "X"},
        {"order_id": "lost", "ts": 5, "symbol": "A"}])
    with open(f"{root}/orders/o.json", "a") as f:
        f.write("{not json\n")
    jobs.run(["route", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck", "--input", f"{root}/orders",
              "--state-root", f"{root}/state", "--out-root", f"{root}/routed"], spark)
    audit = {r.order_id: r.decision for r in read_batches(spark, f"{root}/routed/audit").collect()}
    assert audit == {"test-123": "ALLOW", "ok": "ALLOW"}
    rejects = read_batches(spark, f"{root}/routed/rejects").collect()
    assert sorted(r.missing_fields for r in rejects) == ["account_id", "order_id,account_id,symbol"]
    counters = read_batches(spark, f"{root}/routed/counters").first()
    assert (counters.orders_processed, counters.errors, counters.kill_state_scopes) == (2, 2, 0)


def test_amounts_out_of_range_are_rejects(spark):
    """A price beyond the decimal, infinite or not a number stops no job."""
    root = tempfile.mkdtemp(prefix="jobs-")
    order = {"account_id": "1", "symbol": "A", "ts": 5, "qty": 3}
    _lines(f"{root}/orders", "o.json", [{"order_id": "good", "price": 1.5, **order}, {"order_id": "huge", "price": 1e19, **order},
                                        {"order_id": "later", "price": 2.5, **order, "ts": 200_000}])
    with open(f"{root}/orders/o.json", "a") as f:
        for text in ("NaN", "Infinity"):
            f.write('{"order_id": "%s", "ts": 5, "account_id": "1", "symbol": "A", "qty": 1, "price": %s}\n' % (text, text))
    jobs.run(["detect", "x", "0", "1e9", "1.0", "--watermark", "0 seconds", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck",
              "--input", f"{root}/orders", "--out-root", f"{root}/out"], spark)
    assert sorted(r.missing_fields for r in spark.read.json(f"{root}/out/rejects").collect()) == ["notional"] * 3
    assert [json.loads(r.value)["total_notional"] for r in spark.read.json(f"{root}/out/signals").collect()] == [4.5]


def test_aggregate_job_keeps_and_counts_rejects(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    good = {"cmd_id": "1", "ts": 1000, "scope": "ACCOUNT:7", "action": "KILL"}
    _lines(f"{root}/commands", "c.json", [good, {"cmd_id": "2", "ts": 1000, "action": "KILL"}, {"ts": 5, "scope": "GLOBAL"}])
    with open(f"{root}/commands/c.json", "a") as f:
        f.write("{not json\n")
    jobs.run(["aggregate", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck", "--input", f"{root}/commands",
              "--state-root", f"{root}/state"], spark)
    rejects = read_batches(spark, f"{root}/state/rejects").collect()
    assert sorted(r.missing_fields for r in rejects) == ["cmd_id,action", "cmd_id,scope,action", "scope"]
    assert "{not json" in {r.raw for r in rejects}
    counters = read_batches(spark, f"{root}/state/counters").first()
    assert (counters.commands_processed, counters.errors) == (1, 3)
    assert [r.status for r in latest_snapshot(spark, f"{root}/state").collect()] == ["KILLED"]


def test_audit_is_published_by_order(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    _lines(f"{root}/orders", "o.json", [{"order_id": "o1", "account_id": "7", "symbol": "A"}])
    jobs.run(["route", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck", "--input", f"{root}/orders",
              "--state-root", f"{root}/state", "--out-root", f"{root}/out"], spark)
    assert [r.key for r in spark.read.json(f"{root}/out/audit.v1").collect()] == ["o1"]
    assert [r.key for r in spark.read.json(f"{root}/out/orders.gated.v1").collect()] == ["7"]


def test_rows_without_a_time_are_replayed_in_the_first_period(spark):
    from pyspark.sql import functions as F

    from haltgate.streaming.io import feed, in_periods, period_cuts
    df = spark.createDataFrame([(k, k * 10 if k % 4 else None) for k in range(40)], "id int, t bigint").repartition(3)
    cuts = period_cuts(df, F.col("t"), 4)
    parts = [sorted(r.id for r in p.collect()) for p in in_periods(df, F.col("t"), cuts)]
    assert sorted(sum(parts, [])) == list(range(40)) and {k for k in range(0, 40, 4)} <= set(parts[0]) and all(parts)
    seen, path = [], f"{tempfile.mkdtemp(prefix='feed-')}/rows"
    feed(df, F.col("t"), cuts, path, lambda: seen.append(spark.read.parquet(path).count()))
    assert seen == [sum(len(p) for p in parts[: k + 1]) for k in range(4)]
    assert len(spark.read.parquet(path).inputFiles()) > 4  # Spark's own partitions
    assert period_cuts(df.filter("false"), F.col("t"), 4) == [] and len(in_periods(df, F.col("t"), [])) == 1


def test_processing_time_stamps(spark):
    """``ts_mode="processing"``: signals carry the time at which they were made, in whole seconds."""
    import time

    from conftest import orders_df
    from haltgate.operators.signals import risk_signals
    rows = [(f"o{k}", 60_000 * k, "1", "A", "BUY", 1, 1.0, "X") for k in range(3)]
    before = int(time.time()) * 1000
    stamped = risk_signals(orders_df(spark, rows), ts_mode="processing").collect()
    assert len(stamped) == 3 and all(before <= r.ts <= time.time() * 1000 and r.ts % 1000 == 0 for r in stamped)


def test_detect_job_writes_rejects(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    _lines(f"{root}/orders", "o.json", [{"order_id": "a", "account_id": "1", "symbol": "A", "qty": 1, "price": 1.0}])
    jobs.run(["detect", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck", "--input", f"{root}/orders",
              "--out-root", f"{root}/out"], spark)
    assert [r.missing_fields for r in spark.read.json(f"{root}/out/rejects").collect()] == ["ts"]


def test_jobs_resume_from_their_checkpoints(spark):
    root = tempfile.mkdtemp(prefix="jobs-")
    order = {"account_id": "1", "symbol": "A", "qty": 1, "price": 1.0}
    args = ["route", "--source", "files", "--available-now", "--checkpoint-root", f"{root}/ck", "--input", f"{root}/orders",
            "--state-root", f"{root}/state", "--out-root", f"{root}/routed"]
    for k in range(2):
        _lines(f"{root}/orders", f"o{k}.json", [{"order_id": f"o{k}", **order}])
        jobs.run(args, spark)
    audit = sorted((r.batch_id, r.order_id) for r in read_batches(spark, f"{root}/routed/audit").collect())
    assert audit == [(0, "o0"), (1, "o1")]


class _Query:
    def __init__(self, error):
        self.isActive, self.error = False, error

    def exception(self):
        return self.error


def test_failed_queries_are_started_again_and_then_fail_the_job():
    import pytest

    from haltgate.streaming.supervisor import supervise
    started = []

    def starter(errors):
        def start():
            started.append(1)
            return _Query(errors.pop(0) if errors else None)
        return start

    assert supervise({"q": starter([ValueError("one"), ValueError("two")])}, poll_s=0) == {"q": 2} and len(started) == 3
    with pytest.raises(RuntimeError, match="q"):
        supervise({"q": starter([ValueError(str(k)) for k in range(9)])}, poll_s=0, max_restarts=2)
