import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import ms
from haltgate.operators.signals import risk_signals
from haltgate.params import RiskParams
from haltgate.sources.orders import decode_orders
from haltgate.streaming.control import aggregate_batch, latest_snapshot, read_batches
from haltgate.streaming.detector import detector_streams
from haltgate.streaming.io import json_file_stream, order_stream


def _write_lines(d, name, recs):
    with open(os.path.join(d, name), "w") as f:
        for r in recs:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _order(oid, ts, acct="1", sym="AAPL"):
    return {"order_id": oid, "ts": ts, "account_id": acct, "symbol": sym, "side": "BUY",
            "qty": 10, "price": 5.0, "strategy": "ALGO_X"}


def test_malformed_order_goes_to_rejects(spark):
    raw = spark.createDataFrame(
        [('{"order_id":"test-123","account_id":"99999","symbol":"TEST","qty":100,"price":50.0}',),
         (json.dumps(_order("ok", 1)),), ("not json",)], "value string")
    good, bad = decode_orders(raw)
    assert [r.order_id for r in good.collect()] == ["ok"]
    b = {r.raw: r.missing_fields for r in bad.collect()}
    assert b['{"order_id":"test-123","account_id":"99999","symbol":"TEST","qty":100,"price":50.0}'] == "ts"
    assert "order_id" in b["not json"]


def test_stream_equals_batch_for_closed_windows_and_drops_late_rows(spark):
    p = RiskParams(watermark="60 seconds")
    src = tempfile.mkdtemp(prefix="orders-")
    run = tempfile.mkdtemp(prefix="run-")
    first = [_order(f"a{i}", ms(10, 0, i)) for i in range(5)] + [_order("b0", ms(10, 5, 0), "2")]
    _write_lines(src, "part-0.json", first)
    raw = json_file_stream(spark, src, max_files_per_trigger=1)
    orders, _ = order_stream(raw)
    sig, _ = detector_streams(orders, p)
    q = (sig.writeStream.format("parquet").outputMode("append").option("path", f"{run}/out")
         .option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    # second file: one on-time row, one row behind the watermark (10:03:58)
    _write_lines(src, "part-1.json", [_order("late", ms(10, 0, 30)), _order("c0", ms(10, 9, 0), "3")])
    q = (sig.writeStream.format("parquet").outputMode("append").option("path", f"{run}/out")
         .option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.account_id, r.order_count) for r in spark.read.parquet(f"{run}/out").collect()}
    # closed windows only; the late row is not counted in the 10:00 window
    assert got == {("1", 5), ("2", 1)}
    batch = risk_signals(spark.read.schema("order_id string, ts bigint, account_id string, symbol string, "
                                           "side string, qty int, price double, strategy string")
                         .json(src), p)
    b = {(r.account_id, r.order_count) for r in batch.collect()}
    assert ("1", 6) in b  # the batch operator counts the late row


def test_aggregator_batches_are_idempotent(spark):
    root = tempfile.mkdtemp(prefix="state-")
    cmds = spark.createDataFrame(
        [("1", 100, "ACCOUNT:1", "KILL", "r", "op", None, None, "c")],
        "cmd_id string, ts bigint, scope string, action string, reason string, triggered_by string, "
        "metric string, value double, corr_id string")
    aggregate_batch(spark, cmds, 0, root)
    more = cmds.withColumn("cmd_id", F.lit("2")).withColumn("ts", F.lit(200).cast("bigint")) \
               .withColumn("action", F.lit("UNKILL"))
    aggregate_batch(spark, more, 1, root)
    aggregate_batch(spark, more, 1, root)  # replay of batch 1
    snap = latest_snapshot(spark, root).collect()
    assert [(r.scope, r.status) for r in snap] == [("ACCOUNT:1", "ACTIVE")]
    assert read_batches(spark, f"{root}/history").count() == 2


def test_first_breach_writes_one_command_per_window(spark):
    """Two batches breach different metrics of one window: one command."""
    from haltgate.streaming.detector import start_update_detector
    src, run = tempfile.mkdtemp(prefix="orders-"), tempfile.mkdtemp(prefix="run-")
    p = RiskParams(max_orders=3, max_notional=1e12, max_share=0.7)
    for k, n in enumerate((1, 5)):
        _write_lines(src, f"part-{k}.json", [_order(f"{k}-{i}", ms(10, 0, 10 * k + i)) for i in range(n)])
        orders, _ = order_stream(json_file_stream(spark, src))
        start_update_detector(orders, p, f"{run}/out", f"{run}/ck", {"availableNow": True},
                              first_breach_only=True).awaitTermination()
    got = [(r.metric, r.batch_id) for r in read_batches(spark, f"{run}/out/commands").collect()]
    assert got == [("symbol_concentration", 0)]
