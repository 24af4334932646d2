"""Streaming risk detector: orders -> windowed signals -> kill commands.

Append mode with two chained window aggregations (window x account x symbol,
then window x account): each window is emitted once, final, when the event
time watermark passes its end, so the signals and commands equal the batch
operators' rows for every closed window. Late rows (older than the
watermark) are dropped and their state evicted. The stateful-operator
correctness check stays on.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.breaches import kill_commands
from ..operators.extensions import commands_of_windows
from ..operators.signals import risk_signals, rollup_signals, symbol_counts, window_counts
from ..operators.state import latest_by_key
from ..params import DEFAULT_PARAMS, RiskParams, interval_seconds
from ..schemas import COMMAND_COLUMNS
from ..sources.orders import with_order_metrics
from .io import (console_writer, keyed_json_stream_writer, list_batches, prune_batches, publish_batch,
                 write_batch)


def watermarked(orders: DataFrame, params: RiskParams = DEFAULT_PARAMS) -> DataFrame:
    """Adds notional / event time and the event-time watermark."""
    return with_order_metrics(orders).withWatermark("event_time", params.watermark)


def detector_streams(orders: DataFrame, params: RiskParams = DEFAULT_PARAMS,
                     ts_mode: str = "event") -> tuple[DataFrame, DataFrame]:
    """(signals, commands) streaming DataFrames from an order stream.
    ``ts_mode='processing'`` stamps ``ts`` with the processing time in whole
    seconds, as the reference does; the default (window end) is replayable."""
    sig = risk_signals(watermarked(orders, params), params, ts_mode)
    return sig, kill_commands(sig, params)


def detector_starters(orders: DataFrame, params: RiskParams, sink_format: str,
                      sink_options: dict[str, dict[str, str]], checkpoint_root: str,
                      trigger: dict | None = None, debug_console: bool = False,
                      ts_mode: str = "event") -> dict[str, Callable[[], StreamingQuery]]:
    """The signal and command queries by name, each started (again) by a call
    and resumed from its own checkpoint.

    ``sink_options`` maps 'signals' / 'commands' to writer options (for
    Kafka: bootstrap servers and topic; for files: path)."""
    sig, cmd = detector_streams(orders, params, ts_mode)
    trig = trigger or {"processingTime": "10 seconds"}
    out = {
        "signals": lambda: keyed_json_stream_writer(
            sig, "account_id", sink_format, sink_options["signals"],
            f"{checkpoint_root}/risk_signals").trigger(**trig).start(),
        "commands": lambda: keyed_json_stream_writer(
            cmd.select(*COMMAND_COLUMNS), "scope", sink_format, sink_options["commands"],
            f"{checkpoint_root}/kill_commands").trigger(**trig).start(),
    }
    if debug_console:
        out["console"] = lambda: console_writer(sig).trigger(**trig).start()
    return out


def start_detector(*args, **params) -> list[StreamingQuery]:
    """Starts every query of ``detector_starters``."""
    return [start() for start in detector_starters(*args, **params).values()]


def multi_window_stream(orders: DataFrame, specs: list[RiskParams]) -> DataFrame:
    """EXT-4 as a stream: kill commands of several window widths in one query with one
    watermark, the longest of the specs'. Every order is taken up once per width behind
    one scan, and all widths share the two window aggregations, whose shuffles carry
    partial aggregates; each closes its windows as the watermark passes their ends."""
    longest = max(specs, key=lambda p: interval_seconds(p.watermark))
    timed = watermarked(orders, longest)
    for i, p in enumerate(specs):
        timed = timed.withColumn(f"_w{i}", F.window("event_time", p.window))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("spec"), F.col(f"_w{i}").alias("window")) for i in range(len(specs))]))
    # explode drops the watermark's mark, by which the aggregations know the windows that are over
    window = F.col("_s.window").alias("window", metadata=timed.schema["_w0"].metadata)
    rows = (timed.select("account_id", "symbol", "notional", each.alias("_s"))
            .select(F.col("_s.spec").alias("spec"), window, "account_id", F.col("symbol").alias("_inner"), "notional"))
    signals = rollup_signals(window_counts(rows, "spec", "window", "account_id", "_inner"), ("spec", "account_id"))
    return commands_of_windows(signals, specs)


# -- low-latency variant: update mode ------------------------------------------------

_COUNT_KEYS = ["window", "account_id", "_inner"]


def update_batch(spark: SparkSession, updated: DataFrame, batch_id: int, root: str,
                 params: RiskParams, first_breach_only: bool, retention_ms: int,
                 sinks: dict[str, dict[str, str]] | None = None) -> None:
    """One micro-batch of updated (window, account, symbol) counts.

    The batch carries the current totals of every group it touched; they
    replace the kept counts (versioned per batch, windows older than the
    retention dropped). Only the touched (window, account) groups are rolled
    up again and emitted, as update mode would. Commands: every update of a
    breached window (parity), or only the first command of a (scope, window
    start, width), whatever metric breached first. Which windows have a
    command is kept like the counts and as long."""
    counts_root = os.path.join(root, "counts")
    prior = [v for v in list_batches(spark, counts_root) if v < batch_id]
    # written once: each look at the batch itself would read its input and aggregate it again
    updated = updated.checkpoint()
    upd = updated.withColumn("_v", F.lit(batch_id).cast("bigint"))
    if prior:
        base = spark.read.parquet(os.path.join(counts_root, f"batch_id={prior[-1]}"))
        merged = base.unionByName(upd)
    else:
        merged = upd
    latest = latest_by_key(merged.withColumn("_k", F.struct(*_COUNT_KEYS)), "_k", ["_v"]) \
        .drop("_k").checkpoint()
    # Keep only windows that can still change: a window ending a window
    # width plus the watermark delay before the newest one is closed.
    horizon = updated.agg(F.max(F.unix_millis("window.end"))).first()[0]
    kept = latest if horizon is None else \
        latest.filter(F.unix_millis("window.end") > F.lit(horizon - retention_ms))
    write_batch(kept, counts_root, batch_id)
    prune_batches(spark, counts_root)
    touched = updated.select("window", "account_id").distinct()
    sig = rollup_signals(latest.join(touched, ["window", "account_id"]), ("account_id",))
    write_batch(sig, os.path.join(root, "signals"), batch_id)
    sig = spark.read.schema(sig.schema).parquet(os.path.join(root, "signals", f"batch_id={batch_id}"))
    cmds = kill_commands(sig, params)
    if first_breach_only:
        seen_root = os.path.join(root, "breached")
        done = [v for v in list_batches(spark, seen_root) if v < batch_id]
        seen = spark.read.parquet(os.path.join(seen_root, f"batch_id={done[-1]}")).select("corr_id", "ts") \
            if done else spark.createDataFrame([], "corr_id string, ts bigint")
        cmds = cmds.join(seen, "corr_id", "left_anti").select(*cmds.columns)
        write_batch(cmds, os.path.join(root, "commands"), batch_id)
        new = spark.read.parquet(os.path.join(root, "commands", f"batch_id={batch_id}"))
        kept_seen = seen.unionByName(new.select("corr_id", "ts"))
        if horizon is not None:
            kept_seen = kept_seen.filter(F.col("ts") > F.lit(horizon - retention_ms))
        write_batch(kept_seen, seen_root, batch_id)
        prune_batches(spark, seen_root)
    else:
        write_batch(cmds, os.path.join(root, "commands"), batch_id)
    for name, key in (("signals", "account_id"), ("commands", "scope")):
        if sinks and name in sinks:
            written = spark.read.parquet(os.path.join(root, name, f"batch_id={batch_id}"))
            publish_batch(written.select(*COMMAND_COLUMNS) if name == "commands" else written, key, sinks[name], batch_id)


def start_update_detector(orders: DataFrame, params: RiskParams, root: str, checkpoint: str,
                          trigger: dict | None = None, first_breach_only: bool = False,
                          sinks: dict[str, dict[str, str]] | None = None) -> StreamingQuery:
    """Update-mode detector: signals and commands for every window a
    micro-batch touches, before the window closes; published to ``sinks``
    (``signals``, ``commands``) as keyed JSON where named."""
    spark = orders.sparkSession
    per = symbol_counts(watermarked(orders, params), params)
    retention = params.window_ms + interval_seconds(params.watermark) * 1000
    return (per.writeStream.outputMode("update")
            .foreachBatch(lambda df, bid: update_batch(spark, df, bid, root, params,
                                                       first_breach_only, retention, sinks))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())

