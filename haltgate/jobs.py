"""Job entry points (``spark-submit -m``-style):

    python -m haltgate.jobs detect  <bootstrap> [rate] [notional] [share] [--window ...]
    python -m haltgate.jobs aggregate <bootstrap> --state-root DIR
    python -m haltgate.jobs route   <bootstrap> --state-root DIR --out-root DIR
    python -m haltgate.jobs release <bootstrap> --window ... --cooldown ...
    python -m haltgate.jobs maintain --out-root DIR

With ``--source files --input DIR`` the log is replaced by a folder of
JSON-lines files (and the Kafka sinks by file sinks under ``--out-root``);
``--available-now`` processes what is there and stops. Thresholds follow the
reference's positional order: order rate, notional, symbol concentration.
"""

from __future__ import annotations

import argparse
import datetime
import os

from pyspark.sql import DataFrame, SparkSession

from .functions.columns import AUDIT_TTL_DAYS
from .params import DEFAULT_PARAMS, RiskParams, interval_seconds
from .session import build_session, checkpoint_dir, configured_checkpoint_dir, ensure_checkpoint_dir, ensure_utc
from .sources.commands import decode_commands
from .streaming import control
from .streaming.detector import detector_starters, start_update_detector
from .streaming.io import (AUDIT_TOPIC, COMMANDS_TOPIC, GATED_TOPIC, ORDERS_TOPIC, SIGNALS_TOPIC,
                           STATE_TOPIC, compact_dates, expire_dates, json_file_stream, keyed_json_stream_writer,
                           log_stream, order_stream, reject_writer)
from .streaming.stateful import release_stream
from .streaming.supervisor import supervise


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="haltgate.jobs")
    p.add_argument("job", choices=["detect", "aggregate", "route", "release", "maintain"])
    p.add_argument("bootstrap", nargs="?", default="localhost:9092")
    p.add_argument("rate", nargs="?", type=int, default=DEFAULT_PARAMS.max_orders)
    p.add_argument("notional", nargs="?", type=float, default=DEFAULT_PARAMS.max_notional)
    p.add_argument("share", nargs="?", type=float, default=DEFAULT_PARAMS.max_share)
    p.add_argument("--window", default=DEFAULT_PARAMS.window)
    p.add_argument("--watermark", default=DEFAULT_PARAMS.watermark)
    p.add_argument("--min-orders", type=int, default=DEFAULT_PARAMS.min_orders)
    p.add_argument("--mode", choices=["append", "update", "first-breach"], default="append")
    p.add_argument("--source", choices=["kafka", "files"], default="kafka")
    p.add_argument("--input", help="folder of JSON-lines files (--source files)")
    p.add_argument("--kafka-option", action="append", default=[],
                   help="extra reader/writer option key=value (security settings etc.)")
    p.add_argument("--state-root")
    p.add_argument("--out-root")
    p.add_argument("--state-log", help="folder of published state records, instead of the snapshot")
    p.add_argument("--strategy-scopes", action="store_true", help="also gate on STRATEGY scopes")
    p.add_argument("--checkpoint-root", help="defaults to spark.checkpoint.dir/<job>")
    p.add_argument("--cooldown", default="5 minutes", help="calm period after which release lifts a detector kill")
    p.add_argument("--keep-days", type=int, default=AUDIT_TTL_DAYS, help="dates of the audit index that maintain keeps")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--console", action="store_true")
    return p


def _kafka_options(args) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": args.bootstrap}
    for kv in args.kafka_option:
        k, v = kv.split("=", 1)
        opts[k] = v
    return opts


def _source(spark: SparkSession, args, topic: str, starting: str) -> DataFrame:
    if args.source == "files":
        return json_file_stream(spark, args.input)
    return log_stream(spark, [topic], _kafka_options(args), starting).select("value")


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, int]:
    args = _parser().parse_args(argv)
    if spark is None:
        spark = build_session(app_name=f"haltgate-{args.job}")
    ensure_utc(spark)
    # A job resumes from its checkpoints: their place has to be named.
    if not args.checkpoint_root and not configured_checkpoint_dir(spark):
        raise SystemExit("name --checkpoint-root or spark.checkpoint.dir: a job resumes from there")
    ensure_checkpoint_dir(spark)
    ck = args.checkpoint_root or os.path.join(checkpoint_dir(spark), args.job)
    rejects_to = os.path.join(args.out_root or ck, "rejects")
    trig = {"availableNow": True} if args.available_now else None
    params = RiskParams(window=args.window, max_orders=args.rate, max_notional=args.notional,
                        max_share=args.share, min_orders=args.min_orders, watermark=args.watermark)
    starters = {}
    if args.job == "maintain":
        today, index = datetime.datetime.now(datetime.timezone.utc).date(), os.path.join(args.out_root, "audit_index")
        return {"expired": len(expire_dates(spark, index, today, args.keep_days)),
                "compacted": len(compact_dates(spark, index, today - datetime.timedelta(days=1)))}

    def sink(topic: str) -> dict[str, str] | None:
        """Where records of a topic are published: the log, or files under the output root."""
        if args.source == "kafka":
            return {"format": "kafka", "topic": topic, **_kafka_options(args)}
        return {"format": "json", "path": os.path.join(args.out_root, topic)} if args.out_root else None

    if args.job == "detect":
        # Detection starts from the newest offsets, as the reference does.
        orders, rejects = order_stream(_source(spark, args, ORDERS_TOPIC, "latest"))
        starters["rejects"] = lambda: reject_writer(rejects, rejects_to, f"{ck}/rejects") \
            .trigger(**(trig or {"processingTime": "10 seconds"})).start()
        if args.mode == "append":
            if args.source == "files":
                fmt, opts = "json", {"signals": {"path": f"{args.out_root}/signals"},
                                     "commands": {"path": f"{args.out_root}/commands"}}
            else:
                k = _kafka_options(args)
                fmt, opts = "kafka", {"signals": {**k, "topic": SIGNALS_TOPIC},
                                      "commands": {**k, "topic": COMMANDS_TOPIC}}
            starters.update(detector_starters(orders, params, fmt, opts, ck, trig, args.console))
        else:
            starters["detect"] = lambda: start_update_detector(
                orders, params, args.out_root, f"{ck}/update", trig,
                first_breach_only=args.mode == "first-breach",
                sinks={k: v for k, v in (("signals", sink(SIGNALS_TOPIC)), ("commands", sink(COMMANDS_TOPIC))) if v})
    elif args.job == "aggregate":
        raw = _source(spark, args, COMMANDS_TOPIC, "earliest")
        starters["aggregate"] = lambda: control.start_aggregator(
            raw, args.state_root, f"{ck}/agg", trig, sink(STATE_TOPIC), os.path.join(args.out_root or args.state_root, "rejects"))
    elif args.job == "release":
        # reads the command log and writes UNKILL commands to it
        commands, _ = decode_commands(_source(spark, args, COMMANDS_TOPIC, "earliest"))
        out = release_stream(commands, interval_seconds(args.cooldown) * 1000, params.window_ms, args.watermark)
        to = sink(COMMANDS_TOPIC)
        starters["release"] = lambda: keyed_json_stream_writer(out, "scope", to["format"], {k: v for k, v in to.items() if k != "format"},
                                                               f"{ck}/release").trigger(**(trig or {"processingTime": "5 seconds"})).start()
    else:
        raw = _source(spark, args, ORDERS_TOPIC, "earliest")
        starters["route"] = lambda: control.start_router(
            raw, args.state_root, args.out_root, f"{ck}/router", trig, state_log=args.state_log,
            sinks={"gated": sink(GATED_TOPIC), "audit": sink(AUDIT_TOPIC)}, include_strategy=args.strategy_scopes)
    return supervise(starters, poll_s=1.0 if args.available_now else 10.0)


if __name__ == "__main__":
    run()
