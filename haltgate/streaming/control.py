"""Streaming control plane: the command -> state aggregator and the order
router, both as ``foreachBatch`` sinks over the batch operators.

State is kept as two tables in shared storage: the append-only state
history (one folder per micro-batch) and versioned snapshots (one folder per
micro-batch: previous snapshot ∪ the batch's records, folded). Each batch
writes only folders named by its batch id, so a batch replayed after a
failure overwrites its own output (effectively exactly-once).

The router gates each micro-batch against the newest complete snapshot, as
a router bootstrapped from the compacted state and refreshed per batch
would; decisions are consistent per micro-batch. The batch operator
``gate_asof`` gives exact per-order as-of decisions for replays and audits.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import AUDIT_TTL_DAYS, ttl_epoch_seconds
from ..operators.gate import gate_snapshot, gated_orders
from ..operators.reports import aggregator_counters
from ..operators.state import compact, fold_state, state_from_log, state_records
from ..schemas import STATE_COLUMNS, STATE_SCHEMA
from ..sources.commands import decode_commands
from ..sources.orders import ROUTER_ORDER_FIELDS, decode_orders
from .io import at_once, list_batches, prune_batches, publish_batch, write_batch, write_dated_batch


def latest_snapshot(spark: SparkSession, state_root: str) -> DataFrame:
    """Newest complete snapshot version (empty when none yet)."""
    versions = list_batches(spark, os.path.join(state_root, "snapshot"))
    if not versions:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.parquet(os.path.join(state_root, "snapshot", f"batch_id={versions[-1]}"))


#: Batches of the state log that a reader takes on top of its base before it makes a new one.
LOG_DELTAS = 16


def snapshot_from_log(spark: SparkSession, path: str, deltas: int = LOG_DELTAS) -> DataFrame:
    """State from the published state records (key, JSON value, a folder per
    batch): what a router that starts from the compacted log knows.

    The log is read once: ``<path>-base`` holds the newest record per key up to the batch
    that names its version, tombstones left out, and only later batches are read on top. After
    ``deltas`` of them they are folded into a new version, so a batch of the router reads
    as much after a thousand batches of state as after ten. A version is complete or
    not there; two readers that make the same one write the same rows."""
    base_root = f"{path.rstrip('/')}-base"
    versions = list_batches(spark, base_root)
    base = versions[-1] if versions else -1
    new = list_batches(spark, path, after=base)
    parts = []
    if versions:
        parts.append(spark.read.parquet(os.path.join(base_root, f"batch_id={base}")).select("key", "value", F.lit(base).cast("bigint").alias("offset")))
    if new:
        parts.append(spark.read.schema("key string, value string, batch_id bigint").option("basePath", path)
                     .json([os.path.join(path, f"batch_id={b}") for b in new]).select("key", "value", F.col("batch_id").alias("offset")))
    if not parts:
        return spark.createDataFrame([], STATE_SCHEMA)
    records = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if len(new) >= deltas:
        write_batch(compact(records, "key", ["offset"], "value").select("key", "value"), base_root, new[-1])
        prune_batches(spark, base_root)
        return snapshot_from_log(spark, path, deltas)
    return state_from_log(records.select("key", "value", F.lit(0).alias("partition"), "offset"))


def aggregate_batch(spark: SparkSession, commands: DataFrame, batch_id: int, state_root: str,
                    state_sink: dict[str, str] | None = None, rejects: DataFrame | None = None,
                    rejects_root: str | None = None) -> None:
    """One micro-batch of commands -> history folder, new snapshot version,
    counters; the new state of every scope the batch names is published to
    ``state_sink``. The newest snapshot versions are kept, older ones go.
    ``rejects`` are the records that were no commands: kept and counted."""
    prior = [v for v in list_batches(spark, os.path.join(state_root, "snapshot")) if v < batch_id]
    recs = state_records(commands).checkpoint()
    write_batch(recs, os.path.join(state_root, "history"), batch_id)
    base = (spark.read.parquet(os.path.join(state_root, "snapshot", f"batch_id={prior[-1]}"))
            if prior else spark.createDataFrame([], STATE_SCHEMA))
    snap = fold_state(base.select(*STATE_COLUMNS).unionByName(recs.select(*STATE_COLUMNS)))
    write_batch(snap, os.path.join(state_root, "snapshot"), batch_id)
    if state_sink is not None:
        new = spark.read.parquet(os.path.join(state_root, "snapshot", f"batch_id={batch_id}"))
        publish_batch(new.join(recs.select("scope").distinct(), "scope", "left_semi"), "scope", state_sink, batch_id)
    prune_batches(spark, os.path.join(state_root, "snapshot"))
    counters = aggregator_counters(commands)
    if rejects is not None:
        kept = keep_rejects(spark, rejects, rejects_root or os.path.join(state_root, "rejects"), batch_id)
        counters = counters.withColumn("errors", F.col("errors") + F.lit(kept))
    write_batch(counters, os.path.join(state_root, "counters"), batch_id)


def keep_rejects(spark: SparkSession, rejects: DataFrame, path: str, batch_id: int) -> int:
    """Writes a micro-batch's rejected records and counts what was written."""
    write_batch(rejects, path, batch_id)
    return spark.read.schema(rejects.schema).parquet(os.path.join(path, f"batch_id={batch_id}")).count()


def start_aggregator(commands: DataFrame, state_root: str, checkpoint: str,
                     trigger: dict | None = None, state_sink: dict[str, str] | None = None,
                     rejects_root: str | None = None) -> StreamingQuery:
    """Aggregates commands, or raw log records (a ``value`` column of JSON): those
    without command id, scope or action are written as rejects."""
    spark = commands.sparkSession
    raw = "cmd_id" not in commands.columns

    def aggregate(df: DataFrame, bid: int) -> None:
        good, bad = decode_commands(df) if raw else (df, None)
        aggregate_batch(spark, good, bid, state_root, state_sink, bad, rejects_root)

    return (commands.writeStream
            .foreachBatch(aggregate)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def route_batch(spark: SparkSession, orders: DataFrame, batch_id: int, state_root: str,
                out_root: str, rejects: DataFrame | None = None, state_log: str | None = None,
                sinks: dict[str, dict[str, str]] | None = None, include_strategy: bool = False) -> None:
    """One micro-batch of orders -> audit, gated orders, audit index, counters,
    and the records that could not be decided. The audit is written first;
    everything else is read from what was written. State comes from the
    published ``state_log`` where one is named, else from the newest snapshot;
    ``sinks`` publishes ``gated`` orders and ``audit`` records."""
    snap = latest_snapshot(spark, state_root) if state_log is None else snapshot_from_log(spark, state_log)
    if not list_batches(spark, os.path.join(out_root, "audit"), after=batch_id - 1)[:1] == [batch_id]:
        # a batch that is replayed keeps its decisions, whatever the state is by now
        write_batch(gate_snapshot(orders, snap, include_strategy=include_strategy), os.path.join(out_root, "audit"), batch_id)
    audit = spark.read.parquet(os.path.join(out_root, "audit", f"batch_id={batch_id}"))
    gated = gated_orders(audit)
    sinks = sinks or {}
    index = (audit.select("order_id", "ts", "account_id", "symbol", "decision", "reason", "corr_id")
             .withColumn("expires_at", ttl_epoch_seconds("ts", AUDIT_TTL_DAYS))
             .withColumn("date", F.to_date(F.timestamp_millis("ts"))))

    def count() -> None:
        errors = F.lit(0 if rejects is None else keep_rejects(spark, rejects, os.path.join(out_root, "rejects"), batch_id)).cast("bigint")
        counters = audit.agg(F.count(F.lit(1)).alias("orders_processed"),
                             F.count_if(F.col("decision") == "ALLOW").alias("orders_allowed"),
                             F.count_if(F.col("decision") == "DROP").alias("orders_dropped")) \
            .withColumns({"errors": errors, "kill_state_scopes": F.lit(snap.count()).cast("bigint")})
        write_batch(counters, os.path.join(out_root, "counters"), batch_id)

    at_once(spark, lambda: publish_batch(audit, "order_id", sinks.get("audit"), batch_id),
            lambda: publish_batch(gated, "account_id", sinks.get("gated"), batch_id),
            lambda: write_dated_batch(index, os.path.join(out_root, "audit_index"), batch_id),
            lambda: write_batch(gated, os.path.join(out_root, "gated"), batch_id), count)


def start_router(orders: DataFrame, state_root: str, out_root: str, checkpoint: str,
                 trigger: dict | None = None, **params) -> StreamingQuery:
    """Routes decoded orders, or raw log records (a ``value`` column of JSON):
    those without order id, account or symbol are written as rejects."""
    spark = orders.sparkSession
    raw = "order_id" not in orders.columns

    def route(df: DataFrame, bid: int) -> None:
        good, bad = decode_orders(df, required=ROUTER_ORDER_FIELDS) if raw else (df, None)
        route_batch(spark, good, bid, state_root, out_root, bad, **params)

    return (orders.writeStream
            .foreachBatch(route)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 second"})).start())


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batch folders of a ``write_batch`` table (``batch_id``
    column, from partition discovery of the ``batch_id=<n>`` folders)."""
    return spark.read.parquet(path)
