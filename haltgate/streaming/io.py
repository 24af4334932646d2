"""Streaming sources and sinks: log (Kafka) and file variants, keyed JSON,
console, and idempotent per-batch table writes for ``foreachBatch``.

The Kafka connector is not bundled here; its paths are plain reader/writer
options and are exercised with the file source in tests.
"""

from __future__ import annotations

import datetime
import os
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.gate import MAX_BROADCAST_BYTES, sized_broadcast
from ..session import state_dir
from ..sources.orders import REQUIRED_ORDER_FIELDS, decode_orders, to_keyed_json

# Topic names of the reference.
ORDERS_TOPIC = "orders.v1"
SIGNALS_TOPIC = "risk_signals.v1"
COMMANDS_TOPIC = "killswitch.commands.v1"
STATE_TOPIC = "killswitch.state.v1"
GATED_TOPIC = "orders.gated.v1"
AUDIT_TOPIC = "audit.v1"


# -- sources -------------------------------------------------------------------

def log_stream(spark: SparkSession, topics: list[str], options: dict[str, str],
               starting_offsets: str = "latest") -> DataFrame:
    """Kafka records (topic, key, value, partition, offset, timestamp).
    ``latest`` for detection, ``earliest`` for the router and aggregator."""
    df = (spark.readStream.format("kafka").options(**options).option("subscribe", ",".join(topics)).option("startingOffsets", starting_offsets).load())
    return df.select("topic", F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"), "partition", "offset",
                     "timestamp")


def log_batch(spark: SparkSession, topics: list[str], options: dict[str, str]) -> DataFrame:
    """Whole log from earliest to latest as a batch (state bootstrap)."""
    return (spark.read.format("kafka").options(**options).option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
            .option("endingOffsets", "latest").load()
            .select("topic", F.col("key").cast("string").alias("key"),
                    F.col("value").cast("string").alias("value"), "partition", "offset"))


def split_topics(records: DataFrame, topics: list[str]) -> dict[str, DataFrame]:
    """One subscription of several topics, dispatched by topic."""
    return {t: records.filter(F.col("topic") == t) for t in topics}


def json_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files as a stream of ``value`` strings (file stand-in for the log)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def order_stream(raw: DataFrame, value_col: str = "value",
                 required: list[str] = REQUIRED_ORDER_FIELDS) -> tuple[DataFrame, DataFrame]:
    """Raw JSON records -> (orders, rejects)."""
    return decode_orders(raw, value_col, required)


def reject_writer(rejects: DataFrame, path: str, checkpoint: str):
    """Rejected records (raw text, missing fields) as JSON lines."""
    return (rejects.writeStream.format("json").option("path", path)
            .option("checkpointLocation", checkpoint))


def period_cuts(df: DataFrame, ts_ms: Column, periods: int) -> list[int]:
    """Times that cut the span of a table's times into equal periods: one pass over the
    time column, two numbers on the driver. No times, no cuts."""
    lo, hi = df.agg(F.min(ts_ms), F.max(ts_ms)).first()
    return [] if lo is None else [lo + (hi - lo) * k // periods for k in range(1, periods)]


def in_periods(df: DataFrame, ts_ms: Column, cuts_ms: list[int]) -> list[DataFrame]:
    """The rows of each period between the cuts, oldest first; rows without a time are in
    the first."""
    edges, parts = [None, *cuts_ms, None], []
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = df if lo is None else df.filter(ts_ms >= lo)
        before = F.lit(True) if hi is None else ts_ms < hi
        parts.append(part.filter(before if lo is not None else before | ts_ms.isNull()))
    return parts


@contextmanager
def stored(df: DataFrame, path: str):
    """The rows of a table as written to ``path``, which is deleted at the end: for tables that
    are read several times and cost a plan each."""
    spark = df.sparkSession
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def feed(df: DataFrame, ts_ms: Column, cuts_ms: list[int], path: str, turn: Callable[[], None]) -> str:
    """Replays a table as a growing folder: each period's rows are written there, with as
    many files as Spark has partitions, and ``turn`` takes them up (as a batch of each
    query that it starts) before the next period comes."""
    for part in in_periods(df, ts_ms, cuts_ms):
        part.write.mode("append").parquet(path)
        turn()
    return path


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream; without a bound, all that is new is a batch."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


@contextmanager
def _started_under(spark: SparkSession, name: str, value: str):
    """A query keeps the settings that it was started under; the session gets its own back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def without_empty_batches(spark: SparkSession):
    """For starting a query that takes what is there and stops (``availableNow``) over an
    operator whose state expires by processing time: with empty batches such a query has always
    something to wait for."""
    return _started_under(spark, "spark.sql.streaming.noDataMicroBatches.enabled", "false")


def state_store(spark: SparkSession):
    """For starting a query over an operator of ``stateful``: ``transformWithState`` keeps its
    state in RocksDB only, whatever store the session names for other queries."""
    return _started_under(spark, "spark.sql.streaming.stateStore.providerClass",
                          "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


# -- sinks -----------------------------------------------------------------------

def keyed_json_stream_writer(df: DataFrame, key_col: str | None, fmt: str, options: dict[str, str],
                             checkpoint: str, output_mode: str = "append"):
    """(key, JSON value) writer; ``fmt='kafka'`` with topic/bootstrap options,
    or any file format (``json``/``parquet``) with a ``path`` option."""
    w = (to_keyed_json(df, key_col).writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    for k, v in options.items():
        w = w.option(k, v)
    return w


def console_writer(df: DataFrame, output_mode: str = "append"):
    """Untruncated console output for debugging."""
    return df.writeStream.format("console").outputMode(output_mode).option("truncate", False)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Idempotent micro-batch write: each batch owns ``batch_id=<n>``; a
    replayed batch (restart after failure) overwrites its own folder only."""
    target = os.path.join(path, f"batch_id={batch_id}")
    w = df.write.mode("overwrite").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(target)


#: Fields of a published record's value that name it: the batch, and the record in it.
RECORD_BATCH, RECORD_ROW = "batch_id", "record"


def publish_batch(df: DataFrame, key_col: str, sink: dict[str, str] | None, batch_id: int) -> None:
    """Batch twin of ``keyed_json_stream_writer`` for ``foreachBatch``: (key,
    JSON value) records to a log. ``sink`` has ``format`` and the writer's
    options; a file sink gets a folder per batch, so a replayed batch
    replaces its own records. With ``append`` set (as any log does it) a
    replayed batch is there again: its records carry the batch and a name of
    their own, the digest of their fields and, of equal ones, a number, by which
    ``once`` leaves each out but once."""
    if sink is None:
        return
    options = dict(sink)
    fmt, append = options.pop("format"), options.pop("append", None)
    digest = F.sha2(F.to_json(F.struct(*df.columns)), 256)
    named = _numbered_again(df, digest).withColumn(RECORD_BATCH, F.lit(batch_id).cast("bigint"))
    keyed = to_keyed_json(named, key_col)
    if "path" in options and not append:
        write_batch(keyed, options["path"], batch_id, fmt=fmt)
    else:
        keyed.write.format(fmt).options(**options).mode("append").save()


_PLAIN = {"string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "array<string>"}


def _numbered_again(df: DataFrame, digest: Column) -> DataFrame:
    """Adds the record's name: its digest and, among equal records, its number from 1. Only
    records whose hash comes twice meet in a window; the others are the first of their kind.
    Values of other types than the plain ones are hashed as JSON has them: equal records have
    equal hashes."""
    hashed = F.xxhash64(*[c if t in _PLAIN else F.to_json(F.struct(c)) for c, t in df.dtypes])
    several = df.select(hashed.alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("_h").checkpoint()
    if several.isEmpty():
        return df.withColumn(RECORD_ROW, F.concat_ws("-", digest, F.lit(1)))
    several = sized_broadcast(several, MAX_BROADCAST_BYTES)
    again = Window.partitionBy(RECORD_ROW).orderBy(F.lit(0))
    equal = (df.withColumn("_h", hashed).join(several, "_h", "left_semi").drop("_h").withColumn(RECORD_ROW, digest)
             .withColumn(RECORD_ROW, F.concat_ws("-", RECORD_ROW, F.row_number().over(again))))
    other = df.withColumn("_h", hashed).join(several, "_h", "left_anti").drop("_h").withColumn(RECORD_ROW, F.concat_ws("-", digest, F.lit(1)))
    return other.unionByName(equal)


def at_once(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Runs writes that do not need each other at the same time: the tasks of one fill the
    cores that another leaves idle. The first failure is raised when all have ended."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            done.result()


def once(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Published records without the repeats of replayed batches; records without a name
    stay. As a stream it remembers the names of all records, unless the caller bounds
    that by a watermark."""
    batch, row = [F.get_json_object(value_col, f"$.{f}") for f in (RECORD_BATCH, RECORD_ROW)]
    named = records.withColumns({"_batch": batch, "_row": row})
    return (named.filter("_row is not null").dropDuplicates(["_batch", "_row"])
            .unionByName(named.filter("_row is null")).drop("_batch", "_row"))


_DATE = r"date=\d{4}-\d\d-\d\d"


def expire_dates(spark: SparkSession, path: str, today: datetime.date, keep_days: int) -> list[str]:
    """Deletes the folders of dates older than ``keep_days`` of a table laid out by
    date, compacted or not, and says which."""
    gone, oldest = set(), today - datetime.timedelta(days=keep_days)
    for table in (path, f"{path.rstrip('/')}-daily"):
        fs, p = _fs(spark, table)
        for st in fs.listStatus(p) if fs.exists(p) else []:
            name = st.getPath().getName()
            if re.fullmatch(_DATE, name) and datetime.date.fromisoformat(name[5:]) < oldest:
                fs.delete(st.getPath(), True)
                gone.add(name[5:])
    return sorted(gone)


def compact_dates(spark: SparkSession, path: str, before: datetime.date) -> list[str]:
    """Writes the batch folders of each date below ``before`` as one part of the table
    ``<path>-daily``, then deletes those that it read, and says which dates. A writer may go
    on beside it: what it adds to such a date stays a batch folder. Readers use
    ``read_dated``, which sees every row once at any moment, also if this stops half
    way and is run again."""
    fs, root = _fs(spark, path)
    jpath, done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, []
    for st in fs.listStatus(root) if fs.exists(root) else []:
        name = st.getPath().getName()
        if not re.fullmatch(_DATE, name) or datetime.date.fromisoformat(name[5:]) >= before:
            continue
        daily = f"{path.rstrip('/')}-daily/{name}"
        batches = [x.getPath() for x in fs.listStatus(st.getPath())]
        if not fs.exists(jpath(daily, "_SUCCESS")):
            rows = spark.read.option("basePath", st.getPath().toString()).parquet(*[b.toString() for b in batches])
            rows.coalesce(max(1, len(rows.inputFiles()) // 64)).write.mode("overwrite").parquet(daily)
            done.append(name[5:])
        held = {f"batch_id={r.batch_id}" for r in spark.read.parquet(daily).select("batch_id").distinct().collect()}
        for b in batches:
            if b.getName() in held:
                fs.delete(b, True)
    return sorted(done)


def read_dated(spark: SparkSession, path: str) -> DataFrame:
    """A table laid out by date and batch, and what ``compact_dates`` made of it."""
    fs, daily = _fs(spark, f"{path.rstrip('/')}-daily")
    batches = None
    if _holds_files(spark, path):
        batches = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if not fs.exists(daily):
        return batches
    days = spark.read.parquet(daily.toString()).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    if batches is None:
        return days
    # a part that is compacted but not deleted yet
    return days.unionByName(batches.join(days.select("date", "batch_id").distinct(), ["date", "batch_id"], "left_anti"))


def _holds_files(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.listFiles(p, True).hasNext()


def prune_batches(spark: SparkSession, path: str, keep: int = 3) -> None:
    """Deletes all but the newest ``keep`` versions of a versioned table, so
    that neither its size nor its listing grows with the number of batches."""
    for old in list_batches(spark, path)[:-keep]:
        fs, p = _fs(spark, os.path.join(path, f"batch_id={old}"))
        fs.delete(p, True)


def write_dated_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """A micro-batch of a table laid out by date above batch, so that a date
    is one folder. A replayed batch replaces its own parts only."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch_id").parquet(path))


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for one run."""
    return state_dir(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_batches(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Ids above ``after`` of the complete batches of a ``write_batch`` table (Hadoop FS
    listing, so it works on shared storage as well as locally); only those are looked
    into."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch_id=") and int(name.split("=", 1)[1]) > after and \
                fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)
