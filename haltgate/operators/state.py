"""Command -> state fold, compaction view, change detection, kill intervals,
reset-all and the scope board.

Latest-per-key uses ``max_by`` with a (ts, cmd_id) ordering: a declarative
aggregate with a map-side partial step, so a hot scope (GLOBAL) is reduced per
task before the shuffle. Arrival order decided the winner in the reference;
``(updated_ts, last_cmd_id)`` is used here so replays are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (ACTION_UNKILL, STATE_TTL_DAYS, STATUS_ACTIVE, STATUS_KILLED,
                                 STATUS_UNKNOWN, UPDATED_BY_DEFAULT, stable_id, status_of,
                                 ttl_epoch_seconds)
from ..schemas import COMMAND_COLUMNS, STATE_COLUMNS, STATE_SCHEMA
from .sequence import SEQ_BUCKET_MS, day_bucket, neighbour_in_key

# Scopes the reference dashboard always shows.
WATCHED_SCOPES = ["GLOBAL", "SYMBOL:AAPL", "SYMBOL:GOOGL", "SYMBOL:MSFT", "SYMBOL:TSLA",
                  "ACCOUNT:99999"]
# Reason of a reset, and the scopes it releases when none is KILLED.
RESET_REASON = "Dashboard cleanup"
RESET_DEFAULT_SCOPES = ["GLOBAL", "SYMBOL:AAPL", "ACCOUNT:99999"]


def state_records(commands: DataFrame) -> DataFrame:
    """One state record per command with a known action (KILL -> KILLED,
    UNKILL -> ACTIVE; others dropped). Missing fields get the aggregator's
    defaults; a missing correlation id gets a deterministic one."""
    return (commands.withColumn("_status", status_of("action"))
            .filter(F.col("_status").isNotNull() & F.col("scope").isNotNull())
            .select(
                F.col("scope"),
                F.col("_status").alias("status"),
                F.col("ts").alias("updated_ts"),
                F.coalesce(F.col("triggered_by"), F.lit(UPDATED_BY_DEFAULT)).alias("updated_by"),
                F.coalesce(F.col("reason"), F.lit("")).alias("reason"),
                F.col("cmd_id").alias("last_cmd_id"),
                F.coalesce(F.col("corr_id"), stable_id(F.lit("corr"), F.col("cmd_id")))
                 .alias("corr_id")))


def latest_by_key(df: DataFrame, key: str, order_cols: list[str]) -> DataFrame:
    """Latest row per key by ``order_cols`` (last write wins)."""
    others = [x for x in df.columns if x != key]
    return (df.groupBy(key)
            .agg(F.max_by(F.struct(*others), F.struct(*order_cols)).alias("_row"))
            .select(key, "_row.*"))


def fold_state(states: DataFrame) -> DataFrame:
    """State history -> snapshot: one row per scope."""
    return latest_by_key(states.select(*STATE_COLUMNS), "scope", ["updated_ts", "last_cmd_id"])


def compact(changelog: DataFrame, key: str, order_cols: list[str], value_col: str) -> DataFrame:
    """Log compaction: the latest record per key; a null value (tombstone)
    deletes the key."""
    return latest_by_key(changelog, key, order_cols).filter(F.col(value_col).isNotNull())


def state_from_log(records: DataFrame) -> DataFrame:
    """Bootstrap from the compacted state log: records ``(key, value,
    partition, offset)`` with JSON state values; the latest record per key
    by log position wins (a key always maps to one partition), a null value
    is a tombstone."""
    latest = compact(records.select("key", "value", "partition", "offset"), "key",
                     ["partition", "offset"], "value")
    parsed = latest.select(F.from_json("value", STATE_SCHEMA).alias("s")).select("s.*")
    return parsed.filter(F.col("scope").isNotNull()).select(*STATE_COLUMNS)


def status_changes(states: DataFrame, bucket_ms: int = SEQ_BUCKET_MS) -> DataFrame:
    """State records whose status differs from the scope's previous record
    (the first record of a scope counts as a change); adds ``prev_status``."""
    s = neighbour_in_key(states, "scope", ["updated_ts", "last_cmd_id"],
                         day_bucket("updated_ts", bucket_ms), ["status"], "prev", "_prev")
    return (s.withColumn("prev_status", F.col("_prev.status")).drop("_prev")
            .filter(F.col("prev_status").isNull() | (F.col("prev_status") != F.col("status"))))


def kill_intervals(states: DataFrame, bucket_ms: int = SEQ_BUCKET_MS) -> DataFrame:
    """KILLED periods: a KILL change paired with the next status change of the
    scope (necessarily an UNKILL); open periods have null end and duration.

    One pass over the history: the next change after a KILLED change is the
    first ACTIVE record after it, so the previous status (change detection)
    and that end come from windows over (scope, minute) and one per-bucket
    summary that stitches both across bucket edges. "The first ACTIVE record
    after" is read in descending order as the last one before: a frame that
    grows row by row, so a window costs as much as its rows."""
    order = ["updated_ts", "last_cmd_id"]
    rec = F.struct("updated_ts", "last_cmd_id")
    active = F.when(F.col("status") != STATUS_KILLED, rec)
    d = states.withColumn("_bk", day_bucket("updated_ts", bucket_ms))
    w = Window.partitionBy("scope", "_bk").orderBy(*order)
    back = (Window.partitionBy("scope", "_bk").orderBy(*[F.desc(o) for o in order])
            .rowsBetween(Window.unboundedPreceding, -1))
    d = (d.withColumn("_prev", F.lag("status").over(w))
         .withColumn("_end", F.last(active, ignorenulls=True).over(back)))
    by_bucket = Window.partitionBy("scope").orderBy("_bk")
    buckets_back = (Window.partitionBy("scope").orderBy(F.desc("_bk"))
                    .rowsBetween(Window.unboundedPreceding, -1))
    summary = (d.groupBy("scope", "_bk")
               .agg(F.max_by("status", rec).alias("_last"), F.min(active).alias("_first_active"))
               .select("scope", "_bk",
                       F.lag("_last").over(by_bucket).alias("_carry_prev"),
                       F.last("_first_active", ignorenulls=True).over(buckets_back)
                        .alias("_carry_end")))
    j = (d.join(summary, ["scope", "_bk"], "left")
         .withColumn("_prev", F.coalesce("_prev", "_carry_prev"))
         .withColumn("_end", F.coalesce("_end", "_carry_end")))
    opens = (F.col("status") == STATUS_KILLED) & (F.col("_prev").isNull()
                                                  | (F.col("_prev") != STATUS_KILLED))
    return (j.filter(opens)
            .select("scope",
                    F.col("updated_ts").alias("kill_ts"),
                    F.col("_end.updated_ts").alias("unkill_ts"),
                    (F.col("_end.updated_ts") - F.col("updated_ts")).alias("duration_ms"),
                    "reason", "updated_by",
                    F.col("last_cmd_id").alias("kill_cmd_id"),
                    F.col("_end.last_cmd_id").alias("unkill_cmd_id")))


def reset_all_commands(snapshot: DataFrame, ts_ms: int | None = None,
                       operator: str = "dashboard") -> DataFrame:
    """An UNKILL for every KILLED scope of the snapshot; for the default
    scopes when none is KILLED. Ids derive from the killing command (for
    default scopes from the newest record of the snapshot), so issuing the
    reset twice yields the same commands."""
    killed = snapshot.filter(F.col("status") == STATUS_KILLED).select("scope", "updated_ts", "last_cmd_id")
    newest = snapshot.agg(F.coalesce(F.max("updated_ts"), F.lit(0)).alias("updated_ts"),
                          F.max_by("last_cmd_id", F.struct("updated_ts", "last_cmd_id")).alias("last_cmd_id"),
                          F.count_if(F.col("status") == STATUS_KILLED).alias("_killed"))
    defaults = (newest.filter(F.col("_killed") == 0)
                .select(F.explode(F.array(*[F.lit(s) for s in RESET_DEFAULT_SCOPES])).alias("scope"),
                        "updated_ts", "last_cmd_id"))
    ts = F.col("updated_ts") + 1 if ts_ms is None else F.lit(ts_ms).cast("bigint")
    return (killed.unionByName(defaults)
            .select(stable_id(F.lit("reset"), "scope", "last_cmd_id").alias("cmd_id"),
                    ts.alias("ts"), "scope",
                    F.lit(ACTION_UNKILL).alias("action"),
                    F.lit(RESET_REASON).alias("reason"),
                    F.lit(operator).alias("triggered_by"),
                    F.lit(None).cast("string").alias("metric"),
                    F.lit(None).cast("double").alias("value"),
                    stable_id(F.lit("resetcorr"), "scope", "last_cmd_id").alias("corr_id"))
            .select(*COMMAND_COLUMNS))


def scope_board(snapshot: DataFrame, watched: list[str] | None = None) -> DataFrame:
    """Watched scopes ∪ known scopes, left-joined to the snapshot; a scope
    without state shows UNKNOWN. The watched list is a handful of literals."""
    spark = snapshot.sparkSession
    w = watched if watched is not None else WATCHED_SCOPES
    watched_df = spark.createDataFrame([(s,) for s in w], "scope string")
    scopes = watched_df.unionByName(snapshot.select("scope")).distinct()
    return (scopes.join(snapshot, "scope", "left")
            .select("scope",
                    F.coalesce(F.col("status"), F.lit(STATUS_UNKNOWN)).alias("status"),
                    "reason", "updated_ts", "updated_by",
                    F.col("scope").isin(*w).alias("watched")))


def active_kill_count(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count_if(F.col("status") == STATUS_KILLED).alias("active_kills"),
                        F.count(F.lit(1)).alias("known_scopes"))


def state_cache(snapshot: DataFrame, now_ms, ttl_days: int = STATE_TTL_DAYS) -> DataFrame:
    """Snapshot with ``expires_at`` (epoch s). Only ACTIVE rows expire: a KILL
    stays visible however old it is (the reference's cache let it vanish)."""
    now_s = F.floor(F.lit(now_ms) / 1000).cast("bigint") if not hasattr(now_ms, "alias") \
        else F.floor(now_ms / 1000).cast("bigint")
    return (snapshot.withColumn("expires_at", ttl_epoch_seconds("updated_ts", ttl_days))
            .filter((F.col("status") != STATUS_ACTIVE) | (F.col("expires_at") > now_s)))
