"""Command and operator-request sources derived from the supplied tables.

Operator commands come from ``events``: an ``error`` event is an operator
KILL, a ``signup`` an UNKILL, a ``click`` with ``props.k >= 99`` an unknown
action (PAUSE) that the aggregator must ignore. Most commands target the
event's account; a fixed share targets a symbol or the GLOBAL scope.
Operator HTTP requests (path, scope, reason, operator) come from events with
``props.k >= 96``; their scopes include missing and malformed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (ACTION_KILL, ACTION_UNKILL, OPERATOR_DEFAULT,
                                 ERR_PATH_UNKNOWN, REASON_OPERATOR_DEFAULT, SCOPE_GLOBAL, c, scope_error,
                                 stable_id, to_epoch_ms)
from ..schemas import COMMAND_COLUMNS, COMMAND_SCHEMA
from .orders import split_records

EVENT_SYMBOLS = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _pick(idx: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(idx == i, F.lit(v)) if expr is None else expr.when(idx == i, F.lit(v))
    return expr


def event_commands(events: DataFrame) -> DataFrame:
    """events -> operator command log (reference command schema)."""
    k = _k()
    eid = F.col("event_id")
    action = (F.when(F.col("event_type") == "error", F.lit(ACTION_KILL))
              .when(F.col("event_type") == "signup", F.lit(ACTION_UNKILL))
              .when((F.col("event_type") == "click") & (k >= 99), F.lit("PAUSE")))
    scope = (F.when(F.pmod(eid, F.lit(1000)) == 7, F.lit(SCOPE_GLOBAL))
             .when(F.pmod(eid, F.lit(40)) == 3,
                   F.concat(F.lit("SYMBOL:"), _pick(F.pmod(k, F.lit(5)), EVENT_SYMBOLS)))
             .otherwise(F.concat(F.lit("ACCOUNT:"), F.col("user_id").cast("string"))))
    reason = (F.when(F.pmod(k, F.lit(10)) == 0, F.lit(""))
              .when(action == ACTION_KILL, F.concat(F.lit("Operator kill after error event "),
                                                    eid.cast("string")))
              .when(action == ACTION_UNKILL, F.concat(F.lit("Operator release after signup event "),
                                                      eid.cast("string")))
              .otherwise(F.lit("Operator pause request")))
    ev = events.withColumn("_action", action).filter(F.col("_action").isNotNull())
    return ev.select(
        stable_id(F.lit("cmd"), eid).alias("cmd_id"),
        to_epoch_ms("ts").alias("ts"),
        scope.alias("scope"),
        F.col("_action").alias("action"),
        reason.alias("reason"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None).cast("string"))
         .otherwise(F.lit("ops-console")).alias("triggered_by"),
        F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast("double").alias("value"),
        F.when(F.pmod(k, F.lit(11)) == 0, F.lit(None).cast("string"))
         .otherwise(stable_id(F.lit("corr"), eid)).alias("corr_id"),
    )


# Fields without which the aggregator cannot use a command.
REQUIRED_COMMAND_FIELDS = ["cmd_id", "scope", "action"]


def decode_commands(raw: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON log records -> (commands, rejects), as ``decode_orders``."""
    text = F.col(value_col).cast("string")
    parsed = raw.select(text.alias("raw"), F.from_json(text, COMMAND_SCHEMA).alias("c"))
    return split_records(parsed, "c", [F.when(F.col(f"c.{f}").isNull(), F.lit(f)) for f in REQUIRED_COMMAND_FIELDS])


def command_log(detector_commands: DataFrame, operator_commands: DataFrame) -> DataFrame:
    """Full command history: detector KILLs and operator commands."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in COMMAND_SCHEMA.fields]
    return detector_commands.select(*cols).unionByName(operator_commands.select(*cols))


def operator_requests(events: DataFrame) -> DataFrame:
    """events -> operator console requests (request_id, ts, path, scope, reason, operator)."""
    k = _k()
    et = F.col("event_type")
    path = (F.when(et == "view", F.lit("/unkill"))
            .when(et == "click", F.lit("/pause"))
            .otherwise(F.lit("/kill")))
    uid = F.col("user_id").cast("string")
    scope = (F.when(k == 96, F.lit(None).cast("string"))
             .when(k == 97, F.lit(""))
             .when(k == 98, F.concat(F.lit("account:"), uid))
             .when(F.pmod(F.col("event_id"), F.lit(9)) == 0, F.lit(SCOPE_GLOBAL))
             .when(F.pmod(F.col("event_id"), F.lit(9)) == 1, F.lit("ACCOUNT:"))
             .otherwise(F.concat(F.lit("ACCOUNT:"), uid)))
    return (events.filter(k >= 96).select(
        F.col("event_id").cast("string").alias("request_id"),
        to_epoch_ms("ts").alias("ts"),
        path.alias("path"),
        scope.alias("scope"),
        F.when(F.pmod(F.col("event_id"), F.lit(2)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Console request "), F.col("event_id").cast("string")))
         .alias("reason"),
        F.when(F.pmod(F.col("user_id"), F.lit(3)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("op-"), F.pmod(F.col("user_id"), F.lit(3)).cast("string")))
         .alias("operator")))


def validate_requests(requests: DataFrame, include_strategy: bool = False) -> DataFrame:
    """Adds ``status_code`` and ``error``: 400 for a missing or malformed
    scope, 404 for an unknown path, 200 otherwise."""
    err = scope_error("scope", include_strategy)
    path_ok = F.col("path").isin("/kill", "/unkill")
    return (requests
            .withColumn("error", F.coalesce(err, F.when(~path_ok, F.lit(ERR_PATH_UNKNOWN))))
            .withColumn("status_code", F.when(err.isNotNull(), F.lit(400))
                        .when(~path_ok, F.lit(404)).otherwise(F.lit(200))))


def operator_commands(requests: DataFrame, include_strategy: bool = False) -> DataFrame:
    """Valid requests -> commands with the console's defaults
    (reason 'Manual operator action', operator 'api' as ``triggered_by``)."""
    v = validate_requests(requests, include_strategy).filter(F.col("status_code") == 200)
    return v.select(
        stable_id(F.lit("op"), "request_id").alias("cmd_id"),
        c("ts"),
        c("scope"),
        F.when(F.col("path") == "/kill", F.lit(ACTION_KILL)).otherwise(F.lit(ACTION_UNKILL))
         .alias("action"),
        F.coalesce(c("reason"), F.lit(REASON_OPERATOR_DEFAULT)).alias("reason"),
        F.coalesce(c("operator"), F.lit(OPERATOR_DEFAULT)).alias("triggered_by"),
        F.lit(None).cast("string").alias("metric"),
        F.lit(None).cast("double").alias("value"),
        stable_id(F.lit("opcorr"), "request_id").alias("corr_id"),
    ).select(*COMMAND_COLUMNS)


def rejected_requests(requests: DataFrame) -> DataFrame:
    v = validate_requests(requests).filter(F.col("status_code") != 200)
    return v.select("request_id", "ts", "path", "scope", "status_code", "error")
