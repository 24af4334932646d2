"""Record schemas of the six streams and two derived tables (Spark DDL)."""

from __future__ import annotations

from pyspark.sql import types as T

ORDER_DDL = ("order_id string, ts bigint, account_id string, symbol string, side string, "
             "qty int, price double, strategy string")

SIGNAL_DDL = ("account_id string, order_count bigint, total_notional double, avg_notional double, "
              "unique_symbols bigint, max_symbol string, top_symbol string, top_symbol_share double, "
              "window_start timestamp, window_end timestamp, ts bigint")

COMMAND_DDL = ("cmd_id string, ts bigint, scope string, action string, reason string, "
               "triggered_by string, metric string, value double, corr_id string")

STATE_DDL = ("scope string, status string, updated_ts bigint, updated_by string, reason string, "
             "last_cmd_id string, corr_id string")

AUDIT_DDL = ("ts bigint, decision string, order_id string, account_id string, symbol string, "
             "scope_matches array<string>, killswitch_status string, reason string, "
             "corr_id string, service string")

OPERATOR_REQUEST_DDL = "request_id string, ts bigint, path string, scope string, reason string, operator string"


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(),
          "double": T.DoubleType(), "timestamp": T.TimestampType(),
          "array<string>": T.ArrayType(T.StringType())}


def ddl_schema(ddl: str) -> T.StructType:
    """Flat 'name type, ...' lists as used above (no session needed)."""
    fields = []
    for part in ddl.split(", "):
        name, typ = part.strip().split(" ", 1)
        fields.append(T.StructField(name, _TYPES[typ.strip()], True))
    return T.StructType(fields)


ORDER_SCHEMA = ddl_schema(ORDER_DDL)
COMMAND_SCHEMA = ddl_schema(COMMAND_DDL)
STATE_SCHEMA = ddl_schema(STATE_DDL)
AUDIT_SCHEMA = ddl_schema(AUDIT_DDL)

ORDER_COLUMNS = [f.name for f in ORDER_SCHEMA.fields]
COMMAND_COLUMNS = [f.name for f in COMMAND_SCHEMA.fields]
STATE_COLUMNS = [f.name for f in STATE_SCHEMA.fields]
AUDIT_COLUMNS = [f.name for f in AUDIT_SCHEMA.fields]
