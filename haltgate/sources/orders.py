"""Order sources: JSON log decoding and the two views over the supplied tables.

*Event orders* (stream-like, one order per event) and *book orders*
(lineitem joined to orders and part, for volume) both produce the reference
order schema ``order_id, ts, account_id, symbol, side, qty, price, strategy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, event_time, notional_amount, to_epoch_ms
from ..schemas import ORDER_SCHEMA

# Side and strategy domains of the reference order generator.
SIDES = ["BUY", "SELL"]
STRATEGIES = ["ALGO_X", "ALGO_Y", "MANUAL", "SMART_ROUTER"]

# Fields without which a consumer cannot use an order: the detector needs its
# time and amount, the router decides on order, account and symbol alone.
REQUIRED_ORDER_FIELDS = ["order_id", "ts", "account_id", "symbol", "qty", "price"]
ROUTER_ORDER_FIELDS = ["order_id", "account_id", "symbol"]


def _strategy_of(key: Column) -> Column:
    idx = F.pmod(key, F.lit(len(STRATEGIES)))
    expr = None
    for i, s in enumerate(STRATEGIES):
        expr = F.when(idx == i, F.lit(s)) if expr is None else expr.when(idx == i, F.lit(s))
    return expr


def event_orders(events: DataFrame) -> DataFrame:
    """events -> orders: event_id is the order id, user the account, the event
    type the symbol, ``props.k`` the quantity and ``value`` the price."""
    qty = F.get_json_object("props", "$.k").try_cast("int")
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        to_epoch_ms("ts").alias("ts"),
        F.col("user_id").cast("string").alias("account_id"),
        F.upper("event_type").alias("symbol"),
        F.when(F.pmod(qty, F.lit(2)) == 0, F.lit(SIDES[0])).otherwise(F.lit(SIDES[1])).alias("side"),
        qty.alias("qty"),
        F.col("value").alias("price"),
        _strategy_of(F.col("user_id")).alias("strategy"),
    )


def book_orders(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """lineitem ⋈ orders ⋈ part -> orders: customer is the account, brand the
    symbol, order priority the strategy, order date the event time."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_returnflag")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    p = part.select("p_partkey", "p_brand")
    # the lines meet the parts first: the second shuffle carries one column of them, not three of the orders
    j = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        # A line is identified by order, line number, part and supplier.
        F.concat_ws("-", *[F.col(k).cast("string") for k in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("order_id"),
        to_epoch_ms("o_orderdate").alias("ts"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("p_brand").alias("symbol"),
        F.when(F.col("l_returnflag") == "R", F.lit("SELL")).otherwise(F.lit("BUY")).alias("side"),
        F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("o_orderpriority").alias("strategy"),
    )


def replayed(orders: DataFrame, start_ms: int, span_ms: int, step_ms: int = 3 * 3_600_000) -> DataFrame:
    """Book orders moved into the period [start, start + span): the order date
    modulo the span, and ``step_ms`` later for each line number (the second
    part of the order id). A fixed mapping, so that a book of other years
    meets the state history of the period."""
    line = F.split("order_id", "-").getItem(1).cast("bigint")
    return orders.withColumn("ts", F.lit(start_ms) + F.pmod(F.col("ts") + line * step_ms, F.lit(span_ms)))


def with_order_metrics(orders: DataFrame) -> DataFrame:
    """Adds ``notional`` (qty*price, an exact decimal) and ``event_time``."""
    return orders.withColumns({"notional": notional_amount("qty", "price"),
                               "event_time": event_time("ts")})


def decode_orders(raw: DataFrame, value_col: str = "value",
                  required: list[str] = REQUIRED_ORDER_FIELDS) -> tuple[DataFrame, DataFrame]:
    """JSON log records -> (orders, rejects).

    ``from_json`` in permissive mode turns malformed text into a null-filled
    struct; rows missing a field of ``required`` go to ``rejects`` with the
    raw text instead of becoming null-key rows downstream. So do, where quantity
    and price are required, rows whose amount is out of range or no number
    (``notional`` among the missing fields).
    """
    parsed = raw.select(F.col(value_col).cast("string").alias("raw"),
                        F.from_json(F.col(value_col).cast("string"), ORDER_SCHEMA).alias("o"))
    faults = [F.when(F.col(f"o.{f}").isNull(), F.lit(f)) for f in required]
    if {"qty", "price"} <= set(required):
        priced = F.col("o.qty").isNotNull() & F.col("o.price").isNotNull()
        faults.append(F.when(priced & notional_amount("o.qty", "o.price").isNull(), F.lit("notional")))
    return split_records(parsed, "o", faults)


def split_records(parsed: DataFrame, record: str, faults: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(records without a fault, raw text and faults of the others); a fault is a name,
    or null where the record does not have it."""
    marked = parsed.withColumn("missing_fields", F.concat_ws(",", F.array_compact(F.array(*faults))))
    return (marked.filter(F.col("missing_fields") == "").select(f"{record}.*"),
            marked.filter(F.col("missing_fields") != "").select("raw", "missing_fields"))


def split_valid_orders(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orders with every required field, orders missing one)."""
    ok = None
    for f in REQUIRED_ORDER_FIELDS:
        cond = F.col(f).isNotNull()
        ok = cond if ok is None else ok & cond
    return orders.filter(ok), orders.filter(~ok)


def to_keyed_json(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """(key, value) pairs for a log sink: key = ``key_col``, else ``account_id``
    when present, else the first column as text; value = the row as JSON."""
    if key_col is None:
        key_col = "account_id" if "account_id" in df.columns else df.columns[0]
    return df.select(F.col(key_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[c(x) for x in df.columns])).alias("value"))

