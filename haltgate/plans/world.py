"""End-to-end batch plans over the supplied tables.

events -> orders -> signals -> kill commands ─┐
events -> operator commands + console requests ┴-> command log -> state
history -> snapshot / intervals -> gate (as-of) -> audit -> reports.

The command log is checkpointed and the gate counts its state side when a
plan is built; nothing is collected but scalars (sizes of tables).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ACCOUNT_PREFIX
from ..operators.breaches import kill_commands
from ..operators.gate import gate_asof
from ..operators.signals import risk_signals
from ..operators.state import fold_state, state_records
from ..params import EVENT_PARAMS, REPLAY_SPAN_MS, REPLAY_START_MS, RiskParams
from ..schemas import COMMAND_COLUMNS
from ..session import state_dir
from ..sources.commands import command_log, event_commands, operator_commands, operator_requests
from ..sources.orders import book_orders, event_orders, replayed
from ..sources.tables import Tables


def store_audit(audit: DataFrame, path: str) -> None:
    """Audit rows by date; within a date clustered and sorted by account."""
    dated = audit.withColumn("date", F.to_date(F.timestamp_millis("ts")))
    (dated.repartitionByRange("date", "account_id").sortWithinPartitions("date", "account_id", "ts")
     .write.partitionBy("date").parquet(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("date")


def _is_number(column: str, text: str) -> Column:
    """Whether a whole-number column reads as ``text``: a comparison that reaches the scan."""
    try:
        number = int(text)
    except ValueError:
        return F.lit(False)
    return F.col(column) == F.lit(number) if str(number) == text and abs(number) < 2**63 else F.lit(False)


def _memo(fn):
    """Build each derived DataFrame once per World (plans are immutable)."""
    name = "_memo_" + fn.__name__

    def wrapper(self):
        if name not in self.__dict__:
            self.__dict__[name] = fn(self)
        return self.__dict__[name]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


class World:
    """The derived tables of one data directory. Nothing is kept from one World to
    the next; ``audit_path`` names an audit that ``save_audit`` stored before, which
    reports then read as it is, whatever the tables hold by now."""

    def __init__(self, spark: SparkSession, sf_dir: str, params: RiskParams = EVENT_PARAMS, audit_path: str | None = None):
        self.t = Tables(spark, sf_dir)
        self.params = params
        self.audit_path = audit_path

    @_memo
    def orders(self) -> DataFrame:
        return event_orders(self.t.events)

    @_memo
    def book_orders(self) -> DataFrame:
        return book_orders(self.t.lineitem, self.t.orders, self.t.part)

    @_memo
    def signals(self) -> DataFrame:
        return risk_signals(self.orders(), self.params)

    @_memo
    def detector_commands(self) -> DataFrame:
        return kill_commands(self.signals(), self.params)

    @_memo
    def requests(self) -> DataFrame:
        return operator_requests(self.t.events)

    @_memo
    def operator_commands(self) -> DataFrame:
        return event_commands(self.t.events).unionByName(operator_commands(self.requests()))

    @_memo
    def commands(self) -> DataFrame:
        """The command log, materialised once (reliable checkpoint in the
        shared checkpoint folder): state, intervals, traces and reports all
        read it, and the control plane is small next to the order flow."""
        return command_log(self.detector_commands().select(*COMMAND_COLUMNS),
                           self.operator_commands()).checkpoint()

    @_memo
    def states(self) -> DataFrame:
        return state_records(self.commands())

    @_memo
    def snapshot(self) -> DataFrame:
        return fold_state(self.states())

    @_memo
    def audit(self) -> DataFrame:
        return gate_asof(self.orders(), self.states())

    def save_audit(self) -> str:
        """Gates the orders and stores the audit; the path is for ``audit_path`` of
        later Worlds."""
        path = state_dir(self.t.spark, f"audit-{uuid.uuid4().hex[:12]}")
        store_audit(self.audit(), path)
        return path

    @_memo
    def stored_audit(self) -> DataFrame:
        """The audit as a table: a folder for each date, clustered by account, so
        that lookups push their predicate to the files they need. Without an
        ``audit_path`` this World's own, gated and stored on first use."""
        return read_audit(self.t.spark, self.audit_path or self.save_audit())

    @_memo
    def reported_audit(self) -> DataFrame:
        """What a report over all orders reads: the audit at ``audit_path``, or the
        gate's rows as they come; one pass over them is not worth a table."""
        return self.stored_audit() if self.audit_path else self.audit()

    def audit_of(self, order_id: str | None = None, account_id: str | None = None) -> DataFrame:
        """The audit of one order or account. A decision needs only the order and the state,
        so the key is looked up in the source, before the gate; from an audit at
        ``audit_path`` it is read."""
        if self.audit_path:
            found = self.stored_audit()
            found = found if order_id is None else found.filter(F.col("order_id") == order_id)
            return found if account_id is None else found.filter(F.col("account_id") == account_id)
        events, states = self.t.events, self.states()
        if order_id is not None:
            events = events.filter(_is_number("event_id", order_id))
        if account_id is not None:
            events = events.filter(_is_number("user_id", account_id))
            states = states.filter(~F.col("scope").startswith(ACCOUNT_PREFIX) | (F.col("scope") == ACCOUNT_PREFIX + account_id))
        return gate_asof(event_orders(events), states)

    @_memo
    def book_audit(self) -> DataFrame:
        """Gate at volume: the book replayed within the period of the commands."""
        return gate_asof(replayed(self.book_orders(), REPLAY_START_MS, REPLAY_SPAN_MS), self.states())
