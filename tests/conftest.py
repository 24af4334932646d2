import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from haltgate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8, app_name="haltgate-tests")
    yield s


ORDER_COLS = "order_id string, ts bigint, account_id string, symbol string, side string, qty int, price double, strategy string"
CMD_COLS = ("cmd_id string, ts bigint, scope string, action string, reason string, triggered_by string, "
            "metric string, value double, corr_id string")


def orders_df(spark, rows):
    return spark.createDataFrame(rows, ORDER_COLS)


def commands_df(spark, rows):
    return spark.createDataFrame(rows, CMD_COLS)


def ms(h, m, s, ms_=0, day=1):
    """2024-01-<day> h:m:s.ms UTC in epoch ms."""
    return 1704067200000 + (day - 1) * 86400000 + ((h * 60 + m) * 60 + s) * 1000 + ms_
