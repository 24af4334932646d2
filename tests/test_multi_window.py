"""The stream over several window widths: one scan and one chain of aggregations for all."""

import random
import tempfile

from pyspark.sql import functions as F

from conftest import ORDER_COLS
from haltgate.operators import extensions as X
from haltgate.params import RiskParams
from haltgate.streaming.detector import multi_window_stream
from haltgate.streaming.io import file_stream

SPECS = [RiskParams(window=w, max_orders=n, max_notional=900.0 * n, max_share=0.6, min_orders=2, watermark=m)
         for w, n, m in (("10 minutes", 2, "1 minute"), ("1 hour", 4, "5 minutes"), ("1 day", 30, "1 minute"))]


def test_all_widths_share_a_scan_and_two_aggregations(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rnd, run, read, states = random.Random(5), tempfile.mkdtemp(prefix="widths-"), 0, set()
    rows = sorted((rnd.randrange(3 * 86_400_000), rnd.choice(["1", "2", "3", None]), rnd.choice(["A", "B", None]), rnd.choice([100.0, None])) for _ in range(900))
    rows.insert(0, (None, "1", "A", 100.0))
    rows = [(f"o{k:04d}", ts, account, symbol, "BUY", 1, price, "X") for k, (ts, account, symbol, price) in enumerate(rows)]
    try:
        for part in (rows[:450], rows[450:]):
            spark.createDataFrame(part, ORDER_COLS).write.mode("append").parquet(f"{run}/in")
            q = (multi_window_stream(file_stream(spark, f"{run}/in", ORDER_COLS), SPECS).writeStream.format("parquet").option("path", f"{run}/out")
                 .option("checkpointLocation", f"{run}/ck").trigger(availableNow=True).start())
            assert q.awaitTermination(120)
            read += sum(p["numInputRows"] for p in q.recentProgress)
            states |= {len(p["stateOperators"]) for p in q.recentProgress}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    orders = spark.createDataFrame(rows, ORDER_COLS)
    got, newest = spark.read.parquet(f"{run}/out"), max(r[1] for r in rows[1:])
    exp = X.multi_window_commands(orders, SPECS).filter(F.col("ts") <= newest - 300_000)  # the longest watermark
    assert sorted(map(str, got.select(exp.columns).collect())) == sorted(map(str, exp.collect()))
    assert {r.window_label for r in exp.collect()} == {"600s", "3600s", "86400s"}
    assert read == len(rows) and states == {2}
