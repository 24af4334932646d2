"""Helpers shared by the operators: shared-folder tables, key ranges, text rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

#: Whitespace of every word definition here: space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
MIN_LONG = -(2**63)


class Scratch:
    """The folders and tables made since it was opened."""

    def __init__(self):
        self.paths: list[str] = []
        self.tables: list[str] = []
        self.kept: set[str] = set()

    def keep_last(self) -> str:
        self.kept.add(self.paths[-1])
        return self.paths[-1]


_OPEN: list[Scratch] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """Deletes the folders and tables that are made inside when it ends, but those kept: for
    callers that store an operator's result inside, so that nothing reads them afterwards."""
    made = Scratch()
    _OPEN.append(made)
    try:
        yield made
    finally:
        _OPEN.remove(made)
        for table in made.tables:
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        for path in set(made.paths) - made.kept:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    for made in _OPEN:
        made.paths.append(path)
    return path


def write_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """Writes ``df`` in the shared folder, in sorted buckets of ``key``, as a table of the
    catalog, so that joins on the key move only their other side."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    for made in _OPEN:
        made.tables.append(table)
    (df.write.option("compression", "zstd").option("path", path).format("parquet")
     .bucketBy(shuffle_partitions(spark), key).sortBy(key).saveAsTable(table))
    return spark.table(table)


def write_table(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and reads it back: lineage ends
    there, and executors lost later cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text (null: empty), whatever else the input carries."""
    return docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def let(value: Column, use) -> Column:
    """Binds ``value`` once for ``use``: an expression captured by a lambda would be
    evaluated again for every element."""
    return F.transform(F.array(value), use)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass(frozen=True)
class KeyRanges:
    """Contiguous ranges of an ascending long key. ``starts[i]`` is the least key of
    range i and occurs in the data; nulls sort before every key."""

    starts: tuple[int, ...]

    @classmethod
    def of(cls, df: DataFrame, key: str, n: int) -> KeyRanges:
        """About ``n`` even ranges from one pass over the key column. The driver gets
        at most ``n`` numbers, whatever the size of the table."""
        k = F.coalesce(F.col(key).cast("long"), F.lit(MIN_LONG))
        probs = F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5))
        row = df.agg(F.min(k).alias("lo"), F.percentile_approx(k, probs, max(10_000, 10 * n)).alias("q")).first()
        if row is None or row.lo is None:
            return cls((MIN_LONG,))
        return cls(tuple(sorted({row.lo, *(row.q if n > 1 else [])})))

    def index(self, key: Column) -> Column:
        """The range of a key; only the key column crosses into Python."""
        starts = np.array(self.starts, dtype=np.int64)

        @F.pandas_udf("int")
        def find(keys: pd.Series) -> pd.Series:
            k = keys.fillna(MIN_LONG).to_numpy(dtype=np.int64)
            return pd.Series(np.maximum(np.searchsorted(starts, k, side="right") - 1, 0).astype(np.int32))

        return find(F.coalesce(key.cast("long"), F.lit(MIN_LONG)))

    def heads(self, key: Column) -> Column:
        """Whether the key starts its range."""
        starts = np.array(self.starts, dtype=np.int64)

        @F.pandas_udf("boolean")
        def find(keys: pd.Series) -> pd.Series:
            k = keys.to_numpy(dtype=np.int64)
            at = np.minimum(np.searchsorted(starts, k), len(starts) - 1)
            return pd.Series(starts[at] == k)

        return find(F.coalesce(key.cast("long"), F.lit(MIN_LONG)))


def numbered(rows: DataFrame, group: str, order: list[str], drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows``, without ``drop``, with ``i``, the row's number within its ``group`` (never
    null) by ``order``, nulls first, and ``n``, the group's rows. Rows are dealt by ranges
    of (group, order), so a large group is spread over tasks; the counts of the groups'
    parts in each partition tell where a part begins."""
    by = [group, *[F.col(c).asc_nulls_first() for c in order]]
    placed = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    placed = write_table(placed.withColumn("spot", F.monotonically_increasing_id()).drop(*drop), "numbered")
    part = F.shiftrightunsigned("spot", 33).alias("part")
    runs = placed.groupBy(group, part).agg(F.min("spot").alias("first"), F.count("*").alias("size"))
    all_ = Window.partitionBy(group)
    before = F.sum("size").over(all_.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    starts = write_table(runs.select(group, "part", "first", before.alias("before"), F.sum("size").over(all_).alias("n")), "runs")
    return (placed.withColumn("part", part).join(starts, [group, "part"])
            .withColumn("i", F.col("spot") - F.col("first") + F.col("before")).drop("spot", "first", "before", "part"))


#: A key with more than one in so many of all rows is met by broadcast: fewer keys than this.
HOT_SHARE = 1000


def join_counted(rows: DataFrame, table: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined to ``table``, which has one row for each ``key`` and the number of
    ``rows`` with it (``count``, dropped). Fewer than ``HOT_SHARE`` keys can each have more
    than that share of the rows: those are broadcast, so that no task gets a hot key's
    rows; all others meet by a shuffle. ``table`` should be written."""
    total = table.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT_SHARE > total
    few = F.broadcast(table.where(hot).drop(count))
    rest = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(table.where(~hot).drop(count), key)
    return rows.join(few, key).unionByName(rest)


def emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)


class Emitter:
    """Collects result rows and hands them on in batches of bounded bytes."""

    def __init__(self, schema: pa.Schema, max_rows: int = 20_000, max_bytes: int = 8 << 20):
        self.schema, self.max_rows, self.max_bytes = schema, max_rows, max_bytes
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 64) -> None:
        self.rows.append(row)
        self.bytes += size

    def full(self) -> bool:
        return len(self.rows) >= self.max_rows or self.bytes >= self.max_bytes

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield emit(self.rows, self.schema)
        self.rows, self.bytes = [], 0


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(ddl))
