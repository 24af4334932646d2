"""Parquet table access. Column pruning and filter pushdown reach the scan
because every operator selects its columns before anything else."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, ensure_utc

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(table_path(sf_dir, name))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).events``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            if name not in self._cache:
                self._cache[name] = read_table(self.spark, self.sf_dir, name)
            return self._cache[name]
        raise AttributeError(name)
