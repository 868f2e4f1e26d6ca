"""Scans of the driver's Parquet tables (S11); upstream results are passed
between jobs as DataFrame arguments (S12).

Readers return lazy DataFrames; Catalyst prunes columns and pushes filters
into the Parquet scan, so callers should select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


# A session may name here into how many partitions a scan is dealt; unset (the
# default, and right for tables of many files) a scan is read as it lies.
SPREAD_CONF = "spark.forecourt.scan.partitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table.

    A table in a single file with a single row group gives one split, and all
    work up to the first shuffle runs in one task.  Who knows that of an input
    sets ``SPREAD_CONF``; no size is looked up and no job runs here.
    """
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    parts = spark.conf.get(SPREAD_CONF, None)
    return df.repartition(int(parts)) if parts else df


class Tables:
    """Attribute access to the star tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str = DEFAULT_SF_DIR):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
