"""Slowly changing dimension, type 2, from a change stream.

A new version starts whenever the tracked attributes differ from the
previous row of the same key; ``valid_to`` is the start of the next version
and ``is_current`` marks the open one.  Built on the bucketed sequential
operators, so a hot key does not land in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.sequential import next_value, previous_value
from forecourt.sources import generations


def scd2(df: DataFrame, key: str, ts: str, tie: str, attrs: list[str], unit: str = "day") -> DataFrame:
    a = df.select(key, ts, tie, *attrs).withColumn("_attrs", F.struct(*attrs))
    p = previous_value(a, key, ts, tie, "_attrs", out="_prev", unit=unit)
    changes = p.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_attrs")))
    v = next_value(changes, key, ts, tie, ts, out="valid_to", unit=unit)
    return v.select(key, *attrs, F.col(ts).alias("valid_from"), "valid_to",
                    F.col("valid_to").isNull().alias("is_current"))


# ------------------------------------------------------- a stored history
BUCKETS = 64


def _derived(events: DataFrame, key: str, ts: str, tie: str, attrs: list[str], unit: str) -> DataFrame:
    """All events with ``is_start`` and, for those that start a version, ``valid_to``."""
    a = events.withColumn("_attrs", F.struct(*attrs))
    p = previous_value(a, key, ts, tie, "_attrs", out="_prev", unit=unit)
    p = p.withColumn("is_start", F.col("_prev").isNull() | (F.col("_prev") != F.col("_attrs")))
    starts = next_value(p.where("is_start"), key, ts, tie, ts, out="valid_to", unit=unit)
    others = p.where("not is_start").withColumn("valid_to", F.lit(None).cast(events.schema[ts].dataType))
    columns = [key, ts, tie, *attrs, "is_start", "valid_to"]
    return starts.select(*columns).unionByName(others.select(*columns))


def merge_history(batch: DataFrame, store: str, key: str, ts: str, tie: str, attrs: list[str], unit: str = "day",
                  buckets: int = BUCKETS) -> None:
    """Apply a batch of changes, late and repeated ones included, to a stored type-2 history.

    The store keeps every distinct event, also those that confirm a version, because a
    late change may come between the two.  Only the versions of the batch's keys are derived
    anew and only the buckets of those keys are rewritten; ``history`` sees the batch as
    a whole or not at all.  Any order of the batches gives the result of ``scd2``, and
    a batch that is applied twice changes nothing.  Rows without a key are left out.
    """
    spark = batch.sparkSession
    events = batch.where(F.col(key).isNotNull()).select(key, ts, tie, *attrs).distinct()
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    touched = [r[0] for r in events.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    old, untouched = generations.read(spark, store, "bucket", touched), None
    if old is not None:
        old, mine = old.drop("bucket"), events.select(key).distinct()
        untouched = old.join(mine, key, "left_anti")
        events = events.unionByName(old.join(mine, key, "left_semi").select(*events.columns)).distinct()
    rows = _derived(events, key, ts, tie, attrs, unit)
    rows = rows if untouched is None else rows.unionByName(untouched)
    generations.replace(spark, store, rows.withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64(key, ts), F.lit(4))),
                        "bucket", touched)


def history(spark: SparkSession, store: str, key: str, ts: str, attrs: list[str]) -> DataFrame:
    """The stored versions, as ``scd2`` gives them."""
    rows = generations.read(spark, store, "bucket").where("is_start")
    return rows.select(key, *attrs, F.col(ts).alias("valid_from"), "valid_to", F.col("valid_to").isNull().alias("is_current"))
