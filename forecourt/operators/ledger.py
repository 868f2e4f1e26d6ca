"""A stored stock ledger with a checkpoint for each month.

Movements are kept by month; the checkpoint of a month is its net quantity per part, so
the balance of a day is the sum of the checkpoints before its month and of that month's
movements up to the day: no other movements are read.  A batch of movements, back-dated
ones included, rewrites the months it touches and their checkpoints, behind a manifest;
later checkpoints need no correction, as they hold their own month only.  Movements
have an id: one that comes again replaces itself, so a batch that is applied twice changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.sources import generations

COLUMNS = ["movement_id", "part_number", "signed_qty", "movement_ts"]
_MONTH = "month"


def _month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def post(batch: DataFrame, store: str) -> None:
    """Add movements (id, part, signed quantity, time) to the ledger and correct the checkpoints
    of their months.  Movements without id, part or time are left out (they are quarantined before)."""
    spark = batch.sparkSession
    rows = batch.select(*COLUMNS).where("movement_id is not null and part_number is not null and movement_ts is not null")
    rows = rows.withColumn(_MONTH, _month(F.col("movement_ts")))
    months = [r[0] for r in rows.select(_MONTH).distinct().collect()]  # calendar months
    if not months:
        return
    old = generations.read(spark, f"{store}/movements", _MONTH, months)
    if old is not None:
        old = old.withColumn(_MONTH, _month(F.col("movement_ts")))
        rows = old.join(rows.select("movement_id", _MONTH), ["movement_id", _MONTH], "left_anti").select(*COLUMNS, _MONTH).unionByName(rows)
    rows = rows.dropDuplicates(["movement_id", _MONTH])
    generations.replace(spark, f"{store}/movements", rows.repartition(_MONTH, F.pmod(F.xxhash64("movement_id"), F.lit(8))), _MONTH, months)
    net = generations.read(spark, f"{store}/movements", _MONTH, months).withColumn(_MONTH, _month(F.col("movement_ts")))
    net = net.groupBy(_MONTH, "part_number").agg(F.sum("signed_qty").cast("bigint").alias("net_qty"))
    generations.replace(spark, f"{store}/checkpoints", net.repartition(_MONTH), _MONTH, months)


def balances(spark: SparkSession, store: str, day: str) -> DataFrame:
    """(part_number, on_hand) at the end of ``day`` (yyyy-MM-dd) of every part that had a movement until then."""
    month = day[:7]
    before = [m for m in generations.current(spark, f"{store}/checkpoints")["parts"] if m < month]
    parts = []
    if before:
        parts.append(generations.read(spark, f"{store}/checkpoints", _MONTH, before).select("part_number", F.col("net_qty").alias("q")))
    tail = generations.read(spark, f"{store}/movements", _MONTH, [month])
    if tail is not None:
        end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")
        parts.append(tail.where(F.col("movement_ts") < end).select("part_number", F.col("signed_qty").cast("bigint").alias("q")))
    if not parts:
        return spark.createDataFrame([], "part_number string, on_hand long")
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy("part_number").agg(F.sum("q").cast("bigint").alias("on_hand"))
