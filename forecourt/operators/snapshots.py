"""What changed between two full snapshots of a table.

Rows are compared by a digest of their compared columns.  Keys that a snapshot
has several times count once (the row with the greatest digest).  One full outer
join on the key; everything else is map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ADDED, CHANGED, WITHDRAWN, SAME = "added", "changed", "withdrawn", "same"


def digest(columns: list[str]):
    """Of the columns as text; a null differs from an empty text."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def one_per_key(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, row, digest) with the compared columns in a struct, null keys left out."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key), F.struct(*columns).alias("row"), digest(columns).alias("digest"))
    return rows.groupBy(key).agg(F.max_by("row", "digest").alias("row"), F.max("digest").alias("digest"))


def compare(before: DataFrame, after: DataFrame, key: str, columns: list[str], unchanged: bool = False) -> DataFrame:
    """(key, change, changed_columns, before, after) of every key whose row differs;
    rows that are the same only if ``unchanged``."""
    old = one_per_key(before, key, columns).select(key, F.col("row").alias("before"), F.col("digest").alias("_old"))
    new = one_per_key(after, key, columns).select(key, F.col("row").alias("after"), F.col("digest").alias("_new"))
    change = (F.when(F.col("_old").isNull(), ADDED).when(F.col("_new").isNull(), WITHDRAWN)
              .when(F.col("_old") == F.col("_new"), SAME).otherwise(CHANGED))
    both = old.join(new, key, "full_outer").withColumn("change", change)
    if not unchanged:
        both = both.where(F.col("change") != SAME)
    differs = F.array_compact(F.array(*[F.when(~F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")), F.lit(c)) for c in columns]))
    return both.select(key, "change", F.when(F.col("change") == CHANGED, differs).otherwise(F.array().cast("array<string>"))
                       .alias("changed_columns"), "before", "after")


def effective(snapshots: DataFrame, key: str, day: str, columns: list[str]) -> DataFrame:
    """Effective-dated rows of dated snapshots: a version starts on the first day that
    shows it and ends on the first snapshot day without it (null: still listed).

    ``valid_to`` is exclusive.  The days are those of the snapshots, one row a day.
    """
    days = snapshots.select(F.col(day).alias("_day")).distinct()
    days = days.withColumn("_next", F.lead("_day").over(Window.orderBy("_day")))  # one row a day
    rows = snapshots.where(F.col(key).isNotNull()).select(key, F.col(day).alias("_day"), F.struct(*columns).alias("_row"),
                                                          digest(columns).alias("_digest"))
    rows = rows.groupBy(key, "_day").agg(F.max_by("_row", "_digest").alias("_row"), F.max("_digest").alias("_digest"))
    rows = rows.join(days, "_day")
    by_day = Window.partitionBy(key).orderBy("_day")
    starts = ~(F.lag("_next").over(by_day).eqNullSafe(F.col("_day")) & F.lag("_digest").over(by_day).eqNullSafe(F.col("_digest")))
    rows = rows.withColumn("_version", F.sum(starts.cast("int")).over(by_day))
    return rows.groupBy(key, "_version").agg(
        F.max_by("_row", "_day").alias("_row"), F.min("_day").alias("valid_from"), F.max_by("_next", "_day").alias("valid_to")).select(
        key, "_row.*", "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
