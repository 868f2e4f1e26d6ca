"""Lookup joins: dimensions, effective-dated (range) and as-of.

Both time joins have one plan at every size.  What has to be compared by range
is reduced to the distinct (key, time) values of the facts first, resolved
there, and brought back to the facts by an equi join; nothing is counted while
the plan is built and no join is a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Day numbers counted from 0001-01-01 have at most 22 bits.
DAY_BITS = 22
_DAY_ZERO = "0001-01-01"


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a dimension table.

    No hint: Spark broadcasts the dimension only when its size estimate is
    under ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks with the
    measured shuffle size at run time; a large dimension stays a shuffle join.
    """
    return fact.join(dim, on, how)


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(_DAY_ZERO).cast("date"))


def _day_blocks(rates: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """Each range cut into aligned blocks of 2**level days (two a level at most):
    a day lies in a range exactly if one of the day's own blocks is among them."""
    lvl = F.col("_lvl")

    def first(level):  # first and last whole block of a level inside the range
        return F.expr(f"shiftright(_a + shiftleft(1, {level}) - 1, {level})")

    def last(level):
        return F.expr(f"shiftright(_b + 1, {level}) - 1")

    r = (rates.withColumn("_a", _day_number(F.col(valid_from))).withColumn("_b", _day_number(F.col(valid_to)))
         .withColumn("_lvl", F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS))))
         .withColumn("_lo", first("_lvl")).withColumn("_hi", last("_lvl"))
         .withColumn("_plo", first("(_lvl + 1)")).withColumn("_phi", last("(_lvl + 1)")))
    # a block is needed where the one of twice its size does not fit
    own = F.filter(F.array("_lo", "_hi"), lambda x: (F.col("_lo") <= F.col("_hi"))
                   & ~F.shiftright(x, 1).between(F.col("_plo"), F.col("_phi")))
    return r.withColumn("_blk", F.explode(F.array_distinct(own))).select(
        lvl, F.col("_blk"), *[F.col(c) for c in rates.columns])


def effective_join(facts: DataFrame, rates: DataFrame, at: Column, valid_from: str, valid_to: str,
                   how: str = "left", dates: DataFrame | None = None, literal: bool = False) -> DataFrame:
    """Attach the rate row whose [valid_from, valid_to] (inclusive) holds ``at``.

    ``at`` is a DATE expression over ``facts``.  Overlapping ranges fan out
    (``operators.quality.range_issues`` finds them).  ``dates`` may name a
    cheaper one-column frame that has all dates of the facts (it may have more).
    The distinct dates meet the ranges in an equi join on aligned day blocks,
    and the facts meet the result by date.  ``literal``: the ranges are constants
    that do not overlap, so the result has one row for each calendar day at most;
    that bound allows a broadcast, and the facts are not dealt by date.
    """
    days = (dates.toDF("_day") if dates is not None else facts.select(at.alias("_day"))).distinct()
    days = days.where(F.col("_day").isNotNull()).withColumn("_lvl", F.explode(F.sequence(F.lit(0), F.lit(DAY_BITS))))
    days = days.withColumn("_blk", F.expr("shiftright(datediff(_day, DATE '0001-01-01'), _lvl)"))
    in_force = (days.join(_day_blocks(rates, valid_from, valid_to), ["_lvl", "_blk"]).drop("_lvl", "_blk"))
    if literal:
        in_force = F.broadcast(in_force)
    return facts.withColumn("_at", at).join(in_force, F.col("_at") == F.col("_day"), how).drop("_at", "_day")


def asof_join(facts: DataFrame, quotes: DataFrame, keys: list[str], fact_ts: str, quote_ts: str,
              value_cols: list[str], points: DataFrame | None = None, unit: str = "month") -> DataFrame:
    """For each fact row, the latest quote with quote_ts <= fact_ts per key.

    The distinct (key, time) points of the facts are merged with the quotes and
    take the last quote before them in a window over (key, bucket); one row per
    (key, bucket) carries the last quote over the buckets' borders.  The facts
    then meet their points in an equi join.  ``points`` may name a cheaper frame
    that has all (key, time) values of the facts.  Value columns break ties
    between quotes of the same time.
    """
    quote = F.struct(F.col(quote_ts).alias("_qt"), *[F.col(c) for c in value_cols])
    q = quotes.select(*keys, F.col(quote_ts).alias("_ts"), quote.alias("_q")).where(F.col("_ts").isNotNull())
    p = (points if points is not None else facts).select(*keys, F.col(fact_ts).alias("_ts")).distinct()
    p = p.where(F.col("_ts").isNotNull()).withColumn("_q", F.lit(None).cast(q.schema["_q"].dataType))
    e = q.unionByName(p).withColumn("_b", F.date_trunc(unit, F.col("_ts").cast("timestamp")))
    buckets = e.groupBy(*keys, "_b").agg(F.max("_q").alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.select(*keys, "_b", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    # quotes come before points of the same time
    w = Window.partitionBy(*keys, "_b").orderBy("_ts", F.col("_q").isNull(), "_q").rowsBetween(
        Window.unboundedPreceding, 0)
    inner = e.withColumn("_in", F.last("_q", ignorenulls=True).over(w)).where(F.col("_q").isNull())
    found = inner.join(carry, [*keys, "_b"]).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], "_ts", F.coalesce("_in", "_carry").alias("_found"))
    on = [facts[k] == found[f"_k_{k}"] for k in keys] + [facts[fact_ts] == found["_ts"]]
    out = facts.join(found, on, "left")
    return out.select(*[facts[c] for c in facts.columns], F.col("_found._qt").alias(f"{quote_ts}_used"),
                      *[F.col(f"_found.{c}").alias(c) for c in value_cols])


def lookup(fact: DataFrame, dim: DataFrame, key: Column, dim_key: str, spread: Column) -> DataFrame:
    """Left join on ``key``; rows without a key take a value of their own, spread
    by ``spread``, so that a shuffle does not send all of them to one task (no
    key of a dimension starts with a zero character)."""
    own = F.coalesce(key, F.concat(F.lit("\0"), F.pmod(F.xxhash64(spread), F.lit(4096)).cast("string")))
    return fact.withColumn("_own", own).join(dim, F.col("_own") == F.col(dim_key), "left").drop("_own", dim_key)
