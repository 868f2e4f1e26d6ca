"""Stock ledger, reconciliation and daily health.

The ledger is reduced to part x day *before* any window runs, so a part
that has a third of all movements still contributes at most one row per
day to the per-part running windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vocab
from forecourt.operators.joins import dim_join

# ---------------------------------------------------------------- FIXED VALUES
# movement type spellings (after lower + trim) -> controlled value
MOVEMENT_TYPES = {
    "receipt": "receipt", "grn": "receipt", "issue": "issue", "return": "return",
    "adjustment": "adjustment", "adj": "adjustment", "writeoff": "writeoff",
    "write-off": "writeoff", "write off": "writeoff",
}
RECONCILE_TOLERANCE = 2
STOCKOUT_DAYS = 14
CONSUMPTION_WINDOW_DAYS = 30
# ------------------------------------------------------------ END FIXED VALUES


def signed_movements(raw: DataFrame) -> DataFrame:
    """Vocabulary + sign convention (receipts/returns/adjustments +, issues/write-offs -)."""
    mtype = C.map_vocab("movement_type", MOVEMENT_TYPES, normalise=C.lower_trim)
    sign = F.create_map(*[F.lit(x) for kv in vocab.MOVEMENT_SIGN.items() for x in kv])
    qty = F.abs(C.to_int("movement_qty"))
    return raw.select(
        "movement_id", C.part_key("part_number").alias("part_number"), mtype.alias("movement_type"),
        (qty * F.try_element_at(sign, mtype)).alias("signed_qty"),
        F.when(mtype.isin("issue", "writeoff"), qty).otherwise(F.lit(0)).alias("consumed_qty"),
        C.parse_ts("movement_date").alias("movement_ts"),
        C.upper_trim("warehouse").alias("warehouse"))


def reconcile(signed: DataFrame, parts: DataFrame, tolerance: int = RECONCILE_TOLERANCE) -> DataFrame:
    """Ledger sum per part vs the on-hand snapshot; divergence > tolerance alerts."""
    led = signed.groupBy("part_number").agg(F.sum("signed_qty").alias("movement_sum"))
    p = parts.select("part_number", "qty_on_hand")
    j = p.join(led, "part_number", "left")
    ms = F.coalesce("movement_sum", F.lit(0)).cast("bigint")
    div = ms - F.col("qty_on_hand")
    return j.select("part_number", ms.alias("movement_sum"), "qty_on_hand", div.alias("divergence"),
                    (F.abs(div) > tolerance).alias("is_alert"),
                    (F.col("qty_on_hand") < 0).alias("has_negative_stock"))


def daily_health(signed: DataFrame, parts: DataFrame) -> DataFrame:
    """Part x every day between the part's first and last movement -
    on-hand, trailing 30-day consumption, days of cover, stock-out risk and
    reorder due (missing reorder point -> 30-day consumption).

    Windows run over days with movements only; a day's row is then repeated up
    to the next one.  The trailing consumption of a quiet day is that of the last
    30 days, so consumption leaves the window on days of its own: a movement
    counts on its day and is taken back 30 days later.
    """
    daily = signed.groupBy("part_number", F.to_date("movement_ts").alias("day")).agg(
        F.sum("signed_qty").alias("net_qty"), F.sum("consumed_qty").alias("consumed_qty"))
    daily = daily.where(F.col("day").isNotNull())
    span = daily.groupBy("part_number").agg(F.max("day").alias("_last"))
    steps = daily.select("part_number", F.explode(F.array(
        F.struct("day", "net_qty", "consumed_qty", F.col("consumed_qty").alias("moving")),
        F.struct(F.date_add("day", CONSUMPTION_WINDOW_DAYS).alias("day"), F.lit(0).cast("bigint").alias("net_qty"),
                 F.lit(0).cast("bigint").alias("consumed_qty"), (-F.col("consumed_qty")).alias("moving")))).alias("s"))
    steps = steps.groupBy("part_number", F.col("s.day").alias("day")).agg(
        F.sum("s.net_qty").alias("net_qty"), F.sum("s.consumed_qty").alias("consumed_qty"), F.sum("s.moving").alias("moving"))
    steps = steps.join(span, "part_number").where(F.col("day") <= F.col("_last"))
    in_order = Window.partitionBy("part_number").orderBy("day")
    run = in_order.rowsBetween(Window.unboundedPreceding, 0)
    h = steps.select("part_number", "day", "net_qty", "consumed_qty", F.sum("net_qty").over(run).alias("on_hand"),
                     F.sum("moving").over(run).alias("consumption_30d"), F.lead("day").over(in_order).alias("_next"))
    h = h.withColumn("_day", F.explode(F.sequence("day", F.coalesce(F.date_sub("_next", 1), "day"))))
    own = F.col("_day") == F.col("day")
    for c in ("net_qty", "consumed_qty"):
        h = h.withColumn(c, F.when(own, F.col(c)).otherwise(F.lit(0).cast("bigint")))
    h = dim_join(h, parts.select("part_number", "reorder_point"), "part_number", "left")
    cover = F.when(F.col("consumption_30d") > 0,
                   F.col("on_hand") * F.lit(CONSUMPTION_WINDOW_DAYS) / F.col("consumption_30d"))
    rp_eff = F.coalesce(F.col("reorder_point").cast("bigint"), F.col("consumption_30d"))
    return h.select("part_number", F.col("_day").cast("timestamp_ntz").alias("day"), "net_qty", "consumed_qty",
                    "on_hand", "consumption_30d", cover.alias("days_cover"),
                    F.coalesce(cover < STOCKOUT_DAYS, F.lit(False)).alias("stockout_risk"),
                    rp_eff.alias("reorder_point_eff"), (F.col("on_hand") <= rp_eff).alias("reorder_due"))
