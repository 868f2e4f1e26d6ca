"""P60-P65 marts and the customer / vehicle / technician masters (P1-P5,
P14-P17, P21, P33, P36).

Metric definitions the catalog leaves open are fixed here and marked with a
dagger in the docstrings.  Every mart is a partial/final aggregate; windows
only run over already-aggregated rows (per key x bucket, or per day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.operators.joins import dim_join
from forecourt.operators.sequential import previous_value

# ---------------------------------------------------------------- FIXED VALUES
REWORK_DAYS = 30                 # dagger: same vehicle + service code within 30 days
WORKING_HOURS_PER_MONTH = 22 * 8  # dagger: billable capacity per technician-month
CHURN_BANDS = [(90, "active"), (180, "at_risk"), (365, "lapsing")]  # dagger; else churned
ACTIVE_CUSTOMER_DAYS = 730       # 24 months
ACTIVE_TECHNICIAN_DAYS = 90
BAY_CAPACITY = 6                 # dagger: bays in the workshop
BAY_RATE_NGN_PER_HOUR = 1500     # dagger: bay cost for fully loaded costing
DAILY_HOURS_ALERT = 24
TOP_K_CODES = 3
# ------------------------------------------------------------ END FIXED VALUES


def technician_performance(work_orders: DataFrame) -> DataFrame:
    """Technician x month - jobs, completed, avg cycle time, rework rate dagger,
    labour hours and billable utilisation dagger.  All inputs are order columns;
    an order without vehicle or code has a key of its own, so it has no
    predecessor and no shared partition."""
    o = work_orders.select("wo_number", "technician_id", "status", "opened_at", "labour_hours",
                           C.hour_boundaries("opened_at", "closed_at").alias("cycle_time_hours"),
                           F.coalesce(F.concat(F.col("vehicle_vin"), F.lit("|"), F.col("service_type_code")),
                                      F.concat(F.lit("~"), F.col("wo_number"))).alias("_vk"))
    r = previous_value(o, "_vk", "opened_at", "wo_number", "opened_at", out="_prev_opened", unit="month")
    gap = F.unix_seconds(F.col("opened_at").cast("timestamp")) - F.unix_seconds(F.col("_prev_opened").cast("timestamp"))
    r = r.withColumn("_rework", F.coalesce(gap <= REWORK_DAYS * 86400, F.lit(False)))
    g = r.where(F.col("technician_id").isNotNull()).groupBy(
        "technician_id", C.month_start("opened_at").alias("month")).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(F.col("status") == "completed").alias("jobs_completed"),
        F.round(F.avg("cycle_time_hours"), 6).alias("avg_cycle_time_hours"),
        F.count_if("_rework").alias("rework_jobs"),
        F.sum("labour_hours").cast("double").alias("labour_hours"))
    return g.select("*",
                    F.round(F.col("rework_jobs") / F.col("jobs"), 6).alias("rework_rate"),
                    F.round(F.col("labour_hours") / F.lit(float(WORKING_HOURS_PER_MONTH)), 6)
                    .alias("billable_utilisation"))


def customer_retention(fact: DataFrame, as_of: str) -> DataFrame:
    """Per customer - last service, days since, lifetime revenue, churn band dagger."""
    g = fact.groupBy("customer_id").agg(
        F.min("opened_at").alias("first_service_at"), F.max("opened_at").alias("last_service_at"),
        F.count(F.lit(1)).alias("jobs"), F.sum("revenue_ngn").cast("decimal(28,2)").alias("lifetime_revenue_ngn"))
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_service_at"))
    band = F.lit("churned")
    for limit, name in reversed(CHURN_BANDS):
        band = F.when(days <= limit, F.lit(name)).otherwise(band)
    return g.select("*", days.cast("bigint").alias("days_since_service"), band.alias("churn_risk_band"),
                    (days <= ACTIVE_CUSTOMER_DAYS).alias("is_active"))


def _top_k(counts: DataFrame, grp: list[str], item: str, out: str, k: int = TOP_K_CODES) -> DataFrame:
    """Comma-joined top-k items per group by count (ties by item), as
    ``_t_<grp>`` key columns plus ``out``; each group keeps at most k rows."""
    w = Window.partitionBy(*grp).orderBy(F.col("n").desc(), F.col(item).asc_nulls_last())
    top = (counts.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
           .groupBy(*grp).agg(F.array_sort(F.collect_list(F.struct("_rk", item))).alias("_top")))
    return top.select(*[F.col(c).alias(f"_t_{c}") for c in grp],
                      F.array_join(F.transform("_top", lambda s: s[item]), ",").alias(out))


def _null_safe_left(left: DataFrame, right: DataFrame, grp: list[str]) -> DataFrame:
    """Left join on ``grp`` where NULL keys match (vehicles with a rejected
    year form their own NULL group)."""
    cond = [left[c].eqNullSafe(right[f"_t_{c}"]) for c in grp]
    return left.join(right, cond, "left").drop(*[f"_t_{c}" for c in grp])


def vehicle_reliability(work_orders: DataFrame, vehicles: DataFrame, faults: DataFrame | None = None) -> DataFrame:
    """Make x model x year - vehicles serviced, jobs per vehicle, repeat
    repair rate (a service code done twice on one vehicle), top service codes
    and, from telematics (``faults``: vin, fault_code), top fault codes.

    Orders are reduced to (vin, code) before they meet the vehicles once; totals
    and top codes both come from that.
    """
    v = vehicles.select("vin", "make", "model", "year_manufactured")
    grp = ["make", "model", "year_manufactured"]
    per_code = (work_orders.where(F.col("vehicle_vin").isNotNull())
                .groupBy(F.col("vehicle_vin").alias("vin"), "service_type_code").agg(F.count(F.lit(1)).alias("n"))
                .join(v, "vin"))
    per_vin = per_code.groupBy("vin", *grp).agg(F.sum("n").alias("jobs"), (F.max("n") >= 2).alias("has_repeat"))
    g = per_vin.groupBy(*grp).agg(F.count(F.lit(1)).alias("vehicles"), F.sum("jobs").alias("jobs"),
                                  F.count_if("has_repeat").alias("_repeat"))
    codes = per_code.groupBy(*grp, "service_type_code").agg(F.sum("n").alias("n"))
    out = _null_safe_left(g, _top_k(codes, grp, "service_type_code", "top_service_codes"), grp)
    cols = ["top_service_codes"]
    if faults is not None:
        per_fault = (faults.where(F.col("vin").isNotNull() & F.col("fault_code").isNotNull())
                     .groupBy("vin", "fault_code").agg(F.count(F.lit(1)).alias("n")))
        fc = per_fault.join(v, "vin").groupBy(*grp, "fault_code").agg(F.sum("n").alias("n"))
        out = _null_safe_left(out, _top_k(fc, grp, "fault_code", "top_fault_codes"), grp)
        cols.append("top_fault_codes")
    return out.select(*grp, "vehicles", "jobs",
                      F.round(F.col("jobs") / F.col("vehicles"), 6).alias("avg_repairs_per_vehicle"),
                      F.round(F.col("_repeat") / F.col("vehicles"), 6).alias("repeat_repair_rate"), *cols)


def daily_operations(fact: DataFrame) -> DataFrame:
    """Every day from the first to the last with a job opened or closed -
    jobs opened, jobs closed, revenue of closed jobs, work in progress as jobs
    and as recomputed revenue (opened - closed so far), bay utilisation dagger.

    One pass over the fact; the calendar and the running sums only see one row
    per day.
    """
    def day(c: str):
        return F.to_date(c)

    event = F.explode(F.array(
        F.struct(day("opened_at").alias("day"), F.lit(1).alias("o"), F.lit(0).alias("c")),
        F.struct(day("closed_at").alias("day"), F.lit(0).alias("o"), F.lit(1).alias("c"))))
    d = fact.select("revenue_ngn", event.alias("e")).where(F.col("e.day").isNotNull()).groupBy(F.col("e.day").alias("day")).agg(
        F.sum("e.o").cast("bigint").alias("jobs_opened"), F.sum("e.c").cast("bigint").alias("jobs_closed"),
        F.sum(F.col("revenue_ngn") * F.col("e.c")).cast("decimal(28,2)").alias("revenue_closed_ngn"),
        F.sum(F.col("revenue_ngn") * (F.col("e.o") - F.col("e.c"))).cast("decimal(28,2)").alias("_wip_change"))
    up_to = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    # each day is followed by the days up to the next one with a row
    d = d.select("*", F.sum(F.col("jobs_opened") - F.col("jobs_closed")).over(up_to).cast("bigint").alias("wip_jobs"),
                 F.sum("_wip_change").over(up_to).cast("decimal(28,2)").alias("wip_value_ngn"),
                 F.lead("day").over(Window.orderBy("day")).alias("_next"))
    d = d.withColumn("_day", F.explode(F.sequence("day", F.coalesce(F.date_sub("_next", 1), "day"))))
    own = F.col("_day") == F.col("day")
    zero = F.lit(0).cast("bigint")
    return d.select(F.col("_day").cast("timestamp_ntz").alias("day"),
                    F.when(own, F.col("jobs_opened")).otherwise(zero).alias("jobs_opened"),
                    F.when(own, F.col("jobs_closed")).otherwise(zero).alias("jobs_closed"),
                    F.when(own, F.col("revenue_closed_ngn")).otherwise(F.lit(0).cast("decimal(28,2)")).alias("revenue_closed_ngn"),
                    "wip_jobs", "wip_value_ngn",
                    F.round(F.col("wip_jobs") / F.lit(float(BAY_CAPACITY)), 6).alias("bay_utilisation"))


def job_costing(fact: DataFrame) -> DataFrame:
    """Fully loaded cost = parts + labour + sublet (at cost) + bay time dagger
    (non-negative cycle hours x rate).  ``fact`` with extras."""
    bay_hours = F.greatest(F.coalesce("cycle_time_hours", F.lit(0)), F.lit(0))
    bay_cost = (bay_hours * F.lit(BAY_RATE_NGN_PER_HOUR)).cast("decimal(18,4)")
    full = (F.col("cost_ngn") + F.col("sublet_cost_ngn") + bay_cost).cast("decimal(18,4)")
    profit = (F.col("revenue_ngn") - full).cast("decimal(18,4)")
    return fact.select("wo_number", "parts_cost_ngn", "labour_cost_ngn", "sublet_cost_ngn", bay_cost.alias("bay_cost_ngn"),
                       full.alias("fully_loaded_cost_ngn"), profit.alias("fully_loaded_profit_ngn"),
                       C.safe_ratio(profit, F.col("revenue_ngn")).cast("decimal(18,6)").alias("fully_loaded_margin"))


def technician_daily_hours(work_orders: DataFrame) -> DataFrame:
    """Technician-days whose booked labour hours exceed 24."""
    g = work_orders.where(F.col("technician_id").isNotNull()).groupBy(
        "technician_id", F.date_trunc("day", F.col("opened_at").cast("timestamp")).cast("timestamp_ntz").alias("day")
    ).agg(F.sum("labour_hours").alias("labour_hours"), F.count(F.lit(1)).alias("jobs"))
    return g.where(F.col("labour_hours") > DAILY_HOURS_ALERT)


def last_activity(work_orders: DataFrame, key: str) -> DataFrame:
    """P5/P36/P17 helper: first and last opened_at per key (partial aggregation)."""
    return work_orders.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min("opened_at").alias("first_order_at"), F.max("opened_at").alias("last_order_at"))


def technician_master(technicians: DataFrame, work_orders: DataFrame, as_of: str,
                      skill_levels: list[str]) -> DataFrame:
    """Title-case names, skill-level vocabulary, active = a job in the last 90 days."""
    act = last_activity(work_orders, "technician_id")
    t = dim_join(technicians, act, "technician_id", "left")
    days = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_order_at"))
    return t.select("technician_id", F.initcap(C.collapse_ws("technician_name")).alias("technician_name"),
                    F.when(F.col("skill_level").isin(*skill_levels), F.col("skill_level"))
                    .otherwise(F.lit("unknown")).alias("skill_level"),
                    "last_order_at", F.coalesce(days <= ACTIVE_TECHNICIAN_DAYS, F.lit(False)).alias("is_active"))
