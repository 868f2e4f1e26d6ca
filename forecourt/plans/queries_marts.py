"""Queries for the marts (P60-P65) and the customer, vehicle and technician
masters (P1-P5, P14-P17, P21, P33, P36)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import vocab
from forecourt.plans import duck_sql as S
from forecourt.plans import gold, marts
from forecourt.plans.registry import register
from forecourt.plans.workshop import Workshop
from forecourt.sources import star_extracts as X
from forecourt.streaming import telematics as TM

# ---------------------------------------------------------------- FIXED VALUES
AS_OF_DATE = "2027-01-01"
# ------------------------------------------------------------ END FIXED VALUES


# ---------------------------------------------------------------------- P60
@register("tech_performance", S.with_ctes(["wo"], """
, r AS (SELECT *, date_diff('hour', opened_at, closed_at) AS cycle,
               coalesce(vehicle_vin IS NOT NULL AND service_type_code IS NOT NULL AND date_diff('second',
                 lag(opened_at) OVER (PARTITION BY vehicle_vin, service_type_code ORDER BY opened_at NULLS LAST, wo_number),
                 opened_at) <= 30 * 86400, false) AS rework FROM wo),
g AS (SELECT technician_id, date_trunc('month', opened_at) AS month, count(*) AS jobs,
             count(*) FILTER (WHERE status = 'completed') AS jobs_completed, round(avg(cycle), 6) AS avg_cycle_time_hours,
             count(*) FILTER (WHERE rework) AS rework_jobs, CAST(sum(labour_hours) AS DOUBLE) AS labour_hours
      FROM r WHERE technician_id IS NOT NULL GROUP BY 1, 2)
SELECT *, round(rework_jobs / jobs, 6) AS rework_rate, round(labour_hours / 176.0, 6) AS billable_utilisation FROM g"""))
def tech_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technician x month performance mart, from order columns alone."""
    return marts.technician_performance(Workshop(spark, sf_dir).work_orders)


# ---------------------------------------------------------------------- P62
@register("customer_retention", S.with_ctes(["fact"], """
, g AS (SELECT customer_id, min(opened_at) AS first_service_at, max(opened_at) AS last_service_at, count(*) AS jobs,
               sum(revenue_ngn) AS lifetime_revenue_ngn FROM fact GROUP BY customer_id),
d AS (SELECT *, date_diff('day', CAST(last_service_at AS DATE), DATE '2027-01-01') AS days FROM g)
SELECT customer_id, first_service_at, last_service_at, jobs, CAST(lifetime_revenue_ngn AS DOUBLE) AS lifetime_revenue_ngn,
       days AS days_since_service,
       CASE WHEN days <= 90 THEN 'active' WHEN days <= 180 THEN 'at_risk' WHEN days <= 365 THEN 'lapsing' ELSE 'churned' END
         AS churn_risk_band,
       days <= 730 AS is_active
FROM d"""))
def customer_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer retention mart (churn bands are a fixed definition)."""
    return gold.as_reported(marts.customer_retention(Workshop(spark, sf_dir).order_fact(), AS_OF_DATE))


# ------------------------------------------------------------ P14-P17
@register("vehicle_master", S.with_ctes(["vehicles", "wo"], """
, fs AS (SELECT vehicle_vin AS vin, min(opened_at) AS first_service_at, count(*) AS jobs
         FROM wo WHERE vehicle_vin IS NOT NULL GROUP BY vehicle_vin)
SELECT v.*, fs.first_service_at, coalesce(fs.jobs, 0) AS jobs FROM vehicles v LEFT JOIN fs USING (vin)"""))
def vehicle_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned vehicles with make aliases, year guard, check digit and
    first service date derived from the earliest work order."""
    w = Workshop(spark, sf_dir)
    fs = (w.work_orders.where(F.col("vehicle_vin").isNotNull()).groupBy(F.col("vehicle_vin").alias("vin"))
          .agg(F.min("opened_at").alias("first_service_at"), F.count(F.lit(1)).alias("jobs")))
    v = w.vehicles.join(fs, "vin", "left")
    return v.withColumn("jobs", F.coalesce("jobs", F.lit(0)).cast("bigint"))


# ---------------------------------------------------------------------- P63
@register("vehicle_reliability", S.with_ctes(["wo", "vehicles", "tm"], """
, pc AS (SELECT vehicle_vin AS vin, service_type_code, count(*) AS n FROM wo WHERE vehicle_vin IS NOT NULL
         GROUP BY 1, 2),
pv AS (SELECT vin, sum(n) AS jobs, max(n) >= 2 AS has_repeat FROM pc GROUP BY vin),
j AS (SELECT pv.*, v.make, v.model, v.year_manufactured FROM pv JOIN vehicles v USING (vin)),
g AS (SELECT make, model, year_manufactured, count(*) AS vehicles, CAST(sum(jobs) AS BIGINT) AS jobs,
             count(*) FILTER (WHERE has_repeat) AS rep FROM j GROUP BY 1, 2, 3),
codes AS (SELECT v.make, v.model, v.year_manufactured, pc.service_type_code, sum(pc.n) AS n
          FROM pc JOIN vehicles v USING (vin) GROUP BY 1, 2, 3, 4),
rk AS (SELECT *, row_number() OVER (PARTITION BY make, model, year_manufactured
                                    ORDER BY n DESC, service_type_code ASC NULLS LAST) AS r FROM codes),
top AS (SELECT make, model, year_manufactured, string_agg(service_type_code, ',' ORDER BY r) AS top_service_codes
        FROM rk WHERE r <= 3 GROUP BY 1, 2, 3),
fcodes AS (SELECT v.make, v.model, v.year_manufactured, tm.fault_code, count(*) AS n
           FROM tm JOIN vehicles v ON v.vin = tm.vin
           WHERE tm.vin IS NOT NULL AND tm.fault_code IS NOT NULL GROUP BY 1, 2, 3, 4),
frk AS (SELECT *, row_number() OVER (PARTITION BY make, model, year_manufactured
                                     ORDER BY n DESC, fault_code ASC NULLS LAST) AS r FROM fcodes),
ftop AS (SELECT make, model, year_manufactured, string_agg(fault_code, ',' ORDER BY r) AS top_fault_codes
         FROM frk WHERE r <= 3 GROUP BY 1, 2, 3)
SELECT g.make, g.model, g.year_manufactured, g.vehicles, g.jobs,
       round(g.jobs / g.vehicles, 6) AS avg_repairs_per_vehicle, round(g.rep / g.vehicles, 6) AS repeat_repair_rate,
       top.top_service_codes, ftop.top_fault_codes
FROM g LEFT JOIN top ON g.make IS NOT DISTINCT FROM top.make AND g.model IS NOT DISTINCT FROM top.model
                    AND g.year_manufactured IS NOT DISTINCT FROM top.year_manufactured
       LEFT JOIN ftop ON g.make IS NOT DISTINCT FROM ftop.make AND g.model IS NOT DISTINCT FROM ftop.model
                    AND g.year_manufactured IS NOT DISTINCT FROM ftop.year_manufactured"""))
def vehicle_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make x model x year reliability with top service codes and, from
    the telematics events, top fault codes."""
    w = Workshop(spark, sf_dir)
    faults = TM.clean_events(X.telematics_raw(w.t.events)).select("vin", "fault_code")
    return marts.vehicle_reliability(w.work_orders, w.vehicles, faults)


# ---------------------------------------------------------------------- P65
@register("daily_ops", S.with_ctes(["fact"], """
, e AS (SELECT CAST(opened_at AS DATE) AS day, 1 AS o, 0 AS c, revenue_ngn AS r FROM fact WHERE opened_at IS NOT NULL
        UNION ALL SELECT CAST(closed_at AS DATE), 0, 1, revenue_ngn FROM fact WHERE closed_at IS NOT NULL),
cal AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e),
d AS (SELECT cal.day, coalesce(sum(o), 0) AS jobs_opened, coalesce(sum(c), 0) AS jobs_closed,
             coalesce(sum(r * c), 0) AS closed_value, coalesce(sum(r * (o - c)), 0) AS change
      FROM cal LEFT JOIN e USING (day) GROUP BY 1)
SELECT CAST(day AS TIMESTAMP) AS day, CAST(jobs_opened AS BIGINT) AS jobs_opened, CAST(jobs_closed AS BIGINT) AS jobs_closed,
       CAST(closed_value AS DOUBLE) AS revenue_closed_ngn,
       CAST(sum(jobs_opened - jobs_closed) OVER w AS BIGINT) AS wip_jobs, CAST(sum(change) OVER w AS DOUBLE) AS wip_value_ngn,
       round(sum(jobs_opened - jobs_closed) OVER w / 6.0, 6) AS bay_utilisation
FROM d WINDOW w AS (ORDER BY day ROWS UNBOUNDED PRECEDING)"""))
def daily_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily operations mart over the calendar (opened, closed, revenue, WIP as jobs and value)."""
    return gold.as_reported(marts.daily_operations(Workshop(spark, sf_dir).order_fact()))


# ---------------------------------------------------------------------- P64
@register("job_costing", S.with_ctes(["fact"], f"""
, c AS (SELECT *, CAST(greatest(coalesce(cycle_time_hours, 0), 0) * 1500 AS DECIMAL(18,4)) AS bay FROM fact),
f AS (SELECT *, CAST(cost_ngn + sublet_cost_ngn + bay AS DECIMAL(18,4)) AS full_cost FROM c)
SELECT wo_number, CAST(parts_cost_ngn AS DOUBLE) AS parts_cost_ngn, CAST(labour_cost_ngn AS DOUBLE) AS labour_cost_ngn,
       CAST(sublet_cost_ngn AS DOUBLE) AS sublet_cost_ngn,
       CAST(bay AS DOUBLE) AS bay_cost_ngn, CAST(full_cost AS DOUBLE) AS fully_loaded_cost_ngn,
       CAST(CAST(revenue_ngn - full_cost AS DECIMAL(18,4)) AS DOUBLE) AS fully_loaded_profit_ngn,
       {S.exact_ratio("CAST(revenue_ngn - full_cost AS DECIMAL(18,4))", "revenue_ngn", 4, 2)} AS fully_loaded_margin
FROM f"""))
def job_costing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fully loaded job cost (parts + labour + sublet + bay time)."""
    return gold.as_reported(marts.job_costing(Workshop(spark, sf_dir).order_fact(extras=True)))


# ---------------------------------------------------------------------- P21
@register("technician_daily_hours", S.with_ctes(["wo"], f"""
SELECT technician_id, date_trunc('day', opened_at) AS day, CAST(sum(labour_hours) AS DOUBLE) AS labour_hours,
       count(*) AS jobs
FROM wo WHERE technician_id IS NOT NULL GROUP BY 1, 2 HAVING sum(labour_hours) > 24"""))
def technician_daily_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technician-days with more than 24 booked labour hours."""
    return gold.as_reported(marts.technician_daily_hours(Workshop(spark, sf_dir).work_orders))


# ------------------------------------------------------------- P33 / P36
@register("technician_master", S.with_ctes(["techs", "wo"], f"""
, act AS (SELECT technician_id, max(opened_at) AS last_order_at FROM wo WHERE technician_id IS NOT NULL
          GROUP BY technician_id)
SELECT t.technician_id, {S.title('t.technician_name')} AS technician_name,
       CASE WHEN t.skill_level IN ('apprentice', 'junior', 'senior', 'master') THEN t.skill_level ELSE 'unknown' END AS skill_level,
       act.last_order_at,
       coalesce(date_diff('day', CAST(act.last_order_at AS DATE), DATE '{AS_OF_DATE}') <= 90,
                false) AS is_active
FROM techs t LEFT JOIN act USING (technician_id)"""))
def technician_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technician names, skill levels and activity-derived is_active."""
    w = Workshop(spark, sf_dir)
    return marts.technician_master(w.technicians, w.work_orders, AS_OF_DATE, vocab.SKILL_LEVELS)


# ------------------------------------------------------------- P1-P5
@register("customer_master", S.with_ctes(["customers", "wo"], f"""
, act AS (SELECT customer_id, max(opened_at) AS last_order_at FROM wo WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT c.* REPLACE (CAST(c.registration_date AS TIMESTAMP) AS registration_date), act.last_order_at,
       coalesce(date_diff('day', CAST(act.last_order_at AS DATE), DATE '{AS_OF_DATE}') <= 730,
                false) AS is_active
FROM customers c LEFT JOIN act USING (customer_id)"""))
def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned customers with legacy-id mapping and activity in the last 24 months."""
    w = Workshop(spark, sf_dir)
    act = marts.last_activity(w.work_orders, "customer_id").drop("first_order_at")
    c = w.customers.join(act, "customer_id", "left")
    days = F.datediff(F.lit(AS_OF_DATE).cast("date"), F.to_date("last_order_at"))
    return c.withColumn("registration_date", F.col("registration_date").cast("timestamp_ntz")) \
            .withColumn("is_active", F.coalesce(days <= marts.ACTIVE_CUSTOMER_DAYS, F.lit(False)))


# ---------------------------------------------------------------------- P18
@register("owner_at_service", S.with_ctes(["wo", "ownership"], """
, v AS (SELECT vin, owner_id, changed_at AS valid_from,
               lead(changed_at) OVER (PARTITION BY vin ORDER BY changed_at, owner_id) AS valid_to FROM ownership),
f AS (SELECT wo_number, vehicle_vin, opened_at, customer_id FROM wo WHERE vehicle_vin IS NOT NULL)
SELECT f.wo_number, f.vehicle_vin, f.opened_at, f.customer_id, v.owner_id AS owner_at_service,
       v.valid_from AS owner_since, f.customer_id = v.owner_id AS owner_matches_order
FROM f LEFT JOIN v ON v.vin = f.vehicle_vin AND f.opened_at >= v.valid_from
                   AND (v.valid_to IS NULL OR f.opened_at < v.valid_to)"""))
def owner_at_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 vehicle ownership (valid_from / valid_to / is_current from
    change events) joined to each work order by service time, so historical
    jobs stay with the owner of the day."""
    from forecourt.operators.joins import asof_join
    from forecourt.operators.scd import scd2

    w = Workshop(spark, sf_dir)
    ev = X.vehicle_ownership_events(w.t.customer)
    hist = scd2(ev, "vin", "changed_at", "owner_id", ["owner_id"])  # versions of the owner per vehicle
    wo = w.work_orders.where(F.col("vehicle_vin").isNotNull()).select(
        "wo_number", F.col("vehicle_vin").alias("vin"), "opened_at", "customer_id")
    j = asof_join(wo, hist.select("vin", "valid_from", F.col("owner_id").alias("owner_at_service")),
                  ["vin"], "opened_at", "valid_from", ["owner_at_service"], unit="year")
    return j.select("wo_number", F.col("vin").alias("vehicle_vin"), "opened_at", "customer_id", "owner_at_service",
                    F.col("valid_from_used").alias("owner_since"),
                    (F.col("customer_id") == F.col("owner_at_service")).alias("owner_matches_order"))
