"""Queries for keep-latest (W1), range / conditional joins (J1, J3, J4),
reconciliation (Q5, Q8), the data-quality report (Q1-Q4, Q6, Q7, Q9) and
effective-dated technician rates (P35)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vocab
from forecourt.operators import quality as Q
from forecourt.operators.dedup import latest_by
from forecourt.operators.joins import asof_join, effective_join
from forecourt.plans import duck_sql as S
from forecourt.plans import gold
from forecourt.plans.registry import register
from forecourt.plans.workshop import Workshop
from forecourt.sources import star_extracts as X
from forecourt.sources.tables import Tables

# ---------------------------------------------------------------- FIXED VALUES
# A rate table with a gap (2022-01-01 .. 2022-05-31 has no rate) for J1.
GAPPED_RATES = [("2015-01-01", "2021-12-31", "0.0500"),
                ("2022-06-01", "2023-12-31", "0.0600"),
                ("2024-01-01", "2099-12-31", "0.0750")]
CHECK_TIME = "2026-08-06 05:00:00"
# ------------------------------------------------------------ END FIXED VALUES


# ---------------------------------------------------------------- W1 / C21
@register("cdc_latest_state", """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def cdc_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user (time desc, id desc as tie-break)."""
    ev = Tables(spark, sf_dir).events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by(ev, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


@register("soft_delete_state", """
WITH l AS (SELECT user_id, event_type, ts FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
c AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id)
SELECT l.user_id, l.event_type AS last_event_type, l.ts AS last_ts,
       coalesce(l.event_type = 'error', false) AS is_deleted, c.n_events
FROM l JOIN c USING (user_id)""")
def soft_delete_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + C21: current state per user where an 'error' event acts as a delete.

    ``max_by`` over a (ts, id) struct aggregates partially on the map side,
    so a user with a third of all events still ships one row per task.
    """
    ev = Tables(spark, sf_dir).events
    order = F.struct("ts", "event_id")
    agg = ev.groupBy("user_id").agg(
        F.max_by("event_type", order).alias("last_event_type"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_events"))
    op = F.when(F.col("last_event_type") == "error", F.lit("D")).otherwise(F.lit("U"))
    return agg.select("user_id", "last_event_type", "last_ts", C.is_deleted(op).alias("is_deleted"), "n_events")


# ---------------------------------------------------------------------- J1
def _gapped_rates(spark):
    from pyspark.sql import types as T
    import datetime as dt
    rows = [(dt.date.fromisoformat(a), dt.date.fromisoformat(b), Decimal(r)) for a, b, r in GAPPED_RATES]
    schema = T.StructType([T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType()),
                           T.StructField("vat_rate", T.DecimalType(6, 4))])
    return spark.createDataFrame(rows, schema)


_gap_rows = ", ".join(f"(DATE '{a}', DATE '{b}', CAST({r} AS DECIMAL(6,4)))" for a, b, r in GAPPED_RATES)


@register("effective_rate_join", S.with_ctes(["orders0"], f"""
, r AS (SELECT * FROM (VALUES {_gap_rows}) v(valid_from, valid_to, vat_rate))
SELECT k AS o_orderkey, opened AS opened_at, CAST(r.valid_from AS TIMESTAMP) AS rate_valid_from,
       CAST(r.vat_rate AS DOUBLE) AS vat_rate
FROM orders0 LEFT JOIN r ON CAST(opened AS DATE) BETWEEN r.valid_from AND r.valid_to"""))
def effective_rate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-effective rate lookup over distinct dates; dates in the gap get NULL."""
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey", X.opened_ts(F.col("o_orderkey"), F.col("o_orderdate")).alias("opened_at"))
    j = effective_join(o, _gapped_rates(spark), F.to_date("opened_at"), "valid_from", "valid_to", literal=True)
    return j.select("o_orderkey", "opened_at", F.col("valid_from").cast("timestamp_ntz").alias("rate_valid_from"),
                    F.col("vat_rate").cast("double").alias("vat_rate"))


# ------------------------------------------------------------- J3 / J4 / Q8
PRICED_COLS = ["wo_number", "line_id", "line_type", "line_subtotal_ngn", "line_cost_ngn", "line_vat_ngn",
               "line_total_recalculated_ngn", "line_total_ngn_source_raw"]
PRICED_MONEY = set(PRICED_COLS[3:])


def _priced(spark, sf_dir) -> DataFrame:
    return Workshop(spark, sf_dir).priced_lines()


@register("conditional_dim_join", S.with_ctes(["priced"], f"SELECT {S.money_cols(PRICED_COLS, PRICED_MONEY)} FROM priced"))
def conditional_dim_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2-J4 + C22: priced lines; part cost only on part lines, technician rate
    only on labour lines (predicates stay in the ON clause)."""
    return gold.as_reported(_priced(spark, sf_dir).select(*PRICED_COLS))


@register("line_total_reconcile", S.with_ctes(["priced"], f"""
SELECT {S.money_cols(PRICED_COLS, PRICED_MONEY)},
       CAST(abs(line_total_ngn_source_raw - line_total_recalculated_ngn) AS DOUBLE) AS abs_diff_ngn
FROM priced WHERE {S.off_by_more_than_one('line_total_ngn_source_raw', 'line_total_recalculated_ngn')}"""))
def line_total_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose source total differs from the recomputed one by > 1."""
    p = _priced(spark, sf_dir)
    bad = p.where(C.exceeds_tolerance("line_total_ngn_source_raw", "line_total_recalculated_ngn"))
    return gold.as_reported(bad.select(
        *PRICED_COLS,
        F.abs(F.col("line_total_ngn_source_raw") - F.col("line_total_recalculated_ngn")).alias("abs_diff_ngn")))


@register("mismatch_rate", None)
def mismatch_rate(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Order-level part-mismatch rate vs the 10% bound, plus the per-line
    rate - both from one pass over the fact (which carries per-order part-line
    counts), so the lines are priced once."""
    w = w or Workshop(spark, sf_dir)
    fact = w.shared_fact(extras=True, keys=["wo_number"])
    agg = fact.agg(F.count_if("has_part_line_total_mismatch").alias("mismatched"), F.count(F.lit(1)).alias("total"),
                   F.sum("part_lines_mismatched").cast("bigint").alias("part_lines_mismatched"),
                   F.sum("part_lines").cast("bigint").alias("part_lines"))
    rate = C.safe_ratio("mismatched", "total")
    return agg.select("mismatched", "total", F.round(rate, 6).alias("mismatch_rate"),
                      (F.coalesce(rate, F.lit(0.0)) > vocab.MISMATCH_RATE_BOUND).alias("breaches_bound"),
                      "part_lines_mismatched", "part_lines",
                      F.round(C.safe_ratio("part_lines_mismatched", "part_lines"), 6).alias("part_line_rate"))


# ------------------------------------------------------------------ Q1-Q4/Q6
@register("dq_not_null", None)
def dq_not_null(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Q1/Q6: not-null checks, one aggregation pass per table; the mart's are
    taken from the written fact, so lines are priced once."""
    w = w or Workshop(spark, sf_dir)
    fact = w.order_fact_table
    return Q.union_reports([
        Q.not_null(w.work_orders, "silver.work_orders", ["wo_number", "customer_id", "opened_at", "status"]),
        Q.not_null(w.lines, "silver.lines", ["line_id", "wo_number"]),
        Q.not_null(w.technicians, "silver.technicians", ["technician_id"]),
        Q.not_null(w.parts, "silver.parts", ["part_number"]),
        Q.not_null(fact, "gold.order_fact", ["wo_number", "revenue_ngn", "cost_ngn"]),
        Q.not_null(w.service_profitability(fact), "gold.service_profitability", ["service_type_code", "month", "job_count"]),
    ])


@register("dq_unique", None)
def dq_unique(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Q2: unique keys (one shuffle per key, partial aggregation)."""
    w = w or Workshop(spark, sf_dir)
    return Q.union_reports([
        Q.unique(w.work_orders, "silver.work_orders", "wo_number"),
        Q.unique(w.lines, "silver.lines", "line_id"),
        Q.unique(w.technicians, "silver.technicians", "technician_id"),
        Q.unique(w.parts, "silver.parts", "part_number"),
        Q.unique(w.shared_fact(extras=False), "gold.order_fact", "wo_number"),
    ])


@register("dq_accepted", None)
def dq_accepted(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Q3: accepted values (NULL passes)."""
    w = w or Workshop(spark, sf_dir)
    return Q.union_reports([
        Q.accepted_values(w.work_orders, "silver.work_orders", "status", vocab.STATUS_VALUES),
        Q.accepted_values(w.lines, "silver.lines", "line_type", vocab.ACCEPTED_LINE_TYPES),
    ])


@register("dq_expression", None)
def dq_expression(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Q4: row expressions (false fails, NULL passes)."""
    w = w or Workshop(spark, sf_dir)
    return Q.union_reports([
        Q.expressions_hold(w.work_orders, "silver.work_orders", {
            "closed_at_not_before_opened_at":
                F.col("closed_at").isNull() | (F.to_date("closed_at") >= F.to_date("opened_at")),
            "labour_hours_anomaly_flag_is_consistent":
                F.col("has_labour_hours_anomaly") == (F.col("labour_hours") > vocab.LABOUR_HOURS_ALERT)}),
        Q.expressions_hold(w.lines, "silver.lines", {
            "discount_pct_is_a_fraction":
                F.col("discount_pct").isNull() | F.col("discount_pct").between(0, 1)}),
        Q.expressions_hold(w.shared_fact(extras=False), "gold.order_fact", {
            "revenue_not_negative": F.col("revenue_ngn") >= 0}),
    ])


def _dq_sql(parts: list[tuple[str, str, str, str, str]]) -> str:
    sel = [f"SELECT '{chk}' AS check_name, '{tbl}' AS table_name, '{col}' AS column_name, "
           f"CAST(({cnt}) AS BIGINT) AS failing_rows FROM {src}" for chk, tbl, col, cnt, src in parts]
    return "SELECT *, failing_rows = 0 AS passed FROM (" + " UNION ALL ".join(sel) + ") t"


def _nn(tbl, src, cols):
    return [("not_null", tbl, c, f"count(*) FILTER (WHERE {c} IS NULL)", src) for c in cols]


from forecourt.plans.registry import ORACLE  # noqa: E402

ORACLE["dq_not_null"] = S.with_ctes(["wo", "lines", "techs", "parts", "fact", "mart"], _dq_sql(
    _nn("silver.work_orders", "wo", ["wo_number", "customer_id", "opened_at", "status"])
    + _nn("silver.lines", "lines", ["line_id", "wo_number"])
    + _nn("silver.technicians", "techs", ["technician_id"])
    + _nn("silver.parts", "parts", ["part_number"])
    + _nn("gold.order_fact", "fact", ["wo_number", "revenue_ngn", "cost_ngn"])
    + _nn("gold.service_profitability", "mart", ["service_type_code", "month", "job_count"])))


def _uq(tbl, src, col):
    return ("unique", tbl, col,
            f"SELECT count(*) FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)",
            "(SELECT 1) one")


ORACLE["dq_unique"] = S.with_ctes(["wo", "lines", "techs", "parts", "fact"], _dq_sql([
    _uq("silver.work_orders", "wo", "wo_number"), _uq("silver.lines", "lines", "line_id"),
    _uq("silver.technicians", "techs", "technician_id"), _uq("silver.parts", "parts", "part_number"),
    _uq("gold.order_fact", "fact", "wo_number")]))

ORACLE["dq_accepted"] = S.with_ctes(["wo", "lines"], _dq_sql([
    ("accepted_values", "silver.work_orders", "status",
     f"count(*) FILTER (WHERE NOT (status IN {S.in_list(["open", "in_progress", "awaiting_parts", "completed", "cancelled", "unknown"])}))", "wo"),
    ("accepted_values", "silver.lines", "line_type",
     f"count(*) FILTER (WHERE NOT (line_type IN {S.in_list(["part", "labour", "sublet", "fee"])}))", "lines")]))

ORACLE["dq_expression"] = S.with_ctes(["wo", "lines", "fact"], _dq_sql([
    ("expression_is_true", "silver.work_orders", "closed_at_not_before_opened_at",
     "count(*) FILTER (WHERE NOT (closed_at IS NULL OR CAST(closed_at AS DATE) >= CAST(opened_at AS DATE)))", "wo"),
    ("expression_is_true", "silver.work_orders", "labour_hours_anomaly_flag_is_consistent",
     f"count(*) FILTER (WHERE NOT (has_labour_hours_anomaly = (labour_hours > 24)))", "wo"),
    ("expression_is_true", "silver.lines", "discount_pct_is_a_fraction",
     "count(*) FILTER (WHERE NOT (discount_pct IS NULL OR discount_pct BETWEEN 0 AND 1))", "lines"),
    ("expression_is_true", "gold.order_fact", "revenue_not_negative",
     "count(*) FILTER (WHERE NOT (revenue_ngn >= 0))", "fact")]))

ORACLE["mismatch_rate"] = S.with_ctes(["fact", "priced"], f"""
, o AS (SELECT count(*) FILTER (WHERE has_part_line_total_mismatch) AS mismatched, count(*) AS total FROM fact),
l AS (SELECT count(*) FILTER (WHERE line_type = 'part' AND
             {S.off_by_more_than_one('line_total_ngn_source_raw', 'line_total_recalculated_ngn')}) AS part_lines_mismatched,
             count(*) FILTER (WHERE line_type = 'part') AS part_lines FROM priced)
SELECT mismatched, total, round(CASE WHEN total <> 0 THEN mismatched / total END, 6) AS mismatch_rate,
       coalesce(CASE WHEN total <> 0 THEN mismatched / total END, 0.0) > 0.10 AS breaches_bound,
       part_lines_mismatched, part_lines,
       round(CASE WHEN part_lines <> 0 THEN part_lines_mismatched / part_lines END, 6) AS part_line_rate
FROM o, l""")


# ---------------------------------------------------------------------- Q7
@register("freshness_status", S.with_ctes(["wo_events", "signed"], """
, f AS (SELECT 'dms' AS source, max(CAST(ingested_at AS TIMESTAMP)) AS max_loaded_at, 2 AS warn, 6 AS late FROM wo_events
        UNION ALL SELECT 'erp', max(ingested_at), 3, 8 FROM signed),
a AS (SELECT *, date_diff('second', max_loaded_at, TIMESTAMP '2026-08-06 05:00:00') / 3600.0 AS age_hours FROM f)
SELECT source, max_loaded_at, age_hours,
       CASE WHEN age_hours IS NULL OR age_hours > late THEN 'error' WHEN age_hours > warn THEN 'warn' ELSE 'ok' END AS status
FROM a"""))
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: source freshness from max(_ingested_at) of each landed source."""
    w = Workshop(spark, sf_dir)
    moves = X.stock_movements_raw(w.t.lineitem, w.t.part)
    return Q.freshness(w.work_orders_raw, "dms", "_ingested_at", CHECK_TIME, *vocab.FRESHNESS_HOURS["dms"]) \
        .unionByName(Q.freshness(moves, "erp", "_ingested_at", CHECK_TIME, *vocab.FRESHNESS_HOURS["erp"]))


# ---------------------------------------------------------------------- Q9
@register("rate_overlap_check", S.with_ctes(["rate_hist"], """
, n AS (SELECT *, lead(valid_from) OVER (PARTITION BY technician_id ORDER BY valid_from, valid_to) AS next_valid_from
        FROM rate_hist),
i AS (SELECT *, CASE WHEN next_valid_from <= valid_to THEN 'overlap'
                     WHEN next_valid_from > valid_to + 1 THEN 'gap' END AS issue FROM n)
SELECT technician_id, CAST(valid_from AS TIMESTAMP) AS valid_from, CAST(valid_to AS TIMESTAMP) AS valid_to,
       CAST(next_valid_from AS TIMESTAMP) AS next_valid_from, issue
FROM i WHERE issue IS NOT NULL"""))
def rate_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: overlapping or gapped validity ranges in the technician rate history."""
    hist = X.technician_rate_history(Tables(spark, sf_dir).supplier)
    bad = Q.range_issues(hist, ["technician_id"], "valid_from", "valid_to")
    return bad.select("technician_id", *[F.col(c).cast("timestamp_ntz").alias(c)
                                         for c in ("valid_from", "valid_to", "next_valid_from")], "issue")


# ---------------------------------------------------------------------- P35
def _order_points(w: Workshop) -> DataFrame:
    """All (technician, opening date) values, read before events are deduplicated."""
    return w.work_orders_raw.select(C.sentinel_null("technician_id").alias("technician_id"),
                                    F.to_date(C.parse_ts("date_opened")).alias("opened_date")).where("technician_id is not null")


@register("tech_rate_as_of", S.with_ctes(["lines", "wo", "rate_hist"], """
, lab AS (SELECT l.line_id, wo.technician_id, CAST(wo.opened_at AS DATE) AS opened_date, l.quantity
          FROM lines l JOIN wo ON wo.wo_number = l.wo_number
          WHERE l.line_type = 'labour' AND wo.technician_id IS NOT NULL)
SELECT lab.line_id, lab.technician_id, CAST(lab.opened_date AS TIMESTAMP) AS opened_date,
       CAST(h.valid_from AS TIMESTAMP) AS rate_valid_from, CAST(h.hourly_rate_ngn AS DOUBLE) AS hourly_rate_ngn,
       CAST(CAST(coalesce(lab.quantity, 0) * h.hourly_rate_ngn AS DECIMAL(18,4)) AS DOUBLE) AS labour_cost_ngn
FROM lab ASOF LEFT JOIN rate_hist h ON lab.technician_id = h.technician_id AND lab.opened_date >= h.valid_from"""))
def tech_rate_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labour lines costed at the technician rate in force on the order date
    (as-of: latest rate start on or before the date)."""
    w = Workshop(spark, sf_dir)
    wo = w.work_orders.select("wo_number", "technician_id", F.to_date("opened_at").alias("opened_date"))
    lab = (w.lines.where(F.col("line_type") == "labour").select("line_id", "wo_number", "quantity")
           .join(wo.where(F.col("technician_id").isNotNull()), "wo_number", "inner"))
    hist = X.technician_rate_history(w.t.supplier)
    j = asof_join(lab, hist, ["technician_id"], "opened_date", "valid_from", ["hourly_rate_ngn"],
                  points=_order_points(w), unit="year")
    cost = (F.coalesce("quantity", F.lit(0)) * F.col("hourly_rate_ngn")).cast("decimal(18,4)")
    return j.select("line_id", "technician_id", F.col("opened_date").cast("timestamp_ntz").alias("opened_date"),
                    F.col("valid_from_used").cast("timestamp_ntz").alias("rate_valid_from"),
                    F.col("hourly_rate_ngn").cast("double").alias("hourly_rate_ngn"),
                    cost.cast("double").alias("labour_cost_ngn"))


# ---------------------------------------------------------------------- C24
@register("cycle_time_hours", """
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, date_diff('hour', min(ts), max(ts)) AS cycle_time_hours
FROM events GROUP BY user_id""")
def cycle_time_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour boundaries crossed between a user's first and last event."""
    ev = Tables(spark, sf_dir).events
    agg = ev.groupBy("user_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return agg.withColumn("cycle_time_hours", C.hour_boundaries("first_ts", "last_ts"))


# ---------------------------------------------------------------------- P7
@register("category_hierarchy_check", S.with_ctes(["parts"], """
SELECT subcategory, count(DISTINCT category) AS n_categories, min(category) AS first_category, max(category) AS last_category,
       count(DISTINCT category) = 1 AS is_consistent, count(*) AS parts
FROM parts WHERE subcategory IS NOT NULL GROUP BY subcategory"""))
def category_hierarchy_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subcategory must sit under exactly one category.  Counted from
    one row per (subcategory, category), so no list is gathered."""
    p = Workshop(spark, sf_dir).parts.where(F.col("subcategory").isNotNull())
    pairs = p.groupBy("subcategory", "category").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("subcategory").agg(
        F.count("category").alias("n_categories"), F.min("category").alias("first_category"),
        F.max("category").alias("last_category"), (F.count("category") == 1).alias("is_consistent"),
        F.sum("n").alias("parts"))


# ---------------------------------------------------------------------- T8
@register("dq_report", None)
def dq_report(spark: SparkSession, sf_dir: str, w: Workshop | None = None) -> DataFrame:
    """Every declared check in one report (one row per check), including the
    part-line mismatch-rate bound."""
    w = w or Workshop(spark, sf_dir)
    w.order_fact_table  # written once, shared by every check below
    rate = mismatch_rate(spark, sf_dir, w).select(
        F.lit("rate_bound").alias("check_name"), F.lit("gold.order_fact").alias("table_name"),
        F.lit("has_part_line_total_mismatch").alias("column_name"),
        F.col("breaches_bound").cast("bigint").alias("failing_rows"), (~F.col("breaches_bound")).alias("passed"))
    return Q.union_reports([dq_not_null(spark, sf_dir, w), dq_unique(spark, sf_dir, w),
                            dq_accepted(spark, sf_dir, w), dq_expression(spark, sf_dir, w), rate])


def _sub(sql: str) -> str:
    return f"SELECT * FROM ({sql})"


ORACLE["dq_report"] = " UNION ALL ".join([
    _sub(ORACLE["dq_not_null"]), _sub(ORACLE["dq_unique"]), _sub(ORACLE["dq_accepted"]), _sub(ORACLE["dq_expression"]),
    _sub("SELECT 'rate_bound' AS check_name, 'gold.order_fact' AS table_name, "
         "'has_part_line_total_mismatch' AS column_name, CAST(breaches_bound AS BIGINT) AS failing_rows, "
         "NOT breaches_bound AS passed FROM (" + ORACLE["mismatch_rate"] + ")")])
