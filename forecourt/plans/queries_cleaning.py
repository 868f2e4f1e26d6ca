"""Queries for the cleaning rules (C1-C21, P16, P22, P23), the silver tables and
bronze landing (S1-S9), each over whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vin as V
from forecourt.functions import vocab
from forecourt.plans import duck_sql as S
from forecourt.plans import gold, silver
from forecourt.plans.registry import register
from forecourt.plans.workshop import Workshop
from forecourt.session import scratch_path
from forecourt.sources import bronze
from forecourt.sources import star_extracts as X
from forecourt.sources.tables import Tables

RUN_TS = "2024-06-01 06:00:00"
RUN_DATE = "2024-06-01"


# ---------------------------------------------------------------- S1-S9, T1
@register("bronze_land_audit", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, '{RUN_TS}' AS _ingested_at, '{RUN_DATE}' AS _ingest_date
FROM customer""")
def bronze_land_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table as all-text bronze with audit columns."""
    return bronze.to_bronze(Tables(spark, sf_dir).customer, ingested_at=RUN_TS, ingest_date=RUN_DATE)


@register("bronze_csv_landing", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name, CAST(s_nationkey AS VARCHAR) AS nation,
       '{RUN_TS}' AS _ingested_at, '{RUN_DATE}' AS _ingest_date, count(*) OVER () AS rows_landed,
       'crm.customers,crm.vehicles,dms.technicians,dms.work_order_lines,dms.work_orders,erp.parts,erp.stock_movements,'
       || 'pos.invoices,pos.payments,supplier_feeds.price_list,telematics.events' AS entities_skipped
FROM supplier""")
def bronze_csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV extract delivered to the shared folder, landed with all
    registered sources (missing ones skipped and reported) and read back."""
    drop = scratch_path(spark, f"landing/{bronze.run_id()}")
    s = Tables(spark, sf_dir).supplier
    s.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name"),
             F.col("s_nationkey").alias("nation")).write.option("header", True).csv(f"{drop}/raw/erp_suppliers.csv")
    report = bronze.land_all(spark, f"{drop}/raw", f"{drop}/bronze", RUN_TS, RUN_DATE)
    landed = bronze.read_bronze(spark, f"{drop}/bronze", "erp", "suppliers", RUN_DATE)
    return landed.select("supplier_id", "supplier_name", "nation", "_ingested_at",
                         F.col("_ingest_date").cast("string").alias("_ingest_date"),
                         F.lit(report.loaded["erp.suppliers"]).cast("bigint").alias("rows_landed"),
                         F.lit(",".join(sorted(report.skipped))).alias("entities_skipped"))


# ---------------------------------------------------------------------- C1
@register("clean_money_roundtrip", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DOUBLE) AS amount_ngn, true AS roundtrip_ok FROM orders""")
def clean_money_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five money styles rendered from o_totalprice clean back to the amount."""
    amount0 = F.col("o_totalprice").cast("decimal(14,2)")
    amt = C.to_decimal(X.money_text(amount0, F.col("o_orderkey")), 14, 2)
    return Tables(spark, sf_dir).orders.select(
        "o_orderkey", amt.cast("double").alias("amount_ngn"), (amt == amount0).alias("roundtrip_ok"))


def _events(spark: SparkSession, sf_dir: str, *cols) -> DataFrame:
    """Change events by cleaned order number and change time."""
    raw = Workshop(spark, sf_dir).work_orders_raw
    return raw.select(C.order_number("wo_number").alias("wo_number"), "cdc_timestamp", *cols)


@register("clean_units_decimal_comma", S.with_ctes(["wo_events"], """
SELECT wo_number, source_updated_at AS cdc_timestamp, odometer_km, has_odometer_anomaly,
       CAST(labour_hours AS DOUBLE) AS labour_hours, has_labour_hours_anomaly, k % 60 = 9 AS has_parse_error
FROM wo_events"""))
def clean_units_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units, thousands and decimal commas; range guard and flags."""
    odo, hrs = C.to_int("odometer_reading"), C.to_decimal("labour_hours", 6, 2)
    return _events(
        spark, sf_dir, C.in_range(odo, vocab.ODOMETER_MIN, vocab.ODOMETER_MAX).alias("odometer_km"),
        C.out_of_range(odo, vocab.ODOMETER_MIN, vocab.ODOMETER_MAX).alias("has_odometer_anomaly"),
        hrs.cast("double").alias("labour_hours"), (hrs > vocab.LABOUR_HOURS_ALERT).alias("has_labour_hours_anomaly"),
        C.any_parse_error([("odometer_reading", odo), ("labour_hours", hrs)]).alias("has_parse_error"))


# ------------------------------------------------------------------ C2/C5/C6
def _counts(df: DataFrame, col, name: str) -> DataFrame:
    return df.groupBy(col.alias(name)).agg(F.count(F.lit(1)).alias("n"))


@register("bool_vocab", S.with_ctes(["wo_events"], "SELECT is_warranty, count(*) AS n FROM wo_events GROUP BY 1"))
def bool_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean spellings -> true/false/NULL, counted."""
    return _counts(Workshop(spark, sf_dir).work_orders_raw, C.to_bool("is_warranty"), "is_warranty")


@register("status_vocab", S.with_ctes(["wo_events"], "SELECT status, count(*) AS n FROM wo_events GROUP BY 1"))
def status_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw status forms -> 5 values, else 'unknown'."""
    return _counts(Workshop(spark, sf_dir).work_orders_raw, C.status("status"), "status")


@register("line_type_vocab", S.with_ctes(["lines"], "SELECT line_type, count(*) AS n FROM lines GROUP BY 1"))
def line_type_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line type vocabulary."""
    return _counts(Workshop(spark, sf_dir).lines_raw, C.line_type("line_type"), "line_type")


# ---------------------------------------------------------------- C3 / C9
@register("ts_multi_format", S.with_ctes(["wo_events"], """
SELECT wo_number, source_updated_at AS cdc_timestamp, opened_at, closed_at,
       CAST(source_updated_at AS TIMESTAMP) AS source_updated_at FROM wo_events"""))
def ts_multi_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch ms, DD/MM/YYYY and ISO in one column; placeholder -> NULL."""
    return _events(spark, sf_dir, C.parse_ts("date_opened").alias("opened_at"),
                   C.null_placeholder_ts(C.parse_ts("date_closed")).alias("closed_at"),
                   C.parse_ts("cdc_timestamp").alias("source_updated_at"))


# ---------------------------------------------------------------------- C4
@register("phone_e164", f"SELECT c_custkey, {S.phone('c_custkey')} AS phone_e164 FROM customer")
def phone_e164(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local, +234, spaced and bracketed numbers -> E.164; others NULL."""
    return Tables(spark, sf_dir).customer.select(
        "c_custkey", C.phone_e164(X.phone_text(F.col("c_custkey"))).alias("phone_e164"))


# ------------------------------------------------------------------ C7 / C8
@register("order_number_norm", S.with_ctes(["wo_events"], """
SELECT wo_number, source_updated_at AS cdc_timestamp, technician_id FROM wo_events"""))
def order_number_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-number prefixes unified; 'nobody assigned' sentinels -> NULL."""
    return _events(spark, sf_dir, C.sentinel_null("technician_id").alias("technician_id"))


# ------------------------------------------------------------- C10-C12, P22, P23
@register("part_key_norm", S.with_ctes(["parts"], """
SELECT part_number, part_description, upper(part_description[1]) || lower(part_description[2:]) AS description_sentence,
       currency, qty_on_hand, qty_on_hand < 0 AS has_negative_stock, reorder_point FROM parts"""))
def part_key_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical part key, sentence-case description, stock flags."""
    qoh = C.to_int("qty_on_hand")
    return Workshop(spark, sf_dir).parts_raw.select(
        C.part_key("part_number").alias("part_number"), C.utrim("part_description").alias("part_description"),
        C.sentence_case("part_description").alias("description_sentence"), C.upper_trim("currency").alias("currency"),
        qoh.alias("qty_on_hand"), (qoh < 0).alias("has_negative_stock"), C.reorder_point("reorder_point").alias("reorder_point"))


@register("text_collapse", S.with_ctes(["wo_events"], """
SELECT wo_number, source_updated_at AS cdc_timestamp, customer_complaint, bay_id, service_type_code FROM wo_events"""))
def text_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim + collapse whitespace (empty -> NULL); code upper-casing."""
    return _events(spark, sf_dir, C.collapse_ws("customer_complaint").alias("customer_complaint"),
                   C.upper_trim("bay_id").alias("bay_id"), C.upper_trim("service_type_code").alias("service_type_code"))


# --------------------------------------------------------------- C13 / P16
def _check_digit_sql(v: str) -> str:
    """ISO 3779 in SQL: letter values by their place in a row of 10s."""
    weights = [8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2]
    places = "0123456789.ABCDEFGH..JKLMN.P.R..STUVWXYZ"
    total = " + ".join(f"((strpos('{places}', {v}[{i}]) - 1) % 10) * {w}" for i, w in enumerate(weights, 1))
    return f"CASE WHEN ({total}) % 11 = 10 THEN 'X' ELSE CAST(({total}) % 11 AS VARCHAR) END"


@register("vin_validate", f"""
SELECT c_custkey, CASE WHEN c_custkey % 10 > 0 THEN v END AS vin, c_custkey % 10 > 0 AS is_vin_valid,
       CASE WHEN c_custkey % 10 > 0 THEN {_check_digit_sql('v')} END AS check_digit_expected,
       CASE WHEN c_custkey % 10 > 0 THEN c_custkey % 50 <> 7 END AS is_check_digit_valid
FROM (SELECT c_custkey, {S.vin('c_custkey')} AS v FROM customer)""")
def vin_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strip to [A-Z0-9], 17 characters, ISO 3779 check digit."""
    c = F.col("c_custkey")
    full = X.vin_text(c)
    raw = (F.when(c % 10 == 0, F.substring(full, 1, 16))
           .when(c % 10 == 1, F.concat(F.lower(F.substring(full, 1, 9)), F.lit(" - "), F.substring(full, 10, 8))).otherwise(full))
    r = Tables(spark, sf_dir).customer.select("c_custkey", C.vin_strip(raw).alias("v"))
    exp = V.expected_check_digit(F.col("v"))
    return r.select("c_custkey", F.when(C.vin_valid("v"), F.col("v")).alias("vin"), C.vin_valid("v").alias("is_vin_valid"),
                    exp.alias("check_digit_expected"), (F.substring("v", 9, 1) == exp).alias("is_check_digit_valid"))


# ------------------------------------------------------------- C14-C18
@register("guard_flags", S.with_ctes(["lines"], """
SELECT line_type, count(*) AS n_lines,
       count(*) FILTER (WHERE has_negative_quantity_anomaly) AS n_negative_quantity,
       count(*) FILTER (WHERE has_negative_price_anomaly) AS n_negative_price,
       count(*) FILTER (WHERE quantity IS NULL) AS n_null_quantity,
       count(*) FILTER (WHERE unit_price_ngn IS NULL) AS n_null_price,
       count(*) FILTER (WHERE has_parse_error) AS n_parse_error,
       CAST(sum(quantity) AS DOUBLE) AS sum_quantity
FROM lines GROUP BY line_type"""))
def guard_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative price / quantity guards (returns exempt) and unreadable values, counted by type."""
    lines = Workshop(spark, sf_dir).lines
    return lines.groupBy("line_type").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("has_negative_quantity_anomaly").alias("n_negative_quantity"),
        F.count_if("has_negative_price_anomaly").alias("n_negative_price"),
        F.count_if(F.col("quantity").isNull()).alias("n_null_quantity"),
        F.count_if(F.col("unit_price_ngn").isNull()).alias("n_null_price"),
        F.count_if("has_parse_error").alias("n_parse_error"),
        F.sum("quantity").cast("double").alias("sum_quantity"))


@register("discount_percent_or_fraction", S.with_ctes(["lines"], """
SELECT CAST(discount_pct AS DOUBLE) AS discount_pct, count(*) AS n FROM lines GROUP BY 1"""))
def discount_percent_or_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C18: '10' and '0.10' both mean ten percent; exactly 1 stays 100%."""
    return _counts(Workshop(spark, sf_dir).lines_raw, C.percent_or_fraction("discount_pct").cast("double"), "discount_pct")


# ------------------------------------------------------------- C19 / Q2
@register("composite_key", S.with_ctes(["lines"], """
SELECT line_id, count(*) AS n FROM lines WHERE line_id IS NOT NULL GROUP BY line_id HAVING count(*) > 1"""))
def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """line_id = order || '-' || line_no; listing of non-unique ids."""
    lines = Workshop(spark, sf_dir).lines
    return (lines.where(F.col("line_id").isNotNull()).groupBy("line_id")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


# ------------------------------------------------------------- T2-T5 silver
@register("silver_work_orders", S.with_ctes(["wo"], "SELECT * REPLACE (CAST(labour_hours AS DOUBLE) AS labour_hours) FROM wo"))
def silver_work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 (W1, C1-C21, P1): change events -> current state, typed and flagged."""
    return gold.as_reported(Workshop(spark, sf_dir).work_orders)


@register("silver_lines", S.with_ctes(["lines"], """
SELECT * REPLACE (CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price_ngn AS DOUBLE) AS unit_price_ngn,
                  CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(vat_rate_source_raw AS DOUBLE) AS vat_rate_source_raw,
                  CAST(line_total_ngn_source_raw AS DOUBLE) AS line_total_ngn_source_raw)
FROM lines"""))
def silver_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 (P22): typed lines."""
    return gold.as_reported(Workshop(spark, sf_dir).lines)


@register("silver_technicians", S.with_ctes(["techs"], """
SELECT * REPLACE (CAST(hire_date AS TIMESTAMP) AS hire_date, CAST(hourly_rate_ngn AS DOUBLE) AS hourly_rate_ngn)
FROM techs"""))
def silver_technicians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: technicians."""
    t = Workshop(spark, sf_dir).technicians
    return gold.as_reported(t.withColumn("hire_date", F.col("hire_date").cast("timestamp_ntz")))


@register("silver_parts", S.with_ctes(["parts"], """
SELECT * REPLACE (CAST(unit_cost_ngn AS DOUBLE) AS unit_cost_ngn, CAST(unit_price_ngn AS DOUBLE) AS unit_price_ngn)
FROM parts"""))
def silver_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: parts."""
    return gold.as_reported(Workshop(spark, sf_dir).parts)


@register("silver_payments", S.with_ctes(["payments"], """
SELECT wo_number, payment_method, count(*) AS n, CAST(sum(amount_ngn) AS DOUBLE) AS amount_ngn FROM payments GROUP BY 1, 2"""))
def silver_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments by order and controlled method."""
    p = silver.clean_payments(X.payments_raw(Tables(spark, sf_dir).orders))
    return p.groupBy("wo_number", "payment_method").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_ngn").cast("double").alias("amount_ngn"))
