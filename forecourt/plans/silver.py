"""Bronze (all text) -> silver (typed, deduplicated, flagged).

Projection / filter vocabulary used here: computed projection with rename
(F1), ``select *`` plus new columns (F2), qualified star + one column in the
joins (F3), final column pruning and order (F4), ``rn = 1`` filter (F5),
BETWEEN / NOT BETWEEN guards (F6), IN lists (F7), NULL-aware three-valued
predicates (F8) and searched / simple CASE as ``when`` chains or literal map
lookups (F9).

Bad values are flagged and nulled, never dropped.  Each function is a lazy
``DataFrame -> DataFrame``; only T2 shuffles (one exchange on the normalised
order number for the keep-latest window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vocab
from forecourt.operators.dedup import latest_by, row_fingerprint
from forecourt.operators.joins import dim_join, lookup

WORK_ORDER_COLUMNS = [
    "wo_number", "customer_id", "vehicle_vin", "opened_at", "closed_at", "status",
    "service_type_code", "technician_id", "bay_id", "odometer_km", "labour_hours",
    "customer_complaint", "is_warranty", "is_deleted", "is_vin_valid", "has_odometer_anomaly",
    "has_labour_hours_anomaly", "has_parse_error", "source_updated_at", "ingested_at",
]

LINE_COLUMNS = [
    "line_id", "wo_number", "line_type", "part_number", "description", "quantity",
    "has_negative_quantity_anomaly", "unit_price_ngn", "has_negative_price_anomaly",
    "discount_pct", "vat_rate_source_raw", "line_total_ngn_source_raw", "has_parse_error",
]


def latest_work_order_events(raw: DataFrame) -> DataFrame:
    """W1 on the *normalised* order number (raw prefixes differ per event).

    Order: change time desc, then D > U > I, then ingest time desc, then a row
    fingerprint, so ties resolve the same way on every run and every scan.
    """
    op_rank = (F.when(F.col("cdc_operation") == "D", 3).when(F.col("cdc_operation") == "U", 2)
               .when(F.col("cdc_operation") == "I", 1).otherwise(0))
    keyed = raw.withColumn("_wo", C.order_number("wo_number"))
    return latest_by(
        keyed, ["_wo"],
        [C.parse_ts("cdc_timestamp").desc_nulls_last(), op_rank.desc(),
         F.col("_ingested_at").desc_nulls_last(), row_fingerprint(raw).desc()],
    )


def current_ids(df: DataFrame, col: str, migration: DataFrame | None) -> DataFrame:
    """``col`` upper-trimmed and, where ``migration`` knows it as a legacy id, mapped."""
    df = df.withColumn(col, C.upper_trim(col))
    if migration is None:
        return df
    # one row a legacy id: no row comes twice, and the join is left out where no customer is asked for
    known = migration.groupBy(F.col("legacy_id").alias("_legacy")).agg(F.min("customer_id").alias("_now"))
    return dim_join(df, known, F.col(col) == F.col("_legacy")).withColumn(
        col, F.coalesce("_now", col)).drop("_legacy", "_now")


def clean_work_orders(raw: DataFrame, migration: DataFrame | None = None) -> DataFrame:
    """Change events -> one typed row per work order at current state, with
    legacy customer ids mapped if their ``migration`` table is given.

    Values used by several outputs (VIN, odometer, hours) are parsed once in
    their own projection; Catalyst keeps that projection separate instead of
    re-inlining an expensive expression into every consumer.
    """
    cur = latest_work_order_events(raw).select(
        "*", C.vin_strip("vehicle_vin").alias("_vin"), C.to_int("odometer_reading").alias("_odo"),
        C.to_decimal("labour_hours", 6, 2).alias("_hours"), C.parse_ts("date_opened").alias("_opened"),
        C.parse_ts("date_closed").alias("_closed"))
    cur = current_ids(cur, "customer_id", migration)
    vin, odo_raw, hours = F.col("_vin"), F.col("_odo"), F.col("_hours")
    out = cur.select(
        F.col("_wo").alias("wo_number"),
        "customer_id",
        F.when(C.vin_valid(vin), vin).alias("vehicle_vin"),
        F.col("_opened").alias("opened_at"),
        C.null_placeholder_ts("_closed").alias("closed_at"),
        C.status("status").alias("status"),
        C.upper_trim("service_type_code").alias("service_type_code"),
        C.sentinel_null("technician_id").alias("technician_id"),
        C.upper_trim("bay_id").alias("bay_id"),
        C.in_range(odo_raw, vocab.ODOMETER_MIN, vocab.ODOMETER_MAX).alias("odometer_km"),
        hours.alias("labour_hours"),
        C.collapse_ws("customer_complaint").alias("customer_complaint"),
        C.to_bool("is_warranty").alias("is_warranty"),
        C.is_deleted("cdc_operation").alias("is_deleted"),
        C.vin_valid(vin).alias("is_vin_valid"),
        C.out_of_range(odo_raw, vocab.ODOMETER_MIN, vocab.ODOMETER_MAX).alias("has_odometer_anomaly"),
        (hours > vocab.LABOUR_HOURS_ALERT).alias("has_labour_hours_anomaly"),
        C.any_parse_error([("odometer_reading", odo_raw), ("labour_hours", hours), ("date_opened", F.col("_opened")),
                           ("date_closed", F.col("_closed"))]).alias("has_parse_error"),
        F.col("cdc_timestamp").alias("source_updated_at"),
        F.col("_ingested_at").alias("ingested_at"),
    )
    return out.select(*WORK_ORDER_COLUMNS)


def clean_lines(raw: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Typed lines.  The order number uses the same normaliser as T2 so
    lines under any prefix still find their order.  Parsed values that feed
    several outputs are computed once in their own projection.  With ``aliases``
    (alias, part_number) a supplier's own numbers become canonical ones (P22)."""
    p = raw.select(
        "line_no", C.part_key("part_number").alias("_pn"), "description", "quantity", "unit_price_ngn", "discount_pct",
        "vat_rate", "line_total_ngn",
        C.line_type("line_type").alias("_lt"), C.to_decimal("quantity", 10, 2).alias("_qty"),
        C.to_decimal("unit_price_ngn", 14, 2).alias("_price"), C.order_number("wo_number").alias("_wo"),
        C.percent_or_fraction("discount_pct").alias("_discount"), C.to_decimal("line_total_ngn", 14, 2).alias("_total"))
    if aliases is not None:
        # one row an alias: no line comes twice, and the join is left out where no part number is asked for
        a = aliases.groupBy(F.col("alias").alias("_alias")).agg(F.min("part_number").alias("_canonical"))
        p = lookup(p, a, F.col("_pn"), "_alias", F.concat(F.col("_wo"), F.col("line_no")))
        p = p.withColumn("_pn", F.coalesce("_canonical", "_pn"))
    ltype, qty, price, wo = F.col("_lt"), F.col("_qty"), F.col("_price"), F.col("_wo")
    neg_qty = C.negative_not_return(qty, ltype)
    return p.select(
        F.concat(wo, F.lit("-"), C.utrim("line_no")).alias("line_id"),
        wo.alias("wo_number"),
        ltype.alias("line_type"),
        F.col("_pn").alias("part_number"),
        C.collapse_ws("description").alias("description"),
        F.when(neg_qty, F.lit(None)).otherwise(qty).alias("quantity"),
        neg_qty.alias("has_negative_quantity_anomaly"),
        C.non_negative(price).alias("unit_price_ngn"),
        (price < 0).alias("has_negative_price_anomaly"),
        F.col("_discount").alias("discount_pct"),
        C.to_decimal("vat_rate", 6, 4).alias("vat_rate_source_raw"),
        F.col("_total").alias("line_total_ngn_source_raw"),
        C.any_parse_error([("quantity", qty), ("unit_price_ngn", price), ("discount_pct", F.col("_discount")),
                           ("line_total_ngn", F.col("_total"))]).alias("has_parse_error"),
    )


def clean_technicians(raw: DataFrame) -> DataFrame:
    """T4: technician master data."""
    return raw.select(
        C.upper_trim("technician_id").alias("technician_id"),
        C.utrim("technician_name").alias("technician_name"),
        C.lower_trim("skill_level").alias("skill_level"),
        C.lower_trim("specialisation").alias("specialisation"),
        F.to_date(C.parse_ts("hire_date")).alias("hire_date"),
        C.to_decimal("hourly_rate_ngn", 10, 2).alias("hourly_rate_ngn"),
        C.to_bool("is_active").alias("is_active"),
        C.any_parse_error([("hire_date", C.parse_ts("hire_date")),
                           ("hourly_rate_ngn", C.to_decimal("hourly_rate_ngn", 10, 2))]).alias("has_parse_error"),
    )


def clean_parts(raw: DataFrame) -> DataFrame:
    """T5: parts catalogue, keyed by the canonical part number."""
    return raw.select(
        C.part_key("part_number").alias("part_number"),
        C.utrim("part_description").alias("part_description"),
        C.utrim("category").alias("category"),
        C.utrim("subcategory").alias("subcategory"),
        C.to_decimal("unit_cost_ngn", 14, 2).alias("unit_cost_ngn"),
        C.to_decimal("unit_price_ngn", 14, 2).alias("unit_price_ngn"),
        C.upper_trim("supplier_id").alias("supplier_id"),
        C.to_int("qty_on_hand").alias("qty_on_hand"),
        C.reorder_point("reorder_point").alias("reorder_point"),
        C.upper_trim("currency").alias("currency"),
        C.any_parse_error([("unit_cost_ngn", C.to_decimal("unit_cost_ngn", 14, 2)),
                           ("unit_price_ngn", C.to_decimal("unit_price_ngn", 14, 2)),
                           ("qty_on_hand", C.to_int("qty_on_hand"))]).alias("has_parse_error"),
    )


def clean_invoices(raw: DataFrame) -> DataFrame:
    """Invoice numbers, dates, currency (blank: the default) and totals.
    Every invoice stays; totals that are not positive are flagged."""
    total, day = C.to_decimal("total", 14, 2), F.to_date(C.parse_ts("invoice_date"))
    currency = F.coalesce(F.nullif(C.upper_trim("currency"), F.lit("")), F.lit(vocab.DEFAULT_CURRENCY))
    return raw.select(
        C.invoice_number("invoice_number").alias("invoice_number"), C.order_number("wo_number").alias("wo_number"),
        day.alias("invoice_date"), currency.alias("currency"), total.alias("total"),
        F.coalesce(total <= 0, F.lit(True)).alias("has_non_positive_total"),
        C.any_parse_error([("total", total), ("invoice_date", day)]).alias("has_parse_error"))


def clean_payments(raw: DataFrame) -> DataFrame:
    """Payments by order, method vocabulary."""
    return raw.select("payment_id", C.order_number("wo_number").alias("wo_number"),
                      C.to_decimal("amount", 14, 2).alias("amount_ngn"),
                      C.map_vocab("payment_method", vocab.PAYMENT_METHODS).alias("payment_method"))


def title_case(col):
    """Collapse whitespace, then capitalise each space-separated word."""
    return F.initcap(C.collapse_ws(col))


def clean_customers(raw: DataFrame, migration: DataFrame) -> DataFrame:
    """Legacy ids mapped (P1), names title-cased, type vocabulary and city
    aliases (P2), E.164 phone (P3), validated e-mail (invalid -> NULL + flag, P4)."""
    ids = raw.withColumn("_id", C.upper_trim("customer_id"))
    mig = migration.select(F.col("legacy_id").alias("_id"), F.col("customer_id").alias("_new_id"))
    j = dim_join(ids, mig, "_id", "left")
    city_u = C.upper_trim("address_city")
    city = F.coalesce(C.map_vocab("address_city", vocab.CITY_ALIASES, default=None), title_case("address_city"))
    mail = C.email("email")
    return j.select(
        F.coalesce("_new_id", "_id").alias("customer_id"),
        F.col("_id").alias("source_customer_id"),
        title_case("customer_name").alias("customer_name"),
        C.map_vocab("customer_type", vocab.CUSTOMER_TYPES).alias("customer_type"),
        C.phone_e164("phone_primary").alias("phone_e164"),
        mail.alias("email"),
        mail.isNull().alias("has_invalid_email"),
        F.when(city_u.isNull(), F.lit(None)).otherwise(city).alias("city"),
        F.to_date(C.parse_ts("registration_date")).alias("registration_date"),
    )


def clean_vehicles(raw: DataFrame, make_aliases: DataFrame, max_year: int) -> DataFrame:
    """VIN strip/validate/check digit (P16), plate, make via the alias
    seed with the raw value kept when unmapped (P15), model aliases, plate
    format, year range, engine / transmission vocabularies (P14)."""
    from forecourt.functions import vin as V

    aliases = F.broadcast(make_aliases.select(F.col("raw_make").alias("_raw_make"), "canonical_make"))
    v = raw.withColumn("_raw_make", C.utrim("make")).join(aliases, "_raw_make", "left")
    vin = C.vin_strip("vin")
    plate = F.nullif(F.regexp_replace(F.upper("plate_number"), r"[\s\-]", ""), F.lit(""))
    model = title_case("model")
    models = F.create_map(*[F.lit(x) for kv in vocab.MODEL_ALIASES.items() for x in kv])
    year = C.to_int("year_manufactured")
    year_ok = year.between(vocab.VEHICLE_MIN_YEAR, max_year)
    return v.select(
        F.when(C.vin_valid(vin), vin).alias("vin"),
        C.vin_valid(vin).alias("is_vin_valid"),
        V.check_digit_ok(vin).alias("is_check_digit_valid"),
        plate.alias("plate_number"), C.plate_valid(plate).alias("is_plate_valid"),
        C.upper_trim("customer_id").alias("customer_id"),
        F.coalesce("canonical_make", "_raw_make").alias("make"),
        F.coalesce(F.try_element_at(models, model), model).alias("model"),
        F.when(year_ok, year).alias("year_manufactured"),
        (year.isNotNull() & ~year_ok).alias("has_invalid_year"),
        C.map_vocab("engine_type", vocab.ENGINE_TYPES, normalise=C.lower_trim).alias("engine_type"),
        C.map_vocab("transmission", vocab.TRANSMISSIONS, normalise=C.lower_trim).alias("transmission"),
    )
