"""Queries for quarantine and referential checks (P19, P20, P50-P53), FX as-of
costing (P26), stock ledger and health (P24-P28, P61), invoices and payments
(P31, P32), SCD2 (P18), the skills bridge (P34) and event handling
(P41, P42, P44)."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vin as VIN
from forecourt.functions import vocab
from forecourt.operators import entity as ER
from forecourt.operators import inventory as INV
from forecourt.operators import ledger
from forecourt.operators import quarantine as QU
from forecourt.operators import events as EV
from forecourt.operators.joins import asof_join, dim_join, lookup
from forecourt.operators.scd import history, merge_history, scd2
from forecourt.plans import duck_sql as S
from forecourt.plans import gold, silver
from forecourt.plans.queries_entity import CONTACTS_SQL, normalise, review_sql
from forecourt.plans.registry import register
from forecourt.plans.workshop import Workshop
from forecourt.session import scratch_path
from forecourt.sources import star_extracts as X
from forecourt.sources.bronze import run_id
from forecourt.sources.tables import Tables
from forecourt.streaming import telematics as TM

# ---------------------------------------------------------------- FIXED VALUES
AS_OF_DATE = "2027-01-01"
SKILLS = ["engine", "transmission", "brakes", "electrical", "ac"]
MATCH_DISTANCE, REVIEW_DISTANCE = 2, 4
# ------------------------------------------------------------ END FIXED VALUES

_KNOWN_CODE = "service_type_code IN (SELECT service_type_code FROM service_types)"


# ------------------------------------------------------------- P19 / P20 / P52
@register("unknown_code", S.with_ctes(["wo", "service_types"], f"""
SELECT wo_number, service_type_code, opened_at FROM wo WHERE service_type_code IS NOT NULL AND NOT ({_KNOWN_CODE})"""))
def unknown_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose service code is not in the reference list (anti join on a broadcast seed)."""
    w = Workshop(spark, sf_dir)
    codes = F.broadcast(w.service_types.select("service_type_code"))
    wo = w.work_orders.where(F.col("service_type_code").isNotNull())
    return wo.join(codes, "service_type_code", "left_anti").select("wo_number", "service_type_code", "opened_at")


@register("orphan_lines", S.with_ctes(["lines", "wo", "customers", "vehicles"], """
SELECT (SELECT count(*) FROM lines) AS n_lines,
       (SELECT count(*) FROM lines WHERE wo_number NOT IN (SELECT wo_number FROM wo)) AS n_orphan_lines,
       (SELECT count(*) FROM wo) AS n_orders,
       (SELECT count(*) FROM wo WHERE wo_number NOT IN (SELECT wo_number FROM lines)) AS n_orders_without_lines,
       (SELECT count(*) FROM wo WHERE customer_id NOT IN (SELECT customer_id FROM customers)) AS n_orders_unknown_customer,
       (SELECT count(*) FROM wo WHERE vehicle_vin NOT IN (SELECT vin FROM vehicles)) AS n_orders_unknown_vehicle"""))
def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referential checks on cleaned ids.  Lines are counted per order
    number, then one full outer join with the orders (each checked against the
    masters) gives all figures."""
    w = Workshop(spark, sf_dir)
    n = w.lines.groupBy("wo_number").agg(F.count(F.lit(1)).alias("n"))
    wo = referenced(w, w.work_orders.select("wo_number", "customer_id", "vehicle_vin")).withColumn("o", F.lit(1))
    j = wo.join(n, "wo_number", "full_outer")
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"),
                 F.coalesce(F.sum(F.when(F.col("o").isNull(), F.col("n"))), F.lit(0)).alias("n_orphan_lines"),
                 F.count("o").alias("n_orders"),
                 F.count_if(F.col("o").isNotNull() & F.col("n").isNull()).alias("n_orders_without_lines"),
                 F.count_if("is_unknown_customer").alias("n_orders_unknown_customer"),
                 F.count_if("is_unknown_vehicle").alias("n_orders_unknown_vehicle"))


def referenced(w: Workshop, wo: DataFrame) -> DataFrame:
    """Orders with the flags of a customer or vehicle that no master has."""
    c = w.customers.select(F.col("customer_id").alias("_c"), F.lit(True).alias("_has_c")).dropDuplicates(["_c"])
    v = w.vehicles.where("vin is not null").select(F.col("vin").alias("_v"), F.lit(True).alias("_has_v")).dropDuplicates(["_v"])
    wo = lookup(wo, c, F.col("customer_id"), "_c", F.col("wo_number"))
    wo = lookup(wo, v, F.col("vehicle_vin"), "_v", F.col("wo_number"))
    return wo.select("*", (F.col("customer_id").isNotNull() & F.col("_has_c").isNull()).alias("is_unknown_customer"),
                     (F.col("vehicle_vin").isNotNull() & F.col("_has_v").isNull()).alias("is_unknown_vehicle")).drop("_has_c", "_has_v")


# ---------------------------------------------------------------- P50-P53
def quarantine_records(w: Workshop) -> DataFrame:
    """All quarantine tables in one: entity, key, reason, time, the row as JSON.
    The components of the customer review queue are computed now, and the cleaned orders
    written: the rules on orders and the lines both read them."""
    orders = w.work_orders_table
    wo = referenced(w, orders)
    codes = F.broadcast(w.service_types.select(F.col("service_type_code").alias("_code"), F.lit(True).alias("_known")))
    wo = wo.join(codes, wo["service_type_code"] == codes["_code"], "left").drop("_code")
    # one pass over the lines: priced, orphans kept, anomaly flags carried along
    lines = w.priced_lines(keep_orphans=True, carry=["has_negative_quantity_anomaly", "has_negative_price_anomaly", "has_parse_error"],
                           work_orders=orders)
    readings = TM.clean_events(X.telematics_raw(w.t.events)).drop("event_ts")
    readings = EV.flag_regressions(readings.where("vin is not null and event_ts_ntz is not null"), "vin", "event_ts_ntz",
                                   "event_id", "odometer_km")
    names = ER.review_queue(contacts_of(w.t.customer), "customer_id", "name_norm", "city", MATCH_DISTANCE, REVIEW_DISTANCE)
    return QU.unify([
        QU.route_many(names, "customer", "customer_id", {"customer_match_review": F.lit(True)}),
        QU.route_many(wo, "work_order", "wo_number", {
            "invalid_vin": ~F.coalesce("is_vin_valid", F.lit(False)),
            "invalid_check_digit": ~VIN.check_digit_ok(F.col("vehicle_vin")),
            "unknown_customer": F.col("is_unknown_customer"),
            "unknown_vehicle": F.col("is_unknown_vehicle"),
            "unknown_service_code": F.col("service_type_code").isNotNull() & F.col("_known").isNull(),
            "odometer_out_of_range": F.col("has_odometer_anomaly"),
            "parse_error": F.col("has_parse_error"),
        }, "opened_at"),
        QU.route_many(lines, "line", "line_id", {
            "negative_quantity": F.col("has_negative_quantity_anomaly"),
            "negative_price": F.col("has_negative_price_anomaly"),
            "orphan_line": ~F.col("has_order"),
            "line_total_mismatch": F.col("has_order") & C.exceeds_tolerance(
                "line_total_ngn_source_raw", "line_total_recalculated_ngn"),
            "parse_error": F.col("has_parse_error"),
        }, "opened_at"),
        QU.route_many(readings, "telematics", "event_id", {"odometer_regression": F.col("is_regression")}, "event_ts_ntz"),
        QU.route_many(w.parts, "part", "part_number", {"negative_stock": F.col("qty_on_hand") < 0,
                                                       "parse_error": F.col("has_parse_error")}),
    ])


def contacts_of(customer: DataFrame) -> DataFrame:
    return normalise(X.customer_contacts(customer), "customer_id", "customer_name")


_QUARANTINE = f"""
, {CONTACTS_SQL}, {review_sql(MATCH_DISTANCE, REVIEW_DISTANCE)},
lw AS (SELECT l.*, wo.wo_number IS NOT NULL AS has_order, wo.opened_at FROM lines l LEFT JOIN wo USING (wo_number)),
reg AS (SELECT *, max(odometer_km) OVER (PARTITION BY vin ORDER BY event_ts_ntz, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM tm WHERE vin IS NOT NULL AND event_ts_ntz IS NOT NULL),
q AS (
  SELECT 'work_order' AS entity, wo_number AS record_key, 'invalid_vin' AS reason, opened_at, coalesce(service_type_code, '') AS detail FROM wo WHERE NOT is_vin_valid
  UNION ALL SELECT 'work_order', wo_number, 'invalid_check_digit', opened_at, service_type_code FROM wo WHERE vehicle_vin[9] = 'Z'
  UNION ALL SELECT 'work_order', wo_number, 'unknown_customer', opened_at, service_type_code FROM wo WHERE customer_id NOT IN (SELECT customer_id FROM customers)
  UNION ALL SELECT 'work_order', wo_number, 'unknown_vehicle', opened_at, service_type_code FROM wo WHERE vehicle_vin NOT IN (SELECT vin FROM vehicles)
  UNION ALL SELECT 'work_order', wo_number, 'unknown_service_code', opened_at, service_type_code FROM wo WHERE NOT ({_KNOWN_CODE})
  UNION ALL SELECT 'work_order', wo_number, 'odometer_out_of_range', opened_at, service_type_code FROM wo WHERE has_odometer_anomaly
  UNION ALL SELECT 'work_order', wo_number, 'parse_error', opened_at, service_type_code FROM wo WHERE has_parse_error
  UNION ALL SELECT 'line', line_id, 'negative_quantity', opened_at, line_type FROM lw WHERE has_negative_quantity_anomaly
  UNION ALL SELECT 'line', line_id, 'negative_price', opened_at, line_type FROM lw WHERE has_negative_price_anomaly
  UNION ALL SELECT 'line', line_id, 'orphan_line', opened_at, line_type FROM lw WHERE NOT has_order
  UNION ALL SELECT 'line', line_id, 'parse_error', opened_at, line_type FROM lw WHERE has_parse_error
  UNION ALL SELECT 'line', line_id, 'line_total_mismatch', opened_at, line_type FROM priced
            WHERE {S.off_by_more_than_one('line_total_ngn_source_raw', 'line_total_recalculated_ngn')}
  UNION ALL SELECT 'telematics', event_id, 'odometer_regression', event_ts_ntz, vin FROM reg WHERE odometer_km < top
  UNION ALL SELECT 'part', part_number, 'negative_stock', NULL, category FROM parts WHERE qty_on_hand < 0
  UNION ALL SELECT 'part', part_number, 'parse_error', NULL, category FROM parts WHERE has_parse_error
  UNION ALL SELECT 'customer', customer_id, 'customer_match_review', NULL, review_group FROM review)"""
_QUARANTINE_NEEDS = ["wo", "lines", "priced", "customers", "vehicles", "service_types", "tm", "parts"]


@register("quarantine_records", S.with_ctes(_QUARANTINE_NEEDS, _QUARANTINE + """
SELECT entity, record_key, reason, opened_at AS business_ts, detail FROM q""", recursive=True))
def quarantine_records_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine records of all catalog tables, with a field read back from each payload."""
    q = quarantine_records(Workshop(spark, sf_dir))
    # each payload is parsed once, not once for each field that it does not have
    fields = F.json_tuple("payload", "service_type_code", "line_type", "category", "vin", "review_group").alias(*"abcde")
    q = q.select("entity", "record_key", "reason", "business_ts", fields)
    return q.select("entity", "record_key", "reason", "business_ts", F.coalesce(*"abcde").alias("detail"))


@register("quarantine_daily", S.with_ctes(_QUARANTINE_NEEDS, _QUARANTINE + """
SELECT date_trunc('day', opened_at) AS quarantine_day, entity, reason, count(*) AS n FROM q GROUP BY 1, 2, 3""", recursive=True))
def quarantine_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantine volumes per day and reason."""
    return QU.daily_counts(quarantine_records(Workshop(spark, sf_dir)))


_STOCK = "CASE WHEN k % 97 = 3 THEN NULL ELSE (k * 13) % 183 - 2 END"


@register("quarantine_life_cycle", f"""
WITH a AS (SELECT k, part_number, {_STOCK} AS qty FROM (SELECT p_partkey AS k, 'P' || {S.code('', 'p_partkey', 5)} AS part_number FROM part)),
one AS (SELECT k, part_number, CASE WHEN qty IS NULL THEN 'parse_error' ELSE 'negative_stock' END AS reason, qty FROM a WHERE qty IS NULL OR qty < 0),
two AS (SELECT k, part_number, CASE WHEN qty IS NULL THEN 'parse_error' ELSE 'negative_stock' END AS reason, qty FROM (
  SELECT k, part_number, CASE WHEN k % 50 = 1 THEN -7 ELSE qty END AS qty FROM a WHERE k % 2 = 1) WHERE qty IS NULL OR qty < 0)
SELECT coalesce(b.part_number, c.part_number) AS record_key, coalesce(b.reason, c.reason) AS reason,
  CASE WHEN c.k IS NULL THEN 'resolved' WHEN b.k IS NULL THEN 'new' ELSE 'open' END AS status,
  CASE WHEN b.k IS NULL THEN '2024-06-02' ELSE '2024-06-01' END AS first_seen,
  CASE WHEN c.k IS NULL THEN '2024-06-01' ELSE '2024-06-02' END AS last_seen,
  CASE WHEN c.k IS NULL THEN '2024-06-02' END AS resolved_on
FROM one b FULL JOIN two c ON b.k = c.k AND b.reason = c.reason AND b.qty IS NOT DISTINCT FROM c.qty""")
def quarantine_life_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the parts after a second run over a corrected extract: even part
    numbers are put right, some others get another wrong balance."""
    t, state = Tables(spark, sf_dir), None
    p = F.regexp_extract("_key", "[0-9]+", 0).cast("bigint")
    first = X.parts_raw(t.part)
    fixed = first.withColumn("_key", C.part_key("part_number")).withColumn("qty_on_hand", F.when(p % 2 == 0, "0").when(
        p % 50 == 1, "-7").otherwise(F.col("qty_on_hand"))).drop("_key")
    for day, raw in (("2024-06-01", first), ("2024-06-02", fixed)):
        parts = silver.clean_parts(raw)
        state = QU.life_cycle(state, QU.route_many(parts, "part", "part_number", {
            "negative_stock": F.col("qty_on_hand") < 0, "parse_error": F.col("has_parse_error")}), day)
    return state.select("record_key", "reason", "status", "first_seen", "last_seen", "resolved_on")


# ---------------------------------------------------------------------- P26
@register("fx_as_of", S.with_ctes(["lines", "wo", "parts", "fx"], """
, foreign_parts AS (SELECT l.line_id, l.part_number, CAST(wo.opened_at AS DATE) AS opened_date, l.quantity, p.currency,
                           p.unit_cost_ngn AS unit_cost_fx
          FROM lines l JOIN wo ON wo.wo_number = l.wo_number JOIN parts p ON p.part_number = l.part_number
          WHERE l.line_type = 'part' AND p.currency <> 'NGN')
SELECT f.line_id, f.part_number, f.currency, CAST(f.opened_date AS TIMESTAMP) AS opened_date,
       CAST(fx.quote_date AS TIMESTAMP) AS fx_quote_date, CAST(fx.rate_ngn AS DOUBLE) AS rate_ngn,
       CAST(f.unit_cost_fx AS DOUBLE) AS unit_cost_fx,
       CAST(CAST(round(coalesce(f.quantity, 0) * f.unit_cost_fx * fx.rate_ngn, 2) AS DECIMAL(18,2)) AS DOUBLE) AS line_cost_ngn
FROM foreign_parts f ASOF LEFT JOIN fx ON f.currency = fx.currency AND f.opened_date >= fx.quote_date"""))
def fx_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts priced in USD or EUR costed at the quote in force on the order date (as-of join)."""
    w = Workshop(spark, sf_dir)
    wo = w.work_orders.select("wo_number", F.to_date("opened_at").alias("opened_date"))
    parts = w.parts.where(F.col("currency").isin("USD", "EUR")).select(
        "part_number", "currency", F.col("unit_cost_ngn").alias("unit_cost_fx"))
    lines = w.lines.where(F.col("line_type") == "part").select("line_id", "wo_number", "part_number", "quantity")
    foreign = dim_join(lines, parts, "part_number", "inner").join(wo, "wo_number", "inner")
    points = w.opened_dates.distinct().select(
        F.explode(F.array(F.lit("USD"), F.lit("EUR"))).alias("currency"), F.col("opened").alias("opened_date"))
    j = asof_join(foreign, X.fx_quotes(w.t.lineitem), ["currency"], "opened_date", "quote_date", ["rate_ngn"], points=points)
    cost = F.round(F.coalesce("quantity", F.lit(0)) * F.col("unit_cost_fx") * F.col("rate_ngn"), 2).cast("decimal(18,2)")
    return j.select("line_id", "part_number", "currency", F.col("opened_date").cast("timestamp_ntz").alias("opened_date"),
                    F.col("quote_date_used").cast("timestamp_ntz").alias("fx_quote_date"),
                    F.col("rate_ngn").cast("double").alias("rate_ngn"), F.col("unit_cost_fx").cast("double").alias("unit_cost_fx"),
                    cost.cast("double").alias("line_cost_ngn"))


# ------------------------------------------------------------- P24-P28, P61
def _signed(w: Workshop) -> DataFrame:
    return INV.signed_movements(X.stock_movements_raw(w.t.lineitem, w.t.part))


@register("stock_reconcile", S.with_ctes(["signed", "parts"], f"""
, led AS (SELECT part_number, sum(signed_qty) AS movement_sum FROM signed GROUP BY part_number)
SELECT p.part_number, CAST(coalesce(led.movement_sum, 0) AS BIGINT) AS movement_sum, p.qty_on_hand,
       CAST(coalesce(led.movement_sum, 0) AS BIGINT) - p.qty_on_hand AS divergence,
       abs(CAST(coalesce(led.movement_sum, 0) AS BIGINT) - p.qty_on_hand) > 2 AS is_alert,
       p.qty_on_hand < 0 AS has_negative_stock
FROM parts p LEFT JOIN led USING (part_number)"""))
def stock_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed ledger per part vs on-hand; > 2 units divergence alerts."""
    w = Workshop(spark, sf_dir)
    return INV.reconcile(_signed(w), w.parts)


@register("stock_balances", S.with_ctes(["signed"], """
SELECT d.day, part_number, CAST(sum(signed_qty) AS BIGINT) AS on_hand
FROM signed, (VALUES ('2021-01-31'), ('2021-02-15'), ('2021-12-31')) d(day)
WHERE movement_ts < CAST(d.day AS DATE) + INTERVAL 1 DAY GROUP BY 1, 2"""))
def stock_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of three days from month checkpoints; the movements are posted in three
    batches, the later ones back-dated and partly known."""
    store, keys = scratch_path(spark, f"ledger/{run_id()}"), ["movement_id", "part_number", "movement_ts"]
    # the source's numbers come several times: what has number, part and time in common is one movement
    signed = _signed(Workshop(spark, sf_dir)).groupBy(*keys).agg(F.sum("signed_qty").alias("signed_qty"))
    signed = signed.withColumn("movement_id", F.concat_ws("|", *[F.col(c).cast("string") for c in keys]))
    share, found = F.pmod(F.xxhash64("movement_id"), F.lit(4)), None
    for part in (share == 0, share.isin(0, 1), share.isin(2, 3)):
        ledger.post(signed.where(part), store)
    for day in ("2021-01-31", "2021-02-15", "2021-12-31"):
        one = ledger.balances(spark, store, day).select(F.lit(day).alias("day"), "part_number", "on_hand")
        found = one if found is None else found.unionByName(one)
    return found


@register("inventory_health", S.with_ctes(["signed", "parts"], """
, d AS (SELECT part_number, CAST(movement_ts AS DATE) AS day, sum(signed_qty) AS net, sum(consumed_qty) AS used FROM signed GROUP BY 1, 2),
cal AS (SELECT part_number, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d GROUP BY 1),
h AS (SELECT part_number, day, CAST(coalesce(net, 0) AS BIGINT) AS net_qty, CAST(coalesce(used, 0) AS BIGINT) AS consumed_qty,
             CAST(sum(coalesce(net, 0)) OVER (PARTITION BY part_number ORDER BY day) AS BIGINT) AS on_hand,
             CAST(sum(coalesce(used, 0)) OVER (PARTITION BY part_number ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT)
               AS consumption_30d
      FROM cal LEFT JOIN d USING (part_number, day)),
c AS (SELECT h.*, CASE WHEN consumption_30d > 0 THEN on_hand * 30 / consumption_30d END AS days_cover,
             coalesce(CAST(p.reorder_point AS BIGINT), consumption_30d) AS reorder_point_eff
      FROM h LEFT JOIN parts p USING (part_number))
SELECT part_number, CAST(day AS TIMESTAMP) AS day, net_qty, consumed_qty, on_hand, consumption_30d, days_cover,
       coalesce(days_cover < 14, false) AS stockout_risk, reorder_point_eff, on_hand <= reorder_point_eff AS reorder_due
FROM c"""))
def inventory_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part x day on-hand, 30-day consumption, days of cover, stock-out risk, reorder due."""
    w = Workshop(spark, sf_dir)
    return INV.daily_health(_signed(w), w.parts)


# ---------------------------------------------------------------- P30-P32
@register("silver_invoices", S.with_ctes(["invoices", "fx"], """
SELECT i.invoice_number, i.wo_number, CAST(i.invoice_date AS TIMESTAMP) AS invoice_date, i.currency,
       CAST(i.total AS DOUBLE) AS total, coalesce(i.total <= 0, true) AS has_non_positive_total, false AS has_parse_error,
       CAST(fx.quote_date AS TIMESTAMP) AS fx_quote_date,
       CAST(CAST(round(i.total * CASE i.currency WHEN 'NGN' THEN 1 ELSE fx.rate_ngn END, 2) AS DECIMAL(18,2)) AS DOUBLE) AS total_ngn
FROM invoices i ASOF LEFT JOIN fx ON i.currency = fx.currency AND i.invoice_date >= fx.quote_date"""))
def silver_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices from their raw extract, none dropped, foreign totals
    converted at the quote in force on the invoice date."""
    t = Tables(spark, sf_dir)
    inv = silver.clean_invoices(X.invoices_raw(t.orders))
    j = asof_join(inv, X.fx_quotes(t.lineitem), ["currency"], "invoice_date", "quote_date", ["rate_ngn"],
                  points=inv.select("currency", "invoice_date").where(F.col("currency") != vocab.DEFAULT_CURRENCY))
    rate = F.when(F.col("currency") == vocab.DEFAULT_CURRENCY, F.lit(1).cast("decimal(10,4)")).otherwise(F.col("rate_ngn"))
    return j.select("invoice_number", "wo_number", F.col("invoice_date").cast("timestamp_ntz").alias("invoice_date"), "currency",
                    F.col("total").cast("double").alias("total"), "has_non_positive_total", "has_parse_error",
                    F.col("quote_date_used").cast("timestamp_ntz").alias("fx_quote_date"),
                    F.round(F.col("total") * rate, 2).cast("decimal(18,2)").cast("double").alias("total_ngn"))


def invoices_and_payments(w: Workshop) -> DataFrame:
    """Every completed, closed order's invoice (the fact carries its summed source
    total) with its payments, which are summed by order from their own extract."""
    inv = w.order_fact(extras=True).where((F.col("status") == "completed") & F.col("closed_at").isNotNull()).select(
        "wo_number", F.col("closed_at").alias("invoice_ts"),
        (F.col("revenue_ngn") + F.col("vat_ngn")).cast("decimal(18,2)").alias("invoice_total_recalculated"),
        F.col("source_total_ngn").alias("invoice_total_source"))
    pays = silver.clean_payments(X.payments_raw(w.t.orders))
    paid = pays.groupBy("wo_number").agg(F.sum("amount_ngn").alias("amount_paid"), F.count(F.lit(1)).alias("n_payments"))
    j = inv.join(paid, "wo_number", "left")
    amt, total = F.coalesce("amount_paid", F.lit(0)).cast("decimal(18,2)"), F.col("invoice_total_source")
    status = (F.when(F.coalesce(amt >= total, F.lit(False)), F.lit("paid"))
              .when(amt > 0, F.lit("partial")).otherwise(F.lit("unpaid")))
    days = F.datediff(F.lit(AS_OF_DATE).cast("date"), F.to_date("invoice_ts")).cast("bigint")
    return j.select("wo_number", "invoice_ts", "invoice_total_source", "invoice_total_recalculated",
                    F.coalesce(total <= 0, F.lit(True)).alias("has_non_positive_total"),
                    (F.abs(total - F.col("invoice_total_recalculated")) <= 1).alias("reconciles"),
                    amt.alias("amount_paid"), F.coalesce("n_payments", F.lit(0)).cast("bigint").alias("n_payments"),
                    status.alias("payment_status"), F.when(status != "paid", days).alias("days_outstanding"))


@register("invoice_payment_status", S.with_ctes(["fact", "payments"], """
, p AS (SELECT wo_number, sum(amount_ngn) AS amt, count(*) AS n FROM payments GROUP BY 1),
j AS (SELECT f.wo_number, f.closed_at, f.source_total_ngn AS src, CAST(f.revenue_ngn + f.vat_ngn AS DECIMAL(18,2)) AS calc,
             coalesce(p.amt, 0) AS amt, coalesce(p.n, 0) AS n
      FROM fact f LEFT JOIN p USING (wo_number) WHERE f.status = 'completed' AND f.closed_at IS NOT NULL),
s AS (SELECT *, CASE WHEN amt >= src THEN 'paid' WHEN amt > 0 THEN 'partial' ELSE 'unpaid' END AS payment_status FROM j)
SELECT wo_number, closed_at AS invoice_ts, CAST(src AS DOUBLE) AS invoice_total_source, CAST(calc AS DOUBLE) AS invoice_total_recalculated,
       coalesce(src <= 0, true) AS has_non_positive_total, abs(src - calc) <= 1 AS reconciles, CAST(amt AS DOUBLE) AS amount_paid,
       n AS n_payments, payment_status,
       CASE WHEN payment_status <> 'paid' THEN date_diff('day', CAST(closed_at AS DATE), DATE '2027-01-01') END AS days_outstanding
FROM s"""))
def invoice_payment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every invoice vs the recomputed order total (within 1.00); amount paid
    summed from payments; paid / partial / unpaid; days outstanding."""
    return gold.as_reported(invoices_and_payments(Workshop(spark, sf_dir)))


# ---------------------------------------------------------------------- P18
_SCD2 = """
WITH e AS (SELECT user_id, ts, event_id, event_type,
                  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
c AS (SELECT * FROM e WHERE prev IS NULL OR prev <> event_type)
SELECT user_id, event_type, ts AS valid_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM c"""


@register("scd2_history", _SCD2)
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-2 history of each user's event type (valid_from / valid_to / is_current)."""
    ev = Tables(spark, sf_dir).events
    return scd2(ev, "user_id", "ts", "event_id", ["event_type"])


@register("scd2_merged", _SCD2)
def scd2_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history from a stored table, to which the events come in three batches in no
    order of time, the last of them with events of the first again."""
    ev, store = Tables(spark, sf_dir).events, scratch_path(spark, f"history/{run_id()}")
    share = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for part in (share == 2, share == 0, share.isin(1, 2, 3)):
        merge_history(ev.where(part), store, "user_id", "ts", "event_id", ["event_type"])
    return history(spark, store, "user_id", "ts", ["event_type"])


# ---------------------------------------------------------------------- P34
@register("skills_bridge", S.with_ctes(["techs"], f"""
SELECT technician_id, skill, skill IN {S.in_list(SKILLS)} AS is_controlled
FROM (SELECT technician_id, trim(unnest(string_split(specialisation, ';'))) AS skill FROM techs)
WHERE skill <> ''"""))
def skills_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-value specialisation -> technician x skill bridge, checked
    against the controlled list."""
    t = Workshop(spark, sf_dir).technicians
    b = t.select("technician_id", F.explode(F.split("specialisation", ";")).alias("skill"))
    b = b.select("technician_id", C.utrim("skill").alias("skill")).where(F.col("skill") != "")
    return b.withColumn("is_controlled", F.col("skill").isin(*SKILLS))


# ---------------------------------------------------------------------- P44
@register("odometer_monotonic", """
SELECT event_id, user_id, ts, value,
       max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max,
       coalesce(value < max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS is_regression
FROM events""")
def odometer_monotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading below the highest earlier reading (event-time order) is a regression."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return EV.flag_regressions(ev, "user_id", "ts", "event_id", "value")


# ---------------------------------------------------------------------- P41
@register("event_dedup", f"""
WITH arr AS (SELECT event_id, user_id, ts, event_type, value, ts + INTERVAL 5 MINUTE AS arrived_at FROM events
             UNION ALL
             SELECT event_id, user_id, ts, event_type, value, ts + INTERVAL 1 HOUR FROM events
             WHERE event_id % 10 = 0)
SELECT event_id, user_id, ts, event_type, value, arrived_at, n_copies FROM (
  SELECT *, count(*) OVER (PARTITION BY event_id) AS n_copies,
         row_number() OVER (PARTITION BY event_id ORDER BY arrived_at) AS rn FROM arr) WHERE rn = 1""")
def event_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once delivery (re-delivered copies) collapsed to one row per event id."""
    ev = Tables(spark, sf_dir).events
    return EV.dedup_deliveries(EV.with_redeliveries(ev))


# ---------------------------------------------------------------------- P42
@register("late_events", f"""
WITH a AS (SELECT event_id, ts, {S.arrival()} AS arrived_at FROM events),
b AS (SELECT *, date_trunc('hour', arrived_at) AS arrival_batch FROM a),
m AS (SELECT arrival_batch, max(ts) AS bmax FROM b GROUP BY arrival_batch),
wm AS (SELECT arrival_batch, max(bmax) OVER (ORDER BY arrival_batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
              - INTERVAL 3 DAY AS watermark FROM m)
SELECT b.event_id, b.ts, b.arrived_at, b.arrival_batch, wm.watermark, coalesce(b.ts < wm.watermark, false) AS is_late
FROM b JOIN wm USING (arrival_batch)""")
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events older than (max event time of earlier arrival batches - 3 days) are late."""
    ev = Tables(spark, sf_dir).events.select("event_id", "ts")
    return EV.late_flags(EV.with_arrival(ev), LATE_DAYS=EV.LATE_DAYS)


