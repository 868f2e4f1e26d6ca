"""The order fact and the service-profitability mart.

Plan of ``order_fact`` (one row per work order): lines get their part cost,
orders their VAT rate and their technician's rate, each by a lookup that needs
only one side's columns; then orders and lines meet in one left join on the
order number, lines are priced in DECIMAL (one rounding per money value) and
summed by the order's columns.  The sum needs no further exchange, as the join
has dealt the rows by order number, and an order without lines keeps its row
with zero totals.  Nothing is written in between.

Lookups spread rows without a key (``operators.joins.lookup``).  An order's own
lines are priced together; their number is bounded by the order, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions import clean as C
from forecourt.operators.joins import effective_join, lookup

MONEY = "decimal(18,2)"
COST = "decimal(18,4)"
# mart-level sums over many orders get more integer digits
MONEY_SUM = "decimal(28,2)"
COST_SUM = "decimal(28,4)"

FACT_COLUMNS = [
    "wo_number", "customer_id", "vehicle_vin", "service_type_code", "technician_id", "bay_id",
    "status", "is_warranty", "opened_at", "closed_at", "cycle_time_hours", "parts_revenue_ngn",
    "labour_revenue_ngn", "other_revenue_ngn", "revenue_ngn", "vat_ngn", "parts_cost_ngn",
    "labour_cost_ngn", "cost_ngn", "gross_profit_ngn", "margin_pct", "line_count",
    "has_line_total_mismatch", "has_part_line_total_mismatch", "has_labour_line_total_mismatch",
]


def with_rates(work_orders: DataFrame, vat_rates: DataFrame, technicians: DataFrame | None = None,
               dates: DataFrame | None = None) -> DataFrame:
    """J1 + J4: the VAT rate in force on the order's opening date (NULL if none)
    and the hourly rate of its technician.  VAT rates are a literal table without
    overlaps (tested); ``dates``: see ``effective_join``."""
    rates = vat_rates.select("valid_from", "valid_to", F.col("vat_rate").alias("effective_vat_rate"))
    out = effective_join(work_orders, rates, F.to_date("opened_at"), "valid_from", "valid_to", dates=dates, literal=True)
    out = out.drop("valid_from", "valid_to")
    if technicians is not None:
        # one row a technician: no order comes twice, and the join is left out where no rate is asked for
        t = technicians.groupBy(F.col("technician_id").alias("_t_id")).agg(F.min("hourly_rate_ngn").alias("_hourly"))
        out = lookup(out, t, F.col("technician_id"), "_t_id", F.col("wo_number"))
    return out


def with_part_cost(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """The unit cost of part lines (the predicate is part of the key)."""
    # one row a part: no line comes twice, and the join is left out where no cost is asked for
    p = parts.groupBy(F.col("part_number").alias("_p_part")).agg(F.min("unit_cost_ngn").alias("_unit_cost"))
    return lookup(lines, p, F.when(F.col("line_type") == "part", F.col("part_number")), "_p_part", F.col("line_id"))


def priced(joined: DataFrame) -> DataFrame:
    """Money of every line of a join of orders (with rates) and
    lines (with part cost); all zero where an order has no line."""
    q0 = F.coalesce("quantity", F.lit(0))
    p0 = F.coalesce("unit_price_ngn", F.lit(0))
    d0 = F.coalesce("discount_pct", F.lit(0))
    rate0 = F.coalesce("effective_vat_rate", F.lit(0))
    # narrow factor type keeps q * p * factor at 31 digits: exact, one rounding
    factor = F.when(F.col("line_type") == "part", F.lit(1) - d0).otherwise(F.lit(1)).try_cast("decimal(6,5)")
    cost = (F.when(F.col("line_type") == "part", q0 * F.coalesce("_unit_cost", F.lit(0)))
            .when(F.col("line_type") == "labour", q0 * F.coalesce("_hourly", F.lit(0)))
            .otherwise(F.lit(0))).cast(COST)
    j = joined.withColumn("line_subtotal_ngn", F.round(q0 * p0 * factor, 2).cast(MONEY)).withColumn("line_cost_ngn", cost)
    sub = F.col("line_subtotal_ngn")
    return j.withColumns({
        "line_vat_ngn": F.round(sub * rate0, 2).cast(MONEY),
        "line_total_recalculated_ngn": F.round(sub * (F.lit(1) + rate0), 2).cast(MONEY),
    })


def price_lines(lines: DataFrame, orders: DataFrame, parts: DataFrame, keep_orphans: bool = False,
                carry: list[str] | None = None) -> DataFrame:
    """J2-J4 + C22: one priced row per line that has an order (``orders`` come
    from ``with_rates``).

    ``keep_orphans`` keeps lines without an order (order columns NULL, so
    one pass over the lines can feed both pricing and the orphan check);
    ``carry`` passes further line columns through.
    """
    slim = orders.select("wo_number", "effective_vat_rate", "opened_at", "_hourly", F.lit(True).alias("_has_order"))
    j = with_part_cost(lines, parts).join(slim, "wo_number", "left" if keep_orphans else "inner")
    return priced(j).select(
        "wo_number", "line_id", "line_type", "effective_vat_rate", "opened_at", "line_total_ngn_source_raw", *(carry or []),
        F.coalesce("_has_order", F.lit(False)).alias("has_order"), "line_subtotal_ngn", "line_cost_ngn", "line_vat_ngn",
        "line_total_recalculated_ngn")


def _sum_if(cond, value):
    """A2: conditional sum."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def order_sums() -> list:
    """A1-A5 + A8 + Q8: per-order sums (A3), conditional sums (A2), counts (A4, A8),
    bool_or flags (A5) and reconciliation flags."""
    lt = F.col("line_type")
    sub, cost = F.col("line_subtotal_ngn"), F.col("line_cost_ngn")
    mism = C.exceeds_tolerance("line_total_ngn_source_raw", "line_total_recalculated_ngn")
    return [
        _sum_if(lt == "part", sub).cast(MONEY).alias("parts_revenue_ngn"),
        _sum_if(lt == "labour", sub).cast(MONEY).alias("labour_revenue_ngn"),
        _sum_if(lt.isin("sublet", "fee"), sub).cast(MONEY).alias("other_revenue_ngn"),
        F.sum(sub).cast(MONEY).alias("revenue_ngn"),
        F.sum("line_vat_ngn").cast(MONEY).alias("vat_ngn"),
        _sum_if(lt == "part", cost).cast(COST).alias("parts_cost_ngn"),
        _sum_if(lt == "labour", cost).cast(COST).alias("labour_cost_ngn"),
        F.sum(cost).cast(COST).alias("cost_ngn"),
        F.count(lt).alias("line_count"),
        F.coalesce(F.bool_or(mism), F.lit(False)).alias("has_line_total_mismatch"),
        F.coalesce(F.bool_or((lt == "part") & mism), F.lit(False)).alias("has_part_line_total_mismatch"),
        F.coalesce(F.bool_or((lt == "labour") & mism), F.lit(False)).alias("has_labour_line_total_mismatch"),
        # extras for reports that would otherwise read the lines again
        F.sum("line_total_ngn_source_raw").cast(MONEY).alias("source_total_ngn"),
        _sum_if(lt == "sublet", sub).cast(MONEY).alias("sublet_cost_ngn"),
        F.count_if(lt == "part").alias("part_lines"),
        F.count_if((lt == "part") & mism).alias("part_lines_mismatched"),
    ]


EXTRA_COLUMNS = ["source_total_ngn", "sublet_cost_ngn", "part_lines", "part_lines_mismatched"]
ORDER_COLUMNS = FACT_COLUMNS[:10]


def order_fact(work_orders: DataFrame, lines: DataFrame, parts: DataFrame,
               technicians: DataFrame, vat_rates: DataFrame, extras: bool = False,
               include_deleted: bool = True, dates: DataFrame | None = None, keys: list[str] = ORDER_COLUMNS) -> DataFrame:
    """One row per work order with revenue, VAT, cost, profit and flags.

    ``keys``: the order's own columns that are asked for, its number among them; the others
    are neither cleaned nor compared.

    ``extras`` adds the per-order source total, sublet cost (bought-in work is
    passed on at cost) and part-line counts so reports need no second pass over
    the lines.  ``include_deleted=False`` leaves soft-deleted orders (and so
    their lines) out; the default keeps them, flagged, as the source model does."""
    if not include_deleted:
        work_orders = work_orders.where(~F.col("is_deleted"))
    wo = with_rates(work_orders.select(*ORDER_COLUMNS), vat_rates, technicians, dates)
    costed = with_part_cost(lines.select("line_id", "wo_number", "line_type", "part_number", "quantity", "unit_price_ngn",
                                         "discount_pct", "line_total_ngn_source_raw"), parts)
    f = priced(wo.join(costed, "wo_number", "left")).groupBy(*keys).agg(*order_sums())
    profit = (F.col("revenue_ngn") - F.col("cost_ngn")).cast(COST)
    f = f.withColumns({"gross_profit_ngn": profit, "margin_pct": C.safe_ratio(profit, "revenue_ngn").cast("decimal(18,6)")})
    if {"opened_at", "closed_at"} <= set(keys):
        f = f.withColumn("cycle_time_hours", C.hour_boundaries("opened_at", "closed_at"))
    return f.select(*[c for c in FACT_COLUMNS if c in f.columns], *(EXTRA_COLUMNS if extras else []))


def service_profitability(fact: DataFrame, service_types: DataFrame) -> DataFrame:
    """Month x service type (A7 group by expression, A6 avg ignoring NULL,
    A10 second aggregation level over the fact, J6 broadcast seed lookup);
    margin NULL on zero revenue (C26); ordered by month (NULL last) then gross
    profit descending (O1)."""
    m = fact.groupBy(C.month_start("opened_at").alias("month"), "service_type_code").agg(
        F.count(F.lit(1)).alias("job_count"),
        F.sum("revenue_ngn").cast(MONEY_SUM).alias("revenue_ngn"),
        F.sum("cost_ngn").cast(COST_SUM).alias("cost_ngn"),
        F.sum("gross_profit_ngn").cast(COST_SUM).alias("gross_profit_ngn"),
        F.round(F.avg("cycle_time_hours"), 6).alias("avg_cycle_time_hours"),
    )
    st = F.broadcast(service_types.select(
        F.col("service_type_code").alias("_st_code"),
        F.col("description").alias("service_type_description"),
        F.col("category").alias("service_category")))
    out = m.join(st, m["service_type_code"] == st["_st_code"], "left")
    return out.select(
        "month", "service_type_code", "service_type_description", "service_category", "job_count",
        "revenue_ngn", "cost_ngn", "gross_profit_ngn",
        C.safe_ratio("gross_profit_ngn", "revenue_ngn").cast("decimal(18,6)").alias("margin_pct"),
        "avg_cycle_time_hours",
    ).orderBy(F.col("month").asc_nulls_last(), F.col("gross_profit_ngn").desc_nulls_last())


def as_reported(df: DataFrame) -> DataFrame:
    """Output casting: exact DECIMAL money becomes DOUBLE for reporting."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append((F.col(f.name).cast("double") + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
