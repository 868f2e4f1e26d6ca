"""Registered queries: each name maps to a Spark job over the whole driver
tables and (where SQL can express it) the DuckDB oracle statement.

Queries are grouped by the survey's operator IDs.  Money is computed in
DECIMAL and reported as DOUBLE (``as_reported``) so both engines hash equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forecourt.plans import duck_sql as S
from forecourt.plans import gold
from forecourt.plans.workshop import Workshop

from forecourt.plans.registry import ORACLE, QUERIES, register  # noqa: F401


FACT_MONEY = {"parts_revenue_ngn", "labour_revenue_ngn", "other_revenue_ngn", "revenue_ngn", "vat_ngn",
              "parts_cost_ngn", "labour_cost_ngn", "cost_ngn", "gross_profit_ngn", "margin_pct"}
MART_COLS = ["month", "service_type_code", "service_type_description", "service_category", "job_count",
             "revenue_ngn", "cost_ngn", "gross_profit_ngn", "margin_pct", "avg_cycle_time_hours"]


# ------------------------------------------------------------------ T6 / T7
@register("order_fact", S.with_ctes(["fact"], f"SELECT {S.money_cols(gold.FACT_COLUMNS, FACT_MONEY)} FROM fact"))
def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 (J1-J5, A1-A5, W1, C1-C27): one row per work order."""
    return gold.as_reported(Workshop(spark, sf_dir).order_fact())


@register("service_profitability", S.with_ctes(
    ["mart"], f"SELECT {S.money_cols(MART_COLS, {'revenue_ngn', 'cost_ngn', 'gross_profit_ngn'})} FROM mart "
              "ORDER BY month ASC NULLS LAST, gross_profit_ngn DESC"))
def service_profitability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 (A7, A10, J6, O1): month x service type profitability."""
    return gold.as_reported(Workshop(spark, sf_dir).service_profitability())


# the remaining query groups register themselves on import
from forecourt.plans import queries_cleaning  # noqa: E402,F401
from forecourt.plans import queries_quality  # noqa: E402,F401
from forecourt.plans import queries_operations  # noqa: E402,F401
from forecourt.plans import queries_telematics  # noqa: E402,F401  (defines telematics CTEs used by marts)
from forecourt.plans import queries_marts  # noqa: E402,F401
from forecourt.plans import queries_entity  # noqa: E402,F401
from forecourt.plans import queries_landing  # noqa: E402,F401
