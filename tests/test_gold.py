"""Order fact and mart on hand-authored bronze rows (known answers)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from forecourt.plans import gold, silver
from forecourt.sources import seeds

WO_COLS = ["wo_number", "customer_id", "vehicle_vin", "date_opened", "date_closed", "status", "service_type_code",
           "technician_id", "bay_id", "odometer_reading", "labour_hours", "customer_complaint", "is_warranty",
           "cdc_operation", "cdc_timestamp", "_ingested_at"]
LINE_COLS = ["wo_number", "line_no", "line_type", "part_number", "description", "quantity", "unit_price_ngn",
             "discount_pct", "vat_rate", "line_total_ngn"]


def wo_row(wo, opened, closed="1900-01-01", status="4", code="SVC-MIN", tech="T1", op="I", cdc="2024-03-01 10:59:00"):
    return (wo, "C1", "1HGCM82633A004352", opened, closed, status, code, tech, "bay-1", "145,300 km", "2,5",
            " knock ", "Y", op, cdc, "2024-06-01 00:00:00")


@pytest.fixture(scope="module")
def fact(spark):
    wo_raw = spark.createDataFrame([
        wo_row("WO-000001", "2024-03-01 10:59:00", "2024-03-01 12:01:00"),
        # second prefix spelling and a later update of the same order
        wo_row("wo-000001", "2024-03-01 10:59:00", "2024-03-01 12:01:00", op="U", cdc="2024-03-01 11:00:00"),
        wo_row("WO-000002", "15/06/2014"),                      # before any VAT rate, no lines
        wo_row("W/O 000003", "2021-01-05 08:00:00", tech="N/A"),  # unassigned technician
        wo_row("WO000004", "2021-01-05 08:00:00", op="D", cdc="2021-01-05 09:00:00"),
        wo_row("WO000004", "2021-01-05 08:00:00", op="U", cdc="2021-01-05 09:00:00"),  # tie: D wins
    ], ",".join(f"{c} string" for c in WO_COLS))
    lines_raw = spark.createDataFrame([
        ("WO-000001", "1", "Labour", "", "diag", "2.00", "NGN5,000.00", "0.10", "0.075", "10750.00"),
        ("WO-000001", "2", "part", "p-1 0", "pads", "2", "10,000.00", "5", "0.075", "21000.00"),
        ("W/O 000003", "1", "sublet", "", "tow", "1", "1000.00", "", "", "1076.00"),     # off by 1.00: ok
        ("W/O 000003", "2", "fee", "", "disposal", "1", "1000.00", "", "", "1073.99"),   # off by 1.01: flagged
        ("W/O 000003", "3", "misc", "", "other", "1", "100.00", "", "", ""),
        ("WO000004", "1", "part", "P-99", "unknown part", "1", "500.00", "0", "", "537.50"),
        ("WO-999999", "1", "part", "P-10", "orphan", "1", "1.00", "0", "", "1.08"),
    ], ",".join(f"{c} string" for c in LINE_COLS))
    techs = spark.createDataFrame([("t1", "Ada", "senior", "engine", "2020-01-01", "3,500.00", "Y")],
                                  "technician_id string, technician_name string, skill_level string, "
                                  "specialisation string, hire_date string, hourly_rate_ngn string, is_active string")
    parts = spark.createDataFrame([("P-10", "Pads", "brakes", "pads", "7,000.00", "10,000.00", "s1", "5", "", "NGN")],
                                  "part_number string, part_description string, category string, subcategory string, "
                                  "unit_cost_ngn string, unit_price_ngn string, supplier_id string, qty_on_hand string, "
                                  "reorder_point string, currency string")
    f = gold.order_fact(silver.clean_work_orders(wo_raw), silver.clean_lines(lines_raw),
                        silver.clean_parts(parts), silver.clean_technicians(techs), seeds.vat_rates(spark))
    return {r["wo_number"]: r for r in f.collect()}


def test_fact_known_row(fact):
    r = fact["WO-000001"]
    assert r["revenue_ngn"] == Decimal("29000.00")
    assert r["labour_revenue_ngn"] == Decimal("10000.00") and r["parts_revenue_ngn"] == Decimal("19000.00")
    assert r["vat_ngn"] == Decimal("2175.00")
    assert r["labour_cost_ngn"] == Decimal("7000.0000") and r["parts_cost_ngn"] == Decimal("14000.0000")
    assert r["gross_profit_ngn"] == Decimal("8000.0000")
    assert r["margin_pct"] == Decimal("0.275862")
    assert r["line_count"] == 2
    assert r["has_part_line_total_mismatch"] is True
    assert r["has_labour_line_total_mismatch"] is False
    assert r["has_line_total_mismatch"] is True
    assert r["cycle_time_hours"] == 2  # 10:59 -> 12:01 crosses two hour boundaries


def test_fact_edges(fact):
    assert set(fact) == {"WO-000001", "WO-000002", "WO-000003", "WO-000004"}  # one row per order, orphan line gone
    r2 = fact["WO-000002"]  # no lines, opened before the VAT table
    assert r2["line_count"] == 0 and r2["revenue_ngn"] == 0 and r2["margin_pct"] is None
    assert r2["has_line_total_mismatch"] is False
    r3 = fact["WO-000003"]  # 1.00 difference passes, 1.01 fails; 'misc' counts in revenue only
    assert r3["other_revenue_ngn"] == Decimal("2000.00") and r3["revenue_ngn"] == Decimal("2100.00")
    assert r3["has_line_total_mismatch"] is True and r3["technician_id"] is None
    r4 = fact["WO-000004"]  # part missing from the catalogue costs 0
    assert r4["parts_cost_ngn"] == 0 and r4["revenue_ngn"] == Decimal("500.00")


def test_tie_break_prefers_delete(spark):
    raw = spark.createDataFrame([
        wo_row("WO000004", "2021-01-05 08:00:00", op="U", cdc="2021-01-05 09:00:00"),
        wo_row("WO-000004", "2021-01-05 08:00:00", op="D", cdc="2021-01-05 09:00:00"),
    ], ",".join(f"{c} string" for c in WO_COLS))
    rows = silver.clean_work_orders(raw).collect()
    assert len(rows) == 1 and rows[0]["is_deleted"] is True
    assert rows[0]["odometer_km"] == 145300 and rows[0]["labour_hours"] == Decimal("2.50")


def test_mart_orders_nulls_last(spark):
    fact = spark.createDataFrame([
        ("WO-1", dt.datetime(2024, 1, 5), "SVC-MIN", Decimal("100.00"), Decimal("40.0000"), Decimal("60.0000"), 2),
        ("WO-2", None, "SVC-MAJ", Decimal("0.00"), Decimal("0.0000"), Decimal("0.0000"), None),
        ("WO-3", dt.datetime(2024, 1, 9), "BRK-PAD", Decimal("300.00"), Decimal("100.0000"), Decimal("200.0000"), 4),
        ("WO-4", dt.datetime(2023, 12, 9), "AC-REG", Decimal("1.00"), Decimal("0.0000"), Decimal("1.0000"), 4),
    ], "wo_number string, opened_at timestamp_ntz, service_type_code string, revenue_ngn decimal(18,2), "
       "cost_ngn decimal(18,4), gross_profit_ngn decimal(18,4), cycle_time_hours bigint")
    rows = gold.service_profitability(fact, seeds.service_types(spark)).collect()
    assert [r["service_type_code"] for r in rows] == ["AC-REG", "BRK-PAD", "SVC-MIN", "SVC-MAJ"]  # month, then profit falling
    assert rows[-1]["month"] is None and rows[-1]["margin_pct"] is None
    assert rows[1]["service_type_description"] == "Brake pad replacement"


def test_include_deleted_switch(spark):
    raw = spark.createDataFrame([
        wo_row("WO-000010", "2021-01-05 08:00:00", op="D", cdc="2021-01-05 09:00:00"),
        wo_row("WO-000011", "2021-01-05 08:00:00"),
    ], ",".join(f"{c} string" for c in WO_COLS))
    lines = spark.createDataFrame([("WO-000010", "1", "fee", "", "x", "1", "10.00", "", "", "10.75")],
                                  ",".join(f"{c} string" for c in LINE_COLS))
    empty_p = spark.createDataFrame([], "part_number string, part_description string, category string, "
                                    "subcategory string, unit_cost_ngn string, unit_price_ngn string, "
                                    "supplier_id string, qty_on_hand string, reorder_point string, currency string")
    empty_t = spark.createDataFrame([], "technician_id string, technician_name string, skill_level string, "
                                    "specialisation string, hire_date string, hourly_rate_ngn string, is_active string")
    args = (silver.clean_work_orders(raw), silver.clean_lines(lines), silver.clean_parts(empty_p),
            silver.clean_technicians(empty_t), seeds.vat_rates(spark))
    assert {r.wo_number for r in gold.order_fact(*args).collect()} == {"WO-000010", "WO-000011"}
    assert {r.wo_number for r in gold.order_fact(*args, include_deleted=False).collect()} == {"WO-000011"}


def test_vat_seed_has_no_overlaps_or_gaps(spark):
    from forecourt.operators import quality as Q

    from pyspark.sql import functions as F

    rates = seeds.vat_rates(spark).withColumn("k", F.lit(1))
    assert Q.range_issues(rates, ["k"], "valid_from", "valid_to").count() == 0


def test_calendars(spark):
    """Every day between the first and the last is there, with what holds on it."""
    from forecourt.operators.inventory import daily_health
    from forecourt.plans import marts

    d = lambda n: dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=n)
    moves = spark.createDataFrame([("P1", d(0), 100, 0), ("P1", d(2), -6, 6), ("P1", d(40), -4, 4), ("P2", d(5), 7, 0)],
                                  "part_number string, movement_ts timestamp_ntz, signed_qty bigint, consumed_qty bigint")
    parts = spark.createDataFrame([("P1", None), ("P2", 9)], "part_number string, reorder_point int")
    h = {(r.part_number, (r.day - d(0).replace(hour=0)).days): r for r in daily_health(moves, parts).collect()}
    assert sorted(h) == [("P1", n) for n in range(41)] + [("P2", 5)]
    assert [h["P1", n].on_hand for n in (0, 1, 2, 39, 40)] == [100, 100, 94, 94, 90]
    assert [h["P1", n].consumption_30d for n in (1, 2, 31, 32, 40)] == [0, 6, 6, 0, 4]
    assert h["P1", 3].net_qty == 0 and h["P2", 5].reorder_due is True
    fact = spark.createDataFrame([("A", d(0), d(3), Decimal("10.00")), ("B", d(1), None, Decimal("5.00")), ("C", None, None, Decimal("1.00"))],
                                 "wo_number string, opened_at timestamp_ntz, closed_at timestamp_ntz, revenue_ngn decimal(18,2)")
    days = marts.daily_operations(fact).orderBy("day").collect()
    assert [(r.jobs_opened, r.jobs_closed, r.wip_jobs, r.wip_value_ngn, r.revenue_closed_ngn) for r in days] == [
        (1, 0, 1, 10, 0), (1, 0, 2, 15, 0), (0, 0, 2, 15, 0), (0, 1, 1, 5, 10)]


def test_part_and_technician_listed_twice_double_no_money(spark):
    orders = spark.createDataFrame([("WO-1", "T1")], "wo_number string, technician_id string").withColumn("opened_at", F.lit("2021-03-01").cast("timestamp_ntz"))
    parts = spark.createDataFrame([("P1", 5), ("P1", 7)], "part_number string, unit_cost_ngn int")
    techs = spark.createDataFrame([("T1", 30), ("T1", 40)], "technician_id string, hourly_rate_ngn int")
    lines = spark.createDataFrame([("WO-1-1", "WO-1", "part", "P1")], "line_id string, wo_number string, line_type string, part_number string")
    assert [r._unit_cost for r in gold.with_part_cost(lines, parts).collect()] == [5]
    rated = gold.with_rates(orders, seeds.vat_rates(spark), techs)
    assert [r._hourly for r in rated.collect()] == [30]
    # no cost asked for, no join
    count = gold.with_part_cost(lines, parts).select("line_id")
    assert "Join" not in count._jdf.queryExecution().optimizedPlan().toString()


def test_quarantine_cleans_the_orders_once(spark):
    from forecourt.plans.queries_operations import quarantine_records
    from forecourt.plans.workshop import Workshop

    plan = quarantine_records(Workshop(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in plan  # both readers have the written orders


def test_unused_order_columns_are_not_carried(spark):
    """The mismatch rate needs no customer: the lookup of legacy ids is left out, and orders are summed by their number."""
    import __spark_entry__

    plan = __spark_entry__.queries()["mismatch_rate"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_legacy" not in plan
    keys = [line.split("[", 1)[1].split("]", 1)[0] for line in plan.splitlines() if "Aggregate [wo_number" in line]
    assert keys and all("," not in k for k in keys)


def test_a_legacy_id_listed_twice(spark):
    wo = spark.createDataFrame([wo_row("WO-000001", "2024-03-01 10:59:00")], ",".join(f"{c} string" for c in WO_COLS))
    migration = spark.createDataFrame([("C1", "CUST-2"), ("C1", "CUST-1"), ("C9", "CUST-9")], "legacy_id string, customer_id string")
    assert [r.customer_id for r in silver.clean_work_orders(wo, migration).collect()] == ["CUST-1"]


def test_quarantine_payloads_are_parsed_once(spark):
    import __spark_entry__

    q = __spark_entry__.queries()["quarantine_records"](spark, "/root/testdata/sf0.001")
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") > 0 and "get_json_object" not in plan
