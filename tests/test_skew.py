"""A hot work order with about a third of all lines, and two thirds of the lines
without a part number: results are the same whether joins are broadcast,
shuffled or split."""

from __future__ import annotations


from forecourt.plans import gold, silver
from forecourt.sources import seeds
from tests.test_gold import LINE_COLS, WO_COLS, wo_row


def _inputs(spark):
    wos = [wo_row(f"WO-{i:06d}", "2021-02-01 09:00:00", tech="T1") for i in range(1, 301)]
    lines = []
    for i in range(1, 301):
        n = 1500 if i == 7 else 5
        for ln in range(1, n + 1):
            lt = "part" if ln % 2 else "labour"
            lines.append((f"WO-{i:06d}", str(ln), lt, "P-10" if lt == "part" else "", "x", "2", "100.00",
                          "0.1", "", "215.00"))
    wo = silver.clean_work_orders(spark.createDataFrame(wos, ",".join(f"{c} string" for c in WO_COLS)))
    ln = silver.clean_lines(spark.createDataFrame(lines, ",".join(f"{c} string" for c in LINE_COLS)))
    parts = silver.clean_parts(spark.createDataFrame(
        [("P-10", "Pads", "b", "p", "50.00", "100.00", "s1", "5", "", "NGN")],
        "part_number string, part_description string, category string, subcategory string, unit_cost_ngn string, "
        "unit_price_ngn string, supplier_id string, qty_on_hand string, reorder_point string, currency string"))
    techs = silver.clean_technicians(spark.createDataFrame(
        [("T1", "Ada", "senior", "engine", "2020-01-01", "10.00", "Y")],
        "technician_id string, technician_name string, skill_level string, specialisation string, "
        "hire_date string, hourly_rate_ngn string, is_active string"))
    return wo, ln, parts, techs


def test_hot_order_results_stable_under_skew_split(spark):
    wo, ln, parts, techs = _inputs(spark)
    keys = ["spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold"]
    broadcast = sorted(gold.order_fact(wo, ln, parts, techs, seeds.vat_rates(spark)).collect())
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        base = sorted(gold.order_fact(wo, ln, parts, techs, seeds.vat_rates(spark)).collect())
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1k")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        skewed = sorted(gold.order_fact(wo, ln, parts, techs, seeds.vat_rates(spark)).collect())
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert base == skewed == broadcast
    hot = [r for r in base if r["wo_number"] == "WO-000007"][0]
    assert hot["line_count"] == 1500
    assert hot["revenue_ngn"] == 750 * 180 + 750 * 200  # part lines discounted 10%, labour not


def test_fact_joins_orders_and_lines_once(spark):
    wo, ln, parts, techs = _inputs(spark)
    plan = gold.order_fact(wo, ln, parts, techs, seeds.vat_rates(spark))._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x and "wo_number" in x]
    assert len(joins) == 1 and "LeftOuter" in joins[0]
    assert "NestedLoop" not in plan


def test_lines_without_part_number_are_spread(spark):
    """Rows without a key get many keys, so a shuffled lookup deals them evenly."""
    from pyspark.sql import functions as F

    from forecourt.operators.joins import lookup

    wo, ln, parts, techs = _inputs(spark)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        dim = parts.select(F.col("part_number").alias("p"), "unit_cost_ngn")
        out = lookup(ln.where("line_type = 'labour'"), dim, F.when(F.col("line_type") == "part", F.col("part_number")), "p",
                     F.col("line_id"))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
