"""T1 -> T7 through files: the raw extracts are written as CSV, landed as
bronze Parquet, read back as text and run through silver and gold; the
result equals the in-memory run on the same extracts."""

from __future__ import annotations

import os

from forecourt.plans import gold, silver
from forecourt.plans.workshop import Workshop
from forecourt.sources import bronze
from forecourt.sources import star_extracts as X

SF = "/root/testdata/sf0.001"


def test_csv_bronze_silver_gold(spark, tmpdir_path):
    w = Workshop(spark, SF)
    raw_dir = os.path.join(tmpdir_path, "raw")
    extracts = {"dms_work_orders.csv": w.work_orders_raw, "dms_work_order_lines.csv": w.lines_raw,
                "dms_technicians.csv": w.technicians_raw, "erp_parts.csv": w.parts_raw}
    for name, df in extracts.items():
        # quoteAll + emptyValue keep blanks and padded text exactly as produced
        (df.coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True)
           .option("emptyValue", "").csv(os.path.join(tmpdir_path, "csv", name)))
        part = [f for f in os.listdir(os.path.join(tmpdir_path, "csv", name)) if f.endswith(".csv")][0]
        os.makedirs(raw_dir, exist_ok=True)
        os.replace(os.path.join(tmpdir_path, "csv", name, part), os.path.join(raw_dir, name))
    out = os.path.join(tmpdir_path, "bronze")
    rep = bronze.land_all(spark, raw_dir, out, "2024-06-01 06:00:00", "2024-06-01")
    assert set(rep.loaded) == {"dms.work_orders", "dms.work_order_lines", "dms.technicians", "erp.parts"}
    rb = lambda s, e: bronze.read_bronze(spark, out, s, e, "2024-06-01").drop("_ingest_date")
    fact_files = gold.order_fact(
        silver.clean_work_orders(rb("dms", "work_orders"), X.customer_id_migration(w.t.customer)),
        silver.clean_lines(rb("dms", "work_order_lines"), X.part_number_aliases(w.t.part)),
        silver.clean_parts(rb("erp", "parts")), silver.clean_technicians(rb("dms", "technicians")), w.vat_rates)
    fact_mem = w.order_fact(w.work_orders)
    cols = [c for c in fact_mem.columns]
    assert sorted(fact_files.select(*cols).collect()) == sorted(fact_mem.select(*cols).collect())
