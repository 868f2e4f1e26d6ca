"""T1 landing: all-text bronze, audit columns, missing files skipped,
idempotent re-runs per ingest date."""

from __future__ import annotations

import os

from forecourt.sources import bronze


def test_land_all(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "erp_parts.csv"), "w") as f:
        f.write("part_number,unit_cost_ngn,reorder_point\nP-1,\"NGN1,200.00\",N/A\nP-2,300,\n")
    with open(os.path.join(raw, "dms_technicians.csv"), "w") as f:
        f.write("technician_id,hourly_rate_ngn,_ingested_at\nT1,3500,2024-05-31 23:00:00\n")
    out = os.path.join(tmpdir_path, "bronze")
    rep = bronze.land_all(spark, raw, out, "2024-06-01 06:00:00", "2024-06-01")
    assert rep.loaded == {"dms.technicians": 1, "erp.parts": 2}
    assert "dms.work_orders" in rep.skipped and len(rep.skipped) == 10
    parts = bronze.read_bronze(spark, out, "erp", "parts", "2024-06-01")
    assert all(t == "string" for _, t in parts.dtypes if _ != "_ingest_date")
    rows = {r.part_number: r for r in parts.collect()}
    assert rows["P-1"].unit_cost_ngn == "NGN1,200.00" and rows["P-1"].reorder_point == "N/A"
    assert rows["P-2"]._ingested_at == "2024-06-01 06:00:00"
    tech = bronze.read_bronze(spark, out, "dms", "technicians").collect()[0]
    assert tech._ingested_at == "2024-05-31 23:00:00"  # kept when the extract has one
    # re-run the same day: partition overwritten, not duplicated; another day appends
    bronze.land_all(spark, raw, out, "2024-06-01 07:00:00", "2024-06-01")
    bronze.land_all(spark, raw, out, "2024-06-02 06:00:00", "2024-06-02")
    all_parts = bronze.read_bronze(spark, out, "erp", "parts")
    assert all_parts.count() == 4
    assert sorted(str(r[0]) for r in all_parts.select("_ingest_date").distinct().collect()) == [
        "2024-06-01", "2024-06-02"]


def test_landing_does_not_sort_its_rows(spark, tmpdir_path, monkeypatch):
    raw, seen, land = os.path.join(tmpdir_path, "raw"), [], bronze.land_entity
    os.makedirs(raw)
    with open(os.path.join(raw, "erp_parts.csv"), "w") as f:
        f.write("part_number,unit_cost_ngn\nP-1,1\nP-2,2\n")
    monkeypatch.setattr(bronze, "land_entity", lambda s, *a: (seen.append(s.conf.get("spark.sql.maxConcurrentOutputFileWriters")), land(s, *a))[1])
    rep = bronze.land_all(spark, raw, os.path.join(tmpdir_path, "out"), "2024-06-01 06:00:00", "2024-06-01")
    assert rep.loaded == {"erp.parts": 2}
    assert [int(x) > 0 for x in seen] == [True]  # with 0, Spark sorts by the partition column before it writes
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
