"""Injected faults with known counts (the reference's test strategy): the
corrupted part-line totals are exactly what reconciliation finds among clean
part lines, and the stream flags the same odometer regressions as the batch
operator on the same events."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.operators.events import flag_regressions
from forecourt.plans.workshop import Workshop
from forecourt.sources import star_extracts as X
from forecourt.streaming import telematics as TM

SF = "/root/testdata/sf0.001"


def test_corrupted_part_totals_are_found(spark):
    w = Workshop(spark, SF)
    li = w.t.lineitem
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    # injected: part lines (flag N, or flag R with line number 4 mod 5) with
    # (k * 17 + n) % 50 == 3, without lines that carry another injected fault
    # (negative quantity, negative or unreadable price, missing total, order without a date)
    is_part = (F.col("l_returnflag") == "N") | ((F.col("l_returnflag") == "R") & (ln % 5 == 4))
    corrupted = li.where(is_part & ((k * 17 + ln) % 50 == 3) & (k % 97 != 5) & (k % 193 != 2) & (k % 389 != 1)
                         & (k % 211 != 4) & (k % 333 != 5))
    expected = {f"WO-{r.l_orderkey:06d}-{r.l_linenumber}" for r in corrupted.collect()}
    priced = w.priced_lines(carry=["has_negative_quantity_anomaly", "has_negative_price_anomaly", "has_parse_error"])
    priced = priced.where("opened_at is not null and not has_parse_error")
    found = priced.where((F.col("line_type") == "part") & ~F.col("has_negative_quantity_anomaly")
                         & ~F.col("has_negative_price_anomaly")
                         & C.exceeds_tolerance("line_total_ngn_source_raw", "line_total_recalculated_ngn"))
    got = {r.line_id for r in found.collect()}
    assert expected and got == expected


def test_stream_equals_batch_on_regressions(spark, tmpdir_path):
    raw = X.telematics_raw(spark.read.parquet(f"{SF}/events.parquet"))
    src = os.path.join(tmpdir_path, "in")
    raw.coalesce(1).write.json(src)
    out, ck = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck")
    q = TM.start(spark, src, out, ck)
    q.awaitTermination()
    assert q.exception() is None
    streamed = {r.event_id for r in spark.read.parquet(os.path.join(out, "quarantine_odometer_regression")).collect()}
    loaded = spark.read.parquet(os.path.join(out, "events")).count()
    clean = TM.clean_events(raw)
    malformed = F.col("event_id").isNull() | F.col("event_ts").isNull() | F.col("has_parse_error")
    ev = clean.where(F.col("is_vin_valid") & ~malformed)
    batch = flag_regressions(ev, "vin", "event_ts", "event_id", "odometer_km")
    expected = {r.event_id for r in batch.where("is_regression").collect()}
    assert streamed == expected
    assert loaded + len(streamed) == ev.count()  # nothing late in one batch; every valid reading accounted for
