"""Telematics stream: file source, dedup within the watermark, explicit late
split, odometer monotonicity in event-time order, VIN quarantine, and
idempotent replay."""

from __future__ import annotations

import datetime as dt
import json
import os

from forecourt.streaming import telematics as TM


def _ev(i, vin, ts, odo, ing=None):
    ms = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return {"event_id": f"E{i}", "vin": vin, "event_timestamp": f"{ms:013d}", "odometer_km": str(odo),
            "fault_code": " p0300 ", "latitude": "6.5", "longitude": "3.4",
            "_ingested_at": (ing or ts).strftime("%Y-%m-%d %H:%M:%S")}


def _write(path, name, rows):
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_stream_end_to_end(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    v1, v2 = "1HGCM82633A004352", "1HGCM82633A004353"
    t0 = dt.datetime(2024, 1, 10, 12)
    # file 1: normal readings (one duplicate delivery inside the file)
    _write(src, "a.json", [_ev(1, v1, t0, 1000), _ev(2, v1, t0 + dt.timedelta(hours=1), 1100),
                           _ev(2, v1, t0 + dt.timedelta(hours=1), 1100), _ev(3, v2, t0, 50)])
    # file 2: later readings, a regression, an invalid VIN and a re-delivery of E3
    _write(src, "b.json", [_ev(4, v1, t0 + dt.timedelta(days=5), 1500), _ev(5, v1, t0 + dt.timedelta(days=5, hours=1), 1400),
                           _ev(6, "BAD-VIN", t0 + dt.timedelta(days=5), 10), _ev(3, v2, t0, 50)])
    # file 3: a tolerated late reading (1 day behind) that is *not* a regression in event order,
    # and a reading older than the 3-day window (late)
    _write(src, "c.json", [_ev(7, v1, t0 + dt.timedelta(days=4), 1300), _ev(8, v2, t0 - dt.timedelta(days=3), 40),
                           _ev(9, "1HGCM82633A009999", t0 + dt.timedelta(days=5), 10)])  # valid but unknown VIN
    out = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")
    vehicles = spark.createDataFrame([(v1,), (v2,)], "vin string")
    q = TM.start(spark, src, out, ck, max_files_per_trigger=1, known_vins=vehicles)
    q.awaitTermination()
    assert q.exception() is None

    def ids(name):
        p = os.path.join(out, name)
        return sorted(r.event_id for r in spark.read.parquet(p).collect()) if os.path.exists(p) else []

    assert ids("events") == ["E1", "E2", "E3", "E4", "E7"]
    assert ids("quarantine_odometer_regression") == ["E5"]
    assert ids("quarantine_invalid_vin") == ["E6"]
    assert ids("quarantine_late") == ["E8"]
    assert ids("quarantine_unmatched_vin") == ["E9"]
    # the day-partitioned table holds exactly the loaded events, once each
    days = lambda: sorted(r.event_id for r in TM.read_days(spark, out).collect())
    assert days() == ids("events")
    loaded = spark.read.parquet(os.path.join(out, "events"))
    r = loaded.where("event_id = 'E1'").collect()[0]
    assert r.fault_code == "P0300" and r.is_out_of_country is False
    assert r.fault_description.startswith("Random or multiple cylinder misfire")

    # replaying the last batch reproduces the same outputs (idempotent per batch id)
    batch = TM.clean_events(spark.read.schema(TM.RAW_SCHEMA).json(os.path.join(src, "c.json")))
    TM.process_batch(batch, 2, out, vehicles)
    assert ids("quarantine_odometer_regression") == ["E5"]
    assert days() == ids("events") == ["E1", "E2", "E3", "E4", "E7"]


def _folder_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def _batches(t0):
    """Ten batches of three vehicles: late, repeated and regressing readings."""
    vins = ["1HGCM82633A004352", "1HGCM82633A004353", "1HGCM82633A004354"]
    out = []
    for b in range(10):
        rows = [_ev(100 * b + k, vins[k % 3], t0 + dt.timedelta(hours=20 * b + k), 1000 + 50 * b + k) for k in range(6)]
        if b > 1:
            rows.append(_ev(100 * (b - 1) + 2, vins[2], t0 + dt.timedelta(hours=20 * (b - 1) + 2), 1000 + 50 * (b - 1) + 2))  # again
            rows.append(_ev(100 * b + 50, vins[0], t0 + dt.timedelta(hours=20 * b + 7), 900 + b))  # regression
        if b > 5:
            rows.append(_ev(100 * b + 60, vins[1], t0 + dt.timedelta(hours=20 * b - 24), 1))  # late by a day, a regression
            rows.append(_ev(100 * b + 61, vins[1], t0 + dt.timedelta(hours=1), 5000))  # behind the window
        out.append(rows)
    return out


def test_state_deltas_and_day_compaction(spark, tmpdir_path, monkeypatch):
    """Folding state and compacting days, with crashes and replays between, changes no result."""
    import pytest

    batches = [TM.clean_events(spark.createDataFrame([tuple(r[f.name] for f in TM.RAW_SCHEMA) for r in rows], TM.RAW_SCHEMA))
               for rows in _batches(dt.datetime(2024, 1, 10))]
    plain, folded = os.path.join(tmpdir_path, "plain"), os.path.join(tmpdir_path, "folded")
    for k, b in enumerate(batches):
        TM.process_batch(b, k, plain)
    monkeypatch.setattr(TM, "COMPACT_EVERY", 3)
    for k, b in enumerate(batches):
        if k == 5:  # a batch that fails after its state was written and runs again
            with monkeypatch.context() as m:
                m.setattr(TM, "release_state", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    TM.process_batch(b, k, folded)
        TM.process_batch(b, k, folded)
        if k in (3, 6, 8):
            before = sorted(r.event_id for r in TM.read_days(spark, folded).collect())
            with monkeypatch.context() as m:  # a crash before the manifest is there
                m.setattr(TM, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    TM.compact_days(spark, folded)
            assert sorted(r.event_id for r in TM.read_days(spark, folded).collect()) == before
            with monkeypatch.context() as m:  # a crash after it, before old files are deleted
                m.setattr(TM, "drop_scratch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    TM.compact_days(spark, folded)
            assert sorted(r.event_id for r in TM.read_days(spark, folded).collect()) == before
            TM.compact_days(spark, folded)
            assert sorted(r.event_id for r in TM.read_days(spark, folded).collect()) == before
    rows = lambda out: sorted((r.event_id, str(r.event_date), r.odometer_km) for r in TM.read_days(spark, out).collect())
    assert rows(folded) == rows(plain) and len(rows(plain)) == 60
    for sink in ("quarantine_late", "quarantine_odometer_regression"):
        got = [sorted(r.event_id for r in spark.read.parquet(os.path.join(out, sink)).collect()) for out in (plain, folded)]
        assert got[0] == got[1] and len(got[0]) > 3
    # what a batch writes does not grow with what is there
    sizes = [_folder_bytes(os.path.join(plain, "_state", "odometer", f"batch={k}")) for k in (1, 9)]
    assert sizes[1] < 1.5 * sizes[0]
    assert sorted(os.listdir(os.path.join(folded, "_state", "commits"))) == ["batch=8", "batch=9"]
    assert "batch=0" not in os.listdir(os.path.join(folded, "_state", "seen_ids"))
    TM.drop_scratch(spark, os.path.join(folded, "_state", "commits", "batch=9"))
    with pytest.raises(RuntimeError, match="no committed state"):
        TM.process_batch(batches[0], 10, folded)


SINKS = ["events", "quarantine_malformed", "quarantine_late", "quarantine_invalid_vin", "quarantine_unmatched_vin",
         "quarantine_odometer_regression"]


def test_every_event_is_in_one_sink(spark, tmpdir_path):
    """Also events without id, time or readable odometer; they do not touch valid readings."""
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    v = "1HGCM82633A004352"
    t0 = dt.datetime(2024, 1, 10, 12)
    good = [_ev(i, v, t0 + dt.timedelta(hours=i), 1000 + i) for i in range(5)]
    bad = [_ev(10, v, t0, 5000), _ev(11, v, t0, 6000), _ev(12, v, t0, 0), _ev(13, v, t0, 7000), _ev(14, v, t0, 8000)]
    bad[0]["event_id"], bad[1]["event_id"] = None, "  "
    bad[2]["odometer_km"] = "not a number"
    bad[3]["event_timestamp"], bad[4]["event_timestamp"] = None, "garbage"
    _write(src, "a.json", good + bad + [_ev(20, "SHORT", t0, 1), _ev(21, v, t0 + dt.timedelta(hours=9), 12)])
    out = os.path.join(tmpdir_path, "out")
    q = TM.start(spark, src, out, os.path.join(tmpdir_path, "ck"))
    q.awaitTermination()
    assert q.exception() is None
    n = {s: spark.read.schema("event_id string").parquet(os.path.join(out, s)).count() for s in SINKS}
    assert n == {"events": 5, "quarantine_malformed": 5, "quarantine_late": 0, "quarantine_invalid_vin": 1,
                 "quarantine_unmatched_vin": 0, "quarantine_odometer_regression": 1}
    assert sum(n.values()) == len(good) + len(bad) + 2


def test_lag_histograms(spark, tmpdir_path):
    """Percentiles of the stream, fed in two parts with late events, within the error of sorted lags."""
    import math
    import random

    from forecourt.streaming import lag

    rng, t0, src = random.Random(5), dt.datetime(2024, 1, 10), os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    rows, lags = [], {}
    for i in range(400):
        ts = t0 + dt.timedelta(hours=rng.randrange(48))
        seconds = rng.choice([0, 3, 60, rng.randrange(1, 9000)])
        rows.append(_ev(i, "1HGCM82633A004352", ts, i, ts + dt.timedelta(seconds=seconds)))
        lags.setdefault(ts.date(), []).append(seconds)
    for name, part in (("a.json", rows[:250]), ("b.json", rows[250:])):
        _write(src, name, part)
        q = lag.start(spark, src, os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ck"))
        q.awaitTermination()
        assert q.exception() is None
    found = lag.percentiles(lag.stored(spark, os.path.join(tmpdir_path, "out")), [50, 95]).collect()
    assert {r.start.date(): r.n for r in found} == {d: len(x) for d, x in lags.items()}
    for r in found:
        exact = sorted(lags[r.start.date()])
        for p in (50, 95):
            want = exact[math.ceil(len(exact) * p / 100) - 1]
            assert abs(r[f"p{p}"] - want) <= 1.001 * lag.ERROR * want
