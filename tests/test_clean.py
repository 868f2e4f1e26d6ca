"""Golden cases for the cleaning rules (literal tables, see FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from forecourt.functions import clean as C
from forecourt.functions import vin as V


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_numeric_goldens(spark):
    cases = {
        "2500.00": "2500.00", "NGN3,500.00": "3500.00", "NGN 9000.00": "9000.00", "3,500.00": "3500.00",
        "145,300 km": "145300.00", "145300KM": "145300.00", "3,5": "3.50", "4 hrs": "4.00",
        "1,234,567.89": "1234567.89", "₦1,200": "1200.00", "0,75": "0.75", "12.5 HOURS": "12.50",
        "-500": "-500.00", "145,300KM": "145300.00", "145KMS": "145.00", " NGN 10.00 ": "10.00",
    }
    got = one_col(spark, list(cases), lambda c: C.to_decimal(c, 14, 2))
    assert [str(g) for g in got] == list(cases.values())
    assert one_col(spark, ["", "   ", None, "abc"], lambda c: C.to_decimal(c, 14, 2)) == [None] * 4


def test_to_int_rounds_fractions(spark):
    assert one_col(spark, ["145.6", "145.4", "-2.5", "1,000"], C.to_int) == [146, 145, -3, 1000]


def test_booleans(spark):
    vals = ["y", "yes", "1", "TRUE", " t ", "N", "no", "0", "false", "F", "", "maybe", None]
    assert one_col(spark, vals, C.to_bool) == [True] * 5 + [False] * 5 + [None] * 3


def test_timestamps(spark):
    got = one_col(spark, ["1414393405123", "15/10/2025", "2025-12-12 15:31:51", "15/10/2025 12:00", "abc",
                          "141439340512"], C.parse_ts)
    assert got[0] == dt.datetime(2014, 10, 27, 7, 3, 25, 123000)
    assert got[1] == dt.datetime(2025, 10, 15)
    assert got[2] == dt.datetime(2025, 12, 12, 15, 31, 51)
    assert got[3:] == [None, None, None]
    closed = one_col(spark, ["1900-01-01", "2024-01-02"], lambda c: C.null_placeholder_ts(C.parse_ts(c)))
    assert closed == [None, dt.datetime(2024, 1, 2)]


def test_phones(spark):
    got = one_col(spark, ["08031234567", "0803 123 4567", "+2348031234567", "06031234567", "123"], C.phone_e164)
    assert got == ["+2348031234567", "+2348031234567", "+2348031234567", None, None]


def test_order_numbers_and_sentinels(spark):
    got = one_col(spark, ["WO-000123", "WO000123", "W/O 000123", "wo-000123", " WO/7 "], C.order_number)
    assert got == ["WO-000123"] * 4 + ["WO-7"]
    got = one_col(spark, ["", "UNASSIGNED", "n/a", "-", " tech-01 ", None], C.sentinel_null)
    assert got == [None, None, None, None, "TECH-01", None]


def test_discount_percent_or_fraction(spark):
    got = one_col(spark, ["10", "5.0", "0.1", "1", ""], C.percent_or_fraction)
    assert got == [Decimal("0.10000"), Decimal("0.05000"), Decimal("0.10000"), Decimal("1.00000"), None]


def test_vocabularies(spark):
    got = one_col(spark, ["1", " open ", "In Progress", "waiting parts", "closed", "Canceled", "xyz", None], C.status)
    assert got == ["open", "open", "in_progress", "awaiting_parts", "completed", "cancelled", "unknown", "unknown"]
    got = one_col(spark, ["Labour", " PART ", "return", "misc"], C.line_type)
    assert got == ["labour", "part", "return", "unknown"]


def test_vin_rules(spark):
    got = one_col(spark, ["1hgcm-82633a00435 2", "1HGCM82633A004352X"], C.vin_strip)
    assert got == ["1HGCM82633A004352", "1HGCM82633A004352X"]
    # a VIN with a correct ISO 3779 check digit (position 9 = '3')
    assert one_col(spark, ["1HGCM82633A004352", "1HGCM82634A004352"], V.check_digit_ok) == [True, False]


def test_hour_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59), dt.datetime(2024, 1, 1, 11, 1)),
                                (dt.datetime(2024, 1, 1, 11, 1), dt.datetime(2024, 1, 1, 10, 59)),
                                (dt.datetime(2024, 1, 1, 11, 1), None)], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(C.hour_boundaries("a", "b")).collect()] == [1, -1, None]


def test_text_rules(spark):
    assert one_col(spark, ["  a   b  ", "   ", None], C.collapse_ws) == ["a b", None, None]
    assert one_col(spark, [" p-00.12 ", "P0012"], C.part_key) == ["P0012", "P0012"]
    assert one_col(spark, ["  bRAKE   pads "], C.sentence_case) == ["Brake pads"]


def test_money_and_units_roundtrip_property(spark):
    """Random amounts rendered in every source style clean back exactly."""
    import random

    rnd = random.Random(11)
    rows, expect = [], []
    for _ in range(400):
        cents = rnd.randint(0, 10**11)
        v = Decimal(cents) / 100
        grouped = f"{v:,.2f}"
        for text in (f"{v:.2f}", f"NGN{grouped}", grouped, f"NGN {v:.2f}", f"₦{grouped}", f" {grouped} "):
            rows.append((text,))
            expect.append(v.quantize(Decimal("0.01")))
        km = rnd.randint(0, 2_000_000)
        for text in (f"{km}", f"{km:,} km", f"{km}KM", f"{km:,}KM", f"{km}KMS"):
            rows.append((text,))
            expect.append(Decimal(km).quantize(Decimal("0.01")))
        frac = rnd.randint(0, 999)
        rows.append((f"{frac // 100},{frac % 100:02d}",))  # decimal comma, never a thousands group
        expect.append(Decimal(frac) / 100)
    df = spark.createDataFrame(rows, "x string")
    got = [r[0] for r in df.select(C.to_decimal("x", 18, 2)).collect()]
    assert got == expect


def test_padded_equals_the_formatter(spark):
    from forecourt.sources.star_extracts import padded

    numbers = [0, 7, 99999, 100000, 123456789, 2**62, -1, -123456, None]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for width in (1, 2, 5, 8):
        rows = df.select(padded(F.col("n"), width).alias("a"), F.format_string(f"%0{width}d", "n").alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows]


def test_lines_need_no_alias_where_no_part_number_is_asked_for(spark):
    from forecourt.plans import silver
    from forecourt.sources import star_extracts as X
    from forecourt.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    lines = silver.clean_lines(X.work_order_lines_raw(t.lineitem), X.part_number_aliases(t.part))
    assert "Join" not in lines.select("line_id", "wo_number")._jdf.queryExecution().optimizedPlan().toString()
    alias = spark.createDataFrame([("ALT1", "P2"), ("ALT1", "P1")], "alias string, part_number string")
    raw = X.work_order_lines_raw(t.lineitem).limit(1).withColumn("part_number", F.lit("alt-1"))
    assert [r.part_number for r in silver.clean_lines(raw, alias).collect()] == ["P1"]


def test_check_digit_of_odd_vins(spark):
    odd = ["1HGCM82633A00435I", "1hgcm82633a004352", "+1234567890123456", "1HGCM82633A0043", "", None, "11111111111111111", "1M8GDM9AXKP042788"]
    assert one_col(spark, odd, V.expected_check_digit) == [None, None, None, None, None, None, "1", "X"]


def test_check_digit_calls_no_function_per_character(spark):
    plan = spark.createDataFrame([("1",)], "c string").select(V.check_digit_ok(F.col("c")))._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "split(" not in plan


def test_numbers_are_trimmed_once_and_times_meet_few_patterns(spark):
    from pyspark.sql import functions as F

    from forecourt.functions import clean as C

    rows = [(" NGN 1,234.50 ",), (" 1,234 ",), ("\t12,5 km ",), ("  ",), ("",), (None,), ("1 2",), (" ₦ 7",)]
    df = spark.createDataFrame(rows, "x string")
    got = [r[0] for r in df.select(C.clean_numeric("x")).collect()]
    assert got == ["1234.50", "1234", "12.5", None, None, None, "1 2", "7"]
    plan = df.select(C.clean_numeric("x").alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 1
    times = ["1700000000000", "1700000000000\n", "1700000000000\r\n", "170000000000", "17000000000000", "05/03/2024", "05/03/2024 10:00", "5/3/2024",
             "2024-03-05", "2024-03-05 10:11:12", " 2024-03-05", "2024-13-05", "20240305-1", "ab-cd", "", None]
    t = spark.createDataFrame([(x,) for x in times], "x string")
    x = F.col("x")
    plain = (F.when(x.rlike(r"^\d{13}$"), F.timestamp_millis(x.try_cast("bigint")).cast("timestamp_ntz"))
             .when(x.rlike(r"^\d{2}/\d{2}/\d{4}"), F.try_to_timestamp(x, F.lit("dd/MM/yyyy")).cast("timestamp_ntz"))
             .when(x.rlike(r"^\d{4}-\d{2}-\d{2}"), x.try_cast("timestamp_ntz")))
    assert [r[0] for r in t.select(C.parse_ts("x")).collect()] == [r[0] for r in t.select(plain).collect()]
