"""Quoted CSV in splits, against the csv module and DuckDB's reader."""

from __future__ import annotations

import csv
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forecourt.sources import bronze
from forecourt.sources import csv_records as R


@pytest.fixture()
def split_bytes(spark):
    """Set the size of splits; put back afterwards."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def put(n: int) -> None:
        spark.conf.set(keys[0], str(n))
        spark.conf.set(keys[1], "1")

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


def read(spark, path):
    df = R.read_records(spark, path)
    return df.columns, sorted((tuple(r) for r in df.collect()), key=repr)


def test_fields_as_received(spark, tmpdir_path, split_bytes):
    path = os.path.join(tmpdir_path, "a.csv")
    text = ('﻿id,"na""me",note\r\n1,"say ""hi"", you",x\n2,"two\nlines",\n\n3,5" pipe,"a"b"c\n4,only\n5,a,b,c,d\n6,"",é\r\n'
            '7,"x\r\n\n,""\n",z\n8, , \n9,"unclosed\nrest').encode() + b",\xff"
    with open(path, "wb") as f:
        f.write(text)
    expected = sorted([
        ("1", 'say "hi", you', "x", None), ("2", "two\nlines", None, None), ("3", '5" pipe', 'ab"c', None), ("4", "only", None, "4,only"),
        ("5", "a", "b", "5,a,b,c,d"), ("6", "", "é", None), ("7", 'x\r\n\n,"\n', "z", None), ("8", " ", " ", None),
        ("9", "unclosed\nrest,�", None, '9,"unclosed\nrest,�')], key=repr)
    for n in (7, 40, 1 << 27):
        split_bytes(n)
        assert read(spark, path) == (["id", 'na"me', "note", "_rescued"], expected)


def test_splits_give_equal_rows(spark, tmpdir_path, split_bytes):
    rng = random.Random(1)
    parts = ["a", "b", '"', ",", "\n", "\r\n", " ", "é", "longer words here "]
    rows = [[str(i), *("".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2))] for i in range(300)]
    rows[150][1] = "one\nvery long field, over many splits\n" * 200
    for k in range(3):
        with open(os.path.join(tmpdir_path, f"{k}.csv"), "w", newline="") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerows([["id", "a,\nb", "c"], *rows[k * 100:k * 100 + 100]])
    expected = sorted(((a, b or None, c or None, None) for a, b, c in rows), key=repr)
    duck = duckdb.sql(f"SELECT * FROM read_csv('{tmpdir_path}/*.csv', header = true, all_varchar = true, quote = '\"', escape = '\"', "
                      "delim = ',', max_line_size = 100000, new_line = '\\n')").fetchall()
    assert sorted(((a, b or None, c or None, None) for a, b, c in duck), key=repr) == expected
    for n in (1000, 1 << 27):
        split_bytes(n)
        columns, got = read(spark, tmpdir_path)
        assert columns == ["id", "a,\nb", "c", "_rescued"] and got == expected


def test_other_header_is_an_error(spark, tmpdir_path):
    for name, head in (("a", "x,y"), ("b", "y,x")):
        with open(os.path.join(tmpdir_path, f"{name}.csv"), "w") as f:
            f.write(f"{head}\n1,2\n")
    with pytest.raises(Exception, match="header"):
        R.read_records(spark, tmpdir_path).collect()


def test_empty_files(spark, tmpdir_path):
    for name, text in (("a", ""), ("b", "x,y\n"), ("c", "x,y"), ("d", "\n\nx,y\n\n")):
        with open(os.path.join(tmpdir_path, f"{name}.csv"), "w") as f:
            f.write(text)
        got = read(spark, os.path.join(tmpdir_path, f"{name}.csv"))
        assert got == ((["x", "y", "_rescued"] if name != "a" else ["_rescued"]), [])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(['"', ",", "\n", "a", " "]), max_size=30))
def test_states_follow_the_automaton(parts):
    """Line by line, from either state, as a reader that goes through all characters."""
    line = "".join(parts).replace("\n", "")
    for inside in (False, True):
        state = "quoted" if inside else "start"
        for c in line:
            if state in ("start", "plain"):
                state = "start" if c == "," else "quoted" if c == '"' and state == "start" else "plain"
            elif state == "quoted":
                state = "closing" if c == '"' else "quoted"
            else:
                state = "quoted" if c == '"' else "start" if c == "," else "plain"
        assert R.ends_inside(line, inside) == (state == "quoted")


def test_landing_keeps_records(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "crm_customers.csv"), "w") as f:
        f.write('id,na.`me\n1,"A ""B"", C"\n2,"two\nlines"\n3\n')
    report = bronze.land_all(spark, raw, os.path.join(tmpdir_path, "out"), "2024-06-01 06:00:00", "2024-06-01")
    assert report.loaded == {"crm.customers": 3}
    got = bronze.read_bronze(spark, os.path.join(tmpdir_path, "out"), "crm", "customers")
    assert sorted((r.id, r["na.`me"], r._rescued) for r in got.collect()) == [
        ("1", 'A "B", C', None), ("2", "two\nlines", None), ("3", None, "3")]


def test_kinds_and_states_agree_with_the_patterns(spark, tmpdir_path):
    rng = random.Random(2)
    lines = ["".join(rng.choice('",a \r') for _ in range(rng.randrange(9))) for _ in range(400)] + ['"a",' * 50_000, '"' + '""' * 50_000]
    with open(os.path.join(tmpdir_path, "a.csv"), "w", newline="") as f:
        f.write("\n".join(lines))
    rows = R._lines(spark, tmpdir_path).collect()
    kind = {bytes(r.line).decode(): r.kind for r in rows}
    assert all(kind[x] == R.ends_inside(x, False) + 2 * R.ends_inside(x, True) for x in lines)
    kinds = np.array([kind[x] for x in lines], np.int8)
    for start in (False, True):
        state, expected = start, []
        for x in lines:
            state = R.ends_inside(x, state)
            expected.append(state)
        assert R.inside_after(kinds, start).tolist() == expected


def test_quoted_records_go_in_few_batches():
    """Records with and without quotes in turn are read together, not one by one."""
    lines = pa.array([b'1,"a, b"', b"2,", b'3,"two', b'lines"', b'4,""', b"5,x,y"], pa.binary())
    table, other = R._columns(lines, 2)
    assert table.to_pydict() == {"0": list("1234"), "1": ["a, b", None, "two\nlines", ""]} and other == [b"5,x,y"]
    assert R._columns(pa.array([b"1,\xff"], pa.binary()), 2) is None and R._columns(pa.array([b"1,a\rb"], pa.binary()), 2) is None


def test_pass_one_reads_a_file_once(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "a.csv"), "w", newline="") as f:
        f.write("id,note\n" + "".join(f'{i},"two\nlines"\n' for i in range(500)))
    conf, context = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.sparkContext
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
    context.setJobGroup("pass one", "")
    try:
        opened, unclosed = R.open_splits(spark, tmpdir_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", conf)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert opened and not unclosed
    assert len(context.statusTracker().getJobIdsForGroup("pass one")) == 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet='",a\r', max_size=12), max_size=8), st.integers(0, 3))
def test_kinds_of_a_batch(lines, skipped):
    lines = [*lines, '"' * 200 + ",", '"a",' * 90 + '"']
    array = pa.array([x.encode() for x in lines], pa.binary()).slice(skipped)
    assert R.line_kinds(array).tolist() == [R.ends_inside(x, False) + 2 * R.ends_inside(x, True) for x in lines[skipped:]]


def test_kinds_of_no_lines():
    assert len(R.line_kinds(pa.array([], pa.binary()))) == 0
    assert R.line_kinds(pa.array([b"", b"\xff,"], pa.binary())).tolist() == [R.KEEPS] * 2
