"""Operators against brute-force references on small fixtures, including a
hot key holding a large share of the rows."""

from __future__ import annotations

import datetime as dt
import random
from pyspark.sql import Window
from pyspark.sql import functions as F

from forecourt.operators import entity as ER
from forecourt.operators import quality as Q
from forecourt.operators import quarantine as QU
from forecourt.operators.dedup import latest_by
from forecourt.operators.components import star_forest
from forecourt.operators.joins import asof_join, effective_join, lookup
from forecourt.operators.scd import scd2
from forecourt.operators.sequential import next_value, previous_value, running_max_before


def _events(spark, n=3000, hot_share=0.34, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = "HOT" if rnd.random() < hot_share else f"K{rnd.randint(0, 40)}"
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        rows.append((key, ts, i, rnd.randint(0, 500), rnd.choice(["a", "b", "c"])))
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v int, attr string")


def test_sequential_ops_match_plain_windows(spark):
    df = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ref = df.select("id", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pm"),
                    F.lag("v").over(w).alias("pv"), F.lead("v").over(w).alias("nv"))
    got = running_max_before(df, "k", "ts", "id", "v", out="pm")
    got = previous_value(got, "k", "ts", "id", "v", out="pv")
    got = next_value(got, "k", "ts", "id", "v", out="nv")
    a = sorted(ref.collect())
    b = sorted(got.select("id", "pm", "pv", "nv").collect())
    assert a == b


def test_scd2_matches_reference(spark):
    df = _events(spark, n=800)
    w = Window.partitionBy("k").orderBy("ts", "id")
    ch = df.withColumn("p", F.lag("attr").over(w)).where(F.col("p").isNull() | (F.col("p") != F.col("attr")))
    ref = ch.select("k", "attr", F.col("ts").alias("valid_from"), F.lead("ts").over(w).alias("valid_to"))
    got = scd2(df, "k", "ts", "id", ["attr"]).select("k", "attr", "valid_from", "valid_to")
    assert sorted(ref.collect()) == sorted(got.collect())


def test_latest_by_tie_break(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("b", 2, 1)], "k string, t int, id int")
    got = latest_by(df, ["k"], [F.col("t").desc(), F.col("id").desc()]).orderBy("k").collect()
    assert [(r.k, r.id) for r in got] == [("a", 7), ("b", 1)]


def test_effective_join_equals_range_condition(spark):
    rnd = random.Random(5)
    day = lambda: dt.date(2014, 1, 1) + dt.timedelta(days=rnd.randint(0, 4000))
    dates = [day() for _ in range(300)] + [None, dt.date(1, 1, 1), dt.date(9999, 12, 31)]
    ranges = [(a, a + dt.timedelta(days=rnd.randint(-3, 900)), i) for i, a in enumerate(day() for _ in range(60))]
    ranges += [(dt.date(2020, 1, 1), dt.date(9999, 12, 31), 100), (None, dt.date(2020, 1, 1), 101)]  # overlaps fan out
    facts = spark.createDataFrame(list(enumerate(dates)), "id int, d date")
    rates = spark.createDataFrame(ranges, "valid_from date, valid_to date, rate int")
    expected = []
    for i, d in enumerate(dates):
        hit = [r for a, b, r in ranges if a and d and a <= d <= b]
        expected += [(i, r) for r in hit or [-1]]
    for known in (None, facts.select("d")):
        got = effective_join(facts, rates, F.col("d"), "valid_from", "valid_to", dates=known)
        assert sorted((r.id, -1 if r.rate is None else r.rate) for r in got.collect()) == sorted(expected)
    plan = effective_join(facts, rates, F.col("d"), "valid_from", "valid_to")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_join(spark):
    rnd = random.Random(6)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))
    facts = [(i, rnd.choice(["hot", "hot", "hot", "x", "none", None]), day()) for i in range(400)] + [(400, "x", None)]
    quotes = [(rnd.choice(["hot", "x", "only"]), day(), i) for i in range(60)]
    quotes += [("hot", dt.date(2020, 6, 1), 1000), ("hot", dt.date(2020, 6, 1), 1001)]  # a tie: the larger value
    f = spark.createDataFrame(facts, "id int, k string, t date")
    q = spark.createDataFrame(quotes, "k string, t0 date, v int")
    for keys in (["k"], []):
        got = {r.id: (r.t0_used, r.v) for r in asof_join(f, q if keys else q.drop("k"), keys, "t", "t0", ["v"]).collect()}
        for i, k, t in facts:
            old = [(t0, v) for kq, t0, v in quotes if t and t0 <= t and (not keys or kq == k)]
            assert got[i] == (max(old) if old else (None, None))
    plan = asof_join(f, q.drop("k"), [], "t", "t0", ["v"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_times_have_no_place(spark):
    """A row without time gets no predecessor and is nobody's."""
    base = dt.datetime(2024, 1, 1)
    rows = [("a", base, 1, 10), ("a", None, 2, 99), ("a", base + dt.timedelta(days=3), 3, 12), ("b", None, 4, 5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v int")
    got = running_max_before(df, "k", "ts", "id", "v", out="pm")
    got = next_value(previous_value(got, "k", "ts", "id", "v", out="pv"), "k", "ts", "id", "v", out="nv")
    assert {r.id: (r.pm, r.pv, r.nv) for r in got.collect()} == {
        1: (None, None, 12), 2: (None, None, None), 3: (10, 10, None), 4: (None, None, None)}


def test_lookup_spreads_rows_without_key(spark):
    fact = spark.range(400).select("id", F.when(F.col("id") % 4 == 0, F.lit("p")).alias("k"))
    dim = spark.createDataFrame([("p", 7), ("q", 8)], "dk string, v int")
    out = lookup(fact, dim, F.col("k"), "dk", F.col("id"))
    assert out.columns == ["id", "k", "v"]
    assert {(r.k, r.v) for r in out.collect()} == {("p", 7), (None, None)} and out.count() == 400


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def _groups(rows, tau):
    """Smallest id reachable over pairs of a block within ``tau`` edits."""
    parent = {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (ia, ba, sa) in enumerate(rows):
        for ib, bb, sb in rows[n + 1:]:
            if ba == bb and abs(len(sa) - len(sb)) <= tau and _lev(sa, sb) <= tau:
                a, b = sorted((root(ia), root(ib)))
                parent[b] = a
    return {i: root(i) for i in parent}


def test_fuzzy_groups_equal_brute_force(spark):
    """Names of every length, the shortest included."""
    rnd = random.Random(3)
    names = {"ab", "xy", "abc", "abd", "xyz", "qrst", "a"}
    while len(names) < 200:
        base = "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 14)))
        names.add(base)
        if rnd.random() < 0.4:
            s = list(base)
            s[rnd.randrange(len(s))] = rnd.choice("abcdefgh")
            names.add("".join(s))
    rows = [(f"id{i:04d}", f"city{i % 4}", n) for i, n in enumerate(sorted(names))]
    df = spark.createDataFrame(rows, "id string, blk string, s string")
    of = {i: (b, s) for i, b, s in rows}
    for tau in (1, 2, 4):
        links = ER.fuzzy_links(df, "id", "blk", "s", tau)
        for r in links.collect():
            assert of[r.src][0] == of[r.dst][0] and _lev(of[r.src][1], of[r.dst][1]) <= tau
        comp = ER.connected_components(df, links)
        assert {r.id: r.component for r in comp.collect()} == _groups(rows, tau)
    queue = {r.id: (r.match_group, r.review_group) for r in ER.review_queue(df, "id", "s", "blk", 1, 3).collect()}
    near, far = _groups(rows, 1), _groups(rows, 3)
    several = {g for g in far.values() if len({near[i] for i in far if far[i] == g}) > 1}
    assert queue == {i: (near[i], far[i]) for i in far if far[i] in several}


def test_long_chain_is_one_component(spark):
    n = 700
    edges = spark.createDataFrame([(f"{(i * 7919) % n:04d}", f"{((i + 1) * 7919) % n:04d}") for i in range(n - 1)], "src string, dst string")
    both = edges.unionByName(spark.createDataFrame([("x", "y"), ("x", "x"), (None, "z")], "src string, dst string"))
    forest = star_forest(both)
    assert {(r.id, r.component) for r in forest.collect()} == {(f"{i:04d}", "0000") for i in range(1, n)} | {("y", "x")}


def test_connected_components_and_star_edges(spark):
    df = spark.createDataFrame([("a", "p1"), ("b", "p1"), ("c", "p1"), ("d", "p2"), ("e", None)], "id string, ph string")
    e = ER.star_edges(df, "id", "ph")
    assert sorted(tuple(r) for r in e.collect()) == [("b", "a"), ("c", "a")]  # star, not all pairs
    extra = spark.createDataFrame([("d", "c")], "src string, dst string")
    comp = ER.connected_components(df.select("id"), e.unionByName(extra))
    assert {r.id: r.component for r in comp.collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e"}


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", "open"), (1, None, "bad"), (2, "c", None)], "k int, n string, s string")
    nn = {r.column_name: r.failing_rows for r in Q.not_null(df, "t", ["k", "n", "s"]).collect()}
    assert nn == {"k": 0, "n": 1, "s": 1}
    assert Q.unique(df, "t", "k").collect()[0].failing_rows == 1
    assert Q.accepted_values(df, "t", "s", ["open"]).collect()[0].failing_rows == 1  # NULL passes
    rates = spark.createDataFrame([("x", dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
                                   ("x", dt.date(2020, 6, 1), dt.date(2021, 12, 31)),
                                   ("x", dt.date(2022, 3, 1), dt.date(2099, 12, 31))], "k string, f date, t date")
    assert [r.issue for r in Q.range_issues(rates, ["k"], "f", "t").orderBy("f").collect()] == ["overlap", "gap"]


def test_quarantine_routes_each_failed_rule(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None), (4, -9)], "id int, q int")
    q = QU.route_many(df, "line", "id", {"negative_quantity": F.col("q") < 0, "huge": F.abs("q") > 8})
    assert sorted((r.record_key, r.reason) for r in q.collect()) == [("2", "negative_quantity"), ("4", "huge"), ("4", "negative_quantity")]
    assert all('"q":-' in r.payload for r in q.collect())


def test_quarantine_life_cycle(spark):
    """Against plain sets over five runs, the second of them repeated."""
    runs = [("d1", ["a", "b", "c"]), ("d2", ["b", "c", "d", "d"]), ("d2", ["b", "c", "d", "d"]), ("d3", []), ("d4", ["a", "d", "e"]), ("d5", ["a", "e"])]
    state, expected, done = None, {}, set()
    for day, keys in runs:
        found = spark.createDataFrame([("part", k, "negative_stock", None, f"{{{k}}}") for k in keys],
                                      "entity string, record_key string, reason string, business_ts timestamp_ntz, payload string")
        state = QU.life_cycle(state, found, day).checkpoint()
        if day not in done:
            for k in set(keys):
                old = expected.get(k)
                status = "new" if old is None else "reopened" if old[0] == "resolved" else "open"
                expected[k] = (status, old[1] if old else day, day, None)
            for k in set(expected) - set(keys):
                status, first, last, gone = expected[k]
                expected[k] = ("resolved", first, last, gone or day)
        done.add(day)
        assert {r.record_key: (r.status, r.first_seen, r.last_seen, r.resolved_on) for r in state.collect()} == expected
        assert state.count() == len(expected)


def test_snapshots(spark):
    from forecourt.operators import snapshots

    days = {"1": [("a", "1", None), ("b", "1", "x"), ("b", "1", "x"), ("c", "1", "x"), (None, "9", "9")], "2": [("a", "1", ""), ("b", "1", "x"), ("d", "1", "x")],
            "3": [("a", "1", None), ("c", "1", "x"), ("d", "2", "y")]}
    all_days = spark.createDataFrame([(*r, d) for d, rows in days.items() for r in rows], "k string, p string, q string, day string")
    diff = lambda x, y: {(r.k, r.change, tuple(r.changed_columns)) for r in snapshots.compare(
        all_days.where(f"day = '{x}'"), all_days.where(f"day = '{y}'"), "k", ["p", "q"]).collect()}
    assert diff(1, 2) == {("a", "changed", ("q",)), ("c", "withdrawn", ()), ("d", "added", ())}
    assert diff(2, 3) == {("a", "changed", ("q",)), ("b", "withdrawn", ()), ("c", "added", ()), ("d", "changed", ("p", "q"))}
    assert diff(1, 9) == {("a", "withdrawn", ()), ("b", "withdrawn", ()), ("c", "withdrawn", ())}
    table = snapshots.effective(all_days, "k", "day", ["p", "q"])
    assert sorted(tuple(r) for r in table.select("k", "p", "valid_from", "valid_to", "is_current").collect()) == [
        ("a", "1", "1", "2", False), ("a", "1", "2", "3", False), ("a", "1", "3", None, True), ("b", "1", "1", "3", False),
        ("c", "1", "1", "2", False), ("c", "1", "3", None, True), ("d", "1", "2", "3", False), ("d", "2", "3", None, True)]


def test_raise_on_failures(spark):
    import pytest

    df = spark.createDataFrame([(1,), (None,)], "k int")
    report = Q.not_null(df, "t", ["k"])
    with pytest.raises(Q.DataQualityError):
        Q.raise_on_failures(report)
    Q.raise_on_failures(report, allow={"t.k"})


def test_cluster_conf_sizing():
    from forecourt.session import cluster_conf

    c = cluster_conf(100 << 40, 4000)
    assert int(c["spark.sql.shuffle.partitions"]) == 157287  # 30 TiB shuffled / 200 MiB, rounded up
    assert int(cluster_conf(1 << 30, 8)["spark.sql.shuffle.partitions"]) == 16  # floor: 2 per core


def test_stored_history_takes_batches_in_any_order(spark, tmpdir_path):
    """Late, repeated and confirming events; equals the one-shot history after every batch."""
    import os
    import random

    from forecourt.operators.scd import history, merge_history

    rng, columns = random.Random(3), "k string, ts timestamp, id int, attr string"
    rows = [(rng.choice("aaab") if i % 9 else None, dt.datetime(2024, 1, 1 + rng.randrange(9), rng.randrange(24)), i, rng.choice("xy")) for i in range(90)]
    store, seen = os.path.join(tmpdir_path, "h"), []
    for batch in (rows[50:], rows[:30], rows[20:55]):
        seen += batch
        merge_history(spark.createDataFrame(batch, columns), store, "k", "ts", "id", ["attr"], buckets=4)
        whole = spark.createDataFrame(sorted(set(seen), key=repr), columns).where("k is not null")
        want = scd2(whole, "k", "ts", "id", ["attr"])
        assert sorted(map(tuple, history(spark, store, "k", "ts", ["attr"]).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_stored_components_equal_a_rebuild(spark, tmpdir_path):
    import os

    from forecourt.operators.components import merge_links, root_history, star_forest, stored_forest

    batches = [[(5, 6), (8, 9), (1, 1), (None, 3)], [(6, 8), (20, 21), (22, 21)], [(6, 8)], [(9, 2), (21, 30)], [(2, 20)]]
    store, seen = os.path.join(tmpdir_path, "c"), []
    for k, batch in enumerate(batches):
        seen += batch
        merge_links(spark.createDataFrame(batch, "src int, dst int"), store, k, buckets=4)
        want = star_forest(spark.createDataFrame(seen, "src int, dst int"))
        assert sorted(map(tuple, stored_forest(spark, store).collect())) == sorted(map(tuple, want.collect()))
    moved = {(r.id, r.merged_into, r.batch) for r in root_history(spark, store).collect()}
    assert {(8, 5, 1), (5, 2, 3), (20, 2, 4)} <= moved and not any(b == 2 for _, _, b in moved)


def test_generations_survive_a_lost_call(spark, tmpdir_path, monkeypatch):
    import pytest

    from forecourt.sources import generations

    def rows(tag):
        return spark.createDataFrame([(p, tag) for p in (1, 2)], "part int, tag string")

    def content():
        return sorted((r.part, r.tag) for r in generations.read(spark, tmpdir_path, "part").collect())

    generations.replace(spark, tmpdir_path, rows("a"), "part", [1, 2])
    with monkeypatch.context() as m:
        m.setattr(generations, "publish_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            generations.replace(spark, tmpdir_path, rows("b"), "part", [1, 2])
    assert content() == [(1, "a"), (2, "a")]
    generations.replace(spark, tmpdir_path, rows("c").where("part = 2"), "part", [2])
    assert content() == [(1, "a"), (2, "c")]
    generations.replace(spark, tmpdir_path, rows("d").where("false"), "part", [1])
    assert content() == [(2, "c")]


def test_ledger_checkpoints(spark, tmpdir_path):
    """Back-dated, repeated and corrected movements; a day reads its own month only."""
    from forecourt.operators import ledger

    columns = "movement_id string, part_number string, signed_qty int, movement_ts timestamp_ntz"
    t = lambda m, d, h=0: dt.datetime(2024, m, d, h)
    batches = [[("a", "p", 10, t(1, 5)), ("b", "q", 4, t(2, 1)), ("c", "p", -3, t(3, 9, 23))],
               [("d", "p", 5, t(1, 31, 23)), ("b", "q", 4, t(2, 1)), (None, "p", 9, t(1, 1))],
               [("e", "q", -1, t(3, 10)), ("a", "p", 11, t(1, 5))]]
    known = {}
    for batch in batches:
        ledger.post(spark.createDataFrame(batch, columns), tmpdir_path)
        known |= {r[0]: r for r in batch if r[0]}
        for day in ("2023-12-31", "2024-01-31", "2024-02-01", "2024-03-09", "2024-12-31"):
            want = {}
            for _, part, q, at in known.values():
                if str(at)[:10] <= day:
                    want[part] = want.get(part, 0) + q
            assert {r.part_number: r.on_hand for r in ledger.balances(spark, tmpdir_path, day).collect()} == want
    files = ledger.balances(spark, tmpdir_path, "2024-03-31").inputFiles()
    assert {f.split("month=")[1][:7] for f in files if "/movements/" in f} == {"2024-03"}
    assert {f.split("month=")[1][:7] for f in files if "/checkpoints/" in f} == {"2024-01", "2024-02"}


def test_fuzzy_links_candidates_need_two_segments(spark):
    """Names that share one segment only are no candidates, and no link of random texts is lost."""
    import random
    rnd = random.Random(11)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(0, 11))) for _ in range(150)})
    df = spark.createDataFrame([(k, "X", w) for k, w in enumerate(words)], "id long, blk string, s string")
    a, b = df.toDF("i", "x", "a"), df.toDF("j", "y", "b")
    for tau in (2, 4):
        links = ER.fuzzy_links(df, "id", "blk", "s", tau)
        plan = links._jdf.queryExecution().optimizedPlan().toString()
        assert "xxhash64(blk" in plan and plan.count("levenshtein") == 1
        near = a.join(b, (F.col("i") < F.col("j")) & (F.levenshtein("a", "b") <= tau)
                      & (F.greatest(F.length("a"), F.length("b")) > tau))
        want = {tuple(r) for r in near.select("i", "j").collect()}
        got = {(min(r), max(r)) for r in links.collect()}
        assert want <= got
        assert all(max(len(words[i]), len(words[j])) <= tau for i, j in got - want)
    # a pair (i, j) of segments at each place once: a name of 12 characters is looked for 63 times, of its own length
    places = ER.probe_places(4)
    assert len(places) == len(set(places)) and sum(p[0] == 0 for p in places) == 63


def test_signatures_reject_chance_candidates_and_no_pair(spark):
    """The distance is taken behind the signatures' test, also where a caller adds a condition, and no pair within
    tau edits is rejected: short and long texts, some not ASCII, changed at any place."""
    import random
    rnd = random.Random(7)
    letters = "abcdefgh é漢1Q\u0000"
    rows = []
    for _ in range(1500):
        a = "".join(rnd.choice(letters) for _ in range(rnd.choice([1, 3, 8, 12, 15, 16, 17, 19, 30])))
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randint(0, len(b))
            b[at:at + rnd.randint(0, 1)] = rnd.choice(["", rnd.choice(letters)])
        rows.append(tuple(sorted((a, "".join(b)), key=len)))
    df = spark.createDataFrame(rows, "a string, b string").withColumn("d", F.length("b") - F.length("a"))
    for tau in (1, 2, 3, 4):
        near = df.where(F.levenshtein("a", "b") <= tau)
        passed = ER.may_be_near(ER.signature(F.col("a")), ER.signature(F.col("b")), F.col("d"), tau)
        assert near.count() > 300 and near.where(~passed).count() == 0
    words = spark.createDataFrame([("".join(rnd.choice("abcdefghijklmnop") for _ in range(12)),) for _ in range(400)], "s string")
    pairs = words.toDF("a").crossJoin(words.toDF("b")).where("a < b and substring(a, 1, 1) = substring(b, 1, 1)")
    passed = ER.may_be_near(ER.signature(F.col("a")), ER.signature(F.col("b")), F.lit(0), 4)
    assert pairs.where(passed).count() < pairs.count() / 20
    names = spark.createDataFrame([(1, "X", "anna bell"), (2, "X", "anna bela")], "id long, blk string, s string")
    plan = ER.fuzzy_links(names, "id", "blk", "s", 2).where("src <> dst")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("bit_count") < plan.index("levenshtein")
