"""Ledgers, lookups and returns: published examples and brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline.functions import dates
from plumbline.operators import asof, intervals as iv, returns as rt

D = date


def ledger_of(spark, facts, kind="double"):
    rows = [("E", s, e, v, i) for i, (s, e, v) in enumerate(facts)]
    df = spark.createDataFrame(rows, "entity string, start date, end date, value double, ord int").withColumn(
        "value", F.col("value").cast(kind))
    return [(r["start"], r["end"], round(float(r["value"]), 6), r["source"]) for r in
            iv.build_ledger(df, ["entity"]).orderBy("start").collect()]


def brute_ledger(facts):
    """The same rule by plain loops over one entity."""
    first = {}
    for s, e, v in facts:
        if e >= s:
            first.setdefault((s, e), v)
    spans = sorted((((e - s).days + 1, s, e, v) for (s, e), v in first.items()))
    kept = []
    for _, s, e, v in spans:
        if not any(s <= b and a <= e for a, b, _, _ in kept):
            kept.append((s, e, v, "tagged"))
    while True:
        before = len(kept)
        for days, s, e, v in spans:
            parts = sorted(k for k in kept if s <= k[0] and k[1] <= e)
            if not parts or sum((b - a).days + 1 for a, b, _, _ in parts) >= days:
                continue
            holes, at = [], s
            for a, b, _, _ in parts:
                if a > at:
                    holes.append((at, a - timedelta(1)))
                at = max(at, b + timedelta(1))
            if at <= e:
                holes.append((at, e))
            if len(holes) == 1 and not any(holes[0][0] <= b and a <= holes[0][1] for a, b, _, _ in kept):
                rest = v - sum(p[2] for p in parts)
                kept.append((*holes[0], 0.0 if abs(rest) < 1e-9 else rest, "derived_by_difference"))
        if len(kept) == before:
            break
    return sorted((a, b, round(v, 6), src) for a, b, v, src in kept)


def test_unreported_quarters_are_recovered(spark):
    facts = [(D(2025, 1, 1), D(2025, 3, 31), .48), (D(2025, 1, 1), D(2025, 6, 30), .87), (D(2025, 7, 1), D(2025, 9, 30), .39),
             (D(2025, 1, 1), D(2025, 12, 31), 1.65)]
    got = ledger_of(spark, facts, "decimal(18,4)")
    assert [(v, s) for _, _, v, s in got] == [(.48, "tagged"), (.39, "derived_by_difference"), (.39, "tagged"), (.39, "derived_by_difference")]


def test_duplicate_interval_and_ambiguous_total(spark):
    q = (D(2025, 4, 1), D(2025, 6, 30), .4)
    assert len(ledger_of(spark, [q, (q[0], q[1], .5)])) == 1
    assert ledger_of(spark, [q, (D(2025, 1, 1), D(2025, 12, 31), 1.6)]) == [(*q, "tagged")]


def test_ledger_matches_plain_loops_and_is_disjoint(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for n in range(40):
        facts = []
        for _ in range(rnd.randint(1, 9)):
            s = D(2024, 1, 1) + timedelta(days=30 * rnd.randint(0, 12))
            facts.append((s, s + timedelta(days=30 * rnd.choice([1, 3, 3, 6, 9, 12]) - 1), float(rnd.randint(1, 50))))
        rows += [(f"E{n}", s, e, v, i) for i, (s, e, v) in enumerate(facts)]
        want[f"E{n}"] = brute_ledger(facts)
    df = spark.createDataFrame(rows, "entity string, start date, end date, value double, ord int").repartition(5)
    got = {}
    for r in iv.build_ledger(df, ["entity"]).collect():
        got.setdefault(r["entity"], []).append((r["start"], r["end"], round(r["value"], 6), r["source"]))
    assert {k: sorted(x) for k, x in got.items()} == want
    for periods in got.values():
        ordered = sorted(periods)
        assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_ledger_under_long_totals_matches_plain_loops(spark):
    rnd = random.Random(5)
    rows, want = [], {}
    for n in range(60):
        facts, months = [], 24
        for _ in range(rnd.randint(4, 22)):
            at, size = rnd.randint(0, months - 1), rnd.choice([1, 1, 2, 3, 3, 4, 6, 9, 12, 18, 24, 30])
            s = D(2024, 1, 1) + timedelta(days=30 * at + rnd.choice([0, 0, 0, 7]))
            facts.append((s, s + timedelta(days=30 * size - 1), float(rnd.randint(1, 90))))
        facts.append((D(2023, 6, 1) if n % 2 else D(2024, 1, 1), D(2026, 12, 31) if n % 3 else D(2025, 12, 20), 500.0))
        rows += [(f"E{n}", s, e, v, i) for i, (s, e, v) in enumerate(facts)]
        want[f"E{n}"] = brute_ledger(facts)
    df = spark.createDataFrame(rows, "entity string, start date, end date, value double, ord int").repartition(5)
    got = {}
    for r in iv.build_ledger(df, ["entity"]).collect():
        got.setdefault(r["entity"], []).append((r["start"], r["end"], round(r["value"], 6), r["source"]))
    assert {k: sorted(x) for k, x in got.items()} == want
    assert sum(x[3] != "tagged" for rows in want.values() for x in rows) > 20


def test_a_whole_history_waits_for_its_parts_and_holds_no_others_up(spark):
    """Quarters of ten years with every second one unstated, half years, and totals over everything."""
    quarter = lambda k: D(2010 + k // 4, 3 * (k % 4) + 1, 1)
    day = timedelta(1)
    facts = [(quarter(k), quarter(k + 1) - day, 1.0) for k in range(0, 40, 2)]
    facts += [(quarter(k), quarter(k + 2) - day, 3.0) for k in range(0, 40, 2)]
    facts += [(quarter(0), quarter(41) - day, 100.0), (D(2000, 1, 1), D(2040, 1, 1), 7.0)]
    got = ledger_of(spark, facts, "decimal(18,4)")
    assert got == brute_ledger(facts) and len(got) == 41 and got[-1][2] == 40.0


def test_incomplete_window_is_reported(spark):
    led = spark.createDataFrame([("E", D(2025, 1, 1), D(2025, 3, 31), .5)], "entity string, start date, end date, value double")
    win = spark.createDataFrame([("E", D(2025, 1, 1), D(2025, 12, 31)), ("E", D(2025, 1, 1), D(2025, 4, 5))],
                                "entity string, window_start date, window_end date")
    got = {r["window_end"]: (r["total"], r["complete"]) for r in iv.sum_between(led, win, ["entity"]).collect()}
    assert got == {D(2025, 12, 31): (.5, False), D(2025, 4, 5): (.5, True)}


def test_gaps_match_marking_days(spark):
    rnd = random.Random(4)
    outer, cover = [], []
    for n in range(15):
        outer.append((n, D(2025, 1, 1), D(2025, 12, 31)))
        for _ in range(rnd.randint(0, 6)):
            s = D(2024, 11, 1) + timedelta(days=rnd.randint(0, 450))
            cover.append((n, s, s + timedelta(days=rnd.randint(0, 90))))
    o = spark.createDataFrame(outer, "k int, start date, end date")
    c = spark.createDataFrame(cover, "k int, start date, end date")
    got = sorted(tuple(r) for r in iv.interval_gaps(o, c, ["k"]).collect())
    want = []
    for n, s, e in outer:
        free = [s + timedelta(days=i) for i in range((e - s).days + 1)
                if not any(a <= s + timedelta(days=i) <= b for k, a, b in cover if k == n)]
        for d in free:
            if want and want[-1][0] == n and want[-1][2] + timedelta(1) == d:
                want[-1] = (n, want[-1][1], d)
            else:
                want.append((n, d, d))
    assert got == sorted(want)


def test_gaps_of_many_outer_intervals(spark):
    rnd = random.Random(6)
    day = lambda n: D(2020, 1, 1) + timedelta(days=n)
    outer = [(k, day(a), day(a + rnd.randint(0, 500))) for k in range(4) for a in rnd.sample(range(1500), 25)] + [(9, day(0), day(10))]
    outer += [(0, day(0), day(2000)), (0, day(0), day(2000)), (1, day(5), day(3))]
    cover = [(k, day(a), day(a + rnd.randint(-1, 60))) for k in range(3) for a in rnd.sample(range(-100, 2100), 30)]
    got = iv.interval_gaps(spark.createDataFrame(outer, "k int, start date, end date"),
                           spark.createDataFrame(cover, "k int, start date, end date"), ["k"])
    want = []
    for k, s, e in set(outer):
        taken = {a + timedelta(i) for c, a, b in cover if c == k for i in range((b - a).days + 1)}
        run = []
        for d in [s + timedelta(i) for i in range((e - s).days + 2)]:
            if d <= e and d not in taken:
                run.append(d)
            elif run:
                want.append((k, run[0], run[-1]))
                run = []
    assert sorted(map(tuple, got.collect())) == sorted(want)


def month_ends(n, last=D(2025, 12, 31)):
    out, d = [], last
    for _ in range(n):
        out.append(d)
        d = d.replace(day=1) - timedelta(days=1)
    return out[::-1]


def chain(spark, months, ret=1.0):
    df = spark.createDataFrame([("E", m, ret) for m in months], "entity string, month_end date, ret double")
    return {r["years"]: r["ret"] for r in rt.chain_returns(df, ["entity"]).collect()}


def test_chain_needs_enough_contiguous_months(spark):
    full = (1.01 ** 12 - 1) * 100
    assert chain(spark, month_ends(12))[1] == pytest.approx(full)
    assert chain(spark, month_ends(11))[1] is None
    assert chain(spark, month_ends(13)[:5] + month_ends(13)[6:])[1] is None
    got = chain(spark, month_ends(36))
    assert got[3] == pytest.approx(full) and got[5] is None


def test_months_are_attributed_across_a_year_end(spark):
    df = spark.createDataFrame([(D(2026, 6, 30), "1", "2", "3"), (D(2026, 1, 31), "1", None, "3")],
                               "period_end date, rtn1 string, rtn2 string, rtn3 string")
    got = sorted((r["month_end"], r["ret"]) for r in rt.month_unpivot(df).collect())
    assert got == [(D(2025, 11, 30), 1.0), (D(2026, 1, 31), 3.0), (D(2026, 4, 30), 1.0), (D(2026, 5, 31), 2.0), (D(2026, 6, 30), 3.0)]


def test_several_unnamed_classes_give_a_band_and_no_value(spark):
    rows = [("E", c, m, r, m, 0) for c, r in (("pos0", 0.3), ("pos1", 0.4)) for m in month_ends(12)]
    df = spark.createDataFrame(rows, "entity string, share_class string, month_end date, ret double, filed date, ord int")
    r = rt.monthly_trailing(df, [1]).first()
    assert r["value"] is None and r["reason"] == "class_attribution_failed" and r["low"] < r["high"]


def test_total_return_with_flows_and_window_rule(spark):
    quarter = [D(2024, 12, 31), D(2025, 3, 31), D(2025, 6, 30), D(2025, 9, 30), D(2025, 12, 31)]
    navs = spark.createDataFrame([("E", d, 10.0) for d in quarter], "entity string, end date, nav double")
    led = spark.createDataFrame([("E", a + timedelta(1), b, 0.2, "tagged") for a, b in zip(quarter, quarter[1:])],
                                "entity string, start date, end date, value double, source string")
    got = {r["years"]: r for r in rt.trailing_total_returns(navs, led, ["entity"]).collect()}
    assert got[1]["value"] == pytest.approx((1.02 ** (4 * 365.25 / 365) - 1) * 100)
    assert got[1]["flags"] == [] and got[3]["value"] is None and got[3]["reason"] == "window_mismatch"
    assert got[3]["run_start"] == quarter[0]


def test_lookups_match_brute_force(spark):
    rnd = random.Random(9)
    day = lambda: D(2025, 1, 1) + timedelta(days=rnd.randint(0, 120))
    facts = [(rnd.choice("ab"), day(), float(i), day(), i) for i in range(60)]
    points = [(rnd.choice("abc"), day(), i) for i in range(80)]
    f = spark.createDataFrame(facts, "k string, end date, val double, filed date, ord int")
    p = spark.createDataFrame(points, "k string, at date, id int")
    got = {r["id"]: r["val"] for r in asof.as_of_many(p, f, "k", "at", ["val", "ord"]).collect()}
    near = {r["id"]: r["val"] for r in asof.nearest(p, f, "k", "at", ["val"], 5).collect()}
    for k, at, i in points:
        mine = [x for x in facts if x[0] == k]
        past = [x for x in mine if x[1] <= at]
        assert got[i] == (max(past, key=lambda x: (x[1], x[4]))[2] if past else None)
        close = [x for x in mine if abs((x[1] - at).days) <= 5]
        assert near[i] == (min(close, key=lambda x: (abs((x[1] - at).days), x[3], x[4]))[2] if close else None)


def test_next_period_end_clamps_the_day(spark):
    rows = [("03-31", D(2025, 9, 29)), ("03-31", D(2025, 9, 30)), ("12-31", D(2025, 12, 31)), ("02-29", D(2025, 2, 1))]
    df = spark.createDataFrame(rows, "fye string, d date")
    got = [r[0] for r in df.select(dates.next_period_end(F.col("fye"), F.col("d"))).collect()]
    assert got == [D(2025, 9, 30), D(2026, 3, 31), D(2026, 6, 30), D(2025, 2, 28)]


def test_perimeter_golden(spark):
    tags = {"repo": 2862689.0, "loan": 632516.0, "liab": 5239439.0, "clo": 1198332.0, "eq": 1172550.0}
    parts = {"recourse": ("repo", "loan"), "liabilities": ("liab",), "securitisation": ("clo",), "equity": ("eq",)}
    rows = [(e, D(2025, 12, 31), t, v, 0) for e in ("full", "noloan", "noclo") for t, v in tags.items()
            if not (e == "noloan" and t == "loan") and not (e == "noclo" and t == "clo")]
    df = spark.createDataFrame(rows, "entity string, end date, tag string, val double, ord int")
    got = {r["entity"]: r for r in asof.perimeter_ratio(df, ["entity", "end"], parts).collect()}
    assert got["full"]["regulatory"] == pytest.approx(2.98086, abs=1e-5) and got["full"]["economic"] == pytest.approx(3.44643, abs=1e-5)
    assert got["noloan"]["regulatory"] is None and got["noloan"]["economic"] is not None
    assert got["noclo"]["economic"] is None and got["noclo"]["regulatory"] is not None
