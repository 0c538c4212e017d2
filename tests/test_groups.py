"""Group operators against brute force, including the paths for huge groups."""

import random
import statistics

from pyspark.sql import functions as F

from plumbline.operators import groups
from plumbline.operators.cluster import cluster_leaders, tolerance_clusters


def agree(a, b, unit):
    tol = {"pct": (0.10, 0.010), "ratio": (0.02, 0.015), "usd": (0.02, 0.002)}[unit]
    mid = (abs(a) + abs(b)) / 2 or 1.0
    return abs(a - b) <= max(tol[0], mid * tol[1])


def brute_clusters(values, unit):
    leaders = []
    for x in sorted(values):
        if not any(agree(leader, x, unit) for leader in leaders):
            leaders.append(x)
    return leaders


def sample(seed, n=200):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), round(rnd.uniform(-1, 6), 3), "ratio") for _ in range(n)]


def test_leaders_match_full_search_on_both_paths(spark):
    rows = sample(1)
    df = spark.createDataFrame(rows, "k string, value double, unit string")
    want = {k: brute_clusters([v for g, v, _ in rows if g == k], "ratio") for k in "ab"}
    for limit in (None, 100_000, 10):
        got = {r["k"]: r["leaders"] for r in cluster_leaders(df, ["k"], limit).collect()}
        assert got == want, limit


def test_dense_groups_of_every_shape_by_jump_pointers(spark):
    rnd = random.Random(7)
    shapes = {
        "one": [3.0], "equal": [2.5, 2.5], "zero": [0.0, -0.0, 0.004, -0.004],
        "dense": [rnd.uniform(0.9, 1.4) for _ in range(1200)],
        "wide": [(-1) ** i * 10 ** rnd.uniform(-4, 9) for i in range(300)],
        "steps": [round(i * 0.05, 2) for i in range(-60, 300)],
    }
    for unit in ("pct", "usd"):
        rows = [(k, "x", x, unit) for k, values in shapes.items() for x in values]
        df = spark.createDataFrame(rows, "k string, j string, value double, unit string")
        got = {r["k"]: r["leaders"] for r in cluster_leaders(df, ["k", "j"], 0).collect()}
        assert got == {k: brute_clusters(v, unit) for k, v in shapes.items()}


def test_cluster_of_each_row_is_the_greatest_leader_not_above(spark):
    rows = sample(2)
    df = spark.createDataFrame(rows, "k string, value double, unit string")
    for r in tolerance_clusters(df, ["k"]).collect():
        leaders = brute_clusters([v for g, v, _ in rows if g == r["k"]], "ratio")
        assert r["leader"] == max(x for x in leaders if x <= r["value"])
        assert leaders[r["cluster"] - 1] == r["leader"]


def test_values_both_zero_agree(spark):
    df = spark.createDataFrame([("a", 0.0, "usd"), ("a", -0.0, "usd"), ("a", 0.02, "usd")], "k string, value double, unit string")
    assert cluster_leaders(df, ["k"]).first()["leaders"] in ([0.0], [-0.0])


def test_ranks_and_median_match_sorting_when_a_group_is_cut(spark):
    rnd = random.Random(3)
    rows = [("a", float(rnd.randint(0, 300))) for _ in range(1500)] + [("b", 7.0)] * 900 + [("c", 1.5), ("c", 2.5)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    for pieces in (None, 1, 8):
        ranks = {(r["k"], r["v"]): r for r in groups.value_ranks(df, ["k"], "v", pieces=pieces).collect()}
        assert len(ranks) == len(set(rows))
        for (k, v), r in ranks.items():
            values = [x for g, x in rows if g == k]
            assert r["n"] == values.count(v)
            assert r["n_below"] == sum(x < v for x in values)
            assert r["n_total"] == len(values)
    stats = {r["k"]: r for r in groups.order_statistics(df, ["k"], "v").collect()}
    for k in "abc":
        values = sorted(x for g, x in rows if g == k)
        assert stats[k]["median"] == statistics.median(values)
        assert stats[k]["upper_median"] == values[len(values) // 2]
        assert (stats[k]["low"], stats[k]["high"]) == (values[0], values[-1])


def test_mode_tie_goes_to_first_seen(spark):
    df = spark.createDataFrame([("x", "b", 1), ("x", "a", 2), ("x", "a", 4), ("x", "b", 3)], "k string, v string, o int")
    assert groups.modal_first(df, ["k"], "v", "o").first()["modal"] == "b"
    assert groups.modal_first(df.limit(0), ["k"], "v", "o").count() == 0


def test_top_k_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = groups.top_k(df, ["k"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in out.collect()) == [994, 995, 996, 997, 998, 999]


def test_rows_of_a_large_group_meet_the_leaders_of_their_cell_only(spark):
    from plumbline.operators import cluster as cl

    values = [(k, "pct", x / 40.0) for k in (1, 2) for x in range(-900, 900, 7 if k == 1 else 600)] * 2
    df = spark.createDataFrame(values, "k int, unit string, value double")
    small = cl.tolerance_clusters(df, ["k"], None).collect()
    large = cl.tolerance_clusters(df, ["k"], 20)
    assert sorted(map(tuple, small)) == sorted(map(tuple, large.select("k", "unit", "value", "cluster", "leader").collect()))
    assert max(r["cluster"] for r in small) > 100
    found, cells = cl._walk(df.where("k = 1").distinct(), ["k"])
    near = cl._leaders_of_cells(found, cells, ["k", "unit"]).selectExpr("size(_within) as n").collect()
    assert len(near) > 100 and max(r["n"] for r in near) <= 2
