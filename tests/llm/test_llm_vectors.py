"""Hard negatives and whitening against plain versions and SQL."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import negatives, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, score int, n int, key string, node string, size int"
NAN, INF = float("nan"), float("inf")
# Nulls everywhere, empty, zero, not finite, ties, repeated rows, other lengths.
BAD = [(None, [1.0, 0.5, -0.25], 1), (900, None, 1), (901, [], 1), (902, [1.0, None, 0.0], 1), (950, [1.0, NAN, 0.0], 2),
       (903, [INF, 0.0, 0.0], 2), (904, [1.0, 1.0, 1.0], None), (905, [0.5, 0.5], 1), (906, [0.5, 0.25], 2)]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", "n", 3) for r in rows], SCHEMA)


def made(n, size, labels, seed, grid=None):
    r = np.random.default_rng(seed)
    x = r.standard_normal((n, size)) + 0.4
    if grid:
        x = np.round(x * grid) / grid
    return [(i, [float(np.float32(v)) for v in row], int(label)) for i, (row, label) in enumerate(zip(x, r.integers(0, labels, n)))]


def plain_negatives(rows, every=50, positives=5, most=3):
    good = [(i, [math.floor(256 * c) for c in v], label) for i, v, label in rows
            if None not in (i, v, label) and v and all(c is not None and math.isfinite(c) for c in v)]
    good = list(dict.fromkeys((i, tuple(v), label) for i, v, label in good))
    out = []
    for a in good:
        if a[0] % every:
            continue
        met = [(-sum(p * q for p, q in zip(a[1], o[1])), o[0], o[2]) for o in good if o is not a and len(o[1]) == len(a[1])]
        met.sort(key=lambda m: m[:2])
        for s, ident, _ in [m for m in met if m[2] == a[2]][:positives]:
            near = [m for m in met if m[2] != a[2] and 50 * -s <= 100 * -m[0] <= 95 * -s][:most]
            out += [(a[0], ident, k, m[1], -s, -m[0]) for k, m in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("anchor_block, row_block, every", [(8192, 4096, 50), (3, 17, 5)])
def test_negatives_equal_all_pairs(spark, anchor_block, row_block, every):
    # A coarse grid makes many ties; a third of the rows share one label, twenty one vector.
    rows = made(260, 9, 4, 1, grid=4)
    rows = [(i, v, 0 if i % 3 == 0 else label) for i, v, label in rows]
    rows += [(300 + i, rows[0][1], i % 2) for i in range(20)] + rows[:3] + BAD
    got = negatives.mine(table(spark, rows), every=every, anchor_block=anchor_block, row_block=row_block).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, every)


def test_negatives_edges(spark):
    assert negatives.mine(table(spark, [])).count() == 0
    assert negatives.mine(table(spark, BAD)).count() == 0
    # Few rows: all of them; a zero anchor scores 0 with everyone; large and negative numbers stay exact.
    rows = [(0, [0.0, 0.0], 1), (1, [1.0, 2.0], 1), (2, [3.0, 1.0], 2), (50, [30000.0, -7.5], 1), (51, [20000.0, 5.0], 1), (52, [15000.0, -1e6], 3)]
    assert sorted(map(tuple, negatives.mine(table(spark, rows)).collect())) == plain_negatives(rows)


def test_tables_of_subset_sums():
    r = np.random.default_rng(3)
    for low, high, size in ((-200, 200, 64), (-1, 1, 5), (0, 3, 8), (-(1 << 40), 1 << 40, 11)):
        rows, anchors = r.integers(low, high, (40, size)), r.integers(-100, 100, (7, size))
        planes = negatives.stacked(negatives.planes_of(rows), size)
        assert (negatives.integers(planes, size) == rows).all()
        tables = negatives.subset_sums(anchors, np.int64)
        assert (negatives.scores(tables, planes) == rows @ anchors.T).all()


def test_registered_query_equals_its_sql(spark):
    from catalog.check import duck

    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_hard_negatives"](spark, folder)
    want = duck(folder).execute(queries.ORACLES["op11_hard_negatives"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def plain_whitening(rows, most=8):
    good = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v, *_ in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in good]
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    good = [g for g in good if len(g[1]) == size]
    n = len(good)
    x = np.array([v for _, v in good], dtype=object)
    d = n * x - x.sum(axis=0)
    cov = (d / n).astype(float)
    value, vector = np.linalg.eigh(cov.T @ cov / n)
    order = np.argsort(-value)[:most]
    order = [i for i in order if value[i] > 1e-9 * value.max()]
    return [g[0] for g in good], (d * d).sum(axis=1).tolist(), cov @ vector[:, order] / np.sqrt(value[order]), value[order] / value.sum()


def by_component(rows, n):
    out = {}
    for r in rows:
        out.setdefault(r.component, []).append(r)
    assert all(len(v) == n for v in out.values())
    return out


@pytest.mark.parametrize("n, size", [(300, 12), (40, 3), (5, 9), (200, 64)])
def test_whitening_equals_plain_version(spark, n, size):
    rows = made(n, size, 3, n) + (BAD if size == 3 else [])
    ids, deviation, w, explained = plain_whitening(rows)
    got = whitening.whiten(table(spark, rows)).collect()
    per = by_component(got, len(ids))
    assert sorted(per) == list(range(1, w.shape[1] + 1))
    for k, own in per.items():
        own = sorted(own, key=lambda r: (r.vec_id is None, r.vec_id))
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        assert [r.deviation for r in own] == [deviation[i] for i in order]
        values = np.array([r.whitened for r in own])
        want = w[order, k - 1]
        assert min(np.abs(values - want).max(), np.abs(values + want).max()) < 1e-9
        assert {r.n for r in own} == {len(ids)} and abs(own[0].explained - explained[k - 1]) < 1e-12
    assert max(r.identity_error for r in got) < 1e-9


def test_whitening_of_multiple_eigenvalues_and_edges(spark):
    # A cross: all variances equal, so one eigenvalue of multiplicity four.
    cross = [(2 * i + s, [(1.0 if s else -1.0) if j == i else 0.0 for j in range(4)], 0) for i in range(4) for s in (0, 1)]
    got = whitening.whiten(table(spark, cross)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and all(abs(r.explained - 0.25) < 1e-12 for r in got)
    assert max(r.identity_error for r in got) < 1e-12
    # No variance: no components. Empty tables and tables without a vector give none either.
    for rows in ([], [(1, None, 1)], [(1, [0.5, 1.0], 1)], [(1, [0.5, 1.0], 1)] * 5):
        assert whitening.whiten(table(spark, rows)).count() == 0
    # Variance in one direction only; repeated rows count each.
    line = [(i, [i / 4, i / 2, 0.0], 0) for i in range(6)] + [(5, [5 / 4, 5 / 2, 0.0], 0)]
    got = whitening.whiten(table(spark, line)).collect()
    assert len(got) == 7 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    # Beyond a long the deviation is null; large entries stay exact.
    wide = [(i, [float(i * 2 ** 28), float(i * i)], 0) for i in range(40)]
    got = whitening.whiten(table(spark, wide)).collect()
    assert {r.n for r in got} == {40} and any(r.deviation is None for r in got)


def test_exact_polynomial_and_roots(spark):
    r = np.random.default_rng(8)
    for size in (1, 2, 5, 9):
        y = r.integers(-50, 50, (size + 3, size)).astype(object)
        m = y.T @ y
        poly = whitening.characteristic(spark, m)
        # Traces of powers by Newton's identities.
        power, traces = np.eye(size, dtype=object), []
        for _ in range(size):
            power = power @ m
            traces.append(sum(power[i, i] for i in range(size)))
        e = [Fraction(1)]
        for k in range(1, size + 1):
            e.append(sum((-1) ** (i - 1) * e[k - i] * traces[i - 1] for i in range(1, k + 1)) / k)
        assert poly == [int((-1) ** (size - i) * e[size - i]) for i in range(size + 1)]
    # (t - 2)^3 (t - 7) t: one root of multiplicity three.
    poly = [1]
    for root in (2, 2, 2, 7, 0):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [(round(float(x), 9), k) for x, k in whitening.largest_roots(poly, 4, 40)] == [(7.0, 1), (2.0, 3)]
    assert whitening.roots_above(poly, 2) == 1 and whitening.roots_above(poly, 1) == 4


def test_products_of_wide_entries_are_exact():
    r = np.random.default_rng(4)
    for most in (1000, 1 << 40):
        y = r.integers(-most, most, (3000, 3))
        assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()


def test_every_row_of_the_given_table(spark):
    rows = queries.QUERIES["op12_whitening"](spark, "/root/testdata/sf0.001")
    assert rows.groupBy("component").count().where(F.col("count") == 500).count() == 8
    assert rows.agg(F.max("identity_error")).first()[0] < 1e-9
