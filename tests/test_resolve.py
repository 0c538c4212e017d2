"""Reconciliation rules on small fixtures, on both paths, in any row order."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from plumbline import rules
from plumbline.functions import scoring, text
from plumbline.metrics import BUILTIN, MetricSpec, metric_frame, unique
from plumbline.operators import eligibility, resolve as resolve_module
from plumbline.operators.resolve import resolve
from plumbline.plans.benchmark import benchmark_run, reconcile_grid
from plumbline.plans import reports
from plumbline.schema import CANDIDATE, NOTICE, conform, union_sources
from plumbline.session import durable

REF = date(2025, 12, 31)
ENTITIES = [("IF", 0, "interval_fund", "03-31", "Class I", [s.key for s in BUILTIN]),
            ("BDC", 1, "bdc", "09-30", "", [s.key for s in BUILTIN]),
            ("REIT", 2, "mortgage_reit", "12-31", "", ["management_fee_pct", "nav_per_share_usd"])]


@pytest.fixture(scope="module")
def dims(spark):
    ents = spark.createDataFrame(
        ENTITIES, "entity string, entity_ord int, entity_type string, fiscal_year_end string, "
                  "institutional_class string, supported_metrics array<string>")
    return ents, metric_frame(spark, BUILTIN)


def cand(entity="BDC", metric="management_fee_pct", value=1.0, tier="text_pattern", accession="A1", basis=None,
         flags=(), as_of=date(2025, 9, 30), transforms=(), until=None, start=None, clock=None, ordno=0, form="10-K"):
    return dict(entity=entity, metric=metric, value=None if value is None else float(value), unit="pct", tier=tier, form=form, accession=accession,
                filing_date=as_of and as_of + timedelta(days=50), period_end=as_of, basis=basis or {"fee_basis": "stated_annual_rate"},
                transforms=list(transforms), flags=list(flags), as_of=as_of, terms_clock=clock, effective_from=start,
                effective_until=until, ord=ordno)


def frame(spark, rows):
    rows = [dict(r, ord=i) for i, r in enumerate(rows)]
    return conform(spark.createDataFrame([tuple(r.get(f) for f in CANDIDATE.names) for r in rows], CANDIDATE), CANDIDATE)


def run(spark, dims, rows, **kw):
    out = resolve(frame(spark, rows), dims[0], dims[1], F.lit(REF), **kw)
    return {(r["entity"], r["metric"]): r for r in out.collect()}


PATHS = [dict(), dict(fold_limit=0)]


@pytest.mark.parametrize("path", PATHS)
def test_corroborated_value_beats_a_lone_one_and_conflict_costs(spark, dims, path):
    rows = [cand(value=1.0, accession="A1"), cand(value=1.0, accession="A2", tier="html_table"), cand(value=1.5, accession="A3")]
    r = run(spark, dims, rows, **path)["BDC", "management_fee_pct"]
    assert r["chosen_value"] == 1.0 and r["tier"] == "html_table"
    assert (r["n_agree"], r["n_disagree"], r["n_clusters"]) == (1, 1, 2)
    assert r["agreement"] == rules.AGREEMENT_CONFLICT
    assert r["spread_pct"] == pytest.approx(0.5 / 1.5 * 100)
    assert r["conflict"].startswith("kept 1: agreed on by 2")


@pytest.mark.parametrize("path", PATHS)
def test_superseded_rate_neither_wins_nor_disagrees(spark, dims, path):
    rows = [cand(value=1.375, flags=["superseded_rate"], accession="A1", as_of=date(2025, 11, 30)),
            cand(value=1.375, flags=["superseded_rate"], accession="A2"), cand(value=1.0, accession="A1")]
    r = run(spark, dims, rows, **path)["BDC", "management_fee_pct"]
    assert r["value"] == 1.0 and r["n_disagree"] == 0 and r["agreement"] == rules.AGREEMENT_SINGLE


@pytest.mark.parametrize("path", PATHS)
def test_rate_dated_out_of_the_quarter_is_dropped_unless_it_is_all_there_is(spark, dims, path):
    old = cand(value=1.375, until=date(2024, 7, 1))
    now = cand(value=1.0, start=date(2024, 7, 1))
    assert run(spark, dims, [old, now], **path)["BDC", "management_fee_pct"]["chosen_value"] == 1.0
    assert run(spark, dims, [old], **path)["BDC", "management_fee_pct"]["chosen_value"] == 1.375


@pytest.mark.parametrize("path", PATHS)
def test_preferred_basis_beats_a_higher_tier(spark, dims, path):
    rows = [cand(value=0.02, tier="xbrl", basis={"fee_basis": "as_tagged"}), cand(value=1.0)]
    r = run(spark, dims, rows, **path)["BDC", "management_fee_pct"]
    assert r["chosen_value"] == 1.0 and r["n_bases"] == 2


@pytest.mark.parametrize("path", PATHS)
def test_wanted_share_class_comes_first(spark, dims, path):
    m = "net_return_1y_pct"
    rows = [cand("IF", m, 9.0, "xbrl", basis={"share_class": "fund_level"}),
            cand("IF", m, 8.0, "derived", basis={"share_class": "class  i"})]
    assert run(spark, dims, rows, **path)["IF", m]["chosen_value"] == 8.0


@pytest.mark.parametrize("path", PATHS)
def test_precedence_disqualified_then_stale_then_weak(spark, dims, path):
    m = "leverage_regulatory_dte"
    flag = rules.ZERO_BORROWINGS_FLAG
    old = date(2025, 3, 31)
    got = run(spark, dims, [
        cand("IF", m, 0.0, "structured_xml", flags=[flag], as_of=old, basis={"leverage_basis": "gross"}),
        cand("IF", "management_fee_pct", 9.0, "narrative_llm", as_of=old),
        cand("BDC", "management_fee_pct", 9.0, "narrative_llm"),
    ], **path)
    r = got["IF", m]
    assert r["reason"] == "basis_disqualified" and r["value"] is None and r["score"] == 0.0 and r["as_of"] == old
    assert got["IF", "management_fee_pct"]["reason"] == "stale_beyond_limit"
    weak = got["BDC", "management_fee_pct"]
    assert weak["reason"] == "below_confidence_floor" and "out_of_sane_range" in weak["detail"]
    assert "275d behind the 2025-12-31 anchor" in got["IF", "management_fee_pct"]["detail"]


def test_stale_is_measured_from_the_terms_clock(spark, dims):
    old = date(2025, 3, 31)
    got = run(spark, dims, [cand(as_of=old, clock=date(2025, 11, 1))])
    assert got["BDC", "management_fee_pct"]["reason"] != "stale_beyond_limit"
    assert run(spark, dims, [cand(as_of=REF - timedelta(days=183))])["BDC", "management_fee_pct"]["reason"] is None
    assert run(spark, dims, [cand(as_of=REF - timedelta(days=184))])["BDC", "management_fee_pct"]["reason"] == "stale_beyond_limit"


def test_result_does_not_depend_on_layout_or_path(spark, dims):
    import random

    rnd = random.Random(5)
    rows = [cand(rnd.choice(["BDC", "IF"]), rnd.choice(["management_fee_pct", "nav_per_share_usd"]), rnd.choice([1.0, 1.05, 1.3, 2.0]),
                 rnd.choice(list(rules.TIER_SCORES)), f"A{rnd.randint(0, 5)}",
                 {"fee_basis": rnd.choice(["stated_annual_rate", "as_tagged"])},
                 rnd.sample(["superseded_rate", "odd", "inferred_from_absence"], rnd.randint(0, 2)),
                 date(2025, rnd.randint(1, 12), 1), until=rnd.choice([None, None, date(2025, 6, 1)])) for _ in range(300)]
    base = frame(spark, rows)
    seen = []
    layouts = [(base, PATHS[0]), (base.repartition(1), PATHS[0]), (base.repartition(17), PATHS[1]),
               (base.orderBy(F.rand(3)), PATHS[1])]
    for df, path in layouts:
        out = resolve(df, dims[0], dims[1], F.lit(REF), **path)
        cols = sorted(c for c in out.columns if c != "basis")
        seen.append(sorted(map(str, out.select(*cols).collect())))
    assert all(s == seen[0] for s in seen)


def many_kinds(spark):
    """Keys of one to a dozen rows over tiers, bases, flags, dates and equal values."""
    rows = [
        cand(entity=("BDC", "IF", "REIT")[i % 3], metric=BUILTIN[i % 4 * (i % 5 > 0)].key, value=1.0 + i % 7 / 20 + i % 2,
             tier=("xbrl", "html_table", "text_pattern", "derived")[i % 4], accession=f"A{i % 9}",
             basis={"fee_basis": "stated_annual_rate" if i % 5 else "other", "share_class": "Class I" if i % 4 else "fund_level"},
             flags=["superseded_rate"] if i % 11 == 0 else [], as_of=REF - timedelta(days=i * 5 % 400),
             until=REF - timedelta(days=30) if i % 6 == 0 else None)
        for i in range(90)]
    return frame(spark, rows)


def as_text(df):
    return sorted(df.withColumn("basis", F.map_entries("basis")).select(sorted(df.columns)).toJSON().collect())


def test_keys_of_few_and_of_many_rows_are_settled_alike(spark, dims, monkeypatch):
    df, anchors = many_kinds(spark), [REF - timedelta(days=92), REF]
    run = lambda **kw: as_text(resolve(df, dims[0], dims[1], F.col("anchor"), ["anchor", "entity", "metric"], anchors=anchors, **kw))
    by_stages, by_windows = run(fold_limit=0), run()
    monkeypatch.setattr(resolve_module, "ROW_LIMIT", 5)
    monkeypatch.setattr(resolve_module, "TASK_ROWS", 10)
    assert len(by_stages) > 10
    assert by_stages == by_windows == run() == run(fold_limit=None)


def test_rows_of_a_hot_key_stay_where_they_lie(spark, dims, monkeypatch):
    numbered = []
    monkeypatch.setattr(resolve_module, "durable", lambda df: numbered.append(df) or durable(df))
    rows = [cand(value=1.0 + i % 50 / 20, accession=f"A{i}", basis={}) for i in range(400)]
    out = resolve(frame(spark, rows), dims[0], dims[1], F.lit(REF), fold_limit=0).collect()
    assert [r["n_candidates"] for r in out] == [400]
    [table] = [df for df in numbered if {"cluster", "measures"} <= set(df.columns)]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(entity" not in plan


def test_rows_of_small_keys_are_dealt_once_and_not_written(spark, dims, monkeypatch):
    written = []
    monkeypatch.setattr(resolve_module, "durable", lambda df: written.append(df.columns) or durable(df))
    out = resolve(many_kinds(spark), dims[0], dims[1], F.lit(REF))
    assert written == [["_key", "_n"]]
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    deals = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(deals) <= 2  # the rows and the entities


def test_rows_later_than_every_anchor_are_not_dealt(spark, dims, monkeypatch):
    counted = []
    monkeypatch.setattr(resolve_module, "durable", lambda df: counted.append(durable(df)) or counted[-1])
    late = frame(spark, [cand(value=1.0), cand(value=2.0, as_of=REF + timedelta(days=1)), cand("IF", as_of=REF + timedelta(days=9))])
    out = resolve(late, dims[0], dims[1], F.col("anchor"), ["anchor", "entity", "metric"], anchors=[REF - timedelta(days=1), REF])
    assert [r["_n"] for r in counted[0].collect()] == [1]
    assert sorted((r["anchor"], r["chosen_value"], r["n_candidates"]) for r in out.collect()) == [
        (REF - timedelta(days=1), 1.0, 1), (REF, 1.0, 1)]


def test_rows_later_than_every_anchor_are_not_dealt(spark, dims, monkeypatch):
    counted = []
    monkeypatch.setattr(resolve_module, "durable", lambda df: counted.append(durable(df)) or counted[-1])
    late = frame(spark, [cand(value=1.0), cand(value=2.0, as_of=REF + timedelta(days=1)), cand("IF", as_of=REF + timedelta(days=9))])
    out = resolve(late, dims[0], dims[1], F.col("anchor"), ["anchor", "entity", "metric"], anchors=[REF - timedelta(days=1), REF])
    assert [r["_n"] for r in counted[0].collect()] == [1]
    assert sorted((r["anchor"], r["chosen_value"], r["n_candidates"]) for r in out.collect()) == [
        (REF - timedelta(days=1), 1.0, 1), (REF, 1.0, 1)]


def test_a_filing_has_one_vote_where_independence_is_strict(spark, dims):
    rows = [cand(value=1.0, accession="A1"), cand(value=1.0, accession="A1", tier="html_table"), cand(value=1.5, accession="A2"),
            cand("IF", value=1.0, accession=None), cand("IF", value=1.0, accession=None, tier="html_table")]
    loose, strict = run(spark, dims, rows), run(spark, dims, rows, strict_independence=True)
    key = ("BDC", "management_fee_pct")
    assert (loose[key]["n_agree"], loose[key]["n_disagree"]) == (1, 1)
    assert (strict[key]["n_agree"], strict[key]["n_disagree"]) == (0, 1)
    assert strict["IF", "management_fee_pct"]["n_agree"] == 1


def test_values_that_are_no_numbers_take_no_part(spark, dims):
    nan = float("nan")
    rows = [cand(value=None, accession="A1"), cand(value=1.0, accession="A2"), cand(value=nan, accession="A3"),
            cand("IF", "nav_per_share_usd", None), cand("IF", "nav_per_share_usd", nan, accession="A4")]
    got = run(spark, dims, rows)
    r = got["BDC", "management_fee_pct"]
    assert (r["value"], r["n_clusters"], r["conflict"], r["n_candidates"]) == (1.0, 1, None, 1)
    assert ("IF", "nav_per_share_usd") not in got
    grid = benchmark_run(frame(spark, rows), dims[0], BUILTIN, [REF])
    blank = {(r["entity"], r["metric"]): r for r in grid.collect()}["IF", "nav_per_share_usd"]
    assert blank["value"] is None and blank["reason"] == "no_candidate" and blank["detail"].startswith("2 source(s)")


def test_notices_of_the_anchors_sum_the_candidates_once(spark):
    rows = [cand(), cand("IF", as_of=REF + timedelta(days=9)), cand("REIT", value=None, as_of=REF + timedelta(days=5))]
    said = eligibility.anchor_notices(frame(spark, rows), [REF])
    got = sorted((r["entity"], r["detail"].split(" ")[0], r["as_of"], r["ord"] - (1 << 62)) for r in said.collect())
    late = REF + timedelta(days=5)
    assert got == [("IF", "every", REF + timedelta(days=9), 0), ("REIT", "1", late, 1), ("REIT", "every", late, 0)]
    plan = said._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_notices_of_the_anchors_sum_the_candidates_once(spark):
    rows = [cand(), cand("IF", as_of=REF + timedelta(days=9)), cand("REIT", value=None, as_of=REF + timedelta(days=5))]
    said = eligibility.anchor_notices(frame(spark, rows), [REF])
    got = sorted((r["entity"], r["detail"].split(" ")[0], r["as_of"], r["ord"] - (1 << 62)) for r in said.collect())
    late = REF + timedelta(days=5)
    assert got == [("IF", "every", REF + timedelta(days=9), 0), ("REIT", "1", late, 1), ("REIT", "every", late, 0)]
    plan = said._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1


# ------------------------------------------------------------------ whole runs

def test_every_cell_has_a_value_or_a_reason_and_board_equals_coverage(spark, dims):
    rows = [cand(value=1.0, accession="A1"), cand(value=1.0, accession="A2", tier="html_table"),
            cand("IF", "net_return_1y_pct", 7.0, "derived", basis={"share_class": "fund_level"}, as_of=date(2025, 12, 1)),
            cand("IF", "net_return_3y_pct", 7.0, "derived", as_of=date(2026, 3, 1))]
    notices = spark.createDataFrame([("BDC", "net_return_5y_pct", "window_mismatch", "too short", date(2025, 9, 30), None, None, "", 1)], NOTICE)
    grid = benchmark_run(frame(spark, rows), dims[0], BUILTIN, [REF], notices)
    cells = reports.cells(grid, ["anchor"])
    out = {(r["entity"], r["metric"]): r for r in cells.collect()}
    assert len(out) == len(ENTITIES) * len(BUILTIN)
    assert all((r["value"] is None) == (r["reason"] is not None) for r in out.values())
    assert all(r["reason_code"] in rules.REASON_LABELS for r in out.values() if r["value"] is None)
    assert out["REIT", "net_return_1y_pct"]["reason"] == "not_applicable"
    assert out["BDC", "net_return_5y_pct"]["reason"] == "window_mismatch"
    assert out["IF", "net_return_1y_pct"]["reason"] == "wrong_share_class"
    assert "later period than 2025-12-31" in out["IF", "net_return_3y_pct"]["detail"]
    cov = {(r["entity"], r["metric"]): r["status"] for r in reports.coverage(cells).collect()}
    assert {k for k, s in cov.items() if s == "FILLED"} == {k for k, r in out.items() if r["value"] is not None}


def test_no_fee_means_no_hurdle(spark, dims):
    zero = [cand("IF", "incentive_fee_pct", 0.0, "html_table", basis={"fee_basis": "stated_rate"}, accession=a, as_of=REF) for a in "AB"]
    out = reconcile_grid(frame(spark, zero), dims[0], BUILTIN, F.lit(REF))
    row = out.where("entity = 'IF' and metric = 'incentive_hurdle_pct'").first()
    assert row["reason"] == "not_applicable" and row["detail"].startswith("void")


def test_audit_lists_every_candidate_once(spark, dims):
    rows = [cand(value=v, accession=a) for v, a in ((1.0, "A"), (1.0, "B"), (3.0, "C"))]
    df = frame(spark, rows)
    grid = reconcile_grid(df, dims[0], BUILTIN, F.lit(REF))
    got = reports.audit(df, grid).collect()
    assert sorted(r["outcome"] for r in got if r["outcome"] != "no_candidate") == ["rejected", "rejected", "reported"]
    assert sum(r["outcome"] == "no_candidate" for r in got) == len(ENTITIES) * len(BUILTIN) - 1


def test_audit_settles_the_run_once(spark, dims):
    df, settled = frame(spark, [cand(value=1.0), cand(value=3.0)]), spark.sparkContext.accumulator(0)
    grid = reconcile_grid(df, dims[0], BUILTIN, F.lit(REF))

    def seen(batches):
        for batch in batches:
            settled.add(batch.num_rows)
            yield batch

    counted = grid.select("entity", "metric", "chosen_ord", "value", "unit", "confidence", "score", "n_candidates")
    reports.audit(df, counted.mapInArrow(seen, counted.schema)).collect()
    assert settled.value == len(ENTITIES) * len(BUILTIN)


def coverage_frame(spark, rows):
    return spark.createDataFrame(rows, "entity string, metric string, status string, owner string, detail string, confidence string, value double")


def test_run_diff_kinds(spark):
    filled = lambda m, v, c: ("E", m, "FILLED", "-", f"{v} pct", c, v)
    blank = lambda m, s: ("E", m, s, "OURS", None, None, None)
    before = coverage_frame(spark, [filled("lost", 1.0, "High"), blank("gained", "no_candidate"), filled("worse", 1.0, "High"),
                                    filled("moved", 2000.0, "High"), filled("gone", 1.0, "High"), filled("zero", 0.0, "High")])
    after = coverage_frame(spark, [blank("lost", "no_candidate"), filled("gained", 1.0, "Low"), filled("worse", 1.2, "Medium"),
                                   filled("moved", 3000.0, "High"), filled("new", 1.0, "High"), filled("zero", 5.0, "High")])
    got = {(r["metric"], r["kind"]) for r in reports.run_changes(before, after).collect()}
    assert got == {("lost", "LOST"), ("gained", "GAINED"), ("worse", "DEGRADED"), ("moved", "CHANGED")}


def test_peer_statistics_golden(spark):
    cells = spark.createDataFrame(
        [("A", 0, "r", 1, 8.72, {}), ("B", 1, "r", 1, 6.27, {}), ("A", 0, "fee", -1, 1.0, {"fee_basis": "pct_of_net_assets"}),
         ("B", 1, "fee", -1, 1.0, {"fee_basis": "stated"}), ("C", 2, "fee", -1, 1.5, {"fee_basis": "pct_of_adjusted_equity"})],
        "entity string, entity_ord int, metric string, direction int, value double, basis map<string,string>")
    house = spark.createDataFrame([("r", 10.31), ("fee", 1.25)], "metric string, house_value double")
    got = {r["metric"]: r for r in reports.peer_comparison(cells, house, {"fee": "fee_basis"}).collect()}
    assert (got["r"]["house_rank"], got["r"]["out_of"]) == (1, 3)
    assert got["r"]["peer_median"] == pytest.approx(7.495) and got["r"]["house_delta"] == pytest.approx(2.815)
    assert (got["fee"]["house_rank"], got["fee"]["out_of"], got["fee"]["n_excluded"]) == (3, 3, 1)


# --------------------------------------------------------------------- columns

def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_flag_multipliers_exact_prefix_suffix_unknown(spark):
    flags = F.array(*[F.lit(f) for f in ("out_of_sane_range", "nav_history_gap_210d", "2_distribution_periods_derived", "superseded_rate", "new")])
    assert one(spark, scoring.penalty_product(flags)) == pytest.approx(0.30 * 0.85 * 0.95 * 0.90 * 0.90)
    assert one(spark, scoring.penalty_product(F.array().cast("array<string>"))) == 1.0


def test_labels(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, text.coverage_label(d("2021-01-01"), d("2025-12-31"))) == "5.0y available (2021-01-01 to 2025-12-31)"
    assert one(spark, text.coverage_label(d("2025-06-30"), d("2025-12-31"))) == "6mo available (2025-06-30 to 2025-12-31)"
    assert one(spark, text.blank_label(F.lit("no data."), d("2025-01-01"), d(None), d(None))) == "no data; last available 2025-01-01."
    for v, want in ((1.0, "1"), (0.31861, "0.3186"), (12345.0, "1.234e+04"), (0.0, "0"), (14.84, "14.84"), (1234.4, "1234")):
        assert one(spark, text.significant(F.lit(v))) in (want, "1.235e+04"), v


def test_metric_specs_are_validated():
    for bad in (dict(unit="bps"), dict(direction=2), dict(low=1.0, high=1.0), dict(near=("a",), patterns=("b",)),
                dict(near=("a",), take="x"), dict(near=("a",), within=5)):
        with pytest.raises(ValueError):
            MetricSpec("k", **bad)
    with pytest.raises(ValueError):
        unique([MetricSpec("k"), MetricSpec("k")])


def test_union_keeps_source_order(spark):
    a = spark.createDataFrame([("E", "m", 1.0, 5)], "entity string, metric string, value double, ord long")
    out = union_sources(a, a)
    assert [r["ord"] for r in out.orderBy("ord").collect()] == [5, (1 << 56) + 5]


def test_terms_clock_only_moves_forward(spark):
    f = spark.createDataFrame([("E", "10-K", date(2025, 11, 1)), ("E", "10-Q", date(2026, 2, 1)), ("F", "10-K", date(2025, 1, 1))],
                              "entity string, form string, filing_date date")
    e = spark.createDataFrame([("E", "bdc"), ("F", "bdc")], "entity string, entity_type string")
    clocks = eligibility.amendment_clock(f, e, F.lit(REF))
    rows = frame(spark, [cand("E", as_of=date(2025, 3, 1)), cand("F", as_of=date(2025, 3, 1))])
    got = {r["entity"]: r for r in eligibility.apply_terms_clock(rows, clocks, rules.TERMS_METRICS).collect()}
    assert got["E"]["terms_clock"] == date(2025, 11, 1) and got["E"]["flags"] == ["rate_not_restated_within_window"]
    assert got["F"]["terms_clock"] is None and got["F"]["flags"] == []
