"""Notices, routing by entity type, and sources that state candidates."""

from datetime import date

from pyspark.sql import functions as F

from plumbline.operators.asof import original_filing
from plumbline.plans import sources
from plumbline.schema import CANDIDATE, NOTICE, conform

TRAILING = ("entity string, years int, n_obs int, run_start date, run_end date, target date, window_start date, drift int, reason string")


def test_return_notices_say_what_is_missing(spark):
    day = date(2025, 9, 30)
    rows = [("A", 1, 2, day, day, day, None, None, "insufficient_history"),
            ("A", 5, 9, date(2022, 3, 31), day, date(2020, 9, 30), date(2022, 3, 31), 547, "window_mismatch"), ("A", 3, 9, day, day, day, day, 0, None)]
    got = {r["metric"]: r for r in sources.return_notices(spark.createDataFrame(rows, TRAILING)).collect()}
    assert set(got) == {"net_return_1y_pct", "net_return_5y_pct"}
    assert got["net_return_1y_pct"]["coverage_start"] is None and got["net_return_1y_pct"]["detail"].startswith("2 price(s)")
    long = got["net_return_5y_pct"]
    assert (long["coverage_start"], long["coverage_end"], long["as_of"]) == (date(2022, 3, 31), day, day) and "547 days" in long["detail"]
    assert set(long.asDict()) == set(NOTICE.names)


def test_sources_feed_only_their_entity_types(spark):
    ents = spark.createDataFrame([("F", "interval_fund", ["m"]), ("B", "bdc", ["m"])], "entity string, entity_type string, supported_metrics array<string>")
    frame = lambda v: conform(spark.createDataFrame([("F", "m", v, 0), ("B", "m", v, 1)], "entity string, metric string, value double, ord long"), CANDIDATE)
    routes = {"interval_fund": ("tables", "prose"), "bdc": ("facts", "prose")}
    got = sources.routed({"facts": frame(1.0), "tables": frame(2.0), "prose": frame(3.0)}, ents, routes).orderBy("ord").collect()
    assert [(r["entity"], r["value"]) for r in got] == [("B", 1.0), ("F", 2.0), ("F", 3.0), ("B", 3.0)]
    told = spark.createDataFrame([("F", "m", "r1", 5), ("F", "other", "r2", 1), ("B", "m", "r3", 1)], "entity string, metric string, reason string, ord long")
    kept = sources.routed_notices({"tables": told}, ents, routes).collect()
    assert [(r["entity"], r["reason"]) for r in kept] == [("F", "r1")]


def test_tagged_fees_and_document_rows(spark):
    facts = spark.createDataFrame([
        ("E", "cef:ManagementFeesPercent", date(2025, 6, 30), "a1", "N-2", date(2025, 8, 1), 0.0125, 1),
        ("E", "cef:ManagementFeesPercent", date(2024, 6, 30), "a0", "N-2", date(2024, 8, 1), 0.02, 0),
        ("E", "cef:IncentiveFeesPercent", date(2025, 6, 30), "a2", "10-K", date(2025, 8, 1), 0.001, 2)],
        "entity string, tag string, end date, accn string, form string, filed date, val double, ord long")
    got = {r["metric"]: r for r in sources.tagged_fee_candidates(facts, F.lit(date(2025, 12, 31))).collect()}
    assert got["management_fee_pct"]["value"] == 1.25 and got["management_fee_pct"]["flags"] == []
    assert got["incentive_fee_pct"]["flags"] == ["fee_table_from_10-K_not_fund_prospectus", "implausibly_low_for_entity_type"]
    rows = spark.createDataFrame([(1, "m", 2.0, 40)], "doc int, metric string, value double, pos int")
    docs = spark.createDataFrame([(1, "E", "10-K", "a9", date(2025, 3, 1), date(2024, 12, 31))],
                                 "doc int, entity string, form string, accession string, filing_date date, period_end date")
    r = sources.document_candidates(rows, docs, "doc", "text_pattern").first()
    assert (r["entity"], r["tier"], r["unit"], r["as_of"], r["locator"], r["ord"]) == ("E", "text_pattern", "pct", date(2024, 12, 31), "place 40", 40)


def test_original_filing_prefers_a_dated_one(spark):
    facts = spark.createDataFrame([("k", None, 1, "undated"), ("k", date(2024, 1, 1), 2, "dated"), ("l", None, 3, "only")],
                                  "key string, filed date, ord long, name string")
    assert {r["key"]: r["name"] for r in original_filing(facts, ["key"]).collect()} == {"k": "dated", "l": "only"}


def test_class_and_house_trends(spark):
    tables = spark.createDataFrame([
        ("E", "N-CSR", date(2025, 3, 31), 1, "Class I", [2025, 2024], [10.0, 9.0]), ("E", "N-CSRS", date(2024, 9, 30), 2, "class i", [2025, 2024], [9.5, 8.9]),
        ("E", "N-CSR", date(2025, 3, 31), 3, "Class A", [2025], [1.0])],
        "entity string, form string, report_date date, table_no long, share_class string, years array<int>, nav_end array<double>")
    ents = spark.createDataFrame([("E", "03-31", "Class I")], "entity string, fiscal_year_end string, institutional_class string")
    got = sources.class_trend(tables, ents, F.lit(date(2025, 12, 31))).orderBy("end").collect()
    assert [(r["end"], r["nav_per_share"]) for r in got] == [(date(2024, 3, 31), 9.0), (date(2024, 9, 30), 9.5), (date(2025, 3, 31), 10.0)]
    own = spark.createDataFrame([(date(2025, m, 28), 1.0 * m) for m in (3, 6, 9, 12)], "period_end date, nav_per_share_usd double")
    assert [r["nav_per_share"] for r in sources.house_trend(own, F.lit(date(2025, 11, 30))).collect()] == [6.0]
