"""Queries on sources, notices and runs that are fed by entity type."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import extraction as x, timeseries as ts, views as v
from catalog.registry import fragment, query, variant
from catalog.reports import CLASS_METRICS, ZERO_RULE
from plumbline.operators import returns as rt
from plumbline.plans import benchmark, candidates as pc, reports, sources
from plumbline.sources import html_tables as ht, prose

six = lambda c: F.round(c, 6)


@query("return_notices", """
SELECT CAST(entity AS VARCHAR) AS entity, CASE years WHEN 1 THEN 'net_return_1y_pct' WHEN 3 THEN 'net_return_3y_pct' ELSE 'net_return_5y_pct' END AS metric,
  CASE WHEN n_obs < 3 THEN 'insufficient_history' ELSE 'window_mismatch' END AS reason, run_end AS as_of,
  CASE WHEN n_obs >= 3 THEN run_start END AS coverage_start, CASE WHEN n_obs >= 3 THEN run_end END AS coverage_end,
  CASE WHEN n_obs < 3 THEN n_obs || ' price(s) on record, three are needed'
    ELSE 'no price within ' || tol || ' days of ' || CAST(target AS VARCHAR) || '; the nearest, of ' || CAST(window_start AS VARCHAR) || ', is ' || drift || ' days away' END AS detail
FROM window_picks WHERE n_obs < 3 OR drift > tol
""")
def return_notices(spark, sf):
    trailing = rt.trailing_total_returns(ts.gappy(spark, sf), ts.per_share(spark, sf), ["entity"])
    return sources.return_notices(trailing).select("entity", "metric", "reason", "as_of", "coverage_start", "coverage_end", "detail")


fragment("month_series", """
SELECT CASE WHEN entity % 2 = 0 THEN entity ELSE entity * 1000 + ascii(share_class) END AS entity, years, n_months, coverage_start, coverage_end, ret FROM chained
""")
fragment("month_trailing", """
SELECT entity, years, count(*) AS n, max(ret) AS one, count(ret) AS n_ret, min(ret) AS low, max(ret) AS high, max(n_months) AS n_months,
  min(coverage_start) AS coverage_start, max(coverage_end) AS coverage_end FROM month_series GROUP BY entity, years
""")


def month_trailing(spark, sf):
    own = F.when(F.col("entity") % 2 == 0, F.col("entity")).otherwise(F.col("entity") * 1000 + F.ascii("share_class"))
    return rt.monthly_trailing(ts.monthly(spark, sf).withColumns({"entity": own, "filed": F.col("month_end"), "ord": F.lit(0)}))


@query("monthly_candidates", """
SELECT entity, CASE years WHEN 1 THEN 'net_return_1y_pct' WHEN 3 THEN 'net_return_3y_pct' ELSE 'net_return_5y_pct' END AS metric,
  round(one, 5) AS value, coverage_end AS period_end, 'fund_level' AS share_class, 'fund_level_not_share_class_specific' AS flags
FROM month_trailing WHERE n = 1 AND one IS NOT NULL
""")
def monthly_candidates(spark, sf):
    return sources.monthly_candidates(month_trailing(spark, sf)).select(
        "entity", "metric", F.round("value", 5).alias("value"), "period_end", F.col("basis")["share_class"].alias("share_class"),
        F.array_join("flags", ";").alias("flags"))


@query("monthly_notices", """
SELECT CAST(entity AS VARCHAR) AS entity, CASE years WHEN 1 THEN 'net_return_1y_pct' WHEN 3 THEN 'net_return_3y_pct' ELSE 'net_return_5y_pct' END AS metric,
  CASE WHEN n > 1 THEN 'class_attribution_failed' ELSE 'insufficient_history' END AS reason, coverage_start, coverage_end,
  CASE WHEN n > 1 THEN n || ' unnamed class series' || CASE WHEN n_ret >= 2 THEN '; between ' || printf('%.2f', low) || ' and ' || printf('%.2f', high) ELSE '' END
    ELSE n_months || ' month(s) on record, ' || years * 12 || ' in a row are needed' END AS detail
FROM month_trailing WHERE n > 1 OR one IS NULL
""")
def monthly_notices(spark, sf):
    return sources.monthly_notices(month_trailing(spark, sf)).select(
        "entity", "metric", "reason", "coverage_start", "coverage_end", "detail")


@query("tagged_fees", """
SELECT entity, CASE tag WHEN '1-URGENT' THEN 'management_fee_pct' ELSE 'incentive_fee_pct' END AS metric, round(val / 1000000 * 100, 6) AS value, accn AS accession,
  concat_ws(';', CASE WHEN form <> 'F' THEN 'fee_table_from_' || form || '_not_fund_prospectus' END,
    CASE WHEN val / 1000000 * 100 < 0.25 THEN 'implausibly_low_for_entity_type' END) AS flags
FROM (SELECT *, row_number() OVER (PARTITION BY entity, tag ORDER BY "end" DESC, accn DESC, ord DESC) AS k FROM v_facts
  WHERE tag IN ('1-URGENT', '2-HIGH') AND "end" <= DATE '2000-12-31') WHERE k = 1
""")
def tagged_fees(spark, sf):
    facts = v.facts(spark, sf).withColumns({
        "val": F.col("val") / 1_000_000, "form": F.when(F.col("form") == "F", F.lit("N-2")).otherwise(F.col("form"))}).drop("start")
    out = sources.tagged_fee_candidates(facts, v.ref(), {"management_fee_pct": "1-URGENT", "incentive_fee_pct": "2-HIGH"})
    return out.select("entity", "metric", six("value").alias("value"), "accession", F.array_join("flags", ";").alias("flags"))


def class_tables(spark, sf, specs=()):
    tables = ht.highlights_tables(x.highlight_pages(spark, sf), ["o_orderkey", "entity", "form", "report_date"], "html", specs)
    return tables.withColumn("table_no", F.col("o_orderkey"))


@query("custom_row_candidates", """
SELECT entity, 'portfolio_turnover_pct' AS metric, 45.0::DOUBLE AS value, 'Class I' AS share_class, 'html_table' AS tier FROM class_pick
""")
def custom_row_candidates(spark, sf):
    entities = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.lit("Class I").alias("institutional_class"))
    out = pc.class_candidates(class_tables(spark, sf, [x.TURNOVER]), entities, [x.TURNOVER])
    return out.where(F.col("metric") == x.TURNOVER.key).select(
        "entity", "metric", "value", F.col("basis")["share_class"].alias("share_class"), "tier")


@query("trend_classes", """
SELECT entity, "end", round(nav, 4) AS nav_per_share, form AS source FROM (
  SELECT *, row_number() OVER (PARTITION BY entity, "end" ORDER BY rd DESC, i, ok) AS k FROM (
    SELECT entity, rd, i, ok, CASE WHEN annual THEN 'N-CSR' ELSE 'N-CSRS' END AS form, (ok % 300 + 800 + 10 * i) / 100 AS nav,
      CASE WHEN i = 0 AND NOT annual THEN rd ELSE CASE entity % 3 WHEN 0 THEN make_date(y - i, 12, 31) WHEN 1 THEN make_date(y - i, 9, 30) ELSE make_date(y - i, 3, 31) END END AS "end"
    FROM (SELECT * FROM class_rows WHERE m = 0), (VALUES (0), (1), (2)) t(i)) WHERE "end" <= DATE '2000-12-31') WHERE k = 1
""")
def trend_classes(spark, sf):
    k = F.col("c_custkey") % 3
    entities = v.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity"), F.lit("Class I").alias("institutional_class"),
        F.when(k == 0, "12-31").when(k == 1, "09-30").otherwise("03-31").alias("fiscal_year_end"))
    tables = class_tables(spark, sf).where(F.col("share_class") == "CLASS I")
    return sources.class_trend(tables, entities, v.ref()).select("entity", "end", F.round("nav_per_share", 4).alias("nav_per_share"), "source")


@query("trend_house", """
SELECT 'house' AS entity, "end", round(nav, 6) AS nav_per_share, 'own series' AS source FROM v_nav
WHERE entity = 0 AND month("end") IN (6, 12) AND "end" <= DATE '2000-12-31'
""")
def trend_house(spark, sf):
    own = v.nav(spark, sf).where("entity = 0").select(F.col("end").alias("period_end"), F.col("nav").alias("nav_per_share_usd"))
    return sources.house_trend(own, v.ref()).select("entity", "end", six("nav_per_share").alias("nav_per_share"), "source")


@query("stated_candidates", """
SELECT 'C' || o_custkey AS entity, metric, round(value, 6) AS value, CAST(o_orderkey AS VARCHAR) AS accession, 'text_pattern' AS tier, 'pct' AS unit, as_of, n_flags FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS as_of, CASE WHEN k IN (0, 1, 5) THEN 'management_fee_pct' WHEN k IN (2, 3, 6) THEN 'incentive_hurdle_pct' ELSE 'incentive_fee_pct' END AS metric,
    CASE WHEN k = 2 THEN a * 4 ELSE a END AS value, CASE WHEN k = 0 THEN 1 WHEN k = 4 THEN CASE WHEN a < 5 THEN 2 ELSE 1 END ELSE 0 END AS n_flags
  FROM (SELECT *, o_orderkey % 7 AS k, (o_orderkey % 300 + 50) / 100 AS a FROM orders)
  UNION ALL SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE), 'management_fee_pct', 4.75, 1 FROM orders WHERE o_orderkey % 7 = 5
  UNION ALL SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE), 'incentive_hurdle_pct', (o_orderkey % 300 + 50) / 100 * 4, 0 FROM orders WHERE o_orderkey % 7 = 6)
""")
def stated_candidates(spark, sf):
    rows = prose.fee_prose(x.fee_docs(spark, sf), ["o_orderkey"])
    filings = x.orders(spark, sf).select(
        "o_orderkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("entity"), F.lit("10-K").alias("form"),
        F.col("o_orderkey").cast("string").alias("accession"), F.col("o_orderdate").cast("date").alias("period_end")).withColumn(
        "filing_date", F.date_add("period_end", 45))
    out = sources.document_candidates(rows, filings, "o_orderkey", "text_pattern")
    return out.select("entity", "metric", six("value").alias("value"), "accession", "tier", "unit", "as_of", F.size("flags").alias("n_flags"))


# ------------------------------------------------------------- one routed run
ROUTES = {"interval_fund": ("reports", "tables"), "bdc": ("facts", "prose"), "mortgage_reit": ("facts", "prose")}
LINES = {"facts": (1, 2), "reports": (3,), "tables": (4,), "prose": (5, 6, 7)}
# The union's layout dates a row by its filing where nothing else does.
fragment("route_v_candidates", """
SELECT c.* REPLACE (c.ord + CASE WHEN line < 3 THEN 0 WHEN line = 3 THEN 1 WHEN line = 4 THEN 2 ELSE 3 END * 72057594037927936 AS ord,
  coalesce(c.as_of, c.period_end, c.filing_date) AS as_of)
FROM (SELECT *, CAST(replace(locator, 'line ', '') AS INTEGER) AS line FROM v_candidates) c
JOIN (SELECT entity, entity_type = 'interval_fund' AS fund FROM v_entities) e USING (entity)
WHERE CASE WHEN fund THEN line IN (3, 4) ELSE line IN (1, 2, 5, 6, 7) END
""")
variant("route_", "v_candidates", "cover_rows")


def routed_sources(spark, sf):
    line = F.replace(F.col("locator"), F.lit("line "), F.lit("")).cast("int")
    rows = v.candidates(spark, sf)
    return {name: rows.where(line.isin(list(lines))) for name, lines in LINES.items()}


fragment("route_told", """
SELECT entity, metric, min(n) AS n FROM (
  SELECT 'S' || user_id AS entity, 'm' || (user_id % 7 + 5) AS metric, event_id AS n FROM events WHERE event_type = 'error') GROUP BY ALL
""")


@query("routed_coverage", """
SELECT c.entity, c.metric, CASE WHEN c.status = 'no_candidate' AND t.entity IS NOT NULL AND e.entity_type = 'interval_fund' THEN 'insufficient_history' ELSE c.status END AS status,
  c.owner, c.confidence
FROM route_cover_rows c JOIN v_entities e USING (entity) LEFT JOIN route_told t USING (entity, metric) WHERE anchor = DATE '2000-12-31'
""")
def routed_coverage(spark, sf):
    """Facts, reports, tables and prose, each for its entity types, with the reports' notices, to coverage."""
    entities = v.entities(spark, sf)
    cands = sources.routed(routed_sources(spark, sf), entities, ROUTES)
    errors = v.table(spark, sf, "events").where("event_type = 'error'").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("entity"),
        F.concat(F.lit("m"), (F.col("user_id") % 7 + 5).cast("string")).alias("metric"), F.lit("insufficient_history").alias("reason"),
        F.lit("few months").alias("detail"), F.lit(None).cast("date").alias("as_of"), F.col("event_id").alias("ord"))
    told = sources.routed_notices({"reports": errors}, entities, ROUTES)
    grid = benchmark.benchmark_run(cands, entities, v.SPECS, (v.ANCHOR,), told, zero_rule=ZERO_RULE)
    cells = reports.cells(grid, ["anchor"], CLASS_METRICS)
    return reports.coverage(cells, ["anchor"]).select("entity", "metric", "status", "owner", "confidence")
