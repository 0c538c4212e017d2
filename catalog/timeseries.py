"""Queries on dated facts: lookups, ledgers, returns, windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import fragment, query
from plumbline.functions import text
from plumbline.operators import asof, intervals as iv, returns as rt

six = lambda c: F.round(c, 6)


@query("asof_lookup", """
SELECT entity, tag, accn, "end", val FROM (SELECT *, row_number() OVER (PARTITION BY entity, tag
  ORDER BY "end" DESC, accn DESC) AS k FROM v_facts WHERE "end" <= DATE '2000-12-31') WHERE k = 1
""")
def asof_lookup(spark, sf):
    return asof.as_of(v.facts(spark, sf), ["entity", "tag"], v.ref()).select("entity", "tag", "accn", "end", "val")


@query("asof_many", """
SELECT p.ord, p.entity, p.at, f."end" AS fact_end, f.val FROM (SELECT ord, entity, "end" AS at FROM v_facts) p
LEFT JOIN LATERAL (SELECT * FROM v_facts f WHERE f.entity = p.entity AND f.tag = '1-URGENT' AND f."end" <= p.at
  ORDER BY f."end" DESC, f.accn DESC LIMIT 1) f ON true
""")
def asof_many(spark, sf):
    facts = v.facts(spark, sf)
    points = facts.select("ord", "entity", F.col("end").alias("at"))
    urgent = facts.where(F.col("tag") == "1-URGENT")
    return asof.as_of_many(points, urgent, "entity", "at", ["val"]).select(
        "ord", "entity", "at", F.col("end").alias("fact_end"), "val")


@query("nearest_lookup", """
SELECT p.ord, p.entity, p.at, f."end" AS fact_end, f.delta, f.val
FROM (SELECT ord, entity, "end" + 10 AS at FROM v_facts WHERE tag <> '2-HIGH') p
LEFT JOIN LATERAL (SELECT f."end", f.val, abs(f."end" - p.at) AS delta FROM v_facts f
  WHERE f.entity = p.entity AND f.tag = '2-HIGH' AND abs(f."end" - p.at) <= 45
  ORDER BY abs(f."end" - p.at), f.filed, f.ord LIMIT 1) f ON true
""")
def nearest_lookup(spark, sf):
    facts = v.facts(spark, sf)
    points = facts.where(F.col("tag") != "2-HIGH").select("ord", "entity", F.date_add("end", 10).alias("at"))
    high = facts.where(F.col("tag") == "2-HIGH")
    return asof.nearest(points, high, "entity", "at", ["val"], tolerance=45).select(
        "ord", "entity", "at", F.col("end").alias("fact_end"), "delta", "val")


@query("preferred_tag", """
SELECT entity, tag, "end", val, rank FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY rank) AS j FROM (
  SELECT *, CASE tag WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 ELSE 3 END AS rank,
    row_number() OVER (PARTITION BY entity, tag ORDER BY "end" DESC, accn DESC) AS k
  FROM v_facts WHERE "end" <= DATE '1996-12-31' AND tag IN ('1-URGENT', '3-MEDIUM', '5-LOW')) WHERE k = 1) WHERE j = 1
""")
def preferred_tag(spark, sf):
    out = asof.preferred_tag(v.facts(spark, sf), ["1-URGENT", "3-MEDIUM", "5-LOW"], F.lit(date(1996, 12, 31)))
    return out.select("entity", "tag", "end", "val", "rank")


# Facts of a nation and month end: several per tag, so dates do match.
def nation_facts(spark, sf):
    c = v.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = v.facts(spark, sf)
    return rows.join(c, F.col("entity") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("entity"), "tag", F.last_day("end").alias("end"), "val", "accn", "form",
        F.lit(None).cast("date").alias("start"), "filed", "ord", "unit")


fragment("nation_facts", """
SELECT c_nationkey AS entity, tag, last_day("end") AS "end", val, accn, form, filed, ord
FROM v_facts JOIN customer ON entity = c_custkey
""")


fragment("tag_latest", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity, tag ORDER BY "end" DESC, accn DESC) AS k
FROM nation_facts WHERE "end" <= DATE '2000-12-31') WHERE k = 1
""")


@query("matched_ratio", """
SELECT a.entity, a."end", a.val AS numerator, b.val AS denominator, round(a.val / b.val, 6) AS ratio
FROM tag_latest a JOIN tag_latest b ON a.entity = b.entity AND a."end" = b."end"
WHERE a.tag = '2-HIGH' AND b.tag = '1-URGENT' AND b.val <> 0
""")
def matched_ratio(spark, sf):
    return asof.matched_ratio(nation_facts(spark, sf), "2-HIGH", "1-URGENT", v.ref()).withColumn(
        "ratio", six("ratio"))


PARTS = {"recourse": ("2-HIGH", "3-MEDIUM"), "liabilities": ("4-NOT SPECIFIED",), "securitisation": ("5-LOW",),
         "equity": ("1-URGENT",)}


@query("perimeter_ratio", """
SELECT entity, "end", round((hi + me) / eq, 6) AS regulatory, round((li - lo) / eq, 6) AS economic FROM (
  SELECT entity, "end", arg_min(val, ord) FILTER (tag = '2-HIGH') AS hi, arg_min(val, ord) FILTER (tag = '3-MEDIUM') AS me,
    arg_min(val, ord) FILTER (tag = '4-NOT SPECIFIED') AS li, arg_min(val, ord) FILTER (tag = '5-LOW') AS lo,
    arg_min(val, ord) FILTER (tag = '1-URGENT') AS eq
  FROM nation_facts GROUP BY ALL) WHERE eq <> 0
""")
def perimeter_ratio(spark, sf):
    return asof.perimeter_ratio(nation_facts(spark, sf), ["entity", "end"], PARTS).select(
        "entity", "end", six("regulatory").alias("regulatory"), six("economic").alias("economic"))


@query("dedupe_original", """
SELECT entity, "end", val, accn, filed FROM (SELECT *, row_number() OVER (PARTITION BY entity, "end" ORDER BY filed, ord) AS k
FROM nation_facts) WHERE k = 1
""")
def dedupe_original(spark, sf):
    return asof.original_filing(nation_facts(spark, sf), ["entity", "end"]).select("entity", "end", "val", "accn", "filed")


@query("dedupe_restated", """
SELECT entity, "end", val, accn, filed FROM (SELECT *, row_number() OVER (PARTITION BY entity, "end" ORDER BY filed DESC, ord DESC) AS k
FROM nation_facts) WHERE k = 1
""")
def dedupe_restated(spark, sf):
    return asof.latest_restatement(nation_facts(spark, sf), ["entity", "end"]).select("entity", "end", "val", "accn", "filed")


@query("period_shape", """
SELECT entity, start, "end", CAST(value AS DOUBLE) AS value FROM v_intervals WHERE "end" - start BETWEEN 80 AND 190
""")
def period_shape(spark, sf):
    return asof.period_shape(v.intervals(spark, sf), instant=False, min_days=80, max_days=190).select(
        "entity", "start", "end", F.col("value").cast("double").alias("value"))


# ------------------------------------------------------------------- intervals

fragment("ledger", """
SELECT entity, make_date(y, 1, 1) AS start, make_date(y, 3, 31) AS "end", q1 AS value, 'tagged' AS source FROM v_years
UNION ALL SELECT entity, make_date(y, 4, 1), make_date(y, 6, 30), q2, 'derived_by_difference' FROM v_years
UNION ALL SELECT entity, make_date(y, 7, 1), make_date(y, 9, 30), q3, 'tagged' FROM v_years
UNION ALL SELECT entity, make_date(y, 10, 1), make_date(y, 12, 31), q4, 'derived_by_difference' FROM v_years
""")


def ledger(spark, sf):
    return iv.build_ledger(v.intervals(spark, sf), ["entity"])


def scaled_ledger(spark, sf):
    """Amounts as a distribution per share."""
    return ledger(spark, sf).where(F.col("end") <= v.ref())


@query("interval_ledger", """
SELECT entity, start, "end", CAST(value AS DOUBLE) AS value, source FROM ledger
""")
def interval_ledger(spark, sf):
    return ledger(spark, sf).select("entity", "start", "end", F.col("value").cast("double").alias("value"), "source")


fragment("history", """
SELECT entity, min(y) AS y1, max(y) AS y2, sum(q1 + q2 + q3 + q4) AS total, count(*) AS years FROM v_years GROUP BY entity
""")


# Two totals over an entity's whole history. One ends a quarter later and lacks nothing else once
# the years are settled, so that quarter is recovered; the other is open at both ends and tells nothing.
@query("interval_ledger_whole", """
SELECT entity, start, "end", CAST(value AS DOUBLE) AS value, source, CAST(CASE WHEN source = 'tagged' THEN 0
  WHEN month(start) = 4 THEN 1 ELSE 3 END AS INTEGER) AS parts FROM ledger
UNION ALL SELECT entity, make_date(y2 + 1, 1, 1), make_date(y2 + 1, 3, 31), 1000.25, 'derived_by_difference', CAST(4 * years AS INTEGER)
FROM history WHERE y2 - y1 + 1 = years
""")
def interval_ledger_whole(spark, sf):
    stated = v.intervals(spark, sf)
    full = stated.where(F.date_diff("end", "start") > 360).groupBy("entity").agg(
        F.min("start").alias("start"), F.max("end").alias("last"), F.sum("value").alias("total"))
    late = full.select("entity", "start", F.add_months("last", 3).alias("end"), (F.col("total") + F.lit("1000.25").cast("decimal(18,2)")).alias("value"))
    loose = full.select("entity", F.add_months("start", -120).alias("start"), F.add_months("last", 120).alias("end"), F.col("total").alias("value"))
    whole = late.unionByName(loose).select(
        "entity", "start", "end", F.col("value").cast("decimal(18,2)"), F.lit("tagged").alias("source"), F.lit(9).cast("bigint").alias("ord"))
    return iv.build_ledger(stated.unionByName(whole), ["entity"]).withColumn("value", F.col("value").cast("double"))


fragment("cover_days", """
SELECT DISTINCT o_custkey AS entity, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + 200 AS "end" FROM orders
""")


@query("interval_gaps", """
SELECT entity, gap_start, gap_end FROM (
  SELECT entity, greatest(coalesce(max("end") OVER w + 1, DATE '1996-01-01'), DATE '1996-01-01') AS gap_start, start - 1 AS gap_end
  FROM cover_days WHERE "end" >= DATE '1996-01-01' AND start <= DATE '2000-12-31'
  WINDOW w AS (PARTITION BY entity ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE gap_end >= gap_start
UNION ALL
SELECT entity, last_end + 1, DATE '2000-12-31' FROM (SELECT entity, max("end") AS last_end FROM cover_days
  WHERE "end" >= DATE '1996-01-01' AND start <= DATE '2000-12-31' GROUP BY entity) WHERE last_end < DATE '2000-12-31'
UNION ALL
SELECT c_custkey, DATE '1996-01-01', DATE '2000-12-31' FROM customer WHERE c_custkey NOT IN (
  SELECT entity FROM cover_days WHERE "end" >= DATE '1996-01-01' AND start <= DATE '2000-12-31')
""")
def interval_gaps(spark, sf):
    outer = v.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("entity"), F.lit(date(1996, 1, 1)).alias("start"), F.lit(date(2000, 12, 31)).alias("end"))
    day = F.col("o_orderdate").cast("date")
    covered = v.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("entity"), day.alias("start"), F.date_add(day, 200).alias("end"))
    return iv.interval_gaps(outer, covered, ["entity"])


fragment("month_cover", """
SELECT DISTINCT o_custkey % 50 AS entity, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) AS "end"
FROM orders WHERE o_orderkey % 7 = 0
""")


fragment("gap_outer", """
SELECT DISTINCT o_custkey % 50 AS entity, CAST(o_orderdate AS DATE) AS f, CAST(o_orderdate AS DATE) + 60 AS t FROM orders
UNION SELECT DISTINCT o_custkey % 50, DATE '1990-01-01', DATE '2002-12-31' FROM orders
""")
fragment("gap_days", """
SELECT DISTINCT entity, CAST(start + CAST(k AS INTEGER) AS DATE) AS d FROM month_cover, range(5) r(k) WHERE start + CAST(k AS INTEGER) <= "end"
""")
fragment("gap_free", """
SELECT entity, d + 1 AS s, coalesce(lead(d) OVER (PARTITION BY entity ORDER BY d), DATE '2100-01-01') - 1 AS e
FROM (SELECT * FROM gap_days UNION ALL SELECT DISTINCT o_custkey % 50, DATE '1900-01-01' FROM orders)
""")


# Thousands of overlapping outer intervals a key, among them one over a whole history.
@query("interval_gaps_many", """
SELECT o.entity, greatest(s, f) AS gap_start, least(e, t) AS gap_end FROM gap_outer o JOIN gap_free USING (entity)
WHERE e >= s AND s <= t AND e >= f
""")
def interval_gaps_many(spark, sf):
    o = v.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 50).alias("entity"), F.col("o_orderdate").cast("date").alias("start"), "o_orderkey")
    whole = o.select("entity", F.lit(date(1990, 1, 1)).alias("start"), F.lit(date(2002, 12, 31)).alias("end")).distinct()
    outer = o.select("entity", "start", F.date_add("start", 60).alias("end")).unionByName(whole)
    covered = o.where(F.col("o_orderkey") % 7 == 0).select(
        "entity", "start", F.date_add("start", (F.col("o_orderkey") % 5).cast("int")).alias("end"))
    return iv.interval_gaps(outer, covered, ["entity"])


@query("interval_sum", """
SELECT w.entity, w.ws AS window_start, w.we AS window_end, CAST(coalesce(sum(l.value), 0) AS DOUBLE) AS total,
  count(l.value) AS n_used, coalesce(sum(l."end" - l.start + 1), 0) >= (w.we - w.ws + 1) - 7 AS complete
FROM (SELECT DISTINCT entity, make_date(y, m, 1) AS ws, make_date(y + 1, m, 1) - 1 AS we
      FROM v_years, (VALUES (1), (5), (7)) t(m)) w
LEFT JOIN ledger l ON l.entity = w.entity AND l.start >= w.ws AND l."end" <= w.we GROUP BY w.entity, w.ws, w.we
""")
def interval_sum(spark, sf):
    years = v.quarters(spark, sf).select("entity", "y").distinct()
    windows = years.withColumn("m", F.explode(F.array(F.lit(1), F.lit(5), F.lit(7)))).select(
        "entity", F.make_date("y", "m", F.lit(1)).alias("window_start"),
        F.date_sub(F.make_date(F.col("y") + 1, F.col("m"), F.lit(1)), 1).alias("window_end"))
    out = iv.sum_between(ledger(spark, sf), windows, ["entity"])
    return out.withColumn("total", F.col("total").cast("double"))


@query("latest_quarter", """
SELECT entity, start, "end", CAST(value AS DOUBLE) AS value, source FROM (SELECT *, row_number() OVER (PARTITION BY entity
  ORDER BY start DESC) AS k FROM ledger WHERE "end" - start + 1 BETWEEN 80 AND 100) WHERE k = 1
""")
def latest_quarter(spark, sf):
    return iv.latest_quarter(ledger(spark, sf), ["entity"]).select(
        "entity", "start", "end", F.col("value").cast("double").alias("value"), "source")


@query("ttm_sum", """
SELECT q.entity, q."end" AS window_end, CAST(sum(l.value) AS DOUBLE) AS total, count(*) AS n_used,
  sum(l."end" - l.start + 1) >= 365 - 7 AS complete
FROM (SELECT entity, max("end") AS "end" FROM ledger WHERE "end" - start + 1 BETWEEN 80 AND 100 GROUP BY entity) q
JOIN ledger l ON l.entity = q.entity AND l.start >= q."end" - 364 AND l."end" <= q."end" GROUP BY ALL
""")
def ttm_sum(spark, sf):
    books = ledger(spark, sf)
    last = iv.latest_quarter(books, ["entity"])
    windows = last.select("entity", F.date_sub("end", 364).alias("window_start"), F.col("end").alias("window_end"))
    return iv.sum_between(books, windows, ["entity"]).select(
        "entity", "window_end", F.col("total").cast("double").alias("total"), "n_used", "complete")


# --------------------------------------------------------------------- returns

def nav_series(spark, sf):
    return v.nav(spark, sf).where(F.col("end") <= v.ref())


fragment("nav_steps", """
SELECT * FROM (SELECT entity, "end", nav, lag("end") OVER w AS prev_end, lag(nav) OVER w AS prev_nav FROM v_nav
WHERE "end" <= DATE '2000-12-31' WINDOW w AS (PARTITION BY entity ORDER BY "end")) WHERE prev_end IS NOT NULL
""")
fragment("nav_flows", """
SELECT s.entity, s."end", s.nav, s.prev_end, s.prev_nav, coalesce(sum(l.value), 0) AS flow, count(l.value) AS n_flows,
  count(*) FILTER (l.source <> 'tagged') AS n_derived,
  coalesce(sum(l."end" - l.start + 1), 0) >= (s."end" - s.prev_end) - 7 AND count(l.value) > 0 AS flow_complete
FROM nav_steps s LEFT JOIN ledger l ON l.entity = s.entity AND l.start > s.prev_end AND l."end" <= s."end"
GROUP BY s.entity, s."end", s.nav, s.prev_end, s.prev_nav
""")


# Three sparser series per nation, by month of the quarter: steps span whole quarters, and the
# flows fall inside those of the series that keeps the nation's number.
def half_year_nav(spark, sf):
    return nav_series(spark, sf).withColumn("entity", F.col("entity") + 100 * (F.month("end") % 3))


fragment("qnav", """SELECT CAST(entity + 100 * (month("end") % 3) AS INTEGER) AS entity, "end", nav FROM v_nav WHERE "end" <= DATE '2000-12-31'""")
fragment("qsteps", """
SELECT * FROM (SELECT entity, "end", nav, lag("end") OVER w AS prev_end, lag(nav) OVER w AS prev_nav FROM qnav
WINDOW w AS (PARTITION BY entity ORDER BY "end")) WHERE prev_end IS NOT NULL
""")
fragment("qflows", """
SELECT s.entity, s."end", s.nav, s.prev_end, s.prev_nav, CAST(coalesce(sum(l.value), 0) AS DOUBLE) AS flow, count(l.value) AS n_flows,
  count(*) FILTER (l.source <> 'tagged') AS n_derived,
  coalesce(sum(l."end" - l.start + 1), -1) >= (s."end" - s.prev_end) - 7 AS flow_complete
FROM qsteps s LEFT JOIN ledger l ON l.entity = s.entity AND l.start > s.prev_end AND l."end" <= s."end"
GROUP BY s.entity, s."end", s.nav, s.prev_end, s.prev_nav
""")


@query("series_flow_join", """
SELECT entity, prev_end, "end", flow, n_flows, n_derived, flow_complete FROM qflows
""")
def series_flow_join(spark, sf):
    moves = iv.steps(half_year_nav(spark, sf), ["entity"], "nav")
    return iv.flows_between(moves, ledger(spark, sf), ["entity"]).select(
        "entity", "prev_end", "end", F.col("flow").cast("double").alias("flow"), "n_flows", "n_derived", "flow_complete")


def per_share(spark, sf):
    """The ledger in the units of the price series."""
    books = ledger(spark, sf)
    return books.withColumn("value", (F.col("value") / 10_000_000).cast("decimal(28,10)"))


@query("period_return", """
SELECT entity, prev_end, "end", round((nav - prev_nav + flow / 10000000) / prev_nav, 6) AS period_return, "end" - prev_end AS gap_days
FROM qflows
""")
def period_return(spark, sf):
    out = rt.period_returns(half_year_nav(spark, sf), per_share(spark, sf), ["entity"])
    return out.select("entity", "prev_end", "end", six("period_return").alias("period_return"), "gap_days")


# Two years of some nations stand as entities of their own, so that long gaps and short runs exist.
def gappy(spark, sf):
    apart = (F.col("entity") % 3 == 0) & F.year("end").isin(1997, 1998)
    return nav_series(spark, sf).withColumn("entity", F.when(apart, F.col("entity") + 100).otherwise(F.col("entity")))


fragment("gappy", """
SELECT CAST(CASE WHEN entity % 3 = 0 AND year("end") IN (1997, 1998) THEN entity + 100 ELSE entity END AS INTEGER) AS entity, "end", nav
FROM v_nav WHERE "end" <= DATE '2000-12-31'
""")
fragment("runs", """
SELECT entity, max("end") FILTER (gap IS NULL OR gap > 200) AS run_start, max("end") AS run_end, count(*) AS n_obs
FROM (SELECT *, "end" - lag("end") OVER (PARTITION BY entity ORDER BY "end") AS gap FROM gappy) GROUP BY entity
""")


@query("contiguous_run", "SELECT * FROM runs")
def contiguous_run(spark, sf):
    return rt.contiguous_run(gappy(spark, sf), ["entity"])


fragment("window_asks", """
SELECT r.*, t.years, r.run_end - t.span AS target, t.tol FROM runs r
CROSS JOIN (VALUES (1, 365, 20), (3, 1096, 45), (5, 1826, 60)) t(years, span, tol)
""")
fragment("window_picks", """
SELECT a.*, p.at AS window_start, abs(p.at - a.target) AS drift FROM window_asks a
LEFT JOIN LATERAL (SELECT g."end" AS at FROM gappy g WHERE g.entity = a.entity AND g."end" < a.run_end
  ORDER BY abs(g."end" - a.target), g."end" LIMIT 1) p ON true
""")


@query("window_anchor", """
SELECT entity, years, target, window_start, drift, CASE WHEN n_obs < 3 THEN 'insufficient_history'
  WHEN drift > tol THEN 'window_mismatch' END AS reason FROM window_picks
""")
def window_anchor(spark, sf):
    return rt.trailing_total_returns(gappy(spark, sf), per_share(spark, sf), ["entity"]).select(
        "entity", "years", "target", "window_start", "drift", "reason")


fragment("gap_steps", """
SELECT * FROM (SELECT entity, "end", nav, lag("end") OVER w AS prev_end, lag(nav) OVER w AS prev_nav FROM gappy
WINDOW w AS (PARTITION BY entity ORDER BY "end")) WHERE prev_end IS NOT NULL
""")
fragment("gap_flows", """
SELECT s.entity, s."end", s.nav, s.prev_end, s.prev_nav, coalesce(sum(l.value), 0) AS flow,
  count(*) FILTER (l.source <> 'tagged') AS n_derived,
  coalesce(sum(l."end" - l.start + 1), -1) >= (s."end" - s.prev_end) - 7 AS flow_complete
FROM gap_steps s LEFT JOIN ledger l ON l.entity = s.entity AND l.start > s.prev_end AND l."end" <= s."end"
GROUP BY s.entity, s."end", s.nav, s.prev_end, s.prev_nav
""")
fragment("trailing_tr", """
SELECT p.entity, p.years, p.window_start, p.run_end, p.run_start, p.reason, p.drift,
  CASE WHEN p.reason IS NULL THEN (pow(product((f.nav - f.prev_nav + CAST(f.flow AS DOUBLE) / 10000000) / f.prev_nav + 1),
    365.25 / (p.run_end - p.window_start)) - 1) * 100 END AS value,
  count(*) FILTER (NOT f.flow_complete) AS n_incomplete, max(f."end" - f.prev_end) AS max_gap,
  sum(f.n_derived)::BIGINT AS n_derived
FROM (SELECT *, CASE WHEN n_obs < 3 THEN 'insufficient_history' WHEN drift > tol THEN 'window_mismatch' END AS reason FROM window_picks) p
JOIN gap_flows f ON f.entity = p.entity AND f.prev_end >= p.window_start
GROUP BY p.entity, p.years, p.window_start, p.run_end, p.run_start, p.reason, p.drift
""")


@query("total_return", """
SELECT entity, years, window_start, run_end, run_start, reason, round(value, 5) AS value, n_incomplete, max_gap, n_derived,
  CASE WHEN value IS NULL THEN 0 ELSE n_incomplete + CASE WHEN max_gap > 200 THEN 1 ELSE 0 END
    + CASE WHEN n_derived > 0 THEN 1 ELSE 0 END END AS n_flags FROM trailing_tr
""")
def total_return(spark, sf):
    out = rt.trailing_total_returns(gappy(spark, sf), per_share(spark, sf), ["entity"])
    return out.select("entity", "years", "window_start", "run_end", "run_start", "reason",
                      F.round("value", 5).alias("value"), "n_incomplete", "max_gap", "n_derived",
                      F.size("flags").alias("n_flags"))


# Returns of the months up to the anchor; each month stated once.
def monthly(spark, sf):
    return v.returns(spark, sf).where(F.col("month_end") <= v.ref())


fragment("chained", """
SELECT entity, share_class, years, max(n) AS n_months, min(first_month) AS coverage_start, max(last_month) AS coverage_end,
  CASE WHEN max(n) >= 12 * years AND max(m) - min(m) FILTER (k <= 12 * years) = 12 * years - 1
    THEN (pow(product(1 + ret / 100) FILTER (k <= 12 * years), 1.0 / years) - 1) * 100 END AS ret
FROM (SELECT *, year(month_end) * 12 + month(month_end) AS m, row_number() OVER (PARTITION BY entity, share_class ORDER BY month_end DESC) AS k,
    count(*) OVER (PARTITION BY entity, share_class) AS n, min(month_end) OVER (PARTITION BY entity, share_class) AS first_month,
    max(month_end) OVER (PARTITION BY entity, share_class) AS last_month
  FROM v_returns WHERE month_end <= DATE '2000-12-31'), (VALUES (1), (3), (5)) t(years) GROUP BY entity, share_class, years
""")


@query("chain_return", """
SELECT entity, share_class, years, n_months, round(ret, 5) AS ret FROM chained
""")
def chain_return(spark, sf):
    return rt.chain_returns(monthly(spark, sf), ["entity", "share_class"]).select(
        "entity", "share_class", "years", "n_months", F.round("ret", 5).alias("ret"))


@query("series_bands", """
SELECT entity, years, round(min(ret), 5) AS low, round(max(ret), 5) AS high, count(*) AS n_classes,
  1.0 BETWEEN min(ret) - 0.05 AND max(ret) + 0.05 AS holds_one
FROM chained WHERE ret IS NOT NULL GROUP BY entity, years HAVING count(*) >= 2
""")
def series_bands(spark, sf):
    bands = rt.return_bands(rt.chain_returns(monthly(spark, sf), ["entity", "share_class"]), ["entity"])
    return bands.select("entity", "years", F.round("low", 5).alias("low"), F.round("high", 5).alias("high"), "n_classes",
                        rt.in_band(F.lit(1.0), F.col("low"), F.col("high")).alias("holds_one"))


@query("monthly_trailing", """
SELECT entity, years, count(*) AS n_series,
  CASE WHEN count(*) = 1 THEN round(max(ret), 5) END AS value,
  CASE WHEN count(*) > 1 THEN 'class_attribution_failed' WHEN max(ret) IS NULL THEN 'insufficient_history' END AS reason,
  CASE WHEN count(*) > 1 AND count(ret) >= 2 THEN round(min(ret), 5) END AS low,
  CASE WHEN count(*) > 1 AND count(ret) >= 2 THEN round(max(ret), 5) END AS high
FROM (SELECT CASE WHEN entity % 2 = 0 THEN entity ELSE entity * 1000 + ascii(share_class) END AS entity, years, ret FROM chained)
GROUP BY entity, years
""")
def monthly_trailing(spark, sf):
    # Each class of an odd nation is an entity of its own.
    own = F.when(F.col("entity") % 2 == 0, F.col("entity")).otherwise(F.col("entity") * 1000 + F.ascii("share_class"))
    rows = monthly(spark, sf).withColumns({"entity": own, "filed": F.col("month_end"), "ord": F.lit(0)})
    out = rt.monthly_trailing(rows)
    return out.select("entity", "years", "n_series", *[F.round(c, 5).alias(c) for c in ("value", "low", "high")], "reason")


@query("month_unpivot", """
SELECT entity, accn, i AS month_no, CASE i WHEN 2 THEN "end" ELSE last_day(CAST("end" - INTERVAL (2 - i) MONTH AS DATE)) END AS month_end,
  CASE i WHEN 0 THEN val / 1000 WHEN 1 THEN val / 2000 ELSE val / 4000 END AS ret
FROM v_facts, (VALUES (0), (1), (2)) t(i) WHERE i <> 1 OR ord % 5 <> 0
""")
def month_unpivot(spark, sf):
    f = v.facts(spark, sf).select(
        "entity", "accn", F.col("end").alias("period_end"), (F.col("val") / 1000).alias("rtn1"),
        F.when(F.col("ord") % 5 != 0, F.col("val") / 2000).alias("rtn2"),
        (F.col("val") / 4000).alias("rtn3"))
    out = rt.month_unpivot(f)
    no = 2 - F.months_between(F.last_day("period_end"), F.last_day("month_end")).cast("int")
    return out.select("entity", "accn", no.alias("month_no"), "month_end", "ret")


def nation_entities(spark, sf):
    n = v.table(spark, sf, "nation")
    fye = F.when(F.col("n_nationkey") % 3 == 0, "12-31").when(F.col("n_nationkey") % 3 == 1, "09-30").otherwise("03-31")
    return n.select(F.col("n_nationkey").alias("entity"), fye.alias("fiscal_year_end"))


@query("semiannual_cadence", """
SELECT entity, "end", nav FROM v_nav WHERE "end" BETWEEN DATE '1998-12-31' AND DATE '2000-12-31'
  AND CASE entity % 3 WHEN 0 THEN month("end") IN (12, 6) ELSE month("end") IN (9, 3) END
""")
def semiannual_cadence(spark, sf):
    return rt.semiannual_cadence(v.nav(spark, sf), nation_entities(spark, sf), v.ref()).select("entity", "end", "nav")


@query("return_candidates", """
SELECT entity, CASE years WHEN 1 THEN 'net_return_1y_pct' WHEN 3 THEN 'net_return_3y_pct' ELSE 'net_return_5y_pct' END AS metric,
  round(value, 5) AS value, run_end AS period_end, 'net_of_fees=True|reinvested=True|return_basis=nav_total_return' AS basis_key
FROM trailing_tr WHERE value IS NOT NULL
""")
def return_candidates(spark, sf):
    from plumbline.plans.candidates import return_candidates as to_candidates

    out = to_candidates(rt.trailing_total_returns(gappy(spark, sf), per_share(spark, sf), ["entity"]))
    return out.select("entity", "metric", F.round("value", 5).alias("value"), "period_end",
                      text.basis_key(F.col("basis")).alias("basis_key"))
