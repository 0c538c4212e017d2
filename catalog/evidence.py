"""Queries on conflicting candidates: filters, bases, clusters, scores, K1."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as v
from catalog.registry import fragment, query, variant
from plumbline import rules
from plumbline.functions import scoring, text
from plumbline.operators import eligibility, resolve as rs
from plumbline.operators.cluster import FOLD_LIMIT, tolerance_clusters

KEYS = ["entity", "metric"]

# SQL staging of the whole reconciliation, for both anchors at once.
fragment("anchors", "SELECT * FROM (VALUES (DATE '2000-09-30'), (DATE '2000-12-31')) t(anchor)")
fragment("el", """
SELECT a.anchor, c.* REPLACE (coalesce(c.as_of, c.period_end) AS as_of)
FROM v_candidates c JOIN anchors a ON coalesce(c.as_of, c.period_end) <= a.anchor
""")
fragment("ev", """
SELECT el.*, 'rate_basis=' || rate_basis || '|share_class=' || share_class AS basis_key,
  NOT (value BETWEEN m.low AND m.high) AS f0, NOT f1 AS measures, f5 AS disq,
  f1::INT + f2::INT + f3::INT + f4::INT + f5::INT + (NOT (value BETWEEN m.low AND m.high))::INT AS n_flags,
  (CASE WHEN f1 THEN 0.90::DOUBLE ELSE 1 END) * (CASE WHEN f2 THEN 0.85::DOUBLE ELSE 1 END)
   * (CASE WHEN f3 THEN 0.85::DOUBLE ELSE 1 END) * (CASE WHEN f4 THEN 0.90::DOUBLE ELSE 1 END)
   * (CASE WHEN f5 THEN 0.55::DOUBLE ELSE 1 END)
   * (CASE WHEN NOT (value BETWEEN m.low AND m.high) THEN 0.30::DOUBLE ELSE 1 END) AS penalty,
  concat_ws('; ', CASE WHEN f1 THEN 'superseded_rate' END, CASE WHEN f2 THEN 'ttm_window_incomplete' END,
    CASE WHEN f3 THEN 'nav_history_gap_92d' END, CASE WHEN f4 THEN 'odd_flag' END,
    CASE WHEN f5 THEN 'zero_borrowings_but_material_total_liabilities' END,
    CASE WHEN NOT (value BETWEEN m.low AND m.high) THEN 'out_of_sane_range' END) AS flags,
  CASE WHEN el.mno % 2 = 1 THEN 0 WHEN rate_basis = 'N' THEN 0 WHEN rate_basis = 'A' THEN 1 ELSE 2 END AS pref_rank,
  CASE WHEN e.institutional_class = '' OR e.institutional_class = share_class THEN 0 ELSE 2 END AS class_rank,
  effective_until IS NOT NULL AND effective_until <= anchor AS dated_out,
  tier || '/' || accession || '/' || transforms AS obs,
  CASE el.unit WHEN 'ratio' THEN 0.02 WHEN 'usd' THEN 0.02 ELSE 0.10 END::DOUBLE AS tol_abs,
  CASE el.unit WHEN 'ratio' THEN 0.015 WHEN 'usd' THEN 0.002 ELSE 0.010 END::DOUBLE AS tol_rel
FROM el JOIN v_metrics m USING (metric) JOIN v_entities e USING (entity)
""")
fragment("bases", """
SELECT anchor, entity, metric, basis_key, min(class_rank) AS class_rank, min(pref_rank) AS pref_rank,
  max(tier_score) AS max_tier, min(ord) AS first_ord, bool_and(disq) AS all_disq, bool_and(dated_out) AS all_out,
  count(*) AS n_rows
FROM ev GROUP BY ALL
""")
fragment("ranked_bases", """
SELECT *, row_number() OVER (PARTITION BY anchor, entity, metric
    ORDER BY class_rank, pref_rank, max_tier DESC, first_ord) AS basis_no,
  count(*) OVER (PARTITION BY anchor, entity, metric) AS n_bases,
  sum(n_rows) OVER (PARTITION BY anchor, entity, metric) AS n_candidates
FROM bases
""")
fragment("pf", """
SELECT ev.*, b.all_disq FROM ev JOIN ranked_bases b USING (anchor, entity, metric, basis_key)
WHERE basis_no = 1 AND (NOT dated_out OR all_out OR all_disq)
""")
fragment("vals", """
SELECT *, row_number() OVER (PARTITION BY anchor, entity, metric ORDER BY value) AS rn
FROM (SELECT DISTINCT anchor, entity, metric, tol_abs, tol_rel, value FROM pf)
""")
fragment("lead_walk", """
SELECT anchor, entity, metric, rn, value, value AS leader, 1 AS cluster FROM vals WHERE rn = 1
UNION ALL
SELECT n.anchor, n.entity, n.metric, n.rn, n.value,
  CASE WHEN abs(w.leader - n.value) <= greatest(n.tol_abs,
    n.tol_rel * CASE WHEN abs(w.leader) + abs(n.value) = 0 THEN 1.0 ELSE (abs(w.leader) + abs(n.value)) / 2 END)
    THEN w.leader ELSE n.value END,
  CASE WHEN abs(w.leader - n.value) <= greatest(n.tol_abs,
    n.tol_rel * CASE WHEN abs(w.leader) + abs(n.value) = 0 THEN 1.0 ELSE (abs(w.leader) + abs(n.value)) / 2 END)
    THEN w.cluster ELSE w.cluster + 1 END
FROM lead_walk w JOIN vals n ON n.anchor = w.anchor AND n.entity = w.entity AND n.metric = w.metric AND n.rn = w.rn + 1
""")
fragment("clustered", """
SELECT pf.*, w.leader, w.cluster FROM pf JOIN lead_walk w USING (anchor, entity, metric, value)
""")
fragment("cluster_stats", """
SELECT anchor, entity, metric, cluster, bool_or(measures) AS any_measure, count(DISTINCT obs) AS independents,
  min(n_flags) AS min_flags, max(tier_score) AS max_tier, max(as_of) AS max_day, count(*) AS n_rows
FROM clustered GROUP BY ALL
""")
fragment("cluster_win", """
SELECT *, row_number() OVER (PARTITION BY anchor, entity, metric ORDER BY any_measure DESC, independents DESC,
  min_flags, max_tier DESC, max_day DESC, cluster) AS cluster_no,
  count(*) OVER (PARTITION BY anchor, entity, metric) AS n_clusters FROM cluster_stats
""")
fragment("chosen", """
SELECT * FROM (
  SELECT c.*, w.independents, w.n_clusters, row_number() OVER (PARTITION BY anchor, entity, metric
    ORDER BY n_flags, tier_score DESC, as_of DESC, value, ord) AS pick
  FROM clustered c JOIN cluster_win w USING (anchor, entity, metric, cluster) WHERE cluster_no = 1) WHERE pick = 1
""")
fragment("agree_counts", """
SELECT anchor, entity, metric,
  count(*) FILTER (ok AND near) AS n_agree, count(*) FILTER (ok AND NOT near) AS n_disagree
FROM (SELECT p.anchor, p.entity, p.metric, p.measures AND p.obs <> c.obs AS ok,
    abs(c.value - p.value) <= greatest(c.tol_abs, c.tol_rel * CASE WHEN abs(c.value) + abs(p.value) = 0
      THEN 1.0 ELSE (abs(c.value) + abs(p.value)) / 2 END) AS near
  FROM pf p JOIN chosen c USING (anchor, entity, metric)) GROUP BY ALL
""")
fragment("scored", """
SELECT *, CASE WHEN n_disagree > 0 THEN 0.70 WHEN n_agree > 0 THEN 1.10 ELSE 0.90 END::DOUBLE AS agreement,
  CASE WHEN as_of IS NULL THEN 0.70 WHEN anchor - as_of <= 100 THEN 1.0 WHEN anchor - as_of <= 200 THEN 0.95
    WHEN anchor - as_of <= 400 THEN 0.85 ELSE 0.70 END::DOUBLE AS freshness,
  anchor - as_of AS age_days
FROM chosen JOIN agree_counts USING (anchor, entity, metric)
""")
fragment("plain_best", """
SELECT anchor, entity, metric, as_of AS plain_as_of FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor, entity, metric ORDER BY n_flags, tier_score DESC, ord) AS k FROM pf)
WHERE k = 1
""")
fragment("resolved", """
SELECT s.* EXCLUDE (as_of, value), s.value AS chosen_value, b.n_bases, b.n_candidates,
  CASE WHEN reason = 'basis_disqualified' THEN p.plain_as_of ELSE s.as_of END AS as_of,
  CASE WHEN reason IS NULL THEN s.value END AS value,
  CASE WHEN reason IS NOT NULL THEN 'Suppressed' ELSE grade END AS confidence,
  CASE WHEN reason = 'basis_disqualified' THEN 0.0 ELSE s.score END AS final_score
FROM (
  SELECT *, CASE WHEN score >= 0.85 THEN 'High' WHEN score >= 0.65 THEN 'Medium' WHEN score >= 0.40 THEN 'Low'
      ELSE 'Suppressed' END AS grade,
    CASE WHEN all_disq THEN 'basis_disqualified'
      WHEN anchor - coalesce(terms_clock, as_of) > 183 THEN 'stale_beyond_limit'
      WHEN score < 0.40 THEN 'below_confidence_floor' END AS reason
  FROM (SELECT *, greatest(0.0, least(1.0, tier_score * agreement * freshness * penalty)) AS score FROM scored)) s
JOIN plain_best p USING (anchor, entity, metric)
JOIN (SELECT DISTINCT anchor, entity, metric, n_bases, n_candidates FROM ranked_bases) b USING (anchor, entity, metric)
""")


def eligible_candidates(spark, sf):
    return eligibility.eligible(v.candidates(spark, sf), v.ref())


def staged(spark, sf) -> rs.Stages:
    ev = rs.evidence(eligible_candidates(spark, sf), v.metrics(spark), v.ref())
    return rs.stages(ev, v.entities(spark, sf), v.metrics(spark), KEYS)


def resolved(spark, sf):
    return rs.resolve(eligible_candidates(spark, sf), v.entities(spark, sf), v.metrics(spark), v.ref())


def six(col):
    return F.round(col, 6)


@query("reconcile", """
SELECT entity, metric, round(value, 6) AS value, unit, confidence, round(final_score, 6) AS score, reason,
  as_of, tier, accession, basis_key, n_agree, n_disagree, n_clusters, n_bases, n_candidates
FROM resolved WHERE anchor = DATE '2000-12-31'
""")
def reconcile(spark, sf):
    return resolved(spark, sf).select(
        "entity", "metric", six("value").alias("value"), "unit", "confidence", six("score").alias("score"),
        "reason", "as_of", "tier", "accession", "basis_key", "n_agree", "n_disagree",
        "n_clusters", "n_bases", "n_candidates",
    )


# ------------------------------------------------------------ filters, notices

@query("anchor_filter", """
SELECT entity, metric, accession, round(value, 6) AS value, as_of FROM el WHERE anchor = DATE '2000-12-31'
""")
def anchor_filter(spark, sf):
    return eligible_candidates(spark, sf).select(
        "entity", "metric", "accession", six("value").alias("value"),
        eligibility.covers().alias("as_of"))


@query("range_flag", """
SELECT entity, metric, accession, round(value, 6) AS value, n_flags, flags FROM ev WHERE anchor = DATE '2000-12-31'
""")
def range_flag(spark, sf):
    rows = eligibility.flag_ranges(eligible_candidates(spark, sf), v.metrics(spark))
    return rows.select("entity", "metric", "accession", six("value").alias("value"),
                       F.size("flags").alias("n_flags"), F.array_join("flags", "; ").alias("flags"))


def basis_rows(spark, sf):
    return staged(spark, sf).groups


@query("disqualified_groups", """
SELECT entity, metric, basis_key, all_disq AS disqualified, n_rows FROM ranked_bases
WHERE anchor = DATE '2000-12-31' AND basis_no = 1 AND all_disq
""")
def disqualified_groups(spark, sf):
    st = staged(spark, sf)
    n = st.groups.select(*KEYS, "basis_key", "n_rows")
    return st.primary.where("all_disqualified").join(n, [*KEYS, "basis_key"]).select(
        *KEYS, "basis_key", F.col("all_disqualified").alias("disqualified"), "n_rows")


@query("in_force", """
SELECT entity, metric, basis_key, count(*) AS n_kept, count(*) FILTER (dated_out) AS n_dated_out_kept
FROM (SELECT *, bool_and(dated_out) OVER (PARTITION BY entity, metric, basis_key) AS all_out
  FROM ev WHERE anchor = DATE '2000-12-31') WHERE NOT dated_out OR all_out GROUP BY ALL
""")
def in_force(spark, sf):
    ev = rs.keyed_by_basis(rs.evidence(eligible_candidates(spark, sf), v.metrics(spark), v.ref()), v.metrics(spark))
    # Counting both kinds per basis decides the fallback without a window.
    return ev.groupBy(*KEYS, "basis_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("dated_out").alias("n_out")
    ).select(
        *KEYS, "basis_key",
        F.when(F.col("n") == F.col("n_out"), F.col("n")).otherwise(F.col("n") - F.col("n_out")).alias("n_kept"),
        F.when(F.col("n") == F.col("n_out"), F.col("n")).otherwise(F.lit(0)).alias("n_dated_out_kept"),
    )


@query("excluded_keys", """
SELECT entity, metric, 'no_candidate' AS reason, count(*) AS n_excluded, min(coalesce(as_of, period_end)) AS as_of
FROM v_candidates GROUP BY entity, metric
HAVING coalesce(min(coalesce(as_of, period_end)), DATE '9999-12-31') > DATE '1999-12-20'
""")
def excluded_keys(spark, sf):
    from datetime import date

    out = eligibility.excluded_notices(v.candidates(spark, sf), KEYS, F.lit(date(1999, 12, 20)))
    return out.select(*KEYS, "reason", "n_excluded", "as_of")


fragment("first_notice_rows", """
SELECT entity, reason, detail, ord FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ord) AS k
FROM v_notices) WHERE k = 1
""")


@query("first_notice", "SELECT entity, reason, detail, ord FROM first_notice_rows")
def first_notice(spark, sf):
    return eligibility.first_notices(v.notices(spark, sf), ["entity"]).select("entity", "reason", "detail", "ord")


@query("notice_fallback", """
SELECT s_suppkey AS entity, coalesce(reason, 'no_candidate') AS reason,
  coalesce(detail, 'no candidate value found in any source') AS detail
FROM supplier LEFT JOIN first_notice_rows ON s_suppkey = entity
""")
def notice_fallback(spark, sf):
    grid = v.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"))
    first = eligibility.first_notices(v.notices(spark, sf), ["entity"])
    return eligibility.with_notices(grid, first, ["entity"]).select("entity", "reason", "detail")


fragment("grid", """
SELECT e.*, m.metric, m.mno, m.unit, m.direction,
  CASE WHEN m.mno <= e.last_listed THEN true
    ELSE m.custom AND (NOT m.interval_only OR e.entity_type = 'interval_fund') END AS in_scope
FROM v_entities e CROSS JOIN v_metrics m
""")


@query("dense_grid", "SELECT entity, entity_type, metric, unit, direction, in_scope FROM grid")
def dense_grid(spark, sf):
    return eligibility.dense_grid(v.entities(spark, sf), v.SPECS).select(
        "entity", "entity_type", "metric", "unit", "direction", "in_scope")


@query("doc_in_force", """
SELECT entity, form, accession, filing_date, rn FROM (SELECT *, row_number() OVER (PARTITION BY entity, form
  ORDER BY filing_date DESC, accession DESC) AS rn FROM v_filings WHERE filing_date <= DATE '2000-12-31') WHERE rn <= 1
""")
def doc_in_force(spark, sf):
    return eligibility.terms_documents(v.filings(spark, sf), v.ref()).select(
        "entity", "form", "accession", "filing_date", "rn")


@query("doc_by_period", """
SELECT entity, form, accession, report_date FROM (SELECT *, row_number() OVER (PARTITION BY entity
  ORDER BY report_date DESC, accession) AS rn FROM v_filings
  WHERE form IN ('1-URGENT', '2-HIGH') AND report_date <= DATE '2000-12-31') WHERE rn = 1
""")
def doc_by_period(spark, sf):
    return eligibility.period_documents(v.filings(spark, sf), ["1-URGENT", "2-HIGH"], v.ref()).select(
        "entity", "form", "accession", "report_date")


@query("topk_per_group", """
SELECT entity, form, accession, report_date, rn FROM (SELECT *, row_number() OVER (PARTITION BY entity, form
  ORDER BY report_date DESC, filing_date DESC, accession DESC) AS rn FROM v_filings
  WHERE report_date <= DATE '2000-12-31') WHERE rn <= 3
""")
def topk_per_group(spark, sf):
    return eligibility.latest_reports(v.filings(spark, sf), v.ref(), 3).select(
        "entity", "form", "accession", "report_date", "rn")


AMENDABLE = {"bdc": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "mortgage_reit": ("1-URGENT", "5-LOW"),
             "interval_fund": ("4-NOT SPECIFIED", "5-LOW")}


def customer_entities(spark, sf):
    c = v.table(spark, sf, "customer")
    kind = F.when(F.col("c_nationkey") % 3 == 0, "interval_fund").when(
        F.col("c_nationkey") % 3 == 1, "bdc").otherwise("mortgage_reit")
    return c.select(F.col("c_custkey").alias("entity"), kind.alias("entity_type"))


fragment("customer_entities", """
SELECT c_custkey AS entity, CASE c_nationkey % 3 WHEN 0 THEN 'interval_fund' WHEN 1 THEN 'bdc'
  ELSE 'mortgage_reit' END AS entity_type FROM customer
""")


@query("amendment_clock", """
SELECT entity, filing_date AS terms_clock, form AS clock_form, CASE WHEN filing_date - base > 183 THEN 1 ELSE 0 END AS lapsed
FROM (
  SELECT f.entity, f.filing_date, f.form, c.base, row_number() OVER (PARTITION BY f.entity ORDER BY f.filing_date DESC, f.form) AS k
  FROM v_filings f JOIN customer_entities e USING (entity)
  JOIN (SELECT entity, min(report_date) AS base FROM v_filings GROUP BY entity) c USING (entity)
  WHERE f.filing_date <= DATE '2000-12-31' AND ((entity_type = 'bdc' AND form IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
    OR (entity_type = 'mortgage_reit' AND form IN ('1-URGENT', '5-LOW'))
    OR (entity_type = 'interval_fund' AND form IN ('4-NOT SPECIFIED', '5-LOW'))))
WHERE k = 1 AND filing_date > base
""")
def amendment_clock(spark, sf):
    filings = v.filings(spark, sf)
    clocks = eligibility.amendment_clock(filings, customer_entities(spark, sf), v.ref(), AMENDABLE)
    terms = filings.groupBy("entity").agg(F.min("report_date").alias("as_of")).select(
        "entity", F.lit("management_fee_pct").alias("metric"), "as_of",
        F.lit(None).cast("date").alias("terms_clock"),
        F.array().cast("array<string>").alias("flags"), F.array().cast("array<string>").alias("transforms"))
    out = eligibility.apply_terms_clock(terms, clocks, rules.TERMS_METRICS)
    form = F.regexp_extract(F.get("transforms", 0), r"\((.*), no amendment", 1)
    return out.where(F.col("terms_clock").isNotNull()).select(
        "entity", "terms_clock", form.alias("clock_form"), F.size("flags").alias("lapsed"))


# -------------------------------------------------------- bases, clusters, scores

@query("basis_key", """
SELECT basis_key, count(*) AS n, count(DISTINCT entity) AS entities FROM ev WHERE anchor = DATE '2000-12-31' GROUP BY ALL
""")
def basis_key(spark, sf):
    return eligible_candidates(spark, sf).groupBy(text.basis_key(F.col("basis")).alias("basis_key")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("entity").alias("entities"))


@query("format_basis", """
SELECT DISTINCT rate_basis || '; share class: ' || replace(share_class, '_', ' ') AS basis FROM v_candidates
""")
def format_basis(spark, sf):
    return v.candidates(spark, sf).select("basis").select(text.format_basis(F.col("basis")).alias("basis")).distinct()


fragment("prices", """
SELECT l_partkey AS part, l_extendedprice AS value, row_number() OVER (PARTITION BY l_partkey ORDER BY l_extendedprice) AS rn
FROM (SELECT DISTINCT l_partkey, l_extendedprice FROM lineitem)
""")
fragment("price_walk", """
SELECT part, rn, value, value AS leader, 1 AS cluster FROM prices WHERE rn = 1
UNION ALL
SELECT n.part, n.rn, n.value,
  CASE WHEN abs(w.leader - n.value) <= greatest(0.10, 0.010 * (abs(w.leader) + abs(n.value)) / 2) THEN w.leader ELSE n.value END,
  CASE WHEN abs(w.leader - n.value) <= greatest(0.10, 0.010 * (abs(w.leader) + abs(n.value)) / 2) THEN w.cluster ELSE w.cluster + 1 END
FROM price_walk w JOIN prices n ON n.part = w.part AND n.rn = w.rn + 1
""")


def price_rows(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("value"), F.lit("pct").alias("unit"))


PRICE_SQL = """
SELECT p.l_partkey AS part, w.cluster, w.leader, count(*) AS n, max(w.value) AS high
FROM lineitem p JOIN price_walk w ON p.l_partkey = w.part AND p.l_extendedprice = w.value GROUP BY ALL
"""


def price_clusters(spark, sf, fold_limit):
    out = tolerance_clusters(price_rows(spark, sf), ["part"], fold_limit)
    return out.groupBy("part", "cluster", "leader").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high"))


@query("tolerance_cluster", PRICE_SQL)
def tolerance_cluster(spark, sf):
    return price_clusters(spark, sf, FOLD_LIMIT)


# All prices as one group.
fragment("one_walk", """
SELECT min(l_extendedprice) AS leader FROM lineitem
UNION ALL
SELECT min(p.value) FROM one_walk w JOIN (SELECT DISTINCT l_extendedprice AS value FROM lineitem) p
  ON p.value > w.leader AND abs(w.leader - p.value) > greatest(0.10, 0.010 * (abs(w.leader) + abs(p.value)) / 2)
HAVING min(p.value) IS NOT NULL
""")


@query("tolerance_cluster_one_group", """
SELECT w.cluster, w.leader, count(*) AS n, max(l_extendedprice) AS high
FROM lineitem ASOF JOIN (SELECT leader, row_number() OVER (ORDER BY leader) AS cluster FROM one_walk) w ON l_extendedprice >= w.leader
GROUP BY ALL
""")
def tolerance_cluster_one_group(spark, sf):
    rows = price_rows(spark, sf).withColumn("part", F.lit(0))
    return tolerance_clusters(rows, ["part"]).groupBy("cluster", "leader").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("high"))


@query("independent_filings", """
SELECT entity, metric, basis_key, count(DISTINCT accession) AS independents, count(*) AS n
FROM ev WHERE anchor = DATE '2000-12-31' GROUP BY ALL
""")
def independent_filings(spark, sf):
    """One vote per filing, whatever was read from it and how."""
    ev = rs.evidence(eligible_candidates(spark, sf), v.metrics(spark), v.ref(), strict_independence=True)
    return rs.keyed_by_basis(ev, v.metrics(spark)).groupBy(*KEYS, "basis_key").agg(
        F.count_distinct("observation").alias("independents"), F.count(F.lit(1)).alias("n"))


@query("independent_count", """
SELECT entity, metric, basis_key, count(DISTINCT obs) AS independents, count(*) AS n
FROM ev WHERE anchor = DATE '2000-12-31' GROUP BY ALL
""")
def independent_count(spark, sf):
    rows = eligible_candidates(spark, sf).withColumn("basis_key", text.basis_key(F.col("basis")))
    return rows.groupBy(*KEYS, "basis_key").agg(
        F.count_distinct("tier", "accession", "transforms").alias("independents"), F.count(F.lit(1)).alias("n"))


@query("basis_select", """
SELECT entity, metric, basis_key, class_rank, pref_rank, max_tier, n_bases FROM ranked_bases
WHERE anchor = DATE '2000-12-31' AND basis_no = 1
""")
def basis_select(spark, sf):
    st = staged(spark, sf)
    return st.primary.select(*KEYS, "basis_key", "n_bases").join(
        st.groups.select(*KEYS, "basis_key", "class_rank", "pref_rank", "max_tier"), [*KEYS, "basis_key"])


@query("evidence_winner", """
SELECT entity, metric, round(value, 6) AS value, tier, accession, n_flags, independents, n_clusters
FROM chosen WHERE anchor = DATE '2000-12-31'
""")
def evidence_winner(spark, sf):
    return resolved(spark, sf).select(
        *KEYS, six("chosen_value").alias("value"), "tier", "accession", "n_flags", "independents", "n_clusters")


fragment("conflict_pool", """
SELECT c.anchor, c.entity, c.metric, c.value FROM clustered c JOIN cluster_win w USING (anchor, entity, metric, cluster)
WHERE w.cluster_no > 1
UNION ALL SELECT anchor, entity, metric, value FROM chosen WHERE n_clusters > 1
""")
fragment("conflict_mid", """
SELECT anchor, entity, metric, max(value) - min(value) AS span,
  max(value) FILTER (k = n // 2) AS mid
FROM (SELECT *, row_number() OVER (PARTITION BY anchor, entity, metric ORDER BY value) - 1 AS k,
        count(*) OVER (PARTITION BY anchor, entity, metric) AS n FROM conflict_pool)
GROUP BY ALL
""")


@query("conflict_report", """
SELECT c.entity, c.metric, round(c.value, 6) AS chosen_value, l.losing_clusters, l.losing_rows, l.losing_independents,
  round(m.span / abs(CASE WHEN m.mid = 0 THEN 1.0 ELSE m.mid END) * 100, 5) AS spread_pct
FROM chosen c JOIN conflict_mid m USING (anchor, entity, metric)
JOIN (SELECT anchor, entity, metric, count(*) AS losing_clusters, sum(n_rows)::BIGINT AS losing_rows,
    sum(independents)::BIGINT AS losing_independents FROM cluster_win WHERE cluster_no > 1 GROUP BY ALL) l USING (anchor, entity, metric)
WHERE anchor = DATE '2000-12-31'
""")
def conflict_report(spark, sf):
    return resolved(spark, sf).where("n_clusters > 1").select(
        *KEYS, six("chosen_value").alias("chosen_value"), (F.col("n_clusters") - 1).alias("losing_clusters"),
        "losing_rows", "losing_independents", F.round("spread_pct", 5).alias("spread_pct"))


@query("superseded_label", """
SELECT entity, metric, accession, CASE WHEN f1 AND effective_until IS NOT NULL
    THEN rtrim(rtrim(printf('%.2f', value), '0'), '.') || '% (superseded as of ' || CAST(effective_until AS VARCHAR) || ')'
  WHEN f1 THEN rtrim(rtrim(printf('%.2f', value), '0'), '.') || '% (superseded, date not stated in filing)'
  ELSE rtrim(rtrim(printf('%.2f', value), '0'), '.') END AS label
FROM v_candidates
""")
def superseded_label(spark, sf):
    rows = v.candidates(spark, sf)
    superseded = F.array_contains("flags", "superseded_rate")
    return rows.select(*KEYS, "accession", text.superseded_label(
        F.col("value"), superseded, F.col("effective_until")).alias("label"))


@query("penalty_product", """
SELECT entity, metric, accession, n_flags, round(penalty, 6) AS penalty FROM ev WHERE anchor = DATE '2000-12-31'
""")
def penalty_product(spark, sf):
    rows = eligibility.flag_ranges(eligible_candidates(spark, sf), v.metrics(spark))
    return rows.select(*KEYS, "accession", F.size("flags").alias("n_flags"),
                       six(scoring.penalty_product(F.col("flags"))).alias("penalty"))


@query("alternatives", """
SELECT entity, metric, basis_key, round(value, 6) AS value, tier, n_flags FROM (
  SELECT ev.*, row_number() OVER (PARTITION BY entity, metric, basis_key ORDER BY n_flags, ev.tier_score DESC, ord) AS k
  FROM ev JOIN ranked_bases b USING (anchor, entity, metric, basis_key)
  WHERE anchor = DATE '2000-12-31' AND basis_no > 1) WHERE k = 1
""")
def alternatives(spark, sf):
    st = staged(spark, sf)
    return rs.alternatives(st.evidence, st.primary, KEYS).select(
        *KEYS, "basis_key", six("value").alias("value"), "tier", "n_flags")


@query("evidence_score", """
SELECT entity, metric, tier_score, agreement, freshness, round(penalty, 6) AS penalty, n_agree, n_disagree,
  round(greatest(0.0, least(1.0, tier_score * agreement * freshness * penalty)), 6) AS score
FROM scored WHERE anchor = DATE '2000-12-31' AND NOT all_disq
""")
def evidence_score(spark, sf):
    out = resolved(spark, sf).where("not all_disqualified")
    return out.select(*KEYS, "tier_score", "agreement", "freshness", six("penalty").alias("penalty"),
                      "n_agree", "n_disagree", six("score").alias("score"))


@query("grade", """
SELECT grade, reason, count(*) AS n FROM resolved WHERE anchor = DATE '2000-12-31' GROUP BY ALL
""")
def grade(spark, sf):
    out = resolved(spark, sf)
    score = F.col("tier_score") * F.col("agreement") * F.col("freshness") * F.col("penalty")
    return out.groupBy(scoring.grade(scoring.clamp01(score)).alias("grade"), "reason").agg(
        F.count(F.lit(1)).alias("n"))


@query("freshness", """
SELECT entity, metric, accession, CASE WHEN as_of IS NULL THEN 0.70 WHEN DATE '2000-12-31' - as_of <= 100 THEN 1.0
  WHEN DATE '2000-12-31' - as_of <= 200 THEN 0.95 WHEN DATE '2000-12-31' - as_of <= 400 THEN 0.85 ELSE 0.70 END::DOUBLE AS freshness
FROM v_candidates
""")
def freshness(spark, sf):
    return v.candidates(spark, sf).select(
        *KEYS, "accession", scoring.freshness(F.col("as_of"), v.ref()).alias("freshness"))


@query("values_agree", """
SELECT l_orderkey, l_linenumber, l_partkey, abs(l_quantity - l_extendedprice / 1000) <= greatest(
  CASE l_linenumber % 3 WHEN 0 THEN 0.10 ELSE 0.02 END,
  CASE l_linenumber % 3 WHEN 0 THEN 0.010 WHEN 1 THEN 0.015 ELSE 0.002 END * (l_quantity + l_extendedprice / 1000) / 2) AS agree
FROM lineitem
""")
def values_agree(spark, sf):
    li = v.table(spark, sf, "lineitem")
    k = F.col("l_linenumber") % 3
    unit = F.when(k == 0, "pct").when(k == 1, "ratio").otherwise("usd")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", scoring.values_agree(
        F.col("l_quantity"), F.col("l_extendedprice") / 1000, unit).alias("agree"))


@query("stale_cut", """
SELECT entity, metric, count(*) AS n, count(*) FILTER (coalesce(DATE '2000-12-31' - coalesce(terms_clock, as_of) > 183, false)) AS n_stale
FROM v_candidates GROUP BY ALL
""")
def stale_cut(spark, sf):
    stale = scoring.is_stale(F.coalesce("terms_clock", "as_of"), v.ref())
    return v.candidates(spark, sf).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(stale).alias("n_stale"))


@query("stale_detail", """
SELECT entity, metric, CASE WHEN terms_clock IS NOT NULL
  THEN form || ' carries no amendment to this rate through ' || CAST(terms_clock AS VARCHAR) || '; '
  ELSE form || CASE WHEN period_end IS NOT NULL THEN ' for period ended ' || CAST(period_end AS VARCHAR)
    ELSE ' dated ' || CAST(as_of AS VARCHAR) END || ' (filed ' || CAST(filing_date AS VARCHAR) || ') is ' END
  || CAST(DATE '2000-12-31' - coalesce(terms_clock, as_of) AS VARCHAR)
  || 'd behind the 2000-12-31 anchor, beyond the 183d limit' AS detail
FROM resolved WHERE anchor = DATE '2000-12-31' AND reason = 'stale_beyond_limit'
""")
def stale_detail(spark, sf):
    return resolved(spark, sf).where("reason = 'stale_beyond_limit'").select(*KEYS, "detail")


@query("union_sources", """
SELECT source, entity, count(*) AS n, min(as_of) AS first_as_of, count(*) FILTER (n_flags = 0) AS unflagged FROM (
  SELECT 0 AS source, entity, coalesce(as_of, period_end, filing_date) AS as_of, f1::INT + f2::INT + f3::INT + f4::INT + f5::INT AS n_flags FROM v_candidates
  UNION ALL SELECT 1, CAST(entity AS VARCHAR), "end", 0 FROM v_facts) GROUP BY ALL
""")
def union_sources(spark, sf):
    from plumbline.schema import union_sources as union

    facts = v.facts(spark, sf).select(
        F.col("entity").cast("string").alias("entity"), F.col("tag").alias("metric"), F.col("val").alias("value"),
        F.lit("usd").alias("unit"), F.lit("xbrl").alias("tier"), "form", F.col("accn").alias("accession"),
        F.col("filed").alias("filing_date"), F.col("end").alias("period_end"), "ord")
    both = union(v.candidates(spark, sf), facts)
    return both.groupBy(F.shiftrightunsigned("ord", 56).cast("int").alias("source"), "entity").agg(
        F.count(F.lit(1)).alias("n"), F.min("as_of").alias("first_as_of"),
        F.count_if(F.size("flags") == 0).alias("unflagged"))


# A third of all rows under one key, and every 41st order without a number.
fragment("hot_v_candidates", """
SELECT * REPLACE (CASE WHEN CAST(accession AS BIGINT) % 3 = 0 THEN 'S1' ELSE entity END AS entity,
  CASE WHEN CAST(accession AS BIGINT) % 3 = 0 THEN 'm4' ELSE metric END AS metric,
  CASE WHEN CAST(accession AS BIGINT) % 3 = 0 THEN 4 ELSE mno END AS mno,
  CASE WHEN CAST(accession AS BIGINT) % 3 = 0 THEN 'ratio' ELSE unit END AS unit)
FROM v_candidates WHERE CAST(accession AS BIGINT) % 41 <> 0
""")


def hot_candidates(spark, sf):
    number = F.col("accession").cast("bigint")
    hot = number % 3 == 0
    pick = lambda name, value: F.when(hot, F.lit(value)).otherwise(F.col(name))
    value = F.when(number % 82 == 0, F.lit(float("nan"))).when(number % 41 != 0, F.col("value"))
    return v.candidates(spark, sf).withColumns({
        "entity": pick("entity", "S1"), "metric": pick("metric", "m4"), "unit": pick("unit", "ratio"), "value": value})


variant("hot_", "v_candidates", "resolved")
variant("hot_", "v_candidates", "conflict_mid")


@query("reconcile_hot_keys", """
SELECT entity, metric, round(value, 6) AS value, confidence, round(final_score, 6) AS score, reason,
  as_of, tier, accession, n_agree, n_disagree, n_clusters, n_bases, n_candidates, round(span / abs(CASE WHEN mid = 0 THEN 1.0 ELSE mid END) * 100, 5) AS spread_pct
FROM hot_resolved LEFT JOIN hot_conflict_mid USING (anchor, entity, metric) WHERE anchor = DATE '2000-12-31'
""")
def reconcile_hot_keys(spark, sf):
    cands = eligibility.eligible(hot_candidates(spark, sf), v.ref())
    out = rs.resolve(cands, v.entities(spark, sf), v.metrics(spark), v.ref())
    return out.select(
        "entity", "metric", six("value").alias("value"), "confidence", six("score").alias("score"),
        "reason", "as_of", "tier", "accession", "n_agree", "n_disagree", "n_clusters", "n_bases", "n_candidates",
        F.round("spread_pct", 5).alias("spread_pct"),
    )
