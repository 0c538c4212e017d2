"""Queries on whole runs: grid, cells, coverage, audit, peers, trend, diff."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import evidence as e, views as v
from catalog.registry import fragment, query
from catalog.timeseries import nation_entities, nation_facts
from plumbline.operators import groups
from plumbline.plans import benchmark, reports
from plumbline.session import durable, scratch_path
from plumbline.sources.structured import write_tables

six = lambda c: F.round(c, 6)
ANCHORS = (v.EARLIER, v.ANCHOR)
ZERO_RULE = ("m3", "m4")
CLASS_METRICS = ("m5", "m6", "m7")
COMPARE = {f"m{i}": "rate_basis" for i in range(0, 40, 2)}

fragment("late_keys", """
SELECT anchor, entity, metric, min(d) AS as_of FROM (SELECT a.anchor, c.entity, c.metric, coalesce(c.as_of, c.period_end) AS d
  FROM v_candidates c CROSS JOIN anchors a) GROUP BY ALL HAVING count(*) FILTER (coalesce(d <= anchor, false)) = 0
""")
fragment("run_rows", """
SELECT a.anchor, g.*, r.chosen_value, r.n_candidates, r.tier, r.accession, r.basis_key, r.rate_basis, r.share_class,
  CASE WHEN in_scope THEN r.value END AS value,
  CASE WHEN in_scope THEN coalesce(r.confidence, 'Suppressed') ELSE 'Suppressed' END AS confidence,
  CASE WHEN in_scope THEN coalesce(r.final_score, 0.0) ELSE 0.0 END AS score,
  CASE WHEN NOT in_scope THEN 'not_applicable' WHEN r.entity IS NULL THEN 'no_candidate' ELSE r.reason END AS reason,
  CASE WHEN NOT in_scope THEN NULL WHEN r.entity IS NULL THEN l.as_of ELSE r.as_of END AS as_of,
  r.all_disq, r.ord
FROM grid g CROSS JOIN anchors a LEFT JOIN resolved r ON r.anchor = a.anchor AND r.entity = g.entity AND r.metric = g.metric
LEFT JOIN late_keys l ON l.anchor = a.anchor AND l.entity = g.entity AND l.metric = g.metric
""")
fragment("run", """
SELECT * EXCLUDE (no_fee) REPLACE (
  CASE WHEN metric = 'm4' AND value IS NULL AND no_fee THEN 'not_applicable' ELSE reason END AS reason,
  CASE WHEN metric = 'm4' AND value IS NULL AND no_fee THEN 0.0 ELSE score END AS score,
  CASE WHEN metric = 'm4' AND value IS NULL AND no_fee THEN NULL ELSE as_of END AS as_of)
FROM (SELECT *, coalesce(bool_or(metric = 'm3' AND value = 0.0) OVER (PARTITION BY anchor, entity), false) AS no_fee FROM run_rows)
""")


def run(spark, sf):
    return benchmark.benchmark_run(v.candidates(spark, sf), v.entities(spark, sf), v.SPECS, ANCHORS, zero_rule=ZERO_RULE)


def latest(spark, sf):
    """The same plan for the one reporting anchor."""
    return benchmark.benchmark_run(
        v.candidates(spark, sf), v.entities(spark, sf), v.SPECS, (v.ANCHOR,), zero_rule=ZERO_RULE)


RUN_COLUMNS = ["entity", "metric", "in_scope", "confidence", "reason", "as_of"]


@query("reconcile_grid", """
SELECT entity, metric, in_scope, confidence, reason, as_of, round(value, 6) AS value, round(score, 6) AS score
FROM run WHERE anchor = DATE '2000-12-31'
""")
def reconcile_grid(spark, sf):
    return latest(spark, sf).select(*RUN_COLUMNS, six("value").alias("value"), six("score").alias("score"))


@query("benchmark_run", """
SELECT anchor, entity, metric, in_scope, confidence, reason, as_of, round(value, 6) AS value, round(score, 6) AS score FROM run
""")
def benchmark_run(spark, sf):
    return run(spark, sf).select("anchor", *RUN_COLUMNS, six("value").alias("value"), six("score").alias("score"))


fragment("cell_basis", """
SELECT *, CASE WHEN value IS NOT NULL THEN rate_basis || '; share class: ' || replace(share_class, '_', ' ') END AS basis_text FROM run
""")
fragment("basis_mode", """
SELECT anchor, metric, basis_text AS reference_basis FROM (SELECT anchor, metric, basis_text, row_number() OVER (
  PARTITION BY anchor, metric ORDER BY count(*) DESC, min(entity_ord)) AS k FROM cell_basis WHERE value IS NOT NULL
  GROUP BY anchor, metric, basis_text) WHERE k = 1
""")
fragment("cells", """
SELECT * EXCLUDE (value, reason, confidence, basis_text, wrong),
  CASE WHEN NOT wrong THEN value END AS value, CASE WHEN wrong THEN 'wrong_share_class' ELSE reason END AS reason,
  CASE WHEN NOT wrong AND value IS NOT NULL THEN confidence END AS confidence,
  CASE WHEN NOT wrong THEN basis_text END AS basis_text,
  NOT wrong AND value IS NOT NULL AND basis_text <> reference_basis AS divergent
FROM (SELECT *, value IS NOT NULL AND entity_type = 'interval_fund' AND metric IN ('m5', 'm6', 'm7')
    AND basis_text LIKE '%fund level%' AS wrong FROM cell_basis LEFT JOIN basis_mode USING (anchor, metric))
""")


CELL_COLUMNS = ["anchor", "entity", "entity_ord", "entity_type", "metric", "unit", "direction", "value", "chosen_value",
                "basis", "confidence", "reason", "detail"]


def cells(spark, sf, both=False):
    # Reports read a finished run several times, so what they read is written first.
    rows = durable((run(spark, sf) if both else latest(spark, sf)).select(*CELL_COLUMNS))
    return reports.cells(rows, ["anchor"], CLASS_METRICS)


@query("board_cells", """
SELECT entity, metric, round(value, 6) AS value, unit, basis_text, divergent, confidence, reason,
  CASE reason WHEN 'no_candidate' THEN 'no_value_found' WHEN 'stale_beyond_limit' THEN 'stale'
    WHEN 'below_confidence_floor' THEN 'low_evidence' WHEN 'basis_disqualified' THEN 'basis_not_measured' ELSE reason END AS reason_code
FROM cells WHERE anchor = DATE '2000-12-31'
""")
def board_cells(spark, sf):
    return cells(spark, sf).select("entity", "metric", six("value").alias("value"), "unit", "basis_text", "divergent",
                                   "confidence", "reason", "reason_code")


@query("board_grid", "SELECT entity, " + ", ".join(
    f"max(round(value, 6)) FILTER (metric = 'm{i}') AS m{i}" for i in range(40)
) + " FROM cells WHERE anchor = DATE '2000-12-31' GROUP BY entity")
def board_grid(spark, sf):
    wide = reports.board(cells(spark, sf), [s.key for s in v.SPECS])
    return wide.select("entity", *[six(s.key).alias(s.key) for s in v.SPECS])


fragment("cover_rows", """
SELECT anchor, entity, metric, CASE WHEN value IS NOT NULL THEN 'FILLED' ELSE reason END AS status,
  CASE WHEN value IS NOT NULL THEN '-' WHEN reason IN ('not_applicable', 'basis_disqualified', 'wrong_share_class') THEN 'STRUCTURAL'
    WHEN reason = 'stale_beyond_limit' THEN 'CADENCE' ELSE 'OURS' END AS owner,
  CASE WHEN value IS NOT NULL THEN rtrim(rtrim(printf('%.3f', value), '0'), '.') || ' ' || unit END AS detail,
  confidence, value
FROM cells
""")


@query("coverage", """
SELECT entity, metric, status, owner, detail, confidence FROM cover_rows WHERE anchor = DATE '2000-12-31'
""")
def coverage(spark, sf):
    return reports.coverage(cells(spark, sf)).select("entity", "metric", "status", "owner", "detail", "confidence")


@query("table_sinks", """
SELECT anchor, entity, metric, status, owner, detail, confidence FROM cover_rows
""")
def table_sinks(spark, sf):
    """The coverage of two anchors written as a partitioned table and read again."""
    path = scratch_path(spark, "sinks")
    rows = reports.coverage(cells(spark, sf, both=True), ["anchor"]).drop("value")
    write_tables({"coverage": rows}, path, ["anchor"])
    return spark.read.parquet(f"{path}/coverage").select("anchor", "entity", "metric", "status", "owner", "detail", "confidence")


@query("table_sinks_rerun", """
SELECT anchor, entity, metric, CASE WHEN anchor = DATE '2000-12-31' THEN lower(status) ELSE status END AS status, owner, confidence
FROM cover_rows
""")
def table_sinks_rerun(spark, sf):
    """Two anchors written, one of them written again with other rows: the other one stays."""
    path = scratch_path(spark, "sinks")
    rows = durable(reports.coverage(cells(spark, sf, both=True), ["anchor"]).select(
        "anchor", "entity", "metric", "status", "owner", "confidence"))
    write_tables({"coverage": rows}, path, ["anchor"])
    again = rows.where(F.col("anchor") == v.ref()).withColumn("status", F.lower("status"))
    write_tables({"coverage": again}, path, ["anchor"])
    return spark.read.parquet(f"{path}/coverage").select("anchor", "entity", "metric", "status", "owner", "confidence")


@query("coverage_rollup", """
SELECT bucket, confidence, count(*) AS cells FROM (SELECT *, CASE WHEN status = 'FILLED' THEN 'FILLED' ELSE owner END AS bucket
  FROM cover_rows WHERE anchor = DATE '2000-12-31') GROUP BY ROLLUP (bucket, confidence)
""")
def coverage_rollup(spark, sf):
    return reports.coverage_rollup(reports.coverage(cells(spark, sf)))


@query("sparse_entities", """
SELECT entity, count(value) AS n_populated, count(value) <= 12 AS demoted FROM cells WHERE anchor = DATE '2000-12-31' GROUP BY entity
""")
def sparse_entities(spark, sf):
    return reports.sparse_entities(cells(spark, sf), 12)


@query("audit", """
SELECT e.entity, e.metric, round(e.value, 6) AS value, e.tier, e.basis_key, e.accession,
  CASE WHEN e.ord = k.ord AND k.value IS NOT NULL THEN 'reported' WHEN e.ord = k.ord THEN 'resolved_then_suppressed'
    ELSE 'rejected' END AS outcome,
  CASE WHEN e.ord = k.ord THEN k.confidence END AS confidence, CASE WHEN e.ord = k.ord THEN round(k.score, 6) END AS score
FROM ev e JOIN (SELECT * REPLACE (CASE WHEN in_scope AND NOT all_disq AND reason IS DISTINCT FROM 'not_applicable' THEN ord END AS ord) FROM run) k
  USING (anchor, entity, metric) WHERE anchor = DATE '2000-12-31'
UNION ALL
SELECT entity, metric, NULL, NULL, NULL, NULL, 'no_candidate', confidence, score FROM run
WHERE anchor = DATE '2000-12-31' AND n_candidates IS NULL
""")
def audit(spark, sf):
    usable = e.eligible_candidates(spark, sf)
    rows = reports.audit(usable, latest(spark, sf).drop("anchor"))
    return rows.select("entity", "metric", six("value").alias("value"), "tier", "basis_key", "accession", "outcome",
                       "confidence", six("score").alias("score"))


@query("modal_first", """
SELECT metric, modal, n FROM (SELECT metric, rate_basis AS modal, count(*) AS n, row_number() OVER (PARTITION BY metric
  ORDER BY count(*) DESC, min(ord)) AS k FROM v_candidates GROUP BY metric, rate_basis) WHERE k = 1
""")
def modal_first(spark, sf):
    rows = v.candidates(spark, sf).withColumn("rate", F.col("basis")["rate_basis"])
    return groups.modal_first(rows, ["metric"], "rate", "ord")


@query("peer_stats", """
SELECT s_nationkey AS nation, count(*) AS n, min(s_acctbal) AS low, max(s_acctbal) AS high,
  round(median(s_acctbal), 4) AS median, round(max(s_acctbal) FILTER (s_suppkey = f) - median(s_acctbal), 4) AS house_delta
FROM supplier JOIN (SELECT s_nationkey, min(s_suppkey) AS f FROM supplier GROUP BY 1) USING (s_nationkey) GROUP BY 1
""")
def peer_stats(spark, sf):
    s = v.table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "nation")
    stats = groups.order_statistics(s, ["nation"], "s_acctbal")
    house = s.groupBy("nation").agg(F.min_by("s_acctbal", "s_suppkey").alias("house"))
    return stats.join(house, "nation").select(
        "nation", "n", "low", "high", F.round("median", 4).alias("median"),
        F.round(F.col("house") - F.col("median"), 4).alias("house_delta"))


@query("median_price", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(median(l_extendedprice), 4) AS median, min(l_extendedprice) AS low,
  max(l_extendedprice) AS high FROM lineitem GROUP BY ALL
""")
def median_price(spark, sf):
    """Order statistics of groups large enough to be cut into ranges."""
    li = v.table(spark, sf, "lineitem")
    out = groups.order_statistics(li, ["l_returnflag", "l_linestatus"], "l_extendedprice")
    return out.select("l_returnflag", "l_linestatus", "n", F.round("median", 4).alias("median"), "low", "high")


@query("directed_rank", """
SELECT nation, s_suppkey, direction, rank() OVER (PARTITION BY nation ORDER BY CASE WHEN direction > 0 THEN -bal ELSE bal END) AS position,
  CASE WHEN direction <> 0 THEN rank() OVER (PARTITION BY nation ORDER BY CASE WHEN direction > 0 THEN -bal ELSE bal END) END AS rank
FROM (SELECT s_nationkey % 5 AS nation, s_suppkey, round(s_acctbal, -3) AS bal, s_nationkey % 5 % 3 - 1 AS direction FROM supplier)
""")
def directed_rank(spark, sf):
    s = v.table(spark, sf, "supplier").select(
        (F.col("s_nationkey") % 5).alias("nation"), "s_suppkey", F.round("s_acctbal", -3).alias("bal"),
        (F.col("s_nationkey") % 5 % 3 - 1).alias("direction"))
    return reports.directed_rank(s, ["nation"], "bal").drop("bal")


fragment("compare_rows", """
SELECT c.*, k.reference_key, ckey = reference_key AS counted FROM (
  SELECT *, CASE WHEN mno % 2 = 0 THEN rate_basis ELSE '' END AS ckey FROM cells
  WHERE anchor = DATE '2000-12-31' AND value IS NOT NULL AND entity <> 'S0') c
JOIN (SELECT metric, ckey AS reference_key FROM (SELECT metric, CASE WHEN mno % 2 = 0 THEN rate_basis ELSE '' END AS ckey,
    row_number() OVER (PARTITION BY metric ORDER BY count(*) DESC, min(entity_ord)) AS k FROM cells
    WHERE anchor = DATE '2000-12-31' AND value IS NOT NULL AND entity <> 'S0' GROUP BY 1, 2) WHERE k = 1) k USING (metric)
""")


@query("peer_comparison", """
SELECT c.metric, max(reference_key) AS reference_key, max(direction) AS direction, count(*) FILTER (counted) AS n_peers,
  count(*) FILTER (NOT counted) AS n_excluded, round(median(value) FILTER (counted), 6) AS peer_median,
  round(min(value) FILTER (counted), 6) AS peer_low, round(max(value) FILTER (counted), 6) AS peer_high,
  round(max(house_value), 6) AS house_value,
  CASE WHEN c.metric <> 'm2' THEN round(max(house_value) - median(value) FILTER (counted), 6) END AS house_delta,
  CASE WHEN c.metric <> 'm2' AND max(house_value) IS NOT NULL AND max(direction) <> 0 THEN
    1 + count(*) FILTER (counted AND CASE WHEN direction > 0 THEN value > house_value ELSE value < house_value END) END AS house_rank,
  CASE WHEN c.metric <> 'm2' AND max(house_value) IS NOT NULL AND max(direction) <> 0 THEN 1 + count(*) FILTER (counted) END AS out_of
FROM compare_rows c LEFT JOIN (SELECT metric, chosen_value AS house_value FROM run
  WHERE entity = 'S0' AND anchor = DATE '2000-12-31') h USING (metric) GROUP BY c.metric
""")
def peer_comparison(spark, sf):
    shown = cells(spark, sf)
    # S0 plays the house: its chosen figures stand in for the own series.
    house = shown.where("entity = 'S0'").select("metric", F.col("chosen_value").alias("house_value"))
    out = reports.peer_comparison(shown.where("entity <> 'S0'"), house, COMPARE, withheld=["m2"])
    return out.select("metric", "reference_key", "direction", "n_peers", "n_excluded", "house_rank", "out_of",
                      *[six(c).alias(c) for c in ("peer_median", "peer_low", "peer_high", "house_value", "house_delta")])


@query("trend", """
SELECT entity, "end", round(nav, 4) AS nav_per_share, source FROM (
  SELECT entity, "end", CASE WHEN states THEN p ELSE e / s END AS nav, CASE WHEN states THEN form ELSE 'book value' END AS source
  FROM (SELECT entity, "end", max(val) FILTER (tag = '1-URGENT') AS p, max(form) FILTER (tag = '1-URGENT') AS form,
      max(val) FILTER (tag = '2-HIGH') AS e, max(val) FILTER (tag = '3-MEDIUM') AS s FROM (
    SELECT *, row_number() OVER (PARTITION BY entity, tag, "end" ORDER BY filed DESC, ord DESC) AS k
    FROM (SELECT * REPLACE (CASE WHEN tag = '1-URGENT' AND entity % 2 = 1 THEN 'unlisted' ELSE tag END AS tag) FROM nation_facts)
    WHERE "end" <= DATE '2000-12-31') WHERE k = 1 GROUP BY entity, "end")
  JOIN (SELECT c_nationkey AS entity, c_nationkey % 2 = 0 AS states FROM customer GROUP BY c_nationkey) USING (entity))
WHERE nav IS NOT NULL AND "end" >= DATE '1998-12-31'
  AND CASE entity % 3 WHEN 0 THEN month("end") IN (12, 6) ELSE month("end") IN (9, 3) END
""")
def trend(spark, sf):
    # Odd nations state their price under a tag nobody asks for, so they fall back to book value.
    facts = nation_facts(spark, sf).withColumn("tag", F.when(
        (F.col("tag") == "1-URGENT") & (F.col("entity") % 2 == 1), F.lit("unlisted")).otherwise(F.col("tag")))
    out = reports.price_trend(facts, nation_entities(spark, sf), v.ref(), "1-URGENT", "2-HIGH", "3-MEDIUM")
    return out.select("entity", "end", F.round("nav_per_share", 4).alias("nav_per_share"), "source")


@query("run_regression", """
SELECT entity, metric, kind, before, after, cause FROM (
  SELECT p.entity, p.metric, 'LOST' AS kind, p.detail AS before, c.status AS after, c.status AS cause
  FROM prev_cover p JOIN curr_cover c USING (entity, metric) WHERE p.status = 'FILLED' AND c.status <> 'FILLED'
  UNION ALL SELECT p.entity, p.metric, 'GAINED', p.status, c.detail, NULL
  FROM prev_cover p JOIN curr_cover c USING (entity, metric) WHERE p.status <> 'FILLED' AND c.status = 'FILLED'
  UNION ALL SELECT p.entity, p.metric, 'DEGRADED', p.confidence, c.confidence, NULL
  FROM prev_cover p JOIN curr_cover c USING (entity, metric) WHERE p.status = 'FILLED' AND c.status = 'FILLED'
    AND CASE c.confidence WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END < CASE p.confidence WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END
  UNION ALL SELECT p.entity, p.metric, 'CHANGED', rtrim(rtrim(printf('%.3f', p.value), '0'), '.'), rtrim(rtrim(printf('%.3f', c.value), '0'), '.'), NULL
  FROM prev_cover p JOIN curr_cover c USING (entity, metric) WHERE p.value <> 0 AND abs(c.value - p.value) / abs(p.value) > 0.25)
""")
def run_regression(spark, sf):
    rows = reports.coverage(cells(spark, sf, both=True), ["anchor"])
    previous = rows.where(F.col("anchor") == F.lit(v.EARLIER))
    current = rows.where(F.col("anchor") == F.lit(v.ANCHOR))
    return reports.run_changes(previous, current).drop("move")


fragment("prev_cover", "SELECT * FROM cover_rows WHERE anchor = DATE '2000-09-30'")
fragment("curr_cover", "SELECT * FROM cover_rows WHERE anchor = DATE '2000-12-31'")
