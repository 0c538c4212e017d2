"""Driver tables seen through the library's input layouts (FIXTURES.md 4).

Each view exists twice: as a DataFrame here and as a SQL fragment of the same
name, both by the same deterministic arithmetic.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.registry import fragment
from plumbline.metrics import MetricSpec, metric_frame

ANCHOR = date(2000, 12, 31)
EARLIER = date(2000, 9, 30)
UNITS = ("pct", "ratio", "usd")
TIERS = ("xbrl", "structured_xml", "derived", "html_table", "text_pattern", "narrative_llm", "narrative_llm")
FORMS = ("10-K", "10-Q", "N-CSR", "486BPOS")

SPECS = tuple(
    MetricSpec(
        f"m{i}", label=f"metric {i}", unit=UNITS[i % 3], direction=(i // 3) % 3 - 1,
        low=0.0 if i % 10 == 3 else 0.5, high=3.05,
        preferences=(("rate_basis", "N"), ("rate_basis", "A")) if i % 2 == 0 else (),
        custom=i >= 30, entity_types=("interval_fund",) if i >= 35 else (),
    )
    for i in range(40)
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ref():
    return F.lit(ANCHOR)


def metrics(spark: SparkSession) -> DataFrame:
    return metric_frame(spark, SPECS)


fragment("v_metrics", """
SELECT 'm' || CAST(i AS VARCHAR) AS metric, CAST(i AS INTEGER) AS mno,
  CASE i % 3 WHEN 0 THEN 'pct' WHEN 1 THEN 'ratio' ELSE 'usd' END AS unit,
  CAST((i // 3) % 3 - 1 AS INTEGER) AS direction,
  CASE WHEN i % 10 = 3 THEN 0.0 ELSE 0.5 END::DOUBLE AS low, 3.05::DOUBLE AS high,
  i >= 30 AS custom, i >= 35 AS interval_only
FROM range(40) t(i)
""")


def entities(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    kind = F.when(F.col("s_nationkey") % 3 == 0, "interval_fund").when(
        F.col("s_nationkey") % 3 == 1, "bdc").otherwise("mortgage_reit")
    fye = F.when(F.col("s_suppkey") % 3 == 0, "12-31").when(
        F.col("s_suppkey") % 3 == 1, "09-30").otherwise("03-31")
    listed = F.transform(
        F.sequence(F.lit(0), F.when(kind == "mortgage_reit", F.lit(24)).otherwise(F.lit(29))),
        lambda i: F.concat(F.lit("m"), i.cast("string")),
    )
    return s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("entity"),
        F.col("s_suppkey").alias("entity_ord"),
        kind.alias("entity_type"), fye.alias("fiscal_year_end"),
        F.when(kind == "interval_fund", F.lit("Class I")).otherwise(F.lit("")).alias("institutional_class"),
        listed.alias("supported_metrics"),
    )


fragment("v_entities", """
SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS entity, s_suppkey AS entity_ord,
  CASE s_nationkey % 3 WHEN 0 THEN 'interval_fund' WHEN 1 THEN 'bdc' ELSE 'mortgage_reit' END AS entity_type,
  CASE s_suppkey % 3 WHEN 0 THEN '12-31' WHEN 1 THEN '09-30' ELSE '03-31' END AS fiscal_year_end,
  CASE WHEN s_nationkey % 3 = 0 THEN 'Class I' ELSE '' END AS institutional_class,
  CASE WHEN s_nationkey % 3 = 2 THEN 24 ELSE 29 END AS last_listed
FROM supplier
""")


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    mno = (F.col("l_partkey") % 40).cast("int")
    base = F.date_sub(
        F.lit(date(2001, 1, 31)), ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 31) % 420).cast("int")
    )

    def nth(values, index):
        out = F.lit(values[-1])
        for i, v in reversed(list(enumerate(values[:-1]))):
            out = F.when(index == i, F.lit(v)).otherwise(out)
        return out

    flags = F.array_compact(F.array(
        F.when(F.col("l_tax") > 0.075, F.lit("superseded_rate")),
        F.when(F.col("l_discount") > 0.085, F.lit("ttm_window_incomplete")),
        F.when(F.col("l_partkey") % 17 == 0, F.lit("nav_history_gap_92d")),
        F.when(F.col("l_partkey") % 23 == 0, F.lit("odd_flag")),
        F.when((mno == 1) & (F.col("l_suppkey") % 10 == 0),
               F.lit("zero_borrowings_but_material_total_liabilities")),
    ))
    rows = li.withColumn("mno", mno).withColumn("base", base)
    ord_no = (
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10_000 + F.col("l_partkey") % 10_000) * 64
        + F.col("l_quantity").cast("bigint") % 64
    )
    return rows.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("entity"),
        F.concat(F.lit("m"), F.col("mno").cast("string")).alias("metric"),
        (F.col("l_quantity") % 4 + F.col("l_tax")).alias("value"),
        nth(UNITS, F.col("mno") % 3).alias("unit"),
        nth(TIERS, F.col("l_linenumber") - 1).alias("tier"),
        nth(FORMS, F.col("l_linenumber") % 4).alias("form"),
        F.col("l_orderkey").cast("string").alias("accession"),
        F.date_add("base", (F.col("l_orderkey") % 40 + 30).cast("int")).alias("filing_date"),
        F.when(F.col("l_linenumber") != 7, F.col("base")).alias("period_end"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("locator"),
        F.create_map(
            F.lit("rate_basis"), F.col("l_returnflag"),
            F.lit("share_class"), F.when(F.col("l_linestatus") == "O", F.lit("Class I")).otherwise(F.lit("fund_level")),
        ).alias("basis"),
        F.array("l_returnflag").alias("transforms"),
        flags.alias("flags"),
        F.when(F.col("l_orderkey") % 97 != 0, F.col("base")).alias("as_of"),
        F.when(F.col("mno") == 0, F.date_add("base", 120)).alias("terms_clock"),
        F.lit(None).cast("date").alias("effective_from"),
        F.when(F.col("l_partkey") % 11 == 0, F.date_add("base", 90)).alias("effective_until"),
        ord_no.alias("ord"),
    )


fragment("v_candidates", """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS entity, 'm' || CAST(l_partkey % 40 AS VARCHAR) AS metric,
  CAST(l_partkey % 40 AS INTEGER) AS mno, l_quantity % 4 + l_tax AS value,
  CASE (l_partkey % 40) % 3 WHEN 0 THEN 'pct' WHEN 1 THEN 'ratio' ELSE 'usd' END AS unit,
  CASE l_linenumber WHEN 1 THEN 'xbrl' WHEN 2 THEN 'structured_xml' WHEN 3 THEN 'derived'
    WHEN 4 THEN 'html_table' WHEN 5 THEN 'text_pattern' ELSE 'narrative_llm' END AS tier,
  CASE l_linenumber WHEN 1 THEN 0.95 WHEN 2 THEN 0.92 WHEN 3 THEN 0.75
    WHEN 4 THEN 0.72 WHEN 5 THEN 0.66 ELSE 0.55 END::DOUBLE AS tier_score,
  CASE l_linenumber % 4 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN 'N-CSR' ELSE '486BPOS' END AS form,
  CAST(l_orderkey AS VARCHAR) AS accession,
  base + CAST(l_orderkey % 40 + 30 AS INTEGER) AS filing_date,
  CASE WHEN l_linenumber <> 7 THEN base END AS period_end,
  'line ' || CAST(l_linenumber AS VARCHAR) AS locator,
  l_returnflag AS rate_basis, CASE WHEN l_linestatus = 'O' THEN 'Class I' ELSE 'fund_level' END AS share_class,
  l_returnflag AS transforms,
  l_tax > 0.075 AS f1, l_discount > 0.085 AS f2, l_partkey % 17 = 0 AS f3, l_partkey % 23 = 0 AS f4,
  (l_partkey % 40 = 1 AND l_suppkey % 10 = 0) AS f5,
  CASE WHEN l_orderkey % 97 <> 0 THEN base END AS as_of,
  CASE WHEN l_partkey % 40 = 0 THEN base + 120 END AS terms_clock,
  CASE WHEN l_partkey % 11 = 0 THEN base + 90 END AS effective_until,
  ((l_orderkey * 10 + l_linenumber) * 10000 + l_partkey % 10000) * 64 + CAST(l_quantity AS BIGINT) % 64 AS ord
FROM (SELECT *, DATE '2001-01-31' - CAST((l_orderkey * 7 + l_linenumber * 31) % 420 AS INTEGER) AS base FROM lineitem)
""")


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Instant facts: order priority as tag, order date as period end."""
    o = table(spark, sf, "orders")
    end = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").alias("entity"), F.lit("core").alias("taxonomy"),
        F.col("o_orderpriority").alias("tag"), F.lit("USD").alias("unit"),
        F.lit(None).cast("date").alias("start"), end.alias("end"),
        F.col("o_totalprice").alias("val"), F.col("o_orderkey").cast("string").alias("accn"),
        F.col("o_orderstatus").alias("form"),
        F.date_add(end, (F.col("o_orderkey") % 60).cast("int")).alias("filed"),
        F.col("o_orderkey").alias("ord"),
    )


fragment("v_facts", """
SELECT o_custkey AS entity, o_orderpriority AS tag, CAST(o_orderdate AS DATE) AS "end", o_totalprice AS val,
  CAST(o_orderkey AS VARCHAR) AS accn, o_orderstatus AS form,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS filed, o_orderkey AS ord
FROM orders
""")


def filings(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    report = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_custkey").alias("entity"), F.col("o_orderpriority").alias("form"),
        F.col("o_orderkey").alias("accession"), report.alias("report_date"),
        F.date_add(report, (F.col("o_orderkey") % 60 + 30).cast("int")).alias("filing_date"),
    )


fragment("v_filings", """
SELECT o_custkey AS entity, o_orderpriority AS form, o_orderkey AS accession,
  CAST(o_orderdate AS DATE) AS report_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 + 30 AS INTEGER) AS filing_date
FROM orders
""")


def _orders_with_customer(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("d", F.col("o_orderdate").cast("date"))


def nav(spark: SparkSession, sf: str) -> DataFrame:
    """nation x month: mean order price as a price per share."""
    cents = F.col("o_totalprice").cast("decimal(18,2)")
    rows = _orders_with_customer(spark, sf).groupBy(
        F.col("c_nationkey").alias("entity"), F.last_day("d").alias("end")
    ).agg(F.sum(cents).alias("s"), F.count(F.lit(1)).alias("n"))
    return rows.select("entity", "end", (F.col("s").cast("double") / F.col("n") / 1000).alias("nav"))


fragment("v_nav", """
SELECT c_nationkey AS entity, last_day(CAST(o_orderdate AS DATE)) AS "end",
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 1000 AS nav
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")


def returns(spark: SparkSession, sf: str) -> DataFrame:
    """nation (group) x market segment x month return in percent, within +-2.

    Nations 0 to 19 are pooled into five, which fills their months.
    """
    pooled = F.when(F.col("c_nationkey") < 20, F.col("c_nationkey") % 5).otherwise(F.col("c_nationkey"))
    return _orders_with_customer(spark, sf).groupBy(
        pooled.alias("entity"), F.col("c_mktsegment").alias("share_class"),
        F.last_day("d").alias("month_end"),
    ).agg((((F.sum("o_orderkey") % 401) - 200) / 100).alias("ret"))


fragment("v_returns", """
SELECT CASE WHEN c_nationkey < 20 THEN c_nationkey % 5 ELSE c_nationkey END AS entity, c_mktsegment AS share_class, last_day(CAST(o_orderdate AS DATE)) AS month_end,
  CAST(sum(o_orderkey) % 401 - 200 AS DOUBLE) / 100 AS ret
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3
""")


def quarters(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return _orders_with_customer(spark, sf).groupBy(
        F.col("c_nationkey").alias("entity"), F.year("d").alias("y"), F.quarter("d").alias("q")
    ).agg(F.sum(amount).alias("amount"))


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Q1, first half, Q3 and full year totals; Q2 and Q4 are never stated."""
    per_year = quarters(spark, sf).groupBy("entity", "y").agg(
        *[F.coalesce(F.sum(F.when(F.col("q") == k, F.col("amount"))), F.lit(0)).cast("decimal(18,2)").alias(f"q{k}")
          for k in range(1, 5)]
    )

    def iv(m1, m2, d2, total):
        return F.struct(
            F.make_date("y", F.lit(m1), F.lit(1)).alias("start"), F.make_date("y", F.lit(m2), F.lit(d2)).alias("end"),
            total.cast("decimal(18,2)").alias("value"),
        )

    q1, q2, q3, q4 = (F.col(f"q{k}") for k in range(1, 5))
    rows = F.array(iv(1, 3, 31, q1), iv(1, 6, 30, q1 + q2), iv(7, 9, 30, q3), iv(1, 12, 31, q1 + q2 + q3 + q4))
    return per_year.select("entity", F.posexplode(rows).alias("ord", "iv")).select(
        "entity", "iv.start", "iv.end", "iv.value", F.lit("tagged").alias("source"), F.col("ord").cast("bigint").alias("ord")
    )


fragment("v_quarters", """
SELECT c_nationkey AS entity, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
""")
fragment("v_years", """
SELECT entity, y, coalesce(sum(amount) FILTER (q = 1), 0) AS q1, coalesce(sum(amount) FILTER (q = 2), 0) AS q2,
  coalesce(sum(amount) FILTER (q = 3), 0) AS q3, coalesce(sum(amount) FILTER (q = 4), 0) AS q4
FROM v_quarters GROUP BY ALL
""")
fragment("v_intervals", """
SELECT entity, make_date(y, 1, 1) AS start, make_date(y, 3, 31) AS "end", q1 AS value FROM v_years
UNION ALL SELECT entity, make_date(y, 1, 1), make_date(y, 6, 30), q1 + q2 FROM v_years
UNION ALL SELECT entity, make_date(y, 7, 1), make_date(y, 9, 30), q3 FROM v_years
UNION ALL SELECT entity, make_date(y, 1, 1), make_date(y, 12, 31), q1 + q2 + q3 + q4 FROM v_years
""")


def notices(spark: SparkSession, sf: str) -> DataFrame:
    """Error events as absence notices for a user."""
    e = table(spark, sf, "events").where(F.col("event_type") == "error")
    k = F.get_json_object("props", "$.k").cast("int")
    reason = F.when(k % 3 == 0, "insufficient_history").when(k % 3 == 1, "window_mismatch").otherwise(
        "class_attribution_failed")
    return e.select(
        F.col("user_id").alias("entity"), reason.alias("reason"),
        F.concat(F.lit("k="), k.cast("string")).alias("detail"), F.col("event_id").alias("ord"),
    )


fragment("v_notices", """
SELECT user_id AS entity,
  CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'insufficient_history'
    WHEN 1 THEN 'window_mismatch' ELSE 'class_attribution_failed' END AS reason,
  'k=' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS detail, event_id AS ord
FROM events WHERE event_type = 'error'
""")
