"""Queries on sources: nested facts, reports, tagged and plain text, tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog import views as v
from catalog.evidence import customer_entities
from catalog.registry import fragment, query
from catalog.timeseries import nation_facts, per_share
from plumbline import rules
from plumbline.functions import dates, text as tx
from plumbline.metrics import MetricSpec
from plumbline.plans import candidates as pc, reports
from plumbline.session import dealt
from plumbline.sources import html_tables as ht, prose, structured as st

six = lambda c: F.round(c, 6)


def orders(spark, sf):
    return v.table(spark, sf, "orders")


def filed_orders(spark, sf):
    """Orders that pages and texts are made of, dealt while rows are narrow."""
    return dealt(orders(spark, sf), "o_orderkey")


def join_text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# --------------------------------------------------------------------- sources

@query("fact_flatten", """
SELECT entity, 'core' AS taxonomy, tag, u AS unit, CASE u WHEN 'USD' THEN val ELSE val / 2 END AS val, "end", accn, filed
FROM v_facts, (VALUES ('USD'), ('EUR')) t(u) WHERE u = 'USD' OR ord % 3 = 0
""")
def fact_flatten(spark, sf):
    """Facts nested as taxonomy -> tag -> unit -> rows JSON, one per order, flattened back."""
    f = v.facts(spark, sf)
    one = lambda val: F.array(F.struct(
        val.alias("val"), F.col("end").cast("string").alias("end"), F.col("accn"), F.col("form"),
        F.col("filed").cast("string").alias("filed")))
    units = F.when(F.col("ord") % 3 == 0, F.create_map(F.lit("USD"), one(F.col("val")), F.lit("EUR"), one(F.col("val") / 2))
                   ).otherwise(F.create_map(F.lit("USD"), one(F.col("val"))))
    nested = F.to_json(F.struct(F.create_map("taxonomy", F.create_map("tag", F.struct(units.alias("units")))).alias("facts")))
    parsed = f.select("entity", F.from_json(nested, f"facts {st.FACTS}").alias("j")).select("entity", "j.facts")
    return st.flatten_facts(parsed, ["entity"]).select("entity", "taxonomy", "tag", "unit", "val", "end", "accn", "filed")


@query("index_zip", """
SELECT entity, form, accession, filing_date, position FROM (
  SELECT entity, CASE i WHEN 1 THEN 'other' ELSE form END AS form, CAST(accession AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS accession,
    CASE WHEN i = 2 AND accession % 4 = 0 THEN NULL ELSE filing_date - CAST(i * 100 AS INTEGER) END AS filing_date, CAST(i AS INTEGER) AS position
  FROM v_filings, (VALUES (0), (1), (2)) t(i)) WHERE form IN ('1-URGENT', '2-HIGH') AND (filing_date IS NULL OR filing_date >= DATE '1997-01-01')
""")
def index_zip(spark, sf):
    f = v.filings(spark, sf)
    day = lambda i: F.date_sub("filing_date", i * 100).cast("string")
    packed = f.select(
        "entity", F.array(F.col("form"), F.lit("other"), F.col("form")).alias("form"),
        F.array(*[join_text(F.col("accession"), f"-{i}") for i in range(3)]).alias("accession"),
        F.array(day(0), day(1), F.when(F.col("accession") % 4 == 0, F.lit("")).otherwise(day(2))).alias("filing_date"))
    return st.zip_index(packed, ["entity"], ["form", "accession", "filing_date"], ["1-urgent", "2-high"], date(1997, 1, 1)
                        ).select("entity", "form", "accession", "filing_date", "position")


def xml_docs(spark, sf):
    """An XML report per order: some borrowing fields absent, some zero."""
    o = filed_orders(spark, sf).withColumn("d", F.last_day(F.col("o_orderdate").cast("date")))
    k = F.col("o_orderkey")
    borrow = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("<amtPayOneYrBanksBorr>0.00</amtPayOneYrBanksBorr>")).otherwise(
        join_text("<amtPayOneYrBanksBorr>", k % 1000, "</amtPayOneYrBanksBorr><amtPayAftOneYrOther>", k % 77, "</amtPayAftOneYrOther>"))
    rtn = join_text('<monthlyTotReturn rtn1="0.', k % 9, '" rtn2="N/A" rtn3="-0.', k % 8, '"/>')
    second = F.when(k % 5 == 0, F.lit('<monthlyTotReturn rtn1="1.5" rtn2="1.25" rtn3="1.0"/>')).otherwise(F.lit(""))
    xml = join_text(
        "<submission><formData><genInfo><regName> Fund ", F.col("o_custkey"), " </regName><seriesName>s</seriesName><repPdEnd>",
        F.col("d"), "</repPdEnd><repPdDate>", F.col("d"), "</repPdDate></genInfo><fundInfo><totAssets>", k + 500, "</totAssets><totLiabs>",
        k % 300, "</totLiabs><netAssets>", k % 1500 + 1, "</netAssets>", borrow, "<returnInfo><monthlyTotReturns>", rtn, second,
        "</monthlyTotReturns></returnInfo></fundInfo><invstOrSecs><invstOrSec><name>x</name></invstOrSec></invstOrSecs></formData></submission>")
    return o.select("o_orderkey", F.col("o_custkey").alias("entity"), F.lit("NPORT-P").alias("form"), F.col("d").alias("report_date"), xml.alias("xml"))


@query("xml_report_scan", """
SELECT o_orderkey, 'Fund ' || CAST(o_custkey AS VARCHAR) AS reg_name, last_day(CAST(o_orderdate AS DATE)) AS period_end,
  CAST(o_orderkey % 300 AS DOUBLE) AS total_liabilities, CAST(o_orderkey % 1500 + 1 AS DOUBLE) AS net_assets,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 0.0 ELSE CAST(o_orderkey % 1000 + o_orderkey % 77 AS DOUBLE) END AS borrowings,
  CASE WHEN o_orderkey % 4 < 2 THEN 0 ELSE CAST(o_orderkey % 1000 > 0 AS INTEGER) + CAST(o_orderkey % 77 > 0 AS INTEGER) END AS n_parts,
  CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 1 END AS n_return_rows
FROM orders
""")
def xml_report_scan(spark, sf):
    return st.parse_reports(xml_docs(spark, sf), "xml", ["o_orderkey"]).select(
        "o_orderkey", "reg_name", "period_end", "total_liabilities", "net_assets", "borrowings",
        F.size("borrowing_breakdown").alias("n_parts"), F.size("return_rows").alias("n_return_rows"))


@query("report_returns", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'pos' || CAST(pos AS VARCHAR) END AS share_class,
  CASE i WHEN 2 THEN d ELSE last_day(CAST(d - INTERVAL (2 - i) MONTH AS DATE)) END AS month_end,
  CASE WHEN pos = 1 THEN 1.5 - i * 0.25 WHEN i = 0 THEN CAST('0.' || CAST(o_orderkey % 9 AS VARCHAR) AS DOUBLE)
    ELSE CAST('-0.' || CAST(o_orderkey % 8 AS VARCHAR) AS DOUBLE) END AS ret
FROM (SELECT *, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders), (VALUES (0), (1)) p(pos), (VALUES (0), (1), (2)) t(i)
WHERE (pos = 0 AND i <> 1) OR (pos = 1 AND o_orderkey % 5 = 0)
""")
def report_returns(spark, sf):
    reports_df = st.parse_reports(xml_docs(spark, sf), "xml", ["o_orderkey"])
    return st.report_returns(reports_df, ["o_orderkey"]).select("o_orderkey", "share_class", "month_end", "ret")


@query("zero_anomaly", """
SELECT o_orderkey, metric, round(value, 6) AS value, flags FROM (
  SELECT o_orderkey, 'leverage_regulatory_dte' AS metric, CASE o_orderkey % 4 WHEN 1 THEN 0.0 ELSE CAST(o_orderkey % 1000 + o_orderkey % 77 AS DOUBLE) END / (o_orderkey % 1500 + 1) AS value,
    CASE WHEN (o_orderkey % 4 = 1 OR o_orderkey % 77000 = 0) AND CAST(o_orderkey % 300 AS DOUBLE) / (o_orderkey % 1500 + 1) > 0.10
      THEN 'zero_borrowings_but_material_total_liabilities' ELSE '' END AS flags FROM orders WHERE o_orderkey % 4 <> 0
  UNION ALL SELECT o_orderkey, 'leverage_economic_dte', CAST(o_orderkey % 300 AS DOUBLE) / (o_orderkey % 1500 + 1), 'includes_unsettled_trades_and_payables' FROM orders)
""")
def zero_anomaly(spark, sf):
    rows = st.report_leverage(st.parse_reports(xml_docs(spark, sf), "xml", ["o_orderkey"]))
    return rows.select("o_orderkey", "metric", six("value").alias("value"), F.array_join("flags", ";").alias("flags"))


@query("inline_fact_scan", """
SELECT o_orderkey, tag, CAST(o_orderdate AS DATE) AS "end",
  CASE tag WHEN 'a:Debt' THEN CAST(o_orderkey % 5000 + 1 AS DOUBLE) * 1000 ELSE -CAST(o_custkey AS DOUBLE) / 4 END AS val
FROM orders, (VALUES ('a:Debt'), ('b:Other')) t(tag)
""")
def inline_fact_scan(spark, sf):
    o = filed_orders(spark, sf)
    d = F.col("o_orderdate").cast("date")
    ctx = lambda cid, day, seg: join_text(
        f'<xbrli:context id="{cid}"><xbrli:entity>', seg, "</xbrli:entity><xbrli:period><xbrli:instant>", day,
        "</xbrli:instant></xbrli:period></xbrli:context>")
    page = join_text(
        "<html>", ctx("c1", d, ""), ctx("c2", d, "<xbrli:segment>m</xbrli:segment>"),
        '<p><ix:nonFraction contextRef="c1" name="a:Debt" scale="3">', F.format_number(F.col("o_orderkey") % 5000 + 1, 0), "</ix:nonFraction>",
        '<ix:nonFraction contextRef="c2" name="a:Debt" scale="3">9</ix:nonFraction>',
        '<ix:nonFraction contextRef="c9" name="a:Debt" scale="3">9</ix:nonFraction>',
        '<ix:nonFraction contextRef="c1" name="b:Other" sign="-"><b>', F.format_string("%.2f", F.col("o_custkey") / 4), "</b></ix:nonFraction></p></html>")
    return st.inline_facts(o.select("o_orderkey", page.alias("html")), ["o_orderkey"], "html").select("o_orderkey", "tag", "end", "val")


@query("quarter_series", """
SELECT o_orderkey, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS quarter,
  last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS period_end
FROM orders WHERE last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) <= DATE '2000-12-31'
""")
def quarter_series(spark, sf):
    o = orders(spark, sf)
    label = join_text("Q", F.quarter("o_orderdate"), " ", F.year("o_orderdate"))
    return st.own_series(o.select("o_orderkey", label.alias("quarter")), v.ref())


@query("null_aware_sum", """
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_tax > 0.05 AND l_discount > 0.05 THEN NULL ELSE CASE WHEN l_tax <= 0.05 THEN l_tax ELSE 0 END + CASE WHEN l_discount <= 0.05 THEN l_discount ELSE 0 END END AS total,
  CAST(l_tax <= 0.05 AND l_tax <> 0 AS INTEGER) + CAST(l_discount <= 0.05 AND l_discount <> 0 AS INTEGER) AS n_parts
FROM lineitem
""")
def null_aware_sum(spark, sf):
    li = v.table(spark, sf, "lineitem")
    a = F.when(F.col("l_tax") <= 0.05, F.col("l_tax"))
    b = F.when(F.col("l_discount") <= 0.05, F.col("l_discount"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", st.null_aware_sum(a, b).alias("total"),
                     F.size(st.nonzero_parts({"tax": a, "discount": b})).alias("n_parts"))


@query("context_flags", """
SELECT ord, concat_ws(';', CASE WHEN form <> 'F' THEN 'fee_table_from_' || form || '_not_fund_prospectus' END,
  CASE WHEN val / 400000 < 0.25 THEN 'implausibly_low_for_entity_type' END) AS flags FROM v_facts
""")
def context_flags(spark, sf):
    f = v.facts(spark, sf)
    form = F.when(F.col("form") == "F", F.lit("497")).otherwise(F.col("form"))
    return f.select("ord", F.array_join(st.context_flags(form, F.col("val") / 400000), ";").alias("flags"))


FORM_OF = {"1-URGENT": "10-K", "2-HIGH": "10-Q", "3-MEDIUM": "N-CSR", "4-NOT SPECIFIED": "NPORT-P", "5-LOW": "8-K"}


@query("classify_entities", """
SELECT entity, kind AS entity_type, coalesce(strftime(annual, '%m-%d'), '12-31') AS fiscal_year_end,
  kind <> '' AND NOT (kind = 'bdc' AND sic = '7000') AS confident
FROM (SELECT *, CASE WHEN iv AND NOT op THEN 'interval_fund' WHEN op AND sic = '6798' THEN 'mortgage_reit'
    WHEN op AND NOT iv THEN 'bdc' ELSE '' END AS kind
  FROM (SELECT c.entity, CASE c_custkey % 3 WHEN 0 THEN '6798' WHEN 1 THEN '6726' ELSE '7000' END AS sic,
      coalesce(iv, false) AS iv, coalesce(op, false) AS op, annual
    FROM (SELECT c_custkey, c_custkey * 4 + part AS entity FROM customer, (VALUES (0), (1), (2), (3)) t(part)) c
    LEFT JOIN (SELECT entity * 4 + accession % 4 AS entity, bool_or(form IN ('3-MEDIUM', '4-NOT SPECIFIED')) AS iv, bool_or(form IN ('1-URGENT', '2-HIGH')) AS op,
        max(report_date) FILTER (form IN ('1-URGENT', '3-MEDIUM')) AS annual FROM v_filings GROUP BY ALL) f ON f.entity = c.entity))
""")
def classify_entities(spark, sf):
    # Four entities per customer, each with a quarter of its filings.
    f = v.filings(spark, sf).withColumn("entity", F.col("entity") * 4 + F.col("accession") % 4)
    mapped = f.withColumn("form", F.element_at(F.create_map(*[F.lit(x) for kv in FORM_OF.items() for x in kv]), F.col("form")))
    k = F.col("c_custkey") % 3
    reg = v.table(spark, sf, "customer").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(3)))).select(
        (F.col("c_custkey") * 4 + F.col("part")).alias("entity"), F.when(k == 0, "6798").when(k == 1, "6726").otherwise("7000").alias("sic"),
        F.lit("1231").alias("registered_fye"))
    return st.classify_entities(mapped, reg).drop("reasons")


def fiscal_customers(spark, sf):
    c = v.table(spark, sf, "customer")
    k = F.col("c_custkey") % 3
    fye = F.when(k == 0, "12-31").when(k == 1, "09-30").otherwise("03-31")
    return c.select(F.col("c_custkey").alias("entity"), fye.alias("fiscal_year_end"))


NEXT_SQL = """CASE {k} % 3 WHEN 0 THEN CASE WHEN {d} < make_date(year({d}), 6, 30) THEN make_date(year({d}), 6, 30) WHEN {d} < make_date(year({d}), 12, 31)
    THEN make_date(year({d}), 12, 31) ELSE make_date(year({d}) + 1, 6, 30) END
  ELSE CASE WHEN {d} < make_date(year({d}), 3, 31) THEN make_date(year({d}), 3, 31) WHEN {d} < make_date(year({d}), 9, 30)
    THEN make_date(year({d}), 9, 30) ELSE make_date(year({d}) + 1, 3, 31) END END"""


@query("next_period_end", f"""
SELECT o_orderkey, {NEXT_SQL.format(k='o_custkey', d='CAST(o_orderdate AS DATE)')} AS next_end FROM orders
""")
def next_period_end(spark, sf):
    k = F.col("o_custkey") % 3
    fye = F.when(k == 0, "12-31").when(k == 1, "09-30").otherwise("03-31")
    return orders(spark, sf).select("o_orderkey", dates.next_period_end(fye, F.col("o_orderdate").cast("date")).alias("next_end"))


fragment("windows_due", """
SELECT entity, pe AS period_end, pe + lo AS earliest, pe + hi AS latest, n AS n_observations,
  CASE WHEN strftime(pe + lo, '%b %Y') = strftime(pe + hi, '%b %Y') THEN 'expected ' || strftime(pe + lo, '%b %Y')
    ELSE 'expected ' || strftime(pe + lo, '%b') || '-' || strftime(pe + hi, '%b %Y') END AS "window"
FROM (SELECT entity, CAST(min(filing_date - report_date) AS INTEGER) AS lo, CAST(max(filing_date - report_date) AS INTEGER) AS hi, count(*) AS n,
    CASE WHEN entity % 3 = 0 THEN DATE '2001-06-30' ELSE DATE '2001-03-31' END AS pe
  FROM v_filings WHERE report_date <= DATE '2000-12-31' GROUP BY entity)
""")


@query("filing_window", """SELECT entity, period_end, earliest, latest, n_observations, "window" FROM windows_due""")
def filing_window(spark, sf):
    return st.filing_windows(v.filings(spark, sf), fiscal_customers(spark, sf), v.ref())


@query("pending_promotion", """
SELECT c.entity, CASE WHEN c.entity % 2 = 0 AND entity_type = 'interval_fund' AND w.entity IS NOT NULL THEN 'not_yet_filed'
    WHEN c.entity % 2 = 0 THEN 'no_value_found' ELSE 'stale' END AS reason_code,
  CASE WHEN c.entity % 2 = 0 AND entity_type = 'interval_fund' AND w.entity IS NOT NULL THEN "window" ELSE 'none' END AS detail
FROM customer_entities c LEFT JOIN windows_due w ON w.entity = c.entity
""")
def pending_promotion(spark, sf):
    blank = customer_entities(spark, sf).withColumns({
        "reason_code": F.when(F.col("entity") % 2 == 0, F.lit("no_value_found")).otherwise(F.lit("stale")), "detail": F.lit("none")})
    due = st.filing_windows(v.filings(spark, sf), fiscal_customers(spark, sf), v.ref())
    return reports.promote_pending(blank, due).drop("entity_type")


# --------------------------------------------------------------------- scalars

@query("coverage_label", """
SELECT o_orderkey, CASE WHEN n / 365.25 >= 1.0 THEN printf('%.1f', n / 365.25) || 'y'
    ELSE CAST(CAST(round_even(n / 30.44, 0) AS INTEGER) AS VARCHAR) || 'mo' END || ' available (' || CAST(s AS VARCHAR) || ' to 2000-12-31)' AS label
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, DATE '2000-12-31' - CAST(o_orderdate AS DATE) AS n FROM orders WHERE o_orderdate <= DATE '2000-12-31')
""")
def coverage_label(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return orders(spark, sf).where(day <= v.ref()).select("o_orderkey", tx.coverage_label(day, v.ref()).alias("label"))


@query("annualize", """
SELECT o_orderkey, round((pow(1 + (o_orderkey % 401 - 200) / 1000.0, 365.25 / (o_custkey % 700 + 30)) - 1) * 100, 4) AS annualized,
  o_totalprice * 365.25 / (o_custkey % 30 + 80) AS run_rate FROM orders
""")
def annualize(spark, sf):
    growth = 1 + (F.col("o_orderkey") % 401 - 200) / 1000.0
    return orders(spark, sf).select(
        "o_orderkey", F.round(dates.annualize(growth, F.col("o_custkey") % 700 + 30) * 100, 4).alias("annualized"),
        (F.col("o_totalprice") * rules.YEAR_DAYS / (F.col("o_custkey") % 30 + 80)).alias("run_rate"))


@query("normalize_label", """
SELECT p_partkey, lower(regexp_replace(p_name || ' ' || p_type, '\\s+', '', 'g')) AS label FROM part
""")
def normalize_label(spark, sf):
    p = v.table(spark, sf, "part")
    return p.select("p_partkey", tx.normalize_label(F.concat_ws(" ", "p_name", "p_type")).alias("label"))


@query("citation_text", """
SELECT ord, lpad(CAST(entity AS VARCHAR), 10, '0') || ' | ' || form || ' | period ended ' || CAST("end" AS VARCHAR) || ' | acc. 00-' || accn
    || ' | XBRL core:' || tag || ' [USD] @ ' || CAST("end" AS VARCHAR) || ' (note)' AS citation,
  'https://archive/' || CAST(entity AS VARCHAR) || '/00' || accn || '/00-' || accn || '-index.htm' AS url
FROM v_facts
""")
def citation_text(spark, sf):
    f = v.facts(spark, sf)
    accession = F.concat(F.lit("00-"), F.col("accn"))
    locator = tx.fact_locator(F.concat("taxonomy", F.lit(":"), "tag"), F.col("unit"), F.col("start"), F.col("end"), F.lit("note"))
    return f.select("ord", tx.citation(tx.padded_id(F.col("entity")), F.col("form"), F.col("end"), accession, locator).alias("citation"),
                    tx.filing_url("https://archive", F.col("entity"), accession).alias("url"))


@query("format_value", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 3 WHEN 0 THEN printf('%.2f', l_quantity / 4) || '%'
  WHEN 1 THEN printf('%.2f', l_quantity / 4) || 'x' ELSE '$' || format('{:,.2f}', l_quantity * 100) END AS label FROM lineitem
""")
def format_value(spark, sf):
    k = F.col("l_linenumber") % 3
    unit = F.when(k == 0, "pct").when(k == 1, "ratio").otherwise("usd")
    value = F.when(k == 2, F.col("l_quantity") * 100).otherwise(F.col("l_quantity") / 4)
    return v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", tx.format_value(value, unit).alias("label"))


@query("numeric_tokens", """
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(replace(replace(text, '$', ' '), '%', ' '), '\\(?[0-9][0-9,]*\\.[0-9]+\\)?'),
  lambda t: CAST(CAST(round(CAST(replace(replace(replace(t, '(', ''), ')', ''), ',', '') AS DOUBLE) * 100, 0) * CASE WHEN t LIKE '(%' THEN -1 ELSE 1 END AS BIGINT) AS VARCHAR)), ' ') AS tokens
FROM documents
""")
def numeric_tokens(spark, sf):
    d = v.table(spark, sf, "documents")
    tokens = F.transform(tx.numeric_tokens(F.array("text")), lambda x: F.round(x * 100, 0).cast("bigint").cast("string"))
    return d.select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@query("header_years", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || ',' || CAST(year(o_orderdate) - 1 AS VARCHAR) AS years FROM orders
""")
def header_years(spark, sf):
    o = orders(spark, sf)
    y = F.year("o_orderdate")
    row = F.array(F.col("o_orderpriority"), join_text("For the Period January 1, ", y - 3, " through March 31, ", y, "*"), join_text(y - 1))
    return o.select("o_orderkey", F.array_join(tx.header_years(row), ",").alias("years"))


@query("percent_token", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN l_quantity / 4 END AS value FROM lineitem
""")
def percent_token(spark, sf):
    cell = F.when(F.col("l_linenumber") % 2 == 0, join_text("about ", F.format_string("%.2f", F.col("l_quantity") / 4), " % net")).otherwise(F.lit("n/a 12"))
    return v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", tx.percent_token(cell).alias("value"))


# ------------------------------------------------------------------ corpus text

# Quotes of every length: the passages whole, and their first one, two and three words.
fragment("quotes_asked", """
SELECT item_id * 10 + k AS item_id, CASE k WHEN 0 THEN text ELSE array_to_string(string_split(text, ' ')[1:k], ' ') END AS text
FROM benchmark, (VALUES (0), (1), (2), (3)) t(k)
""")


def quotes_asked(spark, sf):
    words = F.split("text", " ")
    return v.table(spark, sf, "benchmark").select("item_id", "text", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k")).select(
        (F.col("item_id") * 10 + F.col("k")).alias("item_id"),
        F.when(F.col("k") == 0, F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("k"), F.lit(1))), " ")).alias("text"))


@query("quote_verify", """
SELECT d.doc_id, b.item_id FROM
  (SELECT doc_id, lower(trim(regexp_replace(replace(replace(replace(replace(replace(text, '’', ''''), '“', '"'), '”', '"'), '–', '-'), '—', '-'), '[\\s ]+', ' ', 'g'))) AS t FROM documents) d,
  (SELECT item_id, lower(trim(regexp_replace(replace(replace(replace(replace(replace(text, '’', ''''), '“', '"'), '”', '"'), '–', '-'), '—', '-'), '[\\s ]+', ' ', 'g'))) AS q FROM quotes_asked) b
WHERE contains(d.t, b.q)
""")
def quote_verify(spark, sf):
    return prose.locate_quotes(quotes_asked(spark, sf), v.table(spark, sf, "documents"), "item_id", "doc_id")


@query("phrase_structure", """
SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)released under') AND regexp_matches(text, '(?i)token =') THEN 'both'
  WHEN regexp_matches(text, '(?i)released under') THEN 'released under' WHEN regexp_matches(text, '(?i)token =') THEN 'token =' ELSE '' END AS structure
FROM documents
""")
def phrase_structure(spark, sf):
    d = v.table(spark, sf, "documents")
    return d.select("doc_id", prose.tier_structure(F.col("text"), r"(?i)(released under|token =)", "both").alias("structure"))


DECLARED = (
    MetricSpec("secret_digits", unit="count", low=0, high=500, near=("token =",), take="first_number", within=60),
    MetricSpec("mail_host", unit="count", low=0, high=8, near=("mail",), take="first_number", within=10),
    MetricSpec("mail_domain", unit="count", anchors=("example", "token"), patterns=(r"@mail([0-9]+)\.example",)),
)
fragment("squashed", """
SELECT doc_id, regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g') AS t FROM documents
""")


@query("declared_extract", """
SELECT doc_id, metric, value, CASE WHEN metric = 'secret_digits' AND value > 500 OR metric = 'mail_host' AND value > 8 THEN 1 ELSE 0 END AS n_flags FROM (
  SELECT doc_id, 'secret_digits' AS metric, try_cast(replace(regexp_extract(t, '(?i)token =[^.]{0,60}?([0-9][0-9,]*(?:\\.[0-9]+)?)', 1), ',', '') AS DOUBLE) AS value FROM squashed
  UNION ALL SELECT doc_id, 'mail_host', try_cast(replace(regexp_extract(t, '(?i)mail[^.]{0,10}?([0-9][0-9,]*(?:\\.[0-9]+)?)', 1), ',', '') AS DOUBLE) FROM squashed
  UNION ALL SELECT doc_id, 'mail_domain', try_cast(regexp_extract(t, '(?i)@mail([0-9]+)\\.example', 1) AS DOUBLE) FROM squashed)
WHERE value IS NOT NULL
""")
def declared_extract(spark, sf):
    out = prose.declared_metrics(v.table(spark, sf, "documents"), DECLARED, ["doc_id"])
    return out.select("doc_id", "metric", "value", F.size("flags").alias("n_flags"))


@query("declared_extract_pages", """
SELECT page_id, 'track_no' AS metric, try_cast(regexp_extract(html, 'track\\(([0-9]+)', 1) AS DOUBLE) AS value FROM pages
WHERE regexp_matches(html, 'track\\([0-9]')
""")
def declared_extract_pages(spark, sf):
    """A declared metric on raw HTML, where tags may split a phrase."""
    spec = MetricSpec("track_no", unit="count", near=("track(",), take="first_number", within=10)
    out = prose.declared_metrics(v.table(spark, sf, "pages"), [spec], ["page_id"], text="html")
    return out.select("page_id", "metric", "value")


@query("declared_first_stops", """
SELECT doc_id, 'late_mail' AS metric, CAST(regexp_extract(substr(text, position('mail' IN lower(text)), 12), '(?i)mail([0-9]+)\\.', 1) AS DOUBLE) AS value
FROM documents WHERE regexp_matches(substr(text, position('mail' IN lower(text)), 12), '(?i)mail[0-9]+\\.')
""")
def declared_first_stops(spark, sf):
    """Only the first place of the phrase counts, and little text behind it."""
    spec = MetricSpec("late_mail", unit="count", anchors=("mail",), patterns=(r"mail([0-9]+)\.",))
    out = prose.declared_metrics(v.table(spark, sf, "documents"), [spec], ["doc_id"], stops=1, before=0, after=12)
    return out.select("doc_id", "metric", "value")


@query("declared_by_type", """
SELECT doc_id, 'mail_domain' AS metric, CAST(regexp_extract(text, '(?i)@mail([0-9]+)\\.example', 1) AS DOUBLE) AS value FROM documents
WHERE lang IN ('de', 'fr') AND regexp_matches(text, '(?i)@mail[0-9]+\\.example')
""")
def declared_by_type(spark, sf):
    """A metric of some entity types is read in documents of those types only."""
    spec = MetricSpec("mail_domain", unit="count", anchors=("@mail",), patterns=(r"@mail([0-9]+)\.example",), entity_types=("de", "fr"))
    docs = v.table(spark, sf, "documents")
    return prose.declared_metrics(docs, [spec], ["doc_id"], entity_type=docs["lang"]).select("doc_id", "metric", "value")


@query("declared_spec_rows", """
SELECT DISTINCT doc_id, 'mail_' || CAST(p_partkey AS VARCHAR) AS metric, CAST(p_partkey AS DOUBLE) AS value
FROM (SELECT doc_id, lang, unnest(regexp_extract_all(text, '(?i)mail([0-9]+)\\.', 1)) AS n FROM documents)
JOIN part ON n = CAST(p_partkey AS VARCHAR) WHERE p_partkey % 2 = 1 OR lang IN ('de', 'fr')
""")
def declared_spec_rows(spark, sf):
    """Specs as rows, one per part; those of even parts count in documents of two types only."""
    n = F.col("p_partkey").cast("string")
    specs = v.table(spark, sf, "part").select(
        F.concat(F.lit("mail_"), n).alias("metric"), F.lit("count").alias("unit"), F.lit(-1e9).alias("low"), F.lit(1e9).alias("high"),
        F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("de"), F.lit("fr"))).otherwise(F.array().cast("array<string>")).alias("entity_types"),
        F.array(F.concat(F.lit("mail"), n, F.lit("."))).alias("phrases"),
        F.array(F.concat(F.lit("mail("), n, F.lit(")\\."))).alias("patterns"))
    docs = dealt(v.table(spark, sf, "documents"), "doc_id")
    return prose.declared_metrics(docs, specs, ["doc_id"], entity_type=docs["lang"]).select("doc_id", "metric", "value")


@query("first_distinct", """
SELECT user_id, event_type, value, event_id FROM (SELECT user_id, event_type, floor(value / 10) AS value, event_id,
  row_number() OVER (PARTITION BY user_id, event_type, floor(value / 10) ORDER BY event_id) AS k FROM events) WHERE k = 1
""")
def first_distinct(spark, sf):
    e = v.table(spark, sf, "events").select("user_id", "event_type", F.floor(F.col("value") / 10).cast("double").alias("value"), "event_id")
    return prose.first_distinct(e, ["user_id", "event_type", "value"], "event_id")


def fee_docs(spark, sf):
    """One or two statements per text; in every second text that states two they come in reverse."""
    o = filed_orders(spark, sf)
    k, kind = F.col("o_orderkey"), F.col("o_orderkey") % 7
    a = F.format_string("%.2f", (k % 300 + 50) / 100)
    now = join_text("Its management fee is calculated at an annual rate of ", a, "% on all holdings.")
    was = F.lit("Prior to May 1, 2019, the <i>Management</i> Fee fell due each month at an annual rate of 4.75% of average net assets.")
    gap = F.repeat(F.lit("Nothing further is said here. "), F.lit(130))
    year = join_text("an annualized hurdle rate of ", a, "% applies")
    quarter = join_text("the hurdle rate of ", a, "% per quarter applies")
    body = (
        F.when(kind == 0, join_text("Prior to May 1, 2019, the <i>Management</i> Fee fell due each month at an annual rate of ", a, "% on the balance."))
        .when(kind == 1, join_text("Other terms formerly held. ", now))
        .when(kind == 2, join_text("above a hurdle rate of ", a, "% quarterly, as before"))
        .when(kind == 3, join_text("or 9.99% per quarter, so an annualized hurdle&nbsp;rate of ", a, "%, and a catch-up"))
        .when(kind == 4, join_text("as an example there is a ", a, "% incentive fee on pre-incentive fee income"))
        .when(kind == 5, F.when(k % 2 == 0, join_text(now, " ", was)).otherwise(join_text(was, " ", now)))
        .otherwise(F.when(k % 2 == 0, join_text(year, ". ", gap, quarter)).otherwise(join_text(quarter, ". ", gap, year)))
    )
    return o.select("o_orderkey", join_text("An opening without figures. ", body).alias("text"))


@query("rule_extract", """
SELECT o_orderkey, metric, value, flags, effective_until FROM (
  SELECT o_orderkey, CASE WHEN k IN (0, 1, 5) THEN 'management_fee_pct' WHEN k IN (2, 3, 6) THEN 'incentive_hurdle_pct' ELSE 'incentive_fee_pct' END AS metric,
    round(CASE WHEN k = 2 THEN a * 4 ELSE a END, 6) AS value,
    CASE WHEN k = 0 THEN 'superseded_rate' WHEN k = 4 THEN 'rate_from_worked_example' || CASE WHEN a < 5 THEN ';implausible_incentive_fee_rate' ELSE '' END ELSE '' END AS flags,
    CASE WHEN k = 0 THEN DATE '2019-05-01' END AS effective_until
  FROM (SELECT o_orderkey, o_orderkey % 7 AS k, (o_orderkey % 300 + 50) / 100 AS a FROM orders)
  UNION ALL
  SELECT o_orderkey, 'management_fee_pct', 4.75, 'superseded_rate', DATE '2019-05-01' FROM orders WHERE o_orderkey % 7 = 5
  UNION ALL
  SELECT o_orderkey, 'incentive_hurdle_pct', round((o_orderkey % 300 + 50) / 100 * 4, 6), '', NULL FROM orders WHERE o_orderkey % 7 = 6)
""")
def rule_extract(spark, sf):
    return prose.fee_prose(fee_docs(spark, sf), ["o_orderkey"]).select(
        "o_orderkey", "metric", six("value").alias("value"), F.array_join("flags", ";").alias("flags"), "effective_until")


@query("superseded_pairs", """
SELECT o_orderkey, 'management_fee_pct' AS metric, CASE s WHEN 0 THEN 1.0 ELSE (o_orderkey % 300 + 150) / 100 END AS value,
  CASE s WHEN 0 THEN '' ELSE 'superseded_rate' END AS flags,
  CASE WHEN s = 0 AND o_orderkey % 2 = 0 THEN DATE '2024-07-01' END AS effective_from,
  CASE WHEN s = 1 AND o_orderkey % 2 = 0 THEN DATE '2024-07-01' END AS effective_until
FROM orders, (VALUES (0), (1)) t(s)
""")
def superseded_pairs(spark, sf):
    o = filed_orders(spark, sf)
    old = F.format_string("%.2f", (F.col("o_orderkey") % 300 + 150) / 100)
    when = F.when(F.col("o_orderkey") % 2 == 0, F.lit("effective as of July 1, 2024, ")).otherwise(F.lit(""))
    docs = o.select("o_orderkey", join_text("The board met on May 9, 2024; ", when, "the management fee rate was reduced from ", old, "% to 1.0%.").alias("text"))
    return prose.superseded_pairs(docs, ["o_orderkey"]).select(
        "o_orderkey", "metric", "value", F.array_join("flags", ";").alias("flags"), "effective_from", "effective_until")


def table_html(rows):
    cells = lambda row: F.concat(F.lit("<tr>"), *[join_text("<td> ", c, "</td>") for c in row], F.lit("</tr>\n"))
    return F.concat(F.lit("<table border=1>"), *[cells(r) for r in rows], F.lit("</table>"))


def fee_pages(spark, sf):
    o = filed_orders(spark, sf)
    k = F.col("o_orderkey")
    a = F.format_string("%.2f", (k % 300 + 50) / 100)
    head = F.when(k % 2 == 0, F.lit("<b>as a percentage of net assets</b>")).otherwise(F.lit("Expenses"))
    full = table_html([[head, "x"], ["Management Fee (1)", F.concat(a, F.lit("%"))], ["Other expenses", "0.10%"], ["Total annual expenses", "2.00%"]])
    part = table_html([[head, "x"], ["Incentive Fee", F.concat(a, F.lit(" %"))]])
    page = join_text("<html><p>Annual <i>Expenses</i></p>", F.when(k % 3 == 0, full).otherwise(part), "</html>")
    return o.select("o_orderkey", page.alias("html"))


@query("html_table_scan", """
SELECT o_orderkey, r AS row_no, CASE WHEN r = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'as a percentage of net assets' ELSE 'Expenses' END || '|x'
  WHEN o_orderkey % 3 <> 0 THEN 'Incentive Fee|' || a || ' %' WHEN r = 1 THEN 'Management Fee (1)|' || a || '%'
  WHEN r = 2 THEN 'Other expenses|0.10%' ELSE 'Total annual expenses|2.00%' END AS cells
FROM (SELECT o_orderkey, printf('%.2f', (o_orderkey % 300 + 50) / 100) AS a FROM orders), (VALUES (0), (1), (2), (3)) t(r)
WHERE o_orderkey % 3 = 0 OR r < 2
""")
def html_table_scan(spark, sf):
    rows = ht.html_tables(fee_pages(spark, sf), ["o_orderkey"], "html", ht.FEE_ANCHORS)
    return rows.select("o_orderkey", "row_no", F.array_join("cells", "|").alias("cells"))


def nested_pages(spark, sf):
    """A table in capitals whose first row holds a table of its own; every third page is cut off."""
    o = filed_orders(spark, sf)
    k = F.col("o_orderkey")
    a = F.format_string("%.2f", (k % 300 + 50) / 100)
    inner = F.concat(F.lit("<table><tr><td>Inner</td><td>"), a, F.lit("%</td></tr><tr><th>Last"),
                     F.when(k % 2 == 0, F.lit("</th></tr></table>")).otherwise(F.lit("</table>")))
    end = F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("</TD></TR></TABLE></html>"))
    page = join_text("<html><p>Annual Expenses</p><TABLE border=1>\n<TR><TD>Outer<!-- <td>x</td> --><TD>before Shareholder <b>Fees</b> ", inner,
                     " behind</TD></TR><TR><TD>Management Fee</TD><TD>", a, "%", end)
    return o.select("o_orderkey", page.alias("html"))


@query("nested_table_scan", """
SELECT o_orderkey, t AS table_no, r AS row_no, CASE WHEN t = 0 AND r = 0 THEN 'Outer|before Shareholder Fees behind'
  WHEN t = 0 THEN 'Management Fee|' || a || '%' WHEN r = 0 THEN 'Inner|' || a || '%' ELSE 'Last' END AS cells,
  CASE WHEN t = 0 THEN 'Annual Expenses' ELSE 'Outer before Shareholder Fees' END AS preamble
FROM (SELECT o_orderkey, printf('%.2f', (o_orderkey % 300 + 50) / 100) AS a FROM orders), (VALUES (0), (1)) u(t), (VALUES (0), (1)) w(r)
""")
def nested_table_scan(spark, sf):
    rows = ht.html_tables(nested_pages(spark, sf), ["o_orderkey"], "html", ht.FEE_ANCHORS)
    return rows.select("o_orderkey", "table_no", "row_no", F.array_join("cells", "|").alias("cells"), "preamble")


@query("fee_table_extract", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'management_fee_pct' ELSE 'incentive_fee_pct' END AS metric, (o_orderkey % 300 + 50) / 100 AS value,
  CASE WHEN o_orderkey % 2 = 0 THEN 'pct_of_net_assets' ELSE 'pct_of_unstated' END AS fee_basis,
  CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'fee_denominator_unstated' END AS flags FROM orders
UNION ALL SELECT o_orderkey, 'incentive_fee_pct', 0.0, 'none_disclosed', 'inferred_from_absence' FROM orders WHERE o_orderkey % 3 = 0
""")
def fee_table_extract(spark, sf):
    return ht.fee_tables(fee_pages(spark, sf), ["o_orderkey"], "html").select(
        "o_orderkey", "metric", "value", F.col("basis")["fee_basis"].alias("fee_basis"), F.array_join("flags", ";").alias("flags"))


@query("return_table_extract", """
SELECT o_orderkey, metric, CASE metric WHEN 'net_return_1y_pct' THEN (o_orderkey % 300 + 50) / 100 ELSE 7.5 END AS value, 'Class ' || c AS share_class
FROM orders, (VALUES ('net_return_1y_pct'), ('net_return_5y_pct')) t(metric), (VALUES ('A'), ('I')) u(c)
WHERE c = 'A' OR metric = 'net_return_1y_pct'
""")
def return_table_extract(spark, sf):
    o = filed_orders(spark, sf)
    a = F.concat(F.format_string("%.2f", (F.col("o_orderkey") % 300 + 50) / 100), F.lit("%"))
    grid = table_html([["Fund", "1 Year", "Five Years"], ["Class A", a, "7.5%"], ["Class I", a, "n/a"]])
    docs = o.select("o_orderkey", join_text("<p>Average Annual Total Returns</p>", grid).alias("html"))
    return ht.return_tables(docs, ["o_orderkey"], "html").select("o_orderkey", "metric", "value", "share_class")


def highlight_pages(spark, sf):
    o = filed_orders(spark, sf)
    k = F.col("o_orderkey")
    y = F.year("o_orderdate")
    n = [F.format_string("%.2f", (k % 300 + 800 + 10 * i) / 100) for i in range(3)]
    r = [F.format_string("%.2f", (k % 700 + 100 * i) / 100) for i in range(3)]
    cls = F.when(k % 4 == 0, F.lit("CLASS  I")).when(k % 4 == 1, F.lit("Class I Shares")).otherwise(F.lit("CLASS A"))
    grid = table_html([
        [cls, join_text("Year ended ", y), join_text(y - 1), join_text(y - 2)],
        ["Net asset value, beginning of period", "$", "1.00"],
        ["Net asset value, end of period", "$", n[0], "$", n[1], "$", n[2]],
        ["Total return 4", F.concat(F.lit("("), r[0]), ")", "%", r[1], "%", r[2], "%"],
        ["Total dividends and/or distributions to shareholders:", "(0.75", ")", "(0.86", ")", "(0.88", ")"],
        ["Portfolio turnover", "45", "%", "50", "%", "55", "%"],
    ])
    return o.select("o_orderkey", F.col("o_custkey").alias("entity"), F.when(k % 2 == 0, F.lit("N-CSR")).otherwise(F.lit("N-CSRS")).alias("form"),
                    F.last_day(F.col("o_orderdate").cast("date")).alias("report_date"), join_text("<p>Financial Highlights</p>", grid).alias("html"))


TURNOVER = MetricSpec("portfolio_turnover_pct", high=500.0, low=0.0, custom=True, highlight_rows=("portfolio turnover",))


@query("highlights_extract", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'CLASS I' WHEN 1 THEN 'Class I Shares' ELSE 'CLASS A' END AS share_class,
  CAST(y AS VARCHAR) || ',' || CAST(y - 1 AS VARCHAR) || ',' || CAST(y - 2 AS VARCHAR) AS years,
  (o_orderkey % 300 + 800) / 100 AS nav_newest, -(o_orderkey % 700) / 100 AS return_newest, 0.88::DOUBLE AS dividend_oldest, 45.0::DOUBLE AS turnover
FROM (SELECT *, year(o_orderdate) AS y FROM orders)
""")
def highlights_extract(spark, sf):
    out = ht.highlights_tables(highlight_pages(spark, sf), ["o_orderkey"], "html", [TURNOVER])
    return out.select("o_orderkey", "share_class", F.array_join("years", ",").alias("years"), F.get("nav_end", 0).alias("nav_newest"),
                      F.get("total_return", 0).alias("return_newest"), F.get("dividends", 2).alias("dividend_oldest"),
                      F.get(TURNOVER.key, 0).alias("turnover"))


@query("class_candidates", """
SELECT entity, 'nav_per_share_usd' AS metric, round((ok % 300 + 800) / 100, 6) AS value FROM class_pick
UNION ALL SELECT entity, 'distribution_yield_pct', round(100.0 * 0.75 / ((ok % 300 + 800) / 100), 6) FROM class_pick
  WHERE annual_year = y
UNION ALL SELECT entity, 'net_return_1y_pct', round(-(annual_ok % 700) / 100, 6) FROM class_pick WHERE annual_ok IS NOT NULL
UNION ALL SELECT entity, 'net_return_3y_pct', round((pow((1 - (annual_ok % 700) / 10000) * (1 + (annual_ok % 700 + 100) / 10000) * (1 + (annual_ok % 700 + 200) / 10000), 1.0 / 3) - 1) * 100, 6)
  FROM class_pick WHERE annual_ok IS NOT NULL
""")
def class_candidates(spark, sf):
    tables = ht.highlights_tables(highlight_pages(spark, sf), ["o_orderkey", "entity", "form", "report_date"], "html")
    tables = tables.withColumn("table_no", F.col("o_orderkey"))
    entities = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), F.lit("Class I").alias("institutional_class"))
    return pc.class_candidates(tables, entities).select("entity", "metric", six("value").alias("value"))


fragment("class_rows", """
SELECT o_custkey AS entity, o_orderkey AS ok, o_orderkey % 4 AS m, o_orderkey % 2 = 0 AS annual, year(o_orderdate) AS y,
  last_day(CAST(o_orderdate AS DATE)) AS rd FROM orders WHERE o_orderkey % 4 < 2
""")
fragment("class_pick", """
SELECT p.entity, p.ok, p.y, a.ok AS annual_ok, a.y AS annual_year FROM
  (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY m, rd DESC, ok) AS k FROM class_rows) WHERE k = 1) p
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY m, rd DESC, ok) AS k FROM class_rows WHERE annual) WHERE k = 1) a
  ON a.entity = p.entity
""")


# -------------------------------------------------------- candidates from facts

TAGS = {"price": ("1-URGENT",), "equity": ("2-HIGH", "1-URGENT"), "shares": ("3-MEDIUM",), "debt": ("4-NOT SPECIFIED", "5-LOW"),
        "liabilities": ("5-LOW",), "assets": ("3-MEDIUM",)}


def nation_kinds(spark, sf):
    n = F.col("n_nationkey")
    kind = F.when(n % 3 == 0, "interval_fund").when(n % 3 == 1, "bdc").otherwise("mortgage_reit")
    return v.table(spark, sf, "nation").select(n.alias("entity"), kind.alias("entity_type"))


fragment("roles", """
SELECT entity, max({r}) FILTER (tag = '1-URGENT') AS t1, max({r}) FILTER (tag = '2-HIGH') AS t2, max({r}) FILTER (tag = '3-MEDIUM') AS t3,
  max({r}) FILTER (tag = '4-NOT SPECIFIED') AS t4, max({r}) FILTER (tag = '5-LOW') AS t5
FROM nation_facts WHERE "end" <= DATE '2000-12-31' GROUP BY entity
""".replace("{r}", "{{'d': \"end\", 'accn': accn, 'ord': ord, 'val': val}}".replace("{{", "{").replace("}}", "}")))


@query("nav_candidates", """
SELECT entity, 'xbrl' AS tier, 'nav_per_share' AS measure, t1.d AS period_end, round(t1.val, 6) AS value, '' AS flags FROM roles WHERE t1 IS NOT NULL
UNION ALL SELECT entity, 'derived', CASE WHEN entity % 3 = 2 THEN 'book_value_per_share' ELSE 'nav_per_share' END, t2.d, round(t2.val / t3.val, 6),
  CASE WHEN entity % 3 = 2 THEN 'reit_book_value_not_nav' ELSE '' END FROM roles WHERE t2.d = t3.d
""")
def nav_candidates(spark, sf):
    out = pc.price_candidates(nation_facts(spark, sf), nation_kinds(spark, sf), TAGS, v.ref())
    return out.select("entity", "tier", F.col("basis")["measure"].alias("measure"), "period_end", six("value").alias("value"),
                      F.array_join("flags", ";").alias("flags"))


@query("leverage_candidates", """
SELECT entity, 'leverage_regulatory_dte' AS metric, round(t4.val / t2.val, 6) AS value, '4-NOT SPECIFIED / 2-HIGH' AS transform FROM roles WHERE t4.d = t2.d
UNION ALL SELECT entity, 'leverage_economic_dte', round(t5.val / t2.val, 6), '5-LOW / 2-HIGH' FROM roles WHERE t5.d = t2.d
UNION ALL SELECT entity, 'leverage_economic_dte', round((t3.val - t2.val) / t2.val, 6), '(3-MEDIUM - 2-HIGH) / 2-HIGH' FROM roles WHERE t3.d = t2.d
""")
def leverage_candidates(spark, sf):
    out = pc.leverage_candidates(nation_facts(spark, sf), TAGS, v.ref())
    return out.select("entity", "metric", six("value").alias("value"), F.get("transforms", 0).alias("transform"))


@query("yield_two_bases", """
SELECT q.entity, b AS yield_basis, round(CASE b WHEN 'trailing_12m' THEN 100.0 * t.total / p.price ELSE 100.0 * q.amount * (365.25 / q.days) / p.price END, 5) AS value,
  CASE WHEN b = 'trailing_12m' THEN CASE WHEN t.covered >= 358 THEN '' ELSE 'ttm_window_incomplete' END
    ELSE CASE WHEN q.source <> 'tagged' THEN 'distribution_period_derived' ELSE '' END END AS flags
FROM (SELECT entity, "end", "end" - start + 1 AS days, CAST(value AS DOUBLE) / 10000000 AS amount, source, row_number() OVER (PARTITION BY entity ORDER BY start DESC) AS k FROM ledger) q
JOIN (SELECT l.entity, CAST(sum(l.value) AS DOUBLE) / 10000000 AS total, sum(l."end" - l.start + 1) AS covered FROM ledger l
  JOIN (SELECT entity, max("end") AS m FROM ledger GROUP BY entity) x ON x.entity = l.entity AND l.start >= x.m - 364 GROUP BY l.entity) t ON t.entity = q.entity
JOIN (SELECT entity, arg_max(nav, "end") AS price FROM v_nav WHERE "end" <= DATE '2000-12-31' GROUP BY entity) p ON p.entity = q.entity,
(VALUES ('trailing_12m'), ('current_quarter_annualized')) u(b) WHERE q.k = 1
""")
def yield_two_bases(spark, sf):
    price = v.nav(spark, sf).where(F.col("end") <= v.ref()).groupBy("entity").agg(F.max_by("nav", "end").alias("price"))
    out = pc.yield_candidates(per_share(spark, sf), price)
    return out.select("entity", F.col("basis")["yield_basis"].alias("yield_basis"), F.round("value", 5).alias("value"),
                      F.array_join("flags", ";").alias("flags"))
