"""Nested facts, parallel-array indexes, XML reports, tagged HTML, own series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline import rules
from plumbline.functions import dates
from plumbline.operators.returns import month_unpivot

FACT = ("struct<val: double, start: string, end: string, accn: string, form: string, filed: string, "
        "fy: int, fp: string, frame: string>")
FACTS = f"map<string, map<string, struct<units: map<string, array<{FACT}>>>>>"


def iso_date(col: Column) -> Column:
    return F.try_to_date(F.substring(F.trim(col), 1, 10), "yyyy-MM-dd")


def read_facts(spark: SparkSession, path: str, entity_field: str = "cik") -> DataFrame:
    """One JSON document per entity: {entity_field, facts: taxonomy -> tag -> units}."""
    return spark.read.schema(f"{entity_field} string, facts {FACTS}").json(path)


def flatten_facts(df: DataFrame, keys: Sequence[str], facts: str = "facts") -> DataFrame:
    """taxonomy -> tag -> unit -> rows, one typed fact per row."""
    return (
        df.select(*keys, F.explode(facts).alias("taxonomy", "_tags"))
        .select(*keys, "taxonomy", F.explode("_tags").alias("tag", "_body"))
        .select(*keys, "taxonomy", "tag", F.explode("_body.units").alias("unit", "_rows"))
        .select(*keys, "taxonomy", "tag", "unit", F.explode("_rows").alias("_f"))
        .select(
            *keys, "taxonomy", "tag", "unit", F.col("_f.val").alias("val"),
            iso_date(F.col("_f.start")).alias("start"), iso_date(F.col("_f.end")).alias("end"),
            F.coalesce("_f.accn", F.lit("")).alias("accn"), F.coalesce("_f.form", F.lit("")).alias("form"),
            iso_date(F.col("_f.filed")).alias("filed"), "_f.fy", "_f.fp", "_f.frame",
        )
    )


def zip_index(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], forms: Sequence[str] = (), since: date | None = None
) -> DataFrame:
    """Parallel arrays to rows, kept by form and filing date; ``position`` is newest first."""
    rows = df.select(*keys, F.posexplode(F.arrays_zip(*columns)).alias("position", "_r")).select(
        *keys, "position", "_r.*")
    if forms:
        rows = rows.where(F.upper("form").isin([f.upper() for f in forms]))
    for name in columns:
        if name.endswith("_date"):
            rows = rows.withColumn(name, iso_date(F.col(name)))
    if since is not None:
        rows = rows.where(F.col("filing_date").isNull() | (F.col("filing_date") >= F.lit(since)))
    return rows


# Borrowing fields of a report.
BORROW_FIELDS = (
    "amtPayOneYrBanksBorr", "amtPayOneYrCtrldComp", "amtPayOneYrOthAffil", "amtPayOneYrOther",
    "amtPayAftOneYrBanksBorr", "amtPayAftOneYrCtrldComp", "amtPayAftOneYrOthAffil", "amtPayAftOneYrOther",
)
# Holdings are not declared, so the parser never materialises them.
REPORT = (
    "formData struct<genInfo: struct<regName: string, seriesName: string, repPdEnd: string, repPdDate: string>, "
    "fundInfo: struct<totAssets: double, totLiabs: double, netAssets: double, "
    + ", ".join(f"{f}: double" for f in BORROW_FIELDS)
    + ", returnInfo: struct<monthlyTotReturns: struct<monthlyTotReturn: array<struct<"
    "_classId: string, _rtn1: string, _rtn2: string, _rtn3: string>>>>>>"
)


def parse_reports(df: DataFrame, xml: str, keys: Sequence[str]) -> DataFrame:
    """Header, balances and borrowings of one XML report per row.

    ``borrowings`` is NULL when no field is reported and 0 when all are zero.
    Reports that cannot be read are left to ``unreadable_reports``.
    """
    parsed = df.select(*keys, F.from_xml(F.col(xml), REPORT).alias("_x")).select(
        *keys, F.col("_x.formData.genInfo").alias("_g"), F.col("_x.formData.fundInfo").alias("_f"))
    fields = [F.col(f"_f.{f}") for f in BORROW_FIELDS]
    return parsed.where(F.col("_g").isNotNull() & F.col("_f").isNotNull()).select(
        *keys, F.trim("_g.regName").alias("reg_name"), F.trim("_g.seriesName").alias("series_name"),
        iso_date(F.col("_g.repPdDate")).alias("period_end"), iso_date(F.col("_g.repPdEnd")).alias("fiscal_year_end"),
        F.col("_f.totAssets").alias("total_assets"), F.col("_f.totLiabs").alias("total_liabilities"),
        F.col("_f.netAssets").alias("net_assets"),
        null_aware_sum(*fields).alias("borrowings"),
        nonzero_parts(dict(zip(BORROW_FIELDS, fields))).alias("borrowing_breakdown"),
        F.col("_f.returnInfo.monthlyTotReturns.monthlyTotReturn").alias("return_rows"),
    )


def unreadable_reports(df: DataFrame, xml: str, keys: Sequence[str]) -> DataFrame:
    """keys and reason of reports that are missing, do not parse, or lack the header or the balances."""
    parsed = df.select(*keys, F.col(xml).isNull().alias("_none"), F.from_xml(F.col(xml), REPORT).alias("_x"))
    info, fund = F.col("_x.formData.genInfo").isNull(), F.col("_x.formData.fundInfo").isNull()
    reason = (F.when(F.col("_none"), F.lit("no_document")).when(info & fund, F.lit("unreadable"))
              .when(info, F.lit("no_header")).when(fund, F.lit("no_balances")))
    return parsed.withColumn("reason", reason).where("reason is not null").select(*keys, "reason")


def null_aware_sum(*parts: Column) -> Column:
    """Sum of the reported parts; NULL only when none is reported."""
    total = F.lit(0.0)
    for part in parts:
        total = total + F.coalesce(part, F.lit(0.0))
    return F.when(F.coalesce(*parts).isNotNull(), total)


def nonzero_parts(parts: dict[str, Column]) -> Column:
    pairs = [x for name, col in parts.items() for x in (F.lit(name), col)]
    return F.map_filter(F.create_map(*pairs), lambda k, val: val.isNotNull() & (val != 0))


def report_returns(reports: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Monthly returns per class row: three columns to month ends, oldest first."""
    rows = reports.where(F.col("period_end").isNotNull() & (F.size("return_rows") > 0))
    each = rows.select(*keys, "period_end", F.size("return_rows").alias("_n"),
                       F.posexplode("return_rows").alias("_pos", "_r"))
    named = F.coalesce(F.col("_r._classId"), F.when(F.col("_n") > 1, F.concat(F.lit("pos"), F.col("_pos").cast("string"))))
    each = each.select(
        *keys, "period_end", named.alias("share_class"),
        *[F.col(f"_r._rtn{i}").try_cast("double").alias(f"rtn{i}") for i in (1, 2, 3)],
    )
    return month_unpivot(each)


def report_leverage(latest: DataFrame) -> DataFrame:
    """Leverage of the newest report on two bases, with the zero-borrowings flag."""
    ok = latest.where(F.col("net_assets").isNotNull() & (F.col("net_assets") != 0))
    flagged = zero_anomaly(F.col("borrowings"), F.col("total_liabilities"), F.col("net_assets"))
    rows = F.array(
        F.when(F.col("borrowings").isNotNull(), F.struct(
            F.lit("leverage_regulatory_dte").alias("metric"), (F.col("borrowings") / F.col("net_assets")).alias("value"),
            F.lit("gross_debt_to_equity").alias("leverage_basis"),
            F.when(flagged, F.array(F.lit(rules.ZERO_BORROWINGS_FLAG))).otherwise(F.array().cast("array<string>")).alias("flags"))),
        F.when(F.col("total_liabilities").isNotNull(), F.struct(
            F.lit("leverage_economic_dte").alias("metric"),
            (F.col("total_liabilities") / F.col("net_assets")).alias("value"),
            F.lit("total_liabilities_to_equity").alias("leverage_basis"),
            F.array(F.lit("includes_unsettled_trades_and_payables")).alias("flags"))),
    )
    keep = [c for c in latest.columns if c not in ("return_rows", "borrowing_breakdown")]
    return ok.select(*keep, F.explode(F.array_compact(rows)).alias("_r")).select(*keep, "_r.*")


def zero_anomaly(borrowings: Column, liabilities: Column, net_assets: Column) -> Column:
    """No borrowings reported while liabilities are material against net assets."""
    material = F.try_divide(liabilities, net_assets) > rules.MATERIAL_LIABILITY_RATIO
    return F.coalesce((borrowings == 0) & material, F.lit(False))


def context_flags(form: Column, percent: Column) -> Column:
    """Doubts about a tagged fee: read from an untrusted form, or too low."""
    trusted = F.upper(form).isin(list(rules.TRUSTED_FEE_FORMS))
    return F.array_compact(F.array(
        F.when(~trusted, F.concat(F.lit("fee_table_from_"), form, F.lit("_not_fund_prospectus"))),
        F.when(percent < rules.MIN_PLAUSIBLE_FEE, F.lit("implausibly_low_for_entity_type")),
    ))


# Fixed patterns of inline tagged facts.
CONTEXT = r'(?s)<xbrli:context id="([^"]+)"(.*?)</xbrli:context>'
INLINE = r"(?s)<ix:nonFraction([^>]*)>(.*?)</ix:nonFraction>"


def inline_facts(docs: DataFrame, keys: Sequence[str], html: str) -> DataFrame:
    """Consolidated inline facts: tag, date and scaled value, in document order.

    A document joins its facts with its own contexts through a map built once in
    the row, so nothing is shuffled; dimensional contexts are left out.
    """
    ids = F.regexp_extract_all(html, F.lit(CONTEXT), F.lit(1))
    bodies = F.regexp_extract_all(html, F.lit(CONTEXT), F.lit(2))
    both = F.arrays_zip(ids.alias("cid"), bodies.alias("body"))
    contexts = docs.where(F.contains(html, F.lit("<ix:nonFraction"))).withColumn("_c", both)
    usable = F.filter("_c", lambda c: ~F.contains(c["body"], F.lit("<xbrli:segment>")))
    dated = F.transform(usable, lambda c: F.struct(c["cid"].alias("cid"), iso_date(F.regexp_extract(
        c["body"], r"<xbrli:instant>(\d{4}-\d{2}-\d{2})</xbrli:instant>", 1)).alias("end")))
    facts = F.arrays_zip(
        F.regexp_extract_all(html, F.lit(INLINE), F.lit(1)).alias("attrs"),
        F.regexp_extract_all(html, F.lit(INLINE), F.lit(2)).alias("inner"),
    )
    # The last dated definition of an id is the one a fact gets.
    table = F.expr("""map_from_entries(transform(filter(_d, (c, i) -> c.end is not null and
        not exists(slice(_d, i + 2, size(_d)), x -> x.cid = c.cid and x.end is not null)), c -> struct(c.cid, c.end)))""")
    bound = contexts.withColumn("_d", dated).withColumn("_m", table)
    located = F.transform(facts, lambda f: F.struct(
        f["attrs"].alias("attrs"), f["inner"].alias("inner"),
        F.col("_m")[F.regexp_extract(f["attrs"], r'contextRef="([^"]*)"', 1)].alias("end")))
    rows = bound.select(*keys, F.posexplode(located).alias("ord", "_f")).where("_f.end is not null")
    attr = lambda name: F.regexp_extract(F.col("_f.attrs"), name + r'="([^"]*)"', 1)
    raw = F.replace(F.trim(F.regexp_replace("_f.inner", "<[^>]+>", "")), F.lit(","), F.lit(""))
    typed = rows.select(
        *keys, "ord", attr("name").alias("tag"), F.col("_f.end").alias("end"),
        raw.alias("_raw"), F.coalesce(attr("scale").try_cast("int"), F.lit(0)).alias("_scale"), attr("sign").alias("_sign"),
    ).where(F.col("_raw").rlike(r"^-?\d+(\.\d+)?$"))
    value = F.col("_raw").cast("double") * F.pow(F.lit(10.0), F.col("_scale"))
    return typed.select(
        *keys, "ord", "tag", "end", F.when(F.col("_sign") == "-", -value).otherwise(value).alias("val"))


SERIES = ("quarter string, net_return_qtd_pct double, net_return_1y_pct double, net_return_3y_pct double, "
          "net_return_5y_pct double, nav_per_share_usd double, total_aum_usd_mm double, management_fee_pct double, "
          "incentive_fee_pct double, incentive_hurdle_pct double, leverage_ratio_dte double, distribution_yield_pct double")


def read_series(spark: SparkSession, path: str, schema: str = SERIES) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def own_series(df: DataFrame, anchor: Column, label: str = "quarter") -> DataFrame:
    """The house's own quarters with their period end, none past the anchor."""
    rows = df.withColumn("period_end", dates.quarter_label_end(F.col(label)))
    return rows.where(F.col("period_end") <= anchor)


def write_tables(tables: dict[str, DataFrame], folder: str, partition_by: Sequence[str] = ()) -> None:
    """Write result tables as parquet, partitioned (for example by anchor).

    A partitioned table keeps the partitions that the new rows do not name, so a rerun of one
    anchor replaces that anchor alone; the new files are staged and moved in when all are
    written. A table without any of the columns is replaced whole.
    """
    for name, df in tables.items():
        keys = [c for c in partition_by if c in df.columns]
        mode = "dynamic" if keys else "static"
        df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*keys).parquet(f"{folder}/{name}")


def write_csv(df: DataFrame, path: str) -> None:
    """A flat table as CSV; maps and arrays must be joined to text first."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def classify_entities(filings: DataFrame, registry: DataFrame) -> DataFrame:
    """Entity type and fiscal year end from filing history; ambiguous is refused.

    ``registry`` has entity, sic and the registered fiscal year end as 'MMDD'.
    """
    form = F.upper("form")
    annual = form.isin(list(rules.ANNUAL_FORMS))
    seen = filings.groupBy("entity").agg(
        F.bool_or(F.col("form").isin(list(rules.INTERVAL_FORMS))).alias("has_interval"),
        F.bool_or(F.col("form").isin(list(rules.OPERATING_FORMS))).alias("has_operating"),
        F.max(F.when(annual, F.col("report_date"))).alias("annual_end"),
    )
    sic = F.coalesce("sic", F.lit(""))
    rows = registry.join(seen, "entity", "left").fillna(False, ["has_interval", "has_operating"])
    interval, operating = F.col("has_interval"), F.col("has_operating")
    reit = operating & sic.isin(list(rules.REIT_SIC))
    kind = (
        F.when(interval & ~operating, "interval_fund").when(reit, "mortgage_reit")
        .when(operating & ~interval, "bdc").otherwise("")
    )
    registered = F.when(F.col("registered_fye").rlike(r"^\d{4}$"), F.concat(
        F.substring("registered_fye", 1, 2), F.lit("-"), F.substring("registered_fye", 3, 2))).otherwise("")
    fye = F.coalesce(F.date_format("annual_end", "MM-dd"), registered)
    odd_sic = (kind == "bdc") & ~sic.isin(list(rules.INVESTMENT_SIC))
    return rows.select(
        "entity", kind.alias("entity_type"), fye.alias("fiscal_year_end"),
        ((kind != "") & (fye != "") & ~odd_sic).alias("confident"),
        F.array_compact(F.array(
            F.when(F.col("annual_end").isNull() & (registered != ""), F.lit("fiscal year end from registration")),
            F.when(F.col("annual_end").isNotNull() & (registered != "") & (registered != fye),
                   F.lit("registered fiscal year end disagrees with filings")),
            F.when(fye == "", F.lit("no fiscal year end could be established")),
            F.when(odd_sic, F.lit("SIC is not an investment-company code")),
            F.when(operating & interval & ~reit, F.lit("files both operating and closed-end forms; ambiguous")),
            F.when(~operating & ~interval, F.lit("no source reaches this filer")),
        )).alias("reasons"),
    )


def filing_windows(filings: DataFrame, entities: DataFrame, anchor: Column) -> DataFrame:
    """When the next report should arrive, from the filer's own observed lags."""
    lag = F.date_diff("filing_date", "report_date")
    lags = filings.where(F.col("report_date") <= anchor).groupBy("entity").agg(
        F.min(lag).alias("_lo"), F.max(lag).alias("_hi"), F.count(F.lit(1)).alias("n_observations"))
    nxt = dates.next_period_end(F.col("fiscal_year_end"), anchor)
    out = lags.join(entities.select("entity", "fiscal_year_end"), "entity").withColumn("period_end", nxt).withColumns({
        "earliest": F.expr("date_add(period_end, _lo)"), "latest": F.expr("date_add(period_end, _hi)")})
    month = lambda c: F.date_format(c, "MMM yyyy")
    label = F.when(month("earliest") == month("latest"), F.concat(F.lit("expected "), month("earliest"))).otherwise(
        F.concat(F.lit("expected "), F.date_format("earliest", "MMM"), F.lit("-"), month("latest")))
    return out.select("entity", "period_end", "earliest", "latest", "n_observations", label.alias("window"))
