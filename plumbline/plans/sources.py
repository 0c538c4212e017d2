"""From extractors to one run: notices, candidate rows of documents, routing by entity type.

Reasons that an extractor has for leaving a metric out become notices, rows that documents
state become candidates with their provenance, and every source feeds only the entity types
it is meant for. All of it is unions, joins on the entity and column work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import rules
from plumbline.functions.dates import clamped, fiscal_month, other_fiscal_month
from plumbline.functions.text import normalize_label
from plumbline.operators.asof import as_of
from plumbline.operators.groups import first_per_group
from plumbline.schema import CANDIDATE, NOTICE, conform, union_sources
from plumbline.sources.structured import context_flags


def _metric_of(years: Column) -> Column:
    pairs = ", ".join(f"{y}, '{m}'" for y, m in rules.RETURN_METRICS.items())
    return F.element_at(F.expr(f"map({pairs})"), years)


def _notice(rows: DataFrame, detail: Column, as_of_day: Column, start: Column, end: Column, note: Column) -> DataFrame:
    """Notice rows of (entity, years, reason); the shortest span comes first."""
    told = rows.where(F.col("reason").isNotNull()).select(
        F.col("entity").cast("string").alias("entity"), _metric_of(F.col("years")).alias("metric"), "reason",
        detail.alias("detail"), as_of_day.alias("as_of"), start.alias("coverage_start"), end.alias("coverage_end"),
        note.alias("internal_note"), F.col("years").cast("long").alias("ord"))
    return conform(told, NOTICE).drop("filing_date")


def return_notices(trailing: DataFrame) -> DataFrame:
    """Why a total return is missing: too few prices, or none near the start of the span.

    ``trailing`` comes from ``trailing_total_returns``; the coverage is its last unbroken run.
    """
    allowed = F.expr("map(" + ", ".join(f"{y}, {d}" for y, d in rules.WINDOW_TOLERANCE_DAYS.items()) + ")")
    few = F.concat(F.col("n_obs").cast("string"), F.lit(" price(s) on record, three are needed"))
    off = F.concat(
        F.lit("no price within "), F.element_at(allowed, F.col("years")).cast("string"), F.lit(" days of "),
        F.col("target").cast("string"), F.lit("; the nearest, of "), F.col("window_start").cast("string"), F.lit(", is "),
        F.col("drift").cast("string"), F.lit(" days away"))
    mismatch = F.col("reason") == "window_mismatch"
    return _notice(trailing, F.when(mismatch, off).otherwise(few), F.col("run_end"),
                   F.when(mismatch, F.col("run_start")), F.when(mismatch, F.col("run_end")),
                   F.concat(F.lit("span of "), F.col("years").cast("string"), F.lit(" year(s)")))


def monthly_notices(trailing: DataFrame) -> DataFrame:
    """Why a chain of monthly returns is missing; ``trailing`` comes from ``monthly_trailing``."""
    several = F.concat(
        F.col("n_series").cast("string"), F.lit(" unnamed class series"),
        F.when(F.col("low").isNotNull(), F.format_string("; between %.2f and %.2f", F.col("low"), F.col("high"))).otherwise(F.lit("")))
    short = F.concat(F.col("n_months").cast("string"), F.lit(" month(s) on record, "), (F.col("years") * 12).cast("string"),
                     F.lit(" in a row are needed"))
    return _notice(trailing, F.when(F.col("reason") == "class_attribution_failed", several).otherwise(short),
                   F.col("coverage_end"), F.col("coverage_start"), F.col("coverage_end"), F.lit(None).cast("string"))


def monthly_candidates(trailing: DataFrame) -> DataFrame:
    """Returns chained from monthly reports, which speak for the whole fund and say so."""
    months = (F.col("years") * 12).cast("string")
    return trailing.where(F.col("value").isNotNull()).select(
        "entity", _metric_of(F.col("years")).alias("metric"), "value", F.lit("pct").alias("unit"), F.lit("derived").alias("tier"),
        F.col("coverage_end").alias("period_end"),
        F.create_map(F.lit("return_basis"), F.lit("nport_monthly_chain_linked"), F.lit("net_of_fees"), F.lit("True"),
                     F.lit("share_class"), F.lit("fund_level")).alias("basis"),
        F.array(F.concat(F.lit("chained from "), months, F.lit(" monthly returns, per year"))).alias("transforms"),
        F.array(F.lit("fund_level_not_share_class_specific")).alias("flags"), F.col("years").cast("long").alias("ord"))


# The tagged fee of a metric.
FEE_TAGS = {"management_fee_pct": "cef:ManagementFeesPercent", "incentive_fee_pct": "cef:IncentiveFeesPercent"}


def tagged_fee_candidates(facts: DataFrame, anchor: Column, tags: Mapping[str, str] = FEE_TAGS) -> DataFrame:
    """Fees that filers tag as a fraction, in percent, with doubts about where they were read."""
    metric = F.element_at(F.create_map(*[F.lit(x) for m, t in tags.items() for x in (t, m)]), F.col("tag"))
    latest = as_of(facts.where(F.col("tag").isin(list(tags.values()))), ["entity", "tag"], anchor)
    percent = F.col("val") * 100
    return latest.select(
        "entity", metric.alias("metric"), percent.alias("value"), F.lit("pct").alias("unit"), F.lit("xbrl").alias("tier"),
        "form", F.col("accn").alias("accession"), F.col("filed").alias("filing_date"), F.col("end").alias("period_end"),
        F.col("tag").alias("locator"), F.create_map(F.lit("fee_basis"), F.lit("as_tagged")).alias("basis"),
        F.array(F.lit("fraction x 100")).alias("transforms"), context_flags(F.col("form"), percent).alias("flags"), "ord")


def document_candidates(rows: DataFrame, documents: DataFrame, key: str, tier: str, unit: str = "pct") -> DataFrame:
    """Rows that documents state, in the candidate layout.

    ``rows`` come from a prose or table extractor and carry ``key``, metric and value;
    ``documents`` has key, entity, form, accession, filing_date and period_end. A basis, flags,
    transforms, an excerpt, dates of validity, a unit or a share class are taken over where
    there are any; a position becomes the locator and the order.
    """
    have = set(rows.columns)
    side = documents.select(key, "entity", "form", "accession", "filing_date", "period_end")
    out = rows.join(side, key).withColumn("tier", F.lit(tier))
    if "unit" not in have:
        out = out.withColumn("unit", F.lit(unit))
    if "basis" not in have:
        named = F.col("share_class") if "share_class" in have else F.lit("unstated")
        out = out.withColumn("basis", F.create_map(F.lit("share_class"), named))
    place = F.col("pos") if "pos" in have else F.col("anchor_pos") if "anchor_pos" in have else F.lit(0)
    return conform(out.withColumns({"locator": F.concat(F.lit("place "), place.cast("string")), "ord": place.cast("long")}), CANDIDATE)


def routed(
    sources: Mapping[str, DataFrame], entities: DataFrame, routes: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One candidate table from named sources, each for the entity types that ``routes`` gives it.

    ``routes`` lists, per entity type, the sources it is read from. The order of ``sources``
    is the order of the evidence.
    """
    frames = []
    for name, frame in sources.items():
        types = [t for t, names in routes.items() if name in names]
        wanted = entities.where(F.col("entity_type").isin(types)).select("entity").distinct()
        frames.append(frame.join(wanted, "entity", "left_semi"))
    return union_sources(*frames)


def routed_notices(sources: Mapping[str, DataFrame], entities: DataFrame, routes: Mapping[str, Sequence[str]]) -> DataFrame:
    """The notices of named sources, earlier sources first, for the metrics an entity reports."""
    out = None
    scope = entities.select("entity", "entity_type", F.explode("supported_metrics").alias("metric"))
    for position, (name, frame) in enumerate(sources.items()):
        types = [t for t, names in routes.items() if name in names]
        part = frame.join(scope.where(F.col("entity_type").isin(types)), ["entity", "metric"], "left_semi")
        part = part.withColumn("ord", F.col("ord") + F.lit(position << 40))
        out = part if out is None else out.unionByName(part)
    return out


# ----------------------------------------------------------------------- trend
def class_trend(tables: DataFrame, entities: DataFrame, anchor: Column) -> DataFrame:
    """Prices of the wanted share class at fiscal year ends, from year-columned tables.

    ``tables`` has entity, form, report_date, table_no, share_class, years, nav_end. The first
    column of a report that is not annual is for the report's own date. Of one day the newest
    report counts, then its earlier column, then the lower table number.
    """
    own = entities.select("entity", "fiscal_year_end", "institutional_class").where("institutional_class <> ''")
    rows = tables.join(own, "entity").where(normalize_label(F.col("share_class")) == normalize_label(F.col("institutional_class")))
    each = rows.select("entity", "form", "report_date", "table_no", "fiscal_year_end", "nav_end", F.posexplode("years").alias("_i", "_y"))
    closes = clamped(F.col("_y"), fiscal_month(F.col("fiscal_year_end")), F.substring("fiscal_year_end", 4, 2).cast("int"))
    day = F.when((F.col("_i") == 0) & (F.upper("form") != "N-CSR"), F.col("report_date")).otherwise(closes)
    points = each.select("entity", day.alias("end"), F.get("nav_end", F.col("_i")).alias("nav_per_share"), F.col("form").alias("source"),
                         "report_date", "_i", "table_no").where(F.col("nav_per_share").isNotNull() & (F.col("end") <= anchor))
    return first_per_group(points, ["entity", "end"], [-F.unix_date("report_date"), F.col("_i"), F.col("table_no")]).select(
        "entity", "end", "nav_per_share", "source")


def house_trend(series: DataFrame, anchor: Column, price: str = "nav_per_share_usd", fiscal_year_end: str = "12-31") -> DataFrame:
    """The house's own prices at its two semi-annual dates, up to the anchor."""
    year_end = F.lit(fiscal_year_end)
    months = F.month("period_end").isin(fiscal_month(year_end), other_fiscal_month(year_end))
    return series.where(months & (F.col("period_end") <= anchor) & F.col(price).isNotNull()).select(
        F.lit("house").alias("entity"), F.col("period_end").alias("end"), F.col(price).alias("nav_per_share"),
        F.lit("own series").alias("source"))
