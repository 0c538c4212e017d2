"""Candidate construction from facts: prices, leverage, yields, class tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import rules
from plumbline.functions.dates import days_inclusive
from plumbline.metrics import MetricSpec
from plumbline.operators.asof import tag_as_of
from plumbline.operators.intervals import latest_quarter, sum_between


def _strings(*conditional: tuple[Column, str]) -> Column:
    if not conditional:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in conditional]))


def _row(present: Column, metric: str, value: Column, unit: str, tier: str, fact: Column, basis: dict,
         transform: Column, flags: Column) -> Column:
    pairs = [x for k, val in basis.items() for x in (F.lit(k), val if isinstance(val, Column) else F.lit(val))]
    return F.when(present, F.struct(
        F.lit(metric).alias("metric"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
        F.lit(tier).alias("tier"), fact["end"].alias("period_end"), fact["accn"].alias("accession"),
        F.create_map(*pairs).alias("basis"),
        F.array_compact(F.array(transform)).alias("transforms"), flags.alias("flags"),
    ))


def _emit(df: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return df.select("entity", F.explode(F.array_compact(F.array(*rows))).alias("_r")).select("entity", "_r.*")


def latest_by_tag(facts: DataFrame, tags: dict[str, Sequence[str]], anchor: Column) -> DataFrame:
    """Per entity, the as-of fact of each role; a role takes its first tag that has one.

    One aggregate over the facts serves every role.
    """
    names = [t for group in tags.values() for t in group]
    wide = facts.where(F.col("tag").isin(names) & (F.col("end") <= anchor)).groupBy("entity").agg(
        *[tag_as_of(t).alias(f"_t{i}") for i, t in enumerate(names)])
    at = {t: f"_t{i}" for i, t in enumerate(names)}

    def role(group: Sequence[str]) -> Column:
        return F.coalesce(*[
            F.when(F.col(at[t]).isNotNull(), F.struct(
                F.lit(t).alias("tag"), F.col(f"{at[t]}.end").alias("end"), F.col(f"{at[t]}.accn").alias("accn"),
                F.col(f"{at[t]}.val").alias("val")))
            for t in group
        ])

    return wide.select("entity", *[role(group).alias(name) for name, group in tags.items()])


def price_candidates(facts: DataFrame, entities: DataFrame, tags: dict[str, Sequence[str]], anchor: Column) -> DataFrame:
    """Stated price per share, and equity over shares as an independent check.

    Roles in ``tags``: price, equity, shares. For a mortgage REIT the derived
    figure is book value and says so.
    """
    latest = latest_by_tag(facts, {k: tags[k] for k in ("price", "equity", "shares")}, anchor)
    rows = latest.join(entities.select("entity", "entity_type"), "entity")
    reit = F.col("entity_type") == "mortgage_reit"
    same_day = (F.col("equity.end") == F.col("shares.end")) & (F.col("shares.val") != 0)
    derived = F.try_divide(F.col("equity.val"), F.col("shares.val"))
    measure = F.when(reit, F.lit("book_value_per_share")).otherwise(F.lit("nav_per_share"))
    formula = F.concat(F.col("equity.tag"), F.lit(" / "), F.col("shares.tag"))
    return _emit(rows, [
        _row(F.col("price").isNotNull(), "nav_per_share_usd", F.col("price.val"), "usd", "xbrl", F.col("price"),
             {"class": "common", "measure": "nav_per_share"}, F.lit(None).cast("string"), _strings()),
        _row(same_day, "nav_per_share_usd", derived, "usd", "derived", F.col("equity"),
             {"class": "common", "measure": measure}, formula, _strings((reit, "reit_book_value_not_nav"))),
    ])


def leverage_candidates(facts: DataFrame, tags: dict[str, Sequence[str]], anchor: Column) -> DataFrame:
    """Debt to equity on three constructions, each only on matching dates.

    Roles: equity, debt, liabilities, assets. The third, from assets minus
    equity, is the same concept as the second from other tags.
    """
    rows = latest_by_tag(facts, {k: tags[k] for k in ("equity", "debt", "liabilities", "assets")}, anchor)
    rows = rows.where(F.coalesce(F.col("equity.val") != 0, F.lit(False)))
    eq = F.col("equity.val")
    day = lambda role: F.col(f"{role}.end") == F.col("equity.end")
    over = lambda role: F.concat(F.col(f"{role}.tag"), F.lit(" / "), F.col("equity.tag"))
    probe = F.concat(F.lit("("), F.col("assets.tag"), F.lit(" - "), F.col("equity.tag"), F.lit(") / "), F.col("equity.tag"))
    gross, total = {"leverage_basis": "gross_debt_to_equity"}, {"leverage_basis": "total_liabilities_to_equity"}
    return _emit(rows, [
        _row(day("debt"), "leverage_regulatory_dte", F.col("debt.val") / eq, "ratio", "derived", F.col("debt"),
             gross, over("debt"), _strings()),
        _row(day("liabilities"), "leverage_economic_dte", F.col("liabilities.val") / eq, "ratio", "derived",
             F.col("liabilities"), total, over("liabilities"), _strings()),
        _row(day("assets"), "leverage_economic_dte", (F.col("assets.val") - eq) / eq, "ratio", "derived",
             F.col("assets"), total, probe, _strings()),
    ])


def yield_candidates(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """Distribution yield on two bases: last quarter annualised, trailing year.

    ``prices`` has entity and price. Both are kept because they diverge when a
    distribution changes.
    """
    last = latest_quarter(ledger, ["entity"]).select(
        "entity", F.col("start").alias("q_start"), F.col("end").alias("q_end"), F.col("value").cast("double").alias("q_value"),
        "source")
    windows = last.select("entity", F.date_sub("q_end", 364).alias("window_start"), F.col("q_end").alias("window_end"))
    year = sum_between(ledger, windows, ["entity"]).select(
        "entity", F.col("total").cast("double").alias("total"), "n_used", "complete")
    rows = last.join(year, "entity").join(prices.select("entity", "price"), "entity").where(
        F.col("price").isNotNull() & (F.col("price") != 0))
    factor = F.lit(rules.YEAR_DAYS) / days_inclusive(F.col("q_start"), F.col("q_end"))
    fact = F.struct(F.col("q_end").alias("end"), F.lit(None).cast("string").alias("accn"))
    no_note = F.lit(None).cast("string")
    return _emit(rows, [
        _row(F.lit(True), "distribution_yield_pct", F.lit(100.0) * F.col("q_value") * factor / F.col("price"), "pct",
             "derived", fact, {"denominator": "nav", "yield_basis": "current_quarter_annualized"}, no_note,
             _strings((F.col("source") != "tagged", "distribution_period_derived"))),
        _row(F.col("n_used") > 0, "distribution_yield_pct", F.lit(100.0) * F.col("total") / F.col("price"), "pct",
             "derived", fact, {"denominator": "nav", "yield_basis": "trailing_12m"}, no_note,
             _strings((~F.col("complete"), "ttm_window_incomplete"))),
    ])


def return_candidates(trailing: DataFrame) -> DataFrame:
    """Trailing total returns as candidates; ``sources.return_notices`` tells why others are missing."""
    metric = F.element_at(F.expr("map(" + ", ".join(f"{y}, '{m}'" for y, m in rules.RETURN_METRICS.items()) + ")"), F.col("years"))
    return trailing.where(F.col("value").isNotNull()).select(
        "entity", metric.alias("metric"), "value", F.lit("pct").alias("unit"), F.lit("derived").alias("tier"),
        F.col("run_end").alias("period_end"),
        F.create_map(F.lit("net_of_fees"), F.lit("True"), F.lit("reinvested"), F.lit("True"),
                     F.lit("return_basis"), F.lit("nav_total_return")).alias("basis"), "flags")


def class_candidates(tables: DataFrame, entities: DataFrame, specs: Sequence[MetricSpec] = ()) -> DataFrame:
    """Figures of the wanted share class from year-columned tables.

    ``specs`` with a row of their own add the newest figure of that row, from a column of
    ``tables`` named like the spec.

    ``tables`` comes from ``highlights_tables``: entity, form, report_date,
    share_class, years, nav_end, total_return, dividends. An exact class match
    beats a containing one; no match yields nothing rather than another class.
    """
    from plumbline.functions.text import normalize_label

    rows = tables.join(entities.select("entity", "institutional_class").where("institutional_class <> ''"), "entity")
    want, have = normalize_label(F.col("institutional_class")), normalize_label(F.col("share_class"))
    match = F.when(have == want, F.lit(0)).when(F.contains(have, want), F.lit(1))
    matched = rows.withColumn("_m", match).where(F.col("_m").isNotNull())
    order = F.struct("_m", (-F.unix_date("report_date")).alias("d"), "table_no")
    own = [s for s in specs if s.highlight_rows]
    payload = F.struct("form", "report_date", "years", "nav_end", "total_return", "dividends", "share_class", *[s.key for s in own])
    annual_only = F.upper("form") == "N-CSR"
    picked = matched.groupBy("entity").agg(
        F.min(F.struct(order.alias("o"), payload.alias("t"))).getField("t").alias("t"),
        F.min(F.when(annual_only, F.struct(order.alias("o"), payload.alias("t")))).getField("t").alias("a"),
        F.max("institutional_class").alias("share_class"),
    )
    # Year-keyed values: position settles a repeated year (stub columns).
    navs = F.expr("filter(transform(t.years, (y, i) -> struct(y, -i as p, get(t.nav_end, i) as v)), x -> x.v is not null)")
    # One return per fiscal year: of a year stated twice the later column.
    rets = F.expr("transform(array(reverse(sort_array(filter(transform(a.years, (y, i) -> struct(y, i as p, get(a.total_return, i) as v)), "
                  "x -> x.v is not null)))), s -> filter(s, (x, k) -> k = 0 or x.y <> get(s, k - 1).y))[0]")
    divs = F.expr("filter(transform(a.years, (y, i) -> struct(y, -i as p, get(a.dividends, i) as v)), x -> x.v is not null)")
    base = picked.withColumns({"_navs": navs, "_rets": rets, "_divs": divs}).withColumns({
        "_top": F.expr("array_max(_navs)"),
    }).withColumn("_year", F.expr("_top.y")).withColumns({
        "_nav": F.expr("array_min(filter(_navs, x -> x.y = _year)).v"),
        "_div": F.expr("array_min(filter(_divs, x -> x.y = _year)).v"),
    })
    fact = lambda c: F.struct(F.col(f"{c}.report_date").alias("end"), F.lit(None).cast("string").alias("accn"))
    cls = F.col("share_class")
    common = {"net_of_fees": "True", "share_class": cls}
    out = [
        _row(F.expr("get(t.nav_end, 0)").isNotNull(), "nav_per_share_usd", F.expr("get(t.nav_end, 0)"), "usd", "html_table",
             fact("t"), {"measure": "nav_per_share", **common}, F.lit(None).cast("string"), _strings()),
        _row(F.col("_div").isNotNull() & (F.col("_nav") != 0), "distribution_yield_pct",
             F.lit(100.0) * F.col("_div") / F.col("_nav"), "pct", "derived", fact("a"),
             {"denominator": "nav", "yield_basis": "fiscal_year_distributions_on_nav", **common},
             F.lit("fiscal year distributions / NAV at period end"), _strings()),
    ]
    source = F.coalesce("a", "t")
    for spec in own:
        newest = F.get(source[spec.key], F.lit(0))
        fact_of = F.struct(source["report_date"].alias("end"), F.lit(None).cast("string").alias("accn"))
        out.append(_row(newest.isNotNull(), spec.key, newest, spec.unit, "html_table", fact_of, {"share_class": cls},
                        F.lit(None).cast("string"), _strings((~newest.between(spec.low, spec.high), "out_of_sane_range"))))
    for years, metric in rules.RETURN_METRICS.items():
        chained = F.expr(
            f"(pow(aggregate(slice(_rets, 1, {years}), 1D, (g, x) -> g * (1 + x.v / 100)), 1D / {years}) - 1) * 100")
        out.append(_row(F.size("_rets") >= years, metric, chained, "pct", "derived", fact("a"),
                        {"return_basis": "chain_linked_annual_total_return", **common},
                        F.lit(f"chain-link {years} stated annual total returns, annualized"), _strings()))
    return _emit(base, out)
