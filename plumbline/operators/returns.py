"""Period returns, chain-linked trailing returns, bands and cadence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import rules
from plumbline.functions import dates
from plumbline.operators.asof import latest_restatement
from plumbline.operators.intervals import flows_between, steps


def month_unpivot(reports: DataFrame, columns: Sequence[str] = ("rtn1", "rtn2", "rtn3")) -> DataFrame:
    """Monthly return columns to rows, oldest first, the last on the report date."""
    n = len(columns)
    values = F.array(*[F.col(c).cast("double") for c in columns])
    keep = [c for c in reports.columns if c not in columns]
    long = reports.select(*keep, F.posexplode(values).alias("_i", "ret")).where(F.col("ret").isNotNull())
    back = F.lit(n - 1) - F.col("_i")
    month_end = F.when(back == 0, F.col("period_end")).otherwise(
        F.last_day(F.add_months("period_end", -back)))
    return long.withColumn("month_end", month_end).drop("_i")


def chain_returns(monthly: DataFrame, keys: Sequence[str], years: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Trailing returns over the last 12, 36, 60 contiguous months.

    A group holds one row per month (restatements already resolved), so its
    months fit in one short array.
    """
    months = F.sort_array(F.collect_list(F.struct(
        dates.month_index(F.col("month_end")).alias("m"), "month_end", "ret"))).alias("months")
    grouped = monthly.groupBy(*keys).agg(months)
    spans = F.expr("explode(array(" + ",".join(str(y) for y in years) + "))").alias("years")
    cut = "slice(months, size(months) - 12 * years + 1, 12 * years)"
    return grouped.select(*keys, "months", spans).selectExpr(
        *keys, "years", "cast(size(months) as bigint) as n_months",
        "months[0].month_end as coverage_start", "element_at(months, -1).month_end as coverage_end",
        f"""case when size(months) >= 12 * years
            and element_at(months, -1).m - months[size(months) - 12 * years].m = 12 * years - 1 then
            (pow(aggregate({cut}, 1D, (g, x) -> g * (1 + x.ret / 100)), 1D / years) - 1) * 100 end as ret""",
    )


def return_bands(trailing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Low and high trailing return across two or more unnamed class series."""
    return trailing.where(F.col("ret").isNotNull()).groupBy(*keys, "years").agg(
        F.min("ret").alias("low"), F.max("ret").alias("high"), F.count(F.lit(1)).alias("n_classes")
    ).where(F.col("n_classes") >= 2)


def in_band(value: Column, low: Column, high: Column, slack: float = rules.BAND_SLACK) -> Column:
    return value.between(low - slack, high + slack)


def monthly_trailing(monthly: DataFrame, years: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Trailing returns per entity, or the reason there is none.

    ``monthly`` has entity, share_class, month_end, ret, filed, ord. Several
    unnamed class series cannot be attributed: the entity gets a reason and a
    band instead of a value.
    """
    one = latest_restatement(monthly, ["entity", "share_class", "month_end"])
    trailing = chain_returns(one, ["entity", "share_class"], years)
    # First a row per series, then per entity: each step is a short aggregate.
    out = trailing.groupBy("entity", "years").agg(
        F.count(F.lit(1)).alias("n_series"), F.max("ret").alias("_one"), F.max("n_months").alias("n_months"),
        F.min("coverage_start").alias("coverage_start"), F.max("coverage_end").alias("coverage_end"),
        F.count("ret").alias("n_classes"), F.min("ret").alias("low"), F.max("ret").alias("high"),
    )
    several = F.col("n_series") > 1
    banded = several & (F.col("n_classes") >= 2)
    return out.select(
        "entity", "years", "n_series", "n_months", "coverage_start", "coverage_end",
        F.when(~several, F.col("_one")).alias("value"),
        F.when(several, F.lit("class_attribution_failed")).when(F.col("_one").isNull(), F.lit("insufficient_history"))
        .alias("reason"),
        F.when(banded, F.col("low")).alias("low"), F.when(banded, F.col("high")).alias("high"),
    )


def period_returns(
    series: DataFrame, ledger: DataFrame, keys: Sequence[str], value: str = "nav", first: bool = False
) -> DataFrame:
    """(current - previous + flows) / previous for consecutive observations.

    With ``first`` the first observation stays, without a return.
    """
    moves = flows_between(steps(series, keys, value, first), ledger, keys)
    change = (F.col(value) - F.col(f"prev_{value}") + F.col("flow").cast("double")) / F.col(f"prev_{value}")
    return moves.withColumns({
        "period_return": F.when(F.col(f"prev_{value}") > 0, change),
        "gap_days": F.date_diff("end", "prev_end"),
    })


def contiguous_run(series: DataFrame, keys: Sequence[str], max_gap: int = rules.MAX_GAP_DAYS) -> DataFrame:
    """Start and end of the last run of observations without a long gap."""
    line = Window.partitionBy(*keys).orderBy("end")
    gap = F.date_diff("end", F.lag("end").over(line))
    starts = F.when(F.coalesce(gap, F.lit(max_gap + 1)) > max_gap, F.col("end"))
    return series.withColumn("_start", starts).groupBy(*keys).agg(
        F.max("_start").alias("run_start"), F.max("end").alias("run_end"), F.count(F.lit(1)).alias("n_obs"))


def trailing_total_returns(
    series: DataFrame, ledger: DataFrame, keys: Sequence[str], years: Sequence[int] = (1, 3, 5)
) -> DataFrame:
    """Annualised total return over trailing windows, or a typed reason.

    The window starts at the observation nearest its target date and must lie
    within the published tolerance; longer gaps, missing flows and recovered
    flows are carried as flags.
    """
    keys = list(keys)
    moves = period_returns(series, ledger, keys, first=True)
    step = F.when(F.col("prev_end").isNotNull(), F.struct(
        "end", "prev_end", "prev_nav", "period_return", "gap_days", "flow_complete", "n_derived"))
    opens = F.coalesce("gap_days", F.lit(rules.MAX_GAP_DAYS + 1)) > rules.MAX_GAP_DAYS
    # Flows, run and path all rest on the one partitioning by key.
    run = moves.groupBy(*keys).agg(
        F.max(F.when(opens, F.col("end"))).alias("run_start"), F.max("end").alias("run_end"),
        F.count(F.lit(1)).alias("n_obs"), F.sort_array(F.collect_list(step)).alias("path"))
    tolerance = "map(" + ",".join(f"{y},{d}" for y, d in rules.WINDOW_TOLERANCE_DAYS.items()) + ")"
    span = "map(" + ",".join(f"{y},{round(rules.YEAR_DAYS * y)}" for y in rules.WINDOW_TOLERANCE_DAYS) + ")"
    asked = run.withColumn("path", F.when(F.size("path") > 0, F.col("path"))).withColumn(
        "years", F.expr("explode(array(" + ",".join(str(y) for y in years) + "))"))
    anchored = asked.withColumn("target", F.expr(f"date_sub(run_end, {span}[years])")).withColumn(
        "anchor", F.expr("""array_min(transform(path, s ->
            named_struct('drift', abs(datediff(s.prev_end, target)), 'at', s.prev_end)))"""))
    inside = anchored.withColumn("win", F.expr("filter(path, s -> s.prev_end >= anchor.at)"))
    elapsed = "datediff(run_end, anchor.at)"
    growth = "aggregate(win, 1D, (g, s) -> g * (s.period_return + 1))"
    return inside.selectExpr(
        *keys, "years", "n_obs", "run_start", "run_end", "target", "anchor.at as window_start", "anchor.drift as drift",
        f"""case when n_obs < 3 then 'insufficient_history'
            when anchor.drift > {tolerance}[years] then 'window_mismatch' end as reason""",
        "win", f"{elapsed} as elapsed",
    ).withColumn("value", F.expr(f"""case when reason is null and elapsed > 0 and forall(win, s -> s.prev_nav > 0)
            then (pow({growth}, {rules.YEAR_DAYS}D / elapsed) - 1) * 100 end""")).withColumns({
        "max_gap": F.expr("array_max(win.gap_days)"),
        "n_incomplete": F.expr("cast(size(filter(win, s -> not s.flow_complete)) as bigint)"),
        "n_derived": F.expr("aggregate(win, 0L, (n, s) -> n + s.n_derived)"),
    }).withColumn("flags", F.expr(f"""if(value is null, cast(array() as array<string>), concat(
            transform(filter(win, s -> not s.flow_complete),
                s -> concat('incomplete_distributions_', s.prev_end, '..', s.end)),
            if(max_gap > {rules.MAX_GAP_DAYS}, array(concat('nav_history_gap_', max_gap, 'd')), array()),
            if(n_derived > 0, array(concat(n_derived, '_distribution_periods_derived')), array())))""")).drop("win")


def semiannual_cadence(series: DataFrame, entities: DataFrame, anchor: Column, quarters: int = 8) -> DataFrame:
    """Observations at an entity's two fiscal months within the trailing window."""
    months = entities.select("entity", dates.fiscal_month(F.col("fiscal_year_end")).alias("_m1"),
                             dates.other_fiscal_month(F.col("fiscal_year_end")).alias("_m2"))
    earliest = F.add_months(anchor, -12 * (quarters // 4))
    return series.where(F.col("end").between(earliest, anchor)).join(months, "entity").where(
        F.month("end").isin(F.col("_m1"), F.col("_m2"))).drop("_m1", "_m2")
