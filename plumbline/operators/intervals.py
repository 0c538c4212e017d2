"""Ledgers of non-overlapping periods, gaps, and sums over contained periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import rules
from plumbline.functions.dates import days_inclusive
from plumbline.operators.groups import first_per_group, last_per_group
from plumbline.session import durable


def overlap_islands(df: DataFrame, keys: Sequence[str], name: str = "island") -> DataFrame:
    """Number the runs of intervals that overlap one another, directly or not.

    Intervals in different islands never interact, so an island, not an entity,
    is the unit the ledger is built on.
    """
    line = Window.partitionBy(*keys).orderBy("start", F.desc("end"))
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))
    return df.withColumn("_opens", opens).withColumn(
        name, F.sum("_opens").over(line.rowsBetween(Window.unboundedPreceding, 0))
    ).drop("_opens")


def _accept_sql(kind: str) -> str:
    """SQL taking spans, shortest first, that overlap none taken before."""
    entry = f"array<struct<start: date, end: date, value: {kind}>>"
    return f"""aggregate(spans, cast(array() as {entry}), (acc, p) ->
        if(exists(acc, a -> a.start <= p.end and p.start <= a.end), acc,
           concat(acc, array(named_struct('start', p.start, 'end', p.end, 'value', p.value)))))"""


def _recover_sql(kind: str, passes: int | None, tolerance: float) -> str:
    """SQL recovering periods from spans that carry their free stretches and what those lack."""
    entry = f"array<struct<start: date, end: date, value: {kind}, parts: bigint>>"
    # What covers p: the runs between its free stretches, and periods recovered before.
    runs = """filter(transform(sequence(0, size(p.free)), i -> named_struct(
        'start', if(i = 0, p.start, date_add(p.free[i - 1].e, 1)),
        'end', if(i = size(p.free), p.end, date_sub(p.free[i].s, 1)))), r -> r.start <= r.end)"""
    # The one uncovered stretch of p, as (cursor, count, first day, last day).
    hole = f"""aggregate(sort_array(concat({runs}, transform(ins, a -> named_struct('start', a.start, 'end', a.end)))),
        named_struct('at', p.start, 'n', 0, 's', p.start, 'e', p.start), (h, a) ->
        named_struct('at', greatest(h.at, date_add(a.end, 1)), 'n', if(a.start > h.at, h.n + 1, h.n),
          's', if(a.start > h.at, h.at, h.s), 'e', if(a.start > h.at, date_sub(a.start, 1), h.e)),
        h -> if(h.at <= p.end, named_struct('n', h.n + 1, 's', h.at, 'e', p.end),
                named_struct('n', h.n, 's', h.s, 'e', h.e)))"""
    rest = f"aggregate(ins, p.rest, (r, a) -> cast(r - a.value as {kind}))"
    small = f"cast(if(abs(r) < {tolerance!r}D, 0, r) as {kind})"
    grow = f"""transform(array({hole}), h -> if(h.n = 1,
        concat(acc, transform(array({rest}), r -> named_struct('start', h.s, 'end', h.e, 'value', {small},
            'parts', p.parts + size(ins)))), acc))[0]"""
    cut = "a.start <= p.end and p.start <= a.end and (a.start < p.start or a.end > p.end)"
    step = f"""(acc, p) -> if(exists(acc, a -> {cut}), acc,
        transform(array(filter(acc, a -> p.start <= a.start and a.end <= p.end)), ins -> {grow})[0])"""
    # Passes go on while one adds a period; a period is added once per span at most.
    most = "size(spans)" if passes is None else str(passes)
    return f"""aggregate(sequence(1, greatest(1, {most})), named_struct('all', cast(array() as {entry}), 'before', -1), (s, k) ->
        if(k > {most} or s.before = size(s.all), s,
           named_struct('all', aggregate(spans, s.all, {step}), 'before', size(s.all))), s -> s.all)"""


def _accepted(unique: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(accepted periods, intervals that hold another one), from distinct intervals.

    An interval that holds another is never accepted: the other one is, or whatever keeps it out
    keeps out both. So only the others are put into islands, where a year over its quarters, or
    a whole history, joins nothing together.
    """
    kind = unique.schema["value"].dataType.simpleString()
    line = Window.partitionBy(*keys).orderBy(F.desc("start"), "end").rowsBetween(Window.unboundedPreceding, -1)
    marked = unique.withColumn("_holds", F.coalesce(F.min("end").over(line) <= F.col("end"), F.lit(False)))
    spans = F.sort_array(F.collect_list(F.struct(
        days_inclusive(F.col("start"), F.col("end")).alias("days"), "start", "end", "value")))
    least = overlap_islands(marked.where("not _holds").drop("_holds"), keys)
    taken = least.groupBy(*keys, "island").agg(spans.alias("spans"))
    accepted = taken.select(*keys, F.expr(f"inline({_accept_sql(kind)})"), F.lit(True).alias("_taken"))
    totals = marked.where("_holds").select(*keys, "start", "end", "value", F.lit(False).alias("_taken"))
    # Both are read several times, so they are written, in one table.
    both = durable(accepted.unionByName(totals))
    return both.where("_taken").drop("_taken"), both.where("not _taken").drop("_taken")


def _uncut(totals: DataFrame, accepted: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals whose ends lie inside no accepted period, by one sweep over a key's days."""
    none = F.lit(None)
    mark = lambda day, kind: totals.select(
        *keys, F.col(day).alias("_d"), F.lit(kind).alias("_kind"), none.cast("date").alias("_a"), "start", "end", "value")
    periods = accepted.select(
        *keys, F.col("start").alias("_d"), F.lit(1).alias("_kind"), F.col("end").alias("_a"),
        none.cast("date").alias("start"), none.cast("date").alias("end"), none.cast(totals.schema["value"].dataType).alias("value"))
    line = Window.partitionBy(*keys).orderBy("_d", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    laid = mark("start", 0).unionByName(periods).unionByName(mark("end", 2)).withColumn("_reach", F.max("_a").over(line))
    cut = F.when(F.col("_kind") == 0, F.col("_reach") >= F.col("_d")).otherwise(F.col("_reach") > F.col("_d"))
    return laid.where("_kind <> 1").groupBy(*keys, "start", "end").agg(
        F.bool_or(F.coalesce(cut, F.lit(False))).alias("_cut"), F.any_value("value").alias("value")).where("not _cut").drop("_cut")


def _own_days(free: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals (start, end) and the first day (_from) of their stretches with a day that no other one reaches.

    The sweep adds up the bounds of the open intervals: where one is open, the sums are its own.
    """
    own = {"start": F.col("start"), "end": F.col("end"), "_from": F.col("_s")}
    both = F.explode(F.array(F.struct(F.col("_s").alias("d"), F.lit(1).alias("sign")),
                             F.struct(F.date_add("_e", 1).alias("d"), F.lit(-1).alias("sign")))).alias("_edge")
    days = free.select(*keys, *[F.unix_date(c).alias(n) for n, c in own.items()], both).groupBy(
        *keys, F.col("_edge.d").alias("_d")).agg(
        F.sum("_edge.sign").alias("_open"), *[F.sum(F.col("_edge.sign") * F.col(c)).alias(c) for c in own])
    line = Window.partitionBy(*keys).orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    alone = days.select(*keys, *[F.sum(c).over(line).alias(c) for c in ("_open", *own)]).where("_open = 1")
    return alone.select(*keys, *[F.date_from_unix_date(F.col(c).cast("int")).alias(c) for c in own])


def _open(free: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals that may come down to one free stretch, with all of theirs.

    Two or more stretches with days that no other interval reaches stay open for ever.
    """
    found = free.unionByName(_own_days(free, keys), allowMissingColumns=True)
    stretch = F.when(F.col("_s").isNotNull(), F.struct(F.col("_s").alias("s"), F.col("_e").alias("e")))
    return found.groupBy(*keys, "start", "end").agg(
        F.any_value("value", True).alias("value"), F.sort_array(F.collect_list(stretch)).alias("free"),
        F.min("_from").alias("_one"), F.max("_from").alias("_other")).where("_one is null or _one = _other").drop("_one", "_other")


def build_ledger(
    facts: DataFrame,
    keys: Sequence[str],
    passes: int | None = None,
    tolerance: float = rules.RESIDUAL_TOLERANCE,
) -> DataFrame:
    """Non-overlapping periods, recovering unreported ones by differencing.

    Shortest intervals are accepted first; a longer one then fills the single
    stretch its accepted parts leave open. Passes over the spans are repeated until
    none recovers a period, or ``passes`` times. Ambiguous totals are dropped.
    Input: keys, start, end, value, ord. Output adds source and parts.

    Intervals meet one another in a row only where the stretches they leave open overlap,
    with those stretches and the sum of what they hold; an interval that can never come down to
    one open stretch, such as a whole history with several holes, meets none.
    """
    keys = list(keys)
    kind = facts.schema["value"].dataType.simpleString()
    clean = facts.where((F.col("end") >= F.col("start")) & F.col("value").isNotNull())
    unique = first_per_group(clean.select(*keys, "start", "end", "value", "ord"), [*keys, "start", "end"], ["ord"])
    accepted, totals = _accepted(unique.drop("ord"), keys)
    by = [*keys, "start", "end"]
    free = durable(_free_stretches(_uncut(totals, accepted, keys), accepted, keys))
    open_ = _open(free, keys)
    # Each holds an accepted period at least; they meet per year.
    held = open_.select(*by, F.explode(F.sequence(F.year("start"), F.year("end"))).alias("_year")).join(
        accepted.select(*keys, F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("value").alias("_v"), F.year("end").alias("_year")),
        [*keys, "_year"]).where("start <= _s and _e <= end").groupBy(*by).agg(F.sum("_v").alias("total"), F.count(F.lit(1)).alias("parts"))
    span = F.struct(days_inclusive(F.col("start"), F.col("end")).alias("days"), "start", "end",
                    (F.col("value") - F.col("total")).cast(kind).alias("rest"), "parts", "free")
    rows = open_.join(held, by).select(
        *keys, span.alias("span"), F.col("free")[0]["s"].alias("start"), F.try_element_at("free", F.lit(-1))["e"].alias("end"))
    grouped = overlap_islands(rows, keys).groupBy(*keys, "island").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    recovered = grouped.select(*keys, F.expr(f"inline({_recover_sql(kind, passes, tolerance)})"))
    return accepted.select(*keys, "start", "end", "value", F.lit("tagged").alias("source"), F.lit(0).alias("parts")).unionByName(
        recovered.select(*keys, "start", "end", "value", F.lit("derived_by_difference").alias("source"), F.col("parts").cast("int")))


#: Days of a bin in which intervals of a key meet.
BIN_DAYS = 366


def _bin(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BIN_DAYS).cast("int")


def interval_gaps(outer: DataFrame, covered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Parts of each of a key's outer intervals that no covered interval reaches."""
    keys = list(keys)
    spans = outer.select(*keys, "start", "end").distinct()
    return _free_stretches(spans, covered, keys).select(*keys, F.col("_s").alias("gap_start"), F.col("_e").alias("gap_end"))


def _free_stretches(outer: DataFrame, covered: DataFrame, keys: list[str]) -> DataFrame:
    """Outer intervals, distinct ones, with each stretch (_s, _e) that no covered interval reaches.

    One sweep over a key's covered days finds its free stretches; outer intervals, however many a
    key has, then meet only the stretches of the time bins they span, each pair once.
    """
    span = outer.withColumnsRenamed({"start": "_from", "end": "_to"}).where("_from <= _to")
    rest = [c for c in span.columns if c not in (*keys, "_from", "_to")]
    bounds = span.groupBy(*keys).agg(F.min("_from").alias("_low"), F.max("_to").alias("_high"))
    # One row per start day: a group is bounded by the calendar.
    daily = covered.where(F.col("start") <= F.col("end")).groupBy(*keys, "start").agg(F.max("end").alias("end"))
    daily = daily.join(bounds, keys).where((F.col("end") >= F.col("_low")) & (F.col("start") <= F.col("_high")))
    # The day behind the last one closes the last stretch, also of a key that nothing covers.
    last = F.date_add("_high", 1)
    line = daily.select(*keys, "start", "end", "_low").unionByName(
        bounds.select(*keys, last.alias("start"), last.alias("end"), "_low"))
    order = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    cursor = F.greatest(F.coalesce(F.date_add(F.max("end").over(order), 1), F.col("_low")), F.col("_low"))
    free = line.withColumn("_cursor", cursor).where(F.col("start") > F.col("_cursor")).select(
        *keys, F.col("_cursor").alias("_s"), F.date_sub("start", 1).alias("_e"))
    binned = lambda df, a, b: df.withColumn("_bin", F.explode(F.sequence(_bin(F.col(a)), _bin(F.col(b)))))
    met = binned(span, "_from", "_to").join(binned(free, "_s", "_e"), [*keys, "_bin"]).where(
        (F.col("_s") <= F.col("_to")) & (F.col("_e") >= F.col("_from"))
        & (F.col("_bin") == F.greatest(_bin(F.col("_s")), _bin(F.col("_from")))))
    return met.select(*keys, F.col("_from").alias("start"), F.col("_to").alias("end"), *rest,
                      F.greatest("_s", "_from").alias("_s"), F.least("_e", "_to").alias("_e"))


def sum_between(ledger: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of ledger periods fully inside each window, and whether it is complete.

    Windows meet the ledger per calendar year they span, never all-to-all.
    """
    keys = list(keys)
    asks = windows.withColumn("_year", F.explode(F.sequence(F.year("window_start"), F.year("window_end"))))
    rows = ledger.select(*keys, "start", "end", "value", F.year("end").alias("_year"))
    inside = asks.join(rows, [*keys, "_year"]).where(
        (F.col("start") >= F.col("window_start")) & (F.col("end") <= F.col("window_end")))
    by = [*keys, "window_start", "window_end"]
    sums = inside.groupBy(*by).agg(
        F.sum("value").alias("total"), F.count(F.lit(1)).alias("n_used"),
        F.sum(days_inclusive(F.col("start"), F.col("end"))).alias("covered"),
    )
    span = days_inclusive(F.col("window_start"), F.col("window_end"))
    return windows.join(sums, by, "left").withColumns({
        "total": F.coalesce(F.col("total"), F.lit(0)),
        "n_used": F.coalesce("n_used", F.lit(0)),
        "complete": F.coalesce(F.col("covered") >= span - rules.COVERAGE_SLACK_DAYS, F.lit(False)),
    }).drop("covered")


def latest_quarter(ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last period of a quarter's length in each ledger."""
    days = days_inclusive(F.col("start"), F.col("end"))
    return last_per_group(ledger.where(days.between(*rules.QUARTER_DAYS)), keys, ["start"])


def steps(series: DataFrame, keys: Sequence[str], value: str, first: bool = False) -> DataFrame:
    """Consecutive observations of a series that has one row per day.

    With ``first`` the first observation stays, without a previous one.
    """
    line = Window.partitionBy(*keys).orderBy("end")
    out = series.withColumns({"prev_end": F.lag("end").over(line), f"prev_{value}": F.lag(value).over(line)})
    return out if first else out.where(F.col("prev_end").isNotNull())


def flows_between(moves: DataFrame, ledger: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ledger amounts falling entirely between consecutive observations.

    Each period is assigned to the next observation at or after its end, and
    counts if it starts after the previous one. Both tables are laid on one line
    per key, so there is one shuffle and no join.
    """
    keys = list(keys)
    rest = [c for c in moves.columns if c not in (*keys, "end", "prev_end")]
    amount = ledger.schema["value"].dataType
    none = lambda kind: F.lit(None).cast(kind)
    carried = F.struct(F.lit(1).alias("_kept"), *rest)
    marks = moves.select(
        *keys, F.col("end").alias("_d"), F.lit(1).alias("_kind"), F.struct("end", "prev_end").alias("_obs"), none("date").alias("start"),
        none(amount).alias("value"), none("string").alias("source"), carried.alias("_m"))
    kind = marks.schema["_m"].dataType
    parts = ledger.select(
        *keys, F.col("end").alias("_d"), F.lit(0).alias("_kind"), none(marks.schema["_obs"].dataType).alias("_obs"), "start",
        F.col("value").cast(amount).alias("value"), "source", none(kind).alias("_m"))
    # Backwards, so that the frame grows: the last observation seen is the next one in time.
    line = Window.partitionBy(*keys).orderBy(F.desc("_d"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    laid = marks.unionByName(parts).withColumn("_next", F.last("_obs", ignorenulls=True).over(line)).where(F.col("_next").isNotNull())
    inside = (F.col("_kind") == 0) & F.coalesce(F.col("start") > F.col("_next.prev_end"), F.lit(False))
    sums = laid.withColumns({"_in": inside, "end": F.col("_next.end")}).groupBy(*keys, "end").agg(
        F.max("_next.prev_end").alias("prev_end"), F.any_value("_m", True).alias("_m"),
        F.sum(F.when(F.col("_in"), F.col("value"))).alias("flow"), F.count_if("_in").alias("n_flows"),
        F.sum(F.when(F.col("_in"), days_inclusive(F.col("start"), F.col("_d")))).alias("_covered"),
        F.count_if(F.col("_in") & (F.col("source") != "tagged")).alias("n_derived"),
    )
    gap = F.date_diff("end", "prev_end")
    return sums.select(
        *keys, "end", "prev_end", *[F.col(f"_m.{c}").alias(c) for c in rest],
        F.coalesce(F.col("flow"), F.lit(0)).alias("flow"), "n_flows", "n_derived",
        F.coalesce(F.col("_covered") >= gap - rules.COVERAGE_SLACK_DAYS, F.lit(False)).alias("flow_complete"))
