"""Point-in-time lookups: latest at a date, nearest to a date, first by preference.

Facts are reduced to one row per entity and day before anything is ordered, so
the ordered part of a group is bounded by the calendar, not by its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.operators.groups import first_per_group, last_per_group


def fact_order(df: DataFrame) -> list[str]:
    return [c for c in ("end", "start", "accn", "ord") if c in df.columns]


def as_of(facts: DataFrame, keys: Sequence[str], anchor: Column) -> DataFrame:
    """Latest fact per key whose period closed on or before the anchor."""
    return last_per_group(facts.where(F.col("end") <= anchor), keys, fact_order(facts))


def as_of_many(points: DataFrame, facts: DataFrame, key: str, at: str, payload: Sequence[str]) -> DataFrame:
    """For every point, the latest fact of its key at the point's own date.

    Works on the distinct (key, date) pairs and joins the answer back.
    """
    order = [c for c in fact_order(facts) if c != "end"]
    daily = last_per_group(facts, [key, "end"], order)
    found = F.struct(F.col("end"), *payload)
    marks = daily.select(key, F.col("end").alias("_d"), F.lit(0).alias("_kind"), found.alias("_fact"))
    asks = points.select(key, F.col(at).alias("_d")).distinct().select(
        key, "_d", F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema["_fact"].dataType).alias("_fact")
    )
    line = Window.partitionBy(key).orderBy("_d", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    answered = (
        marks.unionByName(asks)
        .withColumn("_fact", F.last("_fact", ignorenulls=True).over(line))
        .where(F.col("_kind") == 1)
        .select(key, F.col("_d").alias(at), "_fact.*")
    )
    return points.join(answered, [key, at], "left")


def nearest(
    points: DataFrame, facts: DataFrame, key: str, at: str, payload: Sequence[str], tolerance: int = 5
) -> DataFrame:
    """The fact closest to each point's date, at most ``tolerance`` days away.

    Equal distance goes to the earlier filed fact. Both sides meet in date
    buckets as wide as the tolerance, so a pair is only formed when it is near.
    """
    width = max(tolerance, 1)
    daily = first_per_group(facts, [key, "end"], [F.coalesce("filed", F.lit("9999-12-31").cast("date")), F.col("ord")])
    bucket = F.floor(F.unix_date("end") / width)
    placed = daily.select(
        key, "end", "filed", "ord", *payload,
        F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_bucket"),
    )
    asks = points.select(key, at).distinct().withColumn("_bucket", F.floor(F.unix_date(F.col(at)) / width))
    delta = F.abs(F.date_diff("end", F.col(at)))
    hits = asks.join(placed, [key, "_bucket"]).withColumn("delta", delta).where(F.col("delta") <= tolerance)
    best = first_per_group(
        hits.drop("_bucket"), [key, at],
        [F.col("delta"), F.coalesce("filed", F.lit("9999-12-31").cast("date")), F.col("ord")],
    )
    return points.join(best.drop("filed", "ord"), [key, at], "left")


def preferred_tag(facts: DataFrame, tags: Sequence[str], anchor: Column) -> DataFrame:
    """Per entity, the as-of fact of the first listed tag that has one."""
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    latest = as_of(facts.where(F.col("tag").isin(list(tags))), ["entity", "tag"], anchor)
    return first_per_group(latest.withColumn("rank", rank), ["entity"], ["rank"])


def tag_as_of(tag: str, value: str = "val") -> Column:
    """Aggregate: the latest (end, ..., value) of one tag within a group."""
    return F.max(F.when(F.col("tag") == tag, F.struct("end", "accn", "ord", F.col(value).alias("val"))))


def matched_ratio(facts: DataFrame, numerator: str, denominator: str, anchor: Column) -> DataFrame:
    """Ratio of two tags per entity, only where both end on the same day."""
    both = facts.where(F.col("end") <= anchor).groupBy("entity").agg(
        tag_as_of(numerator).alias("a"), tag_as_of(denominator).alias("b")
    )
    return both.where((F.col("a.end") == F.col("b.end")) & (F.col("b.val") != 0)).select(
        "entity", F.col("a.end").alias("end"), F.col("a.val").alias("numerator"),
        F.col("b.val").alias("denominator"), (F.col("a.val") / F.col("b.val")).alias("ratio"),
    )


def original_filing(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One fact per key: the earliest filed, which is the original; an undated one only if no other is there."""
    return first_per_group(facts, keys, [F.coalesce("filed", F.lit("9999-12-31").cast("date")), "ord"])


def latest_restatement(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One fact per key: the last filed, which is the filer's newest view."""
    return last_per_group(facts, keys, ["filed", "ord"])


def period_shape(
    facts: DataFrame,
    instant: bool | None = None,
    min_days: int | None = None,
    max_days: int | None = None,
    unit: str | None = None,
) -> DataFrame:
    """Keep facts of one period shape; durations count end minus start."""
    out = facts
    if unit is not None:
        out = out.where(F.col("unit") == unit)
    if instant is not None:
        out = out.where(F.col("start").isNull() if instant else F.col("start").isNotNull())
    days = F.date_diff("end", "start")
    if min_days is not None:
        out = out.where(days >= min_days)
    if max_days is not None:
        out = out.where(days <= max_days)
    return out


def perimeter_ratio(facts: DataFrame, keys: Sequence[str], parts: dict[str, Sequence[str]]) -> DataFrame:
    """Leverage on a ruled perimeter; a ratio is NULL if any part is missing.

    ``parts`` lists tags under recourse (all required), liabilities,
    securitisation and equity (first reported tag wins). ``keys`` includes the
    balance-sheet date, so periods are never mixed.
    """
    tags = [t for names in parts.values() for t in names]
    row = facts.where(F.col("tag").isin(tags)).groupBy(*keys).agg(*[
        F.min(F.when(F.col("tag") == t, F.struct("ord", "val"))).alias(f"t{i}") for i, t in enumerate(tags)
    ])
    at = {t: F.col(f"t{i}.val") for i, t in enumerate(tags)}
    pick = lambda names: F.coalesce(*[at[t] for t in names])
    recourse = None
    for t in parts["recourse"]:
        recourse = at[t] if recourse is None else recourse + at[t]
    equity = pick(parts["equity"])
    return row.where(equity.isNotNull() & (equity != 0)).select(
        *keys, (recourse / equity).alias("regulatory"),
        ((pick(parts["liabilities"]) - pick(parts["securitisation"])) / equity).alias("economic"),
    )
