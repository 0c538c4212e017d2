"""Which evidence may be used at a reporting anchor, and why keys end up empty."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import rules
from plumbline.functions import scoring
from plumbline.metrics import MetricSpec
from plumbline.operators.groups import first_per_group, top_k


def covers(period_col: str = "period_end") -> Column:
    return F.coalesce(F.col("as_of"), F.col(period_col))


def at_anchors(df: DataFrame, anchors: Sequence[date], column: str = "anchor") -> DataFrame:
    """One copy of each row per reporting anchor (a short list given by the caller)."""
    literals = F.array(*[F.lit(a) for a in anchors])
    return df.withColumn(column, F.explode(literals))


def eligible(cands: DataFrame, anchor: Column) -> DataFrame:
    """Rows whose period closed on or before the anchor; undated rows drop out."""
    return cands.where(covers() <= anchor)


def excluded_notices(cands: DataFrame, keys: Sequence[str], anchor: Column) -> DataFrame:
    """A notice for every key that lost all of its rows to the anchor.

    One aggregate decides it: a key is explained when none of its rows is
    eligible, so no anti-join of the two row sets is needed.
    """
    keys = list(keys)
    ok = F.coalesce(covers() <= anchor, F.lit(False))
    out = cands.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_excluded"),
        F.count_if(ok).alias("_kept"),
        F.min(covers()).alias("as_of"),
        F.max(anchor).alias("_anchor"),
    ).where(F.col("_kept") == 0)
    when = F.col("_anchor").cast("string")
    return out.select(
        *keys,
        F.lit("no_candidate").alias("reason"),
        F.concat(F.lit("every figure found is for a later period than "), when).alias("detail"),
        "as_of",
        F.concat(
            F.col("n_excluded").cast("string"),
            F.lit(" left out as too late; the first period ends "),
            F.coalesce(F.col("as_of").cast("string"), F.lit("on an unknown day")),
        ).alias("internal_note"),
        "n_excluded",
    )


def unusable_notices(cands: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A notice for every key none of whose rows carries a number, with their count."""
    number = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    out = cands.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_excluded"), F.count_if(number).alias("_good"), F.max(covers()).alias("as_of"))
    return out.where("_good = 0").select(
        *keys, F.lit("no_candidate").alias("reason"),
        F.concat(F.col("n_excluded").cast("string"), F.lit(" source(s) state no usable number")).alias("detail"),
        "as_of", "n_excluded")


def anchor_notices(cands: DataFrame, anchors: Sequence[date]) -> DataFrame:
    """Notices of every anchor for keys whose rows are all too late, and for keys without a number.

    One aggregate over the candidates as they are counts rows and numbers and finds the first
    period; only its one row per key meets the anchors.
    """
    number = F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double"))
    sums = at_anchors(cands.groupBy("entity", "metric").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(number).alias("good"), F.min(covers()).alias("first"),
        F.max(covers()).alias("last")), anchors)
    late = F.when(F.coalesce(F.col("first") > F.col("anchor"), F.lit(True)), F.struct(
        F.concat(F.lit("every figure found is for a later period than "), F.col("anchor").cast("string")).alias("detail"),
        F.col("first").alias("as_of"), F.lit(1 << 62).alias("ord")))
    blank = F.when(F.col("good") == 0, F.struct(
        F.concat(F.col("n").cast("string"), F.lit(" source(s) state no usable number")).alias("detail"),
        F.col("last").alias("as_of"), F.lit((1 << 62) + 1).alias("ord")))
    # Both leave one pass: two filters over the sums would work them out twice.
    said = sums.select("anchor", "entity", "metric", F.explode(F.array_compact(F.array(late, blank))).alias("_n"))
    return said.select("anchor", "entity", "metric", F.lit("no_candidate").alias("reason"), "_n.*")


def first_notices(notices: DataFrame, keys: Sequence[str], ord_col: str = "ord") -> DataFrame:
    """The earliest notice per key: sources report their specific diagnosis first."""
    return first_per_group(notices, keys, [ord_col])


def with_notices(grid: DataFrame, notices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the notice of each key, or the default reason where there is none."""
    joined = grid.join(notices, list(keys), "left")
    return joined.withColumn("reason", F.coalesce("reason", F.lit("no_candidate"))).withColumn(
        "detail", F.coalesce("detail", F.lit("no candidate value found in any source"))
    )


def flag_ranges(cands: DataFrame, metrics: DataFrame) -> DataFrame:
    """Mark, never drop, values outside the plausible range of their metric."""
    dim = metrics.select("metric", "low", "high")
    outside = scoring.out_of_range(F.col("value"), F.col("low"), F.col("high"))
    flags = scoring.add_flag(F.col("flags"), rules.OUT_OF_RANGE_FLAG, outside)
    return cands.join(dim, "metric", "left").withColumn("flags", flags).drop("low", "high")


def in_scope() -> Column:
    """Metric listed for the entity, or custom and allowed for its type."""
    listed = F.array_contains("supported_metrics", F.col("metric"))
    open_type = (F.size("entity_types") == 0) | F.array_contains("entity_types", F.col("entity_type"))
    return listed | (F.col("custom") & open_type)


def dense_grid(entities: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """Every entity with every metric, and whether the pair is in scope.

    The metric registry is configuration, so it is exploded inside each entity
    row; there is no join.
    """
    registry = F.array(*[
        F.struct(
            F.lit(s.key).alias("metric"), F.lit(s.unit).alias("unit"),
            F.lit(s.direction).alias("direction"), F.lit(s.custom).alias("custom"),
            F.array(*[F.lit(t) for t in s.entity_types]).cast("array<string>").alias("entity_types"),
        )
        for s in specs
    ])
    return (
        entities.withColumn("_m", F.explode(registry))
        .select(*entities.columns, "_m.*")
        .withColumn("in_scope", in_scope())
        .drop("custom", "entity_types")
    )


def terms_documents(filings: DataFrame, anchor: Column, per_form: int = 1) -> DataFrame:
    """Newest filings per entity and form *filed* on or before the anchor."""
    order = [F.col("filing_date").desc(), F.col("accession").desc()]
    return top_k(filings.where(F.col("filing_date") <= anchor), ["entity", "form"], order, per_form)


def period_documents(filings: DataFrame, forms: Sequence[str], anchor: Column) -> DataFrame:
    """The filing of each entity whose report date is latest at the anchor."""
    rows = filings.where(F.col("form").isin(list(forms)) & (F.col("report_date") <= anchor))
    order = [F.desc("report_date"), F.col("accession")]
    return top_k(rows, ["entity"], order, 1).drop("rn")


def latest_reports(filings: DataFrame, anchor: Column, k: int) -> DataFrame:
    """The newest ``k`` reports per entity and form, chosen after the anchor filter."""
    order = [F.desc("report_date"), F.desc("filing_date"), F.desc("accession")]
    return top_k(filings.where(F.col("report_date") <= anchor), ["entity", "form"], order, k)


def amendment_clock(filings: DataFrame, entities: DataFrame, anchor: Column, amendable=None) -> DataFrame:
    """Latest filing per entity that could have amended its contractual terms."""
    table = amendable or rules.AMENDABLE_FORMS
    allowed = F.lit(False)
    for entity_type, forms in table.items():
        allowed = allowed | ((F.col("entity_type") == entity_type) & F.col("form").isin(list(forms)))
    rank = F.lit(0)
    for entity_type, forms in table.items():
        for position, form in enumerate(forms):
            rank = F.when((F.col("entity_type") == entity_type) & (F.col("form") == form),
                          F.lit(position)).otherwise(rank)
    # Reduce to one row per entity and form before meeting the entity table.
    newest = filings.where(F.col("filing_date") <= anchor).groupBy("entity", "form").agg(
        F.max("filing_date").alias("terms_clock")
    )
    rows = newest.join(entities.select("entity", "entity_type"), "entity").where(allowed)
    # Among equally late filings the form listed first wins.
    return rows.groupBy("entity").agg(
        F.max("terms_clock").alias("clock"),
        F.max_by("form", F.struct(F.col("terms_clock"), (-rank).alias("r"))).alias("clock_form"),
    )


def apply_terms_clock(cands: DataFrame, clocks: DataFrame, terms_metrics: Sequence[str]) -> DataFrame:
    """Extend the staleness clock of contractual rates, never shorten it."""
    joined = cands.join(clocks, "entity", "left")
    extends = (
        F.col("metric").isin(list(terms_metrics))
        & F.col("clock").isNotNull()
        & (F.col("as_of").isNull() | (F.col("clock") > F.col("as_of")))
    )
    lapsed = extends & F.coalesce(
        F.date_diff("clock", "as_of") > rules.STALE_LIMIT_DAYS, F.lit(False)
    )
    note = F.concat(
        F.lit("staleness measured to "), F.col("clock").cast("string"), F.lit(" ("),
        F.col("clock_form"), F.lit(", no amendment disclosed)"),
    )
    return (
        joined.withColumn("flags", F.when(lapsed, F.array_append("flags", F.lit("rate_not_restated_within_window")))
                          .otherwise(F.col("flags")))
        .withColumn("transforms", F.when(extends, F.array_append("transforms", note)).otherwise(F.col("transforms")))
        .withColumn("terms_clock", F.when(extends, F.col("clock")).otherwise(F.col("terms_clock")))
        .drop("clock", "clock_form")
    )
