"""Whole reconciliations over a dense grid, for one anchor or many."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import rules
from plumbline.metrics import MetricSpec, metric_frame
from plumbline.operators import eligibility
from plumbline.operators.resolve import resolve

RESULT = ["value", "chosen_value", "unit", "confidence", "score", "reason", "detail", "as_of", "tier", "form",
          "accession", "period_end", "locator", "basis", "basis_key", "chosen_ord", "n_agree", "n_disagree",
          "n_clusters", "n_bases", "n_candidates", "spread_pct", "conflict"]


def reconcile_grid(
    cands: DataFrame,
    entities: DataFrame,
    specs: Sequence[MetricSpec],
    ref: Column,
    notices: DataFrame | None = None,
    zero_rule: tuple[str, str] | None = ("incentive_fee_pct", "incentive_hurdle_pct"),
    anchors: Sequence[date] | None = None,
    strict_independence: bool = False,
) -> DataFrame:
    """One row per entity and metric: a value, or the reason it is blank.

    Scope comes first: a metric an entity does not report is not applicable,
    whatever was extracted for it. ``zero_rule`` names a fee and its hurdle: an
    entity that charges no fee has no hurdle. With ``anchors`` every anchor is reconciled
    in the same job, on the rows whose period it does not precede, and the result has an
    ``anchor`` column.
    """
    keys = ["entity", "metric"] if anchors is None else ["anchor", "entity", "metric"]
    spark = cands.sparkSession
    grid = eligibility.dense_grid(entities, specs)
    if anchors is not None:
        grid = eligibility.at_anchors(grid, anchors)
    found = resolve(cands, entities, metric_frame(spark, specs), ref, keys, anchors=anchors,
                    strict_independence=strict_independence)
    out = grid.join(found.select(*keys, *[c for c in RESULT if c != "unit"]), keys, "left")
    missing = F.col("score").isNull()
    if notices is not None:
        side = notices.select(*keys, F.col("reason").alias("_nr"), F.col("detail").alias("_nd"),
                              F.col("as_of").alias("_na"))
        out = out.join(side, keys, "left")
    else:
        out = out.withColumns({"_nr": F.lit(None).cast("string"), "_nd": F.lit(None).cast("string"),
                               "_na": F.lit(None).cast("date")})
    kind = F.replace("entity_type", F.lit("_"), F.lit(" "))
    beyond = F.concat(F.lit("out of scope for a "), kind, F.lit("; nothing similar is put in its place"))
    outside = ~F.col("in_scope")
    out = out.withColumns({
        "reason": F.when(outside, F.lit("not_applicable")).when(
            missing, F.coalesce("_nr", F.lit("no_candidate"))).otherwise(F.col("reason")),
        "detail": F.when(outside, beyond).when(
            missing, F.coalesce("_nd", F.lit("no candidate value found in any source"))).otherwise(F.col("detail")),
        "as_of": F.when(outside, F.lit(None)).when(missing, F.col("_na")).otherwise(F.col("as_of")),
        "value": F.when(~outside, F.col("value")),
        "chosen_ord": F.when(~outside, F.col("chosen_ord")),
        "confidence": F.when(outside | missing, F.lit(rules.SUPPRESSED)).otherwise(F.col("confidence")),
        "score": F.when(outside | missing, F.lit(0.0)).otherwise(F.col("score")),
    }).drop("_nr", "_nd", "_na")
    if zero_rule is None:
        return out
    fee, hurdle = zero_rule
    # A window group is one entity's metrics, so it is as small as the registry.
    rows = Window.partitionBy(*[k for k in keys if k != "metric"])
    no_fee = F.max(F.when((F.col("metric") == fee) & (F.col("value") == 0.0), F.lit(1))).over(rows)
    void = (F.col("metric") == hurdle) & F.col("value").isNull() & no_fee.isNotNull()
    return out.withColumn("_void", void).withColumns({
        "reason": F.when(F.col("_void"), F.lit("not_applicable")).otherwise(F.col("reason")),
        "detail": F.when(F.col("_void"), F.lit("void, since the fee it belongs to is zero"))
        .otherwise(F.col("detail")),
        "chosen_ord": F.when(~F.col("_void"), F.col("chosen_ord")),
        "score": F.when(F.col("_void"), F.lit(0.0)).otherwise(F.col("score")),
        "as_of": F.when(~F.col("_void"), F.col("as_of")),
    }).drop("_void")


def benchmark_run(
    cands: DataFrame,
    entities: DataFrame,
    specs: Sequence[MetricSpec],
    anchors: Sequence[date],
    notices: DataFrame | None = None,
    zero_rule: tuple[str, str] | None = ("incentive_fee_pct", "incentive_hurdle_pct"),
    strict_independence: bool = False,
) -> DataFrame:
    """The full run for every anchor: eligibility, explanations, reconciliation.

    ``notices`` are extraction notices (entity, metric, reason, detail, as_of,
    ord); they outrank the explanations that all figures are for a later period
    or that none is a number.
    """
    keys = ["anchor", "entity", "metric"]
    said = eligibility.anchor_notices(cands, anchors)
    if notices is not None:
        told = eligibility.at_anchors(notices, anchors)
        said = said.unionByName(told.select(*said.columns))
    first = eligibility.first_notices(said, keys)
    return reconcile_grid(cands, entities, specs, F.col("anchor"), first, zero_rule, anchors, strict_independence)
