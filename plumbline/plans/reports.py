"""Board cells, coverage, audit, peer comparison, trend and run-over-run diff."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from plumbline import rules
from plumbline.functions import scoring, text
from plumbline.operators.asof import latest_restatement
from plumbline.operators.groups import modal_first, order_statistics, value_ranks
from plumbline.operators.returns import semiannual_cadence
from plumbline.session import durable


def violates_class(basis: Column, class_metrics: Sequence[str]) -> Column:
    """A closed-end fund's return row may not show a fund-level figure."""
    return (
        (F.col("entity_type") == "interval_fund") & F.col("metric").isin(list(class_metrics))
        & F.contains(F.lower(basis), F.lit("fund level"))
    )


def cells(
    grid: DataFrame,
    by: Sequence[str] = (),
    class_metrics: Sequence[str] = rules.CLASS_REQUIRED_METRICS,
    class_note: str = "not a figure of the wanted share class",
) -> DataFrame:
    """Render units: a value with its basis, or a blank with its reason code.

    ``class_note`` is said, behind the basis, where a figure of another share class is
    withheld. The reference basis of a metric is the one most entities share, ties going
    to the entity listed first; ``by`` adds columns such as the anchor.
    """
    rows = grid.withColumn("basis_text", F.when(F.col("value").isNotNull(), text.format_basis(F.col("basis"))))
    valued = rows.where(F.col("value").isNotNull())
    group = [*by, "metric"]
    reference = modal_first(valued, group, "basis_text", "entity_ord").select(
        *group, F.col("modal").alias("reference_basis"))
    # One row per metric and anchor: as small as the registry.
    joined = rows.join(reference, group, "left")
    wrong = F.coalesce(F.col("value").isNotNull() & violates_class(F.col("basis_text"), class_metrics), F.lit(False))
    return joined.withColumn("_wrong", wrong).withColumns({
        "reason": F.when(F.col("_wrong"), F.lit("wrong_share_class")).otherwise(F.col("reason")),
        "detail": F.when(F.col("_wrong"), F.concat(
            "basis_text", F.lit(f"; {class_note}"))).otherwise(F.col("detail")),
        "value": F.when(~F.col("_wrong"), F.col("value")),
        "confidence": F.when(~F.col("_wrong") & F.col("value").isNotNull(), F.col("confidence")),
        "basis_text": F.when(~F.col("_wrong"), F.col("basis_text")),
    }).withColumns({
        "reason_code": scoring.lookup(F.col("reason"), rules.REASON_CODES),
        "divergent": F.coalesce(F.col("value").isNotNull() & (F.col("basis_text") != F.col("reference_basis")), F.lit(False)),
    }).withColumn("label", scoring.lookup(F.col("reason_code"), rules.REASON_LABELS)).drop("_wrong")


def promote_pending(blank: DataFrame, windows: DataFrame) -> DataFrame:
    """"No value" becomes "not yet filed" only where a pending period is known.

    ``windows`` has one row per entity with a pending period: entity, window.
    """
    joined = blank.join(windows.select("entity", F.col("window").alias("_w")), "entity", "left")
    due = (
        (F.col("reason_code") == "no_value_found") & F.col("_w").isNotNull()
        & (F.col("entity_type") == "interval_fund")
    )
    return joined.withColumns({
        "reason_code": F.when(due, F.lit("not_yet_filed")).otherwise(F.col("reason_code")),
        "detail": F.when(due, F.col("_w")).otherwise(F.col("detail")),
    }).drop("_w")


def board(cell_rows: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Wide table: one row per entity, one column per registered metric."""
    return cell_rows.groupBy(*by, "entity").pivot("metric", list(metrics)).agg(F.max("value"))


def sparse_entities(cell_rows: DataFrame, most: int = 1) -> DataFrame:
    """Entities with at most ``most`` populated cells leave the main table."""
    return cell_rows.groupBy("entity").agg(F.count("value").alias("n_populated")).withColumn(
        "demoted", F.col("n_populated") <= most)


def coverage(cell_rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Status and owner of every cell as the board shows it."""
    filled = F.col("value").isNotNull()
    return cell_rows.select(
        *by, "entity", "metric",
        F.when(filled, F.lit("FILLED")).otherwise(F.col("reason")).alias("status"),
        F.when(filled, F.lit("-")).otherwise(scoring.lookup(F.col("reason"), rules.GAP_OWNERS, "OURS")).alias("owner"),
        F.when(filled, F.concat(text.significant(F.col("value")), F.lit(" "), F.col("unit"))).alias("detail"),
        F.when(filled, F.col("confidence")).alias("confidence"),
        "value",
    )


def coverage_rollup(rows: DataFrame) -> DataFrame:
    """Cells per owner bucket and per grade, with totals."""
    bucket = F.when(F.col("status") == "FILLED", F.lit("FILLED")).otherwise(F.col("owner"))
    return rows.withColumn("bucket", bucket).rollup("bucket", "confidence").agg(F.count(F.lit(1)).alias("cells"))


def audit(cands: DataFrame, grid: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every candidate with its outcome, plus a row for keys that had none."""
    keys = [*by, "entity", "metric"]
    # The run is read twice below, so what is read of it is written first.
    grid = durable(grid.select(*keys, "chosen_ord", "value", "unit", "confidence", "score", "n_candidates"))
    side = grid.select(*keys, "chosen_ord", F.col("value").alias("_value"), F.col("confidence").alias("_conf"),
                       F.col("score").alias("_score"), F.col("n_candidates").alias("_n"))
    mine = F.coalesce(F.col("ord") == F.col("chosen_ord"), F.lit(False))
    kept = cands.select(*keys, "value", "unit", "tier", text.basis_key(F.col("basis")).alias("basis_key"),
                        "as_of", "form", "accession", "locator", F.array_join("flags", "; ").alias("flags"), "ord")
    rows = kept.join(side, keys).select(
        *keys, "value", "unit", "tier", "basis_key", "as_of", "form", "accession", "locator", "flags",
        F.when(mine & F.col("_value").isNotNull(), F.lit("reported")).when(mine, F.lit("resolved_then_suppressed"))
        .otherwise(F.lit("rejected")).alias("outcome"),
        F.when(mine, F.col("_conf")).alias("confidence"), F.when(mine, F.col("_score")).alias("score"),
    )
    absent = grid.where(F.col("n_candidates").isNull()).select(
        *keys, F.lit("no_candidate").alias("outcome"), "unit", "confidence", "score")
    return rows.unionByName(absent, allowMissingColumns=True)


def comparability_key(metric: Column, basis: Column, fields: dict[str, str]) -> Column:
    """What makes two figures comparable: the one basis field that matters.

    Fee metrics compare by what the fee is charged on, so any basis naming
    adjusted equity is one class and everything else the other.
    """
    field = scoring.lookup(metric, fields, "")
    raw = F.coalesce(F.element_at(basis, field), F.lit(""))
    fee = F.when(F.contains(raw, F.lit("adjusted_equity")), F.lit("adjusted_equity")).otherwise(F.lit("assets"))
    return F.when(field == "", F.lit("")).when(field == "fee_basis", fee).otherwise(raw)


# The basis field each built-in metric compares by.
COMPARE_BY = {
    "management_fee_pct": "fee_basis", "incentive_fee_pct": "fee_basis", "nav_per_share_usd": "measure",
    "distribution_yield_pct": "denominator", "leverage_regulatory_dte": "leverage_basis",
    "leverage_economic_dte": "leverage_basis",
}


def peer_comparison(
    cell_rows: DataFrame,
    house: DataFrame,
    fields: dict[str, str] = COMPARE_BY,
    by: Sequence[str] = (),
    withheld: Sequence[str] = (),
) -> DataFrame:
    """Peer median and range per metric, and where the house figure stands.

    ``house`` has metric and house_value. Peers on another basis are counted
    as excluded and never averaged in. Rank is 1 + the number of better peers.
    """
    group = [*by, "metric"]
    keyed = cell_rows.where(F.col("value").isNotNull()).withColumn(
        "compare_key", comparability_key(F.col("metric"), F.col("basis"), fields))
    # The cells are read once: everything below works on counted values.
    tally = durable(keyed.groupBy(*group, "compare_key", "value").agg(
        F.count(F.lit(1)).alias("n"), F.min("entity_ord").alias("first_ord"), F.max("direction").alias("direction")))
    sizes = tally.groupBy(*group, "compare_key").agg(F.sum("n").alias("n"), F.min("first_ord").alias("first_ord"))
    reference = sizes.groupBy(*group).agg(
        F.min_by("compare_key", F.struct((-F.col("n")).alias("a"), "first_ord")).alias("reference_key"))
    rows = tally.join(reference, group).withColumn("counted", F.col("compare_key") == F.col("reference_key"))
    stats = order_statistics(rows.where("counted"), group, "value", count="n")
    ours = house.select(*[c for c in group if c in house.columns], "house_value")
    on = [c for c in group if c in ours.columns]
    better = F.when(F.col("direction") > 0, F.col("value") > F.col("house_value")).otherwise(
        F.col("value") < F.col("house_value"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    counts = rows.join(ours, on, "left").groupBy(*group).agg(
        total(F.col("counted")).alias("n_peers"), total(~F.col("counted")).alias("n_excluded"),
        total(F.col("counted") & better).alias("_better"), F.max("direction").alias("direction"),
        F.max("house_value").alias("house_value"), F.max("reference_key").alias("reference_key"),
    )
    shown = ~F.col("metric").isin(list(withheld)) if withheld else F.lit(True)
    ranked = shown & F.col("house_value").isNotNull() & (F.col("direction") != 0)
    return counts.join(stats, group, "left").select(
        *group, "reference_key", "direction", "n_peers", "n_excluded",
        F.col("median").alias("peer_median"), F.col("low").alias("peer_low"), F.col("high").alias("peer_high"),
        "house_value", F.when(shown, F.col("house_value") - F.col("median")).alias("house_delta"),
        F.when(ranked, F.col("_better") + 1).alias("house_rank"),
        F.when(ranked, F.col("n_peers") + 1).alias("out_of"),
    )


def directed_rank(rows: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Best-first rank of every row; NULL where a metric has no direction."""
    group = list(group)
    ranks = value_ranks(rows, group, value)
    best_first = F.when(F.col("direction") > 0, F.col("n_total") - F.col("n_below") - F.col("n")).otherwise(
        F.col("n_below"))
    return rows.join(ranks, [*group, value]).withColumns({
        "position": best_first + 1,
        "rank": F.when(F.col("direction") != 0, best_first + 1),
    }).drop("n", "n_below", "n_total")


def run_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """What was lost, gained, degraded or moved between two coverage tables.

    Keys present on one side only are no change: the join is inner.
    """
    p = previous.select("entity", "metric", *[F.col(c).alias(f"p_{c}") for c in ("status", "detail", "confidence", "value")])
    c = current.select("entity", "metric", *[F.col(x).alias(f"c_{x}") for x in ("status", "detail", "confidence", "value")])
    both = p.join(c, ["entity", "metric"])
    was, now = F.col("p_status") == "FILLED", F.col("c_status") == "FILLED"
    rank = lambda col: scoring.lookup(F.col(col), rules.GRADE_RANK, 0)
    move = F.try_divide(F.abs(F.col("c_value") - F.col("p_value")), F.abs(F.col("p_value")))

    def change(when: Column, kind: str, before: Column, after: Column) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), before.alias("before"), after.alias("after"),
                                     F.when(was & now, move).alias("move")))

    changes = F.array_compact(F.array(
        change(was & ~now, "LOST", F.col("p_detail"), F.col("c_status")),
        change(~was & now, "GAINED", F.col("p_status"), F.col("c_detail")),
        change(was & now & (rank("c_confidence") < rank("p_confidence")), "DEGRADED",
               F.col("p_confidence"), F.col("c_confidence")),
        change(was & now & (F.col("p_value") != 0) & (move > rules.RELATIVE_MOVE), "CHANGED",
               text.significant(F.col("p_value")), text.significant(F.col("c_value"))),
    ))
    return both.select("entity", "metric", F.explode(changes).alias("_c")).select("entity", "metric", "_c.*").withColumn(
        "cause", F.when(F.col("kind") == "LOST", F.col("after")))


def price_trend(
    facts: DataFrame, entities: DataFrame, anchor: Column, price: str, equity: str, shares: str, quarters: int = 8
) -> DataFrame:
    """Price per share at each entity's semi-annual dates.

    Entities without a stated price use equity over shares of the same day,
    labelled as book value. The newest filing of a day wins.
    """
    rows = latest_restatement(
        facts.where(F.col("tag").isin(price, equity, shares) & (F.col("end") <= anchor)), ["entity", "tag", "end"])
    daily = rows.groupBy("entity", "end").agg(
        F.max(F.when(F.col("tag") == price, F.col("val"))).alias("_p"),
        F.max(F.when(F.col("tag") == price, F.col("form"))).alias("_form"),
        F.max(F.when(F.col("tag") == equity, F.col("val"))).alias("_e"),
        F.max(F.when(F.col("tag") == shares, F.col("val"))).alias("_s"),
    )
    stated = rows.where(F.col("tag") == price).select("entity").distinct().withColumn("_states", F.lit(True))
    joined = daily.join(stated, "entity", "left")
    nav = F.when(F.col("_states"), F.col("_p")).otherwise(F.try_divide("_e", "_s"))
    source = F.when(F.col("_states"), F.col("_form")).otherwise(F.lit("book value"))
    points = joined.select("entity", "end", nav.alias("nav_per_share"), source.alias("source")).where(
        F.col("nav_per_share").isNotNull())
    return semiannual_cadence(points, entities, anchor, quarters)
