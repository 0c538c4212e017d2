"""From conflicting candidates to one value, or a typed reason for a blank.

Keys of few rows, nearly all of them in practice, are shuffled once and settled by
windows inside that one deal. A key of many rows takes stages of plain aggregates and
key joins instead, so rows are combined before each shuffle and AQE can split it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline import rules
from plumbline.functions import scoring, text
from plumbline.operators.cluster import FOLD_LIMIT, cluster_leaders, cluster_number, leaders_sql
from plumbline.operators.eligibility import at_anchors, covers, eligible
from plumbline.operators.groups import order_statistics
from plumbline.session import durable

NO_DATE = -1_000_000  # sorts an undated row behind every dated one
# Keys of more rows are settled in stages, not by windows. A window repeats the key's values beside
# each of its rows, so this also bounds what a task holds (8 kB a row).
ROW_LIMIT = 1_000
# Rows, copies for anchors included, that one task sorts for those windows (some 600 bytes a row).
TASK_ROWS = 250_000


def _preference_rank(basis: Column, preferences: Column) -> Column:
    """Position of the first preferred (key, value) the basis carries."""
    hits = F.transform(preferences, lambda p: F.coalesce(basis[p["key"]] == p["val"], F.lit(False)))
    found = F.array_position(hits, F.lit(True))
    size = F.size(preferences)
    return F.when(preferences.isNull() | (size == 0), F.lit(0)).when(
        found > 0, (found - 1).cast("int")
    ).otherwise(size)


def _class_rank(declared: Column, wanted: Column) -> Column:
    """Wanted class first, unstated second, any other class last."""
    want = text.normalize_label(F.coalesce(wanted, F.lit("")))
    have = text.normalize_label(declared)
    return (
        F.when((want == "") | (have == want), F.lit(0))
        .when(have.isin("", "unstated"), F.lit(1))
        .otherwise(F.lit(2))
    )


def evidence(cands: DataFrame, metrics: DataFrame, ref: Column | None = None, strict_independence: bool = False) -> DataFrame:
    """The narrow per-row facts that decide between candidates.

    ``metrics`` is the metric registry: metric, low, high, preferences. Without ``ref`` what
    depends on the anchor is left for :func:`dated`. Rows are one observation if they share
    tier, filing and transforms; with ``strict_independence`` a filing has one vote whatever was
    read from it and how, and only rows that name no filing are told apart by the rest.
    """
    dim = metrics.select("metric", "low", "high")
    flags = scoring.add_flag(
        F.col("flags"), rules.OUT_OF_RANGE_FLAG,
        scoring.out_of_range(F.col("value"), F.col("low"), F.col("high")),
    )
    observation = F.concat_ws("\u0001", "tier", "accession", F.array_join("transforms", "\u0002"))
    if strict_independence:
        observation = F.when(F.coalesce(F.col("accession"), F.lit("")) != "", F.col("accession")).otherwise(observation)
    out = (
        cands.join(F.broadcast(dim), "metric", "left")
        .withColumns({"flags": flags, "as_of": F.coalesce("as_of", "period_end")})
        .withColumns({
            "share_class": F.coalesce(F.col("basis")["share_class"], F.lit("")),
            "tier_score": scoring.tier_score(F.col("tier")),
            "n_flags": F.size("flags"),
            "as_of_day": F.coalesce(F.unix_date("as_of"), F.lit(NO_DATE)),
            "observation": observation,
            "measures": ~scoring.has_any_flag(F.col("flags"), rules.NON_MEASUREMENT_FLAGS),
            "disqualified": scoring.has_any_flag(F.col("flags"), rules.DISQUALIFYING_FLAGS),
        })
        .drop("low", "high")
    )
    return out if ref is None else dated(out, ref)


def dated(ev: DataFrame, ref: Column) -> DataFrame:
    """Evidence with the anchor and whether a row is dated outside it."""
    out = ~scoring.in_force(F.col("effective_from"), F.col("effective_until"), ref)
    return ev.withColumns({"ref": ref, "dated_out": F.coalesce(out, F.lit(False))})


def keyed_by_basis(ev: DataFrame, metrics: DataFrame) -> DataFrame:
    """Evidence rows with the canonical basis key and its preference rank."""
    dim = metrics.select("metric", "preferences")
    return ev.join(F.broadcast(dim), "metric", "left").withColumns({
        "basis_key": text.basis_key(F.col("basis")),
        "pref_rank": _preference_rank(F.col("basis"), F.col("preferences")),
    }).drop("preferences")


def basis_groups(ev: DataFrame, entities: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (keys, basis) with what ranks the basis."""
    groups = ev.groupBy(*keys, "basis_key", "share_class").agg(
        F.min("pref_rank").alias("pref_rank"),
        F.max("tier_score").alias("max_tier"),
        F.min("ord").alias("first_ord"),
        F.bool_and("disqualified").alias("all_disqualified"),
        F.bool_and("dated_out").alias("all_dated_out"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    dim = entities.select("entity", "institutional_class")
    rank = _class_rank(F.col("share_class"), F.col("institutional_class"))
    return groups.join(dim, "entity", "left").withColumn("class_rank", rank).drop("institutional_class")


def basis_order() -> list[Column]:
    return [F.col("class_rank"), F.col("pref_rank"), (-F.col("max_tier")).alias("neg_tier"), F.col("first_ord")]


def primary_basis(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The basis that supplies the headline value of each key."""
    picked = F.min_by(
        F.struct("basis_key", "all_disqualified", "all_dated_out"), F.struct(*basis_order())
    ).alias("_p")
    return groups.groupBy(*keys).agg(
        picked, F.count(F.lit(1)).alias("n_bases"), F.sum("n_rows").alias("n_candidates")
    ).select(*keys, "_p.*", "n_bases", "n_candidates")


def in_force_rows(ev: DataFrame, primary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the primary basis, without those dated outside the period.

    Undated rows always stay; where every row is dated out, all of them stay.
    """
    side = primary.select(*keys, "basis_key", "all_dated_out", "all_disqualified")
    return ev.join(side, [*keys, "basis_key"]).where(
        ~F.col("dated_out") | F.col("all_dated_out") | F.col("all_disqualified")
    ).drop("all_dated_out")


def row_order() -> list[Column]:
    return [F.col("n_flags"), (-F.col("tier_score")).alias("neg_tier"), (-F.col("as_of_day")).alias("neg_day"),
            F.col("value"), F.col("ord")]


def cluster_order() -> list[Column]:
    return [
        (~F.col("any_measure")).alias("no_measure"), (-F.col("independents")).alias("neg_ind"),
        F.col("min_flags"), (-F.col("max_tier")).alias("neg_tier"),
        (-F.col("max_day")).alias("neg_day"), F.col("cluster"),
    ]


CHOSEN = ["value", "unit", "tier", "tier_score", "observation", "flags", "n_flags", "as_of", "terms_clock",
          "form", "accession", "filing_date", "period_end", "locator", "basis", "basis_key", "ord"]


#: Columns of the evidence that no stage behind the clusters reads.
UNUSED = ["effective_from", "effective_until", "share_class", "pref_rank", "transforms", "disqualified", "dated_out"]


def number_clusters(rows: DataFrame, keys: Sequence[str], leaders: DataFrame) -> DataFrame:
    """In-force rows with the number of the cluster their value falls in."""
    by = [*keys, "basis_key"]
    number = cluster_number(F.col("leaders"), F.col("value"))
    return rows.join(leaders, by).withColumn("cluster", number).drop("leaders")


def clusters(numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per cluster of agreeing values inside the primary basis."""
    by = [*keys, "basis_key"]
    present = [c for c in CHOSEN if c in numbered.columns and c not in by]
    plain = F.struct("n_flags", (-F.col("tier_score")).alias("t"), "ord")
    return numbered.groupBy(*by, "cluster").agg(
        F.bool_or("measures").alias("any_measure"),
        F.count_distinct("observation").alias("independents"),
        F.min("n_flags").alias("min_flags"),
        F.max("tier_score").alias("max_tier"),
        F.max("as_of_day").alias("max_day"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.min_by(F.struct(*present), F.struct(*row_order())).alias("best"),
        F.min_by("as_of", plain).alias("_plain"),
        F.min(plain).alias("_plain_order"),
        F.max("ref").alias("ref"),
        F.bool_and("all_disqualified").alias("all_disqualified"),
    )


def winners(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cluster with the most evidence, its best row, and what it beat."""
    by = [*keys, "basis_key"]
    order = F.struct(*cluster_order())
    out = found.groupBy(*by).agg(
        F.min_by(F.struct("cluster", "independents", "n_rows", "best"), order).alias("_w"),
        F.min_by("_plain", "_plain_order").alias("plain_as_of"),
        F.count(F.lit(1)).alias("n_clusters"),
        F.max("ref").alias("ref"),
        F.bool_and("all_disqualified").alias("all_disqualified"),
    )
    best = [f"_w.best.{c}" for c in CHOSEN if c != "basis_key"]
    return out.select(
        *by, F.col("_w.cluster").alias("cluster"), F.col("_w.independents").alias("independents"),
        *best, "plain_as_of", "n_clusters", "ref", "all_disqualified",
    )


def score_counts(rows: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many independent measurements agree and disagree with each choice.

    The chosen value is compared with every other in-force row of its basis;
    rows of the same observation and rows that do not measure are left out.
    """
    by = [*keys, "basis_key"]
    side = chosen.select(
        *by, F.col("value").alias("_v"), F.col("unit").alias("_u"), F.col("observation").alias("_o")
    )
    counted = F.col("measures") & (F.col("observation") != F.col("_o"))
    agree = scoring.values_agree(F.col("_v"), F.col("value"), F.col("_u"))
    counts = rows.select(*by, "value", "observation", "measures").join(side, by).groupBy(*by).agg(
        F.count_if(counted & agree).alias("n_agree"), F.count_if(counted & ~agree).alias("n_disagree")
    )
    return chosen.join(counts, by)


def _reason() -> Column:
    clock = F.coalesce("terms_clock", "as_of")
    return (
        F.when(F.col("all_disqualified"), F.lit("basis_disqualified"))
        .when(scoring.is_stale(clock, F.col("ref")), F.lit("stale_beyond_limit"))
        .when(F.col("score") < rules.SCORE_FLOOR, F.lit("below_confidence_floor"))
    )


def _detail() -> Column:
    floor = F.concat(
        F.lit("evidence below the reporting floor ("), F.format_string("%.2f", F.col("score")),
        F.lit(f" < {rules.SCORE_FLOOR:.2f}): "),
        F.when(F.size("flags") > 0, F.array_join("flags", "; ")).otherwise(F.lit("insufficient evidence")),
    )
    return (
        F.when(F.col("reason") == "basis_disqualified", F.concat(
            F.lit("all figures on this basis are ruled out: "), F.array_join("flags", "; ")))
        .when(F.col("reason") == "stale_beyond_limit", text.stale_detail(
            F.col("form"), F.col("period_end"), F.col("as_of"), F.col("filing_date"),
            F.col("terms_clock"), F.col("ref")))
        .when(F.col("reason") == "below_confidence_floor", floor)
    )


@dataclass
class Stages:
    """The staged reconciliation, each step a lazy DataFrame."""

    keys: list[str]
    evidence: DataFrame
    groups: DataFrame
    primary: DataFrame
    rows: DataFrame
    clusters: DataFrame
    winners: DataFrame


def stages(
    ev: DataFrame, entities: DataFrame, metrics: DataFrame, keys: Sequence[str], fold_limit: int | None = FOLD_LIMIT
) -> Stages:
    ev = keyed_by_basis(ev, metrics)
    groups = basis_groups(ev, entities, keys)
    primary = primary_basis(groups, keys)
    rows = in_force_rows(ev, primary, keys)
    numbered = number_clusters(rows, keys, cluster_leaders(rows, [*keys, "basis_key"], fold_limit))
    found = clusters(numbered, keys)
    return Stages(list(keys), ev, groups, primary, numbered, found, winners(found, keys))


def settle_in_stages(
    keyed: DataFrame, entities: DataFrame, keys: Sequence[str], fold_limit=FOLD_LIMIT
) -> DataFrame:
    """The decision in stages, each narrow one written once.

    The tables with one row per key or cluster are read back with their real
    size, so Spark broadcasts them when they are small and the candidate rows of
    a hot key are neither shuffled nor recomputed.
    """
    primary = durable(primary_basis(basis_groups(keyed, entities, keys), keys))
    rows = in_force_rows(keyed, primary, keys)
    leaders = durable(cluster_leaders(rows, [*keys, "basis_key"], fold_limit))
    numbered = durable(number_clusters(rows, keys, leaders).drop(*UNUSED))
    found = durable(clusters(numbered, keys))
    best = durable(winners(found, keys))
    counted = score_counts(numbered, best, keys)
    disputes = conflicts(found, best, numbered, keys).select(
        *keys, "losing_rows", "losing_independents", "spread_pct")
    return (
        counted.join(primary.select(*keys, "n_bases", "n_candidates"), list(keys))
        .join(disputes, list(keys), "left").fillna(0, ["losing_rows", "losing_independents"])
    )


def settle_in_windows(keyed: DataFrame, entities: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The decision of :func:`settle_in_stages` for keys of few rows, without another shuffle of rows.

    ``keyed`` is dealt by entity, which every window below keeps: rows are sorted by basis, then,
    inside the primary one, by cluster.
    """
    # One number in front settles nearly all comparisons of the sorts.
    by = ["_key", *keys]
    key, basis = Window.partitionBy(*by), Window.partitionBy(*by, "basis_key", "share_class")
    # The rows lie by entity already, so only the entities move.
    dim = entities.select("entity", "institutional_class").hint("shuffle_hash")
    rank = _class_rank(F.col("share_class"), F.col("institutional_class"))
    rows = keyed.join(dim, "entity", "left").withColumns({"class_rank": rank, "_key": F.xxhash64(*keys)}).drop("institutional_class")
    rows = rows.withColumns({
        "_bases": F.dense_rank().over(key.orderBy("basis_key", "share_class")),
        "_pref": F.min("pref_rank").over(basis), "max_tier": F.max("tier_score").over(basis),
        "first_ord": F.min("ord").over(basis), "all_disqualified": F.bool_and("disqualified").over(basis),
        "_all_out": F.bool_and("dated_out").over(basis),
    }).withColumn("pref_rank", F.col("_pref"))
    rows = rows.withColumns({
        "_p": F.min_by(F.struct("basis_key", "all_disqualified", "_all_out"), F.struct(*basis_order())).over(key),
        "n_bases": F.max("_bases").over(key).cast("bigint"), "n_candidates": F.count(F.lit(1)).over(key),
    }).where(
        (F.col("basis_key") == F.col("_p.basis_key"))
        & (~F.col("dated_out") | F.col("_p._all_out") | F.col("_p.all_disqualified"))
    ).withColumn("all_disqualified", F.col("_p.all_disqualified")).drop(
        "_p", "_pref", "_all_out", "_bases", "class_rank", "max_tier", "first_ord",
        *[c for c in UNUSED if c in keyed.columns])
    plain = F.struct("n_flags", (-F.col("tier_score")).alias("t"), "ord")
    rows = rows.withColumns({
        "_values": F.collect_set("value").over(key), "_unit": F.max("unit").over(key),
        "plain_as_of": F.min_by("as_of", plain).over(key),
    }).withColumn("_leaders", F.expr(leaders_sql("_values", "_unit"))).withColumns({
        "cluster": cluster_number(F.col("_leaders"), F.col("value")),
        "n_clusters": F.size("_leaders").cast("bigint"),
    }).drop("_values", "_unit", "_leaders")
    cluster = Window.partitionBy(*by, "cluster")
    rows = rows.withColumn("_row", F.row_number().over(cluster.orderBy(*row_order()))).withColumns({
        "any_measure": F.bool_or("measures").over(cluster),
        "independents": F.size(F.collect_set("observation").over(cluster)).cast("bigint"),
        "min_flags": F.min("n_flags").over(cluster), "max_tier": F.max("tier_score").over(cluster),
        "max_day": F.max("as_of_day").over(cluster),
    })
    first = F.col("_row") == 1
    rows = rows.withColumn("_c", F.min_by(
        F.struct("cluster", "value", "unit", "observation"),
        F.struct((~first).alias("later"), *cluster_order())).over(key))
    chosen = lambda name: F.col(f"_c.{name}")
    counted = F.col("measures") & (F.col("observation") != chosen("observation"))
    agree = scoring.values_agree(chosen("value"), F.col("value"), chosen("unit"))
    lost = F.col("cluster") != chosen("cluster")
    pool = F.col("_pool")
    mid = F.get(pool, F.floor(F.size(pool) / 2).cast("int"))
    return rows.withColumns({
        "n_agree": F.count_if(counted & agree).over(key), "n_disagree": F.count_if(counted & ~agree).over(key),
        "losing_rows": F.count_if(lost).over(key),
        "losing_independents": F.coalesce(F.sum(F.when(lost & first, F.col("independents"))).over(key), F.lit(0)),
        "_pool": F.collect_list(F.when(lost, F.col("value"))).over(key),
    }).where(first & ~lost).withColumn("_pool", F.array_sort(F.array_append("_pool", F.col("value")))).withColumn(
        "spread_pct", F.when(F.col("n_clusters") > 1, (F.element_at(pool, -1) - F.get(pool, F.lit(0)))
                             / F.abs(F.when(mid == 0, F.lit(1.0)).otherwise(mid)) * 100)
    ).select(*keys, "basis_key", "cluster", "independents", *[c for c in CHOSEN if c != "basis_key"], "plain_as_of",
             "n_clusters", "ref", "all_disqualified", "n_agree", "n_disagree", "n_bases", "n_candidates",
             "losing_rows", "losing_independents", "spread_pct")


def decide(settled: DataFrame) -> DataFrame:
    """Score every settled key and publish its value or the reason for a blank."""
    agreement = (
        F.when(F.col("n_disagree") > 0, F.lit(rules.AGREEMENT_CONFLICT))
        .when(F.col("n_agree") > 0, F.lit(rules.AGREEMENT_CORROBORATED))
        .otherwise(F.lit(rules.AGREEMENT_SINGLE))
    )
    scored = settled.withColumns({
        "agreement": agreement,
        "age_days": F.date_diff("ref", "as_of"),
        "freshness": scoring.freshness(F.col("as_of"), F.col("ref")),
        "penalty": scoring.penalty_product(F.col("flags")),
    }).withColumn("score", scoring.clamp01(
        F.col("tier_score") * F.col("agreement") * F.col("freshness") * F.col("penalty")
    )).withColumn("reason", _reason()).withColumn("detail", _detail())
    blank = F.col("reason").isNotNull()
    void = F.coalesce(F.col("reason") == "basis_disqualified", F.lit(False))
    return scored.withColumns({
        "chosen_value": F.col("value"),
        "chosen_ord": F.when(~F.col("all_disqualified"), F.col("ord")),
        "value": F.when(~blank, F.col("value")),
        "as_of": F.when(void, F.col("plain_as_of")).otherwise(F.col("as_of")),
        "conflict": F.when(F.col("n_clusters") > 1, F.concat(
            F.lit("kept "), text.significant(F.col("value")), F.lit(": agreed on by "),
            F.col("independents").cast("string"), F.lit(" independent extraction(s) vs "),
            F.col("losing_independents").cast("string"), F.lit("; chosen source "), F.col("tier"),
            F.when(F.size("flags") > 0, F.concat(F.lit(", flags "), F.array_join("flags", ", ")))
            .otherwise(F.lit(", no flags")))),
        "confidence": F.when(blank, F.lit(rules.SUPPRESSED)).otherwise(scoring.grade(F.col("score"))),
        "score": F.when(void, F.lit(0.0)).otherwise(F.col("score")),
    }).drop("ord", "plain_as_of")


def usable(cands: DataFrame) -> DataFrame:
    """Candidates that carry a number; ``eligibility.unusable_notices`` accounts for the others."""
    return cands.where(F.col("value").isNotNull() & ~F.isnan(F.col("value").cast("double")))


def spread(cands: DataFrame) -> DataFrame:
    """Rows dealt evenly, whatever the files they come from and however hot a key is."""
    return cands.repartition(F.xxhash64("entity", "metric", "accession", "ord"))


def resolve(
    cands: DataFrame,
    entities: DataFrame,
    metrics: DataFrame,
    ref: Column,
    keys: Sequence[str] = ("entity", "metric"),
    fold_limit: int | None = FOLD_LIMIT,
    anchors: Sequence[date] | None = None,
    strict_independence: bool = False,
) -> DataFrame:
    """Reconcile eligible candidates; precedence disqualified, stale, weak.

    One job counts the rows of each key. Those of up to ``ROW_LIMIT`` are dealt by entity once and
    settled by windows. Larger ones take aggregates that combine before each shuffle and
    key joins that Spark can split, so it does not matter how many candidates a
    key has; the evidence of their rows is worked out and written once, evenly dealt. Both ways
    give the same. ``fold_limit`` None is for keys known to be small: nothing is counted.
    Rows whose value is NULL or NaN take no part, and a key that has no other rows
    gives none. With ``anchors`` each row takes part at every anchor on or after its
    period; ``keys`` then have the column ``anchor``, and rows are copied inside
    tasks that combine them, not before a shuffle of whole rows. ``strict_independence`` gives
    every filing one vote (see :func:`evidence`).
    """
    def prepared(rows: DataFrame) -> DataFrame:
        return keyed_by_basis(evidence(rows, metrics, strict_independence=strict_independence), metrics)

    def at_ref(keyed: DataFrame) -> DataFrame:
        if anchors is not None:
            keyed = eligible(at_anchors(keyed, anchors), F.col("anchor"))
        return dated(keyed, ref)

    rows, key = usable(cands), F.xxhash64("entity", "metric")
    if anchors:
        # Rows later than every anchor take part nowhere, so they are not dealt.
        rows = rows.where(covers() <= F.lit(max(anchors)))
    if fold_limit is None:
        return decide(settle_in_windows(at_ref(prepared(rows.repartition("entity"))), entities, list(keys)))
    # Keys that share a hash only share the way they take.
    counts = durable(rows.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_n")))
    above = F.col("_n") > min(ROW_LIMIT, fold_limit)
    n_rows, n_large = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(above)).first()
    few, many = rows, None
    if n_large:
        named, large = rows.withColumn("_key", key), durable(counts.where(above).select("_key"))
        few = named.join(large, "_key", "left_anti").drop("_key")
        many = named.join(large, "_key", "left_semi").drop("_key")
    pieces = n_rows * len(anchors or [None]) // TASK_ROWS
    default = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = few.repartition("entity") if pieces <= default else few.repartition(pieces, "entity")
    settled = settle_in_windows(at_ref(prepared(few)), entities, list(keys))
    if many is not None:
        staged = settle_in_stages(at_ref(durable(prepared(spread(many)))), entities, list(keys), fold_limit)
        settled = settled.unionByName(staged.select(*settled.columns))
    return decide(settled)


def alternatives(ev: DataFrame, primary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The best row of every basis that lost: fewest flags, then tier."""
    by = [*keys, "basis_key"]
    best = F.min_by(F.struct("value", "tier", "n_flags"),
                    F.struct("n_flags", (-F.col("tier_score")).alias("t"), "ord")).alias("_b")
    per_basis = ev.groupBy(*by).agg(best).select(*by, "_b.*")
    return per_basis.join(primary.select(*by), by, "left_anti")


def conflicts(found: DataFrame, best: DataFrame, numbered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disagreements inside the primary basis: spread, counts, resolution.

    The spread is taken over the chosen value and every losing value, relative
    to their upper median, which comes from distributed ranks.
    """
    by = [*keys, "basis_key"]
    side = best.where(F.col("n_clusters") > 1).select(
        *by, F.col("cluster").alias("win"), F.col("value").alias("chosen_value"),
        F.col("tier").alias("chosen_tier"), F.col("independents").alias("win_independents"),
    )
    summary = found.join(side, by).where(F.col("cluster") != F.col("win")).groupBy(*by).agg(
        F.count(F.lit(1)).alias("losing_clusters"), F.sum("n_rows").alias("losing_rows"),
        F.sum("independents").alias("losing_independents"),
    )
    losing = numbered.join(side, by).where(F.col("cluster") != F.col("win")).select(*by, "value")
    pool = losing.unionByName(side.select(*by, F.col("chosen_value").alias("value")))
    stats = order_statistics(pool, by, "value")
    mid = F.when(F.col("upper_median") == 0, F.lit(1.0)).otherwise(F.col("upper_median"))
    resolution = F.concat(
        text.significant(F.col("chosen_value")), F.lit(" ("), F.col("chosen_tier"), F.lit(")")
    )
    return (
        side.join(summary, by).join(stats, by)
        .withColumn("spread_pct", (F.col("high") - F.col("low")) / F.abs(mid) * 100)
        .withColumn("resolution", resolution)
        .drop("n", "median", "upper_median", "win", "low", "high")
    )
