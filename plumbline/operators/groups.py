"""Per-group picks and order statistics that stay safe when one key is huge.

All of them combine on the map side first, so a key holding a third of the rows
never sends its rows to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.session import durable


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The whole row that sorts first in each group (nulls sort first)."""
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def last_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rn") -> DataFrame:
    """First ``k`` rows of each group; Spark applies the limit before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def value_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    pieces: int | None = None,
    count: str | None = None,
) -> DataFrame:
    """Exact rank information of every distinct value of a group.

    Returns keys, the value, ``n`` rows carrying it, ``n_below`` rows strictly
    smaller and ``n_total`` rows in the group. Equal values are counted before
    the shuffle. The counted values of all groups are laid out by key and value in ranges
    that Spark samples, whose number follows their size unless ``pieces`` is given, and are
    written so; a large group lies in many ranges, a small one in one. Ranges are ranked in
    parallel and offset by the sums of those before them. With ``count`` the rows are
    counted already, one per value.
    """
    keys = list(keys)
    known = df.where(F.col(value).isNotNull())
    if count is None:
        counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    else:
        counts = known.select(*keys, value, F.col(count).alias("n"))
    ranges = [*keys, value] if pieces is None else [pieces, *keys, value]
    placed = durable(counts.repartitionByRange(*ranges).withColumn("_piece", F.spark_partition_id()))
    sizes = placed.groupBy(*keys, "_piece").agg(F.sum("n").alias("_size"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_piece", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
                           F.sum("_size").over(group).alias("n_total"))
    # Explicitly spread the pieces: partitioning by the keys alone would satisfy
    # the window below and put a huge group back into one task.
    spread = placed.join(offsets, [*keys, "_piece"]).repartition(*keys, "_piece")
    within = Window.partitionBy(*keys, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_offset") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return spread.withColumn("n_below", below).select(*keys, value, "n", "n_below", "n_total")


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, count: str | None = None) -> DataFrame:
    """Exact n, min, max, median and upper median of a value per group."""
    keys = list(keys)
    ranks = value_ranks(df, keys, value, count=count)
    first, last = F.col("n_below"), F.col("n_below") + F.col("n") - 1
    upper = F.floor(F.col("n_total") / 2)
    lower = F.floor((F.col("n_total") - 1) / 2)

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col(value)))

    return ranks.groupBy(*keys).agg(
        F.max("n_total").alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        at(lower).alias("_lower"),
        at(upper).alias("upper_median"),
    ).select(
        *keys, "n", "low", "high",
        ((F.col("_lower") + F.col("upper_median")) / 2).alias("median"), "upper_median",
    )


def modal_first(df: DataFrame, keys: Sequence[str], value: str, ord_col: str) -> DataFrame:
    """Most common value per group; ties go to the value seen first."""
    counts = df.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), F.min(ord_col).alias("first_ord")
    )
    return counts.groupBy(*keys).agg(
        F.min_by(value, F.struct((-F.col("n")).alias("a"), F.col("first_ord"))).alias("modal"),
        F.max("n").alias("n"),
    )
