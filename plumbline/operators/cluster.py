"""Leader clustering of values that agree within tolerance.

Values are taken in ascending order; each joins the first cluster whose leader
it agrees with. The distance to a leader grows faster than the tolerance does,
so a value that misses the open leader misses all earlier ones, and the leaders
alone describe the clustering: a value belongs to the greatest leader not above
it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.functions import scoring
from plumbline.session import durable

# Groups of at most this many distinct values (80 kB of numbers) are folded in one array; larger
# ones are walked by jump pointers. Rows do not count, only values; both ways give the same.
FOLD_LIMIT = 10_000
# A cell is half a tolerance wide, so values this many cells apart never agree.
REACH = 4
# Cells whose values meet in one task to find what lies out of each one's reach.
CELLS = 8


def leaders_sql(values: str, unit: str) -> str:
    """SQL folding an array of values into its leaders, ascending."""
    joins = scoring.agree_sql("element_at(acc, -1)", "x", unit)
    return (
        f"aggregate(sort_array({values}), cast(array() as array<double>), "
        f"(acc, x) -> if(size(acc) > 0 and {joins}, acc, concat(acc, array(x))))"
    )


def cell_number(value: Column, unit: Column) -> Column:
    """Order-preserving cell, half a tolerance wide: values sharing one agree.

    Cells are linear up to the value where the relative tolerance takes over and
    logarithmic beyond, so a group has boundedly many whatever its rows.
    """
    absolute, relative = scoring.tolerance_parts(unit)
    knee = absolute / relative
    size = F.abs(value)
    units = F.when(size <= knee, size / absolute).otherwise(1 / relative + F.ln(size / knee) / relative)
    return F.floor(F.signum(value) * units * 2)


def _out_of_reach(table: pd.DataFrame) -> pd.DataFrame:
    """For each of a chunk's own values the smallest greater one there that disagrees with it."""
    table = table.sort_values("value", ignore_index=True)
    v, absolute, relative = table["value"].to_numpy(), table["_abs"].iat[0], table["_rel"].iat[0]
    low, high = np.arange(1, len(v) + 1), np.full(len(v), len(v))
    while (open_ := low < high).any():
        half = (low + high) // 2
        other = v[np.minimum(half, len(v) - 1)]
        mid = (np.abs(v) + np.abs(other)) / 2
        mid[mid == 0] = 1.0
        apart = np.abs(v - other) > np.maximum(absolute, mid * relative)
        high = np.where(open_ & apart, half, high)
        low = np.where(open_ & ~apart, half + 1, low)
    table["next"] = np.where(low < len(v), v[np.minimum(low, len(v) - 1)], np.nan)
    return table[table["_own"]].drop(columns=["_own", "_abs", "_rel", "_chunk"])


def _jumps(values: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """group, value, ``next``: the smallest greater value of the group that disagrees with it.

    It lies within the next few cells, which meet in one task, or is the first value of the first
    used cell behind them, which the cell summary knows.
    """
    absolute, relative = scoring.tolerance_parts(F.col("unit"))
    chunk = F.floor(F.col("cell") / CELLS)
    rows = values.withColumns({"_abs": absolute, "_rel": relative, "_chunk": chunk, "_own": F.lit(True)})
    halo = rows.where(F.pmod("cell", F.lit(CELLS)) < REACH).withColumns({"_chunk": chunk - 1, "_own": F.lit(False)})
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.schema.fields)
    near = rows.unionByName(halo).groupBy(*group, "_chunk").applyInPandas(_out_of_reach, f"{kinds}, next double")
    behind = Window.partitionBy(*group).orderBy("_back").rangeBetween(Window.unboundedPreceding, -REACH)
    far = cells.withColumn("_back", -F.col("cell")).withColumn("_far", F.min("low").over(behind))
    found = near.join(far.select(*group, "cell", "_far"), [*group, "cell"])
    # What pandas leaves open comes back as null.
    return found.select(*group, "value", F.coalesce("next", "_far").alias("next")).where("next is not null")


def _walk(values: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Leaders of large groups, one a row, and the groups' used cells, found without gathering any group.

    Every value points to the smallest greater one that disagrees with it; the leaders are the
    chain from a group's smallest value. Pointers are doubled: in each round the leaders found so
    far take the pointer once, then every pointer is followed by itself. A chain has a leader per
    cell at most, so the rounds are the logarithm of the cells of the largest group.
    """
    group = [*keys, "unit"]
    values = durable(values.distinct().withColumn("cell", cell_number(F.col("value"), F.col("unit"))))
    cells = durable(values.groupBy(*group, "cell").agg(F.min("value").alias("low")))
    most = cells.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
    jump = durable(_jumps(values, cells, group))
    found = durable(cells.groupBy(*group).agg(F.min("low").alias("leader")))
    for step in range(most.bit_length()):
        if step:
            again = jump.select(*group, F.col("value").alias("next"), F.col("next").alias("_after"))
            jump = durable(jump.join(again, [*group, "next"]).select(*group, "value", F.col("_after").alias("next")))
        ahead = found.join(jump.withColumnRenamed("value", "leader"), [*group, "leader"])
        found = durable(found.unionByName(ahead.select(*group, F.col("next").alias("leader"))))
    return found, cells


def _leaders_of_cells(found: DataFrame, cells: DataFrame, group: list[str]) -> DataFrame:
    """group, cell, ``_within``: numbered leaders of the cell behind the last one before it, ascending.

    A cell has one leader at most but for rounding, and a group boundedly many cells.
    """
    order = Window.partitionBy(*group).orderBy("leader")
    one = F.struct(F.row_number().over(order).alias("cluster"), "leader")
    numbered = found.select(*group, cell_number(F.col("leader"), F.col("unit")).alias("cell"), one.alias("_one"))
    own = numbered.groupBy(*group, "cell").agg(F.sort_array(F.collect_list("_one")).alias("_own"))
    before = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.element_at("_own", -1), ignorenulls=True).over(before)
    within = F.concat(F.array_compact(F.array(last)), F.coalesce("_own", F.array().cast(own.schema["_own"].dataType)))
    return cells.join(own, [*group, "cell"], "left").select(*group, "cell", within.alias("_within"))


def _large_groups(values: DataFrame, keys: list[str], fold_limit: int) -> DataFrame | None:
    """keys and unit of the groups with more distinct values, None without any.

    A group has one unit; should sources differ, the greatest counts.
    """
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.max("unit").alias("unit"))
    large = durable(sizes.where(F.col("_rows") > fold_limit).drop("_rows"))
    return None if large.isEmpty() else large


def _fold(values: DataFrame, keys: list[str]) -> DataFrame:
    """Leaders of groups that fit an array."""
    sets = values.groupBy(*keys).agg(F.collect_set("value").alias("_values"), F.max("unit").alias("_unit"))
    return sets.select(*keys, F.expr(leaders_sql("_values", "_unit")).alias("leaders"))


def cluster_leaders(
    df: DataFrame, keys: Sequence[str], fold_limit: int | None = FOLD_LIMIT
) -> DataFrame:
    """keys + ``leaders`` (ascending) for rows with ``value`` and ``unit``.

    With ``fold_limit`` set, one counting job first looks for groups with more
    distinct values; pass ``None`` only when the groups are known to be small.
    """
    keys = list(keys)
    values = df.select(*keys, "unit", "value").where(F.col("value").isNotNull())
    if fold_limit is None:
        return _fold(values, keys)
    values = values.distinct()
    large = _large_groups(values, keys, fold_limit)
    if large is None:
        return _fold(values, keys)
    found, _ = _walk(values.drop("unit").join(large, keys), keys)
    return _fold(values.join(large.drop("unit"), keys, "left_anti"), keys).unionByName(
        found.groupBy(*keys).agg(F.sort_array(F.collect_list("leader")).alias("leaders")))


def cluster_number(leaders: Column, value: Column) -> Column:
    """1-based number of the cluster a value falls in."""
    return F.size(F.filter(leaders, lambda leader: leader <= value))


def tolerance_clusters(
    df: DataFrame, keys: Sequence[str], fold_limit: int | None = FOLD_LIMIT
) -> DataFrame:
    """Rows with their cluster number and cluster leader.

    Rows of large groups meet the leaders of their own cell and the last one before it, never all
    leaders of the group, and are joined by cell, so a group of any size is spread.
    """
    keys = list(keys)
    values = df.select(*keys, "unit", "value").where(F.col("value").isNotNull())
    large = None
    if fold_limit is not None:
        values = values.distinct()
        large = _large_groups(values, keys, fold_limit)
    few = values if large is None else values.join(large.drop("unit"), keys, "left_anti")
    number = cluster_number(F.col("leaders"), F.col("value"))
    out = (
        df.join(_fold(few, keys), keys)
        .withColumn("cluster", number)
        .withColumn("leader", F.element_at("leaders", F.col("cluster")))
        .drop("leaders")
    )
    if large is None:
        return out
    group = [*keys, "unit"]
    found, cells = _walk(values.drop("unit").join(large, keys), keys)
    near = durable(_leaders_of_cells(found, cells, group)).select(*keys, F.col("cell").alias("_cell"), "_within")
    rows = df.join(large.withColumnRenamed("unit", "_unit"), keys).withColumn("_cell", cell_number(F.col("value"), F.col("_unit")))
    own = F.element_at(F.filter("_within", lambda x: x["leader"] <= F.col("value")), -1)
    placed = rows.join(near, [*keys, "_cell"]).withColumn("_one", own)
    return out.unionByName(placed.withColumns({"cluster": F.col("_one.cluster"), "leader": F.col("_one.leader")}).select(*out.columns))
