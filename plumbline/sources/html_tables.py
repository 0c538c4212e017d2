"""HTML tables near an anchor phrase, and the figures their rows state."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions import text as tx
from plumbline.metrics import MetricSpec
from plumbline.sources.phrases import Places, hint
from plumbline.sources.prose import first_distinct, shown

_TAG = re.compile(r"<!--.*?-->|<(/?)(table|tr|td|th)\b[^>]*>", re.S | re.I)


@dataclass
class Table:
    """A table of a page: where it lies, the table around it, its rows of cells as stretches of the page."""

    start: int
    body: int
    up: int | None
    end: int = -1
    rows: list[list[list[tuple[int, int]]]] = field(default_factory=list)
    # Where the open cell's text goes on; None outside of cells.
    cell: int | None = None
    in_row: bool = False


def table_tree(page: str) -> list[Table]:
    """The tables of a page in the order they start, nested ones with rows of their own.

    Tags may be in any case. A cell ends at the next cell, row or end of its table; text of a
    nested table is not the outer cell's. A table that is never closed reaches to the page's end.
    """
    tables: list[Table] = []
    open_: list[int] = []

    def pause(t: Table, at: int) -> None:
        if t.cell is not None:
            t.rows[-1][-1].append((t.cell, at))

    def close(t: Table, at: int, row: bool) -> None:
        pause(t, at)
        t.cell = None
        t.in_row = t.in_row and not row

    for m in _TAG.finditer(page):
        name = (m[2] or "").lower()
        if name == "table" and not m[1]:
            if open_:
                pause(tables[open_[-1]], m.start())
            tables.append(Table(m.start(), m.end(), open_[-1] if open_ else None))
            open_.append(len(tables) - 1)
            continue
        if not open_:
            continue
        t = tables[open_[-1]]
        if not name:
            # A comment is no text of its cell.
            pause(t, m.start())
            t.cell = m.end() if t.cell is not None else None
            continue
        if name == "table":
            close(t, m.start(), True)
            t.end = m.end()
            open_.pop()
            if open_ and tables[open_[-1]].cell is not None:
                tables[open_[-1]].cell = m.end()
        elif m[1]:
            close(t, m.start(), name == "tr")
        elif name == "tr":
            close(t, m.start(), True)
            t.rows.append([])
            t.in_row = True
        else:
            close(t, m.start(), False)
            if not t.in_row:
                t.rows.append([])
                t.in_row = True
            t.rows[-1].append([])
            t.cell = m.end()
    for n in reversed(open_):
        close(tables[n], len(page), True)
        tables[n].end = len(page)
    return tables


def _rows_of(page: str, table: Table) -> list[list[str]]:
    rows = []
    for row in table.rows:
        cells = [shown(" ".join(page[a:b] for a, b in cell)) for cell in row]
        cells = [c for c in cells if c]
        if cells:
            rows.append(cells)
    return rows


def html_tables(
    docs: DataFrame, keys: Sequence[str], html: str, phrases: Sequence[str], enclosing: bool = False,
    within: int | None = None, preamble: int | None = None,
) -> DataFrame:
    """Rows of the tables an anchor phrase points at, one row per table row.

    By default an anchor points at the first table that starts after it, no further away than
    ``within`` characters if given; with ``enclosing`` at the innermost table it stands in. Tables
    inside others have numbers and rows of their own. Each row carries its table's header cells
    and the text between the table before (or the start of the table around) and its own, or its
    last ``preamble`` characters. Documents stay where they are and rows stream out of each
    partition; a null page has no tables.
    """
    fields = [docs.schema[k] for k in keys]
    schema = T.StructType(fields + [
        T.StructField("table_no", T.IntegerType()), T.StructField("anchor_pos", T.IntegerType()),
        T.StructField("row_no", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("header", T.ArrayType(T.StringType())), T.StructField("preamble", T.StringType()),
    ])
    names = schema.names
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Places(phrases)
        for batch in batches:
            of_page, out = [], []
            for number, page in enumerate(batch.column(len(fields)).to_pylist()):
                tables = table_tree(page)
                starts, ends = [t.start for t in tables], sorted(t.end for t in tables)
                first: dict[int, int] = {}
                for pos in wanted.of(page):
                    at: int | None = bisect_left(starts, pos)
                    if enclosing:
                        at = at - 1 if at else None
                        while at is not None and tables[at].end <= pos:
                            at = tables[at].up
                    elif at == len(tables) or within is not None and starts[at] - pos > within:
                        at = None
                    if at is not None:
                        first.setdefault(at, pos)
                for at, pos in first.items():
                    own = tables[at]
                    rows = _rows_of(page, own)
                    done = bisect_right(ends, own.start)
                    begin = max(ends[done - 1] if done else 0, tables[own.up].body if own.up is not None else 0)
                    before = shown(page[begin:own.start])
                    before = before if preamble is None else before[-preamble:] if preamble else ""
                    for n, cells in enumerate(rows):
                        of_page.append(number)
                        out.append((at, pos, n, cells, rows[0], before))
            if out:
                found = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
                place = pa.array(of_page, pa.int32())
                yield pa.RecordBatch.from_arrays([*(c.take(place) for c in batch.columns[:-1]), *found], names=names)

    near, words = docs.where(F.col(html).rlike("(?i)<table")), hint(phrases)
    if words is not None:
        near = near.where(F.col(html).rlike(words))
    return near.select(*keys, html).mapInArrow(scan, schema)


# What an expense table and a return table look like.
FEE_ANCHORS = ("Annual Expenses", "Annual Fund Operating Expenses", "Fees and Expenses", "Shareholder Fees",
               "Summary of Fund Expenses")
RETURN_ANCHORS = ("Average Annual Total Return", "Average Annual Total Returns")
HIGHLIGHT_ANCHORS = ("Net asset value, end of",)
CLASS_HEADING = r"\b(Class\s+[A-Z]{1,2}|Institutional\s+(?:Class|Shares))\b"
ROW_NAV, ROW_RETURN = r"^net asset value,? end of", r"^total return"
ROW_DIVIDENDS = r"^(total )?(dividends|distributions)( and/or distributions)? to shareholders"


def fee_tables(docs: DataFrame, keys: Sequence[str], html: str, within: int | None = None) -> DataFrame:
    """Fee rates of expense tables, and "none charged" where a complete table
    lists a management fee and totals but no incentive fee."""
    rows = html_tables(docs, keys, html, FEE_ANCHORS, within=within).withColumn("label", F.lower(F.col("cells")[0]))
    label = F.col("label")
    metric = F.when(label.rlike("^(management fee|investment management fee|advisory fee)"), F.lit("management_fee_pct")).when(
        label.rlike("^incentive fee"), F.lit("incentive_fee_pct"))
    percent = tx.percent_token(F.try_element_at("cells", F.lit(2)))
    denominator = F.when(F.contains(F.lower(F.col("header")[0]), F.lit("net asset")), F.lit("net_assets")).otherwise(F.lit("unstated"))
    basis = lambda of: F.create_map(F.lit("fee_basis"), of)
    rate = F.when(F.col("metric").isNotNull() & F.col("value").isNotNull(), F.struct(
        "metric", "value", basis(F.concat(F.lit("pct_of_"), "_d")).alias("basis"),
        F.when(F.col("_d") == "unstated", F.array(F.lit("fee_denominator_unstated"))).otherwise(F.array().cast("array<string>")).alias("flags"),
        F.struct("anchor_pos", "row_no").alias("_at")))
    # One pass over the pages: a table's rates and what else it lists are gathered together.
    tables = rows.withColumns({"metric": metric, "value": percent, "_d": denominator}).groupBy(*keys, "table_no").agg(
        F.collect_list(rate).alias("_stated"),
        F.bool_or(label.rlike("total annual")).alias("_t"), F.bool_or(label.rlike("other expenses")).alias("_o"),
        F.bool_or(label.rlike("^(investment )?management fee")).alias("_m"), F.bool_or(label.rlike("incentive")).alias("_i"),
        F.min("anchor_pos").alias("anchor_pos"))
    none = F.when(F.expr("_t and _o and _m and not _i"), F.struct(
        F.lit("incentive_fee_pct").alias("metric"), F.lit(0.0).alias("value"), basis(F.lit("none_disclosed")).alias("basis"),
        F.array(F.lit("inferred_from_absence")).alias("flags"),
        F.struct("anchor_pos", F.lit(1 << 30).alias("row_no")).alias("_at")))
    found = tables.select(*keys, F.explode(F.array_compact(F.array_append("_stated", none))).alias("_f")).select(*keys, "_f.*")
    return first_distinct(found, [*keys, "metric", "value"], "_at").drop("_at")


def return_tables(docs: DataFrame, keys: Sequence[str], html: str, within: int | None = None) -> DataFrame:
    """Stated trailing returns: header text names the period of each column."""
    rows = html_tables(docs, keys, html, RETURN_ANCHORS, within=within).where(F.col("row_no") > 0)

    def period(cell: Column) -> Column:
        return (
            F.when(cell.rlike(r"(?i)(5\s*year|five\s*year)"), F.lit("net_return_5y_pct"))
            .when(cell.rlike(r"(?i)(3\s*year|three\s*year)"), F.lit("net_return_3y_pct"))
            .when(cell.rlike(r"(?i)(1\s*year|one\s*year)"), F.lit("net_return_1y_pct"))
        )

    cells = rows.select(*keys, "anchor_pos", "row_no", "cells", F.posexplode("header").alias("_i", "_h"))
    return cells.select(
        *keys, "anchor_pos", "row_no", period(F.col("_h")).alias("metric"),
        tx.percent_token(F.get("cells", F.col("_i"))).alias("value"),
        F.col("cells")[0].alias("share_class"),
    ).where(F.col("metric").isNotNull() & F.col("value").isNotNull())


def highlights_tables(
    docs: DataFrame, keys: Sequence[str], html: str, specs: Sequence[MetricSpec] = ()
) -> DataFrame:
    """One row per year-columned table: class, years and aligned series."""
    rows = html_tables(docs, keys, html, HIGHLIGHT_ANCHORS, enclosing=True)
    return highlights_from_rows(rows, [*keys, "table_no"], specs)


def highlights_from_rows(rows: DataFrame, keys: Sequence[str], specs: Sequence[MetricSpec] = ()) -> DataFrame:
    """The same from table rows: keys, row_no, cells, preamble."""
    label = F.lower(F.col("cells")[0])
    rest = F.slice("cells", F.lit(2), F.greatest(F.size("cells") - 1, F.lit(0)))
    head = F.col("cells")[0]
    own = F.when(~head.rlike(tx.YEAR), tx.squash(head)).otherwise(tx.squash(F.coalesce(
        F.try_element_at(F.regexp_extract_all(F.coalesce("preamble", F.lit("")), F.lit(CLASS_HEADING), F.lit(1)), F.lit(-1)),
        F.lit(""))))
    listed = {f"_is_{s.key}": F.col("_label").rlike("(?i)" + "|".join(f"(?:{p})" for p in s.highlight_rows))
              for s in specs if s.highlight_rows}
    asked = F.lit(False)
    for name in listed:
        asked = asked | F.col(name)
    # Numbers, and the class, are read in the rows whose name or years call for them.
    marked = rows.withColumns({"_label": label, "_y": tx.header_years(F.col("cells"))}).withColumns({
        "_nav": F.col("_label").rlike(ROW_NAV), "_ret": F.col("_label").rlike(ROW_RETURN),
        "_div": F.col("_label").rlike(ROW_DIVIDENDS), **listed}).withColumns({
            "_v": F.when(F.col("_nav") | F.col("_ret") | F.col("_div"), tx.numeric_tokens(rest)),
            "_w": F.when(asked, tx.numeric_tokens(rest, True)), "_c": F.when(F.size("_y") >= 2, own)})
    is_nav, is_ret = F.col("_nav"), F.col("_ret")
    is_div = F.col("_div") & ~is_nav & ~is_ret & (F.size("_v") > 0)
    title = F.size("_y") >= 2
    pick = lambda cond, how: how(F.when(cond, F.struct("row_no", "_v")))["_v"]
    extra = []
    for s in specs:
        if s.highlight_rows:
            named = F.col(f"_is_{s.key}") & ~is_nav & ~is_ret & ~is_div
            extra.append(F.min(F.when(named, F.struct("row_no", "_w")))["_w"].alias(f"row_{s.key}"))
    out = marked.groupBy(*keys).agg(
        F.min(F.when(title, F.struct("row_no", F.col("_y").alias("y"), F.col("_c").alias("c")))).alias("_t"),
        # A later row of the same name replaces an earlier one, except payouts.
        pick(is_nav, F.max).alias("nav_end"), pick(is_ret, F.max).alias("total_return"),
        pick(is_div, F.min).alias("dividends"), *extra,
    ).where(F.col("_t").isNotNull() & ((F.size("nav_end") > 0) | (F.size("total_return") > 0)))
    n = F.size("_t.y")
    cut = lambda c: F.when(F.col(c).isNotNull(), F.slice(c, F.lit(1), n))
    return out.select(
        *keys, F.when(F.col("_t.c") == "", F.lit("unlabelled")).otherwise(F.col("_t.c")).alias("share_class"),
        F.col("_t.y").alias("years"), cut("nav_end").alias("nav_end"), cut("total_return").alias("total_return"),
        F.transform(cut("dividends"), F.abs).alias("dividends"),
        *[cut(f"row_{s.key}").alias(s.key) for s in specs if s.highlight_rows],
    )
