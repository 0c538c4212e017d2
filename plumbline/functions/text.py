"""Labels, citations and token readers as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from plumbline import rules

# Fixed patterns. (?U) makes \s and \b Unicode-aware, as the sources need.
PERCENT = r"([0-9]{1,3}(?:\.[0-9]{1,4})?)\s*%"
YEAR = r"\b((?:19|20)\d{2})\b"
DECIMAL = r"\(?\d[\d,]*\.\d+\)?"
NUMBER = r"\(?\d[\d,]*(?:\.\d+)?\)?"


def basis_key(basis: Column) -> Column:
    """Canonical text of a basis map: sorted ``k=v`` pairs joined by ``|``."""
    pairs = F.sort_array(F.map_entries(basis))
    return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")


def format_basis(basis: Column) -> Column:
    """Readable basis statement; keys ending in ``_basis`` show the value alone."""

    def part(e: Column) -> Column:
        value = F.replace(e["value"], F.lit("_"), F.lit(" "))
        name = F.replace(e["key"], F.lit("_"), F.lit(" "))
        return F.when(e["key"].endswith("_basis"), value).otherwise(F.concat(name, F.lit(": "), value))

    return F.array_join(F.transform(F.sort_array(F.map_entries(basis)), part), "; ")


def significant(value: Column, digits: int = 4) -> Column:
    """Shortest text with so many significant digits, like the %g conversion."""
    exponent = F.when(value == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(value))).cast("int"))
    text = F.format_string(f"%.{digits - 1}e", value)
    for power in range(-4, digits):
        fixed = F.format_string(f"%.{digits - 1 - power}f", value)
        text = F.when(exponent == power, fixed).otherwise(text)
    trimmed = F.regexp_replace(text, r"(\.[0-9]*?)0+(e|$)", "$1$2")
    return F.regexp_replace(trimmed, r"\.(e|$)", "$1")


def format_value(value: Column, unit: Column) -> Column:
    return (
        F.when(value.isNull(), F.lit("--"))
        .when(unit == "pct", F.concat(F.format_string("%.2f", value), F.lit("%")))
        .when(unit == "ratio", F.concat(F.format_string("%.2f", value), F.lit("x")))
        .when(unit == "usd", F.concat(F.lit("$"), F.format_number(value, 2)))
        .otherwise(significant(value))
    )


def normalize_label(label: Column) -> Column:
    return F.lower(F.regexp_replace(label, r"(?U)\s+", ""))


def squash(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_quote(text: Column) -> Column:
    """Typography-tolerant form used to test that a passage is in its source."""
    plain = F.translate(text, "’“”–— ", "'\"\"-- ")
    return F.lower(squash(plain))


def numeric_tokens(cells: Column, allow_integers: bool = False) -> Column:
    """Ordered numbers of a row; split parentheses are rejoined and negative."""
    joined = F.translate(F.array_join(cells, " "), "$%", "  ")
    repaired = F.regexp_replace(joined, r"\(\s*([\d,]*\.?\d+)\s*\)", "($1)")
    tokens = F.regexp_extract_all(repaired, F.lit(NUMBER if allow_integers else DECIMAL), F.lit(0))

    def number(tok: Column) -> Column:
        magnitude = F.translate(tok, "(),", "").cast("double")
        return F.when(tok.startswith("("), -magnitude).otherwise(magnitude)

    return F.transform(tokens, number)


def header_years(cells: Column) -> Column:
    """The last year named in each cell that names one."""
    found = F.transform(cells, lambda c: F.regexp_extract_all(c, F.lit(YEAR), F.lit(1)))
    named = F.filter(found, lambda ys: F.size(ys) > 0)
    return F.transform(named, lambda ys: F.element_at(ys, -1).cast("int"))


def percent_token(cell: Column) -> Column:
    return F.try_element_at(
        F.regexp_extract_all(cell, F.lit(PERCENT), F.lit(1)), F.lit(1)
    ).cast("double")


def padded_id(ident: Column) -> Column:
    return F.lpad(ident.cast("string"), 10, "0")


def filing_url(root: str, ident: Column, accession: Column) -> Column:
    bare = F.replace(accession, F.lit("-"), F.lit(""))
    return F.concat(
        F.lit(root + "/"), ident.cast("bigint").cast("string"), F.lit("/"), bare, F.lit("/"),
        accession, F.lit("-index.htm"),
    )


def fact_locator(qname: Column, unit: Column, start: Column, end: Column, note: Column) -> Column:
    period = F.when(
        start.isNotNull() & end.isNotNull(),
        F.concat(start.cast("string"), F.lit(".."), end.cast("string")),
    ).otherwise(F.coalesce(end.cast("string"), F.lit("?")))
    tail = F.when(F.coalesce(note, F.lit("")) != "", F.concat(F.lit(" ("), note, F.lit(")"))).otherwise("")
    return F.concat(F.lit("XBRL "), qname, F.lit(" ["), unit, F.lit("] @ "), period, tail)


def citation(entity: Column, form: Column, period_end: Column, accession: Column, locator: Column) -> Column:
    return F.concat_ws(
        " | ",
        entity,
        form,
        F.when(period_end.isNotNull(), F.concat(F.lit("period ended "), period_end.cast("string"))),
        F.concat(F.lit("acc. "), accession),
        locator,
    )


def stale_detail(form, period_end, as_of, filing_date, terms_clock, reference) -> Column:
    """Why a value aged out: which document, what period, filed when."""
    source = F.when(F.coalesce(form, F.lit("")) == "", F.lit("source")).otherwise(form)
    age = F.date_diff(reference, F.coalesce(terms_clock, as_of)).cast("string")
    tail = F.concat(
        age, F.lit("d behind the "), reference.cast("string"),
        F.lit(f" anchor, beyond the {rules.STALE_LIMIT_DAYS}d limit"),
    )
    covers = (
        F.when(period_end.isNotNull(), F.concat(F.lit("for period ended "), period_end.cast("string")))
        .when(as_of.isNotNull(), F.concat(F.lit("dated "), as_of.cast("string")))
        .otherwise(F.lit("with no period stated"))
    )
    filed = F.when(
        filing_date.isNotNull(), F.concat(F.lit(" (filed "), filing_date.cast("string"), F.lit(")"))
    ).otherwise(F.lit(""))
    return F.when(
        terms_clock.isNotNull(),
        F.concat(
            source, F.lit(" carries no amendment to this rate through "),
            terms_clock.cast("string"), F.lit("; "), tail,
        ),
    ).otherwise(F.concat(source, F.lit(" "), covers, filed, F.lit(" is "), tail))


def coverage_label(start: Column, end: Column) -> Column:
    """Length actually covered: years with one decimal, else whole months."""
    days = F.date_diff(end, start)
    years = days / F.lit(rules.YEAR_DAYS)
    length = F.when(years >= 1.0, F.concat(F.format_string("%.1f", years), F.lit("y"))).otherwise(
        F.concat(F.bround(days / F.lit(rules.MONTH_DAYS), 0).cast("int").cast("string"), F.lit("mo"))
    )
    label = F.concat(
        length, F.lit(" available ("), start.cast("string"), F.lit(" to "), end.cast("string"), F.lit(")")
    )
    return F.coalesce(label, F.lit(""))


def blank_label(detail: Column, as_of: Column, start: Column, end: Column) -> Column:
    """What a blank cell says: detail, coverage, and the last date available."""
    label = coverage_label(start, end)
    parts = F.concat_ws(
        "; ",
        F.rtrim(detail, F.lit(".")),
        F.when(label != "", label),
        F.when(as_of.isNotNull() & end.isNull(), F.concat(F.lit("last available "), as_of.cast("string"))),
    )
    return F.concat(parts, F.lit("."))


def superseded_label(value: Column, superseded: Column, until: Column) -> Column:
    """A superseded rate is never shown bare."""
    text = significant(value, 6)
    return (
        F.when(superseded & until.isNotNull(),
               F.concat(text, F.lit("% (superseded as of "), until.cast("string"), F.lit(")")))
        .when(superseded, F.concat(text, F.lit("% (superseded, date not stated in filing)")))
        .otherwise(text)
    )
