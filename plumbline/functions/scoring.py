"""Agreement, freshness, penalties, grades and in-force tests as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from plumbline import rules


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_map(table: dict) -> Column:
    """A small fixed table as a constant map."""
    return F.expr("map(" + ", ".join(_literal(x) for pair in table.items() for x in pair) + ")")


def lookup(col: Column, table: dict, default=None) -> Column:
    """Value of ``col`` in a small fixed table."""
    found = F.element_at(literal_map(table), col)
    return found if default is None else F.coalesce(found, F.lit(default))


def tier_score(tier: Column) -> Column:
    return lookup(tier, rules.TIER_SCORES)


def _tolerance_part(unit: Column, i: int) -> Column:
    parts = {u: float(t[i]) for u, t in rules.TOLERANCES.items()}
    return lookup(unit, parts, parts["pct"])


def tolerance_parts(unit: Column) -> tuple[Column, Column]:
    """(absolute, relative) tolerance of a unit."""
    return _tolerance_part(unit, 0), _tolerance_part(unit, 1)


def values_agree(a: Column, b: Column, unit: Column) -> Column:
    """Whether two values lie within the looser of the two tolerances."""
    mid = (F.abs(a) + F.abs(b)) / 2
    mid = F.when(mid == 0, F.lit(1.0)).otherwise(mid)
    return F.abs(a - b) <= F.greatest(_tolerance_part(unit, 0), mid * _tolerance_part(unit, 1))


def agree_sql(a: str, b: str, unit: str) -> str:
    """``values_agree`` as SQL text, for use inside array expressions."""

    def part(i: int) -> str:
        whens = " ".join(f"when '{u}' then {t[i]!r}D" for u, t in rules.TOLERANCES.items())
        return f"case {unit} {whens} else {rules.TOLERANCES['pct'][i]!r}D end"

    mid = f"(abs({a}) + abs({b})) / 2"
    return (
        f"(abs({a} - {b}) <= greatest({part(0)}, {part(1)} * if({mid} = 0, 1D, {mid})))"
    )


def freshness(as_of: Column, reference: Column) -> Column:
    age = F.date_diff(reference, as_of)
    expr = F.when(as_of.isNull(), F.lit(rules.FRESHNESS_STALE))
    for limit, factor in rules.FRESHNESS_BANDS:
        expr = expr.when(age <= limit, F.lit(factor))
    return expr.otherwise(F.lit(rules.FRESHNESS_STALE))


def flag_multiplier(flag: Column) -> Column:
    """Multiplier of one flag: exact name, else first prefix or suffix match."""
    rules_in_order = F.expr("array(" + ", ".join(
        f"struct({_literal(name)} as name, {_literal(value)} as value)" for name, value in rules.FLAG_MULTIPLIERS
    ) + ")")
    near = F.filter(rules_in_order, lambda r: F.startswith(flag, r["name"]) | F.endswith(flag, r["name"]))
    return F.coalesce(
        F.element_at(literal_map(dict(rules.FLAG_MULTIPLIERS)), flag),
        F.get(near, 0)["value"],
        F.lit(rules.UNKNOWN_FLAG_MULTIPLIER),
    )


def penalty_product(flags: Column) -> Column:
    """Product of all flag multipliers; 1.0 for an unflagged row."""
    return F.aggregate(
        F.coalesce(flags, F.array().cast("array<string>")),
        F.lit(1.0),
        lambda acc, flag: acc * flag_multiplier(flag),
    )


def has_any_flag(flags: Column, names) -> Column:
    return F.arrays_overlap(flags, F.array(*[F.lit(n) for n in names]))


def grade(score: Column) -> Column:
    cuts = rules.GRADE_CUTS
    expr = reduce(
        lambda e, cut: e.when(score >= cut[1], F.lit(cut[0])),
        cuts[1:],
        F.when(score >= cuts[0][1], F.lit(cuts[0][0])),
    )
    return expr.otherwise(F.lit(rules.SUPPRESSED))


def clamp01(score: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def in_force(valid_from: Column, valid_until: Column, when: Column) -> Column:
    """true / false / NULL: NULL means the source gives no dates (end exclusive)."""
    return (
        F.when(valid_from.isNull() & valid_until.isNull(), F.lit(None).cast("boolean"))
        .when(valid_from > when, F.lit(False))
        .when(valid_until <= when, F.lit(False))
        .otherwise(F.lit(True))
    )


def add_flag(flags: Column, name: str, condition: Column) -> Column:
    """Append a flag once, where the condition holds."""
    return F.when(condition, F.array_union(flags, F.array(F.lit(name)))).otherwise(flags)


def out_of_range(value: Column, low: Column, high: Column) -> Column:
    ninf, pinf = F.lit(float("-inf")), F.lit(float("inf"))
    return ~value.between(F.coalesce(low, ninf), F.coalesce(high, pinf))


def is_stale(clock: Column, reference: Column, limit: int = rules.STALE_LIMIT_DAYS) -> Column:
    return F.coalesce(F.date_diff(reference, clock) > limit, F.lit(False))
