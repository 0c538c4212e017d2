"""Registration of queries and assembly of the SQL they are checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def fragment(name: str, sql: str) -> None:
    """A named SQL subquery other SQL may use as if it were a table."""
    FRAGMENTS[name] = sql


def variant(prefix: str, root: str, target: str) -> None:
    """Copies, under prefixed names, of the fragments that lead from ``root`` to ``target``.

    The prefixed root itself is stated by the caller.
    """
    above: set[str] = {root}
    while True:
        more = {n for n, sql in FRAGMENTS.items() if n not in above and above & set(_WORD.findall(sql))}
        if not more:
            break
        above |= more
    needed = [n for n in _ordered(FRAGMENTS[target]) + [target] if n in above]
    for name in needed:
        if name != root:
            FRAGMENTS[prefix + name] = _WORD.sub(
                lambda w: prefix + w.group() if w.group() in needed else w.group(), FRAGMENTS[name])


def _ordered(sql: str) -> list[str]:
    out: list[str] = []

    def visit(body: str, own: str = "") -> None:
        for word in dict.fromkeys(_WORD.findall(body)):
            if word in FRAGMENTS and word not in out and word != own:
                visit(FRAGMENTS[word], word)
                if word not in out:
                    out.append(word)

    visit(sql)
    return out


def compose(sql: str) -> str:
    names = _ordered(sql)
    if not names:
        return sql
    parts = ",\n".join(f"{n} AS (\n{FRAGMENTS[n].strip()}\n)" for n in names)
    return f"WITH RECURSIVE {parts}\n{sql.strip()}"


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def oracle_sql() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLES.items()}
