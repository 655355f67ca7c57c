"""Puts a DuckDB query together from named common table expressions."""

from __future__ import annotations

import re


def text_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def pick(values: list[str], index: str) -> str:
    """Zero-based pick from a list, NULL past its end."""
    return f"list_extract({text_list(values)}, ({index}) + 1)"


def rnd(expression: str, digits: int) -> str:
    """Half away from zero on the decimal value, after dropping the noise of summation."""
    return f"round(cast({expression} as decimal(38, 8)), {digits})::double"


def day(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d')"


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def values_table(rows: list[dict], types: dict[str, str]) -> str:
    def literal(value, sql_type: str) -> str:
        quoted = "'" + str(value).replace("'", "''") + "'"
        return f"cast({quoted} as {sql_type})"

    lines = ",\n    ".join(
        "(" + ", ".join(literal(r[c], t) for c, t in types.items()) + ")" for r in rows)
    return f"select * from (values\n    {lines}) v({', '.join(types)})"


def assemble(ctes: dict[str, str], final: str) -> str:
    """The final select with the expressions it needs, directly or not, in front."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in ordered and re.search(rf"\b{name}\b", sql):
                visit(ctes[name])
                if name not in ordered:
                    ordered.append(name)

    visit(final)
    if not ordered:
        return final
    return "with " + ",\n".join(f"{n} as (\n{ctes[n]}\n)" for n in ordered) + "\n" + final
