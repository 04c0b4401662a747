"""Assembles each check query: needed fixture tables as CTEs, then the body with plain output types."""

from __future__ import annotations

import re

from oracle.bodies import BODIES, SHARED
from oracle.fixtures import FIXTURES

_TYPES = {"i": "bigint", "d": "double", "t": "timestamp"}


def _closure(text: str, known: dict[str, str]) -> list[str]:
    """Names of the CTEs a text uses, each after the ones it builds on."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in known:
            if name not in ordered and re.search(rf"\b{name}\b", sql):
                visit_one(name)

    def visit_one(name: str) -> None:
        inner = known[name]
        for other in known:
            if other != name and other not in ordered and re.search(rf"\b{other}\b", inner):
                visit_one(other)
        if name not in ordered:
            ordered.append(name)

    visit(text)
    return ordered


def _output(columns: str) -> str:
    """``name:kind`` pairs to a select list; kinds are i(nteger), d(ouble), t(imestamp) or none."""
    parts = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        quoted = f'"{name}"'
        parts.append(f"cast({quoted} as {_TYPES[kind]}) as {quoted}" if kind else quoted)
    return ", ".join(parts)


def oracle_queries() -> dict[str, str]:
    known = {**FIXTURES, **SHARED}
    built = {}
    for key, (columns, body) in BODIES.items():
        names = _closure(body, known)
        head = ",\n".join(f"{n} as ({known[n].strip()})" for n in names)
        prefix = f"with {head}\n" if head else ""
        built[key] = f"{prefix}select {_output(columns)} from (\n{body.strip()}\n) as answer"
    return built
