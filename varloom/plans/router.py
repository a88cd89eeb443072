"""Rule-set router: the compiled plans of many rule sets in one chain of projections.

A response belongs to one rule set only. Side by side, the projections of all rule sets would be evaluated for every row; here
a column is shared by all of them instead. The columns that the plans make at the same depth are dealt to shared slots of
the same type; a slot's expression is

* one expression, where the rule sets differ in literals only (keys, bounds, fills): each differing literal becomes an
  element of a constant array, ``array('q1', 'q7', ...)[rule set]``, which the optimizer folds, so neither
  the code nor the time per row grows with the number of rule sets;
* else a choice between the different expressions, by halves, of which a row evaluates the one of its own rule set.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import zip_longest

from varloom.plans.compiler import PFX, CompiledPlan

ROUTE = f"`{PFX}route`"

_STRING = r"'(?:[^'\\]|\\.)*'"
_PARTS = re.compile(rf"({_STRING}|CAST\(NULL AS STRING\)|CAST\(-?[0-9][0-9.e+-]* AS DOUBLE\)|`[^`]*`)", re.DOTALL)


def _split(sql: str) -> tuple[tuple[str, ...], list[str], list[str]]:
    """(shape, literals, names): the texts between literals and column names with their kinds, and those."""
    shape, literals, names = [], [], []
    for part in _PARTS.split(sql):
        if part.startswith("`"):
            names.append(part)
            shape.append("`")
        elif part.startswith("'") or part == "CAST(NULL AS STRING)":
            literals.append(part)
            shape.append("'")
        elif part.startswith("CAST(") and part.endswith("AS DOUBLE)") and _PARTS.fullmatch(part):
            literals.append(part)
            shape.append("#")
        else:
            shape.append(part)
    return tuple(shape), literals, names


def _join(shape: tuple[str, ...], literals: list[str], names: list[str]) -> str:
    lit, name = iter(literals), iter(names)
    return "".join(next(name) if s == "`" else next(lit) if s in ("'", "#") else s for s in shape)


def _kind(alias: str) -> str:
    """What a plan's column holds: columns of one kind have one type."""
    own = alias.removeprefix(PFX)
    version = re.fullmatch(r"[kv][0-9]+_([a-z_]+)", own)
    return version.group(1) if version else re.match(r"[a-z]+", own).group()


class Router:
    """Shares columns between plans; ``columns[i]`` names the slots of plan i's columns."""

    def __init__(self, plans: list[CompiledPlan]):
        self.plans = plans
        self.columns: list[dict[str, str]] = [{} for _ in plans]
        self.layers = [self._layer(depth, parts) for depth, parts in
                       enumerate(zip_longest(*(p.layers for p in plans), fillvalue=()))]

    def _layer(self, depth: int, parts) -> list[tuple[str, str]]:
        slots: dict[tuple[str, int], dict[int, str]] = {}
        named: list[tuple[int, str, str]] = []
        for i, part in enumerate(parts):
            by_kind = defaultdict(list)
            for alias, sql in part:
                by_kind[_kind(alias)].append((_split(sql)[0], alias, sql))
            for kind, items in by_kind.items():
                # like shapes meet in the same slot
                for j, (_, alias, sql) in enumerate(sorted(items, key=lambda x: x[0])):
                    slots.setdefault((kind, j), {})[i] = self._renamed(i, sql)
                    named.append((i, alias, f"{PFX}{depth}_{kind}_{j}"))
        out = [(f"{PFX}{depth}_{kind}_{j}", self.choose(sql)) for (kind, j), sql in slots.items()]
        for i, alias, slot in named:
            self.columns[i][alias] = slot
        return out

    def _renamed(self, i: int, sql: str) -> str:
        shape, literals, names = _split(sql)
        own = self.columns[i]
        return _join(shape, literals, [f"`{own.get(n[1:-1], n[1:-1])}`" for n in names])

    def expression(self, per_plan: dict[int, str]) -> str:
        """One expression over the shared columns out of one per plan; null for rows of plans without one."""
        return self.choose({i: self._renamed(i, sql) for i, sql in per_plan.items()})

    def choose(self, per_plan: dict[int, str]) -> str:
        like: dict[tuple, dict[int, list[str]]] = {}
        for i, sql in per_plan.items():
            shape, literals, names = _split(sql)
            like.setdefault((shape, tuple(names)), {})[i] = literals
        texts = [self._shared(shape, list(names), rows) for (shape, names), rows in like.items()]
        if len(texts) == 1 and len(per_plan) == len(self.plans):
            return texts[0]
        place = ["-1"] * len(self.plans)
        for k, rows in enumerate(like.values()):
            for i in rows:
                place[i] = str(k)
        return _halves(f"array({', '.join(place)})[{ROUTE}]", texts, 0)

    def _shared(self, shape, names, rows: dict[int, list[str]]) -> str:
        literals = []
        for values in zip(*rows.values(), strict=True):
            if len(set(values)) == 1:
                literals.append(values[0])
                continue
            of = dict(zip(rows, values, strict=True))
            null = "CAST(NULL AS DOUBLE)" if values[0].endswith("AS DOUBLE)") else "CAST(NULL AS STRING)"
            literals.append(f"array({', '.join(of.get(i, null) for i in range(len(self.plans)))})[{ROUTE}]")
        return _join(shape, literals, names)


def _halves(place: str, texts: list[str], first: int) -> str:
    if len(texts) == 1:
        return f"CASE WHEN {place} = {first} THEN {texts[0]} END"
    half = len(texts) // 2
    return f"CASE WHEN {place} < {first + half} THEN {_halves(place, texts[:half], first)} ELSE {_halves(place, texts[half:], first + half)} END"
