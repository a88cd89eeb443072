"""All-surveys derivation (O10).

The reference runs one derivation job per active survey, eight at a time.
Here it is one projection over one scan: surveys with the same rules form a
group, each group's rules are compiled once, and the router lets the groups share their
columns, so a row pays for its own rules only. The number of scans does not depend on the number of surveys, and
there is no shuffle.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.values import sql_str
from varloom.operators.derive import merged_map_sql, present_text
from varloom.plans.compiler import PFX, CompiledPlan, compile_rules
from varloom.plans.router import ROUTE, Router
from varloom.sources.surveys import active_surveys


def compile_groups(rules: dict[str, list[dict]], mode: str, failed: dict[str, str] | None, builders: dict | None = None) -> list[tuple[list[str], CompiledPlan]]:
    """(surveys, plan) per distinct rule set; a survey whose rules do not compile goes to ``failed``, or raises without it."""
    groups: dict[tuple, list[str]] = {}
    for survey, rows in sorted(rules.items()):
        groups.setdefault(tuple(tuple(sorted((k, repr(v)) for k, v in r.items() if k != "rule_no")) for r in rows), []).append(survey)
    out = []
    for surveys in groups.values():
        try:
            plan = compile_rules(rules[surveys[0]], mode, builders=builders)
        except ValueError as e:
            if failed is None:
                raise
            failed.update({s: str(e) for s in surveys})
            warnings.warn(f"surveys {surveys} are left out: {e}", stacklevel=3)
            continue
        out.append((surveys, plan))
    return out


def derive_all_surveys(responses: DataFrame, rules: DataFrame, surveys: DataFrame | None = None, *,
                       mode: str = "intended", output: str = "wide", failed: dict[str, str] | None = None,
                       builders: dict | None = None) -> DataFrame:
    """Responses of all (active) surveys that have rules, with their derived variables.

    ``output``: ``wide`` (a column per variable of any survey), ``map`` or ``long``, as in ``derive``.
    With a dict as ``failed`` a survey with an unsupported rule is reported there and left out, and the rest is
    derived; without one it raises. ``builders``: rules of one's own, as in ``derive``.
    """
    if output not in ("wide", "map", "long"):
        raise ValueError("output must be 'wide', 'map' or 'long'")
    if surveys is not None:
        rules = rules.join(active_surveys(surveys).select("survey_id"), "survey_id", "left_semi")
    by_survey: dict[str, list[dict]] = {}
    for row in rules.orderBy("survey_id", "rule_no").collect():  # the rule tables themselves
        d = row.asDict()
        by_survey.setdefault(d.pop("survey_id"), []).append(d)
    groups = compile_groups(by_survey, mode, failed, builders)
    if not groups:
        raise ValueError("no active survey has rules")

    ids = [s for surveys, _ in groups for s in surveys]
    df = responses.filter(F.col("survey_id").isin(ids))
    # the place of a survey in the list of surveys, then its group: looked up once per row
    at = ", ".join(str(i) for i, (surveys, _) in enumerate(groups) for _ in surveys)
    df = df.selectExpr("*", f"array({at})[CAST(array_position(array({', '.join(map(sql_str, ids))}), survey_id) AS INT) - 1] AS {ROUTE}")
    plans = [plan for _, plan in groups]
    router = Router(plans)
    for layer in router.layers:
        df = df.selectExpr("*", *(f"{sql} AS `{alias}`" for alias, sql in layer))
    columns = [f"`{c}`" for c in responses.columns if c != "values"]
    if output == "wide":
        names = list(dict.fromkeys(v for plan in plans for v in plan.variables))
        value = lambda v: router.expression({i: present_text(plan, v) for i, plan in enumerate(plans) if v in plan.final})
        return df.selectExpr(*columns, *(f"{value(v)} AS `{v}`" for v in names))
    merged = router.expression({i: merged_map_sql(plan) for i, plan in enumerate(plans)})
    if output == "map":
        return df.selectExpr(*columns, f"{merged} AS `values`")
    return df.selectExpr(*columns, f"{merged} AS `{PFX}m`").select(
        *(F.col(c) for c in columns), F.explode(F.col(f"`{PFX}m`")).alias("key", "value"))
