"""``derive``: compute derived variables for every response (O20-O23).

Works on batch and streaming DataFrames alike: it is a chain of narrow
projections, so it never shuffles and partitions exactly like its input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varloom.functions.values import sql_str
from varloom.operators.common import INTENDED, RESOLVED_SUBS
from varloom.plans.compiler import PFX, CompiledPlan, compile_rules

OUTPUTS = ("map", "wide", "long", "trace", "outcomes")


def apply_plan(df: DataFrame, plan: CompiledPlan) -> DataFrame:
    """Chain one ``selectExpr`` per layer; Catalyst prunes unused columns."""
    for layer in plan.layers:
        df = df.selectExpr("*", *[f"{sql} AS `{alias}`" for alias, sql in layer])
    return df


def present_text(plan: CompiledPlan, var: str) -> str:
    """SQL: a variable's final text, null when it is not set."""
    v = plan.final[var]
    return f"CASE WHEN `{v.p}` THEN {v.extra('text')} END"


def merged_map_sql(plan: CompiledPlan) -> str:
    """SQL: the answer map with derived variables written back (O23).

    Keys the rule set writes are removed first, then the present ones are
    added back, so ``map_concat`` never sees a duplicate key.
    """
    m = f"`{plan.map_col}`"
    if not plan.variables:
        return m
    names = ", ".join(sql_str(v) for v in plan.variables)
    entries = ", ".join(
        f"named_struct('k', {sql_str(v)}, 'v', {plan.final[v].extra('text')}, 'p', `{plan.final[v].p}`)"
        for v in plan.variables
    )
    kept = f"map_filter({m}, (k, x) -> NOT array_contains(array({names}), k))"
    new = (f"map_from_entries(transform(filter(array({entries}), e -> e.p), "
           f"e -> struct(e.k AS key, e.v AS value)))")
    return f"map_concat({kept}, {new})"


def derive(responses: DataFrame, rules, *, mode: str = INTENDED, output: str = "map",
           map_col: str = "values", prefix: str = "", on_error: str | None = None, align: list[str] | None = None,
           barrier: bool = False, builders: dict | None = None, kinds: str | None = None) -> DataFrame:
    """Run a rule table over every response.

    ``output``:
      * ``map``      - input columns, answer map with derived values merged in;
      * ``wide``     - input columns without the map, one text column per variable
                       (null when the variable is not set);
      * ``long``     - input columns without the map, plus ``key`` / ``value`` rows;
      * ``trace``    - ``(variable, pass_number, rule_no, outcome, n)`` counts;
      * ``outcomes`` - input columns without the map, plus one outcome code per
                       block, named ``<variable>__p<pass>`` (0 = skipped).

    ``on_error``: what happens where the reference would raise. By default an unsupported rule is refused
    here and an unreadable answer drops the variable for its response (outcome 9); ``"quarantine"`` treats an unsupported
    rule that a response reaches in the same way; ``"fail"`` raises as soon as a response reaches either, as the reference does.

    ``align``: with ``long``, further map columns whose keys are united with the answers', each a column beside ``value``.

    ``barrier``: filters on the result stay above the derivation, where the optimizer would otherwise write the whole chain of a
    deep variable into the filter a second time. The price: filters on input columns stay there too, so apply those before.

    ``builders``: rules of one's own, ``{(action, detail): builder}``; detail ``None`` takes any. A builder is called with the
    rule, a function from key to ``Operand`` and the mode, and returns a ``Compiled``. They come before the built-in ones.

    ``kinds``: a map column with the JSON kind of each answer, as ``read_snapshot(..., kinds="kinds")`` makes it. ``equal_string`` then holds of
    strings only, as in the reference: neither the number 1 nor a computed 2.0 equals the text of it. Copies and merged texts are strings.
    An answer without a kind counts as a string. The column stays as it is in the output.
    """
    if output not in OUTPUTS:
        raise ValueError(f"output must be one of {OUTPUTS}")
    if align and output != "long":
        raise ValueError("align goes with output='long'")
    plan = rules if isinstance(rules, CompiledPlan) else compile_rules(rules, mode, map_col, on_error, builders, kinds)
    out = _derive(responses, plan, output, prefix, align)
    if barrier:  # predicates do not pass an observation, unused columns are still pruned through it
        out = out.observe(f"{PFX}{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    return out


def _derive(responses: DataFrame, plan: CompiledPlan, output: str, prefix: str, align: list[str] | None) -> DataFrame:
    map_col = plan.map_col
    base_cols = [c for c in responses.columns if c != map_col]
    df = apply_plan(responses, plan)
    q = [f"`{c}`" for c in base_cols]
    if output == "map":
        return df.selectExpr(*[f"`{c}`" for c in responses.columns if c != map_col],
                             f"{merged_map_sql(plan)} AS `{map_col}`")
    if output == "wide":
        return df.selectExpr(*q, *[f"{present_text(plan, v)} AS `{prefix}{v}`" for v in plan.variables])
    if output == "long":
        if align:
            merged = df.selectExpr(*q, f"{merged_map_sql(plan)} AS `value`")
            return long_form(merged, ["value", *align])
        merged = df.selectExpr(*q, f"{merged_map_sql(plan)} AS `{PFX}m`")
        return merged.select(*[F.col(f"`{c}`") for c in base_cols],
                             F.explode(F.col(f"`{PFX}m`")).alias("key", "value"))
    if output == "outcomes":
        return df.selectExpr(*q, *[f"{plan.outcome_sql(b)} AS `{b.variable}__p{b.pass_number}`"
                                   for b in plan.blocks])
    return trace(df, plan)


def trace(applied: DataFrame, plan: CompiledPlan) -> DataFrame:
    """Per-rule outcome counts (O22): how often each rule was evaluated, with which outcome.

    A rule is evaluated when no rule before it in its block decided; outcome 2 is "conditions not met". Each response
    sends the codes of its blocks, packed with the block's number, through one count per code, summed before the shuffle: one expression and
    one aggregate, however many rules there are. What is left, at most a row per block and code, meets the rules.
    """
    spark = applied.sparkSession
    if not plan.blocks:
        return spark.createDataFrame([], "variable string, pass_number int, rule_no int, outcome int, n bigint")
    width = 16 * (2 + max(len(b.rules) for b in plan.blocks))
    codes = ", ".join(f"{width * j}L + `{b.selector}`" for j, b in enumerate(plan.blocks))
    met = applied.selectExpr(f"explode(array({codes})) AS code").groupBy("code").count()
    met = met.selectExpr(f"CAST(code DIV {width} AS INT) AS block", f"CAST(code % {width} AS INT) AS code", "count").filter("code > 0")
    rules = ", ".join(f"({j}, {i}, {sql_str(b.variable)}, {b.pass_number}, {rule.rule_no})"
                      for j, b in enumerate(plan.blocks) for i, rule in enumerate(b.rules, start=1))
    resolved = ", ".join(map(str, RESOLVED_SUBS))
    return (met.join(spark.sql(f"SELECT * FROM VALUES {rules} AS r(block, place, variable, pass_number, rule_no)"), "block")
            .filter("code = 2 OR place <= code DIV 16")
            .selectExpr("variable", "pass_number", "rule_no", "count",
                        f"CASE WHEN code = 2 OR place < code DIV 16 THEN 2 WHEN code % 16 IN ({resolved}) THEN 1 ELSE code % 16 END AS outcome")
            .groupBy("variable", "pass_number", "rule_no", "outcome").agg(F.sum("count").alias("n")))


def long_form(df: DataFrame, maps: list[str], key: str = "key") -> DataFrame:
    """One row per response and key of any of its maps (O21), with a column per map; no shuffle.

    The keys of all maps are united, as an index of fields that are dictionaries would be; a map without the key has null there. The other
    columns are repeated. A null map has no keys; a response whose maps are all null or empty has no rows.
    """
    if not maps:
        raise ValueError("name at least one map column")
    others = [c for c in df.columns if c not in maps]
    if key in df.columns:
        raise ValueError(f"there is a column {key!r} already; choose another name for the keys")
    keys = [f"coalesce(map_keys(`{m}`), CAST(array() AS ARRAY<STRING>))" for m in maps]
    united = keys[0] if len(keys) == 1 else f"array_distinct(concat({', '.join(keys)}))"
    rows = df.selectExpr("*", f"explode({united}) AS `{PFX}key`")
    return rows.selectExpr(*(f"`{c}`" for c in others), f"`{PFX}key` AS `{key}`", *(f"try_element_at(`{m}`, `{PFX}key`) AS `{m}`" for m in maps))
