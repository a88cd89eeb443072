"""Rule-set compiler: rule table -> layered Spark SQL projections.

The reference runs, per response, ``for pass: for variable: for rule``; a
rule reads the response as it stands at that moment (earlier writes
visible), the first rule with an outcome other than "conditions not met"
ends the block, "data not found" drops the variable from later passes.

That loop is static: which version of each key a rule sees does not depend
on the data. So the compiler walks the loop ONCE at compile time in SSA
style - every block (pass, variable) produces a new version of its variable
as three flat columns (present, text, number) - and groups blocks into
dependency levels. Each level becomes two or three ``selectExpr`` projections:

1. ``s``  - the block selector: one searched CASE over all rules of the
   block (first match wins by fall-through), ``16 * rule_index + sub``;
2. tmp   - computed texts, and numbers whose operator asks for a projection of their own
   (sums, means); other values are computed inside the final projection;
3. final - the new version (present, text, number, kind of number) and the drop flag;
4. extra - helper columns of the new version that a later rule or the output
   asked for: the text of a number, the parts of an answer read as a list.

Everything is a narrow, row-local projection: no shuffle, no Python UDF. Projections without array functions
stay inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from varloom.functions.values import (
    list_numbers,
    list_text,
    plain_number,
    py_float_text,
    py_int_text,
    py_mean_text,
    py_num,
    py_num_lifted,
    sql_str,
)
from varloom.operators.common import (
    ERROR,
    INTENDED,
    OBSERVED,
    RESOLVED_SUBS,
    Compiled,
    LitVal,
    NumVal,
    Operand,
    TextVal,
    UnsupportedRule,
)
from varloom.operators.predicates import PREDICATES
from varloom.operators.value_functions import VALUE_FUNCTIONS
from varloom.plans.rules import Rule, RuleSet, load_rules

PFX = "__vl_"
LEVELS = 3  # dependency levels between two readings of answers that variables may overwrite


def _unsupported(rule: Rule, ref, mode: str) -> Compiled:
    """A rule that the reference only stumbles over when a response reaches it."""
    return Compiled().add("TRUE", ERROR)


def dispatch(rule: Rule, on_error: str | None = None, builders: dict | None = None):
    """The builder for a rule's (action, detail); unsupported pairs raise, or become an error of the rows that reach them."""
    for own in ((rule.action, rule.detail), (rule.action, None)):
        if builders and own in builders:
            return builders[own]
    if rule.action in VALUE_FUNCTIONS:
        return VALUE_FUNCTIONS[rule.action]
    builder = PREDICATES.get((rule.action, rule.detail))
    if builder is None:
        if on_error is not None:
            return _unsupported
        raise UnsupportedRule(
            f"rule {rule.rule_no}: unsupported action {rule.action!r} / detail {rule.detail!r}"
        )
    return builder


#: How a version's text comes about: as it stands, or as the text of its number.
TEXT, FLOAT, INT, MEAN = 0, 1, 2, 3
_KIND = {"float": FLOAT, "int": INT, "mean": MEAN}


@dataclass
class Version:
    """One version of a key as flat columns: presence, text or kind of number, number.

    A number's text is long to write (Python's ``repr``), so it is no column of the chain: ``extras``
    holds the helper columns that somebody asked for, each a projection after this version's own.
    """

    key: str
    p: str
    r: str
    n: str
    level: int
    k: str | None = None  # column with the kind; None: always text
    kinds: str | None = None  # raw answers: the map column with their JSON kinds
    j: str | None = None  # derived, in a plan with kinds: column that tells strings from numbers
    extras: dict[str, tuple[str, int, str]] = field(default_factory=dict)  # name -> (column, step, sql)

    def extra(self, name: str) -> str:
        """Column (quoted) of a helper of this version."""
        if name == "text" and self.k is None:
            return f"`{self.r}`"
        if name == "is_text" and self.j is None and self.kinds is None:
            return "TRUE"
        if name == "is_text" and self.j is not None:
            return f"`{self.j}`"
        if name not in self.extras:
            step, sql = getattr(self, f"_{name}")()
            self.extras[name] = (f"{self.p[:-2]}_{name}", step, sql)
        return f"`{self.extras[name][0]}`"

    def _text(self):
        n = f"`{self.n}`"
        return 1, (f"CASE `{self.k}` WHEN {FLOAT} THEN {py_float_text(n)} WHEN {INT} THEN {py_int_text(n)} "
                   f"WHEN {MEAN} THEN {py_mean_text(n)} ELSE `{self.r}` END")

    def _is_text(self):
        return 1, f"coalesce(try_element_at(`{self.kinds}`, {sql_str(self.key)}) = 'string', TRUE)"

    def _list_plain(self):
        return 2, f"(`{self.p}` AND {plain_number(self.extra('text'), f'`{self.n}`')})"

    def _list_literal(self):
        # in a lambda, so that the columns of many keys do not end up in one method
        return 3, f"CASE WHEN `{self.p}` AND NOT {self.extra('list_plain')} THEN transform(array({self.extra('text')}), t -> {list_text('t')})[0] END"

    def _list(self):
        return 4, list_numbers(self.extra("list_literal"))

    def _list_bad(self):
        a, plain = self.extra("list"), self.extra("list_plain")
        return 5, f"(`{self.p}` AND NOT {plain} AND ({a} IS NULL OR array_contains(transform({a}, x -> x IS NULL), TRUE)))"

    def _list_count(self):
        return 5, f"CASE WHEN NOT `{self.p}` THEN 0 WHEN {self.extra('list_plain')} THEN 1 ELSE coalesce(size({self.extra('list')}), 0) END"

    def _list_sum(self):
        return 5, (f"CASE WHEN NOT `{self.p}` THEN 0D WHEN {self.extra('list_plain')} THEN 0D + `{self.n}` "
                   f"ELSE aggregate({self.extra('list')}, 0D, (acc, x) -> acc + x) END")

    def operand(self) -> Operand:
        return Operand(self.key, f"`{self.p}`", f"`{self.n}`", self.extra)


@dataclass
class Block:
    variable: str
    pass_number: int
    rules: list[Rule]
    selector: str  # column name
    level: int


@dataclass
class CompiledPlan:
    layers: list[list[tuple[str, str]]]  # per projection: (alias, sql)
    variables: list[str]
    final: dict[str, Version]
    blocks: list[Block]
    map_col: str

    def outcome_sql(self, b: Block) -> str:
        s = f"`{b.selector}`"
        resolved = ", ".join(str(x) for x in RESOLVED_SUBS)
        return f"CASE WHEN {s} = 0 THEN 0 WHEN {s} % 16 IN ({resolved}) THEN 1 ELSE {s} % 16 END"


@dataclass
class _State:
    versions: dict[str, Version] = field(default_factory=dict)  # current version per key
    raw: dict[str, Version] = field(default_factory=dict)
    drop: dict[str, tuple[str, int]] = field(default_factory=dict)  # variable -> (col, level)
    first: dict[str, int] = field(default_factory=dict)  # raw key -> the first level that reads it


class Compiler:
    def __init__(self, rules, mode: str = INTENDED, map_col: str = "values", on_error: str | None = None, builders: dict | None = None,
                 kinds: str | None = None):
        if on_error not in (None, "quarantine", "fail"):
            raise ValueError("on_error must be None, 'quarantine' or 'fail'")
        if mode not in (INTENDED, OBSERVED):
            raise ValueError(f"mode must be {INTENDED!r} or {OBSERVED!r}")
        self.ruleset: RuleSet = load_rules(rules)
        self.mode = mode
        self.map_col = map_col
        self.on_error, self.builders, self.kinds = on_error, builders, kinds
        self._ids = 0

    def _id(self, name: str) -> str:
        self._ids += 1
        return f"{PFX}{name}{self._ids}"

    def _raw(self, st: _State, key: str) -> Version:
        if key not in st.raw:
            base = self._id("k")
            st.raw[key] = Version(key, base + "_p", base + "_r", base + "_n", 0, kinds=self.kinds)
        return st.raw[key]

    def _lift(self, st: _State) -> tuple[list[list[tuple[str, str]]], dict[int, list[Version]]]:
        """Projections that lift the referenced keys out of the answer map, and the raw versions left for later, by level.

        Variable names are lifted too (a variable may overwrite an answer),
        but usually are not answer keys: one ``arrays_overlap`` per row tells
        whether any is, and only then are they probed one by one, just before the levels that read them (``_lift_late``).
        """
        m = f"`{self.map_col}`"
        variables = set(self.ruleset.variables)
        lift, pre, now = [], [], []
        late: dict[int, list[Version]] = {}
        names = [k for k in st.raw if k in variables]
        if names:
            arr = ", ".join(sql_str(k) for k in names)
            pre = [(f"{PFX}anyvar", f"coalesce(arrays_overlap(map_keys({m}), array({arr})), FALSE)")]
        for key, v in st.raw.items():
            k = sql_str(key)
            if key in variables:
                first = st.first.get(key, 1)
                late.setdefault(first - (first - 1) % LEVELS, []).append(v)
            else:
                # the map is searched once for a value; only a null needs the second search
                r = f"try_element_at({m}, {k})"
                lift += [(v.p, f"({r} IS NOT NULL OR coalesce(map_contains_key({m}, {k}), FALSE))"), (v.r, r)]
                now.append(v)
        numbers = [(v.n, py_num_lifted(f"`{v.r}`")) for v in now]
        return [x for x in (pre, lift, numbers) if x] + self._extras(now, 0), late

    def _lift_late(self, versions: list[Version], level: int) -> list[list[tuple[str, str]]]:
        """Projections that lift answers which variables may overwrite.

        Their numbers are read by one expression for all of them. Its lambda also ends the stretch of projections that Spark
        generates as one method: the levels of a long chain in one method are too much code for the JVM to compile.
        """
        m, any_var, numbers = f"`{self.map_col}`", f"`{PFX}anyvar`", f"{PFX}numbers{level}"
        lift, texts = [], []
        for v in versions:
            k = sql_str(v.key)
            texts.append(f"try_element_at({m}, {k})")
            lift += [(v.p, f"({any_var} AND coalesce(map_contains_key({m}, {k}), FALSE))"), (v.r, f"CASE WHEN {any_var} THEN {texts[-1]} END")]
        lift.append((numbers, f"CASE WHEN {any_var} THEN transform(array({', '.join(texts)}), t -> {py_num('t')}) END"))
        return [lift, [(v.n, f"`{numbers}`[{i}]") for i, v in enumerate(versions)], *self._extras(versions, 0)]

    def _current(self, st: _State, key: str) -> Version:
        return st.versions.get(key) or self._raw(st, key)

    def compile(self) -> CompiledPlan:
        rs = self.ruleset
        st = _State()
        blocks: list[Block] = []
        per_level: dict[int, list[tuple[list, list, list]]] = {}
        made: list[Version] = []

        for pass_number in range(0, rs.max_pass + 1):
            for var in rs.variables:
                rules = rs.block(pass_number, var)
                if not rules:
                    continue
                used: list[Version] = []

                def ref(key, _used=used, _st=st):
                    if key is None:
                        raise ValueError("rule names a null key")
                    v = self._current(_st, key)
                    _used.append(v)
                    return v.operand()

                compiled: list[Compiled] = [dispatch(r, self.on_error, self.builders)(r, ref, self.mode) for r in rules]
                prev = self._current(st, var)
                drop = st.drop.get(var)
                level = 1 + max([v.level for v in used] + [prev.level, drop[1] if drop else 0])
                for v in (*used, prev):
                    if v.level == 0:
                        st.first[v.key] = min(level, st.first.get(v.key, level))
                sel = self._id("s")
                s_sql, v_cols, f_cols, new_version, new_drop = self._block_sql(
                    sel, compiled, prev, drop, var, level, [r.rule_no for r in rules])
                per_level.setdefault(level, []).append((s_sql, v_cols, f_cols))
                st.versions[var] = new_version
                made.append(new_version)
                st.drop[var] = (new_drop, level)
                blocks.append(Block(var, pass_number, rules, sel, level))

        final = {v: self._current(st, v) for v in rs.variables}
        layers, late = self._lift(st)
        for level in sorted({*per_level, *late}):
            if level in late:
                layers += self._lift_late(late[level], level)
            items = per_level.get(level, [])
            if not items:
                continue
            layers.append([x for s_sql, _, _ in items for x in s_sql])
            tmp = [x for _, v_cols, _ in items for x in v_cols]
            if tmp:
                layers.append(tmp)
            layers.append([x for _, _, f_cols in items for x in f_cols])
            layers += self._extras(made, level)
        layers += self._final_texts(list(final.values()))
        return CompiledPlan(layers, list(rs.variables), final, blocks, self.map_col)

    def _final_texts(self, versions: list[Version]) -> list[list[tuple[str, str]]]:
        """Texts of the final numbers that no rule has read as text: one expression for all of them, at the end.

        Written out per variable, the texts of a dozen numbers outgrow the method size limit of generated code. Most numbers
        are short: below 1e7 (from there on it has an exponent) Java's text is Python's, and one cast makes all of them.
        """
        late = [v for v in versions if v.k is not None and "text" not in v.extras]
        if not late:
            return []
        java, some, texts = f"{PFX}java", f"{PFX}long", f"{PFX}texts"

        def short(k, n, s):
            return f"{k} = {FLOAT} AND {n} > -1e7D AND {n} < 1e7D AND length({s}) <= 16 AND NOT contains({s}, 'E')"

        whole = f"e.k = {INT} OR e.k = {MEAN} AND e.n = floor(e.n) AND abs(e.n) < 1e18"  # as in py_mean_text
        long = f"WHEN {whole} THEN {py_int_text('e.n')} WHEN e.k <> {TEXT} THEN {py_float_text('e.n')}"
        numbers = ", ".join(f"named_struct('k', `{v.k}`, 'n', `{v.n}`, 's', `{java}`[{i}])" for i, v in enumerate(late))
        each = f"transform(array({numbers}), e -> CASE WHEN {short('e.k', 'e.n', 'e.s')} THEN e.s {long} END)"
        others = " ".join(f"WHEN `{v.k}` <> {TEXT} AND NOT ({short(f'`{v.k}`', f'`{v.n}`', f'`{java}`[{i}]')}) THEN TRUE"
                          for i, v in enumerate(late))
        own = []
        for i, v in enumerate(late):
            column = f"{v.p[:-2]}_text"
            own.append((column, f"CASE WHEN `{v.k}` = {TEXT} THEN `{v.r}` ELSE `{texts}`[{i}] END"))
            v.extras["text"] = (column, 0, "")
        cast = f"CAST(array({', '.join(f'`{v.n}`' for v in late)}) AS ARRAY<STRING>)"
        return [[(java, cast)], [(some, f"CASE {others} ELSE FALSE END")], [(texts, f"CASE WHEN `{some}` THEN {each} ELSE `{java}` END")], own]

    def _extras(self, versions: list[Version], level: int) -> list[list[tuple[str, str]]]:
        """Projections of the helper columns asked for of the versions of one level."""
        steps: dict[int, list[tuple[str, str]]] = {}
        for v in versions:
            if v.level == level:
                for column, step, sql in v.extras.values():
                    # texts of numbers nobody reads before the end are only made where they are used
                    steps.setdefault(step, []).append((column, sql))
        return [steps[i] for i in sorted(steps)]

    def _block_sql(self, sel, compiled, prev: Version, drop, var, level, rule_nos):
        whens = []
        text_whens, num_whens = [], []
        r_whens, n_whens, k_whens = [], [], []
        resolved_codes = []
        tmp_r, tmp_n = self._id("tr"), self._id("tn")
        for idx, comp in enumerate(compiled, start=1):
            for cond, sub in comp.branches:
                code = str(16 * idx + sub)
                if sub == ERROR and self.on_error == "fail":
                    code = f"CAST(raise_error('rule {rule_nos[idx - 1]}: the answer or the rule cannot be read') AS INT)"
                whens.append(f"WHEN {cond} THEN {code}")
            for sub, val in comp.vals.items():
                code = 16 * idx + sub
                if not any(code == 16 * idx + s for _, s in comp.branches):
                    continue
                resolved_codes.append(code)
                if isinstance(val, LitVal):
                    r_whens.append(f"WHEN {code} THEN {val.r()}")
                    n_whens.append(f"WHEN {code} THEN {val.n()}")
                    k_whens.append(f"WHEN {code} THEN {TEXT}")
                elif isinstance(val, TextVal):
                    text_whens.append(f"WHEN {code} THEN {val.sql}")
                    r_whens.append(f"WHEN {code} THEN `{tmp_r}`")
                    n_whens.append(f"WHEN {code} THEN {py_num(f'`{tmp_r}`')}")
                    k_whens.append(f"WHEN {code} THEN {TEXT}")
                elif isinstance(val, NumVal):
                    if val.own_layer:
                        num_whens.append(f"WHEN {code} THEN {val.sql}")
                    r_whens.append(f"WHEN {code} THEN CAST(NULL AS STRING)")
                    n_whens.append(f"WHEN {code} THEN {f'`{tmp_n}`' if val.own_layer else f'({val.sql})'}")
                    k_whens.append(f"WHEN {code} THEN {_KIND[val.kind]}")
        skip = f"WHEN `{drop[0]}` THEN 0 " if drop else ""
        s_sql = [(sel, f"CASE {skip}{' '.join(whens)} ELSE 2 END")]
        s = f"`{sel}`"
        v_cols = []
        if text_whens:
            v_cols.append((tmp_r, f"CASE {s} {' '.join(text_whens)} END"))
        if num_whens:
            v_cols.append((tmp_n, f"CAST(CASE {s} {' '.join(num_whens)} END AS DOUBLE)"))
        base = self._id("v")
        p, r, n, d, k = base + "_p", base + "_r", base + "_n", base + "_d", base + "_k"
        codes = ", ".join(str(c) for c in resolved_codes) or "-1"
        f_cols = [
            (p, f"CASE WHEN {s} IN ({codes}) THEN TRUE ELSE `{prev.p}` END"),
            (r, f"CAST(CASE {s} {' '.join(r_whens)} ELSE `{prev.r}` END AS STRING)"
                if r_whens else f"`{prev.r}`"),
            (n, f"CAST(CASE {s} {' '.join(n_whens)} ELSE `{prev.n}` END AS DOUBLE)"
                if n_whens else f"`{prev.n}`"),
        ]
        numbers = prev.k is not None or any(isinstance(v, NumVal) for c in compiled for v in c.vals.values())
        if numbers:
            before = f"`{prev.k}`" if prev.k else str(TEXT)
            f_cols.append((k, f"CASE {s} {' '.join(k_whens)} ELSE {before} END" if k_whens else before))
        j = None
        if self.kinds:  # texts are strings, numbers are not, an answer that stays keeps its kind
            j = base + "_j"
            own = " ".join(f"WHEN {code} THEN {'TRUE' if kind.endswith(f'THEN {TEXT}') else 'FALSE'}" for code, kind in zip(resolved_codes, k_whens))
            before = prev.extra("is_text")
            f_cols.append((j, f"CASE {s} {own} ELSE {before} END" if own else before))
        lost = f"{s} % 16 IN (3, 9)"
        f_cols.append((d, f"(`{drop[0]}` OR {lost})" if drop else lost))
        return s_sql, v_cols, f_cols, Version(var, p, r, n, level, k if numbers else None, j=j), d


def compile_rules(rules, mode: str = INTENDED, map_col: str = "values", on_error: str | None = None,
                  builders: dict | None = None, kinds: str | None = None) -> CompiledPlan:
    return Compiler(rules, mode, map_col, on_error, builders, kinds).compile()
