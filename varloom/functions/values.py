"""Value coercion helpers, emitted as Spark SQL expression text.

Answers live in a ``MAP<STRING,STRING>``. Every operator needs three views of
an answer: whether the key is present, its raw text (null = JSON null) and
its number as Python's ``float()`` would read it. These helpers build the SQL
for those views so that the whole rule set compiles to JVM-side expressions
(whole-stage codegen, no Python in the hot path).
"""

from __future__ import annotations

import math

# The text grammar Python's float() accepts (ASCII digits only),
# written as a Java regex. Underscores are allowed between digits.
_PY_FLOAT_RE = (
    r"^\s*[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
    r"|^\s*[+-]?(?i:inf(inity)?|nan)\s*$"
)
# Python int() text: optional sign, digits with single underscores, whitespace.
_PY_INT_RE = r"^\s*[+-]?\d+(_\d+)*\s*$"
# A bare (unquoted) number inside a Python list literal: no inf/nan names; a sign may stand apart. Whole numbers have no leading
# zeros, unless they are zero; other bases have a prefix.
_PY_LIST_NUM_RE = r"^(?![+-]? *0[0-9_]*[1-9][0-9_]*$)([+-] *)?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"

def sql_str(value: str | None) -> str:
    """Quote a Python string as a Spark SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_double(value: float | None) -> str:
    """A Python float as a Spark SQL double literal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if math.isnan(value):
        return "double('NaN')"
    if math.isinf(value):
        return "double('Infinity')" if value > 0 else "double('-Infinity')"
    return f"CAST({value!r} AS DOUBLE)"


def py_float(text) -> float | None:
    """Python ``float(str(x))`` or None when it raises (compile-time literals)."""
    try:
        return float(str(text))
    except (ValueError, TypeError):
        return None


def py_num(text_sql: str) -> str:
    """SQL: the double Python's float() reads from ``text_sql``, else NULL.

    Guarded by a regex so that Java-only forms (``1d``, ``0x1p3``) stay NULL;
    underscores are stripped and a signed NaN loses its sign before the cast.
    """
    t = text_sql
    # Fast path: text made only of digits, '.', 'e', signs and spaces is read
    # identically by Java's parser and Python's float(); no regex needed.
    return (
        f"CASE WHEN {t} IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN {_plain(t)} THEN try_cast({t} AS DOUBLE) "
        f"{_odd_num(t)} END"
    )


def py_num_lifted(text_sql: str) -> str:
    """As ``py_num``, for many columns side by side: the rare forms are read by a lambda.

    Such a projection is generated in small methods. With all forms of ten answers in one method
    it is too much code for the JVM to compile.
    """
    t = text_sql
    return (f"CASE WHEN {_plain(t)} THEN try_cast({t} AS DOUBLE) "
            f"WHEN {t} IS NOT NULL THEN transform(array({t}), t -> CASE {_odd_num('t')} END)[0] END")


def _plain(t: str) -> str:
    return f"translate({t}, '0123456789.eE+- ', '') = ''"


def _odd_num(t: str) -> str:
    return f"WHEN {t} RLIKE '{_esc(_PY_FLOAT_RE)}' THEN try_cast(regexp_replace(replace(trim({t}), '_', ''), '^[+-](?i:nan)$', 'NaN') AS DOUBLE)"


def is_digits(text_sql: str) -> str:
    """SQL: Python ``str.isnumeric()`` for ASCII text (non-empty, digits only)."""
    t = text_sql
    return f"({t} <> '' AND translate({t}, '0123456789', '') = '')"


def py_int(text_sql: str) -> str:
    """SQL: Python int(text) as a double (ints only), else NULL."""
    t = text_sql
    return f"CASE WHEN {t} RLIKE '{_esc(_PY_INT_RE)}' THEN try_cast(replace(trim({t}), '_', '') AS DOUBLE) END"


def _esc(regex: str) -> str:
    return regex.replace("\\", "\\\\").replace("'", "\\'")


def py_float_text(num_sql: str) -> str:
    """SQL: text of a double as Python's ``str(float)`` writes it.

    Spark writes doubles the Java way (``1.0E7``); Python switches to
    exponent notation only below 1e-4 and from 1e16, and writes ``1e+16``. Java's digits read back as the same double, but before
    JDK 19 they may be one too many or not the nearest. Up to 15 digits there is only one shortest text, so they are kept as they
    are; a longer text is written anew by Jackson's shortest-decimal writer, which is part of Spark and lays numbers out as Java does.
    No lambda functions.
    """
    x = num_sql
    s = f"CAST({x} AS STRING)"  # 16 characters hold 15 digits and the point
    java = f"java_method('com.fasterxml.jackson.core.io.NumberOutput', 'toString', {x}, true)"
    fixed = f"regexp_replace(regexp_replace(CAST(CAST({java} AS DECIMAL(38,21)) AS STRING), '0+$', ''), '\\\\.$', '.0')"
    sci = (f"replace(regexp_replace(regexp_replace(regexp_replace({java}, '\\\\.0E', 'E'), "
           f"'E(-?)([0-9])$', 'E$10$2'), 'E([0-9])', 'e+$1'), 'E-', 'e-')")
    digit = f"format_string('%.0e', {x})"  # Java writes two digits at least, which a subnormal may not need
    return (
        f"CASE WHEN {x} IS NULL THEN CAST(NULL AS STRING) "
        f"WHEN isnan({x}) THEN 'nan' "
        f"WHEN abs({x}) = double('Infinity') THEN if({x} > 0, 'inf', '-inf') "
        f"WHEN length({s}) <= 16 AND NOT contains({s}, 'E') THEN {s} "
        f"WHEN abs({x}) >= 1e-4 AND abs({x}) < 1e16 THEN {fixed} "
        f"WHEN abs({x}) < 2.3e-308D AND try_cast({digit} AS DOUBLE) = {x} THEN {digit} "
        f"ELSE {sci} END"
    )


def py_int_text(num_sql: str) -> str:
    """SQL: text of an integral double as Python's ``str(int)``."""
    return f"CAST(CAST({num_sql} AS DECIMAL(38,0)) AS STRING)"


def py_mean_text(num_sql: str) -> str:
    """SQL: text of ``statistics.mean`` over ints: an int when exact, else a float."""
    x = num_sql
    return (
        f"CASE WHEN {x} = floor({x}) AND abs({x}) < 1e18 THEN {py_int_text(x)} "
        f"ELSE {py_float_text(x)} END"
    )


# Whole numbers of up to 64 bits in other bases.
_PY_BASED_RE = (r"^([+-] *)?0([xX](?=_?[0-9a-fA-F])(_?0)*(_?[0-9a-fA-F]){0,16}|[oO](?=_?[0-7])(_?0)*(_?1)?(_?[0-7]){0,21}"
                r"|[bB](?=_?[01])(_?0)*(_?[01]){0,64})$")


def plain_number(text_sql: str, num_sql: str) -> str:
    """SQL: the answer is one number in its plain form, no list; numbers with leading zeros are left to the list reading."""
    padded = f"left(trim(LEADING '+- ' FROM {text_sql}), 2) BETWEEN '00' AND '09'"
    return f"({text_sql} IS NOT NULL AND translate({text_sql}, '0123456789.eE+- ', '') = '' AND NOT ({padded}) AND {num_sql} IS NOT NULL)"


def literal_number(text_sql: str) -> str:
    """SQL: the double of one unquoted element of a Python list literal, else NULL.

    ``True`` and ``False`` are 1 and 0, ``0x1F``, ``0o17`` and ``0b11`` (up to 64 bits) are whole numbers, ``007`` is refused
    but ``007.5`` is not. Parentheses and complex numbers are refused.
    """
    t = text_sql
    based = f"conv(substr(translate({t}, '_ +-', ''), 3), if({t} RLIKE '[xX]', 16, if({t} RLIKE '[oO]', 8, 2)), 10)"
    return (f"CASE WHEN {t} RLIKE '{_esc(_PY_LIST_NUM_RE)}' THEN try_cast(translate({t}, '_ ', '') AS DOUBLE) "
            f"WHEN {t} RLIKE '{_esc(_PY_BASED_RE)}' THEN if({t} LIKE '-%', -1D, 1D) * CAST(CAST({based} AS DECIMAL(20)) AS DOUBLE) "
            f"ELSE CASE {t} WHEN 'True' THEN 1D WHEN 'False' THEN 0D END END")


def list_text(text_sql: str) -> str:
    """SQL: a list answer as the text of one Python list literal.

    Mirrors the reference reading of list answers: text without ``[`` is wrapped in brackets.
    """
    t = f"translate(coalesce({text_sql}, 'None'), '\\t\\n\\r', '   ')"
    return f"trim(CASE WHEN instr({t}, '[') > 0 THEN {t} ELSE concat('[', {t}, ']') END)"


def list_numbers(list_sql: str) -> str:
    """SQL: ``array<double>`` of the text of a list literal, with NULL elements for bad parts.

    Each element, quoted (``float`` of it) or not (``literal_number``), must be a number. A trailing comma is allowed, an empty
    list is empty. NULL (whole array) when the text is not one flat
    list; the caller treats NULL or any NULL element as an error.
    """
    inner = f"substr({list_sql}, 2, length({list_sql}) - 2)"
    quoted = "^\"([^\"]*)\"$|^\\'([^\\']*)\\'$"
    parts = f"split(regexp_replace({inner}, ', *$', ''), ',', -1)"
    parts = f"transform({parts}, x -> struct(trim(x) RLIKE '{quoted}' AS q, regexp_replace(trim(x), '{quoted}', '$1$2') AS z))"
    number = f"CASE WHEN e.q THEN {py_num('e.z')} ELSE {literal_number('e.z')} END"
    return (f"CASE WHEN {list_sql} RLIKE '^\\\\[ *\\\\]$' THEN CAST(array() AS ARRAY<DOUBLE>) "
            f"WHEN {list_sql} RLIKE '^\\\\[[^\\\\[\\\\]]*\\\\]$' THEN transform({parts}, e -> {number}) END")


def exact_mean(items: list[str]) -> str:
    """SQL: the mean of the non-null items as ``statistics.mean`` gives it: exact sum, rounded once.

    Whole numbers add up exactly as they are. Otherwise the sum is carried with its rounding error (two-sum) and the
    quotient is corrected by its exact remainder (the quotient is split in halves whose products with the count are exact). Numbers near either end
    of the range are scaled by a power of two before and after, so that neither sum nor products leave it.
    """
    largest = f"greatest(0D, {', '.join(f'abs({x})' for x in items)})"
    scale = f"CASE WHEN {largest} > 1e290 THEN {sql_double(2.0 ** -60)} WHEN {largest} < 1e-200 THEN {sql_double(2.0 ** 200)} ELSE 1D END"
    given = f"filter(array({', '.join(f'{x} * ({scale})' for x in items)}), x -> x IS NOT NULL)"
    whole = " AND ".join(f"({x} IS NULL OR ({x} = floor({x}) AND abs({x}) < 1e12))" for x in items)
    plain = f"({' + '.join(f'coalesce({x}, 0D)' for x in items)}) / ({' + '.join(f'if({x} IS NULL, 0, 1)' for x in items)})"
    t = "(a.s + x - a.s)"
    step = f"named_struct('s', a.s + x, 'e', a.e + ((a.s - (a.s + x - {t})) + (x - {t})), 'n', a.n + 1D)"
    q = "(a.s / a.n)"
    high = f"(134217729D * {q} - (134217729D * {q} - {q}))"
    rest = f"((((a.s - {high} * a.n) - ({q} - {high}) * a.n) + a.e) / a.n)"
    done = f"CASE WHEN a.n = 0D THEN CAST(NULL AS DOUBLE) WHEN isnan({rest}) THEN {q} ELSE {q} + {rest} END"
    zero = "named_struct('s', 0D, 'e', 0D, 'n', 0D)"
    return f"CASE WHEN {whole} THEN {plain} ELSE aggregate({given}, {zero}, (a, x) -> {step}, a -> {done}) / ({scale}) END"
