"""Query catalogue: one Spark job per operator, each with a DuckDB oracle.

Every query reads the supplied tables (through a fixture job), so its work
grows with them. The oracle SQL states the expected result directly over the
raw tables, written independently of the compiler.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from varloom.operators.derive import derive
from varloom.plans.rules import rule as R
from varloom.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FIXTURE = {
    "R1": fx.lineitem_responses,
    "R2": fx.order_responses,
    "R3A": lambda s, d: fx.document_responses(s, d, "A"),
    "R3B": lambda s, d: fx.document_responses(s, d, "B"),
    "R3C": lambda s, d: fx.document_responses(s, d, "C"),
    "R4": fx.event_responses,
}


def register(name: str, fixture: str, rules: list[dict], oracle: str | None,
             mode: str = "intended", output: str = "wide") -> None:
    def run(spark: SparkSession, sf_dir: str, _f=fixture, _r=rules, _m=mode, _o=output) -> DataFrame:
        return derive(FIXTURE[_f](spark, sf_dir), _r, mode=_m, output=_o)

    QUERIES[name] = run
    if oracle is not None:
        ORACLES[name] = oracle


# ----------------------------------------------------------- oracle fixtures

R1_SQL = """r1 AS (SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
  CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS response_id,
  l_quantity AS qty, l_discount AS disc, l_tax AS tax, l_linenumber AS line,
  l_returnflag AS flag, l_linestatus AS status FROM lineitem)"""

R2_SQL = """piv AS (SELECT l_orderkey,
  max(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS q1, max(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS q2,
  max(CASE WHEN l_linenumber = 3 THEN l_quantity END) AS q3, max(CASE WHEN l_linenumber = 4 THEN l_quantity END) AS q4,
  max(CASE WHEN l_linenumber = 5 THEN l_quantity END) AS q5, max(CASE WHEN l_linenumber = 6 THEN l_quantity END) AS q6,
  max(CASE WHEN l_linenumber = 7 THEN l_quantity END) AS q7 FROM lineitem GROUP BY l_orderkey),
r2 AS (SELECT CAST(o_orderkey AS VARCHAR) AS response_id, 'SV_' || substr(o_orderpriority, 1, 1) AS survey_id,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio, o_orderstatus AS ostatus, q1, q2, q3, q4, q5, q6, q7
  FROM orders LEFT JOIN piv ON o_orderkey = l_orderkey)"""

R3_SQL = """r3 AS (SELECT CAST(d.doc_id AS VARCHAR) AS response_id, d.lang, d.source, d.n_chars,
  l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

R4_SQL = """pt AS (SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY user_id, event_type),
r4 AS (SELECT CAST(user_id AS VARCHAR) AS response_id, sum(cnt) AS total, count(*) AS ntypes,
  max(CASE WHEN event_type = 'click' THEN cnt END) AS click,
  max(CASE WHEN event_type = 'view' THEN cnt END) AS view_n FROM pt GROUP BY user_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def F(x: str) -> str:
    """DuckDB: Python-style text of a double expression."""
    return f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


def I(x: str) -> str:  # noqa: E743
    """DuckDB: text of an integer-valued expression."""
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)"


NULLS = "CAST(NULL AS VARCHAR)"

# ------------------------------------------------------- P1-P9 single key (R1)

register("cond_equal", "R1", [
    R("eq25", 0, "conditional", "equal", a="qty", A="25", then="yes", otherwise="no"),
    R("eqdisc", 0, "conditional", "equal", a="disc", A="0.05", then="five"),
    R("eqflag", 0, "conditional", "equal", a="flag", A="1", then="x", otherwise="y"),
], _with(R1_SQL) + f"""SELECT response_id,
  CASE WHEN qty = 25 THEN 'yes' ELSE 'no' END AS eq25,
  CASE WHEN disc = 0.05 THEN 'five' END AS eqdisc,
  {NULLS} AS eqflag FROM r1""")

register("cond_gt", "R1", [
    R("gt", 0, "conditional", "greater_than", a="qty", A="40", then="hi", otherwise="lo"),
    R("gt2", 0, "conditional_2", "greater_than", a="tax", A="0.04", then="taxed"),
], _with(R1_SQL) + """SELECT response_id,
  CASE WHEN qty > 40 THEN 'hi' ELSE 'lo' END AS gt,
  CASE WHEN tax > 0.04 THEN 'taxed' END AS gt2 FROM r1""")

register("cond_gte", "R1", [
    R("gte", 0, "conditional_3", "greater_than_equal", a="qty", A="40", then="y", otherwise="0"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty >= 40 THEN 'y' ELSE '0' END AS gte FROM r1""")

register("cond_else_observed", "R1", [
    R("gte", 0, "conditional_3", "greater_than_equal", a="qty", A="40", then="y", otherwise="0"),
    R("gte_txt", 0, "conditional", "greater_than_equal", a="qty", A="40", then="y", otherwise=""),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty >= 40 THEN 'y' END AS gte,
  CASE WHEN qty >= 40 THEN 'y' ELSE '' END AS gte_txt FROM r1""", mode="observed")

register("cond_lt", "R1", [
    R("lt", 0, "conditional", "less_than", a="disc", A="0.03", then="low"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN disc < 0.03 THEN 'low' END AS lt FROM r1""")

register("cond_lte", "R1", [
    R("lte", 0, "conditional", "less_than_equal", a="line", A="2", then="early", otherwise="late"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line <= 2 THEN 'early' ELSE 'late' END AS lte FROM r1""")

register("cond_is_in", "R1", [
    R("isin", 0, "conditional", "is_in", a="flag", A="A,R", then="ar", otherwise="n"),
    R("isin_num", 0, "conditional", "is_in", a="qty", A="1,2,3", then="few"),
    R("isin_dec", 0, "conditional", "is_in", a="disc", A="0.1,0.0", then="edge"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN flag IN ('A', 'R') THEN 'ar' ELSE 'n' END AS isin,
  CASE WHEN qty IN (1, 2, 3) THEN 'few' END AS isin_num,
  CASE WHEN disc IN (0.1, 0.0) THEN 'edge' END AS isin_dec FROM r1""")

register("cond_between", "R1", [
    R("btw", 0, "conditional", "between_including", a="qty", A="10", A2="20", then="mid", otherwise="out"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty BETWEEN 10 AND 20 THEN 'mid' ELSE 'out' END AS btw FROM r1""")

register("cond_between_text", "R1", [
    R("btw", 0, "conditional", "between_including", a="qty", A="1", A2="5", then="in", otherwise="out"),
], _with(R1_SQL) + """SELECT response_id,
  CASE WHEN '1' <= CAST(CAST(qty AS BIGINT) AS VARCHAR) AND CAST(CAST(qty AS BIGINT) AS VARCHAR) <= '5'
  THEN 'in' ELSE 'out' END AS btw FROM r1""", mode="observed")

register("cond_is_null", "R3B", [
    R("isnull_q", 0, "conditional", "is_null", a="quality", then="unlabelled", otherwise="labelled"),
], _with(R3_SQL) + """SELECT response_id, CASE WHEN quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS isnull_q
  FROM r3""")

register("cond_is_null_empty", "R3C", [
    R("isnull_q", 0, "conditional", "is_null", a="quality", then="unlabelled", otherwise="labelled"),
    R("isnull_obs", 0, "conditional", "is_null", a="toxic", then="unlabelled"),
], _with(R3_SQL) + """SELECT response_id, CASE WHEN quality IS NULL THEN 'unlabelled' ELSE 'labelled' END AS isnull_q,
  CASE WHEN toxic IS NULL THEN 'unlabelled' END AS isnull_obs FROM r3""")

register("cond_is_null_observed", "R3B", [
    R("isnull_q", 0, "conditional", "is_null", a="quality", then="unlabelled", otherwise="labelled"),
], _with(R3_SQL) + """SELECT response_id, 'labelled' AS isnull_q FROM r3""", mode="observed")

register("cond_equal_string", "R3A", [
    R("eqs", 0, "conditional", "equal_string", a="lang", A="en", then="english", otherwise="other"),
    R("eqs_q", 0, "conditional", "equal_string", a="quality", A="1", then="good"),
], _with(R3_SQL) + """SELECT response_id, CASE WHEN lang = 'en' THEN 'english' ELSE 'other' END AS eqs,
  CASE WHEN quality = 1 THEN 'good' END AS eqs_q FROM r3""")

# --------------------------------------------------- P10-P27 multi key (R1-R3)

register("multi_eq_eq", "R2", [
    R("hit", 0, "multi_conditional", "equal,equal", a="prio", A="1", b="qty_2", B="20", then="hit", otherwise="miss"),
], _with(R2_SQL) + """SELECT response_id, survey_id,
  CASE WHEN q2 IS NULL THEN NULL WHEN prio = 1 AND q2 = 20 THEN 'hit' ELSE 'miss' END AS hit FROM r2""")

register("multi_eq_gt", "R2", [
    R("big2", 0, "multi_conditional_and_3", "equal,greater_than", a="prio", A="2", b="qty_1", B="25",
      then="big2", otherwise="no"),
], _with(R2_SQL) + """SELECT response_id, survey_id,
  CASE WHEN q1 IS NULL THEN NULL WHEN prio = 2 AND q1 > 25 THEN 'big2' ELSE 'no' END AS big2 FROM r2""")

register("multi_eq_null", "R3C", [
    R("nolab", 0, "multi_conditional", "equal,is_null", a="toxic", A="1", b="quality", then="x", otherwise="o"),
    R("lang_nolab", 0, "multi_conditional_and", "equal,is_null", a="n_chars", A="0", b="quality", then="x"),
], _with(R3_SQL) + """SELECT response_id,
  CASE WHEN toxic IS NULL THEN NULL WHEN toxic = 1 AND quality IS NULL THEN 'x' ELSE 'o' END AS nolab,
  CASE WHEN n_chars = 0 AND quality IS NULL THEN 'x' END AS lang_nolab FROM r3""")

register("multi_lt_eq", "R1", [
    R("lteq", 0, "multi_conditional_and", "less_than,equal", a="qty", A="10", b="line", B="1", then="y", otherwise="n"),
    R("lteq2", 0, "multi_conditional_and_2", "less_than,equal", a="disc", A="0.02", b="status", B="1", then="y"),
], _with(R1_SQL) + f"""SELECT response_id, CASE WHEN qty < 10 AND line = 1 THEN 'y' ELSE 'n' END AS lteq,
  {NULLS} AS lteq2 FROM r1""")

register("multi_in_eq_eq", "R1", [
    R("iee", 0, "multi_conditional_and", "is_in,equal,equal", a="qty", A="1,2,3", b="line", B="1", c="tax",
      C="0", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty IN (1, 2, 3) AND line = 1 AND tax = 0 THEN 'y' ELSE 'n' END AS iee
  FROM r1""")

register("multi_in_eq_eq_observed", "R1", [
    R("iee", 0, "multi_conditional_and", "is_in,equal,equal", a="qty", A="1,2,3", b="line", B="1", c="tax",
      C="0", then="y", otherwise="n"),
    R("iee_err", 0, "multi_conditional_and", "is_in,equal,equal", a="flag", A="1", b="line", B="1", c="tax",
      C="0", then="y", otherwise="n"),
], _with(R1_SQL) + f"""SELECT response_id, 'n' AS iee, {NULLS} AS iee_err FROM r1""", mode="observed")

register("multi_in_eq", "R1", [
    R("ie", 0, "multi_conditional_and", "is_in,equal", a="line", A="1,2", b="tax", B="0.08", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line IN (1, 2) AND tax = 0.08 THEN 'y' ELSE 'n' END AS ie FROM r1""")

register("multi_in_in", "R1", [
    R("ii", 0, "multi_conditional_and", "is_in,is_in", a="line", A="1,7", b="qty", B="50,49", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line IN (1, 7) AND qty IN (50, 49) THEN 'y' ELSE 'n' END AS ii FROM r1""")

register("multi_gte_gt", "R1", [
    R("gg", 0, "multi_conditional_and", "greater_than_equal,greater_than", a="qty", A="45", b="disc", B="0.05",
      then="y", otherwise="n"),
    R("gg2", 0, "multi_conditional_and_2", "greater_than_equal,greater_than", a="line", A="6", b="tax", B="0.07",
      then="y"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty >= 45 AND disc > 0.05 THEN 'y' ELSE 'n' END AS gg,
  CASE WHEN line >= 6 AND tax > 0.07 THEN 'y' END AS gg2 FROM r1""")

register("multi_gte_gt_observed", "R1", [
    R("gg", 0, "multi_conditional_and", "greater_than_equal,greater_than", a="qty", A="45", b="disc", B="0.05",
      then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty = 45 AND disc > 0.05 THEN 'y' ELSE 'n' END AS gg FROM r1""",
    mode="observed")

register("multi_eq4", "R1", [
    R("e4", 0, "multi_conditional_and_2", "equal,equal,equal,equal", a="line", A="1", b="tax", B="0", c="disc",
      C="0", d="status", D="1", then="y", otherwise="n"),
    R("e4b", 0, "multi_conditional_and_2", "equal,equal,equal,equal", a="line", A="1", b="tax", B="0", c="disc",
      C="0.1", d="line", D="1", then="y", otherwise="n"),
], _with(R1_SQL) + f"""SELECT response_id, {NULLS} AS e4,
  CASE WHEN line = 1 AND tax = 0 AND disc = 0.1 THEN 'y' ELSE 'n' END AS e4b FROM r1""")

register("multi_eq3", "R1", [
    R("e3", 0, "multi_conditional_and_3", "equal,equal,equal", a="line", A="2", b="tax", B="0.02", c="disc",
      C="0.04", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line = 2 AND tax = 0.02 AND disc = 0.04 THEN 'y' ELSE 'n' END AS e3
  FROM r1""")

register("multi_eq_lt_lt", "R1", [
    R("ell", 0, "multi_conditional_and_2", "equal,less_than,less_than", a="line", A="3", b="qty", B="10", c="disc",
      C="0.02", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line = 3 AND qty < 10 AND disc < 0.02 THEN 'y' ELSE 'n' END AS ell
  FROM r1""")

register("multi_eq_gte", "R1", [
    R("egte", 0, "multi_conditional_and_3", "equal,greater_than_equal", a="line", A="1", b="qty", B="48",
      then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line = 1 AND qty >= 48 THEN 'y' ELSE 'n' END AS egte FROM r1""")

register("multi_eq_gte_observed", "R1", [
    R("egte", 0, "multi_conditional_and_3", "equal,greater_than_equal", a="line", A="1", b="qty", B="48",
      then="y", otherwise="n"),
    R("egte_txt", 0, "multi_conditional_and_3", "equal,greater_than_equal", a="flag", A="1", b="qty", B="48",
      then="y", otherwise="n"),
], _with(R1_SQL) + f"""SELECT response_id, {NULLS} AS egte, {NULLS} AS egte_txt FROM r1""", mode="observed")

register("multi_eq_lt", "R1", [
    R("elt", 0, "multi_conditional_and_3", "equal,less_than", a="line", A="4", b="qty", B="3", then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN line = 4 AND qty < 3 THEN 'y' ELSE 'n' END AS elt FROM r1""")

register("multi_lt_gte", "R1", [
    R("lg", 0, "multi_conditional_and_3", "less_than,greater_than_equal", a="qty", A="3", b="disc", B="0.09",
      then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty < 3 AND disc >= 0.09 THEN 'y' ELSE 'n' END AS lg FROM r1""")

register("multi_lt_lt", "R1", [
    R("ll", 0, "multi_conditional_and_3", "less_than,less_than", a="qty", A="2", b="tax", B="0.01",
      then="y", otherwise="n"),
], _with(R1_SQL) + """SELECT response_id, CASE WHEN qty < 2 AND tax < 0.01 THEN 'y' ELSE 'n' END AS ll FROM r1""")

# ------------------------------------------------------- V1-V12 value rules

register("recode", "R1", [
    R("rc", 0, "recode", a="line"),
    R("rc_bad", 0, "recode", a="disc"),
], _with(R1_SQL) + f"""SELECT response_id, {I('6 - line')} AS rc, {NULLS} AS rc_bad FROM r1""")

register("recode_2", "R1", [R("rc2", 0, "recode_2", a="line")],
         _with(R1_SQL) + f"""SELECT response_id, {I('8 - line')} AS rc2 FROM r1""")

register("recode_2_observed", "R1", [R("rc2", 0, "recode_2", a="line")],
         _with(R1_SQL) + f"""SELECT response_id, {I('6 - line')} AS rc2 FROM r1""", mode="observed")

register("recode_3", "R1", [R("rc3", 0, "recode_3", a="qty")],
         _with(R1_SQL) + f"""SELECT response_id, {I('6 - qty')} AS rc3 FROM r1""")

register("subtraction", "R1", [
    R("d1", 0, "subtraction", a="qty", b="line"),
    R("d2", 0, "subtraction", a="disc", b="tax"),
    R("d3", 0, "subtraction", a="flag", b="tax"),
], _with(R1_SQL) + f"""SELECT response_id, {F('qty - line')} AS d1, {F('disc - tax')} AS d2, {NULLS} AS d3 FROM r1""")

register("product", "R1", [
    R("p1", 0, "product", a="disc", A="100"),
    R("p2", 0, "product", a="flag", A="2"),
    R("p3", 0, "product", a="qty", A="abc"),
], _with(R1_SQL) + f"""SELECT response_id, {F('disc * 100.0')} AS p1, '' AS p2, '' AS p3 FROM r1""")

register("sum_keys", "R2", [
    R("tot", 0, "sum", a="qty_1,qty_2,qty_3,qty_4,qty_5,qty_6,qty_7"),
    R("tot2", 0, "sum_2", a="qty_6,qty_7,qty_7"),
], _with(R2_SQL) + f"""SELECT response_id, survey_id,
  CASE WHEN len(list_filter([q1, q2, q3, q4, q5, q6, q7], lambda x: x IS NOT NULL)) = 0 THEN ''
       ELSE {F('list_sum(list_filter([q1, q2, q3, q4, q5, q6, q7], lambda x: x IS NOT NULL))')} END AS tot,
  CASE WHEN q6 IS NULL AND q7 IS NULL THEN '' ELSE {F('coalesce(q6, 0) + coalesce(q7, 0)')} END AS tot2 FROM r2""")

register("sum_list_text", "R4", [
    R("tot", 0, "sum", a="vals"),
    R("tot_click", 0, "sum_3", a="vals,click"),
    R("k_sum", 0, "sum_4", a="k,nokey"),
], _with(R4_SQL, """kk AS (SELECT CAST(user_id AS VARCHAR) AS response_id,
  max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k FROM events GROUP BY user_id)""")
    + f"""SELECT r4.response_id, {F('total')} AS tot, {F('total + click')} AS tot_click, {F('k')} AS k_sum
  FROM r4 JOIN kk ON r4.response_id = kk.response_id""")

register("mean_all", "R1", [
    R("m1", 0, "mean", a="qty,line"),
    R("m2", 0, "mean", a="qty,qty,line"),
    R("m3", 0, "mean", a="qty,nokey"),
], _with(R1_SQL) + f"""SELECT response_id, {F('(qty + line) / 2')} AS m1, {F('(qty + qty + line) / 3')} AS m2,
  {NULLS} AS m3 FROM r1""")

MEAN_TEXT = ("CASE WHEN {s} / {c} = floor({s} / {c}) THEN CAST(CAST({s} / {c} AS BIGINT) AS VARCHAR) "
             "ELSE CAST(CAST({s} AS DOUBLE) / {c} AS VARCHAR) END")

register("mean_n_or_more", "R2", [
    R("m3", 0, "mean_3_or_more", a="qty_1,qty_2,qty_3,qty_4"),
    R("m2", 0, "mean_2_or_more", a="qty_5,qty_6,qty_7"),
], _with(R2_SQL, """c AS (SELECT *, (q1 IS NOT NULL)::INT + (q2 IS NOT NULL)::INT + (q3 IS NOT NULL)::INT
  + (q4 IS NOT NULL)::INT AS c4, coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(q4, 0) AS s4,
  (q5 IS NOT NULL)::INT + (q6 IS NOT NULL)::INT + (q7 IS NOT NULL)::INT AS c3,
  coalesce(q5, 0) + coalesce(q6, 0) + coalesce(q7, 0) AS s3 FROM r2)""") + f"""SELECT response_id, survey_id,
  CASE WHEN 4 - c4 >= 3 THEN '' ELSE {MEAN_TEXT.format(s='s4', c='c4')} END AS m3,
  CASE WHEN 3 - c3 >= 2 THEN '' ELSE {MEAN_TEXT.format(s='s3', c='c3')} END AS m2 FROM c""")

register("mean_skipna", "R1", [
    R("ms1", 0, "mean_skipna", a="qty,line"),
    R("ms2", 0, "mean_skipna", a="qty,disc"),
    R("ms3", 0, "mean_skipna", a="flag,nokey"),
], _with(R1_SQL) + f"""SELECT response_id, {F('(qty + line) / 2')} AS ms1, {F('(qty + disc) / 2')} AS ms2,
  '' AS ms3 FROM r1""")

register("mean_skipna_observed", "R1", [
    R("ms1", 0, "mean_skipna", a="qty,line"),
    R("ms2", 0, "mean_skipna", a="qty,disc"),
    R("ms3", 0, "mean_skipna", a="nokey,flag"),
], _with(R1_SQL) + f"""SELECT response_id, {F('(qty + line) / 2')} AS ms1, '' AS ms2, {NULLS} AS ms3 FROM r1""",
    mode="observed")

register("merge", "R1", [
    R("fs", 0, "merge", a="flag", b="status"),
    R("ql", 0, "merge", a="qty", b="line"),
    R("qn", 0, "merge", a="qty", b="nokey"),
], _with(R1_SQL) + f"""SELECT response_id, flag || status AS fs, {I('qty')} || {I('line')} AS ql, {NULLS} AS qn
  FROM r1""")

register("copy", "R1", [
    R("cflag", 0, None, a="flag"),
    R("cdisc", 0, None, a="disc"),
], _with(R1_SQL) + f"""SELECT response_id, flag AS cflag, {F('disc')} AS cdisc FROM r1""")

register("count_items", "R4", [
    R("n_vals", 0, "count", a="vals"),
    R("n_click", 0, "count", a="click"),
], _with(R4_SQL) + f"""SELECT response_id, {I('ntypes')} AS n_vals, '1' AS n_click FROM r4""")

# ------------------------------------------ O11-O18 passes and rule order

register("first_match", "R1", [
    R("size", 0, "conditional", "greater_than", a="qty", A="40", then="L"),
    R("size", 0, "conditional", "greater_than", a="qty", A="20", then="M"),
    R("size", 0, "conditional", "equal", a="flag", A="1", then="never"),
    R("size", 0, "conditional", "less_than_equal", a="qty", A="20", then="S"),
], _with(R1_SQL) + """SELECT response_id,
  CASE WHEN qty > 40 THEN 'L' WHEN qty > 20 THEN 'M' END AS size FROM r1""")

register("later_pass_overwrites", "R1", [
    R("v", 0, "conditional", "greater_than_equal", a="qty", A="0", then="base"),
    R("v", 1, "conditional", "equal", a="line", A="1", then="line1"),
    R("v", 3, "conditional", "equal", a="line", A="2", then="line2", otherwise="other"),
    R("w", 2, "conditional", "equal", a="line", A="7", then="seven"),
], _with(R1_SQL) + """SELECT response_id,
  CASE WHEN line = 2 THEN 'line2' ELSE 'other' END AS v,
  CASE WHEN line = 7 THEN 'seven' END AS w FROM r1""")

register("drop_on_missing", "R3A", [
    R("q", 0, "conditional", "equal", a="quality", A="1", then="good", otherwise="bad"),
    R("q", 1, None, a="lang"),
    R("t", 0, "conditional", "equal", a="toxic", A="1", then="toxic"),
    R("t", 1, "merge", a="lang", b="source"),
], _with(R3_SQL) + """SELECT response_id,
  CASE WHEN quality IS NULL THEN NULL ELSE lang END AS q,
  CASE WHEN toxic IS NULL THEN NULL ELSE lang || source END AS t FROM r3""")

register("chained_vars", "R1", [
    R("a", 0, "subtraction", a="qty", b="line"),
    R("b", 0, "conditional", "greater_than", a="a", A="20", then="big", otherwise="small"),
    R("c", 0, "merge", a="b", b="flag"),
    R("a", 1, "product", a="a", A="2"),
    R("d", 1, "merge", a="a", b="c"),
    R("flag", 1, "conditional", "equal", a="line", A="1", then="first"),
    R("e", 2, "merge", a="flag", b="status"),
], _with(R1_SQL) + f"""SELECT response_id, {F('(qty - line) * 2')} AS a,
  CASE WHEN qty - line > 20 THEN 'big' ELSE 'small' END AS b,
  CASE WHEN qty - line > 20 THEN 'big' ELSE 'small' END || flag AS c,
  {F('(qty - line) * 2')} || CASE WHEN qty - line > 20 THEN 'big' ELSE 'small' END || flag AS d,
  CASE WHEN line = 1 THEN 'first' ELSE flag END AS flag,
  CASE WHEN line = 1 THEN 'first' ELSE flag END || status AS e FROM r1""")

register("unset_absent", "R1", [
    R("never", 0, "conditional", "equal", a="qty", A="999", then="x"),
    R("some", 0, "conditional", "equal", a="line", A="7", then="seven"),
], _with(R1_SQL) + f"""SELECT response_id, key, value FROM (
  SELECT response_id, 'qty' AS key, {I('qty')} AS value FROM r1
  UNION ALL SELECT response_id, 'disc', {F('disc')} FROM r1
  UNION ALL SELECT response_id, 'tax', {F('tax')} FROM r1
  UNION ALL SELECT response_id, 'line', {I('line')} FROM r1
  UNION ALL SELECT response_id, 'flag', flag FROM r1
  UNION ALL SELECT response_id, 'status', status FROM r1
  UNION ALL SELECT response_id, 'some', 'seven' FROM r1 WHERE line = 7)""", output="long")

# ------------------------------------------------------------- flagship (R2)

FLAGSHIP_RULES = [
    R("tot", 0, "sum", a="qty_1,qty_2,qty_3,qty_4,qty_5,qty_6,qty_7"),
    R("avg4", 0, "mean_3_or_more", a="qty_1,qty_2,qty_3,qty_4"),
    R("size", 0, "conditional", "greater_than", a="tot", A="150", then="large"),
    R("size", 0, "conditional", "greater_than", a="tot", A="75", then="medium"),
    R("size", 0, "conditional", "less_than_equal", a="tot", A="75", then="small"),
    R("urgent", 0, "multi_conditional", "equal,greater_than", a="prio", A="1", b="qty_1", B="25",
      then="urgent_big", otherwise="normal"),
    R("size", 1, "conditional", "equal", a="prio", A="5", then="low_prio"),
    R("label", 1, "merge", a="size", b="ostatus"),
    R("tot", 2, "product", a="tot", A="2"),
]

FLAGSHIP_SQL = _with(R2_SQL, """b AS (SELECT *, list_filter([q1, q2, q3, q4, q5, q6, q7], lambda x: x IS NOT NULL) AS qs,
  (q1 IS NOT NULL)::INT + (q2 IS NOT NULL)::INT + (q3 IS NOT NULL)::INT + (q4 IS NOT NULL)::INT AS c4,
  coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0) + coalesce(q4, 0) AS s4 FROM r2)""",
    """c AS (SELECT *, CASE WHEN len(qs) > 0 THEN list_sum(qs) END AS tot_n FROM b)""",
    """d AS (SELECT *, CASE WHEN tot_n IS NULL THEN NULL WHEN tot_n > 150 THEN 'large' WHEN tot_n > 75 THEN 'medium'
  ELSE 'small' END AS size0 FROM c)""",
    """e AS (SELECT *, CASE WHEN size0 IS NOT NULL AND prio = 5 THEN 'low_prio' ELSE size0 END AS size1 FROM d)""") + f"""
SELECT response_id, survey_id,
  CASE WHEN tot_n IS NULL THEN '' ELSE {F('tot_n * 2')} END AS tot,
  CASE WHEN 4 - c4 >= 3 THEN '' ELSE {MEAN_TEXT.format(s='s4', c='c4')} END AS avg4,
  size1 AS size,
  CASE WHEN q1 IS NULL THEN NULL WHEN prio = 1 AND q1 > 25 THEN 'urgent_big' ELSE 'normal' END AS urgent,
  size1 || ostatus AS label FROM e"""

register("flagship_derive", "R2", FLAGSHIP_RULES, FLAGSHIP_SQL)

# ------------------------------------------------- O21-O22 long form, trace

register("long_form", "R3A", [
    R("q", 0, "conditional", "equal", a="quality", A="1", then="good", otherwise="bad"),
], _with(R3_SQL) + f"""SELECT response_id, key, value FROM (
  SELECT response_id, 'lang' AS key, lang AS value FROM r3
  UNION ALL SELECT response_id, 'source', source FROM r3
  UNION ALL SELECT response_id, 'n_chars', {I('n_chars')} FROM r3
  UNION ALL SELECT response_id, 'quality', {I('quality')} FROM r3 WHERE quality IS NOT NULL
  UNION ALL SELECT response_id, 'toxic', {I('toxic')} FROM r3 WHERE quality IS NOT NULL
  UNION ALL SELECT response_id, 'q', CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END FROM r3
    WHERE quality IS NOT NULL)""", output="long")

def _long_aligned(spark, sf_dir):
    """Answers and a second map, what kind of answer each key has, side by side per key."""
    kinds = "map('lang', 'text', 'source', 'text', 'n_chars', 'number', 'region', 'text') AS kind"
    rows = fx.document_responses(spark, sf_dir, "A").selectExpr("response_id", "values", kinds)
    return derive(rows, [R("q", 0, "conditional", "equal", a="quality", A="1", then="good", otherwise="bad")], output="long", align=["kind"])


QUERIES["long_aligned"] = _long_aligned
ORACLES["long_aligned"] = f"""WITH v AS ({ORACLES['long_form']}), k AS (
  SELECT response_id, kk.key, kk.kind FROM (SELECT DISTINCT response_id FROM v) CROSS JOIN (VALUES
    ('lang', 'text'), ('source', 'text'), ('n_chars', 'number'), ('region', 'text')) AS kk(key, kind))
  SELECT coalesce(v.response_id, k.response_id) AS response_id, coalesce(v.key, k.key) AS key, v.value, k.kind
  FROM v FULL JOIN k ON v.response_id = k.response_id AND v.key = k.key"""

register("trace_counts", "R1", [
    R("size", 0, "conditional", "greater_than", a="qty", A="40", then="L"),
    R("size", 0, "conditional", "greater_than", a="qty", A="20", then="M"),
    R("size", 0, "conditional", "equal", a="flag", A="1", then="never"),
    R("size", 1, "conditional", "equal", a="line", A="1", then="one"),
], _with(R1_SQL) + """SELECT 'size' AS variable, pass_number, rule_no, outcome, count(*) AS n FROM (
  SELECT 0 AS pass_number, 0 AS rule_no, CASE WHEN qty > 40 THEN 1 ELSE 2 END AS outcome FROM r1
  UNION ALL SELECT 0, 1, CASE WHEN qty > 20 THEN 1 ELSE 2 END FROM r1 WHERE qty <= 40
  UNION ALL SELECT 0, 2, 3 FROM r1 WHERE qty <= 20
  UNION ALL SELECT 1, 3, CASE WHEN line = 1 THEN 1 ELSE 2 END FROM r1 WHERE qty > 20)
  GROUP BY ALL""", output="trace")

# ------------------------------------------- O1-O10 ingestion and catalogue

from pyspark.sql import functions as _F  # noqa: E402

from varloom.plans.all_surveys import derive_all_surveys  # noqa: E402
from varloom.plans.rules import rules_dataframe  # noqa: E402
from varloom.session import work_dir  # noqa: E402
from varloom.sources import snapshots as snap  # noqa: E402
from varloom.sources import surveys as sv  # noqa: E402
from varloom.sources import tokens as tk  # noqa: E402
from varloom.streaming.ingest import ingest_all_surveys, ingest_available, read_sink  # noqa: E402

LATEST_SQL = """SELECT CAST(user_id AS VARCHAR) AS survey_id, CAST(event_id AS VARCHAR) AS continuation_token
  FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS rn FROM events) WHERE rn = 1"""


def _latest_token(spark, sf_dir):
    return tk.latest_tokens(fx.token_history(spark, sf_dir), fx.survey_catalogue(spark, sf_dir))


QUERIES["latest_token"] = _latest_token
ORACLES["latest_token"] = LATEST_SQL


def _active_only(spark, sf_dir):
    return sv.active_surveys(fx.survey_catalogue(spark, sf_dir))


QUERIES["active_only"] = _active_only
ORACLES["active_only"] = """SELECT DISTINCT CAST(user_id AS VARCHAR) AS survey_id, TRUE AS is_active
  FROM events WHERE user_id % 2 = 0"""


def _token_append(spark, sf_dir):
    """Append the latest token of every survey to a fresh store twice, read back the latest."""
    store = work_dir(spark, "tokens")
    latest = _latest_token(spark, sf_dir)
    tk.append_tokens(latest.withColumn("continuation_token", _F.concat("continuation_token", _F.lit("-old"))), store)
    tk.append_tokens(latest, store)
    return tk.latest_tokens(tk.read_tokens(spark, store))


QUERIES["token_append"] = _token_append
ORACLES["token_append"] = LATEST_SQL


RUN_1, RUN_2 = (snap.process_timestamp(datetime(2024, 1, d)) for d in (1, 2))
_TS = "process_timestamp"


def _snapshot_roundtrip(spark, sf_dir):
    """Land R2 as partitioned JSON snapshots, read them back, derive the flagship."""
    root = work_dir(spark, "snapshots")
    snap.write_snapshot(fx.order_responses(spark, sf_dir), root, RUN_1)
    return derive(snap.read_snapshot(spark, root).drop("response"), FLAGSHIP_RULES, output="wide")


QUERIES["snapshot_roundtrip"] = _snapshot_roundtrip
ORACLES["snapshot_roundtrip"] = f"SELECT *, TIMESTAMP '2024-01-01' AS process_timestamp FROM ({FLAGSHIP_SQL})"


PAGE = 10_000  # responses of a landed document, on average


def _land_plain(responses, root):
    """Land responses as in an export: JSON documents of about ``PAGE`` responses, as many as a survey takes, a file each."""
    pages = responses.groupBy(_F.col("survey_id").alias("__survey")).agg(_F.ceil(_F.count("*") / PAGE).cast("int").alias("__pages"))
    doc = _F.concat(_F.lit('{"responses":['), _F.array_join(_F.sort_array(_F.collect_list("r")), ",\n "), _F.lit("]}"))
    one = _F.to_json(_F.struct(_F.col("response_id").alias("responseId"), "values", _F.lit("en").alias("language")))
    (responses.join(pages, _F.col("survey_id").eqNullSafe(_F.col("__survey")))
     .select("survey_id", _F.pmod(_F.xxhash64("response_id"), "__pages").alias("page"), one.alias("r"))
     .groupBy("survey_id", "page").agg(doc.alias("value")).drop("page")
     .write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("survey_id").text(root))


def _plain_tree(spark, sf_dir):
    """Copy what ``_land_plain`` wrote to ``surveys/<system>/<namespace>/<timestamp>/<survey>/survey_responses.json`` and its further pages."""
    flat, root = work_dir(spark, "plain-flat"), work_dir(spark, "plain")
    _land_plain(fx.order_responses(spark, sf_dir), flat)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(flat).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path(flat)):  # one per survey
        name = folder.getPath().getName()
        if name.startswith("survey_id="):
            target = f"{root}/surveys/system/namespace/{RUN_1}/{name.removeprefix('survey_id=')}"
            fs.mkdirs(path(target))
            parts = [x.getPath() for x in fs.listStatus(folder.getPath()) if x.getPath().getName().startswith("part-")]
            for i, part in enumerate(parts):
                fs.rename(part, path(f"{target}/{snap.PAGE_NAME.format(i) if i else snap.JSON_NAME}"))
    return root


def _snapshot_plain(spark, sf_dir):
    """R2 as a landed tree of four levels, read and derived; a field beside the answers comes along."""
    rows = snap.read_snapshot(spark, _plain_tree(spark, sf_dir), layout="plain")
    other = _F.get_json_object("response", "$.language").alias("language")
    return derive(rows.select("response_id", "survey_id", _TS, "values", other), FLAGSHIP_RULES, output="wide")


QUERIES["snapshot_plain"] = _snapshot_plain
ORACLES["snapshot_plain"] = f"SELECT *, TIMESTAMP '2024-01-01' AS process_timestamp, 'en' AS language FROM ({FLAGSHIP_SQL})"


def _typed_answers(spark, sf_dir):
    """List, boolean and number answers have the text that Python prints."""
    r2 = fx.order_responses(spark, sf_dir)
    flat = work_dir(spark, "typed")
    answers = _F.struct(_F.array(_F.concat(_F.lit("o"), "response_id"), _F.lit("b")).alias("l"), (_F.col("response_id") % 2 == 0).alias("t"),
                        _F.col("response_id").cast("double").alias("x"), _F.array(_F.lit(1), _F.lit(2)).alias("n"))
    snap.write_snapshot(r2.withColumn("values", answers), flat, RUN_1)
    rules = [R("list", 0, None, a="l"), R("truth", 0, "conditional", "is_in", a="t", A="True", then="y", otherwise="n"),
             R("number", 0, None, a="x"), R("total", 0, "sum", a="n")]
    return derive(snap.read_snapshot(spark, flat).drop("response"), rules, output="wide").drop(_TS)


QUERIES["typed_answers"] = _typed_answers
ORACLES["typed_answers"] = """SELECT CAST(o_orderkey AS VARCHAR) AS response_id, 'SV_' || substr(o_orderpriority, 1, 1) AS survey_id,
  '[' || chr(39) || 'o' || CAST(o_orderkey AS VARCHAR) || chr(39) || ', ' || chr(39) || 'b' || chr(39) || ']' AS list, CASE WHEN o_orderkey % 2 = 0 THEN 'y' ELSE 'n' END AS truth,
  CAST(CAST(o_orderkey AS DOUBLE) AS VARCHAR) AS number, '3.0' AS total FROM orders"""


def _incremental_ingest(spark, sf_dir):
    """Two landing runs and one idle run of the availableNow stream; the sink holds each row once."""
    landing, sink, ckpt = work_dir(spark, "landing"), work_dir(spark, "sink"), work_dir(spark, "ckpt")
    r2 = fx.order_responses(spark, sf_dir)
    first = _F.col("survey_id").isin("SV_1", "SV_2")
    snap.write_snapshot(r2.filter(first), landing, RUN_1)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    snap.write_snapshot(r2.filter(~first), landing, RUN_2)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    return read_sink(spark, sink)


QUERIES["incremental_ingest"] = _incremental_ingest
ORACLES["incremental_ingest"] = f"""SELECT *, CASE WHEN survey_id IN ('SV_1', 'SV_2') THEN TIMESTAMP '2024-01-01'
  ELSE TIMESTAMP '2024-01-02' END AS process_timestamp FROM ({FLAGSHIP_SQL})"""


def _incremental_reland(spark, sf_dir):
    """The same timestamp lands twice, the second time whole: the sink holds each row once."""
    landing, sink, ckpt = work_dir(spark, "landing"), work_dir(spark, "sink"), work_dir(spark, "ckpt")
    r2 = fx.order_responses(spark, sf_dir)
    snap.write_snapshot(r2.filter(_F.col("response_id").cast("long") % 2 == 0), landing, RUN_1)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide")
    snap.write_snapshot(r2, landing, RUN_1)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide", max_files_per_trigger=2)
    return read_sink(spark, sink)


QUERIES["incremental_reland"] = _incremental_reland
ORACLES["incremental_reland"] = ORACLES["snapshot_roundtrip"]

ODD_IDS = ["a:b", "a+b", "50%", "k=v", "two words", "007", "x[1]{2}", "%2B"]  # characters that paths escape, texts that look like numbers


def _ingest_odd_ids(spark, sf_dir):
    """Surveys whose ids need escaping, landed in two runs and seen in batches of a file: each arrives under its own id."""
    landing, sink, ckpt = work_dir(spark, "landing"), work_dir(spark, "sink"), work_dir(spark, "ckpt")
    names = _F.array(*map(_F.lit, ODD_IDS))
    r2 = fx.order_responses(spark, sf_dir).withColumn("survey_id", _F.get(names, (_F.col("response_id").cast("long") % len(ODD_IDS)).cast("int")))
    first = _F.col("survey_id").isin(ODD_IDS[:5])
    snap.write_snapshot(r2.filter(first), landing, RUN_1)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide", max_files_per_trigger=1)
    snap.write_snapshot(r2.filter(~first), landing, RUN_2)
    ingest_available(spark, landing, sink, ckpt, FLAGSHIP_RULES, output="wide", max_files_per_trigger=1)
    return read_sink(spark, sink)


QUERIES["ingest_odd_ids"] = _ingest_odd_ids
_ODD = "[" + ", ".join(f"'{x}'" for x in ODD_IDS) + "][CAST(response_id AS BIGINT) % " + str(len(ODD_IDS)) + " + 1]"
ORACLES["ingest_odd_ids"] = f"""SELECT * REPLACE ({_ODD} AS survey_id), CASE WHEN CAST(response_id AS BIGINT) % {len(ODD_IDS)} < 5
  THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS process_timestamp FROM ({FLAGSHIP_SQL})"""


def _survey_list(spark, sf_dir):
    """Write the R2 survey catalogue as list documents, read it, keep active surveys."""
    path = work_dir(spark, "survey_list")
    sv.write_survey_list(fx.order_survey_catalogue(spark, sf_dir), path)
    return sv.active_surveys(sv.read_survey_list(spark, path))


QUERIES["survey_list"] = _survey_list
ORACLES["survey_list"] = """SELECT DISTINCT 'SV_' || substr(o_orderpriority, 1, 1) AS survey_id, TRUE AS is_active
  FROM orders WHERE substr(o_orderpriority, 1, 1) <> '3'"""


def _csv_header(spark, sf_dir):
    """Write a header-only CSV per R2 survey and read back key/label pairs."""
    path = work_dir(spark, "csv_header")
    snap.write_csv_header(fx.order_responses(spark, sf_dir), path)
    return snap.read_csv_header(spark, path).drop("import_id")


def _csv_header_plain(spark, sf_dir):
    """The same from a landed tree of four levels."""
    flat, root = work_dir(spark, "csv-flat"), work_dir(spark, "csv-plain")
    snap.write_csv_header(fx.order_responses(spark, sf_dir), flat)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(flat).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.listStatus(path(flat)):  # one per survey
        name = folder.getPath().getName()
        for part in fs.listStatus(folder.getPath()) if name.startswith("survey_id=") else ():
            if part.getPath().getName().startswith("part-"):
                target = f"{root}/surveys/system/namespace/{RUN_1}/{name.removeprefix('survey_id=')}"
                fs.mkdirs(path(target))
                fs.rename(part.getPath(), path(f"{target}/{snap.CSV_NAME}"))
    return snap.read_csv_header(spark, root, layout="plain").drop("import_id")


def _odd_label(key):
    """A label with quotes, a comma and a line break."""
    return _F.concat(_F.lit('Say "'), _F.upper(key), _F.lit('",\nthen go on'))


def _csv_header_odd_labels(spark, sf_dir):
    path = work_dir(spark, "csv_odd_labels")
    snap.write_csv_header(fx.order_responses(spark, sf_dir), path, _odd_label)
    return snap.read_csv_header(spark, path).drop("import_id")


QUERIES["csv_header"] = _csv_header
QUERIES["csv_header_odd_labels"] = _csv_header_odd_labels
QUERIES["csv_header_plain"] = _csv_header_plain
ORACLES["csv_header"] = _with(R2_SQL, """k AS (SELECT DISTINCT survey_id, key FROM (
  SELECT survey_id, 'prio' AS key FROM r2 UNION ALL SELECT survey_id, 'ostatus' FROM r2
  UNION ALL SELECT survey_id, 'qty_1' FROM r2 WHERE q1 IS NOT NULL UNION ALL SELECT survey_id, 'qty_2' FROM r2 WHERE q2 IS NOT NULL
  UNION ALL SELECT survey_id, 'qty_3' FROM r2 WHERE q3 IS NOT NULL UNION ALL SELECT survey_id, 'qty_4' FROM r2 WHERE q4 IS NOT NULL
  UNION ALL SELECT survey_id, 'qty_5' FROM r2 WHERE q5 IS NOT NULL UNION ALL SELECT survey_id, 'qty_6' FROM r2 WHERE q6 IS NOT NULL
  UNION ALL SELECT survey_id, 'qty_7' FROM r2 WHERE q7 IS NOT NULL))""") + """SELECT survey_id,
  CAST(row_number() OVER (PARTITION BY survey_id ORDER BY key) - 1 AS INTEGER) AS position, key, upper(key) AS label FROM k"""
ORACLES["csv_header_plain"] = ORACLES["csv_header"]
ORACLES["csv_header_odd_labels"] = ORACLES["csv_header"].replace("upper(key) AS label", """'Say "' || upper(key) || '",' || chr(10) || 'then go on' AS label""")

TYPED_RULES = [
    R("same", 0, "conditional", "equal_string", a="q", A="1", then="y", otherwise="n"),
    R("doubled", 0, "product", a="q", A="2"),
    R("copied", 0, None, a="q"),
    R("is_two", 1, "conditional", "equal_string", a="doubled", A="2.0", then="y", otherwise="n"),
    R("is_one", 1, "conditional", "equal_string", a="copied", A="1", then="y", otherwise="n"),
]


def _typed_answers(spark, sf_dir):
    """equal_string with the answers' JSON kinds: orders of even keys answer with a number, the others with its text."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "concat('{\"responseId\":\"', o_orderkey, '\",\"values\":{\"q\":', "
        "if(o_orderkey % 2 = 0, CAST(o_orderkey % 3 AS STRING), concat('\"', o_orderkey % 3, '\"')), '}}') AS value")
    answers = snap.parse_responses(rows, _F.lit(RUN_1), _F.lit("SV_1")).withColumn("kinds", snap.answer_kinds(_F.col("response")))
    return derive(answers, TYPED_RULES, output="wide", kinds="kinds").select("response_id", "same", "is_two", "is_one")


QUERIES["typed_answers"] = _typed_answers
ORACLES["typed_answers"] = """SELECT CAST(o_orderkey AS VARCHAR) AS response_id, CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 <> 0 THEN 'y' ELSE 'n' END AS same,
  'n' AS is_two, CASE WHEN o_orderkey % 3 = 1 THEN 'y' ELSE 'n' END AS is_one FROM orders"""

ALL_SURVEY_RULES = (
    [dict(R("big", 0, "conditional", "greater_than", a="qty_1", A="25", then="y", otherwise="n"), survey_id="SV_1")]
    + [dict(R("tot", 0, "sum", a="qty_1,qty_2,qty_3"), survey_id="SV_2")]
    + [dict(R("lbl", 0, "merge", a="prio", b="ostatus"), survey_id=s) for s in ("SV_3", "SV_4", "SV_5")]
)


def _survey_rules(spark):
    rules = rules_dataframe(spark, [{k: v for k, v in r.items() if k != "survey_id"} for r in ALL_SURVEY_RULES])
    ids = spark.createDataFrame([(i, r["survey_id"]) for i, r in enumerate(ALL_SURVEY_RULES)], "rule_no int, survey_id string")
    return rules.join(ids, "rule_no")


def _all_surveys(spark, sf_dir):
    return derive_all_surveys(fx.order_responses(spark, sf_dir), _survey_rules(spark), fx.order_survey_catalogue(spark, sf_dir))


def _ingest_all_surveys(spark, sf_dir):
    """Every active survey's new files, derived by its own rules: two landing runs, the second replaces the first."""
    landing, sink, ckpt = work_dir(spark, "landing"), work_dir(spark, "sink"), work_dir(spark, "ckpt")
    r2, surveys = fx.order_responses(spark, sf_dir), fx.order_survey_catalogue(spark, sf_dir)
    for rows in (r2.filter(_F.col("response_id").cast("long") % 2 == 0), r2):
        snap.write_snapshot(rows, landing, RUN_1)
        ingest_all_surveys(spark, landing, sink, ckpt, _survey_rules(spark), surveys)
    return read_sink(spark, sink).drop(_TS)


QUERIES["ingest_all_surveys"] = _ingest_all_surveys


QUERIES["all_surveys"] = _all_surveys
ORACLES["all_surveys"] = _with(R2_SQL) + f"""SELECT response_id, survey_id,
  CASE WHEN survey_id = 'SV_1' AND q1 IS NOT NULL THEN CASE WHEN q1 > 25 THEN 'y' ELSE 'n' END END AS big,
  CASE WHEN survey_id = 'SV_2' THEN CASE WHEN q1 IS NULL AND q2 IS NULL AND q3 IS NULL THEN ''
    ELSE {F('coalesce(q1, 0) + coalesce(q2, 0) + coalesce(q3, 0)')} END END AS tot,
  CASE WHEN survey_id IN ('SV_4', 'SV_5') THEN CAST(prio AS VARCHAR) || ostatus END AS lbl
  FROM r2 WHERE survey_id <> 'SV_3'"""
ORACLES["ingest_all_surveys"] = ORACLES["all_surveys"]

# ---------------------------------------------- breadth and depth (bench shapes)

_WIDE_KEYS = [("qty", "25"), ("disc", "0.05"), ("tax", "0.04"), ("line", "4")]
WIDE_RULES = [R(f"v{i}", 0, "conditional", "greater_than_equal", a=_WIDE_KEYS[i % 4][0], A=_WIDE_KEYS[i % 4][1],
                then="y", otherwise="n") for i in range(50)]
register("wide_rules_50", "R1", WIDE_RULES, _with(R1_SQL) + "SELECT response_id, " + ", ".join(
    f"CASE WHEN {_WIDE_KEYS[i % 4][0]} >= {_WIDE_KEYS[i % 4][1]} THEN 'y' ELSE 'n' END AS v{i}" for i in range(50))
    + " FROM r1")

CHAIN_RULES = [R("c0", 0, "product", a="qty", A="1")] + [
    R(f"c{i}", 0, "product" if i % 2 else "subtraction", a=f"c{i - 1}", A="2", b="line") for i in range(1, 10)]


def _chain_sql() -> str:
    exprs, cur = [], "qty * 1.0"
    exprs.append(f"{F(cur)} AS c0")
    for i in range(1, 10):
        cur = f"({cur}) * 2.0" if i % 2 else f"({cur}) - line"
        exprs.append(f"{F(cur)} AS c{i}")
    return _with(R1_SQL) + "SELECT response_id, " + ", ".join(exprs) + " FROM r1"


register("chain_depth_10", "R1", CHAIN_RULES, _chain_sql())

CHAIN_20 = [R("c0", 0, "product", a="qty", A="1")] + [R(f"c{i}", 0, "product", a=f"c{i - 1}", A="1") for i in range(1, 20)]
register("chain_depth_20", "R1", CHAIN_20, _with(R1_SQL) + "SELECT response_id, " + ", ".join(
    f"{F('qty')} AS c{i}" for i in range(20)) + " FROM r1")

register("mean_three_decimals", "R1", [
    R("m3", 0, "mean", a="disc,tax,qty"),
    R("m3s", 0, "mean_skipna", a="disc,tax,qty"),
], _with(R1_SQL, """whole AS (SELECT response_id, CAST(disc * pow(2, 60) AS HUGEINT) + CAST(tax * pow(2, 60) AS HUGEINT)
  + CAST(qty * pow(2, 60) AS HUGEINT) AS s FROM r1)""", """third AS (SELECT response_id,
  (s * 1099511627776) // 3 + CASE WHEN (s * 1099511627776) % 3 = 0 THEN 0 ELSE 1 END AS q3 FROM whole)""") + f"""SELECT response_id,
  {F('CAST(q3 AS DOUBLE) / pow(2, 100)')} AS m3, {F('CAST(q3 AS DOUBLE) / pow(2, 100)')} AS m3s FROM third""")

# One key of each document is empty while its guard key is a number: the null tests have something to find.
FIXTURE["R3D"] = lambda s, d: fx.document_responses(s, d, "D")
register("null_guards", "R3D", [
    R("multi", 0, "multi_conditional", "equal,is_null", a="quality", A="1", b="toxic", then="x", otherwise="o"),
    R("both", 0, "multi_conditional_and", "equal,is_null", a="quality", A="1", b="toxic", then="x", otherwise="o"),
    R("pair", 0, "multi_conditional_and", "equal,equal", a="quality", A="1", b="n_even", B="1", then="x", otherwise="o"),
    R("over", 0, "multi_conditional_and", "equal,greater_than", a="quality", A="1", b="n_even", B="0", then="x", otherwise="o"),
], _with(R3_SQL) + """SELECT response_id,
  CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 AND CAST(response_id AS BIGINT) % 2 = 0 THEN 'x' ELSE 'o' END AS multi,
  CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 AND CAST(response_id AS BIGINT) % 2 = 0 THEN 'x' ELSE 'o' END AS "both",
  CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 AND n_chars % 2 = 0 THEN 'x' ELSE 'o' END AS pair,
  CASE WHEN quality IS NULL THEN NULL WHEN quality = 1 AND n_chars % 2 = 0 THEN 'x' ELSE 'o' END AS over FROM r3""")
