"""varloom: derived survey variables computed with Spark DataFrame expressions."""

from varloom.operators.derive import derive, long_form, trace
from varloom.plans.compiler import compile_rules
from varloom.plans.rules import load_rules, rule, rules_dataframe

__all__ = ["derive", "long_form", "trace", "compile_rules", "load_rules", "rule", "rules_dataframe"]
