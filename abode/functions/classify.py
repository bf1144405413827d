"""Ordered rule tables compiled to one ``CASE WHEN`` expression.

A rule table is data: a list of ``(condition, result)`` pairs, tried in
order, first match wins, with a default. Conditions are small tuples that
``compile_rules`` turns into one Spark Column.

Condition forms (``col`` is a column name):

    ("~", col, pattern)          regex search; a missing value never matches
    ("=", col, value)            equality; NULL-propagating
    ("in", col, [values])        membership; a missing value is never a member
    ("lower=", col, value)       equality on lower(col)
    ("lower_in", col, [values])  membership on lower(col)
    ("null", col)                col IS NULL
    ("<" | "<=" | ">" | ">=", col, number)
    ("and", c1, c2, ...), ("or", c1, c2, ...), ("not", c)
    ("true",)                    always
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Cond = tuple
Rules = Sequence[tuple[Cond, str]]

_CMP = {"<", "<=", ">", ">="}


def compile_cond(cond: Cond, columns: dict[str, Column] | None = None) -> Column:
    """Condition tuple -> boolean Column. ``columns`` may remap names."""
    op = cond[0]

    def ref(name: str) -> Column:
        if columns and name in columns:
            return columns[name]
        return F.col(name)

    if op == "~":
        return F.coalesce(ref(cond[1]).rlike(cond[2]), F.lit(False))
    if op == "=":
        return ref(cond[1]) == F.lit(cond[2])
    if op == "in":
        return F.coalesce(ref(cond[1]).isin(list(cond[2])), F.lit(False))
    if op == "lower=":
        return F.lower(ref(cond[1])) == F.lit(cond[2])
    if op == "lower_in":
        return F.coalesce(F.lower(ref(cond[1])).isin(list(cond[2])), F.lit(False))
    if op == "null":
        return ref(cond[1]).isNull()
    if op in _CMP:
        c, v = ref(cond[1]), F.lit(cond[2])
        return {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[op]
    if op == "and":
        out = compile_cond(cond[1], columns)
        for sub in cond[2:]:
            out = out & compile_cond(sub, columns)
        return out
    if op == "or":
        out = compile_cond(cond[1], columns)
        for sub in cond[2:]:
            out = out | compile_cond(sub, columns)
        return out
    if op == "not":
        return ~compile_cond(cond[1], columns)
    if op == "true":
        return F.lit(True)
    raise ValueError(f"unknown condition {op!r}")


def compile_rules(
    rules: Rules, default: str | None, columns: dict[str, Column] | None = None
) -> Column:
    """First-match rule table -> one CASE WHEN Column."""
    out = None
    for cond, result in rules:
        test = compile_cond(cond, columns)
        out = F.when(test, F.lit(result)) if out is None else out.when(test, F.lit(result))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def classify(rules: Rules, default: str | None, **columns: Column) -> Column:
    """Shorthand: ``classify(T01, "Unknown Tenure", TENURE=F.col("t"))``."""
    return compile_rules(rules, default, columns or None)


def if_else(cond: Column, yes: Column, no: Column) -> Column:
    """``yes`` or ``no``; a missing condition gives a missing value."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)
