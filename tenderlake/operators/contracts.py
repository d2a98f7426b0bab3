"""Declared contracts of exported tables, compiled to column expressions and joins.

A contract names what a table's columns are: {"key": [...], "columns": {path: {...}}, "unique": [[...], ...], "references": [{...}, ...]}.
A path is a column, or a field of a struct after a dot, or the elements of an array by `[]`.  Rules of a path: `required`, `enum`, `pattern` (the whole
text), `least`, `most`, `format` (date, timestamp, uuid, sha256).  A reference is {"columns": [...], "table": ..., "to": [...]}.
All rules of columns are one pass over a table; each unique key is one aggregation, each reference one join.
"""

from __future__ import annotations

import functools
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Formats by the pattern of their text (fixed values).
FORMATS = {"date": r"\d{4}-\d{2}-\d{2}", "timestamp": r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}.*", "uuid": r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", "sha256": r"[0-9a-f]{64}"}
RULES = ("required", "enum", "pattern", "format", "least", "most")


def _checks(value: Column, rules: dict[str, Any]) -> dict[str, Column]:
    """By rule, whether a value breaks it; what is null breaks `required` only."""
    text = value.cast("string")
    whole = lambda p: ~F.regexp_like(text, F.lit(f"^(?:{p})$"))
    real = {"date": F.try_to_date(text).isNull(), "timestamp": F.try_to_timestamp(text).isNull()}
    made = {
        "required": lambda x: value.isNull() if x else F.lit(False),
        "enum": lambda x: ~text.isin([str(v) for v in x]),
        "pattern": whole,
        "format": lambda x: text.isNotNull() & (whole(FORMATS[x]) | real.get(x, F.lit(False))),
        "least": lambda x: value < x,
        "most": lambda x: value > x,
    }
    if unknown := set(rules) - set(RULES):
        raise ValueError(f"unknown rules: {', '.join(sorted(unknown))}")
    return {r: F.coalesce(made[r](x), F.lit(False)) for r, x in rules.items()}


def _breaks(of, rule: str, wanted: Any):
    """Whether an element breaks a rule."""
    return lambda x: _checks(of(x), {rule: wanted})[rule]


def broken(path: str, rules: dict[str, Any]) -> Column:
    """The names of the rules that a path breaks, each once however many elements break it."""
    parts = path.split("[]")
    if len(parts) == 1:
        found = _checks(F.col(path), rules)
        return F.filter(F.array(*[F.when(bad, F.lit(r)) for r, bad in found.items()]), lambda x: x.isNotNull())
    inner = parts[1].lstrip(".")
    of = lambda x: functools.reduce(lambda y, f: y[f], inner.split(".") if inner else [], x)
    return F.filter(F.array(*[F.when(F.exists(parts[0], _breaks(of, r, rules[r])), F.lit(r)) for r in rules]), lambda x: x.isNotNull())


def _key(contract: dict[str, Any]) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in contract["key"]])


def validate(tables: dict[str, DataFrame], contracts: dict[str, dict[str, Any]]) -> DataFrame:
    """(table, key, path, rule): every breach of every contract.

    A key in more rows than one breaks `unique` once for each of them; a reference to nothing breaks `reference`; null references and null keys
    break neither.  A declared column that a table lacks is one breach of `missing_column`, with a null key.  Defined cases: repeated rows breach each; empty
    tables breach nothing but `missing_column`.
    """
    found = []
    for name, contract in contracts.items():
        df, paths = tables[name], contract.get("columns", {})
        lacking = [p for p in paths if p.split("[]")[0].split(".")[0] not in df.columns]
        if lacking:
            rows = [(name, None, p, "missing_column") for p in lacking]
            found.append(df.sparkSession.createDataFrame(rows, "table string, key string, path string, rule string"))
        there = {p: r for p, r in paths.items() if p not in lacking}
        if there:
            each = F.concat(*[_named(p, broken(p, r)) for p, r in there.items()])
            found.append(df.select(F.lit(name).alias("table"), _key(contract).alias("key"), F.inline(each)))
        for columns in contract.get("unique", []):
            whole = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
            again = df.where(whole).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(c).alias(f"_{c}") for c in columns])
            same = functools.reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in columns])
            found.append(df.join(again, same).select(F.lit(name).alias("table"), _key(contract).alias("key"), F.lit(",".join(columns)).alias("path"), F.lit("unique").alias("rule")))
        for ref in contract.get("references", []):
            other = tables[ref["table"]].select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(ref["to"])]).distinct()
            same = functools.reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{i}") for i, c in enumerate(ref["columns"])])
            whole = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ref["columns"]])
            found.append(df.where(whole).join(other, same, "left_anti").select(F.lit(name).alias("table"), _key(contract).alias("key"), F.lit(",".join(ref["columns"])).alias("path"), F.lit("reference").alias("rule")))
    return functools.reduce(DataFrame.unionByName, found)


def _named(path: str, rules: Column) -> Column:
    return F.transform(rules, lambda x: F.struct(F.lit(path).alias("path"), x.alias("rule")))


def report(violations: DataFrame) -> DataFrame:
    """(table, path, rule, n)."""
    return violations.groupBy("table", "path", "rule").agg(F.count(F.lit(1)).alias("n"))
