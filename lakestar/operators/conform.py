"""Table-driven typing: one projection per table from a rule per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import StringType

from lakestar.functions.casts import lenient_date, lenient_double, lenient_int

Rule = str | Callable[[Column], Column]

_BY_TYPE: dict[str, Callable[[Column], Column]] = {
    "int": lenient_int,
    "double": lenient_double,
    "date": lenient_date,
    "string": lambda c: c.cast("string"),
}


def conform(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Apply a rule to each named column and pass the others through, in the order they came.

    A rule is a type name ("int", "double", "date", "string") or a function of the column.
    """
    typed = _typed(df, rules)
    return df.select(*[typed.get(name, F.col(f"`{name}`")).alias(name) for name in df.columns])


def _typed(df: DataFrame, rules: Mapping[str, Rule]) -> dict[str, Column]:
    unknown = [name for name in rules if name not in df.columns]
    if unknown:
        raise ValueError(f"no such column to conform: {', '.join(unknown)}")
    out = {}
    for field in df.schema.fields:
        rule, c = rules.get(field.name), F.col(f"`{field.name}`")
        if callable(rule):
            out[field.name] = rule(c)
        elif rule is not None:
            out[field.name] = _BY_TYPE[rule](c) if isinstance(field.dataType, StringType) else c.try_cast(rule)
    return out


def conform_counted(df: DataFrame, rules: Mapping[str, Rule]) -> tuple[DataFrame, Observation]:
    """``conform``, and an observation that holds, once the result has been written, the number of ``rows`` and for each rule, by
    its place in ``rules``, how many values it turned into NULL.

    Take ``df`` from a session of its own (``side_session``) where models are fitted. Each value is typed once: the counts are taken between the typing and the narrowing, so they cost no pass of their own.
    """
    typed, lost = _typed(df, rules), Observation()
    both = df.select("*", *[c.alias(f"_typed_{i}") for i, (_, c) in enumerate((n, typed[n]) for n in rules)])
    at = {name: f"_typed_{i}" for i, name in enumerate(rules)}
    counts = [F.count_if(F.col(f"`{n}`").isNotNull() & F.col(c).isNull()).alias(c.removeprefix("_typed_")) for n, c in at.items()]
    seen = both.observe(lost, F.count("*").alias("rows"), *counts)
    return seen.select(*[F.col(at.get(name, f"`{name}`")).alias(name) for name in df.columns]), lost


def not_null(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a NULL in the subset, or in any column."""
    return df.dropna(subset=subset)


def fill_null(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default in the named columns."""
    return df.fillna(dict(defaults))
