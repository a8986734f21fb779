"""Silver transform, key rules and staging."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation

from siltstone.functions import cleansed, qualified, quoted
from siltstone.spec import ColumnSpec, TableSpec


def silver_transform(df: DataFrame, columns: Iterable[ColumnSpec], on_error: str = "fail") -> DataFrame:
    """Rename, trim, blank null markers and cast the listed columns.

    Everything happens in one projection, however wide the spec.  Columns that
    the spec does not list pass through; listed columns that the frame lacks
    are skipped.  Names are matched without regard to case, as Spark resolves
    them, and come out spelled as in the spec.
    """
    by_source: dict[str, ColumnSpec] = {}
    by_name: dict[str, ColumnSpec] = {}
    for spec in columns:
        by_source.setdefault(spec.source.lower(), spec)
        by_name.setdefault(spec.name.lower(), spec)

    outputs: list[tuple[str, Column]] = []
    for column in df.columns:
        spec = by_source.get(column.lower()) or by_name.get(column.lower())
        if spec is None:
            outputs.append((column, qualified(column)))
        else:
            outputs.append((spec.name, cleansed(qualified(column), spec, on_error)))

    names = [name.lower() for name, _ in outputs]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"two columns would be called {clashes}; rename one of them in the spec")
    return df.select(*(value.alias(name) for name, value in outputs))


def key_rules(primary_keys: Iterable[str]) -> dict[str, str]:
    """One named not-null rule per key column, as SQL predicates."""
    return {f"valid_{key}": f"{quoted(key)} IS NOT NULL" for key in primary_keys}


def drop_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep the rows that satisfy every rule."""
    for predicate in rules.values():
        df = df.filter(predicate)
    return df


def rule_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows ``(rule, passed, dropped)`` from a single pass over ``df``."""
    counts = []
    for predicate in rules.values():
        counts += _pass_and_drop(predicate)
    summary = df.agg(F.array(*counts).alias("counts"))
    per_rule = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                F.col("counts")[2 * i].alias("passed"),
                F.col("counts")[2 * i + 1].alias("dropped"),
            )
            for i, rule in enumerate(rules)
        )
    )
    return summary.select(F.inline(per_rule))


def observe_rules(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """Count passes and drops while ``df`` is being used for something else.

    The observation holds ``<rule>_passed`` and ``<rule>_dropped`` once an
    action on the returned frame has run; no extra pass is made.
    """
    observation = Observation("key_rules")
    counts = []
    for rule, predicate in rules.items():
        passed, dropped = _pass_and_drop(predicate)
        counts += [passed.alias(f"{rule}_passed"), dropped.alias(f"{rule}_dropped")]
    return df.observe(observation, *counts), observation


def observed_counts(df: DataFrame, rules: Mapping[str, str], observation: Observation) -> dict[str, int]:
    """What ``observation`` has seen of ``df``; counted by a pass of its own if nothing was left to observe.

    Where no row passes, adaptive execution replaces the plan by an empty one,
    and the observation goes with it.
    """
    try:
        found = observation.get
    except (Py4JJavaError, PySparkException):
        found = {}
    if found:
        return found
    return {
        f"{row.rule}_{what}": row[what] for row in rule_metrics(df, rules).collect() for what in ("passed", "dropped")
    }


def _pass_and_drop(predicate: str) -> tuple[Column, Column]:
    holds = F.coalesce(F.expr(predicate), F.lit(False))
    return F.count_if(holds), F.count_if(~holds)


def silver_staging(df: DataFrame, spec: TableSpec, on_error: str = "fail") -> DataFrame:
    """Transformed rows whose key columns are all present."""
    return drop_violations(silver_transform(df, spec.columns, on_error), key_rules(spec.primary_keys))
