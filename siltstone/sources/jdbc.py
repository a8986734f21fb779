"""Whole-table JDBC scans."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltstone.spec import TableSpec

# Session settings that describe the database, by the part of
# the connection they hold.
CONF_KEYS = {
    "host": "pipeline.jdbc_host",
    "port": "pipeline.jdbc_port",
    "database": "pipeline.jdbc_database",
    "driver": "pipeline.jdbc_driver",
    "ssl_mode": "pipeline.jdbc_ssl_mode",
}
# The URL, and the reader options for a large table.
URL = "jdbc:postgresql://{host}:{port}/{database}?sslmode={ssl_mode}"
TUNING_OPTIONS = ("fetchsize", "partitionColumn", "lowerBound", "upperBound", "numPartitions")
_TUNING_CONF = "pipeline.jdbc_{}"
URL_CONF = "pipeline.jdbc_url"
_SPLIT = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
# Prefixes of a text column are lengthened, by a letter at a time, as long as their number stays below this.
MAX_PREFIXES, LETTERS = 10_000, 10


def jdbc_options(connection: Mapping[str, Any], user: str, password: str, table: str | None = None) -> dict[str, str]:
    """Reader options from a spec's ``jdbc`` block; credentials come from the caller."""
    tuning = {key: str(connection[key]) for key in TUNING_OPTIONS if connection.get(key) is not None}
    return {
        "url": connection.get("url") or URL.format(**{k: connection[k] for k in CONF_KEYS if k != "driver"}),
        "dbtable": table or connection["table"],
        "driver": connection["driver"],
        "user": user,
        "password": password,
        **tuning,
    }


def jdbc_options_from_conf(spark: SparkSession, table: str, user: str, password: str) -> dict[str, str]:
    """Reader options for ``table`` from the session settings, tuning options included where set.

    A whole URL may be set instead of its parts.
    """
    connection = {"url": spark.conf.get(URL_CONF, None)}
    for part in ("driver",) if connection["url"] else CONF_KEYS:
        connection[part] = spark.conf.get(CONF_KEYS[part])
    for option in TUNING_OPTIONS:
        connection[option] = spark.conf.get(_TUNING_CONF.format(option), None)
    return jdbc_options(connection, user, password, table)


def declared_jdbc_options(spark: SparkSession, spec: TableSpec, user: str, password: str) -> dict[str, str] | None:
    """Reader options from the spec's own block, else from the session settings; ``None`` if neither names a database."""
    if spec.jdbc:
        return jdbc_options({"table": spec.source_table, **spec.jdbc}, user, password)
    if any(spark.conf.get(key, None) for key in (URL_CONF, CONF_KEYS["host"])):
        return jdbc_options_from_conf(spark, spec.source_table, user, password)
    return None


def scan_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """The table as one frame.

    A single connection reads it unless the options split a column
    (``partitionColumn`` and ``numPartitions``): a number or a date by its bounds,
    text by ranges that the database is asked for.  Projections and filters on the
    result are pushed to the database.
    """
    column, parts = options.get("partitionColumn"), int(options.get("numPartitions") or 1)
    whole = {k: v for k, v in options.items() if k not in _SPLIT}
    if column and parts > 1:
        found = spark.read.format("jdbc").options(**whole).load().schema
        kind = next((f.dataType for f in found.fields if f.name.lower() == column.strip('"`').lower()), None)
        if isinstance(kind, T.StringType):
            ranges = text_ranges(spark, whole, column, parts)
            rest = {k: v for k, v in whole.items() if k not in ("url", "dbtable")}
            return spark.read.jdbc(options["url"], options["dbtable"], predicates=ranges, properties=rest)
    return spark.read.format("jdbc").options(**options).load()


def text_ranges(spark: SparkSession, options: Mapping[str, str], column: str, parts: int) -> list[str]:
    """Conditions that split a table into ``parts`` ranges of a text column, of like size.

    The database counts the rows of each prefix; bounds are taken where the
    counts reach a part's share, and the database itself says in which order they
    stand there, so the ranges are whole whatever its collation.  Every row, null
    or of a later insert, meets exactly one condition.
    """
    table = options["dbtable"]
    reader = spark.read.format("jdbc").options(**{k: v for k, v in options.items() if k != "dbtable"})

    def ask(query: str) -> list:
        return reader.option("query", query).load().collect()

    low, high, longest, total = ask(
        f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, MAX(LENGTH({column})) AS l, COUNT(*) AS n FROM {table}"
    )[0]
    if low is None:
        return ["1 = 1"]
    width = len(os.path.commonprefix([low, high])) + 1
    while True:
        prefix = f"SUBSTR({column}, 1, {width})"
        counts = sorted(tuple(r) for r in ask(f"SELECT {prefix} AS p, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {prefix}"))
        fine = max(n for _, n in counts) * parts * 4 <= total or len(counts) * LETTERS > MAX_PREFIXES
        if fine or width >= longest:
            break
        width += 1
    bounds, below, share = [], 0, 1
    for text, n in counts:
        if below * parts >= total * share:
            bounds.append(text)
            share = below * parts // total + 1
        below += n
    if not bounds:
        return ["1 = 1"]
    literals = ["'" + b.replace("'", "''") + "'" for b in bounds]
    asked = " UNION ALL ".join(f"SELECT {k} AS k, COUNT(*) AS n FROM {table} WHERE {column} < {b}" for k, b in enumerate(literals))
    ranked = sorted((r[1], literals[r[0]]) for r in ask(asked))
    ordered = [b for k, (n, b) in enumerate(ranked) if k == 0 or n > ranked[k - 1][0]]
    conditions = [f"{column} < {ordered[0]} OR {column} IS NULL"]
    conditions += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(ordered, ordered[1:])]
    return [*conditions, f"{column} >= {ordered[-1]}"]
