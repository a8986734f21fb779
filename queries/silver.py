"""Silver transform and key rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import column, comparable, read, spec
from siltstone import table_spec
from siltstone.operators.silver import (
    drop_violations,
    key_rules,
    observe_rules,
    rule_metrics,
    silver_staging,
    silver_transform,
)
from siltstone.spec import column_spec


def _columns(*raw: dict):
    return [column_spec(c) for c in raw]


def _padded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw text: padded, dates packed, open orders marked ``-``."""
    def padded(c):
        return F.concat(F.lit("  "), c, F.lit(" "))

    return read(spark, sf_dir, "orders").select(
        padded(F.col("o_orderkey").cast("string")).alias("ORD#"),
        padded(F.col("o_custkey").cast("string")).alias("o_custkey"),
        padded(F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_orderstatus"))).alias("STATUS"),
        padded(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        padded(F.date_format("o_orderdate", "yyyyMMdd")).alias("o_orderdate"),
        padded(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")).alias("o_placed_at"),
        F.col("o_orderpriority"),
    )


_ORDERS = spec(
    "orders",
    "rawords",
    [
        column("o_orderkey", "long", source="ORD#"),
        column("o_custkey", "integer"),
        column("o_orderstatus", "string", source="STATUS", markers=["-", ""]),
        column("o_totalprice", "double"),
        column("o_orderdate", "date", fmt="yyyyMMdd"),
        column("o_placed_at", "timestamp", fmt="dd/MM/yyyy HH:mm:ss"),
        column("o_absent", "string"),
    ],
    keys=["o_orderkey", "o_orderstatus"],
)
_ORDERS_SQL = """
SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderdate AS o_placed_at, o_orderpriority
FROM orders
"""


def transformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table_spec(_ORDERS, "orders")
    return comparable(silver_transform(_padded_orders(spark, sf_dir), parsed.columns))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(silver_staging(_padded_orders(spark, sf_dir), table_spec(_ORDERS, "orders")))


def trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("   "), "text", F.lit("  ")).alias("text"), "n_chars"
    )
    return silver_transform(raw, _columns(column("text", "string"), column("n_chars", "string")))


def null_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.concat(F.lit(" "), "l_returnflag").alias("l_returnflag"), "l_linestatus"
    )
    return silver_transform(
        raw,
        _columns(
            column("l_linenumber", "integer", trim=False, markers=["1", "2"]),
            column("l_returnflag", "string", markers=["N", ""]),
            column("l_linestatus", "string", trim=False, markers=["0E-8", "-", "", "null", "NULL"]),
        ),
    )


def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("as_long"),
        F.col("l_linenumber").cast("string").alias("as_integer"),
        F.col("l_extendedprice").cast("string").alias("as_double"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("false").alias("as_boolean"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("as_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("as_timestamp"),
        F.col("l_suppkey").alias("as_string"),
        F.col("l_partkey").alias("untyped"),
    )
    kinds = ["long", "integer", "double", "boolean", "date", "timestamp", "string"]
    columns = [column(f"as_{kind}", kind, trim=False) for kind in kinds] + [column("untyped", "decimal", trim=False)]
    return comparable(silver_transform(raw, _columns(*columns)))


def cast_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text that does not convert: blank, a word, out of range."""
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, F.lit(""))
        .when(line == 2, F.lit("abc"))
        .when(line == 3, F.lit("3000000000"))
        .otherwise(F.concat(F.lit(" "), line.cast("string")))
    )
    raw = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("number"))
    return silver_transform(raw, _columns(column("number", "integer")), on_error="null")


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed dates of finished orders; those of open orders are no dates."""
    wrong = F.col("o_orderstatus") == "P"
    raw = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(wrong, "20249999").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("packed"),
        F.when(wrong, "never").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH.mm")).alias("moment"),
    )
    columns = _columns(
        column("day", "date", fmt="yyyyMMdd"),
        column("packed", "date", trim=False, fmt="yyyyMMdd"),
        column("moment", "timestamp", fmt="yyyy/MM/dd HH.mm"),
    )
    return comparable(silver_transform(raw, columns, on_error="null"))


def passed_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _columns(column("nation_key", "long", source="n_nationkey"), column("N_NAME", "string"))
    return silver_transform(read(spark, sf_dir, "nation"), columns)


def _keyless_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which one in ten has no user, one in seven no type."""
    number = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.when(number % 10 != 0, F.col("user_id")).alias("user_id"),
        F.when(number % 7 != 0, F.col("event_type")).alias("event_type"),
    )


_RULES = key_rules(["user_id", "event_type"])


def null_keys_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_violations(_keyless_events(spark, sf_dir), _RULES)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_metrics(_keyless_events(spark, sf_dir), _RULES)


def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, taken while the rows are counted for another purpose."""
    rows, seen = observe_rules(_keyless_events(spark, sf_dir), _RULES)
    kept = drop_violations(rows, _RULES).count()
    return spark.createDataFrame([{**seen.get, "kept": kept}])


_KEYLESS_SQL = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id,
                  CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type FROM events)
"""

QUERIES = {
    "silver_transform": transformed,
    "silver_staging": staged,
    "silver_trim": trimmed,
    "silver_null_markers": null_markers,
    "silver_cast": cast_types,
    "silver_cast_or_null": cast_or_null,
    "silver_parse_dates": parsed_dates,
    "silver_passthrough": passed_through,
    "silver_drop_null_keys": null_keys_dropped,
    "silver_rule_metrics": metrics,
    "silver_rule_observation": observed_metrics,
}

ORACLE = {
    "silver_transform": _ORDERS_SQL,
    "silver_staging": _ORDERS_SQL + " WHERE o_orderkey IS NOT NULL AND o_orderstatus <> 'P'",
    "silver_trim": "SELECT doc_id, trim(text) AS text, CAST(n_chars AS VARCHAR) AS n_chars FROM documents",
    "silver_null_markers": """
        SELECT l_orderkey, CASE WHEN l_linenumber NOT IN (1, 2) THEN l_linenumber END AS l_linenumber, l_quantity,
               nullif(l_returnflag, 'N') AS l_returnflag, l_linestatus
        FROM lineitem""",
    "silver_cast": """
        SELECT l_orderkey AS as_long, l_linenumber AS as_integer, l_extendedprice AS as_double,
               l_linestatus = 'O' AS as_boolean, CAST(l_shipdate AS DATE) AS as_date, l_shipdate AS as_timestamp,
               CAST(l_suppkey AS VARCHAR) AS as_string, l_partkey AS untyped
        FROM lineitem""",
    "silver_cast_or_null": """
        SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 3 THEN l_linenumber END AS number FROM lineitem""",
    "silver_parse_dates": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
               CAST(o_orderdate AS DATE) AS packed, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS moment
        FROM orders""",
    "silver_passthrough": """
        SELECT CAST(n_nationkey AS BIGINT) AS nation_key, n_name AS "N_NAME", n_regionkey FROM nation""",
    "silver_drop_null_keys": _KEYLESS_SQL + "SELECT * FROM e WHERE user_id IS NOT NULL AND event_type IS NOT NULL",
    "silver_rule_metrics": _KEYLESS_SQL + """
        SELECT 'valid_user_id' AS rule, count(user_id) AS passed, count(*) - count(user_id) AS dropped FROM e
        UNION ALL
        SELECT 'valid_event_type', count(event_type), count(*) - count(event_type) FROM e""",
    "silver_rule_observation": _KEYLESS_SQL + """
        SELECT count(user_id) AS valid_user_id_passed, count(*) - count(user_id) AS valid_user_id_dropped,
               count(event_type) AS valid_event_type_passed, count(*) - count(event_type) AS valid_event_type_dropped,
               count(*) FILTER (WHERE user_id IS NOT NULL AND event_type IS NOT NULL) AS kept
        FROM e""",
}
