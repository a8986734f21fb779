"""JDBC scans, on a database that lives inside this process."""

from __future__ import annotations

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from queries.bronze import EMBEDDED
from siltstone.plans.medallion import run_table
from siltstone.sources.jdbc import _SPLIT, jdbc_options, jdbc_options_from_conf, scan_jdbc, text_ranges
from siltstone.sources.scan import source_path_of, source_type_of
from siltstone import table_spec
from tests.conftest import rows

POSTGRES = {
    "host": "db.example", "port": "5432", "database": "bank", "ssl_mode": "require",
    "driver": "org.postgresql.Driver", "table": "rawp",
}
CONFIG = {
    "tables": {
        "person": {
            "bronze": {"source_table": "rawp"},
            "silver": {"primary_keys": ["id"], "incremental_columns": ["seq"], "partition_columns": "seq"},
            "columns": [
                {"name": "id", "source": "ID", "type": "integer"},
                {"name": "seq", "source": "SEQ", "type": "integer"},
                {"name": "name", "source": "NAME", "type": "string", "cleansing": {"trim": True}},
            ],
        }
    }
}


def stored(spark, *people):
    table = f"t{uuid.uuid4().hex}"
    options = jdbc_options(EMBEDDED | {"table": table}, "app", "app")
    put(spark, options, *people)
    return options


def put(spark, options, *people):
    df = spark.createDataFrame(list(people), "ID int, SEQ int, NAME string")
    df.write.format("jdbc").options(createTableColumnTypes="NAME VARCHAR(50)", **options).mode("overwrite").save()


def test_options_from_a_spec():
    found = jdbc_options(POSTGRES | {"fetchsize": 10000, "numPartitions": None, "lowerBound": 0}, "u", "p")
    assert found == {
        "url": "jdbc:postgresql://db.example:5432/bank?sslmode=require", "dbtable": "rawp",
        "driver": "org.postgresql.Driver", "user": "u", "password": "p", "fetchsize": "10000", "lowerBound": "0",
    }


def test_options_from_the_session(spark):
    conf = {f"pipeline.jdbc_{k}": v for k, v in POSTGRES.items() if k != "table"} | {"pipeline.jdbc_numPartitions": "8"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        found = jdbc_options_from_conf(spark, "rawp", "u", "p")
    finally:
        for key in conf:
            spark.conf.unset(key)
    assert found == jdbc_options(POSTGRES | {"numPartitions": 8}, "u", "p")


def test_scan_whole_and_in_parts(spark):
    options = stored(spark, *((i, 1, f"n{i}") for i in range(20)))
    whole = scan_jdbc(spark, options)
    assert whole.count() == 20 and whole.rdd.getNumPartitions() == 1
    split = {"partitionColumn": "ID", "lowerBound": "0", "upperBound": "20", "numPartitions": "4"}
    parts = scan_jdbc(spark, options | split)
    assert parts.rdd.getNumPartitions() == 4 and rows(parts) == rows(whole)


def test_filter_and_columns_are_pushed_to_the_database(spark):
    options = stored(spark, (1, 1, "a"), (2, 5, "b"))
    steps = scan_jdbc(spark, options).filter(F.col("SEQ") > 3).select("NAME")._jdf.queryExecution().toString()
    assert "GreaterThan(SEQ,3)" in steps and "ReadSchema: struct<NAME:string>" in steps


def test_database_flow_keeps_the_newest_and_what_the_source_dropped(spark, tmp_path):
    options = stored(spark, (1, 5, " a "), (2, 1, "b"), (3, 1, "c"))
    run = lambda: run_table(spark, CONFIG, "person", str(tmp_path), "jdbc", jdbc=options, as_of=datetime(2024, 1, 1), buckets=2)
    assert rows(run(), "id", "seq", "name") == [(1, 5, "a"), (2, 1, "b"), (3, 1, "c")]
    put(spark, options, (1, 4, "late"), (2, 2, "new"))
    assert rows(run(), "id", "seq", "name") == [(1, 5, "a"), (2, 2, "new"), (3, 1, "c")]
    assert rows(run(), "id", "seq", "source_file")[0] == (1, 5, "rawp")


def test_database_flow_described_by_the_session_or_the_spec(spark, tmp_path):
    from copy import deepcopy

    options = stored(spark, (1, 5, "a"), (2, 1, "b"))
    config = deepcopy(CONFIG)
    config["tables"]["person"]["bronze"]["source_table"] = options["dbtable"]
    for key in ("url", "driver"):
        spark.conf.set(f"pipeline.jdbc_{key}", options[key])
    try:
        found = run_table(spark, config, "person", str(tmp_path / "conf"), "jdbc", credentials=("app", "app"), buckets=2)
        assert rows(found, "id", "name") == [(1, "a"), (2, "b")]
    finally:
        for key in ("url", "driver"):
            spark.conf.unset(f"pipeline.jdbc_{key}")
    with pytest.raises(ValueError, match="JDBC"):
        run_table(spark, config, "person", str(tmp_path / "none"), "jdbc", credentials=("app", "app"), buckets=2)
    block = {"url": options["url"], "driver": options["driver"], "table": options["dbtable"]}
    config["tables"]["person"]["bronze"]["jdbc"] = {"read_options": block}
    found = run_table(spark, config, "person", str(tmp_path / "spec"), "jdbc", credentials=("app", "app"), buckets=2)
    assert rows(found, "id", "name") == [(1, "a"), (2, "b")]


def test_source_type_and_path(spark):
    spec = table_spec(CONFIG, "person")
    assert source_type_of(spark, spec) == "s3"
    assert source_type_of(spark, spec, "jdbc") == "jdbc"
    spark.conf.set("pipeline.source_type", "ftp")
    spark.conf.set("pipeline.s3_bucket", "s3://bucket/raw")
    try:
        with pytest.raises(ValueError, match="ftp"):
            source_type_of(spark, spec)
        assert source_path_of(spark, spec) == "s3://bucket/raw/rawp/"
    finally:
        spark.conf.unset("pipeline.source_type")
        spark.conf.unset("pipeline.s3_bucket")
    with pytest.raises(ValueError, match="JDBC"):
        run_table(spark, CONFIG, "person", "/nowhere", "jdbc")


def test_a_text_key_is_split_by_the_database(spark):
    names = [f"client {i % 7} {i:05d}" for i in range(400)] + ["o'neil", "Ärger", "zz", "", "client"]
    people = [(i, i, n) for i, n in enumerate(names)]
    options = stored(spark, *people) | {"partitionColumn": "NAME", "numPartitions": "5", "lowerBound": "1", "upperBound": "9"}
    found = scan_jdbc(spark, options)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert found.rdd.getNumPartitions() == 5 and sum(sizes) == len(people) and max(sizes) < 2 * len(people) / 5
    assert text_ranges(spark, {k: v for k, v in options.items() if k not in _SPLIT}, "NAME", 5)[0].endswith("NAME IS NULL")
    assert rows(found, "ID", "NAME") == rows(spark.createDataFrame([(i, n) for i, _, n in people], "ID int, NAME string"))


def test_a_text_key_of_one_value_or_no_row(spark):
    for people in ([(1, 1, "same"), (2, 1, "same")], [(1, 1, "x")]):
        options = stored(spark, *people) | {"partitionColumn": "NAME", "numPartitions": "3"}
        assert scan_jdbc(spark, options).count() == len(people)
    empty = stored(spark, (1, 1, "x")) | {"partitionColumn": "NAME", "numPartitions": "3"}
    spark.createDataFrame([], "ID int, SEQ int, NAME string").write.format("jdbc").options(
        createTableColumnTypes="NAME VARCHAR(50)", **{k: v for k, v in empty.items() if k not in _SPLIT}
    ).mode("overwrite").save()
    assert scan_jdbc(spark, empty).count() == 0
