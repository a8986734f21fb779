from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone import table_spec
from siltstone.operators.latest import change_order, latest_per_key
from siltstone.operators.merge import scd1_upsert
from siltstone.operators.snapshot import KeyedSnapshot
from siltstone.session import scratch_dir
from tests.conftest import rows

SCHEMA = "k int, seq int, v string"
CHANGES = st.lists(
    st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])),
    min_size=1,
    max_size=20,
)


def brute(changes):
    """Greatest (seq, v) per key, null least."""
    low = lambda x: (x is not None, x if x is not None else 0)
    lowt = lambda x: (x is not None, x or "")
    best = {}
    for row in changes:
        if row[0] not in best or (low(row[1]), lowt(row[2])) > (low(best[row[0]][1]), lowt(best[row[0]][2])):
            best[row[0]] = row
    return sorted(best.values(), key=lambda r: r[0])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=CHANGES, seed=st.integers(0, 9))
def test_equals_brute_force_in_any_order(spark, changes, seed):
    random.Random(seed).shuffle(changes)
    out = latest_per_key(spark.createDataFrame(changes, SCHEMA), ["k"], [F.col("seq")])
    assert sorted(map(tuple, out.collect()), key=lambda r: r[0]) == brute(changes)


def test_any_cut_into_batches_and_replays(spark):
    random.seed(5)
    changes = [(random.randint(0, 9), random.choice([None, 1, 2, 3]), random.choice("abc")) for _ in range(60)]
    for cuts in ([20, 40], [7, 9, 50]):
        random.shuffle(changes)
        table = KeyedSnapshot(spark, scratch_dir(spark, "cuts"), ["k"], 4)
        for low, high in zip([0, *cuts], [*cuts, 60]):
            batch = spark.createDataFrame(changes[low:high], SCHEMA)
            scd1_upsert(table, batch, [F.col("seq")])
        scd1_upsert(table, spark.createDataFrame(changes[:30], SCHEMA), [F.col("seq")])
        assert sorted(map(tuple, table.read().select("k", "seq", "v").collect())) == brute(changes)


def test_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq")).write.parquet(str(tmp_path / "t"))
    out = latest_per_key(spark.read.parquet(str(tmp_path / "t")), ["k"], [F.col("seq")])
    steps = out._jdf.queryExecution().executedPlan().toString()
    assert steps.index("Final") < steps.index("Exchange") < steps.index("Partial")
    assert steps.count("Exchange hashpartitioning") == 1


def test_order_from_the_spec(spark):
    def spec(columns):
        silver = {"primary_keys": ["k"], "incremental_columns": columns}
        return table_spec({"tables": {"t": {"bronze": {"source_table": "t"}, "silver": silver, "columns": []}}}, "t")

    df = spark.createDataFrame(
        [(1, 10, 5, 1), (1, 20, 4, 2), (1, 20, 3, 3), (2, None, 9, 9), (2, 1, 0, 1)],
        "k int, first int, second int, ingested_timestamp int",
    )
    newest = latest_per_key(df, ["k"], change_order(spec(["first", "second"])))
    assert rows(newest, "k", "first", "second") == [(1, 20, 3), (2, 1, 0)]
    newest = latest_per_key(df, ["k"], change_order(spec([])))
    assert rows(newest, "k", "ingested_timestamp") == [(1, 3), (2, 9)]


def test_packed_dates_as_numbers_or_as_dates(spark):
    silver = {"primary_keys": ["k"], "incremental_columns": ["packed"]}
    spec = table_spec({"tables": {"t": {"bronze": {"source_table": "t"}, "silver": silver, "columns": []}}}, "t")
    df = spark.createDataFrame([(1, 311223, 0), (1, 10124, 0), (1, 0, 9)], "k int, packed int, ingested_timestamp int")
    assert latest_per_key(df, ["k"], change_order(spec)).first().packed == 311223
    assert latest_per_key(df, ["k"], change_order(spec, sequence_format="ddMMyy")).first().packed == 10124


@pytest.mark.parametrize("kind", ["map<string,int>", "struct<m:map<string,int>>"])
def test_unsortable_columns_are_carried(spark, kind):
    df = spark.createDataFrame([(1, 1)], "k int, seq int").withColumn("m", F.lit(None).cast(kind))
    assert latest_per_key(df, ["k"], [F.col("seq")]).count() == 1
