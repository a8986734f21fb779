from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from siltstone.operators.layout import write_clustered


def ranges(folder, column):
    """(min, max, rows) of each file's footer."""
    found = []
    for file in sorted(glob.glob(f"{folder}/*.parquet")):
        meta = pq.ParquetFile(file).metadata
        index = meta.schema.to_arrow_schema().names.index(column)
        groups = [meta.row_group(i).column(index).statistics for i in range(meta.num_row_groups)]
        found.append((min(g.min for g in groups), max(g.max for g in groups), meta.num_rows))
    return found


def test_files_cover_narrow_ranges(spark, tmp_path):
    df = spark.range(20000).select(F.hash("id").alias("h"), "id")
    write_clustered(df, f"{tmp_path}/t", ["h"], 4)
    files = sorted(ranges(f"{tmp_path}/t", "h"))
    assert len(files) == 4 and sum(n for *_, n in files) == 20000
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))


def test_a_value_held_by_most_rows_is_split(spark, tmp_path):
    df = spark.range(20000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id") % 10).alias("h"))
    write_clustered(df, f"{tmp_path}/t", ["h"], 4)
    sizes = [n for *_, n in ranges(f"{tmp_path}/t", "h")]
    assert sum(sizes) == 20000 and max(sizes) < 10000


def test_nulls_are_kept(spark, tmp_path):
    df = spark.range(100).select(F.when(F.col("id") % 2 > 0, F.col("id")).alias("h"))
    write_clustered(df, f"{tmp_path}/t", ["h"])
    assert spark.read.parquet(f"{tmp_path}/t").filter("h is null").count() == 50


def test_either_of_two_columns_skips_most_files(spark, tmp_path):
    df = spark.range(40000).select(F.hash("id").alias("a"), F.sha1(F.col("id").cast("string").cast("binary")).alias("b"), "id")
    write_clustered(df.withColumn("a", F.when(F.col("id") % 50 > 0, F.col("a"))), f"{tmp_path}/t", ["a", "b"], 64, lookup=["id"])
    for column, low, high in (("a", 0, 10**7), ("b", "40", "41")):
        files = ranges(f"{tmp_path}/t", column)
        hit = [f for f in files if f[0] is not None and f[0] <= high and f[1] >= low]
        assert len(files) == 64 and sum(n for *_, n in files) == 40000 and 0 < len(hit) < 24
    assert spark.read.parquet(f"{tmp_path}/t").filter("id = 77").count() == 1


def test_a_curve_over_few_values_and_no_rows(spark, tmp_path):
    df = spark.range(300).select((F.col("id") % 2).alias("a"), F.lit(None).cast("int").alias("b"), F.lit("x").alias("c"))
    write_clustered(df, f"{tmp_path}/t", ["a", "b", "c"], 2)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 300
    write_clustered(df.limit(0), f"{tmp_path}/e", ["a", "b"])
    assert spark.read.schema(df.schema).parquet(f"{tmp_path}/e").count() == 0
