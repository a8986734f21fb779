from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.operators.silver import (
    drop_violations,
    key_rules,
    observe_rules,
    rule_metrics,
    silver_transform,
)
from siltstone.spec import ColumnSpec
from tests.conftest import plan, rows


def col(name, kind="string", source=None, **rest):
    return ColumnSpec(name, source or name, kind, **rest)


def text(spark, *values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_trim_takes_spaces_only_and_makes_text(spark):
    out = silver_transform(text(spark, "  a b ", "\ta ", "   ", None), [col("v", trim=True)])
    assert [r.v for r in out.collect()] == ["a b", "\ta", "", None]
    numbers = spark.createDataFrame([(7,)], "v long")
    assert silver_transform(numbers, [col("v", "untyped", trim=True)]).dtypes == [("v", "string")]


def test_markers_apply_after_trim_and_before_cast(spark):
    spec = col("v", "integer", trim=True, null_markers=("", "-", "null"))
    out = silver_transform(text(spark, " 7 ", " - ", "  ", "null", None), [spec])
    assert [r.v for r in out.collect()] == [7, None, None, None, None]


def test_markers_on_an_untrimmed_number(spark):
    out = silver_transform(spark.createDataFrame([(7,), (0,)], "v int"), [col("v", "long", null_markers=("0", "-"))])
    assert [r.v for r in out.collect()] == [7, None]


def test_blank_key_without_marker_passes_the_rule(spark):
    out = silver_transform(text(spark, "  ", None), [col("v", trim=True)])
    assert rows(drop_violations(out, key_rules(["v"]))) == [("",)]


@pytest.mark.parametrize("bad", ["", "abc", "7.9", "10.0", "3000000000"])
def test_strict_cast_fails_and_lenient_blanks(spark, bad):
    with pytest.raises(PySparkException):
        silver_transform(text(spark, bad), [col("v", "integer")]).collect()
    assert silver_transform(text(spark, bad), [col("v", "integer")], on_error="null").first().v is None


def test_strict_date_fails_and_lenient_blanks(spark):
    day, moment = col("v", "date", format="yyyyMMdd"), col("v", "timestamp", format="yyyyMMdd HHmm")
    assert silver_transform(text(spark, "20240229"), [day]).first().v == date(2024, 2, 29)
    assert silver_transform(text(spark, "20240229 0130"), [moment]).first().v == datetime(2024, 2, 29, 1, 30)
    for spec in (day, moment):
        with pytest.raises(PySparkException):
            silver_transform(text(spark, "20249999"), [spec]).collect()
        assert silver_transform(text(spark, "20249999"), [spec], on_error="null").first().v is None


def test_unknown_type_is_left_alone(spark):
    out = silver_transform(text(spark, "1.5"), [col("v", "decimal(10,2)")])
    assert out.dtypes == [("v", "string")]


def test_rename_missing_source_and_pass_through(spark):
    df = spark.createDataFrame([("1", "x", True)], "`ID#` string, other string, flag boolean")
    out = silver_transform(df, [col("ID", "integer", source="ID#"), col("gone", "string", source="GONE#")])
    assert out.dtypes == [("ID", "int"), ("other", "string"), ("flag", "boolean")]


def test_names_match_without_case_and_take_the_spec_spelling(spark):
    df = spark.createDataFrame([("1", "2")], "`code#` string, Amount string")
    out = silver_transform(df, [col("CODE", "string", source="CODE#"), col("AMOUNT", "integer")])
    assert out.dtypes == [("CODE", "string"), ("AMOUNT", "int")]


def test_already_renamed_column_is_still_typed(spark):
    out = silver_transform(spark.createDataFrame([("1",)], "ID string"), [col("ID", "integer", source="ID#")])
    assert out.dtypes == [("ID", "int")]


def test_clashing_outputs_are_refused(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    with pytest.raises(ValueError, match="b"):
        silver_transform(df, [col("b", source="a")])


def test_swapped_names_do_not_collide(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    out = silver_transform(df, [col("b", source="a"), col("a", source="b")])
    assert out.columns == ["b", "a"] and out.first() == ("1", "2")


def test_odd_names(spark):
    df = spark.createDataFrame([("1", None), ("2", "x")], "`a.b` string, `c``d` string")
    out = silver_transform(df, [col("a.b", "integer"), col("c`d")])
    assert drop_violations(out, key_rules(["c`d", "a.b"])).count() == 1


def test_wide_spec_is_one_projection(spark):
    names = [f"C{i:02d}" for i in range(83)]
    df = spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"`{n}#` string" for n in names))
    spec = [col(n, "integer" if i % 3 else "string", source=f"{n}#", trim=True) for i, n in enumerate(names)]
    out = silver_transform(df, spec)
    assert len(out.columns) == 83 and out.columns[-1] == "C82"
    analysed = out._jdf.queryExecution().analyzed().toString()
    assert analysed.count("Project") == 1


def test_rule_counts_agree_with_the_rows_kept(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y"), (None, None)], "a int, b string")
    rules = key_rules(["a", "b"])
    assert rows(rule_metrics(df, rules)) == [("valid_a", 2, 2), ("valid_b", 2, 2)]
    observed, seen = observe_rules(df, rules)
    assert drop_violations(observed, rules).count() == 1
    assert seen.get == {"valid_a_passed": 2, "valid_a_dropped": 2, "valid_b_passed": 2, "valid_b_dropped": 2}


def test_key_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumn("x", F.col("id") * 2).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text_plan = plan(drop_violations(silver_transform(df, [col("id", "long")]), key_rules(["id"])).select("id"))
    assert "PushedFilters: [IsNotNull(id)]" in text_plan
    assert "ReadSchema: struct<id:bigint>" in text_plan
