from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from siltstone import table_spec
from siltstone.plans.medallion import TableFlow, run_table, table_flow
from tests.conftest import rows

# Part of an employee spec as its YAML file would load.
EMPLOYEE = {
    "tables": {
        "employee": {
            "bronze": {
                "source_table": "staff",
                "primary_keys": ["STAFF#"],
                "cluster_by_col": "CHANGED",
                "read_options": {
                    "cloudFiles.format": "csv",
                    "header": "true",
                    "delimiter": ",",
                    "cloudFiles.inferColumnTypes": "true",
                    "cloudFiles.schemaEvolutionMode": "addNewColumns",
                    "cloudFiles.schemaHints": "`STAFF#` STRING",
                },
            },
            "silver": {"primary_keys": ["STAFF"], "partition_columns": "CHANGED", "incremental_columns": ["CHANGED"]},
            "columns": [
                {"name": "STAFF", "source": "STAFF#", "type": "string", "cleansing": {"trim": True}},
                {"name": "GIVEN", "source": "GIVEN", "type": "string", "cleansing": {"trim": True}},
                {"name": "GRADE", "source": "GRADE", "type": "integer", "cleansing": {"trim": True}},
                {"name": "CHANGED", "source": "CHANGED", "type": "integer", "cleansing": {"trim": True}},
            ],
        }
    }
}


def put(folder, name, *lines):
    os.makedirs(f"{folder}/raw/staff", exist_ok=True)
    with open(f"{folder}/raw/staff/{name}", "w") as file:
        file.write("\n".join(lines) + "\n")


def test_files_to_silver_over_several_runs(spark, tmp_path):
    def run(at):
        return run_table(spark, EMPLOYEE, "employee", f"{tmp_path}/lake", base_path=f"{tmp_path}/raw", as_of=at, buckets=2)

    put(tmp_path, "1.csv", "STAFF#,GIVEN,GRADE,CHANGED", " 001 , Ann , 7 ,240101", "002,Bob,8,240101", ",none,1,240101")
    silver = run(datetime(2024, 1, 1))
    assert rows(silver, "STAFF", "GIVEN", "GRADE", "CHANGED") == [("001", "Ann", 7, 240101), ("002", "Bob", 8, 240101)]

    # Older state of one, newer of the other, a column more, in another order.
    put(tmp_path, "2.csv", "CHANGED,REMARK,STAFF#,GRADE,GIVEN", "231231,late,001,0,Old", "240102,ok,002,9,Rob")
    silver = run(datetime(2024, 1, 2))
    assert rows(silver, "STAFF", "GIVEN", "REMARK") == [("001", "Ann", None), ("002", "Rob", "ok")]

    # Equal sequence: the later load wins.
    put(tmp_path, "3.csv", "STAFF#,GIVEN,GRADE,CHANGED", "001,Anna,7,240101")
    silver = run(datetime(2024, 1, 3))
    assert rows(silver, "STAFF", "GIVEN") == [("001", "Anna"), ("002", "Rob")]
    assert rows(run(datetime(2024, 1, 4)), "STAFF", "GIVEN") == [("001", "Anna"), ("002", "Rob")]
    assert silver.filter(F.col("source_file").endswith("/raw/staff/3.csv")).count() == 1


def test_nothing_has_arrived_yet(spark, tmp_path):
    os.makedirs(f"{tmp_path}/raw/staff")
    run = lambda: run_table(spark, EMPLOYEE, "employee", f"{tmp_path}/lake", base_path=f"{tmp_path}/raw", buckets=2)
    assert run() is None
    put(tmp_path, "1.csv", "STAFF#,GIVEN,GRADE,CHANGED", "001,Ann,7,240101")
    assert rows(run(), "STAFF") == [("001",)]


def test_lost_checkpoint_reads_everything_again_with_the_same_result(spark, tmp_path):
    put(tmp_path, "1.csv", "STAFF#,GIVEN,GRADE,CHANGED", "001,Ann,7,240101", "001,Eve,7,240102")
    options = {"base_path": f"{tmp_path}/raw", "as_of": datetime(2024, 1, 1)}
    first = rows(run_table(spark, EMPLOYEE, "employee", f"{tmp_path}/lake", buckets=2, **options), "STAFF", "GIVEN")
    os.rename(f"{tmp_path}/lake/checkpoints", f"{tmp_path}/lake/lost")
    again = rows(run_table(spark, EMPLOYEE, "employee", f"{tmp_path}/lake", buckets=2, **options), "STAFF", "GIVEN")
    assert first == again == [("001", "Eve")]


def test_names_carry_the_source_type(spark):
    flow = table_flow(spark, EMPLOYEE, "employee", "/lake")
    assert (flow.bronze_name, flow.silver_name) == ("bronze_s3_staff", "silver_s3_employee")
    other = TableFlow("/lake/", table_spec(EMPLOYEE, "employee"), "jdbc")
    assert (other.bronze_path, other.silver_path) == ("/lake/bronze_jdbc_staff", "/lake/silver_jdbc_employee")
