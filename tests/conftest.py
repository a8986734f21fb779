from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from siltstone.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted so that nulls come first."""
    found = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is not None, str(v)) for v in r])


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
