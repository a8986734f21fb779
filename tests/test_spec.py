from __future__ import annotations

import pytest

from siltstone import table_spec
from siltstone.spec import column_spec

COLUMNS = [
    {"name": "KEY", "source": "KEY#", "type": "string", "cleansing": {"trim": True}},
    {"name": "SEQ", "source": "SEQ", "type": "integer"},
]
CURRENT = {
    "tables": {
        "person": {
            "bronze": {"source_table": "rawp", "cluster_by_col": "SEQ", "read_options": {"header": "true"}},
            "silver": {"primary_keys": ["KEY"], "partition_columns": "SEQ", "incremental_columns": ["SEQ"]},
            "columns": COLUMNS,
        }
    }
}
LEGACY = {
    "catalog": "c",
    "tables": {
        "person": {
            "bronze": {
                "source_table": "rawp",
                "source_type": "s3",
                "cluster_by_col": "SEQ",
                "s3": {"s3_path": "s3://bucket/raw/rawp/", "read_options": {"header": "true"}},
            },
            "silver": {"primary_keys": ["KEY"], "partition_columns": ["SEQ"], "incremental_columns": []},
            "columns": COLUMNS,
        }
    },
}


def test_current_and_legacy_layouts_agree():
    current, legacy = table_spec(CURRENT, "person"), table_spec(LEGACY, "person")
    for part in ("source_table", "columns", "primary_keys", "bronze_cluster_by", "silver_cluster_by", "read_options"):
        assert getattr(current, part) == getattr(legacy, part)
    assert current.incremental_columns == ("SEQ",) and legacy.incremental_columns == ()
    assert legacy.source_type == "s3" and legacy.source_path == "s3://bucket/raw/rawp/"


def test_missing_table_names_the_known_ones():
    with pytest.raises(KeyError, match="person"):
        table_spec(CURRENT, "invoice")


def test_empty_key_is_refused():
    broken = {"tables": {"person": CURRENT["tables"]["person"] | {"silver": {"primary_keys": []}}}}
    with pytest.raises(ValueError, match="primary_keys"):
        table_spec(broken, "person")


@pytest.mark.parametrize("key", ["trim", "null_markers", "date_format"])
def test_misplaced_column_keys_are_refused(key):
    with pytest.raises(ValueError, match=key):
        column_spec({"name": "A", "type": "string", key: "x"})


def test_source_defaults_to_name():
    assert column_spec({"name": "A", "type": "string"}).source == "A"
