"""Table specs: the nested dict a YAML file holds, read into typed records.

Two layouts are accepted.  The current one keeps only what describes the data
(``bronze.read_options``); the legacy one also names the source
(``bronze.source_type`` plus ``bronze.<source_type>.read_options``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class ColumnSpec:
    """One silver column: where it comes from and how it is cleansed and typed."""

    name: str
    source: str
    type: str
    format: str | None = None
    trim: bool = False
    null_markers: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    name: str
    source_table: str
    columns: tuple[ColumnSpec, ...]
    primary_keys: tuple[str, ...]
    incremental_columns: tuple[str, ...] = ()
    bronze_cluster_by: tuple[str, ...] = ()
    silver_cluster_by: tuple[str, ...] = ()
    read_options: Mapping[str, str] = field(default_factory=dict)
    source_type: str | None = None
    source_path: str | None = None
    jdbc: Mapping[str, Any] | None = None


# Keys found at column level in older hand-written specs.  Nothing reads them
# there, so they are refused instead of being ignored without a word.
_MISPLACED = {"trim": "cleansing.trim", "null_markers": "cleansing.null_markers", "date_format": "format"}


def column_spec(raw: Mapping[str, Any]) -> ColumnSpec:
    for key, place in _MISPLACED.items():
        if key in raw:
            raise ValueError(f"column {raw.get('name')!r}: move {key!r} to {place!r}")
    cleansing = raw.get("cleansing") or {}
    return ColumnSpec(
        name=raw["name"],
        source=raw.get("source") or raw["name"],
        type=raw["type"],
        format=raw.get("format"),
        trim=bool(cleansing.get("trim")),
        null_markers=tuple(str(m) for m in cleansing.get("null_markers") or () if m is not None),
    )


def table_spec(config: Mapping[str, Any], table: str) -> TableSpec:
    """Read ``config["tables"][table]``; both layouts give the same record."""
    try:
        raw = config["tables"][table]
    except KeyError:
        raise KeyError(f"no table {table!r} in the spec; it has {sorted(config.get('tables', {}))}") from None
    bronze, silver = raw["bronze"], raw["silver"]
    keys = _names(silver["primary_keys"])
    if not keys:
        raise ValueError(f"table {table!r}: silver.primary_keys is empty, but the upsert needs a key")
    files, jdbc = bronze.get("s3") or {}, bronze.get("jdbc") or {}
    return TableSpec(
        name=table,
        source_table=bronze["source_table"],
        columns=tuple(column_spec(c) for c in raw["columns"]),
        primary_keys=keys,
        incremental_columns=_names(silver.get("incremental_columns")),
        bronze_cluster_by=_names(bronze.get("cluster_by_col")),
        silver_cluster_by=_names(silver.get("partition_columns")),
        read_options=bronze.get("read_options") or files.get("read_options") or {},
        source_type=bronze.get("source_type"),
        source_path=files.get("s3_path"),
        jdbc=jdbc.get("read_options"),
    )


def _names(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)

