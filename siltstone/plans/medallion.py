"""The whole bronze-to-silver flow of one table, for any table spec."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.latest import change_order
from siltstone.operators.layout import clustered
from siltstone.operators.loads import read_table, replace_table
from siltstone.operators.merge import scd1_upsert
from siltstone.operators.silver import key_rules, silver_transform
from siltstone.operators.snapshot import KeyedSnapshot
from siltstone.sources.audit import with_audit
from siltstone.sources.files import file_options
from siltstone.sources.jdbc import declared_jdbc_options, scan_jdbc
from siltstone.sources.scan import JDBC, source_path_of, source_type_of
from siltstone.spec import TableSpec, table_spec
from siltstone.streaming.bronze import ingest_files, overwrite_bronze, read_bronze, stream_bronze
from siltstone.streaming.scd1 import stream_scd1


@dataclass(frozen=True)
class TableFlow:
    """Names and folders of one table below ``root``.

    The source type is part of both names, so files and database loads of the
    same table never mix.
    """

    root: str
    spec: TableSpec
    source_type: str

    @property
    def bronze_name(self) -> str:
        return f"bronze_{self.source_type}_{self.spec.source_table}"

    @property
    def silver_name(self) -> str:
        return f"silver_{self.source_type}_{self.spec.name}"

    @property
    def bronze_path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.bronze_name}"

    @property
    def silver_path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.silver_name}"

    @property
    def clustered_path(self) -> str:
        return f"{self.silver_path}_clustered"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"


def table_flow(
    spark: SparkSession, config: Mapping[str, Any], table: str, root: str, source_type: str | None = None
) -> TableFlow:
    """The flow of ``table``; the source type is the argument, the spec's or the session's."""
    spec = table_spec(config, table)
    return TableFlow(root, spec, source_type_of(spark, spec, source_type))


def ingest_table(
    spark: SparkSession,
    flow: TableFlow,
    base_path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    as_of: datetime | None = None,
    max_files: int | None = None,
    credentials: tuple[str, str] | None = None,
) -> None:
    """Bring bronze up to date from either kind of source.

    Files: only those not seen before are read and appended.  Database: the
    table is read whole and replaces its bronze table; without reader options
    in ``jdbc`` the spec or the session describes it, and ``credentials`` are
    user and password.  Columns that the spec lists stay text until silver types
    them.
    """
    spec = flow.spec
    if flow.source_type == JDBC:
        if jdbc is None and credentials is not None:
            jdbc = declared_jdbc_options(spark, spec, *credentials)
        if jdbc is None:
            raise ValueError("a JDBC source needs reader options, or credentials and a described database (see sources.jdbc)")
        rows = with_audit(scan_jdbc(spark, jdbc), spec.source_table, as_of)
        overwrite_bronze(rows, flow.bronze_path, spec.bronze_cluster_by)
    else:
        ingest_files(
            spark,
            source_path_of(spark, spec, base_path),
            flow.bronze_path,
            flow.checkpoint(flow.bronze_name),
            file_options(spec.read_options),
            as_strings=[c.source for c in spec.columns],
            cluster_by=spec.bronze_cluster_by,
            max_files=max_files,
            as_of=as_of,
        )


def load_silver(
    spark: SparkSession,
    flow: TableFlow,
    on_error: str = "fail",
    tie_break: Sequence[str] | None = None,
    sequence_format: str | None = None,
    buckets: int | None = None,
    on_rule_counts: Callable[[dict[str, int]], None] | None = None,
    count_rules: bool = False,
) -> DataFrame | None:
    """Fold bronze into silver, one current row per key, and return the silver rows if there are any.

    Rows from files are folded in as a stream, each once; a database table is
    folded in whole, since its bronze table is replaced by every read.  Rows
    without a whole key are dropped; ``on_rule_counts`` is called for every batch
    with ``valid_<key>_passed`` and ``valid_<key>_dropped``.  ``count_rules`` adds
    them up over all batches and runs, see ``rule_totals`` (without either the
    rule can be applied in the scan).
    """
    spec = flow.spec
    order = change_order(spec, sequence_format=sequence_format)
    silver = KeyedSnapshot(spark, flow.silver_path, spec.primary_keys, buckets)
    sort_by = spec.silver_cluster_by
    options = {"rules": key_rules(spec.primary_keys), "on_counts": on_rule_counts, "count_rules": count_rules}
    options |= {"tie_break": tie_break, "sort_by": sort_by}
    if flow.source_type == JDBC:
        rows = silver_transform(bronze_rows(spark, flow), spec.columns, on_error)
        scd1_upsert(silver, rows, order, **options)
    else:
        bronze = stream_bronze(spark, flow.bronze_path)
        if bronze is None:
            return silver.read()
        rows = silver_transform(bronze, spec.columns, on_error)
        checkpoint = flow.checkpoint(flow.silver_name)
        stream_scd1(rows, flow.silver_path, spec.primary_keys, order, checkpoint, buckets=buckets, **options)
    return silver.read()


def rule_totals(spark: SparkSession, flow: TableFlow) -> dict[str, int]:
    """How many rows have passed and broken each key rule since counting began, whatever batches they came in."""
    return KeyedSnapshot(spark, flow.silver_path, flow.spec.primary_keys).counts()


def cluster_silver(spark: SparkSession, flow: TableFlow, partitions: int | None = None) -> DataFrame | None:
    """A copy of the silver rows whose files are ranged by the spec's columns, for readers that filter by any of them.

    Silver itself is bucketed by key, so that each of its files spans all values
    of those columns.  The copy replaces the one before.
    """
    columns, silver = flow.spec.silver_cluster_by, KeyedSnapshot(spark, flow.silver_path, flow.spec.primary_keys).read()
    if not columns:
        raise ValueError(f"the spec of {flow.spec.name!r} names no column to range silver by")
    if silver is None:
        return None
    replace_table(clustered(silver, columns, partitions), flow.clustered_path)
    return read_table(spark, flow.clustered_path)


def run_table(
    spark: SparkSession,
    config: Mapping[str, Any],
    table: str,
    root: str,
    source_type: str | None = None,
    base_path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    as_of: datetime | None = None,
    max_files: int | None = None,
    credentials: tuple[str, str] | None = None,
    **silver_options,
) -> DataFrame | None:
    """Bring bronze and silver of ``table`` up to date and return the silver rows."""
    flow = table_flow(spark, config, table, root, source_type)
    ingest_table(spark, flow, base_path, jdbc, as_of, max_files, credentials)
    return load_silver(spark, flow, **silver_options)


def bronze_rows(spark: SparkSession, flow: TableFlow) -> DataFrame | None:
    """The bronze table of a flow; ``None`` if nothing has arrived yet."""
    if flow.source_type == JDBC:
        return read_table(spark, flow.bronze_path)
    return read_bronze(spark, flow.bronze_path)
