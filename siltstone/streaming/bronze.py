"""Incremental ingest of raw files into a bronze table.

A bronze table is a folder of parquet files plus small logs kept beside them and
hidden from scans: its columns in ``_columns``, so that nobody has to merge the
footers of every file to learn them, and in ``_found`` what has been seen in the
raw files where columns or types have to be found before the first row is stored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import qualified
from siltstone.operators.log import append_log, newest_row
from siltstone.operators.loads import replace_table
from siltstone.sources.audit import AUDIT_COLUMNS, with_audit
from siltstone.sources.conversion import NESTED, RECORD, as_text, typed, widened
from siltstone.sources.files import (
    SOURCE_PATH,
    FileOptions,
    discovered_schema,
    folder_columns,
    hinted_fields,
    read_files,
    scan_files,
    stream_paths,
    with_folders,
    with_hints,
)
from siltstone.sources.inference import Counts, counted_types, merged_counts, merged_schema, type_of

# Holds what a conversion would lose, unless the spec names another column.
DEFAULT_RESCUED = "_rescued_data"
# Marks a column whose values are taken from folders.
FOLDER = "folder"
# Paths named on the driver per batch; more files simply take more batches.
MAX_FILES = 10_000


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    options: FileOptions,
    as_strings: Iterable[str] = (),
    cluster_by: str | Iterable[str] = (),
    max_files: int | None = None,
    as_of: datetime | None = None,
) -> None:
    """Append the files that are new since the last call, then return.

    ``as_strings`` lists columns that a later step types itself: they are kept
    as text whatever would be inferred for them.  Files with fixed columns and
    files that may add some are written alike, so a table may change its mode.
    The values of ``name=value`` folders below ``source`` become columns.
    """
    as_strings = tuple(as_strings)

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = _paths(batch)
        if not paths:
            return
        known = bronze_columns(session, target)
        folders = _folders(source, paths, known)
        found = _found(session, target) if looks else NOTHING
        rows, unseen = _batch_rows(session, paths, folders, options, known, found, as_strings)
        if rows is None:
            return
        names = T.StructType([f for f in rows.schema.fields if f.name not in (SOURCE_PATH, RECORD, *unseen)])
        if options.format == "json" and options.add_columns:
            names = _with_mixed(rows, names, _settled(options, as_strings, known))
        wanted = _wanted(options, names, as_strings, known, found)
        bronze = _sorted_by(_bronze_rows(rows, wanted, options, as_of, unseen), cluster_by)
        # One folder per batch of one checkpoint: a repeated batch replaces its own rows.
        bronze.write.mode("overwrite").parquet(f"{target}/{query_id(session)}/{batch_id:010d}")
        _log_columns(session, target, known, bronze.schema, folders)

    def look(batch: DataFrame, _: int) -> None:
        paths = _paths(batch)
        if paths:
            _look_into(batch.sparkSession, source, target, paths, options, as_strings)

    looks = _looks_first(spark, target, options)
    if looks:
        _each_once(spark, source, f"{checkpoint}_found", look, max_files)
    _each_once(spark, source, checkpoint, append, max_files)


def _each_once(spark: SparkSession, source: str, checkpoint: str, use: Callable, max_files: int | None) -> None:
    """Give ``use`` the names of the files that it has not been given before, batch by batch."""
    query = stream_paths(spark, source, max_files or MAX_FILES).writeStream.foreachBatch(use)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _paths(batch: DataFrame) -> list[str]:
    # The source of names takes a name for a pattern too, and then gives what it matches once more.
    return sorted({row["path"] for row in batch.filter("length > 0").select("path").collect()})


def _looks_first(spark: SparkSession, target: str, options: FileOptions) -> bool:
    """Whether the files have to be looked into before any is stored.

    Types are inferred from all that waits, and so are fixed columns that no
    header record names, however it is cut into batches.
    """
    if options.infer_types and options.is_text:
        return True
    return not options.add_columns and not options.has_header and bronze_columns(spark, target) is None


def _look_into(spark, source: str, target: str, paths: list[str], options: FileOptions, as_strings) -> None:
    """Merge what these files hold into what has been found so far."""
    seen, counts = before = _found(spark, target)
    settled = {f.name.lower() for f in _settled(options, as_strings, bronze_columns(spark, target))}
    infers = options.infer_types and options.is_text
    shape = T.StructType() if options.has_header else discovered_schema(spark, paths, options, infers)
    if infers and options.format == "csv":
        folders = folder_columns(source, paths)
        rows = scan_files(spark, paths, options, shape)
        if rows is not None:
            rows = with_folders(rows, folders)
            open_columns = [c for c in rows.columns if c not in (SOURCE_PATH, RECORD) and c.lower() not in settled]
            counts = merged_counts(counts, counted_types(rows, open_columns))
    seen = merged_schema(seen, shape)
    if (seen, counts) == before:
        return
    state = {"columns": seen.json(), "counts": counts}
    append_log(spark, f"{target}/_found", {"state": (pa.string(), [json.dumps(state)])})


NOTHING: tuple[T.StructType, Counts] = (T.StructType(), {})


def _found(spark: SparkSession, target: str) -> tuple[T.StructType, Counts]:
    """Columns found in files without a header record, and what fits which type."""
    row = newest_row(spark, f"{target}/_found", "number bigint, state string")
    if row is None:
        return NOTHING
    state = json.loads(row["state"])
    return T.StructType.fromJson(json.loads(state["columns"])), state["counts"]


def _batch_rows(spark, paths, folders, options: FileOptions, known, found, as_strings):
    """Rows of a batch of files, and the names of fields that no column is kept for."""
    if options.add_columns:
        shape = None
        if options.format == "json":
            seen = found[0] if options.infer_types else discovered_schema(spark, paths, options, infer_types=False)
            shape = _json_shape(seen, _settled(options, as_strings, known))
        rows, unseen = scan_files(spark, paths, options, shape), []
    else:
        rows, unseen = _fixed_rows(spark, paths, folders, options, known, found, as_strings)
    return (None if rows is None else with_folders(rows, folders)), unseen


def _with_mixed(rows: DataFrame, names: T.StructType, settled: list[T.StructField]) -> T.StructType:
    """``names`` with the fields of documents that stand beside plain values in one column.

    Such a column is read as text, which shows no fields; where the table has it
    as a document, one aggregate finds the fields of all there are.
    """
    nested = {f.name.lower() for f in settled if isinstance(f.dataType, NESTED)}
    mixed = [f.name for f in names.fields if isinstance(f.dataType, T.StringType) and f.name.lower() in nested]
    if not mixed:
        return names
    found = rows.agg(*(F.schema_of_variant_agg(_document(qualified(c))).alias(c) for c in mixed)).first().asDict()
    fields = []
    for f in names.fields:
        kind = re.sub(r"\bOBJECT<", "STRUCT<", found.get(f.name) or "")
        is_document = kind.startswith(("STRUCT<", "ARRAY<")) and not re.search("<>|VARIANT", kind)
        fields.append(T.StructField(f.name, as_text(T.DataType.fromDDL(kind)) if is_document else f.dataType))
    return T.StructType(fields)


def _document(text: Column) -> Column:
    return F.when(F.trim(text).rlike(r"^[\[{]"), F.try_parse_json(text))


def _json_shape(found: T.StructType, settled: list[T.StructField]) -> T.StructType:
    """How to read documents: plain values as text, and whole ones as text where a column is text."""
    texts = {f.name.lower() for f in settled if isinstance(f.dataType, T.StringType)}
    return T.StructType([
        T.StructField(f.name, T.StringType() if f.name.lower() in texts else as_text(f.dataType)) for f in found.fields
    ])


def _fixed_rows(spark, paths, folders, options: FileOptions, known, found, as_strings):
    """Rows of files that have the columns of the first ones, and the names of fields beyond those.

    Everything that waits for the first batch fixes the columns, whatever is cut
    into that batch; later they are those that the table has.  Fields beyond
    them are looked for, by a pass over the new files, only if there is a
    rescued column to keep them.
    """
    if known is not None:
        names = _raw_columns(known, options)
    elif options.has_header:
        names = discovered_schema(spark, paths[:1], options, infer_types=False)
    else:
        names = found[0]
    if known is not None and options.has_header:
        # A hinted column, or one of a folder, need not be in the files; any other difference of a header fails the scan.
        header = {f.name.lower() for f in discovered_schema(spark, paths, options, infer_types=False).fields}
        absent = {name.lower() for name in (*(f.name for f in hinted_fields(options.hints)), *folders)} - header
        names = T.StructType([f for f in names.fields if f.name.lower() not in absent])
    if options.format == "json":
        names = _json_shape(names, _settled(options, as_strings, known))
    if not names.fields:
        return None, []
    unseen = []
    if options.rescued_column and options.format != "csv":
        settled = {f.name.lower() for f in names.fields}
        present = discovered_schema(spark, paths, options, infer_types=False)
        unseen = [f for f in present.fields if f.name.lower() not in settled]
        if options.format == "json":
            # Nested fields beyond the known ones are read as well, to be rescued.
            names = T.StructType([
                T.StructField(f.name, widened(f.dataType, _field(present, f.name))) if isinstance(f.dataType, NESTED) else f
                for f in names.fields
            ])
    return read_files(spark, paths, options, T.StructType(names.fields + unseen)), [f.name for f in unseen]


def _field(schema: T.StructType, name: str) -> T.DataType:
    return next((f.dataType for f in schema.fields if f.name.lower() == name.lower()), T.NullType())


def query_id(spark: SparkSession) -> str:
    """Identity of the running streaming query; it lives as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _settled(options: FileOptions, as_strings: Iterable[str], known: T.StructType | None) -> list[T.StructField]:
    """Columns whose type is not for inference: those the table has, then hinted ones, then those that stay text."""
    settled = {f.name.lower(): f for f in hinted_fields(options.hints)}
    if options.is_text:
        settled |= {name.lower(): T.StructField(name, T.StringType()) for name in as_strings if name.lower() not in settled}
    settled |= {f.name.lower(): f for f in known.fields} if known else {}
    return list(settled.values())


def _wanted(options: FileOptions, names: T.StructType, as_strings, known, found: tuple[T.StructType, Counts]) -> T.StructType:
    """Types to store: those the table already has, then hints, then inferred or as found.

    A nested column of the table takes in fields that are new, where columns may be added.
    """
    settled = {f.name.lower(): f.dataType for f in _settled(options, as_strings, known)}
    seen, counts = found
    fields = []
    for f in with_hints(names, options.hints).fields:
        kind = settled.get(f.name.lower())
        if kind is None and f.name.lower() in counts:
            kind = type_of(counts[f.name.lower()])
        elif kind is None and options.infer_types and options.is_text:
            kind = _field(seen, f.name)
            kind = f.dataType if isinstance(kind, T.NullType) else kind
        elif kind is not None and options.add_columns:
            kind = widened(kind, _field(names, f.name))
        fields.append(T.StructField(f.name, f.dataType if kind is None else kind))
    return T.StructType(fields)


def _folders(source: str, paths: list[str], known: T.StructType | None) -> list[str]:
    """Columns that folders hold: those of the table and those of these files."""
    names = [f.name for f in known.fields if f.metadata.get(FOLDER)] if known else []
    seen = {name.lower() for name in names}
    return names + [name for name in folder_columns(source, paths) if name.lower() not in seen]


def _raw_columns(known: T.StructType, options: FileOptions) -> T.StructType:
    """What the scan of a known table's files yields: its columns without those that ingest adds."""
    added = {*AUDIT_COLUMNS, options.rescued_column or DEFAULT_RESCUED}
    fields = [f for f in known.fields if f.name not in added]
    if options.format == "csv" and not options.has_header:
        fields = [f for f in fields if not f.metadata.get(FOLDER)]  # the others are taken by their place
    return T.StructType([T.StructField(f.name, as_text(f.dataType) if options.is_text else f.dataType) for f in fields])


def _bronze_rows(rows: DataFrame, wanted: T.StructType, options: FileOptions, as_of, unseen=()) -> DataFrame:
    found = {f.name.lower(): f.dataType for f in rows.schema.fields}
    converts = any(found.get(f.name.lower(), f.dataType) != f.dataType for f in wanted.fields)
    rescued = options.rescued_column or (DEFAULT_RESCUED if converts else None)
    rows = typed(rows, wanted, rescued, unseen)
    return with_audit(rows, qualified(SOURCE_PATH), as_of).drop(SOURCE_PATH)


def bronze_columns(spark: SparkSession, target: str) -> T.StructType | None:
    """The columns of a bronze table, or ``None`` if it does not exist yet."""
    newest = newest_row(spark, f"{target}/_columns", "number bigint, columns string")
    return T.StructType.fromJson(json.loads(newest["columns"])) if newest else None


def _log_columns(spark: SparkSession, target: str, known: T.StructType | None, new: T.StructType, folders: Iterable[str]) -> None:
    """Add the columns, and the nested fields, of ``new`` that the table lacks."""
    marked = {name.lower(): {FOLDER: True} for name in folders}
    new = T.StructType([T.StructField(f.name, f.dataType, metadata=marked.get(f.name.lower(), {})) for f in new.fields])
    columns = widened(known or T.StructType(), new)
    if columns != known:
        append_log(spark, f"{target}/_columns", {"columns": (pa.string(), [columns.json()])})


def read_bronze(spark: SparkSession, target: str) -> DataFrame | None:
    """All rows, a column that older files lack being null there; ``None`` if nothing has arrived yet."""
    schema = bronze_columns(spark, target)
    if schema is None:
        return None
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)


def stream_bronze(spark: SparkSession, target: str, max_files: int | None = None) -> DataFrame | None:
    """Streaming scan of a bronze table with the columns it has now; ``None`` if nothing has arrived yet."""
    schema = bronze_columns(spark, target)
    if schema is None:
        return None
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(target)


def overwrite_bronze(df: DataFrame, target: str, cluster_by: str | Iterable[str] = ()) -> None:
    """Replace a bronze table by a batch read (JDBC); readers see the old rows until the new ones are all there."""
    replace_table(_sorted_by(df, cluster_by), target)


def _sorted_by(df: DataFrame, columns: str | Iterable[str]) -> DataFrame:
    """Rows sorted within each file, so that row groups can be skipped.

    Ranging them over files too would read the source twice, once to sample it;
    ``operators.layout`` does that for a table that is already stored.
    """
    present = [c for c in ([columns] if isinstance(columns, str) else columns) if c in df.columns]
    return df.sortWithinPartitions(*map(qualified, present)) if present else df
