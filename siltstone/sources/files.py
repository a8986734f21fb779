"""Raw files: reader options, column discovery and typed scans.

Text formats are scanned as strings and typed afterwards, so a value that does
not fit its type can be kept beside the row and leading zeros survive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import qualified
from siltstone.session import settings
from siltstone.sources.conversion import RECORD

SOURCE_PATH = "__source_path"
FORMATS = ("csv", "json", "parquet")

# The option names a spec may use, with or without the prefix.
OPTION_PREFIX = "cloudFiles."
FORMAT_OPTION = "format"
INFER_OPTION = "inferColumnTypes"
EVOLUTION_OPTION = "schemaEvolutionMode"
HINTS_OPTION = "schemaHints"
RESCUED_OPTION = "rescuedDataColumn"
ADD_NEW_COLUMNS = "addNewColumns"
# Fixed value: what stands for null in a ``name=value`` folder.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Without added columns the first files fix them; "rescue" keeps misfits where a rescued column is named.
EVOLUTION_MODES = (None, "none", "rescue", ADD_NEW_COLUMNS)


@dataclass(frozen=True)
class FileOptions:
    """A spec's ``read_options``, sorted into what each part of the scan needs."""

    format: str = "csv"
    infer_types: bool = False
    add_columns: bool = False
    hints: str | None = None
    rescued_column: str | None = None
    reader: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_text(self) -> bool:
        return self.format != "parquet"

    @property
    def has_header(self) -> bool:
        return self.format == "csv" and str(self.reader.get("header", "false")).lower() == "true"


def file_options(read_options: Mapping[str, str]) -> FileOptions:
    options = {k.removeprefix(OPTION_PREFIX): v for k, v in read_options.items()}
    file_format = str(options.pop(FORMAT_OPTION, "csv")).lower()
    if file_format not in FORMATS:
        raise ValueError(f"unknown file format {file_format!r}; use one of {FORMATS}")
    mode = options.pop(EVOLUTION_OPTION, None)
    if mode not in EVOLUTION_MODES:
        raise ValueError(f"unknown schema evolution mode {mode!r}; use one of {EVOLUTION_MODES}")
    return FileOptions(
        format=file_format,
        infer_types=str(options.pop(INFER_OPTION, "false")).lower() == "true",
        add_columns=mode == ADD_NEW_COLUMNS,
        hints=options.pop(HINTS_OPTION, None) or None,
        rescued_column=options.pop(RESCUED_OPTION, None) or None,
        reader=options,
    )


def hinted_fields(hints: str | None) -> list[T.StructField]:
    """The columns of hints such as ``"`ID#` STRING, amount DOUBLE"``."""
    return list(T.StructType.fromDDL(hints).fields) if hints else []


def with_hints(schema: T.StructType, hints: str | None) -> T.StructType:
    """``schema`` with the hinted columns' types replaced, unknown hinted columns added."""
    wanted = {f.name.lower(): f for f in hinted_fields(hints)}
    fields = []
    for found in schema.fields:
        hint = wanted.pop(found.name.lower(), None)
        fields.append(T.StructField(found.name, hint.dataType) if hint else found)
    return T.StructType(fields + list(wanted.values()))


def literal(path: str) -> str:
    """``path`` as a reader's argument: readers take paths for patterns."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def named(paths: Sequence[str]) -> list[str]:
    return [literal(path) for path in paths]


def folder_columns(source: str, paths: Sequence[str]) -> list[str]:
    """Names of the ``name=value`` folders below ``source``, in order of depth."""
    root = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", source).rstrip("/")
    names: dict[str, str] = {}
    for path in paths:
        below = path.split(root, 1)[-1]
        for folder in below.split("/")[:-1]:
            name, found, _ = folder.partition("=")
            if found and name:
                names.setdefault(name.lower(), name)
    return [unquote(name) for name in names.values()]


def with_folders(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with the values of their ``name=value`` folders as text; a folder goes before a file's own column of its name."""
    taken = {n.lower() for n in names}
    own = {c.lower(): qualified(c) for c in rows.columns if c.lower() in taken}
    kept = [qualified(c) for c in rows.columns if c.lower() not in taken]

    def decoded(text: Column) -> Column:
        # A plus sign stands for itself in a path.
        return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)

    def value(name: str) -> Column:
        # The path is encoded as a URI, and special characters of a value within it once more.
        path, pattern = decoded(qualified(SOURCE_PATH)), f"(?is)^.*/{re.escape(name)}=([^/]*)/"
        found = F.regexp_extract(path, pattern, 1)
        mine = own.get(name.lower())
        elsewhere = F.lit(None).cast("string") if mine is None else mine.cast("string")
        return F.when(~path.rlike(pattern), elsewhere).when(found != NULL_FOLDER, decoded(found)).alias(name)

    return rows.select(*kept, *(value(name) for name in names)) if names else rows


def scan_files(
    spark: SparkSession, paths: Sequence[str], options: FileOptions, schema: T.StructType | None = None
) -> DataFrame | None:
    """All rows of the files, columns matched by name, plus the path they came from: one scan.

    ``schema`` spares looking for the columns of files without a header record.
    ``None`` if the files hold no column at all.
    """
    if options.has_header:
        return _scan_by_header(spark, paths, options)
    schema = schema or discovered_schema(spark, paths, options, infer_types=False)
    return _scan(spark, paths, options, schema, enforce=True) if schema.fields else None


def discovered_schema(
    spark: SparkSession, paths: Sequence[str], options: FileOptions, infer_types: bool
) -> T.StructType:
    """Columns of files that need not be alike.

    A CSV file costs its header record (or, without one, a pass over all files
    given), a parquet file its footer; JSON needs a pass over the files given.
    Only JSON has types of its own to infer here.
    """
    reader = spark.read.options(**options.reader)
    if options.has_header:
        names = all_names(header_names(spark, [h for h, _ in header_records(spark, paths, options.reader)], options.reader))
        return T.StructType([T.StructField(name, T.StringType()) for name in names])
    if options.format == "csv":
        return positional_schema(spark, paths, options)
    if options.format == "json":
        return reader.option("primitivesAsString", str(not infer_types).lower()).json(named(paths)).schema
    return reader.option("mergeSchema", "true").parquet(*named(paths)).schema


def positional_schema(spark: SparkSession, paths: Sequence[str], options: FileOptions) -> T.StructType:
    """Text columns ``_c0``, ``_c1``, ... as many as the longest record of all the files has values."""
    one = T.StructType().add("_c0", "string").add(RECORD, "string")
    rows = spark.read.options(**options.reader).option("columnNameOfCorruptRecord", RECORD).schema(one).csv(named(paths))
    # A record of one value is complete, so that its text is not kept.
    values = F.when(F.col(RECORD).isNotNull(), value_count(F.col(RECORD), options.reader)).when(F.col("_c0").isNotNull(), 1)
    width = rows.agg(F.max(values)).first()[0] or 0
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])


def value_count(record: Column, reader: Mapping[str, str]) -> Column:
    """How many values a CSV record holds: separators outside quotes, and one.

    A quote opens a value only at its start; doubled quotes stand for one only
    where the quote is its own escape.
    """
    separator = reader.get("sep", reader.get("delimiter", ",")).replace("\\t", "\t")
    quote, escape = reader.get("quote", '"'), reader.get("escape", "\\")
    if quote:
        q, e, cut = re.escape(quote), re.escape(escape), re.escape(separator)
        inside = f"(?:{q}{q}|[^{q}])*" if escape == quote else f"(?:{e}.|[^{q}{e}])*" if escape else f"[^{q}]*"
        record = F.regexp_replace(record, f"(?s)(^|{cut})[ \\t]*{q}{inside}{q}", "$1")
    shorter = F.length(record) - F.length(F.replace(record, F.lit(separator), F.lit("")))
    return (shorter / len(separator) + 1).cast("int")


def header_records(spark: SparkSession, paths: Sequence[str], reader: Mapping[str, str]) -> list[tuple[str, list[str]]]:
    """The text of every different header record and the files that have it; files without one are left out.

    The header is the first line that is neither blank nor a comment, with the
    lines after it that its quotes span if records may span lines.  Each task
    reads the first lines of one file.  Only paths reach the driver, which needs
    them anyway to name them in a scan.
    """
    comment, quote = reader.get("comment", ""), reader.get("quote", '"')
    spans_lines = str(reader.get("multiLine", "false")).lower() == "true"

    # Local, so that it travels by value and executors need not have this package.
    def header(batches: Iterator) -> Iterator:
        lines, path = [], None
        for batch in batches:
            for row in batch.to_pylist():
                skipped = not row["value"].strip() or comment and row["value"].startswith(comment)
                if lines or not skipped:
                    lines.append(row["value"])
                    path = row["path"]
                    if not (spans_lines and quote) or sum(line.count(quote) for line in lines) % 2 == 0:
                        break
            else:
                continue
            break
        if lines:
            yield batch.from_pylist([{"value": "\n".join(lines), "path": path}], schema=batch.schema)

    text_options = {k: v for k, v in reader.items() if k in ("encoding", "lineSep", "compression")}
    # A file must not be split here, nor share a task: its first lines are all that is read of it.
    one_file_per_task = str(1 << 40)
    peeking = {
        "spark.sql.files.maxPartitionBytes": one_file_per_task,
        "spark.sql.files.openCostInBytes": one_file_per_task,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    }
    with settings(spark, peeking):
        lines = spark.read.options(**text_options).text(named(paths))
        lines = lines.filter("_metadata.file_block_start = 0").select("value", F.col("_metadata.file_path").alias("path"))
        groups = lines.mapInArrow(header, lines.schema).groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths"))
        return [(row["value"], row["paths"]) for row in groups.orderBy("value").collect()]


def header_names(spark: SparkSession, records: Sequence[str], reader: Mapping[str, str]) -> list[list[str]]:
    """Column names of header records.  A column without a name is called by its place, a repeated name gets its place added."""
    if not records:
        return []
    width = max(_separators(r, reader) for r in records) + 1
    parsing = {k: v for k, v in reader.items() if k not in ("header", "multiLine", "mode", "encoding", "compression")}
    schema = ", ".join(f"_c{i} STRING" for i in range(width))
    texts = spark.createDataFrame(pa.table({"place": list(range(len(records))), "text": list(records)}))
    parsed = texts.select("place", F.from_csv("text", schema, parsing).alias("names"), value_count(F.col("text"), reader).alias("width"))
    found = []
    for row in sorted(parsed.collect(), key=lambda r: r["place"]):
        cells = list(row["names"] or [])[: row["width"]]
        lowered = [c.lower() for c in cells if c]
        found.append([
            f"_c{i}" if not c else f"{c}{i}" if lowered.count(c.lower()) > 1 else c for i, c in enumerate(cells)
        ])
    return found


def all_names(headers: Sequence[Sequence[str]]) -> list[str]:
    """Names of all headers, each once whatever its case, in order of appearance."""
    names: dict[str, str] = {}
    for header in headers:
        for name in header:
            names.setdefault(name.lower(), name)
    return list(names.values())


def _separators(text: str, reader: Mapping[str, str]) -> int:
    return text.count(reader.get("sep", reader.get("delimiter", ",")).replace("\\t", "\t"))


def _scan_by_header(spark: SparkSession, paths: Sequence[str], options: FileOptions) -> DataFrame | None:
    """Rows of CSV files of any number of different headers, in one scan.

    Values are read by their place; a table of the files' headers, joined by
    path, says at which place a file has each column.
    """
    records = header_records(spark, paths, options.reader)
    headers = header_names(spark, [text for text, _ in records], options.reader)
    names = all_names(headers)
    if not names:
        return None
    if len(headers) == 1:
        return _scan(spark, paths, options, T.StructType([T.StructField(n, T.StringType()) for n in names]), enforce=True)
    width = max(map(len, headers))
    schema = T.StructType([T.StructField(f"__v{i}", T.StringType()) for i in range(width)])
    rows = _scan(spark, paths, options, schema, enforce=True, fixed_width=False)
    places = []
    for header in headers:
        at = {name.lower(): i for i, name in enumerate(header)}
        places.append([at.get(name.lower()) for name in names])
    # A row per file of the batch, and one per different header.
    files = pa.table({
        SOURCE_PATH: [path for _, own in records for path in own],
        "__header": [k for k, (_, own) in enumerate(records) for _ in own],
    })
    layouts = pa.table({
        "__header": list(range(len(headers))), "__width": [len(h) for h in headers],
        "__places": pa.array(places, pa.list_(pa.int32())),
    })
    layout = spark.createDataFrame(files).join(spark.createDataFrame(layouts), "__header").drop("__header")
    values = F.array(*(qualified(f.name) for f in schema.fields)).alias("__values")
    kept = [RECORD] if RECORD in rows.columns else []
    rows = rows.select(values, *kept, SOURCE_PATH).join(layout, SOURCE_PATH)
    columns = [F.get("__values", F.get("__places", F.lit(j))).alias(name) for j, name in enumerate(names)]
    if kept:
        beyond = F.exists(F.slice("__values", F.col("__width") + 1, F.lit(width)), lambda v: v.isNotNull())
        # A record that fills the widest header exactly was not kept by the reader.
        parsing = {k: v for k, v in options.reader.items() if k in ("sep", "delimiter", "quote", "escape")}
        again = F.to_csv(F.struct(*(F.get("__values", F.lit(i)).alias(f"_{i}") for i in range(width))), parsing)
        filled = (F.col("__width") == width) & F.get("__values", F.lit(width - 1)).isNotNull() & F.col(RECORD).isNotNull()
        longer = beyond | filled | (value_count(F.col(RECORD), options.reader) > F.col("__width"))
        columns.append(F.when(longer, F.coalesce(RECORD, again)).alias(RECORD))
    return rows.select(*columns, SOURCE_PATH)


def read_files(spark: SparkSession, paths: Sequence[str], options: FileOptions, schema: T.StructType) -> DataFrame:
    """One scan of files that all have the columns of ``schema``, plus the path each row came from.

    A CSV file with another header fails the scan: its columns would be taken
    by position.
    """
    return _scan(spark, paths, options, schema, enforce=not options.has_header)


def _scan(
    spark: SparkSession,
    paths: Sequence[str],
    options: FileOptions,
    schema: T.StructType,
    enforce: bool,
    fixed_width: bool = True,
) -> DataFrame:
    """Rows and their path; with a rescued column also the text of CSV records with values beyond the last column.

    Without ``fixed_width`` that of every record with another number of values.
    """
    reader = spark.read.format(options.format).option("enforceSchema", str(enforce).lower()).options(**options.reader)
    keeps_records = options.format == "csv" and options.rescued_column is not None
    if keeps_records:
        schema = T.StructType(schema.fields + [T.StructField(RECORD, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", RECORD)
    rows = reader.schema(schema).load(named(paths))
    if keeps_records and fixed_width:
        # A record of another length that fills the last column is a longer one.
        *columns, _ = schema.fields
        filled = qualified(columns[-1].name).isNotNull()
        longer = filled | (value_count(F.col(RECORD), options.reader) > len(columns))
        rows = rows.withColumn(RECORD, F.when(longer, F.col(RECORD)))
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))


def stream_paths(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming scan of file names only, each once; no file is opened."""
    # All folders below, without taking their names for columns: the folders of a source need not be alike.
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path", "length")
