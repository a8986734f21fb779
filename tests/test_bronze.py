from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from siltstone.sources.audit import with_audit
from siltstone.sources.conversion import typed
from siltstone.sources.files import file_options, header_records, scan_files, with_hints
from siltstone.sources.inference import counted_types, merged_counts, type_of
from siltstone.streaming.bronze import ingest_files, read_bronze, stream_bronze
from tests.conftest import plan, rows

CSV = {"cloudFiles.format": "csv", "header": "true"}
ADD = {"cloudFiles.schemaEvolutionMode": "addNewColumns"}
EVOLVING = CSV | ADD
INFERRED = EVOLVING | {"cloudFiles.inferColumnTypes": "true"}
AT = datetime(2024, 2, 1)


class Lake:
    """A raw folder, its bronze table and checkpoint."""

    def __init__(self, spark, folder, read_options, **rest):
        self.spark, self.folder, self.options, self.rest = spark, folder, file_options(read_options), rest
        os.makedirs(f"{folder}/raw")

    def put(self, name, *lines):
        with open(f"{self.folder}/raw/{name}", "w") as file:
            file.write("\n".join(lines) + "\n" if lines else "")

    def ingest(self, checkpoint="checkpoint"):
        ingest_files(
            self.spark, f"{self.folder}/raw", self.target, f"{self.folder}/{checkpoint}", self.options, as_of=AT, **self.rest
        )
        return read_bronze(self.spark, self.target)

    @property
    def target(self):
        return f"{self.folder}/bronze"


@pytest.fixture
def lake(spark, tmp_path):
    return lambda read_options, **rest: Lake(spark, str(tmp_path), read_options, **rest)


def test_options_with_and_without_prefix():
    prefixed = {"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true", "cloudFiles.schemaHints": "a INT"}
    plain = {"format": "json", "inferColumnTypes": "true", "schemaHints": "a INT"}
    assert file_options(prefixed) == file_options(plain)
    found = file_options(CSV | {"delimiter": "|", "rescuedDataColumn": "_r"})
    assert dict(found.reader) == {"header": "true", "delimiter": "|"} and found.rescued_column == "_r"
    with pytest.raises(ValueError, match="xml"):
        file_options({"format": "xml"})


def test_hints_replace_and_add(spark):
    schema = T.StructType().add("CODE#", "long").add("n", "long")
    hinted = with_hints(schema, "`code#` STRING, extra DOUBLE")
    assert [(f.name, f.dataType.simpleString()) for f in hinted.fields] == [
        ("CODE#", "string"), ("n", "bigint"), ("extra", "double")]


def test_second_run_reads_only_new_files(spark, lake):
    for options in (CSV, EVOLVING):
        table = lake(options) if options is CSV else Lake(spark, f"{table.folder}/evolving", options)
        table.put("1.csv", "a,b", "1,x")
        assert rows(table.ingest(), "a", "b") == [("1", "x")]
        assert table.ingest().count() == 1
        table.put("2.csv", "a,b", "2,y", "3,")
        assert rows(table.ingest(), "a", "b") == [("1", "x"), ("2", "y"), ("3", None)]


def test_columns_match_by_name_wherever_they_stand(lake):
    table = lake(EVOLVING)
    table.put("1.csv", "a,b", "1,x")
    table.put("2.csv", "b,a", "y,2")
    table.ingest()
    table.put("3.csv", "a,new,b", "3,n,z")
    bronze = table.ingest()
    assert rows(bronze, "a", "b", "new") == [("1", "x", None), ("2", "y", None), ("3", "z", "n")]
    assert bronze.columns[-1] == "new"


def test_fixed_columns_are_never_shifted(lake):
    """Without added columns a file with another header is refused, not read by position."""
    table = lake(CSV | {"cloudFiles.schemaHints": "a INT, absent INT"})
    table.put("1.csv", "a,b", "1,x")
    table.ingest()
    table.put("2.csv", "a,b", "2,y")
    assert rows(table.ingest(), "a", "b", "absent") == [(1, "x", None), (2, "y", None)]
    table.put("3.csv", "b,a", "z,3")
    with pytest.raises(StreamingQueryException, match="FAILED_READ_FILE"):
        table.ingest()


def test_quoted_and_delimited_headers(lake):
    table = lake(EVOLVING | {"delimiter": "|"})
    table.put("1.csv", '"CODE#"|"odd|name"', '007|"a|b"')
    assert rows(table.ingest(), "`CODE#`", "`odd|name`") == [("007", "a|b")]


def test_empty_and_header_only_files(lake):
    table = lake(EVOLVING)
    table.put("0.csv")
    table.put("1.csv", "", "a,b", "1,x")
    table.put("2.csv", "a,b")
    assert rows(table.ingest(), "a", "b") == [("1", "x")]


def test_long_files_have_one_header_group(spark, tmp_path):
    for i in range(3):
        with open(tmp_path / f"{i}.csv", "w") as file:
            file.write(("a,b\n" if i else "b,a\n") + "1,2\n" * 5000)
    paths = [f"file:{tmp_path}/{i}.csv" for i in range(3)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert [[p.rsplit("/", 1)[1] for p in g] for _, g in header_records(spark, paths, {})] == [["1.csv", "2.csv"], ["0.csv"]]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    both = scan_files(spark, paths, file_options(CSV))
    assert both.groupBy("a", "b").count().orderBy("a").collect() == [("1", "2", 10000), ("2", "1", 5000)]


def test_inferred_types_and_what_they_lose(lake):
    table = lake(INFERRED | {"cloudFiles.schemaHints": "key STRING"})
    table.put("1.csv", "key,n,d,t", "001,1,1.5,x")
    bronze = table.ingest()
    assert dict(bronze.dtypes) | {"key": "string", "n": "int", "d": "double", "t": "string"} == dict(bronze.dtypes)
    assert rows(bronze, "key", "n", "d", "_rescued_data") == [("001", 1, 1.5, None)]
    # A type once stored is kept; what does not fit it is kept beside the row.
    table.put("2.csv", "key,n,d,t", "002,many,2,y")
    bronze = table.ingest()
    assert rows(bronze.filter("key = '002'"), "n", "d", "_rescued_data") == [(None, 2.0, '{"n":"many"}')]


def test_hinted_column_that_no_file_has_yet(lake):
    table = lake(EVOLVING | {"cloudFiles.schemaHints": "a INT, later DOUBLE"})
    table.put("1.csv", "a", "1")
    bronze = table.ingest()
    assert dict(bronze.dtypes)["later"] == "double" and rows(bronze, "a", "later") == [(1, None)]
    table.put("2.csv", "a,later", "2,2.5")
    assert rows(table.ingest(), "a", "later") == [(1, None), (2, 2.5)]


def test_columns_typed_later_stay_text(lake):
    table = lake(INFERRED, as_strings=["key", "n"])
    table.put("1.csv", "key,n,other", " 001 , 7 ,5")
    assert rows(table.ingest(), "key", "n", "other") == [(" 001 ", " 7 ", 5)]


def test_disagreeing_files_get_a_type_that_holds_both(spark, lake):
    table = lake(INFERRED)
    table.put("1.csv", "a,b,c", "1,1,1")
    table.put("2.csv", "c,b,a", "3000000000,2.5,x")
    found = table.ingest()
    wanted = {"a": "string", "b": "double", "c": "bigint"}
    assert {c: t for c, t in found.dtypes if c in wanted} == wanted
    # The counts of the files are merged by adding them, in any order.
    counts = [
        counted_types(scan_files(spark, [f"{table.folder}/raw/{n}.csv"], table.options), "abc") for n in (1, 2)
    ]
    for one, two in (counts, counts[::-1]):
        assert {c: type_of(n).simpleString() for c, n in merged_counts(one, two).items()} == wanted


def test_typed_rescues_each_misfit(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01"), ("a", "y", "never"), (None, None, None)], "n string, t string, d string")
    out = typed(df, T.StructType().add("n", "integer").add("d", "date"), "_rescued")
    assert [r["_rescued"] for r in out.collect()] == [None, '{"n":"a","d":"never"}', None]


@pytest.mark.parametrize("mode", ["addNewColumns", "none"])
def test_json_by_name_with_nested_values(spark, lake, mode):
    table = lake({"cloudFiles.format": "json", "cloudFiles.schemaEvolutionMode": mode})
    table.put("1.json", '{"a": 1, "n": {"x": 2}}', '{"n": {"x": 3}, "a": 4.50}')
    table.ingest()
    table.put("2.json", '{"b": true, "a": 5}')
    bronze = table.ingest()
    assert rows(bronze, "a", "n.x") == [("1", "2"), ("4.50", "3"), ("5", None)]
    assert ("b" in bronze.columns) == (mode == "addNewColumns")


@pytest.mark.parametrize("mode", ["addNewColumns", "none"])
def test_parquet_keeps_types(spark, lake, mode):
    table = lake({"cloudFiles.format": "parquet", "cloudFiles.schemaEvolutionMode": mode})
    spark.range(3).write.mode("append").parquet(f"{table.folder}/raw")
    table.ingest()
    spark.range(3, 5).withColumn("extra", F.lit(True)).write.mode("append").parquet(f"{table.folder}/raw")
    bronze = table.ingest()
    assert dict(bronze.dtypes)["id"] == "bigint"
    assert bronze.agg(F.sum("id")).first()[0] == 10
    if mode == "addNewColumns":
        assert bronze.filter("extra").count() == 2


def test_a_changed_parquet_type_loses_nothing(spark, lake):
    table = lake({"cloudFiles.format": "parquet", "cloudFiles.schemaEvolutionMode": "addNewColumns"})
    spark.sql("select 1 as n").write.mode("append").parquet(f"{table.folder}/raw")
    table.ingest()
    spark.sql("select 3000000000 as n, 'x' as t").write.mode("append").parquet(f"{table.folder}/raw")
    assert rows(table.ingest(), "n", "t", "_rescued_data") == [(None, "x", '{"n":"3000000000"}'), (1, None, None)]


def test_headerless_csv_by_position(lake):
    table = lake({"cloudFiles.format": "csv"})
    table.put("1.csv", "1,x", "2,y")
    assert rows(table.ingest(), "_c0", "_c1") == [("1", "x"), ("2", "y")]


def test_repeated_batch_replaces_its_own_rows(lake, monkeypatch):
    """The write succeeds but the run dies before the batch is noted as done."""
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1", "2")
    write = DataFrameWriter.parquet

    def write_then_die(self, path, *rest, **options):
        write(self, path, *rest, **options)
        if path.endswith("0000000000"):
            raise OSError("executor lost")

    monkeypatch.setattr(DataFrameWriter, "parquet", write_then_die)
    with pytest.raises(Exception, match="executor lost"):
        table.ingest()
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert rows(table.ingest(), "a") == [("1",), ("2",)]


def test_a_new_checkpoint_does_not_overwrite(lake):
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1")
    table.ingest()
    assert rows(table.ingest("another"), "a") == [("1",), ("1",)]


def test_many_small_batches(spark, lake):
    table = lake(EVOLVING, max_files=2)
    for i in range(5):
        table.put(f"{i}.csv", "a", str(i))
    assert rows(table.ingest(), "a") == [(str(i),) for i in range(5)]


def test_bronze_files_are_sorted_by_the_cluster_column(spark, lake):
    table = lake(EVOLVING, cluster_by="a")
    table.put("1.csv", "a,b", *(f"{i % 10},{i}" for i in range(200)))
    found = [row.a for row in table.ingest().select("a").collect()]
    assert len(found) == 200 and found == sorted(found)


def test_audit_columns(spark, lake):
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1")
    row = table.ingest().first()
    assert row.ingested_timestamp == AT and row.ingested_date == AT.date()
    assert row.source_file.endswith("/raw/1.csv")
    now = with_audit(spark.range(1), "some_table").first()
    assert now.source_file == "some_table" and now.ingested_timestamp.date() == now.ingested_date


def test_batch_work_within_a_micro_batch_is_adaptive(spark, lake):
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1")
    table.ingest()
    plans = []

    def note(batch, _):
        plans.append(batch.groupBy("a").count()._jdf.queryExecution().executedPlan().toString())

    query = stream_bronze(spark, table.target).writeStream.foreachBatch(note).trigger(availableNow=True).start()
    query.awaitTermination()
    assert plans[0].startswith("AdaptiveSparkPlan")


def test_bronze_streams_with_its_columns(spark, lake):
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1")
    table.ingest()
    table.put("2.csv", "a,b", "2,x")
    table.ingest()
    stream = stream_bronze(spark, table.target)
    query = stream.writeStream.format("memory").queryName("seen").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("seen"), "a", "b") == [("1", None), ("2", "x")]


def test_an_empty_source_is_no_error_whatever_the_mode(spark, tmp_path):
    from siltstone.sources.files import file_options
    from siltstone.streaming.bronze import ingest_files

    (tmp_path / "raw").mkdir()
    for mode in ("none", "addNewColumns"):
        options = file_options({"format": "json", "schemaEvolutionMode": mode})
        ingest_files(spark, str(tmp_path / "raw"), str(tmp_path / mode), str(tmp_path / f"{mode}-log"), options)


def test_an_unknown_evolution_mode_is_refused():
    from siltstone.sources.files import file_options

    with pytest.raises(ValueError, match="evolution"):
        file_options({"format": "csv", "schemaEvolutionMode": "addNewColumn"})


def test_a_table_may_change_its_mode(spark, lake):
    table = lake(CSV)
    table.put("1.csv", "a,b", "1,x")
    table.ingest()
    table.options = file_options(EVOLVING)
    table.put("2.csv", "a,b,c", "2,y,z")
    assert rows(table.ingest(), "a", "b", "c") == [("1", "x", None), ("2", "y", "z")]
    table.options = file_options(CSV)
    table.put("3.csv", "a,b,c", "3,w,v")
    assert rows(table.ingest(), "a", "c") == [("1", None), ("2", "z"), ("3", "v")]
    table.put("4.csv", "a,b", "4,u")
    with pytest.raises(StreamingQueryException, match="FAILED_READ_FILE"):
        table.ingest()


@pytest.mark.parametrize("max_files", [1, 10])
def test_fields_beyond_fixed_columns_are_rescued(lake, max_files):
    table = lake({"cloudFiles.format": "json", "rescuedDataColumn": "_r", "schemaHints": "id INT"}, max_files=max_files)
    table.put("1.json", '{"id": 1}')
    table.ingest()
    table.put("2.json", '{"id": 2, "Extra": "x", "n": {"k": 1}}')
    table.put("3.json", '{"id": "many"}')
    bronze = table.ingest()
    assert "Extra" not in bronze.columns
    assert rows(bronze, "id", "_r") == [(None, '{"id":"many"}'), (1, None), (2, '{"Extra":"x","n":"{\\"k\\":\\"1\\"}"}')]


def test_fixed_columns_honour_clustering_and_batches(lake):
    table = lake(CSV, cluster_by="a", max_files=1)
    for part in range(2):
        table.put(f"{part}.csv", "a", *(str(i % 10) for i in range(100)))
    bronze = table.ingest()
    files = {r.f for r in bronze.select(F.input_file_name().alias("f")).collect()}
    assert bronze.count() == 200 and len({f.rsplit("/", 2)[1] for f in files}) == 2
    for file in files:
        found = [r.a for r in bronze.filter(F.input_file_name() == file).select("a").collect()]
        assert found == sorted(found)


def test_files_with_equal_comments_are_told_apart_by_their_header(lake):
    table = lake(CSV | ADD | {"comment": "#"})
    table.put("1.csv", "# export", "id,name", "1,one")
    table.put("2.csv", "# export", "", "name,id", "two,2")
    assert rows(table.ingest(), "id", "name") == [("1", "one"), ("2", "two")]


def test_headers_that_differ_after_a_line_break(lake):
    table = lake(CSV | ADD | {"multiLine": "true"})
    table.put("1.csv", 'id,"na', 'me"', "1,one")
    table.put("2.csv", 'id,"na', 'me2"', "2,two")
    found = table.ingest()
    assert {"na\nme", "na\nme2"} <= set(found.columns)
    assert rows(found, "id", "`na\nme`", "`na\nme2`") == [("1", "one", None), ("2", None, "two")]


@pytest.mark.parametrize("mode", [{}, ADD])
def test_values_beyond_the_last_column_are_rescued(lake, mode):
    table = lake(CSV | mode | {"rescuedDataColumn": "_rescued"})
    table.put("1.csv", "id,name", "1,one", "2,two,EXTRA", '3,"a,b"', "4", "5,,,z", '"6","six"', '7,"say ""x"", y"')
    found = table.ingest()
    # Doubled quotes are no escape by default: the reader ends that value at the comma.
    assert found.filter("id = 7 and _rescued like '%, y%'").count() == 1
    assert rows(found.filter("id < 7"), "id", "name", "_rescued") == [
        ("1", "one", None),
        ("2", "two", '{"_record":"2,two,EXTRA"}'),
        ("3", "a,b", None),
        ("4", None, None),
        ("5", None, '{"_record":"5,,,z"}'),
        ("6", "six", None),
    ]


@pytest.mark.parametrize("mode", [{}, ADD])
def test_the_widest_headerless_record_sets_the_columns(lake, mode):
    table = lake({"cloudFiles.format": "csv"} | mode)
    table.put("1.csv", *(f"{i},x" for i in range(5)))
    table.put("2.csv", "9,wide,third", '"1,0","q"')
    found = table.ingest()
    assert [c for c in found.columns if c.startswith("_c")] == ["_c0", "_c1", "_c2"]
    assert rows(found.filter("_c2 is not null"), "_c0", "_c1", "_c2") == [("9", "wide", "third")]
    assert rows(found.filter("_c1 = 'q'"), "_c0") == [("1,0",)]


@pytest.mark.parametrize("max_files", [1, 10])
@pytest.mark.parametrize("mode", [{}, ADD])
def test_inferred_types_do_not_depend_on_the_batches(lake, mode, max_files):
    table = lake(CSV | mode | {"inferColumnTypes": "true"}, max_files=max_files)
    table.put("1.csv", "x,y", "5,1")
    table.put("2.csv", "x,y", "abc,2")
    found = table.ingest()
    assert dict(found.dtypes)["x"] == "string" and dict(found.dtypes)["y"] == "int"
    assert rows(found, "x", "y") == [("5", 1), ("abc", 2)]


@pytest.mark.parametrize("mode", [{}, ADD])
def test_names_are_not_taken_for_patterns(spark, lake, mode):
    table = lake({"cloudFiles.format": "json"} | mode)
    table.put("a*.json", '{"id": 1}')
    table.put("ab.json", '{"id": 2}')
    bronze = table.ingest()
    assert rows(bronze, "id") == [("1",), ("2",)]
    assert sorted(r.f.rsplit("/", 1)[1] for r in bronze.select(F.url_decode("source_file").alias("f")).collect()) == ["a*.json", "ab.json"]
    table = Lake(spark, f"{table.folder}/csv", CSV | mode)
    for k, name in enumerate(["p?.csv", "px.csv", "a b [1]{x}*.csv", "back\\slash.csv", "100%.csv", "a+b,c.csv"]):
        table.put(name, "id", str(k))
    assert rows(table.ingest(), "id") == [(str(k),) for k in range(6)]


@pytest.mark.parametrize("mode", [{}, ADD])
def test_folders_hold_columns(spark, lake, mode):
    table = lake(CSV | mode | {"inferColumnTypes": "true"})
    for day, area in ((1, "x"), (2, "y%20z")):
        os.makedirs(f"{table.folder}/raw/day={day}/area={area}")
        table.put(f"day={day}/area={area}/1.csv", "id,area", f"{day},file")
    table.put("day=1/2.csv", "id,area", "7,mine")
    bronze = table.ingest()
    assert rows(bronze, "id", "day", "area") == [(1, 1, "x"), (2, 2, "y z"), (7, 1, "mine")]
    assert dict(bronze.dtypes)["day"] == "int"
    os.makedirs(f"{table.folder}/raw/day=__HIVE_DEFAULT_PARTITION__/area=q")
    table.put("day=__HIVE_DEFAULT_PARTITION__/area=q/1.csv", "id,area", "8,file")
    assert rows(table.ingest().filter("id = 8"), "day", "area") == [(None, "q")]


def test_a_failed_batch_logs_no_column(lake, monkeypatch):
    table = lake(EVOLVING)
    table.put("1.csv", "a", "1")
    table.ingest()
    table.put("2.csv", "a,b", "2,x")
    write = DataFrameWriter.parquet

    def fail(self, path, *rest, **options):
        if "/bronze/" in path and "_columns" not in path:
            raise OSError("lost")
        return write(self, path, *rest, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", fail)
    with pytest.raises(Exception, match="lost"):
        table.ingest()
    monkeypatch.setattr(DataFrameWriter, "parquet", write)
    assert "b" not in read_bronze(table.spark, table.target).columns
    assert rows(table.ingest(), "a", "b") == [("1", None), ("2", "x")]


def test_fixed_headerless_files_stay_fixed(lake):
    table = lake({"cloudFiles.format": "csv", "rescuedDataColumn": "_r"})
    table.put("1.csv", "1,x")
    table.ingest()
    table.put("2.csv", "2,y,z")
    bronze = table.ingest()
    assert "_c2" not in bronze.columns
    assert rows(bronze, "_c0", "_c1", "_r") == [("1", "x", None), ("2", "y", '{"_record":"2,y,z"}')]


def test_documents_in_a_text_column_are_kept_as_text(lake):
    table = lake({"cloudFiles.format": "json"} | ADD)
    table.put("1.json", '{"a": "x"}')
    table.ingest()
    table.put("2.json", '{"a": {"b": 1}}', '{"a": [1, {"c": "y"}]}')
    assert rows(table.ingest(), "a") == [('[1, {"c": "y"}]',), ("x",), ('{"b": 1}',)]


def test_nested_columns_grow_and_misfits_are_rescued_by_path(lake):
    hints = {"cloudFiles.schemaHints": "a STRUCT<x: INT, l: ARRAY<STRUCT<n: INT>>>"}
    table = lake({"cloudFiles.format": "json"} | ADD | hints)
    table.put("1.json", '{"id": 1, "a": {"x": 5, "l": [{"n": 1}]}}', '{"id": 2, "a": {"x": "many", "l": [{"n": "q"}, {"n": 2}]}}')
    table.ingest()
    table.put("2.json", '{"id": 3, "a": {"x": 6, "y": {"z": "new"}}}', '{"id": 4, "a": "plain"}', '{"id": 5, "a": null}')
    bronze = table.ingest()
    assert rows(bronze, "id", "a.x", "a.y.z", "_rescued_data") == [
        ("1", 5, None, None),
        ("2", None, None, '{"a.x":"many","a.l":"[{\\"n\\":\\"q\\"},{\\"n\\":\\"2\\"}]"}'),
        ("3", 6, "new", None),
        ("4", None, None, '{"a":"plain"}'),
        ("5", None, None, None),
    ]


def test_any_number_of_headers_is_one_scan(spark, tmp_path):
    """500 headers, each with a column of its own: one scan in the plan, every value in its column."""
    paths = []
    for i in range(500):
        with open(tmp_path / f"{i}.csv", "w") as file:
            file.write(f"own{i},id\n{i},a\n" if i % 2 else f"id,own{i}\na,{i}\n")
        paths.append(f"{tmp_path}/{i}.csv")
    options = file_options(EVOLVING)
    found = scan_files(spark, paths, options)
    assert len(found.columns) == 502 and plan(found).count("Scan csv") == 2  # once in the tree, once in the details
    own = F.coalesce(*(F.col(f"own{i}") for i in range(500)))
    assert found.select(own.cast("int").alias("n"), "id").agg(F.sum("n"), F.count_if(F.col("id") == "a")).first() == (124750, 500)


def test_header_names_without_a_name_or_repeated(lake):
    table = lake(EVOLVING)
    table.put("1.csv", "id,,id,b", "1,2,3,4")
    table.put("2.csv", "ID,c", "9,8")
    assert rows(table.ingest(), "id0", "_c1", "id2", "b", "ID", "c") == [(None, None, None, None, "9", "8"), ("1", "2", "3", "4", None, None)]


@pytest.mark.parametrize("max_files", [1, 10])
def test_no_file_is_looked_into_twice(spark, lake, max_files):
    """Types come from a state that files are merged into: removed files are still in it, the rest is not read again."""
    table = lake(INFERRED, max_files=max_files)
    table.put("1.csv", "x,d", "5,2024-01-01")
    table.put("2.csv", "x,d", "2.5,2024-01-02")
    bronze = table.ingest()
    assert {c: t for c, t in bronze.dtypes if c in "xd"} == {"x": "double", "d": "date"}
    os.remove(f"{table.folder}/raw/1.csv")
    os.remove(f"{table.folder}/raw/2.csv")
    table.put("3.csv", "x,new", "7,true")
    assert {c: t for c, t in table.ingest().dtypes if c in ("x", "d", "new")} == {"x": "double", "d": "date", "new": "boolean"}
