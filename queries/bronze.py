"""Raw sources into bronze.

The given tables are first written out as the raw files or the database table
that a source system would deliver.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.tables import (
    BUCKETS,
    CUSTOMER_COLUMNS,
    SUPPLIER_COLUMNS,
    column,
    comparable,
    read,
    spec,
)
from siltstone import table_spec
from siltstone.operators.layout import write_clustered
from siltstone.operators.silver import silver_transform
from siltstone.plans.medallion import bronze_rows, cluster_silver, ingest_table, rule_totals, run_table, table_flow
from siltstone.session import scratch_dir, settings
from siltstone.sources.jdbc import jdbc_options, scan_jdbc

LOADED_AT = datetime(2024, 2, 1, 12, 30)

CSV = {"cloudFiles.format": "csv", "header": "true", "delimiter": ","}
ADD_COLUMNS = {"cloudFiles.schemaEvolutionMode": "addNewColumns"}
INFER = {"cloudFiles.inferColumnTypes": "true"}


def _config(table: str, columns: list[dict], keys: list[str], read_options: dict, **rest) -> dict:
    return spec(table, f"raw_{table}", columns, keys, bronze={"read_options": read_options}, **rest)


def _write_csv(df: DataFrame, folder: str) -> None:
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("append").options(header="true", **keep).csv(folder)


def _ingested(spark: SparkSession, config: dict, table: str, root: str) -> DataFrame:
    flow = table_flow(spark, config, table, f"{root}/lake")
    ingest_table(spark, flow, base_path=f"{root}/raw", as_of=LOADED_AT)
    return bronze_rows(spark, flow)


def _typed(bronze: DataFrame, config: dict, table: str) -> DataFrame:
    """The listed columns only, typed."""
    columns = table_spec(config, table).columns
    return silver_transform(bronze, columns).select(*(c.name for c in columns))


def _customer_stream(file_format: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_dir(spark, f"bronze_{file_format}")
        customer = read(spark, sf_dir, "customer")
        if file_format == "csv":
            _write_csv(customer, f"{root}/raw/raw_customer")
        else:
            customer.write.format(file_format).save(f"{root}/raw/raw_customer")
        options = CSV if file_format == "csv" else {"cloudFiles.format": file_format}
        config = _config("customer", CUSTOMER_COLUMNS, ["c_custkey"], options)
        return _typed(_ingested(spark, config, "customer", root), config, "customer")

    return query


def inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No listed columns: bronze itself holds the inferred types."""
    root = scratch_dir(spark, "bronze_infer")
    _write_csv(read(spark, sf_dir, "part"), f"{root}/raw/raw_part")
    config = _config("part", [], ["p_partkey"], CSV | INFER)
    return _ingested(spark, config, "part", root).drop("ingested_timestamp", "ingested_date", "source_file")


def hinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero-padded key would be inferred as a number; the hint keeps its text."""
    root = scratch_dir(spark, "bronze_hints")
    padded = read(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("PART#"), "p_name", "p_size"
    )
    _write_csv(padded, f"{root}/raw/raw_part")
    hints = {"cloudFiles.schemaHints": "`PART#` STRING, p_size BIGINT"}
    config = _config("part", [], ["PART#"], CSV | INFER | hints)
    return _ingested(spark, config, "part", root).select("PART#", "p_name", "p_size")


def columns_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second delivery: other column order, one column more in the middle."""
    root = scratch_dir(spark, "bronze_add_columns")
    nation = read(spark, sf_dir, "nation")
    columns = [column("n_nationkey", "integer"), column("n_name", "string"), column("n_regionkey", "integer"),
               column("n_note", "string")]
    config = _config("nation", columns, ["n_nationkey"], CSV | ADD_COLUMNS)
    _write_csv(nation.select("n_nationkey", "n_name", "n_regionkey"), f"{root}/raw/raw_nation")
    _ingested(spark, config, "nation", root)
    note = F.concat(F.lit("note "), "n_name").alias("n_note")
    later = nation.select("n_regionkey", (F.col("n_nationkey") + 1000).alias("n_nationkey"), note, "n_name")
    _write_csv(later, f"{root}/raw/raw_nation")
    return _typed(_ingested(spark, config, "nation", root), config, "nation")


def rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes that are no numbers end up in the rescued column, the rest of the row is kept."""
    root = scratch_dir(spark, "bronze_rescued")
    part = read(spark, sf_dir, "part")
    size = F.when(F.col("p_size") > 40, "huge").otherwise(F.col("p_size").cast("string"))
    _write_csv(part.withColumn("p_size", size), f"{root}/raw/raw_part")
    options = CSV | {"rescuedDataColumn": "_rescued", "schemaHints": "p_size INT, p_partkey BIGINT"}
    config = _config("part", [], ["p_partkey"], options)
    return _ingested(spark, config, "part", root).select("p_partkey", "p_name", "p_size", "_rescued")


def source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per region, so the path tells the region."""
    root = scratch_dir(spark, "bronze_source_file")
    read(spark, sf_dir, "region").withColumn("area", F.col("r_name")).write.partitionBy("area").json(
        f"{root}/raw/raw_region"
    )
    columns = [column("r_regionkey", "integer"), column("r_name", "string")]
    config = _config("region", columns, ["r_regionkey"], {"cloudFiles.format": "json"} | ADD_COLUMNS)
    bronze = _ingested(spark, config, "region", root)
    folder = F.regexp_extract("source_file", "/area=([^/]*)/[^/]*[.]json$", 1)
    return bronze.select(F.col("r_regionkey").cast("int"), "r_name", F.url_decode(folder).alias("source_folder"))


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "bronze_audit")
    _write_csv(read(spark, sf_dir, "region"), f"{root}/raw/raw_region")
    config = _config("region", [column("r_regionkey", "integer")], ["r_regionkey"], CSV)
    bronze = _ingested(spark, config, "region", root)
    has_path = F.col("source_file").contains("/raw/raw_region/part-")
    return comparable(
        bronze.select(
            F.col("r_regionkey").cast("int"), "r_name", "ingested_timestamp", "ingested_date", has_path.alias("has_path")
        )
    )


def rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, four runs: each file is read by one of them."""
    root = scratch_dir(spark, "bronze_rerun")
    supplier = read(spark, sf_dir, "supplier")
    config = _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], CSV | ADD_COLUMNS)
    domestic = F.col("s_nationkey") < 12
    for delivery in (supplier.filter(domestic), supplier.filter(~domestic)):
        _write_csv(delivery, f"{root}/raw/raw_supplier")
        _ingested(spark, config, "supplier", root)
        bronze = _ingested(spark, config, "supplier", root)
    return _typed(bronze, config, "supplier")


def mode_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, fixed columns, then added ones, then fixed again: no delivery hides another."""
    root = scratch_dir(spark, "bronze_mode_switch")
    supplier = read(spark, sf_dir, "supplier")
    for part, mode in enumerate(({}, ADD_COLUMNS, {})):
        config = _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], CSV | mode)
        _write_csv(supplier.filter(F.col("s_suppkey") % 3 == part), f"{root}/raw/raw_supplier")
        bronze = _ingested(spark, config, "supplier", root)
    return _typed(bronze, config, "supplier")


def rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed columns: fields that only the second delivery has are kept beside its rows."""
    root = scratch_dir(spark, "bronze_rescued_fields")
    options = {"cloudFiles.format": "json", "rescuedDataColumn": "_rescued", "schemaHints": "s_suppkey BIGINT"}
    config = _config("supplier", [], ["s_suppkey"], options)
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    even = F.col("s_suppkey") % 2 == 0
    for delivery in (supplier.filter(even).drop("s_nationkey"), supplier.filter(~even)):
        delivery.write.mode("append").json(f"{root}/raw/raw_supplier")
        bronze = _ingested(spark, config, "supplier", root)
    return bronze.select("s_suppkey", "s_name", "_rescued")


def ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a value too many under a header, and headerless files of different widths."""
    root = scratch_dir(spark, "bronze_ragged")
    supplier = read(spark, sf_dir, "supplier")
    odd = F.col("s_suppkey") % 2 == 1
    surplus = F.concat_ws(",", "s_suppkey", "s_name", F.when(odd, "surplus"))
    # A single column under another separator, so that its commas are not quoted.
    lines = supplier.select(surplus.alias("s_suppkey,s_name"))
    lines.write.options(header="true", sep=";").csv(f"{root}/raw/raw_supplier")
    config = _config("supplier", [], ["s_suppkey"], CSV | {"rescuedDataColumn": "_rescued"})
    named = _ingested(spark, config, "supplier", root).select("s_suppkey", "s_name", F.lit(None).cast("string"), "_rescued")
    narrow = supplier.select("s_suppkey", "s_name")
    for delivery in (narrow.filter(~odd), narrow.filter(odd).withColumn("third", F.lit("third"))):
        delivery.write.mode("append").csv(f"{root}/raw/raw_bare")
    bare = spec("bare", "raw_bare", [], ["_c0"], bronze={"read_options": {"cloudFiles.format": "csv"}})
    bare = _ingested(spark, bare, "bare", root).select("_c0", "_c1", "_c2", F.lit(None).cast("string"))
    return named.unionAll(bare).toDF("s_suppkey", "s_name", "third", "_rescued")


def odd_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that hold a column, and names that would match others if they were taken for patterns."""
    root = scratch_dir(spark, "bronze_odd_paths")
    supplier = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    raw = f"{root}/raw/raw_supplier"
    for part, folder in enumerate(("area=a*", "area=ab", "area=a b [1]{x}?", "area=__HIVE_DEFAULT_PARTITION__")):
        rows = supplier.filter(F.col("s_suppkey") % 4 == part)
        rows.write.options(header="true").csv(f"{raw}/{folder}")
    config = _config("supplier", SUPPLIER_COLUMNS[:3], ["s_suppkey"], CSV)
    bronze = _ingested(spark, config, "supplier", root)
    return silver_transform(bronze, table_spec(config, "supplier").columns).select("s_suppkey", "s_name", "s_nationkey", "area")


def nested_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose nested fields grow, change their kind and lose their type from one delivery to the next."""
    root = scratch_dir(spark, "bronze_nested")
    supplier = read(spark, sf_dir, "supplier")
    key, name, nation = F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey")
    first = supplier.filter(key % 2 == 0).select(
        key.alias("id"), F.struct(name.alias("name"), F.struct(nation.alias("nation")).alias("at")).alias("who"),
        F.array(F.struct(nation.alias("n"))).alias("list"), name.alias("note"),
    )
    text = F.when(key % 3 == 0, F.lit("none")).otherwise(nation.cast("string"))
    later = supplier.filter(key % 2 == 1).select(
        key.alias("id"),
        F.struct(name.alias("name"), F.struct(text.alias("nation"), key.alias("street")).alias("at"), nation.alias("rank")).alias("who"),
        F.array(F.struct(nation.alias("n"), key.alias("m"))).alias("list"), F.struct(key.alias("key")).alias("note"),
    )
    hints = "id BIGINT, who STRUCT<name: STRING, at: STRUCT<nation: INT>>, note STRING"
    config = _config("supplier", [], ["id"], {"cloudFiles.format": "json", "cloudFiles.schemaHints": hints} | ADD_COLUMNS)
    for delivery in (first, later):
        delivery.write.mode("append").json(f"{root}/raw/raw_supplier")
        bronze = _ingested(spark, config, "supplier", root)
    return bronze.select(
        "id", "who.name", "who.at.nation", F.col("who.at.street").alias("street"), F.col("who.rank").alias("rank"),
        F.col("list")[0]["n"].alias("n"), F.col("list")[0]["m"].alias("m"), "note", "_rescued_data",
    )


HEADERS = 40


def many_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file has a header of its own: another order of the columns, and one column that no other file has."""
    root = scratch_dir(spark, "bronze_many_headers")
    names = ["c_custkey", "c_name", "c_nationkey"]

    def line(values: dict) -> Column:
        """The values in one of six orders, by the number of the file."""
        found = []
        for k in range(6):
            order = names[k % 3 :] + names[: k % 3]
            order = ["own", *order] if k % 2 else [*order, "own"]
            found.append(F.when(F.col("file") % 6 == k, F.concat_ws(",", *(values[n] for n in order))))
        return F.coalesce(*found).alias("line")

    key = F.col("c_custkey")
    rows = read(spark, sf_dir, "customer").withColumn("file", key % HEADERS)
    rows = rows.select("file", line({n: F.col(n) for n in names} | {"own": key + F.col("file")}), F.lit(1).alias("place"))
    header = line({n: F.lit(n) for n in names} | {"own": F.concat(F.lit("own_"), "file")})
    headers = spark.range(HEADERS).withColumnRenamed("id", "file").select("file", header, F.lit(0).alias("place"))
    placed = rows.unionAll(headers).repartition(HEADERS, "file").sortWithinPartitions("file", "place").select("file", "line")
    placed.write.partitionBy("file").text(f"{root}/raw/raw_customer")
    bronze = _ingested(spark, _config("customer", [], ["c_custkey"], CSV | ADD_COLUMNS), "customer", root)
    own = F.coalesce(*(F.col(f"own_{k}") for k in range(HEADERS)))
    return bronze.select(key.cast("bigint"), "c_name", F.col("c_nationkey").cast("bigint"), own.cast("bigint").alias("own"))


# The database stand-in: a named in-memory database inside the one process of a
# local session.  A cluster sets these to reach a database of its own.
DATABASE_CONF = {"url": "siltstone.check.jdbc.url", "driver": "siltstone.check.jdbc.driver"}
# Reads are split on the name, a text.
BY_NAME = {"fetchsize": 1000, "partitionColumn": '"s_name"', "numPartitions": 4}
EMBEDDED = {"url": "jdbc:derby:memory:siltstone;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def _supplier_table(spark: SparkSession, sf_dir: str) -> dict:
    return _database_table(spark, read(spark, sf_dir, "supplier"))


def _database_table(spark: SparkSession, supplier: DataFrame) -> dict:
    """Suppliers as a database table of its own; the connection to it."""
    connection = {key: spark.conf.get(name, EMBEDDED[key]) for key, name in DATABASE_CONF.items()}
    connection["table"] = scratch_dir(spark, "s").rsplit("/", 1)[1].replace("-", "_")
    options = jdbc_options(connection, user="app", password="app")
    supplier.write.format("jdbc").options(
        createTableColumnTypes="s_name VARCHAR(200)", **options
    ).save()
    return connection


def database(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The database table replaces its bronze table; a second read changes nothing."""
    root = scratch_dir(spark, "bronze_jdbc")
    connection = _supplier_table(spark, sf_dir)
    options = jdbc_options(connection | BY_NAME, user="app", password="app")
    flow = table_flow(spark, _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], {}), "supplier", root, "jdbc")
    for _ in range(2):
        ingest_table(spark, flow, jdbc=options, as_of=LOADED_AT)
    return _lower(bronze_rows(spark, flow)).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "source_file")


def database_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    connection = _supplier_table(spark, sf_dir)
    last = read(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]
    tuning = {"fetchsize": 1000, "partitionColumn": '"s_suppkey"', "lowerBound": 0, "upperBound": last, "numPartitions": 4}
    return _lower(scan_jdbc(spark, jdbc_options(connection | tuning, user="app", password="app")))


def database_by_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session names the database and how its reads are split; only credentials are given."""
    connection = _supplier_table(spark, sf_dir)
    last = read(spark, sf_dir, "supplier").agg(F.max("s_suppkey")).first()[0]
    conf = {"url": connection["url"], "driver": connection["driver"], "partitionColumn": '"s_suppkey"',
            "lowerBound": "0", "upperBound": str(last), "numPartitions": "4"}
    config = _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], {})
    config["tables"]["supplier"]["bronze"]["source_table"] = connection["table"]
    flow = table_flow(spark, config, "supplier", scratch_dir(spark, "bronze_jdbc_conf"), "jdbc")
    with settings(spark, {f"pipeline.jdbc_{key}": value for key, value in conf.items()}):
        ingest_table(spark, flow, credentials=("app", "app"), as_of=LOADED_AT)
    return _lower(bronze_rows(spark, flow)).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def switched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One spec, both kinds of source, two bronze tables."""
    root = scratch_dir(spark, "bronze_switch")
    config = _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], CSV)
    options = jdbc_options(_supplier_table(spark, sf_dir) | BY_NAME, user="app", password="app")
    _write_csv(read(spark, sf_dir, "supplier"), f"{root}/raw/raw_supplier")
    tables = []
    for source_type in ("s3", "jdbc"):
        flow = table_flow(spark, config, "supplier", f"{root}/lake", source_type)
        ingest_table(spark, flow, base_path=f"{root}/raw", jdbc=options, as_of=LOADED_AT)
        tables.append(_typed(bronze_rows(spark, flow), config, "supplier").withColumn("bronze_table", F.lit(flow.bronze_name)))
    return tables[0].unionByName(tables[1])


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.lower() for name in df.columns))


def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem clustered by ship date; a range filter on it skips files and row groups."""
    root = scratch_dir(spark, "clustered")
    lines = read(spark, sf_dir, "lineitem").select("l_shipdate", "l_orderkey", "l_quantity", "l_returnflag")
    write_clustered(lines, root, ["l_shipdate"])
    low, high = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (1997, 1999))
    inside = spark.read.parquet(root).filter((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
    return inside.groupBy("l_returnflag").agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


def clustered_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem along a curve over ship date and part: a filter on either skips most files."""
    root = scratch_dir(spark, "clustered_curve")
    lines = read(spark, sf_dir, "lineitem").select("l_shipdate", "l_partkey", "l_orderkey", "l_quantity")
    write_clustered(lines, root, ["l_shipdate", "l_partkey"], partitions=64, lookup=["l_orderkey"])
    stored = spark.read.parquet(root).withColumn("file", F.col("_metadata.file_path"))
    low, high = (F.lit(datetime(y, 1, 1)).cast("timestamp_ntz") for y in (1997, 1998))
    by_date = (F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high)
    by_part = F.col("l_partkey") <= 20
    files = F.count_distinct("file")

    def few(inside):
        return F.count_distinct(F.when(inside, F.col("file"))) * 2 < files

    return stored.agg(
        F.count("*").alias("lines"), F.count_if(by_date).alias("of_date"), F.count_if(by_part).alias("of_part"),
        few(by_date).alias("date_skips"), few(by_part).alias("part_skips"),
    )


_CUSTOMER_FLOW = dict(
    columns=[column("c_custkey", "long", source="CUST#"), *CUSTOMER_COLUMNS[1:4],
             column("c_mktsegment", "string", markers=["", "NULL"]), column("c_changed", "integer")],
    keys=["c_custkey"],
    silver={"incremental_columns": ["c_changed"], "partition_columns": "c_changed"},
)


def _customer_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two deliveries of padded customers; the second changes some, repeats others with an older state."""
    def padded(c):
        return F.concat(F.lit(" "), c.cast("string"), F.lit("  "))

    customer = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "NULL").otherwise(F.col("c_mktsegment"))
    raw = [padded(key).alias("CUST#"), padded(F.col("c_name")).alias("c_name"),
           padded(F.col("c_nationkey")).alias("c_nationkey"), F.col("c_acctbal"), padded(segment).alias("c_mktsegment")]
    first = customer.select(*raw, padded(F.lit(20240115)).alias("c_changed"))
    changed = customer.select(
        *raw[:3],
        (F.col("c_acctbal") + 1000).alias("c_acctbal"),
        padded(F.when(key % 2 == 0, 20240116).otherwise(20240114)).alias("c_changed"),
        raw[4],
        F.when(key % 3 == 0, "checked").alias("c_remark"),
    )
    return [first, changed]


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to bronze to silver in two runs; the second delivery has one column more."""
    root = scratch_dir(spark, "medallion")
    config = _config("customer", read_options=CSV | ADD_COLUMNS | INFER, **_CUSTOMER_FLOW)
    for delivery in _customer_deliveries(spark, sf_dir):
        _write_csv(delivery, f"{root}/raw/raw_customer")
        silver = run_table(
            spark, config, "customer", f"{root}/lake", base_path=f"{root}/raw", as_of=LOADED_AT, buckets=BUCKETS
        )
    return silver.drop("ingested_timestamp", "ingested_date", "source_file", "_rescued_data")


def database_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database to silver in two loads; rows that the second one lacks stay as they were."""
    root = scratch_dir(spark, "medallion_jdbc")
    config = _config("supplier", SUPPLIER_COLUMNS, ["s_suppkey"], {})
    supplier = read(spark, sf_dir, "supplier")
    changed = supplier.filter(F.col("s_nationkey") < 12).withColumn("s_acctbal", F.col("s_acctbal") + 1000)
    for day, load in enumerate((supplier, changed)):
        options = jdbc_options(_database_table(spark, load) | BY_NAME, user="app", password="app")
        at = LOADED_AT + timedelta(days=day)
        silver = run_table(spark, config, "supplier", root, source_type="jdbc", jdbc=options, as_of=at, buckets=BUCKETS)
    return comparable(silver.drop("ingested_date", "source_file"))


def _nation_flow(spark: SparkSession, sf_dir: str, purpose: str):
    """Customers by the flow, every seventh without a key, silver to be ranged by nation."""
    root = scratch_dir(spark, purpose)
    key = F.when(F.col("c_custkey") % 7 == 0, "NULL").otherwise(F.col("c_custkey").cast("string"))
    _write_csv(read(spark, sf_dir, "customer").withColumn("c_custkey", key), f"{root}/raw/raw_customer")
    columns = [column("c_custkey", "long", markers=["NULL"]), *CUSTOMER_COLUMNS[1:]]
    config = _config("customer", columns, ["c_custkey"], CSV, silver={"partition_columns": "c_nationkey"})
    counts = []
    options = {"base_path": f"{root}/raw", "buckets": BUCKETS, "on_rule_counts": counts.append}
    run_table(spark, config, "customer", f"{root}/lake", **options)
    return table_flow(spark, config, "customer", f"{root}/lake"), counts


def medallion_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the key rule let pass and dropped, counted by the run itself."""
    _, counts = _nation_flow(spark, sf_dir, "medallion_rules")
    found = [(c["valid_c_custkey_passed"], c["valid_c_custkey_dropped"]) for c in counts]
    return spark.createDataFrame(found, "passed long, dropped long")


def medallion_rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same summed over two runs of batches of one file each, one run repeated: kept with the table."""
    root = scratch_dir(spark, "medallion_totals")
    customer = read(spark, sf_dir, "customer")
    key = F.when(F.col("c_custkey") % 7 == 0, "NULL").otherwise(F.col("c_custkey").cast("string"))
    columns = [column("c_custkey", "long", markers=["NULL"]), *CUSTOMER_COLUMNS[1:]]
    config = _config("customer", columns, ["c_custkey"], CSV)
    for part in range(2):
        rows = customer.filter(F.col("c_custkey") % 2 == part).withColumn("c_custkey", key)
        _write_csv(rows.repartition(3), f"{root}/raw/raw_customer")
        for _ in range(2):
            run_table(
                spark, config, "customer", f"{root}/lake", base_path=f"{root}/raw", buckets=BUCKETS, max_files=1, count_rules=True
            )
    totals = rule_totals(spark, table_flow(spark, config, "customer", f"{root}/lake"))
    return spark.createDataFrame([(totals["valid_c_custkey_passed"], totals["valid_c_custkey_dropped"])], "passed long, dropped long")


def medallion_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver ranged by nation after a run: few files hold the nations of a filter."""
    flow, _ = _nation_flow(spark, sf_dir, "medallion_clustered")
    ranged = cluster_silver(spark, flow, BUCKETS).withColumn("file", F.col("_metadata.file_path"))
    inside = F.col("c_nationkey") < 5
    files, hit = F.count_distinct("file"), F.count_distinct(F.when(inside, F.col("file")))
    return ranged.agg(F.count_if(inside).alias("customers"), (hit * 2 < files).alias("skips_files"))


_SUPPLIER_SQL = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier"

QUERIES = {
    "bronze_csv_stream": _customer_stream("csv"),
    "bronze_json_stream": _customer_stream("json"),
    "bronze_parquet_stream": _customer_stream("parquet"),
    "bronze_infer_types": inferred,
    "bronze_schema_hints": hinted,
    "bronze_add_columns": columns_added,
    "bronze_rescued": rescued,
    "bronze_source_file": source_file,
    "bronze_audit": audited,
    "bronze_incremental_rerun": rerun,
    "bronze_jdbc": database,
    "bronze_jdbc_partitioned": database_in_parts,
    "bronze_jdbc_conf": database_by_conf,
    "bronze_mode_switch": mode_switch,
    "bronze_rescued_fields": rescued_fields,
    "bronze_ragged_csv": ragged,
    "medallion_rule_counts": medallion_rule_counts,
    "medallion_rule_totals": medallion_rule_totals,
    "clustered_curve": clustered_curve,
    "medallion_clustered": medallion_clustered,
    "bronze_source_switch": switched,
    "bronze_odd_paths": odd_paths,
    "bronze_nested_evolution": nested_evolution,
    "bronze_many_headers": many_headers,
    "clustered_write": clustered_write,
    "medallion_e2e": end_to_end,
    "medallion_jdbc": database_end_to_end,
}

ORACLE = {
    "bronze_csv_stream": "SELECT * FROM customer",
    "bronze_json_stream": "SELECT * FROM customer",
    "bronze_parquet_stream": "SELECT * FROM customer",
    "bronze_infer_types": """
        SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
               CAST(NULL AS VARCHAR) AS _rescued_data
        FROM part""",
    "bronze_schema_hints": """
        SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS "PART#", p_name, CAST(p_size AS BIGINT) AS p_size FROM part""",
    "bronze_add_columns": """
        SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS n_note FROM nation
        UNION ALL
        SELECT n_nationkey + 1000, n_name, n_regionkey, 'note ' || n_name FROM nation""",
    "bronze_rescued": """
        SELECT p_partkey, p_name, CASE WHEN p_size <= 40 THEN p_size END AS p_size,
               CASE WHEN p_size > 40 THEN '{"p_size":"huge"}' END AS _rescued
        FROM part""",
    "bronze_source_file": "SELECT r_regionkey, r_name, r_name AS source_folder FROM region",
    "bronze_audit": """
        SELECT r_regionkey, r_name, TIMESTAMP '2024-02-01 12:30:00' AS ingested_timestamp,
               DATE '2024-02-01' AS ingested_date, true AS has_path
        FROM region""",
    "bronze_incremental_rerun": _SUPPLIER_SQL,
    "bronze_jdbc": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'raw_supplier' AS source_file FROM supplier",
    "bronze_jdbc_partitioned": _SUPPLIER_SQL,
    "bronze_jdbc_conf": _SUPPLIER_SQL,
    "bronze_mode_switch": _SUPPLIER_SQL,
    "bronze_rescued_fields": """
        SELECT s_suppkey, s_name,
               CASE WHEN s_suppkey % 2 <> 0 THEN '{"s_nationkey":"' || s_nationkey || '"}' END AS _rescued
        FROM supplier""",
    "bronze_ragged_csv": """
        SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(NULL AS VARCHAR) AS third,
               CASE WHEN s_suppkey % 2 = 1 THEN '{"_record":"' || s_suppkey || ',' || s_name || ',surplus"}' END AS _rescued
        FROM supplier
        UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), s_name, CASE WHEN s_suppkey % 2 = 1 THEN 'third' END, NULL FROM supplier""",
    "bronze_odd_paths": """
        SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, s_nationkey,
               CASE s_suppkey % 4 WHEN 0 THEN 'a*' WHEN 1 THEN 'ab' WHEN 2 THEN 'a b [1]{x}?' END AS area
        FROM supplier""",
    "bronze_nested_evolution": """
        SELECT s_suppkey AS id, s_name AS name,
               CASE WHEN s_suppkey % 2 = 0 OR s_suppkey % 3 <> 0 THEN s_nationkey END AS nation,
               CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey AS VARCHAR) END AS street,
               CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_nationkey AS VARCHAR) END AS rank,
               CAST(s_nationkey AS VARCHAR) AS n,
               CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey AS VARCHAR) END AS m,
               CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '{"key":' || s_suppkey || '}' END AS note,
               CASE WHEN s_suppkey % 6 = 3 THEN '{"who.at.nation":"none"}' END AS _rescued_data
        FROM supplier""",
    "bronze_many_headers": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey + c_custkey % 40 AS own
        FROM customer""",
    "medallion_rule_counts": """
        SELECT count(*) FILTER (c_custkey % 7 <> 0) AS passed, count(*) FILTER (c_custkey % 7 = 0) AS dropped
        FROM customer""",
    "medallion_rule_totals": """
        SELECT count(*) FILTER (c_custkey % 7 <> 0) AS passed, count(*) FILTER (c_custkey % 7 = 0) AS dropped
        FROM customer""",
    "clustered_curve": """
        SELECT count(*) AS lines,
               count(*) FILTER (l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01') AS of_date,
               count(*) FILTER (l_partkey <= 20) AS of_part, true AS date_skips, true AS part_skips
        FROM lineitem""",
    "medallion_clustered": """
        SELECT count(*) FILTER (c_custkey % 7 <> 0 AND c_nationkey < 5) AS customers, true AS skips_files
        FROM customer""",
    "bronze_source_switch": """
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, t.bronze_table
        FROM supplier CROSS JOIN (VALUES ('bronze_s3_raw_supplier'), ('bronze_jdbc_raw_supplier')) AS t(bronze_table)""",
    "clustered_write": """
        SELECT l_returnflag, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
        GROUP BY l_returnflag""",
    "medallion_e2e": """
        WITH deliveries AS (
          SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 20240115 AS c_changed,
                 CAST(NULL AS VARCHAR) AS c_remark
          FROM customer
          UNION ALL
          SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1000, c_mktsegment,
                 CASE WHEN c_custkey % 2 = 0 THEN 20240116 ELSE 20240114 END,
                 CASE WHEN c_custkey % 3 = 0 THEN 'checked' END
          FROM customer)
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment,
               c_changed, c_remark
        FROM deliveries
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY c_changed DESC) = 1""",
    "medallion_jdbc": """
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal + CASE WHEN s_nationkey < 12 THEN 1000 ELSE 0 END AS s_acctbal,
               TIMESTAMP '2024-02-01 12:30:00' + CASE WHEN s_nationkey < 12 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END
                 AS ingested_timestamp
        FROM supplier""",
}
