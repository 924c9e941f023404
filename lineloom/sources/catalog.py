"""Databases, tables, columns and table detail of the session's catalog.

Only the catalog itself is enumerated on the driver, where Spark keeps it, by a
bounded number of calls at a time; what is found is returned as DataFrames and
everything after that is set at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

TABLE_SCHEMA = "database string, tableName string"
COLUMN_SCHEMA = "databaseName string, tableName string, colName string, dataType string"
# Names and order of the detail columns.
DETAIL_COLUMNS = (
    "format",
    "id",
    "name",
    "description",
    "location",
    "createdAt",
    "lastModified",
    "partitionColumns",
    "numFiles",
    "sizeInBytes",
    "properties",
    "minReaderVersion",
    "minWriterVersion",
)
# The part of DESCRIBE … AS JSON that table detail is made from.
_DESCRIBED = (
    "table_name string, namespace array<string>, provider string, comment string, location string, "
    "created_time timestamp, partition_columns array<string>, table_properties map<string,string>"
)


# Calls to the catalog that are under way at once.
WORKERS = 16


def _each(spark: SparkSession, ask: Callable, items: Iterable) -> list:
    """`ask` of every item in order, some at a time; the first failure is raised.

    A call mostly waits for the metastore, and each has the caller's job
    properties.
    """
    with ThreadPoolExecutor(WORKERS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(ask), items))


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def table_names(spark: SparkSession, databases: list[str] | None = None) -> list[tuple[str, str]]:
    """(database, table) of every table; temporary views have no database and are left out."""
    names = [r.namespace for r in list_databases(spark).collect()] if databases is None else list(databases)
    listed = _each(spark, lambda n: spark.sql(f"SHOW TABLES IN {_quoted(n)}").collect(), names)
    return [(r.namespace, r.tableName) for rows in listed for r in rows if r.namespace]


def list_tables(spark: SparkSession, databases: list[str] | None = None, names=None) -> DataFrame:
    """(database, tableName) of every table, or of those named already."""
    rows = table_names(spark, databases) if names is None else names
    return nonempty(spark.createDataFrame(rows, TABLE_SCHEMA), "database")


def nonempty(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose column is neither NULL nor the empty string."""
    return rows.where(F.col(column) != "")


def schema_rows(database: str, table: str, df: DataFrame) -> list[tuple[str, str, str, str]]:
    """Column rows of one table, read from its schema (partition columns once).

    Spark reads char and varchar as string and keeps what was declared beside it.
    """
    declared = lambda f: (f.metadata or {}).get("__CHAR_VARCHAR_TYPE_STRING", f.dataType.simpleString())
    return [(database, table, f.name, declared(f)) for f in df.schema.fields]


def column_table(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(databaseName, tableName, colName, dataType) of tables given as unread DataFrames."""
    rows = [row for (database, table), df in tables.items() for row in schema_rows(database, table, df)]
    return spark.createDataFrame(rows, COLUMN_SCHEMA)


def list_columns(spark: SparkSession, databases: list[str] | None = None, names=None) -> DataFrame:
    """(databaseName, tableName, colName, dataType) of every table in the catalog."""
    names = table_names(spark, databases) if names is None else names
    # A table's schema is resolved where it is asked for, so that is done in the pool too.
    rows = _each(spark, lambda pair: schema_rows(*pair, spark.table(_quoted(*pair))), names)
    return spark.createDataFrame([row for found in rows for row in found], COLUMN_SCHEMA)


def existing_folders(spark: SparkSession, roots: list[str]) -> list[str]:
    """Those of the paths that are there."""
    conf, make = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    paths = [(r, make(r)) for r in roots]
    return [r for r, path in paths if path.getFileSystem(conf).exists(path)]


def file_listing(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(path, length, modificationTime) of all data files below the roots; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
    return files.select("path", "length", "modificationTime")


def folder_profile(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """(table, num_files, size_bytes) of a folder that holds one file or folder per table."""
    base = root.split("://", 1)[-1].rstrip("/")
    entry = F.regexp_extract("path", rf"\Q{base}\E/+([^/]+)", 1)
    files = file_listing(spark, [root]).withColumn(
        "table", F.when(F.endswith(entry, F.lit(suffix)), F.substring(entry, F.lit(1), F.length(entry) - len(suffix))).otherwise(entry)
    )
    return files.groupBy("table").agg(
        F.count(F.lit(1)).alias("num_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")
    )


def profile_locations(files: DataFrame, locations: DataFrame) -> DataFrame:
    """(location, numFiles, sizeInBytes, lastModified) of the files below each location.

    A file is joined with the folders above it by equality, whatever the depth
    of the location.
    """
    parts = F.split(F.regexp_replace("path", r"^file:/+", "file:/"), "/")
    # A location may be a file itself.
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    spread = files.select("length", "modificationTime", F.explode(above).alias("folder"))
    keys = locations.select("location", _plain("location").alias("folder")).distinct()
    return (
        spread.join(keys, "folder")
        .groupBy("location")
        .agg(
            F.count(F.lit(1)).alias("numFiles"),
            F.sum("length").alias("sizeInBytes"),
            F.max("modificationTime").alias("lastModified"),
        )
    )


def _plain(location: str):
    return F.rtrim(F.regexp_replace(location, r"^file:/+", "file:/"), F.lit("/"))


def table_detail(spark: SparkSession, databases: list[str] | None = None, names=None) -> DataFrame:
    """The 13 detail columns of every table that has a location.

    Sizes and file counts are long, times are timestamps and partition columns
    an array, so nothing is cut off. A table whose folder is gone has no files
    and no time of change.
    """
    names = table_names(spark, databases) if names is None else names
    describe = lambda pair: (*pair, spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(*pair)} AS JSON").first()[0])
    described = _each(spark, describe, names)
    parsed = (
        spark.createDataFrame(described, "database string, tableName string, json string")
        .withColumn("d", F.from_json("json", _DESCRIBED))
        .where("d.location IS NOT NULL")
        .select("database", "tableName", "d.*")
    )
    roots = existing_folders(spark, [r.location for r in parsed.select("location").distinct().collect()])
    if roots:
        profile = profile_locations(file_listing(spark, roots), parsed)
    else:
        profile = spark.createDataFrame([], "location string, numFiles long, sizeInBytes long, lastModified timestamp")
    properties = F.coalesce("table_properties", F.create_map().cast("map<string,string>"))
    detail = parsed.join(profile, "location", "left").select(
        F.lower("provider").alias("format"),
        F.element_at(properties, "id").alias("id"),
        F.concat_ws(".", "database", "tableName").alias("name"),
        F.col("comment").alias("description"),
        "location",
        F.col("created_time").alias("createdAt"),
        "lastModified",
        F.coalesce("partition_columns", F.array().cast("array<string>")).alias("partitionColumns"),
        F.coalesce("numFiles", F.lit(0).cast("long")).alias("numFiles"),
        F.coalesce("sizeInBytes", F.lit(0).cast("long")).alias("sizeInBytes"),
        F.to_json(properties).alias("properties"),
        F.element_at(properties, "delta.minReaderVersion").alias("minReaderVersion"),
        F.element_at(properties, "delta.minWriterVersion").alias("minWriterVersion"),
    )
    return detail.select(*DETAIL_COLUMNS)
