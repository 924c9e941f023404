"""Script text and path listings."""

from __future__ import annotations

import itertools
import os
import re
import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import lines_of

LISTING_SCHEMA = (
    "objects array<struct<object_id:string,object_type:string,path:string,language:string>>"
)


def _text(spark: SparkSession, root: str, pattern: str | None):
    reader = spark.read.option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _file_path():
    """The file's path as it was written; Spark gives it with percent escapes.

    A plus stands for itself there, which `url_decode` would read as a space.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def read_scripts(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, text), one row per file in any depth. For files that fit a row."""
    files = _text(spark, root, pattern).text(root, wholetext=True)
    return files.select(_file_path().alias("path"), F.col("value").alias("text"))


def read_script_lines(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(path, text), one row per line. Large files are split between tasks."""
    lines = _text(spark, root, pattern).text(root)
    return lines.select(_file_path().alias("path"), F.col("value").alias("text"))


def write_scripts(scripts: DataFrame, keys: list[str], text: str, root: str) -> None:
    """One text file for each value of the keys, below folders `key=value` for the first of them.

    Rows of equal keys are the lines of one file. Below a folder that tasks can open as it
    is, they write the files themselves: Spark's writer makes a folder for every value of
    the last key and commits each file by renaming it, which costs many times the writing.
    File systems that only Spark reaches get Spark's writer. Values are escaped by percent
    signs both ways; `key_value` reads them from a path.
    """
    rows = scripts.select(*[F.col(k).cast("string").alias(k) for k in keys], F.col(text).cast("binary").alias("value"))
    folder = local_folder(root)
    if folder is None:
        rows = rows.repartition(*keys).withColumn("value", F.col("value").cast("string"))
        rows.write.partitionBy(*keys).text(root)
        return
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "value")
    os.makedirs(folder)
    rows.foreachPartition(_file_writer(keys, folder))


def local_folder(root: str) -> str | None:
    """The folder as the operating system names it, if its path is one of the local file system."""
    found = re.fullmatch(r"(?s)(?:file:(?://(?=/))?)?(/.*)", root)
    return found[1] if found else None


def _file_writer(keys: list[str], folder: str):
    """The function of a task. Being local, it is sent by value: executors need not have this package."""

    def segment(key, value):
        return key if value is None else f"{key}={quote(value, safe='')}"

    def write(rows):
        made = None
        for values, group in itertools.groupby(rows, lambda row: tuple(row[k] for k in keys)):
            *above, name = map(segment, keys, values)
            inside = os.path.join(folder, *above)
            if inside != made:
                os.makedirs(inside, exist_ok=True)
                made = inside
            # Another attempt of the task may write the same file: it gets its name when it is whole.
            part = os.path.join(inside, f".{uuid.uuid4().hex}")
            with open(part, "wb") as out:
                for row in group:
                    out.write(bytes(row["value"] or b"") + b"\n")
            os.replace(part, os.path.join(inside, f"{name}.txt"))

    return write


def key_value(path: str, key: str) -> Column:
    """A key's value in the paths of files that `write_scripts` wrote; NULL if it had none."""
    found = F.regexp_extract(path, rf"(?s)/\Q{key}=\E([^/]*?)(?:\.txt)?(?:/|\z)", 1)
    inside = F.contains(F.col(path), F.lit(f"/{key}="))
    return F.when(inside, F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))))


# Scheme and authority of a path.
_PREFIX = r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?/*"


def listed_paths(scripts: DataFrame, export_root: str, prefix: str = "") -> DataFrame:
    """Turn file paths below an export folder into the listing's paths.

    The export root gives way to `prefix` and the file extension goes. A path
    outside the root fails the query.
    """
    base = re.sub(rf"\A{_PREFIX}", "", export_root).rstrip("/").replace("\\E", r"\E\\E\Q")
    inside = F.regexp_extract("path", rf"(?s)\A{_PREFIX}\Q{base}\E(/.*?)(\.[^./]*)?\z", 1)
    stray = F.raise_error(F.concat(F.lit(f"not below {export_root}: "), F.col("path")))
    return scripts.withColumn("path", F.when(inside == "", stray).otherwise(F.concat(F.lit(prefix), inside)))


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Redistribute a plain scan that has fewer tasks than the cluster has cores.

    One file of one row group is read by one task, whatever its size. A scan of
    many files is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, *keys)


def number_lines(scripts: DataFrame) -> DataFrame:
    """(path, pos, line) from whole texts; positions count from 0 without gaps."""
    return scripts.select("path", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))


def read_listing(spark: SparkSession, root: str, *, multiline: bool = False, on_fault: str = "fail") -> DataFrame:
    """Objects of saved listing bodies: one JSON document per line, or per file with `multiline`."""
    reader = spark.read.option("columnNameOfCorruptRecord", "corrupt").option("multiLine", str(multiline).lower())
    bodies = reader.schema(f"{LISTING_SCHEMA}, {_FAULT_FIELDS}").json(root)
    return _objects(bodies, F.col("corrupt"), on_fault)


def parse_listing(bodies: DataFrame, column: str = "body", *, on_fault: str = "fail") -> DataFrame:
    """Objects of listing bodies held as JSON strings, indented or not.

    A body that is no JSON object, or is a service's error, fails the query;
    with `on_fault` = "skip" it gives no row, and `listing_faults` reports it.
    """
    return _objects(_parsed(bodies, column), F.col("corrupt"), on_fault)


def listing_faults(bodies: DataFrame, column: str = "body") -> DataFrame:
    """(body, fault): bodies that `parse_listing` cannot take, and why."""
    found = _parsed(bodies, column)
    return found.withColumn("fault", _fault(F.col("corrupt"))).where("fault IS NOT NULL").select("body", "fault")


_FAULT_FIELDS = "error_code string, message string, corrupt string"


def _parsed(bodies: DataFrame, column: str) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    parsed = F.from_json("body", f"{LISTING_SCHEMA}, {_FAULT_FIELDS}", options)
    found = bodies.select(F.col(column).alias("body")).withColumn("b", parsed)
    corrupt = F.when(F.col("body").isNull(), "no body").otherwise(F.col("b.corrupt"))
    return found.select("body", "b.objects", "b.error_code", "b.message", corrupt.alias("corrupt"))


def _fault(corrupt):
    error = F.concat(F.lit("error "), "error_code", F.coalesce(F.concat(F.lit(": "), "message"), F.lit("")))
    return F.when(corrupt.isNotNull(), F.concat(F.lit("malformed: "), F.left(corrupt, F.lit(200)))).otherwise(error)


def _objects(bodies: DataFrame, corrupt, on_fault: str) -> DataFrame:
    fault = _fault(corrupt)
    stop = F.raise_error(F.concat(F.lit("listing body, "), fault)) if on_fault == "fail" else F.lit(None)
    return unpack_objects(bodies.select(F.when(fault.isNotNull(), stop).otherwise(F.col("objects")).alias("objects")))


def unpack_objects(bodies: DataFrame) -> DataFrame:
    # An outer explode, as a plain one has the optimizer add a filter on the
    # array's size, which would parse each body a second time.
    return bodies.select(F.explode_outer("objects").alias("o")).where("o IS NOT NULL").select("o.*")


def listing_objects(bodies: DataFrame, column: str = "body", *, on_fault: str = "fail") -> DataFrame:
    """(object): each object of the bodies with all its fields, as VARIANT.

    Faults are treated as by `parse_listing`.
    """
    found = bodies.select(F.col(column).alias("body")).withColumn("v", F.try_parse_json("body"))
    field = lambda path, kind: F.try_variant_get("v", path, kind)
    # A body that is no JSON object has no objects, and one of a service's error has its code.
    broken = F.col("body").isNull() | F.col("v").isNull() | ~F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    text = F.coalesce(F.left(F.col("body"), F.lit(200)), F.lit("no body"))
    error = F.concat(F.lit("error "), field("$.error_code", "string"), F.coalesce(F.concat(F.lit(": "), field("$.message", "string")), F.lit("")))
    fault = F.when(broken, F.concat(F.lit("malformed: "), text)).otherwise(error)
    stop = F.raise_error(F.concat(F.lit("listing body, "), fault)) if on_fault == "fail" else F.lit(None)
    objects = F.when(fault.isNotNull(), stop).otherwise(field("$.objects", "array<variant>"))
    # An outer explode, as in `unpack_objects`.
    return found.select(F.explode_outer(objects).alias("object")).where("object IS NOT NULL")


def merged_schema(objects: DataFrame, column: str = "object") -> T.StructType:
    """The fields of all objects: a type that holds all values of a field, or VARIANT where none does."""
    told = objects.agg(F.schema_of_variant_agg(column)).first()[0]
    if not told or not told.startswith("OBJECT<"):
        return T.StructType()
    return _struct(re.sub(r"\bOBJECT<>", "VARIANT", told))


def _struct(told: str) -> T.StructType:
    kinds = re.sub(r"(?<![`\w])OBJECT<", "STRUCT<", told)
    return T.StructType.fromDDL(f"root {kinds}")["root"].dataType


def parse_listing_all(bodies: DataFrame, column: str = "body", *, on_fault: str = "fail") -> DataFrame:
    """The objects of listing bodies with every field that any of them has.

    Nested objects become columns named by their path with dots. A field that an
    object lacks is NULL. The bodies are parsed twice: once for the fields.
    """
    objects = listing_objects(bodies, column, on_fault=on_fault)
    columns = []
    for path, kind in _leaves(merged_schema(objects)):
        value = F.col("object")
        for name in path:
            value = _field(value, name)
        columns.append(F.try_variant_get(value, "$", _kind(kind)).alias(".".join(path)))
    return objects.select(*columns)


def _field(value: Column, name: str) -> Column:
    if "'" not in name and "\\" not in name:
        return F.try_variant_get(value, f"$['{name}']", "variant")
    # A path has no way to write such a name.
    return F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(name))


def _kind(kind: T.DataType) -> str:
    # Fields that are only ever null have no type of their own.
    return "string" if isinstance(kind, T.NullType) else kind.simpleString()


def _leaves(fields: T.StructType, path: tuple = ()):
    for f in fields.fields:
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, here)
        else:
            yield here, f.dataType
