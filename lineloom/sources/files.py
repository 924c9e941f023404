"""Files the jobs leave for each other: lineage map, id lists, entity snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAP_SCHEMA = "notebook string, source string, target string"


# How a NULL is written. No written value equals it, as a backslash of a value is doubled.
NULL_MARK = "\\N"
_ESCAPED = (("\n", "n"), ("\r", "r"), (",", "c"))
_CSV = {
    "header": "true",
    "quoteAll": "true",
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _escape(value: Column, marks=_ESCAPED) -> Column:
    """The value on one line: backslashes doubled, marks as backslash and letter."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for mark, letter in marks:
        out = F.replace(out, F.lit(mark), F.lit("\\" + letter))
    return out


def _unescape(value: Column, marks=_ESCAPED) -> Column:
    def part(text: Column) -> Column:
        for mark, letter in marks:
            text = F.replace(text, F.lit("\\" + letter), F.lit(mark))
        return text

    # Between doubled backslashes a backslash always opens a mark.
    return F.array_join(F.transform(F.split(value, r"\\\\", -1), part), "\\")


def write_map(mapping: DataFrame, path: str) -> None:
    """Lineage map as CSV with the header notebook,source,target.

    Every value is read back as it was, NULL and the empty text, outer blanks
    and line ends included. Line ends are escaped, so large files stay splittable.
    """
    columns = [_escape(F.col(c), _ESCAPED[:2]).alias(n) for c, n in (("path", "notebook"), ("source",) * 2, ("target",) * 2)]
    mapping.select(*columns).write.options(**_CSV).mode("overwrite").csv(path)


# A map as other programs write it: quoted where needed, nothing for NULL, no escapes.
_PLAIN = {**_CSV, "nullValue": "", "multiLine": "true"}


def read_map(spark: SparkSession, path: str, *, escaped: bool = True) -> DataFrame:
    """(path, source, target) of a map that `write_map` wrote.

    With `escaped` off it is a CSV of another writer: backslashes are themselves,
    values may hold line ends inside quotes, and a cell without anything is NULL.
    """
    if not escaped:
        return spark.read.options(**_PLAIN).schema(MAP_SCHEMA).csv(path).withColumnRenamed("notebook", "path")
    rows = spark.read.options(**_CSV).schema(MAP_SCHEMA).csv(path).withColumnRenamed("notebook", "path")
    return rows.select(*[_unescape(F.col(c), _ESCAPED[:2]).alias(c) for c in rows.columns])


def write_ids(rows: DataFrame, columns: list[str], path: str) -> None:
    """One line per row; several columns are joined by a comma.

    An id without comma, backslash and line end stands there as it is.
    """
    parts = [F.coalesce(_escape(F.col(c).cast("string")), F.lit(NULL_MARK)) for c in columns]
    rows.select(F.concat_ws(",", *parts).alias("value")).write.mode("overwrite").text(path)


def read_ids(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Lines of an id list, split at commas into the named columns."""
    parts = F.split("value", ",", -1)
    raw = [F.get(parts, F.lit(i)) for i in range(len(columns))]
    found = [F.when(r != NULL_MARK, _unescape(r)).alias(c) for r, c in zip(raw, columns)]
    return spark.read.text(path).select(*found)


def write_entities(entities: DataFrame, path: str) -> None:
    """A new snapshot of the entity table; `path` must not be one being read.

    One folder per type, so that a search or lookup of one type reads no other.
    """
    entities.write.mode("errorifexists").partitionBy("type_name").parquet(path)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.parquet(path)
    return found.withColumn("type_name", F.col("type_name").cast("string"))
