"""Inventory of a catalog and the entities made from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.names import name_part
from ..operators.entities import column_entities, table_entities
from ..sources.catalog import list_columns, list_databases, list_tables, table_detail, table_names


@dataclass(frozen=True)
class Inventory:
    databases: DataFrame
    tables: DataFrame
    details: DataFrame
    columns: DataFrame

    def register(self, prefix: str = "") -> None:
        """Make the four tables temporary views."""
        for name in ("databases", "tables", "details", "columns"):
            getattr(self, name).createOrReplaceTempView(prefix + name)


def inventory(spark: SparkSession, databases: list[str] | None = None) -> Inventory:
    """The catalog is listed once; all parts speak of the same tables."""
    names = table_names(spark, databases)
    return Inventory(
        databases=list_databases(spark),
        tables=list_tables(spark, names=names),
        details=table_detail(spark, names=names),
        columns=list_columns(spark, names=names),
    )


def split_names(details: DataFrame, database: str | Column | None = None, extra: list[str | Column] = ()) -> DataFrame:
    """Distinct (databaseName, tableName, extra …) from `name`, of one database if given."""
    named = details
    if database is not None:
        named = named.where(name_part("name", 0) == database)
    return named.select(
        name_part("name", 0).alias("databaseName"), name_part("name", 1).alias("tableName"), *extra
    ).distinct()


def selected_tables(details: DataFrame, database: str) -> DataFrame:
    """Detail rows of one database in the form `table_entities` takes."""
    return split_names(
        details,
        database,
        [
            F.col("format").alias("tableFormat"),
            "description",
            "location",
            "createdAt",
            "partitionColumns",
            "numFiles",
            "sizeInBytes",
        ],
    )


def preview(rows: DataFrame, key: str | list[str], n: int = 10) -> DataFrame:
    """First rows by key."""
    return rows.orderBy(*([key] if isinstance(key, str) else key)).limit(n)


def build_entities(found: Inventory, database: str, *, domain: str, scheme: str = "cat") -> DataFrame:
    """Table and column entities of one database."""
    tables = table_entities(selected_tables(found.details, database), domain=domain, scheme=scheme)
    columns = column_entities(
        found.columns.where(F.col("databaseName") == database), tables, domain=domain, scheme=scheme
    )
    return tables.unionByName(columns)
