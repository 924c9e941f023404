"""Catalog entities as a table: build, search, write, look up, delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.names import column_key, entity_guid, table_key
from ..session import materialize

# Default type names; every operator takes others.
TABLE, COLUMN, JOB, FILE, TERM = "table", "column", "job", "file", "glossary_term"

ENDS = "array<struct<type_name:string,qualified_name:string,guid:string>>"
REFERENCES = "array<struct<name:string,type_name:string,qualified_name:string,guid:string>>"


def make_entity(
    rows: DataFrame,
    type_name: str,
    *,
    qualified_name: Column,
    name: Column,
    attributes: dict[str, Column],
    relationships: Column | None = None,
    inputs: Column | None = None,
    outputs: Column | None = None,
) -> DataFrame:
    """Rows of the entity table, one per input row.

    All kinds share one schema; `inputs` and `outputs` are NULL but for processes.
    """
    pairs = [part for key, value in attributes.items() for part in (F.lit(key), value.cast("string"))]
    packed = F.create_map(*pairs) if pairs else F.create_map()
    related = F.array() if relationships is None else relationships
    return rows.select(
        F.lit(type_name).alias("type_name"),
        qualified_name.alias("qualified_name"),
        name.alias("name"),
        packed.cast("map<string,string>").alias("attributes"),
        related.cast(REFERENCES).alias("relationships"),
        (F.lit(None) if inputs is None else inputs).cast(ENDS).alias("inputs"),
        (F.lit(None) if outputs is None else outputs).cast(ENDS).alias("outputs"),
    ).withColumn("guid", entity_guid("type_name", "qualified_name"))


def table_entities(details: DataFrame, *, domain: str, scheme: str = "cat", type_name: str = TABLE) -> DataFrame:
    """From (databaseName, tableName, tableFormat, location, numFiles, sizeInBytes)."""
    return make_entity(
        details,
        type_name,
        qualified_name=table_key("databaseName", "tableName", domain=domain, scheme=scheme),
        name=F.col("tableName"),
        attributes={
            "format": F.col("tableFormat"),
            "location": F.col("location"),
            "num_files": F.col("numFiles"),
            "size": F.col("sizeInBytes"),
        },
    )


def column_entities(
    columns: DataFrame,
    tables: DataFrame,
    *,
    domain: str,
    scheme: str = "cat",
    type_name: str = COLUMN,
) -> DataFrame:
    """From (databaseName, tableName, colName, dataType); each column refers to its table.

    Columns whose table is not among `tables` (entities) are left out; see
    `missing_entities` for a report of those.
    """
    keyed = columns.withColumn("parent", table_key("databaseName", "tableName", domain=domain, scheme=scheme))
    parents = tables.select(
        F.col("qualified_name").alias("parent"), F.col("guid").alias("parent_guid"), F.col("type_name").alias("parent_type")
    )
    reference = F.struct(
        F.lit("table").alias("name"),
        F.col("parent_type").alias("type_name"),
        F.col("parent").alias("qualified_name"),
        F.col("parent_guid").alias("guid"),
    )
    return make_entity(
        keyed.join(parents, "parent"),
        type_name,
        qualified_name=column_key("databaseName", "tableName", "colName", domain=domain, scheme=scheme),
        name=F.col("colName"),
        attributes={"data_type": F.col("dataType")},
        relationships=F.array(reference),
    )


def matches_search(keyword: str, type_name: str | None = None) -> Column:
    """The search predicate: keyword in the name, key or type name, any case."""
    word = F.lit(keyword.lower())
    found = [F.contains(F.lower(c), word) for c in ("qualified_name", "name", "type_name")]
    hit = found[0] | found[1] | found[2]
    return hit if type_name is None else (F.col("type_name") == type_name) & hit


def search_entities(entities: DataFrame, keyword: str, type_name: str | None = None) -> DataFrame:
    return entities.where(matches_search(keyword, type_name))


def delete_by_search(entities: DataFrame, keyword: str, type_name: str | None = None) -> DataFrame:
    """What is left after removing every hit. The predicate is negated; no join."""
    return entities.where(~F.coalesce(matches_search(keyword, type_name), F.lit(False)))


def delete_entities(entities: DataFrame, hits: DataFrame) -> DataFrame:
    """What is left after removing the entities whose guid is in `hits`."""
    return entities.join(hits.select("guid"), "guid", "left_anti")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key; `order` should have no ties within a key.

    Combines before the shuffle, so a hot key stays small.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(newest.alias("row")).select(*keys, *[F.col("row")[c].alias(c) for c in rest])


def upsert(
    current: DataFrame,
    updates: DataFrame,
    keys: list[str] = ("type_name", "qualified_name"),
    order: list[str] | None = None,
) -> DataFrame:
    """Replace rows of `current` (unique by `keys`) by those of `updates`.

    The whole row is replaced. If `updates` may hold a key more than once,
    `order` says which row is newest; without it such a key is an error. The new
    rows are written once. `current` is not regrouped: the rows with a new
    version are dropped by an anti join and the new rows appended.
    """
    keys = list(keys)
    fresh = materialize(updates if order is None else latest(updates, keys, order), "fresh")
    if order is None:
        twice = fresh.groupBy(*keys).count().where("count > 1").select(*keys).first()
        if twice is not None:
            raise ValueError(f"more than one new row for {tuple(twice)}; say by `order` which is newest")
    kept = current.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh)


def lookup(rows: DataFrame, entities: DataFrame, on: dict[str, str], type_name: str | None = None) -> DataFrame:
    """Join each row with the entity whose column equals the row's; misses are left out.

    `on` maps columns of `rows` to columns of `entities`.
    """
    known = entities if type_name is None else entities.where(F.col("type_name") == type_name)
    known = known.withColumnsRenamed({theirs: ours for ours, theirs in on.items()})
    return rows.join(known, list(on), "inner")


def missing_entities(rows: DataFrame, entities: DataFrame, on: dict[str, str], type_name: str | None = None) -> DataFrame:
    """Rows whose lookup finds nothing."""
    known = entities if type_name is None else entities.where(F.col("type_name") == type_name)
    known = known.select(*[F.col(theirs).alias(ours) for ours, theirs in on.items()])
    return rows.join(known, list(on), "left_anti")


def entity_json(entities: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as one JSON object, NULL fields included."""
    return entities.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))
