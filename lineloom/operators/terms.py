"""Glossary terms on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import GLOSSARY_SUFFIX, term_key
from .entities import TERM


def _term_guids(entities: DataFrame, terms: list[str], type_name: str) -> DataFrame:
    keys = sorted({t + GLOSSARY_SUFFIX for t in terms})
    return (
        entities.where((F.col("type_name") == type_name) & F.col("qualified_name").isin(keys))
        .groupBy(F.col("qualified_name").alias("term"))
        .agg(F.min("guid").alias("term_guid"))
    )


def assign_terms(tables: DataFrame, entities: DataFrame, terms: list[str], *, type_name: str = TERM) -> DataFrame:
    """Give every table every listed term: (table_guid, term_guid, relationship_guid).

    The caller writes the list of terms by hand, so a table is repeated once per
    listed term; the term's guid then comes from an equi-join with at most that
    many rows, which is why it may be broadcast. Terms that the catalog does not
    have give no row; `missing_terms` names them.
    """
    keys = sorted({t + GLOSSARY_SUFFIX for t in terms})
    wanted = tables.select(
        F.col("guid").alias("table_guid"), F.explode(F.array(*[F.lit(k) for k in keys])).alias("term")
    )
    known = F.broadcast(_term_guids(entities, terms, type_name))
    return wanted.join(known, "term").select("table_guid", "term_guid", relationship_guid().alias("relationship_guid"))


def missing_terms(entities: DataFrame, terms: list[str], *, type_name: str = TERM) -> DataFrame:
    """Listed terms the catalog does not have."""
    spark = entities.sparkSession
    listed = spark.createDataFrame([(t,) for t in sorted(set(terms))], "term string").select(term_key("term").alias("term"))
    return listed.join(_term_guids(entities, terms, type_name), "term", "left_anti")


def relationship_guid():
    return F.sha2(F.concat_ws("|", "table_guid", "term_guid"), 256)


def assignments_of(entities: DataFrame) -> DataFrame:
    """(table_guid, term_guid, relationship_guid) from entities with `meanings`."""
    return entities.select(F.col("guid").alias("table_guid"), F.explode("meanings").alias("m")).select(
        "table_guid", F.col("m.guid").alias("term_guid"), F.col("m.relationship_guid").alias("relationship_guid")
    )


def unassign_terms(assignments: DataFrame, pairs: DataFrame) -> DataFrame:
    """Assignments left after removing those of `pairs` (table_guid, term_guid).

    Only a table's own pairs are removed.
    """
    return assignments.join(pairs.select("table_guid", "term_guid"), ["table_guid", "term_guid"], "left_anti")
