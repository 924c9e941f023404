"""Inputs derived from the given tables, the same rows the SQL side derives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lineloom.functions.names import entity_guid
from lineloom.operators.entities import FILE, TABLE, make_entity
from lineloom.sources.scripts import spread

# These words occur in the given documents.
WORDS = ("the ", "license")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a script (path, text)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id")
    path = F.concat(F.lit("/Shared/"), "lang", F.lit("/"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"))
    return docs.select(path.alias("path"), "text")


def asset_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Third label from the right of each page's host, as a table name."""
    labels = F.split(F.split_part("url", F.lit("/"), F.lit(3)), "[.]")
    names = table(spark, sf_dir, "pages").select(F.try_element_at(labels, F.lit(-3)).alias("name"))
    names = names.where("name IS NOT NULL").distinct()
    return names.select("name", F.concat(F.lit("cat://test/t/"), "name").alias("qualified_name"))


def asset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local link targets, as file names."""
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"), "page_id")
    links = F.regexp_extract_all(F.lower("html"), F.lit('href="/([^"/]+)"'), F.lit(1))
    names = pages.select(F.explode(links).alias("name")).distinct()
    return names.select("name", F.concat(F.lit("cat://test/f/"), "name").alias("qualified_name"))


def asset_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both asset lists as entities; tables of seven characters are left uncatalogued."""
    tables = asset_tables(spark, sf_dir).where(F.length("name") != 7).withColumn("type_name", F.lit(TABLE))
    both = asset_files(spark, sf_dir).withColumn("type_name", F.lit(FILE)).unionByName(tables)
    return both.withColumn("guid", entity_guid("type_name", "qualified_name"))


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_entity(
        table(spark, sf_dir, "customer"),
        "customer",
        qualified_name=F.concat(F.lit("cat://test/c/"), F.col("c_custkey").cast("string")),
        name=F.col("c_name"),
        attributes={"segment": F.col("c_mktsegment")},
    )


def nation_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return make_entity(
        table(spark, sf_dir, "nation"),
        "nation",
        qualified_name=F.concat(F.lit("cat://test/n/"), F.col("n_nationkey").cast("string")),
        name=F.col("n_name"),
        attributes={},
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, object_type, object_id): documents in folders; src7 is no folder but a repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    lang = F.concat(F.lit("/Shared/"), "lang")
    folder = F.concat(lang, F.lit("/"), "source")
    kind = F.when(F.col("source") == "src7", "REPO").otherwise("DIRECTORY")
    doc_kind = F.when(F.col("doc_id") % 10 == 0, "LIBRARY").otherwise("NOTEBOOK")
    doc_id = F.col("doc_id").cast("string")
    top = docs.select(lang.alias("path"), F.lit("DIRECTORY").alias("object_type"), F.lit("").alias("object_id")).distinct()
    mid = docs.select(folder.alias("path"), kind.alias("object_type"), F.lit("").alias("object_id")).distinct()
    leaf = docs.select(
        F.concat(folder, F.lit("/doc_"), doc_id).alias("path"), doc_kind.alias("object_type"), doc_id.alias("object_id")
    )
    return top.unionByName(mid).unionByName(leaf)
