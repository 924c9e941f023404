"""Hot keys: a third of all rows under one key, joins that may not broadcast."""

import pytest
from pyspark.sql import functions as F

from lineloom.operators import entities as E
from lineloom.operators import model, terms
from lineloom.plans import lineage

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot(spark, column="k"):
    """A third of the rows have key 0; each row has an own number."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 900)
    return spark.range(0, ROWS, 1, 8).select("id", key.cast("string").alias(column), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def keys(spark, n=900):
    return spark.range(n).select(F.col("id").cast("string").alias("k"))


def as_entities(spark, n, type_name):
    return E.make_entity(keys(spark, n), type_name, qualified_name=F.col("k"), name=F.col("k"), attributes={})


def run(df):
    """Rows and whether the hot partition was split."""
    rows = df.collect()
    return rows, "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_lookup_and_misses(shuffled):
    known = as_entities(shuffled, 450, "t")
    found, split = run(E.lookup(hot(shuffled), known, {"k": "qualified_name"}, "t"))
    missed, missed_split = run(E.missing_entities(hot(shuffled), known, {"k": "qualified_name"}, "t"))
    assert len(found) + len(missed) == ROWS and len(found) == len({r.id for r in found})
    assert split and missed_split


def test_columns_of_one_wide_table(shuffled):
    columns = hot(shuffled, "tableName").select(
        F.lit("db").alias("databaseName"), "tableName", F.col("pad").alias("colName"), F.lit("int").alias("dataType")
    )
    details = keys(shuffled).select(
        F.lit("db").alias("databaseName"),
        F.col("k").alias("tableName"),
        *[F.lit(None).cast("string").alias(c) for c in ("tableFormat", "location", "numFiles", "sizeInBytes")],
    )
    built, split = run(E.column_entities(columns, E.table_entities(details, domain="d"), domain="d"))
    assert len(built) == ROWS and split


def test_one_source_read_by_a_third_of_the_scripts(shuffled):
    mapping = hot(shuffled, "source").select(F.col("pad").alias("path"), "source", F.lit("1").alias("target"))
    known = as_entities(shuffled, 900, E.FILE).unionByName(as_entities(shuffled, 900, E.TABLE))
    found, split = run(lineage.resolve_processes(mapping, known))
    assert len(found) == ROWS and split


def test_delete_and_unassign(shuffled):
    left, split = run(E.delete_entities(hot(shuffled, "guid"), keys(shuffled, 450).withColumnRenamed("k", "guid")))
    assert split and len(left) == sum(1 for i in range(ROWS) if i % 3 and i % 900 >= 450)
    held = hot(shuffled, "table_guid").withColumn("term_guid", F.lit("x"))
    pairs = keys(shuffled, 450).select(F.col("k").alias("table_guid"), F.lit("x").alias("term_guid"))
    rest, split = run(terms.unassign_terms(held, pairs))
    assert split and len(rest) == len(left)


def test_composition_with_a_hot_parent(shuffled):
    faults, split = run(model.composition_faults(hot(shuffled).drop("pad"), keys(shuffled, 899), "id", "k"))
    assert len(faults) == sum(1 for i in range(ROWS) if i % 3 and i % 900 == 899)
    assert split


def test_one_type_for_nearly_all_entities(shuffled):
    found = hot(shuffled, "qualified_name").select("qualified_name", F.lit(E.COLUMN).alias("type_name"))
    assert model.typed_entities(found, model.type_table(shuffled)).count() == ROWS
    assert model.untyped_entities(found, model.type_table(shuffled)).count() == 0


def test_upsert_with_a_hot_key_in_the_updates(shuffled):
    current = keys(shuffled, 1000).withColumn("id", F.lit(-1).cast("long")).withColumn("pad", F.lit("old"))
    got = E.upsert(current, hot(shuffled), ["k"], ["id"])
    rows = {r.k: r.id for r in got.collect()}
    assert len(rows) == got.count() == 1000
    newest = {"0": max(i for i in range(ROWS) if i % 3 == 0 or i % 900 == 0)}
    assert rows["0"] == newest["0"] and sum(v == -1 for v in rows.values()) == 1000 - 1 - sum(1 for k in range(1, 900) if k % 3)
