"""Hand-written edge rows for names, entities, types, terms, trees and joins."""

import random

import pytest
from pyspark.sql import functions as F

from lineloom.functions.names import is_csv_name, job_key, name_part, short_name
from lineloom.functions.text import WRITE_WORDS, mentions_any
from lineloom.operators import entities as E
from lineloom.operators import model, terms
from lineloom.operators.joins import keyed_join, measured_bytes, salted_join
from lineloom.operators.tree import folders_of, scripts_of, walk_tree
from lineloom.plans import inventory, lineage


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def entity_table(spark, keys, type_name="table"):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    return E.make_entity(df, type_name, qualified_name=F.col("k"), name=F.col("k"), attributes={"k": F.col("k")})


# -- names and predicates ----------------------------------------------------


def test_name_split(spark):
    df = spark.createDataFrame([("db.t",), ("db.t.x",), ("nodot",)], "name string")
    got = df.select(name_part("name", 0), name_part("name", 1)).collect()
    assert [tuple(r) for r in got] == [("db", "t"), ("db", "t"), ("nodot", None)]
    assert rows(inventory.split_names(df, "db")) == [("db", "t")]


def test_csv_after_the_first_character(spark):
    df = spark.createDataFrame([("csv_x",), ("xcsv",), ("a.csv",), ("a.CSV",)], "n string")
    assert [r.n for r in df.where(is_csv_name("n")).collect()] == ["xcsv", "a.csv"]
    files = df.select(F.concat(F.lit("lake://csv/"), "n").alias("qualified_name"))
    assert lineage.csv_assets(files).count() == 2


def test_write_words(spark):
    lines = ["CREATE TABLE", "created", "insert", "Spark.Write", "merge into", None]
    df = spark.createDataFrame([(v,) for v in lines], "v string")
    got = [r.v for r in df.where(mentions_any(F.col("v"), WRITE_WORDS)).collect()]
    assert got == ["CREATE TABLE", "Spark.Write", "merge into"]


def test_short_name_and_job_key(spark):
    df = spark.createDataFrame([("cat://d/db/Tab",)], "q string")
    assert df.select(short_name("q")).first()[0] == "tab"
    df = spark.createDataFrame([("/a/x",), ("/b/x",)], "p string")
    assert [r[0] for r in df.select(job_key("p", domain="d")).collect()] == [
        "cat://d/notebooks/a/x",
        "cat://d/notebooks/b/x",
    ]


# -- entities ----------------------------------------------------------------


def test_guid_is_stable(spark):
    one, two = (entity_table(spark, ["a", "b"]).repartition(n) for n in (1, 7))
    assert rows(one.select("guid")) == rows(two.select("guid"))


def test_columns_without_a_table_are_reported(spark):
    details = spark.createDataFrame(
        [("db", "t", "parquet", "/l", 1, 2**33)],
        "databaseName string, tableName string, tableFormat string, location string, numFiles long, sizeInBytes long",
    )
    tables = E.table_entities(details, domain="d")
    assert tables.first().attributes["size"] == str(2**33)
    columns = spark.createDataFrame(
        [("db", "t", "a", "int"), ("db", "gone", "b", "int")],
        "databaseName string, tableName string, colName string, dataType string",
    )
    built = E.column_entities(columns, tables, domain="d").collect()
    assert [(r.qualified_name, r.relationships[0].guid) for r in built] == [("cat://d/db/t#a", tables.first().guid)]
    keyed = columns.withColumn("key", F.concat(F.lit("cat://d/"), "databaseName", F.lit("/"), "tableName"))
    assert [r.colName for r in E.missing_entities(keyed, tables, {"key": "qualified_name"}).collect()] == ["b"]


def test_search_then_delete_leaves_nothing(spark):
    found = entity_table(spark, [f"host/Sales_{i}" for i in range(60)] + ["host/other"])
    assert E.search_entities(found, "SALES").count() == 60
    assert E.search_entities(found, "sales", "column").count() == 0
    assert E.search_entities(found, "table").count() == 61
    for left in (E.delete_by_search(found, "sales"), E.delete_entities(found, E.search_entities(found, "sales"))):
        assert [r.name for r in left.collect()] == ["host/other"]


def test_search_over_missing_values(spark):
    df = spark.createDataFrame([(None, "q1", "n", "g1"), ("t", "q2", None, "g2")], "type_name string, qualified_name string, name string, guid string")
    assert [r.guid for r in E.search_entities(df, "q2").collect()] == ["g2"]
    assert [r.guid for r in E.delete_by_search(df, "q2").collect()] == ["g1"]
    assert E.delete_by_search(df, "q", "t").count() == 1


UPDATES = "type_name string, qualified_name string, v string, at int"


def test_upsert_newest_wins_and_is_idempotent(spark):
    current = spark.createDataFrame([("t", "a", "old", 0), ("t", "b", "keep", 0)], UPDATES)
    updates = spark.createDataFrame([("t", "a", "new", 5), ("t", "c", "add", 2), ("t", "a", "older", 3)], UPDATES)
    once = E.upsert(current, updates, order=["at"])
    expected = [("t", "a", "new", 5), ("t", "b", "keep", 0), ("t", "c", "add", 2)]
    assert rows(once) == expected
    assert rows(E.upsert(once, updates, order=["at"])) == expected


def test_upsert_keeps_maps_and_arrays(spark):
    current = entity_table(spark, ["a", "b"])
    fresh = entity_table(spark, ["b", "c"]).withColumn("attributes", F.create_map(F.lit("k"), F.lit("new")))
    left = {r.qualified_name: r.attributes["k"] for r in E.upsert(current, fresh, order=["guid"]).collect()}
    assert left == {"a": "a", "b": "new", "c": "new"}


def test_latest_with_a_hot_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"))
    got = E.latest(df, ["k"], ["at"])
    assert got.count() == 6001
    assert got.where("k = -1").first().at == 8997


def test_entity_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "name string, v string")
    assert E.entity_json(df, ["name", "v"]).first().json == '{"name":"a","v":null}'


# -- types -------------------------------------------------------------------


def test_defaults_and_required(spark):
    jobs = spark.createDataFrame(
        [("job", "q1", {"job_type": "notebook", "extra": "x"}), ("job", "q2", {}), ("job", "q3", None), ("odd", "q4", {"a": "b"})],
        "type_name string, qualified_name string, attributes map<string,string>",
    )
    got = {r.qualified_name: r for r in model.check_types(jobs, model.type_table(spark)).collect()}
    assert got["q1"].attributes == {"job_type": "notebook", "notebook_path": None, "schedule": "adHoc", "extra": "x"}
    assert (got["q1"].missing, got["q2"].missing, got["q3"].missing) == ([], ["job_type"], ["job_type"])
    assert (got["q4"].known, got["q4"].attributes, got["q4"].missing) == (False, {"a": "b"}, [])


def test_types_are_replaced_and_deleted(spark):
    types = model.type_table(spark)
    newer = model.type_table(spark, [("column", ["DataSet"], [("data_type", "string", True)])])
    merged = E.upsert(types, newer, ["type_name"])
    assert {r.type_name: r.attributes for r in merged.collect()}["column"][0].required
    assert rows(model.delete_types(types, ["job", "column"]).select("type_name")) == [("table",)]
    assert model.untyped_entities(entity_table(spark, ["a"], "job"), model.delete_types(types, ["job"])).count() == 1
    relations = model.relation_table(spark)
    assert relations.first().child_cardinality == "SINGLE"
    assert model.broken_relations(relations, types).count() == 0
    assert model.broken_relations(relations, model.delete_types(types, ["column"])).count() == 1


def test_composition_faults(spark):
    links = spark.createDataFrame([("ok", "t1"), ("orphan", "gone"), ("two", "t1"), ("two", "t2"), ("half", "t1"), ("half", "gone")], "c string, p string")
    parents = spark.createDataFrame([("t1",), ("t2",)], "p string")
    assert rows(model.composition_faults(links, parents, "c", "p")) == [("orphan", 0), ("two", 2)]


def test_options_containers_and_cardinality(spark):
    types = {r.type_name: r for r in model.type_table(spark).collect()}
    assert types["table"].options == {"schemaElementAttribute": "columns"} and types["job"].options == {}
    relation = model.relation_table(spark).first()
    assert (relation.parent_container, relation.child_container) == (True, False)
    assert model.type_table(spark, []).count() == 0 == model.relation_table(spark, []).count()
    odd = model.type_table(spark, [("it's \\", [], [("a'b", "\\n'", True)], {"k'": "v"})]).first()
    assert (odd.type_name, odd.attributes[0].default, odd.options) == ("it's \\", "\\n'", {"k'": "v"})
    assert "Scan ExistingRDD" not in model.type_table(spark)._jdf.queryExecution().toString()
    links = spark.createDataFrame([("ok", "t1"), ("none", "gone"), ("two", "t1"), ("two", "t2")], "c string, p string")
    parents = spark.createDataFrame([("t1",), ("t2",)], "p string")
    one = lambda category, cardinality: model.relation_table(spark, [("r", category, "a", "x", "SET", True, "b", "y", cardinality, False)])
    found = lambda *rule: rows(model.relation_faults(links, one(*rule), "r", parents, "c", "p"))
    assert found("COMPOSITION", "SINGLE") == [("none", 0), ("two", 2)]
    assert found("COMPOSITION", "SET") == [("none", 0)] and found("ASSOCIATION", "SINGLE") == [("two", 2)]
    with pytest.raises(ValueError):
        model.relation_faults(links, one("COMPOSITION", "SINGLE"), "other", parents, "c", "p")


def test_processes_and_tables_share_one_table(spark):
    ends = F.array(F.struct(F.lit("file").alias("type_name"), F.col("k").alias("qualified_name"), F.lit("g").alias("guid")))
    df = spark.createDataFrame([("a",)], "k string")
    job = E.make_entity(df, "job", qualified_name=F.col("k"), name=F.col("k"), attributes={}, inputs=ends, outputs=ends)
    merged = E.upsert(entity_table(spark, ["a", "b"]), job.unionByName(entity_table(spark, ["b"])))
    assert sorted((r.type_name, r.qualified_name, r.inputs is not None) for r in merged.collect()) == [
        ("job", "a", True), ("table", "a", False), ("table", "b", False)
    ]


def test_upsert_refuses_two_new_rows_without_an_order(spark):
    new = entity_table(spark, ["a"])
    with pytest.raises(ValueError, match="more than one new row"):
        E.upsert(entity_table(spark, ["b"]), new.unionByName(new))


# -- terms -------------------------------------------------------------------


def test_assign_then_unassign(spark):
    tables = entity_table(spark, ["t1", "t2"])
    glossary = entity_table(spark, ["A@Glossary", "B@Glossary", "C@Glossary"], E.TERM)
    given = terms.assign_terms(tables, glossary, ["A", "B", "C", "Absent", "A"])
    assert given.count() == 6
    assert rows(terms.missing_terms(glossary, ["A", "Absent"])) == [("Absent@Glossary",)]
    one = given.limit(1).select("table_guid", "term_guid")
    assert terms.unassign_terms(given, one).count() == 5
    assert terms.unassign_terms(given, given).count() == 0


def test_assignments_from_meanings(spark):
    schema = "guid string, meanings array<struct<guid:string,relationship_guid:string>>"
    df = spark.createDataFrame([("t1", [("a", "r1"), ("b", "r2")]), ("t2", []), ("t3", None)], schema)
    assert rows(terms.assignments_of(df)) == [("t1", "a", "r1"), ("t1", "b", "r2")]


# -- tree --------------------------------------------------------------------

LISTING = "path string, object_type string, object_id string"


def reached_by_walking(listing, root):
    out, queue = [], [(root, 0)]
    while queue:
        folder, depth = queue.pop()
        for path, kind, _ in listing:
            if path.rsplit("/", 1)[0] == folder and kind in ("DIRECTORY", "NOTEBOOK"):
                out.append((path, depth + 1))
                if kind == "DIRECTORY":
                    queue.append((path, depth + 1))
    return sorted(out)


@pytest.mark.parametrize("bound", [0, 64 * 1024 * 1024])
@pytest.mark.parametrize("parts", [1, 6])
def test_tree_equals_walking(spark, parts, bound):
    rng = random.Random(11)
    listing, folders = [], ["/Shared"]
    for i in range(150):
        path = f"{rng.choice(folders)}/n{i}"
        kind = rng.choice(["DIRECTORY", "DIRECTORY", "NOTEBOOK", "LIBRARY"])
        listing.append((path, kind, str(i)))
        if kind != "NOTEBOOK":
            folders.append(path)
    listing += [("/Sharedx/no", "NOTEBOOK", "x"), ("/Shared/lost/deep/n", "NOTEBOOK", "y"), ("/Other/n", "DIRECTORY", "z")]
    df = spark.createDataFrame(listing, LISTING).repartition(parts)
    for root in ("/Shared", "/Shared/", "/Nowhere"):
        got = sorted((r.path, r.depth) for r in walk_tree(df, root, bound=bound).collect())
        assert got == reached_by_walking(listing, root.rstrip("/"))


def test_tree_kinds(spark):
    df = spark.createDataFrame([("/r/d", "DIRECTORY", "1"), ("/r/d/n", "NOTEBOOK", "2"), ("/r/d/l", "LIBRARY", "3"), ("/r/d/l/n", "NOTEBOOK", "4")], LISTING)
    reached = walk_tree(df, "/r")
    assert [r.path for r in scripts_of(reached).collect()] == ["/r/d/n"]
    assert [r.path for r in folders_of(reached).collect()] == ["/r/d"]


def test_tree_from_the_top(spark):
    df = spark.createDataFrame([("/a", "DIRECTORY", "1"), ("/a/n", "NOTEBOOK", "2"), ("/b/n", "NOTEBOOK", "3")], LISTING)
    assert sorted(r.path for r in walk_tree(df, "/").collect()) == ["/a", "/a/n"]


# -- joins -------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, how):
    left = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 600, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, ["k"], how)
    salted = salted_join(left, right, ["k"], how, ["id"])
    assert rows(salted.select(*plain.columns)) == rows(plain)
    assert rows(keyed_join(left, right, ["k"], how, ["id"], bound=0).select(*plain.columns)) == rows(plain)


def test_salting_spreads_a_hot_key(spark):
    left = spark.range(8000).select("id", F.lit(1).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(left, spark.range(3).select(F.col("id").alias("k")), ["k"], "inner", ["id"])
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 8000 and max(sizes) < 4000


def test_broadcast_only_what_fits(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(100).withColumnRenamed("id", "k")
    size = measured_bytes(right)
    assert size == 1600
    plan = lambda bound: keyed_join(left, right, ["k"], "inner", ["k"], bound=bound)._jdf.queryExecution().logical().toString()
    # Beyond the bound only the list of hot keys is sent to every task.
    assert plan(size).count("strategy=broadcast") == 1 and "strategy=merge" not in plan(size)
    assert "strategy=merge" in plan(size - 1)


def test_compressible_side_above_the_bound_is_not_broadcast(spark, tmp_path):
    """A side whose files are far smaller than its rows, under the default settings."""
    spark.range(200_000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 200).alias("v")).write.parquet(str(tmp_path / "r"))
    right = spark.read.parquet(str(tmp_path / "r"))
    left = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    joined = keyed_join(left, right, ["k"], "inner", ["id"], bound=1 << 20)
    assert joined.count() == 1000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    broadcasts = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert "SortMergeJoin" in plan and all("_salt" not in line.split("BuildRight")[0] for line in broadcasts)
