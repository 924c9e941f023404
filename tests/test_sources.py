"""Catalog inventory, script files, listings and round trips on temporary data."""

import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lineloom.operators import entities as E
from lineloom.plans import inventory as inv
from lineloom.plans import lineage
from lineloom.session import drop_scratch, materialize, scratch_root, tune
from lineloom.sources import catalog, files
from lineloom.sources import scripts as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def databases(spark):
    spark.sql("CREATE DATABASE sales")
    spark.sql("CREATE TABLE sales.plain (a INT, b STRING COMMENT 'x') USING parquet COMMENT 'about'")
    spark.sql("INSERT INTO sales.plain VALUES (1, 'x')")
    spark.sql("INSERT INTO sales.plain VALUES (2, 'y')")
    spark.sql(
        "CREATE TABLE sales.parted (a INT, p STRING) USING parquet PARTITIONED BY (p) "
        "TBLPROPERTIES ('delta.minReaderVersion'='1')"
    )
    spark.sql("INSERT INTO sales.parted VALUES (1, 'u'), (2, 'v'), (3, 'w')")
    spark.sql("CREATE TABLE sales.empty (a INT) USING parquet")
    spark.sql("CREATE VIEW sales.seen AS SELECT a FROM sales.plain")
    spark.range(1).createOrReplaceTempView("only_temporary")
    yield ["sales"]
    spark.sql("DROP DATABASE sales CASCADE")
    spark.catalog.dropTempView("only_temporary")


def test_tables(spark, databases):
    assert ("sales",) in rows(catalog.list_databases(spark))
    expected = [("sales", "empty"), ("sales", "parted"), ("sales", "plain"), ("sales", "seen")]
    assert rows(catalog.list_tables(spark, databases)) == expected
    assert set(expected) <= set(rows(catalog.list_tables(spark)))
    assert "only_temporary" not in {r.tableName for r in catalog.list_tables(spark).collect()}


def test_partition_columns_come_once(spark, databases):
    got = [r[1:] for r in rows(catalog.list_columns(spark, databases)) if r[1] == "parted"]
    assert got == [("parted", "a", "int"), ("parted", "p", "string")]


def test_detail(spark, databases):
    details = catalog.table_detail(spark, databases)
    assert tuple(details.columns) == catalog.DETAIL_COLUMNS
    got = {r.name: r for r in details.collect()}
    assert set(got) == {"sales.plain", "sales.parted", "sales.empty"}
    plain, parted, empty = (got[f"sales.{n}"] for n in ("plain", "parted", "empty"))
    assert (plain.format, plain.description, plain.numFiles) == ("parquet", "about", 2)
    assert plain.sizeInBytes > 0 and plain.lastModified is not None and plain.createdAt is not None
    assert (parted.partitionColumns, parted.numFiles, parted.minReaderVersion) == (["p"], 3, "1")
    assert (empty.numFiles, empty.sizeInBytes, empty.partitionColumns) == (0, 0, [])
    assert dict(details.dtypes)["sizeInBytes"] == "bigint"


def test_inventory_to_entities(spark, databases):
    found = inv.inventory(spark, databases)
    found.register("t_")
    assert spark.table("t_columns").count() == found.columns.count()
    built = inv.build_entities(found, "sales", domain="d")
    keys = {r.qualified_name for r in built.collect()}
    assert {"cat://d/sales/plain", "cat://d/sales/plain#b", "cat://d/sales/parted#p"} <= keys
    assert not any("seen" in k for k in keys)  # a view has no files and no detail
    assert inv.preview(found.columns, ["tableName", "colName"], 2).count() == 2


def test_nothing_to_list(spark):
    assert catalog.list_tables(spark, []).count() == 0
    assert catalog.table_detail(spark, []).count() == 0


def test_large_sizes_stay_whole(spark):
    df = spark.createDataFrame([("/w/t/f1", 2**31), ("/w/t/p=1/f2", 5)], "path string, length long")
    df = df.withColumn("modificationTime", F.current_timestamp())
    where = spark.createDataFrame([("/w/t/",), ("/w/x",)], "location string")
    got = catalog.profile_locations(df, where).select("location", "numFiles", "sizeInBytes")
    assert rows(got) == [("/w/t/", 2, 2**31 + 5)]


def test_folder_profile_of_files_and_folders(spark, tmp_path):
    spark.range(300).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "one"))
    got = {r.table: r.num_files for r in catalog.folder_profile(spark, str(tmp_path)).collect()}
    assert got == {"many": 3, "one": 1}


def test_nonempty(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "v string")
    assert rows(catalog.nonempty(df, "v")) == [("a",)]


@pytest.fixture
def script_folder(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "etl.py").write_bytes(b"a\r\nb\n\nc")
    (tmp_path / "a" / "b" / "etl.sql").write_bytes(b"INSERT into tab \nfrom in.csv\n")
    (tmp_path / "none.py").write_bytes(b"")
    return str(tmp_path)


def test_lines_are_those_of_the_line_source(spark, script_folder):
    numbered = S.number_lines(S.read_scripts(spark, script_folder))
    by_line = S.read_script_lines(spark, script_folder)
    assert rows(numbered.select("path", "line")) == rows(by_line)
    etl = [r for r in rows(numbered) if r[0].endswith("etl.py")]
    assert [r[1:] for r in etl] == [(0, "a"), (1, "b"), (2, ""), (3, "c")]
    again = spark.createDataFrame([("p", "a\r\nb\n\nc\n"), ("q", "x\ry")], "path string, text string")
    assert [r[1:] for r in rows(S.number_lines(again))] == [(0, "a"), (1, "b"), (2, ""), (3, "c"), (0, "x"), (1, "y")]


def test_pattern_of_files(spark, script_folder):
    # The file source gives no row for a file without bytes.
    assert S.read_scripts(spark, script_folder, "*.py").count() == 1
    assert {r.path.rsplit("/", 1)[1] for r in S.read_script_lines(spark, script_folder, "*.sql").collect()} == {"etl.sql"}


def test_lineage_from_files_both_ways(spark, script_folder):
    tables = spark.createDataFrame([("tab", "T")], "name string, qualified_name string")
    sources = spark.createDataFrame([("in.csv", "F")], "name string, qualified_name string")
    whole = lineage.lineage_map(S.read_scripts(spark, script_folder), sources, tables)
    lines = lineage.lineage_map(S.read_script_lines(spark, script_folder), sources, tables, whole_texts=False)
    assert [r[1:] for r in rows(whole)] == [("F", "T")]
    assert rows(whole) == rows(lines)


def test_export_paths_become_listing_paths(spark, script_folder):
    got = S.listed_paths(S.read_scripts(spark, script_folder), script_folder, "/Shared")
    assert {r.path for r in got.collect()} == {"/Shared/a/etl", "/Shared/a/b/etl"}
    odd = spark.createDataFrame([("dbfs:/x/a.b/c",), ("/x/c.d.py",)], "path string")
    assert [r.path for r in S.listed_paths(odd, "/x/").collect()] == ["/a.b/c", "/c.d"]


@pytest.mark.parametrize("bound", [0, 2**26])
def test_only_reached_scripts_are_scanned(spark, script_folder, bound):
    listing = spark.createDataFrame(
        [("/Shared/a", "DIRECTORY"), ("/Shared/a/b", "REPO"), ("/Shared/a/b/etl", "NOTEBOOK"), ("/Shared/a/etl", "NOTEBOOK")],
        "path string, object_type string",
    )
    known = spark.createDataFrame([("tab", "T")], "name string, qualified_name string")
    texts = S.listed_paths(S.read_scripts(spark, script_folder), script_folder, "/Shared")
    scan = lambda rows: lineage.scan_lineage(rows, "/Shared", texts, known, known, words=["b", "into"], bound=bound)
    assert rows(scan(listing)) == [("/Shared/a/etl", None, None)]
    folders = listing.withColumn("object_type", F.regexp_replace("object_type", "REPO", "DIRECTORY"))
    assert rows(scan(folders)) == [("/Shared/a/b/etl", "T", "T"), ("/Shared/a/etl", None, None)]


def test_spread_only_where_needed(spark):
    few, many = spark.range(0, 100, 1, 2), spark.range(0, 100, 1, 20)
    assert S.spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert S.spread(many, "id") is many


def test_listing(spark, tmp_path):
    bodies = [
        {"objects": [{"object_id": "1", "object_type": "DIRECTORY", "path": "/a"}, {"object_id": "2", "object_type": "NOTEBOOK", "path": "/n", "language": "SQL"}]},
        {},
        {"objects": []},
    ]
    (tmp_path / "l.json").write_text("\n".join(json.dumps(b) for b in bodies))
    expected = sorted([("1", "DIRECTORY", "/a", None), ("2", "NOTEBOOK", "/n", "SQL")], key=repr)
    assert rows(S.read_listing(spark, str(tmp_path))) == expected
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string")
    assert rows(S.parse_listing(df)) == expected


def test_map_round_trip(spark, tmp_path):
    mapping = spark.createDataFrame([("/a,b", "s", None), ("/c", None, 't"q')], "path string, source string, target string")
    files.write_map(mapping, str(tmp_path / "m"))
    assert rows(files.read_map(spark, str(tmp_path / "m"))) == rows(mapping)


def test_id_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("g1", "r1"), ("g2", "r2")], "guid string, rel string")
    files.write_ids(df, ["guid"], str(tmp_path / "one"))
    assert rows(files.read_ids(spark, str(tmp_path / "one"), ["guid"])) == [("g1",), ("g2",)]
    files.write_ids(df, ["guid", "rel"], str(tmp_path / "two"))
    assert rows(files.read_ids(spark, str(tmp_path / "two"), ["guid", "rel"])) == rows(df)


def test_entity_snapshot(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "k string")
    made = E.make_entity(df, "t", qualified_name=F.col("k"), name=F.col("k"), attributes={"x": F.lit(1)})
    files.write_entities(made, str(tmp_path / "v1"))
    again = files.read_entities(spark, str(tmp_path / "v1"))
    assert again.first().attributes == {"x": "1"} and sorted(again.dtypes) == sorted(made.dtypes)
    files.write_entities(made.withColumn("type_name", F.lit("u")).unionByName(made), str(tmp_path / "v2"))
    hits = E.search_entities(files.read_entities(spark, str(tmp_path / "v2")), "a", "t")
    assert hits.count() == 1
    assert "PartitionFilters: [isnotnull(type_name" in hits._jdf.queryExecution().toString()


def test_scratch_is_where_the_session_says(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    kept = materialize(spark.range(5), "five")
    assert kept.count() == 5 and f"{scratch_root(spark)}/five-" in kept.inputFiles()[0]
    assert tune(spark).conf.get("spark.sql.adaptive.enabled") == "true"


def test_only_written_tables_are_dropped(spark, tmp_path):
    kept = tmp_path / "kept"
    spark.range(3).write.parquet(str(kept))
    folder = Path(materialize(spark.range(3), "three").inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    assert drop_scratch(spark) >= 1 and drop_scratch(spark) == 0
    assert kept.exists() and not folder.exists()


def test_edges_and_jobs(spark):
    mapping = spark.createDataFrame(
        [("/e/a", "F", "T"), ("/e/b", "F", None), ("/e/c", "gone", "T"), ("/x/a", "F", "T")],
        "path string, source string, target string",
    )
    made = spark.createDataFrame([("file", "F", "gF"), ("table", "T", "gT"), ("table", "F", "wrong")], "type_name string, qualified_name string, guid string")
    found = lineage.resolve_processes(mapping, made)
    edges = rows(lineage.lineage_edges(found, domain="d"))
    assert edges == [
        ("F", "cat://d/notebooks/e/a", "input"),
        ("F", "cat://d/notebooks/x/a", "input"),
        ("cat://d/notebooks/e/a", "T", "output"),
        ("cat://d/notebooks/x/a", "T", "output"),
    ]
    jobs = lineage.job_entities(found, domain="d").collect()
    assert len({j.guid for j in jobs}) == 2
    assert all(j.inputs[0].guid == "gF" and j.outputs[0].guid == "gT" and j.attributes["job_type"] == "notebook" for j in jobs)


# -- paths, bodies and values that are easily lost -------------------------------


ODD_NAMES = ["My Notebook", "a+b", "100%", "50%20off", "Übersicht ß", "dots.in.name", "semi;colon", "hash#tag", "quest?ion"]


@pytest.mark.parametrize("root", ["plain", "root with space", "r+%41"])
def test_script_paths_are_the_names_written(spark, tmp_path, root):
    folder = tmp_path / root / "deep er"
    folder.mkdir(parents=True)
    for i, name in enumerate(ODD_NAMES):
        (folder / f"{name}.py").write_text(f"line {i}")
    base = str(tmp_path / root)
    wanted = sorted((f"/Shared/deep er/{n}", f"line {i}") for i, n in enumerate(ODD_NAMES))
    for read in (S.read_scripts, S.read_script_lines):
        for export_root in (base, f"file://{base}", f"file:{base}/"):
            assert rows(S.listed_paths(read(spark, base), export_root, "/Shared")) == wanted


def test_a_path_outside_the_root_fails(spark):
    odd = spark.createDataFrame([("/other/x/a.py",)], "path string")
    for root in ("/x", "/other/y", "/other/x/a.p"):
        with pytest.raises(Exception, match="not below"):
            S.listed_paths(odd, root).collect()


def test_listing_faults(spark, tmp_path):
    good = {"objects": [{"object_id": "1", "object_type": "NOTEBOOK", "path": "/n"}]}
    bodies = [json.dumps(good), json.dumps(good, indent=2), "{}", '{"objects": [', '{"error_code": "DENIED", "message": "no"}', None]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    sound = spark.createDataFrame([(b,) for b in bodies[:3]], "body string")
    assert rows(S.parse_listing(sound)) == [("1", "NOTEBOOK", "/n", None)] * 2
    for body in bodies[3:]:
        with pytest.raises(Exception, match="listing body"):
            S.parse_listing(spark.createDataFrame([(body,)], "body string")).collect()
    assert len(rows(S.parse_listing(df, on_fault="skip"))) == 2
    faults = {r.body: r.fault for r in S.listing_faults(df).collect()}
    assert set(faults) == set(bodies[3:]) and faults[None] == "malformed: no body"
    assert faults[bodies[4]] == "error DENIED: no" and faults[bodies[3]].startswith("malformed")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "l.json").write_text(json.dumps(good, indent=2))
    assert len(rows(S.read_listing(spark, str(tmp_path / "one"), multiline=True))) == 1
    with pytest.raises(Exception, match="listing body"):
        S.read_listing(spark, str(tmp_path / "one")).collect()


VALUES = ["", None, " ", "a ", " a", ",", "a,b", '"', 'say "x"', "\\", "\\N", "\\\\N", "\\n", "\n", "a\r\nb", "\t", "é", "#", "'"]


def test_odd_values_survive(spark, tmp_path):
    mapping = spark.createDataFrame([(f"/p{i}{v}", v, VALUES[-i]) for i, v in enumerate(VALUES)], "path string, source string, target string")
    files.write_map(mapping, str(tmp_path / "map"))
    assert rows(files.read_map(spark, str(tmp_path / "map"))) == rows(mapping)
    for columns in (["path", "source", "target"], ["source"], ["source", "path"]):
        files.write_ids(mapping, columns, str(tmp_path / "-".join(columns)))
        assert rows(files.read_ids(spark, str(tmp_path / "-".join(columns)), columns)) == rows(mapping.select(*columns))


def test_catalog_keeps_declared_types_and_lives_with_absent_folders(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS STRING) AS v", "'abc' AS c").write.parquet(str(tmp_path / "gone"))
    spark.sql("CREATE DATABASE declared")
    try:
        spark.sql(f"CREATE TABLE declared.gone (v VARCHAR(10), c CHAR(5)) USING parquet LOCATION '{tmp_path}/gone'")
        spark.sql("CREATE TABLE declared.here (x INT) USING parquet")
        spark.sql("INSERT INTO declared.here VALUES (1)")
        columns = {r[1:] for r in rows(catalog.list_columns(spark, ["declared"]))}
        assert columns == {("gone", "v", "varchar(10)"), ("gone", "c", "char(5)"), ("here", "x", "int")}
        shutil.rmtree(tmp_path / "gone")
        found = {r.name: r for r in catalog.table_detail(spark, ["declared"]).collect()}
        assert found["declared.gone"].numFiles == 0 and found["declared.gone"].lastModified is None
        assert found["declared.here"].numFiles == 1
    finally:
        spark.sql("DROP DATABASE declared CASCADE")


def test_many_databases_are_one_plan(spark):
    names = [f"many{i}" for i in range(40)]
    for n in names:
        spark.sql(f"CREATE DATABASE {n}")
    try:
        listed = catalog.list_tables(spark, names)
        assert listed.count() == 0 and "Union" not in listed._jdf.queryExecution().toString()
    finally:
        for n in names:
            spark.sql(f"DROP DATABASE {n}")


def test_scratch_of_round_trips_is_dropped_too(spark):
    from lineloom.session import scratch_path

    path = scratch_path(spark, "by-hand")
    files.write_ids(spark.range(2).select(F.col("id").cast("string")), ["id"], path)
    assert Path(path).exists()
    drop_scratch(spark)
    assert not Path(path).exists()


def test_unresolved_processes(spark):
    mapping = spark.createDataFrame([("/a", "f1", "t1"), ("/b", "f1", "t2"), ("/c", "f2", "t1"), ("/d", None, "t1")], "path string, source string, target string")
    known = spark.createDataFrame([("file", "f1", "g1"), ("table", "t1", "g2")], "type_name string, qualified_name string, guid string")
    assert rows(lineage.resolve_processes(mapping, known).select("path")) == [("/a",)]
    assert rows(lineage.unresolved_processes(mapping, known)) == [("/b", "f1", "t2", True, False), ("/c", "f2", "t1", False, True)]


def test_catalog_calls_keep_their_order_and_raise(spark):
    assert catalog._each(spark, lambda n: n * n, range(100)) == [n * n for n in range(100)]
    with pytest.raises(ZeroDivisionError):
        catalog._each(spark, lambda n: 1 // n, [3, 0, 2])


@pytest.mark.parametrize("by_tasks", [True, False])
def test_scripts_are_written_to_a_file_each(spark, tmp_path, monkeypatch, by_tasks):
    if not by_tasks:
        monkeypatch.setattr(S, "local_folder", lambda root: None)
    root = f"file:{tmp_path}/export of x"
    odd = [] if not by_tasks else [("", "_b", 5, "e"), ("é", ".", 6, "f"), ("a/b", "..", 7, "g\rh")]
    docs = [("a b", "x+%41", 1, "p\nq"), ("c#", "=y:", 2, None), ("c#", "=y:", 3, ""), ("a", "b", 4, "r"), ("a", "b", 4, "s")]
    S.write_scripts(spark.createDataFrame(docs + odd, "l string, s string, d int, text string"), ["l", "s", "d"], "text", root)
    read = S.read_scripts(spark, root)
    got = read.select(*[S.key_value("path", k) for k in "lsd"], "text").collect()
    texts = {tuple(r)[:3]: sorted(r["text"].splitlines(keepends=True)) for r in got}
    wanted = [(("a b", "x+%41", "1"), ["p\n", "q\n"]), (("c#", "=y:", "2"), ["\n"]), (("c#", "=y:", "3"), ["\n"]), (("a", "b", "4"), ["r\n", "s\n"])]
    wanted += [((l, s, str(d)), f"{t}\n".splitlines(keepends=True)) for l, s, d, t in odd]
    assert texts == dict(wanted) and len(got) == len(wanted)


def test_scripts_without_a_key_have_no_value_for_it(spark, tmp_path):
    docs = [("a", None, 1, "p"), (None, "b", 2, "q"), ("a", "b", None, "r")]
    S.write_scripts(spark.createDataFrame(docs, "l string, s string, d int, text string"), ["l", "s", "d"], "text", f"{tmp_path}/x")
    got = S.read_scripts(spark, f"{tmp_path}/x").select(*[S.key_value("path", k) for k in "lsd"], "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", None, "1", "p\n"), (None, "b", "2", "q\n"), ("a", "b", None, "r\n")], key=str)


def test_tasks_write_scripts_without_a_folder_for_each(spark, tmp_path):
    docs = spark.range(300).selectExpr("'a' AS l", "id AS d", "'text' AS text")
    S.write_scripts(docs, ["l", "d"], "text", f"{tmp_path}/x")
    assert sorted(os.listdir(f"{tmp_path}/x/l=a")) == sorted(f"d={i}.txt" for i in range(300))
