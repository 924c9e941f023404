"""Cascades, inherited types, search index, kept maps and stores, whole listing objects, plain CSV."""

import csv
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from lineloom.operators import cascade, matching, model, search
from lineloom.operators import entities as E
from lineloom.plans import incremental, lineage
from lineloom.sources import files, scripts, store

EDGES = "owner string, owned string"


# -- cascade ------------------------------------------------------------------


def plain_reach(edges, hits):
    reached = set(hits)
    while True:
        more = {b for a, b in edges if a in reached} - reached
        if not more:
            return reached
        reached |= more


def plain_steps(edges, hits):
    left = plain_reach(edges, hits)
    edges = {(a, b) for a, b in edges if a in left and a != b}
    out, step = {}, 1
    while True:
        ready = left - {a for a, _ in edges}
        if not ready:
            return {**out, **{n: (step, True) for n in left}}
        out.update((n, (step, False)) for n in ready)
        left -= ready
        edges = {(a, b) for a, b in edges if b not in ready}
        step += 1


def random_graph(seed):
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(40)]
    edges = [(rng.choice(nodes[:30]), rng.choice(nodes)) for _ in range(45)]
    return edges + edges[:5] + [("n1", "n1")], rng.sample(nodes, 4) + ["absent"]


@pytest.mark.parametrize("edges, hits", [
    ([(f"c{i}", f"c{i + 1}") for i in range(20)], ["c3"]),  # deep
    ([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "a"), ("d", "e")], ["x"]),  # a ring, its owner, what hangs on it
    random_graph(1),
    random_graph(2),
    ([("a", "b")], ["a", "a", None]),
])
def test_deletion_order(spark, edges, hits):
    frame = spark.createDataFrame(edges, EDGES)
    got = cascade.deletion_order(frame, spark.createDataFrame([(h,) for h in hits], "guid string")).collect()
    want = plain_steps(edges, [h for h in hits if h])
    assert {r["guid"]: (r["step"], r["ring"]) for r in got} == want
    assert len(got) == len(want)


def test_short_guids_cascade_alike(spark):
    ref = lambda *owners: [("parent", "t", "q", o) for o in owners]
    rows = [("t", "a", []), ("t", "b", ref("a")), ("t", "c", ref("b", "a")), ("t", "d", ref("x")), ("t", None, ref("a")), ("t", "e", ref(None))]
    held = spark.createDataFrame(rows, f"type_name string, guid string, relationships {E.REFERENCES}")
    held = held.withColumn("name", F.col("guid"))
    relations = model.relation_table(spark, [("r", "COMPOSITION", "t", "children", "SET", True, "t", "parent", "SINGLE", False)])
    short = cascade.compact_guids(held)
    assert {len(r["guid"]) for r in short.where("name IS NOT NULL").collect()} == {12}
    hit = F.col("name") == "a"
    left = cascade.delete_cascading(short, short.where(hit), relations)
    assert sorted(str(r["name"]) for r in left.collect()) == ["None", "d", "e"]
    order = cascade.deletion_order(cascade.composition_edges(short, relations), short.where(hit))
    named = order.join(short.select("guid", "name"), "guid")
    assert {(r["name"], r["step"], r["ring"]) for r in named.collect()} == {("c", 1, False), ("b", 2, False), ("a", 3, False)}


def test_delete_takes_columns_along_and_leaves_no_orphans(spark):
    details = spark.createDataFrame(
        [("db", t, "parquet", "/x", 1, 2) for t in ("a", "b", "c")],
        "databaseName string, tableName string, tableFormat string, location string, numFiles long, sizeInBytes long",
    )
    columns = spark.createDataFrame(
        [("db", t, c, "int") for t in ("a", "b") for c in ("x", "y")],
        "databaseName string, tableName string, colName string, dataType string",
    )
    tables = E.table_entities(details, domain="d")
    held = tables.unionByName(E.column_entities(columns, tables, domain="d"))
    relations = model.relation_table(spark)
    hits = E.search_entities(held, "d/db/a", E.TABLE)
    left = cascade.delete_cascading(held, hits, relations)
    assert sorted(r["name"] for r in left.collect()) == ["b", "c", "x", "y"]
    assert cascade.orphans(left, relations).collect() == []
    # The plain deletion leaves them, and they are found.
    lost = cascade.orphans(E.delete_entities(held, hits), relations)
    assert sorted(r["qualified_name"] for r in lost.collect()) == ["cat://d/db/a#x", "cat://d/db/a#y"]
    assert cascade.delete_cascading(held, held.limit(0), relations).count() == held.count()


def test_the_container_may_hold_the_reference(spark):
    ref = [("parts", "part", "q", "p1")]
    rows = [("box", "b1", ref), ("part", "p1", []), ("part", "p2", [("parts", "box", "q", "b1")])]
    held = spark.createDataFrame(rows, f"type_name string, guid string, relationships {E.REFERENCES}")
    kinds = [("r", "COMPOSITION", "box", "parts", "SET", True, "part", "box", "SINGLE", False), ("s", "AGGREGATION", "box", "x", "SET", True, "part", "parts", "SINGLE", False)]
    edges = cascade.composition_edges(held, model.relation_table(spark, kinds))
    assert [tuple(r) for r in edges.collect()] == [("b1", "p1")]


# -- types --------------------------------------------------------------------


def plain_attributes(types, name):
    """Nearest definitions by breadth-first search over ways."""
    supers, fields = {t[0]: t[1] for t in types}, {t[0]: t[2] for t in types}
    ways, found = [((), [name])], {}
    while ways:
        later = []
        for way, seen in sorted(ways):
            for place, (attribute, default, required) in enumerate(fields.get(seen[-1], [])):
                found.setdefault(attribute, (attribute, default, required))
            for place, above in enumerate(supers.get(seen[-1], [])):
                if above not in seen:
                    later.append(((*way, place), [*seen, above]))
        ways = later
    return found


def test_inherited_types(spark):
    rng = random.Random(4)
    names = [f"t{i}" for i in range(14)]
    attribute = lambda i: (f"f{rng.randrange(6)}", rng.choice([None, f"d{i}"]), rng.random() < 0.4)
    types = []
    for i, name in enumerate(names):
        fields = {a[0]: a for a in (attribute(i) for _ in range(rng.randrange(3)))}
        types.append((name, rng.sample(names[:i] + ["undefined"], min(i, rng.randrange(4))), list(fields.values())))
    types += [("r1", ["r2"], [("a", "1", False)]), ("r2", ["r3", "t3"], [("b", "2", False)]), ("r3", ["r1"], [("a", "3", True)]), ("self", ["self"], [])]
    table = model.type_table(spark, types)
    got = {r["type_name"]: [tuple(a) for a in r["attributes"]] for r in model.inherited_types(table).collect()}
    assert got == {t[0]: list(plain_attributes(types, t[0]).values()) for t in types}
    rings = {r["type_name"]: r["ring"] for r in model.type_rings(table).collect()}
    assert rings == {"r1": ["r1", "r2", "r3", "r1"], "r2": ["r2", "r3", "r1", "r2"], "r3": ["r3", "r1", "r2", "r3"], "self": ["self", "self"]}
    unknown = {(r["type_name"], r["super_type"]) for r in model.undefined_supers(table).collect()}
    assert unknown == {(t[0], s) for t in types for s in t[1] if s == "undefined"}


def test_a_deep_hierarchy_and_a_required_attribute_of_a_super_type(spark):
    types = [(f"d{i}", [f"d{i - 1}"] if i else [], [("owner", None, True)] if not i else []) for i in range(130)]
    inherited = model.inherited_types(model.type_table(spark, types))
    row = spark.range(1).select(F.lit("d129").alias("type_name"), F.lit("q").alias("qualified_name"), F.create_map().cast("map<string,string>").alias("attributes"))
    assert model.check_types(row, inherited).first()["missing"] == ["owner"]
    assert model.check_types(row, model.type_table(spark, types)).first()["missing"] == []
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == "100"


# -- search -------------------------------------------------------------------


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(9)
    syllables = ["al", "Be", "ca", "dé", "%", "_x", "1", "İ"]
    rows = [(rng.choice(["table", "file"]), "cat://d/" + "".join(rng.choice(syllables) for _ in range(rng.randrange(6))), rng.choice([None, "", "ab", "".join(rng.choice(syllables) for _ in range(4))])) for _ in range(300)]
    held = spark.createDataFrame(list(dict.fromkeys(rows)), "type_name string, qualified_name string, name string")
    held = held.withColumn("guid", F.sha2(F.concat_ws("|", "type_name", "qualified_name", "name"), 256))
    path = str(tmp_path_factory.mktemp("index") / "i")
    search.write_index(held, path, buckets=8)
    return held, path


@pytest.mark.parametrize("keyword, kind", [("alBe", None), ("ALBE", "file"), ("cat://d/", None), ("ca%_x", None), ("dé1", "table"), ("al", None), ("", "file"), ("nothing", None), ("table", None), ("file", "table"), ("caldéal", None)])
def test_index_finds_what_the_scan_finds(spark, indexed, keyword, kind):
    held, path = indexed
    got = search.search_index(spark, path, keyword, kind, buckets=8).collect()
    want = E.search_entities(held, keyword, kind).collect()
    assert sorted(r["guid"] for r in got) == sorted(r["guid"] for r in want)
    word = keyword.lower()
    for r in got:
        name = (r["name"] or "").lower() if r["name"] is not None else None
        if name == word:
            assert r["score"] == 0
        elif name is not None and name.startswith(word):
            assert r["score"] == 1


def test_search_reads_few_partitions(spark, indexed):
    held, path = indexed
    longest = max((r["qualified_name"] for r in held.collect()), key=len)
    hits = search.search_index(spark, path, longest, None, buckets=8)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "dynamicpruning" in plan


def test_pages_are_the_whole_list_in_order(spark, indexed):
    held, path = indexed
    hits = search.search_index(spark, path, "cat", None, buckets=8)
    key = lambda r: tuple(r[c] for c in search.ORDER)
    pages, after = [], None
    while True:
        rows = search.page(hits, 37, after).collect()
        if not rows:
            break
        pages += map(key, rows)
        after = pages[-1]
    assert pages == sorted(key(r) for r in hits.collect())


# -- kept map -----------------------------------------------------------------


def test_only_changed_scripts_are_matched(spark, monkeypatch):
    asset = "name string, qualified_name string"
    one = spark.createDataFrame([("f1.csv", "q/f1.csv")], asset)
    two = spark.createDataFrame([("tab", "q/tab"), ("other", "q/other")], asset)
    texts = {"/a": "insert into tab from f1.csv ", "/b": "select 1", "/c": "create other x", "/d": "merge tab ", "/e": None}
    frame = lambda held: spark.createDataFrame(list(held.items()), "path string, text string")
    matched = []
    plain = incremental.lineage_map

    def counted(changed, *args, **options):
        matched.append(sorted(r["path"] for r in changed.select("path").collect()))
        return plain(changed, *args, **options)

    monkeypatch.setattr(incremental, "lineage_map", counted)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    full = lambda held, *assets: rows(lineage.lineage_map(frame(held), *assets))

    state = incremental.update_map(frame(texts), one, two)
    assert rows(incremental.mapping_of(state)) == full(texts, one, two)
    newer = {**texts, "/b": "insert tab ", "/f": "create f1.csv"}
    del newer["/c"]
    second = incremental.update_map(frame(newer), one, two, state)
    assert rows(incremental.mapping_of(second)) == full(newer, one, two)
    assert matched[1] == ["/b", "/e", "/f"]  # a script without text has no digest and is looked at again
    assert sorted(map(tuple, incremental.changes(state, second).collect())) == [("/b", "added"), ("/c", "removed"), ("/f", "added")]
    # Another order of the same lists changes nothing, another name everything.
    third = incremental.update_map(frame(newer), one, two.orderBy(F.desc("name")), second)
    assert matched[2] == ["/e"] and rows(incremental.mapping_of(third)) == full(newer, one, two)
    fewer = two.where("name = 'other'")
    last = incremental.update_map(frame(newer), one, fewer, third)
    assert matched[3] == sorted(newer) and rows(incremental.mapping_of(last)) == full(newer, one, fewer)


# -- store --------------------------------------------------------------------


def held_rows(spark, rows):
    df = spark.createDataFrame(rows, "type_name string, qualified_name string, name string")
    return df.withColumn("guid", F.sha2("qualified_name", 256))


def parts(root):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def test_a_store_rewrites_only_what_it_touches(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [(kind, f"q{i}", f"n{i}") for kind in ("01", "b/=c") for i in range(60)]
    store.create_store(held_rows(spark, rows), root, buckets=8)
    read = lambda: sorted(tuple(r) for r in store.read_store(spark, root).select("type_name", "qualified_name", "name").collect())
    assert read() == sorted(rows)
    with pytest.raises(ValueError):
        store.create_store(held_rows(spark, rows), root)
    first = parts(root)

    store.update_store(spark, root, held_rows(spark, [("01", "q3", "new"), ("01", "q3000", "more")]), held_rows(spark, [("01", "q3000", ""), ("01", "q4", "")]))
    want = {r[:2]: r[2] for r in rows}
    want["01", "q3"] = "new"
    del want["01", "q4"]
    assert read() == sorted((*k, v) for k, v in want.items())
    assert all(parts(root)[f] == t for f, t in first.items())
    written = set(parts(root)) - set(first)
    assert written and all("type_name=01" in f for f in written)
    assert len({f.split("bucket=")[1].split("/")[0] for f in written}) <= 3

    # A part of which all rows go is not in the manifest any more, and a new type comes in.
    store.update_store(spark, root, held_rows(spark, [("new", "x", "y")]), held_rows(spark, [("b/=c", f"q{i}", "") for i in range(60)]))
    want = {k: v for k, v in want.items() if k[0] != "b/=c"} | {("new", "x"): "y"}
    assert read() == sorted((*k, v) for k, v in want.items())


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = [("a", f"q{i}", "n") for i in range(20)]
    store.create_store(held_rows(spark, rows), root, buckets=4)
    broken = held_rows(spark, [("a", f"q{i}", "m") for i in range(20)])
    broken = broken.withColumn("name", F.when(F.col("qualified_name") == "q7", F.raise_error(F.lit("no"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="no"):
        store.update_store(spark, root, broken)
    # A generation that was written but not committed, and a commit that was begun, are not seen.
    store._write(store._bucketed(held_rows(spark, [("a", "q1", "lost")]), 4), root, "half")
    os.makedirs(f"{root}/commits", exist_ok=True)
    open(f"{root}/commits/000000000002", "w").close()
    assert sorted(tuple(r)[:3] for r in store.read_store(spark, root).collect()) == sorted(rows)


def test_two_writers_cannot_make_the_same_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    store.create_store(held_rows(spark, [("a", "q", "n")]), root, buckets=2)
    last = store._last(spark, root)
    monkeypatch.setattr(store, "_last", lambda *_: last)
    store.update_store(spark, root, held_rows(spark, [("a", "q", "first")]))
    with pytest.raises(Exception, match="(?i)exist"):
        store.update_store(spark, root, held_rows(spark, [("a", "q", "second")]))
    monkeypatch.undo()
    assert store.read_store(spark, root).first()["name"] == "first"


# -- listing and CSV ----------------------------------------------------------


def test_all_fields_of_listed_objects(spark):
    bodies = [
        {"objects": [{"path": "/a", "n": 1, "info": {"size": 2.5, "deep": {"x": True}}}, {"path": "/b", "odd name'": "v", "tags": ["a", 1]}]},
        {"objects": [{"path": None, "n": "text", "none": None}]},
        {"objects": []},
        {},
    ]
    frame = spark.createDataFrame([(json.dumps(b, indent=i),) for i, b in enumerate(bodies)], "body string")
    found = scripts.parse_listing_all(frame)
    assert sorted(found.columns) == sorted(["path", "n", "info.size", "info.deep.x", "odd name'", "tags", "none"])
    rows = {r["path"]: r for r in found.collect()}
    assert float(rows["/a"]["info.size"]) == 2.5 and rows["/a"]["info.deep.x"] is True and rows["/b"]["info.size"] is None
    assert rows["/b"]["odd name'"] == "v" and len(rows["/b"]["tags"]) == 2
    # A field of numbers here and texts there keeps both.
    assert str(rows["/a"]["n"]) == "1" and "text" in str(rows[None]["n"])


def test_faults_of_listings(spark):
    frame = spark.createDataFrame([('{"objects":[{"path":"/a"}]}',), ("nothing",), (None,), ('{"error_code":"E","message":"m"}',), ("[1]",)], "body string")
    assert [tuple(r) for r in scripts.parse_listing_all(frame, on_fault="skip").collect()] == [("/a",)]
    for fault in ("nothing", '{"error_code":"E"}', "[1]"):
        with pytest.raises(Exception, match="listing body"):
            scripts.parse_listing_all(spark.createDataFrame([(fault,)], "body string")).collect()
    assert scripts.parse_listing_all(frame.limit(0)).collect() == []


def test_a_plain_csv_is_read_as_it_stands(spark, tmp_path):
    rows = [("/a", "C:\\new\\raw.csv", "t"), ("/b", 'say "x", y', None), ("/c", "two\nlines", " outer "), ("/d", "\\N", "\\\\"), ("/e", "", "é")]
    path = str(tmp_path / "map.csv")
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["notebook", "source", "target"])
        out.writerows(rows)
    got = [tuple(r) for r in files.read_map(spark, path, escaped=False).orderBy("path").collect()]
    assert got == [(a, b or None, c or None) for a, b, c in rows]


def test_evidence_of_a_hit(spark):
    asset = "name string, qualified_name string"
    one = spark.createDataFrame([("F1.csv", "q/f1"), ("f1.csv", "q/again"), ("none.csv", "q/none")], asset)
    two = spark.createDataFrame([("tab", "q/tab")], asset)
    texts = [("/a", "é\r\nx\rINSERT tab, tab x\nfrom F1.CSV tab "), ("/b", "tab "), ("/c", None), ("/d", "create f1.csv\n\ntab")]
    got = lineage.evidence(spark.createDataFrame(texts, "path string, text string"), one, two).collect()
    assert sorted(map(tuple, got)) == [
        ("/a", "source", "q/again", 3, 6, "from F1.CSV tab "),
        ("/a", "source", "q/f1", 3, 6, "from F1.CSV tab "),
        ("/a", "target", "q/tab", 2, 13, "INSERT tab, tab x"),
        ("/d", "source", "q/again", 0, 8, "create f1.csv"),
        ("/d", "source", "q/f1", 0, 8, "create f1.csv"),
    ]


def test_evidence_cuts_a_text_once_for_all_its_names(spark):
    asset = "name string, qualified_name string"
    known = spark.createDataFrame([(f"n{i}.csv", f"q/{i}") for i in range(3)], asset)
    texts = spark.createDataFrame([("/a", "create x\r\nN1.csv n1.csv\rn2.csv\n\n n1.csv n0.csv"), ("/b", "create n0.csv")], "path string, text string")
    found = lineage.evidence(texts, known, known.limit(0))
    assert sorted((r["path"], r["qualified_name"], r["line"], r["column"]) for r in found.collect()) == [
        ("/a", "q/0", 4, 9), ("/a", "q/1", 1, 1), ("/a", "q/2", 2, 1), ("/b", "q/0", 0, 8)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    placing = [line for line in plan.splitlines() if "transform(names" in line]
    assert placing and not any("split(" in line for line in placing)


@pytest.mark.parametrize("direct", [True, False])
def test_evidence_of_many_names(spark, monkeypatch, direct):
    """Short lists are placed as the text is read; longer ones are found first. The hits are the same."""
    if direct:
        monkeypatch.setattr(lineage, "_named", None)
    else:
        monkeypatch.setattr(matching, "DIRECT_NAMES", 0)
    texts = {
        "/a": "The a.csv\r\nÉa B.CSV\r\rtab x\nB.csv",
        "/b": "the\rİ tab end\n",
        "/c": "a.csv",
        "/d": "the " + "y" * 300 + "\n\n a.csv",
        None: "the a.csv",
    }
    files = spark.createDataFrame([("A.csv", "f1"), ("b.csv", "f2"), ("a.csv", "f3")], "name string, qualified_name string")
    tables = spark.createDataFrame([("tab", "t1")], "name string, qualified_name string")
    found = lineage.evidence(spark.createDataFrame(list(texts.items()), "path string, text string"), files, tables, words=["the"])
    assert sorted(tuple(r) for r in found.collect()) == [
        ("/a", "source", "f1", 0, 5, "The a.csv"),
        ("/a", "source", "f2", 1, 4, "Éa B.CSV"),
        ("/a", "source", "f3", 0, 5, "The a.csv"),
        ("/a", "target", "t1", 3, 1, "tab x"),
        ("/b", "target", "t1", 1, 4, "İ tab end"),
        ("/d", "source", "f1", 2, 2, " a.csv"),
        ("/d", "source", "f3", 2, 2, " a.csv"),
    ]
