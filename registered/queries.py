"""One function per query, (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lineloom.functions.names import column_key, entity_guid, short_name, table_key
from lineloom.operators import cascade, model, search, terms, tree
from lineloom.operators import entities as E
from lineloom.plans import incremental, inventory, lineage
from lineloom.session import materialize, scratch_path
from lineloom.sources import catalog, files, store
from lineloom.sources import scripts as script_source

from . import views
from .views import WORDS, table

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
TERMS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NOWHERE"]
CUT = "2024-01-16 00:00:00"
# Values that a text format may lose.
ODD = ["", " ", ",", '"', "\\", "\\N", "\t", "\n", "'", "a ", "#"]


# -- inventory ---------------------------------------------------------------


def inventory_tables(spark: SparkSession, d: str) -> DataFrame:
    found = catalog.folder_profile(spark, d).select(F.lit("testdata").alias("database"), F.col("table").alias("tableName"))
    return catalog.nonempty(found, "database")


def inventory_columns(spark: SparkSession, d: str) -> DataFrame:
    names = sorted(r["table"] for r in catalog.folder_profile(spark, d).select("table").collect())
    return catalog.column_table(spark, {("testdata", t): table(spark, d, t) for t in names})


# A column that the catalog declares otherwise than its file.
DECLARED = {"nation": "n_nationkey INT, n_name VARCHAR(25), n_regionkey INT"}


def _cataloged(spark: SparkSession, d: str, job) -> DataFrame:
    """Result of a job over a database of external tables, which is dropped again."""
    name = f"inventory_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        for t in TABLES:
            columns = f"({DECLARED[t]})" if t in DECLARED else ""
            spark.sql(f"CREATE TABLE {name}.{t} {columns} USING parquet LOCATION '{d}/{t}.parquet'")
        return materialize(job(name), "catalog").replace(name, "testdata")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def catalog_tables(spark: SparkSession, d: str) -> DataFrame:
    return _cataloged(spark, d, lambda name: inventory.inventory(spark, [name]).tables)


def catalog_columns(spark: SparkSession, d: str) -> DataFrame:
    return _cataloged(spark, d, lambda name: inventory.inventory(spark, [name]).columns)


def catalog_detail(spark: SparkSession, d: str) -> DataFrame:
    def job(name: str) -> DataFrame:
        parts = F.split("name", "[.]")
        detail = inventory.inventory(spark, [name]).details
        return detail.select(
            parts[0].alias("database"), parts[1].alias("tableName"), "format", "numFiles", "sizeInBytes",
            F.size("partitionColumns").alias("partitions"),
        )

    return _cataloged(spark, d, job)


def catalog_entities(spark: SparkSession, d: str) -> DataFrame:
    def job(name: str) -> DataFrame:
        made = inventory.build_entities(inventory.inventory(spark, [name]), name, domain="test")
        key = F.replace("qualified_name", F.lit(name), F.lit("testdata"))
        parent = F.replace(F.get("relationships", F.lit(0))["qualified_name"], F.lit(name), F.lit("testdata"))
        attribute = lambda k: F.col("attributes")[k].alias(k)
        return made.select("type_name", key.alias("qualified_name"), "name", attribute("data_type"), attribute("num_files"), parent.alias("parent"))

    return _cataloged(spark, d, job)


def table_detail(spark: SparkSession, d: str) -> DataFrame:
    return catalog.folder_profile(spark, d)


def table_names_split(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "customer").select(F.regexp_replace("c_name", "#", ".").alias("name"), "c_mktsegment")
    return inventory.split_names(named, "Customer", [F.col("c_mktsegment").alias("segment")])


def nonempty_filter(spark: SparkSession, d: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", "").otherwise(F.nullif("l_returnflag", F.lit("R")))
    holes = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", flag.alias("flag"))
    return catalog.nonempty(holes, "flag")


def preview(spark: SparkSession, d: str) -> DataFrame:
    return inventory.preview(table(spark, d, "orders"), "o_orderkey")


def qualified_names(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        "c_custkey",
        table_key("n_name", "c_name", domain="test").alias("table_key"),
        column_key("n_name", "c_name", "c_mktsegment", domain="test").alias("column_key"),
    )


def asset_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", short_name("url").alias("name"))


def csv_assets(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("qualified_name"))
    return lineage.csv_assets(pages, "page")


# -- scripts -----------------------------------------------------------------


def script_lines(spark: SparkSession, d: str) -> DataFrame:
    return script_source.number_lines(views.scripts(spark, d))


def path_like(spark: SparkSession, d: str) -> DataFrame:
    return views.scripts(spark, d).select("path").where(F.col("path").like("%src1%"))


def writing_scripts(spark: SparkSession, d: str) -> DataFrame:
    return lineage.writing_scripts(views.scripts(spark, d), WORDS)


def writing_counts(spark: SparkSession, d: str) -> DataFrame:
    return lineage.writing_line_counts(script_source.number_lines(views.scripts(spark, d)), WORDS)


def json_listing(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a listing body of itself and its folder."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    doc_id, folder = F.col("doc_id").cast("string"), F.concat(F.lit("/Shared/"), "source")
    item = lambda i, kind, path, lang: F.struct(
        i.alias("object_id"), F.lit(kind).alias("object_type"), path.alias("path"), lang.alias("language")
    )
    objects = F.array(
        item(doc_id, "NOTEBOOK", F.concat(folder, F.lit("/"), doc_id), F.col("lang")),
        item(F.concat(F.lit("d"), doc_id), "DIRECTORY", folder, F.lit(None).cast("string")),
    )
    return script_source.parse_listing(docs.select(F.to_json(F.struct(objects.alias("objects"))).alias("body")))


def path_tree(spark: SparkSession, d: str) -> DataFrame:
    return tree.walk_tree(views.listing(spark, d), "/Shared")


def path_tree_kinds(spark: SparkSession, d: str) -> DataFrame:
    return tree.count_kinds(path_tree(spark, d))


# -- lineage -----------------------------------------------------------------


def match_source(spark: SparkSession, d: str) -> DataFrame:
    return lineage.first_match(views.scripts(spark, d), views.asset_files(spark, d), lineage.SOURCE)


def match_target(spark: SparkSession, d: str) -> DataFrame:
    return lineage.first_match(views.scripts(spark, d), views.asset_tables(spark, d), lineage.TARGET)


def match_wildcards(spark: SparkSession, d: str) -> DataFrame:
    """Table names whose second letter is any letter, as LIKE reads an underscore."""
    names = views.asset_tables(spark, d).select(
        F.concat(F.substring("name", 1, 1), F.lit("_"), F.substring("name", 3, 100)).alias("name"), "qualified_name"
    )
    return lineage.first_match(views.scripts(spark, d), names, lineage.TARGET, wildcards=True)


def match_counts(spark: SparkSession, d: str) -> DataFrame:
    lines = script_source.number_lines(views.scripts(spark, d))
    return lineage.match_counts(lines, views.asset_tables(spark, d), lineage.TARGET)


def lineage_map(spark: SparkSession, d: str) -> DataFrame:
    return lineage.lineage_map(
        views.scripts(spark, d), views.asset_files(spark, d), views.asset_tables(spark, d), words=WORDS
    )


def lineage_scan(spark: SparkSession, d: str) -> DataFrame:
    """The map of the scripts that a walk from the root reaches, of some folders."""
    return lineage.scan_lineage(
        views.listing(spark, d),
        "/Shared",
        views.scripts(spark, d),
        views.asset_files(spark, d),
        views.asset_tables(spark, d),
        words=WORDS,
        path_like="%src1%",
    )


def lineage_all_matches(spark: SparkSession, d: str) -> DataFrame:
    return lineage.all_matches(
        views.scripts(spark, d), views.asset_files(spark, d), views.asset_tables(spark, d), words=WORDS
    )


def lineage_evidence(spark: SparkSession, d: str) -> DataFrame:
    return lineage.evidence(
        views.scripts(spark, d), views.asset_files(spark, d), views.asset_tables(spark, d), words=WORDS
    )


def _processes(spark: SparkSession, d: str) -> DataFrame:
    return lineage.resolve_processes(lineage_map(spark, d), views.asset_entities(spark, d))


def lineage_edges(spark: SparkSession, d: str) -> DataFrame:
    return lineage.lineage_edges(_processes(spark, d), domain="test")


def lineage_jobs(spark: SparkSession, d: str) -> DataFrame:
    jobs = lineage.job_entities(_processes(spark, d), domain="test")
    return jobs.select(
        "guid",
        "qualified_name",
        "name",
        F.col("attributes")["notebook_path"].alias("notebook_path"),
        F.col("inputs")[0]["guid"].alias("input_guid"),
        F.col("outputs")[0]["guid"].alias("output_guid"),
    )


def lineage_unresolved(spark: SparkSession, d: str) -> DataFrame:
    return lineage.unresolved_processes(lineage_map(spark, d), views.asset_entities(spark, d))


def lineage_files(spark: SparkSession, d: str) -> DataFrame:
    """The scan's map from script files: every document is written to one and read again."""
    root = scratch_path(spark, "export of scripts")
    docs = table(spark, d, "documents").select("lang", "source", F.col("doc_id").alias("doc"), "text")
    script_source.write_scripts(docs, ["lang", "source", "doc"], "text", root)
    found = script_source.listed_paths(script_source.read_scripts(spark, root), root, "/Shared")
    lang, source, doc = [script_source.key_value("path", key) for key in ("lang", "source", "doc")]
    path = F.concat(F.lit("/Shared/"), lang, F.lit("/"), source, F.lit("/doc_"), doc)
    return lineage.scan_lineage(
        views.listing(spark, d),
        "/Shared",
        found.withColumn("path", path),
        views.asset_files(spark, d),
        views.asset_tables(spark, d),
        words=WORDS,
        path_like="%src1%",
    )


def csv_odd_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Every line of the documents as a map row: outer blanks, quotes, commas, backslashes, empty and NULL."""
    lines = script_source.number_lines(views.scripts(spark, d))
    odd = F.element_at(F.array(*map(F.lit, ODD)), F.col("pos") % len(ODD) + 1)
    rows = lines.select(
        F.concat_ws("#", "path", F.col("pos").cast("string")).alias("path"),
        F.concat(odd, "line", odd).alias("source"),
        F.when(F.col("pos") % 3 > 0, F.when(F.col("pos") % 3 == 1, odd).otherwise("")).alias("target"),
    )
    path = scratch_path(spark, "odd-csv")
    files.write_map(rows, path)
    return files.read_map(spark, path)


def text_odd_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Id pairs with NULL, empty values, commas and backslashes, for every order."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    odd = F.element_at(F.array(*map(F.lit, ODD)), (F.col("o_orderkey") % len(ODD) + 1).cast("int"))
    pairs = orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderkey") % 3 > 0, F.when(F.col("o_orderkey") % 3 == 1, odd).otherwise("")).alias("first"),
        F.concat("o_orderpriority", odd).alias("second"),
    )
    path = scratch_path(spark, "odd-ids")
    files.write_ids(pairs, ["first", "second", "order_id"], path)
    return files.read_ids(spark, path, ["first", "second", "order_id"])


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "map-csv")
    files.write_map(lineage_map(spark, d), path)
    return files.read_map(spark, path)


def text_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    pairs = views.customer_entities(spark, d).select(
        F.col("guid").alias("term_guid"), F.sha2("name", 256).alias("relationship_guid")
    )
    files.write_ids(pairs, ["term_guid", "relationship_guid"], path)
    return files.read_ids(spark, path, ["term_guid", "relationship_guid"])


# -- entities ----------------------------------------------------------------


def _customer_tables(spark: SparkSession, d: str, solvent: bool = False) -> DataFrame:
    details = table(spark, d, "customer").select(
        F.lit("crm").alias("databaseName"),
        F.col("c_name").alias("tableName"),
        F.lower("c_mktsegment").alias("tableFormat"),
        F.concat(F.lit("/data/"), "c_name").alias("location"),
        F.col("c_nationkey").alias("numFiles"),
        F.col("c_custkey").alias("sizeInBytes"),
        "c_acctbal",
    )
    return E.table_entities(details.where("c_acctbal > 0") if solvent else details, domain="test")


def entity_build(spark: SparkSession, d: str) -> DataFrame:
    attribute = lambda k: F.col("attributes")[k].alias(k)
    return _customer_tables(spark, d).select(
        "guid",
        "type_name",
        "qualified_name",
        "name",
        *[attribute(k) for k in ("format", "location", "num_files", "size")],
    )


def _order_columns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.lit("crm").alias("databaseName"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("tableName"),
        F.col("o_orderkey").cast("string").alias("colName"),
        F.col("o_orderstatus").alias("dataType"),
    )


def entity_columns(spark: SparkSession, d: str) -> DataFrame:
    # Customers in debt have no table here, so their orders' columns find none.
    columns = E.column_entities(_order_columns(spark, d), _customer_tables(spark, d, solvent=True), domain="test")
    parent = F.col("relationships")[0]
    return columns.select(
        "guid",
        "qualified_name",
        F.col("attributes")["data_type"].alias("data_type"),
        parent["qualified_name"].alias("parent"),
        parent["guid"].alias("parent_guid"),
    )


def entity_guid_query(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "orders").select(
        "o_orderkey", F.concat(F.lit("cat://test/o/"), F.col("o_orderkey").cast("string")).alias("key")
    )
    return keyed.select("o_orderkey", entity_guid(F.lit("order"), "key").alias("guid"))


def entity_json(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_nationkey").alias("nation")
    )
    return E.entity_json(rows, ["name", "segment", "nation"])


def _both_kinds(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_entities(spark, d).unionByName(views.nation_entities(spark, d))


def entity_search(spark: SparkSession, d: str) -> DataFrame:
    hits = E.search_entities(_both_kinds(spark, d), "ER#00000001", "customer")
    return hits.select("guid", "qualified_name", "name")


def _wanted(spark: SparkSession, d: str) -> DataFrame:
    key = F.concat(F.lit("cat://test/c/"), F.col("o_custkey").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", key.alias("key"))


def _solvent(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").where("c_acctbal > 0")
    return E.make_entity(
        rows,
        "customer",
        qualified_name=F.concat(F.lit("cat://test/c/"), F.col("c_custkey").cast("string")),
        name=F.col("c_name"),
        attributes={},
    )


def entity_lookup(spark: SparkSession, d: str) -> DataFrame:
    found = E.lookup(_wanted(spark, d), _solvent(spark, d), {"key": "qualified_name"}, "customer")
    return found.select("o_orderkey", "key", "name", "guid")


def entity_misses(spark: SparkSession, d: str) -> DataFrame:
    return E.missing_entities(_wanted(spark, d), _solvent(spark, d), {"key": "qualified_name"}, "customer")


def entity_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Events until a date are the snapshot, later ones the update."""
    events = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    cut = F.lit(CUT).cast("timestamp_ntz")
    snapshot = E.latest(events.where(F.col("ts") < cut), ["user_id"], ["ts", "event_id"])
    return E.upsert(snapshot, events.where(F.col("ts") >= cut), ["user_id"], ["ts", "event_id"])


def entity_store(spark: SparkSession, d: str) -> DataFrame:
    """Jobs and newer tables go into a snapshot of all kinds, which is written and read again."""
    jobs = lineage.job_entities(_processes(spark, d), domain="test")
    held = _both_kinds(spark, d)
    newer = _customer_tables(spark, d).unionByName(
        E.make_entity(
            table(spark, d, "customer").where("c_acctbal < 0"),
            "customer",
            qualified_name=F.concat(F.lit("cat://test/c/"), F.col("c_custkey").cast("string")),
            name=F.lower("c_name"),
            attributes={"segment": F.lit("IN DEBT")},
        )
    )
    path = scratch_path(spark, "entity-store")
    files.write_entities(E.upsert(held, newer.unionByName(jobs)), path)
    first = lambda ends: F.get(ends, F.lit(0))["qualified_name"]
    return files.read_entities(spark, path).select(
        "type_name",
        "qualified_name",
        "name",
        F.col("attributes")["segment"].alias("segment"),
        first("inputs").alias("input"),
        first("outputs").alias("output"),
    )


def entity_delete(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select(
        "o_orderkey", entity_guid(F.lit("customer"), F.concat(F.lit("cat://test/c/"), F.col("o_custkey").cast("string"))).alias("guid")
    )
    gone = views.customer_entities(spark, d).where(F.col("attributes")["segment"] == "BUILDING")
    return E.delete_entities(orders, gone).select("o_orderkey")


def entity_delete_by_search(spark: SparkSession, d: str) -> DataFrame:
    return E.delete_by_search(_both_kinds(spark, d), "cat://test/c/1", "customer").select("type_name", "qualified_name")


def column_parent(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose customer is missing (one nation's are left out) or claimed twice."""
    orders = table(spark, d, "orders")
    claims = orders.select("o_orderkey", F.col("o_custkey").alias("parent"))
    again = orders.where("o_orderkey % 7 = 0").select("o_orderkey", (F.col("o_custkey") + 1).alias("parent"))
    parents = table(spark, d, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("parent"))
    return model.composition_faults(claims.unionByName(again), parents, "o_orderkey", "parent")


def _jobs(spark: SparkSession, d: str) -> DataFrame:
    return E.make_entity(
        table(spark, d, "customer"),
        E.JOB,
        qualified_name=F.concat(F.lit("cat://test/j/"), F.col("c_custkey").cast("string")),
        name=F.col("c_name"),
        attributes={
            "job_type": F.nullif("c_mktsegment", F.lit("BUILDING")),
            "notebook_path": F.col("c_name"),
            "schedule": F.when(F.col("c_nationkey") > 10, "daily"),
        },
    )


def type_check(spark: SparkSession, d: str) -> DataFrame:
    found = _jobs(spark, d).unionByName(views.nation_entities(spark, d))
    checked = model.check_types(found, model.type_table(spark))
    attribute = lambda k: F.col("attributes")[k].alias(k)
    return checked.select(
        "qualified_name",
        attribute("job_type"),
        attribute("notebook_path"),
        attribute("schedule"),
        F.array_join("missing", ",").alias("missing"),
        "known",
    )


def type_replace(spark: SparkSession, d: str) -> DataFrame:
    """Jobs checked against a newer definition, with another default and a required schedule."""
    newer = model.type_table(spark, [(E.JOB, ["Process"], [("job_type", "script", False), ("schedule", None, True)])])
    types = E.upsert(model.type_table(spark), newer, ["type_name"])
    checked = model.check_types(_jobs(spark, d), types)
    attribute = lambda k: F.col("attributes")[k].alias(k)
    return checked.select(
        "qualified_name", attribute("job_type"), attribute("schedule"), F.array_join("missing", ",").alias("missing")
    )


def relation_broken(spark: SparkSession, d: str) -> DataFrame:
    """Customers whose composition with their nation lost a type, one relation and type per customer."""
    nations = table(spark, d, "nation")
    customers = table(spark, d, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    text = lambda value: F.lit(value)
    ends = (F.col("n_name"), text("customers"), text("SET"), F.lit(True), F.col("c_name"), text("nation"), text("SINGLE"), F.lit(False))
    values = (F.col("c_name"), text("COMPOSITION"), *ends)
    relations = customers.select(*[v.alias(c) for v, c in zip(values, model.RELATION_COLUMNS)])
    types = nations.select(F.col("n_name").alias("type_name")).unionByName(customers.select(F.col("c_name").alias("type_name")))
    broken = model.broken_relations(relations, model.delete_types(types, ["NATION_3", "Customer#000000001"]))
    return broken.select("name", "parent_type", "parent_container", "child_container")


def relation_faults(spark: SparkSession, d: str) -> DataFrame:
    """Orders against a relation that lets a child have many parents, but not none."""
    relations = model.relation_table(
        spark, [("order_of", "COMPOSITION", "customer", "orders", "SET", True, "order", "customers", "SET", False)]
    )
    claims = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("parent"))
    parents = table(spark, d, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("parent"))
    return model.relation_faults(claims, relations, "order_of", parents, "o_orderkey", "parent")


def type_delete(spark: SparkSession, d: str) -> DataFrame:
    types = model.type_table(spark, [("customer", [], []), ("nation", [], [])])
    left = model.delete_types(types, ["nation"])
    return model.typed_entities(_both_kinds(spark, d), left).select("type_name", "qualified_name")


def type_orphans(spark: SparkSession, d: str) -> DataFrame:
    types = model.type_table(spark, [("customer", [], []), ("nation", [], [])])
    left = model.delete_types(types, ["customer"])
    return model.untyped_entities(_both_kinds(spark, d), left).select("type_name", "qualified_name")


def _type(name, supers, *attributes) -> list:
    """Columns of the type table; attributes are (name, default, required)."""
    fields = [F.struct(F.lit(n).alias("name"), default.cast("string").alias("default"), F.lit(r).alias("required")) for n, default, r in attributes]
    return [
        name.alias("type_name"),
        F.array(*supers).cast("array<string>").alias("super_types"),
        F.array(*fields).cast(model.ATTRIBUTES).alias("attributes"),
    ]


def _place_types(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers are of their nation, nations of their region, regions both places and parties, parties places."""
    none = F.lit(None)
    place = _type(F.lit("place"), [], ("population", none, True), ("comment", F.lit("none"), False))
    party = _type(F.lit("party"), [F.lit("place")], ("comment", F.lit("party"), False), ("rank", F.lit("0"), False))
    regions, nations = table(spark, d, "region"), table(spark, d, "nation")
    supplied = table(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    even = _type(F.col("n_name"), [F.col("r_name")], ("comment", F.col("n_name"), False))
    odd = _type(F.col("n_name"), [F.col("r_name")])
    nations = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = [
        spark.range(1).select(*place),
        spark.range(1).select(*party),
        regions.select(*_type(F.col("r_name"), [F.lit("place"), F.lit("party")], ("region_code", F.col("r_regionkey"), False))),
        nations.where("n_nationkey % 2 = 0").select(*even),
        nations.where("n_nationkey % 2 = 1").select(*odd),
        supplied.select(*_type(F.col("s_name"), [F.col("n_name")], ("rank", F.col("s_suppkey"), False))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def type_inherited(spark: SparkSession, d: str) -> DataFrame:
    """Customers as entities of a supplier's type, which has its attributes from four levels of types."""
    customers = table(spark, d, "customer")
    held = E.make_entity(
        customers,
        "",
        qualified_name=F.concat(F.lit("cat://test/p/"), F.col("c_custkey").cast("string")),
        name=F.col("c_name"),
        attributes={"population": F.when(F.col("c_acctbal") > 0, F.col("c_custkey"))},
    )
    number = F.pmod(F.split_part("qualified_name", F.lit("/"), F.lit(5)).cast("long"), F.lit(150))
    held = held.withColumn("type_name", F.concat(F.lit("Supplier#"), F.lpad(number.cast("string"), 9, "0")))
    checked = model.check_types(held, model.inherited_types(_place_types(spark, d)))
    attribute = lambda k: F.col("attributes")[k].alias(k)
    return checked.select(
        "qualified_name",
        "type_name",
        *[attribute(k) for k in ("population", "comment", "rank", "region_code")],
        F.array_join("missing", ",").alias("missing"),
        "known",
    )


def _reference(name: str, kind: str, key):
    return F.array(
        F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type_name"), key.alias("qualified_name"), entity_guid(F.lit(kind), key).alias("guid"))
    )


def _sales_entities(spark: SparkSession, d: str) -> DataFrame:
    """Customers, their orders, and the orders' lines; each names its owner."""
    number = lambda c: F.col(c).cast("string")
    customer = lambda c: F.concat(F.lit("cat://test/c/"), number(c))
    order = lambda c: F.concat(F.lit("cat://test/o/"), number(c))
    line = F.concat(order("l_orderkey"), F.lit("#"), number("l_linenumber"), F.lit("/"), number("l_partkey"))
    orders = E.make_entity(
        table(spark, d, "orders"), "order", qualified_name=order("o_orderkey"), name=number("o_orderkey"),
        attributes={"status": F.col("o_orderstatus")}, relationships=_reference("customer", "customer", customer("o_custkey")),
    )
    lines = E.make_entity(
        table(spark, d, "lineitem"), "line", qualified_name=line, name=number("l_linenumber"),
        attributes={}, relationships=_reference("order", "order", order("l_orderkey")),
    )
    return views.customer_entities(spark, d).unionByName(orders).unionByName(lines)


def _sales_relations(spark: SparkSession) -> DataFrame:
    return model.relation_table(
        spark,
        [
            ("orders", "COMPOSITION", "customer", "orders", "SET", True, "order", "customer", "SINGLE", False),
            ("lines", "COMPOSITION", "order", "lines", "SET", True, "line", "order", "SINGLE", False),
        ],
    )


def _sales_hits(entities: DataFrame) -> DataFrame:
    value = lambda k: F.col("attributes")[k]
    return entities.where((value("segment") == "BUILDING") | (value("status") == "F"))


def entity_cascade(spark: SparkSession, d: str) -> DataFrame:
    """What goes with one segment's customers and all finished orders, lines first."""
    held = cascade.compact_guids(_sales_entities(spark, d))
    edges = cascade.composition_edges(held, _sales_relations(spark))
    gone = cascade.deletion_order(edges, _sales_hits(held))
    # Joined before they are told apart: both go by the guid, so the entities are dealt once.
    gone = held.select("guid", "type_name", "qualified_name").join(gone, "guid").distinct()
    return gone.select("type_name", "qualified_name", "step", "ring")


def entity_cascade_left(spark: SparkSession, d: str) -> DataFrame:
    held = cascade.compact_guids(_sales_entities(spark, d))
    left = cascade.delete_cascading(held, _sales_hits(held), _sales_relations(spark))
    # A guid is made of type and key, so the distinct rows are the same with it and stay where they are.
    return left.select("guid", "type_name", "qualified_name").distinct().select("type_name", "qualified_name")


def _index(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "search-index")
    search.write_index(_both_kinds(spark, d), path)
    return path


def entity_index_search(spark: SparkSession, d: str) -> DataFrame:
    hits = search.search_index(spark, _index(spark, d), "ER#00000001", "customer")
    return hits.select("guid", "qualified_name", "name", "score")


def entity_index_page(spark: SparkSession, d: str) -> DataFrame:
    """The second twenty hits, found from the last of the first."""
    hits = search.search_index(spark, _index(spark, d), "st/c/1")
    last = search.page(hits, 20).collect()[-1]
    found = search.page(hits, 20, tuple(last[c] for c in search.ORDER))
    return found.select("guid", "qualified_name", "name", "score")


def lineage_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The map after two rounds in which scripts come, change and vanish."""
    now = views.scripts(spark, d)
    assets = views.asset_files(spark, d), views.asset_tables(spark, d)
    place = F.pmod(F.xxhash64("path"), F.lit(10))
    vanished = now.select(F.concat("path", F.lit("_old")).alias("path"), "text")
    older = now.withColumn("text", F.when(place < 3, F.substring("text", 1, 40)).otherwise(F.col("text"))).where(place != 3)
    later = now.withColumn("text", F.when(place == 4, F.lower("text")).otherwise(F.col("text"))).where(place != 5)
    state = incremental.update_map(older.unionByName(vanished), *assets, words=WORDS)
    state = incremental.update_map(later, *assets, state, words=WORDS)
    return incremental.mapping_of(incremental.update_map(now, *assets, state, words=WORDS))


def entity_store_partial(spark: SparkSession, d: str) -> DataFrame:
    """A store of customers and nations after an update of debtors, a deletion, and a new kind."""
    root = scratch_path(spark, "store")
    store.create_store(_both_kinds(spark, d), root)
    debtors = E.make_entity(
        table(spark, d, "customer").where("c_acctbal < 0"),
        "customer",
        qualified_name=F.concat(F.lit("cat://test/c/"), F.col("c_custkey").cast("string")),
        name=F.lower("c_name"),
        attributes={"segment": F.lit("IN DEBT")},
    )
    gone = views.nation_entities(spark, d).where(F.startswith("name", F.lit("F")))
    store.update_store(spark, root, debtors, gone)
    store.update_store(spark, root, _customer_tables(spark, d))
    return store.read_store(spark, root).select("type_name", "qualified_name", "name", F.col("attributes")["segment"].alias("segment"))


def json_listing_all(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a listing body whose objects have different and nested fields."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    doc_id = F.col("doc_id").cast("string")
    folder = F.struct(F.concat(F.lit("d"), doc_id).alias("object_id"), F.col("source").alias("path"), F.lit("DIRECTORY").alias("object_type"))
    info = F.struct(F.col("n_chars").alias("size"), F.col("lang").alias("language"))
    script = F.struct(doc_id.alias("object_id"), F.col("source").alias("path"), F.col("doc_id").alias("created_at"), info.alias("info"))
    parts = F.concat_ws(",", F.to_json(folder), F.to_json(script))
    body = F.concat(F.lit('{"objects":['), parts, F.lit("]}"))
    found = script_source.parse_listing_all(docs.select(body.alias("body")))
    return found.select("object_id", "path", "object_type", "created_at", *[F.col(f"`info.{c}`").alias(c) for c in ("size", "language")])


def csv_plain(spark: SparkSession, d: str) -> DataFrame:
    """Lines of the documents with backslashes and quotes, in a CSV that another writer left, as a map."""
    lines = script_source.number_lines(views.scripts(spark, d))
    rows = lines.select(
        F.concat_ws("#", "path", F.col("pos").cast("string")).alias("notebook"),
        F.concat(F.lit("C:\\new\\raw "), "line", F.lit('"')).alias("source"),
        F.when(F.col("pos") % 3 > 0, F.concat(F.lit("a\nb\\\\"), "line")).alias("target"),
    )
    path = scratch_path(spark, "plain-csv")
    rows.write.option("header", "true").option("escape", '"').csv(path)
    return files.read_map(spark, path, escaped=False)


def _glossary(spark: SparkSession, d: str) -> DataFrame:
    return E.make_entity(
        table(spark, d, "region"),
        E.TERM,
        qualified_name=F.concat("r_name", F.lit("@Glossary")),
        name=F.col("r_name"),
        attributes={},
    )


def term_assign(spark: SparkSession, d: str) -> DataFrame:
    return terms.assign_terms(views.customer_entities(spark, d), _glossary(spark, d), TERMS)


def term_unassign(spark: SparkSession, d: str) -> DataFrame:
    """Customers carry their nation and segment as terms; BUILDING is taken from those in debt."""
    meaning = lambda guid: F.struct(guid.alias("guid"), F.concat(F.lit("rel-"), guid).alias("relationship_guid"))
    nation = F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string"))
    carried = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("guid"),
        F.array(meaning(nation), meaning(F.col("c_mktsegment"))).alias("meanings"),
        "c_acctbal",
    )
    held = terms.assignments_of(carried)
    debtors = carried.where("c_acctbal < 0").select(
        F.col("guid").alias("table_guid"), F.lit("BUILDING").alias("term_guid")
    )
    return terms.unassign_terms(held, debtors)


QUERIES = {
    "inventory_tables": inventory_tables,
    "inventory_columns": inventory_columns,
    "table_detail": table_detail,
    "catalog_tables": catalog_tables,
    "catalog_columns": catalog_columns,
    "catalog_detail": catalog_detail,
    "catalog_entities": catalog_entities,
    "table_names_split": table_names_split,
    "nonempty_filter": nonempty_filter,
    "preview": preview,
    "qualified_names": qualified_names,
    "asset_names": asset_names,
    "csv_assets": csv_assets,
    "script_lines": script_lines,
    "path_like": path_like,
    "writing_scripts": writing_scripts,
    "writing_counts": writing_counts,
    "json_listing": json_listing,
    "path_tree": path_tree,
    "path_tree_kinds": path_tree_kinds,
    "match_source": match_source,
    "match_target": match_target,
    "match_wildcards": match_wildcards,
    "match_counts": match_counts,
    "lineage_map": lineage_map,
    "lineage_scan": lineage_scan,
    "lineage_all_matches": lineage_all_matches,
    "lineage_evidence": lineage_evidence,
    "lineage_edges": lineage_edges,
    "lineage_jobs": lineage_jobs,
    "lineage_unresolved": lineage_unresolved,
    "lineage_files": lineage_files,
    "csv_odd_roundtrip": csv_odd_roundtrip,
    "text_odd_roundtrip": text_odd_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "text_roundtrip": text_roundtrip,
    "entity_build": entity_build,
    "entity_columns": entity_columns,
    "entity_guid": entity_guid_query,
    "entity_json": entity_json,
    "entity_search": entity_search,
    "entity_lookup": entity_lookup,
    "entity_misses": entity_misses,
    "entity_upsert": entity_upsert,
    "entity_store": entity_store,
    "entity_delete": entity_delete,
    "entity_delete_by_search": entity_delete_by_search,
    "column_parent": column_parent,
    "type_check": type_check,
    "type_replace": type_replace,
    "relation_broken": relation_broken,
    "relation_faults": relation_faults,
    "type_inherited": type_inherited,
    "entity_cascade": entity_cascade,
    "entity_cascade_left": entity_cascade_left,
    "entity_index_search": entity_index_search,
    "entity_index_page": entity_index_page,
    "lineage_incremental": lineage_incremental,
    "entity_store_partial": entity_store_partial,
    "json_listing_all": json_listing_all,
    "csv_plain": csv_plain,
    "type_delete": type_delete,
    "type_orphans": type_orphans,
    "term_assign": term_assign,
    "term_unassign": term_unassign,
}
