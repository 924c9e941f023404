"""Entity types: definitions, defaults, required attributes, composition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize
from .entities import COLUMN, JOB, TABLE
from .joins import keyed_join

ATTRIBUTES = "array<struct<name:string,default:string,required:boolean>>"
RELATION_COLUMNS = (
    "name category parent_type parent_field parent_cardinality parent_container "
    "child_type child_field child_cardinality child_container"
).split()

# Attributes of the entity types, as (name, default, required), and their options.
TYPES = [
    (
        TABLE,
        ["DataSet"],
        [("format", "parquet", False), ("location", None, False), ("num_files", None, False), ("size", None, False)],
        {"schemaElementAttribute": "columns"},
    ),
    (COLUMN, ["DataSet"], [("data_type", None, False)]),
    (JOB, ["Process"], [("job_type", None, True), ("notebook_path", None, False), ("schedule", "adHoc", False)]),
]
# Columns are part of exactly one table.
RELATIONS = [("column_to_table", "COMPOSITION", TABLE, "columns", "SET", True, COLUMN, "table", "SINGLE", False)]


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values: list[str], kind: str) -> str:
    return f"CAST(array({', '.join(values)}) AS {kind})"


def type_table(spark: SparkSession, definitions=TYPES) -> DataFrame:
    """(type_name, super_types, attributes, options); options may be left out of a definition.

    Written as VALUES, so that a plan with it holds constants and no scan.
    """
    rows = []
    for name, supers, attributes, *rest in definitions:
        fields = [f"struct({_text(n)}, {_text(d)}, {str(bool(r)).lower()})" for n, d, r in attributes]
        options = [_text(x) for pair in (rest[0] if rest else {}).items() for x in pair]
        held = f"CAST(map({', '.join(options)}) AS map<string,string>)"
        rows.append(f"({_text(name)}, {_array([_text(x) for x in supers], 'array<string>')}, {_array(fields, ATTRIBUTES)}, {held})")
    if not rows:
        return spark.createDataFrame([], f"type_name string, super_types array<string>, attributes {ATTRIBUTES}, options map<string,string>")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(type_name, super_types, attributes, options)")


def relation_table(spark: SparkSession, definitions=RELATIONS) -> DataFrame:
    """One row per relation, by `RELATION_COLUMNS`; a container flag tells which end holds the other."""
    value = lambda x: str(x).lower() if isinstance(x, bool) else _text(x)
    rows = [f"({', '.join(value(x) for x in d)})" for d in definitions]
    if not rows:
        kinds = ["boolean" if c.endswith("container") else "string" for c in RELATION_COLUMNS]
        return spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in zip(RELATION_COLUMNS, kinds)))
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(RELATION_COLUMNS)})")


def check_types(entities: DataFrame, types: DataFrame) -> DataFrame:
    """Fill defaults and list in `missing` the required attributes without a value.

    `known` is false for an entity whose type is not defined; its attributes
    stay as they are.
    """
    given = F.coalesce(F.col("attributes"), F.create_map().cast("map<string,string>"))
    defined = F.transform("defs", lambda a: a["name"])
    filled = F.map_from_entries(
        F.transform("defs", lambda a: F.struct(a["name"], F.coalesce(F.element_at(given, a["name"]), a["default"])))
    )
    others = F.map_filter(given, lambda k, _: ~F.array_contains(defined, k))
    lacking = F.filter("defs", lambda a: a["required"] & F.element_at(given, a["name"]).isNull() & a["default"].isNull())
    definitions = types.select("type_name", F.col("attributes").alias("defs"))
    joined = keyed_join(entities, definitions, ["type_name"], "left", ["qualified_name"])
    known = F.col("defs").isNotNull()
    return joined.select(
        *[c for c in entities.columns if c != "attributes"],
        F.when(known, F.map_concat(filled, others)).otherwise(given).alias("attributes"),
        F.when(known, F.transform(lacking, lambda a: a["name"]))
        .otherwise(F.array().cast("array<string>"))
        .alias("missing"),
        known.alias("known"),
    )


# Both ends of the search upwards are told by the list of types seen, so a ring ends it.
_ANCESTORS = """
WITH RECURSIVE held AS (
    SELECT type_name AS sub, place, super FROM {types} LATERAL VIEW posexplode(super_types) AS place, super
), up(type_name, ancestor, way, seen, ring) AS (
    SELECT type_name, type_name, CAST(array() AS array<int>), array(type_name), false FROM {types}
    UNION ALL
    SELECT up.type_name, super, array_append(way, place), array_append(seen, super), super = up.type_name
    FROM up JOIN held ON sub = ancestor
    WHERE NOT ring AND (super = up.type_name OR NOT array_contains(seen, super))
)
SELECT type_name, ancestor, way, seen, ring FROM up
"""
_RECURSION = ("spark.sql.cteRecursionLevelLimit", "spark.sql.cteRecursionRowLimit")


def type_ancestors(types: DataFrame) -> DataFrame:
    """(type_name, ancestor, way, seen, ring): every way up from a type, itself with an empty way included.

    `way` has the place of each step in its list of super types, `seen` the types
    on it. A way that comes back to its type ends there, with `ring`. Super types
    that are not defined are ancestors too. The search has an end in any table, so
    the session's limits of recursion are lifted while the result is written.
    """
    spark = types.sparkSession
    known = materialize(types.select("type_name", "super_types"), "types")
    before = {name: spark.conf.get(name) for name in _RECURSION}
    try:
        for name in _RECURSION:
            spark.conf.set(name, "-1")
        return materialize(spark.sql(_ANCESTORS, types=known), "ancestors")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def inherited_types(types: DataFrame) -> DataFrame:
    """The types with the attributes of all their super types.

    Of several definitions of a name the nearest counts: the one fewest steps up,
    then the one by the super type named first. An attribute comes after those of
    nearer types. Rings of super types inherit from each other; `type_rings`
    reports them.
    """
    ways = type_ancestors(types).where("NOT ring").select("type_name", F.col("ancestor"), F.struct(F.size("way").alias("far"), "way").alias("at"))
    fields = types.select(F.col("type_name").alias("ancestor"), F.posexplode("attributes").alias("place", "attribute"))
    order = F.struct("at", "place")
    nearest = ways.join(fields, "ancestor").groupBy("type_name", F.col("attribute.name").alias("name")).agg(
        F.min_by("attribute", order).alias("attribute"), F.min(order).alias("order")
    )
    # As many as the type has attributes.
    merged = nearest.groupBy("type_name").agg(F.array_sort(F.collect_list(F.struct("order", "attribute"))).alias("found"))
    attributes = F.coalesce(F.transform("found", lambda f: f["attribute"]), F.array()).cast(ATTRIBUTES)
    rest = [c for c in types.columns if c != "attributes"]
    return types.drop("attributes").join(merged, "type_name", "left").select(*rest, attributes.alias("attributes"))


def type_rings(types: DataFrame) -> DataFrame:
    """(type_name, ring): types that are among their own super types, by their shortest way back."""
    back = type_ancestors(types).where("ring")
    return back.groupBy("type_name").agg(F.min_by("seen", F.struct(F.size("way"), "way")).alias("ring"))


def undefined_supers(types: DataFrame) -> DataFrame:
    """(type_name, super_type): super types that are not defined themselves."""
    named = types.select("type_name", F.explode("super_types").alias("super_type"))
    return named.join(types.select(F.col("type_name").alias("super_type")), "super_type", "left_anti").select("type_name", "super_type")


def delete_types(types: DataFrame, names: list[str]) -> DataFrame:
    return types.where(~F.col("type_name").isin(list(names)))


def broken_relations(relations: DataFrame, types: DataFrame) -> DataFrame:
    """Relations with an end whose type is not (or no longer) defined."""
    ends = F.explode(F.array("parent_type", "child_type")).alias("type_name")
    lost = relations.select("name", ends).join(types.select("type_name"), "type_name", "left_anti")
    return relations.join(lost.select("name").distinct(), "name", "left_semi")


def untyped_entities(entities: DataFrame, types: DataFrame) -> DataFrame:
    """Entities whose type is not (or no longer) defined."""
    return keyed_join(entities, types.select("type_name"), ["type_name"], "left_anti", ["qualified_name"])


def typed_entities(entities: DataFrame, types: DataFrame) -> DataFrame:
    """Entities whose type is defined."""
    return keyed_join(entities, types.select("type_name"), ["type_name"], "left_semi", ["qualified_name"])


def composition_faults(children: DataFrame, parents: DataFrame, child: str, parent: str) -> DataFrame:
    """Children that do not have exactly one existing parent: (child, parents).

    `children` is (child, parent) with a row per claimed link; `parents` has
    the column `parent` once per parent.
    """
    counted = _parents(children, parents, child, parent)
    return counted.where(F.col("parents") != 1)


def _parents(children: DataFrame, parents: DataFrame, child: str, parent: str) -> DataFrame:
    known = parents.select(F.col(parent).alias("_known"))
    linked = children.join(known, F.col(parent) == F.col("_known"), "left")
    return linked.groupBy(child).agg(F.count("_known").alias("parents"))


def relation_faults(
    links: DataFrame, relations: DataFrame, relation: str, parents: DataFrame, child: str, parent: str
) -> DataFrame:
    """Children that break a relation as the table of relations defines it: (child, parents).

    A child of a composition needs a parent; where the child's end is SINGLE it
    may not have more than one. The rest is as for `composition_faults`.
    """
    rule = relations.where(F.col("name") == relation).select("category", "child_cardinality").first()
    if rule is None:
        raise ValueError(f"no relation {relation}")
    counted = _parents(links, parents, child, parent)
    fault = F.lit(False)
    if rule.category == "COMPOSITION":
        fault = fault | (F.col("parents") < 1)
    if rule.child_cardinality == "SINGLE":
        fault = fault | (F.col("parents") > 1)
    return counted.where(fault)
