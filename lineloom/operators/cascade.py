"""Deleting what belongs to the deleted: closure over compositions, dependants first."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .joins import keyed_join

# Rounds after which the reached entities are written as one table again.
COMPACT = 16


def composition_edges(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """(owner, owned): guids of entities that a composition ties together.

    A reference counts if a relation of category COMPOSITION has its field and
    both its types; it may be held by either end. The end that the relation
    marks as container owns the other.
    """
    made = relations.where("category = 'COMPOSITION' AND parent_container <> child_container")

    def end(mine: str, other: str) -> DataFrame:
        return made.select(
            F.col(f"{mine}_type").alias("type_name"),
            F.col(f"{mine}_field").alias("field"),
            F.col(f"{other}_type").alias("target_type"),
            F.col(f"{mine}_container").alias("owns"),
        )

    ends = end("child", "parent").unionByName(end("parent", "child")).distinct()
    held = entities.select("type_name", "guid", F.explode("relationships").alias("r"))
    held = held.select("type_name", F.col("r.name").alias("field"), F.col("r.type_name").alias("target_type"), "guid", F.col("r.guid").alias("target"))
    tied = keyed_join(held, ends, ["type_name", "field", "target_type"], "inner", ["guid"])
    owner = F.when(F.col("owns"), F.col("guid")).otherwise(F.col("target"))
    owned = F.when(F.col("owns"), F.col("target")).otherwise(F.col("guid"))
    return tied.select(owner.alias("owner"), owned.alias("owned")).where("owner IS NOT NULL AND owned IS NOT NULL")


def compact_guids(entities: DataFrame) -> DataFrame:
    """The entities with digests of 12 bytes as guids, also in their relationships.

    Guids are joined and shuffled again and again by a cascade; a digest is a fifth
    of a guid in hex. It is the start of the SHA-256, so that among a billion
    guids two meet with a chance of 1 in 10^11.
    """
    short = lambda guid: F.substring(F.unhex(F.sha2(guid, 256)), 1, 12)
    ends = F.transform(
        "relationships",
        lambda r: F.struct(r["name"].alias("name"), r["type_name"].alias("type_name"), r["qualified_name"].alias("qualified_name"), short(r["guid"]).alias("guid")),
    )
    return entities.withColumn("guid", short(F.col("guid"))).withColumn("relationships", ends)


def _guids(rows: DataFrame, column: str = "guid") -> DataFrame:
    return rows.select(F.col(column).alias("guid")).where("guid IS NOT NULL").distinct()


def _ranks(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(owner, owned) among owners, and (guid): all owners, both written.

    Most entities own nothing, and their edges lead nowhere further; so rounds
    go over the edges among owners only.
    """
    owners = materialize(_guids(edges, "owner"), "owners")
    inner = edges.join(owners.withColumnRenamed("guid", "owned"), "owned", "left_semi")
    return materialize(inner, "inner-edges"), owners


def _reached_owners(inner: DataFrame, owners: DataFrame, hits: DataFrame) -> DataFrame:
    """(guid): the owners among the hits, and all owners that they own at any depth.

    Each round joins only the entities found in the round before with the edges;
    what a round finds is written, and rounds end when nothing is new, so rings
    of owners end too.
    """
    fresh = reached = materialize(_guids(hits).join(owners, "guid", "left_semi"), "reached")
    rounds = 0
    while not fresh.isEmpty():
        found = inner.join(fresh.withColumnRenamed("guid", "owner"), "owner").select(F.col("owned").alias("guid"))
        fresh = materialize(found.distinct().join(reached, "guid", "left_anti"), "reached")
        reached, rounds = reached.unionByName(fresh), rounds + 1
        if rounds % COMPACT == 0:
            reached = materialize(reached, "reached")
    return reached


def _owned_by(edges: DataFrame, owners: DataFrame) -> DataFrame:
    return edges.join(owners.withColumnRenamed("guid", "owner"), "owner", "left_semi").select(F.col("owned").alias("guid"))


def belongings(edges: DataFrame, hits: DataFrame) -> DataFrame:
    """(guid): the hits and all that they own, at any depth."""
    edges = edges.where("owner <> owned")
    inner, owners = _ranks(edges)
    return _guids(hits.select("guid").unionByName(_owned_by(edges, _reached_owners(inner, owners, hits))))


def deletion_order(edges: DataFrame, hits: DataFrame) -> DataFrame:
    """(guid, step, ring): what goes with the hits, and in which step.

    Everything that an entity owns goes in an earlier step. Entities of a ring of
    owners, and those that own one, have no such order; they go together in the
    last step, marked by `ring`.

    What owns nothing goes in the first step. Owners have theirs from the edges
    among them; all that the reached ones own is reached, too.
    """
    edges = materialize(edges.where("owner <> owned"), "edges")
    inner, owners = _ranks(edges)
    left = reached = materialize(_reached_owners(inner, owners, hits), "left")
    every = hits.select("guid").where("guid IS NOT NULL").unionByName(_owned_by(edges, reached))
    steps, step = [], 2
    held = inner.join(left.withColumnRenamed("guid", "owner"), "owner", "left_semi")
    while not left.isEmpty():
        # What owns nothing that is still there can go.
        held = materialize(held, "edges")
        ready = left.join(held.select(F.col("owner").alias("guid")).distinct(), "guid", "left_anti")
        ready = materialize(ready.withColumn("step", F.lit(step)).withColumn("ring", F.lit(False)), "ready")
        if ready.isEmpty():
            break
        steps.append(ready)
        left = materialize(left.join(ready, "guid", "left_anti"), "left")
        held = held.join(ready.select(F.col("guid").alias("owned")), "owned", "left_anti")
        step += 1
        if len(steps) == COMPACT:
            steps = [materialize(_union(steps), "ready")]
    if step == 2 and every.join(owners, "guid", "left_anti").isEmpty():
        step = 1  # all are owners without an order, so there is no first step before theirs
    steps.append(left.withColumn("step", F.lit(step)).withColumn("ring", F.lit(True)))
    # An owner that another owns is there with the first step as well; its own is later.
    first = every.withColumn("step", F.lit(1)).withColumn("ring", F.lit(False))
    return _union([first, *steps]).groupBy("guid").agg(F.max("step").alias("step"), F.max("ring").alias("ring"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def delete_cascading(entities: DataFrame, hits: DataFrame, relations: DataFrame) -> DataFrame:
    """What is left after removing the hits and all that belongs to them."""
    gone = belongings(materialize(composition_edges(entities, relations), "edges"), hits)
    return entities.join(gone, "guid", "left_anti")


def orphans(entities: DataFrame, relations: DataFrame) -> DataFrame:
    """Entities whose owner is named but not there."""
    edges = composition_edges(entities, relations)
    lost = edges.join(entities.select(F.col("guid").alias("owner")), "owner", "left_anti")
    return entities.join(lost.select(F.col("owned").alias("guid")).distinct(), "guid", "left_semi")
