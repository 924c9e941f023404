"""Walk a folder tree given as a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .joins import BROADCAST_BYTES, keyed_join, measured_bytes

# The kinds of a listing that are walked.
FOLDER, SCRIPT = "DIRECTORY", "NOTEBOOK"


def walk_tree(listing: DataFrame, root: str, *, bound: int = BROADCAST_BYTES) -> DataFrame:
    """Listing rows a walk from `root` reaches, with `depth`; other kinds are not entered.

    `listing` has `path` and `object_type`. A path tells all its ancestors, so
    no level-by-level loop is needed: a row is reached exactly if every folder
    between the root and itself is listed as one. Only distinct folders are
    compared, and in a complete listing none is missing and no join is left.
    """
    root = root.rstrip("/")
    below = F.substring("path", F.lit(len(root) + 2), F.length("path"))
    rows = (
        listing.where(F.col("path").startswith(root + "/") & F.col("object_type").isin(FOLDER, SCRIPT))
        .withColumn("depth", F.size(F.split(below, "/")))
        .withColumn("parent", F.regexp_extract("path", r"(?s)\A(.*)/", 1))
    )
    rows = materialize(rows, "listed")
    parents = rows.where("depth > 1").select("parent", (F.col("depth") - 1).alias("above")).distinct()
    segments = F.split(F.substring("parent", F.lit(len(root) + 2), F.length("parent")), "/")
    ancestors = F.transform(
        F.sequence(F.lit(1), F.col("above")), lambda i: F.concat_ws("/", F.lit(root), F.array_join(F.slice(segments, F.lit(1), i), "/"))
    )
    chains = parents.select("parent", F.explode(ancestors).alias("folder"))
    folders = rows.where(F.col("object_type") == FOLDER).select(F.col("path").alias("folder"))
    absent = materialize(chains.select("folder").distinct().join(folders, "folder", "left_anti"), "absent")
    size = measured_bytes(absent)
    if size > 0:
        cut_off = keyed_join(chains, absent, ["folder"], "left_semi", ["parent"], bound=bound, right_bytes=size)
        cut_off = materialize(cut_off.select("parent").distinct(), "cut-off")
        rows = keyed_join(rows, cut_off, ["parent"], "left_anti", ["path"], bound=bound)
    return rows.drop("parent").select(*listing.columns, "depth")


def scripts_of(reached: DataFrame) -> DataFrame:
    return reached.where(F.col("object_type") == SCRIPT)


def folders_of(reached: DataFrame) -> DataFrame:
    return reached.where(F.col("object_type") == FOLDER)


def count_kinds(rows: DataFrame) -> DataFrame:
    """(object_type, objects): listing rows by kind."""
    return rows.groupBy("object_type").agg(F.count(F.lit(1)).alias("objects"))
