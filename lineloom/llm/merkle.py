"""Merkle manifest of a table: digests, roots and a proof for every row.

A row's leaf is the SHA-256 of its fields. Per group the leaves ascend by key
and every two consecutive nodes become their parent, until one is left, the
subroot; the subroots, by group, give the root in the same way. All digests are
lowercase hex text.

The tree is not kept. Only every `height`-th level is written, as (tree, place,
node) rows; a subtree between two written levels has at most 2 ** height leaves
and is one group of rows. Proofs come from the top down: each group computes the
missing nodes of its subtree anew from the written ones, adds to the way of its
top the siblings of each of its leaves, and forgets them. So no task holds more
than a subtree, whatever the size of a group of the input; places are counted by
ranges of the key, not by a window over a whole group.

Defined cases: an empty table gives no rows; NULL fields are `-`; rows without a
key come first in their group, rows of one key by their leaves; equal rows have
equal leaves and proofs of different places; NULL is a group of its own, before
the others, which follow by their bytes; a group of one row has its leaf as
subroot. Texts may have any length, as they are hashed where they are read.
Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .common import parts_for, range_of, split_points

HEIGHT = 8
RANGE_ROWS = 200_000
STEPS = "array<struct<before:string,after:string>>"
_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def row_digest(*fields: str | Column) -> Column:
    """SHA-256 of the fields, each as `-` or its length in bytes, `:` and its text."""
    parts = []
    for field in fields:
        value = (F.col(field) if isinstance(field, str) else field).cast("string")
        marked = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(marked, F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def manifest(
    rows: DataFrame, *, key: str, group: str, leaf: Column, carry: dict[str, Column] | None = None, height: int = HEIGHT
) -> DataFrame:
    """(key, group, leaf, subroot, root, steps, and the columns of `carry`) of every row.

    `steps` are the siblings up to the root; see `folded`. `key` ascends as a
    whole number if it is one, else by the bytes of its text.
    """
    carry = carry or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = rows.select(
        tree.alias("_tree"),
        F.col(key).alias("_of"),
        F.col(group).alias("_group"),
        leaf.alias("_node"),
        *[value.alias(f"_with_{name}") for name, value in carry.items()],
    )
    whole = isinstance(rows.schema[key].dataType, T.IntegralType)
    # The row's number makes equal rows different; it is read back, not counted again.
    order = F.concat_ws("-", _sortable("_of", whole), "_node", F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    leaves = materialize(leaves.withColumn("_order", order), "leaves")
    levels = _levels(leaves, height)
    tops = levels[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_order"), "_node")
    upper = _levels(materialize(tops, "subroots"), height)
    root = upper[-1].select(F.lit("").alias("_tree"), F.lit(0).cast("long").alias("_at"), F.col("_node").alias("_root"))
    root = root.withColumn("_steps", F.array().cast(STEPS))
    for level in reversed(upper):
        root = _ways(level, root, ["_root"], height)
    top = root.select(
        F.col("_order").alias("_tree"),
        F.lit(0).cast("long").alias("_at"),
        "_root",
        F.col("_node").alias("_subroot"),
        "_steps",
    )
    for level in reversed(levels):
        top = _ways(level, top, ["_root", "_subroot"], height)
    names = {"_of": key, "_group": group, "_node": "leaf", "_subroot": "subroot", "_root": "root", "_steps": "steps"}
    names |= {f"_with_{name}": name for name in carry}
    return top.select(*[F.col(c).alias(name) for c, name in names.items()])


def folded(leaf: str | Column, steps: str | Column = "steps") -> Column:
    """The root that a leaf and its steps lead to."""
    start = F.col(leaf) if isinstance(leaf, str) else leaf
    side = lambda step, name: F.coalesce(step[name], F.lit(""))
    return F.aggregate(
        steps, start, lambda node, step: F.sha2(F.concat(side(step, "before"), node, side(step, "after")), 256)
    )


def siblings(steps: str | Column = "steps") -> Column:
    """The digests of a proof, from the leaf's to the root's."""
    each = F.transform(steps, lambda step: F.coalesce(step["before"], step["after"]))
    return F.filter(each, lambda node: node.isNotNull())


def _sortable(column: str, whole: bool) -> Column:
    value = F.col(column)
    if whole:
        text = F.lpad(F.hex(value.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    else:
        text = value.cast("string")
    return F.when(value.isNull(), "0").otherwise(F.concat(F.lit("1"), text))


def _levels(nodes: DataFrame, height: int) -> list[DataFrame]:
    """The written levels, from the given nodes, with `_at` and `_size`, up to the tops of all trees."""
    levels = [materialize(_placed(nodes), "level")]
    while (levels[-1].agg(F.max("_size")).first()[0] or 0) > 1:
        levels.append(materialize(_raised(levels[-1], height), "level"))
    return levels


def _placed(nodes: DataFrame) -> DataFrame:
    """Add `_at`, the place from 0 within the tree, and `_size`, the tree's nodes."""
    points = split_points(nodes, "_order", parts_for(nodes.count(), RANGE_ROWS))
    dealt = nodes.withColumn("_range", range_of("_order", points))
    counts = dealt.groupBy("_tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("_tree")
    earlier = tree.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "_tree",
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(tree).alias("_size"),
    )
    nth = F.row_number().over(Window.partitionBy("_tree", "_range").orderBy("_order"))
    found = dealt.withColumn("_nth", nth).join(counts, ["_tree", "_range"])
    return found.withColumn("_at", F.col("_before") + F.col("_nth") - 1).drop("_range", "_nth", "_before")


def _digest(nodes: Iterable[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def _subtree(nodes: list[str], size: int, height: int) -> list[list[str]]:
    """The nodes and the levels above them: `height` of them, or as many as the whole tree has."""
    levels = [nodes]
    for _ in range(height if size > 1 << height else (size - 1).bit_length()):
        below = levels[-1]
        levels.append([_digest(below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def _raised(level: DataFrame, height: int) -> DataFrame:
    def top(table: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        size = table["_size"][0].as_py()
        nodes = _subtree(table["_node"].to_pylist(), size, height)[-1]
        place = table["_at"][0].as_py() >> height
        row = {"_tree": table["_tree"][0].as_py(), "_at": place, "_size": -(-size >> height), "_node": nodes[0]}
        return pa.Table.from_pylist([row], schema=made)

    made = pa.schema([("_tree", pa.string()), ("_at", pa.int64()), ("_size", pa.int64()), ("_node", pa.string())])
    rows = level.select("_tree", "_at", "_size", "_node")
    blocks = rows.groupBy("_tree", F.shiftright("_at", height).alias("_block"))
    return blocks.applyInArrow(top, "_tree string, _at long, _size long, _node string")


def _ways(level: DataFrame, above: DataFrame, known: list[str], height: int) -> DataFrame:
    """The nodes of a written level with their steps, from the steps of the level above.

    `above` is (_tree, _at, _steps, known columns) with a row per subtree of the level.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in level.schema.fields]
    schema = ", ".join([*fields, *[f"{c} string" for c in known], f"_steps {STEPS}"])

    def ways(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = table.sort_by("_at")
        levels = _subtree(table["_node"].to_pylist(), table["_size"][0].as_py(), height)
        beyond = upper["_steps"][0].as_py()
        steps = []
        for place in range(table.num_rows):
            own = []
            for nodes in levels[:-1]:
                other = place ^ 1
                node = nodes[other] if other < len(nodes) else None
                own.append({"before": node if place & 1 else None, "after": None if place & 1 else node})
                place >>= 1
            steps.append(own + beyond)
        for name in known:
            table = table.append_column(name, pa.array([upper[name][0].as_py()] * table.num_rows, pa.string()))
        return table.append_column("_steps", pa.array(steps, _STEPS))

    left = level.groupBy("_tree", F.shiftright("_at", height).alias("_block"))
    right = above.select("_tree", "_at", "_steps", *known).groupBy("_tree", "_at")
    return left.cogroup(right).applyInArrow(ways, schema)
