"""Equi-joins whose right side is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(schema: T.StructType) -> Column:
    """Bytes a row holds: string lengths (nested values as text) plus 16 per field."""
    width = F.lit(16 * len(schema.fields))
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Sum of `row_bytes`. Runs an aggregation, so give it a written or small table."""
    return df.agg(F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0))).first()[0]


def materialize_measured(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """The written table and its `measured_bytes`, both from one job."""
    seen = Observation(f"bytes of {label}")
    size = F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes")
    return materialize(df.observe(seen, size), label), seen.get["bytes"]


def hot_keys(left: DataFrame, on: list[str], parts: int) -> DataFrame:
    """(on, _salts): keys with more than one part in `parts` of the rows, at most `parts` of them.

    A key gets four salts for each part it fills, so all together get about four
    times `parts`.
    """
    counts = materialize(left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    salts = F.ceil(F.col("_n") * 4 * parts / max(total, 1)).cast("int")
    return counts.where(F.col("_n") * parts > total).select(*on, salts.alias("_salts"))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread_by: list[str]) -> DataFrame:
    """Shuffled equi-join that splits the hot keys of the left side over many tasks.

    Hot is a key with more rows than an even part of the shuffle; only the right
    rows of such keys are copied, once per salt. The salt is a hash of
    `spread_by`, so a retried task computes it again. The right side is never
    broadcast, however small its files look.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, on, parts))
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_salts")).cast("int"), F.lit(0))
    left = left.join(hot, on, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return left.join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str],
    *,
    bound: int = BROADCAST_BYTES,
    right_bytes: int | None = None,
) -> DataFrame:
    """Broadcast `right` if it is measured to fit `bound`, else join salted."""
    size = measured_bytes(right) if right_bytes is None else right_bytes
    if size <= bound:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, spread_by)
