"""An entity table on files of which an update rewrites only the parts it touches.

Below the root, `data/generation=…/type_name=…/bucket=…` holds the rows, a bucket
being a hash of the key, and `manifests/<generation>` names for every (type,
bucket) the generation that holds it now. An update writes a new generation of the
parts that its rows fall in, then a manifest, and last one small file in
`commits`, numbered on from the one before. Readers take the last commit, so
until it is there they see the old table, whole; a write that fails leaves files
that no manifest names. Two writers cannot make the same commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.entities import upsert
from ..session import materialize

BUCKETS = 16
KEYS = ["type_name", "qualified_name"]


def _files(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _commits(spark: SparkSession, root: str) -> list[str]:
    files, where = _files(spark, f"{root}/commits")
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where) if status.getLen())


def _last(spark: SparkSession, root: str) -> tuple[int, str, int, StructType] | None:
    """(number, generation, buckets, schema) of the last commit."""
    names = _commits(spark, root)
    if not names:
        return None
    generation, buckets, schema = spark.read.text(f"{root}/commits/{names[-1]}", wholetext=True).first()[0].split("\n", 2)
    return int(names[-1]), generation, int(buckets), StructType.fromJson(json.loads(schema))


def _commit(spark: SparkSession, root: str, number: int, generation: str, buckets: int, schema: StructType) -> None:
    files, where = _files(spark, f"{root}/commits/{number:012d}")
    out = files.create(where, False)  # fails if another writer was first
    out.write(bytearray(f"{generation}\n{buckets}\n{schema.json()}".encode()))
    out.close()


def _manifest(spark: SparkSession, root: str, generation: str) -> DataFrame:
    return spark.read.schema("type_name string, bucket int, generation string").parquet(f"{root}/manifests/{generation}")


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("qualified_name"), F.lit(buckets)).cast("int"))


def _write(rows: DataFrame, root: str, generation: str) -> None:
    """Rows with `bucket`; a part is written by as many tasks as the shuffle's skew handling makes of it."""
    rows = rows.hint("rebalance", "type_name", "bucket")
    rows.write.mode("errorifexists").partitionBy("type_name", "bucket").parquet(f"{root}/data/generation={generation}")


def _parts(spark: SparkSession, root: str, generation: str, schema: StructType) -> DataFrame:
    """(type_name, bucket, generation) of what a generation holds."""
    rows = _data(spark, root, schema).where(F.col("generation") == generation)
    return rows.select("type_name", "bucket", "generation").distinct()


def _data(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    whole = StructType([*schema.fields, StructField("generation", StringType()), StructField("bucket", IntegerType())])
    return spark.read.schema(whole).parquet(f"{root}/data")


def create_store(entities: DataFrame, root: str, *, buckets: int = BUCKETS) -> None:
    """The first generation; the root must not have one."""
    spark = entities.sparkSession
    if _last(spark, root) is not None:
        raise ValueError(f"there is a store in {root}")
    generation = uuid.uuid4().hex
    _write(_bucketed(entities, buckets), root, generation)
    _parts(spark, root, generation, entities.schema).write.parquet(f"{root}/manifests/{generation}")
    _commit(spark, root, 1, generation, buckets, entities.schema)


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """The entities of the last commit.

    The manifest has a row per type and bucket, a number that does not grow with
    the entities; joined as a broadcast it prunes the generations that have gone.
    """
    last = _last(spark, root)
    if last is None:
        raise ValueError(f"no store in {root}")
    _, generation, _, schema = last
    live = F.broadcast(_manifest(spark, root, generation))
    return _data(spark, root, schema).join(live, ["generation", "type_name", "bucket"], "left_semi").select(*schema.names)


def update_store(
    spark: SparkSession, root: str, updates: DataFrame | None = None, gone: DataFrame | None = None, order: list[str] | None = None
) -> None:
    """Replace or add the rows of `updates`, drop those with the keys in `gone`, in one commit.

    Only parts with such keys are read and written again. `order` is as for `upsert`.
    A key that is in both is dropped.
    """
    last = _last(spark, root)
    if last is None:
        raise ValueError(f"no store in {root}")
    number, before, buckets, schema = last
    fresh = _data(spark, root, schema).select(*schema.names).where(F.lit(False)) if updates is None else updates
    names = [*schema.names, *[c for c in order or [] if c not in schema.names]]
    fresh = materialize(_bucketed(fresh.select(*names), buckets), "updates")
    lost = fresh.select(*KEYS, "bucket").where(F.lit(False)) if gone is None else _bucketed(gone.select(*KEYS), buckets)
    lost = materialize(lost.distinct(), "gone")
    touched = fresh.select("type_name", "bucket").unionByName(lost.select("type_name", "bucket")).distinct()
    touched = F.broadcast(materialize(touched, "touched"))  # types times buckets at most
    live = F.broadcast(_manifest(spark, root, before).join(touched, ["type_name", "bucket"], "left_semi"))
    old = _data(spark, root, schema).join(live, ["generation", "type_name", "bucket"], "left_semi")
    merged = upsert(old.select(*schema.names, "bucket"), fresh, KEYS, order).select(*schema.names, "bucket")
    merged = merged.join(lost.select(*KEYS), KEYS, "left_anti")
    generation = uuid.uuid4().hex
    _write(merged, root, generation)
    kept = _manifest(spark, root, before).join(touched, ["type_name", "bucket"], "left_anti")
    made = _parts(spark, root, generation, schema)
    kept.unionByName(made).write.parquet(f"{root}/manifests/{generation}")
    _commit(spark, root, number + 1, generation, buckets, schema)
