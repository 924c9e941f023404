"""Search by an inverted index of three-letter pieces, with ranked hits in pages.

The index is three tables below one folder, each partitioned by a number of
buckets that does not grow with the data:

- `pieces` (piece, n): in how many entities a piece stands;
- `postings` (piece, part, guid): the entities a piece stands in;
- `entities` by `part`, a hash of the guid.

A search looks the keyword's pieces up in their buckets, takes the rarest, reads the
postings of those buckets and the parts that their entities are in, and checks the
whole keyword there. Partition filters and dynamic pruning keep the rest unread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import grams_of
from .entities import matches_search
from .joins import BROADCAST_BYTES, hot_keys

PIECE = 3
BUCKETS = 64
RAREST = 3
# What a hit of a candidate takes in a broadcast: guid, part and overhead.
HIT_BYTES = 160
SEARCHED = ("qualified_name", "name", "type_name")
ORDER = ("score", "qualified_name", "guid")


def _bucket(column: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def write_index(entities: DataFrame, path: str, *, buckets: int = BUCKETS) -> None:
    """Write the index of an entity table to a new folder.

    Pieces that many entities have are dealt over several tasks, so no task
    writes all postings of one.
    """
    placed = entities.withColumn("part", _bucket("guid", buckets))
    placed.repartition("part").write.partitionBy("part").parquet(f"{path}/entities")
    pieces = [F.coalesce(grams_of(F.lower(c), PIECE), F.array().cast("array<string>")) for c in SEARCHED]
    every = F.array_distinct(F.concat(*pieces))
    stored = read_part(entities.sparkSession, path, "entities")
    postings = stored.select("part", "guid", F.explode(every).alias("piece"))
    hot = F.broadcast(hot_keys(postings, ["piece"], buckets))
    salt = F.coalesce(F.pmod(F.xxhash64("guid"), F.col("_salts")).cast("int"), F.lit(0))
    dealt = postings.withColumn("bucket", _bucket("piece", buckets)).join(hot, "piece", "left").withColumn("salt", salt)
    dealt = dealt.repartition("bucket", "salt").select("bucket", "piece", "part", "guid")
    dealt.sortWithinPartitions("bucket", "piece").write.partitionBy("bucket").parquet(f"{path}/postings")
    counts = read_part(entities.sparkSession, path, "postings").groupBy("bucket", "piece").agg(F.count(F.lit(1)).alias("n"))
    counts.repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/pieces")


def read_part(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")


def search_index(
    spark: SparkSession, path: str, keyword: str, type_name: str | None = None, *, buckets: int = BUCKETS
) -> DataFrame:
    """The entities that `search_entities` finds, with a `score`: 0 is the best.

    A keyword of fewer than three letters has no piece, and all entities are read.
    `buckets` is that of `write_index`.
    """
    word = keyword.lower()
    entities = read_part(spark, path, "entities")
    pieces = sorted({word[i : i + PIECE] for i in range(len(word) - PIECE + 1)})
    if pieces:
        # At most one row per piece of the keyword.
        known = {r["piece"]: r["n"] for r in _of_pieces(read_part(spark, path, "pieces"), pieces, buckets).collect()}
        if len(known) < len(pieces):
            return _scored(entities.where(F.lit(False)), word)
        chosen = sorted(known, key=lambda piece: (known[piece], piece))[:RAREST]
        found = _of_pieces(read_part(spark, path, "postings"), chosen, buckets)
        candidates = found.groupBy("part", "guid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(chosen)).drop("n")
        if known[chosen[0]] * HIT_BYTES <= BROADCAST_BYTES:
            candidates = F.broadcast(candidates)
        entities = entities.join(candidates, ["part", "guid"], "left_semi")
    return _scored(entities.where(matches_search(keyword, type_name)), word)


def _of_pieces(table: DataFrame, pieces: list[str], buckets: int) -> DataFrame:
    # Hashes of constants are constants, so the buckets are partition filters.
    places = [_bucket(F.lit(p), buckets) for p in pieces]
    return table.where(F.col("bucket").isin(places) & F.col("piece").isin(pieces)).drop("bucket")


def _scored(hits: DataFrame, word: str) -> DataFrame:
    """Best are names that are the keyword, then those that begin with it, have it, keys, types."""
    name, key = F.lower("name"), F.lower("qualified_name")
    score = (
        F.when(name == word, 0)
        .when(F.startswith(name, F.lit(word)), 1)
        .when(F.contains(name, F.lit(word)), 2)
        .when(F.contains(key, F.lit(word)), 3)
        .otherwise(4)
    )
    return hits.drop("part").withColumn("score", score)


def page(hits: DataFrame, size: int, after: tuple | None = None) -> DataFrame:
    """The next `size` hits behind the row with the `ORDER` values `after`, best first.

    Pages stay right when entities come or go between them, and no page counts
    the hits before it.
    """
    if after is not None:
        later = []
        for i, column in enumerate(ORDER):
            same = [F.col(c) == v for c, v in zip(ORDER[:i], after)]
            later.append(reduce(lambda a, b: a & b, [*same, F.col(column) > after[i]]))
        hits = hits.where(reduce(lambda a, b: a | b, later))
    return hits.orderBy(*ORDER).limit(size)
