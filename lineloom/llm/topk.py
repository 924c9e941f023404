"""Exact top-k search by inner product without random access (NRA).

Vectors are integers. A block of candidates keeps, for every component, its
rows sorted by that component. For a query the lists are read in step, from the
end that adds most to the score; each row read has a lower bound (what is known,
and the worst for the rest) and an upper bound (what is known, and the last
value read for the rest). Reading stops when no row outside the k best lower
bounds, read or not, can reach the k-th; the scores still open are resolved.
The best of all blocks are merged.

Queries are given as rows of their own and come in blocks of bounded size; each
block of queries meets each block of candidates through an equality on block
numbers.

Rows whose id or vector is null, or whose vector holds a null or a value that
is not finite, take no part. Components that one of two vectors lacks count as
0. A query's own id is no candidate for it, in any row; repeated query ids with
equal vectors are one query; repeated candidate rows are candidates each. Ties
go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import map_arrow, parts_for

CANDIDATES, QUERIES = 4096, 512
PORTIONS = 8  # in which the lists are read
ENOUGH = 20  # times k rows left open are resolved at once


def whole_numbers(vectors: DataFrame, *, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, ints): floor(scale * x) of each component of the vectors that take part."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    picked = vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(sound)
    return picked.select(
        F.col(key).cast("long").alias("id"), F.transform(values, lambda x: F.floor(x * scale).cast("long")).alias("ints")
    )


def _blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    """Rows gathered in `n` blocks by hash: (name, ids binary, ints binary, width int)."""

    def pack(key: tuple, part: pa.Table) -> pa.Table:
        ids, lists = part.column("id").to_numpy(), part.column("ints").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        matrix = np.zeros((len(ids), int(sizes.max())), np.int64)
        matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        order = np.argsort(ids, kind="stable")
        columns = [[key[0].as_py()], [ids[order].tobytes()], [matrix[order].tobytes()], [matrix.shape[1]]]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32()]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [name, "ids", "ints", "width"])

    block = F.pmod(F.xxhash64("id", "ints"), F.lit(n)).cast("int")
    return rows.withColumn(name, block).groupBy(name).applyInArrow(pack, f"{name} int, ids binary, ints binary, width int")


def best_of_block(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, matrix: np.ndarray, k: int):
    """For each query (positions, scores) of the k best candidates of a block, ties to the smaller id.

    All queries read the lists in step, a portion of every list at a time; the
    sums over what is read are matrix products. Each query stops by itself.
    """
    n, width = matrix.shape
    # Products and sums of whole numbers are exact as floats up to 2**53.
    largest = int(np.abs(matrix).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, width)
    kind = np.float64 if largest < 1 << 53 else np.int64
    lists = np.argsort(matrix, axis=0, kind="stable")  # rows by rising value of each component
    v, columns = matrix.astype(kind), np.arange(width)
    up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    least, most = v.min(0), v.max(0)
    from_top, from_end = np.zeros((n, width), kind), np.zeros((n, width), kind)  # 1 for what is read
    out: list = [None] * len(queries)
    going = np.arange(len(queries))
    read = 0
    for part in range(1, PORTIONS + 1):
        upto = n * part // PORTIONS
        from_top[lists[n - upto : n - read], columns] = 1
        from_end[lists[read:upto], columns] = 1
        read = upto
        if not read:
            continue
        u, d = up[going], down[going]
        known = u @ (v * from_top).T + d @ (v * from_end).T
        rest_top, rest_end = (1 - from_top).T, (1 - from_end).T
        lower = known + (u * least) @ rest_top + (d * most) @ rest_end
        last_top, last_end = v[lists[n - read], columns], v[lists[read - 1], columns]
        upper = known + (u * last_top) @ rest_top + (d * last_end) @ rest_end
        barred = own[going][:, None] == ids
        bottom = np.finfo(kind).min if kind is np.float64 else np.iinfo(kind).min
        lower[barred] = bottom
        kth = min(k, n)
        bar = np.partition(lower, n - kth, axis=1)[:, n - kth, None]
        still = (upper >= bar) & ~barred
        done = (still.sum(1) <= ENOUGH * k) | (read == n)
        for q in np.flatnonzero(done):
            rows = np.flatnonzero(still[q])
            scores = matrix[rows] @ queries[going[q]]
            order = np.lexsort((ids[rows], -scores))[:k]
            out[going[q]] = (rows[order], scores[order])
        going = going[~done]
        if not len(going):
            break
    return out


def _search(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    found: list[tuple[int, int, int]] = []
    for row in batch.to_pylist():
        ids = np.frombuffer(row["ids"], np.int64)
        own = np.frombuffer(row["query_ids"], np.int64)
        width = max(row["width"], row["query_width"], 1)
        widened = lambda raw, count, w: np.pad(np.frombuffer(raw, np.int64).reshape(count, w), ((0, 0), (0, width - w)))
        matrix = widened(row["ints"], len(ids), row["width"])
        queries = widened(row["query_ints"], len(own), row["query_width"])
        for lo in range(0, len(own), 128):
            best = best_of_block(queries[lo : lo + 128], own[lo : lo + 128], ids, matrix, k)
            for q, (rows, scores) in zip(own[lo : lo + 128].tolist(), best):
                found += zip([q] * len(rows), ids[rows].tolist(), scores.tolist())
    columns = list(zip(*found)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "id", "score"])


def top_k(
    candidates: DataFrame, queries: DataFrame, *, k: int = 5, per_block: int = CANDIDATES, per_query_block: int = QUERIES
) -> DataFrame:
    """(query_id, rank, id, score) from two frames (id long, ints array<long>)."""
    spark = candidates.sparkSession
    asked = queries.dropDuplicates(["id", "ints"])
    n_blocks = parts_for(candidates.count(), per_block)
    n_asked = parts_for(asked.count(), per_query_block)
    # Each block of queries goes to a few groups of candidate blocks, so that
    # few queries do not mean few tasks.
    groups = max(1, min(n_blocks, -(-spark.sparkContext.defaultParallelism * 3 // n_asked)))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = _blocks(candidates, n_blocks, "block").withColumn("group", F.pmod("block", F.lit(groups)))
    stored = stored.withColumn("query_block", number(n_asked))
    asking = _blocks(asked, n_asked, "query_block").withColumnsRenamed(
        {"ids": "query_ids", "ints": "query_ints", "width": "query_width"}
    ).withColumn("group", number(groups))
    met = stored.join(asking, ["query_block", "group"]).drop("block", "group", "query_block")
    found = map_arrow(met, lambda batch: _search(batch, k), "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
