"""What several operators share: Arrow batches, word hashes, ranges with their neighbours."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# -- tables -------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_mod(column: str | Column, n: int) -> Column:
    """crc32 of the value written as text, modulo n; NULL counts as the empty text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(value.cast("string"), F.lit(""))) % n


def spread(docs: DataFrame, *keys: str) -> DataFrame:
    """Deal a scan anew that has fewer tasks than the cluster has cores; others stay as they are."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() >= cores else docs.repartition(cores, *keys)


def without(docs: DataFrame, *names: str) -> DataFrame:
    """Less the columns that an operator adds itself; those of the input give way."""
    return docs.drop(*names)


def fields_of(df: DataFrame) -> list[str]:
    """The columns as parts of a schema string."""
    return [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]


# Ranges of a key at most: their bounds are constants of the plan.
RANGES = 16384


def parts_for(amount: int, each: int, least: int = 1) -> int:
    return int(max(least, math.ceil((amount or 0) / each)))


def total_bytes(docs: DataFrame, text: str) -> int:
    """Bytes of a text column: one number from one aggregation."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0])


# -- Arrow --------------------------------------------------------------------


def give_back() -> None:
    """Return freed memory to the system; a worker lives on after its task and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over the batches of a partition, giving memory back at its end."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`fn` over each Arrow batch of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(tidy(run), schema)


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def in_chunks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [lo, hi) of texts of about `limit` bytes; a longer text is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def text_runs(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets from 0) of runs of texts."""
    data, offsets = utf8_parts(column)
    for lo, hi in in_chunks(offsets, limit):
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


# -- words --------------------------------------------------------------------

_U = np.uint64
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_powers = np.cumprod(np.full(256, _STEP, np.uint64))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.full(2 * n, _STEP, np.uint64))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, place of each text's first word, and the end).

    Words are runs without space, tab and line ends, with A-Z lower-cased.
    """
    is_word = _IS_WORD[data]
    begin = is_word.copy()
    begin[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begin[heads] = is_word[heads]
    starts = np.flatnonzero(begin)
    place = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), place
    where = np.flatnonzero(is_word)
    firsts = np.cumsum(is_word)[starts] - 1
    lengths = np.diff(np.append(firsts, len(where)))
    at = np.arange(len(where)) - np.repeat(firsts, lengths)
    values = _BYTE[_LOWER[data[where]]] * _power(int(lengths.max()))[at]
    return mix(np.add.reduceat(values, firsts) + lengths.astype(np.uint64)), place


_FACTORS = _random.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)


def shingle_hashes(words: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words, place of each text's first run, and the end).

    A text of fewer words gives its whole sequence as one, a text without words none.
    """
    counts = np.diff(place)
    runs = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    total = int(bounds[-1])
    if not total:
        return np.zeros(0, np.uint64), bounds
    start = np.arange(total) + np.repeat(place[:-1] - bounds[:-1], runs)
    length = np.repeat(np.minimum(counts, k), runs)
    out = length.astype(np.uint64)
    short = bool((length < k).any())
    for j in range(k):
        if short:
            has = length > j
            out += np.where(has, words[np.where(has, start + j, 0)] * _FACTORS[j], _U(0))
        else:
            out += words[start + j] * _FACTORS[j]
    return mix(out), bounds


# -- keys ---------------------------------------------------------------------

# A Bloom filter of 64-bit words: a word per four keys, four bits per key. At most 64 MB of words.
KEYS_A_WORD, ROW_BITS, MOST_WORDS = 4, 5, 1 << 23


def maybe_among(rows: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose `key` is among the `count` keys, and about one in a hundred of the others.

    Only bits are sent to the tasks, so that rows without a key there need not be
    shuffled; a join with `keys` tells the rest. Of more keys than KEYS_A_WORD
    times MOST_WORDS, more of the others come through.
    """
    wide = 1 << ROW_BITS
    size = wide * parts_for(min(count // KEYS_A_WORD + 1, MOST_WORDS), wide)
    word, bits = F.pmod(F.xxhash64(key, F.lit("word")), F.lit(size)), F.xxhash64(key, F.lit("bits"))
    row, at = F.shiftright(word, ROW_BITS), word.bitwiseAND(F.lit(wide - 1)).cast("int")
    places = [F.shiftright(bits, n).bitwiseAND(F.lit(63)).cast("int") for n in (0, 6, 12, 18)]
    mask = reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places])
    words = keys.select(row.alias("_row"), at.alias("at"), mask.alias("word")).groupBy("_row", "at").agg(F.bit_or("word").alias("word"))
    filled = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("word"))
    all_words = F.transform(F.sequence(F.lit(0), F.lit(wide - 1)), lambda i: F.coalesce(F.col("word")[i], F.lit(0).cast("long")))
    filled = F.broadcast(filled.select("_row", all_words.alias("_words")))
    missing = F.bitwise_not(F.get("_words", at)).bitwiseAND(mask)
    return rows.join(filled, (row == F.col("_row")) & (missing == 0), "left_semi")


# -- ranges -------------------------------------------------------------------


def split_points(df: DataFrame, key: str, parts: int, sample: int = 20000) -> list:
    """Up to parts - 1 values of `key` that cut the rows into ranges of like size.

    They come from a sample by hash of about `sample` different values, and
    steer only how rows are dealt out. There are at most RANGES of them.
    """
    parts = min(parts, RANGES)
    if parts < 2:
        return []
    keys = df.select(key).where(F.col(key).isNotNull())
    share = min(1.0, sample / max(1, keys.count()))
    picked = F.pmod(F.xxhash64(key, F.lit("split")), F.lit(1 << 30)) < int(share * (1 << 30))
    # Different values only: a frequent one comes once.
    values = sorted(r[0] for r in keys.where(picked).distinct().collect())
    points = {values[len(values) * i // parts] for i in range(1, parts)} if values else set()
    return sorted(points - set(values[:1]))


def range_of(key: str, points: list) -> Column:
    """Number of split points up to the key, 0 for NULL."""
    if not points:
        return F.lit(0)
    wide = max(1, math.isqrt(len(points)))
    groups = [points[i : i + wide] for i in range(0, len(points), wide)]
    upto = lambda values: F.size(F.filter(values, lambda p: p <= F.col(key)))
    whole = F.array(*[F.lit(g[-1]) for g in groups])
    inner = F.get(F.array(*[F.array(*[F.lit(v) for v in g]) for g in groups]), upto(whole))
    part = F.when(upto(whole) < len(groups), upto(whole) * wide + upto(inner)).otherwise(len(points))
    return F.when(F.col(key).isNull(), 0).otherwise(part).cast("int")
