"""Document fingerprints by consistent weighted sampling.

A document is the multiset of its five-word shingles (words lower-cased in A-Z;
fewer words are one shingle), each weighted by how often it stands there. For
each of the samples, a shingle draws r, c from Gamma(2, 1) and b from the unit
interval, all from its hash; its weight S gives t = floor(ln S / r + b) and
a = c exp(-r (t - b) - r), and the shingle with the least a is the sample. The
same (shingle, t) has the same a in every document, so the least a stands for
the sample, and two documents agree in a sample with a probability equal to
their generalised Jaccard similarity sum(min S) / sum(max S). A fingerprint
keeps 16 bits of each sample, as four hex digits.

Null texts and texts without words have the empty fingerprint; two of those are
alike (1), one of those and another document are not (0). Equal texts have
equal fingerprints. Null keys sort first. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import (
    fields_of,
    map_arrow,
    mix,
    parts_for,
    range_of,
    shingle_hashes,
    split_points,
    spread,
    text_runs,
    total_bytes,
    without,
    word_hashes,
)

SAMPLES = 48
SHINGLE = 5
BLOCK = 2048
_seeds = mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_U16 = np.float32(1 / 65536)


def sample_values(terms: np.ndarray, log_weight: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """ln a of each term and sample."""
    bits = mix(terms[:, None] ^ _seeds[:samples])
    b = ((bits * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.float32)
    u = bits.view(np.uint16).reshape(*bits.shape, 4).astype(np.float32)
    u += np.float32(0.5)
    u *= _U16
    b += np.float32(0.5)
    b *= _U16
    r = -np.log(u[..., 0] * u[..., 1])
    c = -np.log(u[..., 2] * u[..., 3])
    np.log(c, out=c)
    t = np.floor(log_weight[:, None] / r + b)
    t -= b
    t += 1
    t *= r
    c -= t
    return c


def term_weights(terms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How often each term stands in its text."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint64), np.diff(bounds))
    key = mix(terms + owner * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    counts = np.diff(np.append(first, len(key)))
    out = np.ones(len(terms), np.float32)
    many = np.repeat(counts, counts)
    out[order] = many
    return out


def signatures(texts: pa.Array, samples: int = SAMPLES, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(16 bits of each sample of each text, whether it has any word)."""
    out = np.zeros((len(texts), samples), np.uint16)
    some = np.zeros(len(texts), bool)
    for lo, hi, data, offsets in text_runs(texts):
        terms, bounds = shingle_hashes(*word_hashes(data, offsets), shingle)
        if not len(terms):
            continue
        weight = np.log(term_weights(terms, bounds))
        least = np.full((hi - lo, samples), np.inf, np.float32)
        owner = np.repeat(np.arange(hi - lo), np.diff(bounds))
        for at in range(0, len(terms), BLOCK):
            who = owner[at : at + BLOCK]
            values = sample_values(terms[at : at + BLOCK], weight[at : at + BLOCK], samples)
            first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
            part = np.minimum.reduceat(values, first, axis=0)
            least[who[first]] = np.minimum(least[who[first]], part)
        bits = least.view(np.uint32) * np.uint32(0x9E3779B1)
        out[lo:hi] = (bits >> np.uint32(16)).astype(np.uint16)
        some[lo:hi] = np.diff(bounds) > 0
    return out, some


def as_text(signs: np.ndarray, some: np.ndarray) -> list[str]:
    big = signs.astype(">u2")
    return [row.tobytes().hex() if has else "" for row, has in zip(big, some)]


def fingerprint(docs: DataFrame, *, text: str = "text", out: str = "fingerprint", samples: int = SAMPLES) -> DataFrame:
    """The columns of `docs` and the fingerprint of each whole text."""
    docs = without(docs, out)
    at = docs.columns.index(text)

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pa.array(as_text(*signatures(batch.column(at), samples)), pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, out])

    return map_arrow(spread(docs), add, ", ".join([*fields_of(docs), f"`{out}` string"]))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of the samples in which two fingerprints agree."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    groups = lambda x: F.regexp_extract_all(x, F.lit("([0-9a-f]{4})"), F.lit(1))
    same = F.size(F.filter(F.zip_with(groups(a), groups(b), lambda x, y: x == y), lambda s: s))
    both = (F.length(a) > 0) & (F.length(b) > 0)
    return F.when(both, same / (F.length(a) / 4)).otherwise((F.length(a) == F.length(b)).cast("double"))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


EDIT_SCHEMA = (
    "doc_id long, text string, edited string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _alike(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    same = (a == b).mean(1)
    return np.where(some_a & some_b, same, (some_a == some_b).astype(float))


def fingerprint_edits(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES, part_bytes: int = 4 << 20
) -> DataFrame:
    """Each document, its text edited with its successor's, and how alike the fingerprints are.

    The successor is the next in ascending doc_id, equal ids ordered by text;
    the last is followed by the first. The rows are dealt out by ranges of the
    id; those at a range's start are copied to the range before, so each task
    finds the successor of its last row. Tasks read their range as a stream.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    points = split_points(rows, "doc_id", parts_for(total_bytes(rows, "text"), part_bytes))
    last = len(points)
    lowest, missing = rows.agg(F.min("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    is_first = F.col("doc_id").isNull() if missing else F.col("doc_id") == F.lit(lowest)
    place = lambda part, copy: F.struct(part.cast("int").alias("part"), F.lit(copy).alias("copy"))
    own = range_of("doc_id", points)
    starts = F.coalesce(F.col("doc_id").isin(points), F.lit(False)) if points else F.lit(False)
    copies = F.array(
        place(own, 0),
        F.when(starts, place(own - 1, 1)),
        F.when(is_first, place(F.lit(last), 2)),
    )
    dealt = rows.select("doc_id", "text", F.explode(F.array_compact(copies)).alias("at")).select("doc_id", "text", "at.*")
    ordered = dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions("copy", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the row whose successor has not been read
        ended = False
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                if ended:
                    continue  # further copies; one successor is enough
                part = batch.slice(lo, 512)
                copied = part.column(2).to_numpy() > 0
                if copied.any():
                    part, ended = part.slice(0, int(copied.argmax()) + 1), True
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                signs, some = signatures(part.column(1), samples)
                if held:
                    keys, texts = [held[0], *keys], [held[1], *texts]
                    signs, some = np.concatenate([held[2], signs]), np.append(held[3], some)
                held = [keys[-1], texts[-1], signs[-1:], some[-1:]]
                n = len(keys) - 1
                if not n:
                    continue
                changed = pa.array([edited(texts[i], texts[i + 1]) for i in range(n)], pa.string())
                new, has = signatures(changed, samples)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[:n], pa.int64()),
                        pa.array(texts[:n], pa.string()),
                        changed,
                        pa.array(as_text(signs[:n], some[:n]), pa.string()),
                        pa.array(as_text(new, has), pa.string()),
                        pa.array(_alike(signs[:n], some[:n], new, has)),
                        pa.array(_alike(signs[:n], some[:n], signs[1:], some[1:])),
                    ],
                    [c.split()[0] for c in EDIT_SCHEMA.split(", ")],
                )

    return ordered.select("doc_id", "text", "copy").mapInArrow(run, EDIT_SCHEMA)
