"""Byte-level BPE encoding and decoding with a local rank file.

The tiktoken library does the merging. Long texts are first cut where no match
of the pattern can cross, so that each call is short: between a character that
is no white space and white space after it, and between a letter and a digit.

Null and empty texts give no ids. Ids outside the vocabulary fail. Other
columns of the input are kept, but for one named as the column added.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import fields_of, spread, without

LONG_TEXT = 1 << 16
# Every alternative of the pattern either starts with its only white space or is
# white space alone, and none mixes letters with digits.
_SAFE = re.compile(r"(?<=\S)(?=\s)|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (base64 bytes and rank on each line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if rank}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, limit: int = LONG_TEXT):
    """Cut a text into pieces of about `limit` characters at safe places only.

    A stretch without a safe place stays whole.
    """
    lo = 0
    while len(text) - lo > limit:
        cut = _SAFE.search(text, lo + limit)
        if cut is None:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    if len(text) <= LONG_TEXT:
        return enc.encode_ordinary(text)
    return [i for piece in safe_pieces(text) for i in enc.encode_ordinary(piece)]


def _local(path: str) -> str:
    """A path that exists on every executor, or the name of a file sent with addFile."""
    return SparkFiles.get(path[len("files:") :]) if path.startswith("files:") else path


def _schema_with(df: DataFrame, name: str, kind: str) -> str:
    return ", ".join([*fields_of(df), f"`{name}` {kind}"])


def encode(docs: DataFrame, *, text: str, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The columns of `docs` and `ids` array<int>.

    `ranks` is a path of the rank file on every executor, or ``files:NAME`` for
    one sent with SparkContext.addFile.
    """
    docs = without(docs, ids)
    at = docs.columns.index(text)

    def run(batches):
        enc = encoding(_local(ranks), pattern)
        for batch in batches:
            for part in _portions(batch, pc.binary_length(batch.column(at))):
                coded = [encode_text(enc, t) if t else [] for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(coded, pa.list_(pa.int32()))], [*part.schema.names, ids]
                )

    return spread(docs).mapInArrow(run, _schema_with(docs, ids, "array<int>"))


def _portions(batch: pa.RecordBatch, lengths: pa.Array, limit: int = 2 << 20):
    """Slices of a batch whose lengths add up to about `limit`, so that Python holds few values at a time."""
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = done = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo, done = hi, int(ends[hi - 1])


def decode(coded: DataFrame, *, ids: str = "ids", ranks: str, pattern: str, decoded: str = "decoded") -> DataFrame:
    """The columns of `coded` and `decoded` binary: the raw bytes of the ids, NULL ids as none."""
    coded = without(coded, decoded)
    at = coded.columns.index(ids)

    def run(batches):
        enc = encoding(_local(ranks), pattern)
        for batch in batches:
            for part in _portions(batch, pc.list_value_length(batch.column(at)), 1 << 19):
                raw = [enc.decode_bytes(i) if i else b"" for i in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(raw, pa.binary())], [*part.schema.names, decoded]
                )

    return coded.mapInArrow(run, _schema_with(coded, decoded, "binary"))
