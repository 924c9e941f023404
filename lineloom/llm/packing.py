"""Packing of token ids into windows: best-fit decreasing with a segment tree.

Each document is its ids and a closing id. An overlong document is first cut
into full windows. The rests are taken by falling length, and each goes to the
open window with the least room that still holds it; a segment tree over the
remaining capacities finds that window. What room is left in the end is filled
by cutting the emptiest windows open, and the last rest becomes windows whose
fill is a power of two, which need no padding.

Each task packs its documents in groups of bounded size, so nothing is
shuffled and no window depends on the size of the corpus.

Null and empty texts are one piece, the closing id. Equal ids and repeated rows
are packed like others. Extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .bpe import encode_text
from .common import spread, tidy

GROUP_IDS = 2_000_000
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Rooms:
    """Open windows by remaining capacity; a segment tree over capacities 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = capacity + self.leaves
        while node and self.windows[capacity]:
            self.some[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest window with room for `need`, or None."""
        node = need + self.leaves
        if not self.some[node]:
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        window = self.windows[capacity].pop()
        while node:
            self.some[node] -= 1
            node >>= 1
        return capacity, window


def best_fit(lengths: Iterable[int], size: int) -> list[list[int]]:
    """Windows as lists of item numbers; items by falling length, each at most `size`."""
    lengths = list(lengths)
    rooms, windows = Rooms(size), []
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = rooms.take(lengths[item])
        if found is None:
            capacity, window = size, len(windows)
            windows.append([])
        else:
            capacity, window = found
        windows[window].append(item)
        if capacity > lengths[item]:
            rooms.put(capacity - lengths[item], window)
    return windows


def pack_lengths(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (document, start, length) that hold each place of each document once.

    All windows but those of the last rest are full; those hold powers of two.
    """
    windows = [[(d, s, size)] for d, n in enumerate(lengths) for s in range(0, n - size + 1, size)]
    rests = [(d, n - n % size, n % size) for d, n in enumerate(lengths) if n % size]
    open_windows = [[rests[i] for i in w] for w in best_fit([r[2] for r in rests], size)]
    fill = lambda w: sum(p[2] for p in w)
    open_windows.sort(key=fill, reverse=True)
    full, last = 0, len(open_windows) - 1
    while full < last:
        room = size - fill(open_windows[full])
        while room and full < last:
            d, s, n = open_windows[last].pop()
            moved = min(room, n)
            open_windows[full].append((d, s + n - moved, moved))
            if n > moved:
                open_windows[last].append((d, s, n - moved))
            room -= moved
            if not open_windows[last]:
                last -= 1
        if not room:
            full += 1
    windows += open_windows[: last + 1]
    if windows and 0 < (rest := fill(windows[-1])) < size:
        pieces = windows.pop()
        while rest:
            room = 1 << (rest.bit_length() - 1)
            rest -= room
            window = []
            while room:
                d, s, n = pieces.pop()
                moved = min(room, n)
                window.append((d, s, moved))
                if n > moved:
                    pieces.append((d, s + moved, n - moved))
                room -= moved
            windows.append(window)
    return windows


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, and its byte.

    Printable bytes stand for themselves, the others follow from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def coder(path: str, pattern: str, added: bool = True) -> Callable[[list[str]], list[list[int]]]:
    """Ids of texts by a tokenizer file, as its library gives them without adding special tokens.

    The strings of the file's added tokens are those tokens, or with `added` off
    ordinary text. If the merges of the file stand in the order of the ids they make,
    an id is its merge's rank, and tiktoken gives the same ids several times as fast as
    the tokenizers library (a test compares them). Otherwise that library is used.
    """
    with open(path, encoding="utf-8") as source:
        file = json.load(source)
    model, extra = file["model"], file.get("added_tokens") or []
    vocabulary = model["vocab"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [vocabulary["".join(m)] for m in pairs]
    letters = _byte_letters()
    single = {t: i for t, i in vocabulary.items() if len(t) == 1 and t in letters}
    plain = not any(t.get(flag) for t in extra for flag in ("single_word", "lstrip", "rstrip", "normalized"))
    if made == list(range(256, 256 + len(made))) and sorted(single.values()) == list(range(256)) and (plain or not added):
        tokens = [*single, *("".join(m) for m in pairs)]
        ranks = {bytes(letters[c] for c in t): vocabulary[t] for t in tokens}
        fast = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        known = {t["content"]: t["id"] for t in extra} if added else {}
        if not known:
            return lambda texts: [encode_text(fast, t) for t in texts]
        cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(known, key=len, reverse=True)) + ")")

        def encode(text: str) -> list[int]:
            # Every second part is an added token; the others are coded each on its own.
            parts = cut.split(text)
            if len(parts) == 1:
                return encode_text(fast, text)
            return [i for n, part in enumerate(parts) for i in ([known[part]] if n % 2 else encode_text(fast, part))]

        return lambda texts: [encode(t) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = not added
    return lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    pattern: str,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 1024,
    closing_id: int = 0,
    group_ids: int = GROUP_IDS,
    added: bool = True,
) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit), by `PIECE_SCHEMA`.

    `tokenizer` is the path of a tokenizer file on every executor and `pattern`
    the pattern that it splits by. With `added` off, the strings of added tokens,
    such as an end of text, are ordinary text, so that no text can write one.
    """

    def packed(group: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        windows = pack_lengths([len(ids) for _, ids in group], size)
        rows: dict[str, list] = {c.split()[0]: [] for c in PIECE_SCHEMA.split(", ")}
        for number, window in enumerate(windows):
            offset = 0
            for d, start, length in window:
                key, ids = group[d]
                values = (key, start, length, ids[start : start + length].tobytes(), len(ids), first + number, offset)
                for column, value in zip(rows.values(), values):
                    column.append(value)
                offset += length
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(v, k) for v, k in zip(rows.values(), kinds)]
        return pa.RecordBatch.from_arrays(arrays, list(rows)), first + len(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = coder(tokenizer, pattern, added)
        number = TaskContext.get().partitionId() << 40
        group, held = [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1)
            for lo in range(0, batch.num_rows, 256):
                part = [t or "" for t in texts.slice(lo, 256).to_pylist()]
                for key, ids in zip(keys[lo : lo + 256], encoded(part)):
                    group.append((key, np.array([*ids, closing_id], "<u4")))
                    held += len(ids) + 1
                if held >= group_ids:
                    out, number = packed(group, number)
                    group, held = [], 0
                    yield out
        if group:
            yield packed(group, number)[0]

    return spread(docs.select(doc_id, text), doc_id).mapInArrow(tidy(run), PIECE_SCHEMA)
