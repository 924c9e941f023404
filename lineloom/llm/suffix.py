"""Removal of repeated byte strings by suffix arrays of shards.

A byte goes if a string of `length` bytes that covers it also starts in a
document with a smaller id. Strings are judged on the input, so overlaps count.

A suffix array of a shard of documents would know the strings of that shard only,
and comparing all shards with each other is quadratic. So shards are made by
content. Every string of 50 bytes has an anchor: the least hash of its
31 pieces of 20 bytes. Equal strings have equal anchors, and neighbouring strings
mostly share theirs, so a text falls into runs of starts with one anchor, about
16 each.

1. Texts are dealt into blocks. A block sends the anchors of its runs, packed by
   bucket, 8 bytes each. A bucket tells every block which of them stand in another
   block as well.
2. A block sends the runs with such an anchor, or one that two of its own
   documents have, as segments to the anchor's bucket: the bytes of all strings
   that start in the run. Of equal segments it sends the one of the least id.
3. A bucket takes equal segments as one of their least id, cuts them into shards,
   sorts the suffixes of each by Larsson-Sadakane refinement, and takes common prefixes by Kasai's way; neighbours
   with 50 common bytes are one string. The sorted strings of the shards are merged by
   binary search, which gives every string the least id that has it. Strings whose
   least id is smaller than their segment's are told to the block.
4. A block marks the bytes of these strings in every text that has the segment and a
   larger id, and of equal segments of its own, and removes them.

Texts are dealt out once; steps 1, 2 and 4 read the same exchange. An anchor with
more than `MANY` different segments is split over buckets by a hash of each
whole string, which equal strings share too. So no task holds more than a block, or the
segments of a bucket; a string that all blocks have is there once per block.

Defined cases: an empty table gives no rows; a NULL or empty text has nothing to
remove; a NULL id counts as smaller than all others; documents of equal ids, repeated
rows among them, take nothing from each other; texts may have any length and are
worked on in pieces. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, parts_for, spread, total_bytes, utf8_parts

LENGTH, PIECE = 50, 20
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 3 << 19
MANY = 20_000
RUN = 32  # starts in a segment at most
CHUNK = 1 << 15
NO_ID = -(2**63)

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_KEY = ~_U(0xFFFF)  # the low 16 bits of a posting count its segments
_random = np.random.default_rng(19)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = pow(3, 41, 1 << 64)
_powers = lambda base: np.cumprod(np.full(CHUNK + 256, base, np.uint64)) * _U(pow(base, -1, 1 << 64))
_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))

POSTING_SCHEMA = "bucket int, block int, keys binary"
KNOWN_SCHEMA = "block int, bucket int, again binary, many binary, splits binary"
SEGMENT_SCHEMA = "bucket int, sub int, block int, data binary, lengths binary, places binary, ids binary"
OWNER_SCHEMA = "block int, places binary, firsts binary, counts binary, owners binary"


# -- anchors ------------------------------------------------------------------


_POWER = [_U(pow(_BASE, n, 1 << 64)) for n in range(PIECE)]


def _least_pieces(data: np.ndarray, length: int) -> np.ndarray:
    """The least hash of the pieces of each string of `length` bytes in `data`."""
    one = _BYTE[data]

    def longer(a: np.ndarray, n: int, b: np.ndarray, m: int) -> np.ndarray:
        """Hashes of n + m bytes from those of n bytes and of the m bytes behind them."""
        out = a[: len(a) - m] * _POWER[m]
        out += b[n : n + len(out)]
        return out

    two = longer(one, 1, one, 1)
    four = longer(two, 2, two, 2)
    eight = longer(four, 4, four, 4)
    least = longer(longer(eight, 8, eight, 8), 16, four, 4)
    # High bits depend on all bytes; they go down, and up again by a factor.
    least ^= least >> _U(32)
    least *= _U(0xD6E8FEB86659FD93)
    window, width = length - PIECE + 1, 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    over = window - width
    return np.minimum(least[:-over], least[over:]) if over else least


class Runs:
    """The runs of a block's texts: place, starts, anchor, hash of the bytes, number of the text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int = LENGTH):
        ends = bounds[1:]
        parts = []
        for lo in range(0, max(0, len(data) - length + 1), CHUNK):
            hi = min(lo + CHUNK, len(data) - length + 1)
            anchors = _least_pieces(data[lo : hi + length - 1], length)
            begins = np.ones(hi - lo, bool)
            begins[1:] = anchors[1:] != anchors[:-1]
            inside = np.ones(hi - lo, bool)
            for text in range(*np.searchsorted(ends, [lo, hi + length], "right")):
                inside[max(0, ends[text] - length + 1 - lo) : max(0, ends[text] - lo)] = False
                begins[min(max(0, ends[text] - lo), hi - lo - 1)] = True
            # A run ends at the next begin, or where its text has no more strings.
            cuts = np.flatnonzero(begins | ~inside)
            sizes = np.diff(np.append(cuts, hi - lo))
            if sizes.max() > RUN:
                n = -(-sizes // RUN)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                cuts = np.repeat(cuts, n) + RUN * step
                sizes = np.diff(np.append(cuts, hi - lo))
            mine = inside[cuts]
            first, starts = cuts[mine], sizes[mine]
            if not len(first):
                continue
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data[lo : hi + length - 1]] * _UP[: hi - lo + length - 1])])
            content = (sums[first + starts + length - 1] - sums[first]) * _DOWN[first] + starts.astype(np.uint64)
            text = np.searchsorted(ends, first + lo, "right")
            # The least of many hashes is small; mixed, it is spread again.
            parts.append((first + lo, starts, mix(anchors[first]) & _KEY, mix(content), text))
        empty = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64, np.int64)]
        columns = [np.concatenate(c) for c in zip(empty, *parts)]
        self.place, self.starts, self.anchor, self.content, self.text = columns

    def grouped(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order by anchor, bytes, id and place; whether a run in that order is the first of its segment)."""
        order = np.argsort(self.anchor)
        anchor = self.anchor[order]
        alone = np.ones(len(order) + 1, bool)
        alone[1:-1] = anchor[1:] != anchor[:-1]
        rest = np.flatnonzero(~(alone[1:] & alone[:-1]))
        few = order[rest]
        order[rest] = few[np.lexsort((self.place[few], ids[self.text[few]], self.content[few], self.anchor[few]))]
        anchor, content = self.anchor[order], self.content[order]
        first = np.ones(len(order), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
        return order, first


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)


def _runs_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal values, and the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.append(np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])), len(sorted_keys))


# -- blocks -------------------------------------------------------------------


class Block:
    """The texts of a block, in an order that does not depend on how they came."""

    def __init__(self, rows: pa.Table):
        self.rows = rows.sort_by([("order", "ascending"), ("text", "ascending")])
        self.data, self.bounds = utf8_parts(self.rows["text"])
        self.ids = self.rows["order"].to_numpy().astype(np.int64)
        if len(self.bounds) and self.bounds[0]:
            self.data, self.bounds = self.data[self.bounds[0] :], self.bounds - self.bounds[0]
        self.data = self.data[: int(self.bounds[-1])]


def _postings(order: np.ndarray, first: np.ndarray, runs: Runs) -> np.ndarray:
    """The block's anchors in ascending order, each with the number of its segments in the low bits."""
    anchors = runs.anchor[order[first]]
    at = _runs_of(anchors)
    return anchors[at[:-1]] | np.minimum(np.diff(at), 0xFFFF).astype(np.uint64)


def ask(rows: pa.Table, buckets: int, length: int) -> pa.Table:
    """Step 1: the anchors of a block, by bucket."""
    block = Block(rows)
    runs = Runs(block.data, block.bounds, length)
    keys = _postings(*runs.grouped(block.ids), runs)
    bucket = _bucket(keys, buckets)  # ascends as the keys do
    at = _runs_of(bucket)
    out = {
        "bucket": pa.array(bucket[at[:-1]], pa.int32()),
        "block": pa.array([rows["block"][0].as_py()] * (len(at) - 1), pa.int32()),
        "keys": pa.array([keys[i:j].tobytes() for i, j in zip(at, at[1:])], pa.binary()),
    }
    return pa.table(out)


def answer(rows: pa.Table, many: int) -> pa.Table:
    """Which anchors of a bucket stand in more than one block, and those with many segments."""
    blobs = [np.frombuffer(b, np.uint64) for b in rows["keys"].to_pylist()]
    keys = np.concatenate(blobs)
    names, counts = keys & _KEY, (keys & ~_KEY).astype(np.int64)
    order = np.argsort(names, kind="stable")
    at = _runs_of(names[order])
    again = np.zeros(len(keys), bool)
    again[order] = np.repeat(np.diff(at) > 1, np.diff(at))
    sums = np.add.reduceat(counts[order], at[:-1])
    crowded = np.flatnonzero(sums > many)
    hot, splits = names[order][at[crowded]], -(-sums[crowded] // many)
    out = {"block": [], "bucket": [], "again": [], "many": [], "splits": []}
    end = 0
    for block, bucket, blob in zip(rows["block"].to_pylist(), rows["bucket"].to_pylist(), blobs):
        mine = again[end : end + len(blob)]
        end += len(blob)
        if not mine.any():
            continue
        own = np.isin(hot, blob & _KEY)
        out["block"].append(block)
        out["bucket"].append(bucket)
        out["again"].append(np.packbits(mine).tobytes())
        out["many"].append(hot[own].tobytes())
        out["splits"].append(splits[own].astype(np.int64).tobytes())
    kinds = dict(block=pa.int32(), bucket=pa.int32(), again=pa.binary(), many=pa.binary(), splits=pa.binary())
    return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})


def _string_hashes(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(places), np.uint64)
    for j in range(length):
        out = out * _U(_BASE) + _BYTE[data[places + j]]
    return mix(out)


def send(rows: pa.Table, known: pa.Table, buckets: int, length: int) -> pa.Table:
    """Step 2: the segments of a block whose strings may stand in another document."""
    out = {c.split()[0]: [] for c in SEGMENT_SCHEMA.split(", ")}
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    made = lambda: pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})
    if not rows.num_rows:
        return made()
    block = Block(rows)
    runs = Runs(block.data, block.bounds, length)
    order, first = runs.grouped(block.ids)
    postings = _postings(order, first, runs)
    if not len(postings):
        return made()
    # Anchors that two of the block's own documents have.
    at = _runs_of(runs.anchor[order])
    ids = block.ids[runs.text[order]]
    wanted = np.maximum.reduceat(ids, at[:-1]) > np.minimum.reduceat(ids, at[:-1])
    splits = np.ones(len(postings), np.int64)
    bounds = np.searchsorted(_bucket(postings, buckets), np.arange(buckets + 1))
    for row in known.to_pylist():
        lo, hi = bounds[row["bucket"]], bounds[row["bucket"] + 1]
        wanted[lo:hi] |= np.unpackbits(np.frombuffer(row["again"], np.uint8), count=hi - lo).astype(bool)
        hot = np.frombuffer(row["many"], np.uint64)
        splits[np.searchsorted(postings & _KEY, hot)] = np.frombuffer(row["splits"], np.int64)
    number = np.repeat(np.arange(len(postings)), np.diff(at))[first]
    chosen = order[first][wanted[number]]
    parts = splits[number[wanted[number]]]
    bucket = _bucket(runs.anchor[chosen], buckets)
    place, starts, text = runs.place[chosen], runs.starts[chosen], runs.text[chosen]
    sub = np.zeros(len(chosen), np.int64)
    if (parts > 1).any():
        # Each string of a crowded anchor goes where its own hash says.
        split = np.flatnonzero(parts > 1)
        n = starts[split]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        single = np.repeat(place[split], n) + step
        to = (_string_hashes(block.data, single, length) >> _U(16)) % np.repeat(parts[split], n).astype(np.uint64)
        rest = parts == 1
        bucket = np.concatenate([bucket[rest], np.repeat(bucket[split], n)])
        text = np.concatenate([text[rest], np.repeat(text[split], n)])
        place = np.concatenate([place[rest], single])
        starts = np.concatenate([starts[rest], np.ones(len(single), np.int64)])
        sub = np.concatenate([sub[rest], to.astype(np.int64)])
    by = np.lexsort((place, sub, bucket))
    bucket, sub, place, starts, text = (a[by] for a in (bucket, sub, place, starts, text))
    cut = _runs_of(bucket * (int(sub.max(initial=0)) + 1) + sub)
    ids, lengths, mine = block.ids[text], starts + length - 1, rows["block"][0].as_py()
    for lo, hi in zip(cut, cut[1:]):
        n = lengths[lo:hi]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cells = (
            int(bucket[lo]), int(sub[lo]), mine, block.data[np.repeat(place[lo:hi], n) + step].tobytes(),
            n.astype(np.uint8).tobytes(), place[lo:hi].tobytes(), ids[lo:hi].tobytes(),
        )
        for column, cell in zip(out.values(), cells):
            column.append(cell)
    return made()


def remove(rows: pa.Table, found: pa.Table, length: int) -> pa.Table:
    """Step 4: every text of a block without the strings that a smaller id has, and the runs removed."""
    if not rows.num_rows:
        return pa.table({"doc_id": pa.array([], pa.int64()), "kept": pa.array([], pa.binary()), "spans": pa.array([], _SPANS)})
    block = Block(rows)
    runs = Runs(block.data, block.bounds, length)
    order, first = runs.grouped(block.ids)
    edge = np.zeros(len(block.data) + 1, np.int32)

    def cover(place: np.ndarray, starts: np.ndarray) -> None:
        np.add.at(edge, place, 1)
        np.add.at(edge, place + starts + length - 1, -1)

    segment = np.cumsum(first) - 1
    ids = block.ids[runs.text[order]]
    least = ids[first]
    later = ids > least[segment]
    cover(runs.place[order][later], runs.starts[order][later])
    blobs = lambda name, kind: np.concatenate([np.zeros(0, kind), *[np.frombuffer(b, kind) for b in found[name].to_pylist()]])
    where, begin, count = blobs("places", np.int64), blobs("firsts", np.uint8), blobs("counts", np.uint8)
    owner = blobs("owners", np.int64)
    if len(where):
        # A report is of the run that was sent, or of one string within it, and holds for all runs of its segment.
        by_place = np.argsort(runs.place, kind="stable")
        run = by_place[np.searchsorted(runs.place[by_place], where, "right") - 1]
        begin = begin + (where - runs.place[run])
        back = np.empty(len(order), np.int64)
        back[order] = segment
        members = np.append(np.flatnonzero(first), len(order))
        of = back[run]
        n = members[of + 1] - members[of]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        member = np.repeat(members[of], n) + step
        hit = ids[member] > np.repeat(owner, n)
        cover((runs.place[order][member] + np.repeat(begin, n))[hit], np.repeat(count.astype(np.int64), n)[hit])
    gone = np.cumsum(edge[:-1]) > 0
    kept, spans = [], []
    for lo, hi in zip(block.bounds, block.bounds[1:]):
        mine = gone[lo:hi]
        kept.append(block.data[lo:hi][~mine].tobytes())
        turns = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])])
    return pa.table({"doc_id": block.rows["doc_id"], "kept": pa.array(kept, pa.binary()), "spans": pa.array(spans, _SPANS)})


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


# -- shards -------------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every place as one number that sorts as they do; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = (out << _U(8)) | padded[j : j + len(data)]
    return out


def suffix_array(words: np.ndarray, left: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, where a suffix has `left` bytes up to its segment's end.

    Larsson and Sadakane's way: suffixes are sorted by seven bytes, then groups that
    are still equal by the group of the suffix that many bytes on, which doubles what
    they are sorted by. Groups of one are not looked at again. An end is less than any
    byte, and ends are in the order of their segments, so all suffixes differ.
    """
    n, ends = len(words), int(segment[-1]) + 1
    short = np.minimum(left, 7).astype(np.uint64)
    first = (words & (_U(0xFFFFFFFFFFFFFF00) << (_U(8) * (_U(7) - short)))) | short
    order = np.argsort(first).astype(np.int32)
    new = np.ones(n + 1, bool)
    new[1:n] = first[order[1:]] != first[order[:-1]]
    group = np.empty(n, np.int32)
    open_at, done = np.arange(n), 7
    while True:
        # A group's number is the place of its first suffix, behind the numbers of the ends.
        group[order[open_at]] = np.maximum.accumulate(np.where(new[open_at], open_at, 0)) + ends
        open_at = open_at[~(new[open_at] & new[open_at + 1])]
        if not len(open_at):
            return order
        place = order[open_at]
        follows = np.where(left[place] > done, group[np.minimum(place + done, n - 1)], segment[place])
        key = (group[place].astype(np.int64) << 32) | follows
        by = np.argsort(key)
        order[open_at] = place[by]
        key = key[by]
        new[open_at[1:]] |= key[1:] != key[:-1]
        done *= 2


def common_prefixes(
    order: np.ndarray, words: np.ndarray, left: np.ndarray, begins: np.ndarray, counts: np.ndarray, depth: int
) -> np.ndarray:
    """Bytes that the first `counts` suffixes of each segment share with the one before them in order.

    By place, and exact below `depth`. Kasai's way: a suffix shares at most one byte
    less than the suffix one place earlier did, so the comparison goes on from there.
    All segments go forward together.
    """
    before = np.full(len(order), -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(len(order), np.int64)
    padded = np.concatenate([words, np.zeros(depth + 8, np.uint64)])
    shared = np.zeros(len(begins), np.int64)
    for step in range(int(counts.max())):
        lane = np.flatnonzero(counts > step)
        place = begins[lane] + step
        other = before[place]
        most = np.where(other >= 0, np.minimum(left[place], left[other]), 0)
        now = np.minimum(np.maximum(shared[lane] - 1, 0), most)
        going = np.flatnonzero(now < np.minimum(most, depth))
        while len(going):
            differ = padded[place[going] + now[going]] ^ padded[other[going] + now[going]]
            same = (differ == 0).astype(np.int64)
            for bits in range(8, 64, 8):
                same += differ < _U(1 << bits)
            now[going] = np.minimum(now[going] + same, most[going])
            going = going[(same == 8) & (now[going] < np.minimum(most[going], depth))]
        shared[lane] = now
        out[place] = now
    return out


class Segments:
    """All segments of a bucket, as rows of bytes with zeros behind the end; of equal ones the least id counts."""

    def __init__(self, rows: list[dict], length: int):
        join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in rows])
        data, self.lengths = join("data", np.uint8), join("lengths", np.uint8).astype(np.int32)
        self.place, self.id = join("places", np.int64), join("ids", np.int64)
        self.block = np.repeat([r["block"] for r in rows], [len(r["lengths"]) for r in rows])
        n, width = len(self.lengths), -(-(length + RUN) // 8) * 8
        self.cells = np.zeros((n, width), np.uint8)
        self.cells[np.arange(width) < self.lengths[:, None]] = data
        hashes = self.lengths.astype(np.uint64)
        for word in self.cells.view(np.uint64).T:
            hashes = mix(hashes * _STEP + word)
        order = np.lexsort((self.id, hashes))
        heads = _runs_of(hashes[order])
        first = np.empty(n, np.int64)
        first[order] = np.repeat(order[heads[:-1]], np.diff(heads))
        # Equal hashes of different bytes would only leave a segment on its own.
        same = (self.lengths == self.lengths[first]) & (self.cells == self.cells[first]).all(axis=1)
        self.first = np.where(same, first, np.arange(n))
        self.distinct = np.unique(self.first)


class Shard:
    """Some of the distinct segments, the different strings in them in order, and each string's least id."""

    def __init__(self, held: Segments, chosen: np.ndarray, length: int, alone: bool):
        self.chosen = chosen
        lengths = held.lengths[chosen]
        cells = held.cells[chosen]
        data = cells[np.arange(cells.shape[1]) < lengths[:, None]]
        self.begins = (np.cumsum(lengths) - lengths).astype(np.int32)
        n = lengths - length + 1
        self.segment = np.repeat(np.arange(len(n), dtype=np.int32), n)
        self.step = (np.arange(len(self.segment)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        starts = self.begins[self.segment] + self.step
        words = _words(data)
        left = np.repeat(self.begins + lengths, lengths) - np.arange(len(data), dtype=np.int32)
        order = suffix_array(words, left, np.repeat(np.arange(len(n), dtype=np.int32), lengths))
        prefix = common_prefixes(order, words, left, self.begins, n, length)
        string = np.cumsum(prefix[order] < length)
        mine = np.full(len(data), -1, np.int32)
        mine[starts] = np.arange(len(starts))
        start = mine[order]
        counts = start >= 0
        start, string = start[counts], string[counts]
        at = _runs_of(string)
        self.least = np.minimum.reduceat(held.id[chosen][self.segment[start]], at[:-1])
        self.string = np.empty(len(starts), np.int32)
        self.string[start] = np.repeat(np.arange(len(at) - 1), np.diff(at))
        self.strings = None
        if not alone:
            # One byte more at the end, as numpy's texts lose zeros there.
            text = np.ones((len(at) - 1, length + 1), np.uint8)
            text[:, :length] = np.lib.stride_tricks.sliding_window_view(data, length)[starts[start[at[:-1]]]]
            self.strings = text.view(f"S{length + 1}").ravel()


def merged(one: tuple, two: tuple) -> tuple:
    """Two sorted lists of (strings, least ids) as one; the second is looked up in the first by binary search."""
    (a, least_a), (b, least_b) = (one, two) if len(one[0]) >= len(two[0]) else (two, one)
    at = np.searchsorted(a, b)
    same = at < len(a)
    same[same] = a[at[same]] == b[same]
    least = least_a.copy()
    least[at[same]] = np.minimum(least[at[same]], least_b[same])
    return np.insert(a, at[~same], b[~same]), np.insert(least, at[~same], least_b[~same])


def settle(rows: pa.Table, length: int, shard_bytes: int) -> pa.Table:
    """Step 3: the strings of a bucket's segments whose least id is smaller than the segment's."""
    held = Segments(rows.sort_by("block").to_pylist(), length)
    each = max(1, shard_bytes // held.cells.shape[1])
    cuts = range(0, len(held.distinct), each)
    shards = [Shard(held, held.distinct[i : i + each], length, len(cuts) == 1) for i in cuts]
    lists = [(s.strings, s.least) for s in shards]
    while len(lists) > 1:
        lists = [merged(*lists[i : i + 2]) if i + 1 < len(lists) else lists[i] for i in range(0, len(lists), 2)]
    strings, least = lists[0]
    reports = []
    for shard in shards:
        owners = least[np.searchsorted(strings, shard.strings)] if len(shards) > 1 else shard.least
        owner = owners[shard.string]
        # Neighbouring strings of a segment with one owner are one report.
        fresh = np.ones(len(owner), bool)
        fresh[1:] = (shard.segment[1:] != shard.segment[:-1]) | (owner[1:] != owner[:-1])
        at = np.append(np.flatnonzero(fresh), len(owner))
        reports.append((shard.chosen[shard.segment[at[:-1]]], shard.step[at[:-1]], np.diff(at), owner[at[:-1]]))
    segment, first, count, owner = (np.concatenate(c) for c in zip(*reports))
    # The reports of a segment go to all blocks that sent it.
    members = np.argsort(held.first, kind="stable")
    lo, hi = (np.searchsorted(held.first[members], segment, side) for side in ("left", "right"))
    n = hi - lo
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    member = members[np.repeat(lo, n) + step]
    of = np.repeat(np.arange(len(n)), n)
    hit = held.id[member] > owner[of]
    member, of = member[hit], of[hit]
    order = np.argsort(held.block[member], kind="stable")
    member, of = member[order], of[order]
    cut = _runs_of(held.block[member])
    out = {c.split()[0]: [] for c in OWNER_SCHEMA.split(", ")}
    for lo, hi in zip(cut, cut[1:]):
        out["block"].append(int(held.block[member[lo]]))
        out["places"].append(held.place[member[lo:hi]].tobytes())
        out["firsts"].append(first[of[lo:hi]].astype(np.uint8).tobytes())
        out["counts"].append(count[of[lo:hi]].astype(np.uint8).tobytes())
        out["owners"].append(owner[of[lo:hi]].tobytes())
    kinds = [pa.int32()] + [pa.binary()] * 4
    return pa.table({c: pa.array(v, k) for (c, v), k in zip(out.items(), kinds)})


# -- the whole ----------------------------------------------------------------


def remove_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
    many: int = MANY,
) -> DataFrame:
    """(doc_id, kept, spans): each text's remaining bytes, and the runs [start, end) that went."""
    if not PIECE + 1 <= length <= 255 - RUN:
        raise ValueError(f"length must be from {PIECE + 1} to {255 - RUN}")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = parts_for(total_bytes(texts, "text"), block_bytes)
    buckets = 2 * parts
    order = F.coalesce("doc_id", F.lit(NO_ID))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")
    blocks = spread(texts, "doc_id").select(block.alias("block"), "doc_id", order.alias("order"), "text").groupBy("block")
    asked = blocks.applyInArrow(lambda rows: ask(rows, buckets, length), POSTING_SCHEMA)
    known = asked.groupBy("bucket").applyInArrow(lambda rows: answer(rows, many), KNOWN_SCHEMA)
    sent = blocks.cogroup(known.groupBy("block")).applyInArrow(lambda r, k: send(r, k, buckets, length), SEGMENT_SCHEMA)
    settled = sent.groupBy("bucket", "sub").applyInArrow(lambda rows: settle(rows, length, shard_bytes), OWNER_SCHEMA)
    spans = "array<struct<start:bigint,end:bigint>>"
    return blocks.cogroup(settled.groupBy("block")).applyInArrow(
        lambda rows, found: remove(rows, found, length), f"doc_id long, kept binary, spans {spans}"
    )
