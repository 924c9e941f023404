"""Language-model scores by a weighted backoff automaton, learned from the corpus itself.

Tokens are words (A-Z lower-cased) and one end per text. The states of the
automaton are the start, every word, and a root without history. A word that
followed a state in training has an arc there; any other is read after the
state's failure arc, which leads to the root. With c counts of training,
D the discount and T(h) the number of different followers of h:

    root    P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))
    failure l(h) = D T(h) / c(h), or 1 if h was not seen
    arc     (c(hw) - D) / c(h) + l(h) P(w)

These are interpolated absolute discounts, so the arcs of a state and its
failure add up to one. One pass from left to right carries the state and adds
up log10 of the weights.

The model grows with the corpus, so it is never gathered in one place. Texts
are dealt into blocks of bounded size. A block asks for just the words and
pairs that it contains, packed by bucket, and adds its own training counts to
the question. A bucket sums the counts of all blocks and answers each. A block
with its answers is an automaton that holds all its texts can reach. Words that
make up more than a 2000th of the training tokens (there are at most 2000) are
split over buckets by follower.

Null and empty texts are an end alone. Without training texts every weight is
the root's with N = V = 0. Equal texts score alike; repeated rows are scored
(and learned from) as often as they stand. A null training mark counts as no.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix, parts_for, spread, text_runs, total_bytes, word_hashes

DISCOUNT = 0.85
BLOCK_BYTES = 16 << 20
HOT_SHARE, SPLIT = 2000, 32
_U = np.uint64
END, START = _U(0x454E44), _U(0x5354415254)
_FOLLOWER_BITS = _U(22)  # 42 bits tell the followers of a state apart

TALLY_SCHEMA = "bucket int, words binary, counts binary"
COUNT_SCHEMA = "distinct long, tokens long, words binary, counts binary"
ASK_SCHEMA = "block int, bucket int, entries binary, counts binary, followers binary, low binary, high binary, pairs binary"
ANSWER_SCHEMA = "block int, bucket int, counts binary, kinds binary, pairs binary"
SCORE_SCHEMA = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each closed by END; bounds)."""
    parts, sizes = [], []
    for lo, hi, data, offsets in text_runs(texts):
        words, place = word_hashes(data, offsets)
        n = np.diff(place)
        out = np.full(len(words) + hi - lo, END, np.uint64)
        out[np.arange(len(words)) + np.repeat(np.arange(hi - lo), n)] = words
        parts.append(out)
        sizes.append(n + 1)
    flat = np.concatenate([np.zeros(0, np.uint64), *parts])
    return flat, np.cumsum(np.concatenate([np.zeros(1, np.int64), *sizes]))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix(hashes) >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)


def _by_bucket(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stable order, bucket of each run, bounds of the runs)."""
    order = np.argsort(bucket, kind="stable")
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    return order, bucket[order][first], np.append(first, len(order))


# -- vocabulary ---------------------------------------------------------------


def _tally(buckets: int, flush: int = 2_000_000):
    """Training words of a task and their counts, packed by bucket."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        order, numbers, bounds = _by_bucket(_bucket(words, buckets))
        words, counts = words[order], counts[order].astype(np.uint32)
        cut = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(numbers), cut(words), cut(counts)], ["bucket", "words", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                words, _ = tokens_of(batch.column(0).slice(lo, 512))
                held.append(words)
                n += len(words)
                if n >= flush:
                    yield packed(held)
                    held, n = [], 0
        if n:
            yield packed(held)

    return run


def _merge(part: pa.Table) -> pa.Table:
    words = np.frombuffer(b"".join(part.column("words").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(part.column("counts").to_pylist()), np.uint32)
    known, where = np.unique(words, return_inverse=True)
    total = np.bincount(where, counts).astype(np.int64)
    top = np.argsort(-total, kind="stable")[:16]
    columns = [[len(known)], [int(total.sum())], [known[top].tobytes()], [total[top].tobytes()]]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in COUNT_SCHEMA.split(", ")])


def vocabulary(docs: DataFrame, buckets: int) -> tuple[int, int, np.ndarray]:
    """(training tokens N, different ones V, hashes of the most frequent words).

    Each bucket reports two numbers and its 16 most frequent words; the last
    steer only how work is split.
    """
    found = docs.where("train").select("text").mapInArrow(_tally(buckets), TALLY_SCHEMA)
    rows = found.groupBy("bucket").applyInArrow(lambda part: _merge(part), COUNT_SCHEMA).collect()
    n = sum(r["tokens"] for r in rows)
    words = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r["words"], np.uint64) for r in rows]])
    counts = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["counts"], np.int64) for r in rows]])
    hot = np.unique(np.append(words[counts * HOT_SHARE >= max(1, n)], START))
    return n, sum(r["distinct"] for r in rows), hot


# -- blocks and buckets -------------------------------------------------------


class Block:
    """The states and arcs that a block's texts can reach, in the order that it asks for them."""

    def __init__(self, texts: pa.Array, hot: np.ndarray, buckets: int):
        self.tokens, self.bounds = tokens_of(texts)
        self.words, self.word = np.unique(np.append(self.tokens, START), return_inverse=True)
        start, self.word = self.word[-1], self.word[:-1]
        self.state = np.empty_like(self.word)  # before each token
        self.state[1:] = self.word[:-1]
        self.state[self.bounds[:-1]] = start
        # A frequent state is SPLIT entries, told apart by follower; others are one.
        parts = np.where(np.isin(self.words, hot), SPLIT, 1)
        base = np.concatenate([[0], np.cumsum(parts)])
        follower = self.tokens >> _FOLLOWER_BITS
        entry = base[self.state] + (follower % parts[self.state].astype(np.uint64)).astype(np.int64)
        order = np.lexsort((follower, entry))
        e, f = entry[order], follower[order]
        fresh = np.concatenate([[True], (e[1:] != e[:-1]) | (f[1:] != f[:-1])])
        arc = np.cumsum(fresh) - 1
        self.arc = np.empty_like(arc)
        self.arc[order] = arc
        self.arc_entry, self.arc_follower = e[fresh], f[fresh]
        self.entry_word = np.repeat(np.arange(len(self.words)), parts)
        number = np.arange(base[-1]) - base[self.entry_word]
        self.first = number == 0
        self.entry_hash = mix(self.words[self.entry_word] + number.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        self.entry_bucket = _bucket(self.entry_hash, buckets)
        self.entry_order, self.numbers, self.entry_bounds = _by_bucket(self.entry_bucket)
        arc_bucket = self.entry_bucket[self.arc_entry]
        # Arcs are in the order of entries, so a stable order keeps them beside their entry.
        rank = np.empty(len(self.entry_order), np.int64)
        rank[self.entry_order] = np.arange(len(rank))
        self.arc_order = np.argsort(rank[self.arc_entry], kind="stable")
        ends = np.searchsorted(arc_bucket[self.arc_order], self.numbers, "right")
        self.arc_bounds = np.concatenate([[0], ends])

    def ask(self, number: int, train: np.ndarray) -> pa.Table:
        """Entries, their followers and the block's own training counts, by bucket."""
        learned = np.repeat(train, np.diff(self.bounds))
        seen = np.bincount(self.word[learned], minlength=len(self.words))
        seen[np.searchsorted(self.words, START)] = int(train.sum())
        counts = np.where(self.first, seen[self.entry_word], 0).astype(np.uint32)[self.entry_order]
        followers = np.bincount(self.arc_entry, minlength=len(self.first)).astype(np.uint32)[self.entry_order]
        pairs = np.bincount(self.arc[learned], minlength=len(self.arc_entry)).astype(np.uint32)[self.arc_order]
        follower = self.arc_follower[self.arc_order]
        per_entry = (self.entry_hash[self.entry_order], counts, followers)
        per_arc = (follower.astype(np.uint32), (follower >> _U(32)).astype(np.uint16), pairs)
        cut = lambda a, bounds: pa.array([a[i:j].tobytes() for i, j in zip(bounds, bounds[1:])], pa.binary())
        columns = [cut(a, self.entry_bounds) for a in per_entry] + [cut(a, self.arc_bounds) for a in per_arc]
        block = pa.array(np.full(len(self.numbers), number, np.int32))
        return pa.table([block, pa.array(self.numbers), *columns], [c.split()[0] for c in ASK_SCHEMA.split(", ")])

    def automaton(self, counts: np.ndarray, kinds: np.ndarray, pairs: np.ndarray, n: int, v: int, discount: float):
        """The block's automaton from its answers, which come in the order asked for."""
        spread_out = lambda values, order: values[np.argsort(order, kind="stable")].astype(np.float64)
        size = len(self.words)
        count = np.bincount(self.entry_word, spread_out(counts, self.entry_order), size)
        kind = np.bincount(self.entry_word, spread_out(kinds, self.entry_order), size)
        root = (count + 0.5) / (n + 0.5 * (v + 1))
        seen = count > 0
        failure = np.where(seen, discount * kind / np.where(seen, count, 1), 1.0)
        return Automaton(count, root, failure, spread_out(pairs, self.arc_order), discount)


class Automaton:
    """Weights of the root, the failure arcs and the arcs of a block."""

    def __init__(self, count, root, failure, pairs, discount):
        self.count, self.root, self.failure, self.pairs, self.discount = count, root, failure, pairs, discount

    def traverse(self, state: np.ndarray, arc: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 weight of each step of a pass: by the arc if training had it, else by failure."""
        backed = self.failure[state] * self.root[word]
        seen = self.pairs[arc]
        taken = np.maximum(seen - self.discount, 0) / np.maximum(self.count[state], 1)
        return np.log10(np.where(seen > 0, taken + backed, backed))


def _answer(part: pa.Table) -> pa.Table:
    """A bucket's sums, handed to each block that asked."""
    cat = lambda name, kind: np.frombuffer(b"".join(part.column(name).to_pylist()), kind)
    entries, counts, followers = cat("entries", np.uint64), cat("counts", np.uint32), cat("followers", np.uint32)
    known, where = np.unique(entries, return_inverse=True)
    count = np.bincount(where, counts, len(known))
    owner = np.repeat(where, followers)
    follower = cat("low", np.uint32).astype(np.uint64) | cat("high", np.uint16).astype(np.uint64) << _U(32)
    arcs, arc = np.unique(mix(known[owner] + follower * _U(0xD6E8FEB86659FD93)), return_inverse=True)
    pair = np.bincount(arc, cat("pairs", np.uint32), len(arcs))
    state = np.zeros(len(arcs), np.int64)
    state[arc] = owner
    kind = np.bincount(state[pair > 0], minlength=len(known))
    lengths = lambda name, width: np.array([len(b) // width for b in part.column(name).to_pylist()])
    entry_ends, arc_ends = np.cumsum(lengths("entries", 8)), np.cumsum(lengths("low", 4))
    narrow = lambda a, ends: pa.array([_packed(x) for x in np.split(a, ends[:-1])], pa.binary())
    columns = [narrow(count[where], entry_ends), narrow(kind[where], entry_ends), narrow(pair[arc], arc_ends)]
    return pa.table(
        [part.column("block"), part.column("bucket"), *columns], [c.split()[0] for c in ANSWER_SCHEMA.split(", ")]
    )


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, a byte each; those over 254 are 255 there and follow in full."""
    large = values >= 255
    head = np.where(large, 255, values).astype(np.uint8).tobytes()
    return len(values).to_bytes(8, "little") + head + values[large].astype(np.uint64).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    out = np.frombuffer(raw, np.uint8, n, 8).astype(np.uint64)
    out[out == 255] = np.frombuffer(raw[8 + n :], np.uint64)
    return out


def score_corpus(
    docs: DataFrame,
    train: Column,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    discount: float = DISCOUNT,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, int]:
    """(doc_id, n_tokens, n_known, base_score, score) of every document, and the training tokens.

    `base_score` is the root's alone; a token is known if training has it.
    """
    picked = spread(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train")))
    size = total_bytes(picked, "text")
    blocks = parts_for(size, block_bytes)
    buckets = max(8, 2 * blocks)
    n, v, hot = vocabulary(picked, buckets)
    dealt = picked.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", "train"), F.lit(blocks)).cast("int"))

    def ask(part: pa.Table) -> pa.Table:
        found = Block(part.column("text").combine_chunks(), hot, buckets)
        return found.ask(part.column("block")[0].as_py(), part.column("train").to_numpy())

    def score(part: pa.Table, answers: pa.Table) -> pa.Table:
        found = Block(part.column("text").combine_chunks(), hot, buckets)
        order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
        got = [
            np.concatenate([_unpacked(column[i].as_py()) for i in order])
            for column in (answers.column(c) for c in ("counts", "kinds", "pairs"))
        ]
        automaton = found.automaton(*got, n, v, discount)
        base = np.log10(automaton.root[found.word])
        steps = automaton.traverse(found.state, found.arc, found.word)
        at = found.bounds[:-1]
        known = (automaton.count[found.word] > 0).astype(np.int64)
        columns = [
            part.column("doc_id"),
            pa.array(np.diff(found.bounds)),
            *(pa.array(np.add.reduceat(x, at)) for x in (known, base, steps)),
        ]
        return pa.table(columns, [c.split()[0] for c in SCORE_SCHEMA.split(", ")])

    asked = dealt.groupBy("block").applyInArrow(ask, ASK_SCHEMA)
    answers = asked.groupBy("bucket").applyInArrow(lambda part: _answer(part), ANSWER_SCHEMA)
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORE_SCHEMA), n
