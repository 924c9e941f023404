"""N-gram Jaccard join: universe partition, pigeonhole, exact verification.

A document is the set of its k-word shingles. Two link when
``100 * |A & B| >= percent * |A | B|``. The result names, per document, the
smallest id that its links reach.

1. Documents with equal sets are one set from here on.
2. Sizes fall into bands whose bounds grow by 100 / percent, so a partner of a
   set stands in the same band or the one below. For each of those two bands a
   set's shingles are hashed into the band's m segments. Linked sets differ in
   at most H shingles, so of m > H segments at least m - H agree; m exceeds
   H + 1 by a surplus, so up to that many segments of a set may go unused.
3. Allocation. A segment that is empty costs most and tells nothing: it gets no
   key (0). Others get a key of their content (1). A set with more empty
   segments than the surplus gets, besides, the keys of all its segments with
   one shingle left out (2): if it links to another such set, some segment of
   theirs differs in one shingle at most.
4. Sets that share a key are candidates. First each is verified with the least
   set that it shares a key with; that joins most groups at one pair per set. Of
   the pairs left, those of sets not yet connected are verified: for keys of few sets all
   of them; for keys of many sets those of sets that have more empty segments
   and such crowded keys than the surplus, as any other partner shares a less
   crowded key. There is no limit on partners.
5. Verification counts the common shingles of whole texts.

Null and empty texts and texts without words have no shingles, link with
nothing, and are components of their own. Fewer than k words are one shingle.
Repeated rows are copies. Rows with a null id are members, but name a component
only if all its ids are null. Shingles and sets are told apart by 64-bit hashes.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import map_arrow, mix, parts_for, shingle_hashes, spread, text_runs, tidy, total_bytes, without, word_hashes
from .components import connected, with_links

CROWDED = 8
SURPLUS = 0.1
FLUSH_KEYS = 1_500_000
_U = np.uint64
_BAND, _SEGMENT, _DELETED = (mix(np.array([i], np.uint64))[0] | _U(1) for i in (101, 102, 103))


def set_runs(texts: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, distinct shingles of each text in rising order, bounds)."""
    for lo, hi, data, offsets in text_runs(texts):
        shingles, bounds = shingle_hashes(*word_hashes(data, offsets), k)
        parts = [np.unique(shingles[bounds[i] : bounds[i + 1]]) for i in range(hi - lo)]
        yield lo, hi, np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def set_ids(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One number per set, the same for equal sets."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        out[some] = np.add.reduceat(mix(shingles ^ _BAND), bounds[:-1][some])
    return mix(out + sizes.astype(np.uint64) * _SEGMENT)


def bands(percent: int, largest: int = 1 << 40) -> np.ndarray:
    """Least size of each band."""
    lows, low = [], 1
    while low <= largest:
        lows.append(low)
        low = max(low + 1, math.ceil(low * 100 / percent))
    return np.array(lows, np.int64)


def band_segments(lows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(segments, surplus) of each band.

    Sets of sizes s <= t link only if they differ in at most
    floor((100 - p) (s + t) / (100 + p)) shingles; s stands in the band, and t
    is at most 100 s / p.
    """
    most = np.append(lows[1:] - 1, lows[-1] * 2)
    reach = most * 100 // percent
    differ = (100 - percent) * (most + reach) // (100 + percent)
    surplus = np.maximum(1, (differ * SURPLUS).astype(np.int64))
    return differ + 1 + surplus, surplus


class Keys:
    """Keys of the segments of sets, for the band of each and the band below."""

    def __init__(self, percent: int):
        self.lows = bands(percent)
        self.segments, self.surplus = band_segments(self.lows, percent)

    def of(self, shingles: np.ndarray, bounds: np.ndarray, down: int):
        """(key, set, role, spare) arrays of the sets in their band, or the one below if `down`.

        role is the band the key is for; spare is the surplus less the empty segments.
        """
        sizes = np.diff(bounds)
        band = np.searchsorted(self.lows, sizes, "right") - 1 - down
        some = np.flatnonzero((sizes > 0) & (band >= 0))
        if not len(some):
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none, none
        m = self.segments[band[some]]
        base = np.concatenate([[0], np.cumsum(m)])
        rows = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in some])
        of_set = np.repeat(np.arange(len(some)), sizes[some])
        x = shingles[rows]
        segment = ((mix(x ^ _SEGMENT) >> _U(32)) * m[of_set].astype(np.uint64) >> _U(32)).astype(np.int64)
        place = base[of_set] + segment
        value, count = np.zeros(base[-1], np.uint64), np.bincount(place, minlength=base[-1])
        np.add.at(value, place, mix(x ^ _DELETED))
        owner = np.repeat(np.arange(len(some)), m)
        number = np.arange(base[-1]) - base[:-1][owner]
        salt = mix(band[some].astype(np.uint64) * _BAND)[owner] ^ mix(number.astype(np.uint64) * _SEGMENT)
        used = count > 0
        keys = mix(value + salt)
        spare = self.surplus[band[some]] - (m - np.bincount(owner[used], minlength=len(some)))
        out_keys, out_sets = [keys[used]], [owner[used]]
        # Allocation 2 for sets short of segments: whole and one-deletion keys.
        short = spare < 0
        if short.any():
            at = np.flatnonzero(short[of_set])
            whole = np.flatnonzero(used & short[owner])
            out_keys += [mix(keys[whole] ^ _DELETED), mix(mix(value[place[at]] - mix(x[at] ^ _DELETED) + salt[place[at]]) ^ _DELETED)]
            out_sets += [owner[whole], of_set[at]]
            # Too few segments even so: such sets of a band meet in one key.
            needed = self.segments[band[some]] - self.surplus[band[some]]
            bare = np.flatnonzero(short & (2 * np.bincount(owner[used], minlength=len(some)) < needed))
            out_keys.append(mix(band[some][bare].astype(np.uint64) * _DELETED))
            out_sets.append(bare)
        sets = np.concatenate(out_sets)
        return np.concatenate(out_keys), some[sets], band[some][sets], spare[sets]


SET_SCHEMA = "doc_id long, spot long, n_shingles long, set long"


def doc_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, spot, n_shingles, set) of each document of (doc_id, spot, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, ids = [], []
        for _, _, shingles, bounds in set_runs(batch.column(2), k):
            sizes.append(np.diff(bounds))
            ids.append(set_ids(shingles, bounds).view(np.int64))
        columns = [batch.column(0), batch.column(1), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(ids))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "spot", "n_shingles", "set"])

    return map_arrow(docs, run, SET_SCHEMA)


# A key's set carries its spare segments, capped, plus DOWN for keys of the band below its own.
DOWN = 64
POSTING_SCHEMA = "bucket int, keys binary, sets binary, spare binary"


def postings(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """Keys and the sets that have them, packed by bucket of the key.

    A set that a task has met before gives no keys again, so a group of copies
    costs a task one set.
    """

    def packed(held: list[tuple]) -> pa.RecordBatch:
        keys, sets, spare = (np.concatenate(c) for c in zip(*held))
        bucket = ((keys >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        ends = np.append(first[1:], len(order))
        take = lambda a: pa.array([a[order[i:j]].tobytes() for i, j in zip(first, ends)], pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[order][first]), take(keys), take(sets), take(spare)], ["bucket", "keys", "sets", "spare"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, met, held, count = Keys(percent), set(), [], 0
        for batch in batches:
            for _, _, shingles, bounds in set_runs(batch.column(1), k):
                ids = set_ids(shingles, bounds)
                new = [i for i, s in enumerate(ids.tolist()) if not (s in met or met.add(s))]
                chosen = [shingles[bounds[i] : bounds[i + 1]] for i in new]
                if not chosen:
                    continue
                ends = np.concatenate([[0], np.cumsum([len(c) for c in chosen])])
                for down in (0, 1):
                    keys, owner, _, spare = maker.of(np.concatenate(chosen), ends, down)
                    held.append((keys, ids[new][owner], (np.clip(spare, -1, 40) + down * DOWN).astype(np.int8)))
                    count += len(keys)
                if count >= FLUSH_KEYS:
                    yield packed(held)
                    held, count = [], 0
        if count:
            yield packed(held)

    return docs.mapInArrow(tidy(run), POSTING_SCHEMA)


CANDIDATE_SCHEMA = "kind byte, a long, b long, n int, need int"
STAR = 0  # (least set met, set)
PAIR = 1  # (set, set), common keys, and how many they need at least
MEMBER = 2  # (crowded key, set), 1 for a key of the band below, spare segments


def _meet(part: pa.Table) -> pa.Table:
    """Candidates of one bucket.

    Two sets link through keys of the lower of their bands, so at least one of
    them is at home there.
    """
    joined = lambda name, kind: np.frombuffer(b"".join(part.column(name).to_pylist()), kind)
    keys, sets, spare = joined("keys", np.uint64), joined("sets", np.int64), joined("spare", np.int8)
    # Keys that stand alone are most; drop them before sorting by set.
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = k[1:] == k[:-1]
    order = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
    below = spare[order] >= DOWN - 1
    order = order[np.lexsort((sets[order], below, keys[order]))]  # sets at home first
    k, s, e = keys[order], sets[order], spare[order].astype(np.int32)
    if len(k):
        fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])  # a set once per key
        k, s, e = k[fresh], s[fresh], e[fresh]
    below = e >= DOWN - 1
    e = np.where(below, e - DOWN, e)
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(k)))
    met = (count > 1) & ~below[first] if len(first) else np.zeros(0, bool)
    first, count = first[met], count[met]
    leader = np.repeat(first, count - 1)
    member = np.concatenate([np.arange(f + 1, f + c) for f, c in zip(first, count)]) if len(first) else leader
    order = np.lexsort((s[leader], s[member]))  # each set with the least of its leaders
    a, b = s[leader][order], s[member][order]
    once = np.concatenate([[True], b[1:] != b[:-1]]) if len(b) else np.zeros(0, bool)
    stars = np.stack([a[once], b[once]], 1)
    left, right = [], []
    for c in range(2, CROWDED + 1):
        i, j = np.triu_indices(c, 1)
        at = first[count == c]
        left.append((at[:, None] + i).ravel())
        right.append((at[:, None] + j).ravel())
    left, right = np.concatenate(left), np.concatenate(right)
    home = ~(below[left] & below[right])
    left, right = left[home], right[home]
    swap = s[left] > s[right]
    left, right = np.where(swap, right, left), np.where(swap, left, right)
    pairs, where, common = np.unique(np.stack([s[left], s[right]], 1), axis=0, return_inverse=True, return_counts=True)
    need = np.zeros(len(pairs), np.int64)
    np.maximum.at(need, where.ravel(), 1 + np.maximum(e[left], e[right]))
    crowded = count > CROWDED
    inside = np.concatenate([np.arange(f, f + c) for f, c in zip(first[crowded], count[crowded])]) if crowded.any() else leader[:0]
    members = np.stack([k[inside].view(np.int64), s[inside]], 1)
    rows = [stars, pairs.reshape(-1, 2), members]
    kinds = np.repeat(np.array([STAR, PAIR, MEMBER], np.int8), [len(r) for r in rows])
    none = np.zeros(len(stars), np.int64)
    both = np.concatenate(rows)
    columns = [
        pa.array(kinds),
        pa.array(both[:, 0]),
        pa.array(both[:, 1]),
        pa.array(np.concatenate([none, common, below[inside]]).astype(np.int32)),
        pa.array(np.concatenate([none, need, e[inside]]).astype(np.int32)),
    ]
    return pa.table(columns, ["kind", "a", "b", "n", "need"])


SKETCH_SCHEMA = "set long, size long, below byte, sketch binary"


def sketches(shingles: np.ndarray, lows: np.ndarray, below: int) -> bytes:
    """A byte per segment of a fine partition for a band: the sum of odd hashes of what is in it.

    Where two sets of a band have different bytes they differ in a shingle there,
    and in two if the lowest bits are equal, as those tell odd from even numbers.
    """
    band = int(np.searchsorted(lows, len(shingles), "right")) - 1 - below
    width = int(max(32, lows[max(band, 0)]))
    place = ((mix(shingles ^ _DELETED) >> _U(32)) * _U(width) >> _U(32)).astype(np.int64)
    return np.bincount(place, mix(shingles ^ _SEGMENT) & _U(255) | _U(1), width).astype(np.int64).astype(np.uint8).tobytes()


CLOSE_SCHEMA = "a long, b long"
BLOCK = 1000
ROUNDS = 4


def _close(part: pa.Table, percent: int, spanning: bool) -> pa.Table:
    """Pairs of two blocks of a crowded key's sets that may link, by size and sketch.

    With `spanning`, each set gets the nearest only, and the two count as
    connected from there on, so no more pairs come out than sets go in.
    """
    side = part.column("side").to_numpy()
    sets, sizes, below = (part.column(c).to_numpy() for c in ("set", "size", "below"))
    labels = part.column("label").to_numpy().copy()
    sketch = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in part.column("sketch")])
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(right):
        right = left
    out = [np.zeros((0, 2), np.int64)]
    for i in left:
        near = labels[right] != labels[i]
        near &= (sizes[right] * 100 >= sizes[i] * percent) & (sizes[i] * 100 >= sizes[right] * percent)
        near &= (below[right] == 0) | (below[i] == 0)
        j = right[near]
        differ = sketch[j] ^ sketch[i]
        apart = 2 * (differ != 0).sum(1) - (differ & 1).sum(1)
        may = apart * (100 + percent) <= (100 - percent) * (sizes[i] + sizes[j])
        j = j[may]
        if spanning and len(j):
            j = j[[apart[may].argmin()]]
            labels[labels == labels[i]] = labels[j[0]]
        out.append(np.stack([np.minimum(sets[i], sets[j]), np.maximum(sets[i], sets[j])], 1))
    pairs = np.unique(np.concatenate(out), axis=0)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def sketched(members: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """(set, size, below, sketch) of the sets of crowded keys."""
    lows = bands(percent)
    wanted = materialize(reps.join(members.select("set").distinct(), "set", "left_semi"), "crowded-sets")
    few = wanted.count() <= 1_000_000  # 16 bytes each
    chosen = docs.join(F.broadcast(wanted) if few else wanted, "spot").select("set", "text")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        sets = batch.column(0).to_pylist()
        for lo, hi, shingles, bounds in set_runs(batch.column(1), k):
            for i in range(hi - lo):
                own = shingles[bounds[i] : bounds[i + 1]]
                rows += [(sets[lo + i], len(own), below, sketches(own, lows, below)) for below in (0, 1)]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int8(), pa.binary()))]
        return pa.RecordBatch.from_arrays(columns, ["set", "size", "below", "sketch"])

    return materialize(map_arrow(chosen, cut, SKETCH_SCHEMA).dropDuplicates(["set", "below"]), "sketches")


def close_members(members: DataFrame, labels: DataFrame, made: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """(a, b) pairs that share a crowded key, are not connected, and may link.

    `members` is (key, set, below). The sets of a key meet in blocks of bounded
    size, and only what the sketches leave possible comes out.
    """
    labelled = members.join(labels.withColumnRenamed("node", "set"), "set", "left")
    labelled = materialize(labelled.select("key", "set", "below", F.coalesce("label", "set").alias("label")), "crowded")
    sizes = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    mixed = sizes.where("low <> high").select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = labelled.join(mixed, "key")
    own = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    meets = lambda o: F.struct(
        F.least(own, o).alias("one"), F.greatest(own, o).alias("two"), F.when(own > o, 1).otherwise(0).alias("side")
    )
    dealt = dealt.withColumn("m", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), meets)))
    rows = dealt.select("key", "set", "label", "below", "m.*").join(made, ["set", "below"])
    met = rows.groupBy("key", "one", "two").applyInArrow(lambda part: _close(part, percent, spanning), CLOSE_SCHEMA)
    return met.distinct()


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of the distinct (a, b) pairs of sets that link.

    Only texts of sets in a pair are cut; a set travels once per pair.
    """
    pairs = materialize(pairs.select("a", "b").distinct(), "set-pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    wanted = materialize(reps.join(asked, "set", "left_semi"), "wanted-sets")
    few = wanted.count() <= 1_000_000  # 16 bytes each
    chosen = docs.join(F.broadcast(wanted) if few else wanted, "spot").select("set", "text")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        packed = []
        for lo, hi, shingles, bounds in set_runs(batch.column(1), k):
            packed += [shingles[bounds[i] : bounds[i + 1]].tobytes() for i in range(hi - lo)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["set", "shingles"])

    # Rows that repeat an id and a text would be cut twice.
    once = map_arrow(chosen, cut, "set long, shingles binary").dropDuplicates(["set"])
    stored = materialize(once, "sets")
    left = stored.withColumnsRenamed({"set": "a", "shingles": "of_a"})
    right = stored.withColumnsRenamed({"set": "b", "shingles": "of_b"})
    both = pairs.join(left, "a").join(right, "b")

    def compare(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("of_a"), batch.column("of_b")):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= percent * (len(x) + len(y) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep))

    return materialize(map_arrow(both.select("a", "b", "of_a", "of_b"), compare, "a long, b long"), "links")


def jaccard_components(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85, bucket_keys: int = 400_000
) -> DataFrame:
    """(doc_id, n_shingles, component_id, label, spot) of every document.

    `label` tells components apart where ids repeat or are null, and is null
    without shingles; `spot` is a hash of id and text.
    """
    docs = spread(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    docs = docs.withColumn("spot", F.xxhash64("doc_id", "text"))
    size = total_bytes(docs, "text")
    # About one key per 16 bytes of text.
    buckets = parts_for(size // 16, bucket_keys, least=8)
    sets = materialize(doc_sets(docs.select("doc_id", "spot", "text"), k), "doc-sets")
    met = postings(docs.select("doc_id", "text"), k, percent, buckets).groupBy("bucket").applyInArrow(
        lambda part: _meet(part), CANDIDATE_SCHEMA
    )
    met = materialize(met, "candidates")
    # One row stands for each set: that of the least id.
    least = sets.where("n_shingles > 0").groupBy("set").agg(F.min_by("spot", F.struct("doc_id", "spot")).alias("spot"))
    reps = materialize(least, "set-reps")

    nearest = met.where(F.col("kind") == STAR).groupBy("b").agg(F.min("a").alias("a"))
    links = verified(nearest, docs, reps, k, percent)
    labels = connected(links, "a", "b")

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose sets are in different components so far."""
        x = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        y = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        joined = pairs.join(x, "a", "left").join(y, "b", "left")
        return joined.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")

    shared = met.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    crowded = met.where(F.col("kind") == MEMBER).select(
        F.col("a").alias("key"), F.col("b").alias("set"), F.col("n").cast("byte").alias("below"), F.col("need").alias("spare")
    )
    load = materialize(crowded.groupBy("set", "below").agg(F.count(F.lit(1)).alias("n"), F.min("spare").alias("spare")), "load")
    most = load.groupBy("set").agg(F.max("n").alias("most"))
    shared = materialize(shared, "pairs-met")
    enough = shared.where("n >= need").select("a", "b")
    # Too few keys in common, unless crowded ones make up for it.
    lacking = shared.where("n < need").join(most.select(F.col("set").alias("a"), F.col("most").alias("na")), "a")
    lacking = lacking.join(most.select(F.col("set").alias("b"), F.col("most").alias("nb")), "b")
    lacking = lacking.where("n + least(na, nb) >= need").select("a", "b")

    short = load.where("n > spare").select("set", "below")
    members = materialize(crowded.join(short, ["set", "below"]).select("key", "set", "below"), "members")
    rest = None
    if not members.isEmpty():
        made = sketched(members, docs, reps, k, percent)
        for _ in range(ROUNDS):  # join groups of near copies by few pairs before all pairs left are looked at
            close = close_members(members, labels, made, percent, True).groupBy("b").agg(F.min("a").alias("a"))
            new = verified(close, docs, reps, k, percent)
            if new.isEmpty():
                break
            labels = with_links(labels, new, "a", "b")
        rest = close_members(members, labels, made, percent, False)
    pairs = apart(enough.unionByName(lacking))
    pairs = pairs if rest is None else pairs.unionByName(rest)
    more = verified(pairs, docs, reps, k, percent)
    if not more.isEmpty():
        labels = with_links(labels, more, "a", "b")

    placed = labels.withColumnRenamed("node", "set")
    in_set = sets.where("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("least"))
    labelled = in_set.join(placed, "set", "left").select("set", "least", F.coalesce("label", "set").alias("label"))
    labelled = materialize(labelled, "labelled")
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    named = materialize(labelled.join(named, "label").select("set", "label", "component_id"), "named")
    return sets.join(named, "set", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "label",
        "spot",
    )


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **rule: int) -> DataFrame:
    """The rows of `docs` less near duplicates: of each component the row of the least id stays.

    Documents without shingles stay. Of rows equal in id and text one stays; of
    rows that share an id only, the one whose hash is least.
    """
    docs = without(docs, "_spot", "_rows", "_size")
    found = jaccard_components(docs, doc_id=doc_id, text=text, **rule)
    some = found.where("n_shingles > 0").select("label", F.struct(F.col("doc_id"), F.col("spot")).alias("row"))
    best = some.groupBy("label").agg(F.min("row").alias("row"))
    rows = found.groupBy("spot").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("size"))
    kept = rows.join(best.select(F.col("row.spot").alias("spot"), F.lit(True).alias("best")), "spot", "left")
    kept = kept.where("best OR size = 0").select(
        F.col("spot").alias("_spot"), F.col("n").alias("_rows"), F.col("size").alias("_size")
    )
    kept = materialize(kept, "kept")
    few = kept.count() <= 1_000_000  # 24 bytes each
    spotted = docs.withColumn("_spot", F.xxhash64(F.col(doc_id).cast("long"), text))
    joined = spotted.join(F.broadcast(kept) if few else kept, "_spot")
    single = joined.where("_rows = 1 OR _size = 0").select(*docs.columns)
    repeated = joined.where("_rows > 1 AND _size > 0").dropDuplicates(["_spot"]).select(*docs.columns)
    return single.unionByName(repeated)
