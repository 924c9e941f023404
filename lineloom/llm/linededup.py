"""Line deduplication: segment-partition edit join, in DataFrame functions only.

A line goes if an earlier line, by (doc_id, place in the text), is within
`edits` edits of it. Lines are compared without spaces at their ends; lines
under `least` characters always stay, and lines under `least_near` characters go
only for an equal line.

1. A line of length L is cut into edits + 1 segments; a line within that many
   edits contains one of them unchanged, at a place that the lengths and the
   segment's number leave few choices for. Each line gives the keys (length,
   number, segment) of its own cut and those that it would match in the cuts of
   lines up to `edits` characters shorter.
2. One aggregation with map-side combining finds the keys that two different
   lines share, and only lines with such a key go on, each once per key. Where
   these keys are too many to send to every task, bits of them are sent.
3. Lines that share a key are compared inside the join: if their counts of some
   characters allow it, equal starts and ends are taken off, and a bit-parallel automaton of 2 * edits + 1 diagonals, one
   register per number of edits, reads what is left.
4. Equal lines are found by hash, with map-side combining.
5. A document's dropped places are gathered, and its text is put together again.

Texts are not shuffled unless the list of dropped places is too large to send
to every task.

Null and empty texts stay as they are. Null ids come before all others. Rows
with equal ids are one document: they are not compared with each other's lines
at the same or a later place. Chains count: a line may go for one that goes
itself. Extra columns are kept, but
for those named as the ones added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .common import maybe_among, spread, without

FEW_ROWS = 1_000_000
FIRST_ID = -(1 << 63)


def keyed_lines(lines: DataFrame, edits: int) -> DataFrame:
    """(line, id, key, own) of (line, size, id): the keys of each line's own segments, and of those
    that it may hold of other lines.

    Pieces are taken from the line in UTF-32, where they are found without
    counting through the characters before them. Lines have at least
    `shortest(edits)` characters, so every place tried is inside the line.
    """
    parts = edits + 1
    places, sizes, keys = {}, {}, []
    for shorter in range(edits + 1):
        base, rest = F.expr(f"(size - {shorter}) div {parts}").cast("int"), (F.col("size") - shorter) % parts
        for i in range(1, parts + 1):
            sizes[f"n{shorter}_{i}"] = (base + F.when(rest > parts - i, 1).otherwise(0)) * 4
            start = base * (i - 1) + F.greatest(F.lit(0), F.lit(i - 1 - parts) + rest)
            places[f"p{shorter}_{i}"] = start * 4 + 1
            for shift in range(max(-(i - 1), shorter - (parts - i)), min(i - 1, shorter + parts - i) + 1):
                piece = F.substring("wide", F.col(f"p{shorter}_{i}") + 4 * shift, F.col(f"n{shorter}_{i}"))
                key = F.xxhash64(F.col("size") - shorter, F.lit(i), piece)
                keys.append(F.struct(key.alias("key"), F.lit(shorter == 0 and shift == 0).alias("own")))
    placed = lines.select("line", "size", "id", F.encode("line", "UTF-32").alias("wide"))
    placed = placed.select("*", *[c.alias(n) for n, c in {**places, **sizes}.items()])
    return placed.select("line", "id", F.inline(F.array(*keys)))


def shortest(edits: int) -> int:
    """Least length of lines that are searched for near ones: segments longer than any shift."""
    return (edits + 1) * (edits + 2)


def _common_start(a: Column, b: Column, side, most: int = 20) -> Column:
    """Length of the equal start (side = left) or end (side = right), by halving steps."""
    top = F.least(F.length(a), F.length(b))
    steps = F.array(*[F.lit(1 << k) for k in range(most, -1, -1)])
    grown = lambda so_far, step: F.when(
        (so_far + step <= top) & (side(a, so_far + step) == side(b, so_far + step)), so_far + step
    ).otherwise(so_far)
    return F.aggregate(steps, F.lit(0), grown)


def _let(values: Column, body) -> Column:
    """`body` of a struct that is computed once, however often body names its fields."""
    return F.get(F.transform(F.array(values), body), F.lit(0))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within `edits` edits of each other.

    A state is a diagonal d = (characters read of a) - (of b), a bit each. For e
    edits: keep the diagonals whose next characters are equal, or come from
    e - 1 edits by replacing (same d), adding (d - 1) or leaving out (d + 1).
    """
    diagonals = range(-edits, edits + 1)
    mask = (1 << len(diagonals)) - 1
    state = [1 << edits]
    for _ in range(edits):
        state.append((state[-1] | state[-1] << 1) & mask)
    fields = [f"r{e}" for e in range(edits + 1)]
    start = F.struct(*[F.lit(s).alias(f) for s, f in zip(state, fields)])

    def equal_bits(x: Column, char: Column, j: Column) -> Column:
        out = F.lit(0)
        for d in diagonals:
            there = F.when(j + d >= 0, F.get(x, j + d)) if d < 0 else F.get(x, j + d)
            out = out + F.when(there == char, 1 << (d + edits)).otherwise(0)
        return out

    def step(now: Column, equal: Column) -> Column:
        new = []
        for e, name in enumerate(fields):
            value = now[name].bitwiseAND(equal)
            if e:
                less = now[fields[e - 1]]
                moved = less.bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
                value = value.bitwiseOR(moved).bitwiseAND(F.lit(mask))
            new.append(value)
        return F.struct(*[v.alias(f) for v, f in zip(new, fields)])

    def read(p: Column) -> Column:
        bits = F.transform(p["b"], lambda char, j: equal_bits(p["a"], char, j))
        end = F.aggregate(bits, start, step, lambda s: s[fields[-1]])
        differ = F.size(p["a"]) - F.size(p["b"])
        # The end is reached on the diagonal of the two lengths.
        place = F.coalesce(*[F.when(differ == d, 1 << (d + edits)) for d in diagonals], F.lit(0))
        return end.bitwiseAND(place) != 0

    chars = lambda x: F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0))
    return _let(F.struct(chars(a).alias("a"), chars(b).alias("b")), read)


def similar(a: Column, b: Column, edits: int) -> Column:
    """`within` after taking off the equal start and end, which no edit is needed for."""
    cut = lambda x, n: F.substring(x, n + 1, F.length(x))
    left = lambda x, n: F.left(x, F.length(x) - n)

    def tail(p: Column) -> Column:
        same = _common_start(p["a"], p["b"], lambda x, n: F.right(x, n))
        named = F.struct(p["a"].alias("a"), p["b"].alias("b"), same.alias("n"))
        return _let(named, lambda q: within(left(q["a"], q["n"]), left(q["b"], q["n"]), edits))

    def head(p: Column) -> Column:
        rest = F.struct(cut(p["a"], p["n"]).alias("a"), cut(p["b"], p["n"]).alias("b"))
        return _let(rest, tail)

    same = _common_start(a, b, lambda x, n: F.left(x, n))
    found = _let(F.struct(a.alias("a"), b.alias("b"), same.alias("n")), head)
    return F.when(F.abs(F.length(a) - F.length(b)) <= edits, found).otherwise(False)


# An edit changes the counts of two characters by one at most, whichever are counted.
COUNTED = "eaintrsolud "


def char_counts(line: Column) -> list[Column]:
    return [(F.length(line) - F.length(F.replace(line, F.lit(c)))).alias(f"c{i}") for i, c in enumerate(COUNTED)]


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, spot, pos, line, size, id, id2); doc orders, spot tells rows apart."""
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST_ID)).alias("doc"),
        F.xxhash64(doc_id, text).alias("spot"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    return rows.select("doc", "spot", "pos", F.trim("line").alias("line")).select(
        "*", F.length("line").alias("size"), F.xxhash64("line").alias("id"), F.xxhash64("line", F.lit(1)).alias("id2")
    )


def near_lines(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """(id, other): pairs of different lines within `edits` edits, both ways."""
    keyed = keyed_lines(lines.where(F.col("size") >= max(least, shortest(edits))), edits)
    shared = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.bool_or("own").alias("own"))
    shared = materialize(shared.where("own AND low <> high").select("key"), "shared-keys")
    found = shared.count()
    if found <= FEW_ROWS:
        members = keyed.join(F.broadcast(shared), "key").distinct()
    else:  # a row per key holds the whole line, so none is shuffled that bits of the shared keys can tell apart
        members = maybe_among(keyed, shared, "key", found).distinct().join(shared, "key")
    members = materialize(members.select("*", *char_counts(F.col("line"))), "line-members")
    counted = [f"c{i}" for i in range(len(COUNTED))]
    own = members.where("own").select("key", F.col("id").alias("a"), F.col("line").alias("of_a"), *[F.col(c).alias(f"a_{c}") for c in counted])
    other = members.select(F.col("key").alias("key_b"), F.col("id").alias("b"), F.col("line").alias("of_b"), *counted)
    # The comparison belongs to the join, so that no pair is kept that fails it.
    apart = reduce(lambda x, y: x + y, [F.abs(F.col(f"a_{c}") - F.col(c)) for c in counted])
    alike = F.when(apart <= 2 * edits, similar(F.col("of_a"), F.col("of_b"), edits)).otherwise(False)
    met = own.join(other, (F.col("key") == F.col("key_b")) & (F.col("a") != F.col("b")) & alike)
    one, two = (F.struct(F.col(x).alias("id"), F.col(y).alias("other")) for x, y in ("ab", "ba"))
    pairs = met.select(F.explode(F.array(one, two)).alias("p"))
    return pairs.select("p.*").distinct()


# Lines of white space only.
BLANK = r"\A[\x20\x09-\x0D]*\z"


def dropped_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    edits: int = 2,
    least: int = 1,
    least_near: int = 0,
    stays: str | None = BLANK,
) -> DataFrame:
    """(spot, dropped, sources): per row with lines to drop, their places and the documents that had them first.

    Lines of `least` characters or more count, and near copies are searched of
    those of `least_near` or as many as the join can search. Lines that the pattern
    `stays` finds something in always stay; unless told otherwise, blank ones.
    """
    lines = _lines(docs, doc_id, text).where(F.col("size") >= least)
    if stays is not None:
        lines = lines.where(~F.col("line").rlike(stays))
    place = F.struct(F.col("doc"), F.col("pos"))
    firsts = lines.groupBy("id", "id2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    links = materialize(near_lines(lines, edits, least_near), "near-lines")
    firsts = materialize(firsts, "first-lines")
    theirs = firsts.select(F.col("id").alias("other"), F.col("first").alias("theirs"))
    nearest = links.join(theirs, "other").groupBy("id").agg(F.min("theirs").alias("theirs"))
    known = firsts.join(nearest, "id", "left").where("n > 1 OR theirs IS NOT NULL")
    known = materialize(known.select("id", "id2", F.least("first", F.coalesce("theirs", "first")).alias("first")), "known-lines")
    few = known.count() <= FEW_ROWS
    hits = lines.join(F.broadcast(known) if few else known, ["id", "id2"]).where(F.col("first") < place)
    dropped = hits.groupBy("spot").agg(
        F.array_sort(F.collect_set("pos")).alias("dropped"), F.array_sort(F.collect_set("first.doc")).alias("sources")
    )
    return materialize(dropped, "dropped-lines")


def dedup_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", edits: int = 2, **limits: int | str) -> DataFrame:
    """The columns of `docs` with the text left, and n_lines, dropped (places) and sources (ids)."""
    docs = spread(without(docs, "n_lines", "dropped", "sources", "_spot"))
    dropped = dropped_lines(docs, doc_id=doc_id, text=text, edits=edits, **limits)
    dropped = dropped.withColumnRenamed("spot", "_spot")
    size = dropped.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("dropped") + 2 * F.size("sources")), F.lit(0))).first()
    few = size[0] <= FEW_ROWS and size[1] <= 4 * FEW_ROWS
    joined = docs.withColumn("_spot", F.xxhash64(doc_id, text)).join(F.broadcast(dropped) if few else dropped, "_spot", "left")
    lines = F.split(text, "\n", -1)
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("dropped", i)), "\n")
    return joined.select(
        *[F.when(F.col("dropped").isNull(), F.col(text)).otherwise(left).alias(text) if c == text else F.col(c) for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
        F.coalesce("sources", F.array().cast("array<bigint>")).alias("sources"),
    )
