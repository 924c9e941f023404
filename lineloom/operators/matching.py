"""Find which of many names occur in which of many texts.

"Text contains name" is not an equality, and joining every text with every
name is out of the question. The way taken here has equi-joins only:

1. every text is cut into words, each with the word-breaking character that may
   follow it, and the *distinct* words are gathered. That is one pass with
   map-side combining, and much smaller than the text;
2. each distinct word is compared with the names through a short piece both
   must share (for a name: the piece that fewest names have);
3. the written (word, name) pairs are joined with the distinct words of each
   text. They are broadcast if they are measured to be small, otherwise the
   words are shuffled, hot words salted. Their number grows with the words
   times the names each contains, so where only the first name counts,
   `least_names` keeps one pair per word and kind.

A name with a word-breaking character anywhere but at its end is looked up by
its longest part, and the text is then checked for the whole name, once per
text and name.

Cutting texts into words costs as much as looking for some thousand names in
them one after the other. So a list of at most `DIRECT_NAMES` names is looked
for in each text as it is read: one pass without a shuffle, wildcards or not.
The way through words is for longer lists, and where nothing may be broadcast.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.text import WORD_BREAKS, grams_of, pieces_of, tokens_of
from ..session import materialize
from .joins import BROADCAST_BYTES, keyed_join, materialize_measured, row_bytes

# Lengths of the pieces names are looked up by. A name takes the longest that
# fits; few lengths keep the words from being cut up too often.
GRAM_SIZES = (8, 5, 3, 2, 1)
MIN_WINDOW = 128

# Names that are looked for one by one in every text, and the bytes of their
# rows: they become constants of the plan.
DIRECT_NAMES, DIRECT_BYTES = 512, 1 << 20


def _gram_size(needle: str):
    size = F.lit(0)
    for n in reversed(GRAM_SIZES):
        size = F.when(F.length(needle) >= n, n).otherwise(size)
    return size


def _short_list(patterns: DataFrame, bound: int) -> list | None:
    """The rows of a list that is short enough to be looked for directly."""
    if not bound:
        return None
    rows = _in_a_line(patterns).limit(DIRECT_NAMES + 1).collect()
    size = sum(16 + len(str(value).encode()) for row in rows for value in row)
    return rows if len(rows) <= DIRECT_NAMES and size <= min(bound, DIRECT_BYTES) else None


def _has(text: str, pattern: str, wildcards: bool):
    if not wildcards or not set(pattern) & set("_%"):
        return F.contains(F.col(text), F.lit(pattern))
    # LIKE is a regular expression; few texts have the longest part without wildcards.
    like = F.col(text).like("%" + pattern.replace("\\", "\\\\") + "%")
    return F.contains(F.col(text), F.lit(max(re.split("[_%]", pattern), key=len))) & like


def _held(text: str, rows: list, wildcards: bool = False):
    held = [F.when(_has(text, p, wildcards), F.lit(p)) for p in sorted({r["pattern"] for r in rows})]
    return F.array_compact(F.array(*held))


def names_held(patterns: DataFrame, text: str, bound: int = BROADCAST_BYTES):
    """The patterns of a short list that a text contains, as an array column; None if the list is not short."""
    short = _short_list(patterns, bound)
    return _held(text, short) if short else None


def _names_directly(
    texts: DataFrame, keys: list[str], text: str, patterns: DataFrame, rows: list, wildcards: bool = False
) -> DataFrame:
    hits = texts.select(*keys, F.explode(_held(text, rows, wildcards)).alias("pattern"))
    return hits.join(F.broadcast(patterns), "pattern").select(*keys, *[c for c in patterns.columns if c != "pattern"])


def _least_directly(text: str, rows: list, kind: str, wildcards: bool):
    """The least place of a kind's patterns in a text: they are tried in order up to the first hit."""
    tried, first = [], F.when(F.lit(False), F.lit(None).cast("long"))
    for row in sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["place"]):
        # A text with a longer pattern has the ones inside it, too.
        if not any(p in row["pattern"] for p in tried):
            tried.append(row["pattern"])
            first = first.when(_has(text, row["pattern"], wildcards), F.lit(row["place"]).cast("long"))
    return first.alias(kind)


class _Search:
    """What a search in `texts` for `patterns` needs before its two ways part."""

    def __init__(self, texts: DataFrame, keys: list[str], text: str, patterns: DataFrame, wildcards: bool, bound: int):
        self.texts, self.keys, self.text = texts, keys, text
        self.wildcards, self.bound = wildcards, bound
        self.payload = [c for c in patterns.columns if c != "pattern"]
        self.prepared = _with_needles(patterns, wildcards)
        self.facts = self.prepared.agg(
            F.collect_set(_gram_size("needle")).alias("sizes"),
            F.min(F.length("needle")).alias("shortest"),
            F.max(F.length("needle")).alias("longest"),
            F.sum(row_bytes(self.prepared.schema)).alias("bytes"),
            F.bool_and("exact").alias("exact"),
        ).first()
        self.blank = [F.lit(None).cast(patterns.schema[c].dataType).alias(c) for c in self.payload]
        self.empty = not self.facts["sizes"]

    def words(self, columns: list[str]) -> DataFrame:
        """(columns, word): the distinct words of each text, long runs in overlapping pieces."""
        words = F.array_distinct(tokens_of(F.col(self.text)))
        if 0 in self.facts["sizes"]:  # names with nothing to look up by: checked on every text
            words = F.concat(words, F.array(F.lit("")))
        window = max(MIN_WINDOW, self.facts["longest"])
        cut = self.texts.select(*columns, F.explode(words).alias("run"))
        return cut.select(*columns, F.explode(pieces_of(F.col("run"), window)).alias("word"))

    def pairs(self) -> DataFrame:
        vocabulary = self.words([]).where(F.length("word") >= self.facts["shortest"]).distinct()
        return _word_pairs(vocabulary, self.prepared, self.facts, self.bound)

    def joined(self, pairs: DataFrame, size: int) -> DataFrame:
        return keyed_join(self.words(self.keys), pairs, ["word"], "inner", self.keys, bound=self.bound, right_bytes=size)

    def checked(self, asked: DataFrame) -> DataFrame:
        """Those of the distinct (keys, pattern, …) whose text contains the whole pattern."""
        asked, size = materialize_measured(asked, "open-hits")
        aside = {k: f"_{k}" for k in self.keys}
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(aside[k])) for k in self.keys])
        contains = _verifies(self.text, self.wildcards)
        probe = self.texts.select(*self.keys, self.text)
        if size <= self.bound:
            right = F.broadcast(asked.withColumnsRenamed(aside))
            found = probe.join(right, same & contains)
            return found.select(*self.keys, *[c for c in asked.columns if c not in self.keys])
        wanted = asked.select(*self.keys).distinct().withColumnsRenamed(aside)
        probe = probe.join(wanted, same, "left_semi").dropDuplicates(self.keys).withColumnsRenamed(aside)
        return asked.join(probe, same & contains, "left_semi")


def find_names(
    texts: DataFrame,
    keys: list[str],
    text: str,
    patterns: DataFrame,
    *,
    wildcards: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows ``keys + pattern columns`` for every pattern a text contains.

    `texts` holds lower-cased text under `text`; `keys` identify a text.
    `patterns` has a column `pattern` (lower case) and whatever should come
    with it; it is read several times, so it should be a written table. With
    `wildcards` the characters ``_`` and ``%`` of a pattern work as in LIKE.

    One hit may be given more than once for a text.
    """
    short = _short_list(patterns, bound)
    if short:
        return _names_directly(texts, keys, text, patterns, short, wildcards)
    search = _Search(texts, keys, text, patterns, wildcards, bound)
    if search.empty:
        return texts.select(*keys, *search.blank).where(F.lit(False))
    joined = search.joined(*materialize_measured(search.pairs(), "word-pairs"))
    if search.facts["exact"]:
        return joined.select(*keys, *search.payload)
    joined = materialize(joined.select(*keys, "exact", "pattern", *search.payload).distinct(), "hits")
    sure = joined.where("exact").select(*keys, *search.payload)
    open_hits = joined.where("NOT exact").drop("exact")
    return sure.unionByName(search.checked(open_hits).select(*keys, *search.payload))


def least_names(
    texts: DataFrame,
    keys: list[str],
    text: str,
    patterns: DataFrame,
    *,
    kinds: list[str],
    wildcards: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keys, one column per kind): the least `place` of the patterns of a kind that a text contains.

    `patterns` is (pattern, kind, place), a written table; the rest is as for
    `find_names`. Every text gives at least one row, with NULL for a kind that it
    has none of; take the least again after grouping. A word keeps the first of
    the names in it only, so the pairs are no more than words times kinds, and
    a name that needs a look at the text is looked for only where it would come
    before what is known.
    """
    short = _short_list(patterns, bound)
    if short is not None:
        return texts.select(*keys, *[_least_directly(text, short, kind, wildcards) for kind in kinds])
    search = _Search(texts, keys, text, patterns, wildcards, bound)
    none = [F.lit(None).cast("long").alias(k) for k in kinds]
    if search.empty:
        return texts.select(*keys, *none)
    firsts = lambda rows: [F.min(F.when(F.col("kind") == k, F.col("place"))).alias(k) for k in kinds]
    every = search.pairs()
    if not search.facts["exact"]:
        every = materialize(every, "word-pairs")
    exact = every.where("exact").groupBy("word").agg(*firsts(every))
    exact, size = materialize_measured(exact, "first-pairs")
    by_word = search.words(keys)
    if size <= bound:
        sure = by_word.join(F.broadcast(exact), "word", "left").select(*keys, *kinds)
    else:
        found = keyed_join(by_word, exact, ["word"], "inner", keys, bound=bound, right_bytes=size)
        sure = found.select(*keys, *kinds).unionByName(texts.select(*keys, *none))
    open_pairs, open_size = None, 0
    if not search.facts["exact"]:
        unsure = every.where("NOT exact").select("word", "pattern", "kind", "place")
        open_pairs, open_size = materialize_measured(unsure, "open-pairs")
    if not open_size:
        # Texts without a word give no row above.
        return sure.unionByName(texts.where(F.coalesce(F.size(tokens_of(F.col(text))), F.lit(0)) == 0).select(*keys, *none))
    sure = sure.unionByName(texts.select(*keys, *none)).groupBy(*keys).agg(*[F.min(k).alias(k) for k in kinds])
    sure = materialize(sure, "sure")
    asked = search.joined(open_pairs, open_size).select(*keys, "pattern", "kind", "place").distinct()
    known = reduce(lambda out, k: F.when(F.col("kind") == k, F.col(f"_of_{k}")).otherwise(out), kinds, F.lit(None))
    aside = sure.withColumnsRenamed({**{k: f"_key_{k}" for k in keys}, **{k: f"_of_{k}" for k in kinds}})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    asked = asked.join(aside, same, "left").where(known.isNull() | (F.col("place") < known))
    hits = search.checked(asked.select(*keys, "pattern", "kind", "place"))
    each = [F.when(F.col("kind") == k, F.col("place")).alias(k) for k in kinds]
    return sure.unionByName(hits.select(*keys, *each))


def _in_a_line(patterns: DataFrame) -> DataFrame:
    return patterns.where(~F.col("pattern").rlike(r"[\r\n]"))  # no line contains a line end


def _with_needles(patterns: DataFrame, wildcards: bool) -> DataFrame:
    """Add `needle`, what a word must contain, and `exact`, whether that is all."""
    special = WORD_BREAKS + ("_%" if wildcards else "")
    # A word comes with the character that follows it, so one break at the end is no matter.
    body = F.regexp_replace("pattern", rf"[{WORD_BREAKS}]\z", "")
    parts = F.split(body, f"[{special}]+")
    longest = F.array_max(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))["p"]
    exact = (body != "") & ~body.rlike(f"[{special}]")
    return (
        _in_a_line(patterns)
        .withColumn("exact", exact)
        .withColumn("needle", F.when(exact, F.col("pattern")).otherwise(longest))
    )


def _verifies(text: str, wildcards: bool):
    if wildcards:
        return F.expr(f"`{text}` LIKE concat('%', replace(pattern, '\\\\', '\\\\\\\\'), '%')")
    return F.contains(F.col(text), F.col("pattern"))


def _word_pairs(vocabulary: DataFrame, prepared: DataFrame, facts, bound: int) -> DataFrame:
    """(word, pattern columns) for every word that contains a needle."""
    needles = prepared.select("needle").distinct()
    sizes = sorted(n for n in facts["sizes"] if n > 0)
    own = F.array(F.lit(""))
    for n in sizes:
        own = F.when(_gram_size("needle") == n, F.array_distinct(grams_of(F.col("needle"), n))).otherwise(own)
    pieces = needles.select("needle", F.explode(own).alias("gram"))
    shared = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = pieces.join(shared, "gram").groupBy("needle").agg(F.min(F.struct("n", "gram")).alias("best"))
    keyed = rarest.select("needle", F.col("best.gram").alias("gram"))

    cut = _cut_words(vocabulary, sizes, blank=0 in facts["sizes"])

    # The names were measured with the facts, and a needle or its piece is no
    # longer than its name's row.
    size = facts["bytes"]
    found = keyed_join(cut, keyed, ["gram"], "inner", ["word"], bound=bound, right_bytes=size)
    once = F.instr("word", F.col("gram")) == F.col("at")  # a piece may stand in a word twice
    found = found.where(once & F.contains(F.col("word"), F.col("needle"))).select("word", "needle")
    return keyed_join(found, prepared, ["needle"], "inner", ["word"], bound=bound, right_bytes=size).drop("needle")


def _cut_words(vocabulary: DataFrame, sizes: list[int], blank: bool) -> DataFrame:
    """(word, at, gram) for every place of a word and every gram size that fits there.

    `blank` keeps the empty word, with the empty gram.
    """
    word, at = F.col("word"), F.col("at")
    smallest = min(sizes, default=1)
    places = F.sequence(F.lit(1), F.length(word) - smallest + 1)
    wanted = F.length(word) >= smallest
    grams = [F.when(at + n - 1 <= F.length(word), F.substring(word, at, F.lit(n))) for n in sizes]
    if blank:
        places = F.when(word == "", F.array(F.lit(1))).otherwise(places)
        wanted = wanted | (word == "")
        grams.append(F.when(word == "", F.lit("")))
    placed = vocabulary.where(wanted).select(word, F.explode(places).alias("at"))
    return placed.select(word, at, F.explode(F.array(*grams)).alias("gram")).where("gram IS NOT NULL")
