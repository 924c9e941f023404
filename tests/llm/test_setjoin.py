"""Set join against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lineloom.llm import setjoin
from lineloom.llm.components import connected, with_links

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string"


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def expected(rows, k, percent):
    """{doc_id: (size, component)} by comparing every pair of sets."""
    sets = {}
    for key, text in rows:
        sets.setdefault(shingles(text, k), []).append(key)
    each = [s for s in sets if s]
    parent = {s: s for s in each}

    def find(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    for i, a in enumerate(each):
        for b in each[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                parent[find(a)] = find(b)
    least = {}
    for s in each:
        least[find(s)] = min(least.get(find(s), 1 << 60), min(sets[s]))
    return {key: (len(s), least[find(s)] if s else key) for s, keys in sets.items() for key in keys}


def variants(rng, n, words, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "One", "one", "one two", "A b c", "a B  c", "a b c d"]
    texts += list(variants(rng, 60, 120, 6)) + list(variants(rng, 40, 15, 2)) + list(variants(rng, 30, 5, 1))
    texts += list(variants(rng, 6, 2500, 90))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(n)) for n in (0, 1, 2, 5, 9, 12, 40) * 5]
    texts += ["copy of this " * 9] * 40
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("k, percent, seed", [(4, 85, 1), (5, 80, 2), (2, 60, 3)])
def test_components_equal_brute_force(spark, k, percent, seed):
    rows = corpus(seed)
    found = setjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA), k=k, percent=percent, bucket_keys=500)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == expected(rows, k, percent)


def test_crowded_keys_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(setjoin, "BLOCK", 7)
    rows = list(enumerate(variants(random.Random(9), 90, 60, 4)))
    found = setjoin.jaccard_components(spark.createDataFrame(rows, SCHEMA), k=3, percent=85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == expected(rows, 3, 85)


def test_one_of_each(spark):
    text = "these ten words are the whole text of a document"
    rows = [(5, text), (3, text), (3, text), (3, "another text for an id that is taken already"), (None, text), (8, None), (9, ""), (None, None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("label", F.lit("kept")).withColumn("n", F.lit(1))
    kept = sorted(((r.doc_id, r.text) for r in setjoin.one_of_each(df).collect()), key=repr)
    assert kept == sorted([(None, text), rows[3], rows[5], rows[6], rows[7]], key=repr)
    some = setjoin.one_of_each(df.where("doc_id IS NOT NULL")).where("text IS NOT NULL AND text <> ''")
    assert sorted((r.doc_id, r.text) for r in some.collect()) == sorted([(3, text), rows[3]])
    assert setjoin.one_of_each(df).columns == df.columns


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert setjoin.jaccard_components(empty).count() == 0
    assert setjoin.one_of_each(empty).count() == 0


def test_band_segments_leave_the_surplus():
    """For any sizes that may link, at least surplus + 1 segments agree."""
    for percent in (60, 80, 85):
        lows = setjoin.bands(percent, 3000)
        segments, surplus = setjoin.band_segments(lows, percent)
        for band, low in enumerate(lows[:-1]):
            for s in range(low, min(lows[band + 1], low + 40)):
                t = s * 100 // percent
                assert t < (lows[band + 2] if band + 2 < len(lows) else 10**9)
                differ = (100 - percent) * (s + t) // (100 + percent)
                assert segments[band] - differ >= surplus[band] + 1


def test_connected(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_more_links_give_the_same_as_all_at_once(spark):
    rng = random.Random(11)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]
    frame = lambda part: spark.createDataFrame(part, "a long, b long")
    plain = lambda df: {r.node: r.label for r in df.collect() if r.node != r.label}
    step = with_links(with_links(connected(frame(links[:20]), "a", "b"), frame(links[20:40]), "a", "b"), frame(links[40:]), "a", "b")
    assert plain(step) == plain(connected(frame(links), "a", "b"))
