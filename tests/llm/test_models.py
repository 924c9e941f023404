"""Language identification and quality classifier."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lineloom.llm import language, quality

SCHEMA = "doc_id long, text string, lang string"
SAMPLES = {
    "aa": ["banana bandana", "ban ana ban dana", "nab a banana"],
    "zz": ["zürich zoo zzz", "zoo zu zürich", "zebra zoo"],
}


def brute_bits(samples, text, order=3):
    """Code length by a tree of counters, method C with exclusion."""
    counts = {}
    for sample in samples:
        data = b"\n" * order + sample.encode()
        for i in range(order, len(data)):
            for n in range(order + 1):
                counts.setdefault(data[i - n : i], {}).setdefault(data[i], 0)
                counts[data[i - n : i]][data[i]] += 1
    total, data = 0.0, b"\n" * order + text.encode()
    for i in range(order, len(data)):
        out = set()
        for n in range(order, -1, -1):
            seen = {s: c for s, c in counts.get(data[i - n : i], {}).items() if s not in out}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total += math.log2(whole / seen[data[i]])
                break
            total += math.log2(whole / len(seen))
            out |= set(seen)
        else:
            total += math.log2(256 - len(out))
    return total


def test_code_lengths_equal_a_tree_of_counters():
    model = language.fit(SAMPLES)
    rng = random.Random(4)
    texts = ["", "banana", "zürich", "\x00\xff€", "a" * 70000] + ["".join(rng.choice("abnzü o€\n") for _ in range(rng.randrange(40))) for _ in range(60)]
    bits = language.code_lengths(model, pa.array(texts))
    for text, row in zip(texts, bits):
        if len(text) < 100:
            wanted = [brute_bits(SAMPLES[k], text) for k in model.languages]
            assert np.allclose(row, wanted, rtol=1e-4, atol=1e-3), text
    pruned = language.fit(SAMPLES, max_contexts=3)
    assert language.predict(pruned, pa.array(["banana ban", "zoo zürich"]))[0] == ["aa", "zz"]


def test_identify(spark):
    rows = [(i, t, k) for k, texts in SAMPLES.items() for i, t in enumerate(texts)]
    rows += [(50, None, "aa"), (51, "", "aa"), (52, "12 34!", None), (None, "banana", None), (53, "zoo " * 30000, "aa"), (53, "zoo", None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash"))
    model = language.learn(df.where("doc_id < 10"), order_by=F.col("doc_id"))
    got = {(r.doc_id, r.text): r for r in language.identify(df, model).collect()}
    assert len(got) == len(rows)
    assert {got[k, None].lang_pred for k in (50,)} == {"und"} and got[51, ""].score == 0.0
    assert got[52, "12 34!"].lang_pred == "und" and got[None, "banana"].lang_pred == "aa"
    assert got[53, "zoo " * 30000].lang_pred == "zz" == got[53, "zoo"].lang_pred
    assert all(0 <= r.score <= 1 for r in got.values())
    nothing = language.learn(df.limit(0), order_by=F.col("doc_id"))
    assert {r.lang_pred for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def test_sample_is_bounded(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.when(F.col("id") % 10 > 0, "aa").otherwise("bb").alias("lang"))
    model = language.learn(df, order_by=F.col("doc_id"), per_language=50)
    assert model.languages == ["aa", "bb"]


def test_chunks_cover_every_byte():
    for n in (0, 1, 7, 8, 9, 16, 17, 100):
        chunks, bounds = quality.chunks_of(np.arange(n, dtype=np.uint8), np.array([0, n]))
        assert set(range(n)) <= set(chunks.ravel().tolist()) and bounds[-1] == max(1, -(-n // quality.STRIDE))


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, "word and other words " * 3, "en") for i in range(5)] + [(9, "zwölf größere bäume " * 50, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(df, order_by=F.col("doc_id"), max_chars=200)
    assert model.languages == ["de", "en"]
    assert {r.lang: r.lang_pred for r in language.identify(df, model).collect()} == {"de": "de", "en": "en"}


def test_pooling_equals_the_whole_and_gradient_learns():
    rng = random.Random(2)
    good = ["".join(rng.choice("abcdefgh .") for _ in range(rng.randrange(5, 300))) for _ in range(300)]
    bad = [t[: len(t) // 2] + " ###$$$ " + t[len(t) // 2 :] for t in good[:150]]
    net = quality.fit(good[:250] + bad[:120], [1] * 250 + [0] * 120, epochs=15)
    scores = quality.probability(net, pa.array(good[250:] + bad[120:] + [None, ""]))
    assert (scores[:50] >= 0.5).mean() > 0.9 and (scores[50:80] < 0.5).mean() > 0.9
    assert scores[-1] == scores[-2] and 0 <= scores.min() and scores.max() <= 1
    data = np.frombuffer((good[0] * 400).encode(), np.uint8)
    top = quality.pooled(net, data, np.array([0, len(data)]))[0]
    chunks, _ = quality.chunks_of(data, np.array([0, len(data)]))
    assert np.allclose(top, quality._answers(net, chunks).max(0), atol=1e-4)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([1, 1], 0.75), ([0, 0], 0.25)])
def test_one_label_or_none(spark, labels, score):
    docs = spark.createDataFrame([(1, "a", 9), (1, "a", 9), (2, None, 9), (None, "", 9)], "doc_id long, text string, score int")
    table = spark.createDataFrame([(i + 1, y) for i, y in enumerate(labels)] + [(7, 1), (None, 1)], "doc_id long, quality int")
    net = quality.learn(docs.dropDuplicates(["doc_id"]), table)
    scored = quality.score(docs, net)
    assert [r.score for r in scored.collect()] == [score] * 4 and scored.columns == docs.columns
    assert quality.score(docs.limit(0), net).count() == 0
