"""Line dedup against brute force."""

import contextlib
import pathlib
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lineloom.llm import linededup as L
from lineloom.llm.common import maybe_among

SCHEMA = "doc_id long, text string"
SPACES = " \t\n\v\f\r"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def edited(rng, text, edits, letters="abé𝄞 "):
    out = list(text)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out) + 1)
        if kind == 0:
            out.insert(at, rng.choice(letters))
        elif out and at < len(out):
            if kind == 1:
                del out[at]
            else:
                out[at] = rng.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_automaton_equals_dynamic_programming(spark, edits):
    rng = random.Random(edits)
    texts = ["".join(rng.choice("abé𝄞") for _ in range(rng.randrange(12))) for _ in range(400)]
    pairs = [(t, edited(rng, t, rng.randrange(5))) for t in texts] + [("", ""), ("a", ""), ("", "ab")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", L.similar(F.col("a"), F.col("b"), edits).alias("s"), L.within(F.col("a"), F.col("b"), edits).alias("w")).collect():
        near = distance(r.a, r.b) <= edits
        assert (r.s, r.w) == (near, near), (r.a, r.b)


def expected(rows, edits, least=1, near=0):
    where = {}
    for doc, text in rows:
        for pos, line in enumerate((text if text is not None else "").split("\n")):
            line = line.strip(" ")
            if len(line) >= least and line.strip(SPACES):
                at = (-(2**63) if doc is None else doc, pos)
                where[line] = min(where.get(line, at), at)
    out = []
    long = [l for l in where if len(l) >= max(near, L.shortest(edits))]
    first = dict(where)
    for i, a in enumerate(long):
        for b in long[:i]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                first[a], first[b] = min(first[a], where[b]), min(first[b], where[a])
    for doc, text in rows:
        at = -(2**63) if doc is None else doc
        if text is None:
            out.append((doc, None, []))
            continue
        lines = text.split("\n")
        gone = [p for p, l in enumerate(lines) if len(l.strip(" ")) >= least and l.strip(SPACES) and first[l.strip(" ")] < (at, p)]
        out.append((doc, "\n".join(l for p, l in enumerate(lines) if p not in gone), gone))
    return sorted(out, key=repr)


@pytest.mark.parametrize("edits, few", [(2, True), (1, True), (2, False), (3, True)])
def test_dedup_equals_brute_force(spark, monkeypatch, edits, few):
    if not few:
        monkeypatch.setattr(L, "FEW_ROWS", -1)
    rng = random.Random(10 * edits + few)
    word = lambda: "".join(rng.choice("abcdeé𝄞") for _ in range(rng.randrange(2, 8)))
    pool = [" ".join(word() for _ in range(rng.randrange(1, 14))) for _ in range(25)]
    rows = []
    for doc in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = rng.choice(pool) if rng.random() < 0.7 else " ".join(word() for _ in range(8))
            lines.append(edited(rng, line, rng.choice([0, 0, 1, 2, 3, 4])))
        rows.append((doc, "\n".join(lines)))
    rows += [(None, rows[7][1]), (None, None), (90, None), (91, ""), (92, "  " + pool[0] + " "), (3, rows[3][1]), (4, pool[1])]
    rows += [(93, pool[2] + "\n" + pool[2]), (94, "\n\n" + "x" * 5000), (95, "x" * 5001)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"dropped": F.lit(1), "size": F.lit("s"), "pos": F.lit(2)})
    found = L.dedup_lines(df, edits=edits)
    assert sorted(((r.doc_id, r.text, r.dropped) for r in found.collect()), key=repr) == expected(rows, edits)
    assert found.columns == ["doc_id", "text", "size", "pos", "n_lines", "dropped", "sources"]


def test_a_line_in_most_documents(spark):
    rows = [(i, f"the very same line of text in all\nline of document number {i * 7919}, and of no other") for i in range(300)]
    found = L.dedup_lines(spark.createDataFrame(rows, SCHEMA), edits=1).orderBy("doc_id").collect()
    assert [r.dropped for r in found][:2] == [[], [0]] and all(0 in r.dropped for r in found[1:])
    assert all(r.sources[0] == 0 for r in found[1:])


def test_empty_table_and_no_python(spark):
    assert L.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
    plan = L.dedup_lines(spark.createDataFrame([(1, "a")], SCHEMA))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_line_stage_of_the_pipeline_takes_short_lines(spark):
    rows = [(1, "Les.\na\n \t\nshort line 12\nTop"), (2, "b\n  Les. \n\r\nshort line 13\n\nTap"), (3, "Les.\n \t\na"), (4, "\r\n \t\nown")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    left = {r.doc_id: r.text for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert left == {1: rows[0][1], 2: "b\n\r\n\nTap", 4: rows[3][1]}


def test_short_lines_equal_brute_force(spark):
    rng = random.Random(4)
    pool = ["".join(rng.choice("abc") for _ in range(n)) for n in range(1, 24) for _ in range(3)]
    rows = [(doc, "\n".join(edited(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 3])).strip() for _ in range(6))) for doc in range(80)]
    found = L.dedup_lines(spark.createDataFrame(rows, SCHEMA), least=1, least_near=L.shortest(2))
    assert sorted(((r.doc_id, r.text, r.dropped) for r in found.collect()), key=repr) == expected(rows, 2, 1, 12)


def shuffle_bytes(spark, known=()):
    """Size of the shuffle files there are, by path, without the known ones."""
    places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = [f for place in places for f in pathlib.Path(place.toString()).glob("*/shuffle_*.data")]
    out = {}
    for f in files:
        with contextlib.suppress(FileNotFoundError):
            out[f] = f.stat().st_size
    return {f: n for f, n in out.items() if f not in known}


def unlike_lines(rng, n):
    """Lines that share no third of their characters with each other."""
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(300)) for _ in range(n)]


def test_lines_without_a_shared_key_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(L, "FEW_ROWS", -1)
    asked = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(asked)
    materialize = L.materialize
    rng = random.Random(5)
    lines = unlike_lines(rng, 3000)
    near = [(10_000 + i, edited(rng, lines[i], 2)) for i in range(5)]
    shuffled = {}

    def watched(df, label):
        if label == "line-members":
            before = shuffle_bytes(spark)
            df.write.format("noop").mode("overwrite").save()
            shuffled[label] = sum(shuffle_bytes(spark, before).values())
        return materialize(df, label)

    monkeypatch.setattr(L, "materialize", watched)
    spark.conf.set(asked, "-1")  # small as they are here, the tables are joined as large ones
    try:
        found = L.dedup_lines(spark.createDataFrame([*enumerate(lines), *near], SCHEMA))
    finally:
        spark.conf.set(asked, usual)
    assert {r.doc_id for r in found.where("size(dropped) > 0").collect()} == {i for i, _ in near}
    assert 0 < shuffled["line-members"] < 300 * 3000 / 10


@pytest.mark.parametrize("many", [0, 1, 7, 20_000])
def test_maybe_among_keeps_all_keys_and_few_others(spark, many):
    rows = spark.range(100_000).select("id", F.xxhash64("id").alias("key"))
    found = maybe_among(rows, rows.where(F.col("id") < many).select("key"), "key", many).select("id").collect()
    assert sum(r.id < many for r in found) == many and len(found) <= many + 2000


def test_shuffle_files_go_once_a_table_is_written(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(unlike_lines(rng, 5))) for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    before = shuffle_bytes(spark)
    L.dropped_lines(docs)
    for _ in range(50):  # they are deleted in the background
        left = sum(shuffle_bytes(spark, before).values())
        if left < 100_000:
            break
        time.sleep(0.2)
    assert left < 100_000
