"""Name search against brute force, and the properties of the lineage map."""

import random
import time

import pytest
from pyspark.sql import functions as F

from lineloom.functions.text import WORD_BREAKS, pieces_of, words_of
from lineloom.operators import matching
from lineloom.operators.matching import find_names
from lineloom.plans import lineage as L
from lineloom.plans.lineage import SOURCE, TARGET, all_matches, first_match, lineage_map, match_counts
from lineloom.session import materialize

NARROW, WIDE = 0, 64 * 1024 * 1024  # nothing may be broadcast / everything may


@pytest.fixture(params=["shuffled", "broadcast", "direct"])
def bound(request, monkeypatch):
    """The three ways of the search: words shuffled, words with broadcasts, short lists in each text."""
    if request.param != "direct":
        monkeypatch.setattr(matching, "DIRECT_NAMES", 0)
    return NARROW if request.param == "shuffled" else WIDE


def assets(spark, names, prefix="cat://d/x/"):
    return spark.createDataFrame([(n, prefix + n) for n in names], "name string, qualified_name string")


def scripts(spark, texts):
    return spark.createDataFrame(list(texts.items()), "path string, text string")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def found(spark, texts, patterns, **options):
    table = materialize(spark.createDataFrame([(p, p) for p in patterns], "pattern string, name string"), "t")
    hits = find_names(scripts(spark, texts), ["path"], "text", table, **options)
    return sorted({(r.path, r.name) for r in hits.collect()})


def like(text, pattern):
    """LIKE '%pattern%' by dynamic programming, independent of Spark's."""
    states = {0}
    full = "%" + pattern + "%"

    def close(s):
        out = set(s)
        for i in sorted(s):
            while i < len(full) and full[i] == "%":
                i += 1
                out.add(i)
        return out

    states = close(states)
    for ch in text:
        nxt = set()
        for i in states:
            if i < len(full):
                if full[i] == "%":
                    nxt.add(i)
                elif full[i] == "_" or full[i] == ch:
                    nxt.add(i + 1)
        states = close(nxt)
    return len(full) in states


ALPHABET = ["a", "b", "_", ".", "é", "-", " ", "(", "/", "%", "\n", "x", "0"]
ODD = ["", " ", "( ", "a(b", "a b", " a", "o'x", "/", "a/b", "%", "_", "a_b", "a%b", "é", "b  a", "((", "a\\b", "$", ".*"]


@pytest.mark.parametrize("wildcards", [False, True])
def test_find_names_equals_brute_force(spark, bound, wildcards):
    rng = random.Random(7)
    pick = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    letters = [c for c in ALPHABET if not (wildcards and c == "\n")]
    texts = {f"s{i}": pick(rng.randint(0, 60), letters) for i in range(150)}
    texts |= {"quote": "read o'x now", "back": "x a\\b y", "dollar": "cost $ .* end", "none": None}
    names = sorted(set(ODD) | {pick(rng.randint(1, 12), [c for c in ALPHABET if c != "\n"]) for _ in range(120)})
    holds = like if wildcards else (lambda text, name: name in text)
    expected = sorted((p, n) for p, t in texts.items() if t is not None for n in names if holds(t, n))
    assert found(spark, texts, names, wildcards=wildcards, bound=bound) == expected
    assert any(n for _, n in expected)


def test_long_runs_are_searched_whole(spark, bound):
    rng = random.Random(3)
    run = "".join(rng.choice("abcdefgh0123") for _ in range(20_000))
    names = [run[i : i + n] for i, n in ((0, 5), (126, 128), (127, 9), (255, 130), (9_999, 200), (19_990, 10), (19_700, 300))]
    names += [names[1] + "zz", "notthere"]
    spaced = [run[-40:] + " ", run[100:140] + " "]
    texts = {"one": "x " + run + " y", "cut": "x " + run[:-1]}
    expected = sorted((p, n) for p, t in texts.items() for n in names + spaced if n in t)
    assert found(spark, texts, names + spaced, bound=bound) == expected


def test_long_needles_share_a_common_start(spark, bound):
    names = [f"warehouse_events_{i:06d}" for i in range(300)]
    texts = {f"p{i}": f"select * from db.{names[i]} where x" for i in range(0, 300, 7)}
    expected = sorted((p, n) for p, t in texts.items() for n in names if n in t)
    assert found(spark, texts, names, bound=bound) == expected


def test_pieces_are_short_and_cover(spark):
    word = "q" * 1000
    df = spark.createDataFrame([(word,)], "w string").select(F.explode(pieces_of(F.col("w"), 100)).alias("p"))
    lengths = [len(r.p) for r in df.collect()]
    assert max(lengths) <= 200 and sum(lengths) >= 1000


def test_words_keep_one_space(spark):
    df = spark.createDataFrame([("into t1  x;t2\nend",)], "t string").select(words_of(F.col("t")).alias("w"))
    assert df.first().w == ["into ", "t1 ", "x", "t2", "end"]


def test_target_needs_the_space_in_the_same_line(spark, bound):
    texts = {"a": "into T1 x", "b": "into t1", "c": "into t1;", "d": "xt1 y", "e": "t1\n y", "f": "t1\r\n y"}
    got = first_match(scripts(spark, texts), assets(spark, ["t1"]), TARGET, bound=bound)
    assert rows(got) == [("a", "cat://d/x/t1"), ("d", "cat://d/x/t1")]


def test_wildcard_only_on_request(spark):
    texts = {"a": "x axb y", "b": "x a_b y"}
    names = assets(spark, ["a_b"])
    assert [r[0] for r in rows(first_match(scripts(spark, texts), names, TARGET))] == ["b"]
    assert [r[0] for r in rows(first_match(scripts(spark, texts), names, TARGET, wildcards=True))] == ["a", "b"]


def test_wildcards_stay_in_a_line(spark):
    texts = {"a": "one b\nc two ", "b": "one b c two "}
    got = first_match(scripts(spark, texts), assets(spark, ["b%two"]), TARGET, wildcards=True)
    assert [r[0] for r in rows(got)] == ["b"]


def test_quote_in_a_name(spark):
    got = first_match(scripts(spark, {"a": "load o'x now"}), assets(spark, ["o'x"]), SOURCE)
    assert rows(got) == [("a", "cat://d/x/o'x")]


@pytest.mark.parametrize("parts", [1, 5])
def test_first_match_is_the_smaller_name(spark, parts):
    texts = scripts(spark, {f"s{i}": "use zeta_tab and alpha_tab here" for i in range(20)}).repartition(parts)
    names = assets(spark, ["zeta_tab", "alpha_tab", "other"]).repartition(parts)
    assert {r.target for r in first_match(texts, names, TARGET).collect()} == {"cat://d/x/alpha_tab"}


def test_rank_goes_before_the_name(spark):
    names = spark.createDataFrame(
        [("zeta", "q/zeta", 1), ("alpha", "q/alpha", 2)], "name string, qualified_name string, rank long"
    )
    got = first_match(scripts(spark, {"s": "zeta alpha end"}), names, TARGET)
    assert rows(got) == [("s", "q/zeta")]


def test_same_name_in_two_folders_gives_first_key_or_both(spark):
    names = spark.createDataFrame([("f.csv", "q/b/f.csv"), ("f.csv", "q/a/f.csv")], "name string, qualified_name string")
    script = scripts(spark, {"s": "insert from f.csv"})
    assert rows(first_match(script, names, SOURCE)) == [("s", "q/a/f.csv")]
    both = all_matches(script, names, assets(spark, ["none"]))
    assert [r[2] for r in rows(both)] == ["q/a/f.csv", "q/b/f.csv"]


SCRIPTS = {
    "/e/both": "INSERT into T_One from F_In.csv",
    "/e/source": "create view from f_in.csv",
    "/e/target": "merge into t_one using x",
    "/e/none": "spark.write.parquet(x)",
    "/e/reader": "select t_one from f_in.csv",
    "/e/blank": "",
}
EXPECTED = [
    ("/e/both", "F", "T"),
    ("/e/none", None, None),
    ("/e/source", "F", None),
    ("/e/target", None, "T"),
]


def mapped(spark, source, **options):
    files = spark.createDataFrame([("f_in.csv", "F")], "name string, qualified_name string")
    tables = spark.createDataFrame([("t_one", "T")], "name string, qualified_name string")
    got = lineage_map(source, files, tables, **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("wildcards", [False, True])
def test_lineage_map_keeps_columns_straight(spark, bound, wildcards):
    texts = scripts(spark, SCRIPTS | {"/e/both": "INSERT into T_One\nT_One from F_In.csv"})
    texts = texts.withColumn("text", F.regexp_replace("text", "\nT_One", " "))
    assert mapped(spark, texts, bound=bound, wildcards=wildcards) == sorted(EXPECTED, key=repr)


def test_lineage_map_from_lines(spark, bound):
    lines = [("/m", "create x"), ("/m", "load f_in.csv"), ("/m", "load f_in.csv"), ("/m", "to t_one end"), ("/r", "f_in.csv")]
    df = spark.createDataFrame(lines, "path string, text string")
    assert mapped(spark, df, whole_texts=False, bound=bound) == [("/m", "F", "T")]


def test_lineage_map_options(spark):
    texts = scripts(spark, SCRIPTS)
    assert mapped(spark, texts, complete_only=True) == [("/e/both", "F", "T")]
    assert mapped(spark, texts, path_like="%T%") == []
    assert len(mapped(spark, texts, path_like="%/s%")) == 1


def test_lineage_map_without_assets(spark):
    nothing = spark.createDataFrame([], "name string, qualified_name string")
    got = lineage_map(scripts(spark, SCRIPTS), nothing, nothing)
    assert sorted(r.path for r in got.collect()) == [p for p, *_ in EXPECTED]
    assert all(r.source is None and r.target is None for r in got.collect())


def test_counts_are_lines_not_hits(spark, bound):
    lines = spark.createDataFrame(
        [("p", 0, "t1 t1 x t1 "), ("p", 1, "t1"), ("p", 2, "t1 t1 x t1 "), ("q", 0, "a b a b ")],
        "path string, pos int, line string",
    )
    names = assets(spark, ["t1", "a b"])
    assert rows(match_counts(lines, names, TARGET, bound=bound)) == [("p", "t1", 2), ("q", "a b", 1)]


def test_all_found_assets_are_listed_ones(spark):
    rng = random.Random(5)
    names = [f"n{i}" for i in range(50)]
    texts = {f"s{i}": "insert " + " ".join(rng.choice(names) for _ in range(8)) for i in range(60)}
    got = all_matches(scripts(spark, texts), assets(spark, names[:25]), assets(spark, names[25:]))
    expected = {(p, "cat://d/x/" + n) for p, t in texts.items() for n in names[:25] if n in t.lower()}
    expected |= {(p, "cat://d/x/" + n) for p, t in texts.items() for n in names[25:] if n + " " in t.lower()}
    assert {(r.path, r.qualified_name) for r in got.collect()} == expected


def test_all_matches_from_lines(spark):
    lines = [("/m", "create x"), ("/m", "load f.csv and g.csv"), ("/m", "f.csv"), ("/r", "f.csv")]
    df = spark.createDataFrame(lines, "path string, text string")
    got = all_matches(df, assets(spark, ["f.csv", "g.csv"]), assets(spark, ["none"]), whole_texts=False)
    assert rows(got) == [("/m", "source", "cat://d/x/f.csv"), ("/m", "source", "cat://d/x/g.csv")]


def test_one_line_repeated(spark, bound):
    """A third of all lines alike, naming something that has to be verified in the line."""
    df = spark.range(3000).select(
        F.lit("/big").alias("path"),
        F.when(F.col("id") % 3 == 0, "insert odd (name").otherwise(F.concat(F.lit("odd "), "id")).alias("text"),
    )
    assert mapped(spark, df, whole_texts=False, bound=bound) == [("/big", None, None)]
    got = first_match(df, assets(spark, ["odd (name", "odd (nam_"]), SOURCE, bound=bound)
    assert rows(got) == [("/big", "cat://d/x/odd (name")]


def plan_of(df):
    return df._jdf.queryExecution().toString()


def plans_of_map(spark, bound):
    """Plans of everything a lineage map writes on its way, and its own."""
    plans = []
    keep = matching.materialize
    matching.materialize = L.materialize = lambda df, label: plans.append(plan_of(df)) or keep(df, label)
    try:
        names = assets(spark, ["t_one", "a b", "o'x"])
        plans.append(plan_of(lineage_map(scripts(spark, SCRIPTS), names, names, bound=bound)))
    finally:
        matching.materialize = L.materialize = keep
    return plans


@pytest.mark.parametrize("bound", [NARROW, WIDE])
def test_no_nested_loop_and_no_python(spark, bound, monkeypatch):
    monkeypatch.setattr(matching, "DIRECT_NAMES", 0)
    plans = plans_of_map(spark, bound)
    assert len(plans) >= 3
    for plan in plans:
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_a_short_list_is_looked_for_in_one_pass(spark):
    (plan,) = plans_of_map(spark, WIDE)
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 1
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "EvalPython" not in plan


def test_lists_over_the_bound_go_through_words(spark, monkeypatch):
    """At the bound and one beyond it, in names and in bytes, the hits are the same."""
    names = ["t1", "t2", "a b"]
    texts = {"p": "t1 and a b", "q": "t2", "r": "t", "s": ""}
    expected = sorted((p, n) for p, t in texts.items() for n in names if n in t)
    ways = []
    keep = matching._short_list
    monkeypatch.setattr(matching, "_short_list", lambda *args: ways.append(keep(*args)) or ways[-1])
    for most, size in ((3, 1 << 20), (2, 1 << 20), (3, 50)):
        monkeypatch.setattr(matching, "DIRECT_NAMES", most)
        monkeypatch.setattr(matching, "DIRECT_BYTES", size)
        assert found(spark, texts, names) == expected
    assert [w is not None for w in ways] == [True, False, False]


def test_a_third_of_all_words_alike(spark, bound):
    """One name in every script: both ways to join give every row."""
    texts = spark.range(3000).select(
        F.concat(F.lit("s"), "id").alias("path"), F.concat(F.lit("insert hot_tab "), F.col("id"), F.lit(" tail")).alias("text")
    )
    names = assets(spark, ["hot_tab", "7 "])
    assert first_match(texts, names, TARGET, bound=bound).count() == 3000


def test_breaks_cover_white_space(spark):
    df = spark.createDataFrame([("a\tb\u000bc\fd",)], "t string")
    assert df.select(words_of(F.col("t")).alias("w")).first().w == ["a", "b", "c", "d"]
    assert "/" in WORD_BREAKS


def test_least_names_equal_brute_force(spark, bound):
    rng = random.Random(bound + 1)
    letters = "ab ,.'\n"
    texts = {f"p{i}": "".join(rng.choice(letters) for _ in range(rng.randrange(30))) for i in range(120)} | {"none": "", "blank": "\n"}
    names = sorted({"".join(rng.choice("ab ,'") for _ in range(rng.randrange(1, 5))) for _ in range(40)} - {""})
    table = materialize(
        spark.createDataFrame([(n, "xy"[i % 2], i) for i, n in enumerate(names)], "pattern string, kind string, place long"), "t"
    )
    hits = matching.least_names(scripts(spark, texts), ["path"], "text", table, kinds=["x", "y"], bound=bound)
    got = {r.path: (r.x, r.y) for r in hits.groupBy("path").agg(F.min("x").alias("x"), F.min("y").alias("y")).collect()}
    first = lambda text, k: min((i for i, n in enumerate(names) if i % 2 == k and n in text), default=None)
    assert got == {p: (first(t, 0), first(t, 1)) for p, t in texts.items()}


def test_a_name_in_parts_is_looked_for_once_per_text(spark, monkeypatch):
    """A name with a blank whose longest part stands in the text tens of thousands of times."""
    monkeypatch.setattr(matching, "DIRECT_NAMES", 0)
    known = assets(spark, ["my report", "my"])

    def seconds(n):
        text = "".join(f"my_report{i % 9} = report + 1\n" for i in range(n))
        start = time.perf_counter()
        assert rows(first_match(scripts(spark, {"/s": text}), known, SOURCE)) == [("/s", "cat://d/x/my")]
        found = all_matches(scripts(spark, {"/s": text + "my report"}), known, known, words=["report"])
        assert found.count() == 3
        return time.perf_counter() - start

    seconds(100)
    assert seconds(40_000) < 2 * seconds(20_000) + 3


def test_short_lists_with_wildcards_are_looked_for_directly(spark, monkeypatch):
    """No words and no shuffle of lines: only one row per script is grouped."""
    monkeypatch.setattr(matching, "_Search", None)
    texts = {"/a": "x\nsome t9 here", "/b": "t1\nt2", "/c": "50% of ab\\c d", "/d": "ab\nc d", "/e": ""}
    names = assets(spark, ["t_", "b%c", "b\\_"])
    assert rows(first_match(scripts(spark, texts), names, TARGET, wildcards=True)) == [
        ("/a", "cat://d/x/t_"),
        ("/c", "cat://d/x/b%c"),
    ]
    assert found(spark, texts, ["t_ ", "%d", "0%"], wildcards=True) == [
        ("/a", "t_ "), ("/c", "%d"), ("/c", "0%"), ("/d", "%d")
    ]
