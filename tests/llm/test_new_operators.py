"""Conversation repair, Merkle manifest and removal of repeats against plain versions."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineloom.llm import conversations, merkle, suffix

SPACES = " \t\n\v\f\r"


# -- conversations ------------------------------------------------------------


def judged(turns):
    """(turn, role, text, fault) in order; turns are (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    seen, out = set(), []
    for turn, role, text in rows:
        said = text.strip(SPACES)
        fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def legal(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (body != "" and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def brute_repair(rows):
    """(cost, audit, text) by trying every choice of edits, with up to two insertions in each gap."""
    best = None
    choices = [["D"] + ([] if row[3] in ("blank", "duplicate") else ["K", "Ru", "Ra"]) for row in rows]
    gaps = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for edits in itertools.product(*choices):
        for inserted in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, said = 0, "", []
            for i in range(len(rows) + 1):
                for role in inserted[i]:
                    cost, audit = cost + 2, audit + "I"
                    said.append({"u": "user", "a": "assistant"}[role] + ":")
                if i == len(rows):
                    break
                _, role, text, fault = rows[i]
                edit = edits[i]
                audit += edit[0]
                cost += {"K": 0, "R": 2, "D": 3}[edit[0]] + (fault == "truncated" and edit != "D")
                if edit == "K":
                    said.append(f"{role}:{text}")
                elif edit != "D":
                    said.append({"Ru": "user", "Ra": "assistant"}[edit] + f":{text}")
            if best is not None and (cost, audit) >= best[:2]:
                continue
            if legal("".join(line[:1] for line in said)):
                best = (cost, audit, "\n".join(said))
    return best


def expected_conversation(turns):
    rows = judged(turns)
    numbers = [row[0] for row in rows if row[0] is not None]
    pairs = zip(rows, rows[1:])
    cost, audit, text = brute_repair(rows)
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *(sum(row[3] == fault for row in rows) for fault in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def test_repair_against_every_choice_of_edits(spark):
    rng = random.Random(11)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "cut", "", " \n", None, "Why?  ", "ends, "]
    talks = {i: [(rng.choice([None, 0, 1, 2, 2, 5]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randrange(1, 4))] for i in range(150)}
    talks[None] = [(None, None, None), (3, "user", "a.")]
    rows = [(key, *turn, "x") for key, turns in talks.items() for turn in turns]
    # A column named as one of the result's, and a conversation of which no row is left.
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string")
    found = conversations.repair(df, absent=F.col("conv_id") == 7)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    got = {r["conv_id"]: tuple(r[c] for c in names) for r in found.collect()}
    want = {key: expected_conversation(turns) for key, turns in talks.items()}
    want[7] = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == want
    assert conversations.repair(df.limit(0)).collect() == []


def test_long_conversations_do_not_depend_on_the_places(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(3000)]
    results = []
    for places in (3, 8, 64, 10000):
        way = conversations.Repair(places)
        for row in rows:
            way.row(*row)
        results.append(way.end())
    assert len(set(results)) == 1
    assert len(results[0][1]) >= len(rows)


def test_one_hot_conversation_with_repeated_rows(spark):
    rows = [(1, i // 2, "user" if i % 4 < 2 else "assistant", f"line {i // 2}." + "x" * 50) for i in range(6000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = conversations.repair(df).first()
    assert (found["duplicate"], found["truncated"], found["gaps"]) == (3000, 3000, 0)
    assert (found["cost"], found["audit"]) == (3000 * 3 + 3000, "KD" * 3000)


# -- Merkle -------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """(root, siblings and sides of each node's way)."""
    ways, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            other = at ^ 1
            ways[i].append((at & 1, nodes[other] if other < len(nodes) else None))
            where[i] = at // 2
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], ways


@pytest.mark.parametrize("height", [1, 2, 8])
def test_manifest_against_a_plain_tree(spark, height):
    rng = random.Random(height)
    sizes = {None: 5, "": 1, "de": 37, "en": 64, "é": 3, "zz": 2}
    rows = [(rng.choice([None, rng.randrange(-50, 200)]), lang, f"t{rng.randrange(4)}" * rng.randrange(3)) for lang, n in sizes.items() for _ in range(n)]
    rows += [(300, "en", "same")] * 3 + [(301, "de", "long " * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, lang string, text string, leaf string")
    found = merkle.manifest(df, key="doc_id", group="lang", leaf=merkle.row_digest("doc_id", "text"), height=height)
    got = [
        tuple(r) for r in found.select("doc_id", "lang", "leaf", "subroot", "root", merkle.siblings(), merkle.folded("leaf")).collect()
    ]

    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for key, lang, text in rows:
        groups.setdefault(lang, []).append((key is not None, key or 0, digest(field(key), field(text)), key))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    subs = {lang: plain_tree([leaf for *_, leaf, _ in sorted(groups[lang], key=lambda r: r[:3])]) for lang in order}
    root, ups = plain_tree([subs[lang][0] for lang in order])
    want = []
    for lang, up in zip(order, ups):
        for (_, _, leaf, key), way in zip(sorted(groups[lang], key=lambda r: r[:3]), subs[lang][1]):
            want.append((key, lang, leaf, subs[lang][0], root, [n for _, n in way + up if n is not None], root))
    sort = lambda rows: sorted(rows, key=repr)
    assert sort(got) == sort(want)


def test_manifest_of_an_empty_table_and_a_wrong_leaf(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    build = lambda df: merkle.manifest(df, key="doc_id", group="lang", leaf=merkle.row_digest("text"))
    assert build(df).collect() == []
    df = spark.range(20).selectExpr("id AS doc_id", "'en' AS lang", "cast(id AS string) AS text")
    found = build(df).select("root", merkle.folded(F.lit("0" * 64)).alias("folded"))
    assert all(r["root"] != r["folded"] for r in found.collect())


# -- repeats ------------------------------------------------------------------


def plain_removal(rows, length):
    """{(doc_id, text): (kept, spans)}."""
    order = lambda key: -(2**63) if key is None else key
    least = {}
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            least[s] = min(least.get(s, order(key)), order(key))
    out = {}
    for key, text in rows:
        data = (text or "").encode()
        gone = [False] * (len(data) + 1)
        for i in range(len(data) - length + 1):
            if least[data[i : i + length]] < order(key):
                gone[i : i + length] = [True] * length
        turns = [i for i in range(len(data) + 1) if gone[i] != (gone[i - 1] if i else False)]
        spans = list(zip(turns[::2], turns[1::2]))
        out[key, text] = (bytes(b for b, g in zip(data, gone) if not g), spans)
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9)))
    base = [" ".join(word() for _ in range(rng.randrange(5, 150))) for _ in range(25)]
    shared = [" ".join(word() for _ in range(rng.randrange(8, 40))) for _ in range(6)]
    rows = [(None, base[0]), (1, None), (2, ""), (3, "short"), (4, "a" * 3000), (5, "a" * 49), (6, "b" + "a" * 60), (7, "\0" * 130 + "x"), (8, "\0" * 90)]
    for i in range(10, 130):
        text = rng.choice(base)
        cut = rng.randrange(len(text) + 1)
        text = text[cut:] + rng.choice(shared) + text[:cut] if rng.random() < 0.6 else text
        rows.append((rng.randrange(9, 100), text))
    return rows + rows[-3:]


@pytest.mark.parametrize("sizes", [(1 << 22, 1 << 20, 20_000), (2000, 500, 20_000), (3000, 2000, 4)])
def test_removal_against_every_string(spark, sizes):
    """Also with many blocks, shards that have to be merged, and anchors that are split."""
    block, shard, many = sizes
    rows = corpus(sum(sizes))
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, kept binary")
    found = suffix.remove_repeats(df, block_bytes=block, shard_bytes=shard, many=many)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in found.collect())
    plain = plain_removal(rows, suffix.LENGTH)
    want = sorted((k is not None, k or 0, *plain[k, t]) for k, t in rows)
    assert got == want
    assert any(spans for *_, spans in got)


def test_removal_of_an_empty_table_and_a_very_long_text(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix.remove_repeats(df).collect() == []
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    df = spark.createDataFrame([(1, long[1000:1100]), (2, long), (3, long[200_000:] + "end")], "doc_id long, text string")
    got = {r["doc_id"]: (len(r["kept"]), [tuple(s) for s in r["spans"]]) for r in suffix.remove_repeats(df).collect()}
    assert got == {1: (100, []), 2: (399_900, [(1000, 1100)]), 3: (3, [(0, 200_000)])}


def test_suffix_array_and_prefixes_against_sorting():
    rng = random.Random(8)
    for _ in range(30):
        segments = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(30, 81))) for _ in range(rng.randrange(1, 12))]
        segments += segments[: rng.randrange(len(segments))]
        data = np.frombuffer(b"".join(segments), np.uint8)
        lengths = np.array([len(s) for s in segments])
        begins = np.cumsum(lengths) - lengths
        number = np.repeat(np.arange(len(segments)), lengths)
        left = np.repeat(begins + lengths, lengths) - np.arange(len(data))
        suffixes = [segments[n][len(segments[n]) - l :] for n, l in zip(number, left)]
        words = suffix._words(data)
        order = suffix.suffix_array(words, left, number)
        assert list(order) == sorted(range(len(data)), key=lambda i: (suffixes[i], number[i]))
        prefix = suffix.common_prefixes(order, words, left, begins, lengths, 30)
        for a, b in zip(order, order[1:]):
            same = next((i for i, (x, y) in enumerate(zip(suffixes[a], suffixes[b])) if x != y), min(len(suffixes[a]), len(suffixes[b])))
            assert min(prefix[b], 30) == min(same, 30)
