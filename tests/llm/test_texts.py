"""Fingerprints, page text, BPE, language model and packing."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lineloom.llm import bpe, fingerprint, html, lm, packing
from lineloom.llm.common import range_of, split_points

SCHEMA = "doc_id long, text string"
RANKS = {"ranks": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}
MODEL = {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "pattern": public_tokenizers.PATTERN}
LOWER = {i: i + 32 for i in range(65, 91)}
ODD = [None, "", " ", "a", "Zwei  Wörter\n\n", "<|endoftext|> it's 12ab 　x", "x" * 200_000, "a1 " * 60_000, "𝄞é" * 9, "a", "a"]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def odd_rows():
    return list(enumerate(ODD)) + [(3, "a"), (3, "b"), (None, "null id"), (None, None)]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6, 7, 12, 30])
def test_ranges(spark, n):
    points = [3 * i + 2 for i in range(n)]
    got = spark.range(-2, 3 * n + 6).select("id", range_of("id", points).alias("p")).collect()
    assert all(r.p == sum(p <= r.id for p in points) for r in got)


def test_split_points_are_rows(spark):
    df = spark.range(500).select((F.col("id") * 7).alias("k"))
    points = split_points(df, "k", 9)
    assert len(points) == 8 and points == sorted(points) and all(p % 7 == 0 for p in points)
    assert split_points(df.limit(0), "k", 9) == []


# -- fingerprints --------------------------------------------------------------


def jaccard(a, b):
    a, b = collections.Counter(a), collections.Counter(b)
    return sum(min(a[x], b[x]) for x in a) / sum((a | b).values())


def test_collisions_are_the_generalised_jaccard_similarity():
    texts = ["a b c", "a a a a b b c d e f g", "a b b b c c d d d x y z", "a a a a b b c d e f g"]
    signs, _ = fingerprint.signatures(pa.array(texts), 4096, 1)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert abs((signs[i] == signs[j]).mean() - jaccard(a.split(), b.split())) < 0.03
    assert (signs[1] == signs[3]).all()


@pytest.mark.parametrize("part_bytes", [40, 4 << 20])
def test_edits_with_the_next_document(spark, part_bytes):
    rng = random.Random(part_bytes)
    rows = [(2 * i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("copy", F.lit("clash"))
    got = fingerprint.fingerprint_edits(df, part_bytes=part_bytes).collect()
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    wanted = collections.Counter()
    for (k, t), (_, after) in zip(order, order[1:] + order[:1]):
        wanted[k, t, t[: len(t) - len(t) // 2] + after[: len(t) // 2]] += 1
    assert collections.Counter((r.doc_id, r.text, r.edited) for r in got) == wanted
    by_text = {}
    for r in got:
        assert by_text.setdefault(r.text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == "") == (not tokens(r.text))
    again = {r.text: r.fingerprint for r in fingerprint.fingerprint(spark.createDataFrame([(1, r.edited) for r in got], SCHEMA)).collect()}
    assert all(again[r.edited] == r.edited_fingerprint for r in got)
    shown = spark.createDataFrame([(r.fingerprint, r.edited_fingerprint, r.near_edited) for r in got], "a string, b string, n double")
    assert all(abs(r.n - r.m) < 1e-9 for r in shown.withColumn("m", fingerprint.likeness("a", "b")).collect())


def test_one_document_and_none(spark):
    one = fingerprint.fingerprint_edits(spark.createDataFrame([(5, "abcd")], SCHEMA)).collect()
    assert [(r.edited, r.near_next) for r in one] == [("abab", 1.0)]
    assert fingerprint.fingerprint_edits(spark.createDataFrame([], SCHEMA)).count() == 0


# -- pages ---------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>t</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><a href="/">Home</a></nav><script>var t="<p>no</p>";</script>
<div class="cookie-notice">We use cookies</div><aside>side</aside>
<article><h1>Title &amp; more</h1><p>One <b>bold</b>
 line.<p>Two&nbsp;x &lt;tag&gt; {0}<ul><li>item<li>other</ul><form><input>send</form>
<div class="ad">Buy</div><figure><figcaption>cap</figcaption></figure><!-- <p>c</p> -->
<section id="comments"><p>nice!</p></section></article><footer>&copy; x</footer></body></html>"""


def test_article_text():
    page = (1, "u", "h/a", *html.page_lines(PAGE.format("y")))
    other = (2, "u", "h/b", *html.page_lines(PAGE.format("z")))
    assert html._settled(page, other) == "Title & more\nOne bold line.\nTwo x <tag> y\nitem\nother\ncap"
    assert html._settled(page, page) == html._settled(page, None)


def test_differences_first_and_structure_second():
    notice, own = "Read our letter every week.", "The text of page {0} is long and is found on no other page {0}."
    made = lambda n, html_of: (n, "u", f"h/{n}", *html.page_lines(html_of.format(n)))
    # Title, first and last paragraph equal the neighbour's: the article stays whole.
    marked = f"<div>Frame</div><article><h1>Title</h1><p>First.</p><p>{own}</p><p>{notice}</p></article><div>Imprint</div>"
    whole = f"Title\nFirst.\n{own.format(1)}\n{notice}"
    assert html._settled(made(1, marked), made(2, marked)) == whole == html._settled(made(1, marked), None)
    # A frame without telling tags or classes goes, one with them goes though it is different.
    bare = f"<div>Frame</div><nav>Page {{0}} of 9</nav><p>{own}</p><div>Imprint</div>"
    assert html._settled(made(1, bare), made(2, bare)) == own.format(1)
    card = f"<article>By author {{0}}</article><div>Frame</div><p>{own}</p>"
    assert html._settled(made(1, card), made(2, card)) == f"By author 1\n{own.format(1)}"


def test_lines_in_doubt_are_compared(spark):
    block = lambda n: f"<div>Menu of the site</div><p>text of page {n}</p><p>shared by all</p><div>Imprint</div>"
    rows = [(i, f"https://h.example/{i // 3}/{i}.html?q=1#f", block(i)) for i in range(9)]
    rows += [(20, "http://alone.example/x", block(20)), (21, None, block(21)), (22, "http://h.example/0/0", None), (23, "http://h.example/0/1/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("part", F.lit(1))
    for part_bytes in (60, 4 << 20):
        got = {r.page_id: r.text for r in html.main_text(df, part_bytes=part_bytes).collect()}
        assert len(got) == len(rows) and got[22] == got[23] == ""
        assert got[20] == "Menu of the site\ntext of page 20\nshared by all\nImprint" == got[21].replace("21", "20")
        assert got[5] == "text of page 5" and got[8] == "text of page 8"
    assert html.main_text(df.limit(0)).count() == 0


def test_copies_are_passed_over(spark):
    page = lambda n: f"<div>Menu of the site</div><p>text of page {n}</p><p>shared by all</p><div>Imprint</div>"
    rows = [(i, f"https://h.example/a/x?page={i}", page("a")) for i in range(40)]
    rows += [(50, "https://h.example/a/a", page("b")), (51, "https://h.example/a/y", page("c"))]
    rows += [(60 + i, f"https://copies.example/x?ref={i}", page("d")) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for part_bytes in (300, 1000, 4 << 20):
        got = {r.page_id: r.text for r in html.main_text(df, part_bytes=part_bytes).collect()}
        assert {got[i] for i in range(40)} == {"text of page a"}
        assert (got[50], got[51]) == ("text of page b", "text of page c")
        assert {got[60 + i] for i in range(3)} == {"Menu of the site\ntext of page d\nshared by all\nImprint"}


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        in_a, in_b = html.common_lines(a, b)
        left, right = [x for x, k in zip(a, in_a) if k], [x for x, k in zip(b, in_b) if k]
        assert left == right and len(left) == table[-1][-1]


@pytest.mark.parametrize("page", ["<p", "<div><p>a</div>b", "</p></div>x", "<a href='>'>x</a>", "<script>never closed", "&#x41;&bogus;&amp", "<p>" * 3000 + "deep"])
def test_broken_pages(page):
    lines, kinds = html.page_lines(page)
    assert len(lines) == len(kinds) and all(l == l.strip() and l for l in lines)


# -- tokens ----------------------------------------------------------------------


def test_bpe_equals_the_library_and_goes_back(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA).withColumns({"ids": F.lit("clash"), "decoded": F.lit(0)})
    coded = bpe.encode(df, text="text", **RANKS)
    enc = bpe.encoding(RANKS["ranks"], RANKS["pattern"])
    rows = bpe.decode(coded, **RANKS).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.ids == enc.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), text="text", **RANKS).count() == 0


def test_safe_pieces_change_nothing():
    enc = bpe.encoding(RANKS["ranks"], RANKS["pattern"])
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice(["a", "B", "é", "1", "2", " ", "  ", "\n", "'s", "!", " ", "语"]) for _ in range(80))
        pieces = list(bpe.safe_pieces(text, 7))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


@pytest.mark.parametrize("added", [True, False])
def test_packing(spark, added):
    rng = random.Random(6)
    rows = odd_rows() + [(100 + i, " ".join(rng.choice(["token", "x1", "é", "<|endoftext|>"]) for _ in range(rng.randrange(900)))) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit("clash"))
    pieces = packing.pack(df.repartition(3), **MODEL, size=256, group_ids=9000, added=added).collect()
    plain = Tokenizer.from_file(MODEL["tokenizer"])
    plain.encode_special_tokens = not added
    assert (50256 in plain.encode("a <|endoftext|> b", add_special_tokens=False).ids) == added
    wanted = collections.Counter((k, *plain.encode(t or "", add_special_tokens=False).ids, 0) for k, t in rows)
    windows, whole = collections.defaultdict(list), collections.defaultdict(dict)
    for p in pieces:
        windows[p.sequence_id].append((p.offset, p.length))
        whole[p.doc_id].setdefault((p.start, p.length, bytes(p.ids)), 0)
    for held in windows.values():
        held.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and held[0][0] == 0
        size = sum(n for _, n in held)
        assert size == 256 or size & (size - 1) == 0 and size < 256
    single = [k for k, n in collections.Counter(k for k, _ in rows).items() if n == 1]
    for key in single:
        parts = sorted(whole[key])
        ids = np.frombuffer(b"".join(p[2] for p in parts), "<u4")
        assert wanted[(key, *ids.tolist())] == 1 and [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
    assert sum(p.length for p in pieces) == sum((len(k) - 1) * n for k, n in wanted.items())
    assert packing.pack(df.limit(0), **MODEL).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(1)
    for _ in range(60):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(50))]
        rooms, wanted = [], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [w for w in range(len(rooms)) if rooms[w] >= lengths[i]]
            if fits:
                tight = min(rooms[w] for w in fits)
                rooms[next(w for w in fits if rooms[w] == tight)] -= lengths[i]
            else:
                rooms.append(64 - lengths[i])
        made = packing.best_fit(lengths, 64)
        assert sorted(64 - sum(lengths[i] for i in w) for w in made) == sorted(rooms)


# -- language model -----------------------------------------------------------------


@pytest.mark.parametrize("block_bytes, split", [(300, 1), (16 << 20, 32)])
def test_scores_equal_a_model_of_dictionaries(spark, monkeypatch, block_bytes, split):
    monkeypatch.setattr(lm, "HOT_SHARE", 20)
    rng = random.Random(block_bytes)
    rows = odd_rows() + [(200 + i, " ".join(rng.choice(["The", "the", "of", "a", f"w{rng.randrange(90)}"]) for _ in range(rng.randrange(40)))) for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"train": F.lit("clash"), "block": F.lit(5)})
    trained = lambda k: None if k is None else k % 5 != 1
    found, n = lm.score_corpus(df, F.col("doc_id") % 5 != 1, block_bytes=block_bytes)
    words, pairs, after, first = (collections.Counter() for _ in range(4))
    for k, t in rows:
        if trained(k):
            path = [1, *tokens(t), 0]
            words.update(path[1:])
            pairs.update(zip(path, path[1:]))
            first.update(path[:-1])
    after.update(h for h, _ in pairs)
    assert n == sum(words.values())
    z = n + 0.5 * (len(words) + 1)
    wanted = collections.Counter()
    for k, t in rows:
        path, base, score = [1, *tokens(t), 0], 0.0, 0.0
        for h, w in zip(path, path[1:]):
            p = (words[w] + 0.5) / z
            base += math.log10(p)
            if first[h]:
                p = max(pairs[h, w] - lm.DISCOUNT, 0) / first[h] + lm.DISCOUNT * after[h] / first[h] * p
            score += math.log10(p)
        wanted[k, len(path) - 1, sum(words[w] > 0 for w in path[1:]), round(base, 5), round(score, 5)] += 1
    got = collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5), round(r.score, 5)) for r in found.collect())
    assert got == wanted


def test_no_training_texts_and_no_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    found, n = lm.score_corpus(df, F.lit(False))
    assert n == 0 and all(r.score == r.base_score and r.n_known == 0 for r in found.collect())
    assert lm.score_corpus(df.limit(0), F.lit(True))[0].count() == 0


def test_packed_counts_go_back():
    values = np.array([0, 1, 254, 255, 256, 2**40, 3], np.int64)
    assert lm._unpacked(lm._packed(values)).tolist() == values.tolist()
