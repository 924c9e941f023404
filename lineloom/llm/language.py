"""Language identification by prediction by partial matching.

Each language has a byte context tree of order 3: for every context of up to
three bytes, which bytes followed it and how often. A byte is coded in the
longest context that the tree knows; with d different followers among n, the
escape to the next shorter context costs d / (n + d) (method C), and followers
already ruled out are excluded there. The statistics are frozen after learning,
so the cost of a byte depends on it and the three before it alone, and all
costs are put in one table: a text's exact code length is a sum of look-ups.

Learning uses a sample whose bound is a parameter (texts per language, bytes per
text, contexts kept). Scoring reads every text whole.

Null texts and texts without a letter are `und` with score 0. Ties go to the
language that sorts first. Equal texts get equal results. With nothing to learn
from, every text is `und`. Extra columns are kept by
`identify`, but for those named as the ones added.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fields_of, spread, text_runs, tidy, without

UNKNOWN = "und"
ORDER = 3
PIECE = 1 << 18  # bytes worked on at once


@dataclass(frozen=True)
class Model:
    languages: list[str]
    rank: np.ndarray  # of each byte among the bytes learned; the last rank is any other byte
    node: np.ndarray  # context number of the last three ranks
    bits: np.ndarray  # (context, rank) -> code length per language


def _followers(ranks: np.ndarray, order: int, m: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of one order with their followers, as (context * m + follower, count)."""
    at = np.flatnonzero(starts >= ORDER)
    code = np.zeros(len(at), np.int64)
    for back in range(order, -1, -1):
        code = code * m + ranks[at - back]
    return np.unique(code, return_counts=True)


def fit(samples: dict[str, list[str]], max_contexts: int = 20000) -> Model | None:
    """Context trees from sample texts of each language.

    Of the contexts of order three, the `max_contexts` most frequent are kept.
    """
    languages = sorted(k for k, texts in samples.items() if any(texts))
    if not languages:
        return None
    start = b"\n" * ORDER
    joined = {k: np.frombuffer(b"".join(start + t.encode() for t in samples[k] if t), np.uint8) for k in languages}
    # Places of each byte in its text, start marks included.
    place = {
        k: np.concatenate([np.arange(len(t.encode()) + ORDER) for t in samples[k] if t]) for k in languages
    }
    seen = np.unique(np.concatenate(list(joined.values())))
    m = len(seen) + 1
    rank = np.full(256, m - 1, np.int32)
    rank[seen] = np.arange(len(seen))

    counts = {k: [_followers(rank[joined[k]].astype(np.int64), o, m, place[k]) for o in range(ORDER + 1)] for k in languages}
    nodes: list[np.ndarray] = []  # context codes of each order
    for order in range(ORDER + 1):
        codes = np.concatenate([counts[k][order][0] // m for k in languages])
        weight = np.concatenate([counts[k][order][1] for k in languages])
        known, where = np.unique(codes, return_inverse=True)
        if order == ORDER and len(known) > max_contexts:
            total = np.bincount(where, weight)
            keep = np.lexsort((known, -total))[:max_contexts]
            known = np.sort(known[keep])
        nodes.append(known)

    costs = []
    for k in languages:
        table = []
        for order in range(ORDER + 1):
            codes, count = counts[k][order]
            here = np.zeros((len(nodes[order]), m), np.float32)
            at = np.searchsorted(nodes[order], codes // m)
            ok = (at < len(nodes[order])) & (nodes[order][np.minimum(at, len(nodes[order]) - 1)] == codes // m)
            here[at[ok], codes[ok] % m] = count[ok]
            table.append(here)
        costs.append(_code_lengths(table, nodes, m))

    # The longest context kept, by order: ranks of order three first.
    first = np.cumsum([0, *[len(n) for n in nodes]])
    of_two = np.arange(m * m)
    node_two = _number(nodes[2], of_two, first[2], _number(nodes[1], of_two % m, first[1], np.zeros(m * m, np.int64)))
    node = np.tile(node_two, m)
    node[nodes[3]] = first[3] + np.arange(len(nodes[3]))
    bits = np.stack(costs, axis=-1).reshape(-1, len(languages)).astype(np.float32)
    return Model(languages, rank, node.astype(np.int32), bits)


def _number(known: np.ndarray, codes: np.ndarray, first: int, otherwise: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, first + at, otherwise)


def _code_lengths(table: list[np.ndarray], nodes: list[np.ndarray], m: int) -> np.ndarray:
    """Bits of each follower in each context, contexts by rising order."""
    out = []
    for order in range(ORDER + 1):
        codes = nodes[order]
        bits = np.zeros((len(codes), m), np.float32)  # of the escapes so far
        left = np.ones((len(codes), m), bool)  # followers not coded yet
        for short in range(order, -1, -1):
            at = np.minimum(np.searchsorted(nodes[short], codes % m**short), len(nodes[short]) - 1)
            same = nodes[short][at] == codes % m**short
            count = np.where(left & same[:, None], table[short][at], 0)
            n, d = count.sum(1, keepdims=True), (count > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log2((n + d) / count)
                escape = np.where(d > 0, np.log2((n + d) / np.maximum(d, 1)), 0)
            bits = np.where(count > 0, bits + hit, np.where(left, bits + escape, bits))
            left &= count == 0
        # Order -1: all bytes that no context has had are alike.
        bits += np.where(left, np.log2(256 - (~left).sum(1, keepdims=True)), 0).astype(np.float32)
        out.append(bits)
    return np.concatenate(out)


def code_lengths(model: Model, texts: pa.Array) -> np.ndarray:
    """Bits of each whole text under each language."""
    m = int(model.rank.max()) + 1
    start = np.full(ORDER, model.rank[ord("\n")], np.int32)
    out = np.zeros((len(texts), len(model.languages)))
    # A run is whole texts of PIECE bytes together, or one longer text, which is read in pieces.
    for lo, hi, data, offsets in text_runs(texts, PIECE):
        filled = np.flatnonzero(np.diff(offsets))
        for a in range(0, len(data), PIECE):
            b = min(a + PIECE, len(data))
            before = max(a - ORDER, 0)
            ranks = model.rank[data[before:b]]
            ranks = np.concatenate([start[: ORDER - (a - before)], ranks])
            # Bytes at a text's start see the start mark, not the text before.
            heads = offsets[:-1][filled] - a
            ends = offsets[1:][filled] - a
            back = [ranks[ORDER - k : ORDER - k + b - a].copy() for k in range(1, ORDER + 1)]
            for k in range(1, ORDER + 1):
                for j in range(k):
                    inside = heads + j
                    back[k - 1][inside[(inside >= 0) & (inside < np.minimum(ends, b - a))]] = start[0]
            context = (back[2] * m + back[1]) * m + back[0]
            cost = model.bits[model.node[context] * m + ranks[ORDER:]]
            out[lo + filled] += np.add.reduceat(cost, np.maximum(heads, 0), axis=0, dtype=np.float64)
    return out


def predict(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, probability among those learned at equal odds) of each text."""
    return _judged(model, texts)[:2]


def _judged(model: Model | None, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """`predict`, and the bits of each text under its language."""
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = code_lengths(model, texts)
    best, least = bits.argmin(1), bits.min(1)
    behind = np.minimum(bits - least[:, None], 1000)
    return [model.languages[i] for i in best], 1 / np.exp2(-behind).sum(1), least


def usual_bits(samples: dict[str, list[str]], max_contexts: int = 20000, share: float = 0.99) -> dict[str, float]:
    """Bits a byte that are enough for a share of texts not learned from, per language.

    Every fifth text is held back from learning; a language of under 20 texts is
    left out, as too few are held back.
    """
    known = {k: sorted(t for t in texts if t) for k, texts in samples.items()}
    known = {k: v for k, v in known.items() if v}
    model = fit({k: [t for i, t in enumerate(v) if len(v) < 20 or i % 5] for k, v in known.items()}, max_contexts)
    out = {}
    for k, v in known.items():
        if len(v) >= 20:
            bits = code_lengths(model, pa.array(v[::5])).min(1)
            out[k] = float(np.quantile(bits / [len(t.encode()) for t in v[::5]], share))
    return out


def learn(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    order_by: Column,
    per_language: int = 400,
    max_chars: int = 20000,
    max_contexts: int = 20000,
) -> Model | None:
    """Fit on about `per_language` texts of each language, taken by hash of `order_by`.

    Of a text, the first `max_chars` characters are learned from, so that every
    language with a non-null text is learned. The sample alone comes to the driver:
    as many texts as the bound times languages.
    """
    samples = sample(docs, text=text, lang=lang, order_by=order_by, per_language=per_language, max_chars=max_chars)
    return fit(samples, max_contexts)


def sample(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", order_by: Column, per_language: int = 400, max_chars: int = 20000
) -> dict[str, list[str]]:
    """The texts that `learn` fits on, per language."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    share = F.lit(0.0)
    for language, n in counts.items():
        share = F.when(F.col(lang) == language, min(1.0, per_language / n)).otherwise(share)
    place = F.pmod(F.xxhash64(order_by, F.lit("learn")), F.lit(1 << 30)) / float(1 << 30)
    rows = known.where(place < share).select(lang, F.left(text, F.lit(max_chars))).collect()
    samples: dict[str, list[str]] = {}
    for language, value in sorted(map(tuple, rows)):
        samples.setdefault(language, []).append(value)
    return samples


def identify(
    docs: DataFrame,
    model: Model | None,
    *,
    text: str = "text",
    pred: str = "lang_pred",
    score: str = "score",
    bits: str | None = None,
) -> DataFrame:
    """The columns of `docs` with the predicted language, its probability and, if named, the text's bits under it."""
    more = [] if bits is None else [bits]
    docs = without(docs, pred, score, *more)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    def run(batches):
        for batch in batches:
            languages, *numbers = _judged(shared.value, batch.column(at))
            added = [pa.array(languages, pa.string()), *(pa.array(n, pa.float64()) for n in numbers[: 1 + len(more)])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, pred, score, *more])

    fields = [*fields_of(docs), f"`{pred}` string", *(f"`{c}` double" for c in [score, *more])]
    found = spread(docs).mapInArrow(tidy(run), ", ".join(fields))
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return found.withColumns(
        {pred: F.when(letters, F.col(pred)).otherwise(UNKNOWN), score: F.when(letters, F.col(score)).otherwise(0.0)}
    )
