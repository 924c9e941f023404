"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes. Each byte has a learned vector; filters look at
overlapping chunks of bytes that cover the whole text; each filter keeps its
largest answer over the text (max pooling); a hidden layer and a logistic unit
combine the answers to a probability. There is no length limit: the largest answers of a long text are
the largest of its parts.

Learning uses a bounded sample of labelled rows (rows and bytes per text are
parameters). Only the chunk that gave a filter's largest answer gets a
gradient, so a step costs little more than a forward pass.

Null and empty texts are scored as one empty chunk. Equal texts get equal
scores. With rows of one label only, the score is that label's smoothed share;
with no rows it is 0.5. Extra columns are kept by `score`,
but for one named as the column added.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fields_of, spread, text_runs, tidy, without

WIDTH, STRIDE, DEPTH, FILTERS, HIDDEN = 16, 8, 8, 32, 16
MARK = 256  # pads the ends


@dataclass
class Network:
    bytes: np.ndarray  # (257, DEPTH)
    filters: np.ndarray  # (WIDTH * DEPTH, FILTERS)
    bias: np.ndarray
    hidden: np.ndarray  # (FILTERS, HIDDEN)
    hidden_bias: np.ndarray
    weights: np.ndarray  # (HIDDEN,)
    offset: float


def _start(rng: np.random.Generator) -> Network:
    return Network(
        rng.normal(0, 0.5, (MARK + 1, DEPTH)).astype(np.float32),
        rng.normal(0, 1 / np.sqrt(WIDTH * DEPTH), (WIDTH * DEPTH, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 1 / np.sqrt(FILTERS), (FILTERS, HIDDEN)).astype(np.float32),
        np.full(HIDDEN, 0.1, np.float32),
        rng.normal(0, 0.3, HIDDEN).astype(np.float32),
        0.0,
    )


def chunk_starts(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of each chunk, chunks before each text, and in all).

    Chunks begin every STRIDE bytes; an empty text has one.
    """
    counts = np.maximum(1, -(-np.diff(offsets) // STRIDE))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts)
    return np.repeat(offsets[:-1], counts) + at * STRIDE, bounds


def _cut(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    at = starts[:, None] + np.arange(WIDTH)
    return np.where(at < ends[:, None], padded[np.minimum(at, len(padded) - 1)].astype(np.int16), np.int16(MARK))


def chunks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each chunk, chunks before each text, and in all); MARK after a text's end."""
    starts, bounds = chunk_starts(offsets)
    return _cut(np.append(data, np.uint8(0)), starts, np.repeat(offsets[1:], np.diff(bounds))), bounds


def _answers(net: Network, chunks: np.ndarray) -> np.ndarray:
    return net.bytes[chunks].reshape(len(chunks), -1) @ net.filters + net.bias


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Largest answer of each filter over each text."""
    starts, bounds = chunk_starts(offsets)
    padded = np.append(data, np.uint8(0))
    top = np.full((len(offsets) - 1, FILTERS), -np.inf, np.float32)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    for lo in range(0, len(starts), 4096):
        who = owner[lo : lo + 4096]
        part = _answers(net, _cut(padded, starts[lo : lo + 4096], offsets[1:][who]))
        first = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
        texts = who[first]
        top[texts] = np.maximum(top[texts], np.maximum.reduceat(part, first, axis=0))
    return top


def _combine(net: Network, top: np.ndarray) -> np.ndarray:
    inner = np.maximum(np.tanh(top).astype(np.float64) @ net.hidden + net.hidden_bias, 0)
    z = inner @ net.weights + net.offset
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def probability(net: Network | float, texts: pa.Array) -> np.ndarray:
    if isinstance(net, float):
        return np.full(len(texts), net)
    out = np.empty(len(texts))
    for lo, hi, data, offsets in text_runs(texts):
        out[lo:hi] = _combine(net, pooled(net, data, offsets))
    return out


def fit(texts: list[str], labels: list[int], *, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network | float:
    """Train with Adam on the log loss."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return float((y.sum() + 1) / (len(y) + 2)) if len(y) else 0.5
    rng = np.random.default_rng(seed)
    net = _start(rng)
    net.offset = float(np.log(y.mean() / (1 - y.mean())))
    raw = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    names = ("bytes", "filters", "bias", "hidden", "hidden_bias", "weights", "offset")
    moment = {n: [0.0, 0.0] for n in names}
    step, total = 0, epochs * -(-len(raw) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(raw))
        for lo in range(0, len(order), batch):
            picked = order[lo : lo + batch]
            offsets = np.concatenate([[0], np.cumsum([len(raw[i]) for i in picked])])
            chunks, bounds = chunks_of(np.concatenate([raw[i] for i in picked]), offsets)
            answers = np.concatenate([_answers(net, chunks[i : i + 8192]) for i in range(0, len(chunks), 8192)])
            best = np.stack([bounds[i] + answers[bounds[i] : bounds[i + 1]].argmax(0) for i in range(len(picked))])
            top = np.take_along_axis(answers, best, 0)
            held = np.tanh(top)
            p = _combine(net, top)
            dz = ((p - y[picked]) / len(picked)).astype(np.float32)
            inner = np.maximum(held @ net.hidden + net.hidden_bias, 0)
            dinner = dz[:, None] * net.weights * (inner > 0)
            dtop = (dinner @ net.hidden.T) * (1 - held * held)
            used = chunks[best]  # text, filter, byte
            vectors = net.bytes[used].reshape(len(picked), FILTERS, -1)
            dvec = (dtop[:, :, None] * net.filters.T[None]).reshape(-1, DEPTH)
            dbytes = np.stack([np.bincount(used.ravel(), dvec[:, j], MARK + 1) for j in range(DEPTH)], 1)
            gradients = {
                "bytes": dbytes.astype(np.float32),
                "filters": np.einsum("bf,bfw->wf", dtop, vectors) + 1e-5 * net.filters,
                "bias": dtop.sum(0),
                "hidden": held.T @ dinner + 1e-4 * net.hidden,
                "hidden_bias": dinner.sum(0),
                "weights": inner.T @ dz + 1e-4 * net.weights,
                "offset": float(dz.sum()),
            }
            step += 1
            now = rate * (1 - step / (total + 1))
            for n in names:
                a, b = moment[n]
                a = 0.9 * a + 0.1 * gradients[n]
                b = 0.999 * b + 0.001 * gradients[n] ** 2
                moment[n] = [a, b]
                change = now * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, float(net.offset - change) if n == "offset" else (getattr(net, n) - change).astype(np.float32))
    return net


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = 6000,
    max_chars: int = 12000,
) -> Network | float:
    """Fit on the `max_rows` labelled rows that come first by hash of the key.

    Of those, texts over `max_chars` are not learned from; all are scored. Only
    the labels are sorted; the keys taken, a bounded list, find their texts.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(key, F.col(label).alias("y"))
    picked = known.orderBy(F.xxhash64(key, F.lit("learn")), key, "y").limit(max_rows)
    rows = docs.select(key, F.col(text).alias("t")).where(F.coalesce(F.length("t"), F.lit(0)) <= max_chars)
    sample = rows.join(F.broadcast(picked), key).select("t", "y", F.xxhash64(key, F.lit("learn")).alias("h")).collect()
    sample.sort(key=lambda r: (r["h"], r["t"] or "", r["y"]))
    return fit([r["t"] for r in sample], [r["y"] for r in sample])


def score(docs: DataFrame, net: Network | float, *, text: str = "text", out: str = "score") -> DataFrame:
    """The columns of `docs` with the probability of label 1."""
    docs = without(docs, out)
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    def run(batches):
        for batch in batches:
            added = pa.array(probability(shared.value, batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, added], [*batch.schema.names, out])

    return spread(docs).mapInArrow(tidy(run), ", ".join([*fields_of(docs), f"`{out}` double"]))
