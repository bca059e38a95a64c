"""Quality of texts by a byte-level convolutional network in NumPy.

A text is its UTF-8 bytes, cut into overlapping chunks that cover all of it. Two banks of learned filters run over
a chunk: one over embedded bytes, one over agreement signals (does a byte equal the byte 2 to ``LAGS`` places before?),
which see repetition whatever is repeated. Each filter's output goes through a ramp and is max-pooled within the
chunk; a text has the largest and the mean chunk response of each filter. A small dense layer makes one
probability of these. All weights are learned by gradient descent (Adam) on the driver, from a bounded sample of rows:
the ``sample_rows`` labelled training rows of smallest hash, with their whole texts. Training and scoring read every
chunk of a text.

Rows with a null label teach nothing. Null and empty texts are one chunk of padding and get a score like others.
Without training rows of both labels the score is the share of label 1, or 0.5 without any. Repeated rows get equal
scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from affinis.llm.columns import with_text_column

SAMPLE_ROWS = 4_000
CHUNK, OVERLAP = 512, 64
EMBED, WIDTH, STRIDE, FILTERS = 8, 8, 4, 24
LAGS, LAG_WIDTH, LAG_STRIDE, LAG_FILTERS = 17, 16, 8, 8
HIDDEN = 16
#: A small sample is passed more often, up to the least number of steps.
PASSES, LEAST_STEPS, BATCH, RATE = 6, 300, 64, 4e-3
#: Chunks scored, and trained on, at once; bounds memory.
BLOCK_CHUNKS, TRAIN_BLOCK = 64, 512


@dataclass
class Network:
    weights: dict[str, np.ndarray]
    constant: float | None = None


def chunks(text: bytes | None) -> np.ndarray:
    """(n, CHUNK) bytes, padded with 0; consecutive chunks share OVERLAP bytes, and the last ends with the text."""
    data = np.frombuffer(text or b"", np.uint8)
    if len(data) <= CHUNK:
        out = np.zeros((1, CHUNK), np.uint8)
        out[0, :len(data)] = data
        return out
    starts = np.append(np.arange(0, len(data) - CHUNK, CHUNK - OVERLAP), len(data) - CHUNK)
    return np.lib.stride_tricks.sliding_window_view(data, CHUNK)[starts]


def _windows(x: np.ndarray, width: int, stride: int) -> np.ndarray:
    """(n, positions, width * channels) of (n, length, channels)."""
    n, _, channels = x.shape
    view = np.lib.stride_tricks.sliding_window_view(x, width, axis=1)[:, ::stride]
    return view.transpose(0, 1, 3, 2).reshape(n, view.shape[1], width * channels)


def _agreement(block: np.ndarray) -> np.ndarray:
    """(n, CHUNK, LAGS - 1): 1 where a byte equals the one 2 to LAGS places before it."""
    out = np.zeros((*block.shape, LAGS - 1), np.float32)
    for lag in range(2, LAGS + 1):
        out[:, lag:, lag - 2] = (block[:, lag:] == block[:, :-lag]) & (block[:, lag:] != 0)
    return out


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    zeros = lambda n: np.zeros(n, np.float32)
    return {
        "embed": (rng.standard_normal((256, EMBED)) * 0.5).astype(np.float32),
        "filters": draw(WIDTH * EMBED, FILTERS), "bias": zeros(FILTERS),
        "lag_filters": draw(LAG_WIDTH * (LAGS - 1), LAG_FILTERS), "lag_bias": zeros(LAG_FILTERS),
        "hidden": draw(2 * (FILTERS + LAG_FILTERS), HIDDEN), "hidden_bias": zeros(HIDDEN),
        "out": draw(HIDDEN, 1), "out_bias": zeros(1),
    }


def pooled(block: np.ndarray, w: dict[str, np.ndarray], trace: dict | None = None) -> np.ndarray:
    """(n, filters): the largest response of every filter in every chunk."""
    byte_view = _windows(w["embed"][block], WIDTH, STRIDE)
    lag_view = _windows(_agreement(block), LAG_WIDTH, LAG_STRIDE)
    parts = []
    for view, filters, bias in ((byte_view, "filters", "bias"), (lag_view, "lag_filters", "lag_bias")):
        n, places, size = view.shape
        response = (view.reshape(n * places, size) @ w[filters]).reshape(n, places, -1)
        best = response.argmax(axis=1) if trace is not None else None
        top = np.maximum(response.max(axis=1) + w[bias], 0)
        if trace is not None:
            trace[filters] = (view, best, top)
        parts.append(top)
    return np.concatenate(parts, axis=1)


def combined(features: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hidden activations and probabilities of (n, 2 * filters) text features."""
    hidden = np.maximum(features @ w["hidden"] + w["hidden_bias"], 0)
    return hidden, 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"], -30, 30)[:, 0]))


def score(text: bytes | None, network: Network) -> float:
    if network.constant is not None:
        return network.constant
    parts = chunks(text)
    tops, total = None, 0.0
    for at in range(0, len(parts), BLOCK_CHUNKS):
        found = pooled(parts[at:at + BLOCK_CHUNKS], network.weights)
        total = total + found.sum(axis=0, dtype=np.float64)
        tops = found.max(axis=0) if tops is None else np.maximum(tops, found.max(axis=0))
    features = np.concatenate([tops, (total / len(parts)).astype(np.float32)])
    return float(combined(features[None], network.weights)[1][0])


def train(texts: list[bytes | None], labels: list[int], seed: int = 7) -> Network:
    """A network for P(label 1). Both classes weigh as often as they occur."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return Network({}, float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    w = initial(seed)
    share = y.mean()
    w["out_bias"][:] = np.log(share / (1 - share))
    all_chunks = [chunks(t) for t in texts]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    in_pass = -(-len(y) // BATCH)
    passes = max(PASSES, -(-LEAST_STEPS // in_pass))
    step, steps = 0, passes * in_pass
    for _ in range(passes):
        order = rng.permutation(len(y))
        for first in range(0, len(order), BATCH):
            picked = order[first:first + BATCH]
            block = np.concatenate([all_chunks[i] for i in picked])
            grads = _gradients(block, np.array([len(all_chunks[i]) for i in picked]), y[picked], w)
            step += 1
            rate = RATE * (1 - (step - 1) / steps) + 1e-5
            for k, g in grads.items():
                m, v = moments[k]
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Network(w)


def _gradients(block: np.ndarray, counts: np.ndarray, y: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy of texts whose chunks follow each other in ``block``."""
    trace: dict = {}
    slices = [slice(at, at + TRAIN_BLOCK) for at in range(0, len(block), TRAIN_BLOCK)]
    tops = pooled(block, w, trace) if len(slices) == 1 else np.concatenate([pooled(block[own], w) for own in slices])
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    largest = np.maximum.reduceat(tops, starts, axis=0)
    mean = np.add.reduceat(tops, starts, axis=0) / counts[:, None]
    features = np.concatenate([largest, mean], axis=1).astype(np.float32)
    hidden, p = combined(features, w)
    d_out = ((p - y) / len(y)).astype(np.float32)[:, None]
    grads = {"out": hidden.T @ d_out, "out_bias": d_out.sum(axis=0)}
    d_hidden = (d_out @ w["out"].T) * (hidden > 0)
    grads |= {"hidden": features.T @ d_hidden, "hidden_bias": d_hidden.sum(axis=0)}
    d_features = d_hidden @ w["hidden"].T
    n = tops.shape[1]
    text_of = np.repeat(np.arange(len(counts)), counts)
    is_largest = tops == largest[text_of]
    ties = np.add.reduceat(is_largest, starts, axis=0)
    d_tops = d_features[text_of, :n] * is_largest / ties[text_of] + d_features[text_of, n:] / counts[text_of, None]
    d_tops = (d_tops * (tops > 0)).astype(np.float32)
    grads |= {k: np.zeros_like(w[k]) for k in ("embed", "filters", "bias", "lag_filters", "lag_bias")}
    for own in slices:
        if len(slices) > 1:
            trace = {}
            pooled(block[own], w, trace)
        _add_filter_gradients(block[own], d_tops[own], trace, w, grads)
    return grads


def _add_filter_gradients(block: np.ndarray, d_tops: np.ndarray, trace: dict, w: dict, grads: dict) -> None:
    at = 0
    for filters, bias in (("filters", "bias"), ("lag_filters", "lag_bias")):
        view, best, top = trace[filters]
        own = d_tops[:, at:at + top.shape[1]]
        at += top.shape[1]
        # only the window of the largest response passes its gradient on
        seen = view[np.arange(len(block))[:, None], best]  # chunk, filter, inputs
        grads[filters] += np.einsum("cf,cfi->if", own, seen)
        grads[bias] += own.sum(axis=0)
        if filters == "filters":
            d_inputs = own[:, :, None] * w[filters].T[None]  # chunk, filter, inputs
            places = best[:, :, None] * STRIDE + np.arange(WIDTH)
            read = block[np.arange(len(block))[:, None, None], places]
            np.add.at(grads["embed"], read.ravel(), d_inputs.reshape(-1, EMBED))


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> tuple[list[bytes | None], list[int]]:
    """Texts and labels of the sample: rows that are not held out, by smallest hash of the id, ``sample_rows`` at most.

    Of rows with one id the smallest text counts.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(doc_id).agg(F.min(label).alias("label"))
    known = known.where(~held_out(F.col(doc_id))).orderBy(F.xxhash64(doc_id), doc_id).limit(sample_rows)
    found = docs.select(doc_id, F.col(text).cast("binary").alias("body")).join(F.broadcast(known), doc_id)
    one = found.groupBy(doc_id).agg(F.min("body").alias("body"), F.first("label").alias("label"))  # sample_rows at most
    rows = one.orderBy(doc_id).select("body", "label").collect()
    return [None if r["body"] is None else bytes(r["body"]) for r in rows], [r["label"] for r in rows]


def held_out(key) -> F.Column:
    """Every fifth row by the CRC-32 of the id as text; such rows never train."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Network:
    return train(*training_rows(docs, labels, doc_id, text, label, sample_rows))


def with_score(docs: DataFrame, network: Network, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; a column named ``out`` is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    return with_text_column(docs, text, out, DoubleType(), lambda: lambda value: score(value, sent.value))
