"""Document quality by attention over passages (multiple-instance learning)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import SPACES, pieces, remainder, span_hashes, table, table_of, training_texts, word_spans
from almanac.llm.language import labelled_sample

#: Labelled texts per class that the model is fitted on, and the longest of them in characters.
SAMPLE, LONGEST = 3_000, 20_000
#: Words of a passage.
PASSAGE = 48
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4
FOLDS, HELD_OUT, GOOD = 4, 2, 0.7

_SPACE = table_of(SPACES)
# Kinds of bytes whose share in a passage describes it.
_KINDS = np.stack(
    [
        table_of(bytes(range(0x61, 0x7B))),
        table_of(bytes(range(0x41, 0x5B))),
        table_of(bytes(range(0x30, 0x3A))),
        table_of(bytes(range(0x80, 0x100))),
        table_of(b".,;:'\"-()"),
        table_of(b"!?"),
        table_of(b"#$%&*+/<=>@^_`~"),
        table_of(b"|[]{}\\"),
        table_of(b"\n\r"),
        table_of(bytes([*range(9), 11, 12, *range(14, 32), 127])),
    ]
).astype(np.float32)
_SHAPES = 5
#: Buckets of hashed word ends (the last two bytes), which tell words of prose from other strings.
_ENDS = 24
FEATURES = len(_KINDS) + _SHAPES + _ENDS + 1


@dataclass
class AttentionModel:
    """Standardisation, encoder, gated attention and classifier."""

    mean: np.ndarray
    spread: np.ndarray
    encode: np.ndarray  # feature, hidden
    encode_bias: np.ndarray
    look: np.ndarray  # hidden, attention
    gate: np.ndarray  # hidden, attention
    weigh: np.ndarray  # attention
    out: np.ndarray  # hidden
    offset: np.ndarray  # 1


def passages(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By piece of the batch: features of all passages, the first passage of each text and the end.

    A passage is ``PASSAGE`` words, the last of a text what is left; a text without words is one passage
    without features.
    """
    for first, last, data, rows in pieces(texts):
        starts, ends = word_spans(data, _SPACE)
        bounds = np.searchsorted(starts, rows)
        count = np.diff(bounds)
        number = np.maximum(1, -(-count // PASSAGE))
        edges = np.concatenate([[0], np.cumsum(number)])
        features = np.zeros((edges[-1], FEATURES), np.float32)
        if len(starts):
            text_of = np.repeat(np.arange(last - first), count)
            within = np.arange(len(starts)) - np.repeat(bounds[:-1], count)
            passage = edges[text_of] + within // PASSAGE
            heads = np.flatnonzero(np.diff(passage, prepend=-1))
            ids = passage[heads]
            words = np.diff(np.append(heads, len(starts))).astype(np.float32)
            # From a passage's first word to the next passage's or the text's end, blanks between words included.
            stops = np.minimum(np.append(starts[heads][1:], len(data)), rows[text_of[heads] + 1] - 1)
            size = np.maximum(1, stops - starts[heads]).astype(np.float32)
            pairs = np.stack([starts[heads], stops], axis=1).ravel()  # every other piece lies between passages
            for k, kind in enumerate(_KINDS):
                features[ids, k] = np.add.reduceat(kind[data], pairs)[::2] / size
            lengths = (ends - starts).astype(np.float32)
            hashes = span_hashes(data, starts, ends)
            key = np.sort((passage.astype(np.uint64) << np.uint64(32)) | (hashes >> np.uint64(32)))
            distinct = np.bincount((key[np.flatnonzero(np.diff(key, prepend=np.uint64(0)) > 0)] >> np.uint64(32)).astype(np.int64), minlength=edges[-1])
            again = np.zeros(len(starts), np.float32)
            again[1:] = (hashes[1:] == hashes[:-1]) & (passage[1:] == passage[:-1])
            base = len(_KINDS)
            features[ids, base] = np.add.reduceat(lengths, heads) / words / 10
            features[ids, base + 1] = np.maximum.reduceat(lengths, heads).clip(0, 100) / 50
            features[ids, base + 2] = distinct[ids] / words
            features[ids, base + 3] = np.add.reduceat(again, heads) / words
            features[ids, base + 4] = np.add.reduceat((lengths == 1).astype(np.float32), heads) / words
            endings = (span_hashes(data, np.maximum(starts, ends - 2), ends) % np.uint64(_ENDS)).astype(np.int64)
            table = np.bincount(passage * _ENDS + endings, minlength=edges[-1] * _ENDS).reshape(-1, _ENDS)
            features[ids, base + 5 : base + 5 + _ENDS] = table[ids] / words[:, None]
            features[:, -1] = 0
            features[ids, -1] = 1
        yield features, edges


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(m: AttentionModel, x: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """Encode every passage, weigh passages by gated attention within their text, and score the mean."""
    x = (x - m.mean) / m.spread
    h = np.tanh(x @ m.encode + m.encode_bias)
    look, gate = np.tanh(h @ m.look), _sigmoid(h @ m.gate)
    energy = (look * gate) @ m.weigh
    number = np.diff(edges)
    top = np.repeat(np.maximum.reduceat(energy, edges[:-1]), number)
    weight = np.exp(energy - top)
    weight /= np.repeat(np.add.reduceat(weight, edges[:-1]), number)
    pooled = np.add.reduceat(weight[:, None] * h, edges[:-1], axis=0)
    return {"x": x, "h": h, "look": look, "gate": gate, "weight": weight, "pooled": pooled, "score": _sigmoid(pooled @ m.out + m.offset[0])}


def fit(bags: list[np.ndarray], target: np.ndarray, seed: int = 3) -> AttentionModel:
    """Adam on the cross entropy of texts; passages have no labels of their own. Classes weigh alike."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    m = AttentionModel(
        every.mean(axis=0),
        np.maximum(every.std(axis=0), 1e-3),
        rng.normal(0, 0.2, (FEATURES, HIDDEN)).astype(np.float32),
        np.zeros(HIDDEN, np.float32),
        rng.normal(0, 0.3, (HIDDEN, ATTENTION)).astype(np.float32),
        rng.normal(0, 0.3, (HIDDEN, ATTENTION)).astype(np.float32),
        rng.normal(0, 0.3, ATTENTION).astype(np.float32),
        rng.normal(0, 0.3, HIDDEN).astype(np.float32),
        np.zeros(1, np.float32),
    )
    weights = [m.encode, m.encode_bias, m.look, m.gate, m.weigh, m.out, m.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    importance = np.where(target == 1, len(target) / (2 * max(1, (target == 1).sum())), len(target) / (2 * max(1, (target == 0).sum())))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), BATCH):
            chosen = order[k : k + BATCH]
            edges = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            f = _forward(m, np.concatenate([bags[i] for i in chosen]), edges)
            number = np.diff(edges)
            error = (f["score"] - target[chosen]) * importance[chosen] / len(chosen)
            d_pooled = np.repeat(error[:, None] * m.out, number, axis=0)
            d_weight = (d_pooled * f["h"]).sum(axis=1)
            mean = np.repeat(np.add.reduceat(f["weight"] * d_weight, edges[:-1]), number)
            d_energy = f["weight"] * (d_weight - mean)
            d_look = d_energy[:, None] * m.weigh * f["gate"] * (1 - f["look"] ** 2)
            d_gate = d_energy[:, None] * m.weigh * f["look"] * f["gate"] * (1 - f["gate"])
            d_h = d_pooled * f["weight"][:, None] + d_look @ m.look.T + d_gate @ m.gate.T
            d_in = d_h * (1 - f["h"] ** 2)
            grads = [
                f["x"].T @ d_in, d_in.sum(axis=0), f["h"].T @ d_look, f["h"].T @ d_gate,
                (f["look"] * f["gate"]).T @ d_energy, f["pooled"].T @ error, np.array([error.sum()]),
            ]
            step += 1
            for w, g, a, b in zip(weights, grads, first, second):
                g = g + DECAY * w
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return m


def train(docs: DataFrame, labels: DataFrame, fit_on: Column, per_class: int = SAMPLE) -> AttentionModel | None:
    """Fit on a bounded sample: ``per_class`` labelled texts of each class, of ``LONGEST`` characters at most (``training_texts``).

    None if a class has no text.
    """
    known = labels.filter(fit_on & F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    # Two classes of so many rows at most: small enough to send to where the texts are.
    chosen = F.broadcast(labelled_sample(known, "quality", per_class))
    rows = training_texts(docs, chosen, "quality", LONGEST)
    target = np.array([r[0] for r in rows], np.int64)
    if len(set(target.tolist())) < 2:
        return None
    bags = [features[a:b] for features, edges in passages([r[2] for r in rows]) for a, b in zip(edges, edges[1:])]
    return fit(bags, target)


def _scorer(model: AttentionModel) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_forward(model, x, edges)["score"] for x, edges in passages(batch["text"].tolist())]
            yield batch[["doc_id"]].assign(score=np.concatenate(found).astype(float) if found else np.zeros(0))

    return score


def quality_scores(docs: DataFrame, model: AttentionModel | None) -> DataFrame:
    """(doc_id, score), one row per row of ``docs`` (doc_id, text): 0 to 1, higher is better.

    All passages of a text take part. Empty and NULL texts have the score of a passage without words;
    every score is 0 if there is no model.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        scored = rows.mapInPandas(_scorer(model), "doc_id string, score double")
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    held_out = (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    predicted = (F.col("score") >= GOOD).cast("int").alias("predicted")
    return quality_scores(docs, model).select("doc_id", held_out, "score", predicted)
