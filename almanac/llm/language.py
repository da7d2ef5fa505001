"""Language identification by a convolutional network over bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almanac.llm.common import remainder, table
from almanac.sources.shared import materialise

#: Bytes of a window, and labelled texts per language that the network is fitted on.
WINDOW, SAMPLE = 192, 1_500
WIDTHS, FILTERS, BYTE_DIM = (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE = 12, 128, 0.01
FOLDS, HELD_OUT = 5, 0
UNKNOWN = "und"
#: Windows that one step of prediction holds.
_STEP = 1_024


@dataclass
class ByteNetwork:
    """Weights; a filter of width w is w matrices from a byte's embedding to the filters' outputs."""

    languages: list[str]
    embedding: np.ndarray  # byte, dim
    filters: list[np.ndarray]  # width, dim, filter
    bias: np.ndarray  # width, filter
    dense: np.ndarray  # filter of any width, language
    offset: np.ndarray  # language


def windows_of(text: str) -> np.ndarray:
    """All of a text in lower case as rows of ``WINDOW`` bytes, the last filled with blanks.

    Of an even split, so that no window is a short rest.
    """
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // WINDOW))
    width = -(-len(data) // rows) if len(data) else WINDOW
    filled = np.full(rows * width, 32, np.uint8)
    filled[: len(data)] = data
    out = np.full((rows, WINDOW), 32, np.uint8)
    out[:, :width] = filled.reshape(rows, width)
    return out


def _pooled(net: ByteNetwork, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Place of each filter's maximum in each window, and the maxima after the rectifier."""
    e = net.embedding[x]
    places, maxima = [], []
    for k, (kernel, bias) in enumerate(zip(net.filters, net.bias)):
        w = WIDTHS[k]
        n = x.shape[1] - w + 1
        patches = np.concatenate([e[:, j : j + n] for j in range(w)], axis=2)
        out = patches @ kernel.reshape(w * BYTE_DIM, FILTERS) + bias
        at = out.argmax(axis=1)
        places.append(at)
        maxima.append(np.take_along_axis(out, at[:, None], axis=1)[:, 0])
    return places, np.maximum(np.concatenate(maxima, axis=1), 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(windows: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 5) -> ByteNetwork:
    """Adam on the cross entropy; gradients flow through the places of the maxima only."""
    rng = np.random.default_rng(seed)
    net = ByteNetwork(
        languages,
        rng.normal(0, 0.5, (256, BYTE_DIM)).astype(np.float32),
        [rng.normal(0, 0.3, (w, BYTE_DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros((len(WIDTHS), FILTERS), np.float32),
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    weights = [net.embedding, *net.filters, net.bias, net.dense, net.offset]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for k in range(0, len(order), BATCH):
            x, y = windows[order[k : k + BATCH]], target[order[k : k + BATCH]]
            places, h = _pooled(net, x)
            error = _softmax(h @ net.dense + net.offset)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            back = (error @ net.dense.T) * (h > 0)
            grads = [np.zeros_like(w) for w in weights]
            grads[-2], grads[-1] = h.T @ error, error.sum(axis=0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                grads[1 + len(WIDTHS)][i] = g.sum(axis=0)
                for j in range(w):
                    bytes_at = np.take_along_axis(x, places[i] + j, axis=1)  # window, filter
                    grads[1 + i][j] = np.einsum("nfd,nf->df", net.embedding[bytes_at], g)
                    flow = g[:, :, None] * net.filters[i][j].T[None]
                    np.add.at(grads[0], bytes_at.ravel(), flow.reshape(-1, BYTE_DIM))
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _tables(net: ByteNetwork) -> list[list[tuple[int, int, np.ndarray]]]:
    """Each filter as sums of table rows: by two neighbouring bytes at once, and one for an odd width."""
    out = []
    for kernel in net.filters:
        single = [(net.embedding @ k).astype(np.float32) for k in kernel]
        parts = [(j, 2, (single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS)) for j in range(0, len(single) - 1, 2)]
        out.append(parts + ([(len(single) - 1, 1, single[-1])] if len(single) % 2 else []))
    return out


def window_probabilities(net: ByteNetwork, tables: list, x: np.ndarray) -> np.ndarray:
    """Probabilities of the languages, by window. The same network, by lookup."""
    pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
    maxima = []
    for w, parts, bias in zip(WIDTHS, tables, net.bias):
        n = x.shape[1] - w + 1
        out = None
        for j, size, values in parts:
            found = values[(pairs if size == 2 else x)[:, j : j + n]]
            out = found if out is None else np.add(out, found, out=out)
        maxima.append(out.max(axis=1) + bias)
    return _softmax(np.maximum(np.concatenate(maxima, axis=1), 0) @ net.dense + net.offset)


def _predictor(net: ByteNetwork) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = _tables(net)
        for batch in batches:
            total = np.zeros((len(batch), len(net.languages)))
            number = np.zeros(len(batch))
            held: list[np.ndarray] = []
            owner: list[np.ndarray] = []

            def flush() -> None:
                if held:
                    x, rows = np.concatenate(held), np.concatenate(owner)
                    for k in range(0, len(x), _STEP):
                        np.add.at(total, rows[k : k + _STEP], window_probabilities(net, tables, x[k : k + _STEP]))
                    np.add.at(number, rows, 1)
                    held.clear()
                    owner.clear()

            for i, text in enumerate(batch["text"]):
                x = windows_of(text)
                held.append(x)
                owner.append(np.full(len(x), i))
                if sum(map(len, held)) >= _STEP:
                    flush()
            flush()
            mean = total / np.maximum(number, 1)[:, None]
            best = mean.argmax(axis=1)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "lang_pred": [net.languages[b] for b in best], "score": np.clip(mean.max(axis=1), 0, 1)}
            )

    return predict


def labelled_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """At most ``per_label`` different rows of each label, those with the smallest hashes, so that reruns agree.

    Labels are counted first; of a frequent one only the share of hashes that has about twice as many rows
    goes on to be numbered. So what a task numbers does not grow with the input, however hot a label is.
    """
    known = rows.filter(F.col(label).isNotNull()).withColumn("hash", F.xxhash64(*[c for c in rows.columns if c != label]))
    # Written, so that Spark sees how small it is and does not deal rows by label to join them.
    counts = materialise(known.groupBy(F.col(label).alias("of")).agg(F.count("*").alias("rows")), "labels")
    few = F.pmod("hash", F.lit(1 << 30)) * F.col("rows") < F.lit(float(2 * per_label) * (1 << 30))
    some = known.join(counts, F.col(label) == F.col("of")).filter(few).select(*known.columns).distinct()
    order = Window.partitionBy(label).orderBy("hash", *[c for c in rows.columns if c != label])
    placed = some.withColumn("place", F.row_number().over(order))
    return placed.filter(F.col("place") <= per_label).select(*rows.columns)


def train(docs: DataFrame, fit_on: Column, per_language: int = SAMPLE) -> ByteNetwork | None:
    """Fit on a bounded sample: one window out of each of ``per_language`` texts of each language.

    The driver holds that many windows of ``WINDOW`` bytes per language. None if nothing is labelled.
    """
    # A stretch from within the text, at a place that its hash gives, and cut where the network cuts.
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    piece = F.substr("text", (F.pmod(F.xxhash64("text"), room) + 1).cast("int"), F.lit(WINDOW))
    lettered = docs.filter(fit_on & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", piece.alias("piece"))
    sample = labelled_sample(lettered, "lang", per_language)
    rows = sorted((r.lang, r.piece) for r in sample.collect())
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    windows = np.stack([windows_of(p)[0] for _, p in rows])
    return fit(windows, np.array([languages.index(lang) for lang, _ in rows]), languages)


def identify(docs: DataFrame, net: ByteNetwork | None) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs`` (doc_id, text).

    All of a text is cut into windows of ``WINDOW`` bytes, which are predicted in batches; a text's
    probabilities are the mean over its windows, however many. NULL, and text without a letter, is ``und``
    with score 0; so is everything if there is no network. Repeated rows each get their result.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    nothing = rows.filter(~lettered if net else F.lit(True)).select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        found = nothing
    else:
        schema = "doc_id string, lang_pred string, score double"
        found = rows.filter(lettered).mapInPandas(_predictor(net), schema).union(nothing)
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "lang_pred", "score")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = remainder(F.col("doc_id"), FOLDS)
    found = identify(docs, train(docs, fold != HELD_OUT))
    return found.withColumn("held_out", remainder(F.col("doc_id"), FOLDS) == HELD_OUT).select("doc_id", "held_out", "lang_pred", "score")
