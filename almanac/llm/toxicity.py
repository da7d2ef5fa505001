"""Toxicity by a convolutional network over hashed words, with thresholds calibrated by language."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm.common import pieces, remainder, span_hashes, table, table_of, word_spans
from almanac.sources.shared import discard, materialise, scratch

#: Characters of ``docs`` for which there is one shard of labelled texts, which one task learns from at a time.
SHARD = 1 << 24
#: With several shards: how often their weights are averaged, and how often each text is seen in between.
ROUNDS, PASSES = 2, 3
#: One in so many texts is left out of the fit, by which thresholds are set; the least of them per class and language.
CALIBRATION, LEAST = 4, 20
#: Steps of a logit in which the texts left out are counted, and the largest logit told apart.
STEPS, HIGHEST = 1_024, 30
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 12, 12, (1, 2, 3)
#: A word is known by itself and by its first bytes, so that new forms of a stem are not new words.
STEMS = (4, 5, 6)
EPOCHS, BATCH, RATE, DECAY, BLANKED = 10, 32, 0.05, 1e-3, 0.4
FOLDS, HELD_OUT = 5, 0
OTHER = "other"

# Bytes between words, and frequent words by which a text's language is told.
_BETWEEN = table_of(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
FREQUENT = {
    "de": "der die das und ist nicht ein eine den dem mit von für zu auf sich des im",
    "en": "the of and to in is that it for was on are as with his they be at this from",
    "es": "el la de que y en los las del se por un una con para su es al lo no",
    "fr": "le la les des et en un une du est que qui dans pour pas sur au par ne il",
}


def _one_hash(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(data, np.array([0]), np.array([len(data)]))[0]


_LANGUAGES = [*sorted(FREQUENT), OTHER]
_FREQUENT = {lang: np.sort(np.array([_one_hash(w) for w in words.split()], np.uint64)) for lang, words in FREQUENT.items()}


@dataclass
class WordNetwork:
    """Weights, and by language the logit at which a text counts as toxic."""

    embedding: np.ndarray  # bucket, dim
    filters: list[np.ndarray]  # width * dim, filter
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)


def tokens(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By piece of the batch: bucket numbers (word, feature), the first word of each text and the end,
    and each text's language by its frequent words."""
    lowered = [t.lower() if isinstance(t, str) else "" for t in texts]
    for first, last, data, rows in pieces(lowered):
        starts, ends = word_spans(data, _BETWEEN)
        hashes = [span_hashes(data, starts, ends)]
        # A stem of n bytes of a word that has more; a shorter word stands for itself.
        hashes += [span_hashes(data, starts, np.minimum(ends, starts + n)) + np.uint64(n) for n in STEMS]
        buckets = np.stack([(h % np.uint64(BUCKETS)).astype(np.int32) for h in hashes], axis=1)
        bounds = np.searchsorted(starts, rows)
        text_of = np.repeat(np.arange(last - first), np.diff(bounds))
        votes = np.stack([np.bincount(text_of[np.isin(hashes[0], _FREQUENT[k])], minlength=last - first) for k in sorted(FREQUENT)])
        language = np.where(votes.max(axis=0) > 0, votes.argmax(axis=0), len(_LANGUAGES) - 1)
        yield buckets, bounds, language


def _inner(edges: np.ndarray) -> np.ndarray:
    """Where the places of each text end from which no filter reaches the next text."""
    return edges[1:] - (max(WIDTHS) - 1)


def _convolved(net: WordNetwork, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The maximum by text and filter, and what it was taken from. ``x`` are word vectors with blank ones behind each text."""
    maxima, outs = [], []
    pairs = np.stack([bounds[:-1], _inner(bounds)], axis=1).ravel()  # every other piece lies between texts
    for w, kernel in zip(WIDTHS, net.filters):
        out = np.zeros((len(x), FILTERS), np.float32)
        for j in range(w):
            out[: len(x) - j] += x[j:] @ kernel[j * DIM : (j + 1) * DIM]
        outs.append(out)
        maxima.append(np.maximum.reduceat(out, pairs, axis=0)[::2])
    pooled = np.concatenate(maxima, axis=1) + net.bias
    return pooled, outs


def _blanked(buckets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put the blank words between texts over which no filter reaches from one to the next."""
    gap = max(WIDTHS) - 1
    n = len(bounds) - 1
    out = np.full((len(buckets) + (gap + 1) * n, buckets.shape[1]), -1, np.int32)
    move = np.repeat(np.arange(n), np.diff(bounds)) * (gap + 1)
    out[np.arange(len(buckets)) + move] = buckets
    return out, bounds + (gap + 1) * np.arange(n + 1)


def _vectors(net: WordNetwork, buckets: np.ndarray) -> np.ndarray:
    x = net.embedding[buckets[:, 0]]
    for k in range(1, buckets.shape[1]):
        x = x + net.embedding[buckets[:, k]]
    x[buckets[:, 0] < 0] = 0
    return x


def logits(net: WordNetwork, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    filled, edges = _blanked(buckets, bounds)
    pooled, _ = _convolved(net, _vectors(net, filled), edges)
    return np.maximum(pooled, 0) @ net.dense + net.offset


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _shapes() -> list[tuple[int, ...]]:
    n = len(WIDTHS) * FILTERS
    return [(BUCKETS, DIM), *[(w * DIM, FILTERS) for w in WIDTHS], (n,), (n,), (1,)]


def _views(rows: np.ndarray) -> list[np.ndarray]:
    """Embedding, filters, bias, dense and offset as parts of one array of rows of ``DIM`` values, the embedding's first."""
    flat, out, at = rows.reshape(-1), [], 0
    for shape in _shapes():
        out.append(flat[at : at + int(np.prod(shape))].reshape(shape))
        at += int(np.prod(shape))
    return out


def _network(rows: np.ndarray) -> WordNetwork:
    embedding, *filters, bias, dense, offset = _views(rows)
    return WordNetwork(embedding, filters, bias, dense, float(offset[0]))


def start(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Weights before training and sums of their squared gradients, as rows of ``DIM`` values."""
    rng = np.random.default_rng(seed)
    n = len(WIDTHS) * FILTERS
    size = -(-sum(int(np.prod(shape)) for shape in _shapes()) // DIM)
    rows, squares = np.zeros((size, DIM), np.float32), np.full((size, DIM), 1e-3, np.float32)
    embedding, *filters, _, dense, _ = _views(rows)
    embedding[:] = rng.normal(0, 0.05, (BUCKETS, DIM))
    for w, kernel in zip(WIDTHS, filters):
        kernel[:] = rng.normal(0, 0.3, (w * DIM, FILTERS))
    dense[:] = np.abs(rng.normal(0, 0.3, n))
    return rows, squares


def fit(texts: list[np.ndarray], target: np.ndarray, weights: np.ndarray, squares: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
    """Adagrad on the cross entropy, in place; only words at a filter's maximum take part in a step."""
    rng = np.random.default_rng(seed)
    net = _network(weights)
    parts, sums = _views(weights), _views(squares)
    # Classes weigh alike, however few texts are toxic.
    alike = (len(target) / np.maximum(1, 2 * np.bincount(target, minlength=2)))[target]
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            chosen = order[k : k + BATCH]
            bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in chosen])])
            buckets, edges = _blanked(np.concatenate([texts[i] for i in chosen]), bounds)
            # Some words are blank in each step, so that none hides behind a stronger one.
            buckets[rng.random(len(buckets)) < BLANKED] = -1
            x = _vectors(net, buckets)
            pooled, outs = _convolved(net, x, edges)
            h = np.maximum(pooled, 0)
            error = ((_sigmoid(h @ net.dense + net.offset) - target[chosen]) * alike[chosen] / len(chosen)).astype(np.float32)
            back = error[:, None] * net.dense * (pooled > 0)
            grads = [np.zeros_like(f) for f in net.filters]
            rows, flows = [], []
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                at = np.stack([outs[i][a:b].argmax(axis=0) + a for a, b in zip(edges, _inner(edges))])
                for j in range(w):
                    place = np.minimum(at + j, len(x) - 1)
                    kernel = net.filters[i][j * DIM : (j + 1) * DIM]
                    grads[i][j * DIM : (j + 1) * DIM] = np.einsum("nfd,nf->df", x[place], g)
                    rows.append(place.ravel())
                    flows.append((g[:, :, None] * kernel.T[None]).reshape(-1, DIM))
            place, flow = np.concatenate(rows), np.concatenate(flows)
            real = buckets[place, 0] >= 0
            touched, inverse = np.unique(buckets[place[real]].ravel(), return_inverse=True)
            summed = np.zeros((len(touched), DIM), np.float32)
            np.add.at(summed, inverse.ravel(), np.repeat(flow[real], buckets.shape[1], axis=0))
            sums[0][touched] += summed**2
            net.embedding[touched] -= RATE * summed / np.sqrt(sums[0][touched])
            dense = h.T @ error + DECAY * net.dense
            for w, g, s in zip(parts[1:], [*grads, back.sum(axis=0), dense, error.sum(keepdims=True)], sums[1:]):
                s += g * g
                w -= RATE * g / np.sqrt(s)
            net.offset = float(parts[-1][0])


def _threshold(scores: np.ndarray, toxic: np.ndarray, clean: np.ndarray | None = None, upto: np.ndarray | None = None) -> float:
    """The logit between two texts at which most are told right; two thirds up the gap, as clean texts are more.

    ``toxic`` is 0 or 1 by text; or it and ``clean`` are numbers of texts with logits from ``scores`` to ``upto``.
    """
    order = np.argsort(scores, kind="stable")
    clean, upto = (1 - toxic if clean is None else clean)[order], (scores if upto is None else upto)[order]
    s, t = scores[order], toxic[order]
    # Classes weigh alike; a cut before place i calls the rest toxic.
    right = np.concatenate([[0], np.cumsum(clean) / max(1, clean.sum())]) + np.concatenate([np.cumsum(t[::-1])[::-1] / max(1, t.sum()), [0]])
    best = np.flatnonzero(right >= right.max() - 1e-12)
    i = int(best[len(best) // 2])
    if i == 0:
        return float(s[0]) - 1
    return float(upto[-1]) + 1 if i == len(s) else float(upto[i - 1] + 2 * s[i]) / 3


def _labelled(docs: DataFrame, labels: DataFrame, fit_on: Column) -> tuple[DataFrame, int]:
    """(shard, aside, toxic, text) of every different labelled text, written, and the number of shards.

    Texts are dealt to shards by hash, which have ``SHARD`` characters or so at most, and one longer text. By
    another hash one in ``CALIBRATION`` is put aside.
    """
    known = labels.filter(fit_on & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    size = docs.agg(F.sum(F.char_length("text").cast("long")).alias("size")).first()["size"] or 0
    shards = max(1, -(-size // SHARD))
    # Labels grow with the documents, so they are not sent to all tasks; one shuffle serves the join and the distinct.
    texts = docs.filter(fit_on & F.col("text").isNotNull()).select("doc_id", "text").join(known.hint("merge"), "doc_id").distinct()
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard")
    aside = (F.pmod(F.xxhash64("text", "doc_id"), F.lit(CALIBRATION)) == 0).alias("aside")
    return materialise(texts.select(shard, aside, F.col("toxic").cast("int").alias("toxic"), "text"), "labelled"), shards


def _learner(weights: np.ndarray, squares: np.ndarray, epochs: int, seed: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """What one shard makes of the weights: the rows it changed, as changes of weights and of sums of squares."""

    def learn(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["toxic", "text"])
        texts = [b[x:y] for b, e, _ in tokens(shard["text"].tolist()) for x, y in zip(e, e[1:])]
        after, sums = weights.copy(), squares.copy()
        fit(texts, shard["toxic"].to_numpy(np.int64), after, sums, epochs, seed + int(key[0]))
        row = np.flatnonzero((sums != squares).any(axis=1))
        change = np.concatenate([after[row] - weights[row], sums[row] - squares[row]], axis=1)
        return pd.DataFrame(change, columns=[f"c{k}" for k in range(2 * DIM)]).assign(row=row)

    return learn


def _counter(net: WordNetwork) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(logits(net, b, e), lang) for b, e, lang in tokens(batch["text"].tolist())]
            if found:
                score, lang = (np.concatenate(x) for x in zip(*found))
                yield pd.DataFrame({"lang": lang, "score": score.astype(float), "toxic": batch["toxic"].to_numpy()})

    return count


def _thresholds(rows: DataFrame, net: WordNetwork) -> dict[str, float]:
    """By language, from all ``rows`` (toxic, text). The driver gets counts by step of a logit, whose number is bounded."""
    step = F.floor(F.least(F.greatest("score", F.lit(-HIGHEST)), F.lit(HIGHEST)) * STEPS).alias("step")
    scored = rows.select("toxic", "text").mapInPandas(_counter(net), "lang int, score double, toxic int")
    counted = scored.groupBy("lang", step).agg(F.min("score").alias("low"), F.max("score").alias("high"), F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
    found = pd.DataFrame([r.asDict() for r in counted.collect()])

    def cut(some: pd.DataFrame) -> float:
        some = some.groupby("step", as_index=False).agg({"low": "min", "high": "max", "toxic": "sum", "clean": "sum"})
        return _threshold(*(some[c].to_numpy() for c in ("low", "toxic", "clean", "high")))

    overall, out = cut(found), {}
    for k, name in enumerate(_LANGUAGES):
        own = found[found["lang"] == k]
        out[name] = cut(own) if min(own["toxic"].sum(), own["clean"].sum()) >= LEAST else overall
    return out


def train(docs: DataFrame, labels: DataFrame, fit_on: Column) -> WordNetwork | None:
    """Fit on every different labelled text, whole, on the executors. None, with a warning, if a class has no text.

    Texts are dealt to shards of bounded size. Each shard trains the network by itself, and a weight becomes the mean over the
    shards that changed it: ``PASSES`` times over all texts in each of ``ROUNDS`` rounds, or ``EPOCHS`` times if there is one shard.
    The driver holds the weights (3 MB, and as much again for Adagrad). One text in ``CALIBRATION`` is kept from the fit.
    By all of these each language gets the threshold that tells most texts right; one with fewer than ``LEAST`` of them in a
    class has the threshold of all. A text labelled both ways stands in both classes.
    """
    with scratch(docs.sparkSession):
        rows, shards = _labelled(docs, labels, fit_on)
        classes = {(r.aside, r.toxic) for r in rows.select("aside", "toxic").distinct().collect()}
        if len({toxic for _, toxic in classes}) < 2:
            warnings.warn("no texts of two classes of toxic: nothing is learned", stacklevel=2)
            return None
        # Of very few texts, either part may lack a class; it is then made up of all of them.
        kept, left = (rows.filter(F.col("aside") == part) if {(part, 0), (part, 1)} <= classes else rows for part in (False, True))
        weights, squares = start()
        changed = [f"c{k}" for k in range(2 * DIM)]
        schema = ", ".join([*[f"{c} float" for c in changed], "row int"])
        for k in range(ROUNDS if shards > 1 else 1):
            learn = _learner(weights, squares, PASSES if shards > 1 else EPOCHS, 11 + k * shards)
            changes = kept.groupBy("shard").applyInPandas(learn, schema)
            sums = materialise(changes.groupBy("row").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in changed]), "weights")
            found = np.array(sums.collect())
            at, change = found[:, 0].astype(int), (found[:, 2:] / found[:, 1:2]).astype(np.float32)
            weights[at] += change[:, :DIM]
            squares[at] += change[:, DIM:]
            discard(sums)
        net = _network(weights)
        net.thresholds = _thresholds(left, net)
    return net


def toxic_score(text: Column, net: WordNetwork | None) -> Column:
    """The score of a text, as in ``toxic_scores``; the rest of its row does not leave Spark."""
    if net is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        limits = np.array([net.thresholds[name] for name in _LANGUAGES])
        for batch in batches:
            found = [_sigmoid(logits(net, b, e) - limits[lang]) for b, e, lang in tokens(batch.tolist())]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return score(text)


def toxic_scores(docs: DataFrame, net: WordNetwork | None) -> DataFrame:
    """(doc_id, score), one row per row of ``docs`` (doc_id, text): 0.5 is the threshold of the text's language.

    The language is told by frequent words of the text itself. All words count, however many. Empty and NULL texts
    have the score of a text without words; every score is 0 if there is no network.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxic_score(F.col("text"), net).alias("score"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
    held_out = (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return toxic_scores(docs, net).select("doc_id", held_out, "score", predicted)
