"""Periodic runs of words: grids of each period, extended by a difference-cover index, and their removal."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import mixed, table

#: Words of the shortest run, which has two periods at least.
LEAST = 12
#: Bytes of text whose words are one sequence to the index; a longer text is a sequence of its own.
SEQUENCE = 1 << 21
#: Pairs of words that are looked at together.
PAIRS = 1 << 21
#: Any two residues of the period 13 have a shift that takes both into the cover.
PERIOD, COVER = 13, (0, 1, 3, 9)


def _shifts() -> np.ndarray:
    """By two residues: the least shift that takes both into the cover."""
    table = np.empty((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
    return table


_SHIFTS = _shifts()


class Extensions:
    """How far a sequence of numbers goes on alike from two places.

    Only the suffixes that begin in the difference cover are sorted. Two places are at most ``PERIOD - 1`` words from
    places of the cover: these words are compared, and the rest is the smallest common prefix
    between two ranks, from a sparse table.
    """

    def __init__(self, sequence: np.ndarray):
        n = len(sequence)
        # Numbers that are nowhere else end every comparison.
        last = int(sequence.max(initial=0)) + 1
        self._words = np.concatenate([sequence, last + np.arange(2 * PERIOD, dtype=np.int64)])
        self._n = n
        self._sorted = False

    def _sort(self) -> None:
        """Rank the sampled suffixes: by their first ``PERIOD`` words, then doubling; ranks of each round are kept."""
        size = -(-self._n // PERIOD) + 1  # places of each residue of the cover; the last ones lie behind the end
        places = (np.arange(size)[None, :] * PERIOD + np.array(COVER)[:, None]).ravel()
        padded = np.concatenate([self._words, self._words[-1] + 1 + np.arange(max(0, places[-1] + PERIOD - len(self._words)) + 1)])
        columns = [padded[places + t] for t in range(PERIOD)]
        base = int(padded[-1]) + 1
        if base < 1 << 21:  # three words in one integer
            columns = [sum(c * base ** (2 - k) for k, c in enumerate(columns[t : t + 3])) for t in range(0, PERIOD, 3)]
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        for c in columns:
            new[1:] |= c[order][1:] != c[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        rounds, step = [rank], 1
        count = len(order)
        while rank.max() < count - 1 and step < size:
            # The place ``step`` periods on has the same residue: it is ``step`` further in its row.
            grid = rank.reshape(len(COVER), size)
            after = np.full_like(grid, -1)
            after[:, :-step] = grid[:, step:]
            key = rank * (count + 1) + after.ravel() + 1
            order = np.argsort(key, kind="stable")
            rank = np.empty(count, np.int64)
            rank[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
            rounds.append(rank)
            step *= 2
        # Common prefixes of neighbours in rank: whole rounds first, from the longest, then word by word.
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        row = np.repeat(np.arange(len(COVER)), size)
        ends = (np.arange(len(COVER)) + 1) * size
        for k in range(len(rounds) - 1, -1, -1):
            inside = (a < ends[row[order[:-1]]]) & (b < ends[row[order[1:]]])
            x, y = np.where(inside, a, 0), np.where(inside, b, 0)
            same = inside & (rounds[k][x] == rounds[k][y])
            common += same * (PERIOD << k)
            a, b = a + same * (1 << k), b + same * (1 << k)
        left = self._plain(places[order[:-1]] + common, places[order[1:]] + common, PERIOD)
        levels = [common + left]
        while 2 << (len(levels) - 1) <= len(levels[0]):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        self._rank, self._levels, self._size = rank, levels, size
        self._row_of = np.full(PERIOD, -1)
        self._row_of[list(COVER)] = np.arange(len(COVER))
        self._sorted = True

    def _plain(self, i: np.ndarray, j: np.ndarray, most: np.ndarray | int) -> np.ndarray:
        """Equal words from i and j on, one by one, up to ``most``."""
        found = np.zeros(len(i), np.int64)
        most = np.broadcast_to(most, i.shape)
        alive = np.flatnonzero((most > 0) & (i < len(self._words)) & (j < len(self._words)))
        while len(alive):
            at = found[alive]
            alive = alive[self._words[i[alive] + at] == self._words[j[alive] + at]]
            found[alive] += 1
            at = found[alive]
            alive = alive[(at < most[alive]) & (np.maximum(i[alive], j[alive]) + at < len(self._words))]
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The number of equal words from i and j on; i and j differ."""
        shift = _SHIFTS[i % PERIOD, j % PERIOD]
        found = self._plain(i, j, shift)
        far = np.flatnonzero(found == shift)
        if not len(far):
            return found
        if not self._sorted:
            self._sort()
        a, b = i[far] + shift[far], j[far] + shift[far]
        ranks = [self._rank[self._row_of[x % PERIOD] * self._size + x // PERIOD] for x in (a, b)]
        low, high = np.minimum(*ranks), np.maximum(*ranks)
        level = np.log2(np.maximum(high - low, 1)).astype(np.int64)
        level -= (1 << level) > high - low
        rest = np.empty(len(far), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            rest[at] = np.minimum(self._levels[k][low[at]], self._levels[k][high[at] - (1 << k)])
        found[far] += rest
        return found


def _grids(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, period) of the grid points 0, p, 2p ... of each sequence and period p, in parts; p words on is inside."""
    halves = lengths // 2
    owner = np.repeat(np.arange(len(lengths)), halves)
    period = np.arange(len(owner)) - np.repeat(np.cumsum(halves) - halves, halves) + 1
    points = (lengths[owner] - 1) // period
    total = np.cumsum(points)
    first = 0
    while first < len(owner):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + PAIRS, side="right")))
        n, p = points[first:last], period[first:last]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        p_all = np.repeat(p, n)
        yield np.repeat(starts[owner[first:last]], n) + step * p_all, p_all
        first = last


def runs_of(sequence: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs in the parts of a sequence, by start, then period.

    Parts are followed by numbers that are nowhere else. A run of period p and two periods has a grid point whose word
    comes again p words on, and goes as far as the words around these two places are alike.
    """
    n = len(sequence)
    onward, back = Extensions(sequence), Extensions(sequence[::-1])
    found = []
    for i, p in _grids(starts, lengths):
        j = i + p
        same = np.flatnonzero(sequence[i] == sequence[j])
        i, j, p = i[same], j[same], p[same]
        # The words before i and j, read backwards; nothing stands before the first one.
        behind = np.zeros(len(i), np.int64)
        inner = np.flatnonzero(i > 0)
        behind[inner] = back(n - i[inner], n - j[inner])
        ahead = onward(i, j)
        whole = (ahead + behind >= p) & (p + ahead + behind >= least)
        found.append(np.stack([(i - behind)[whole], (j + ahead)[whole], p[whole]]))
    start, end, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    # Of the periods of one stretch the smallest is the run's.
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort([period, start])
    return start[order], end[order], period[order]


def _sequences(texts: Sequence[str | None]) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each row) of stretches of a batch."""
    first, held, rows = 0, 0, []
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "replace") if isinstance(text, str) else b""
        if rows and held + len(raw) > SEQUENCE:
            yield first, rows
            first, held, rows = k, 0, []
        rows.append(raw.split())  # at the bytes 20 and 09 to 0D
        held += len(raw)
    if rows:
        yield first, rows


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _repeating(sequence: np.ndarray, starts: np.ndarray, lengths: np.ndarray, least: int) -> np.ndarray:
    """Which parts have some stretch of half the shortest run twice: all that have runs, and hardly any others.

    In a run of period p, at least half of ``least`` words in a row come again p words on.
    """
    k = max(1, least // 2)
    if len(sequence) < k:
        return np.zeros(len(starts), bool)
    owner = np.repeat(np.arange(len(starts)), lengths + 1)[: len(sequence) - k + 1]
    codes = mixed(sequence.astype(np.uint64))
    stretch = owner.astype(np.uint64)
    for t in range(k):
        stretch = stretch * np.uint64(0x9E3779B97F4A7C15) + codes[t : len(sequence) - k + 1 + t]
    order = np.argsort(stretch, kind="stable")
    ordered = stretch[order]
    found = np.zeros(len(starts), bool)
    found[owner[order[1:]][ordered[1:] == ordered[:-1]]] = True
    return found & (lengths >= least)


def _collapsed(rows: list[list[bytes]], least: int) -> Iterator[tuple[list[dict], str]]:
    """Runs and collapsed text of each row."""
    numbers = _Numbers()
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    starts = np.cumsum(lengths + 1) - lengths - 1
    sequence = np.empty(int(lengths.sum()) + len(rows), np.int64)
    for words, a in zip(rows, starts.tolist()):
        sequence[a : a + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    sequence[starts + lengths] = len(numbers) + np.arange(len(rows))
    # The index is made of the texts that may have runs.
    some = np.flatnonzero(_repeating(sequence, starts, lengths, least))
    inside = np.zeros(len(rows), bool)
    inside[some] = True
    whole = np.flatnonzero(np.repeat(inside, lengths + 1))
    part_starts = np.cumsum(lengths[some] + 1) - lengths[some] - 1
    start, end, period = runs_of(sequence[whole], part_starts, lengths[some], least)
    end = whole[end - 1] + 1
    start = whole[start]
    # Words from a run's second period to its end.
    change = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    gone = np.cumsum(change) > 0
    first = np.searchsorted(start, starts)
    last = np.append(first[1:], len(start))
    for words, a, n, f, t in zip(rows, starts.tolist(), lengths.tolist(), first.tolist(), last.tolist()):
        runs = [{"start": int(s - a), "length": int(e - s), "period": int(p)} for s, e, p in zip(start[f:t], end[f:t], period[f:t])]
        kept = [words[k] for k in np.flatnonzero(~gone[a : a + n])] if runs else words
        yield runs, b" ".join(kept).decode("utf-8", "replace")


_RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, text): the periodic runs of every text's words, and the text without their repetitions.

    One row per row of ``docs``, which has doc_id, text and any others. Words are runs of bytes other than ASCII white space. A run
    is a stretch with smallest period q and at least ``least`` and 2 * q words that can't be made longer with that period;
    ``runs`` are (start, length, period) by start, then period. ``text`` has the words left, joined by one space: those that some run
    has behind its first q words are gone. No rows are shuffled; texts are taken together up to ``SEQUENCE`` bytes.

    NULL text gives no runs and an empty text, as do empty texts and those of white space. A very long text is a sequence of its
    own, whose index takes some hundred bytes per word. Repeated rows and NULL ids are rows like others, other columns are not
    read, an empty table gives none.
    """
    schema = T.StructType([docs.schema["doc_id"], T.StructField("runs", T.ArrayType(_RUN, False)), T.StructField("text", T.StringType())])

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, rows in _sequences(batch["text"].tolist()):
                runs, texts = zip(*_collapsed(rows, least))
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[first : first + len(rows)], "runs": list(runs), "text": list(texts)})

    return docs.select("doc_id", "text").mapInPandas(collapse, schema)


def made_periodic(doc_id: Column, text: Column) -> Column:
    """The text, in one of ten documents with its words from some place on made periodic (see op12)."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    whole = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), whole).otherwise(text)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, one in ten made periodic: number, the longest one, digests of all and of the text left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(line, F.lit("\n"))).otherwise("")
    found = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
