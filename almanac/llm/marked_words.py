"""SentencePiece ids by tables of distinct marked words, each segmented once and joined back by position.

One table of all words, joined to the words of every block of texts by shuffles, gave the same ids, but wrote 1.8 times the input
to disk and took more than 3,000 MB of an executor (README): half of all different words stand in one block only.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.llm.common import table
from almanac.sources.shared import materialise, scratch

#: Characters of text that share a list of distinct words; a longer text is a block of its own.
BLOCK = 1 << 22
#: Words of the table that all tasks get, and characters of its longest one.
TABLE, LONGEST = 1 << 17, 64
#: What a space is to the pieces: the marker that begins a word.
MARK = "▁"
_WORD = re.compile(" ( *[^ ]*)")


@lru_cache(maxsize=2)
def _tokenizer(model: str):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=model)


def check_model(model: str) -> None:
    """Fail unless texts may be cut before each run of markers: a word's ids are then its own affair.

    No piece may have a marker behind another character, texts must get a marker in front, and white space
    must stay as it is.
    """
    tokenizer = _tokenizer(model)
    crossing = [p for p in map(tokenizer.id_to_piece, range(tokenizer.get_piece_size())) if MARK in p.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross the marker of a word: {crossing[:5]}")
    if tokenizer.decode(tokenizer.encode("  a \n b ")) != "  a \n b " or tokenizer.id_to_piece(tokenizer.encode("a"))[0][0] != MARK:
        raise ValueError("the model trims white space or puts no marker in front of a text")


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def words_of(text: str) -> list[str]:
    """The text cut before each run of markers, each word without its first marker."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " " or text[-1] == " ":
        return _WORD.findall(" " + text)
    return text.split(" ")


def word_table(docs: DataFrame, model: str, size: int = TABLE, block_size: int = BLOCK) -> DataFrame:
    """(word, ids) of the ``size`` most frequent words of the corpus, each segmented once.

    Words are counted in the tasks that read the texts, block by block; words that come once in a block don't count there.
    Longer words than ``LONGEST`` are left out. So the table has a bounded size, whatever the corpus.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, held = Counter(), 0

        def closed() -> pd.DataFrame:
            often = [(w, n) for w, n in counts.items() if n > 1 and len(w) <= LONGEST]
            return pd.DataFrame(often, columns=["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                if isinstance(text, str):
                    counts.update(words_of(text))
                    held += len(text)
                if held >= block_size:
                    yield closed()
                    counts, held = Counter(), 0
        yield closed()

    def segment(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"word": batch["word"], "ids": _segmented(batch["word"].tolist(), model)})

    counted = docs.select("text").mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    top = materialise(counted.orderBy(F.desc("n"), "word").limit(size).select("word"), "words")
    return materialise(top.mapInPandas(segment, "word string, ids array<int>"), "word-ids")


def _segmented(words: list[str], model: str) -> list[list[int]]:
    """Ids of words without their first marker, which the library puts before each."""
    tokenizer = _tokenizer(model)
    # The library gives an empty text no ids, but a marker at the end of a text is one.
    return [ids or [tokenizer.piece_to_id(MARK)] for ids in tokenizer.encode(words, num_threads=1)]


def encode(docs: DataFrame, model: str, table_size: int = TABLE, block_size: int = BLOCK, decoded: bool = False) -> DataFrame:
    """(doc_id, ids, text?): ids of every text as little-endian unsigned 32-bit integers, with begin and end ids.

    One row per row of ``docs``, which has doc_id, text and any others. They equal those of the library's encode().
    Texts are cut before each run of markers, which no piece crosses. The frequent words are in one table for the whole corpus
    (``word_table``), which goes to all tasks; a block of texts segments each of its other words once. Every
    word of a text then takes its ids by its number. Texts are not shuffled, and a task holds one block of ``block_size`` characters.
    ``decoded`` adds the text that the ids give again (as ``decode`` does), where they are made.

    NULL and empty text have begin and end ids only. A very long text is a block of its own. Repeated rows
    and NULL ids are rows like others. Other columns are not read, whatever their names. An empty table gives none.
    """
    check_model(model)
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    with scratch(spark):
        known = word_table(docs, model, table_size, block_size).toPandas()
    sizes = np.fromiter(map(len, known["ids"]), np.int64, len(known))
    shared = spark.sparkContext.broadcast((known["word"].tolist(), sizes, np.fromiter(chain.from_iterable(known["ids"]), np.int32)))
    schema = T.StructType([docs.schema["doc_id"], T.StructField("ids", T.BinaryType())])
    if decoded:
        schema = schema.add("text", T.StringType())

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(model)
        begin, end = np.int32([tokenizer.bos_id()]), np.int32([tokenizer.eos_id()])
        common, common_counts, common_flat = shared.value
        table_of_words = {w: i for i, w in enumerate(common)}

        def closed() -> pd.DataFrame:
            rare = [w for w in numbers if w not in table_of_words]
            found = _segmented(rare, model)
            counts = np.concatenate([common_counts, np.fromiter(map(len, found), np.int64, len(found))])
            flat = np.concatenate([common_flat, np.fromiter(chain.from_iterable(found), np.int32)])
            starts = np.cumsum(counts) - counts
            # A word's place: in the table, or behind it in this block's list.
            behind = {w: len(common) + i for i, w in enumerate(rare)}
            place = np.fromiter((table_of_words[w] if w in table_of_words else behind[w] for w in numbers), np.int64, len(numbers))
            out = []
            for ref in refs:
                words = place[ref]
                n = counts[words]
                ids = flat[np.repeat(starts[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                out.append(np.concatenate([begin, ids, end]).astype("<u4").tobytes())
            rows = {"doc_id": pd.Series(doc_ids, dtype=object), "ids": out}
            return pd.DataFrame(rows | {"text": _decoded(out, tokenizer)} if decoded else rows)

        doc_ids, refs, numbers, held = [], [], _Numbers(), 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = words_of(text) if isinstance(text, str) else []
                doc_ids.append(None if pd.isna(doc_id) else doc_id)
                refs.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
                held += len(text or "") + 1
                if held >= block_size:
                    yield closed()
                    doc_ids, refs, numbers, held = [], [], _Numbers(), 0
        if doc_ids:
            yield closed()

    return docs.mapInPandas(assign, schema)


def _decoded(ids: Iterable[bytes | None], tokenizer) -> pd.Series:
    return pd.Series([None if i is None else tokenizer.decode(np.frombuffer(i, "<u4").tolist()) for i in ids], dtype=object)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encoded`` with ``text``, which the library decodes from ``ids`` (as in ``encode``).

    Any ids may come, also those of another text's middle; NULL ids give NULL. Other columns stay.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField("text", T.StringType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(model)
        for batch in batches:
            yield batch.assign(text=_decoded(batch["ids"], tokenizer).to_numpy())

    return encoded.mapInPandas(read, schema)


def op11_marked_words(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Number and digests of the ids and of the decoded text of every document."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    found = encode(table(spark, sf_dir, "documents"), str(model), decoded=True)
    return found.select(
        "doc_id",
        F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
