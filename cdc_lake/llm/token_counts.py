"""Token counts with a two-tier lookup on the map side.

A subword encoder works on pre-tokens alone: no vocabulary entry joins a character to a
space or line break that follows it, so the count of a text is the sum over its pre-tokens.
The lengths of the frequent pre-tokens are broadcast; every other pre-token is encoded once
and kept in the worker's cache. No pre-token is shuffled. Arrow kernels split a slice of texts
and number its distinct pre-tokens; only those are counted or looked up in Python.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import map_texts, partition_count

#: Entries of the broadcast table: a fixed size, whatever the corpus.
TABLE_SIZE = 32_768
#: Entries that a worker's cache holds beyond the table before it starts anew.
CACHE_SIZE = 300_000
#: Longer pre-tokens are encoded each time: they would not come again, and fill the cache.
CACHED_CHARS = 48
#: Summaries that one task merges.
FAN_IN = 32
#: Bytes of text that are split at once; a longer text is split alone.
SLICE_BYTES = 4 << 20

_MARK = "▁"  # stands for a space in the vocabulary
_PRE_TOKEN = re.compile(f"{_MARK}+[^{_MARK}\n]*|\n[^{_MARK}\n]*")
_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        import sentencepiece

        _ENCODERS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _ENCODERS[path]


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text: a word, a line break with the word that follows it, or, in
    the rare text with runs of spaces, a marked run of spaces with the word that follows."""
    if not text:
        return []
    if _MARK not in text and "  " not in text and " \n" not in text and text[0] not in " \n" and text[-1] != " ":
        return text.replace("\n", " \n").split(" ")
    return _PRE_TOKEN.findall(_MARK + text.replace(" ", _MARK))


def encoded_length(encoder, pre_token: str) -> int:
    """Tokens of one pre-token. The encoder puts one space mark before any text it gets."""
    if pre_token == _MARK:
        return 1
    if pre_token[0] == _MARK:
        return len(encoder.encode(pre_token[1:]))
    return len(encoder.encode(pre_token)) - (pre_token[0] == "\n")


def _slices(texts: pa.Array):
    """(place, slice) of ``texts`` in slices of about ``SLICE_BYTES``."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(texts)]):
        yield int(start), texts.slice(int(start), int(end - start))


def split_plain(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(places of the plain texts, distinct pre-tokens, number of each pre-token in turn, ends per text).

    In a plain text no space stands next to another, before a line break or at an end, so
    that pre-tokens are the parts between spaces, a line break taking its word along.
    ``ends`` starts with 0.
    """
    odd = pc.or_kleene(pc.match_substring(texts, _MARK), pc.match_substring(texts, "  "))
    odd = pc.or_kleene(odd, pc.match_substring(texts, " \n"))
    odd = pc.or_kleene(odd, pc.or_kleene(pc.starts_with(texts, " "), pc.or_kleene(pc.starts_with(texts, "\n"), pc.ends_with(texts, " "))))
    odd = pc.or_kleene(odd, pc.equal(pc.binary_length(texts), 0))
    plain = np.flatnonzero(~pc.fill_null(odd, True).to_numpy(zero_copy_only=False))
    parts = pc.split_pattern(pc.replace_substring(texts.take(pa.array(plain)), "\n", " \n"), " ")
    coded = pc.dictionary_encode(pc.list_flatten(parts))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())]).astype(np.int64)
    return plain, coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), ends


def _odd(texts: pa.Array, plain: np.ndarray) -> np.ndarray:
    """Places of the other texts that are not empty."""
    rest = np.setdiff1d(np.arange(len(texts)), plain)
    filled = pc.fill_null(pc.greater(pc.binary_length(texts), 0), False).to_numpy(zero_copy_only=False)
    return rest[filled[rest]]


def encoded_lengths(encoder, words: list[str]) -> list[int]:
    """Tokens of each pre-token, encoded in one call."""
    encoded = encoder.encode([word[1:] if word[0] == _MARK else word for word in words], num_threads=1)
    return [1 if word == _MARK else len(tokens) - (word[0] == "\n") for word, tokens in zip(words, encoded)]


class Lengths(dict):
    """Lengths of pre-tokens: the broadcast table, and the cache of what has been encoded."""

    def __init__(self, encoder, table: dict[str, int]):
        super().__init__(table)
        self.encoder, self.most = encoder, len(table) + CACHE_SIZE
        self.table = table

    def __missing__(self, pre_token: str) -> int:
        length = encoded_length(self.encoder, pre_token)
        if len(pre_token) <= CACHED_CHARS:
            self[pre_token] = length
        return length

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, pre_tokens(text)))

    def of(self, words: list[str]) -> np.ndarray:
        lengths = list(map(self.get, words))
        missing = [i for i, length in enumerate(lengths) if length is None]
        if missing:
            for i, length in zip(missing, encoded_lengths(self.encoder, [words[i] for i in missing])):
                lengths[i] = length
                if len(words[i]) <= CACHED_CHARS:
                    self[words[i]] = length
        return np.array(lengths, np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens per text. Each distinct pre-token of a slice is looked up once."""
        out = np.zeros(len(texts), np.int64)
        for start, piece in _slices(texts):
            plain, words, which, ends = split_plain(piece)
            if len(which):
                lengths = self.of(words)
                sums = np.concatenate([[0], np.cumsum(lengths[which])])[ends]
                out[start + plain] = np.diff(sums)
            for i in _odd(piece, plain):
                out[start + i] = self.count(piece[int(i)].as_py())
            self.trim()
        return out

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.update(self.table)


def _shrunk(counts: Counter, size: int) -> Counter:
    """The ``size`` most frequent, less the count of the first one left out (Misra-Gries)."""
    if len(counts) <= size:
        return counts
    ranked = counts.most_common(size + 1)
    floor = ranked[-1][1]
    return Counter({word: n - floor for word, n in ranked if n > floor})


def frequent_pre_tokens(docs: DataFrame, text: str = "text", size: int = TABLE_SIZE) -> list[str]:
    """About the ``size`` most frequent pre-tokens of all texts, in no order.

    Every task keeps a summary of fixed size, and summaries are merged ``FAN_IN`` at a time,
    so neither a task nor the driver holds more than ``FAN_IN * size`` entries.
    """

    def summary(part, counts):
        counts = _shrunk(counts, size)
        return pa.RecordBatch.from_pydict(
            {"part": [part], "words": [list(counts)], "counts": [list(counts.values())]},
            schema=pa.schema([("part", pa.int64()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]),
        )

    def summarise(batches):
        from pyspark import TaskContext

        counts: Counter = Counter()
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                plain, words, which, _ = split_plain(texts)
                for word, n in zip(words, np.bincount(which, minlength=len(words)).tolist()):
                    if len(word) <= CACHED_CHARS:
                        counts[word] += n
                for i in _odd(texts, plain):
                    counts.update(word for word in pre_tokens(texts[int(i)].as_py()) if len(word) <= CACHED_CHARS)
                if len(counts) > 8 * size:
                    counts = _shrunk(counts, 2 * size)
        yield summary(TaskContext.get().partitionId(), counts)

    def merge(table):
        counts: Counter = Counter()
        for words, numbers in zip(table.column("words").to_pylist(), table.column("counts").to_pylist()):
            for word, n in zip(words, numbers):
                counts[word] += n
        return pa.Table.from_batches([summary(table.column("part")[0].as_py(), counts)])

    schema = "part long, words array<string>, counts array<long>"
    texts = docs.select(text)
    parts = partition_count(texts)
    summaries = map_texts(texts, summarise, schema)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        summaries = summaries.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(merge, schema)
    return [word for row in summaries.select("words").collect() for word in row[0]]


def token_counts(docs: DataFrame, model_path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), table_size: int = TABLE_SIZE) -> DataFrame:
    """Bytes and tokens of every whole text: ``keep`` columns, ``n_bytes``, ``n_tokens``.

    Counts are what the library's ``encode`` gives, without added tokens. A null text counts
    as empty (0, 0); repeated rows stay repeated; no row is dropped; other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    encoder = _encoder(model_path)
    frequent = [word for word in frequent_pre_tokens(docs, text, table_size) if word]
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, encoded_lengths(encoder, frequent))))
    names = list(keep)

    def count(batches):
        lengths = Lengths(_encoder(model_path), table.value)
        for batch in batches:
            tokens = lengths.counts(batch.column(len(names)))
            arrays = [batch.column(i) for i in range(len(names) + 2) if i != len(names)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(tokens)], [*names, "n_bytes", "n_tokens"])

    value = docs[text]
    read = docs.select(*[docs[name] for name in names], value, F.coalesce(F.octet_length(value), F.lit(0)).cast("long").alias("n_bytes"))
    schema = read.drop(text).schema.add("n_tokens", "long")
    return map_texts(read, count, schema)
