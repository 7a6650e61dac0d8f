"""Spelling variants by finite-state composition.

Two words are near if one edit leads from one to the other. The pairs are those that the
minimised acceptor of the vocabulary, a transducer of exactly one edit and the acceptor again
accept when composed. The composed machine is taken apart by its initial states:

* A pair has a least length m and a first place p at which it differs. Words of length m and
  m + 1 are dealt out by what both must share if p lies in a given span: their beginning up
  to the span and their end after it. Reading that leads to one state, where a partition's
  machine starts. Spans are the two halves of the word; a partition of very many words is
  dealt out again by the halves of its span, down to a single place, where the alphabet
  bounds it. Every pair meets in one partition.
* A task builds the minimal acceptor of what lies between beginning and end, composes it on
  the fly and enumerates the accepted pairs by the rank of their words. A word leaves with
  the number of its near words there and the most frequent one; pairs are never rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import stored

SHORTEST = 5
LEAST_COUNT = 3
#: A form is this many times as frequent as its variant, at least.
DOMINANCE = 2
#: Words of a partition that is searched whole.
PARTITION = 20_000
#: Words of partitions that share a task's group, about.
PACK = 40_000
#: One occurrence in so many loses a letter: the contract's source of variants.
DAMAGED = 97
_RUNS = "[^A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# -- the vocabulary ------------------------------------------------------------


def lower_ascii(text: Column) -> Column:
    """``text`` with A to Z in lower case, nothing else."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(docs: DataFrame, text: str = "text", damaged: int | None = DAMAGED) -> DataFrame:
    """``word``: a row per run of letters, lower case; of one in ``damaged`` a letter is gone."""
    runs = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("_id"), F.explode(F.split(docs[text], _RUNS)).alias("_run"))
    runs = runs.where("_run <> ''").select("_id", lower_ascii(F.col("_run")).alias("word"))
    if damaged is None:
        return runs.select("word")
    hashed = runs.select("word", F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary")).alias("_hash"))
    gone = F.pmod("_hash", F.length("word")).cast("int")
    less = F.concat(F.substring("word", F.lit(1), gone), F.substring("word", gone + 2, F.length("word")))
    return hashed.select(F.when(F.col("_hash") % damaged == 0, less).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of words that are long and frequent enough. Counts combine map-side."""
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


# -- the acceptor and its composition ------------------------------------------


class Acceptor:
    """The minimal acceptor of sorted distinct strings; a word's rank is its place among them."""

    def __init__(self, words: list[str]):
        self.final: list[bool] = []
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.count: list[int] = []
        self._known: dict[tuple, int] = {}
        path: list[list] = [[False, []]]  # of the last word: final, arcs so far
        last = ""
        for word in words:
            same = 0
            while same < len(last) and same < len(word) and last[same] == word[same]:
                same += 1
            self._close(path, last, same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        self.start = self._state(path[0])

    def _close(self, path, last, depth):
        """States below ``depth`` get no further arcs: each becomes its equal if there is one."""
        while len(path) > depth + 1:
            state = self._state(path.pop())
            path[-1][1].append((last[len(path) - 1], state))

    def _state(self, node) -> int:
        key = (node[0], tuple(node[1]))
        if key not in self._known:
            self._known[key] = len(self.final)
            self.final.append(node[0])
            self.arcs.append(key[1])
            self.count.append(node[0] + sum(self.count[to] for _, to in key[1]))
        return self._known[key]

    def ranked(self, state: int, rank: int) -> list[tuple[str, int, int]]:
        """(letter, state, rank of the first word there) of the arcs; ``rank``: of the first word here."""
        rank += self.final[state]
        out = []
        for letter, to in self.arcs[state]:
            out.append((letter, to, rank))
            rank += self.count[to]
        return out

    def common(self, a: int, rank_a: int, b: int, rank_b: int, skip: str | None = None):
        """Ranks of the pairs of words that go on alike from ``a`` and ``b``; ``skip``: not by this letter first."""
        todo = [(a, rank_a, b, rank_b, skip)]
        while todo:
            a, rank_a, b, rank_b, skip = todo.pop()
            if a == b and skip is None:
                yield from zip(range(rank_a, rank_a + self.count[a]), range(rank_b, rank_b + self.count[b]))
                continue
            if self.final[a] and self.final[b]:
                yield rank_a, rank_b
            if self.arcs[a] and self.arcs[b]:
                ways = {letter: (to, rank) for letter, to, rank in self.ranked(b, rank_b)}
                for letter, to, rank in self.ranked(a, rank_a):
                    if letter != skip and letter in ways:
                        todo.append((to, rank, *ways[letter], None))

    def one_edit(self, span: int | None = None):
        """Ranks (shorter or lesser word, other word) of all pairs that differ by one edit.

        Until the edit both copies are in the same state. ``span``: it comes before this place.
        """
        todo = [(self.start, 0, 0)]
        while todo:
            state, rank, depth = todo.pop()
            if span is not None and depth >= span:
                continue
            ways = self.ranked(state, rank)
            for i, (letter, to, at) in enumerate(ways):
                todo.append((to, at, depth + 1))
                for _, other, there in ways[i + 1 :]:  # replaced
                    yield from self.common(to, at, other, there)
                yield from self.common(state, rank, to, at, skip=letter)  # inserted, at the first place that differs


def near_counts(words: list[str], counts: list[int], least: int, prefix: int, suffix: int, span: int):
    """Per word with near words: (word, number of them, count of the first of them, the first).

    ``words`` have ``least`` characters or one more, and share their first ``prefix`` and last
    ``suffix`` characters. Pairs that differ first ``span`` or more places after the
    beginning, and pairs of two longer words, belong elsewhere.
    """
    middles = [word[prefix : len(word) - suffix] for word in words]
    order = sorted(range(len(words)), key=middles.__getitem__)
    words, counts = [words[i] for i in order], [counts[i] for i in order]
    machine = Acceptor([middles[i] for i in order])
    near, best = [0] * len(words), [None] * len(words)
    for a, b in machine.one_edit(span):
        if len(words[a]) > least and len(words[b]) > least:
            continue
        for x, y in ((a, b), (b, a)):
            near[x] += 1
            if best[x] is None or (-counts[y], words[y]) < (-counts[best[x]], words[best[x]]):
                best[x] = y
    return [(words[x], near[x], counts[y], words[y]) for x, y in enumerate(best) if y is not None]


# -- partitions ------------------------------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """Rows (word, n, least, low, high) for each half of their span, with what the words there share.

    The first difference lies from ``low`` on and before ``high``, which is ``least + 1`` where
    the last letter may be the edit.
    """
    middle = F.floor((F.col("low") + F.least("high", "least")) / 2).cast("int")
    halves = F.array(
        F.struct(F.col("low").alias("low"), middle.alias("high")),
        F.struct(middle.alias("low"), F.col("high").alias("high")),
    )
    dealt = rows.select("word", "n", "least", F.explode(halves).alias("half")).where("half.low < half.high")
    dealt = dealt.select("word", "n", "least", "half.low", "half.high")
    tail = F.greatest(F.col("least") - F.col("high"), F.lit(0))
    start = F.substring("word", F.lit(1), F.col("low"))
    end = F.substring("word", F.length("word") - tail + 1, tail)
    # Letters only, so the line break tells beginning and end apart.
    return dealt.withColumn("shared", F.concat_ws("\n", "least", "low", "high", start, end))


def _searched(packed: DataFrame) -> DataFrame:
    def search(table):
        rows = table.sort_by("shared")
        shared = rows.column("shared").to_pylist()
        words, counts = rows.column("word").to_pylist(), rows.column("n").to_pylist()
        place = {name: rows.column(name).to_numpy() for name in ("least", "low", "high")}
        cuts = np.flatnonzero([True] + [a != b for a, b in zip(shared, shared[1:])] + [True])
        out = []
        for start, end in zip(cuts, cuts[1:]):
            if end - start > 1:
                least, low, high = (int(place[name][start]) for name in ("least", "low", "high"))
                out += near_counts(words[start:end], counts[start:end], least, low, max(least - high, 0), high - low)
        names = ["word", "n_near", "form_n", "form"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        return pa.table({name: pa.array([row[i] for row in out], kind) for i, (name, kind) in enumerate(zip(names, kinds))})

    return packed.groupBy("pack").applyInArrow(search, "word string, n_near long, form_n long, form string")


def near_words(vocabulary: DataFrame, partition: int = PARTITION, shortest: int = SHORTEST) -> DataFrame:
    """``word, n_near, first``: words with near words, how many, and (form_n, form) of the first.

    First is the most frequent, of equal ones the least in code-point order. A round deals out
    and searches; partitions over ``partition`` words go to the next one.
    """
    size = F.length("word").cast("int")
    rows = vocabulary.select("word", "n", F.explode(F.array(size, size - 1)).alias("least")).where(F.col("least") >= shortest)
    rows = rows.select("word", "n", "least", F.lit(0).alias("low"), (F.col("least") + 1).alias("high"))
    found = []
    while True:
        dealt = stored(_halves(rows), "partitions")
        sizes = stored(dealt.groupBy("shared").agg(F.count("*").alias("_size")).where("_size > 1"), "sizes")
        # A span of one place can't be halved: there the alphabet bounds a partition.
        sized = lookup_join(dealt, sizes, "shared", "inner").withColumn("_whole", (F.col("_size") <= partition) | (F.least("high", "least") - F.col("low") <= 1))
        held = sizes.agg(F.sum(F.least("_size", F.lit(partition)))).first()[0] or 0
        pack = F.pmod(F.xxhash64("shared"), F.lit(max(1, held // PACK)))
        whole = sized.where("_whole").select("shared", "word", "n", "least", "low", "high", pack.alias("pack"))
        found.append(stored(_searched(whole), "found"))
        rows = sized.where("NOT _whole").select("word", "n", "least", "low", "high")
        if rows.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    first = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    near = every.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return near.select("word", "n_near", F.struct((-F.col("first.less")).alias("form_n"), F.col("first.form").alias("form")).alias("first"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word that following ``form`` from ``word`` leads to.

    Every round doubles the steps that a row has made. A form is more frequent than its
    variants by a factor, so chains are short and never closed.
    """
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = lookup_join(current, ahead, "root", "left")
        if moved.where("next IS NOT NULL").isEmpty():
            return current
        current = stored(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, text: str = "text", damaged: int | None = DAMAGED, partition: int = PARTITION) -> DataFrame:
    """A row per word: ``word, form, root, n, n_near, form_n``.

    Words are runs of letters (A to Z and U+00C0 to U+00FF) of all texts, A to Z lower-cased,
    of ``SHORTEST`` characters and ``LEAST_COUNT`` occurrences at least. ``form`` is the near
    word that comes first by count, then in code-point order, if it is ``DOMINANCE`` times as
    frequent; ``root`` follows forms to the last. A null text has no words; a null doc_id
    counts as empty where letters are taken away; repeated rows count as often as they come.
    An empty table gives an empty result. Other columns are not read.
    """
    known = stored(vocabulary(words_of(docs, text, damaged)), "vocabulary")
    near = near_words(known, partition)
    form = F.when(F.col("first.form_n") >= DOMINANCE * F.col("n"), F.col("first"))
    rows = known.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("_form"))
    rows = stored(rows.select("word", "n", "n_near", F.col("_form.form").alias("form"), F.col("_form.form_n").alias("form_n")), "forms")
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
