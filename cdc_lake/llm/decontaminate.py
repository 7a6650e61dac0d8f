"""Benchmark passages in documents, found by pieces and verified by edit distance.

An item of n characters may differ in k = n // 20 edits. Cut into k + 1 pieces, at least one
piece of every occurrence is untouched, so exact hits of pieces find all of them. A hit fixes
where the item would lie; Myers' bit-parallel distance decides there. Texts are compared in
lower case, with every run of other characters than letters and digits as one space.

Benchmark items are taken in blocks of bounded size. Each block is broadcast as an automaton
of pieces, and all documents are searched for it whole, without a shuffle.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import map_texts, renamed, restored

#: One edit is allowed for so many characters.
CHARS_PER_EDIT = 20
#: Characters of benchmark text in one block, about: what a broadcast and an automaton hold.
BLOCK_CHARS = 2_000_000


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length that cover ``item``, with their places."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(item: str, window: str) -> tuple[int, int]:
    """Least edit distance of ``item`` to any substring of ``window``, and where that ends."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, distance = full, 0, m
    best, end = m, 0
    for at, c in enumerate(window):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & last:
            distance += 1
        elif mh & last:
            distance -= 1
        ph, mh = ph << 1, mh << 1
        plus = (mh | ~(xv | ph)) & full
        minus = ph & xv
        if distance < best:
            best, end = distance, at + 1
    return best, end


def merged(windows: list[list[int]]) -> list[tuple[int, int]]:
    """The union of ``windows`` as windows that lie apart."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(map(tuple, windows)):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


class Finder:
    """Items of a block, searched together."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = items
        self.budgets = [len(text) // CHARS_PER_EDIT for _, text in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(items):
            for place, piece in pieces(text, self.budgets[number]):
                places.setdefault(piece, []).append((number, place + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """Number of the item -> least distance, for the items that ``text`` holds.

        The places where hits put an item are merged into windows that do not overlap, and
        each is searched once: a text that repeats a piece costs no more than its length.
        """
        found: dict[int, int] = {}
        windows: dict[int, list[list[int]]] = {}
        for end, where in self.automaton.iter(text):
            for number, offset in where:
                item, budget = self.items[number][1], self.budgets[number]
                start = end - offset
                if not budget:
                    if number not in found and self._apart(text, start, len(item)):
                        found[number] = 0
                    continue
                low, high = max(0, start - budget), start + len(item) + budget
                held = windows.setdefault(number, [])
                if held and low <= held[-1][1] and high >= held[-1][0]:
                    held[-1] = [min(low, held[-1][0]), max(high, held[-1][1])]
                else:
                    held.append([low, high])
        for number, held in windows.items():
            item, budget = self.items[number][1], self.budgets[number]
            best = 0 if item in text else budget + 1
            if best:
                for low, high in merged(held):
                    best = min(best, myers(item, text[low:high])[0])
            if best <= budget:
                found[number] = best
        return found

    @staticmethod
    def _apart(text: str, start: int, length: int) -> bool:
        """An item without budget counts as whole words only."""
        end = start + length
        return (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " ")


def _blocks(benchmark: DataFrame, text: str):
    """Broadcast lists of (item_id, normal text), each of about ``BLOCK_CHARS`` characters."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), normal(benchmark[text]).alias("_item"))
    items = items.where("_item <> '' AND item_id IS NOT NULL").distinct()
    n = -(-(items.agg(F.sum(F.length("_item"))).first()[0] or 0) // BLOCK_CHARS)
    for block in range(n):
        rows = items.where(F.pmod(F.xxhash64("_item"), F.lit(n)) == block).collect()
        if rows:
            yield benchmark.sparkSession.sparkContext.broadcast(sorted((row[0], row[1]) for row in rows))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """A row per document and benchmark item that it holds: ``doc_id, item_id, distance, budget``.

    ``distance`` is the least number of edits at any place. A null or empty text or item holds
    and matches nothing; an item under 20 characters must occur exactly, as whole words. Items
    of equal text each count; repeated documents each give their rows. Without matches, or
    with an empty table on either side, the result is empty.
    """
    schema = "doc_id long, item_id long, distance long, budget long"
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), normal(docs[text]).alias("_text"))
    found = None

    def search(items):
        def run(batches):
            finder = Finder(items.value)
            for batch in batches:
                out = []
                for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    out += [(doc_id, items.value[i][0], d, finder.budgets[i]) for i, d in sorted(finder.find(value).items())]
                columns = [pa.array(x, pa.int64()) for x in (zip(*out) if out else ([], [], [], []))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "budget"])

        return run

    for items in _blocks(benchmark, item_text):
        part = map_texts(rows, search(items), schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns kept, whatever their names; no shuffle."""
    rows, names = renamed(docs)
    columns = rows.columns

    def clean(items):
        def run(batches):
            finder = Finder(items.value)
            for batch in batches:
                keep = pa.array([not finder.find(value) for value in batch.column(len(columns)).to_pylist()], pa.bool_())
                yield pa.RecordBatch.from_arrays(batch.columns[: len(columns)], columns).filter(keep)

        return run

    schema = rows.schema
    for items in _blocks(benchmark, item_text):
        rows = map_texts(rows.select("*", normal(F.col(names[text])).alias("_normal_text")), clean(items), schema)
    return rows.select(restored(names, []))
