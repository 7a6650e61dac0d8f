"""Join of documents whose sets of word 5-grams overlap by 0.8 or more (Jaccard).

1. Copies: rows whose words are equal are one text, whatever their ids; the row of the least
   doc_id stands for it.
2. MinHash banding: bands and rows per band follow from the recall wanted; texts that share
   the hash of a band get linked to the least one there, and components of those links are
   the groups to verify.
3. Verification on whole sets: a group is dealt out in blocks of two chunks of bounded size,
   and the pairs of a block are counted inside its task. What leaves a task is a row per text:
   its number of links and the least text it is joined to. Pairs are never rows.
4. Components of the verified links are the classes.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.bitmaps import id_bitmaps, with_id_in, with_id_not_in
from ..operators.joins import lookup_join
from .common import map_texts, renamed, restored, stored
from .components import components

WIDTH = 5
SIMILARITY = 0.8
#: Chance that a pair at the limit shares a band.
RECALL = 0.999
ROWS = 6
#: Texts of a group in one chunk, and shingles of them, about; a block has two chunks.
CHUNK = 256
CHUNK_GRAMS = 1 << 20
#: Texts of small groups that share a task.
PACK = 256
#: Bits per key of the bitmap that rows are looked up in before a join, and bits of it at most (8 MB).
KEY_BITS = 16
MOST_BITS = 1 << 26
#: Words whose hashes a worker keeps, from one task to the next, before it starts anew.
KEPT_WORDS = 1 << 15
_WORD = re.compile(r"\w+")
_COLUMNS = 4096


def bands_for(recall: float = RECALL, rows: int = ROWS, similarity: float = SIMILARITY) -> int:
    """Bands of ``rows`` rows, so that a pair of ``similarity`` shares one with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word windows of a text, lower case, words only.

    A text of fewer words is one window; one without words has none.
    """
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, np.uint64)
    hashes = _word_hashes(words)
    n = max(1, len(words) - width + 1)
    out = np.full(n, len(words) if len(words) < width else width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(width, len(words))):
            out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return np.unique(out)


_HASHES: dict[str, int] = {}


def _word_hashes(words: list[str]) -> np.ndarray:
    get, out = _HASHES.get, []
    for word in words:
        value = get(word)
        if value is None:
            if len(_HASHES) >= KEPT_WORDS:
                _HASHES.clear()
            value = _HASHES[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        out.append(value)
    return np.array(out, np.uint64)


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(5)
    return random.integers(1, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, n, np.uint64)


def _signed(texts: list[str | None], bands: int, rows: int):
    """(digest, band hashes, number of shingles) per text; nulls for a text without words."""
    times, plus = _multipliers(bands * rows)
    for text in texts:
        grams = shingles(text)
        if not len(grams):
            yield None, None, None
            continue
        with np.errstate(over="ignore"):
            least = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
            for start in range(0, len(grams), _COLUMNS):
                np.minimum(least, (grams[start : start + _COLUMNS, None] * times + plus).min(0), out=least)
            keys = np.arange(bands, dtype=np.uint64)
            for row in least.reshape(bands, rows).T:
                keys = (keys ^ row) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(31)
        words = " ".join(_WORD.findall(text.lower()))
        yield hashlib.md5(words.encode()).digest(), keys.view(np.int64).tolist(), len(grams)


def _signatures(docs: DataFrame, text: str, bands: int, rows: int) -> DataFrame:
    def sign(batches):
        for batch in batches:
            signed = list(_signed(batch.column(1).to_pylist(), bands, rows))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:1], *(pa.array([s[i] for s in signed], kind) for i, kind in enumerate(kinds))],
                ["first", "digest", "bands", "n_grams"],
            )

    kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64()]
    first = F.struct(*_row_key(docs["doc_id"], docs[text]))
    return map_texts(
        docs.select(first.alias("first"), docs[text]), sign, "first struct<doc_id: long, text_hash: long>, digest binary, bands array<long>, n_grams long"
    )


def block_links(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray, similarity: float = SIMILARITY):
    """Links between the sets numbered ``first`` and ``second`` (equal: within): pairs of places."""
    if len(sets) == 2:
        shared = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))]] * 2).astype(np.float32)
        shared[1, 0] = shared[0, 1]
    else:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        often = times > 1
        column = np.cumsum(often) - 1
        keep = often[place]
        owner, place = owner[keep], column[place[keep]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(often.sum()), _COLUMNS):
            at = slice(*np.searchsorted(place, [start, start + _COLUMNS]))
            held = np.zeros((len(sets), _COLUMNS), np.float32)
            held[owner[at], place[at] - start] = 1
            shared += held @ held.T
    sizes = np.array([len(s) for s in sets], np.float64)
    inside = shared[np.ix_(first, second)].astype(np.float64)
    linked = inside >= similarity * (sizes[first][:, None] + sizes[second][None, :] - inside) - 1e-6
    if first is second:
        linked &= np.triu(np.ones(linked.shape, bool), 1)
    a, b = np.nonzero(linked)
    return first[a], second[b]


def _verify(table: pa.Table) -> pa.Table:
    """Per text of the blocks in ``table``: its links here, and the least text it is joined to."""
    rows = {name: table.column(name).to_pylist() for name in ("node", "root", "chunk", "i", "j")}
    sets = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
    groups: dict[tuple, list[int]] = {}
    for place, key in enumerate(zip(rows["root"], rows["i"], rows["j"])):
        groups.setdefault(key, []).append(place)
    nodes, roots, counts = [], [], []
    for (_, i, j), places in groups.items():
        if len(places) < 2:
            continue
        chunk = np.array([rows["chunk"][p] for p in places])
        first = np.flatnonzero(chunk == i)
        a, b = block_links([sets[p] for p in places], first, first if i == j else np.flatnonzero(chunk == j))
        if not len(a):
            continue
        ids = np.array([rows["node"][p] for p in places], np.int64)
        count = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
        least = ids.copy()
        while True:
            before = least.copy()
            np.minimum.at(least, a, before[b])
            np.minimum.at(least, b, before[a])
            if (before == least).all():
                break
        for place in np.flatnonzero(count):
            nodes.append(int(ids[place]))
            roots.append(int(least[place]))
            counts.append(int(count[place]))
    return pa.table({"node": pa.array(nodes, pa.int64()), "root": pa.array(roots, pa.int64()), "links": pa.array(counts, pa.int64())})


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    """What names a row: its doc_id, and a hash of its text, should an id have several."""
    return [doc_id.cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash")]


def _looked_up(rows: DataFrame, keys: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """The ``rows`` that may have one of ``keys``, and those that surely have none: no row is shuffled to tell.

    A bitmap of hashed keys is looked up, so some rows without a key are among the first: an exact
    join on ``names`` has to follow. Its size is bounded; beyond four million keys there are more of them.
    """
    place = F.pmod(F.xxhash64(*names), F.lit(min(MOST_BITS, KEY_BITS * max(1, keys.count()))))
    marks = stored(id_bitmaps(keys.select(place.alias("_place")), "_place"), "marks")
    placed = rows.withColumn("_place", place)
    return with_id_in(placed, marks, "_place").drop("_place"), with_id_not_in(placed, marks, "_place").drop("_place")


def _members(docs: DataFrame, text: str, groups: DataFrame) -> DataFrame:
    """Whole shingle sets of the texts in ``groups``, one row per text, read from the row that ``first`` names."""
    key = ["doc_id", "text_hash"]
    texts, _ = _looked_up(docs.select(*_row_key(docs["doc_id"], docs[text]), docs[text].alias("_text")), groups.select("first.*"), key)
    names = [name for name in groups.columns if name != "first"]
    chosen = texts.join(groups.select("first.*", *names), key).dropDuplicates([*key, "node"]).select("_text", *names)

    def build(batches):
        for batch in batches:
            grams = pa.array([shingles(value).tobytes() for value in batch.column(0).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], grams], [*names, "grams"])

    return map_texts(chosen, build, chosen.drop("_text").schema.add("grams", "binary"))


def _chunked(groups: DataFrame) -> DataFrame:
    """``groups`` with the number of chunks of the group, and the chunk of the text."""
    chunks = F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("n_grams") / CHUNK_GRAMS)).cast("int")
    sized = lookup_join(groups, groups.groupBy("root").agg(chunks.alias("chunks")), "root", "inner")
    return sized.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))


def _blocks(members: DataFrame, packs: int) -> DataFrame:
    """A row for each block that a text belongs to, and the pack that the block is in."""
    dealt = members.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("i", F.least("chunk", "_other")).withColumn("j", F.greatest("chunk", "_other"))
    pack = F.when(F.col("chunks") > 1, F.xxhash64("root", "i", "j")).otherwise(F.pmod(F.xxhash64("root"), F.lit(packs)))
    return dealt.select("node", "root", "grams", "chunk", "i", "j", pack.alias("pack"))


def _packs(groups: DataFrame) -> int:
    """Packs for the groups of one chunk: of few texts, and of few shingles."""
    texts, grams = groups.where("chunks = 1").agg(F.count("*"), F.sum("n_grams")).first()
    return max(1, texts // PACK, (grams or 0) // CHUNK_GRAMS)


def _classified(docs: DataFrame, text: str, recall: float, rows: int) -> DataFrame:
    """``first`` (doc_id, text_hash) of each row, of its text's first row (``rep``) and its class's (``head``), and the counts."""
    signed = stored(_signatures(docs, text, bands_for(recall, rows), rows), "signatures")
    usable = signed.where("digest IS NOT NULL AND first.doc_id IS NOT NULL")
    texts = usable.groupBy("digest").agg(F.min("first").alias("first"), F.count("*").alias("n_copies"), F.first("n_grams").alias("n_grams"))
    texts = stored(texts.withColumn("node", F.monotonically_increasing_id()), "texts")

    keys = usable.join(texts.select("first", "node"), "first").select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("node").alias("other"), F.max("node").alias("_last")).where("other < _last").drop("_last")
    linked = lookup_join(keys, shared, "band", "inner").select("node", "other").distinct()
    groups = stored(_chunked(components(linked).join(texts.select("node", "first", "n_grams"), "node")), "groups")

    blocks = _blocks(_members(docs, text, groups.drop("n_grams")), _packs(groups))
    verified = blocks.groupBy("pack").applyInArrow(_verify, "node long, root long, links long")
    verified = stored(verified, "verified")
    classes = stored(components(verified.select("node", F.col("root").alias("other"))), "classes")
    links = verified.groupBy("node").agg(F.sum("links").alias("n_links"))
    heads = classes.join(texts.select("node", "first"), "node").groupBy("root").agg(F.min("first").alias("head"))
    joined = links.join(classes, "node").join(heads, "root").select("node", "n_links", "head")

    info = texts.join(joined, "node", "left").select(
        "digest", F.col("first").alias("rep"), F.coalesce("head", "first").alias("head"), "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    counted = lookup_join(usable.select("first", "digest"), info, "digest", "inner").select("first", "head", "rep", "n_copies", "n_links")
    own = F.col("first")
    alone = signed.where("digest IS NULL OR first.doc_id IS NULL").select(
        own, own.alias("head"), own.alias("rep"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links")
    )
    return counted.unionByName(alone)


def jaccard_join(docs: DataFrame, text: str = "text", recall: float = RECALL, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, rep_id, n_copies, n_links``.

    ``rep_id`` is the least doc_id with the same words, ``n_copies`` the number of rows with
    them, ``n_links`` the number of other texts that it is linked to directly, ``class_id`` the
    least doc_id that links lead to. A text without words (or null) and a row without doc_id
    stand alone: their own doc_id, one copy, no link. Rows of equal doc_id and different texts
    are judged apart; repeated rows stay and count as copies. An empty table gives an empty
    result. Other columns are not read.
    """
    number = lambda name: F.col(name)["doc_id"]
    found = _classified(docs, text, recall, rows)
    return found.select(number("first").alias("doc_id"), number("head").alias("class_id"), number("rep").alias("rep_id"), "n_copies", "n_links")


def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row of ``docs`` per class: the one with the least doc_id. Rows without doc_id stay.

    Of rows with equal doc_id and text one stays; of rows with equal doc_id and different texts
    one per class. All columns are kept, whatever their names. What joins the documents are the
    keys of the rows that leave and of repeated rows; the text of other rows is not shuffled.
    """
    rows, names = renamed(docs)
    found = stored(_classified(docs, text, RECALL, ROWS).where("first.doc_id IS NOT NULL").select("first", "head"), "classified")
    key = ["_id", "_hash"]
    leave = found.where("first <> head").select("first.*").toDF(*key).distinct()
    again = found.groupBy("first").count().where("count > 1").select("first.*").toDF(*key)
    keyed = rows.withColumns(dict(zip(key, _row_key(F.col(names["doc_id"]), F.col(names[text])))))
    asked, untouched = _looked_up(keyed, leave.unionByName(again), key)
    kept = asked.join(leave, key, "left_anti")
    once, more = kept.join(again, key, "left_anti"), kept.join(again, key, "left_semi").dropDuplicates(key)
    return untouched.unionByName(once).unionByName(more).select(restored(names, []))
