"""Near duplicates by SimHash fingerprints, searched in BK-trees.

Equal fingerprints are one entry. Entries are dealt out to shards: two fingerprints that
differ in at most 3 of 64 bits agree on one quarter at least, so the 16 bits of each quarter
name a shard, and every link lies inside one. A shard is a BK-tree, whose children are keyed
by their Hamming distance to the parent; a query follows only the edges within the radius
of its own distance. A shard of many entries is split again, by quarters of the bits that it
doesn't share yet. Where that no longer helps, the shard's trees of bounded size are sent to
blocks of its queries. What leaves a task is a link per entry at most, to the least entry it
is joined to there; pairs are never rows, and fingerprints never pass the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import lookup_join
from .common import stored
from .components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Entries of a shard that is searched whole, and of a tree where one is split into blocks.
SHARD = 4096
#: Entries of shards that share a task's group, about.
PACK = 40_000
#: How often a shard is split by further bits before its queries are searched in blocks.
SPLITS = 3
#: Bytes of a text that are cut into words at once, and shingles whose bits are summed at once.
_PIECE, _FLUSH = 1 << 20, 1 << 17
_SPACES = b" \t\n\x0b\x0c\r"
_EDGES = 65


# -- fingerprints ------------------------------------------------------------


def _pieces(text: bytes):
    """``text`` in pieces of about ``_PIECE`` bytes that end before a space."""
    start = 0
    while start < len(text):
        end = min(start + _PIECE, len(text))
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        yield text[start:end]
        start = end


def _hashes(words: list[bytes]) -> list[int]:
    """Hashes of all windows of ``SHINGLE`` words; of the whole sequence if it is shorter."""
    joined, place, ends = b" ".join(words), -1, []
    for word in words:
        place += len(word) + 1
        ends.append(place)
    hash_of = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return [hash_of(joined, SEED)] if words else []
    starts = [0] + [end + 1 for end in ends]
    return [hash_of(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :])]


def shingle_hashes(text: str | None):
    """Lists of the hashes of a text's shingles, repeats included, a list per piece of the text."""
    kept: list[bytes] = []
    fresh, first = 0, True
    for piece in _pieces((text or "").encode().lower()):
        words = piece.split()
        fresh += len(words)
        kept = kept[-(SHINGLE - 1) :] + words
        if len(kept) >= SHINGLE and words:
            yield _hashes(kept)
            first = False
    if first and fresh:
        yield _hashes(kept)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """A 64-bit fingerprint per text: a bit is set if over half of the hashes have it; 0 without words."""
    ones, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    waiting, owners, sizes = [], [], []

    def flush():
        bits = np.unpackbits(np.array(waiting, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))

    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text):
            waiting += hashes
            owners.append(i)
            sizes.append(len(hashes))
            totals[i] += len(hashes)
            if len(waiting) >= _FLUSH:
                flush()
                waiting, owners, sizes = [], [], []
    if waiting:
        flush()
    return np.packbits(2 * ones > totals[:, None], axis=1).view(">u8").astype(np.uint64).ravel()


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, bits``: the fingerprint as a signed long."""

    def sign(batches):
        for batch in batches:
            bits = fingerprints(batch.column(1).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), docs[text]).mapInArrow(sign, "doc_id long, bits long")


# -- trees -------------------------------------------------------------------


class Forest:
    """BK-trees over 64-bit numbers, one per shard, as arrays.

    ``shards`` numbers the shard of each entry, from 0 up; entries of a shard differ. All
    trees grow a level at a time: of the entries that come to a node by the same edge, the
    first becomes its child, the others go on below that child.
    """

    def __init__(self, bits: np.ndarray, shards: np.ndarray):
        self.bits = bits
        self.roots = np.full(int(shards.max()) + 1 if len(shards) else 0, -1, np.int64)
        names, first = np.unique(shards, return_index=True)
        self.roots[names] = first
        at = np.setdiff1d(np.arange(len(bits)), first, assume_unique=True)
        above = self.roots[shards[at]]
        edges, children = [], []
        while len(at):
            edge = above * _EDGES + self.distance(bits[at], bits[above])
            keys, lead, group = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(keys)
            children.append(at[lead])
            below = np.ones(len(at), bool)
            below[lead] = False
            above, at = at[lead][group][below], at[below]
        edges, children = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (edges, children))
        order = np.argsort(edges, kind="stable")
        self.edges, self.children = edges[order], children[order]

    @staticmethod
    def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).astype(np.int64)

    def search(self, bits: np.ndarray, shards: np.ndarray, radius: int = RADIUS):
        """Numbers (query, entry) within ``radius``, as two arrays."""
        query, node = np.arange(len(bits)), self.roots[shards]
        found = []
        while len(query):
            far = self.distance(bits[query], self.bits[node])
            near = far <= radius
            found.append((query[near], node[near]))
            low = np.searchsorted(self.edges, node * _EDGES + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edges, node * _EDGES + np.minimum(far + radius, _EDGES - 1), "right")
            ways = high - low
            query = np.repeat(query, ways)
            steps = np.arange(len(query)) - np.repeat(np.cumsum(ways) - ways, ways)
            node = self.children[np.repeat(low, ways) + steps]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([n for _, n in found])


def _merged(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``least`` numbers of groups, with the groups of each ``a`` and ``b`` made one."""
    while True:
        x, y = least[a], least[b]
        apart = x != y
        if not apart.any():
            return least
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:  # every entry points to the head of its group
            head = least[least]
            if (head == least).all():
                break
            least = head


def _links(shards: np.ndarray, bits: np.ndarray, query: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, bits of the least entry joined to it) of entries with links inside their shards.

    ``query`` and ``entry`` tell which rows are searched for and which are in the trees.
    """
    order = np.lexsort((bits.view(np.int64), shards))  # a group's first is its least
    shards, bits, query, entry = shards[order], bits[order], query[order], entry[order]
    shards = np.unique(shards, return_inverse=True)[1]
    held, asked = np.flatnonzero(entry), np.flatnonzero(query)
    if not len(held) or not len(asked):
        return bits[:0], bits[:0]
    forest = Forest(bits[held], shards[held])
    asked = asked[np.isin(shards[asked], shards[held])]
    least = np.arange(len(bits))
    for start in range(0, len(asked), 512):
        part = asked[start : start + 512]
        a, b = forest.search(bits[part], shards[part])
        least = _merged(least, part[a], held[b])
    moved = np.flatnonzero(least != np.arange(len(bits)))
    return bits[moved], bits[least[moved]]


# -- shards ------------------------------------------------------------------


def quarters(mask: int) -> list[int]:
    """``mask`` of bits that a shard shares, and each time a quarter of the other bits."""
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cuts = [len(free) * i // 4 for i in range(5)]
    return [mask | sum(1 << bit for bit in free[low:high]) for low, high in zip(cuts, cuts[1:]) if high > low]


def _long(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def _split(rows: DataFrame, masks: list[int]) -> DataFrame:
    """``bits`` of each row under the finer masks of its shard: ``mask, shared, bits``."""
    finer = F.create_map(*[x for mask in masks for x in (_long(mask), F.array(*[_long(m) for m in quarters(mask)]))])
    dealt = rows.select("bits", F.explode(finer[F.col("mask")]).alias("mask"))
    return dealt.select("mask", F.col("mask").bitwiseAND(F.col("bits")).alias("shared"), "bits")


def _searched(packed: DataFrame) -> DataFrame:
    """``node, other`` links inside the shards of each pack."""

    def search(table):
        number = lambda name: table.column(name).to_numpy()
        shards = np.unique(np.stack([number(c) for c in ("mask", "shared", "i", "j")]), axis=1, return_inverse=True)[1].ravel()
        bits, chunk = number("bits").view(np.uint64), number("chunk")
        node, other = _links(shards, bits, chunk == number("j"), chunk == number("i"))
        return pa.table({"node": pa.array(node.view(np.int64)), "other": pa.array(other.view(np.int64))})

    return packed.groupBy("pack").applyInArrow(search, "node long, other long")


def links(entries: DataFrame, shard: int = SHARD, splits: int = SPLITS) -> DataFrame:
    """``node, other`` links that join all ``bits`` of ``entries`` (distinct) within the radius.

    A chain of links, not all pairs: those within the radius of each other get joined.
    """
    masks, found = [0], []
    rows = entries.select("bits", F.lit(0).cast("long").alias("mask"))
    for step in range(splits + 1):
        dealt = stored(_split(rows, masks), "shards")
        masks = [m for mask in masks for m in quarters(mask)]
        sizes = dealt.groupBy("mask", "shared").agg(F.count("*").alias("size")).where("size > 1")
        sizes = stored(sizes.select(F.struct("mask", "shared").alias("_shard"), "size"), "sizes")
        held = sizes.where(F.col("size") <= shard).agg(F.sum("size")).first()[0] or 0
        sized = lookup_join(dealt.withColumn("_shard", F.struct("mask", "shared")), sizes, "_shard", "inner").drop("_shard")
        one = F.lit(0).cast("long")
        pack = F.pmod(F.xxhash64("mask", "shared"), F.lit(max(1, held // PACK)))
        small = sized.where(F.col("size") <= shard).select("mask", "shared", "bits", one.alias("chunk"), one.alias("i"), one.alias("j"), pack.alias("pack"))
        found.append(stored(_searched(small), "found"))
        if sizes.where(F.col("size") > shard).isEmpty():
            break
        large = sized.where(F.col("size") > shard)
        if step < splits:
            rows = large.select("bits", "mask")
        else:
            found.append(stored(_searched(_blocks(large, shard)), "found"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _blocks(large: DataFrame, shard: int) -> DataFrame:
    """Trees of about ``shard`` entries, each sent to every block of its shard's queries."""
    chunks = F.ceil(F.col("size") / shard).cast("long")
    chunked = large.withColumn("_chunks", chunks).withColumn("chunk", F.pmod(F.xxhash64("bits"), F.col("_chunks")))
    met = chunked.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)))
    met = met.withColumn("i", F.least("chunk", "_other")).withColumn("j", F.greatest("chunk", "_other"))
    return met.select("mask", "shared", "bits", "chunk", "i", "j", F.xxhash64("mask", "shared", "i", "j").alias("pack"))


def simhash_dedup(docs: DataFrame, text: str = "text", shard: int = SHARD, splits: int = SPLITS) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Words are runs without space or tab to carriage return, A to Z lower-cased; shingles are
    three of them, or all if there are fewer. Texts without words (null or empty ones too)
    have fingerprint zero and are linked like any other. ``component_id`` is the least doc_id
    that links of ``RADIUS`` bits or fewer lead to. Rows without doc_id are linked too and
    get the component's id, null if no row in it has one. Repeated rows stay repeated, rows
    of one doc_id and different texts are judged apart; an empty table gives an empty result.
    Other columns are not read.
    """
    signed = stored(with_fingerprints(docs, text), "fingerprints")
    entries = stored(signed.groupBy("bits").agg(F.min("doc_id").alias("least")), "entries")
    roots = components(links(entries, shard, splits)).withColumnRenamed("node", "bits")
    placed = entries.join(roots, "bits", "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    placed = stored(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of_bits = lookup_join(placed, ids, "root", "inner").select("bits", "component_id")
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return lookup_join(signed, of_bits, "bits", "inner").select("doc_id", shown.alias("fingerprint"), "component_id")
