"""Toxic spans by a linear-chain conditional random field, and a score per document.

Labels say which documents are toxic, not where. Words and word beginnings that set apart
toxic documents of a bounded sample label its tokens; a two-state chain over sentences learns
from them (hashed word, prefix, suffix and shape features, and transitions). Forward-backward
marginals of every token of every text give the offending offsets, and sums of them a
document's score, calibrated on a third of the sample that they are not learned from.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .jaccard_join import shingles

#: The sample to fit on: so many labelled documents of each class, of at most so many characters.
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 60_000
THRESHOLD = 0.7
#: A token counts as offending from this marginal on.
OFFENDING = 0.5
#: A sign of toxicity: in so many toxic documents, at such odds against the others.
LEAST_DOCUMENTS, LEAST_ODDS = 4, 12.0

_TOKEN = re.compile(r"\w+|[.!?\n]+")
_BITS = 18
_CACHE = 400_000


def _hash(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) >> 32 - _BITS


def signs(word: str) -> list[str]:
    """A lower-case word, and its beginnings: what may set toxic documents apart."""
    return ["w=" + word, *["p=" + word[:n] for n in (4, 5, 6, 7) if len(word) > n]]


def features(token: str) -> list[int]:
    word = token.lower()
    shape = "s=caps" if token.isupper() and len(token) > 1 else "s=title" if token[:1].isupper() else "s=low"
    return [_hash(f) for f in (*signs(word), "p=" + word[:3], "e=" + word[-3:], "e=" + word[-4:], shape, "bias")]


def _expand(count: int, starts: np.ndarray, sizes: np.ndarray):
    """Per step: the places of all sequences that are so long, longest sequences first."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    longer = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    return [starts[:n] + t for t, n in enumerate(longer)]


def marginals(odds: np.ndarray, starts: np.ndarray, sizes: np.ndarray, move: np.ndarray, pairs: bool = False):
    """Chance of the toxic state for each token; with ``pairs`` also expected transitions.

    ``odds``: log-odds of the state from a token's features; ``move``: 2 x 2 log weights, from
    by to. State 1 is toxic. Sequences lie in ``odds`` from ``starts`` on.
    """
    boost = np.exp(np.clip(odds, -30, 30))
    m = np.exp(move)
    steps = _expand(len(odds), starts, sizes)
    ahead = np.zeros(len(odds))
    last = None
    for at in steps:
        if last is None:  # no transition leads to a first token
            one, zero = boost[at], 1.0
        else:
            p = ahead[last[: len(at)]]
            one, zero = boost[at] * ((1 - p) * m[0, 1] + p * m[1, 1]), (1 - p) * m[0, 0] + p * m[1, 0]
        ahead[at] = one / (one + zero)
        last = at
    back = np.full(len(odds), 0.5)
    for at, after in zip(steps[-2::-1], steps[:0:-1]):
        b, e = back[after], boost[after]
        near = at[: len(after)]
        one, zero = m[1, 1] * e * b + m[1, 0] * (1 - b), m[0, 1] * e * b + m[0, 0] * (1 - b)
        back[near] = one / (one + zero)
    both = ahead * back
    result = both / (both + (1 - ahead) * (1 - back))
    if not pairs:
        return result
    expected = np.zeros((2, 2))
    for at, after in zip(steps, steps[1:]):
        p, b, e = ahead[at[: len(after)]], back[after], boost[after]
        joint = [[(1 - p) * m[0, 0] * (1 - b), (1 - p) * m[0, 1] * e * b], [p * m[1, 0] * (1 - b), p * m[1, 1] * e * b]]
        whole = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
        expected += [[(x / whole).sum() for x in row] for row in joint]
    return result, expected


def sequences(breaks: np.ndarray):
    """Starts and sizes of the runs between breaks."""
    edges = np.flatnonzero(np.diff(np.concatenate([[1], breaks.astype(np.int8), [1]])))
    return edges[::2], edges[1::2] - edges[::2]


def _distinct(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Without near copies: they would pass off common words as signs."""
    seen, kept = set(), []
    for text, toxic in sample:
        least = shingles(text)[:8].tolist()
        if least and sum(x in seen for x in least) * 2 >= len(least):
            continue
        seen.update(least)
        kept.append((text, toxic))
    return kept


def _lexicon(sample: list[tuple[str, int]]) -> set[str]:
    """The signs of toxic documents."""
    def of(text):
        return (sign for word in {t.lower() for t in _TOKEN.findall(text)} if word[0].isalnum() for sign in signs(word))

    inside, outside, n = Counter(), Counter(), Counter(toxic for _, toxic in sample)
    for text, toxic in sample:
        if toxic:
            inside.update(set(of(text)))
    inside = {sign: k for sign, k in inside.items() if k >= LEAST_DOCUMENTS}
    for text, toxic in sample:
        if not toxic:  # only signs in question are held
            outside.update({sign for sign in of(text) if sign in inside})
    scale = max(n[0], 1) / max(n[1], 1)
    return {s for s, k in inside.items() if k * scale / (outside[s] + 0.5) >= LEAST_ODDS}


class Model:
    """Weights of the chain and of the document score; small enough to broadcast."""

    def __init__(self):
        self.weights, self.move, self.final = np.full(1 << _BITS, 0.0, np.float32), np.zeros((2, 2)), np.array([-3.0, 0.0, 0.0, 0.0])

    def odds(self, token: str) -> float:
        return float(self.weights[features(token)].sum())

    def learn(self, sample: list[tuple[str, int]], rounds: int = 80, rate: float = 0.5, ridge: float = 1e-4) -> None:
        lexicon = _lexicon(sample)
        ids: list[list[int]] = []
        labels: list[int] = []
        known: dict[str, tuple] = {}
        random = np.random.default_rng(11)
        starts, sizes = [], []
        for text, toxic in sample:
            for sentence in re.split(r"[.!?\n]+", text):
                words = re.findall(r"\w+", sentence)
                for word in words:
                    if word not in known:
                        known[word] = features(word), int(any(s in lexicon for s in signs(word.lower())))
                marks = [known[w][1] if toxic else 0 for w in words]
                if words and (any(marks) or any(known[w][1] for w in words) or random.random() < 0.15):
                    starts.append(len(ids))
                    sizes.append(len(words))
                    ids += [known[w][0] for w in words]
                    labels += marks
        if not ids:
            return
        counts = np.array([len(x) for x in ids])
        flat = np.fromiter((f for x in ids for f in x), np.int32, counts.sum())
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), counts)
        y, starts, sizes = np.array(labels, float), np.array(starts), np.array(sizes)
        inner = np.ones(len(ids), bool)
        inner[starts + sizes - 1] = False
        at = np.flatnonzero(inner)
        seen = np.zeros((2, 2))
        np.add.at(seen, (y[at].astype(int), y[at + 1].astype(int)), 1)
        squares, move_squares = np.full(1 << _BITS, 1e-6), np.full((2, 2), 1e-6)
        for _ in range(rounds):
            odds = np.bincount(owner, self.weights[flat], len(ids))
            chance, expected = marginals(odds, starts, sizes, self.move, pairs=True)
            gradient = np.bincount(flat, (y - chance)[owner], 1 << _BITS) / len(ids) - ridge * self.weights
            squares += gradient**2
            self.weights += (rate * gradient / np.sqrt(squares)).astype(np.float32)
            push = (seen - expected) / len(ids) - ridge * self.move
            move_squares += push**2
            self.move += 0.2 * push / np.sqrt(move_squares)

    def calibrate(self, sample: list[tuple[str, int]], rounds: int = 3000) -> None:
        """Fit the document score by logistic regression on the sums of marginals."""
        if not sample:
            return
        tagger = Tagger(self)
        x = np.array([summary(m) for m, _ in tagger.tag([text for text, _ in sample])])
        y = np.array([toxic for _, toxic in sample], float)
        w, squares = self.final.copy(), np.full(4, 1e-6)
        for _ in range(rounds):
            gradient = x.T @ (y - 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))) / len(y) - 1e-4 * w * [0, 1, 1, 1]
            squares += gradient**2
            w += 0.5 * gradient / np.sqrt(squares)
        self.final = w


def summary(chances: np.ndarray) -> np.ndarray:
    """What the score of a document is made of: bias, largest marginal, sum and density of marginals."""
    if not len(chances):
        return np.array([1.0, 0.0, 0.0, 0.0])
    whole = float(chances.sum())
    return np.array([1.0, float(chances.max()), math.log1p(whole), math.sqrt(whole / len(chances))])


class Tagger(dict):
    """Marginals of the tokens of texts; log-odds per token are cached (NaN: a break)."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        value = math.nan if token[0] in ".!?\n" else self.model.odds(token)
        if len(self) > _CACHE:
            self.clear()
        self[token] = value
        return value

    def tag(self, texts: list[str | None]):
        """(marginals, tokens) per text, breaks left out."""
        tokens = [_TOKEN.findall(text) if text else [] for text in texts]
        ends = np.cumsum([len(t) + 1 for t in tokens])
        odds = np.fromiter((x for t in tokens for x in (*map(self.__getitem__, t), math.nan)), np.float64, ends[-1] if len(ends) else 0)
        breaks = np.isnan(odds)
        chances = marginals(np.where(breaks, 0, odds), *sequences(breaks), self.model.move)
        for start, end, words in zip(np.concatenate([[0], ends[:-1]]) if len(ends) else [], ends, tokens):
            real = ~breaks[start : end - 1]
            yield chances[start : end - 1][real], words

    def offsets(self, text: str, chances: np.ndarray) -> list[tuple[int, int]]:
        """Spans of the offending tokens; neighbours, of one sentence or not, stay apart."""
        places = [m.span() for m in _TOKEN.finditer(text) if m[0][0] not in ".!?\n"]
        return [places[i] for i in np.flatnonzero(chances >= OFFENDING)]


def is_held_out(doc_id):
    """Labels of these documents are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """The model from a sample of bounded size: see ``SAMPLE_ROWS`` and ``SAMPLE_CHARS``."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~is_held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).withColumn("_order", F.xxhash64(F.col("doc_id").cast("long")))
    chosen = [usable.where(F.col("_toxic") == y).orderBy("_order", "doc_id").limit(SAMPLE_ROWS) for y in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * SAMPLE_ROWS rows of three numbers at most
    rows = docs.select("doc_id", docs[text].alias("_text")).where(F.length("_text") <= SAMPLE_CHARS)
    rows = rows.join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("_order", "_text", "_toxic").collect()
    rows = [(row[1], int(row[2] > 0)) for row in sorted(rows, key=lambda row: row[0])]
    model = Model()
    model.learn(_distinct([row for i, row in enumerate(rows) if i % 3]))
    model.calibrate(rows[::3])
    return model


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, n_offending, offsets``; a row per row.

    ``offsets`` lists the offending tokens as ``start:end``, code points, end exclusive. A null
    or empty text has the score of a document without offending tokens. A null doc_id is not
    held out. Without labels, every score is that of an untrained model.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text))

    def score(batches):
        tagger = Tagger(model.value)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            scores, counts, places = [], [], []
            for start in range(0, len(texts), 500):
                part = texts[start : start + 500]
                for value, (chances, _) in zip(part, tagger.tag(part)):
                    z = float(summary(chances) @ model.value.final)
                    scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                    found = tagger.offsets(value, chances) if len(chances) and chances.max() >= OFFENDING else []
                    counts.append(len(found))
                    places.append(",".join(f"{a}:{b}" for a, b in found))
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(places, pa.string())], ["doc_id", "score", "n_offending", "offsets"])

    scored = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[text]).mapInArrow(score, "doc_id long, score double, n_offending long, offsets string")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_offending", "offsets"
    )
