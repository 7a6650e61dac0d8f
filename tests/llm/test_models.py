"""Quality classifier, decontamination, toxicity and packing against plain versions."""

import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cdc_lake.llm import decontaminate, packing, quality_classifier as qc, toxicity

LABELS = "doc_id long, quality int, toxic int"


# -- quality classifier ------------------------------------------------------


def kneser_ney(texts, order=qc.ORDER):
    """(gram -> probability per order, context -> backoff weight, floor), written out."""
    counts = Counter()
    for text in texts:
        padded = qc._PAD * (order - 1) + text
        counts.update(padded[i : i + order] for i in range(len(text)))
    by_order = {order: dict(counts)}
    for n in range(order - 1, 0, -1):
        by_order[n] = Counter(gram[1:] for gram in by_order[n + 1])
    floor = 1 / (len(by_order[1]) + 1)
    p, weight = {"": floor}, {}
    for n in range(1, order + 1):
        t = Counter(min(c, 5) for c in by_order[n].values())
        d = {}
        for i in (1, 2, 3):
            y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0
            d[i] = max(0.1 * i, min(0.9 * i, i - (i + 1) * y * t[i + 1] / t[i])) if t[1] and t[i] else 0.5 * i
        totals, spent = Counter(), Counter()
        for gram, c in by_order[n].items():
            totals[gram[:-1]] += c
            spent[gram[:-1]] += d[min(c, 3)]
        for context in totals:
            weight[n, context] = spent[context] / totals[context]
        for gram, c in by_order[n].items():
            lower = p[gram[1:]] if n > 1 else floor
            p[gram] = max(c - d[min(c, 3)], 0) / totals[gram[:-1]] + weight[n, gram[:-1]] * lower
    return p, weight, floor


def loss(model, text, order=qc.ORDER):
    p, weight, floor = model
    padded, whole = qc._PAD * (order - 1) + text, 0.0
    for i in range(len(text)):
        gram, scale = padded[i : i + order], 1.0
        while gram and gram not in p:
            scale *= weight.get((len(gram), gram[:-1]), 1.0) if len(gram) > 1 else 1.0
            gram = gram[1:]
        whole -= math.log(scale * (p[gram] if gram else floor))
    return whole


@pytest.mark.parametrize("entries", [qc.SHARD_ENTRIES, 700])
def test_perplexity_is_that_of_a_plain_model(docs, prose, monkeypatch, entries):
    monkeypatch.setattr(qc, "SHARD_ENTRIES", entries)
    trusted = [prose(i, 30) for i in range(12)] + ["é ñ 😀"]
    model = qc.train(docs(trusted))
    tested = trusted[:3] + ["zzz !! qq", "x", "", None, "RANDO ster.", "😀😀", "ran" * 2000]
    rows = qc.perplexities(docs(tested), model, keep=["doc_id"]).orderBy("doc_id").collect()
    plain = kneser_ney(trusted)
    for row, text in zip(rows, tested):
        if text:
            assert row._size == len(text) and row._bits == pytest.approx(loss(plain, text), rel=1e-4)
        else:
            assert row._bits is None


def test_probabilities_sum_to_one(docs, prose):
    model = {r.gram: r for r in qc.train(docs([prose(i, 20) for i in range(5)])).collect() if r.logp is not None}
    letters = [g for g in model if len(g) == 1]
    p, weight, floor = kneser_ney([prose(i, 20) for i in range(5)])
    assert sum(p[c] for c in letters) + weight[1, ""] * floor == pytest.approx(1)
    assert {g: round(math.exp(model[g].logp), 9) for g in letters} == {g: round(p[g], 9) for g in letters}


def test_classifier_keeps_prose_and_rejects_junk(docs, table, prose):
    good = [prose(i, 60) for i in range(120)]
    junk = [" ".join(w.upper() + "$%&#"[i % 4] * 3 for i, w in enumerate(prose(i, 40).split())) for i in range(20)]
    texts = good + junk + [prose(900, 60), "Moster ga.", None, ""]
    frame = docs([(i, t, "xx" if i == 141 else "en") for i, t in enumerate(texts)]).withColumn("_perplexity", F.lit("x"))
    labels = table([(i, 1, 0) for i in range(60)] + [(i, 0, 0) for i in range(120, 125)] + [(None, 1, 0), (5, 1, 0)], LABELS)
    got = {r.doc_id: r._kept for r in qc.classify(frame, labels, keep=["doc_id"]).collect()}
    assert all(got[i] for i in range(120)) and not any(got[i] for i in range(120, 140))
    assert got[140] and got[141] and not got[142] and not got[143]
    assert qc.classify(docs([]), labels, keep=["doc_id"]).count() == 0
    assert {r.doc_id: r._kept for r in qc.classify(docs(["a b", None]), table([], LABELS), keep=["doc_id"]).collect()} == {0: True, 1: False}


def test_a_trusted_text_may_begin_with_a_question_mark(docs, prose):
    trusted = [prose(i, 30) for i in range(6)] + ["?What now", "?So what", "?"]
    tested = [trusted[0], "?What else", "é?", "?"]
    rows = qc.perplexities(docs(tested), qc.train(docs(trusted)), keep=["doc_id"]).orderBy("doc_id").collect()
    plain = kneser_ney(trusted)
    for row, text in zip(rows, tested):
        assert row._bits == pytest.approx(loss(plain, text), rel=1e-4)


def test_limit_tells_good_from_bad(table):
    pick = random.Random(4)
    good = [("en", 1.5, 1, abs(pick.gauss(1.49, 0.03))) for _ in range(400)] + [("en", 1.5, 1, x) for x in (1.84, 1.85, 1.9)]
    bad = [("en", 1.5, 0, pick.uniform(1.65, 2.4)) for _ in range(70)]
    only = [("de", 1.5, 1, x / 100) for x in range(140, 160)]
    apart = [("fr", 1.5, 1, x / 100) for x in range(140, 160)] + [("fr", 1.5, 0, 9.0)]
    got = {r._lang: r.limit for r in qc.limits(table(good + bad + only + apart, "_lang string, middle double, q int, _surprise double")).collect()}
    assert max(x[3] for x in good[:400]) - qc.BIN <= got["en"] <= min(x[3] for x in bad) + qc.BIN
    assert 1.6 < got["de"] < 2.2 and 1.6 < got["fr"] < 9.0


def test_repeated_words_are_rejected(docs, table, prose):
    pick = random.Random(9)
    good = [prose(i, 60) for i in range(300)]
    junk = [" ".join([pick.choice(prose(i, 9).replace(".", "").split()).capitalize() + "." * (i % 2)] * 40) for i in range(100)]
    frame = docs(good + junk + ["é%$ ñ#" * 40, "&" * 150])  # a good label on an odd text must not set the limit
    labels = table([(i, 1, 0) for i in range(300)] + [(i, 0, 0) for i in range(300, 400)] + [(400, 1, 0), (401, 1, 0)], LABELS)
    got = {r.doc_id: r._kept for r in qc.classify(frame, labels, keep=["doc_id"]).collect()}
    assert sum(got[i] for i in range(300)) >= 290 and sum(got[i] for i in range(300, 400)) <= 10


# -- benchmark decontamination -------------------------------------------------


def least_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, x in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != x))
    return min(row)


def test_myers_is_edit_distance():
    pick = random.Random(6)
    for _ in range(300):
        item, window = ("".join(pick.choice("abc") for _ in range(pick.randrange(1, n))) for n in (20, 40))
        assert decontaminate.myers(item, window)[0] == least_distance(item, window)


def test_finds_what_all_distances_find(docs, table, prose):
    pick = random.Random(12)
    clean = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [prose(100 + i, pick.randrange(12, 40)) for i in range(12)] + ["short one", prose(100, 20)]
    texts = [prose(i, 60) for i in range(10)]
    for i in range(40):
        passage = list(pick.choice(items))
        for _ in range(pick.randrange(0, 14)):
            at = pick.randrange(len(passage))
            passage[at : at + pick.randrange(0, 2)] = [pick.choice("abc xyz")] * pick.randrange(0, 2)
        passage = "".join(passage)
        texts.append(prose(200 + i, 20) + " " + (passage.upper() if i % 3 else passage.replace(" ", " \n")) + " " + prose(300 + i, 20))
    texts += [None, "", "a SHORT, one!", "ashort onea"]
    found = decontaminate.contaminated(docs(texts), table(list(enumerate(items)) + [(98, None), (99, " ")], "item_id long, text string"))
    expected = set()
    for i, text in enumerate(texts):
        for j, item in enumerate(map(clean, items)):
            budget, body = len(item) // decontaminate.CHARS_PER_EDIT, clean(text or "")
            if not budget:
                if f" {item} " in f" {body} ":
                    expected.add((i, j, 0))
            elif (d := least_distance(item, body)) <= budget:
                expected.add((i, j, d))
    assert {(r.doc_id, r.item_id, r.distance) for r in found.collect()} == expected and len(expected) > 20
    kept = decontaminate.without_leaks(docs(texts), table(list(enumerate(items)), "item_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, _, _ in expected}


def test_blocks_and_empty_tables(docs, table, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    items = table([(i, prose(i, 20)) for i in range(9)], "item_id long, text string")
    frame = docs([prose(i, 20) for i in range(12)] + [prose(0, 20)])
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(frame, items).collect()) == [*((i, i) for i in range(9)), (12, 0)]
    assert {r.doc_id for r in decontaminate.without_leaks(frame, items).collect()} == {9, 10, 11}
    assert decontaminate.contaminated(frame, items.limit(0)).count() == 0 and decontaminate.contaminated(docs([]), items).count() == 0
    assert decontaminate.without_leaks(frame, items.limit(0)).count() == 13


# -- toxicity --------------------------------------------------------------------


def test_marginals_are_those_of_all_paths():
    random_ = np.random.default_rng(3)
    sizes = np.array([1, 4, 6, 2])
    starts = np.array([0, 2, 7, 13])
    odds, move = random_.normal(0, 2, 16), random_.normal(0, 1, (2, 2))
    got, pairs = toxicity.marginals(odds, starts, sizes, move, pairs=True)
    expected = np.zeros((2, 2))
    for start, size in zip(starts, sizes):
        paths = list(product((0, 1), repeat=size))
        weight = [math.exp(sum(s * odds[start + i] for i, s in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))) for p in paths]
        for i in range(size):
            assert got[start + i] == pytest.approx(sum(w for p, w in zip(paths, weight) if p[i]) / sum(weight))
        for p, w in zip(paths, weight):
            for a, b in zip(p, p[1:]):
                expected[a, b] += w / sum(weight)
    assert pairs == pytest.approx(expected)


def test_toxic_documents_are_told_apart(docs, table, prose):
    texts, toxic = [], []
    for i in range(500):
        words = prose(i, 40).split()
        toxic.append(int(i % 3 == 0))
        if toxic[-1]:
            for k in range(3):
                words[7 * k + i % 5] = ("grubbly", "Smurkish", "vexatron", "vexalot")[(i + k) % 4]
        texts.append(" ".join(words))
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(500)]
    # Labels of held-out documents are wrong: learning from them would show.
    labels = table([(i, 1, 1 - y if h else y) for i, (y, h) in enumerate(zip(toxic, held))], LABELS)
    rows = toxicity.toxicity(docs(texts + [None, ""]), labels).orderBy("doc_id").collect()
    assert [r.held_out for r in rows[:500]] == held
    right = [r.predicted == y for r, y, h in zip(rows, toxic, held) if h]
    assert sum(right) / len(right) > 0.97
    for r, text, y in zip(rows, texts, toxic):
        for span in r.offsets.split(",") if r.offsets and y else []:
            a, b = map(int, span.split(":"))
            assert text[a:b].lower()[:4] in ("grub", "smur", "vexa")
    assert all(0 <= r.score <= 1 for r in rows) and rows[500].score == rows[501].score < 0.5


def test_toxicity_edges(docs, table):
    none = table([], LABELS)
    assert toxicity.toxicity(docs([]), none).count() == 0
    got = toxicity.toxicity(docs([(None, "a", "en"), (1, "b", "en"), (1, "b", "en")]).withColumn("score", F.lit("x")), none).collect()
    assert len(got) == 3 and [r.held_out for r in got if r.doc_id is None] == [False]


# -- packing ------------------------------------------------------------------------


def test_boundaries_are_optimal():
    pick = random.Random(5)

    def best(lengths, counts, buckets):
        least = {(0, 0): 0}
        for j in range(1, len(lengths) + 1):
            for b in range(1, buckets + 1):
                options = [least[i, b - 1] + lengths[j - 1] * sum(counts[i:j]) for i in range(j) if (i, b - 1) in least]
                if options:
                    least[j, b] = min(options)
        return min(v for (j, _), v in least.items() if j == len(lengths))

    for _ in range(60):
        lengths = sorted(pick.sample(range(0, 60), pick.randrange(1, 14)))
        counts, buckets = [pick.randrange(1, 9) for _ in lengths], pick.randrange(1, 6)
        bounds = packing.boundaries(np.array(lengths), np.array(counts), buckets)
        assert len(bounds) <= buckets and bounds[-1] == lengths[-1]
        assert sum(min(b for b in bounds if b >= n) * c for n, c in zip(lengths, counts)) == best(lengths, counts, buckets)
    assert packing.boundaries(np.array([]), np.array([])) == []


def test_batches_hold_every_document_once_within_the_budget(table, monkeypatch):
    monkeypatch.setattr(packing, "LANE_ROWS", 50)
    pick = random.Random(7)
    rows = [(i, pick.choice([0, 3, 5, 17, 60, 61, 62, 300, 2000])) for i in range(700)] + [(5, 5), (None, 9), (8, None)]
    got = packing.pack(table(rows, "doc_id long, n_tokens long").withColumn("_keep", F.lit(1)), budget=512, buckets=4).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter(rows)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket_len, r.batch_id), []).append(r)
        assert r.padding == r.bucket_len - (r.n_tokens or 0) >= 0
    short = {k: v for k, v in batches.items() if k[0] <= 512}
    assert all(k[0] * len(v) <= 512 and sorted(r.slot for r in v) == list(range(len(v))) for k, v in short.items() if k[0])
    assert all(len(v) == 1 for k, v in batches.items() if k[0] > 512)
    for bound in {k[0] for k in short}:  # all batches of a bucket but the last are full
        sizes = sorted((k[1], len(v)) for k, v in short.items() if k[0] == bound)
        assert all(n == 512 // max(bound, 1) for _, n in sizes[:-1])
    assert packing.pack(table([], "doc_id long, n_tokens long")).count() == 0


def test_repeated_long_rows_get_different_batches(table):
    rows = [(1, 900)] * 3 + [(None, 900), (None, 900), (2, 901), (3, 5)]
    got = packing.pack(table(rows, "doc_id long, n_tokens long"), budget=512).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter(rows)
    assert len({(r.bucket_len, r.batch_id) for r in got}) == len(rows) and all(r.slot == r.padding == 0 for r in got)
