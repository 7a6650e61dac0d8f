"""Near duplicates, spelling variants and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cdc_lake.llm import merkle_manifest, simhash_dedup, spelling_variants

SPACES = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- SimHash -------------------------------------------------------------------


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            out += [word] if word else []
            word = ""
        else:
            word += c.lower() if "A" <= c <= "Z" else c
    return out


def plain_fingerprint(text):
    words = plain_words(text)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Place in the list -> least doc_id reachable, by all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
            root[find(j)] = find(i)
    least = {}
    for i, (doc_id, _) in enumerate(prints):
        ids = least.setdefault(find(i), [])
        ids += [doc_id] if doc_id is not None else []
    return [min(least[find(i)], default=None) for i in range(len(prints))]


ODD_TEXTS = [None, "", " \t\n", "one", "One  TWO", "a b c", "A\tb\x0bC", "Ä ä É é", "ä Ä É é x", "a b c a b c a b c", "x" * 5000, "İ K ß x", "  lead and trail  "]


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_fingerprints(monkeypatch, prose, piece):
    monkeypatch.setattr(simhash_dedup, "_PIECE", piece)
    monkeypatch.setattr(simhash_dedup, "_FLUSH", 50)
    texts = ODD_TEXTS + [prose(i, n) for i, n in enumerate([3, 4, 50, 400])]
    assert simhash_dedup.fingerprints(texts).tolist() == [plain_fingerprint(t) for t in texts]
    assert not len(simhash_dedup.fingerprints([]))


def near_numbers(n, seed=1):
    """Numbers with chains, dense balls and strangers."""
    pick = random.Random(seed)
    out = {0, 1, (1 << 64) - 1}
    while len(out) < n:
        base = pick.choice(sorted(out)) if pick.random() < 0.7 else pick.getrandbits(64)
        for _ in range(pick.randrange(0, 6)):
            base ^= 1 << pick.randrange(64)
        out.add(base)
    return sorted(out)


def test_forest_finds_what_all_pairs_find():
    pick, numbers = random.Random(3), near_numbers(400)
    shards = np.array(sorted(pick.randrange(5) for _ in numbers))
    bits = np.array(numbers, np.uint64)
    query, entry = simhash_dedup.Forest(bits, shards).search(bits, shards)
    expected = {(i, j) for i in range(len(bits)) for j in range(len(bits)) if shards[i] == shards[j] and (numbers[i] ^ numbers[j]).bit_count() <= 3}
    assert set(zip(query.tolist(), entry.tolist())) == expected and len(query) == len(expected)


def test_forest_children_are_keyed_by_distance():
    bits = np.array(near_numbers(300), np.uint64)
    forest = simhash_dedup.Forest(bits, np.zeros(len(bits), np.int64))
    parents = forest.edges // 65
    assert (np.bitwise_count(bits[parents] ^ bits[forest.children]) == forest.edges % 65).all()
    assert len(set(forest.edges.tolist())) == len(bits) - 1  # one child per distance


@pytest.mark.parametrize(("shard", "splits"), [(4096, 3), (20, 3), (20, 0), (5, 1)])
def test_links_join_what_all_pairs_join(spark, shard, splits):
    numbers = near_numbers(500, seed=7)
    signed = [n - (1 << 64) if n >> 63 else n for n in numbers]
    found = simhash_dedup.links(spark.createDataFrame([(n,) for n in signed], "bits long"), shard, splits)
    root = {n: n for n in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for row in found.collect():
        root[find(row.node)] = find(row.other)
    expected = plain_components(list(zip(signed, numbers)))
    groups = {}
    for n, head in zip(signed, expected):
        groups.setdefault(head, set()).add(find(n))
    assert all(len(heads) == 1 for heads in groups.values())
    assert len({h for heads in groups.values() for h in heads}) == len(groups)


def test_simhash_dedup(table, prose):
    pick, rows = random.Random(2), []
    base = prose(1, 300).split()
    for i in range(40):
        words = list(base)
        if i % 3:
            words[pick.randrange(len(words))] = f"alt{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(i + 50, 60)) for i in range(30)] + [(i + 200, t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(7, "another text of the same id"), (None, " ".join(base)), (None, "nobody near this one at all"), (100, prose(50, 60)), (100, prose(50, 60))]
    frame = table([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, bits string, root int, component_id string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash_dedup.simhash_dedup(frame).collect()), key=repr)
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    expected = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))), key=repr)
    assert got == expected
    assert simhash_dedup.simhash_dedup(frame.limit(0)).collect() == []


# -- spelling variants ------------------------------------------------------------


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, damaged=97):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
            elif run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if damaged and h % damaged == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), None if form[w] is None else n[form[w]]) for w in n)


def variant_rows(frame):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def words_with_variants(seed, stems=25, length=(5, 12), alphabet="abcdeàé×"):
    pick, out = random.Random(seed), []
    for _ in range(stems):
        word = "".join(pick.choice(alphabet) for _ in range(pick.randrange(*length)))
        for _ in range(6):
            edited = list(word)
            for _ in range(pick.randrange(0, 3)):
                at, how = pick.randrange(len(edited) + 1), pick.randrange(3)
                edited[at : at + (how > 0)] = [pick.choice(alphabet)] if how < 2 else []
            out += ["".join(edited)] * pick.choice([1, 3, 3, 4, 7, 20])
    pick.shuffle(out)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_acceptor_accepts_its_words_and_is_minimal(seed):
    words = sorted(set(words_with_variants(seed)))
    machine = spelling_variants.Acceptor(words)
    for rank, word in enumerate(words):
        state, at = machine.start, 0
        for letter in word:
            state, at = next((to, r) for a, to, r in machine.ranked(state, at) if a == letter)
        assert machine.final[state] and at == rank
    assert machine.count[machine.start] == len(words)
    rests = {tuple(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert len(machine.final) == len(rests)  # one state per set of endings


@pytest.mark.parametrize("seed", range(4))
def test_composition_accepts_all_pairs_once(seed):
    words = sorted(set(words_with_variants(seed)) | {"", "a", "aa", "aaa", "ab", "ba", "aab"})
    found = [tuple(sorted(pair)) for pair in spelling_variants.Acceptor(words).one_edit()]
    assert sorted(found) == [(i, j) for i, j in combinations(range(len(words)), 2) if one_edit(words[i], words[j])]


@pytest.mark.parametrize("partition", [20_000, 6])
def test_spelling_variants(table, partition):
    words = words_with_variants(11) + words_with_variants(12, 4, (40, 60)) + ["aaaaa"] * 9 + ["aaaaaa"] * 4 + ["aaaaaaa"] * 3
    rows = [(i if i % 7 else None, ", ".join(words[i * 40 : i * 40 + 40]).title() if i % 5 == 0 else "1".join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    rows += [(1, None), (2, ""), (3, "123 ..."), (4, "ÀÉÎ àéî ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜ"), (4, "repeat rows repeat"), (4, "repeat rows repeat"), (5, ("y" * 300 + " ") * 3 + ("y" * 299 + " ") * 7)]
    frame = table([(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, least int")
    for damaged in (97, 5) if partition > 6 else (5,):
        assert variant_rows(spelling_variants.spelling_variants(frame, damaged=damaged, partition=partition)) == plain_variants(rows, damaged)
    if partition == 6:
        assert spelling_variants.spelling_variants(frame.limit(0)).collect() == []


def test_a_beginning_that_very_many_words_share_is_dealt_out_again(spark):
    """A vocabulary of one family: all words share their first ten letters."""
    pick = random.Random(1)
    words = sorted({"commonhead" + "".join(pick.choice("abcd") for _ in range(5)) for _ in range(700)})
    rows = [(w, pick.randrange(3, 50)) for w in words]
    got = spelling_variants.near_words(spark.createDataFrame(rows, "word string, n long"), partition=50)
    assert {r.word: r.n_near for r in got.collect()} == {w: k for w in words if (k := sum(one_edit(w, v) for v in words))}


# -- Merkle manifest ------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def plain_tree(leaves):
    """(root, per leaf: the levels of its way up, as (left, right) siblings)."""
    ways, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for leaf, place in enumerate(at):
            start = place - place % 8
            ways[leaf].append((nodes[start:place], nodes[place + 1 : start + 8]))
            at[leaf] = place // 8
        nodes = [H(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], ways


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_manifest(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], plain_leaf(row[0], row[3], row[2], row[4], row[1]), row))
    trees = {}
    for lang in groups:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = plain_tree([leaf for _, leaf, _ in groups[lang]])
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    root, above = plain_tree([trees[lang][0] for lang in names]) if names else ("", [])
    out = []
    for lang, up in zip(names, above):
        for (doc_id, leaf, row), way in zip(groups[lang], trees[lang][1]):
            text, node = row[1], leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                node = plain_leaf(doc_id, row[3], lang, row[4], ascii_lower(text))
            for left, right in way + up:
                node = H(*left, node, *right)
            proof = H(*[s for left, right in way + up for s in left + right])
            out.append((doc_id, leaf, trees[lang][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def manifest_rows(frame):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("height", [2, 4])
def test_manifest(monkeypatch, table, height):
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)
    sizes = {"en": 150, "de": 64, "fr": 9, "es": 1, "": 2, None: 10, "ü": 8, "a": 1, "b": 1, "z": 65}
    rows, number = [], 0
    for lang, n in sizes.items():
        for i in range(n):
            rows.append((number * 7919 % 1000, f"Text {number} Of {lang} Äö" * (i % 4), lang, "s" if i % 3 else None, i if i % 5 else None))
            number += 1
    rows += [(5, None, "en", None, None), (None, "Nobody", "en", "s", 1), (None, None, None, None, None)] + [(-3, "Copy", "en", "s", 4)] * 20
    frame = table([(*r, 1, "x", 2) for r in rows], f"{DOCS}, idx int, path string, size int")
    assert manifest_rows(merkle_manifest.manifest(frame)) == plain_manifest(rows)


def test_manifest_of_one_row_and_of_none(table):
    rows = [(3, "Alone", "en", "s", 5)]
    assert manifest_rows(merkle_manifest.manifest(table(rows, DOCS))) == plain_manifest(rows)
    assert merkle_manifest.manifest(table([], DOCS)).collect() == []


def test_a_changed_text_is_told(table, prose):
    rows = [(i, prose(i, 20), "en", "s", 1) for i in range(60)]
    found = {r.doc_id: r.verified for r in merkle_manifest.manifest(table([(i, t.upper(), *x) for i, t, *x in rows], DOCS)).collect()}
    assert found == {i: zlib.crc32(str(i).encode()) % 3 != 0 for i in range(60)}
