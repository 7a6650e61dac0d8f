"""Many spans or repeats in one text, extra columns with the operators' inner names, and empty tables."""

import hashlib
import itertools
import random
import time
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cdc_lake.llm import decontaminate, jaccard_join, packing, quality_classifier, secret_scan, token_counts
from cdc_lake.llm.common import BATCH_BYTES, below, map_texts, running


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 99, 1000])
def test_running_sums_and_maxima(table, n):
    pick = random.Random(n)
    values = [pick.randrange(1000) for _ in range(n)]
    row = table([(values,)], "v array<int>").select(running(F.col("v"), lambda a, b: a + b).alias("s"), running(F.col("v"), F.greatest).alias("m")).first()
    assert row.s == list(itertools.accumulate(values)) and row.m == list(itertools.accumulate(values, max))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 64, 65])
def test_numbers_below(table, n):
    values = sorted(random.Random(n).randrange(50) for _ in range(n))
    rows = table([(values, b) for b in range(-1, 52)], "v array<int>, b int").select("b", below(F.col("v"), F.col("b")).alias("k")).collect()
    assert all(r.k == sum(v < r.b for v in values) for r in rows)


def test_very_many_secrets_in_one_text(docs):
    pick = random.Random(4)
    lines = ["%032x" % pick.getrandbits(128) for _ in range(100_000)]
    text = "é" + "\n".join(lines) + " end"
    begun = time.time()
    frame = secret_scan.redact(docs([text, "plain"]))
    got = {r.doc_id: r for r in frame.collect()}
    assert got[0].text == "é" + "\n".join(["[SECRET]"] * len(lines)) + " end" and got[0].n_chars == len(got[0].text)
    row = secret_scan.secret_scan(docs([text])).first()
    spans = ",".join(f"hex:{1 + 33 * i}:{33 + 33 * i}" for i in range(len(lines)))
    assert row.n_hex == len(lines) and row.spans == spans and row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
    assert time.time() - begun < 120


def plain_redaction(text, spans):
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_redaction_against_a_plain_version(docs):
    pick = random.Random(6)
    part = lambda: pick.choice(["token=", "😀 ", "é" * 3000, "x " * 500, "0123456789abcdef" * pick.randint(1, 3), "AKIA" + "Z" * 18, "secret: aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\n"])
    texts = ["".join(part() for _ in range(pick.randrange(12))) for _ in range(120)]
    found = secret_scan.find_secrets(docs(texts)).select("doc_id", "found", secret_scan.redacted(F.col("_text"), F.col("found")).alias("t")).collect()
    assert any(len(r.found) > 3 for r in found)
    for r in found:
        assert r.t == plain_redaction(texts[r.doc_id], [(s.start, s.end) for s in r.found])


def test_items_and_texts_of_repeated_words():
    item, other = " ".join(["abcd"] * 100), " ".join(["abcd"] * 60 + ["wxyz"] * 10 + ["abcd"] * 30)
    begun = time.time()
    assert decontaminate.Finder([(0, item)]).find(" ".join(["abcd"] * 20_000)) == {0: 0}
    assert decontaminate.Finder([(0, other)]).find(" ".join(["abcd"] * 1_000)) == {}
    assert decontaminate.Finder([(0, other)]).find(" ".join(["abcd"] * 500) + " " + other.replace("wxyz", "wxy", 2) + " abcd" * 500) == {0: 2}
    assert time.time() - begun < 2


def test_merged_windows():
    assert decontaminate.merged([[5, 9], [0, 2], [2, 4], [8, 12], [6, 7]]) == [(0, 4), (5, 12)]


INNER = [
    "_text", "base", "found", "_added", "_bits", "_size", "_lang", "_filled", "_nll", "limit", "middle", "_held", "_kept", "_perplexity", "_lane", "_nth", "_bucket", "_place",
    "_before", "_rows", "_normal_text", "digest", "node", "root", "bands", "class_id", "_text_hash", "in_0__", "in_6__", "q",
]


def clashing(frame):
    return frame.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id")).alias(name) for name in INNER])


def test_extra_columns_of_any_name_go_through_the_pipeline(spark, docs, table, prose, tmp_path):
    import corpus_pipeline

    texts = [prose(i, 70) for i in range(70)] + [prose(3, 70), prose(600, 60) + ' token = "abcdef0123456789abcdef0123" ' + prose(601, 400), None, ""]
    frame = clashing(docs(texts))
    table([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table([(0, prose(900, 25))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = frame.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = corpus_pipeline.stored(stage(spark, frame, str(tmp_path)), "stage")
        assert frame.columns == columns
    rows = frame.collect()
    assert {r.doc_id for r in rows} == {*range(70), 71}
    assert all(r[name] == f"{name} {r.doc_id}" for r in rows for name in INNER)


def test_an_empty_corpus_goes_through_the_pipeline(spark, docs, table, tmp_path):
    import corpus_pipeline

    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    table([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_results_win_over_columns_of_their_names(docs, table, prose):
    sized = table([(i, i % 5) for i in range(40)], "doc_id long, n_tokens long")
    mine = packing.pack(clashing(sized).withColumn("bucket_len", F.lit("x")).withColumn("slot", F.lit("y")))
    assert mine.columns == [*sized.columns, *INNER, "bucket_len", "batch_id", "slot", "padding"]
    assert sorted(map(tuple, mine.select(packing.pack(sized).columns).collect())) == sorted(map(tuple, packing.pack(sized).collect()))
    found = secret_scan.find_secrets(clashing(docs(["token=abcdef0123", "b"])), keep=("doc_id", "found", "digest"))
    assert found.columns == ["doc_id", "digest", "_text", "base", "found"]
    judged = quality_classifier.classify(clashing(docs([prose(i, 60) for i in range(30)])), table([(i, 1) for i in range(30)], "doc_id long, quality int"))
    assert set(judged.columns) == {*docs([]).columns, *INNER, "_threshold"} and judged.count() == 30


def test_one_id_with_two_texts_keeps_both(docs, prose):
    rows = [(1, prose(1, 60), "en"), (1, prose(2, 60), "en"), (1, prose(2, 60), "en"), (2, prose(3, 60), "en")]
    kept = jaccard_join.one_of_each(docs(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted({(i, t) for i, t, _ in rows})


# -- memory of an executor ----------------------------------------------------------


@pytest.fixture
def default_batches(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    yield setting
    spark.conf.unset(setting)


def test_workers_get_texts_in_small_batches(spark, default_batches):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    got = map_texts(rows, sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 1.1 * BATCH_BYTES
    spark.conf.set(default_batches, "1m")  # the session's own choice stands
    assert max(r.size for r in map_texts(rows, sizes, "n long, size long").collect()) < 1.1 * (1 << 20)


@pytest.mark.parametrize("stage", ["quality", "join", "leaks", "lengths"])
def test_stages_hand_texts_over_in_small_batches(spark, docs, table, prose, default_batches, stage):
    frame = docs([prose(i, 30) for i in range(4)])
    if stage == "quality":
        quality_classifier.kept_only(frame, table([(i, 1, 0) for i in range(4)], "doc_id long, quality int, toxic int"))
    elif stage == "join":
        jaccard_join.one_of_each(frame)
    elif stage == "leaks":
        decontaminate.without_leaks(frame, table([(1, prose(9, 20))], "item_id long, text string"))
    else:
        import public_tokenizers

        token_counts.token_counts(frame, public_tokenizers.path("piece_bpe_32k.model"))
    assert spark.conf.get(default_batches) == str(BATCH_BYTES)


def test_kept_hashes_are_few():
    words = [f"w{i}" for i in range(3 * jaccard_join.KEPT_WORDS)]
    jaccard_join._HASHES.clear()
    hashes = jaccard_join._word_hashes(words)
    assert len(jaccard_join._HASHES) <= jaccard_join.KEPT_WORDS and len(set(hashes.tolist())) == len(words)
    assert (jaccard_join._word_hashes(words[:100]) == hashes[:100]).all()


def test_counts_of_many_languages_are_handed_on(monkeypatch):
    monkeypatch.setattr(quality_classifier, "_FLUSH", 50)
    monkeypatch.setattr(quality_classifier, "_EMIT", 20)
    monkeypatch.setattr(quality_classifier, "_SLICE", 30)
    random_ = random.Random(2)
    rows = [(f"l{i % 9}", "".join(random_.choice("abcdé") for _ in range(random_.randrange(70)))) for i in range(60)] + [("l0", None), ("l1", "")]
    read = []

    def batches():
        for lang, text in rows:
            read.append(lang)
            yield pa.RecordBatch.from_pydict({"lang": [lang], "text": pa.array([text], pa.string())})

    found, waiting, most = Counter(), 0, 0
    for batch in quality_classifier._counted(batches()):
        assert 0 < batch.num_rows <= 20
        for row in batch.to_pylist():
            found[row["lang"], row["gram"]] += row["n"]
        most, waiting = max(most, len(read) - waiting), len(read)
    plain = Counter()
    for lang, text in rows:
        padded = "\x02" * 4 + (text or "")
        plain.update((lang, padded[i : i + 5]) for i in range(len(text or "")))
    assert found == plain and most < 20  # rows read between two batches
