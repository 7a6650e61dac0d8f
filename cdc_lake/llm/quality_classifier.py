"""Quality by perplexity under a character model of trusted text.

The model is an interpolated modified Kneser-Ney model of character 5-grams, one per
language, counted over all trusted documents but a held-out fifth. Counts, contexts,
discounts and lower orders are joins of count tables sharded by n-gram. Perplexity is held
against a limit per language that best tells the held-out documents labelled good from those
labelled bad.

Scoring takes the model in shards. The shard of an n-gram follows from the three characters
before the predicted one, so each position of a text needs one shard only, whatever order the
model backs off to; sums over shards add up. Shorter n-grams are in every shard.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.bitmaps import id_bitmaps, with_id_in
from ..operators.joins import lookup_join
from .common import dropped, map_texts, renamed, restored, stored

ORDER = 5
#: Of trusted documents, one in so many sets thresholds and is not trained on.
HELD_OUT = 5
#: So much of the held-out trusted documents of a language is kept at least.
LEAST_KEPT = 0.95
#: Good and bad held-out documents that a language needs for a limit of its own; with fewer, the
#: distance from its middle is that of the languages together.
LEAST_GOOD, LEAST_BAD = 50, 10
#: Where no held-out document is labelled bad, the limit is the upper quartile and so many
#: quartile distances.
FENCE = 4.0
#: Limits are sought among log-losses counted in bins of this width.
BIN = 0.005
#: A text is judged as if so many characters of middling trusted text came with it: the
#: perplexity of a few words says little.
PRIOR_CHARS = 50
#: Entries of one broadcast shard, and the share of a lookup table that they fill (18 bytes
#: each in a worker).
SHARD_ENTRIES, _FILLED = 3_000_000, 0.65
#: Spreads neighbouring code points over the shards.
_NEAR = 1_000_003
_PAD = "\x02"
#: Stands for all languages together; no language is named like that.
_ALL = "\x00all"
#: The model's row for unseen characters: longer than any n-gram of a text.
_UNSEEN = "?" * (ORDER + 1)
#: Entries of a task's counts, of all languages, before they are handed on, and those of a batch;
#: characters handled at once.
_FLUSH, _EMIT, _SLICE = 250_000, 50_000, 250_000


def _language(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def ngram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``lang, gram, n`` over whole texts, every character predicted once."""
    rows = docs.select(_language(docs["lang"]).alias("lang"), docs[text])
    return map_texts(rows, _counted, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(batches):
    """``lang, gram, n``: counts of ``lang, text``, handed on before a task holds more than ``_FLUSH`` and a slice's."""
    counts: dict[str, Counter] = {}
    held = 0
    for batch in batches:
        for lang, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            padded = _PAD * (ORDER - 1) + (value or "")
            for start in range(0, len(value or ""), _SLICE):
                own = counts.setdefault(lang, Counter())
                held -= len(own)
                own.update(padded[i : i + ORDER] for i in range(start, min(start + _SLICE, len(value))))
                held += len(own)
                if held > _FLUSH:
                    yield from _emitted(counts)
                    held = 0
    yield from _emitted(counts)


def _emitted(counts: dict[str, Counter]):
    """Batches of ``counts``, which is emptied."""
    while counts:
        lang, own = counts.popitem()
        entries = iter(own.items())
        while some := list(islice(entries, _EMIT)):
            grams, times = zip(*some)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(grams, pa.string()), pa.array(times, pa.int64())], ["lang", "gram", "n"])


def _discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3`` of modified Kneser-Ney, from the counts of counts."""
    times = counts.groupBy("lang").agg(*[F.count_if(F.col("n") == i).alias(f"t{i}") for i in (1, 2, 3, 4)])
    y = F.col("t1") / (F.col("t1") + 2 * F.col("t2"))
    estimate = lambda i: F.when(
        (F.col("t1") > 0) & (F.col(f"t{i}") > 0), F.greatest(F.lit(0.1 * i), F.least(F.lit(float(i)) * 0.9, i - (i + 1) * y * F.col(f"t{i + 1}") / F.col(f"t{i}")))
    ).otherwise(0.5 * i)
    return times.select("lang", *[estimate(i).alias(f"d{i}") for i in (1, 2, 3)])


def train(trusted: DataFrame, text: str = "text") -> DataFrame:
    """The model: ``lang, gram, logp, backoff``; a gram that is a context too has a row for each.

    ``logp`` is the natural log of the probability of the last character after the others,
    ``backoff`` that of the weight which passes to the next shorter context after this one.
    Tables of one row per language are written first: their file size lets Catalyst
    broadcast them, so the counts move once for their contexts and once for the lower order.
    """
    orders = [stored(ngram_counts(trusted, text), "grams")]
    while len(orders) < ORDER:
        # Lower orders count the different characters before a gram.
        lower = orders[0].groupBy("lang", F.substring("gram", 2, ORDER).alias("gram")).agg(F.count("*").alias("n"))
        orders.insert(0, stored(lower, "grams"))
    floor = stored(orders[0].groupBy("lang").agg((1 / (F.count("*") + 1)).alias("lower")), "floor")
    entry = lambda gram, logp, backoff: [
        "lang", gram.alias("gram"), logp.cast("double").alias("logp"), backoff.cast("double").alias("backoff")
    ]
    model = floor.select(*entry(F.lit(_UNSEEN), F.log("lower"), F.lit(None)))
    context = Window.partitionBy("lang", "context")
    shorter, steps = None, []
    for n, grams in enumerate(orders, 1):
        rows = lookup_join(grams, stored(_discounts(grams), "discounts"), "lang", "inner")
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.select("lang", "gram", "n", discount.alias("d"), F.substring("gram", 1, n - 1).alias("context"))
        if shorter is None:
            rows = lookup_join(rows, floor, "lang", "inner")
        else:
            rows = rows.withColumn("_short", F.substring("gram", 2, n)).join(shorter, ["lang", "_short"])
        weight = F.sum("d").over(context) / F.sum("n").over(context)
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.sum("n").over(context)
        rows = rows.withColumn("p", own + weight * F.col("lower")).withColumn("weight", weight)
        first = F.row_number().over(context.orderBy("gram")) == 1
        rows = stored(rows.select("lang", "gram", "p", F.when(first, F.col("weight")).alias("weight")), f"order{n}")
        steps.append(rows)
        shorter = rows.select("lang", F.col("gram").alias("_short"), F.col("p").alias("lower"))
        model = model.unionByName(rows.select(*entry(F.col("gram"), F.log("p"), F.lit(None))))
        model = model.unionByName(rows.where("weight IS NOT NULL").select(*entry(F.substring("gram", 1, n - 1), F.lit(None), F.log("weight"))))
    whole = stored(model, "model")
    dropped(*orders, *steps, floor)
    return whole


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _mixed(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    value = (value ^ code.astype(np.uint64)) * _MIX
    return value ^ value >> np.uint64(32)


def suffix_keys(codes: np.ndarray, seeds: np.ndarray, order: int = ORDER) -> list[np.ndarray]:
    """For n from 1: keys of the n characters that end at each place (from place n - 1 on)."""
    keys = [_mixed(seeds, codes)]
    for n in range(1, order):
        keys.append(_mixed(keys[-1][1:], codes[:-n]))
    return keys


class Table:
    """Numbers by 64-bit key: open addressing in arrays, looked up many at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.size = max(16, int(len(keys) / _FILLED))
        self.keys, self.values = np.zeros(self.size, np.uint64), np.zeros(self.size, np.float32)
        keys, first = np.unique(np.maximum(keys, np.uint64(1)), return_index=True)
        values, slots = values[first].astype(np.float32), self._slots(keys)
        while len(keys):
            slots, order = np.unique(slots, return_index=True)
            free = self.keys[slots] == 0
            self.keys[slots[free]], self.values[slots[free]] = keys[order[free]], values[order[free]]
            rest = np.ones(len(keys), bool)
            rest[order[free]] = False
            keys, values = keys[rest], values[rest]
            slots = self._slots(keys)
            pending = np.ones(len(keys), bool)
            while pending.any():  # the next free slot of each key
                taken = self.keys[slots] != 0
                slots[taken] = (slots[taken] + 1) % self.size
                pending = taken

    def _slots(self, keys):
        return (((keys * _MIX) >> np.uint64(32)) * np.uint64(self.size) >> np.uint64(32)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, which were found)."""
        keys = np.maximum(keys, np.uint64(1))
        slots = self._slots(keys)
        held = self.keys[slots]
        values, found = self.values[slots], held == keys
        open_ = np.flatnonzero(~found & (held != 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % self.size
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            values[open_[hit]], found[open_[hit]] = self.values[slots[open_[hit]]], True
            open_ = open_[~hit & (held != 0)]
        return values, found


def _keys_of(table: pa.Table) -> np.ndarray:
    """Keys of the ``gram`` strings of a language's model."""
    langs, grams = table.column("lang").to_pylist(), table.column("gram").to_pylist()
    seeds = {lang: _seed(lang) for lang in set(langs)}
    keys, sizes = np.empty(len(grams), np.uint64), np.array([len(g) for g in grams])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        codes = np.frombuffer("".join([grams[i] for i in at]).encode("utf-32-le"), np.uint32).reshape(-1, n)
        key = np.array([seeds[langs[i]] for i in at], np.uint64)
        for k in range(n - 1, -1, -1):
            key = _mixed(key, codes[:, k])
        keys[at] = key
    return keys


def _shard(model: DataFrame, shards: int, shard: int) -> tuple[Table, Table, dict[str, float]]:
    """Probabilities, backoff weights and the unseen character's probability of one shard."""
    code = lambda back: F.ascii(F.substring("gram", -back, 1)).cast("long")
    ends = lambda back: F.pmod((_NEAR * code(back) + code(back + 1)) * _NEAR + code(back + 2), F.lit(shards)) == shard
    grams = model.where(f"logp IS NOT NULL AND length(gram) BETWEEN 1 AND {ORDER}").where((F.length("gram") < 4) | ends(2))
    contexts = model.where("backoff IS NOT NULL AND length(gram) > 0").where((F.length("gram") < 3) | ends(1))
    unseen = model.where(F.col("gram") == _UNSEEN).select("lang", "logp").collect()  # a row per language
    return _packed(grams, "logp"), _packed(contexts, "backoff"), {row[0]: row[1] for row in unseen}


def _packed(entries: DataFrame, value: str) -> Table:
    """A lookup table of a shard. Tasks turn n-grams into keys, so the driver gets numbers only."""

    def pack(batches):
        for batch in batches:
            keys = pa.array(_keys_of(pa.Table.from_batches([batch])).view(np.int64))
            yield pa.RecordBatch.from_arrays([keys, batch.column(2).cast(pa.float32())], ["key", "value"])

    packed = entries.select("lang", "gram", value).mapInArrow(pack, "key long, value float").toArrow()
    return Table(packed.column("key").to_numpy().view(np.uint64), packed.column("value").to_numpy())


def _scores(langs: list[str], texts: list[str | None], shards: int, shard: int, tables) -> np.ndarray:
    """Negative log-likelihood of each text, over the positions that belong to the shard."""
    probabilities, backoffs, unseen = tables
    usable = [i for i, (lang, text) in enumerate(zip(langs, texts)) if text and lang in unseen]
    out = np.zeros(len(texts))
    padded = [_PAD * (ORDER - 1) + texts[i] for i in usable]
    sizes = np.array([len(p) for p in padded], np.int64)
    if not len(sizes):
        return out
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(usable)), sizes)
    seeds = np.array([_seed(langs[i]) for i in usable], np.uint64)[owner]
    keys = suffix_keys(codes, seeds)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    real = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        real[starts + k] = False
    at = np.flatnonzero(real)
    if shards > 1:
        near = codes.astype(np.int64)
        at = at[((_NEAR * near[at - 1] + near[at - 2]) * _NEAR + near[at - 3]) % shards == shard]
    logs = np.zeros(len(codes))
    for n in range(ORDER, 0, -1):
        values, found = probabilities.find(keys[n - 1][at - (n - 1)])
        logs[at[found]] += values[found]
        at = at[~found]
        if n > 1 and len(at):
            weights, known = backoffs.find(keys[n - 2][at - 1 - (n - 2)])
            logs[at] += np.where(known, weights, 0)
    logs[at] += np.array([unseen[langs[i]] for i in usable])[owner[at]]
    out[usable] = -np.bincount(owner, logs, len(usable))
    return out


#: The columns that a judgement adds.
JUDGEMENT = ["_perplexity", "_threshold", "_kept"]


def perplexities(docs: DataFrame, model: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (all of ``docs`` if not given), ``_bits``, ``_size``: log-loss and characters.

    ``_bits`` (natural logs) is null for a text without characters, and for a language that
    the model doesn't know. Perplexity is ``exp(_bits / _size)``.
    """
    keep, spark = keep or docs.columns, docs.sparkSession
    shards = max(1, -(-model.count() // SHARD_ENTRIES))
    value = text if text in keep else "_text"  # a text that is kept need not travel twice
    extra = [] if text in keep else [docs[text].alias("_text")]
    rows = docs.select(*[docs[c] for c in keep], *extra, _language(docs["lang"]).alias("_lang"), F.lit(0.0).alias("_nll"))
    before = None
    for shard in range(shards):
        tables = spark.sparkContext.broadcast(_shard(model, shards, shard))
        rows = map_texts(rows, _scoring(tables, shards, shard, rows.columns.index(value)), rows.schema)
        if shard < shards - 1:  # one shard in a worker's memory at a time
            rows = stored(rows, "scored")
            if before is not None:
                dropped(before)
            before = rows
    size = F.length(F.coalesce(value, F.lit("")))
    return rows.select(*keep, F.when((size > 0) & (F.col("_nll") > 0), F.col("_nll")).alias("_bits"), size.alias("_size"))


def _scoring(tables, shards, shard, place):
    def run(batches):
        for batch in batches:
            langs, texts = batch.column(batch.num_columns - 2).to_pylist(), batch.column(place).to_pylist()
            nll, i = np.array(batch.column(batch.num_columns - 1)), 0
            while i < len(texts):  # about a slice's characters at once
                j, chars = i, 0
                while j < len(texts) and (j == i or chars < _SLICE):
                    chars += len(texts[j] or "")
                    j += 1
                nll[i:j] += _scores(langs[i:j], texts[i:j], shards, shard, tables.value)
                i = j
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(nll)], batch.schema.names)

    return run


def _judged(labels: DataFrame) -> DataFrame:
    """``doc_id, q`` of labelled documents: 1 if labelled good and never bad, 0 if ever bad."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).where("q IN (0, 1)")


def _held_out() -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(HELD_OUT)) == 0


def fit(docs: DataFrame, labels: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The model, and ``_lang, limit, middle``: of held-out log-losses.

    No text is shuffled while the bitmaps of the trusted ids, a bit per id, are below
    Catalyst's broadcast threshold: trusted texts are found and the held-out fold is scored
    where they lie, and the fold's labelled part is told by joining the scores.
    """
    judged = stored(_judged(labels), "judged")
    texts = docs.select("doc_id", "lang", text)
    trusted = stored(id_bitmaps(judged.where((F.col("q") == 1) & ~_held_out()), "doc_id"), "trusted")
    model = train(with_id_in(texts.where(~_held_out()), trusted, "doc_id"), text)
    scored = perplexities(texts.where(_held_out()), model, text, ["doc_id", "lang"]).join(judged.where(_held_out()), "doc_id")
    scored = stored(scored.withColumn("_lang", _language(F.col("lang"))).where("_bits IS NOT NULL"), "held")
    middle = scored.where("q = 1").groupBy("_lang").agg(F.percentile_approx(F.col("_bits") / F.col("_size"), 0.5, 10_000).alias("middle"))
    surprises = lookup_join(scored, stored(middle, "middle"), "_lang", "inner").withColumn("_surprise", _surprise())
    return model, stored(limits(stored(surprises.select("_lang", "middle", "q", "_surprise"), "surprises")), "limits")


def limits(surprises: DataFrame) -> DataFrame:
    """``_lang, limit, middle`` from ``_lang, middle, q, _surprise`` of held-out documents.

    The limit is a quantile of the good documents: the one that keeps the largest share of
    them less the share of bad ones that it keeps, of those that keep ``LEAST_KEPT`` of the
    good; it lies halfway between the documents on its sides. A language with too few
    documents takes the distance from the middle that is best for all languages together.
    Windows run over counts per bin, so a language has some thousand rows at most.
    """
    good, bad = F.col("q") == 1, F.col("q") == 0
    both = surprises.select("*", (F.col("_surprise") - F.col("middle")).alias("_far"), F.explode(F.array(F.col("_lang"), F.lit(_ALL))).alias("_of"))
    spread = F.percentile_approx(F.when(good, F.col("_far")), F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    fence = both.groupBy("_of").agg(spread.alias("f"), F.count_if(good).alias("n_good"), F.count_if(bad).alias("n_bad"))
    fence = fence.select("_of", "n_good", "n_bad", (F.col("f")[1] + FENCE * (F.col("f")[1] - F.col("f")[0])).alias("fence"))
    bins = both.groupBy("_of", F.floor(F.col("_far") / BIN).alias("bin")).agg(F.count_if(good).alias("good"), F.count_if(bad).alias("bad"))
    up, whole = Window.partitionBy("_of").orderBy("bin"), Window.partitionBy("_of")
    kept = lambda column: F.sum(column).over(up) / F.sum(column).over(whole)
    tried = bins.select(
        "_of", kept("good").alias("kept"), (kept("good") - F.try_divide(F.sum("bad").over(up), F.sum("bad").over(whole))).alias("gain"),
        ((F.col("bin") + 1 + F.coalesce(F.lead("bin").over(up), F.col("bin") + 1)) / 2 * BIN).alias("limit"),
    )
    best = tried.where(F.col("kept") >= LEAST_KEPT).groupBy("_of").agg(F.max(F.struct("gain", "limit")).alias("best"))
    # Without a bad document to reject, or if it is best to reject none, nothing bounds the limit from above.
    reach = F.when(F.col("best.gain") > 0, F.col("best.limit")).otherwise(F.col("fence"))
    found = fence.join(best, "_of", "left").select("_of", "n_good", "n_bad", reach.alias("reach"))
    found = stored(found, "reaches")
    together = found.where(F.col("_of") == _ALL).first()
    middles = surprises.groupBy(F.col("_lang").alias("_of")).agg(F.max("middle").alias("middle"))
    own = found.join(middles, "_of").withColumn("of_all", F.lit(together["reach"] if together else None).cast("double"))
    enough = (F.col("n_good") >= LEAST_GOOD) & (F.col("n_bad") >= LEAST_BAD)
    return own.select(F.col("_of").alias("_lang"), (F.col("middle") + F.when(enough, F.col("reach")).otherwise(F.col("of_all"))).alias("limit"), "middle")


def _surprise() -> Column:
    """Log-loss per character, drawn to the language's middle where characters are few."""
    return (F.col("_bits") + PRIOR_CHARS * F.col("middle")) / (F.col("_size") + PRIOR_CHARS)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default all), ``_perplexity``, ``_threshold``, ``_kept``; a row per row.

    Kept are texts at or below their language's threshold, and those of languages without
    trusted documents, which cannot be judged. A null or empty text is not kept. A null
    language is one of its own. Without labels everything but empty texts is kept. Kept
    columns named like one of the three results give way to it.
    """
    model, limits = fit(docs, labels, text)
    rows, names = renamed(docs)
    value = names[text]
    rows = rows.select("*", F.col(names["lang"]).alias("lang"), (F.length(F.coalesce(F.col(value), F.lit(""))) > 0).alias("_filled"))
    kept = {name: names[name] for name in (keep or docs.columns)}
    scored = perplexities(rows, model, value, [*kept.values(), "lang", "_filled"])
    judged = lookup_join(scored.withColumn("_lang", _language(F.col("lang"))), limits, "_lang", "left")
    stays = F.col("_filled") & F.coalesce(_surprise() <= F.col("limit"), F.lit(True))
    perplexity, threshold = F.exp(F.col("_bits") / F.col("_size")), F.exp("limit")
    return judged.select(*restored(kept, JUDGEMENT), *[c.alias(name) for c, name in zip((perplexity, threshold, stays), JUDGEMENT)])


def kept_only(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all columns, whatever their names."""
    _, names = renamed(docs)
    needed = {text: "text", "doc_id": "doc_id", "lang": "lang"}
    names |= needed  # these keep their names, all others get inner ones
    judged = classify(docs.toDF(*[names[c] for c in docs.columns]), labels)
    return judged.where("_kept").select(restored(names, []))
