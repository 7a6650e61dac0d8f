"""Secrets in texts: three fixed patterns, and a battery of randomness tests for the rest.

A long run of key characters that no pattern names is tested twice, alone and by fixed rules.
Under the alphabet it seems to be written in, it must pass for random: chi-squared uniformity
of its symbols, runs about the middle of the alphabet, and serial correlation, joined by
Fisher's method; this turns away counters, repetitions and the like. And it must not pass for
words: its likelihood ratio, even draws from the alphabet against text made of words, names
and numbers, is an e-value (its mean over such text is at most 1, whatever the length), so
one over it bounds the p-value. A run counts as a secret if the false discoveries among all
runs stay below ``LEVEL`` (Benjamini-Hochberg on e-values, which may depend on each other).
Column functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import below, let, renamed, restored, running, total

#: Fixed patterns of the base kinds, in the order in which spans of one start are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6

#: Shortest run that is tested: below it, tests of randomness have no power.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: False discoveries among the added spans.
LEVEL = 0.05
#: Runs that look less random than all but this share of even draws are no keys.
LEAST_RANDOM = 1e-4
#: Steps of evidence: a quarter of a natural logarithm each, to e^500.
_STEPS, _HIGHEST = 4, 2000

_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings: the first whose pattern fits is inferred.
ENCODINGS = (
    (r"^[a-z]+$", _LOWER),
    (r"^[A-Z]+$", _LOWER.upper()),
    (r"^[0-9a-f]+$", _DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+=*$", _LOWER.upper() + "234567"),
    (r"^[a-z0-9]+$", _LOWER + _DIGITS),
    (r"^[A-Za-z0-9]+$", _LOWER.upper() + _LOWER + _DIGITS),
    (r"^[A-Za-z0-9+/]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    (r"", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
)
#: All key characters: small and capital letters, digits, signs.
_KEY = _LOWER + _LOWER.upper() + _DIGITS + "+/=_-"
#: Words: thousandths of letters a to z, means of English, French, German and Spanish, with a tenth spread evenly.
_LETTERS = (84, 18, 33, 44, 145, 13, 18, 29, 72, 5, 8, 44, 26, 73, 62, 22, 7, 67, 69, 66, 40, 13, 10, 6, 8, 9)
_SPREAD = 0.1
#: How words, names, numbers and paths go on: after small letters, capitals, digits, signs; and how they begin.
_NEXT = ((0.86, 0.05, 0.03, 0.06), (0.42, 0.46, 0.05, 0.07), (0.08, 0.05, 0.75, 0.12), (0.42, 0.22, 0.26, 0.10))
#: The same for words in capitals.
_CAPITALS = ((0.46, 0.42, 0.05, 0.07), (0.05, 0.86, 0.03, 0.06), (0.05, 0.08, 0.75, 0.12), (0.22, 0.42, 0.26, 0.10))
_FIRST = (0.50, 0.25, 0.20, 0.05)
_NUMBER = r"^[0-9]+$"
#: Code points of a window of text.
_WINDOW = 4096


def _spans(text: Column, pattern: str, kind: int) -> Column:
    """Matches as (start, kind, end, value) in code points, from the lengths of the texts between them."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(2 if kind == 0 else 0)).alias("value"),
    )

    def placed(found):
        ends = running(F.transform(found, lambda part: part["gap"] + part["size"]), lambda a, b: a + b)
        span = lambda part, end: F.struct((end - part["size"]).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value"))
        return let(ends, lambda e: F.transform(found, lambda part, i: span(part, F.get(e, i))))

    return F.when(text.rlike(pattern), let(F.filter(parts, lambda part: part["size"].isNotNull()), placed)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start, then kind as listed."""
    assigned = F.filter(_spans(text, ASSIGN, 0), lambda span: F.length(span["value"]) >= LEAST_VALUE)
    return F.sort_array(F.concat(assigned, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by the logistic approximation."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def alphabet_of(run: Column) -> Column:
    chosen = F.lit(ENCODINGS[-1][1])
    for pattern, alphabet in reversed(ENCODINGS[:-1]):
        chosen = F.when(run.rlike(pattern), alphabet).otherwise(chosen)
    return chosen


def randomness(run: Column) -> Column:
    """Chance that symbols drawn evenly from the run's alphabet look less random than it."""

    def with_alphabet(pair):
        symbols, alphabet = pair["symbols"], pair["alphabet"]
        k = F.length(alphabet)
        counts = F.transform(F.split(alphabet, ""), lambda c: F.length(symbols) - F.length(F.replace(symbols, c, F.lit(""))))
        squares = total(F.transform(counts, lambda c: (c * c).cast("long")))
        codes = F.transform(F.split(symbols, ""), lambda c: F.instr(alphabet, c))
        return let(F.struct(k.alias("k"), F.length(symbols).alias("n"), squares.alias("squares"), codes.alias("codes")), with_codes)

    def with_codes(s):
        k, n, codes = s["k"], s["n"], s["codes"]
        chi2 = k * s["squares"] / n - n
        spread = 2 / (9 * (k - 1))
        uniform = (F.pow(F.greatest(chi2, F.lit(0.0)) / (k - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
        high = F.transform(codes, lambda c: (2 * c > k).cast("int"))
        above = total(high)
        mean = total(codes) / n
        pairs = F.transform(F.slice(codes, 1, n - 1), lambda c, i: (c - mean) * (F.get(codes, i + 1) - mean))
        lagged = F.aggregate(pairs, F.lit(0.0), lambda a, b: a + b)
        varied = F.aggregate(codes, F.lit(0.0), lambda a, c: a + (c - mean) * (c - mean))
        serial = F.when(varied > 0, F.abs(lagged / varied) * F.sqrt(n)).otherwise(8.0)
        changes = let(high, lambda bits: total(F.transform(bits, lambda b, i: F.coalesce((F.get(bits, i + 1) != b).cast("int"), F.lit(0)))))
        expected = 2 * above * (n - above) / n
        deviation = F.sqrt(F.greatest(expected * (expected - 1) / (n - 1), F.lit(1e-9)))
        runs = F.when((above > 0) & (above < n), F.abs(changes - expected) / deviation).otherwise(8.0)
        half = -(F.log(_tail(uniform)) + F.log(2 * _tail(serial)) + F.log(2 * _tail(runs)))
        return let(F.greatest(half, F.lit(0.0)), lambda h: F.exp(-h) * (1 + h + h * h / 2))

    pair = F.struct(F.rtrim(run, F.lit("=")).alias("symbols"), alphabet_of(run).alias("alphabet"))
    return F.when(F.length(F.rtrim(run, F.lit("="))) < 2, 0.0).otherwise(let(pair, with_alphabet))


def _word_logs() -> tuple[list[int], list[float]]:
    """Per key character: its class, and the log of its chance in that class."""
    letters = [math.log((1 - _SPREAD) * x / sum(_LETTERS) + _SPREAD / 26) for x in _LETTERS]
    return [0] * 26 + [1] * 26 + [2] * 10 + [3] * 5, letters * 2 + [-math.log(10)] * 10 + [-math.log(5)] * 5


def evidence(run: Column) -> Column:
    """Log e-value of a run against words: even draws from its alphabet over text of words.

    Each encoding has an equal share of the even draws, so that choosing the first that fits
    costs ``log(len(ENCODINGS))`` and the mean over words stays below 1, in capitals or not.
    """
    classes, logs = _word_logs()
    floats = lambda values: F.array(*[F.lit(float(v)) for v in values])
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)

    def with_codes(codes):
        kind = lambda code: F.get(F.array(*map(F.lit, classes)), code)
        return let(F.transform(codes, kind), lambda kinds: with_classes(codes, kinds))

    def with_classes(codes, kinds):
        moves = F.transform(F.slice(kinds, 1, F.size(kinds) - 1), lambda kind, i: 4 * kind + F.get(kinds, i + 1))
        onward = lambda table: let(floats(math.log(p) for row in table for p in row), lambda logs_: add(F.transform(moves, lambda m: F.get(logs_, m))))
        begin = F.get(floats(map(math.log, _FIRST)), F.get(kinds, F.lit(0)))
        return begin + F.greatest(onward(_NEXT), onward(_CAPITALS)) + add(F.transform(codes, lambda c: F.get(floats(logs), c)))

    # A run that fits none of the encodings is held to be drawn from all key characters.
    even = F.lit(math.log(len(_KEY)))
    for pattern, alphabet in reversed(ENCODINGS[:-1]):
        even = F.when(run.rlike(pattern), math.log(len(alphabet))).otherwise(even)
    symbols = F.rtrim(run, F.lit("="))
    words = let(F.transform(F.split(symbols, ""), lambda c: F.instr(F.lit(_KEY), c) - 1), with_codes)
    return F.when(F.length(symbols) < 2, 0.0).otherwise(-F.length(symbols) * even - math.log(len(ENCODINGS)) - words)


def _step(run: Column) -> Column:
    """Evidence in whole steps, rounded down; 0 for what is neither words' contrary nor random."""
    steps = F.least(F.greatest(F.floor(evidence(run) * _STEPS), F.lit(0)), F.lit(_HIGHEST)).cast("int")
    return F.when(steps == 0, 0).when(randomness(run) >= LEAST_RANDOM, steps).otherwise(0)


def _apart(spans: Column, base: Column) -> Column:
    """``spans`` that overlap none of ``base``.

    Spans of one kind lie apart from each other, so the last that starts before the end of
    another span is the only one of its kind that need be looked at.
    """
    of_kind = lambda kind, field: F.transform(F.filter(base, lambda b: b["kind"] == kind), lambda b: b[field])
    bounds = F.struct(*[of_kind(kind, field).alias(f"{field}{kind}") for kind in range(3) for field in ("start", "end")])

    def alone(span, held):
        last = lambda kind: F.get(held[f"end{kind}"], below(held[f"start{kind}"], span["end"]) - 1)
        touched = [F.coalesce(last(kind) > span["start"], F.lit(False)) for kind in range(3)]
        return ~(touched[0] | touched[1] | touched[2])

    return F.when(F.size(base) == 0, spans).otherwise(let(bounds, lambda held: F.filter(spans, lambda span: alone(span, held))))


def least_step(docs: DataFrame, text: str = "text") -> int | None:
    """The least step of evidence that counts as a secret, if any does.

    Runs that touch a base span are found anyway: they make no false discovery less. What is shuffled are counts per step, of which there are ``_HIGHEST`` at most.
    """
    value = docs[text]
    spans = docs.where(value.rlike(CANDIDATE)).select(value.alias("_text")).select("_text", base_spans(F.col("_text")).alias("base"))
    runs = spans.select(F.explode(_apart(_spans(F.col("_text"), CANDIDATE, 3), F.col("base"))["value"]).alias("run"))
    counts = runs.where(~F.col("run").rlike(_NUMBER)).groupBy(_step(F.col("run")).alias("step")).agg(F.count("*").alias("n")).collect()
    of, found, least = sum(row["n"] for row in counts), 0, None
    for row in sorted(counts, key=lambda row: -row["step"]):
        found += row["n"]
        if row["step"] > 0 and row["step"] / _STEPS >= math.log(of / (LEVEL * found)):
            least = row["step"]
    return least


def _random_spans(text: Column, base: Column, least: int | None) -> Column:
    """Tested runs that count as secrets and touch no base span."""
    if least is None:
        return F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def secret(span):
        run = span["value"]
        return ~run.rlike(_NUMBER) & (_step(run) >= least)

    return F.filter(_apart(_spans(text, CANDIDATE, 3), base), secret)


def find_secrets(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``_text``, ``base`` and ``found``: arrays of (start, kind, end, value).

    Positions count code points, the end is exclusive, ``kind`` indexes ``KINDS``. ``found``
    holds base and added spans by start. A null text is searched as an empty one; documents
    without secrets have empty arrays; repeated rows stay; an empty table gives none. A kept
    column named like a result column gives way to it.
    """
    least = least_step(docs, text)
    rows, names = renamed(docs)
    rows = rows.select("*", F.coalesce(F.col(names[text]), F.lit("")).alias("_text"))
    rows = rows.select("*", base_spans(F.col("_text")).alias("base"))
    rows = rows.select("*", _random_spans(F.col("_text"), F.col("base"), least).alias("_added"))
    kept = restored({name: names[name] for name in keep}, ["_text", "base", "found"])
    return rows.select(*kept, "_text", "base", F.sort_array(F.concat("base", "_added")).alias("found"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def secret_scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The digest per document: counts per base kind, hash of the base spans, all spans."""
    found = find_secrets(docs, text, keep)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        *keep, *[count(i).alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["kind"] == 3)).cast("long").alias("n_random"),
    )


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, or group of overlapping ones, replaced by ``mark``.

    The text is cut into windows once, since to find a place in a string means to count from
    its start, and every piece that stays is put together from the windows it touches.
    """
    windows = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_WINDOW}}}"), F.lit(0))

    def piece(cut, start, end):  # code points from start, end exclusive
        first, last = F.floor(start / _WINDOW).cast("int"), F.floor((end - 1) / _WINDOW).cast("int")
        part = lambda window, i: F.substring(
            window, F.when(i == 0, start - first * _WINDOW).otherwise(0) + 1, F.when(i == last - first, end - last * _WINDOW).otherwise(_WINDOW) - F.when(i == 0, start - first * _WINDOW).otherwise(0)
        )
        return F.when(end <= start, "").otherwise(F.array_join(F.transform(F.slice(cut, first + 1, last - first + 1), part), ""))

    def put(held):
        before = lambda i: F.coalesce(F.get(held["ends"], i - 1), F.lit(0))
        kept = lambda span, i: F.when(
            span["start"] < before(i), ""
        ).otherwise(F.concat(piece(held["windows"], before(i), span["start"]), F.lit(mark)))
        return F.concat(F.array_join(F.transform(held["spans"], kept), ""), piece(held["windows"], F.element_at(held["ends"], -1), held["size"]))

    ends = running(F.transform(spans, lambda span: span["end"]), F.greatest)
    held = F.struct(windows.alias("windows"), spans.alias("spans"), ends.alias("ends"), F.length(text).alias("size"))
    return F.when(F.size(spans) == 0, text).otherwise(let(held, put))


def redact(docs: DataFrame, text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with a mark in place of each secret; ``size``, if there is such a column, follows the text.

    All rows and columns stay, whatever their names; a null text stays null.
    """
    rows, names = renamed(docs)
    rows = find_secrets(rows, names[text], tuple(names.values()))
    value = F.when(F.col(names[text]).isNotNull(), redacted(F.col("_text"), F.col("found")))
    rows = rows.withColumn(names[text], value)
    if size in names:
        length = F.length(names[text]).cast(docs.schema[size].dataType)
        rows = rows.withColumn(names[size], F.when(F.size("found") > 0, length).otherwise(F.col(names[size])))
    return rows.select(restored(names, []))
