import random

import pytest

WORDS = [a + b for a in ("ran", "tel", "mo", "sti", "ker", "dal", "ve", "fun") for b in ("do", "ster", "lin", "ga", "pet", "or", "ish", "ment")]


@pytest.fixture
def prose():
    """``prose(seed, n)``: n words in sentences, the same for the same seed."""

    def make(seed, n):
        pick = random.Random(seed)
        words = [pick.choice(WORDS) for _ in range(n)]
        for i in range(7, n, 9):
            words[i] += "."
        return " ".join(words) + "."

    return make


@pytest.fixture
def table(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(table):
    """``docs([text, ...])`` with doc_id from 0, or ``docs([(doc_id, text, lang), ...])``."""

    def make(rows, lang="en"):
        rows = [(i, r, lang) if not isinstance(r, tuple) else r for i, r in enumerate(rows)]
        return table([(i, t, l, "s", None if t is None else len(t)) for i, t, l in rows], DOCS)

    return make
