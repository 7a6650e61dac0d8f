"""Plain versions of the contracts, one text at a time."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SECRETS = [
    ("assign", re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_spans(text):
    spans = []
    for i, (kind, pattern, good) in enumerate(SECRETS):
        spans += [(m.start(), i, kind, m.end()) for m in pattern.finditer(text or "") if good(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def base_digest(text):
    spans = base_spans(text)
    n = Counter(kind for kind, _, _ in spans)
    return n["assign"], n["access"], n["hex"], hashlib.sha256(listed(spans).encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 50 or 100 * len(again) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed
