"""Plain versions of the operators, word by word, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return BLANK_WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def id_key(doc_id):
    return (doc_id is not None, doc_id or 0)


def substring_dedup(docs, window=13):
    first = {}
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, id_key(doc_id)), id_key(doc_id))
    out = []
    for doc_id, text in docs:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < id_key(doc_id):
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def line_runs(lines, window, long_line):
    """Start, end and key of every run of lines that is judged."""
    for i in range(len(lines) - window + 1):
        yield i, i + window, ("run", *lines[i : i + window])
    if window > 1:
        for i, line in enumerate(lines):
            if len(words(line)) >= long_line:
                yield i, i + 1, ("line", line)
    if 0 < len(lines) < window:
        yield 0, len(lines), ("document", *lines)


def line_dedup(docs, window=3, long_line=8):
    """Documents are (doc_id, text) with distinct ids."""
    first = {}
    for doc_id, text in docs:
        for i, _, key in line_runs(text.split("\n") if text else [], window, long_line):
            first[key] = min(first.get(key, (id_key(doc_id), i)), (id_key(doc_id), i))
    out = []
    for doc_id, text in docs:
        lines = text.split("\n") if text else []
        gone = set()
        for i, end, key in line_runs(lines, window, long_line):
            if first[key] != (id_key(doc_id), i):
                gone.update(range(i, end))
        out.append((doc_id, len(lines), len(gone), sha("\n".join(x for i, x in enumerate(lines) if i not in gone))))
    return out


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = LETTER_WORD.findall(lowered(text))
        m = min(size, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i : i + m])].add(str(item))
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w = LETTER_WORD.findall(lowered(text))
        hit, found = set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if items_here := windows.get(tuple(w[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= items_here
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def bag(text, size=5):
    w = words(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def similarity(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 1.0


def near_classes(texts, least=0.8):
    """Class number of each text: linked if similar enough, directly or through others."""
    bags = [bag(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, b in enumerate(bags):
        for key in b or [()]:
            holders[key].add(i)
    pairs = {p for who in holders.values() for p in itertools.combinations(sorted(who), 2)}
    for i, j in pairs:
        if similarity(bags[i], bags[j]) >= least:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def targets(sizes, weights, budget=1.5, most=2.0):
    """Share out by weight; what a full source cannot hold is shared again among the others."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = budget * sum(sizes.values())
    full = {}
    while True:
        open_ = [s for s in names if s not in full]
        left, held = total - sum(full.values()), sum(weight[s] for s in open_)
        share = {s: left * weight[s] / held for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return full | share
        full |= {s: most * sizes[s] for s in over}


def fingerprint_rows(docs):
    """(doc_id, n_chars, sha of the edited text) in order of ids."""
    docs = sorted(docs, key=lambda d: id_key(d[0]))
    out = []
    for i, (doc_id, text) in enumerate(docs):
        text, following = text or "", docs[(i + 1) % len(docs)][1] or ""
        n = len(text) // 4
        out.append((doc_id, len(text), sha(text[: len(text) - n] + following[:n])))
    return out


def feistel(number, n, key, rounds=6):
    """Cycle-walking Feistel permutation of 0 … n - 1; ``key(step, value)`` is the keyed hash."""
    rows = max(1, math.ceil(math.sqrt(n)))
    columns = max(1, math.ceil(n / rows))
    while True:
        row, column = divmod(number, columns)
        for step in range(rounds):
            if step % 2 == 0:
                row = (row + key(step, column) % rows) % rows
            else:
                column = (column + key(step, row) % columns) % columns
        number = row * columns + column
        if number < n:
            return number
