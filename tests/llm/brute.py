"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def exact(docs):
    """{(doc_id, text): (keep_id, group_size, kept)}"""
    groups = defaultdict(list)
    for d, t in docs:
        groups[re.sub("[\x20\x09-\x0D]", "", t or "")].append((d, t or ""))
    out = {}
    for norm, rows in groups.items():
        best = min(rows, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        for d, t in rows:
            out[(d, t)] = (best[0], len(rows), d == best[0] and len(t) == len(best[1]), sha(norm))
    return out


def windows(sequences, length):
    """{doc: starts of windows that also start in a document with a smaller id}"""
    low = {}
    for d, s in sequences:
        for i in range(len(s) - length + 1):
            k = tuple(s[i:i + length])
            low[k] = min(low.get(k, d), d)
    return [(d, [i for i in range(len(s) - length + 1) if low[tuple(s[i:i + length])] < d]) for d, s in sequences]


def gone(n, starts, length):
    out = [False] * n
    for i in starts:
        out[i:i + length] = [True] * length
    return out


def spans(flags):
    return sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))


def shingle_sets(texts, n):
    out = []
    for t in texts:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return out


def near(docs, n=5, percent=80):
    """[(doc_id, size, component)] in order."""
    sets = shingle_sets([t for _, t in docs], n)
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        low[r] = min(low.get(r, d), d)
    return [(d, len(sets[i]), low[find(i)] if sets[i] else d) for i, (d, _) in enumerate(docs)]


def boilerplate(docs, min_sites):
    """docs: (doc_id, text, site). {(doc_id, text): (text, lines, removed)}"""
    sites, first = defaultdict(set), {}
    for d, t, s in docs:
        for i, x in enumerate((t or "").split("\n") if t is not None else ()):
            if x.strip(" "):
                if s is not None:
                    sites[x].add(s)
                first[x] = min(first.get(x, (d, i)), (d, i))
    out = {}
    for d, t, s in docs:
        rows = t.split("\n") if t is not None else []
        kept = [x for i, x in enumerate(rows) if len(sites[x]) < min_sites or first.get(x) == (d, i)]
        out[(d, t)] = (None if t is None else "\n".join(kept), len(rows), len(rows) - len(kept))
    return out


def smith_waterman(item, passage, match=2, mismatch=-1, gap=-1):
    best = 0
    row = [0] * (len(passage) + 1)
    for x in item:
        new = [0]
        for j, y in enumerate(passage):
            new.append(max(0, row[j] + (match if x == y else mismatch), row[j + 1] + gap, new[j] + gap))
        row = new
        best = max(best, *row)
    return best


def language_vector(text, bank):
    """The bundled vector of a text, trigram by trigram."""
    letters = [c if c.isalpha() else " " for c in text.lower()]
    s = " " + "".join(letters) + " "
    s = re.sub(" +", " ", s)
    v = np.zeros(bank.dimensions)
    for i in range(len(s) - 2):
        a, b, c = (0 if x == " " else ord(x) for x in s[i:i + 3])
        v += np.roll(bank.letter(a), 2) * np.roll(bank.letter(b), 1) * bank.letter(c)
    return v
