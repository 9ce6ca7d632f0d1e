"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def suffix_dedup(texts, width=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + width] for b in bodies for p in range(len(b) - width + 1))
    out = []
    for b in bodies:
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if seen[b[p : p + width]] > 1:
                gone[p : p + width] = b"\1" * width
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def without_passages(texts, n_words=51):
    """Texts without the words (and the blanks after them) of any run of ``n_words`` words that is found elsewhere too."""
    pieces = [re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", t or "") for t in texts]
    plain = [[p.strip("\t\n\x0b\x0c\r ") for p in ps] for ps in pieces]
    seen = Counter(tuple(w[i : i + n_words]) for w in plain for i in range(len(w) - n_words + 1))
    out = []
    for t, ps, w in zip(texts, pieces, plain, strict=True):
        gone = set()
        for i in range(len(w) - n_words + 1):
            if seen[tuple(w[i : i + n_words])] > 1:
                gone.update(range(i, i + n_words))
        lead = (t or "")[: len(t or "") - sum(map(len, ps))]
        out.append(None if t is None else lead + "".join(p for i, p in enumerate(ps) if i not in gone))
    return out


def shingle_set(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(keys, texts):
    """(n_shingles, least key of the component) of each row; rows are told apart by position."""
    sets = [shingle_set(t) for t in texts]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, k in enumerate(keys):
        r = find(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(least[r], k)
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def quality_counts(text):
    t = text or ""
    w = words(t)
    count = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if count[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def mix_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Target of each source from {source: words}, null last."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    free, total = set(names), share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in names if s not in free)
        level = rest / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > most * sizes[s]}
        if not over:
            return {s: level * w[s] if s in free else most * sizes[s] for s in names}
        free -= over
