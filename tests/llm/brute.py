"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = (1 << 63) - 1


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def substring_dedup(docs, length=50):
    """(doc_id, n_words, n_removed, digest) of each (doc_id, text)."""
    words = [SPACED.findall(t or "") for _, t in docs]
    ids = [LAST if d is None else d for d, _ in docs]
    first = {}
    for d, w in zip(ids, words, strict=True):
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, LAST), d)
    out = []
    for (doc_id, _), d, w in zip(docs, ids, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((doc_id, len(w), sum(gone), sha(" ".join(kept))))
    return out


def contamination(docs, items, size=13):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each (doc_id, text)."""
    windows = defaultdict(set)
    lengths = set()
    for item, text in items:
        w = PLAIN.findall(lowered(text or ""))
        n = min(size, len(w))
        if n:
            lengths.add(n)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc_id, text in docs:
        w = PLAIN.findall(lowered(text or ""))
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    found |= got
                    hit[i : i + n] = [True] * n
        digest = sha(",".join(sorted(str(x) for x in found)))
        out.append((doc_id, len(w), sum(hit), len(found), digest, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def shingle_set(words, size=5):
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def near_classes(docs, least=0.8):
    """Smallest doc_id of the class of each of (doc_id, text): all pairs are compared."""
    words = [SPACED.findall(t or "") for _, t in docs]
    sets = [shingle_set(w) for w in words]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) >= least * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if both >= least * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        smallest[find(i)] = min(smallest.get(find(i), LAST), LAST if d is None else d)
    return [smallest[find(i)] for i in range(len(docs))]


def text_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    text = text or ""
    words = SPACED.findall(text)
    times = defaultdict(int)
    for i in range(len(words) - 2):
        times[tuple(words[i : i + 3])] += 1
    inside = [False] * len(words)
    for i in range(len(words) - 2):
        if times[tuple(words[i : i + 3])] > 1:
            inside[i : i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(inside),
    )


def targets(sizes, weights, share, repeats):
    """Target of each source: ``share`` of all sizes by weight, cut at ``repeats`` sizes, the rest shared again."""
    budget, full, out = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in sizes if s not in full]
        left = budget - sum(repeats * sizes[s] for s in full)
        weight = sum(weights[s] for s in open_)
        out = {s: repeats * sizes[s] if s in full else left * weights[s] / weight for s in sizes}
        above = {s for s in open_ if out[s] > repeats * sizes[s]}
        if not above:
            return out
        full |= above
