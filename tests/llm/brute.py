"""Plain versions of the operators, for comparison on small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    """Node to the smallest node that links reach."""
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_set(text, width=3):
    words = WORDS.findall((text or "").translate(LOWER))
    k = min(width, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def jaccard_components(rows, over=90, under=100):
    """rows: (doc_id, text) with distinct ids. doc_id to (size, component)."""
    sets = {d: shingle_set(t) for d, t in rows}
    links = []
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and under * len(x & y) >= over * len(x | y):
                links.append((a, b))
    found = components(ids, links)
    return {d: (len(sets[d]), found[d]) for d in ids}


def repetition(text, least):
    """(n_words, words in repeated triples, words in repeats of ``least`` words, longest repeat)."""
    words = WORDS.findall(text or "")
    n = len(words)
    triples = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    triple = {i + k for i in range(n - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    at = defaultdict(list)
    for i, w in enumerate(words):
        at[w].append(i)
    covered, longest = set(), 0
    for i in range(n):
        best = 0
        for j in at[words[i]]:
            k = 0
            while i != j and i + k < n and j + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= least:
            covered |= set(range(i, i + best))
    return n, len(triple), len(covered), longest


def best_fit(lengths, size):
    """Sequences that best-fit decreasing needs, one piece at a time."""
    import bisect

    free, bins = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, length)
        if at < len(free):
            room = free.pop(at)
        else:
            room, bins = size, bins + 1
        bisect.insort(free, room - length)
    return bins
