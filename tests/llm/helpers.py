"""Brute-force versions and small tables for the operator tests."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width):
    found = words(text)
    if not found:
        return frozenset()
    own = min(width, len(found))
    return frozenset(tuple(found[i: i + own]) for i in range(len(found) - own + 1))


def components(texts, width, p, q):
    """{doc_id: (set size, smallest reachable id)} for (doc_id, text) pairs, by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in texts]
    parent = {i: i for i, _ in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and q * len(a & b) >= p * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], DOCS)
