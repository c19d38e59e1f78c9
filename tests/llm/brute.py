"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removals(rows, length=13):
    """{index: (words, mask of removed words)} for rows (doc_id, text)."""
    first = {}
    held = [words(text) for _, text in rows]
    for (doc_id, _), own in zip(rows, held):
        if doc_id is None:
            continue
        for k in range(len(own) - length + 1):
            key = tuple(own[k : k + length])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for (doc_id, _), own in zip(rows, held):
        mask = [False] * len(own)
        for k in range(len(own) - length + 1):
            if doc_id is not None and first[tuple(own[k : k + length])] < doc_id:
                mask[k : k + length] = [True] * length
        out.append((own, mask))
    return out


def shingles(text, size):
    own = words((text or "").translate(LOWER))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1)))


def components(rows, size, percent):
    """[(set size, component)] for rows (doc_id, text), all pairs compared."""
    sets = [shingles(t, size) for _, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, own in enumerate(sets):
        for s in own:
            holders.setdefault(s, []).append(i)
    for i, own in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s] if j < i)
        for j, n in shared.items():
            a, b = rows[i][0], rows[j][0]
            if a is None or b is None:
                continue
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
    return [(len(s), None if d is None else find(d)) for (d, _), s in zip(rows, sets)]


def repeats(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    own = words(text)
    windows = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    counts, mask = Counter(windows), [0] * len(own)
    for i, w in enumerate(windows):
        if counts[w] > 1:
            mask[i : i + 5] = [1] * 5
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), again, sum(mask)
