"""Brute-force counterparts."""

import re
import unicodedata
from collections import defaultdict

import numpy as np


def neighbour_pairs(rows, k=15, least=0.6):
    """rows: (id, vector)."""
    rows = sorted((i, v) for i, v in rows if v and any(v))
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = np.round(x @ x.T, 9)
    np.fill_diagonal(s, -2)
    out = set()
    for i in range(len(rows)):
        for j in np.lexsort((ids, -s[i]))[:k]:
            if s[i, j] >= least:
                out.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return out


def clusters(rows, least=0.6, size=5):
    rows = [(i, v) for i, v in rows if v and any(v)]
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in zip(*np.nonzero(x @ x.T >= least)):
        parent[find(a)] = find(b)
    groups = defaultdict(list)
    for n, i in enumerate(ids):
        groups[find(n)].append(i)
    return {(min(g), i) for g in groups.values() if len(g) >= size for i in g}


def letters(text):
    return "".join(c for c in text.casefold() if c.isalnum() or unicodedata.category(c)[0] == "M")


def copies(rows):
    """rows: (id, fields, answer); copies up to the order of all letters, which labelled fields allow."""
    groups = defaultdict(list)
    for i, fields, answer in rows:
        if answer and answer.strip():
            groups[(*map(letters, fields), "".join(sorted(letters(answer))))].append(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


def odd_characters(text):
    """A plainer rule for what look-alike normalisation must touch."""
    bare = re.sub(r"(?<=[☀-➿\U0001F000-\U0001FAFF])\u200d(?=[☀-➿\U0001F000-\U0001FAFF])", "", text)
    if re.search("[​-\u200d⁠﻿\xad\xa0 -   ０-９Ａ-Ｚａ-ｚｦ-ﾟ⼀-⿟]", bare) or unicodedata.normalize("NFC", bare) != bare:
        return True
    return any(re.search("[A-Za-z]", w) and re.search("[Ѐ-ӿͰ-Ͽ]", w) for w in re.findall(r"[^\W\d_]+", bare))
