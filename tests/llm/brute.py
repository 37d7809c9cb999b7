"""Plain versions of the operators, one document after the other."""

import re
from collections import defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    words = BLANK.findall(lower(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def components(rows, width=4, percent=85):
    """{id: (set size, smallest id reached)} of (id, text) rows with distinct ids."""
    sets = {i: shingles(text, width) for i, text in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = sets[ids[x]], sets[ids[y]]
            if 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(ids[x]), root(ids[y])))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def removed_words(rows, window=13):
    """[(words, removed numbers)] of (id, text) rows."""
    first = {}
    split = [(i, BLANK.findall(text or "")) for i, text in rows]
    for i, words in split:
        for p in range(len(words) - window + 1 if i is not None else 0):
            run = tuple(words[p:p + window])
            first[run] = min(first.get(run, i), i)
    out = []
    for i, words in split:
        gone = set()
        for p in range(len(words) - window + 1 if i is not None else 0):
            if first[tuple(words[p:p + window])] < i:
                gone.update(range(p, p + window))
        out.append((words, gone))
    return out


def hits(text, items, window=10):
    """(number of words, hit word numbers, items found, text without the spans) of one text."""
    phrases = defaultdict(set)
    for item, item_text in items:
        words = tuple(ALNUM.findall(lower(item_text)))
        width = min(window, len(words))
        for p in range(len(words) - width + 1 if width else 0):
            phrases[words[p:p + width]].add(str(item))
    found = [(m.group(), m.start(), m.end()) for m in ALNUM.finditer(lower(text))]
    words, hit, names = tuple(w for w, _, _ in found), set(), set()
    for p in range(len(words)):
        for width in {len(x) for x in phrases}:
            if words[p:p + width] in phrases and p + width <= len(words):
                hit.update(range(p, p + width))
                names |= phrases[words[p:p + width]]
    cleaned, at, p = "", 0, 0
    while p < len(words):
        if p in hit:
            q = p
            while q + 1 in hit:
                q += 1
            cleaned, at, p = cleaned + (text or "")[at:found[p][1]], found[q][2], q
        p += 1
    return len(words), hit, sorted(names), cleaned + (text or "")[at:]
