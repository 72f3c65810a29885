"""Plain, slow versions of what the operators compute."""

import collections
import math
import re

BLANKS = " \t\n\x0b\x0c\r"


def components(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def similar(sets, least):
    """All pairs of non-empty multisets with at least this weighted Jaccard similarity."""
    out = []
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if not a or not b or min(a.total(), b.total()) < least * max(a.total(), b.total()):
                continue
            common = (a & b).total()
            if common >= least * (a.total() + b.total() - common):
                out.append((i, j))
    return out


def line_dedup(docs, least=0.8):
    """Kept text of each (doc_id, text): first line of each group of similar lines stays, blank ones all do."""
    first = {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(BLANKS):
                first.setdefault(line, (doc_id, k))
    lines = list(first)
    sets = [collections.Counter({line[j : j + 5] for j in range(len(line) - 4)}) for line in lines]
    roots = components(len(lines), similar(sets, least))
    keep = {min(first[lines[i]] for i in range(len(lines)) if roots[i] == r) for r in set(roots)}
    return [
        "\n".join(x for k, x in enumerate((text or "").split("\n")) if not x.strip(BLANKS) or (doc_id, k) in keep)
        for doc_id, text in docs
    ]


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return collections.Counter()
    size = min(5, len(words))
    return collections.Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_classes(docs, least=0.8):
    """Smallest doc_id of the class of each (doc_id, text)."""
    texts = [t or "" for _, t in docs]
    edges = similar([shingles(t) for t in texts], least)
    edges += [(i, texts.index(t)) for i, t in enumerate(texts)]
    roots = components(len(docs), edges)
    return [min(docs[j][0] for j in range(len(docs)) if roots[j] == r) for r in roots]


def bench_words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leaks(text, items):
    """Ids of the items with a window of 13 words (or all) in the text, a fifth substituted at most; below 8 words all unchanged."""
    words, found = bench_words(text), set()
    for item_id, item in items:
        other = bench_words(item)
        size = min(13, len(other))
        if not other:
            continue
        needed = size - (math.floor(size * 0.2) if size >= 8 else 0)
        for shift in range(-len(other) + size, len(words) - size + 1):
            pairs = [(j, j + shift) for j in range(len(other)) if 0 <= j + shift < len(words)]
            same = [other[a] == words[b] for a, b in pairs]
            if any(sum(same[s : s + size]) >= needed for s in range(len(same) - size + 1)):
                found.add(item_id)
    return found


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    ]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m.group())]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def quality_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(inside),
    }
