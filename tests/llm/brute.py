"""Plain restatements of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def benchmark_words(text):
    low = (text or "").encode().translate(FOLD).decode()
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contamination(docs, items, size=10):
    """docs, items: (id, text) rows -> id -> (n_words, n_hit, sorted items)."""
    windows = []
    for item, text in items:
        w = benchmark_words(text)
        windows += [(item, w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    out = {}
    for doc, text in docs:
        w, hit, found = benchmark_words(text), set(), set()
        for item, gram in windows:
            for i in range(len(w) - len(gram) + 1):
                if w[i:i + len(gram)] == gram:
                    hit.update(range(i, i + len(gram)))
                    found.add(str(item))
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def words(text):
    return (text or "").encode().split()


def repeats(docs, size=13):
    """(id, text) rows -> id -> (n_words, n_removed, kept text)."""
    first = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, doc), doc)
    out = {}
    for doc, text in docs:
        w = words(text)
        gone = {i + k for i in range(len(w) - size + 1) if first[tuple(w[i:i + size])] < doc for k in range(size)}
        out[doc] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def shingles(text, size=4):
    w = (text or "").encode().translate(FOLD).split()
    return frozenset([tuple(w)] if 0 < len(w) < size else (tuple(w[i:i + size]) for i in range(len(w) - size + 1)))


def jaccard_classes(docs, percent=85):
    """(id, text) rows -> id -> (set size, smallest linked id)."""
    sets = {doc: shingles(text) for doc, text in docs}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for doc, s in sets.items():
        for other, n in Counter(o for g in s for o in holders[g]).items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(doc)
    return {doc: (len(s), find(doc)) for doc, s in sets.items()}


def pii(text):
    """Base spans as kind:start:end, by start and then kind."""
    t, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in reversed(re.sub("[^0-9]", "", m[0]))]
        if 14 <= len(d) <= 19 and sum(d[::2] + [x * 2 - 9 * (x > 4) for x in d[1::2]]) % 10 == 0:
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]
