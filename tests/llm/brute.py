"""Plain Python versions of the operators' definitions, for small inputs."""

import hashlib
import re
from collections import Counter

FOLD = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(text or "")


def without_repeats(rows, window=20):
    """{id: (n_words, n_removed, digest)} for rows of (id, text) with distinct ids."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        ws, gone = words(text), set()
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out[doc] = (len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, size):
    ws = words((text or "").translate(FOLD))
    return {tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def near_classes(rows, size, percent=80):
    """{id: least id of its class} for rows of (id, text) with distinct ids."""
    sets = {doc: shingles(text, size) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc: find(doc) for doc in ids}


def contamination(rows, items, window=10):
    """{id: (n_words, n_hit, items)}."""
    wanted = {}
    for item, text in items:
        ws = PLAIN.findall((text or "").translate(FOLD))
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            wanted.setdefault(tuple(ws[i:i + n]), set()).add(str(item))
    out = {}
    for doc, text in rows:
        ws, hit, found = PLAIN.findall((text or "").translate(FOLD)), set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(ws) - n + 1):
                if (key := tuple(ws[i:i + n])) in wanted:
                    hit.update(range(i, i + n))
                    found |= wanted[key]
        out[doc] = (len(ws), len(hit), sorted(found))
    return out


def line_facts(text):
    ws = words(text)
    grams = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    again = {j for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


def periodic_runs(ws, least=12):
    """[(start, length, period)] of the maximal runs, by start and period."""
    found = {}
    for q in range(1, len(ws) // 2 + 1):
        at = 0
        while at + q < len(ws):
            to = at
            while to + q < len(ws) and ws[to] == ws[to + q]:
                to += 1
            if to + q - at >= max(least, 2 * q):
                found.setdefault((at, to + q - at), q)
            at = to + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in gone)


def mined(rows, positives=5, negatives=10, low=30, high=90):
    """Rows of (id, label, vector, anchor) with distinct ids to the mined tuples."""
    out = set()
    for a, label, u, asked in rows:
        if not asked:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i, other) for i, other, v, _ in rows if i != a)
        for p, i, other in [s for s in scored if s[2] == label][:positives]:
            fit = [(n, j) for n, j, x in scored if x != label and low * -p <= 100 * -n <= high * -p][:negatives]
            out |= {(a, i, rank, j, -p, -n) for rank, (n, j) in enumerate(fit, 1)}
    return out
