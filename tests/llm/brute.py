"""Plain versions of the corpus operators' contracts, for small fixtures."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
)


def pii(text):
    return [(k, m.start(), m.end()) for k, p, ok in PII for m in re.finditer(p, text or "") if ok(m)]


KEY = "(" + "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
SECRETS = (
    ("assign", KEY + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 8),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
)


def secrets(text):
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(SECRETS) for m in re.finditer(p, text or "") if ok(m)]
    return [(k, a, b) for a, _, k, b in sorted(found)]


def lines(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def contaminated(docs, benchmark, size=10):
    """docs: (doc_id, text); benchmark: (item_id, text)."""
    windows = {}
    for item, text in benchmark:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (owners := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    items |= owners
        out.append((doc, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    return out


def grams(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def near_copies(docs, similarity=0.8):
    """docs: (doc_id, text) with different ids: (doc_id, n_links, component_id) of each."""
    sets = {i: grams(t) for i, t in docs}
    links = []
    by_gram = {}
    for i, s in sets.items():
        for g in s:
            by_gram.setdefault(g, []).append(i)
    pairs = {(a, b) for owners in by_gram.values() for k, a in enumerate(owners) for b in owners[:k]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 5 * both >= 5 * similarity * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
            links.append((a, b))
    root = components(sets, links)
    n = {i: 0 for i in sets}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return [(i, n[i], root[i]) for i in sets]
