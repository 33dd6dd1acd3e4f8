"""Plain rewritings of what the operators must give."""

import collections
import hashlib
import re


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c)
        total += sum(divmod(2 * x, 10)) if k % 2 else x
    return total % 10 == 0


def personal(text):
    text, out = text or "", [[], [], [], []]
    number = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out[0].append(m.span())
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out[1].append(m.span())
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(number(m)) <= 19 and luhn(number(m)):
            out[2].append(m.span())
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(number(m)) <= 15:
            out[3].append(m.span())
    told = ",".join(f"{k}:{a}:{b}" for k, spans in zip(("email", "ip", "card", "phone"), out, strict=True) for a, b in spans)
    return tuple(map(len, out)), hashlib.sha256(told.encode()).hexdigest(), told


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def jaccard(rows, width, percent):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {i: shingles(t, width) for i, t in rows}
    groups, holders = Union(sets), collections.defaultdict(list)
    for i in sorted(sets):
        for j, k in collections.Counter(j for s in sets[i] for j in holders[s]).items():
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                groups.join(i, j)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(s), groups.find(i)) for i, s in sets.items()}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def contamination(text, items, size=10):
    """(n_words, n_hit, items) of a text against {item_id: text}."""
    w, hit, found = words(text), set(), set()
    for item, t in items.items():
        g = words(t)
        for i in range(max(1, len(g) - size + 1) if g else 0):
            gram = g[i : i + size]
            for p in range(len(w) - len(gram) + 1):
                if w[p : p + len(gram)] == gram:
                    hit.update(range(p, p + len(gram)))
                    found |= set() if item is None else {str(item)}
    return len(w), len(hit), sorted(found)
