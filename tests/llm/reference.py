"""Plain versions of what the operators compute, for small fixtures."""

import collections
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def linked(rows, percent=75):
    """(id, set size, smallest linked id) by comparing all documents that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    shared = collections.Counter()
    for held in holders.values():
        for x in range(len(held)):
            for y in range(x):
                shared[held[y], held[x]] += 1
    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[find(i)].append(key)
    return sorted((key, len(sets[i]), min(groups[find(i)])) for i, (key, _) in enumerate(rows))


def repeated(rows, least=50):
    """Spans of words that another document holds, by looking at every window."""
    texts = [words(t) for _, t in rows]
    holders = collections.defaultdict(set)
    for i, w in enumerate(texts):
        for j in range(len(w) - least + 1):
            holders[tuple(w[j : j + least])].add(i)
    out = {}
    for (key, _), w in zip(rows, texts):
        spans = []
        for j in range(len(w) - least + 1):
            if len(holders[tuple(w[j : j + least])]) > 1:
                if spans and j <= spans[-1][1]:
                    spans[-1][1] = j + least
                else:
                    spans.append([j, j + least])
        out[key] = [tuple(s) for s in spans]
    return out


def held_out(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus == 2


# fixed values: the base patterns of personal data
PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))
