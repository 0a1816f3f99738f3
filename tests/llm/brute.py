"""Plain single-machine versions of the corpus operators, written from their contracts alone."""

import hashlib
import re
import zlib


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def removed_mask(rows, window=13):
    """rows: (doc_id, text) -> mask of removed words of each row."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        out.append((w, gone))
    return out


def shingle_set(text, n=5):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def components(rows, percent=75):
    """rows: (doc_id, text) with distinct ids -> doc_id: (set size, component)."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for p in ids:
        for q in ids:
            if p < q and sets[p] and sets[q]:
                common = len(sets[p] & sets[q])
                if 100 * common >= percent * (len(sets[p]) + len(sets[q]) - common):
                    a, b = sorted((root(p), root(q)))
                    parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in ids}


def base_quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    found = {}
    for k in range(len(w) - 4):
        found.setdefault(tuple(w[k : k + 5]), []).append(k)
    repeated = {p for at in found.values() if len(at) > 1 for k in at for p in range(k, k + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text):
    def digits(x):
        return re.sub("[^0-9]", "", x)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m[0])]


def best_fit_decreasing(lengths, capacity):
    import bisect

    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, length)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        n += gap == capacity
        if gap > length:
            bisect.insort(gaps, gap - length)
    return n


def crc(text):
    return zlib.crc32((text or "").encode())
