"""Plain versions of the operators for small tables."""

import collections
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def first_id(i):
    return -(1 << 63) if i is None else i


def substrings(rows, width):
    """(id, words, removed, kept) in order of (id, place in the table)."""
    seen, out = set(), []
    for _, (i, text) in sorted(enumerate(rows), key=lambda x: (first_id(x[1][0]), x[0])):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def components(sets, percent):
    """Smallest key that links reach, for a dict of sets."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: root(k) for k in keys}


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def katz(rows, k=5):
    """(id, held out, tokens, known, training tokens, base, score) and the normalisation of each history."""
    texts = [words((x or "").translate(LOWER)) + ["\n"] for _, x in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    one, two = collections.Counter(), collections.Counter()
    for text, out in zip(texts, held, strict=True):
        if not out:
            one.update(text)
            two.update(zip(["\0", *text[:-1]], text, strict=True))
    total, distinct = sum(one.values()), len(one)

    def discounted(counts):
        n = collections.Counter(counts.values())
        common = (k + 1) * n[k + 1] / n[1] if n[1] else 0
        take = {}
        for r in range(1, k + 1):
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0
            take[r] = d if 0 < d < 1 else (r - 0.5) / r
        above = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
        return lambda r: r - above if r > k else take[r] * r

    d1, d2 = discounted(one), discounted(two)
    unknown = 1 - sum(map(d1, one.values())) / total if total else 1.0
    uni = lambda w: d1(one[w]) / total if one[w] else unknown
    after = collections.defaultdict(dict)
    for (h, w), n in two.items():
        after[h][w] = n
    size = lambda h: one["\n"] if h == "\0" else one[h]
    weight = {h: (1 - sum(map(d2, x.values())) / size(h)) / (1 - sum(map(uni, x))) for h, x in after.items()}

    def p(h, w):
        if w in after.get(h, ()):
            return d2(after[h][w]) / size(h)
        return weight[h] * uni(w) if h in weight else uni(w)

    sums = [sum(p(h, w) for w in one) + p(h, "no such word") for h in list(after)[:20]]
    scores = []
    for (i, _), text, out in zip(rows, texts, held, strict=True):
        base = sum(math.log10((one[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in text)
        score = sum(math.log10(p(h, w)) for h, w in zip(["\0", *text[:-1]], text, strict=True))
        scores.append((i, out, len(text), sum(one[w] > 0 for w in text), total, base, score))
    return scores, sums
