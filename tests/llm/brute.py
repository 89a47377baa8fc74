"""The operators' results, computed the long way in plain Python."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    w = words(text)
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(again))


def kept_lines(texts):
    """{id: (lines, dropped, kept text)} for {id: text}."""
    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = collections.defaultdict(set)
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = words((t or "").translate(LOWER))
        out[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def groups(texts):
    """{id: (set size, smallest id reached)}."""
    sets = shingle_sets(texts)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(texts, length=50):
    """{id: (words, removed, kept text)}."""
    first = {}
    split = {i: words(texts[i]) for i in sorted(texts)}
    for i, w in split.items():
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k:k + length]), i)
    out = {}
    for i, w in split.items():
        gone = set()
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < i:
                gone.update(range(k, k + length))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def water_fill(sizes, weights=(5, 2, 1), epochs=1.5, most=2.0):
    """{source: target} for {source: size}; None is last."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = epochs * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        if not open_:
            break
        level = (total - sum(most * sizes[s] for s in capped)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level >= most * sizes[s]}
        if not over:
            break
        capped |= over
    return {s: most * sizes[s] if s in capped else weight[s] * level for s in names}
