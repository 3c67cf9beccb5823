"""Plain versions of the operators, for a few rows."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(nodes, links):
    """node -> smallest node reachable."""
    up = {n: n for n in nodes}

    def end(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = end(a), end(b)
        up[max(a, b)] = min(a, b)
    return {n: end(n) for n in nodes}


def shingles(text):
    words = WORD.findall((text or "").translate(SMALL))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_documents(rows):
    """(row number -> (set size, smallest row of its component)) of texts."""
    sets = [shingles(t) for t in rows]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    found = components(range(len(sets)), links)
    return {i: (len(sets[i]), found[i]) for i in found}


def without_repeats(texts, window):
    """(words, removed, kept digest) of each text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def targets(sizes, share=1.5, weights=(3, 1, 2), most=2):
    """source -> target, by sharing the excess again until none is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = share * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in done]
        left, by = total - sum(done.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / by > most * sizes[s] * (1 + 1e-12)]
        if not over:
            return done | {s: left * weight[s] / by for s in open_}
        done |= {s: most * sizes[s] for s in over}


def network_score(network, data):
    """The quality network on the bytes of one text, window by window."""
    from subjectlog.llm import quality as q

    n = max(1, -(-len(data) // q.STRIDE))
    padded = data + b"\0" * (n * q.STRIDE + q.WIDTH - len(data))
    filters = network.p["filters"].reshape(q.WIDTH * q.DIMS, q.FILTERS)
    values = []
    for i in range(n):
        window = np.frombuffer(padded[i * q.STRIDE : i * q.STRIDE + q.WIDTH], np.uint8)
        values.append(network.p["bytes"][window].reshape(-1) @ filters)
    values = np.array(values) + network.p["bias"]
    pooled = np.array([np.maximum(values[i : i + q.CHUNK].max(0), 0) for i in range(0, n, q.CHUNK)])
    z = np.concatenate([pooled.mean(0), pooled.max(0)]) @ network.p["head"] + network.p["offset"][0]
    return 1 / (1 + np.exp(-z))


def gram_counts(text, buckets):
    """Hashed letter n-grams of a text, one by one; None without a letter."""
    import regex

    words = regex.findall(r"\p{L}+", text or "")
    if not words:
        return None
    x, full = [ord(c) for c in " " + " ".join(w.lower() for w in words) + " "], (1 << 64) - 1
    a, b, out = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, Counter()
    for n in (1, 2, 3):
        for i in range(len(x) - n + 1):
            g = 0
            for code in x[i : i + n]:
                g = g * b + code & full
            g = g * a & full
            out[((g ^ g >> 29) * b & full) >> 52] += 1
    return [out[i] for i in range(buckets)]


def nearest_centroid(model, text):
    """(language, cosine, rejected) of one text, centroid by centroid."""
    found = gram_counts(text, len(model.idf))
    if found is None or not model.languages:
        return "und", 0.0, True
    v = [np.log1p(n) * w for n, w in zip(found, model.idf)]
    long = sum(x * x for x in v) ** 0.5
    cosines = [sum(x * y for x, y in zip(v, c)) / long for c in model.centroids.tolist()]
    best = max(range(len(cosines)), key=cosines.__getitem__)
    return model.languages[best], min(1.0, max(0.0, cosines[best])), cosines[best] < model.radius[best]


def forest_score(trees, row):
    """The mean leaf that one row comes to, tree by tree."""
    total = 0.0
    for tree in trees:
        at = 0
        while tree[at][0] >= 0:
            feature, threshold, left, right, _ = tree[at]
            at = int(left if row[int(feature)] <= threshold else right)
        total += tree[at][4]
    return total / len(trees) if trees else 1.0


def value_features(value, words, transitions):
    """What the forest knows of a value itself, character by character (ASCII values)."""
    def kind(c):
        return 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit() else 3

    def place(c):
        return ord(c.lower()) - 97 if c.isalpha() else 26 if c.isdigit() else 27

    n, seen = len(value), Counter(value)
    pairs = list(zip(value, value[1:]))
    covered, at = 0, 0
    while at < n:
        size = next((k for k in range(min(12, n - at), 3, -1) if value[at : at + k].lower() in words), 0)
        covered, at = covered + size, at + max(1, size)
    return [
        n,
        *(sum(kind(c) == k for c in value) / n for k in range(4)),
        -sum(m / n * np.log2(m / n) for m in seen.values()),
        len(seen) / n,
        sum(transitions[place(a)][place(b)] for a, b in pairs) / len(pairs) if pairs else 0.0,
        sum(kind(a) != kind(b) for a, b in pairs) / len(pairs) if pairs else 0.0,
        covered / n,
        float(all(c in "0123456789abcdefABCDEF" for c in value)),
    ]
