"""Plain answers to compare with."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

SPACE = re.compile("[\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# Rows (doc_id, text, lang, source): missing values, empty, blank, very long, tied and repeated ones.
PASSAGE = " ".join(f"p{k}" for k in range(60))
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \t\n \x0b", None, "a"),
    (4, "One line here\nshared Line \nanother one of mine", "en", None),
    (4, "One line here\nshared Line \nanother one of mine", "en", None),
    (None, f"no id {PASSAGE} end", "en", "a"),
    (5, f"start {PASSAGE} tail words that differ", "en", "a"),
    (5, "same id but other text Été 你 x", "fr", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " and a little more", "en", "a"),
    (8, "a b a b a b a b a b a b " * 8, "en", "a"),
    *[(100 + k, f" SHARED line\t\nonly {k} is here\n\nshared line", "de", "b") for k in range(12)],
]
SCHEMA = "doc_id long, text string, lang string, source string"


def words(text, lower=False):
    text = (text or "").translate(LOWER) if lower else text or ""
    return [w for w in SPACE.split(text) if w]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def without_frequent_lines(texts, limit):
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (t or "").split("\n")]
    docs = Counter(k for t in texts for k in {*keys(t)} if k)
    return ["\n".join(x for x, k in zip((t or "").split("\n"), keys(t)) if docs[k] < limit) for t in texts]


def without_repeats(texts, window):
    tokens = [words(t) for t in texts]
    starts = defaultdict(list)
    for d, w in enumerate(tokens):
        for i in range(len(w) - window + 1):
            starts[tuple(w[i : i + window])].append((d, i))
    gone = {(d, i + j) for places in starts.values() if len(places) > 1 for d, i in places for j in range(window)}
    return [" ".join(x for i, x in enumerate(w) if (d, i) not in gone) for d, w in enumerate(tokens)]


def fingerprint(text, size):
    w = words(text, lower=True)
    shingles = [" ".join(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(count, linked):
    root = list(range(count))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(count):
        for b in range(a):
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(count)]


def shingles(text, size=5):
    w = words(text, lower=True)
    return {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))}


def repeated_words(text, size=5):
    w = words(text)
    seen = Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return len({i + j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(size)})
