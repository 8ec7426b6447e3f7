"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Sets:
    """Union-find whose root is the smallest member."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)


def quality_counts(text):
    own = words(text)
    windows = Counter(zip(own, own[1:], own[2:]))
    covered = set()
    for i in range(len(own) - 2):
        if windows[tuple(own[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def substring_removal(docs, window=50):
    """doc -> which of its words go, for (doc, text) with unique ids."""
    own = {doc: words(text) for doc, text in docs if doc is not None}
    first = {}
    for doc in sorted(own):
        for i in range(len(own[doc]) - window + 1):
            first.setdefault(tuple(own[doc][i : i + window]), doc)
    gone = {}
    for doc, w in own.items():
        flags = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < doc:
                flags[i : i + window] = [True] * window
        gone[doc] = flags
    return own, gone


def base_secrets(text):
    found = []
    for m in re.finditer(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""
    ):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    for kind, (pattern, least) in enumerate(((r"AKIA[A-Z0-9]+", 20), (r"[0-9a-f]+", 24)), start=1):
        for m in re.finditer(pattern, text or ""):
            if len(m[0]) >= least:
                found.append((m.start(), kind, m.end(), ("access", "hex")[kind - 1]))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def near_classes(docs, size=5, threshold=0.8, common=0.01):
    """doc -> smallest id of its class under TF-IDF weighted Jaccard over word shingles, for texts that are not null."""
    from math import log

    n = len(docs)
    bags = {}
    for doc, text in docs:
        w = words(text)
        k = min(size, len(w))
        bags[doc] = Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else Counter()
    df = Counter(s for bag in bags.values() for s in bag)
    weigh = lambda s, count: count * (1 + log(1 / max(df[s] / n, common)) / log(1 / common))
    weights = {doc: {s: weigh(s, c) for s, c in bag.items()} for doc, bag in bags.items()}
    holders = defaultdict(list)
    for doc, bag in weights.items():
        for s in bag:
            holders[s].append(doc)
    sets = Sets()
    texts = {}
    for doc, text in docs:
        sets.join(doc, texts.setdefault(text, doc))
    for doc, bag in weights.items():
        for other in {o for s in bag for o in holders[s] if o > doc}:
            theirs = weights[other]
            both = sum(min(w, theirs.get(s, 0)) for s, w in bag.items())
            either = sum(bag.values()) + sum(theirs.values()) - both
            if either and both / either >= threshold:
                sets.join(doc, other)
    return {doc: sets.root(doc) for doc, _ in docs}
