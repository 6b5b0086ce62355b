"""Plain versions of the operators, for small inputs."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def random_texts(seed, texts, vocabulary, longest):
    """Texts of few words with copied stretches."""
    rng, out = random.Random(seed), []
    for _ in range(texts):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, longest))]
        if out and rng.random() < 0.6:
            other = rng.choice(out)
            a = rng.randint(0, len(other))
            at = rng.randint(0, len(own))
            own[at:at] = other[a:a + rng.randint(0, longest)]
        out.append(own)
    return out


def substring_removed(docs, window):
    """Places of words whose window starts in a document with a smaller id too."""
    least, gone = {}, {}
    for d, own in docs.items():
        for i in range(len(own) - window + 1):
            w = tuple(own[i:i + window])
            least[w] = min(d, least.get(w, d))
    for d, own in docs.items():
        gone[d] = {i + k for i in range(len(own) - window + 1) if least[tuple(own[i:i + window])] < d
                   for k in range(window)}
    return gone


def bytes_removed(docs, window, later=False):
    seen = Counter(b[i:i + window] for b in docs.values() for i in range(len(b) - window + 1))
    before, gone = set(), {}
    for d in sorted(docs):
        b, gone[d] = docs[d], set()
        for i in range(len(b) - window + 1):
            w = b[i:i + window]
            if (w in before) if later else seen[w] > 1:
                gone[d].update(range(i, i + window))
            before.add(w)
    return gone


def shingles(text, width=5):
    w = words((text or "").translate(UPPER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def groups(docs, percent=80):
    """Smallest reachable id by links of similar shingle sets."""
    sets = {d: shingles(t) for d, t in docs.items()}
    root = {d: d for d in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in docs:
        for b in docs:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in docs}, {d: len(s) for d, s in sets.items()}


def hits(text, items, window=10):
    """Hit word places and the items that have occurring windows."""
    w = MARKED.findall((text or "").translate(UPPER))
    places, found = set(), set()
    for item, body in items:
        own = MARKED.findall((body or "").translate(UPPER))
        n = min(window, len(own))
        known = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in known:
                places.update(range(i, i + n))
                found.add(str(item))
    return w, places, sorted(found)


def statistics(text):
    w = words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(repeated))
