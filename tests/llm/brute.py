"""Plain single-machine forms of the operators, for small tables."""

import hashlib
import math
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\x0b\x0c\r"


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeats(docs, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, digest)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(piece)
        runs = re.findall(b"\1+", bytes(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = (len(data), sum(gone), len(runs), sha(kept))
    return out


ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def base_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    spans.sort()
    names = ("assign", "access", "hex")
    told = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
    counts = Counter(k for _, k, _ in spans)
    return (counts[0], counts[1], counts[2], sha(",".join(told))), told


def lines(docs, least=10):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(doc_id)
    out = {}
    for doc_id, text in docs:
        own = (text or "").split("\n")
        kept = [x for x in own if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != doc_id)]
        out[doc_id] = (len(own), len(own) - len(kept), sha("\n".join(kept)))
    return out


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text or "") if w]


def base_quality(text, window=8):
    text = text or ""
    own = words(text)
    grams = [tuple(own[i:i + window]) for i in range(len(own) - window + 1)]
    counts = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(window)}
    seen, twice = set(), 0
    for line in text.split("\n"):
        if words(line):
            twice += line in seen
            seen.add(line)
    n = len(own)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return (n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), twice, len(covered), failed)


def near(docs, n, percent):
    """doc_id -> (set size, component)."""
    def lower(text):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    sets = {}
    for doc_id, text in docs:
        own = words(lower(text))
        size = min(n, len(own))
        sets[doc_id] = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    shared = Counter((a, b) for own in holders.values() for i, a in enumerate(own) for b in own[i + 1:])
    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def quality_scores(docs, labels):
    """doc_id -> (score, kept), and the threshold: a restatement with its own hashing and loops."""
    def hashed(*values):
        seed = 42
        for v in values:
            data = v.encode() if isinstance(v, str) else struct.pack("<q", v)
            seed = xxhash.xxh64_intdigest(data, seed)
        return seed - (1 << 64) if seed >> 63 else seed

    size = max(256, 256 * round(sum(len((t or "").encode()) for _, t in docs) ** (1 / 3)))
    folds = {i: hashed(i) % 5 == 0 for i, _ in docs}
    trusted = {i for i, q in labels if q == 1}
    raw, target, grams = Counter(), Counter(), {}
    for i, text in docs:
        own = words(text)
        grams[i] = [hashed(w) % size for w in own] + [hashed(*p) % size for p in zip(own, own[1:])]
        raw.update(grams[i])
        if i in trusted and not folds[i]:
            target.update(grams[i])
    n_raw, n_target = sum(raw.values()), sum(target.values())
    ratio = lambda b: float(np.float32(math.log(((target[b] + 1) / (n_target + size)) / ((raw[b] + 1) / (n_raw + size)))))
    score = {i: sum(map(ratio, g)) / len(g) if g and n_target else 0.0 for i, g in grams.items()}
    failed = {i: base_quality(t)[-1] for i, t in docs}
    best = {}
    for i, q in labels:
        best[i] = max(q, best.get(i, q))
    good = [score[i] for i, q in best.items() if q == 1 and i in score and folds[i] and not failed[i]]
    bad = [score[i] for i, q in best.items() if q == 0 and i in score and not failed[i]]
    least = -0.1
    if good and bad:
        levels = sorted({math.floor(x / 0.001) for x in good + bad})
        value = {k: (sum(math.floor(x / 0.001) >= k for x in good) * len(bad) + sum(math.floor(x / 0.001) < k for x in bad) * len(good))
                 for k in range(levels[0], levels[-1] + 2)}
        first = min(k for k in value if value[k] == max(value.values()))
        stretch = [first]
        while value.get(stretch[-1] + 1) == value[first]:
            stretch.append(stretch[-1] + 1)
        least = stretch[len(stretch) // 2] * 0.001
    return {i: (score[i], not failed[i] and score[i] >= least) for i in score}, least


def leaks(docs, items):
    """(doc_id, item_id): every window of an item's length, or a shorter text as a whole, against that item, by
    weighted and by plain similarity of five-word shingles."""
    def own_words(text):
        return [re.sub(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$", "", w.lower()) or w.lower() for w in words(text)]

    def grams(own):
        return [tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))] if own else []

    items = {i: grams(own_words(t)) for i, t in items if own_words(t)}
    holders = defaultdict(set)
    for i, own in items.items():
        for g in own:
            holders[g].add(i)
    weight = lambda g: 1 / math.log2(1 + len(holders[g])) if g in holders else 1.0
    hits = set()
    for doc, text in docs:
        own = grams(own_words(text))
        for i in {i for g in own for i in holders.get(g, ())}:
            want = Counter(items[i])
            size = min(len(items[i]), len(own))
            for at in range(len(own) - size + 1):
                have = Counter(own[at:at + size])
                both, either = want & have, want | have
                alike = [sum(w(g) * k for g, k in both.items()) / sum(w(g) * k for g, k in either.items())
                         for w in (weight, lambda g: 1.0)]
                if max(alike) >= 0.8 - 1e-12:
                    hits.add((doc, i))
                    break
    return hits
