"""Plain restatements of what the operators compute, over lists of (doc_id, text, ...)."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
INF = 1 << 62


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(t):
    return WORD.findall(t or "")


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def rank(doc_id):
    return INF if doc_id is None else doc_id


def exact(pairs):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", p[1] or "") for p in pairs]
    groups = defaultdict(list)
    for p, n in zip(pairs, norm):
        groups[n].append(p[0])
    out = []
    for p, n in zip(pairs, norm):
        keep = min((i for i in groups[n] if i is not None), default=None)
        out.append((p[0], keep, len(groups[n]), p[0] == keep, sha(n)))
    return out


def line_dedup(pairs):
    owner = {}
    def key(line):
        return low(line.strip(WS))
    for p in pairs:
        for line in (p[1] or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), INF), rank(p[0]))
    out = []
    for p in pairs:
        lines = (p[1] or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == rank(p[0])]
        out.append((p[0], len(lines), len(lines) - len(kept), sha("\n".join(kept)), "\n".join(kept)))
    return out


def shingles(t, n):
    w = words(low(t or ""))
    return {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()


def classes(pairs, n, percent):
    sets = [shingles(p[1], n) for p in pairs]
    parent = list(range(len(pairs)))
    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    real = [k for k, s in enumerate(sets) if s and pairs[k][0] is not None]
    ids = defaultdict(list)
    for k in range(len(pairs)):
        if pairs[k][0] is not None:
            ids[pairs[k][0]].append(k)
    for a in real:
        for b in real:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k in real:
        least[find(k)] = min(least.get(find(k), INF), pairs[k][0])
    return [(p[0], len(s), p[0] if p[0] is None or not s else least[find(k)]) for k, (p, s) in enumerate(zip(pairs, sets))]


def passages(pairs, size=13):
    first = {}
    for p in pairs:
        w = words(p[1])
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, INF), rank(p[0]))
    out = []
    for p in pairs:
        w = words(p[1])
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < rank(p[0]):
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((p[0], len(w), len(gone), sha(kept)))
    return out


def rule_counts(t):
    w = words(t)
    lines = [x for x in (t or "").split("\n") if x.strip(WS)]
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit))


def targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in over}


def crc(t):
    return zlib.crc32((t or "").encode())
