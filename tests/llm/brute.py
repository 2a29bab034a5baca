"""Plain reference versions of the operators' definitions, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
SHA = lambda b: hashlib.sha256(b).hexdigest()


def words(text):
    return WORD.findall(text or "")


def base_quality(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    c, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if c[x] > 1:
            covered.update(range(i, i + 5))
    n, r = len(w), len(covered)
    return (n, sum(map(len, w)), sum((text or "").count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), r,
            n < 10 or 100 * r > 20 * n)


def substring(rows, width=20):
    """rows (doc_id, text): list of (doc_id, n_words, n_removed, sha256)."""
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        w, gone = words(t), set()
        for s in range(len(w) - width + 1):
            k = tuple(w[s:s + width])
            if k in seen:
                gone.update(range(s, s + width))
            seen.add(k)
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), SHA(kept.encode())))
    return out


def targets(sizes):
    """sizes by source: targets of weights 1, 2, 3, repeating, stopped at 3 times the size."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, free, out = sum(sizes.values()), set(names), {}
    while free:
        left, sw = total - sum(out.values()), sum(w[s] for s in free)
        over = [s for s in free if left * w[s] / sw > 3 * sizes[s]]
        if not over:
            return out | {s: left * w[s] / sw for s in free}
        out |= {s: 3.0 * sizes[s] for s in over}
        free -= set(over)
    return out


def unigram(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of each row."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    toks = [(i, words((t or "").translate(low)) + [None]) for i, t in rows]
    c = Counter(x for i, w in toks if not held(i) for x in w)
    n, v = sum(c.values()), len(c)
    return [(i, held(i), len(w), sum(c[x] > 0 for x in w), n,
             sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)) for i, w in toks]


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def ordered_similarity(a, b, k=5):
    """m / (n1 + n2 - m), m: the longest common subsequence of the two lists of
    occurrence-labelled k-word shingles, by dynamic programming."""
    def labelled(w):
        k_ = min(k, len(w))
        n, out = Counter(), []
        for i in range(len(w) - k_ + 1 if w else 0):
            s = tuple(w[i:i + k_])
            out.append((s, n[s]))
            n[s] += 1
        return out

    x, y = labelled(a), labelled(b)
    if not x or not y:
        return 0.0
    row = [0] * (len(y) + 1)
    for p in x:
        diagonal = 0
        for j, q in enumerate(y):
            above = row[j + 1]
            row[j + 1] = diagonal + 1 if p == q else max(above, row[j])
            diagonal = above
    return row[-1] / (len(x) + len(y) - row[-1])


def near_copies(a, b, k=5):
    """In-order similarity of labelled shingles and Jaccard similarity of their sets, both 0.8 or more."""
    x, y = ({tuple(w[i:i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set() for w in (a, b))
    return bool(x and y) and len(x & y) >= 0.8 * len(x | y) and ordered_similarity(a, b, k) >= 0.8


def turns(rows):
    """conversations (conv_id, turn, role, text): conv_id -> (n, sha, loss chars, loss sha)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, v in by.items():
        v.sort()
        loss = "".join(x for *_, r, x in v if r == "assistant")
        out[c] = (len(v), SHA("".join(f"{r}\n{x}\n" for *_, r, x in v).encode()), len(loss), SHA(loss.encode()))
    return out
