"""Plain, slow versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORDS.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality(text):
    w = words(text)
    n = len(w)
    windows = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    covered = {j for i in range(n - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, w)), symbols, dup, len(covered)


def repeated_bytes(texts, length):
    """texts: list of str; per text (n_bytes, n_removed, n_spans, sha)."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, sha(kept)))
    return out


def shingle_set(text, n):
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    if len(w) < n:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_components(docs, n, percent):
    """docs: list of (id, text) with unique ids."""
    sets = {i: shingle_set(t, n) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeated_lines(docs, least_chars=20, least_docs=3):
    """docs: list of (id, text) with unique ids; per id (n_lines, n_dropped, kept text)."""
    holders = defaultdict(set)
    key = lambda line: ascii_lower(line.strip(BLANK))
    for i, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        stay = [
            line
            for line in lines
            if not (len(key(line)) >= least_chars and len(holders[key(line)]) >= least_docs and i != max(holders[key(line)]))
        ]
        out[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def top_products(vectors, k, every):
    """vectors: list of (id, ints), distinct."""
    out = []
    for q, v in vectors:
        if q % every == 0:
            scored = sorted(
                ((-sum(a * b for a, b in zip(v, u, strict=True)), i) for i, u in vectors if i != q and len(u) == len(v))
            )[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


TERMS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall(ascii_lower(text or ""))


def ranked(docs, items, k):
    """docs: list of (id, text); items: list of (id, text); rows (item, rank, id, score)."""
    bodies = [(i, Counter(terms(t))) for i, t in docs]
    bodies = [(i, c, sum(c.values())) for i, c in bodies if c]
    total, n = sum(b[2] for b in bodies), len(bodies)
    df = Counter(term for _, c, _ in bodies for term in c)
    wanted = defaultdict(Counter)
    for i, text in items:
        if i is not None:
            wanted[i].update(terms(text))
    out = []
    for item, query in wanted.items():
        found = []
        for i, c, size in bodies:
            m = 75 + (25 * size * n) // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in query.items()
                if c[t]
            )
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def benchmark_hits(text, items, length):
    """n_words, n_hit, ids of the items (as strings, sorted) that occur."""
    w = terms(text)
    hit, held = set(), set()
    for item, body in items:
        q = terms(body)
        k = min(length, len(q))
        if item is None or not k:
            continue
        windows = {tuple(q[i : i + k]) for i in range(len(q) - k + 1)}
        for i in range(len(w) - k + 1):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                held.add(str(item))
    return len(w), len(hit), sorted(held)


def near_spelling(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spelling(docs):
    """docs: list of (id, text); word -> (n, n_near, form, form_n, root)."""
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = {w: [x for x in n if near_spelling(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n[w], len(near[w]), form[w], n.get(form[w]), root)
    return out
