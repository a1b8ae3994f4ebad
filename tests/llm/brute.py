"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups(texts):
    """texts: one for each row; the group of each row as the set of its rows."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        met = Counter(j for g in s for j in holders[g])
        for j, n in met.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    out = defaultdict(set)
    for i in range(len(texts)):
        out[find(i)].add(i)
    return [out[find(i)] for i in range(len(texts))], [len(s) for s in sets]


def without_repeats(texts, length):
    """n_bytes, n_removed, n_spans, sha256 of each row."""
    raw, seen = [(t or "").encode() for t in texts], Counter()
    for b in raw:
        seen.update(b[s : s + length] for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), len(b) - len(left), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return out


def base_counts(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    met = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if met[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def spelling(docs, typos, shortest=6, rarest=5, ratio=5):
    """docs: (doc_id, text). Rows word, form, root, n, n_near, form_n."""
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if typos and h % typos == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= shortest and n >= rarest}
    holders = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holders["=" + w[:k] + "?" + w[k + 1 :]].add(w)
            holders["-" + w[:k] + w[k + 1 :]].add(w)
    near = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            near[w] |= holders["=" + w[:k] + "?" + w[k + 1 :]] - {w}
            shorter = w[:k] + w[k + 1 :]
            if shorter in words:
                near[w].add(shorter)
        near[w] |= holders["-" + w]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best
    rows = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return rows


def runs(words, least=12):
    """start, length, period of all runs, by trying every period."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q) and not any(words[i : i + length - d] == words[i + d : i + length] for d in range(1, q)):
                out.add((i, length, q))
            i = j
    return sorted(out)


def run_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for k, w in enumerate(words) if k not in gone)
    return doc_id, len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()
