"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(low(text))


def repeats(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each (doc_id, text)."""
    texts = [(t or "").encode() for _, t in rows]
    starts = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if starts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n):
    w = words(text)
    if len(w) >= n:
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {tuple(w)} if w else set()


def jaccard(rows, n, percent):
    """(doc_id, n_shingles, component_id) of each (doc_id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            same = len(a & sets[j])
            if a and sets[j] and 100 * same >= percent * (len(a) + len(sets[j]) - same):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return [
        (d, len(sets[i]), (min(least[find(i)]) if least[find(i)] else None) if sets[i] else d)
        for i, (d, _) in enumerate(rows)
    ]


def unigram(rows, trains):
    """(doc_id, n_tokens, n_known, N, base score) of each row."""
    tokens = [words(t) + ["\0"] for _, t in rows]
    count = Counter(x for (d, _), ts in zip(rows, tokens, strict=True) if trains(d) for x in ts)
    n, v = sum(count.values()), len(count)
    return [
        (d, len(ts), sum(count[x] > 0 for x in ts), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts))
        for (d, _), ts in zip(rows, tokens, strict=True)
    ]


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    under = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i : i + 8])] > 1:
            under |= set(range(i, i + 8))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(under)


def smallest_capacity(sizes, shards):
    """Smallest largest run of a cut of the sizes into so many runs."""
    for capacity in range(max(sizes), sum(sizes) + 1):
        runs, used = 1, 0
        for s in sizes:
            runs, used = (runs, used + s) if used + s <= capacity else (runs + 1, s)
        if runs <= shards:
            return capacity
    return 0


def tiles(text, item, shortest):
    """(words of the item marked, number of tiles) by greedy string tiling, all pairs of places."""
    shortest = min(shortest, len(item))
    a, b, count = [False] * len(text), [False] * len(item), 0
    while shortest:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(text)):
                k = 0
                while i + k < len(text) and j + k < len(item) and text[i + k] == item[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < shortest:
            break
        a[i : i + k] = b[j : j + k] = [True] * k
        count += 1
    return sum(b), count
