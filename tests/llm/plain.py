"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOW))


test_words.__test__ = False


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(rows, window=13):
    """(doc_id, n_words, n_removed, kept_sha256); ids are not null here."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < d for j in range(i, i + window)}
        out.append((d, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out, key=repr)


def factors(rows, window=13):
    """doc_id -> (word_from, word_to, reference, reference_from) along the first occurrences of windows; ids are unique here."""
    first, texts = {}, {d: words(t) for d, t in rows}
    for d in sorted(texts):
        for i in range(len(texts[d]) - window + 1):
            first.setdefault(tuple(texts[d][i : i + window]), (d, i))
    out = {}
    for d, w in texts.items():
        spans = []
        for i in range(len(w) - window + 1):
            of, at = first[tuple(w[i : i + window])]
            if of == d:
                continue
            if spans and spans[-1][1] == i + window - 1 and spans[-1][2] == of and spans[-1][3] + i - spans[-1][0] == at:
                spans[-1][1] = i + window
            else:
                spans.append([i, i + window, of, at])
        out[d] = [tuple(x) for x in spans]
    return out


def contamination(rows, items, size=10):
    windows = defaultdict(set)
    for i, t in items:
        w = test_words(t)
        if 0 < len(w) < size:
            windows[tuple(w)].add(i)
        for k in range(len(w) - size + 1):
            windows[tuple(w[k : k + size])].add(i)
    lengths = {len(k) for k in windows}
    out = []
    for d, t in rows:
        w, hit, found = test_words(t), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return sorted(out, key=repr)


def counts(text):
    w = words(text)
    times = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    repeated = {j for k in range(len(w) - 4) if times[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeated)


def fingerprint(text):
    w = words((text or "").translate(_LOW))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows, tau=4):
    prints = {}
    for d, t in rows:
        prints.setdefault(d, []).append(fingerprint(t))
    ids = sorted(prints)
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if any((x ^ y).bit_count() <= tau for x in prints[a] for y in prints[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, f"{fingerprint(t):016x}", find(d)) for d, t in rows)


def jaccard_groups(rows, size=5, similarity=0.8):
    """(doc_id, text) of the rows that stay: the first by id of each group that pairs of the similarity connect; ids differ."""
    sets = []
    for _, t in rows:
        w = words((t or "").translate(_LOW))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0]))
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common >= similarity * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((order.index(find(a)), order.index(find(b))))
                root[order[y]] = order[x]
    return [rows[k] for k in order if find(k) == k]
