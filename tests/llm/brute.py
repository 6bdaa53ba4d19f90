"""Plain-Python versions of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def removed(docs, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text) rows with distinct ids."""
    starts, out = {}, {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        b = (t or "").encode()
        cover = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if starts.setdefault(w, d) < d:
                cover[i:i + length] = [True] * length
        spans = sum(c and not (i and cover[i - 1]) for i, c in enumerate(cover))
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[d] = (len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest())
    return out


def rules(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    twice = Counter(windows)
    repeat = {j for i, w in enumerate(windows) if twice[w] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed


def longest_repeats(words):
    """For each word, the longest repeat that starts with it."""
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            k = 0
            while i != j and i + k < len(words) and j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_scores(docs):
    """doc_id -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    tokens = {d: WORD.findall(lower(t)) + [None] for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {d: (held[d], len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
            for d, ws in tokens.items()}


def shingles(text, n=5):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else Counter([tuple(words)] if words else [])


def classes(docs, similarity=0.8):
    """doc_id -> least doc_id of its class, by every pair that shares a shingle."""
    sets = {d: shingles(t) for d, t in docs}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for pair in {(a, b) for ds in holders.values() for a in ds for b in ds if a < b}:
        a, b = (sets[x] for x in pair)
        shared = sum((a & b).values())
        if shared >= similarity * (sum(a.values()) + sum(b.values()) - shared):
            x, y = find(pair[0]), find(pair[1])
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}
