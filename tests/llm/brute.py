"""Plain versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCAN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """{doc_id: (size of its set, component)}."""
    sets, inverse, parent = {d: shingles(t) for d, t in docs}, defaultdict(list), {d: d for d, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sorted(sets.items()):
        shared = Counter(e for x in s for e in inverse[x])
        for e, k in shared.items():
            if 100 * k >= 85 * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for x in s:
            inverse[x].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def passages(docs: list[tuple[int, str | None]], size: int = 20) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for d, t in sorted(docs):
        w, gone = WORD.findall(t or ""), set()
        for k in range(len(w) - size + 1):
            x = tuple(w[k:k + size])
            if x in seen:
                gone.update(range(k, k + size))
            seen.add(x)
        out[d] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def figures(text: str | None) -> tuple[int, int, int, int, int, bool]:
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    often = Counter(windows)
    covered = {i for k, x in enumerate(windows) if often[x] > 1 for i in range(k, k + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def phrases(text: str | None) -> tuple:
    w = SCAN_WORD.findall((text or "").translate(LOWER))
    hits = [(k, label) for phrase, label in PHRASES.items() for k in range(len(w))
            if w[k:k + len(phrase.split())] == phrase.split()]
    places = [k for k, _ in hits]
    return len(w), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))


def lines(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            holders[key(x)].add(d)
    out = {}
    for d, t in docs:
        parts = (t or "").split("\n")
        keep = [x for x in parts if len(key(x)) < 40 or len(holders[key(x)]) < 5 or d == max(holders[key(x)])]
        out[d] = (len(parts), len(parts) - len(keep), sha("\n".join(keep)))
    return out


def exact(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, bool, str]]:
    norm = {d: re.sub(r"[\x20\x09-\x0D]", "", t or "") for d, t in docs}
    groups = defaultdict(list)
    for d, t in docs:
        groups[norm[d]].append((-len(t or ""), d))
    return {d: (min(groups[norm[d]])[1], len(groups[norm[d]]), min(groups[norm[d]])[1] == d, sha(norm[d])) for d, _ in docs}


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[int, int, str, int]]:
    """(start, number of the kind, kind, end)."""
    good = {"email": lambda m: True, "ip": lambda m: all(int(x) <= 255 for x in m.split(".")),
            "card": lambda m: 12 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m)),
            "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15}
    return sorted((m.start(), k, kind, m.end()) for k, (kind, pattern) in enumerate(PII.items())
                  for m in re.finditer(pattern, text or "") if good[kind](m.group()))


def importance(docs: list[tuple[int, str | None]], target: list[str | None]) -> dict[int, tuple]:
    """{doc_id: (features, weight, score, rank)}."""
    def grams(text):
        w = SCAN_WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[k:k + n]).encode()) % 10000 for n in (1, 2, 3) for k in range(len(w) - n + 1)]

    own = {d: grams(t) for d, t in docs}
    s, t = Counter(b for _, g in own.values() for b in g), Counter(b for x in target for b in grams(x)[1])
    n, m = sum(s.values()), sum(t.values())
    out, enough = {}, []
    for d, (words, g) in own.items():
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n + 10000) / ((s[b] + 1) * (m + 10000)))) for b in g)
        h = int(sha(f"42:{d}")[:8], 16)
        out[d] = [len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        if words >= 20:
            enough.append((-out[d][2], d))
    for rank, (_, d) in enumerate(sorted(enough)[:5 * len(enough) // 100], 1):
        out[d][3] = rank
    return {d: tuple(x) for d, x in out.items()}


def collocations(docs: list[tuple[str | None, str | None]], least: int = 100, top: int = 2000) -> list[tuple]:
    """Rows of lang, rank, phrase, a, l, r, n, score; documents are (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[k:k + m]) for m in range(1, 6) for k in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = {p[i:i + m] for p, a in often.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
                  if a >= counts[p[i:i + m]]}
        rows = []
        for p, a in often.items():
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in inside:
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)
