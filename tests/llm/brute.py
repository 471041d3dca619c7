"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from itertools import combinations

import xxhash

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, bool]]:
    sets = {}
    for doc_id, text in rows:
        w = SPACE.findall((text or "").translate(LOWER))
        sets[doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def base_counts(text: str | None) -> tuple:
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    triples = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def _grams(text: str | None, buckets: int) -> list[int]:
    def hashed(x: str, seed: int) -> int:
        return xxhash.xxh64_intdigest(x.encode(), seed)

    def signed(h: int) -> int:
        return h - (1 << 64) if h >= 1 << 63 else h

    units = re.findall(r"\w+|[^\w\s]+", text or "")
    one = [hashed(u, 42) for u in units]
    two = [hashed(u, h) for h, u in zip(one, units[1:])]
    return [signed(h) % buckets for h in one + two]


def quality_scores(rows: list[tuple[int, str | None]], trusted: set[int], buckets: int,
                   prior: float) -> list[float | None]:
    grams = [_grams(t, buckets) for _, t in rows]
    raw = Counter(g for x in grams for g in x)
    target = Counter(g for (d, _), x in zip(rows, grams) if d in trusted for g in x)
    n, m = sum(raw.values()), sum(target.values())
    return [sum(math.log((target[g] + prior) / (raw[g] / n * m + prior)) for g in x) / len(x)
            if x and m else None for x in grams]


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII)


def secrets(text: str | None) -> list[tuple[int, str, int]]:
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, k, e) for s, _, k, e in sorted(found)]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[str, int, int]]:
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def least_word_distance(item: list[str], words: list[str]) -> int:
    """Least edits between an item and any stretch of ``words``."""
    before = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(words, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)
