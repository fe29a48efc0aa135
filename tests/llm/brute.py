"""Plain single-machine versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_spans(t: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def secret_spans(t: str) -> list[tuple[int, int, int]]:
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def listed(spans, kinds) -> str:
    return ",".join(f"{kinds[k]}:{a}:{e}" for a, k, e in spans)


def quality_counts(t: str) -> tuple:
    w = WORD.findall(t)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def without_repeats(docs: list[tuple[int, str]], size: int = 13) -> dict[int, tuple[list[str], int]]:
    """doc_id -> (kept words, words); documents in ascending order decide."""
    first: dict[tuple, int] = {}
    out = {}
    for doc, text in sorted(docs):
        w = WORD.findall(text)
        windows = [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
        gone = {j for i, x in enumerate(windows) if first.get(x, doc) < doc for j in range(i, i + size)}
        for x in windows:
            first.setdefault(x, doc)
        out[doc] = ([v for i, v in enumerate(w) if i not in gone], len(w))
    return out


def shingles(text: str, n: int = 4) -> frozenset:
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(docs: list[tuple[int, str]], percent: int = 85, n: int = 4) -> dict[int, int]:
    sets = {d: shingles(t, n) for d, t in docs}
    low = {d: d for d in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                low[max(p, q)] = min(p, q)
    return {d: find(d) for d in sets}
