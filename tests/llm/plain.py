"""Plain versions of the text operators, to hold small results against."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    patterns = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    )
    out = []
    for kind, pattern in patterns:
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in match.group().split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]
            if good():
                out.append((kind, *match.span()))
    return out


def contamination(text, items, window=10):
    """(words, hit words, item ids) by looking up every run of words."""
    windows = defaultdict(set)
    for key, item in items:
        w = words(item)
        runs = [w] if 0 < len(w) < window else [w[i : i + window] for i in range(len(w) - window + 1)]
        for run in runs:
            windows[tuple(run)].add("" if key is None else str(key))
    w, hit, found = words(text), set(), set()
    for size in {len(x) for x in windows}:
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found |= windows[tuple(w[i : i + size])]
    return w, hit, found


def ppm(training: list[bytes], order: int):
    """A function that gives the log10 probability of a text and its end."""
    contexts = defaultdict(Counter)
    end = bytes([255])
    for text in training:
        data = end * order + text + end
        for i in range(order, len(data)):
            for k in range(order + 1):
                contexts[data[i - k : i]][data[i]] += 1

    def score(text: bytes) -> float:
        data, total = end * order + text + end, 0.0
        for i in range(order, len(data)):
            ruled: set[int] = set()
            for k in range(order, -1, -1):
                left = {s: n for s, n in contexts.get(data[i - k : i], {}).items() if s not in ruled}
                if not left:
                    continue
                below = sum(left.values()) + len(left)
                if data[i] in left:
                    total += math.log10(left[data[i]] / below)
                    break
                total += math.log10(len(left) / below)
                ruled |= set(left)
            else:
                total -= math.log10(256 - len(ruled))
        return total

    return score


def repeats(rows, width: int):
    """{row number: (bytes, removed, runs, digest)} for (id, text) rows."""
    first: dict[bytes, tuple] = {}
    rank = lambda key: (key is not None, key or 0)
    for key, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            run = data[i : i + width]
            first[run] = min(first.get(run, (2, 0)), rank(key))
    out = {}
    for number, (key, text) in enumerate(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if first[data[i : i + width]] < rank(key):
                gone[i : i + width] = b"\1" * width
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[number] = (key, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def classes(texts, least=0.8, size=5):
    """The class of each text, as the smallest index that links lead to."""
    counted = []
    for text in texts:
        w = words(text)
        counted.append(Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else None)
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(counted):
        for j in range(i):
            b = counted[j]
            if a and b and sum((a & b).values()) >= least * sum((a | b).values()):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))]
