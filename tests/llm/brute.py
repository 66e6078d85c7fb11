"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash


def words(text) -> list[bytes]:
    return [w for w in re.split(rb"[\x20\x09-\x0D]+", lower((text or "").encode())) if w]


def lower(data: bytes) -> bytes:
    return bytes(b + 32 if 65 <= b <= 90 else b for b in data)


def components(nodes, links) -> dict:
    """The smallest node that each node reaches."""
    least = {n: n for n in nodes}

    def find(n):
        while least[n] != n:
            n = least[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        least[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def fingerprint(text, n: int) -> int:
    own = words(text)
    if not own:
        return 0
    grams = [b" ".join(own)] if len(own) < n else [b" ".join(own[i:i + n]) for i in range(len(own) - n + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def shingles(text, n: int) -> set:
    own = words(text)
    if not own:
        return set()
    return {tuple(own)} if len(own) < n else {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}


FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text) -> list[tuple[int, int, str]]:
    found = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                found.append((m.start(), rank, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def spans_text(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def cosine(a, b) -> float:
    a, b = np.asarray(a, float), np.asarray(b, float)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))
