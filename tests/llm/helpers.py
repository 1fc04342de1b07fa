"""Brute-force versions that the tests compare with."""

from __future__ import annotations

import hashlib
import re


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def components(nodes, links) -> dict:
    """Smallest reachable node of each node."""
    of = {n: n for n in nodes}

    def root(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        of[b] = a
    return {n: root(n) for n in nodes}


def same(mine, expected: dict) -> None:
    """Rows (key first) against a dict of tuples."""
    rows = {r[0]: tuple(r)[1:] for r in mine}
    assert len(rows) == len(expected) == len(mine)
    wrong = {k: (rows[k], expected[k]) for k in expected if rows[k] != expected[k]}
    assert not wrong, list(wrong.items())[:3]
