"""The conversation trie against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from helpers import sha

from phenomill.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, t double"


def expected(rows) -> dict:
    """Nodes by (conv_id, depth) from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        remainder = abs(c) % 100 * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(c - remainder, [])[:h] + said[h:])
    members = defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(out[k][4] for k in children[node]) or 1
        saved = sum(out[k][5] for k in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(built[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out[node] = (parent, len(members[node]), len(children[node]), 0, leaves, saved, sha(ends))
    return {(min(members[n]), len(n), v[6], v[0]): (v[1], v[2], v[4], v[5]) for n, v in out.items()}


def check(frame, rows):
    found = prefix_trie.conversation_trie(frame(SCHEMA, *[(*r, "x", 0.5) for r in rows])).collect()
    mine = {(r.conv_id, r.depth, r.ends_sha256, r.parent_conv_id): (r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in found}
    assert len(mine) == len(found)
    assert mine == expected(rows)


def test_awkward_conversations(frame):
    rng = random.Random(5)
    rows = []
    for conv in [*range(-130, -90), *range(0, 60), 105, 107, *range(200, 230), 7_000_000_123]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            said = rng.choice(["ja", "no", "🙂 é", "", None])
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "user", None]), said))
    rows += [(50, 1, "user", "twice"), (50, 1, "user", "twice"), (None, 1, "user", "no id"), (51, 3, "user", None), (51, 3, None, "user")]
    check(frame, rows)


def test_copies_and_one_long_conversation(frame):
    rows = [(1000 + c, turn, "user", f"turn {turn}") for c in range(400) for turn in range(6)]
    rows += [(3, turn, "user", f"turn {turn % 7}") for turn in range(700)]
    rows += [(4, turn, "user", f"turn {turn % 7}") for turn in range(650)]
    check(frame, rows)


def test_long_text_and_single_rows(frame):
    check(frame, [(5, 0, "user", "word " * 1_000_000), (6, 0, "user", "word " * 1_000_000), (100, None, None, None)])
    check(frame, [(2, 0, "user", "alone")])


def test_empty_table(frame):
    assert prefix_trie.conversation_trie(frame(SCHEMA)).collect() == []


@pytest.mark.parametrize("length", [1, 4, 9])
def test_heights(frame, length):
    rows = [(c, turn, "user", str(turn if turn < length - 1 else c % 3)) for c in range(12) for turn in range(length)]
    check(frame, rows)
