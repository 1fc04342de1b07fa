"""The n-gram model against a brute-force version."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import lower, words

from phenomill.llm import common, hashed_words, kneser_ney


def expected(rows, order: int) -> dict:
    """Scores by id, from the definition, over tuples of strings."""
    fold = {k: zlib.crc32(("" if k is None else str(k)).encode()) % 5 for k, _ in rows}
    lines = [(k, [" start"] * (order - 1) + words(lower(t or "")) + [" end"]) for k, t in rows]
    raw, counts = Counter(), {order: Counter()}
    for k, line in lines:
        if fold[k] != 1:
            raw.update(line[order - 1 :])
            counts[order].update(tuple(line[i - order + 1 : i + 1]) for i in range(order - 1, len(line)))
    for level in range(order - 1, 0, -1):
        counts[level] = Counter(g[1:] for g in counts[level + 1])
    n, v = sum(raw.values()), len(raw)
    discounts, contexts = {}, {}
    for level, found in counts.items():
        of = Counter(found.values())
        if of[1] and of[2] and of[3]:
            y = of[1] / (of[1] + 2 * of[2])
            d = [0, 1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2], 3 - 4 * y * of[4] / of[3]]
        else:
            d = [0, -1, -1, -1]
        discounts[level] = d if all(0 <= d[k] <= k for k in (1, 2, 3)) else [0, 0.5, 1.0, 1.5]
        contexts[level] = defaultdict(list)
        for gram, c in found.items():
            contexts[level][gram[:-1]].append(c)

    def p(gram) -> float:
        if not gram:
            return 1 / (v + 1)
        level, seen = len(gram), contexts[len(gram)].get(gram[:-1])
        if not seen:
            return p(gram[1:])
        d, c = discounts[level], counts[level].get(gram, 0)
        return (c - d[min(c, 3)]) / sum(seen) + sum(d[min(x, 3)] for x in seen) / sum(seen) * p(gram[1:])

    out = {}
    for k, line in lines:
        tokens = line[order - 1 :]
        base = sum(math.log10((raw[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        score = sum(math.log10(p(tuple(line[i - order + 1 : i + 1]))) for i in range(order - 1, len(line)))
        out.setdefault(k, []).append((fold[k] == 1, len(tokens), sum(raw[t] > 0 for t in tokens), n, base, score))
    return out


def check(frame, rows, order=2):
    docs = frame("doc_id long, text string, score string, n_tokens double", *[(k, t, "x", 0.5) for k, t in rows])
    mine = defaultdict(list)
    for r in kneser_ney.held_out_scores(docs, order=order).collect():
        mine[r.doc_id].append(tuple(r)[1:])
    wanted = expected(rows, order)
    assert mine.keys() == wanted.keys()
    for k in wanted:
        for a, b in zip(sorted(mine[k]), sorted(wanted[k]), strict=True):
            assert a[:4] == b[:4]
            assert a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_brute_force(frame, order):
    rng = random.Random(order)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(300)] + ["The", "the", "É", "日本", "x" * 300, "</s>", "<s>"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 30, 200])))) for i in range(-5, 120)]
    rows += [(7, rows[3][1]), (None, "no id the the"), (None, None), (500, None), (501, " \t\n"), (502, "one\x1cword\x85")]
    check(frame, rows, order)


def test_hot_contexts_and_many_shards(frame, monkeypatch):
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 2000)
    monkeypatch.setattr(kneser_ney, "SAMPLED", 1)
    monkeypatch.setattr(kneser_ney, "GRAMS_AT_ONCE", 500)
    rng = random.Random(1)
    rows = [(i, " ".join(w for _ in range(60) for w in ("hot", f"v{rng.randrange(400)}"))) for i in range(60)]
    check(frame, rows)


def test_very_long_text_and_no_training(frame):
    rows = [(i, "long story " * 300_000 if i == 2 else f"short {i}") for i in range(6)]
    check(frame, rows)
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1]
    check(frame, [(i, "nothing learned") for i in held])
    empty = frame("doc_id long, text string")
    assert kneser_ney.held_out_scores(empty).collect() == []


def test_probabilities_sum_to_one(frame):
    """Over all known words and the unknown one, in seen and unseen contexts."""
    docs = frame("doc_id long, text string", *[(i, f"a b c a {'abcde'[i % 5]} a b") for i in range(20)])
    files = kneser_ney.Files(kneser_ney.fit(docs))
    known = common.word_hashes(b"a b c d e")
    targets = np.concatenate([known, [kneser_ney.END, np.uint64(5)]])
    for context in (*known, kneser_ney.START, np.uint64(77)):
        p, _ = files.probabilities([np.full(len(targets), context), targets])
        assert p.sum() == pytest.approx(1)


def test_chunked_words_equal_single_texts():
    texts = ["a bb  ccc", None, "", " x", "y ", "Zz\x1cé\x85 日本 \t\n\r\v\f q", "w" * 70, "tail"]
    for size in (1, 8, 1 << 20):
        hashed_words.CHUNK, kept = size, hashed_words.CHUNK
        try:
            found = [[] for _ in texts]
            for chunk in hashed_words.chunks(pa.array(texts)):
                for owner, h, s, e in zip(chunk.owner, chunk.hashes, chunk.starts, chunk.ends):
                    found[chunk.first + owner].append((int(h), chunk.data[s:e].tobytes().decode()))
        finally:
            hashed_words.CHUNK = kept
        for text, mine in zip(texts, found):
            plain = lower(text or "")
            assert [w for _, w in mine] == words(plain)
            assert [h for h, _ in mine] == common.word_hashes(plain.encode()).tolist()
