"""Collocations against a brute-force version."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import lower

from phenomill.llm import hashed_words, phrase_mining

SCHEMA = "doc_id long, text string, lang string, phrase string, n double"


def expected(rows, least=10, longest=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        scored = []
        for p, a in found.items():
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            if 100 * longer[p] < 50 * a:
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def check(frame, rows, **options):
    docs = frame(SCHEMA, *[(1, t, lang, "x", 0.5) for t, lang in rows])
    assert sorted(tuple(r) for r in phrase_mining.collocations(docs, **options).collect()) == expected(rows, **options)


def prose(rng, size, words=40):
    marks = ["", "", "", "", ",", ".", "\n", "  ", "\t", "\x0b"]
    return " ".join(f"{rng.choice(['Wort', 'é', 'im', 'Of', '日本'])}{int(rng.paretovariate(0.6)) % words}{rng.choice(marks)}" for _ in range(size))


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_against_brute_force(frame, longest):
    rng = random.Random(longest)
    rows = [(prose(rng, rng.choice([0, 1, 5, 400])), rng.choice(["en", "en", "en", "de", None, "und", ""])) for _ in range(60)]
    rows += [(None, "en"), ("", None), ("new york city " * 30, "en"), ("a a a a a. " * 20, "fr"), ("x\x1cy z\x85w " * 12, "fr")]
    check(frame, rows, longest=longest)


def test_copies_top_and_long_text(frame):
    rows = [("in the beginning, was the word", "en")] * 300 + [("of the " * 200_000, "en"), ("the " + "q" * 2_000_000, "en")]
    check(frame, rows, top=3)


def test_empty_table(frame):
    assert phrase_mining.collocations(frame(SCHEMA)).collect() == []


def test_colliding_hashes(frame, monkeypatch):
    """Words and fingerprints of a few bits, in many small pieces: texts alone tell phrases apart."""
    monkeypatch.setattr(phrase_mining, "PRINTS_AT_ONCE", 1000)
    monkeypatch.setattr(phrase_mining, "SHARD_BYTES", 4000)
    real = phrase_mining.mix
    monkeypatch.setattr(phrase_mining, "mix", lambda h: real(h) & np.uint64(0xF800000000000000))
    rng = random.Random(9)
    rows = [(prose(rng, 300, 300), rng.choice(["en", "de"])) for _ in range(40)]
    rows += [("same hash " * 20, "en")]
    batch = pa.record_batch([pa.array([t for t, _ in rows]), pa.array([x for _, x in rows])], ["text", "lang"])
    chunk = next(hashed_words.chunks(batch.column(0), phrase_mining.BETWEEN))
    grams = phrase_mining.Grams(chunk, batch.column(1).to_pylist())
    number, sample = phrase_mining.exact_words(grams)
    said = [(int(grams.lang[i]), chunk.data[chunk.starts[i] : chunk.ends[i]].tobytes()) for i in range(len(number))]
    assert len({*zip(number.tolist(), said)}) == len(set(said)) == len(sample)
    found = []
    for part in phrase_mining._confirm("/nowhere", 0, 3)(iter([batch])):
        found.append(part)
    assert sum(p.num_rows for p in found) == 0  # no file, nothing is frequent


def test_memory_of_both_scans():
    """A task holds its fingerprints once, and only segments of a chunk at full width; nothing is lost in between."""
    rng = random.Random(4)
    vocabulary = [f"{rng.choice(['Wort', 'é', 'of'])}{i}" for i in range(60_000)]
    texts = [" ".join(rng.choices(vocabulary, k=20_000)) for _ in range(100)]
    batch = pa.record_batch([pa.array(texts), pa.array(["en"] * len(texts))], ["text", "lang"])
    total = 0
    tracemalloc.start()
    try:
        for part in phrase_mining._count(3, 4)(iter([batch])):
            for data in part.column("data").drop_null().to_pylist():
                total += int(np.frombuffer(data, np.uint32, len(data) // 12, len(data) // 12 * 8).sum())
        of_count = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        assert not sum(part.num_rows for part in phrase_mining._confirm("/nowhere", 4, 3)(iter([batch])))
        of_confirm = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 3 * 20_000 * 100 - 3 * 100
    assert of_count < 140e6 and of_confirm < 160e6, (of_count, of_confirm)
