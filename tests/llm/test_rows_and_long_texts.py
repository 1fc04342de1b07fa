"""Repeated and missing ids in the dedup stages, and very long texts."""

from __future__ import annotations

import random
import string
import time

import public_tokenizers
import pytest
from helpers import components, lower, words
from tokenizers import Tokenizer

from phenomill.llm import exact_index, jaccard_join, jaccard_links, packing, secret_scan

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, digest string, key long"


def docs(frame, rows):
    return frame(SCHEMA, *[(k, t, "x", 1) for k, t in rows]).repartition(3)


def expected_exact(rows):
    by_text: dict = {}
    for k, t in rows:
        by_text.setdefault(lower(t or ""), []).append(k)
    return sorted(((t, max((k for k in v if k is not None), default=None)) for t, v in by_text.items()), key=str)


def test_exact_stage_keeps_one_row_of_each_text(frame):
    rows = [(5, "A"), (5, "B"), (9, "b"), (7, "C"), (7, "C"), (None, "c"), (None, "D"), (None, "d"), (None, None), (3, ""), (3, "E"), (4, "E"), (4, "F")]
    out = exact_index.drop_copies(docs(frame, rows))
    assert out.columns == ["doc_id", "text", "digest", "key"]
    assert sorted(((lower(r.text or ""), r.doc_id) for r in out.collect()), key=str) == expected_exact(rows)
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), f"text {rng.randrange(60)}") for _ in range(400)]
    out = exact_index.drop_copies(docs(frame, rows))
    assert sorted(((r.text, r.doc_id) for r in out.collect()), key=str) == expected_exact(rows)


def expected_near(rows):
    """What stays, as a set of (id, set of shingles), and how often: rows with an id and words once."""

    def shingles(text):
        w = words(lower(text or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = {shingles(t) for k, t in rows if k is not None and shingles(t)}
    links = [(a, b) for a in sets for b in sets if a is not b and 100 * len(a & b) >= 75 * len(a | b)]
    order = sorted(sets, key=lambda s: sorted(s))
    number = {s: i for i, s in enumerate(order)}
    of = components(range(len(order)), [(number[a], number[b]) for a, b in links])
    groups: dict = {}
    for k, t in rows:
        if k is not None and shingles(t):
            groups.setdefault(of[number[shingles(t)]], []).append(k)
    kept = sorted(min(v) for v in groups.values())
    stay = sorted({(k, t or "") for k, t in rows if k is not None and not shingles(t)}, key=str)
    return kept, stay, sum(k is None for k, _ in rows)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("module", [jaccard_join, jaccard_links])
def test_near_stage_judges_each_text_of_an_id(module, frame, seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(40)] for _ in range(12)]
    rows = []
    for _ in range(90):
        text = list(rng.choice(base))
        if rng.random() < 0.5:
            text[rng.randrange(38, 40)] = "other"
        rows.append((rng.choice([None, *range(25)]), " ".join(text)))
    rows += [(5, " ".join(base[0])), (5, " ".join(base[0])), (6, ""), (6, ""), (6, " "), (2, " ".join(base[1])), (None, ""), (None, None)]
    out = module.drop_near_copies(docs(frame, rows))
    assert out.columns == ["doc_id", "text", "digest", "key"]
    found = out.collect()
    kept, stay, without = expected_near(rows)
    assert sorted(r.doc_id for r in found if r.doc_id is not None and words(r.text or "")) == kept
    assert sorted(((r.doc_id, r.text or "") for r in found if r.doc_id is not None and not words(r.text or "")), key=str) == stay
    assert sum(r.doc_id is None for r in found) == without


@pytest.mark.parametrize("run", [" " * 1_000_000, "\n" * 1_000_000, "a" + " " * 1_000_000 + "b<|endoftext|>", "word " * 1_000_000])
def test_packing_of_very_long_texts(frame, run):
    want = Tokenizer.from_file(VOCABULARY).encode(run, add_special_tokens=False).ids
    assert packing.text_ids(run, VOCABULARY, public_tokenizers.PATTERN) == want
    out = packing.packed_documents(frame("doc_id long, text string", (1, run), (2, "short")), VOCABULARY, public_tokenizers.PATTERN)
    assert sum(r.length for r in out.collect() if r.doc_id == 1) == len(want) + 1


def test_random_text_on_both_sides_of_a_base_span():
    tokens, rng = secret_scan.encoding(RANKS), random.Random(4)
    letters = string.ascii_letters + string.digits
    for _ in range(50):
        left, right = ("".join(rng.choices(letters, k=40)) for _ in range(2))
        middle = "z" + "".join(rng.choices("0123456789abcdef", k=24)) + "Z"
        text = f"see {left}{middle}{right} end"
        spans = secret_scan.spans_of(text, secret_scan.MAX_RATIO, tokens)
        covered = set()
        for start, _, end in spans:
            covered.update(range(start, end))
        missed = [i for i in range(4, len(text) - 4) if i not in covered]
        assert len(missed) <= 4, (text, spans)
        assert secret_scan.base_spans(text) == [s for s in spans if s[1] != 3]


def test_parts_outside_base_spans_against_a_plain_version():
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choices("ab-. ", weights=(5, 5, 1, 0.1, 0.2), k=200))
        taken = []
        for _ in range(rng.randrange(6)):
            start = rng.randrange(200)
            taken.append((start, 2, min(200, start + rng.randrange(1, 40))))
        free = [not any(s <= i < e for s, _, e in taken) for i in range(200)]
        want = []
        for m in secret_scan.RUN.finditer(text):
            at = m.start()
            while at < m.end():
                end = at
                while end < m.end() and free[end]:
                    end += 1
                if end - at >= secret_scan.LEAST:
                    want.append((at, end))
                at = end + 1
        assert list(secret_scan._apart(text, taken)) == want


def test_scan_is_linear_in_the_text():
    tokens, rng = secret_scan.encoding(RANKS), random.Random(4)
    took = []
    for n in (2_000, 20_000):
        text = " ".join("".join(rng.choices("0123456789abcdef", k=24)) for _ in range(n))
        start = time.perf_counter()
        secret_scan.spans_of(text, secret_scan.MAX_RATIO, tokens)
        took.append(time.perf_counter() - start)
    assert took[1] < 40 * took[0] + 0.2
