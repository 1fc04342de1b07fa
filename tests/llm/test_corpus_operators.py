"""Vector codes, quality, repeated passages, shingle join, components: against brute force and on awkward input."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from helpers import components, lower, same, sha, words

from phenomill.llm import bounded, common, exact_index, jaccard_join, jaccard_links, near_dup_vectors, phrase_automata, quality_mil, queries
from phenomill.llm.components import connected_components

FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " \n", "one", "ONE", "one two three four", "one  two\tthree\rfour", "é\x1cü a b c d e", "x" * 4000]


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def near_copies(rng, base: list[str], n: int, changes: int) -> list[str]:
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, changes + 1)):
            own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


# components


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 300)] + [(5, 1000 + i) for i in range(500)] + [(2000 + i, 9000) for i in range(500)]
    edges += [(rng.randrange(20_000, 21_000), rng.randrange(20_000, 21_000)) for _ in range(700)] + [(-7, -7), (-3, -9)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "x long, y long").repartition(9)
    expected = components({n for e in edges for n in e}, edges)
    assert {r.node: r.component for r in connected_components(df).collect()} == {n: c for n, c in expected.items() if n != c}
    assert connected_components(df.limit(0)).count() == 0


# hashes and summaries


def test_word_hashes():
    for text in ("", "a", " a  b\tab\x0bba \x1c é x", "zz " * 400, "q" * 3000 + " end"):
        data = text.encode()
        starts, ends = common.word_spans(data)
        assert [data[s:e] for s, e in zip(starts, ends)] == data.split() == [w.encode() for w in words(text)]
        hashes = common.word_hashes(data)
        assert len(set(zip(hashes.tolist(), data.split()))) == len(set(data.split())) == len(set(hashes.tolist()))
    h = common.word_hashes(b"a b c a b c a b c")
    rolled = common.rolling_hashes(h, 3)
    assert len(rolled) == 7 and (rolled[:3] == rolled[3:6]).all() and len(set(rolled.tolist())) == 3


def test_bounded(spark):
    hashes = common.mix(np.arange(5000, dtype=np.uint64))
    df = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long").repartition(5)
    assert bounded.in_bitmap(hashes, 18, bounded.bitmap(df, 18)).all()
    strangers = common.mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))
    assert bounded.in_bitmap(strangers, 18, bounded.bitmap(df, 18)).mean() < 0.05


def test_split_by(frame):
    df = frame("k long, t string", *[(i, str(i)) for i in range(2000)], (None, "x"))
    likely, never = bounded.split_by(df, "k", frame("q long", *[(i,) for i in range(0, 2000, 100)]), 16)
    a, b = {r.k for r in likely.collect()}, {r.k for r in never.collect()}
    assert not a & b and len(a) + len(b) == 2001 and set(range(0, 2000, 100)) <= a and len(a) < 60 and None in b


# shingle join


def brute_join(rows, size=5, percent=75):
    sets = {}
    for key, text in rows:
        w = words(lower(text or ""))
        sets[key] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    links, keys = [], [k for k in sets if k is not None and sets[k]]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    of = components([k for k in sets if k is not None], links)
    return {k: (len(s), of.get(k)) for k, s in sets.items()}


def join_rows(rng):
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    texts = []
    for length, copies, changes in ((80, 120, 3), (60, 60, 5), (30, 20, 1), (200, 10, 9)):
        texts += near_copies(rng, rng.sample(vocabulary, length), copies, changes)
    line = rng.sample(vocabulary, 40)  # a passage that many documents share
    texts += [" ".join(rng.sample(vocabulary, 15) + line + rng.sample(vocabulary, 10)) for _ in range(60)]
    texts += [" ".join(line)] * 30 + ["Same Words In This Text here"] * 40 + ["same words in THIS text here"]
    rng.shuffle(texts)
    return rows + [(100 + 3 * i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("salted", [50_000, 20])
def test_jaccard_components(spark, monkeypatch, salted):
    monkeypatch.setattr(jaccard_join, "SALTED_ROWS", salted)
    rows = join_rows(random.Random(4))
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows] + [(None, rows[20][1], "y", 2), (None, None, "z", 3)], "doc_id long, text string, key string, n int")
    mine = jaccard_join.components(df.repartition(6)).collect()
    assert sorted((r.n_shingles > 0, r.component_id) for r in mine if r.doc_id is None) == [(False, None), (True, None)]
    expected = brute_join(rows)
    same([r for r in mine if r.doc_id is not None], expected)
    for module in (jaccard_join, jaccard_links):
        kept = {r.doc_id for r in module.drop_near_copies(df).collect()}
        assert kept == {k for k, (_, c) in expected.items() if c == k} | {None}


@pytest.mark.parametrize(("salted", "block", "members"), [(50_000, 1024, 1 << 22), (20, 7, 1 << 22), (20, 1024, 500)])
def test_jaccard_links(spark, monkeypatch, salted, block, members):
    monkeypatch.setattr(jaccard_join, "SALTED_ROWS", salted)
    monkeypatch.setattr(jaccard_links, "BLOCK", block)
    monkeypatch.setattr(jaccard_links, "MEMBERS", members)
    rows = join_rows(random.Random(5))
    df = spark.createDataFrame([*rows, (None, rows[20][1]), (None, None)], "doc_id long, text string")
    mine = jaccard_links.linked_documents(df.repartition(6)).collect()
    assert all(r.n_links == 0 for r in mine if r.doc_id is None)
    sets = {}
    for key, text in rows:
        w = words(lower(text or ""))
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    n_links = {a: sum(a != b and bool(y) and 100 * len(x & y) >= 75 * len(x | y) for b, y in sets.items()) for a, x in sets.items()}
    assert max(n_links.values()) > 50
    same([r for r in mine if r.doc_id is not None], {k: (*v, n_links[k]) for k, v in brute_join(rows).items()})


def test_suffix_filter_of_links(monkeypatch):
    monkeypatch.setattr(jaccard_links, "CELLS_AT_ONCE", 64)
    rng = np.random.default_rng(3)
    sets = []
    for n in (3, 40, 41, 300):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, 1, n // 12, n // 8, n // 2, n):
            other = base.copy()
            other[:changed] = rng.integers(0, 1 << 63, changed, dtype=np.uint64)
            sets.append(np.unique(other))
    sizes = np.array([len(s) for s in sets])
    a, b = np.triu_indices(len(sets), 1)
    room = jaccard_links._room([jaccard_join.part_counts(s) for s in sets], sizes, a, b, 75)
    links = np.array([175 * len(np.intersect1d(sets[x], sets[y])) >= 75 * (len(sets[x]) + len(sets[y])) for x, y in zip(a, b)])
    assert room[links].all() and links.any()
    assert room.sum() < links.sum() + 10


def test_jaccard_links_early_filter(frame, monkeypatch):
    """Sets that share prefix shingles but differ too much in length leave at once; data of a set comes once, without its text."""
    rng = random.Random(6)
    other = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    rows = []
    for i in range(12):
        common = other(8)
        rows += [(3 * i, common), (3 * i + 1, f"{common} {other(300)}")]
    near = other(40)
    rows += [(100, near), (101, near + " tail"), (101, near + " tail"), (102, None)]
    stored, found = {}, {}
    real, data = jaccard_links.written, jaccard_links._data_of_sets
    monkeypatch.setattr(jaccard_links, "written", lambda df, label: stored.setdefault(label, []).append(real(df, label)) or stored[label][-1])
    monkeypatch.setattr(jaccard_links, "discard", lambda df: None)

    def kept(*args):
        out = data(*args)
        found.setdefault(args[-1].__name__, out)
        return out

    monkeypatch.setattr(jaccard_links, "_data_of_sets", kept)
    mine = jaccard_links.linked_documents(frame("doc_id long, text string", *rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in mine if r.n_links) == [(100, 100, 2), (101, 100, 2), (101, 100, 2)]
    keys = {r.key for r in stored["links-classes"][0].where("least >= 100").collect()}
    assert {r.key for r in stored["links-shared"][0].select("key").distinct().collect()} == keys
    parts = [r.key for r in found["part_counts"].collect()]
    assert len(parts) == len(set(parts)) and keys <= set(parts)


def test_jaccard_links_of_repeated_rows(frame):
    text = " ".join(f"r{i}" for i in range(60))
    rows = frame("doc_id long, text string", (1, text), (2, text + " end"), (2, text + " end"), (3, text), (4, ""), (5, None))
    mine = sorted(tuple(r) for r in jaccard_links.linked_documents(rows).collect())
    assert mine == [(1, 56, 1, 3), (2, 57, 1, 3), (2, 57, 1, 3), (3, 56, 1, 3), (4, 0, 4, 0), (5, 0, 5, 0)]
    assert jaccard_links.linked_documents(rows.limit(0)).count() == 0


def test_jaccard_borders(frame):
    base = [f"b{i}" for i in range(11)]  # 7 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:-1])), (3, " ".join(base[:-2])), (4, " ".join(base[:8])), (4, " ".join(base[:8]))]
    mine = {r.doc_id: r.component_id for r in jaccard_join.components(frame("doc_id long, text string", *rows)).collect()}
    assert mine == {k: v[1] for k, v in brute_join(rows).items()}


def test_prefix_length():
    assert [jaccard_join.prefix_length(n, 75) for n in (1, 2, 3, 4, 5, 8, 100)] == [1, 1, 1, 2, 2, 3, 26]


# repeated passages


def brute_repeats(rows, window):
    first: dict = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            if key is not None:
                g = tuple(w[i : i + window])
                first[g] = min(key, first.get(g, key))
    out = {}
    for key, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if key is not None and first[tuple(w[i : i + window])] < key:
                gone |= set(range(i, i + window))
        out[key] = (len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def repeat_rows(rng):
    vocabulary = [f"v{i}" for i in range(400)]
    draw = lambda n: rng.choices(vocabulary, k=n)
    shared = [draw(rng.randrange(8, 40)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(160):
        parts = [draw(rng.randrange(0, 30)) for _ in range(3)]
        for p in rng.sample(shared, 2):
            a = rng.randrange(len(p) // 2)
            parts.insert(rng.randrange(4), p[a : rng.randrange(a, len(p)) + 1])
        rows.append((1000 - 5 * i, " ".join(w for p in parts for w in p)))
    rows += [(2000 + i, " ".join(["spam"] * rng.randrange(5, 60))) for i in range(10)]
    rows += [(3000 + i, " ".join(shared[0] + shared[1])) for i in range(50)]
    return rows + [(3100, rows[40][1] + " " + rows[40][1])]


@pytest.mark.parametrize("share", [0.005, 0.00001])
def test_repeated_passages(spark, monkeypatch, share):
    rows = repeat_rows(random.Random(9))
    monkeypatch.setattr(phrase_automata, "BITS", 20)
    if share < 0.001:  # salt everything
        monkeypatch.setattr(phrase_automata, "max", lambda a, b: 1, raising=False)
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, words string").repartition(5)
    same(phrase_automata.remove_repeats(df, window=12, size=5).collect(), brute_repeats(rows, 12))


def test_repeats_without_id_and_twice(frame):
    text = " ".join(f"t{i}" for i in range(70))
    df = frame("doc_id long, text string", (None, text), (5, text), (5, text), (9, "new " + text))
    mine = sorted((tuple(r)[:3] for r in phrase_automata.remove_repeats(df).collect()), key=str)
    assert mine == [(5, 70, 0), (5, 70, 0), (9, 71, 70), (None, 70, 0)]


def test_first_least():
    rng = np.random.default_rng(4)
    for n, width in [(1, 1), (9, 9), (40, 27), (300, 5), (300, 8)]:
        values = rng.integers(0, 6, n).astype(np.uint64)
        want = [i + int(values[i : i + width].argmin()) for i in range(n - width + 1)]
        assert phrase_automata.first_least(values, width).tolist() == want


def test_full_bitmaps_cost_work_only(spark, monkeypatch):
    rows = repeat_rows(random.Random(12))
    monkeypatch.setattr(phrase_automata, "BITS", 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(phrase_automata.remove_repeats(df, window=12, size=5).collect(), brute_repeats(rows, 12))


def test_automaton():
    automaton = phrase_automata.Automaton(4, 2)
    automaton.add([b"a", b"b", b"c", b"d", b"e"], 1, 3)
    automaton.add([b"a", b"b", b"c", b"d", b"e"], 1, 2)
    automaton.compile()
    assert automaton.matches([b"x", b"a", b"b", b"c", b"d", b"e", b"f"]) == [(1, 6, 2)]
    assert automaton.matches([b"b", b"c", b"d"]) == [] and phrase_automata.Automaton(4, 2).matches([b"a"]) == []
    assert phrase_automata.merged([(5, 6), (0, 2), (2, 4), (1, 3)]) == [(0, 4), (5, 6)]


def test_texts_that_repeat_themselves(frame):
    line = [f"w{i}" for i in range(7)]
    rows = [(1, " ".join(line * 300)), (2, " ".join(["x"] + line * 200 + ["y"])), (3, "spam " * 900), (4, "spam " * 2000), (5, "a spam " * 40)]
    mine = phrase_automata.remove_repeats(frame("doc_id long, text string", *rows)).collect()
    same(mine, brute_repeats(rows, 50))


# vectors


def brute_vectors(rows, threshold):
    sound = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        sound[key] = (label, np.array(vector, dtype=float) / np.linalg.norm(vector))
    links, count = [], {r[0]: 0 for r in rows}
    keys = sorted(sound)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            (la, x), (lb, y) = sound[a], sound[b]
            if la == lb and len(x) == len(y) and x @ y >= threshold:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    of = components([r[0] for r in rows], links)
    return {k: (n, of[k], of[k] == k) for k, n in count.items()}


def vector_rows(rng):
    rows = []
    for label in range(3):
        centres = rng.standard_normal((12, 24))
        for i in range(260):
            spread = rng.choice([0.0, 0.1, 0.25, 0.35, 2.0])
            rows.append((label * 1000 + i, [float(x) for x in np.float32(centres[i % 12] + spread * rng.standard_normal(24))], label))
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0]]
    rows += [(5000 + i, v, 0) for i, v in enumerate(odd)] + [(6000, rows[0][1], None)]
    return rows + [(7000 + i, rows[5][1], 0) for i in range(80)]


def test_near_duplicate_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_dup_vectors, "BLOCK", 24)
    rows = vector_rows(np.random.default_rng(3))
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, class string").repartition(5)
    same(near_dup_vectors.near_duplicates(df).collect(), brute_vectors(rows, 0.93))


def test_vectors_empty_and_nameless(spark):
    schema = "vec_id long, embedding array<double>, label int"
    assert near_dup_vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    mine = near_dup_vectors.near_duplicates(spark.createDataFrame([(None, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1), (2, [3.0], 1)], schema)).collect()
    assert sorted((tuple(r) for r in mine), key=str) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 0, None, False)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = near_dup_vectors.unit(rng.standard_normal((400, 64)))
    y = near_dup_vectors.unit(x + 0.5 * rng.standard_normal((400, 64)))
    signs, factors = near_dup_vectors.encode(x, 192)
    estimate, most = near_dup_vectors.upper_bounds(signs, factors, y @ near_dup_vectors.rotations(64, 192))
    true = x @ y.T
    assert abs((estimate - true).mean()) < 0.002 and (most >= true).all() and (most - true).max() < 1


def test_bands():
    agree = 1 - np.arccos(0.93) / np.pi
    for width in (4, 8, 16):
        n = near_dup_vectors.bands_needed(width, 0.93, 1e-5)
        assert (1 - agree**width) ** n <= 1e-5 < (1 - agree**width) ** (n - 1)


# quality


def test_quality_query(spark):
    folder = "/root/testdata/sf0.01"
    mine = queries.op4_quality_mil(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert len(mine) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in mine)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in mine)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in mine if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) / len(held) > 0.93


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 0.1) for i, t in enumerate(ODD)] + [(None, "text", 0.2), (1, "again", 0.3)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 7), (None, 1), (77, 0)], "doc_id long, quality int")
    model = quality_mil.fit(docs, labels)
    mine = quality_mil.scores(docs, model).collect()
    assert len(mine) == len(ODD) + 2 and {r.score for r in mine} == {0.5}
    assert quality_mil.keep_good(docs, model).count() == len(mine)
    assert quality_mil.scores(docs.limit(0), model).count() == 0


def test_quality_gradients():
    rng = np.random.default_rng(1)
    x, bags, label = rng.random((9, quality_mil.FEATURES)), np.array([0, 2, 3]), np.array([0.0, 1.0, 1.0])
    model = quality_mil.AttentionModel.fresh()
    model.w = {k: v.astype(float) for k, v in model.w.items()}

    def loss():
        s = model.forward(x, bags)[0]
        return -(label * np.log(s) + (1 - label) * np.log(1 - s)).mean()

    grads = model.gradients(x, bags, label)
    for name, weight in model.w.items():
        at = tuple(int(rng.integers(n)) for n in weight.shape)
        held = weight[at]
        weight[at] = held + 1e-5
        up = loss()
        weight[at] = held - 1e-5
        down = loss()
        weight[at] = held
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-6, name
    assert np.allclose(quality_mil.AttentionModel.load(model.dump()).forward(x, bags)[0], model.forward(x, bags)[0])


# pipeline


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "secrets", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = common.written(corpus_pipeline.quality(spark, docs, FOLDER), "test-quality")
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == columns and sum(q == (k in ids) for k, q in label.items()) / len(label) > 0.9
    rows = {r.doc_id: r.text for r in kept.collect()}
    unique = common.written(corpus_pipeline.exact(spark, kept, FOLDER), "test-exact")
    best: dict = {}
    for k, t in rows.items():
        best[lower(t or "")] = max(k, best.get(lower(t or ""), k))
    assert unique.columns == columns and {r.doc_id for r in unique.collect()} == set(best.values())
    single = common.written(corpus_pipeline.near(spark, unique, FOLDER), "test-near")
    expected = brute_join([(r.doc_id, r.text) for r in unique.collect()])
    assert {r.doc_id for r in single.collect()} == {k for k, (_, c) in expected.items() if c == k}
    clean = common.written(corpus_pipeline.secrets(spark, single, FOLDER), "test-secrets")
    assert clean.columns == columns and clean.count() == single.count() and all(r.n_chars == len(r.text) for r in clean.collect())
    packed = corpus_pipeline.packing_stage(spark, clean, FOLDER).select("doc_id", "piece", "ids_crc32")
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, packed.collect()))
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.components(docs).count() == phrase_automata.remove_repeats(docs).count() == exact_index.exact_groups(docs).count() == 0


def test_part_counts_bound_the_intersection():
    rng = np.random.default_rng(4)
    for n, m in ((1, 1), (5, 9), (64, 65), (300, 700), (3000, 2500)):
        x = np.unique(common.mix(rng.integers(0, 4000, n).astype(np.uint64)))
        y = np.unique(common.mix(rng.integers(0, 4000, m).astype(np.uint64)))
        counts = jaccard_join.part_counts(y)
        most = jaccard_join.most_common(jaccard_join.part_counts(x), counts[None, :])
        assert most[0] >= len(np.intersect1d(x, y)) and counts.sum() == len(y) and (most <= min(len(x), len(y))).all()
