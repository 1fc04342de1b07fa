from __future__ import annotations

import importlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenomill.operators import alleles, association, genotypes, pca, structure, variant_rows
from phenomill.sources import genotypes as files

N, M = 90, 40
SCHEMA = "chrom bigint, pos bigint, marker_id string, s bigint, dosage int"


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(N, 10))
    latent = 0.8 * np.repeat(base, 4, axis=1) + 0.6 * rng.normal(size=(N, M))
    g = (latent > 0.2).astype(float) + (latent > 1.0)
    g[rng.random(g.shape) < 0.03] = np.nan
    g[:, 7] = 0.0  # monomorphic
    return g


@pytest.fixture(scope="module")
def long(spark, matrix):
    rows = [
        (1 + j // 25, 100 * j, f"m{j:02d}", i, None if np.isnan(matrix[i, j]) else int(matrix[i, j]))
        for i in range(N)
        for j in range(M)
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def pair_r2(matrix, i, j):
    both = ~np.isnan(matrix[:, i]) & ~np.isnan(matrix[:, j])
    a, b = matrix[both, i], matrix[both, j]
    if a.std() == 0 or b.std() == 0:
        return None
    return np.corrcoef(a, b)[0, 1] ** 2


def expected_pairs(window):
    return {(i, j) for i in range(M) for j in range(i + 1, M) if i // 25 == j // 25 and j - i < window}


def test_pairs_and_r2_across_tile_borders(long, matrix):
    indexed = genotypes.variant_index(long)
    for window in (6, 50):
        want = expected_pairs(window)
        pairs = genotypes.ld_pairs(indexed, window).collect()
        assert len(pairs) == len(want)
        rows = genotypes.ld_r2(long, window, tile=(7, 20), indexed=indexed).collect()
        got = {(int(r.marker_i[1:]), int(r.marker_j[1:])): r.r2 for r in rows}
        assert set(got) == want
        for (i, j), r2 in got.items():
            assert r2 == (pytest.approx(pair_r2(matrix, i, j)) if pair_r2(matrix, i, j) is not None else None)
    near = genotypes.ld_pairs_kb(indexed, 1).collect()
    assert len(near) == len(expected_pairs(11))
    by_length = {(r.marker_i, r.marker_j): r.r2 for r in genotypes.ld_r2(long, tile=(7, 20), indexed=indexed, kb=1).collect()}
    assert set(by_length) == {(r.marker_i, r.marker_j) for r in near}
    assert all(
        (r2 is None and pair_r2(matrix, int(i[1:]), int(j[1:])) is None) or r2 == pytest.approx(pair_r2(matrix, int(i[1:]), int(j[1:])))
        for (i, j), r2 in by_length.items()
    )


def test_prune_equals_greedy(long, matrix):
    kept = {int(r.marker_id[1:]) for r in genotypes.ld_prune(long, 12, 0.1, tile=(16, 33)).collect()}
    af = np.nanmean(matrix, axis=0) / 2
    maf = np.minimum(af, 1 - af)
    linked = {p for p in expected_pairs(12) if (pair_r2(matrix, *p) or 0) > 0.1}
    chosen = set()
    for v in sorted(range(M), key=lambda v: (-maf[v], v)):
        if not any((min(v, u), max(v, u)) in linked for u in chosen):
            chosen.add(v)
    assert kept == chosen
    assert not any(i in kept and j in kept for i, j in linked)


def test_prune_without_linked_pairs(long):
    assert genotypes.ld_prune(long, 12, 1.0, tile=(16, 33)).count() == M


def test_counts_and_filters(long, frame):
    counts = {r.marker_id: r for r in genotypes.variant_qc(long, chromosomes=[1]).collect()}
    assert "m07" not in counts and "m30" not in counts and len(counts) == 24
    rows = [(1, 1, "x", i, d) for i, d in enumerate([0] * 49 + [1])] + [(1, 2, "y", i, 2 * (i % 2)) for i in range(1000)]
    df = frame(SCHEMA, *rows)
    assert {r.marker_id: r.maf for r in genotypes.with_maf(genotypes.genotype_counts(df)).collect()} == {"x": 0.01, "y": 0.5}
    assert [r.marker_id for r in genotypes.variant_qc(df).collect()] == ["x"]
    assert genotypes.variant_qc(df, min_hwe_p=None).count() == 2
    keep = frame("s bigint", (0,), (49,))
    assert genotypes.variant_qc(df, keep, min_maf=None).count() == 2


def test_mac_classes(frame):
    df = frame(
        "marker_id string, c1 bigint, c2 bigint", ("a", 9, 91), ("b", 10, 90), ("c", 19, 81), ("d", 20, 80), ("e", 45, 55), ("f", 40, 60)
    )
    assert {r.marker_id: r.mac_class for r in genotypes.mac_class(df).collect()} == {
        "b": "rare", "c": "rare", "d": "common", "e": "rare", "f": "common",
    }
    by_count = {r.marker_id: r.mac_class for r in genotypes.mac_class(df, by_minor_count=True).collect()}
    assert by_count == {"b": "rare", "c": "rare", "d": "common", "e": "common", "f": "common"}
    sampled = genotypes.sample_per_class(genotypes.mac_class(df), 1)
    assert sampled.count() == 2
    assert sampled.collect() == genotypes.sample_per_class(genotypes.mac_class(df.repartition(3)), 1).collect()
    with pytest.raises(ValueError):
        genotypes.assert_min_rows(genotypes.mac_class(df), "mac_class", {"rare": 4, "common": 1})


def normalized(matrix, rows):
    af = np.nanmean(matrix[rows], axis=0) / 2
    ok = (af > 0) & (af < 1)
    z = (matrix[:, ok] - 2 * af[ok]) / np.sqrt(2 * af[ok] * (1 - af[ok]) * ok.sum())
    return np.nan_to_num(z)


def test_principal_components(long, matrix, frame):
    flagged = [i for i in range(N) if i % 9 == 0]
    unrelated = [i for i in range(N) if i % 9]
    values, scores, loadings = structure.population_pcs(long, frame("s bigint", *[(i,) for i in flagged]), 5)
    z = normalized(matrix, unrelated)
    _, s, vt = np.linalg.svd(z[unrelated], full_matrices=False)
    assert values == pytest.approx((s[:5] ** 2).tolist())
    got = {r.s: np.array(r.scores) for r in scores.collect()}
    assert set(got) == set(range(N))
    want = z @ vt[:5].T
    stacked = np.array([got[i] for i in range(N)])
    assert np.abs(stacked) == pytest.approx(np.abs(want), abs=1e-8)
    v = np.array([r.loadings for r in loadings.collect()])
    assert v.T @ v == pytest.approx(np.eye(5), abs=1e-8)


def test_components_by_rounds_over_small_tiles(long, matrix, frame, monkeypatch):
    """Fewer directions than variants, so that rounds have to converge; every border lies inside the matrix."""
    for name, value in (("WIDTH", 8), ("VARIANTS", 7), ("SAMPLES", 16), ("TILES_PER_TASK", 3)):
        monkeypatch.setattr(pca, name, value)
    values, scores, loadings = structure.hwe_normalized_pca(long, 3)
    z = normalized(matrix, list(range(N)))
    _, s, vt = np.linalg.svd(z, full_matrices=False)
    assert values == pytest.approx((s[:3] ** 2).tolist(), rel=1e-7)
    got = {r.s: np.array(r.scores) for r in scores.collect()}
    stacked = np.array([got[i] for i in range(N)])
    assert np.abs(stacked) == pytest.approx(np.abs(z @ vt[:3].T), abs=1e-3)
    assert (stacked**2).sum(axis=0) == pytest.approx(values)
    assert np.array([r.loadings for r in loadings.collect()]).sum(axis=0).min() >= 0


def test_no_polymorphic_variant(frame):
    rows = frame("chrom int, pos bigint, marker_id string, s bigint, dosage int", (1, 1, "a", 1, 0), (1, 1, "a", 2, 0))
    with pytest.raises(ValueError):
        structure.hwe_normalized_pca(rows)


def test_variant_rows(spark, long, matrix, frame, monkeypatch):
    monkeypatch.setattr(variant_rows, "PIECE", 32)
    index = variant_rows.sample_index(long)
    holes = long.where("NOT (marker_id = 'm03' AND s < 40)")
    variants = variant_rows.from_long(holes, index).cache()
    rows = {r.marker_id: r.dosages for r in variants.collect()}
    for j in range(M):
        want = [None if np.isnan(v) or (j == 3 and i < 40) else int(v) for i, v in enumerate(matrix[:, j])]
        assert rows[f"m{j:02d}"] == want
    filled = holes.unionByName(long.where("marker_id = 'm03' AND s < 40").withColumn("dosage", F.lit(None).cast("int")))
    for statistic in (genotypes.allele_frequency, genotypes.allele_counts, genotypes.genotype_counts):
        for mine, other in zip(sorted(statistic(variants).collect()), sorted(statistic(filled).collect()), strict=True):
            assert mine[:3] == other[:3] and mine[3:] == pytest.approx(other[3:])
    keep = frame("s bigint", *[(i,) for i in range(0, N, 3)], (0,), (10**6,))
    kept, samples = variant_rows.restrict(variants, index, keep)
    assert [r.s for r in samples.orderBy("sample_idx").collect()] == list(range(0, N, 3))
    assert {r.marker_id: r.dosages for r in kept.collect()} == {k: v[::3] for k, v in rows.items()}
    few = genotypes.variant_qc(variants, keep, index=index).collect()
    assert sorted(few) == sorted(genotypes.variant_qc(filled, keep).collect())


def test_frequencies_of_variant_rows_need_no_shuffle(spark, long, tmp_path):
    variant_rows.from_long(long, variant_rows.sample_index(long)).write.parquet(str(tmp_path / "v"))
    for statistic in (genotypes.allele_frequency, genotypes.allele_counts, genotypes.genotype_counts):
        plan = statistic(spark.read.parquet(str(tmp_path / "v")))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_alleles(frame):
    schema = "chrom int, pos bigint, marker_id string, ref string, alt string"
    mine = [(1, 1, "A", "G"), (1, 2, "A", "G"), (1, 3, "A", "G"), (1, 4, "A", "G"), (1, 5, "A", "T"), (1, 6, "A", "T"), (1, 7, "AC", "A"), (1, 8, "AC", "A"), (1, 9, "A", "G"), (1, 10, "a", "g"), (2, 1, "A", "G"), (1, 11, None, "G")]
    other = [(1, 1, "A", "G"), (1, 2, "G", "A"), (1, 3, "T", "C"), (1, 4, "C", "T"), (1, 5, "A", "T"), (1, 6, "T", "A"), (1, 7, "A", "AC"), (1, 8, "GT", "T"), (1, 9, "A", "C"), (1, 10, "G", "A"), (1, 11, None, "G")]
    left = frame(schema, *[(c, p, "x", r, a) for c, p, r, a in mine])
    right = frame(schema, *[(c, p, "y", r, a) for c, p, r, a in other]).withColumn("af", F.lit(0.25))
    want = {(1, 1): False, (1, 2): True, (1, 3): False, (1, 4): True, (1, 5): False, (1, 6): True, (1, 7): True, (1, 8): False, (1, 9): None, (1, 10): True, (2, 1): None, (1, 11): None}
    assert {(r.chrom, r.pos): r.swapped for r in alleles.join_alleles(left, right, ["af"]).collect()} == want
    strict = {(r.chrom, r.pos): r.swapped for r in alleles.join_alleles(left, right, ["af"], drop_ambiguous=True).collect()}
    assert strict == want | {(1, 5): None, (1, 6): None}


def test_relatedness_over_blocks(long, matrix):
    af = np.nanmean(matrix, axis=0) / 2
    ok = (af > 0) & (af < 1)
    z = np.nan_to_num((matrix[:, ok] - 2 * af[ok]) / np.sqrt(2 * af[ok] * (1 - af[ok])))
    kinship = z @ z.T / ok.sum()
    want = {(i, j): kinship[i, j] for i in range(N) for j in range(i, N) if kinship[i, j] >= 0.05}
    for size in (7, 1000):
        rows = structure.sparse_relatedness(long, block_size=size).collect()
        got = {(r.i, r.j): r.kinship for r in rows}
        assert len(rows) == len(got) and set(got) == set(want)
        assert all(got[k] == pytest.approx(want[k]) for k in want)
    few = structure.random_markers(long, 5).collect()
    assert len(few) == 5 and few == structure.random_markers(long.repartition(3), 5).collect()


def test_related_pairs_leave_under_their_names_without_a_join(spark, long, matrix):
    # A sample without a name counts for the frequencies only, as in SQL; the others keep their own names.
    named = long.withColumn("s", F.when(F.col("s") != 5, F.format_string("p%03d", "s")))
    af = np.nanmean(matrix, axis=0) / 2
    ok = (af > 0) & (af < 1)
    z = np.nan_to_num((matrix[:, ok] - 2 * af[ok]) / np.sqrt(2 * af[ok] * (1 - af[ok])))
    kinship = z @ z.T / ok.sum()
    others = [i for i in range(N) if i != 5]
    want = {(f"p{i:03d}", f"p{j:03d}"): kinship[i, j] for i in others for j in others if i <= j and kinship[i, j] >= 0.05}
    for size in (11, 1000):
        edges = structure.sparse_relatedness(named, block_size=size)
        assert "Join" not in edges._jdf.queryExecution().executedPlan().toString()
        rows = edges.collect()
        got = {(r.i, r.j): r.kinship for r in rows}
        assert len(rows) == len(got) and set(got) == set(want)
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_kinships_are_cut_into_bounded_pieces(long, monkeypatch):
    want = {(r.i, r.j): r.kinship for r in structure.sparse_relatedness(long, block_size=40).collect()}
    monkeypatch.setattr(structure, "KINSHIPS_AT_ONCE", 100)
    rows = structure.sparse_relatedness(long, block_size=40).collect()
    assert len(rows) == len(want) and all(r.kinship == pytest.approx(want[r.i, r.j]) for r in rows)
    assert structure.sparse_relatedness(long.where("false")).count() == 0


# --- association ---


def null_numpy(x, y, binary):
    design = np.column_stack([np.ones(len(y)), x])
    if not binary:
        mu = design @ np.linalg.lstsq(design, y, rcond=None)[0]
        s2 = ((y - mu) ** 2).sum() / (len(y) - design.shape[1])
        return design, mu, (y - mu) / s2, np.full(len(y), 1 / s2)
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-design @ beta))
        w = mu * (1 - mu)
        beta += np.linalg.solve(design.T @ (w[:, None] * design), design.T @ (y - mu))
    mu = 1 / (1 + np.exp(-design @ beta))
    return design, mu, y - mu, mu * (1 - mu)


@pytest.fixture(scope="module")
def phenotypes(spark, matrix):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(N, 2))
    signal = np.nan_to_num(matrix[:, 3]) + x[:, 0]
    y = (signal + rng.normal(size=N) > 2.2).astype(float)
    q = signal + rng.normal(size=N)
    rows = [(i, float(y[i]), float(q[i]), float(x[i, 0]), float(x[i, 1]), 1.0) for i in range(N)]
    df = spark.createDataFrame(rows, "person_id bigint, y double, q double, a double, b double, constant double")
    return x, y, q, df


@pytest.mark.parametrize("binary", [True, False])
def test_scan_against_numpy(long, matrix, phenotypes, binary):
    x, y, q, df = phenotypes
    outcome, kind = ("y", "binary") if binary else ("q", "quantitative")
    null = association.null_model(df, "t", outcome, ["a", "b", "constant"], kind)
    design, mu, residual, weight = null_numpy(x, y if binary else q, binary)
    fitted = {r.s: (r.mu, r.residual, r.weight) for r in null.collect()}
    assert [fitted[i][0] for i in range(N)] == pytest.approx(mu.tolist(), abs=1e-6)

    rows = {int(r.MarkerID[1:]): r for r in association.assoc_scan(long, null).collect()}
    assert 7 not in rows and len(rows) == M - 1
    projection = np.linalg.inv(design.T @ (weight[:, None] * design))
    for j, r in rows.items():
        g = np.where(np.isnan(matrix[:, j]), np.nanmean(matrix[:, j]), matrix[:, j])
        adjusted = g - design @ (projection @ (design.T @ (weight * g)))
        score, var = adjusted @ residual, (weight * adjusted**2).sum()
        assert r.Tstat == pytest.approx(score, abs=1e-5) and r["var"] == pytest.approx(var, rel=1e-5)
        assert r.BETA == pytest.approx(score / var, abs=1e-5) and r.SE == pytest.approx(var**-0.5, rel=1e-5)
        assert r["p.value"] == pytest.approx(math.erfc(abs(score) / math.sqrt(2 * var)), rel=1e-3)
        assert r.AC_Allele2 == pytest.approx(g.sum()) and r.N == N
        assert r.N_case == (y.sum() if binary else None)


def test_null_models_of_a_grid(spark, long, phenotypes):
    """All groups in one call equal single fits, and so do their scans."""
    df = phenotypes[3].withColumns({"ancestry": F.when(F.col("person_id") % 3 == 0, "x").otherwise("y"), "person_id": F.col("person_id").cast("bigint")})
    df = df.withColumn("q", F.when(F.col("person_id") != 5, F.col("q")))
    runs = spark.createDataFrame([(a, t, "more") for a in "xy" for t in ("y", "q")] * 2 + [("z", "q", "")], "ancestry string, trait string, other string")
    covariates = ["a", "b", "constant"]
    both = association.null_models(df, runs, {"y": "binary", "q": "quantitative"}, covariates)
    scanned = association.assoc_scan(long, both).collect()
    rows = {(r.ancestry, r.trait, r.s): r for r in both.collect()}
    for a in "xy":
        for t, kind in (("y", "binary"), ("q", "quantitative")):
            part = df.where(F.col("ancestry") == a)
            one = association.null_model(part, t, t, covariates, kind)
            single = one.collect()
            assert len(single) == sum(1 for k in rows if k[:2] == (a, t))
            for r in single:
                mine = rows[a, t, r.s]
                assert (mine.mu, mine.residual, mine.weight) == pytest.approx((r.mu, r.residual, r.weight), rel=1e-5, abs=1e-6)
                assert mine.is_case == r.is_case and len(mine.x) == 4 and mine.x[3] == 0
            want = {r.MarkerID: r for r in association.assoc_scan(long, one).collect()}
            got = {r.MarkerID: r for r in scanned if (r.ancestry, r.trait) == (a, t)}
            assert got.keys() == want.keys()
            for k, r in want.items():
                assert (got[k].N, got[k].N_case, got[k].N_ctrl) == (r.N, r.N_case, r.N_ctrl)
                assert (got[k].Tstat, got[k]["p.value"]) == pytest.approx((r.Tstat, r["p.value"]), rel=1e-4, abs=1e-4, nan_ok=True)
    with pytest.raises(ValueError):
        association.null_models(df, runs, {"y": "survival"})


def spa_numpy(g, mu, rest, q):
    def k(t):
        return np.log(1 - mu + mu * np.exp(g * t)).sum() - t * (g * mu).sum() + rest * t * t / 2

    def k1(t):
        return (g * (mu * np.exp(g * t) / (1 - mu + mu * np.exp(g * t)) - mu)).sum() + rest * t

    def k2(t):
        p = mu * np.exp(g * t) / (1 - mu + mu * np.exp(g * t))
        return (g * g * p * (1 - p)).sum() + rest

    low, high = -50.0, 50.0
    for _ in range(200):
        t = (low + high) / 2
        low, high = (t, high) if k1(t) < q else (low, t)
    w = math.copysign(math.sqrt(2 * (t * q - k(t))), t)
    r = w + math.log(t * math.sqrt(k2(t)) / w) / w
    return 0.5 * math.erfc((r if q > 0 else -r) / math.sqrt(2))


@pytest.mark.parametrize("piece", [1024, 6])
def test_saddlepoint(long, matrix, phenotypes, piece):
    x, y, _, df = phenotypes
    null = association.null_model(df, "t", "y", ["a", "b"], "binary")
    scan = association.assoc_scan(long, null)
    rows = {int(r.MarkerID[1:]): r for r in association.spa_pvalue(scan, long, null, piece=piece).collect()}
    assert len(rows) == M - 1
    used = [j for j, r in rows.items() if r["Is.SPA"]]
    assert used and all(abs(rows[j].Tstat) > 0.5 * math.sqrt(rows[j]["var"]) for j in used)
    design, mu, residual, weight = null_numpy(x, y, True)
    projection = np.linalg.inv(design.T @ (weight[:, None] * design))
    for j in used:
        g = np.where(np.isnan(matrix[:, j]), np.nanmean(matrix[:, j]), matrix[:, j])
        adjusted = g - design @ (projection @ (design.T @ (weight * g)))
        carrier = g != 0
        rest = (weight * adjusted**2)[~carrier].sum()
        q = abs(adjusted @ residual)
        want = sum(spa_numpy(adjusted[carrier], mu[carrier], rest, side) for side in (q, -q))
        assert rows[j]["p.value"] == pytest.approx(min(want, 1.0), rel=1e-3)
    others = [r for j, r in rows.items() if j not in used]
    assert all(r["p.value"] == r["p.value.NA"] for r in others)
    assert all(rows[j]["SPA.Converged"] for j in used) and {r["SPA.Converged"] for r in others} <= {None, False}


def test_rank_inverse_normal(frame):
    from statistics import NormalDist

    df = frame("t string, v double", ("a", 3.0), ("a", 1.0), ("a", 3.0), ("a", 9.0), ("a", None), ("b", 5.0))
    rows = association.rank_inverse_normal(df, ["t"], "v", "z").collect()
    got = {(r.t, r.v): r.z for r in rows}
    inverse = NormalDist().inv_cdf
    assert got == {
        ("a", 1.0): pytest.approx(inverse(0.125)), ("a", 3.0): pytest.approx(inverse(0.5), abs=1e-12),
        ("a", 9.0): pytest.approx(inverse(0.875)), ("a", None): None, ("b", 5.0): pytest.approx(0.0, abs=1e-12),
    }
    assert len(rows) == 6


def test_null_model_with_normalized_trait(phenotypes):
    out = association.null_model(phenotypes[3], "t", "q", [], "quantitative", inverse_normal=True)
    assert out.agg(F.sum("residual")).first()[0] == pytest.approx(0.0, abs=1e-6)
    with pytest.raises(ValueError):
        association.null_model(phenotypes[3], "t", "q", [], "survival")


def test_burden(frame):
    geno = frame(SCHEMA, (1, 1, "a", 1, 1), (1, 2, "b", 1, 2), (1, 2, "b", 2, 1), (1, 3, "c", 2, 1), (1, 3, "c", 3, None))
    groups = frame("gene string, annotation string, marker_id string", ("G", "plof", "a"), ("G", "missense", "b"), ("G", "plof", "c"))
    maf = frame("marker_id string, af double", ("a", 0.00005), ("b", 0.0005), ("c", 0.005))
    masks = {"plof": ["plof"], "both": ["plof", "missense"]}
    out = association.gene_burden(geno, maf, groups, masks)
    got = {(r["mask"], r.max_maf, r.s): r.dosage for r in out.collect()}
    assert got == {
        ("plof", 0.0001, 1): 1, ("both", 0.0001, 1): 1, ("plof", 0.001, 1): 1, ("both", 0.001, 1): 3, ("both", 0.001, 2): 1,
        ("plof", 0.01, 1): 1, ("plof", 0.01, 2): 1, ("both", 0.01, 1): 3, ("both", 0.01, 2): 2,
    }
    names = {r.marker_id for r in association.burden_markers(out).collect()}
    assert "G:both:0.001" in names


def test_burden_counts_the_minor_allele(frame):
    groups = frame("gene string, annotation string, marker_id string", ("G", "plof", "a"), ("G", "plof", "b"))
    af = frame("marker_id string, af double", ("a", 0.9995), ("b", 0.0005))
    geno = frame(SCHEMA, (1, 1, "a", 1, 2), (1, 1, "a", 2, 1), (1, 1, "a", 3, None), (1, 2, "b", 2, 1))
    out = association.gene_burden(geno, af, groups, {"plof": ["plof"]}, [0.001])
    assert {r.s: r.dosage for r in out.collect()} == {2: 2}
    everyone = frame("s bigint", (1,), (2,), (3,), (4,))
    out = association.gene_burden(geno, af, groups, {"plof": ["plof"]}, [0.001], everyone)
    assert {r.s: (r.dosage, r.chrom) for r in out.collect()} == {2: (2, 1), 4: (2, 1)}


def test_scan_keeps_burdens_and_untested_variants(frame):
    people = frame("s bigint, y double, a double", *[(i, float(i * i % 7), float(i % 3)) for i in range(10)])
    null = association.null_model(people, "t", "y", ["a"], "quantitative", sample="s")
    rows = [(1, 1, "high", i, 3 + i % 2) for i in range(10)] + [(1, 2, "flat", i, 1) for i in range(10)] + [(1, 3, "gone", i, None) for i in range(10)]
    rows += [(1, 4, "one", 0, 2)]
    got = {r.MarkerID: r for r in association.assoc_scan(frame(SCHEMA, *rows), null, burden=True).collect()}
    assert set(got) == {"high", "flat", "gone", "one"} and got["high"].AC_Allele2 == 35.0 and 0 < got["high"]["p.value"] <= 1
    assert got["flat"].BETA is None and got["flat"]["p.value"] is None and got["gone"].AF_Allele2 is None and got["gone"].covariate_effect is None
    assert "high" not in {r.MarkerID for r in association.assoc_scan(frame(SCHEMA, *rows), null).collect()}


# --- files ---


def test_plink_files(spark, tmp_path, matrix):
    code = {2: 0, 1: 2, 0: 3}
    width = -(-N // 4)
    raw = bytearray(b"\x6c\x1b\x01")
    for j in range(M):
        line = bytearray(width)
        for i in range(N):
            bits = 1 if np.isnan(matrix[i, j]) else code[int(matrix[i, j])]
            line[i // 4] |= bits << (2 * (i % 4))
        raw += line
    prefix = str(tmp_path / "array")
    (tmp_path / "array.bed").write_bytes(bytes(raw))
    (tmp_path / "array.bim").write_text("".join(f"{1 + j // 25}\tm{j:02d}\t0\t{100 * j}\tG\tA\n" for j in range(M)))
    (tmp_path / "array.fam").write_text("".join(f"f s{i} 0 0 0 -9\n" for i in range(N)))
    variants = files.scan_plink(spark, prefix, variants_per_task=7)
    rows = {r.marker_id: r for r in variants.collect()}
    assert len(rows) == M and (rows["m30"].chrom, rows["m30"].pos, rows["m30"].ref, rows["m30"].alt) == ("2", 3000, "A", "G")
    for j in range(M):
        want = [None if np.isnan(v) else int(v) for v in matrix[:, j]]
        assert rows[f"m{j:02d}"].dosages == want
    long = files.to_long(variants, files.scan_fam(spark, prefix + ".fam"))
    assert long.count() == N * M
    r = long.where("marker_id = 'm05' AND s = 's17'").first()
    assert r.dosage == (None if np.isnan(matrix[17, 5]) else int(matrix[17, 5]))


def test_plink_rows_are_never_broadcast(spark, tmp_path, monkeypatch):
    n, places = 5000, [5, 9, 40]
    calls = np.random.default_rng(7).integers(-1, 3, (3, n))
    codes = np.array([3, 2, 0, 1], dtype="uint8")[calls].reshape(3, -1, 4)
    (tmp_path / "few.bed").write_bytes(b"\x6c\x1b\x01" + (codes << np.array([0, 2, 4, 6], dtype="uint8")).sum(axis=2, dtype="uint8").tobytes())
    (tmp_path / "few.bim").write_text("".join(f"1\tv{pos}\t0\t{pos}\tG\tA\n" for pos in places))
    (tmp_path / "few.fam").write_text("".join(f"family sample{i} 0 0 0 -9\n" for i in range(n)))
    prefix, limit = str(tmp_path / "few"), "spark.sql.autoBroadcastJoinThreshold"
    want = {(pos, f"sample{i}", None if g < 0 else int(g)) for pos, line in zip(places, calls) for i, g in enumerate(line)}
    spark.conf.set(limit, "8k")
    try:
        for merged in (False, True):
            if merged:  # as if there were too many samples
                monkeypatch.setattr(files, "broadcast_checked", lambda df, *limits: df)
            long = files.to_long(files.scan_plink(spark, prefix), files.scan_fam(spark, prefix + ".fam"))
            plan = long._jdf.queryExecution().executedPlan().toString()
            top = next(line for line in plan.splitlines() if "Join" in line)
            assert "SortMergeJoin" in top if merged else "BuildRight" in top
            rows = long.select("pos", "s", "dosage").collect()
            assert len(rows) == len(want) and set(map(tuple, rows)) == want
    finally:
        spark.conf.unset(limit)


def test_vcf(spark, tmp_path):
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
    (tmp_path / "a.vcf").write_text(
        "##fileformat=VCFv4.2\n" + head + "\tx\ty\n1\t5\tg1\tA\tG\t.\t.\t.\tGT:DS\t0/1:0.5\t./.:.\n2\t6\tg2\tA\tG\t.\t.\t.\tDS\t2\t0\n"
    )
    (tmp_path / "b.vcf").write_text(head + "\tz\n1\t5\tg1\tA\tG\t.\t.\t.\tDS:GT\t1.5:0/1\n1\t7\tg3\tA\tG\t.\t.\t.\tGT\t0/1\n")
    rows = {(r.marker_id, r.s): r.dosage for r in files.scan_vcf_dosage(spark, str(tmp_path)).collect()}
    assert rows == {("g1", "x"): 0.5, ("g1", "y"): None, ("g2", "x"): 2.0, ("g2", "y"): 0.0, ("g1", "z"): 1.5}
    assert files.scan_vcf_dosage(spark, str(tmp_path), "1").count() == 3


def test_registered_window_reaches_across_a_chromosome(spark):
    queries = importlib.import_module("__spark_entry__").queries()
    far = {name: queries[name](spark, "/root/testdata/sf0.001").where("j - i > 20").count() for name in ("ld_r2_kb", "ld_r2_1000kb")}
    assert far["ld_r2_kb"] == 0 < far["ld_r2_1000kb"]
    assert queries["ld_prune_1000kb"](spark, "/root/testdata/sf0.001").count() > 0
