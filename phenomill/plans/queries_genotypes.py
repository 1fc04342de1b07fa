"""Genotype, structure and association queries with their oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenomill.operators import alleles, association, cohort, genotypes, structure, variant_rows
from phenomill.plans.registry import query, rounded
from phenomill.session import scratch_path
from phenomill.sources import genotypes as genotype_files
from phenomill.sources import sinks

# --- variant statistics ---


@query("SELECT chrom, pos, marker_id, round(af, 6) AS af FROM af")
def allele_frequency(t):
    """From long rows."""
    return rounded(genotypes.allele_frequency(t.genotypes()), "af")


@query("SELECT chrom, pos, marker_id, round(af, 6) AS af FROM af")
def allele_frequency_rows(t):
    """Narrow, from the stored variant rows, as are the next two."""
    variants, _ = t.variant_rows()
    return rounded(genotypes.allele_frequency(variants).drop("ref", "alt"), "af")


@query("SELECT chrom, pos, marker_id, alt_count, ref_count, c1, c2 FROM allele_counts")
def allele_counts(t):
    variants, _ = t.variant_rows()
    return genotypes.allele_counts(variants).drop("ref", "alt")


QC = """
    SELECT chrom, pos, marker_id, hom_ref, het, hom_alt, missing,
           round(least(alt, 1 - alt), 6) AS maf
    FROM (SELECT *, (het + 2 * hom_alt) / (2 * (hom_ref + het + hom_alt)) AS alt FROM geno_counts)
    WHERE least(alt, 1 - alt) >= 0.01"""


@query(QC)
def variant_qc(t):
    variants, _ = t.variant_rows()
    return rounded(genotypes.variant_qc(variants, min_hwe_p=None).drop("ref", "alt"), "maf")


@query(QC)
def variant_qc_long(t):
    """The same from long rows."""
    return rounded(genotypes.variant_qc(t.genotypes(), min_hwe_p=None), "maf")


@query()
def variant_qc_hwe(t):
    """Frequency and exact Hardy-Weinberg filters among unflagged samples."""
    samples = cohort.anti_join_samples(t.raw("embeddings").select(F.col("vec_id").alias("s")), t.flagged_samples())
    variants, index = t.variant_rows()
    return genotypes.variant_qc(variants, samples, index=index).drop("ref", "alt")


@query("SELECT marker_id, c1, c2, mac_class FROM mac_class")
def mac_class(t):
    return genotypes.mac_class(genotypes.allele_counts(t.genotypes())).select("marker_id", "c1", "c2", "mac_class")


@query("""SELECT marker_id, mac_class FROM (SELECT *, row_number() OVER (PARTITION BY mac_class ORDER BY c1, marker_id) AS rn
          FROM mac_class) WHERE rn <= 20""")
def sample_per_class(t):
    """The sampling operator with an order SQL has too (its default is a hash order)."""
    classes = genotypes.mac_class(genotypes.allele_counts(t.genotypes()))
    return genotypes.sample_per_class(classes, 20, [F.col("c1"), F.col("marker_id")]).select("marker_id", "mac_class")


@query("SELECT mac_class, count(*) AS n FROM spread_classes GROUP BY mac_class")
def assert_min_rows(t):
    """Both classes."""
    classes = genotypes.mac_class(genotypes.allele_counts(t.spread_genotypes()))
    checked = genotypes.assert_min_rows(classes, "mac_class", {"common": 20, "rare": 8})
    return checked.groupBy("mac_class").agg(F.count(F.lit(1)).alias("n"))


# --- linkage ---


@query("""SELECT a.chrom, a.idx AS i, b.idx AS j, a.marker_id AS marker_i, b.marker_id AS marker_j
          FROM variants a JOIN variants b ON a.chrom = b.chrom AND b.idx > a.idx AND b.idx - a.idx < 50""")
def ld_pairs(t):
    return genotypes.ld_pairs(genotypes.variant_index(t.genotypes()))


@query("""SELECT a.chrom, a.idx AS i, b.idx AS j, a.marker_id AS marker_i, b.marker_id AS marker_j
          FROM variants a JOIN variants b ON a.chrom = b.chrom AND b.idx > a.idx AND b.pos - a.pos <= 1000000""")
def ld_pairs_kb(t):
    return genotypes.ld_pairs_kb(genotypes.variant_index(t.genotypes()))


@query("""
    WITH g AS (SELECT v.chrom, v.idx, v.marker_id, s, CAST(dosage AS DOUBLE) AS d
               FROM genotypes JOIN variants v USING (marker_id) WHERE dosage IS NOT NULL)
    SELECT a.chrom, a.idx AS i, b.idx AS j, a.marker_id AS marker_i, b.marker_id AS marker_j,
           round(corr(a.d, b.d) * corr(a.d, b.d), 6) AS r2
    FROM g a JOIN g b ON a.s = b.s AND a.chrom = b.chrom AND b.idx > a.idx AND b.idx - a.idx < 50
    GROUP BY ALL""")
def ld_r2(t):
    return rounded(genotypes.ld_r2(t.genotypes()), "r2")


@query("""
    WITH g AS (SELECT v.chrom, v.idx, v.pos, v.marker_id, s, CAST(dosage AS DOUBLE) AS d
               FROM spread JOIN spread_variants v USING (marker_id) WHERE dosage IS NOT NULL)
    SELECT a.chrom, a.idx AS i, b.idx AS j, a.marker_id AS marker_i, b.marker_id AS marker_j,
           round(corr(a.d, b.d) * corr(a.d, b.d), 6) AS r2
    FROM g a JOIN g b ON a.s = b.s AND a.chrom = b.chrom AND b.idx > a.idx AND b.pos - a.pos <= 1000000
    GROUP BY ALL""")
def ld_r2_kb(t):
    """A window of 1000 kb over chromosomes that are longer."""
    return rounded(genotypes.ld_r2(t.spread_genotypes(), kb=1000), "r2")


@query("""
    WITH g AS (SELECT v.chrom, v.idx, v.pos, v.marker_id, s, CAST(dosage AS DOUBLE) AS d
               FROM genotypes JOIN variants v USING (marker_id) WHERE dosage IS NOT NULL)
    SELECT a.chrom, a.idx AS i, b.idx AS j, a.marker_id AS marker_i, b.marker_id AS marker_j,
           round(corr(a.d, b.d) * corr(a.d, b.d), 6) AS r2
    FROM g a JOIN g b ON a.s = b.s AND a.chrom = b.chrom AND b.idx > a.idx AND b.pos - a.pos <= 1000000
    GROUP BY ALL""")
def ld_r2_1000kb(t):
    """The window in use; it holds all pairs of a chromosome here."""
    return rounded(genotypes.ld_r2(t.genotypes(), kb=1000), "r2")


PRUNE = """
    WITH RECURSIVE g AS (SELECT v.chrom, v.idx, v.pos, v.marker_id, s, CAST(dosage AS DOUBLE) AS d
                         FROM genotypes JOIN variants v USING (marker_id) WHERE dosage IS NOT NULL),
         q AS (SELECT chrom, idx, pos, marker_id, round(least(avg(d) / 2, 1 - avg(d) / 2), 12) AS maf FROM g GROUP BY ALL),
         ranked AS (SELECT *, row_number() OVER (ORDER BY maf DESC, chrom, idx) AS k FROM q),
         linked AS (SELECT x.k AS winner, y.k AS loser
                    FROM (SELECT a.marker_id AS m, b.marker_id AS n FROM g a JOIN g b ON a.s = b.s AND a.chrom = b.chrom AND a.idx <> b.idx AND {near}
                          GROUP BY ALL HAVING corr(a.d, b.d) * corr(a.d, b.d) > {r2}) p
                    JOIN ranked x ON x.marker_id = p.m JOIN ranked y ON y.marker_id = p.n WHERE x.k < y.k),
         walk(k, kept) AS (
             SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
             UNION ALL
             SELECT w.k + 1, CASE WHEN EXISTS (SELECT 1 FROM linked l WHERE l.loser = w.k + 1 AND list_contains(w.kept, l.winner))
                                  THEN w.kept ELSE list_append(w.kept, w.k + 1) END
             FROM walk w WHERE w.k < (SELECT max(k) FROM ranked))
    SELECT chrom, pos, marker_id FROM ranked
    WHERE list_contains((SELECT kept FROM walk ORDER BY k DESC LIMIT 1), k)"""


@query(PRUNE.format(near="abs(b.idx - a.idx) < 50", r2="CAST(0.05 AS DOUBLE)"))
def ld_prune(t):
    return genotypes.ld_prune(t.genotypes())


@query(
    PRUNE.replace("FROM genotypes JOIN variants v", "FROM spread JOIN spread_variants v").format(
        near="abs(b.pos - a.pos) <= 1000000", r2="CAST(0.1 AS DOUBLE)"
    )
)
def ld_prune_kb(t):
    return genotypes.ld_prune(t.spread_genotypes(), kb=1000)


@query(PRUNE.format(near="abs(b.pos - a.pos) <= 1000000", r2="CAST(0.1 AS DOUBLE)"))
def ld_prune_1000kb(t):
    return genotypes.ld_prune(t.genotypes(), kb=1000)


@query()
def markers_for_variance_ratio(t):
    """Both classes, pruned by the window of variants."""
    samples = t.raw("embeddings").select(F.col("vec_id").alias("s"))
    return genotypes.markers_for_variance_ratio(t.spread_genotypes(), samples, {"rare": 5, "common": 5})


@query()
def markers_for_variance_ratio_kb(t):
    """Both classes, pruned by 1000 kb at an r2 of 0.1."""
    samples = t.raw("embeddings").select(F.col("vec_id").alias("s"))
    return genotypes.markers_for_variance_ratio(t.spread_genotypes(), samples, {"rare": 5, "common": 5}, kb=1000)


# --- structure ---


def loadings(t):
    number = F.col("pos") / 1000
    first = ((number * 7) % 11 - 5) / 10
    second = ((number * 5) % 13 - 6) / 10
    af = genotypes.allele_frequency(t.genotypes())
    return af.withColumn("loadings", F.array(first, second))


@query("""
    WITH m AS (SELECT count(*) AS m FROM loadings)
    SELECT s, round(sum(l0 * (dosage - 2 * af) / sqrt(m * 2 * af * (1 - af))), 6) AS pc1,
           round(sum(l1 * (dosage - 2 * af) / sqrt(m * 2 * af * (1 - af))), 6) AS pc2
    FROM genotypes JOIN loadings USING (chrom, pos, marker_id), m WHERE dosage IS NOT NULL GROUP BY s""")
def pc_project(t):
    out = structure.pc_project(t.genotypes(), loadings(t), 2)
    return rounded(out.select("s", F.col("scores")[0].alias("pc1"), F.col("scores")[1].alias("pc2")), "pc1", "pc2")


@query("""SELECT chrom, pos, marker_id, round(l0, 6) AS l0, round(af, 6) AS af FROM loadings""")
def join_loadings_af(t):
    bare = loadings(t).select("chrom", "pos", "marker_id", F.col("loadings")[0].alias("l0"))
    return rounded(structure.join_loadings_af(bare, genotypes.allele_frequency(t.genotypes())), "l0", "af")


@query("""
    WITH m AS (SELECT count(*) AS m FROM loadings),
         p AS (SELECT s, s IN (SELECT s FROM flagged) AS related,
                      round(sum(l0 * (dosage - 2 * af) / sqrt(m * 2 * af * (1 - af))), 6) AS pc1
               FROM genotypes JOIN loadings USING (chrom, pos, marker_id), m WHERE dosage IS NOT NULL GROUP BY s)
    SELECT s, pc1 FROM p WHERE related UNION ALL SELECT s, pc1 FROM p WHERE NOT related""")
def union_scores(t):
    scores = structure.pc_project(t.genotypes(), loadings(t), 1)
    parts = [cohort.semi_join_samples(scores, t.flagged_samples()), cohort.anti_join_samples(scores, t.flagged_samples())]
    return rounded(structure.union_scores(*parts).select("s", F.col("scores")[0].alias("pc1")), "pc1")


TURNED = "CASE WHEN (pos // 1000) % 3 = 1 THEN -1 ELSE 1 END"


def foreign_loadings(t):
    """Loadings as another source writes them: a third counts the other allele, of another third the unambiguous pairs are on the other strand."""
    kind = F.floor(F.col("pos") / 1000) % 3
    af = genotypes.allele_frequency(t.genotypes_with_alleles())
    known = loadings(t).select("chrom", "pos", "marker_id", "loadings").join(af, ["chrom", "pos", "marker_id"])
    strand = lambda c: F.when((kind == 2) & ~alleles.is_ambiguous(), F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c))
    swap = kind == 1
    return known.select(
        "chrom",
        "pos",
        F.concat(F.lit("x"), "marker_id").alias("marker_id"),
        F.when(swap, F.col("alt")).otherwise(strand("ref")).alias("ref"),
        F.when(swap, F.col("ref")).otherwise(strand("alt")).alias("alt"),
        F.when(swap, 1 - F.col("af")).otherwise(F.col("af")).alias("af"),
        "loadings",
    )


@query(f"""
    WITH m AS (SELECT count(*) AS m FROM loadings)
    SELECT s, round(sum({TURNED} * l0 * (dosage - 2 * af) / sqrt(m * 2 * af * (1 - af))), 6) AS pc1,
           round(sum({TURNED} * l1 * (dosage - 2 * af) / sqrt(m * 2 * af * (1 - af))), 6) AS pc2
    FROM genotypes JOIN loadings USING (chrom, pos, marker_id), m WHERE dosage IS NOT NULL GROUP BY s""")
def pc_project_alleles(t):
    """Variants matched by locus and alleles; other marker ids, swapped alleles and strands."""
    out = structure.pc_project(t.genotypes_with_alleles(), foreign_loadings(t), 2)
    return rounded(out.select("s", F.col("scores")[0].alias("pc1"), F.col("scores")[1].alias("pc2")), "pc1", "pc2")


@query("""SELECT chrom, pos, 'x' || marker_id AS marker_id, round(l0, 6) AS l0,
                 round(CASE WHEN (pos // 1000) % 3 = 1 THEN 1 - af ELSE af END, 6) AS af FROM loadings""")
def join_loadings_af_alleles(t):
    """Frequencies of the loadings' own alleles."""
    bare = foreign_loadings(t).select("chrom", "pos", "marker_id", "ref", "alt", F.col("loadings")[0].alias("l0"))
    af = genotypes.allele_frequency(t.genotypes_with_alleles())
    return rounded(structure.join_loadings_af(bare, af).drop("ref", "alt"), "l0", "af")


@query()
def hwe_normalized_pca(t):
    """Eigenvalues of the unflagged samples."""
    variants, index = t.variant_rows()
    kept, samples = variant_rows.restrict(variants, index, cohort.anti_join_samples(index, t.flagged_samples()))
    values, _, _ = structure.hwe_normalized_pca(kept, samples=samples)
    return structure.eigenvalue_table(t.spark, values)


@query("""
    WITH k AS (SELECT count(*) AS m FROM loadings),
         z AS (SELECT s, marker_id, (dosage - 2 * af) / sqrt(2 * af * (1 - af) * m) AS z
               FROM genotypes JOIN loadings USING (chrom, pos, marker_id), k WHERE dosage IS NOT NULL),
         g AS (SELECT a.marker_id AS i, b.marker_id AS j, sum(a.z * b.z) AS g FROM z a JOIN z b ON a.s = b.s GROUP BY ALL),
         h AS (SELECT a.i, b.j, sum(a.g * b.g) AS h FROM g a JOIN g b ON a.j = b.i GROUP BY ALL)
    SELECT round((SELECT sum(g) FROM g WHERE i = j), 6) AS first, round((SELECT sum(g * g) FROM g), 6) AS second,
           round((SELECT sum(g.g * h.h) FROM g JOIN h ON g.i = h.j AND g.j = h.i), 6) AS third""")
def pca_moments(t):
    """Sums of the eigenvalues, their squares and cubes, the eigenvalues as squared norms of the scores of all components."""
    variants, samples = t.variant_rows()
    values, scores, _ = structure.hwe_normalized_pca(variants, 64, samples)
    norms = scores.select(F.posexplode("scores").alias("pc", "x")).groupBy("pc").agg(F.sum(F.col("x") * F.col("x")).alias("v"))
    powers = [F.sum(F.pow("v", F.lit(n))).alias(name) for n, name in ((1, "first"), (2, "second"), (3, "third"))]
    return rounded(norms.agg(*powers), "first", "second", "third")


@query()
def population_pcs(t):
    variants, samples = t.variant_rows()
    _, scores, _ = structure.population_pcs(variants, t.flagged_samples(), samples=samples)
    return scores.select("s", *[F.col("scores")[i].alias(f"PC{i + 1}") for i in range(structure.N_COMPONENTS)])


@query("""
    WITH k AS (SELECT count(*) AS m FROM loadings),
         z AS (SELECT s, marker_id, (dosage - 2 * af) / sqrt(2 * af * (1 - af)) AS z
               FROM genotypes JOIN loadings USING (chrom, pos, marker_id) WHERE dosage IS NOT NULL)
    SELECT a.s AS i, b.s AS j, round(sum(a.z * b.z) / max(m), 6) AS kinship
    FROM z a JOIN z b ON a.marker_id = b.marker_id AND a.s <= b.s, k
    GROUP BY a.s, b.s HAVING sum(a.z * b.z) / max(m) >= 0.05""")
def sparse_relatedness(t):
    return rounded(structure.sparse_relatedness(t.genotypes(), block_size=256), "kinship", many=True)


# --- association ---


@query("""
    WITH d AS (SELECT vec_id AS s, CAST(vec_id % 101 + label AS DOUBLE) AS y, CAST(18 + vec_id % 60 AS DOUBLE) AS age FROM embeddings),
         f AS (SELECT regr_slope(y, age) AS b, regr_intercept(y, age) AS a, count(*) AS n FROM d),
         e AS (SELECT s, a + b * age AS mu, y - (a + b * age) AS r, n FROM d, f),
         v AS (SELECT sum(r * r) / (max(n) - 2) AS s2 FROM e)
    SELECT s, round(mu, 6) AS mu, round(r / s2, 6) AS residual, round(1 / s2, 6) AS weight FROM e, v""")
def null_model(t):
    out = association.null_model(t.genotype_phenotype(), "q", "y_quantitative", ["age"], "quantitative", sample="s")
    return rounded(out.select("s", "mu", "residual", "weight"), "mu", "residual", "weight")


def grid_people(t):
    """Samples with an ancestry, two covariates and outcomes of both kinds; and the runs of their grid."""
    people = t.genotype_phenotype().withColumn("ancestry", F.when(F.col("s") % 3 == 0, "afr").otherwise("eur"))
    people = people.withColumn("y_shifted", F.col("y_quantitative") + 2 * F.col("sex") * F.col("age"))
    kinds = {"y_binary": "binary", "y_quantitative": "quantitative", "y_shifted": "quantitative"}
    phenotypes = t.spark.createDataFrame([(k,) for k in kinds], "trait string")
    return people, cohort.run_grid(phenotypes, ["afr", "eur"], ["indep"], ["array", "wgs"]), kinds


@query("""
    WITH d AS (SELECT vec_id AS s, CASE WHEN vec_id % 3 = 0 THEN 'afr' ELSE 'eur' END AS ancestry, CAST(vec_id % 101 + label AS DOUBLE) AS y0,
                      CAST(18 + vec_id % 60 AS DOUBLE) AS a, CAST(vec_id % 2 AS DOUBLE) AS b FROM embeddings),
         u AS (SELECT s, ancestry, a, b, 'y_quantitative' AS trait, y0 AS y FROM d UNION ALL
               SELECT s, ancestry, a, b, 'y_shifted', y0 + 2 * b * a FROM d),
         m AS (SELECT ancestry, trait, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, covar_pop(a, a) AS aa, covar_pop(b, b) AS bb,
                      covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS b_y FROM u GROUP BY ALL),
         f AS (SELECT *, (ay * bb - b_y * ab) / (aa * bb - ab * ab) AS ca, (b_y * aa - ay * ab) / (aa * bb - ab * ab) AS cb FROM m),
         e AS (SELECT s, u.ancestry, u.trait, y - (my + ca * (a - ma) + cb * (b - mb)) AS r, my + ca * (a - ma) + cb * (b - mb) AS mu, n
               FROM u JOIN f USING (ancestry, trait)),
         v AS (SELECT ancestry, trait, sum(r * r) / (max(n) - 3) AS s2 FROM e GROUP BY ALL)
    SELECT s, ancestry, trait, round(mu, 6) AS mu, round(r / s2, 6) AS residual, round(1 / s2, 6) AS weight FROM e JOIN v USING (ancestry, trait)""")
def null_models(t):
    """The quantitative traits of a grid that is fitted in one call, two covariates."""
    people, runs, kinds = grid_people(t)
    out = association.null_models(people, runs, kinds, ["age", "sex"], sample="s").where(F.col("trait") != "y_binary")
    return rounded(out.select("s", "ancestry", "trait", "mu", "residual", "weight"), "mu", "residual", "weight")


@query()
def assoc_scan_grid(t):
    """Every variant, ancestry and trait of the grid, binary ones too."""
    people, runs, kinds = grid_people(t)
    null = association.null_models(people, runs, kinds, ["age", "sex"], sample="s")
    return association.assoc_scan(t.genotypes(), null).drop("covariate_effect")


@query()
def null_model_binary(t):
    return association.null_model(t.genotype_phenotype(), "b", "y_binary", ["age", "sex"], sample="s")


@query()
def rank_inverse_normal(t):
    rows = t.raw("embeddings").select(F.col("vec_id").alias("s"), "label", (F.col("vec_id") % 101).cast("double").alias("y"))
    return association.rank_inverse_normal(rows, ["label"], "y", "y_normal")


@query("""
    WITH d AS (SELECT vec_id AS s, CAST(vec_id % 101 + label AS DOUBLE) AS y FROM embeddings),
         k AS (SELECT avg(y) AS mu, var_samp(y) AS s2, count(*) AS n FROM d),
         mean AS (SELECT marker_id, avg(dosage) AS g0 FROM genotypes GROUP BY marker_id),
         g AS (SELECT marker_id, s, coalesce(CAST(dosage AS DOUBLE), g0) AS g FROM genotypes JOIN mean USING (marker_id)),
         a AS (SELECT marker_id, sum(g) AS ac, sum(g * (y - mu) / s2) AS score, (sum(g * g) - sum(g) * sum(g) / max(n)) / max(s2) AS v,
                      max(n) AS n FROM g JOIN d USING (s), k GROUP BY marker_id)
    SELECT marker_id AS MarkerID, round(ac, 6) AS AC_Allele2, round(ac / (2 * n), 6) AS AF_Allele2, round(score / v, 6) AS BETA,
           round(1 / sqrt(v), 6) AS SE, round(score, 6) AS Tstat, round(v, 6) AS var, n AS N,
           round(greatest(0, 1 - 2 * abs(score) / sqrt(v) / 3000 * list_sum(list_transform(range(0, 1001),
               lambda i: (CASE WHEN i IN (0, 1000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-score * score / v * i * i / 2000000) / sqrt(2 * pi())))), 6) AS "p.value",
           CAST(NULL AS DOUBLE) AS N_case, CAST(NULL AS DOUBLE) AS N_ctrl
    FROM a WHERE v > 0 AND least(ac, 2 * n - ac) >= 0.5""")
def assoc_scan(t):
    """Score test without covariates, which SQL can express (p-values by Simpson's rule)."""
    null = association.null_model(t.genotype_phenotype(), "q", "y_quantitative", [], "quantitative", sample="s")
    columns = ["MarkerID", "AC_Allele2", "AF_Allele2", "BETA", "SE", "Tstat", "var", "N", "`p.value`", "N_case", "N_ctrl"]
    return rounded(association.assoc_scan(t.genotypes(), null).select(*columns), *columns[1:7], "p.value")


@query()
def assoc_scan_adjusted(t):
    null = association.null_model(t.genotype_phenotype(), "b", "y_binary", ["age", "sex"], sample="s")
    return association.assoc_scan(t.genotypes(), null).drop("covariate_effect")


@query()
def spa_pvalue(t):
    null = association.null_model(t.genotype_phenotype(), "b", "y_binary", ["age", "sex"], sample="s")
    scan = association.assoc_scan(t.genotypes(), null)
    return association.spa_pvalue(scan, t.genotypes(), null).drop("covariate_effect")


MASKS = {"plof": ["plof"], "plof_missense": ["plof", "missense"]}


def variant_groups(t):
    """Eight neighbouring markers are a gene; odd positions are missense."""
    number = (F.col("pos") / 1000).cast("int")
    variants = t.genotypes().select("pos", "marker_id").distinct()
    return variants.select(
        F.concat(F.lit("gene"), F.floor(number / 8).cast("string")).alias("gene"),
        F.when(number % 2 == 0, "plof").otherwise("missense").alias("annotation"),
        "marker_id",
    )


@query("""
    WITH q AS (SELECT marker_id, least(af, 1 - af) AS maf, af > 0.5 AS flipped FROM af),
         members AS (SELECT DISTINCT 'gene' || ((pos // 1000) // 8) AS gene, marker_id, mask, max_maf, flipped
                     FROM variants JOIN q USING (marker_id), (VALUES ('plof', 0), ('plof_missense', 0), ('plof_missense', 1)) m(mask, odd),
                          (VALUES (CAST(0.1 AS DOUBLE)), (CAST(0.3 AS DOUBLE))) l(max_maf)
                     WHERE odd = (pos // 1000) % 2 AND maf <= max_maf)
    SELECT gene, mask, max_maf, s, CAST(sum(copies) AS BIGINT) AS dosage
    FROM (SELECT *, CASE WHEN flipped THEN 2 - dosage ELSE dosage END AS copies FROM genotypes JOIN members USING (marker_id))
    WHERE copies > 0 GROUP BY gene, mask, max_maf, s""")
def gene_burden(t):
    """Frequency limits that fit these common markers; the defaults are for rare ones."""
    af = genotypes.allele_frequency(t.genotypes())
    out = association.gene_burden(t.genotypes(), af, variant_groups(t), MASKS, [0.1, 0.3])
    return out.select("gene", "mask", "max_maf", "s", "dosage")


@query()
def gene_burden_scan(t):
    af = genotypes.allele_frequency(t.genotypes())
    burden = association.gene_burden(t.genotypes(), af, variant_groups(t), MASKS, [0.1, 0.3])
    null = association.null_model(t.genotype_phenotype(), "q", "y_quantitative", ["age", "sex"], "quantitative", sample="s")
    return association.assoc_scan(association.burden_markers(burden), null, burden=True).drop("covariate_effect")


# --- files ---


@query("SELECT CAST(s AS VARCHAR) AS s, CAST(chrom AS VARCHAR) AS chrom, pos, marker_id, CAST(dosage AS DOUBLE) AS dosage FROM genotypes")
def scan_vcf_dosage(t):
    """Genotypes written as VCF files of up to a few hundred samples and read back, each chromosome by itself."""
    path = scratch_path(t.spark, "vcf")
    rows = t.sample_dosages().select(
        F.floor(F.col("s") / 256).alias("block"), "s", F.posexplode("dosages").alias("j", "d")
    )
    entry = F.struct("s", F.coalesce(F.concat(F.lit("./.:"), F.col("d").cast("string")), F.lit("./.:.")).alias("e"))
    lines = rows.groupBy("block", "j").agg(F.sort_array(F.collect_list(entry)).alias("es"))
    j = F.col("j")
    fixed = [F.floor(j / 32 + 1), j * 1000, F.concat(F.lit("m"), j.cast("string")), F.lit("A"), F.lit("G"), F.lit("."), F.lit("."), F.lit("."), F.lit("GT:DS")]
    body = lines.select(
        "block", F.concat_ws("\t", *[c.cast("string") for c in fixed], F.array_join("es.e", "\t")).alias("value")
    )
    names = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"])
    header = lines.where("j = 0").select(
        "block", F.concat_ws("\t", F.lit(names), F.array_join(F.col("es.s").cast("array<string>"), "\t")).alias("value")
    )
    header.unionByName(body).repartition("block").write.partitionBy("block").text(path)
    out = genotype_files.scan_vcf_dosage(t.spark, path, "1").unionByName(genotype_files.scan_vcf_dosage(t.spark, path, "2"))
    return out.select("s", "chrom", "pos", "marker_id", "dosage")


@query("SELECT chrom, pos, marker_id, s, dosage FROM genotypes")
def write_genotypes(t):
    """Variant rows written by chromosome, read again and taken apart."""
    path = scratch_path(t.spark, "genotypes")
    variants, samples = t.variant_rows()
    sinks.write_genotypes(variants, path)
    schema = "pos bigint, marker_id string, ref string, alt string, dosages array<int>, chrom bigint"
    return genotype_files.to_long(t.spark.read.schema(schema).parquet(path), samples).drop("ref", "alt")


@query("""SELECT CAST(chrom AS VARCHAR) AS chrom, pos, marker_id, CAST(s AS VARCHAR) AS s, CAST(dosage AS INT) AS dosage,
                 'ACAGAC'[(pos // 1000) % 6 + 1] AS ref, 'GTCTTG'[(pos // 1000) % 6 + 1] AS alt FROM genotypes""")
def scan_plink(t):
    """Variant rows written as a bed / bim / fam set for each chromosome and read again."""
    folder = scratch_path(t.spark, "plink")
    variants, samples = t.variant_rows()
    parts = []
    for chrom in (1, 2):
        prefix = f"{folder}/chr{chrom}"
        sinks.write_plink(variants.where(F.col("chrom") == chrom), samples, prefix)
        rows = genotype_files.scan_plink(t.spark, prefix)
        parts.append(genotype_files.to_long(rows, genotype_files.scan_fam(t.spark, prefix + ".fam")))
    return parts[0].unionByName(parts[1]).withColumn("dosage", F.col("dosage").cast("int"))
